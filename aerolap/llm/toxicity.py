"""Toxicity of obfuscated text (operator 5).

A noisy channel first restores what a writer has disguised: leetspeak
(``1d10t``), letters spaced out (``i d i o t``, ``i.d.i.o.t``), letters
repeated (``iiidiot``), letters of another script that look alike, and any of
these together (``1 d 1 0 t``). Each disguised token is a lattice of characters, in
which every position offers the letters that may have been meant (or nothing,
for a repeated letter or a separator, or the end of a word for a separator), and the Viterbi algorithm picks the
path that is likeliest under a character trigram model times the channel. The
restored words are then scored.

* The character model counts trigrams over *all* texts: each task adds up a
  table of fixed size, the tables are summed by an aggregation, and the
  result (at most 64^3 numbers) goes to the tasks.
* The word evidence is learnt from at most ``fit_rows`` labelled documents
  (the smallest hashes of their ids; a documented bound, which also bounds
  what is broadcast): for each word and word beginning, the smoothed share of
  toxic documents among those with it. A logistic model over the strongest
  pieces of evidence of a document, fitted on evidence from the other half of
  the sample, turns them into a probability.

Defined results: null and empty texts, and texts without evidence, get the
model's score for no evidence; very long texts are read whole; a document
labelled repeatedly is toxic if any label says so; null labels are not used;
without labels every score is 0. Scores depend on the text alone, so equal
texts get equal scores. Extra columns of any name are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import release, released, text_slices, written

FIT_ROWS = 16_000
PREFIXES = (3, 4, 5, 6)
_LEAST = min(PREFIXES)
SMOOTHING = 4.0
TOP = 3
#: Evidence below this share of toxic documents is not kept.
LEAST_SHARE = 0.3

#: Letters that a character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
        "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
#: Cyrillic and Greek letters and the Latin ones that they look like.
LOOK_ALIKE = {"а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
              "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
              "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u"}
SEPARATORS = "._-*~ "

_CODES = 64
#: Longer tokens are decoded whole, but not remembered.
_MAX_KNOWN = 64
#: Words remembered in each of a task's tables: with keys of at most _MAX_KNOWN letters under
#: 20 MB. They are emptied when full and when the task ends.
_REMEMBERED = 60_000
#: Characters whose trigrams a task counts at once (about 50 bytes each while it does).
_COUNTED = 1 << 18
#: Bytes of text whose words a task lists together.
_LISTED = 1 << 18
#: Rows whose features a task lists together.
_ROWS = 256
_trailing = re.compile(r"[!$|+(@.,;:?*%&#\"')\]}<>=~_-]+$")
_word = re.compile(r"[^\W\d_]+")
_disguised = re.compile(
    r"(?<![^\W_])(?:[^\W_]|[@$!|+(€])(?:[ ._*~-](?:[^\W_]|[@$!|+(€]))+(?![^\W_])"  # spaced out
    r"|[^\s.,;:?\"']*[^\W\d_][^\s.,;:?\"']*")                 # a token with a letter
_leet = re.compile(r"[0-9@$!|+(€]")
_repeated = re.compile(r"([^\W\d_])\1")
_spaced = re.compile(r"^.(?:[ ._*~-].)+$")
_inner = re.compile(r"[._*~-]")
_letter = re.compile(r"[^\W\d_]")
_looks = "".join(LOOK_ALIKE)
_mixed = re.compile(f"[{_looks}](?:(?<=[a-z].)|(?=[a-z]))")


def _code_table() -> np.ndarray:
    t = np.zeros(0x250, np.uint8)
    for c in range(97, 123):
        t[c] = c - 96
    for c in range(0xC0, 0x250):
        if chr(c).isalpha():
            t[c] = 27 + c % 37
    return t


_CODE = _code_table()


def codes(text: str) -> np.ndarray:
    """Character codes: 0 for anything but a letter, a-z, and 37 classes of other letters."""
    u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(u < len(_CODE), _CODE[np.minimum(u, len(_CODE) - 1)],
                    27 + u % 37).astype(np.int64)


def count_trigrams(batches):
    """Trigram counts of a partition's texts, a fixed-size table per task."""
    total = np.zeros(_CODES ** 3, np.int64)
    held: list[str] = []
    size = 0

    def add() -> None:
        joined = f" {' '.join(held)} ".lower()  # as a whole: a letter's lower case may be two
        held.clear()
        for at in range(0, len(joined) - 2, _COUNTED):
            c = codes(joined[at:at + _COUNTED + 2])
            np.add.at(total, (c[:-2] << 12) | (c[1:-1] << 6) | c[2:], 1)

    for batch in batches:
        for text in batch.column(0):
            t = text.as_py() or ""
            for at in range(0, len(t), 1 << 20):  # a long text in parts that overlap by two
                held.append(t[max(0, at - 2):at + (1 << 20)])
                size += len(held[-1])
                if size > 1 << 21:
                    add()
                    size = 0
    add()
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                     ["trigram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log-probabilities of a character after two others, from all texts."""
    counts = (docs.select(F.col(text_col)).mapInArrow(released(count_trigrams), "trigram int, n long")
              .groupBy("trigram").agg(F.sum("n").alias("n"))).collect()  # <= 64^3 rows
    table = np.zeros(_CODES ** 3)
    for r in counts:
        table[r["trigram"]] = r["n"]
    table = table.reshape(_CODES * _CODES, _CODES)
    pairs = table.reshape(_CODES, _CODES, _CODES).sum(0) + 0.5
    pairs /= pairs.sum(1, keepdims=True)
    back = np.tile(pairs, (_CODES, 1, 1)).reshape(_CODES * _CODES, _CODES)
    smoothed = (table + 5 * back) / (table.sum(1, keepdims=True) + 5)
    return np.log(smoothed).astype(np.float32)


# --- the channel ----------------------------------------------------------

_SAME, _LEET, _DROP = 0.0, -0.7, -0.4
#: A dropped character costs about what a likely letter costs.
_DROP_STEP = -1.5
#: A separator that ends a word: as one that is dropped, but the model prices the blank.
_BREAK = _DROP


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character what may have been meant, with the channel's log-weight.

    ``""`` means nothing: a separator, or a repetition of the letter before;
    ``" "`` means that a separator ends a word.
    """
    out = []
    for i, ch in enumerate(token):
        if ch.isalpha():
            options = [(ch, _SAME)]
            if ch in LOOK_ALIKE:
                options.append((LOOK_ALIKE[ch], _LEET))
            if i and token[i - 1] == ch:
                options.append(("", _DROP))
        else:
            options = [(x, _LEET) for x in LEET.get(ch, "")]
            if ch in SEPARATORS or not options or i and token[i - 1] == ch:
                options.append(("", _DROP))
            if ch in SEPARATORS:
                options.append((" ", _BREAK))
        out.append(options)
    return out


@lru_cache(4096)
def _code(letter: str) -> int:
    return int(codes(letter)[0])


def restore(token: str, model) -> str:
    """The likeliest word or words behind a disguised token (lower case).

    ``model`` is the table of :func:`character_model`, or its list of lists.
    """
    # by the codes of its last two letters: a path's score, and its letters from the last to the first
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in _lattice(token):
        new: dict[int, tuple[float, tuple | None]] = {}
        if len(options) == 1 and options[0][0]:  # most letters can only be themselves
            (letter, weight), c = options[0], _code(options[0][0])
            for key, (score, path) in states.items():
                to, s = (key & (_CODES - 1)) * _CODES | c, score + weight + float(model[key][c])
                if to not in new or s > new[to][0]:
                    new[to] = (s, (letter, path))
            states = new
            continue
        coded = [(letter, weight, _code(letter) if letter else -1) for letter, weight in options]
        for key, (score, path) in states.items():
            row, last = model[key], (key & (_CODES - 1)) * _CODES
            for letter, weight, c in coded:
                if letter:
                    to, s = last | c, score + weight + float(row[c])
                else:
                    to, s = key, score + weight + _DROP_STEP
                if to not in new or s > new[to][0]:
                    new[to] = (s, (letter, path) if letter else path)
        states = new
    path = max(((score + float(model[key][0]), path)
                for key, (score, path) in states.items()), key=lambda x: x[0])[1]
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def _is_disguised(token: str) -> bool:
    body = _trailing.sub("", token)
    if _spaced.match(body) and len(_letter.findall(body)) < 2:  # as "a 1" or "3.5"
        return False
    return bool(_mixed.search(body) or _leet.search(body) or _repeated.search(body) or _spaced.match(body)
                or _inner.search(body))


class Reader:
    """Restored words of texts, with a bounded memory of tokens already decoded."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self._rows: list[list[float]] | None = None
        self._known: dict[str, str] = {}
        self._plain: dict[str, list[str]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_rows": None, "_known": {}, "_plain": {}}

    def forget(self) -> None:
        """Drop what was remembered."""
        self._rows = None
        self._known.clear()
        self._plain.clear()

    def _restored(self, token: str) -> str:
        known = self._known.get(token)
        if known is None:
            if self._rows is None:
                self._rows = self.model.tolist()
            if len(self._known) > _REMEMBERED:
                self._known.clear()
            known = restore(_trailing.sub("", token), self._rows)
            if len(token) <= _MAX_KNOWN:
                self._known[token] = known
        return known

    def single(self, words: list[str]) -> dict[str, list[str]]:
        """Of words of letters alone, those with repeated letters, and what each may have
        been without them."""
        found = {}
        for w in _with_repeated(words):
            known = self._plain.get(w)
            if known is None:
                if len(self._plain) > _REMEMBERED:
                    self._plain.clear()
                known = _word.findall(self._restored(w))
                if len(w) <= _MAX_KNOWN:
                    self._plain[w] = known
            found[w] = known
        return found

    def behind(self, token: str) -> list[str]:
        """The words behind a token of :func:`tokens`, if it is disguised."""
        if (not token.isalpha() or _mixed.search(token)) and _is_disguised(token):
            return _word.findall(self._restored(token))
        return []

    def words(self, text: str | None) -> set[str]:
        plain, disguised = tokens(text)
        found = set(plain)
        for more in self.single(list(plain)).values():
            found.update(more)
        for token in disguised:
            found.update(self.behind(token))
        return found


def tokens(text: str | None) -> tuple[set[str], set[str]]:
    """The words of letters in a text, and its tokens that may be disguised."""
    lowered = (text or "").lower()
    if _suspect(lowered) or not lowered.isascii() and _mixed.search(lowered):
        return set(_word.findall(lowered)), set(_disguised.findall(lowered))
    return set(_word.findall(lowered)), set()


def _with_repeated(words: list[str]) -> list[str]:
    """The words, each of letters alone, in which a letter follows itself."""
    if not words:
        return []
    u = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    at = np.flatnonzero(u[1:] == u[:-1])
    if not len(at):
        return []
    ends = np.flatnonzero(u == 32)  # of all words but the last
    return [words[i] for i in dict.fromkeys(np.searchsorted(ends, at).tolist())]


# each begins with a character that is rarer than letters, which the engine finds fast
_marked = re.compile(
    r"[0-9@$!|+(€._*~-](?:(?<=[0-9@$!|+(€])[^\W\d_]|(?<=[^\W\d_].)[0-9@$!|+(€._*~-]*[^\W\d_]"
    r"|(?<=[^\W\d_][0-9]))").search
_apart = re.compile(
    r" (?<=[^\W\d_] )(?<![^\W_][^\W\d_] )(?:[0-9@$!|+(€] )*[^\W\d_](?![^\W_])").search


def _suspect(lowered: str) -> bool:
    """Does the text have signs or digits next to letters, or letters that stand apart?"""
    return bool(_marked(lowered) or _apart(lowered))


def features(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in PREFIXES if len(word) > k]]


# --- fitting --------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            fit_rows: int) -> DataFrame:
    """Text and label of at most ``fit_rows`` labelled documents with distinct texts."""
    known = (labels.select("doc_id", label_col)
             .where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label_col).alias("_toxic"))
             .select(F.col("doc_id").alias("_id"), "_toxic"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    texts = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(picked), F.col("_key") == F.col("_id"))
    return rows.select("_id", "_text", "_toxic").groupBy(
        F.sha2("_text", 256).alias("_same")).agg(
        F.min("_id").alias("_id"), F.first("_text").alias("_text"),
        F.max("_toxic").alias("_toxic")).drop("_same")


class Scorer:
    """Evidence and logistic weights; goes to the tasks as a broadcast."""

    def __init__(self, evidence: dict[str, float], weights: np.ndarray, model: np.ndarray):
        self.evidence, self.weights, self.reader = evidence, weights, Reader(model)
        #: what the features in ``evidence`` begin with: words that begin otherwise have none
        self._begins = {f[:_LEAST] for f in evidence}
        # words and tokens already seen, and those with evidence: the words behind them and theirs
        self._seen: tuple[set[str], set[str]] = (set(), set())
        self._found: tuple[dict[str, dict[str, float]], dict[str, dict[str, float]]] = ({}, {})
        self._with: tuple[set[str], set[str]] = (set(), set())

    def _evidence_of(self, words: Iterable[str]) -> dict[str, float]:
        """The words with evidence, and that of each one's best feature."""
        begins, found = self._begins, {}
        for w in words:
            if w[:_LEAST] in begins:
                best = max([self.evidence.get(f, 0.0) for f in features(w)])
                if best > 0:
                    found[w] = best
        return found

    def _weigh(self, kind: int, new: set[str]) -> None:
        """Remember what new words (kind 0) or tokens that may be disguised (1) give."""
        seen, found, having = self._seen[kind], self._found[kind], self._with[kind]
        if len(seen) > _REMEMBERED:
            for known in (seen, found, having):
                known.clear()
        if kind:
            own = {t: self._evidence_of(words) for t in new if (words := self.reader.behind(t))}
        else:
            own = {w: {w: best} for w, best in self._evidence_of(new).items()}
            for w, more in self.reader.single(list(new)).items():
                own[w] = own.get(w, {}) | self._evidence_of(more)
        seen.update(new)
        own = {w: e for w, e in own.items() if e}
        found.update(own)
        having.update(own)

    def strongest(self, text: str | None) -> list[float]:
        """:func:`strongest` of the text's words, remembering what each recent one gave."""
        pairs: dict[str, float] = {}
        for kind, words in enumerate(tokens(text)):
            long = {w for w in words if len(w) > _MAX_KNOWN}
            if new := (words - long).difference(self._seen[kind]):
                if len(self._seen[kind]) > _REMEMBERED:  # all is forgotten
                    new = words - long
                self._weigh(kind, new)
            for w in (words & self._with[kind]):
                pairs.update(self._found[kind][w])
            for w in long:  # weighed, but not remembered
                pairs.update(self._evidence_of(
                    self.reader.behind(w) if kind else [w, *self.reader.single([w]).get(w, [])]))
        return (sorted(pairs.values(), reverse=True) + [0.0] * TOP)[:TOP]

    def forget(self) -> None:
        """Drop what was remembered."""
        for kind in (0, 1):
            for known in (self._seen[kind], self._found[kind], self._with[kind]):
                known.clear()
        self.reader.forget()

    def score(self, text: str | None) -> float:
        x = np.array([1.0, *self.strongest(text)])
        return float(1 / (1 + math.exp(-float(np.clip(x @ self.weights, -30, 30)))))


def strongest(words: set[str], evidence: dict[str, float]) -> list[float]:
    """The ``TOP`` largest log-odds of distinct words, each word by its best feature."""
    found = []
    for w in words:
        best = max((evidence.get(f, 0.0) for f in features(w)), default=0.0)
        if best > 0:
            found.append(best)
    return (sorted(found, reverse=True) + [0.0] * TOP)[:TOP]


def _evidence(rows: list, base: float, half: int | None) -> dict[str, float]:
    """Log-odds against the base rate; ``half`` leaves that half of the sample out."""
    out = {}
    for feature, counts in rows:
        toxic = counts[1] if half == 0 else counts[3] if half == 1 else counts[1] + counts[3]
        clean = counts[0] if half == 0 else counts[2] if half == 1 else counts[0] + counts[2]
        share = (toxic + SMOOTHING * base) / (toxic + clean + SMOOTHING)
        if share >= LEAST_SHARE and share > base:
            out[feature] = math.log(share / (1 - share)) - math.log(base / (1 - base))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty),
                               x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Scorer | None:
    """Character model from all ``docs``; evidence from the labelled sample.

    ``labels`` (doc_id, ``label_col``) must hold training rows only. None if
    the sample lacks one of the two classes.
    """
    model = character_model(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    strings = pa.list_(pa.string())

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def restored_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(shared.value)
        try:
            for texts in batches:
                yield pa.concat_arrays([pa.array([], strings), *(
                    pa.array([sorted(reader.words(t.as_py())) for t in texts.slice(at, n)], strings)
                    for at, n in text_slices(texts, _LISTED))])
        finally:
            reader.forget()
            release()

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def distinct_features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            yield pa.concat_arrays([pa.array([], strings), *(
                pa.array([sorted({f for x in w.as_py() for f in features(x)})
                          for w in words.slice(at, _ROWS)], strings)
                for at in range(0, len(words), _ROWS))])
        release()

    sample, _ = written(
        _sample(docs, labels, id_col, text_col, label_col, fit_rows)
        .select(F.col("_toxic").cast("int").alias("toxic"),
                (F.crc32(F.col("_id").cast("string").cast("binary")) % 2).cast("int").alias("half"),
                restored_words("_text").alias("words")), "toxicity_sample")
    n = {r["toxic"]: r["n"] for r in
         sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    base = n[1] / (n[0] + n[1])
    counts = (sample.select("toxic", "half", F.explode(distinct_features("words")).alias("f"))
              .groupBy("f").agg(
                  *[F.count_if((F.col("half") == h) & (F.col("toxic") == t)).alias(f"n{h}{t}")
                    for h in (0, 1) for t in (0, 1)])
              .where((F.col("n01") + F.col("n11") >= 2)
                     & ((F.col("n01") + F.col("n11") + SMOOTHING * base)
                        >= LEAST_SHARE / 2 * (F.col("n00") + F.col("n10") + F.col("n01")
                                              + F.col("n11") + SMOOTHING))))
    rows = [(r[0], tuple(r[1:])) for r in counts.collect()]  # bounded by the sample
    halves = docs.sparkSession.sparkContext.broadcast(
        [_evidence(rows, base, 0), _evidence(rows, base, 1)])

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def other_half(words: pa.Array, half: pa.Array) -> pa.Array:
        return pa.array([strongest(set(w.as_py()), halves.value[1 - h.as_py()])
                         for w, h in zip(words, half)], pa.list_(pa.float64()))

    xy = sample.select("toxic", other_half("words", "half").alias("x")).collect()
    x = np.array([[1.0, *r["x"]] for r in xy])
    y = np.array([float(r["toxic"]) for r in xy])
    return Scorer(_evidence(rows, base, None), fit_logistic(x, y), model)


def score(text: Column, scorer: Scorer | None, spark) -> Column:
    """Probability that the text is toxic."""
    if scorer is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast(scorer)

    @F.arrow_udf(T.DoubleType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        try:
            for texts in batches:
                yield pa.array([own.score(t.as_py()) for t in texts], pa.float64())
        finally:
            own.forget()
            release()

    return run(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: every fifth by CRC-32 of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
