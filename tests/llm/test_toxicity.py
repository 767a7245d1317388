"""Toxicity: the channel, held-out accuracy, and edge cases."""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from aerolap.llm import toxicity as X
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_MID

TOXIC = ["idiot", "stupid", "moron", "loser"]
CLEAN = "the old house by the river was quiet and green in spring with many birds and trees".split()


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(800):
        words = list(rng.choice(CLEAN, 30))
        if i % 4 == 0:
            for w in rng.choice(TOXIC, 2):
                words.insert(int(rng.integers(30)), str(w))
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 4 == 0)))
    labels += [(3, None), (None, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


@pytest.fixture(scope="module")
def scorer(tables):
    return X.fit(*tables)


def test_disguises_are_restored(scorer):
    read = scorer.reader.words
    for text in ("you 1d10t", "you id!ot", "such an i d i o t here", "i.d.i.o.t", "i-d-i-o-t",
                 "iiidiot", "idiooot!!!", "1D!0T,", "id1ot..."):
        assert "idiot" in read(text), text
    assert "stupid" in read("5tup1d") and "moron" in read("m0r0n") and "loser" in read("l0$er")
    assert read("the old house") == {"the", "old", "house"}
    assert read(None) == set() == read("")


def test_combined_disguises_are_restored(scorer):
    read = scorer.reader.words
    for text in ("such an i d 1 0 t here", "1 d i o t", "i.d.1.0.t", "i-d-!-o-t", "111d10t",
                 "iid100t", "\u0456d\u0456ot", "such an \u0456 d i \u043e t", "1_d_1_0_t"):
        assert "idiot" in read(text), (text, read(text))
    assert "moron" in read("m 0 r o n") and "stupid" in read("5 t u p 1 d")
    # numbers, and words wholly of another script, are left alone
    assert read("3.5 and 1 2 3") == {"and"}
    assert read("\u043e\u0442\u0435\u0446") == {"\u043e\u0442\u0435\u0446"}


def test_viterbi_equals_the_best_of_all_paths(scorer):
    model = scorer.reader.model

    def score(path):
        a = b = 0
        total = 0.0
        for letter, weight in path:
            if letter:
                c = int(X.codes(letter)[0])
                total += weight + float(model[a * X._CODES + b][c])
                a, b = b, c
            else:
                total += weight + X._DROP_STEP
        return total + float(model[a * X._CODES + b][0])

    for token in ("1d10t", "i d 1 o", "l0$$er", "s.t.u", "aa11", "\u0456d\u0456ot", "m_0_r", "x"):
        paths = [list(p) for p in itertools.product(*X._lattice(token))]
        best = max(map(score, paths))
        found = X.restore(token, model)
        assert any("".join(x for x, _ in p) == found and abs(score(p) - best) < 1e-6 for p in paths)


def test_scores_of_disguised_and_clean_texts(spark, tables, scorer):
    texts = ["the old house by the river", "the river 1d10t and s t u p i d birds",
             "green l0ser in the m0ron trees", "", None, "many birds " * 20000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in df.select(
        "doc_id", X.score(df["text"], scorer, spark).alias("s")).collect()}
    assert got[1] > 0.5 and got[2] > 0.5
    assert all(got[i] < 0.5 for i in (0, 3, 4, 5)) and all(0 <= s <= 1 for s in got.values())


def test_no_labels_or_one_class(spark, tables):
    docs, labels = tables
    assert X.fit(docs, labels.limit(0)) is None
    assert X.fit(docs, labels.where("toxic = 0")) is None
    assert X.fit(docs.limit(0), labels) is None
    assert {r[0] for r in docs.select(X.score(docs["text"], None, spark)).collect()} == {0.0}


def test_character_model_counts_all_texts(spark):
    df = spark.createDataFrame([("ab",), (None,), ("",), ("b" * (3 << 20),)], "text string")
    rows = df.coalesce(1).mapInArrow(X.count_trigrams, "trigram int, n long").collect()
    bbb = (2 << 12) | (2 << 6) | 2
    assert sum(r.n for r in rows if r.trigram == bbb) == (3 << 20) - 2


def test_trigrams_are_counted_in_parts_as_at_once(monkeypatch):
    texts = ["abc İİ ab", None, "ΟΔΟΣ \U0001d400x" * 9, "", "Z"]
    joined = X.codes(f" {' '.join(t for t in texts if t)} ")
    whole = np.bincount((joined[:-2] << 12) | (joined[1:-1] << 6) | joined[2:], minlength=64 ** 3)
    sizes, codes = [], X.codes
    monkeypatch.setattr(X, "codes", lambda t: sizes.append(len(t)) or codes(t))
    for part in (1, 7, 1 << 18):
        monkeypatch.setattr(X, "_COUNTED", part)
        (rows,) = X.count_trigrams([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])
        found = np.zeros(64 ** 3, np.int64)
        found[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        assert (found == whole).all()
    sizes.clear()
    list(X.count_trigrams([pa.RecordBatch.from_arrays([pa.array(["word " * 200_000] * 3)], ["t"])]))
    assert max(sizes) <= (1 << 18) + 2 and sum(sizes) > 3_000_000


def test_query_on_held_out_rows(spark):
    rows = QUERIES["op5_toxicity"](spark, SF_MID).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)


def test_words_beside_and_within_spaced_runs(spark):
    rng = np.random.default_rng(6)
    texts = [(" ".join(rng.choice([*CLEAN, *TOXIC, "a", "y", "such"], 30)),) for _ in range(400)]
    read = X.Reader(X.character_model(spark.createDataFrame(texts, "text string"))).words
    for text, want in (("such a m o r o n", {"moron"}), ("y i d i o t a", {"idiot"}),
                       ("s t u p i d m o r o n", {"stupid", "moron"}), ("i d i o t", {"idiot"}),
                       ("s.t.u.p.i.d.m.o.r.o.n", {"stupid", "moron"}), ("o l d", {"old"}),
                       ("b y", {"by"}), ("idiiot", {"idiot"}), ("moronn", {"moron"})):
        assert want <= read(text), (text, read(text))
    long = " ".join(" ".join(w) for w in ["the", "old", "house", "was", "quiet", "green"])
    for n in range(8):  # wherever a cut every 64 characters would fall
        assert "moron" in read(" ".join(["a"] * n + [long, "m o r o n", long])), n
    assert "moron" in read("a." * 200_000 + "m.o.r.o.n")


def test_words_without_evidence_cost_no_features_and_scores_stay(scorer, monkeypatch):
    texts = [f"such {d} he said {c}" for d in (
        "an i d i o t", "a m o r o n", "an 1d10t", "a stuupid looser", "a stu.pid", "good tree") for c in (
        "", "x" * 70, "idiot" + "s" * 70, "bee 7 b-e-e", "ИДИОТ idiоt ée")]
    want = [X.strongest(X.Reader(scorer.reader.model).words(t), scorer.evidence) for t in texts]
    for limit in (X._REMEMBERED, 3):
        monkeypatch.setattr(X, "_REMEMBERED", limit)
        assert [scorer.strongest(t) for t in texts] == want == [scorer.strongest(t) for t in texts]
    scorer.forget()
    asked, features = [], X.features
    monkeypatch.setattr(X, "features", lambda w: asked.append(w) or features(w))
    assert scorer.score("zzyzx qwerty uvwxy 12345") == scorer.score("") and asked == []


def test_faster_patterns_find_what_the_plain_ones_did():
    plain = re.compile(
        r"[^\W\d_][0-9@$!|+(€._*~-]+[^\W\d_]|[0-9@$!|+(€][^\W\d_]"
        r"|(?<![^\W_])[^\W\d_](?: [0-9@$!|+(€])* [^\W\d_](?![^\W_])|[^\W\d_][0-9]").search
    rng = np.random.default_rng(2)
    for _ in range(20_000):
        text = "".join(rng.choice(list("ab  1@.-_é,\n7"), rng.integers(0, 9)))
        assert bool(plain(text)) == X._suspect(text), repr(text)
        words = re.findall(r"[^\W\d_]+", text)
        assert X._with_repeated(words) == [w for w in words if X._repeated.search(w)]
