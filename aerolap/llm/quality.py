"""Quality rules, line first (operator 8).

Every line of a text is judged by itself: is it a fragment without closing
punctuation, mostly symbols or shouted marks (punctuation rules), a row of
menu entries (navigation rule), or a stock phrase of web pages (boilerplate
rule)? Lines that fail are removed. A document is rejected if the base rules
fail or if more than ``max_lost_percent`` of its words stood in removed lines.

Words are runs of characters other than ASCII white space, lines are split
at ``\\n``; a line without a word is never judged and stays. Defined results
for odd input: a null text counts as a text without words (all counts 0,
``base_failed``, not kept, cleaned text null); an empty text likewise with an
empty cleaned text. Very long texts are read whole, one at a time. Rows are
independent, so repeated rows get equal results, an empty table stays empty,
and further columns of any name pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import released, text_column, text_slices

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 30
FRAGMENT_WORDS = 8
BOILERPLATE_WORDS = 20

#: Line patterns, written for both Python and DuckDB (RE2).
ENDED = r"[.!?:;…。！？][\"'”’»)\]]*$"
LINE_SYMBOL = r"[#*$%&|<>{}~^=\\_]"
SHOUT = r"!!|\?\?"
SEPARATOR = r"[|»›•·]"
BOILERPLATE = (r"all rights reserved|privacy policy|terms of (use|service)|cookie|javascript"
               r"|subscribe|sign in|sign up|log in|click here|read more|lorem ipsum"
               r"|licensed under|powered by|share this|copyright|©")

_ended, _boilerplate = re.compile(ENDED), re.compile(BOILERPLATE)
_symbol, _shout, _separator = re.compile(LINE_SYMBOL), re.compile(SHOUT), re.compile(SEPARATOR)
_blank = " \t\n\x0b\x0c\r"
_lower = {c: c + 32 for c in range(65, 91)}

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("n_lost_words", T.LongType()),
    T.StructField("n_lost_lines", T.LongType()), T.StructField("cleaned", T.StringType()),
])
_ARROW = pa.struct([(f.name, {"bigint": pa.int64(), "boolean": pa.bool_(),
                              "string": pa.string()}[f.dataType.simpleString()])
                    for f in FIELDS.fields])


def line_fails(line: str, n_words: int) -> bool:
    """Does the line (which has ``n_words`` words) break one of the line rules?"""
    body = line.strip(_blank)
    if n_words < FRAGMENT_WORDS and not _ended.search(body):
        return True
    if 5 * len(_symbol.findall(body)) > n_words or 10 * len(_shout.findall(body)) > 3 * n_words:
        return True
    separators = len(_separator.findall(body))
    if separators >= 3 and n_words <= 4 * (separators + 1):
        return True
    return n_words <= BOILERPLATE_WORDS and bool(_boilerplate.search(body.translate(_lower)))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered[i:i + 3] = b"\1\1\1"
    return sum(covered)


def judge(text: str | None, max_lost_percent: int = MAX_LOST_PERCENT) -> dict:
    """All figures, the verdict and the cleaned text of one document."""
    whole = text or ""
    words = whole.encode("utf-8", "surrogatepass").split()
    n = len(words)
    seen: set[str] = set()
    dup = lost = lost_lines = 0
    stay = []
    for line in whole.split("\n"):
        k = len(line.encode("utf-8", "surrogatepass").split())
        if k:
            dup += line in seen
            seen.add(line)
            if line_fails(line, k):
                lost += k
                lost_lines += 1
                continue
        stay.append(line)
    repeat = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    return {
        "n_words": n, "word_chars": len(whole) - sum(map(whole.count, _blank)),
        "n_symbols": sum(map(whole.count, SYMBOLS)), "n_dup_lines": dup,
        "n_repeat_words": repeat, "base_failed": failed,
        "kept": not failed and 100 * lost <= max_lost_percent * n, "n_lost_words": lost,
        "n_lost_lines": lost_lines, "cleaned": None if text is None else "\n".join(stay),
    }


def assess(text: Column, max_lost_percent: int = MAX_LOST_PERCENT) -> Column:
    """Struct of :data:`FIELDS` for a text column."""
    return text_column(lambda texts: [judge(t, max_lost_percent) for t in texts],
                       FIELDS, _ARROW)(text)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures and verdict per document (without the cleaned text)."""
    rows = docs.select(F.col(id_col), assess(F.col(text_col)).alias("_quality"))
    return rows.select(id_col, *[F.col(f"_quality.{f.name}").alias(f.name)
                                 for f in FIELDS.fields if f.name != "cleaned"])


def clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The kept documents with failing lines removed; same columns as ``docs``.

    ``chars_col`` (if the table has it) is set to the new length.
    """
    names = docs.columns
    counts = bool(chars_col) and chars_col in names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in text_slices(batch.column(names.index(text_col))):
                part = batch.slice(at, n)
                judged = [judge(t) for t in part.column(names.index(text_col)).to_pylist()]
                stay = [i for i, j in enumerate(judged) if j["kept"]]
                part = part.take(pa.array(stay, pa.int64()))
                cleaned = [judged[i]["cleaned"] for i in stay]
                columns = list(part.columns)
                columns[names.index(text_col)] = pa.array(cleaned, part.schema.field(text_col).type)
                if counts:
                    columns[names.index(chars_col)] = pa.array(
                        [None if t is None else len(t) for t in cleaned],
                        part.schema.field(chars_col).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    # a step of its own: as a column, the verdict and the text would be computed twice
    return docs.mapInArrow(released(run), docs.schema)
