"""Quality rules against a plain restatement of the contract."""

from __future__ import annotations

import re
from collections import Counter

from aerolap.llm import quality as Q
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("The quick brown fox jumps over the lazy dog near the river bank while a calm wind blows "
         "across every one of those wide green fields and far hills. ")


def _base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {j for i, w in enumerate(windows) if times[w] >= 2 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n)


def test_base_figures_of_every_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op8_quality_rules"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == _base(docs[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_odd_texts():
    for t in (None, "", " \n\t", "a a a a", "  x\x1cy", "a\x0bb\x0cc\r\nd", "x\ny\nx\n\n x"):
        j = Q.judge(t)
        assert (j["n_words"], j["word_chars"], j["n_symbols"], j["n_dup_lines"],
                j["n_repeat_words"], j["base_failed"]) == _base(t)
    assert Q.judge(None)["cleaned"] is None and Q.judge("")["cleaned"] == ""


def test_line_rules():
    bad = ["Home | About | News | Contact", "Click here", "Buy now!! Cheap!! Great!! Best!!",
           "word### word$$$ word%%% word&&& word*** word### word word.",
           "All rights reserved.", "We use cookies on this site."]
    for line in bad:
        assert Q.line_fails(line, len(line.split())), line
    for line in (PROSE.strip(), "He said \"yes.\"", "Un été à la mer, où tout le monde dort."):
        assert not Q.line_fails(line, len(line.split())), line


def test_failing_lines_go_and_lossy_documents_are_rejected():
    body = "\n".join(f"{i} {PROSE.strip()}" for i in range(1, 2)) + "\n" + " ".join(
        f"w{i}" for i in range(60)) + "."
    j = Q.judge(body + "\nHome | About | News | Contact")
    assert j["kept"] and j["n_lost_lines"] == 1 and j["cleaned"] == body
    junk = "\n".join(" ".join(f"a{i}x{k}###" for k in range(12)) for i in range(8))
    j = Q.judge(junk)
    assert not j["base_failed"] and not j["kept"]


def test_clean_keeps_columns(spark):
    good = PROSE + " ".join(f"w{i}" for i in range(60)) + "."
    df = spark.createDataFrame(
        [(1, good + "\nAll rights reserved.", "s", 5, "k"), (2, "short", "s", 5, "k"),
         (3, None, None, None, None)],
        "doc_id long, text string, source string, n_chars long, kept string")
    rows = Q.clean(df).collect()
    assert [r.doc_id for r in rows] == [1] and rows[0].text == good
    assert rows[0].n_chars == len(good) and rows[0].kept == "k"
    assert Q.clean(df).columns == df.columns and Q.clean(df.limit(0)).count() == 0
    assert Q.report(df).count() == 3
