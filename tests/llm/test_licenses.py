"""License scan against a plain Dice coefficient over every template."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from aerolap.llm import licenses as L
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_MID


def _pairs(text):
    words = re.sub(r"[^\w]|_", " ", text.lower()).split()
    return set(zip(words, words[1:]))


def _brute(text, threshold=L.THRESHOLD):
    lines = (text or "").split("\n") if text is not None else []
    paragraphs = re.split(r"\n[ \t\n\v\f\r]*\n", text or "")
    units = lines + (paragraphs if len(paragraphs) > 1 else []) + ([text] if len(lines) > 1 else [])
    best, matched = None, 0
    for at, u in enumerate(units):
        a = _pairs(u)
        scores = [(2 * len(a & b) / (len(a) + len(b)), -at, -i) for i, b in
                  enumerate(_pairs(t) for _, t in L.TEMPLATES) if a]
        if scores and max(scores)[0] >= threshold:
            matched += 1
            best = max(best or scores[0], max(scores))
    if not matched:
        return None, None, None, 0
    return L.TEMPLATES[-best[2]][0], best[0], -best[1], matched


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = QUERIES["op2_license_scan"](spark, SF_MID).collect()
    assert len(rows) == len(docs) and sum(r.license is not None for r in rows) > 20
    for r in rows:
        assert (r.license, r.dice, r.unit_no, r.n_matches) == _brute(docs[r.doc_id]), r.doc_id


def test_variants_and_odd_texts(spark):
    texts = [None, "", "word", "Released under the MIT licence!", "released UNDER the mit license",
             "All rights reserved. 2024", "nothing of the kind is here at all",
             "intro\n\nLicensed under the Apache License,\nVersion 2.0.\n\nend of it",
             "x\n" + L.TEMPLATES[1][1] + "\n" + L.TEMPLATES[5][1], "q " * 30000]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)],
                               "doc_id long, text string, license string")
    rows = {r.doc_id: (r.license, r.dice, r.unit_no, r.n_matches) for r in L.scan(df).collect()}
    assert rows == {i: _brute(t) for i, t in enumerate(texts)}
    assert rows[7][0] == "Apache-2.0"
    assert L.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.scan(df, templates=[])


def test_plan_is_native(spark):
    plan = QUERIES["op2_license_scan"](spark, SF_MID)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_texts_without_a_template_are_not_cut_into_units(spark, monkeypatch):
    texts = [None, "", "\n \n", "all the rights\nthat are reserved\n\nunder the license", "word " * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(L, "units", lambda text: F.array(
        F.raise_error(F.concat(F.lit("cut: "), text)).cast("string")))
    assert {tuple(r)[1:] for r in L.scan(df).collect()} == {(None, None, None, 0)}
    df = spark.createDataFrame([(1, "!all rights\nreserved\n")], "doc_id long, text string")
    with pytest.raises(Exception, match="cut: !all rights"):
        L.scan(df).collect()


def test_notices_among_other_words(spark):
    code = "int main() {\n  return 0;\n}"
    filler = " ".join(f"w{i}" for i in range(3000))
    gpl = L.TEMPLATES[5][1]
    wrapped = gpl.replace(" under the terms", "\nunder the terms").replace(" Foundation", "\nFoundation")
    texts = {"Copyright 2020 The Authors. All rights reserved.": ("Proprietary", 1.0, 0, 1),
             "Copyright (c) 2021 Jane Doe. Released under the MIT License. See LICENSE for details.":
                 ("MIT", 1.0, 0, 1),
             f"{code}\n{wrapped}\n{code} {filler}": ("GPL-3.0", 1.0, 3, 1),
             "This work is licensed under the GNU General Public License, version 2.":
                 ("GPL-2.0", 1.0, 0, 1),
             "This work is licensed under the GNU Affero General Public License, version 3.":
                 ("AGPL-3.0", 1.0, 0, 1),
             "we ship it here, all rights reserved, and the rest of it "
             "is released under the ISC license today": ("Proprietary", 1.0, 0, 2),
             "we ship it here, it is released under the ISC license today": ("ISC", 1.0, 0, 1),
             "first words of it\nReleased under the MIT License.\nand then Licensed under CC BY 4.0 it is":
                 ("MIT", 1.0, 1, 2),
             "all the rights that are reserved under the license of the house": (None, None, None, 0)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.license, r.dice, r.unit_no, r.n_matches) for r in L.scan(df).collect()}
    assert rows == dict(enumerate(texts.values()))
