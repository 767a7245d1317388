"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from aerolap.llm import bpe, mixing, quality
from aerolap.llm.catalog import vocabulary
from aerolap.llm.common import table, written
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard import brute


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard", "source_mix",
                                        "byte_bpe"]

    first, _ = written(stages["quality_rules"](spark, docs, SF_SMALL), "t")
    judged = {r.doc_id: quality.judge(r.text) for r in docs.collect()}
    assert {r.doc_id: r.text for r in first.collect()} == {
        i: j["cleaned"] for i, j in judged.items() if j["kept"]}
    assert first.columns == docs.columns

    second, _ = written(stages["toxicity"](spark, first, SF_SMALL), "t")
    assert second.columns == docs.columns and second.exceptAll(first).count() == 0
    labels = {r.doc_id: r.toxic for r in table(spark, SF_SMALL, "labels").collect()}
    kept = {r.doc_id for r in second.collect()}
    clean = [r.doc_id for r in first.collect() if labels.get(r.doc_id) == 0]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)

    third, _ = written(stages["ngram_jaccard"](spark, second, SF_SMALL), "t")
    want = brute([(r.doc_id, r.text) for r in second.collect()], 5, 80)
    assert {r.doc_id for r in third.collect()} == {i for i, v in want.items() if v[1] == i}
    assert third.columns == docs.columns

    fourth, _ = written(stages["source_mix"](spark, third, SF_SMALL), "t")
    plan = {r.doc_id: r.copies for r in mixing.plan(third).collect() if r.copies}
    assert Counter(r.doc_id for r in fourth.collect()) == Counter(plan)
    assert fourth.columns == docs.columns

    last = stages["byte_bpe"](spark, fourth, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in fourth.collect()}
    v = vocabulary(spark).bpe()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks,
                                special_tokens={})
    for r in last:
        ids = bpe.token_ids(r.ids)
        assert r.n_tokens == len(ids) and v.decode(r.ids) == texts[r.doc_id].encode()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert ids == library.encode_ordinary(texts[r.doc_id])
    assert Counter(r.doc_id for r in last) == Counter(plan)


def test_run_and_empty_input(spark):
    assert P.run(spark, SF_SMALL).count() > 0
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for name, stage in P.STAGES:
        docs, _ = written(stage(spark, docs, SF_SMALL), "t_empty")
        assert docs.count() == 0, name
