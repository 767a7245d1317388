"""Byte-level BPE: equal to the public library, and lossless."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from aerolap.llm import bpe
from aerolap.llm.catalog import QUERIES, VOCABULARY, vocabulary
from tests.conftest import SF_SMALL

ALPHABET = list("aaabbe  \t\n\x0b\x1c\x85  éßñ漢字🙂'sd123٣²½!?.,_́‍")


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f.read().splitlines())}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def own(ranks):
    return bpe.Bpe(ranks, public_tokenizers.PATTERN)


def _texts(n=1200):
    rng = random.Random(7)
    yield from ["", " ", "  a", "a ", "a  b", "\n \n", "<|endoftext|>", "x" * 5000, " " * 3000,
                "ab" * 4000, "é" * 2000]
    for k in range(n):
        size = rng.choice([1, 5, 30, 200])
        yield "".join(rng.choice(ALPHABET if k % 2 else "abcdeinst ,.") for _ in range(size))


def test_equal_to_the_library_and_lossless(own, library):
    for t in _texts():
        packed = own.encode(t)
        assert bpe.token_ids(packed) == library.encode_ordinary(t), repr(t[:80])
        assert own.decode(packed) == t.encode()


def test_tree_equals_direct_merging_and_is_associative(own):
    rng = random.Random(3)
    for _ in range(150):
        b = bytes(rng.choice(b"abcdeinst \xc3\xa9") for _ in range(rng.choice([50, 97, 300, 900])))
        whole = own.merge(b)
        assert own.reduce(b) == whole
        i, j = sorted(rng.sample(range(1, len(b)), 2))
        x, y, z = own.merge(b[:i]), own.merge(b[i:j]), own.merge(b[j:])
        assert own.join(own.join(x, y), z) == own.join(x, own.join(y, z)) == whole


def test_long_merge_equals_short_merge(own):
    rng = random.Random(5)
    for _ in range(100):
        b = bytes(rng.choice(b"aabcdeinst ") for _ in range(90))
        assert own._merge_long(b) == own.merge(b)


def test_batches_equal_single_texts(own, library):
    texts = [*_texts(), None, "one  two", "a\nb c.\nd", "\n\n", "x.\n\ny", "tab\tx y", "q\u00a0 z"]
    rng = random.Random(9)
    texts += [" ".join("".join(rng.choice("abcdeéinstß.,!") for _ in range(rng.randint(1, 40)))
                       for _ in range(50)) for _ in range(60)]
    for size in (1, 7, len(texts)):
        got = [x.as_py() for i in range(0, len(texts), size)
               for x in own.encode_batch(pa.array(texts[i:i + size], pa.string()))]
        assert [bpe.token_ids(x) for x in got] == [library.encode_ordinary(t or "") for t in texts]
    assert own.encode_batch(pa.array([], pa.string())).to_pylist() == []
    sliced = pa.array(texts, pa.string()).slice(5, 20)
    assert own.encode_batch(sliced).to_pylist() == [own.encode(t) for t in texts[5:25]]


def test_batches_are_cut_by_size(own, monkeypatch):
    texts = [f"word{i} and more of them" for i in range(40)] + ["", "z " * 500]
    monkeypatch.setattr(bpe, "_BATCH", 100)
    assert own.encode_batch(pa.array(texts)).to_pylist() == [own.encode(t) for t in texts]


def test_many_merges_equal_single_merges(own):
    rng = random.Random(11)
    strings = [bytes(rng.choice(b"aabcdeinst \xc3\xa9") for _ in range(rng.randint(0, 30)))
               for _ in range(800)]
    got = own.merge_many(pa.array(strings, pa.large_binary())).to_pylist()
    assert [bpe.token_ids(x) for x in got] == [own.merge(b) for b in strings]


def test_matrix_tree_equals_single_merges(own):
    rng = random.Random(13)
    strings = [bytes(rng.choice(b"aabcdeinst \xc3\xa9") for _ in range(rng.randint(0, 32)))
               for _ in range(3000)]
    strings += [b"", b"a" * 32, b" " * 31, b"\xff" * 30, b" internationalization", b"ababab" * 5]
    before = own.joins
    got = own.reduce_many(pa.array(strings, pa.large_binary())).to_pylist()
    assert [bpe.token_ids(x) for x in got] == [own.merge(b) for b in strings]
    assert own.joins - before == sum(max(0, -(-len(b) // bpe.LEAF) - 1) for b in strings)
    assert own.reduce_many(pa.array([], pa.large_binary())).to_pylist() == []


def test_ordinary_text_goes_through_the_tree(own, library, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    before = own.joins
    got = own.encode_batch(pa.array(texts, pa.string())).to_pylist()
    assert [bpe.token_ids(x) for x in got] == [library.encode_ordinary(t or "") for t in texts]
    assert own.joins - before > 1000


def test_few_remembered_pairs_change_nothing(ranks, own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 3)
    small, texts = bpe.Bpe(ranks, public_tokenizers.PATTERN), [*_texts(200)]
    assert (small.encode_batch(pa.array(texts)).to_pylist()
            == own.encode_batch(pa.array(texts)).to_pylist())


def test_decoding_up_the_tree(own):
    text = "many words and 123 more, " * 3000
    assert own.decode(own.encode(text)) == text.encode() and own.decode(None) == b""


def test_query_against_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_nulls_clashing_names_and_empty_table(spark):
    v = vocabulary(spark)
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a b", "z")],
                               "doc_id long, text string, ids string")
    got = bpe.encode_documents(df, v)
    assert got.columns == ["doc_id", "ids"]
    assert sorted(len(r.ids) for r in got.collect()) == [0, 0, 8]
    back = got.select(bpe.decode(F.col("ids"), v).alias("b")).collect()
    assert sorted(bytes(r.b) for r in back) == [b"", b"", b"a b"]
    assert bpe.encode_documents(df.limit(0), v).count() == 0


def test_equal_parts_of_matches_are_merged_and_joined_once(own, monkeypatch):
    joined, merged, join, merge = [], [], own._join_rows, own._merge_rows
    monkeypatch.setattr(own, "_join_rows", lambda raw, *a: joined.append(len(raw)) or join(raw, *a))
    monkeypatch.setattr(own, "_merge_rows", lambda raw, n: merged.append(len(raw)) or merge(raw, n))
    words = [f"reintern{x}" for x in "abcdefghijklmnopqrstuvwxyz"] + ["reintern", "rein", "rein\0", "rein\0\0"]
    got = own.reduce_many(pa.array(words, pa.large_string())).to_pylist()
    assert [bpe.token_ids(b) for b in got] == [own.merge(w.encode()) for w in words]
    # leaves: rein, tern, \0, \0\0, nothing and 26 letters; joined: reintern, rein with two, one or no \0
    assert merged[0] == 31 and joined[0] == 4 + 26 + 1


def test_matches_of_earlier_batches_are_not_encoded_again(ranks, library, monkeypatch):
    fresh, made = bpe.Bpe(ranks, public_tokenizers.PATTERN), []
    reduce = fresh.reduce_many
    monkeypatch.setattr(fresh, "reduce_many", lambda x: made.extend(x.to_pylist()) or reduce(x))
    texts = ["reinterned words, and more words", None, "a\0 a\0\0 a  odd\tspace", "word " * 30]
    for more in ([], [], ["reinterned anew"]):
        made.clear()
        got = fresh.encode_batch(pa.array(texts + more, pa.string())).to_pylist()
        assert [bpe.token_ids(x) for x in got] == [library.encode_ordinary(t or "") for t in texts + more]
        if more:
            assert made == [" anew"]
    assert fresh.encode_batch(pa.array(texts)).to_pylist() == got[:-1] and made == [" anew"]


@pytest.mark.parametrize("places", [1, 5])
def test_displaced_matches_and_nodes_change_nothing(ranks, library, monkeypatch, places):
    for name in ("REMEMBERED_MATCHES", "REMEMBERED_NODES", "REMEMBERED_PAIRS"):
        monkeypatch.setattr(bpe, name, places)
    small, texts = bpe.Bpe(ranks, public_tokenizers.PATTERN), [*_texts(150), "a\0b", "a", "a\0"]
    for at in (0, 60, 0):
        got = small.encode_batch(pa.array(texts[at:], pa.string())).to_pylist()
        assert [bpe.token_ids(x) for x in got] == [library.encode_ordinary(t) for t in texts[at:]]


def test_forgotten_tables_take_no_memory_and_change_nothing(ranks, library):
    fresh, texts = bpe.Bpe(ranks, public_tokenizers.PATTERN), [*_texts(20)]
    for _ in range(2):
        got = fresh.encode_batch(pa.array(texts, pa.string())).to_pylist()
        assert [bpe.token_ids(x) for x in got] == [library.encode_ordinary(t) for t in texts]
        held = [t for seen in (fresh._matches, fresh._nodes)
                for t in (seen._rows, seen._tokens, seen._length)]
        assert sum(t.nbytes for t in held) < 40 << 20
        fresh.forget()
        assert all(t is None for seen in (fresh._matches, fresh._nodes)
                   for t in (seen._rows, seen._tokens, seen._length))


def test_encoding_task_leaves_no_tables_to_its_process(spark, monkeypatch):
    tasks = []
    monkeypatch.setattr(bpe, "released", lambda run: tasks.append(run) or run)
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    known = vocabulary(spark)
    bpe.encode_documents(docs, known)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words"])], ["doc_id", "text"])
    rows = tasks[0](iter([batch]))
    assert next(rows).num_rows == 1 and known.bpe()._matches._rows is not None
    assert list(rows) == [] and known.bpe()._matches._rows is None


def test_rows_with_equal_places_are_told_apart():
    seen = bpe._Seen(2, 1)
    rows = bpe._wide_rows(np.array([[97, 0], [97, 0], [98, 9]], np.uint8), np.array([1, 2, 1]), 8)
    assert rows.tolist() == [[97, 1], [97, 2], [98, 1]]
    seen.put(rows[1:2], np.arange(8)[None], np.array([2]))
    known, tokens, length = seen.get(rows)
    assert known.tolist() == [False, True, False]
    assert (tokens[1].tolist(), length[1]) == ([*range(8)], 2)
