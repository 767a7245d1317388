"""Benchmark decontamination against a plain search of every window."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from aerolap.llm import decontamination as D

DOCS = "doc_id long, text string, hits string, n_words string"
ITEMS = "item_id long, text string"


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, n=10):
    windows = set()
    for i, t in items:
        w = _words(t)
        if w:
            windows |= {("null" if i is None else str(i), tuple(w[k:k + n])) for k in range(max(1, len(w) - n + 1))}
    out = []
    for d, t, *_ in docs:
        w, hit, found = _words(t), set(), set()
        for name, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(name)
        names = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _tables(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "é9", "zz", "Ä"]

    def text(n):
        return "".join(rng.choice(vocab) + rng.choice([" ", "-", "\n", "_ ", "\x00"]) for _ in range(n))
    items = [(rng.choice([None, 1, 2, 10, 33]), text(rng.choice([1, 3, 4, 9, 10, 12]))) for _ in range(12)]
    items += [(5, None), (6, ""), (7, "--"), items[0], (8, items[0][1])]
    docs = []
    for _ in range(40):
        t = text(rng.choice([0, 2, 8, 30]))
        if rng.random() < .6:
            t += (rng.choice(items)[1] or "").upper() + text(3)
        docs.append((rng.choice([None, 1, 2, 3]), t, "x", "y"))
    docs += [(4, None, "x", "y"), (4, "", "x", "y"), docs[0], (9, "Q " * 5000 + (items[3][1] or ""), "x", "y")]
    return docs, items


def test_random_tables_in_one_part_and_in_many(spark, monkeypatch):
    docs, items = _tables(5)
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    assert sorted(map(tuple, D.report(d, b).collect()), key=repr) == want
    assert sorted(map(tuple, D.report(d, b, part_bytes=40).collect()), key=repr) == want
    want = brute(docs, items, 3)
    assert sorted(map(tuple, D.report(d, b, n=3).collect()), key=repr) == want


def test_slices_and_colliding_hashes(monkeypatch):
    monkeypatch.setattr(D, "SLICE_BYTES", 7)
    rng = random.Random(2)
    docs, items = _tables(8)
    part = D.Part.of([(str(i), (t or "").encode()) for i, t in items], 10)
    texts = [(t or "").encode() for _, t, *_ in docs]
    whole = part.find(texts)
    assert whole == [h for s in D._slices(texts) for h in part.find(s)]
    assert [h["n_words"] for h in whole] == [len(_words(t)) for _, t, *_ in docs]
    # with one hash for all windows nothing may be built, and what is found is verified
    monkeypatch.setattr(D, "MULTIPLIERS", (0,))
    w = D.Windows.of(2, np.array([[1, 2]], np.int32), np.array([0]))
    at, _ = w.find(np.array([rng.choice([0, 1, 3]) for _ in range(50)] + [9, 2, 1, 2], np.int32))
    assert at.tolist() == [52]


def test_spans_and_documents_are_removed(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Before, {item.upper()}. After", "h", "n"), (2, "clean text", "h", "n"), (3, None, "h", "n"),
            (4, item, "h", "n"), (5, f"{item}; x {item}!", "h", "n")]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item)], ITEMS)
    cut = D.remove_spans(d, b)
    assert cut.columns == d.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {
        1: "Before, . After", 2: "clean text", 3: None, 4: "", 5: "; x !"}
    kept = D.remove_documents(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {2, 3}


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "a b", "", "")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert D.report(d.limit(0), b).collect() == []
    none = D.report(d, b.limit(0)).first()
    assert (none.n_words, none.n_hit, none.n_items, none.contaminated) == (2, 0, 0, False)
