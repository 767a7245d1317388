"""Merkle manifest against a plain-Python tree, and odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib

from aerolap.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _climb(nodes):
    """The last node, and for each leaf the siblings on its way as (before, after) per level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            run = nodes[i - i % 3:i - i % 3 + 3]
            way.append((run[:i % 3], run[i % 3 + 1:]))
        nodes = [_h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], ways


def brute(rows):
    """Sorted result rows, from the definition."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = []
    for s in sources:
        mine = [(r, _h(*map(_field, r[:5]))) for r in rows if r[1] == s]
        mine.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        per.append((mine, *_climb([leaf for _, leaf in mine])))
    root, top = _climb([p[1] for p in per])
    out = []
    for (mine, subroot, ways), above in zip(per, top, strict=True):
        for (r, leaf), way in zip(mine, ways, strict=True):
            fold = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                fold = _h(*map(_field, (*r[:4], r[4].replace("\n", ""))))
            proof = []
            for before, after in way + above:
                fold = _h(*before, fold, *after)
                proof += before + after
            out.append((r[0], leaf, subroot, root, _h(*proof), fold, fold == root, len(proof)))
    return sorted(out, key=repr)


def check(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert sorted(map(tuple, M.manifest(df).collect()), key=repr) == brute(rows)


def test_random_tables_with_nulls_ties_and_repeated_rows(spark):
    rng = random.Random(3)
    text = [None, "", "a\nb", "x", "é\n\n", "long " * 3000]
    rows = [(rng.choice([None, *range(-3, 60)]), rng.choice(["hot", "hot", "b", "é", None]),
             rng.choice([None, "en"]), rng.choice([None, 7]), rng.choice(text), "clash", 1)
            for _ in range(130)]
    rows += [(5, "hot", "en", 1, "same\nrow", "z", 0)] * 40 + [(9, "lone", None, None, "a\nb", None, None)]
    check(spark, rows)


def test_one_source_and_one_row(spark):
    check(spark, [(i, "s", "en", i, "t\n", "", 0) for i in range(10)])
    check(spark, [(4, None, None, None, None, "", 0)])
    check(spark, [(i, f"s{i}", "en", i, "t\n", "", 0) for i in range(10)])


def test_empty_table(spark):
    assert M.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_altered_text_is_found(spark):
    rows = [(i, "ab"[i % 2], "en", 3, "a\nb" if i % 3 else "ab", "", 0) for i in range(80)]
    got = {r.doc_id: r.verified for r in M.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {r[0]: "\n" not in r[4] or zlib.crc32(str(r[0]).encode()) % 2 == 1 for r in rows}
    assert got == want
    intact = M.manifest(spark.createDataFrame(rows, SCHEMA), tamper=M.F.lit(False))
    assert intact.where("verified").count() == len(rows)


def test_small_levels_take_one_task_and_one_file(spark, monkeypatch):
    files, write = {}, M.written

    def counted(df, name):
        out, path = write(df, name)
        files[name] = len(out.inputFiles())
        return out, path

    monkeypatch.setattr(M, "written", counted)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        check(spark, [(i, f"s{i % 3}", "en", i, "a\nb", "", 0) for i in range(200)])
        few = {k: n for k, n in files.items()
               if k.startswith("merkle_level") or k in ("merkle_packs", "merkle_high")}
        assert len(few) >= 6 and set(few.values()) == {1}
        # nor does it change the result where levels are dealt
        monkeypatch.setattr(M, "SMALL", 20)
        monkeypatch.setattr(M, "FILE_ROWS", 30)
        check(spark, [(i, f"s{i % 3}", "en", i, "a\nb", "", 0) for i in range(200)])
        assert files["merkle_packs"] > 1
    finally:
        spark.conf.set(key, before)
