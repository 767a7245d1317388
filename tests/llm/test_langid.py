"""Language identification on pages of known language."""

from __future__ import annotations

import random
import re
import string

from aerolap.llm import langid as L
from aerolap.llm.catalog import QUERIES
from tests.conftest import SF_MID, SF_SMALL


def test_query_agrees_with_the_known_language(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    rows = QUERIES["op6_page_language"](spark, SF_MID).collect()
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        known = re.search(r"://[^/]+/(\w\w)/", pages[r.page_id].url)[1]
        right += r.lang == known
        assert 0 < r.probability <= 1 + 1e-9
    assert right >= 0.98 * len(rows)


def test_each_evidence_decides_when_the_others_are_silent(spark):
    docs = spark.createDataFrame(
        [(i, t, lang, "x") for i, (t, lang) in enumerate(
            [("the cat and the dog with that", "en"), ("der Hund und die Katze ist nicht", "de")] * 20)],
        "doc_id long, text string, lang string, host string")
    en, de = "the dog and that cat with the", "die Katze und der Hund ist das nicht"

    def page(i, host, text, lang=None):
        tag = f'<html lang="{lang}">' if lang else "<html>"
        return (i, f"http://{host}/x", f"{tag}<script>der die das</script><p>{text}</p></html>", "k")

    pages = [page(i, "a.b.com", en, "en") for i in range(30)]
    pages += [page(100 + i, "c.d.de", de, "de-AT") for i in range(30)]
    pages += [page(200, "x.y.org", "", "de"),      # declaration only
              page(201, "q.r.de", ""),             # suffix only
              page(202, "a.b.com", ""),            # host only
              page(203, "z.y.net", de),            # text only
              (204, None, None, None), (None, "nonsense", "", "k"), (204, None, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, lang string")
    rows = L.identify(df, docs).collect()
    assert len(rows) == len(pages)
    got = {r.page_id: r.lang for r in rows}
    assert [got[i] for i in (200, 201, 202, 203)] == ["de", "de", "en", "de"]
    assert all(got[i] == "en" for i in range(30)) and all(got[100 + i] == "de" for i in range(30))
    assert got[204] in ("de", "en") and None in got
    assert L.identify(df.limit(0), docs).count() == 0
    assert {r.lang for r in L.identify(df, docs.limit(0)).collect()} == {None}


def test_visible_text():
    page = "<p>a &amp; b</p><nav>menu</nav><!-- c --><div class=\"ad\">buy</div><style>x</style>d"
    assert L.visible(page).split() == ["a", "&", "b", "d"] and L.visible(None) == ""
    assert L.counts("").sum() == 0 or L.counts("").sum() <= 1
    assert L.counts("abc").sum() == 3
    long = "abcdef" * (L._PART // 3)
    assert abs(int(L.counts(long).sum()) - len(long)) <= 16


def test_small_table(spark):
    assert QUERIES["op6_page_language"](spark, SF_SMALL).count() == spark.read.parquet(
        f"{SF_SMALL}/pages.parquet").count()


def test_rare_languages_and_more_than_64(spark):
    def text(lang):
        rng = random.Random(lang)
        return " ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(20))

    docs = [(i, text(0), "l00") for i in range(9000)]
    docs += [(10000 + i, text(i), f"l{i:02}") for i in range(1, 70)]  # one document each
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    names, _ = L.fit_text(docs)
    assert names == [f"l{i:02}" for i in range(70)]
    pages = spark.createDataFrame(
        [(i, f"http://h{i}.net/x", f"<p>{text(i)}</p>") for i in range(70)],
        "page_id long, url string, html string")
    assert {r.page_id: r.lang for r in L.identify(pages, docs).collect()} == {
        i: f"l{i:02}" for i in range(70)}
