"""Language identification by Bayesian evidence fusion (operator 6).

A page's language is inferred from four pieces of evidence:

* the *text*, by a naive Bayes model over hashed byte trigrams, for every
  language of the documents. It is fitted on about ``fit_rows`` of them, shared
  out evenly among the languages but ``LEAST_ROWS`` for each (by hashes of ids
  and texts; a documented bound; rarer languages are taken whole). Overlapping trigrams depend on
  each other, so the log-likelihood is tempered, and a small chance of foreign
  text (quotations, advertisements) bounds what it can say;
* the language *declared* in the markup, and
* the address *suffix*, whose likelihoods given a language are estimated from
  all pages by grouped aggregation of the text posteriors;
* a prior of the *host*, smoothed towards its domain's, which is smoothed
  towards that of all pages; a page's own vote is taken out of it.

The posterior is their product, normalised. Sums over hosts, domains, suffixes
and declarations are aggregated before they move; a page travels to them as
its id and a vector with one number per language, never as text. The model of
the text is sparse: only trigrams that a language's sample has take space.

Defined results: a page whose html is null or has no text gives no text
evidence; a null address gives no suffix and no host evidence; a missing
declaration gives none. With no evidence at all the prior of all pages
decides. Equal posteriors go to the first language by name. Repeated rows get
equal results; a null page id is carried; an empty table gives an empty
result; further columns are not read. Very long pages are read whole.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import discard, written

FIT_ROWS = 4000
LEAST_ROWS = 64
FEATURES = 1 << 16
TEMPER = 1 / 3
#: Chance that what is read of a page is not in its language: bounds the text's evidence.
FOREIGN = 1e-3
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 5.0
_PART = 1 << 20

_gone = re.compile(r"(?is)<(script|style|nav|footer|noscript|template)\b.*?</\1\s*>|<!--.*?-->"
                   r"|<(div|aside)\b[^>]*\bclass=[\"']?(?:ad|ads|banner|promo|cookies?)\b.*?</\2\s*>")
_tag = re.compile(r"(?s)<[^>]*>")


def visible(page: str | None) -> str:
    """Text of a page without scripts, styles, navigation, advertisements, comments, tags."""
    return _html.unescape(_tag.sub(" ", _gone.sub(" ", page or "")))


def counts(text: str) -> np.ndarray:
    """Hashed byte-trigram counts of a text (lower case)."""
    out = np.zeros(FEATURES, np.int64)
    raw = text.lower().encode("utf-8", "surrogatepass")
    for at in range(0, max(1, len(raw)), _PART):
        b = np.frombuffer(b" " + raw[max(0, at - 2):at + _PART] + b" ", np.uint8).astype(np.uint32)
        h = (b[:-2] * 40503 + b[1:-1] * 30011 * 7 + b[2:] * 2654435) * np.uint32(2654435761)
        out += np.bincount(h >> np.uint32(16), minlength=FEATURES)
    return out


def _count_by_language(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if text.is_valid:
                if lang not in total:
                    total[lang] = np.zeros(FEATURES, np.int64)
                total[lang] += counts(text.as_py())
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])],
            ["lang", "feature", "n"])


class TextModel:
    """log P(feature | language), as what differs from an unseen feature's, by feature."""

    def __init__(self, lang: np.ndarray, feature: np.ndarray, n: np.ndarray, k: int):
        total = np.bincount(lang, weights=n, minlength=k) + 0.5 * FEATURES
        order = np.argsort(feature, kind="stable")
        self.lang = lang[order].astype(np.int32)
        self.more = np.log1p(n[order] / 0.5).astype(np.float32)
        self.first = np.searchsorted(feature[order], np.arange(FEATURES + 1))
        self.unseen, self.k = np.log(0.5 / total), k

    def log_likelihood(self, n: np.ndarray) -> np.ndarray:
        """Per language, of a text with these :func:`counts`."""
        found = np.flatnonzero(n)
        first = self.first[found]
        each = self.first[found + 1] - first
        at = np.repeat(first - (np.cumsum(each) - each), each) + np.arange(each.sum())
        seen = np.bincount(self.lang[at], weights=self.more[at] * np.repeat(n[found], each),
                           minlength=self.k)
        return seen + self.unseen * n.sum()


def fit_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> tuple[list[str], TextModel | None]:
    """All languages, by name, and the model of their texts."""
    known = docs.select(F.col(id_col).alias("_key"), F.col(lang_col).alias("_lang"),
                        F.col(text_col).alias("_text")).dropna()
    sizes = known.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")).collect()
    names = sorted(r["_lang"] for r in sizes)
    if not names:
        return [], None
    rows = max(LEAST_ROWS, -(-fit_rows // len(names)))
    shares = docs.sparkSession.createDataFrame(
        [(r["_lang"], min(1.0, rows / r["_n"])) for r in sizes], "_name string, _share double")
    place = F.pmod(F.xxhash64("_key", "_text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sums = (known.join(F.broadcast(shares), F.col("_lang") == F.col("_name"))
            .where(place < F.col("_share")).select("_lang", "_text")
            .mapInArrow(_count_by_language, "lang string, feature int, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow())
    lang = pc.index_in(sums["lang"], pa.array(names, sums["lang"].type))
    return names, TextModel(lang.to_numpy(), sums["feature"].to_numpy(),
                            sums["n"].to_numpy(), len(names))


def _address(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?"
                                                  r"([^/:?#]+)", 1)), F.lit(""))


def _declared(page: Column) -> Column:
    found = F.regexp_extract(page, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)
    return F.nullif(F.lower(found), F.lit(""))


def _sums(df: DataFrame, by: list[str], out: str) -> DataFrame:
    """Summed votes per group, as one array column; one row per language until the end."""
    parts = (df.select(*by, F.posexplode("vote").alias("_at", "_v"))
             .groupBy(*by, "_at").agg(F.sum("_v").alias("_v")))
    return parts.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "_at", "_v"))), lambda x: x["_v"]).alias(out))


def _likelihood(votes: DataFrame, key: str, totals: list[float], out: str) -> DataFrame:
    """log P(value | language) per value of ``key``, with one smoothing vote per value."""
    total = F.array(*[F.lit(float(t)) for t in totals])
    return votes.select(F.col(key).alias(f"_{key}"), F.zip_with(
        "votes", total, lambda v, t: F.log((v + 0.01) / (t + 1.0))).alias(out))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html", temper: float = TEMPER, fit_rows: int = FIT_ROWS
             ) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host; one row per page."""
    spark = pages.sparkSession
    names, model = fit_text(docs, fit_rows=fit_rows)
    if not names:
        return pages.select(F.col(id_col).alias("page_id"), F.lit(None).cast("string").alias("lang"),
                            F.lit(None).cast("double").alias("probability"),
                            F.lit(None).cast("string").alias("text_lang"),
                            _declared(F.col(html_col)).alias("declared"),
                            _address(F.col(url_col)).alias("host"))
    k, shared = len(names), spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def text_log_likelihood(html: pa.Array) -> pa.Array:
        out = []
        for page in html:
            text = visible(page.as_py()).strip()
            score = shared.value.log_likelihood(counts(text)) * temper if text else np.zeros(k)
            share = np.exp((score - score.max()).astype(float))
            out.append(np.log((1 - FOREIGN) * share / share.sum() + FOREIGN / k).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    labels = F.array(*[F.lit(n) for n in names])
    read, read_path = written(pages.select(
        F.col(id_col).alias("page_id"), _address(F.col(url_col)).alias("host"),
        _declared(F.col(html_col)).alias("declared"),
        text_log_likelihood(F.col(html_col)).alias("text")), "langid_read")
    weight = F.transform("text", lambda x: F.exp(x))
    labelled = F.split("host", r"\.")
    rows, rows_path = written(
        read.withColumn("_w", weight)
        .withColumn("vote", F.transform("_w", lambda w: w / F.aggregate(
            "_w", F.lit(0.0), lambda a, b: a + b))).drop("_w")
        .withColumn("suffix", F.element_at(labelled, -1))
        .withColumn("domain", F.array_join(F.slice(labelled, F.greatest(
            F.lit(1), F.size(labelled) - 1), 2), ".")), "langid_rows")
    discard(spark, read_path)

    votes = dict(rows.select(F.posexplode("vote").alias("_at", "_v")).groupBy("_at")
                 .agg(F.sum("_v")).collect())
    totals = [votes.get(i, 0.0) for i in range(k)]
    prior = F.array(*[F.lit((t + 1.0) / (sum(totals) + k)) for t in totals])
    declared, d_path = written(_likelihood(_sums(rows.where("declared IS NOT NULL"), ["declared"],
                                                 "votes"), "declared", totals, "ll_declared"),
                               "langid_declared")
    suffix, s_path = written(_likelihood(_sums(rows.where("suffix IS NOT NULL"), ["suffix"],
                                               "votes"), "suffix", totals, "ll_suffix"),
                             "langid_suffix")
    hosts = _sums(rows.where("host IS NOT NULL"), ["host", "domain"], "host_votes")
    domains = _sums(rows.where("host IS NOT NULL"), ["domain"], "domain_votes")
    hosts, h_path = written(hosts.join(domains, "domain").select(
        F.col("host").alias("_host"), "host_votes", "domain_votes"), "langid_hosts")

    joined = (rows.join(declared, F.col("declared") == F.col("_declared"), "left")
              .join(suffix, F.col("suffix") == F.col("_suffix"), "left")
              .join(hosts, F.col("host") == F.col("_host"), "left"))

    def smoothed(votes: Column, parent: Column, weight: float) -> Column:
        """Shares of the group without this page, towards the parent's shares."""
        rest = F.zip_with(votes, F.col("vote"), lambda v, own: F.greatest(v - own, F.lit(0.0)))
        n = F.aggregate(rest, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(rest, parent, lambda v, p: (v + weight * p) / (n + weight))

    zero = F.array(*[F.lit(0.0)] * k)
    both = joined.withColumn("_domain_prior", F.coalesce(
        smoothed(F.col("domain_votes"), prior, DOMAIN_WEIGHT), prior))
    both = both.withColumn("_prior", F.coalesce(
        smoothed(F.col("host_votes"), F.col("_domain_prior"), HOST_WEIGHT), prior))

    def plus(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    both = both.withColumn("_log", plus(
        plus("text", F.coalesce("ll_declared", zero)),
        plus(F.coalesce("ll_suffix", zero), F.transform("_prior", lambda x: F.log(x)))))
    top = F.array_max("_log")
    # the first of the largest values: names are sorted
    place = F.array_position("_log", top).cast("int")
    text_place = F.array_position("text", F.array_max("text")).cast("int")
    mass = F.aggregate(F.transform("_log", lambda x: F.exp(x - top)), F.lit(0.0),
                       lambda a, b: a + b)
    return both.select("page_id", F.element_at(labels, place).alias("lang"),
                       (1 / mass).alias("probability"),
                       F.element_at(labels, text_place).alias("text_lang"), "declared", "host")
