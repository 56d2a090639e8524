"""Corpus filters: documents by quality and perplexity, pages by content, page ids by shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks.functions.text import UNKNOWN

PERCENTILE = 0.8
MIN_PAGE_SCORE = 0.5


def _number(c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c))


def perplexity_thresholds(docs: DataFrame, lang: str = "top_lang", value: str = "perplexity", q: float = PERCENTILE) -> DataFrame:
    """The exact percentile of each language, interpolated linearly."""
    return docs.groupBy(lang).agg(F.percentile(_number(value), F.lit(q)).alias("threshold"))


def perplexity_bucket(value: Column, threshold: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string")).when(value > threshold, "high").otherwise("low-mid")


def judge_documents(docs: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Documents with ``blacklisted``. Median and percentiles are of all documents, before anything is excluded.

    The median is one row and the thresholds one a language, so both meet the documents without a shuffle of them.
    """
    median = docs.agg(F.median(_number("quality")).alias("_median"))
    limits = perplexity_thresholds(docs).withColumnRenamed("threshold", "_threshold").withColumnRenamed("top_lang", "_lang")
    d = docs.crossJoin(F.broadcast(median)).join(limits, F.col("top_lang").eqNullSafe(F.col("_lang")), "left")
    ppl = _number("perplexity")
    out = F.coalesce(_number("quality") < F.col("_median"), F.lit(False)) | ppl.isNull() | F.coalesce(ppl > F.col("_threshold"), F.lit(False)) | F.coalesce(F.col("top_lang") == UNKNOWN, F.lit(False))
    if excluded:
        out = out | F.coalesce(F.col("top_lang").isin(*excluded), F.lit(False))
    return d.withColumn("bucket", perplexity_bucket(F.col("perplexity"), F.col("_threshold"))).withColumn("blacklisted", out).drop("_median", "_threshold", "_lang")


def row_sum(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def filter_pages(pages: DataFrame, docs: DataFrame, strict_headings: bool = False, key: str = "url_hash", min_score: float = MIN_PAGE_SCORE) -> DataFrame:
    """Pages that stay: not of a blacklisted document, with words, with entities, (strict: not only headings), sure of their
    language."""
    counts = [c for c in pages.columns if c.startswith("num_")]
    headings = [c for c in counts if c.startswith("num_heading")]
    others = [c for c in counts if c not in headings]
    bad = docs.where("blacklisted").select(key).distinct()
    p = pages.join(bad, key, "left_anti").where("pdf_word_count > 0").where(row_sum(counts) > 0)
    if strict_headings:
        p = p.where(~((row_sum(headings) > 0) & (row_sum(others) == 0)))
    return p.where(F.col("top_lang_score") > min_score)


def pages_by_shard(pages: DataFrame, shard: str = "annotated_shard_id") -> DataFrame:
    return pages.groupBy(shard).agg(F.array_sort(F.collect_list("page_id")).alias("page_ids"))


def complete_pages(members: DataFrame, page: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Pages that have every kind of member."""
    return members.where(F.col(kind).isin(*kinds)).groupBy(page).agg(F.count_distinct(kind).alias("_n")).where(F.col("_n") == len(set(kinds))).select(page)


def filter_members(members: DataFrame, whitelist: DataFrame, page: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Members of whitelisted, complete pages."""
    return members.join(complete_pages(members, page, kind, kinds), page, "left_semi").join(whitelist.select(page), page, "left_semi")


def checksums(members: DataFrame, ids: DataFrame, key: str = "url_hash", content: str = "content") -> DataFrame:
    return members.join(ids.select(key).distinct(), key, "left_semi").select(key, F.sha2(F.col(content), 256).alias("bytehash"))


def page_documents(pages: DataFrame, docs: DataFrame, key: str = "url_hash") -> DataFrame:
    """Pages with their document's columns; pages without a document go."""
    keep = [c for c in docs.columns if c == key or c not in pages.columns]
    return pages.join(docs.select(*keep), key)


def fill_sources(docs: DataFrame, sources: DataFrame, key: str = "url_hash") -> DataFrame:
    """Documents' url and filename from the source records."""
    s = sources.select(key, F.col("url").alias("_url"), F.col("filename").alias("_filename"))
    d = docs.join(s, key, "left")
    fill = lambda c: F.coalesce(F.col(c), F.col(f"_{c}")) if c in docs.columns else F.col(f"_{c}")
    return d.withColumn("url", fill("url")).withColumn("filename", fill("filename")).drop("_url", "_filename")
