"""Queries over URLs: predicates, cleaning, ids, deduplication, parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.functions import url as U
from sheafworks.operators import urls as O
from sheafworks.plans.base import query
from sheafworks.session import read_table

RAW = """SELECT page_id, CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN concat(url, '/a.doc') WHEN 2 THEN concat(url, '/a.docx') WHEN 3 THEN concat(url, '/a.DOC')
   WHEN 4 THEN concat(url, '?u=http://x.y/b.docx') WHEN 5 THEN concat(url, '/a%20b%2Bc.doc') WHEN 6 THEN concat(url, '/a%zz.docx#.doc') ELSE concat('redirect?to=', url, '/c.docx&v=http://z/d.doc') END AS url,
   concat('CC-MAIN-20', CAST(20 + page_id % 3 AS VARCHAR(9)), '-0', CAST(1 + page_id % 4 AS VARCHAR(9))) AS source FROM pages"""
_R = f"raw AS ({RAW})"
_POS = "list_filter(range(1, length(u) + 1), lambda i: substr(u, i, 4) = '{0}')"
_CLEAN = f"""pos AS (SELECT *, {_POS.format('http')} AS s, list_transform({_POS.format('.doc')}, lambda i: i - 1 + CASE WHEN substr(u, i, 5) = '.docx' THEN 5 ELSE 4 END) AS e FROM dec),
  cut AS (SELECT *, list_min(e) AS m, CASE WHEN len(s) = 1 THEN s[1] WHEN len(e) = 1 THEN s[len(s)] ELSE s[greatest(1, len(list_filter(s, lambda x: x - 1 < list_min(e))))] END AS b FROM pos),
  cleaned AS (SELECT *, CASE WHEN len(s) = 0 OR len(e) = 0 THEN NULL ELSE substr(u, b, greatest(0, m - b + 1)::INT) END AS clean FROM cut)"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW.replace("FROM pages", "FROM {pages}"), pages=read_table(spark, sf_dir, "pages").select("page_id", "url"))


@query("url_hash", f"WITH {_R} SELECT page_id, sha256(url) AS url_hash FROM raw")
def url_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("page_id", U.url_hash(F.col("url")).alias("url_hash"))


@query("url_unquote", f"WITH {_R} SELECT page_id, url_decode(url) AS url FROM raw")
def url_unquote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("page_id", U.unquote(F.col("url")).alias("url"))


@query("doc_url_filter", rf"WITH {_R} SELECT page_id, url FROM raw WHERE regexp_matches(url, '^(www|http:|https:)+[^\s]+\w\.(doc|docx)$')")
def doc_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).where(U.is_doc_url(F.col("url"))).select("page_id", "url")


@query("clean_url", f"WITH {_R}, dec AS (SELECT *, url_decode(url) AS u FROM raw), {_CLEAN} SELECT page_id, clean AS url FROM cleaned")
def clean_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("page_id", U.clean_url(U.unquote(F.col("url"))).alias("url"))


@query("crawl_source", f"WITH {_R} SELECT page_id, regexp_extract(concat('/data/', source, '.parquet'), 'CC-MAIN-\\d{{4}}-\\d{{2}}') AS source FROM raw")
def crawl_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("page_id", U.crawl_of(F.concat(F.lit("/data/"), F.col("source"), F.lit(".parquet"))).alias("source"))


@query("doc_ids", f"""WITH {_R}, first AS (SELECT *, row_number() OVER (PARTITION BY sha256(url) ORDER BY source, url) AS rn FROM raw),
  ids AS (SELECT url, source, concat(source, '-', lpad(CAST(row_number() OVER (PARTITION BY source ORDER BY url) - 1 AS VARCHAR), 9, '0')) AS doc_id, sha256(url) AS url_hash FROM first WHERE rn = 1),
  dec AS (SELECT *, url_decode(url) AS u FROM ids), {_CLEAN} SELECT doc_id, clean AS url, url_hash, source FROM cleaned""")
def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.clean(raw(spark, sf_dir).select("url", "source"))


@query("merge_raw_urls", f"WITH {_R} SELECT DISTINCT url FROM raw")
def merge_raw_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir)
    return O.merge_raw(r.where("page_id % 2 = 0"), r.where("page_id % 2 = 1"))[0]


@query("global_url_dedup", f"WITH {_R} SELECT page_id, url FROM raw WHERE source = 'CC-MAIN-2021-02' AND sha256(url) NOT IN (SELECT sha256(url) FROM raw WHERE source <> 'CC-MAIN-2021-02')")
def global_url_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir).withColumn("url_hash", U.url_hash(F.col("url")))
    return O.global_dedup(r.where("source = 'CC-MAIN-2021-02'"), r).select("page_id", "url")


@query("missing_urls", f"WITH {_R} SELECT url FROM raw EXCEPT SELECT url FROM raw WHERE page_id % 3 = 0")
def missing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir)
    return O.missing(r, r.where("page_id % 3 = 0"), "url")


@query("recovery_segments", "WITH need AS (SELECT concat('https://base/', page_id::VARCHAR) AS uri FROM pages) SELECT uri FROM need WHERE uri NOT IN (SELECT concat('https://base/', page_id::VARCHAR) FROM pages WHERE page_id % 5 <> 0)")
def recovery_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    need = read_table(spark, sf_dir, "pages").select(F.concat(F.lit("https://base/"), F.col("page_id").cast("string")).alias("uri"), "page_id")
    return O.not_seen(need.select("uri"), need.where("page_id % 5 <> 0"), "uri")


@query("partition_chunks", "SELECT page_id, CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / 32) AS INT) AS part FROM pages")
def partition_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = O.global_position(read_table(spark, sf_dir, "pages").select("page_id"), ["page_id"])
    return pos.select("page_id", F.floor(F.col("pos") / 32).cast("int").alias("part"))


@query("partition_round_robin", "SELECT page_id, CAST((row_number() OVER (ORDER BY page_id) - 1) % 7 + 1 AS INT) AS node FROM pages")
def partition_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = O.global_position(read_table(spark, sf_dir, "pages").select("page_id"), ["page_id"])
    return pos.select("page_id", (F.pmod("pos", F.lit(7)) + 1).cast("int").alias("node"))


@query("partition_array_split", "SELECT o_orderkey, CAST(ntile(25) OVER (ORDER BY o_orderkey) - 1 AS INT) AS part FROM orders")
def partition_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.near_equal(read_table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 25)


@query("sample_urls", "SELECT page_id FROM pages ORDER BY md5(concat('0:', page_id::VARCHAR)), page_id LIMIT 40")
def sample_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.sample_exact(read_table(spark, sf_dir, "pages").select("page_id"), "page_id", 40)


@query("doc_filenames", f"WITH {_R} SELECT page_id, concat('doc_', sha256(url), regexp_extract(url, '[^./][^/]*?(\\.[^./]*)$', 1)) AS filename FROM raw")
def doc_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("page_id", U.doc_filename(U.url_hash(F.col("url")), F.col("url")).alias("filename"))


@query("json_walk", "SELECT event_id, event_type AS value FROM events UNION ALL SELECT event_id, concat('u', user_id::VARCHAR) FROM events")
def json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafworks.sources.readers import json_strings

    e = read_table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.col("event_type").alias("a"), F.array(F.struct(F.col("value").alias("n"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("b"))).alias("c")))
    return json_strings(e.select("event_id", doc.alias("j")), "j", ["event_id"])
