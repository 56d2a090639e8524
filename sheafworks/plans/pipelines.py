"""The three pipelines: URLs from crawl metadata, downloads to an export, annotations to a training set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.functions import geometry as G
from sheafworks.functions import url as U
from sheafworks.operators import annotate, audit, datasets, download, labels, urls, whitelist
from sheafworks.plans.base import query
from sheafworks.plans.layout import entities, words
from sheafworks.sources import readers


def mine_urls(files: DataFrame, history: DataFrame, crawl: Callable[[Column], Column] = U.crawl_of) -> DataFrame:
    """Crawl metadata files (``binaryFile``) → clean, globally new document URLs."""
    records = readers.archives(files).select("path", F.decode("payload", "UTF-8").alias("json"))
    found = readers.json_strings(records, "json", ["path"], U.DOC_URL).select(F.col("value").alias("url"), crawl(F.col("path")).alias("source"))
    return urls.global_dedup(urls.clean(found.distinct()), history)


def download_and_export(targets: DataFrame, get: Callable[[str], dict], exported: DataFrame, tasks: int = 64) -> tuple[DataFrame, DataFrame]:
    """URLs → (new documents, rejected ones with their reason)."""
    got = readers.fetch(targets, get, tasks).join(targets.select("url_hash", F.col("source").alias("crawl_id")), "url_hash")
    up = F.col("status").isNotNull()
    reason = F.coalesce(download.header_reason(F.col("status"), F.col("content_length"), F.col("content_type"), up), download.body_reason(F.col("status"), F.octet_length("body"), up))
    judged = got.withColumn("reason", reason).withColumn("bytehash", F.sha2("body", 256))
    return audit.export(judged.where("reason is null"), exported, ["url_hash"]), judged.where("reason is not null").select("url", "url_hash", "reason", "error")


def training_set(pages: DataFrame, docs: DataFrame, found: annotate.Annotated, s: labels.Settings, strict_headings: bool = False) -> DataFrame:
    """Whitelisted, selected and balanced pages → their label files (page_id, content)."""
    kept = whitelist.filter_pages(pages, whitelist.judge_documents(docs), strict_headings)
    own = whitelist.page_documents(kept, docs)
    chosen = datasets.select_pages(own, found.entities, s)
    candidates = found.entities.join(chosen.select("page_id"), "page_id", "left_semi")
    sample = datasets.quota_sample(candidates, s.elem_mins, s.max_img, F.md5(F.col("page_id").cast("string")))
    boxes = candidates.join(sample, "page_id", "left_semi").join(pages.select("page_id", "page_width", "page_height"), "page_id")
    return datasets.label_files(datasets.yolo_lines(boxes, labels.class_table(pages.sparkSession, s)))


def _annotated(spark: SparkSession, sf_dir: str) -> annotate.Annotated:
    e = entities(spark, sf_dir)
    size = [F.lit(v).alias(k) for k, v in (("page_width", 300.0), ("page_height", 200.0), ("pdf_width", 150.0), ("pdf_height", 100.0))]
    pages = e.select("page_id").distinct().select("page_id", (F.col("page_id") % 50).alias("doc_id"), *size)
    half = words(spark, sf_dir).withColumn("bbox", G.rescale(F.col("bbox"), F.lit(0.5), F.lit(0.5)))
    return annotate.annotate(half, e, pages)


@query("annotated_pages")
def annotated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).page_counts


@query("annotated_entities")
def annotated_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _annotated(spark, sf_dir).entities
    return e.select("page_id", "entity_id", "category", "bbox.x", "bbox.y", "bbox.width", "bbox.height")


_HSV = """WITH e AS (SELECT event_id, event_id % 180 AS h, (event_id * 7) % 256 AS s, (event_id // 180) % 256 AS v FROM events),
k AS (SELECT *, fmod(CAST(5 AS DOUBLE) + CAST(h AS DOUBLE) / 30, 6) AS kr, fmod(CAST(3 AS DOUBLE) + CAST(h AS DOUBLE) / 30, 6) AS kg, fmod(CAST(1 AS DOUBLE) + CAST(h AS DOUBLE) / 30, 6) AS kb, v * (CAST(s AS DOUBLE) / 255) AS c FROM e),
rgb AS (SELECT *, CAST(round(v - c * greatest(0, least(kr, 4 - kr, 1))) AS INT) AS r, CAST(round(v - c * greatest(0, least(kg, 4 - kg, 1))) AS INT) AS g, CAST(round(v - c * greatest(0, least(kb, 4 - kb, 1))) AS INT) AS b FROM k),
t AS (SELECT *, greatest(r, g, b) AS top, greatest(r, g, b) - least(r, g, b) AS span FROM rgb),
p AS (SELECT *, CASE WHEN span = 0 THEN 0 WHEN top = r AND g >= b THEN CAST(g - b AS DOUBLE) / span WHEN top = r THEN fmod(CAST(g - b AS DOUBLE) / span + 6, 6) WHEN top = g THEN CAST(b - r AS DOUBLE) / span + 2 ELSE CAST(r - g AS DOUBLE) / span + 4 END AS part FROM t)
SELECT event_id, h, s, v, printf('#%02x%02x%02x', r, g, b) AS color, CAST(round(part * 30) AS INT) % 180 AS h2, CASE WHEN top = 0 THEN 0 ELSE CAST(round(span * CAST(255 AS DOUBLE) / top) AS INT) END AS s2, top AS v2, CAST(255 - 2 * (event_id % 28) AS INT) AS cycled FROM p"""


@query("hsv_colors", _HSV)
def hsv_colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hues with varying saturation and value, there and back, and cycled values."""
    from sheafworks.functions import color
    from sheafworks.session import read_table

    i = F.col("event_id")
    e = read_table(spark, sf_dir, "events").select("event_id", (i % 180).alias("h"), (i * 7 % 256).alias("s"), (F.floor(i / 180) % 256).alias("v"))
    e = e.withColumn("rgb", color.hsv_to_rgb(F.col("h"), F.col("s"), F.col("v")))
    e = e.withColumn("hsv", color.rgb_to_hsv(F.col("rgb")[0], F.col("rgb")[1], F.col("rgb")[2]))
    return e.select("event_id", "h", "s", "v", color.rgb_to_hex(F.col("rgb")).alias("color"), F.col("hsv")[0].alias("h2"), F.col("hsv")[1].alias("s2"), F.col("hsv")[2].alias("v2"), color.cycled_value(i).alias("cycled"))
