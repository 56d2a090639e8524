"""Queries over sources and sinks: what is written into the shared folder, or packed into rows, must be read back as it was."""

from __future__ import annotations

import gzip
import json
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks.functions import color
from sheafworks.functions.text import top_label
from sheafworks.operators import labels, urls, whitelist
from sheafworks.plans.base import query
from sheafworks.session import local_path, materialise, read_table, work_uri
from sheafworks.sources import readers, sinks


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")


def _folder(spark: SparkSession, name: str) -> str:
    path = local_path(work_uri(spark, name))
    if path is None:
        raise ValueError("this query writes files of its own names, for which the shared folder must be mounted")
    return path


# -- listings, archives ----------------------------------------------------------------------------
@query("listing_uris", "SELECT concat('https://base/', url) AS uri FROM pages")
def listing_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = work_uri(spark, "listing")
    _pages(spark, sf_dir).select("url").write.option("compression", "gzip").text(uri)
    return readers.listing(spark, uri, "https://base/")


def warc_file(url: str, html: str, zipped: bool) -> bytes:
    """A WARC file of an information record and a metadata record."""
    rec = lambda kind, target, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {target}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    parts = [rec("warcinfo", "x", b"software: none\r\n"), rec("metadata", url, html.encode())]
    return b"".join(map(gzip.compress, parts)) if zipped else b"".join(parts)


@query("archive_records", "SELECT url AS target, sha256(html) AS digest, 'metadata' AS type FROM pages")
def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["page_id"].astype(str), "content": [warc_file(u, h, p % 2 == 1) for p, u, h in zip(b["page_id"], b["url"], b["html"])]})

    made = _pages(spark, sf_dir).mapInPandas(pack, "path string, content binary")
    return readers.archives(made).select("target", F.sha2("payload", 256).alias("digest"), "type")


@query("ranged_records", "SELECT url AS target, sha256(html) AS digest, NULL AS error FROM pages UNION ALL SELECT NULL, NULL, 'NotImplementedError' UNION ALL SELECT NULL, NULL, 'FileNotFoundError'")
def ranged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in archive files of many records each, every record read by its place in its file; and two addresses that can't be read."""
    folder = _folder(spark, "ranges")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        name = f"{uuid.uuid4().hex}.warc.gz"  # a task that runs again writes another file
        with open(os.path.join(folder, name), "wb") as f:
            for b in batches:
                rows = []
                for u, h in zip(b["url"], b["html"]):
                    data = warc_file(u, h, True)
                    rows.append((name, f.tell(), len(data)))
                    f.write(data)
                yield pd.DataFrame(rows, columns=["uri", "offset", "length"])

    index = materialise(_pages(spark, sf_dir).mapInPandas(write, "uri string, offset bigint, length bigint"), "ranges-index")
    bad = spark.range(1).select(F.explode(F.array(F.lit("s3://bucket/key"), F.lit(f"file://{folder}/none"))).alias("uri"), F.lit(-1).alias("offset"), F.lit(-1).alias("length"))
    found = readers.fetched_archives(index.unionByName(bad), f"file://{folder}/")
    return found.select("target", F.sha2("payload", 256).alias("digest"), F.regexp_extract("error", r"^\w+", 0).alias("error"))


@query("checked_url_tables", "SELECT url, 0 AS refused FROM pages UNION ALL SELECT 'page_id bigint, url string', 1")
def checked_url_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = work_uri(spark, "urls"), work_uri(spark, "urls-other")
    _pages(spark, sf_dir).select("url").write.parquet(good)
    _pages(spark, sf_dir).select("page_id", "url").coalesce(1).write.parquet(bad)
    refused = readers.schema_mismatches(spark, bad).select(F.col("found").alias("url"), F.lit(1).alias("refused"))
    return readers.checked_urls(spark, good).select("url", F.lit(0).alias("refused")).unionByName(refused)


# -- JSON lines, logs, labels ----------------------------------------------------------------------
_CONV = "SELECT conv_id, turn, text, (conv_id + turn) % 7 = 0 AS broken FROM conversations"


@query("json_lines", f"SELECT broken, count(*) AS n, sum(CASE WHEN broken THEN 0 ELSE length(text) END)::BIGINT AS chars FROM ({_CONV}) GROUP BY broken")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = work_uri(spark, "lines")
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    line = F.to_json(F.struct("conv_id", "turn", "text"))
    c.select(F.when((F.col("conv_id") + F.col("turn")) % 7 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(uri)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("text", T.StringType())])
    d = readers.json_lines(spark, uri, schema).select(F.col("_corrupt_record").isNotNull().alias("broken"), F.length("text").alias("k"))
    return d.groupBy("broken").agg(F.count("*").alias("n"), F.sum(F.when(F.col("broken"), 0).otherwise(F.col("k"))).cast("bigint").alias("chars"))


@query("texts_with_metadata", "SELECT conv_id, turn, sha256(text) AS digest FROM conversations")
def texts_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and their metadata, written as two files each of equal lines, brought together by file and line."""
    folder = _folder(spark, "pairs")
    c = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = uuid.uuid4().hex + ".jsonl.gz"
        for kind in ("text", "meta"):
            os.makedirs(os.path.join(folder, kind), exist_ok=True)
        n = 0
        with gzip.open(os.path.join(folder, "text", name), "wt") as a, gzip.open(os.path.join(folder, "meta", name), "wt") as b:
            for part in batches:
                for i, t, text in zip(part["conv_id"], part["turn"], part["text"]):
                    a.write(json.dumps({"text": text}) + "\n")
                    b.write(json.dumps({"conv_id": int(i), "turn": int(t)}) + "\n")
                    n += 1
        yield pd.DataFrame({"n": [n]})

    c.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
    texts, metas = (readers.json_lines_by_position(spark, f"file://{folder}/{kind}").withColumnRenamed("line", kind) for kind in ("text", "meta"))
    both = readers.zip_join_by_position(texts, metas)
    m = F.from_json("meta", "conv_id bigint, turn int")
    return both.select(m["conv_id"].alias("conv_id"), m["turn"].alias("turn"), F.sha2(F.get_json_object("text", "$.text"), 256).alias("digest"))


@query("worker_logs", "SELECT concat(event_type, ' ', event_id::VARCHAR) AS line, true AS named FROM events")
def worker_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = work_uri(spark, "logs")
    read_table(spark, sf_dir, "events").select(F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))).write.text(uri)
    return readers.logs(spark, uri).select("line", F.col("file").startswith("part-").alias("named"))


@query("label_folder", "SELECT concat('o', o_orderkey::VARCHAR) AS page_id, (o_orderkey % 5)::INT AS class, concat((o_orderkey % 5)::VARCHAR, ' 0.5 0.5 0.1 0.', (o_custkey % 9 + 1)::VARCHAR) AS line FROM orders WHERE o_orderkey % 4 > 0")
def label_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label file for each order; those of every fourth are empty."""
    folder, k = _folder(spark, "label-files"), F.col("o_orderkey")
    line = F.concat((k % 5).cast("string"), F.lit("  0.5 0.5 0.1 0."), (F.col("o_custkey") % 9 + 1).cast("string"), F.lit("\n"))
    sinks.write_label_files(read_table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), k.cast("string")).alias("page_id"), F.when(k % 4 == 0, "").otherwise(line).alias("content")), folder, fan_out=256)
    return readers.yolo_labels(spark, f"file://{folder}").select("page_id", "class", "line")


# -- tar archives, folders -------------------------------------------------------------------------
_NAME = "concat('doc_', page_id::VARCHAR, CASE page_id % 3 WHEN 0 THEN '.docx' WHEN 1 THEN '.doc' ELSE '.txt' END)"


@query("tar_documents", f"SELECT (page_id % 7)::VARCHAR AS shard, {_NAME} AS member, octet_length(encode(html))::BIGINT AS size, sha256(html) AS digest FROM pages WHERE page_id % 3 < 2")
def tar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages packed into tar archives by shard, of several parts each; of those the members that are documents."""
    k = F.col("page_id")
    name = F.concat(F.lit("doc_"), k.cast("string"), F.when(k % 3 == 0, ".docx").when(k % 3 == 1, ".doc").otherwise(".txt"))
    packed = sinks.tar_archives(_pages(spark, sf_dir).select((k % 7).alias("shard"), name.alias("member"), F.encode("html", "UTF-8").alias("content")), "shard", max_bytes=200_000)
    found = readers.tar_members(packed.select(F.col("shard").alias("path"), "content")).where("error is null")
    return found.select(F.col("path").alias("shard"), "member", "size", F.sha2("content", 256).alias("digest"))


@query("tar_member_limit", "SELECT (page_id % 7)::VARCHAR AS shard, least(count(*), 3) AS n FROM pages GROUP BY 1")
def tar_member_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most three documents of each archive, which is the feature."""
    rows = _pages(spark, sf_dir).select((F.col("page_id") % 7).alias("shard"), F.concat(F.col("page_id").cast("string"), F.lit(".doc")).alias("member"), F.encode("url", "UTF-8").alias("content"))
    found = readers.tar_members(sinks.tar_archives(rows, "shard").select(F.col("shard").alias("path"), "content"), limit=3)
    return found.groupBy(F.col("path").alias("shard")).agg(F.count("*").alias("n"))


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an annotated page, some without an image or words: page_id, shard, image, text, words, entities."""
    k = F.col("o_orderkey")
    box = F.struct((k % 50).cast("double").alias("x"), F.lit(2.0).alias("y"), F.lit(30.0).alias("width"), F.lit(4.5).alias("height"))
    page = F.concat(F.lit("p"), k.cast("string"))
    one = F.struct(page.alias("page_id"), F.lit(1).alias("page_num"), (k % 31).cast("int").alias("entity_category"), box.alias("bbox"), F.concat(F.lit("e"), k.cast("string")).alias("id"), F.lit(135.0).alias("area"))
    word = F.struct(F.array(F.concat(F.lit("e"), k.cast("string"))).alias("entity_ids"), F.lit(1).alias("page_num"), box.alias("bbox"), F.col("o_orderpriority").alias("text"))
    entities = F.to_json(F.struct(F.create_map((k % 31).cast("string"), F.array(one)).alias("entities")))
    return read_table(spark, sf_dir, "orders").select(
        page.alias("page_id"), (k % 11).alias("shard"), F.when(k % 13 > 0, F.encode(page, "UTF-8")).alias("image"), F.to_json(F.struct(page.alias("text"))).alias("text"),
        F.when(k % 17 > 0, F.to_json(F.struct(F.array(word).alias("words")))).alias("words"), entities.alias("entities"),
    )


_WHOLE = "SELECT *, concat('p', o_orderkey::VARCHAR) AS page_id FROM orders WHERE o_orderkey % 13 > 0 AND o_orderkey % 17 > 0"


@query("page_archives", f"SELECT page_id, (o_orderkey % 11)::VARCHAR AS shard, 4 AS files, NULL AS error FROM ({_WHOLE}) UNION ALL SELECT concat('p', o_orderkey::VARCHAR), NULL, 0, concat('Missing(', CASE WHEN o_orderkey % 13 > 0 THEN 'words' WHEN o_orderkey % 17 > 0 THEN 'image' ELSE 'image,words' END, ')') FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0")
def page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written whole or not at all: what is in the archives, and why the others aren't."""
    good, bad = sinks.page_members(_page_files(spark, sf_dir))
    members = readers.tar_members(sinks.tar_archives(good, "shard", max_bytes=1 << 18).select(F.col("shard").alias("path"), "content"), r"\.(jpg|json)$")
    page = F.regexp_extract("member", r"^(?:text_|words_|entities_)?(.*)\.\w+$", 1)
    held = members.groupBy(page.alias("page_id"), F.col("path").alias("shard")).agg(F.count("*").cast("int").alias("files"))
    return held.select("page_id", "shard", "files", F.lit(None).cast("string").alias("error")).unionByName(bad.select("page_id", F.lit(None).cast("string").alias("shard"), F.lit(0).alias("files"), "error"))


@query("archive_entities", f"SELECT page_id, concat('e', o_orderkey::VARCHAR) AS id, (o_orderkey % 31)::INT AS category, (o_orderkey % 50)::DOUBLE AS x, o_orderpriority AS word FROM ({_WHOLE})")
def archive_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and words of annotation archives, paired."""
    good, _ = sinks.page_members(_page_files(spark, sf_dir))
    members = readers.tar_members(sinks.tar_archives(good, "shard").select(F.col("shard").alias("path"), "content"), r"\.json$")
    return _paired(members)


def _paired(members: DataFrame) -> DataFrame:
    # read twice below, so what is needed of the archives is written once
    members = materialise(members.where(F.col("member").rlike(r"(^|/)(entities|words)_")).select("path", "member", "content"), "members")
    e, w = readers.annotated_entities(members), readers.annotated_words(members)
    own = w.select(F.regexp_extract("member", r"words_(.*)\.json$", 1).alias("page_id"), F.explode("entity_ids").alias("id"), F.col("text").alias("word"))
    return e.select("page_id", "id", F.col("entity_category").alias("category"), F.col("bbox.x").alias("x")).join(own, ["page_id", "id"])


@query("folder_entities", f"SELECT page_id, concat('e', o_orderkey::VARCHAR) AS id, (o_orderkey % 31)::INT AS category, (o_orderkey % 50)::DOUBLE AS x, o_orderpriority AS word FROM ({_WHOLE})")
def folder_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an unpacked folder."""
    folder = _folder(spark, "unpacked")
    good, _ = sinks.page_members(_page_files(spark, sf_dir))
    texts = good.where(F.col("member").endswith(".json")).select(F.regexp_replace("member", r"\.json$", "").alias("page_id"), F.decode("content", "UTF-8").alias("content"))
    sinks.write_label_files(texts, folder, suffix=".json", fan_out=256)
    return _paired(readers.folder_members(spark, f"file://{folder}"))


@query("image_dataset", f"SELECT page_id AS id, o_orderpriority AS token, concat('images/', page_id, '.jpg') AS path, page_id AS bytes FROM ({_WHOLE.replace(' AND o_orderkey % 17 > 0', '')})")
def image_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with their images, written and reread; pages without an image have no row."""
    pages = _page_files(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("id"), F.array("o_orderpriority").alias("tokens"))
    images = pages.where("image is not null").select(F.col("page_id").alias("id"), F.concat(F.lit("images/"), F.col("page_id"), F.lit(".jpg")).alias("path"), F.col("image").alias("content"))
    d = materialise(sinks.image_dataset(orders, images), "dataset")
    return d.select("id", F.col("tokens")[0].alias("token"), "image.path", F.decode("image.bytes", "UTF-8").alias("bytes"))


# -- tables, batches, settings ---------------------------------------------------------------------
@query("chunked_parquet", "SELECT count(*) AS n, sum(l_orderkey)::BIGINT AS keys, true AS bounded FROM lineitem")
def chunked_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = work_uri(spark, "chunks")
    sinks.write_parquet(read_table(spark, sf_dir, "lineitem").select("l_orderkey"), uri, rows_per_file=700)
    d = spark.read.parquet(uri).groupBy("_metadata.file_path").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))
    return d.agg(F.sum("n").cast("bigint").alias("n"), F.sum("keys").cast("bigint").alias("keys"), (F.max("n") <= 700).alias("bounded"))


@query("url_batches", "SELECT batch, string_agg(url, ' ' ORDER BY pos) AS urls FROM (SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS pos, (row_number() OVER (ORDER BY page_id) - 1) // 10 AS batch FROM pages) GROUP BY batch")
def url_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = urls.batches(_pages(spark, sf_dir).select("page_id", "url"), ["page_id"], "url", 10)
    return b.select("batch", F.array_join("items", " ").alias("urls"))


@query("shard_page_ids", "SELECT concat('{\"s', (o_orderkey % 11)::VARCHAR, '\":[', string_agg(concat('\"p', o_orderkey::VARCHAR, '\"'), ',' ORDER BY concat('p', o_orderkey::VARCHAR)), ']}') AS value FROM orders GROUP BY o_orderkey % 11")
def shard_page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = work_uri(spark, "shard-json")
    k = F.col("o_orderkey")
    d = read_table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), (k % 11).cast("string")).alias("annotated_shard_id"), F.concat(F.lit("p"), k.cast("string")).alias("page_id"))
    sinks.shard_json(whitelist.pages_by_shard(d)).write.text(uri)
    return spark.read.text(uri)


_SETTINGS = {"max_img": 7, "elem_mins": {"3": 5, "16": 2}, "elem_drops": ["4"], "elem_mergings": {"masters": {"1": "heading"}, "mapping": {"2": 1}}, "language_codes": ["en"], "quality_threshold": "0.5"}


@query("parsed_settings", "SELECT * FROM (VALUES (3, 5, '3', 0.5, 'en'), (16, 2, '16', 0.5, 'en'), (-1, 0, '0,1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18,19,20,21,22,23,24,25,26,27,28,29,30', 0.0, '')) v(quota, max_img, accepts, quality, languages)")
def parsed_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection for each class with a minimum; without any, the whole with all classes."""
    rows = [(int(s.elem_accepts[0]), s.max_img, ",".join(map(str, s.elem_accepts)), s.quality_threshold, ",".join(s.language_codes)) for s in labels.Settings.parse(_SETTINGS).quotas()]
    every = labels.Settings.parse({}).quotas()[0]
    return spark.createDataFrame([*rows, (-1, every.max_img, ",".join(map(str, every.elem_accepts)), every.quality_threshold, "")], "quota int, max_img int, accepts string, quality double, languages string")


@query("coco_label_names", "SELECT DISTINCT p_type AS label, (dense_rank() OVER (ORDER BY p_type) - 1)::INT AS class FROM part")
def coco_label_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data set's classes as its COCO file names them, in its order."""
    uri = work_uri(spark, "coco")
    kinds = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
    one = kinds.agg(F.array_sort(F.collect_set("name")).alias("n")).select(F.to_json(F.struct(F.array().cast("array<int>").alias("images"), F.transform("n", lambda x: F.struct(x.alias("name"))).alias("categories"))).alias("value"))
    one.write.text(uri)
    return labels.coco_labels(readers.coco(spark, uri))


@query("language_maps", "SELECT doc_id, CASE WHEN text IS NULL OR trim(text) = '' THEN '__label__unknown' ELSE concat('__label__', lang) END AS label, CASE WHEN text IS NULL OR trim(text) = '' THEN 1.0 ELSE 0.75 END AS score, CASE WHEN text IS NULL OR trim(text) = '' THEN 1 ELSE 5 END AS kept FROM documents")
def language_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plug-in identifier (here one that reads the language off the text's first word), of whose labels the best five stay."""

    def plug_in(texts: list[str]) -> list[dict[str, float]]:
        return [{f"__label__{t.split()[0]}": 0.75} | {f"__label__x{i}": 0.2 - i / 100 for i in range(8)} for t in texts]

    d = read_table(spark, sf_dir, "documents").select("doc_id", F.when(F.trim(F.coalesce("text", F.lit(""))) != "", F.concat_ws(" ", "lang", "text")).otherwise(F.col("text")).alias("t"))
    top = top_label(F.col("languages"))
    return readers.predict_languages(d, F.col("t"), plug_in).select("doc_id", top["label"].alias("label"), top["score"].alias("score"), F.size("languages").alias("kept"))


@query("table_color_cycle", "SELECT event_id, (255 - 2 * ((event_id // 103) % 103))::INT AS s, (255 - 2 * (event_id % 103))::INT AS v FROM events")
def table_color_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = color.table_cycle(F.col("event_id"))
    return read_table(spark, sf_dir, "events").select("event_id", c["s"].alias("s"), c["v"].alias("v"))
