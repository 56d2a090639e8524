"""Queries that build training sets: classes, quotas, boxes, reports, converters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.functions import geometry as G
from sheafworks.operators import datasets, labels, whitelist
from sheafworks.plans.base import query
from sheafworks.plans.layout import ENTITIES, WORDS, entities, words
from sheafworks.session import read_table

SETTINGS = labels.Settings.parse({"max_img": 400, "elem_drops": [2, 26, 27], "elem_mergings": {"masters": {"1": "heading"}, "mapping": {"2": 1, "3": 1, "4": 1, "5": 1}}, "elem_mins": {"1": 60, "8": 40, "16": 90}, "elem_accepts": [1, 8, 16], "quality_threshold": 0.3, "language_codes": ["en", "fr"], "language_code_threshold": 0.2})
_LABELS, _CLASSES = labels.class_map(SETTINGS)
_CLASS_SQL = "classes AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, {c})" for k, c in sorted(_CLASSES.items())) + ") v(category, class))"


@query("class_map", "SELECT * FROM (VALUES " + ", ".join(f"({k}, {c}, '{'heading' if k in (1, 2, 3, 4, 5) else S.ENTITY_NAMES[k]}')" for k, c in {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, **{k: k - 4 for k in range(6, 26)}, **{k: k - 6 for k in (28, 29, 30)}}.items()) + ") v(category, class, label)")
def class_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_table(spark, SETTINGS)


_PAGE = "p AS (SELECT DISTINCT l_orderkey AS page_id, CAST(l_orderkey % 10 AS DOUBLE) / 10 AS quality, CASE l_orderkey % 3 WHEN 0 THEN '__label__en' WHEN 1 THEN '__label__fr' ELSE '__label__de' END AS top_lang, CAST(l_orderkey % 7 AS DOUBLE) / 7 AS top_lang_score FROM lineitem)"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    p = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id")).distinct()
    return p.select("page_id", ((k % 10).cast("double") / 10).alias("quality"), F.when(k % 3 == 0, "__label__en").when(k % 3 == 1, "__label__fr").otherwise("__label__de").alias("top_lang"), ((k % 7).cast("double") / 7).alias("top_lang_score"))


@query("select_training_pages", f"WITH {_PAGE}, e AS ({ENTITIES}) SELECT page_id FROM p WHERE quality >= 0.3 AND top_lang IN ('__label__en', '__label__fr') AND top_lang_score >= 0.2 AND page_id IN (SELECT page_id FROM e WHERE category IN (1, 2, 3, 4, 5, 8, 16))")
def select_training_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.select_pages(_pages(spark, sf_dir), entities(spark, sf_dir), SETTINGS).select("page_id")


@query("quota_sample", f"""WITH e AS ({ENTITIES}), c AS (SELECT DISTINCT page_id, category, md5(page_id::VARCHAR) AS o FROM e WHERE category IN (8, 12, 16)),
  r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY o, page_id) AS rn FROM c), q AS (SELECT DISTINCT page_id FROM r WHERE (category = 8 AND rn <= 40) OR (category = 16 AND rn <= 90)),
  rest AS (SELECT DISTINCT page_id, o FROM c WHERE page_id NOT IN (SELECT page_id FROM q)), f AS (SELECT *, row_number() OVER (ORDER BY o, page_id) AS rn FROM rest)
  SELECT page_id, 'quota' AS chosen_by FROM q UNION ALL SELECT page_id, 'fill' FROM f WHERE rn <= greatest(400 - (SELECT count(*) FROM q), 0)""")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir).where(F.col("category").isin(8, 12, 16))
    return datasets.quota_sample(e, {8: 40, 16: 90}, 400, F.md5(F.col("page_id").cast("string")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir).withColumn("page_width", F.lit(512.0)).withColumn("page_height", F.lit(256.0))
    return datasets.yolo_lines(e, labels.class_table(spark, SETTINGS))


_LINES = f"""e AS ({ENTITIES}), {_CLASS_SQL}, lines AS (SELECT page_id, class, concat_ws(' ', class::VARCHAR, substr(((x + w / 2) / 512)::VARCHAR, 1, 10), substr(((y + h / 2) / 256)::VARCHAR, 1, 10), substr((w / 512)::VARCHAR, 1, 10), substr((h / 256)::VARCHAR, 1, 10)) AS line
  FROM e JOIN classes USING (category))"""


@query("yolo_boxes", f"WITH {_LINES} SELECT page_id, class, line FROM lines")
def yolo_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir)


@query("yolo_label_files", f"WITH {_LINES} SELECT page_id, string_agg(line, chr(10) ORDER BY line) AS content FROM lines GROUP BY page_id")
def yolo_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.label_files(_lines(spark, sf_dir))


@query("label_report", f"WITH {_LINES} SELECT class, count(*) AS n FROM (SELECT DISTINCT page_id, class, line FROM lines) GROUP BY class UNION ALL SELECT -1, count(*) FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT page_id FROM lines))")
def label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"))
    return datasets.label_report(_lines(spark, sf_dir), images)


@query("layoutlm_arrays", f"""WITH e AS ({ENTITIES}), w AS ({WORDS}), j AS (SELECT w.page_id, entity_id, word_id, concat(CAST(w.x AS BIGINT)::VARCHAR, ' ', CAST(w.y AS BIGINT)::VARCHAR, ' ', CAST(w.x + w.w AS BIGINT)::VARCHAR, ' ', CAST(w.y + w.h AS BIGINT)::VARCHAR) AS b, category
   FROM w JOIN e ON w.page_id = e.page_id AND w.word_id = e.entity_id) SELECT page_id AS id, string_agg(concat('t', word_id::VARCHAR), '|' ORDER BY entity_id, word_id) AS tokens, string_agg(b, '|' ORDER BY entity_id, word_id) AS word_bboxes, string_agg(category::VARCHAR, '|' ORDER BY entity_id, word_id) AS entity_labels FROM j GROUP BY page_id""")
def layoutlm_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir).select("page_id", F.col("entity_id").alias("entity_pos"), F.col("category").alias("label"), F.col("bbox").alias("entity_bbox"))
    w = words(spark, sf_dir).select("page_id", F.col("word_id").alias("word_pos"), "bbox", F.concat(F.lit("t"), F.col("word_id").cast("string")).alias("text"))
    d = datasets.layoutlm_rows(w.join(e, (w["page_id"] == e["page_id"]) & (w["word_pos"] == e["entity_pos"])).drop(e["page_id"]))
    text = lambda c: F.array_join(c, "|")
    return d.select("id", text("tokens").alias("tokens"), text(F.transform("word_bboxes", lambda b: F.array_join(F.transform(b, lambda v: v.cast("string")), " "))).alias("word_bboxes"), text(F.transform("entity_labels", lambda v: v.cast("string"))).alias("entity_labels"))


@query("coco_boxes", "SELECT concat('img', l_orderkey::VARCHAR, '.png') AS file_name, CAST(l_linenumber - 1 AS INT) AS class, round((l_linenumber * 10 + 15) / 500.0, 6) AS cx, round((l_linenumber * 5 + 10) / 400.0, 6) AS cy, 0.06::DOUBLE AS w, 0.05::DOUBLE AS h FROM lineitem")
def coco_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber")
    doc = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_orderkey").alias("image_id"), k.alias("category_id"), F.array((k * 10).cast("double"), (k * 5).cast("double"), F.lit(30.0), F.lit(20.0)).alias("bbox"))).alias("annotations"))
    doc = doc.withColumn("images", F.array(F.struct(F.col("l_orderkey").alias("id"), F.concat(F.lit("img"), F.col("l_orderkey").cast("string"), F.lit(".png")).alias("file_name"), F.lit(500).alias("width"), F.lit(400).alias("height"))))
    d = datasets.coco_boxes(doc)
    return d.select("file_name", F.col("class").cast("int").alias("class"), F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"), F.round("w", 6).alias("w"), F.round("h", 6).alias("h"))


@query("table_cell_boxes", "SELECT l_orderkey::VARCHAR AS filename, l_linenumber::DOUBLE AS x, 2.0::DOUBLE AS y, (l_quantity - l_linenumber)::DOUBLE AS width, 5.0::DOUBLE AS height FROM lineitem WHERE l_partkey % 5 <> 0")
def table_cell_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    b = F.when(F.col("l_partkey") % 5 != 0, F.array(F.col("l_linenumber").cast("double"), F.lit(2.0), F.col("l_quantity"), F.lit(7.0)))
    d = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(b.alias("bbox"))).alias("cells"))
    lines = d.select(F.lit("train").alias("split"), F.col("l_orderkey").cast("string").alias("filename"), F.struct("cells").alias("html"), F.lit(None).cast("string").alias("_corrupt_record"))
    return datasets.table_cell_boxes(lines).select("filename", "x", "y", "width", "height")


@query("train_val_split", "WITH s AS (SELECT DISTINCT o_custkey FROM orders), v AS (SELECT o_custkey FROM s ORDER BY md5(concat(o_custkey::VARCHAR, ':0')), o_custkey LIMIT 50) SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM v) THEN 'val' ELSE 'train' END AS split FROM orders")
def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.move_to_validation(read_table(spark, sf_dir, "orders"), "o_custkey", 50).select("o_orderkey", "split")


@query("first_per_group", "SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 25")
def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.first_n(read_table(spark, sf_dir, "orders"), ["o_orderkey"], 25, "o_orderpriority").select("o_orderkey")


_KINDS = ("jpg", "text", "entities", "words")
_MEM = "m AS (SELECT CAST(event_id // 4 AS BIGINT) AS page, CASE event_id % 4 WHEN 0 THEN 'jpg' WHEN 1 THEN 'text' WHEN 2 THEN 'entities' ELSE 'words' END AS kind FROM events WHERE event_id % 23 <> 0)"


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where("event_id % 23 <> 0")
    return e.select(F.floor(F.col("event_id") / 4).alias("page"), F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("event_id") % 4 + 1).cast("int")).alias("kind"))


@query("tar_completeness", f"WITH {_MEM} SELECT page FROM m GROUP BY page HAVING count(DISTINCT kind) = 4")
def tar_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.complete_pages(_members(spark, sf_dir), "page", "kind", _KINDS)


@query("filter_members", f"WITH {_MEM}, c AS (SELECT page FROM m GROUP BY page HAVING count(DISTINCT kind) = 4) SELECT page, kind FROM m WHERE page IN (SELECT page FROM c) AND page % 3 = 0")
def filter_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _members(spark, sf_dir)
    return whitelist.filter_members(m, m.where("page % 3 = 0").select("page").distinct(), "page", "kind", _KINDS)


@query("corner_boxes", f"WITH e AS ({ENTITIES}) SELECT page_id, entity_id, concat_ws(',', CAST(x AS BIGINT)::VARCHAR, CAST(y AS BIGINT)::VARCHAR, CAST(x + w AS BIGINT)::VARCHAR, CAST(y + h AS BIGINT)::VARCHAR) AS box FROM e")
def corner_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(spark, sf_dir).select("page_id", "entity_id", F.array_join(F.transform(G.corner_box(F.col("bbox")), lambda v: v.cast("string")), ",").alias("box"))
