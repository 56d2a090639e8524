"""Queries over boxes: matching, filters, trimming, table inference, counts, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.functions import geometry as G
from sheafworks.operators import layout, quality, tables
from sheafworks.plans.base import query
from sheafworks.session import read_table

ENTITIES = """SELECT l_orderkey AS page_id, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100000 + l_suppkey AS entity_id, CAST((l_linenumber * 4) % 31 AS INT) AS category, CAST((l_partkey % 20) * 10 AS DOUBLE) AS x, CAST((l_suppkey % 10) * 10 AS DOUBLE) AS y,
  CAST(40 + (l_linenumber % 3) * 20 AS DOUBLE) AS w, CAST(30 + (l_partkey % 2) * 10 AS DOUBLE) AS h FROM lineitem"""
WORDS = """SELECT l_orderkey AS page_id, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100000 + l_suppkey AS word_id, CAST((l_suppkey % 20) * 11 AS DOUBLE) AS x, CAST((l_partkey % 10) * 11 AS DOUBLE) AS y, CAST(4 + (l_linenumber % 4) * 3 AS DOUBLE) AS w,
  CAST(CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE 5 END AS DOUBLE) AS h FROM lineitem"""
CELLS = """SELECT l_orderkey AS table_id, CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 100000 + l_suppkey AS cell_id, CAST((l_linenumber % 3) * 50 + l_partkey % 4 AS DOUBLE) AS x, CAST(floor(l_linenumber / 3) * 20 + l_suppkey % 8 AS DOUBLE) AS y,
  CAST(45 + (l_partkey % 2) * 5 AS DOUBLE) AS w, CAST(18 + (l_suppkey % 2) * 4 AS DOUBLE) AS h FROM lineitem"""
DECISIONS = """SELECT l_orderkey AS doc_id, CAST((l_linenumber * 4) % 31 AS INT) AS entity_id, CASE l_suppkey % 5 WHEN 0 THEN 'builtin' WHEN 1 THEN 'xml_pattern' WHEN 2 THEN 'content_aware_heuristic' WHEN 3 THEN 'body_heading_heuristic_usingbuiltin' ELSE 'body_heading_heuristic_base' END AS source,
  CASE WHEN (l_linenumber * 4) % 31 IN (16, 22) THEN NULL ELSE repeat('x', CAST(l_partkey % 40 AS INT)) END AS text FROM lineitem"""
_M = f"""e AS ({ENTITIES}), w AS ({WORDS}), pairs AS (SELECT w.page_id, w.word_id, e.entity_id, e.category, w.x, w.y, w.w, w.h,
  greatest(0, least(w.x + w.w, e.x + e.w) - greatest(w.x, e.x)) * greatest(0, least(w.y + w.h, e.y + e.h) - greatest(w.y, e.y)) AS area FROM w JOIN e USING (page_id)),
  m AS (SELECT *, area / (w * h) AS ratio FROM pairs WHERE w * h > 0 AND area / (w * h) >= 0.8)"""


def _boxes(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    d = spark.sql(sql.replace("FROM lineitem", "FROM {li}"), li=li)
    return d.withColumn("bbox", G.box(*map(F.col, "xywh"))).drop(*"xywh") if "x" in d.columns else d


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir, ENTITIES)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir, WORDS)


@query("overlap_area", f"WITH {_M} SELECT page_id, word_id, entity_id, CAST(area AS DOUBLE) AS area FROM pairs WHERE area > 0")
def overlap_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = words(spark, sf_dir).withColumnRenamed("bbox", "wb").join(entities(spark, sf_dir), "page_id")
    return j.select("page_id", "word_id", "entity_id", G.overlap_area(F.col("wb"), F.col("bbox")).alias("area")).where("area > 0")


@query("box_distance", f"WITH e AS ({ENTITIES}), w AS ({WORDS}) SELECT page_id, word_id, entity_id, round(sqrt(pow(greatest(w.x - e.x - e.w, e.x - w.x - w.w, 0), 2) + pow(greatest(w.y - e.y - e.h, e.y - w.y - w.h, 0), 2)), 6) AS distance FROM w JOIN e USING (page_id)")
def box_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = words(spark, sf_dir).withColumnRenamed("bbox", "wb").join(entities(spark, sf_dir), "page_id")
    return j.select("page_id", "word_id", "entity_id", F.round(G.distance(F.col("wb"), F.col("bbox")), 6).alias("distance"))


@query("word_entity_match", f"WITH {_M} SELECT page_id, word_id, entity_id, category, round(ratio, 6) AS ratio FROM m")
def word_entity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.match(words(spark, sf_dir), entities(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query("word_entity_match_grid", f"WITH {_M} SELECT page_id, word_id, entity_id, category, round(ratio, 6) AS ratio FROM m")
def word_entity_match_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.match_dense(words(spark, sf_dir), entities(spark, sf_dir), cell=64.0).withColumn("ratio", F.round("ratio", 6))


@query("word_assignment", f"WITH {_M} SELECT w.page_id, w.word_id, coalesce(string_agg(m.entity_id::VARCHAR, ',' ORDER BY m.entity_id), '') AS entity_ids FROM (SELECT DISTINCT * FROM w) w LEFT JOIN (SELECT DISTINCT page_id, word_id, entity_id FROM m) m ON w.page_id = m.page_id AND w.word_id = m.word_id GROUP BY w.page_id, w.word_id")
def word_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = words(spark, sf_dir).distinct()
    return layout.assign(w, layout.match(w, entities(spark, sf_dir).distinct()), ["page_id", "word_id"]).select("page_id", "word_id", F.array_join(F.transform("entity_ids", lambda x: x.cast("string")), ",").alias("entity_ids"))


@query("rescale_words", f"WITH w AS ({WORDS}) SELECT page_id, word_id, round(x * 1.25, 6) AS x, round(y * 1.5, 6) AS y, round(w * 1.25, 6) AS width, round(h * 1.5, 6) AS height FROM w")
def rescale_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = G.rescale(F.col("bbox"), F.lit(1.25), F.lit(1.5))
    return words(spark, sf_dir).select("page_id", "word_id", *[F.round(b[k], 6).alias(k) for k in ("x", "y", "width", "height")])


_F = "CASE WHEN category IN (26, 27) THEN 0.0005 ELSE 0.01 END"


@query("entity_size_filter", f"WITH e AS ({ENTITIES}) SELECT page_id, entity_id FROM e WHERE w >= CAST(floor({_F} * 6500) AS INT) AND h >= CAST(floor({_F} * 3500) AS INT)")
def entity_size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(spark, sf_dir).where(layout.big_enough(F.col("category"), F.col("bbox"), F.lit(6500.0), F.lit(3500.0))).select("page_id", "entity_id")


_EMPTY = ", ".join(map(str, S.EMPTY_ALLOWED))


@query("entity_emptiness", f"WITH {_M} SELECT page_id, entity_id FROM e WHERE category IN ({_EMPTY}) OR EXISTS (SELECT 1 FROM m WHERE m.page_id = e.page_id AND m.entity_id = e.entity_id)")
def entity_emptiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entities(spark, sf_dir)
    return layout.drop_empty(e, layout.match(words(spark, sf_dir), e), ["page_id", "entity_id"]).select("page_id", "entity_id")


@query("entity_trim", f"""WITH {_M} SELECT page_id, entity_id, CAST(min(x) AS INT) AS x, CAST(min(y) AS INT) AS y, CAST(floor(max(x + w)) AS INT) - CAST(floor(min(x)) AS INT) AS width,
  CAST(floor(max(y + h)) AS INT) - CAST(floor(min(y)) AS INT) AS height, (CAST(floor(max(x + w)) AS INT) - CAST(floor(min(x)) AS INT)) * (CAST(floor(max(y + h)) AS INT) - CAST(floor(min(y)) AS INT)) AS area FROM m GROUP BY page_id, entity_id""")
def entity_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = words(spark, sf_dir)
    return layout.trim(w, layout.match(w, entities(spark, sf_dir)), ["page_id", "entity_id"], ["page_id", "word_id"])


@query("entity_ids", f"WITH e AS ({ENTITIES}) SELECT DISTINCT sha1(concat('Entity(', page_id::VARCHAR, ',p,0,', category::VARCHAR, ',', x::BIGINT::VARCHAR, ',', y::BIGINT::VARCHAR, ',', w::BIGINT::VARCHAR, ',', h::BIGINT::VARCHAR, ')')) AS id FROM e")
def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ints = F.transform(F.array("bbox.x", "bbox.y", "bbox.width", "bbox.height"), lambda v: v.cast("bigint"))
    b = G.box(ints[0], ints[1], ints[2], ints[3])
    ids = entities(spark, sf_dir).select(layout.entity_id(F.col("page_id"), F.lit("p"), F.lit(0), F.col("category"), b).alias("id"))
    return layout.dedup(ids, "id")


@query("page_sets_differ", "SELECT DISTINCT l_orderkey AS doc_id FROM lineitem WHERE l_linenumber > 4")
def page_sets_differ(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_num"))
    return layout.pages_differ(p, p.where("page_num <= 4"))


@query("aspect_ratios", "SELECT l_orderkey, l_linenumber, abs(l_quantity / 50 - l_quantity / (50 + l_linenumber % 3)) <= 0.01 * greatest(l_quantity / 50, l_quantity / (50 + l_linenumber % 3)) AS same FROM lineitem")
def aspect_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "lineitem")
    return d.select("l_orderkey", "l_linenumber", layout.same_aspect(F.col("l_quantity"), F.lit(50.0), F.col("l_quantity"), 50 + F.col("l_linenumber") % 3).alias("same"))


def _groups_sql(pos: str, size: str, cross: str, extent: str, names: tuple[str, str, str, str]) -> str:
    p, s, c, x = names
    return f"""WITH c AS ({CELLS}), spots AS (SELECT DISTINCT table_id, {pos} AS spot FROM c),
  raw AS (SELECT a.table_id, a.spot, max(c.{pos}) AS pos, min(c.{size}) AS size, count(*) AS n_near FROM spots a JOIN c ON a.table_id = c.table_id AND abs(c.{pos} - a.spot) <= 5 GROUP BY 1, 2)
  SELECT r.table_id, r.spot AS group_{p}, min(c.{cross}) AS {c}, r.pos AS {p}, max(c.{cross} + c.{extent}) - min(c.{cross}) AS {x}, r.size AS {s}, r.n_near, count(*) AS n_cells
  FROM raw r JOIN c ON c.table_id = r.table_id AND c.{pos} <= r.pos + 2.5 AND c.{pos} + c.{size} >= r.pos + r.size - 2.5 GROUP BY r.table_id, r.spot, r.pos, r.size, r.n_near"""


@query("table_rows", _groups_sql("y", "h", "x", "w", ("y", "height", "x", "width")))
def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rows(_boxes(spark, sf_dir, CELLS), deal=True)


@query("table_columns", _groups_sql("x", "w", "y", "h", ("x", "width", "y", "height")))
def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.columns(_boxes(spark, sf_dir, CELLS), deal=True)


@query("cells_in_tables", f"""WITH c AS ({CELLS}), t AS (SELECT DISTINCT table_id AS page_id FROM c) SELECT t.page_id AS table_id, c.cell_id FROM c JOIN t ON c.table_id = t.page_id
  WHERE greatest(0, least(x + w, 120) - greatest(x, 0)) * greatest(0, least(y + h, 60) - greatest(y, 0)) = w * h""")
def cells_in_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _boxes(spark, sf_dir, CELLS).withColumnRenamed("table_id", "page_id")
    t = c.select("page_id").distinct().select("page_id", F.col("page_id").alias("table_id"), G.box(*map(F.lit, (0.0, 0.0, 120.0, 60.0))).alias("bbox"))
    return tables.cells_in_tables(c, t).select("table_id", "cell_id")


def _inferred_sql(name: str, cells: str, axes: tuple) -> str:
    """Groups of one of the four outputs, as (kind, table_id, at, lo, pos, length, size, n_near, n_cells)."""
    inner = _groups_sql(*axes).replace(f"c AS ({CELLS})", f"c AS (SELECT * FROM ({CELLS}) WHERE x + w <= 120 AND y + h <= 60{cells})")
    p, size, cross, extent = axes[4]
    return f"SELECT '{name}' AS kind, table_id, group_{p} AS at, {cross} AS lo, {p} AS pos, {extent} AS length, {size} AS size, n_near, n_cells FROM ({inner})"


_Y, _X = ("y", "h", "x", "w", ("y", "height", "x", "width")), ("x", "w", "y", "h", ("x", "width", "y", "height"))
_HEAD = " AND cell_id < 20000000000"
_INFERRED = (("table_row", "", _Y), ("table_column", "", _X), ("table_header_row", _HEAD, _Y), ("table_header_column", _HEAD, _X))


@query("table_inference", " UNION ALL ".join(_inferred_sql(*x) for x in _INFERRED))
def table_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of the body's and the header's cells."""
    c = _boxes(spark, sf_dir, CELLS).withColumnRenamed("table_id", "page_id")
    t = c.select("page_id").distinct().select("page_id", F.col("page_id").alias("table_id"), G.box(*map(F.lit, (0.0, 0.0, 120.0, 60.0))).alias("bbox"))
    found, out = tables.infer(c, c.where("cell_id < 20000000000"), t), None
    for name, _, (_, _, _, _, (pos, size, cross, extent)) in _INFERRED:
        own = found[name].select(F.lit(name).alias("kind"), "table_id", F.col(f"group_{pos}").alias("at"), F.col(cross).alias("lo"), F.col(pos).alias("pos"), F.col(extent).alias("length"), F.col(size).alias("size"), "n_near", "n_cells")
        out = own if out is None else out.unionByName(own)
    return out


_COUNT_SQL = ", ".join(f"CAST(count(*) FILTER (category = {k}) AS INT) AS num_{n}" for k, n in enumerate(S.ENTITY_NAMES))


@query("entity_counts_page", f"WITH e AS ({ENTITIES}) SELECT page_id, {_COUNT_SQL} FROM e GROUP BY page_id")
def entity_counts_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.entity_counts(entities(spark, sf_dir), ["page_id"])


@query("entity_counts_doc", f"WITH e AS (SELECT *, page_id % 100 AS doc FROM ({ENTITIES})) SELECT doc, {_COUNT_SQL} FROM e GROUP BY doc")
def entity_counts_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = quality.entity_counts(entities(spark, sf_dir), ["page_id"]).withColumn("doc", F.col("page_id") % 100)
    return quality.sum_counts(pages, "doc")


_PROP = f"""d AS ({DECISIONS}), p AS (SELECT doc_id, entity_id AS category, sum(CASE WHEN source IN ('builtin', 'xml_pattern') THEN coalesce(length(text), 1) ELSE 0 END) AS b, sum(coalesce(length(text), 1)) AS t FROM d GROUP BY 1, 2),
  props AS (SELECT doc_id, category, CASE WHEN t = 0 THEN 0 ELSE b / t END AS proportion FROM p)"""


@query("builtin_proportions", f"WITH {_PROP} SELECT doc_id, category, round(proportion, 6) AS proportion FROM props")
def builtin_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.builtin_proportions(_boxes(spark, sf_dir, DECISIONS)).withColumn("proportion", F.round("proportion", 6))


@query("quality_score", f"""WITH {_PROP}, n AS (SELECT l_orderkey AS doc_id, CAST((l_linenumber * 4) % 31 AS INT) AS category, count(*) AS n FROM lineitem GROUP BY 1, 2)
  SELECT doc_id, round(sum(CASE WHEN category IN (28, 17, 29) THEN 0 ELSE n * coalesce(proportion, 0) END) / sum(n), 6) AS annotation_quality_score FROM n LEFT JOIN props USING (doc_id, category) GROUP BY doc_id""")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = entities(spark, sf_dir).groupBy(F.col("page_id").alias("doc_id"), "category").agg(F.count("*").alias("n"))
    q = quality.quality_score(counts, quality.builtin_proportions(_boxes(spark, sf_dir, DECISIONS)))
    return q.withColumn("annotation_quality_score", F.round("annotation_quality_score", 6))


_BUCKET = "CASE WHEN entity_id = 10 AND source = 'builtin' THEN 'text_builtin' WHEN entity_id = 10 THEN 'text_fallback' ELSE source END"


@query("annotation_sources", f"WITH d AS ({DECISIONS}), b AS (SELECT *, {_BUCKET} AS bucket, coalesce(length(text), 0) AS n FROM d) SELECT doc_id, " + ", ".join(f"coalesce(sum(n) FILTER (bucket = '{s}'), 0)::BIGINT AS chars_{s}" for s in quality.SOURCES) + " FROM b GROUP BY doc_id")
def annotation_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.source_counts(_boxes(spark, sf_dir, DECISIONS))


@query("decision_source", f"WITH d AS ({DECISIONS}) SELECT doc_id, CASE WHEN source = 'builtin' AND NOT doc_id % 3 = 0 THEN 'builtin' ELSE 'content_aware_heuristic' END AS source, count(*) AS n FROM d GROUP BY 1, 2")
def decision_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _boxes(spark, sf_dir, DECISIONS)
    s = quality.was_builtin_source(F.col("source") == "builtin", F.col("doc_id") % 3 == 0, F.lit("content_aware_heuristic"))
    return d.groupBy("doc_id", s.alias("source")).agg(F.count("*").alias("n"))
