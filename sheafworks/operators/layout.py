"""Words and entities on pages: matching, filters, trimming, ids, consistency checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.functions import geometry as G

MIN_OVERLAP = 0.8
CELL = 256.0


def match(words: DataFrame, entities: DataFrame, page: str = "page_id", threshold: float = MIN_OVERLAP) -> DataFrame:
    """(word_id, entity_id, category, ratio) where at least ``threshold`` of a word lies in an entity of its page.

    ``words`` has word_id and bbox, ``entities`` entity_id, category and bbox. An equi-join on the page with the
    overlap as its residual condition.
    """
    w, e = words.alias("w"), entities.alias("e")
    ratio = G.overlap_ratio(F.col("w.bbox"), F.col("e.bbox"))
    j = w.join(e, (F.col(f"w.{page}") == F.col(f"e.{page}")) & (ratio >= threshold))
    return j.select(F.col(f"w.{page}").alias(page), "w.word_id", "e.entity_id", "e.category", ratio.alias("ratio"))


def _bins(b: Column, axis: str, size: str, cell: float) -> Column:
    lo, hi = F.floor(b[axis] / cell), F.floor((b[axis] + b[size]) / cell)
    return F.sequence(lo, hi)


def match_dense(words: DataFrame, entities: DataFrame, page: str = "page_id", threshold: float = MIN_OVERLAP, cell: float = CELL) -> DataFrame:
    """``match`` for pages with very many boxes: boxes meet in the cells of a grid; the cell of the word's first corner inside
    the entity decides, so no pair comes twice."""
    grid = lambda d, a: d.withColumn("gx", F.explode(_bins(F.col("bbox"), "x", "width", cell))).withColumn("gy", F.explode(_bins(F.col("bbox"), "y", "height", cell))).alias(a)
    w, e = grid(words, "w"), grid(entities, "e")
    a, b = F.col("w.bbox"), F.col("e.bbox")
    ratio = G.overlap_ratio(a, b)
    once = (F.floor(F.greatest(a["x"], b["x"]) / cell) == F.col("w.gx")) & (F.floor(F.greatest(a["y"], b["y"]) / cell) == F.col("w.gy"))
    on = (F.col(f"w.{page}") == F.col(f"e.{page}")) & (F.col("w.gx") == F.col("e.gx")) & (F.col("w.gy") == F.col("e.gy")) & once & (ratio >= threshold)
    return w.join(e, on).select(F.col(f"w.{page}").alias(page), "w.word_id", "e.entity_id", "e.category", ratio.alias("ratio"))


def assign(words: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Words with the ids and categories of their entities, in order of the entity's id; empty arrays without any."""
    m = matches.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("entity_id", "category"))).alias("_m"))
    none = F.coalesce(F.col("_m"), F.array().cast(m.schema["_m"].dataType))
    return words.join(m, keys, "left").withColumn("entity_ids", F.transform(none, lambda x: x["entity_id"])).withColumn("entity_categories", F.transform(none, lambda x: x["category"])).drop("_m")


def fraction(category: Column) -> Column:
    """The least share of the page's sides that an entity of the category must have."""
    small = [k for k, f in S.SIZE_FRACTION.items() if f == 5e-4]
    return F.when(category.isin(*small), 5e-4).otherwise(1e-2)


def big_enough(category: Column, b: Column, page_width: Column, page_height: Column) -> Column:
    f = fraction(category)
    return (b["width"] >= (f * page_width).cast("int")) & (b["height"] >= (f * page_height).cast("int"))


def drop_empty(entities: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Entities without a word go, unless their category may be empty."""
    allowed = entities.where(F.col("category").isin(*S.EMPTY_ALLOWED))
    rest = entities.where(~F.col("category").isin(*S.EMPTY_ALLOWED))
    return allowed.unionByName(rest.join(matches.select(*keys).distinct(), keys, "left_semi"))


def trim(words: DataFrame, matches: DataFrame, keys: list[str], word_keys: list[str]) -> DataFrame:
    """The envelope of each entity's words. x and y are truncated before the sides are taken, the id stays, the area is new."""
    w = matches.select(*keys, *[k for k in word_keys if k not in keys]).join(words.select(*word_keys, "bbox"), word_keys)
    b = F.col("bbox")
    env = w.groupBy(*keys).agg(F.min(b["x"]).cast("int").alias("x"), F.min(b["y"]).cast("int").alias("y"), F.max(b["x"] + b["width"]).cast("int").alias("_r"), F.max(b["y"] + b["height"]).cast("int").alias("_b"))
    return env.withColumn("width", F.col("_r") - F.col("x")).withColumn("height", F.col("_b") - F.col("y")).withColumn("area", F.col("width") * F.col("height")).drop("_r", "_b")


def entity_id(doc: Column, page: Column, number: Column, category: Column, b: Column) -> Column:
    return F.sha1(F.format_string("Entity(%s,%s,%s,%s,%s,%s,%s,%s)", doc, page, number, category, b["x"], b["y"], b["width"], b["height"]))


def dedup(entities: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows of one id are equal, so any may stay."""
    return entities.dropDuplicates([key])


def pages_differ(detected: DataFrame, parsed: DataFrame, doc: str = "doc_id", page: str = "page_num") -> DataFrame:
    """Documents whose detected and parsed pages aren't the same set."""
    a, b = detected.select(doc, page).distinct(), parsed.select(doc, page).distinct()
    return a.exceptAll(b).union(b.exceptAll(a)).select(doc).distinct()


def same_aspect(w1: Column, h1: Column, w2: Column, h2: Column, tolerance: float = 1e-2) -> Column:
    return G.is_close(w1 / h1, w2 / h2, tolerance)
