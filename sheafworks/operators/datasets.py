"""Training sets: page selection, quotas, boxes, converters, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.functions import geometry as G
from sheafworks.functions.text import language_code, short_number
from sheafworks.operators.labels import Settings, class_map


def select_pages(pages: DataFrame, entities: DataFrame, s: Settings, page: str = "page_id") -> DataFrame:
    """Pages of sufficient quality, in an accepted language with sufficient score, with an entity of an accepted class (a merged
    entity counts as its master)."""
    p = pages.where(F.col("quality") >= s.quality_threshold)
    if s.language_codes:
        p = p.where(language_code(F.col("top_lang")).isin(*s.language_codes))
        if s.language_code_threshold > 0:
            p = p.where(F.col("top_lang_score") >= s.language_code_threshold)
    accepted = sorted({k for k in class_map(s)[1] if s.mapping.get(k, k) in s.elem_accepts})
    return p.join(entities.where(F.col("category").isin(*accepted)).select(page).distinct(), page, "left_semi")


def quota_sample(candidates: DataFrame, quotas: dict[int, int], max_img: int, order: Column, page: str = "page_id", category: str = "category") -> DataFrame:
    """Pages by quota, then a fill-up to ``max_img``.

    For each class up to its quota of the pages that hold it, in a fixed pseudo-random order; a page may serve several
    quotas and counts once. What is left of ``max_img`` is filled with further pages in the same order.
    """
    ordered = candidates.select(page, category).distinct().withColumn("_o", order)
    want = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]) if quotas else None
    picked = None
    if want is not None:
        w = Window.partitionBy(category).orderBy("_o", page)
        picked = ordered.where(F.col(category).isin(*quotas)).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= want[F.col(category)]).select(page).distinct()
    every = ordered.groupBy(page).agg(F.min("_o").alias("_o"))
    if picked is None:
        return every.orderBy("_o", page).limit(max_img).select(page, F.lit("fill").alias("chosen_by"))
    marked = every.join(picked.withColumn("_hit", F.lit(True)), page, "left")
    # quota pages all stay; the rest is numbered after them, so the fill-up is what still fits
    top = marked.where("_hit is null").orderBy("_o", page).limit(max_img)
    numbered = top.withColumn("_n", F.row_number().over(Window.orderBy("_o", page)))
    room = picked.agg(F.greatest(F.lit(max_img) - F.count("*"), F.lit(0)).alias("_room"))
    fill = numbered.crossJoin(F.broadcast(room)).where("_n <= _room").select(page, F.lit("fill").alias("chosen_by"))
    return picked.select(page, F.lit("quota").alias("chosen_by")).unionByName(fill)


def yolo_lines(entities: DataFrame, classes: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, class, line): ``class x y w h``, centre and size as shares of the page, each number cut to 10 characters."""
    e = entities.join(F.broadcast(classes.select("category", "class")), "category")
    b = G.yolo_box(F.col("bbox"), F.col("page_width"), F.col("page_height"))
    return e.select(page, "class", F.concat_ws(" ", F.col("class").cast("string"), *[short_number(b[k]) for k in ("cx", "cy", "w", "h")]).alias("line"))


def label_files(lines: DataFrame, page: str = "page_id") -> DataFrame:
    return lines.groupBy(page).agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("content"))


def label_report(lines: DataFrame, images: DataFrame, image: str = "page_id") -> DataFrame:
    """Distinct boxes by class over all images; class -1 counts the images without any."""
    by_class = lines.select(image, "class", "line").distinct().groupBy("class").agg(F.count("*").alias("n"))
    empty = images.select(image).distinct().join(lines.select(image).distinct(), image, "left_anti").agg(F.lit(-1).alias("class"), F.count("*").alias("n"))
    return by_class.unionByName(empty)


def layoutlm_rows(words: DataFrame, page: str = "page_id") -> DataFrame:
    """One row a page: tokens, word boxes, entity boxes and labels, in order of entity, then word.

    ``words`` has entity_pos, word_pos, text, bbox, entity_bbox and label.
    """
    item = F.struct("entity_pos", "word_pos", "text", G.corner_box(F.col("bbox")).alias("wb"), G.corner_box(F.col("entity_bbox")).alias("eb"), "label")
    d = words.groupBy(page).agg(F.array_sort(F.collect_list(item)).alias("_i"))
    get = lambda f: F.transform("_i", lambda x: x[f])
    return d.select(F.col(page).alias("id"), get("text").alias("tokens"), get("wb").alias("word_bboxes"), get("eb").alias("entity_bboxes"), get("label").alias("entity_labels"))


def coco_boxes(doc: DataFrame, first_class: int = 1) -> DataFrame:
    """COCO rows (images, annotations) → (file_name, class, cx, cy, w, h)."""
    images = doc.select(F.explode("images").alias("i")).select("i.*")
    notes = doc.select(F.explode("annotations").alias("a")).select("a.*")
    j = notes.join(images, notes["image_id"] == images["id"])
    b = G.box(*[F.col("bbox")[k] for k in range(4)])
    y = G.yolo_box(b, F.col("width"), F.col("height"))
    return j.select("file_name", (F.col("category_id") - first_class).alias("class"), y["cx"].alias("cx"), y["cy"].alias("cy"), y["w"].alias("w"), y["h"].alias("h"))


def table_cell_boxes(lines: DataFrame) -> DataFrame:
    """Table annotation lines (corner boxes of cells) → (split, filename, class 0, x, y, width, height); cells without a box
    and broken lines go."""
    c = lines.where("_corrupt_record is null").select("split", "filename", F.explode("html.cells").alias("c")).where("c.bbox is not null")
    b = G.from_corners(F.col("c.bbox"))
    return c.select("split", "filename", F.lit(0).alias("class"), b["x"].alias("x"), b["y"].alias("y"), b["width"].alias("width"), b["height"].alias("height"))


def first_n(df: DataFrame, order: Sequence[str], n: int, per: str | None = None) -> DataFrame:
    """The first n rows in an explicit order, of the whole or of each group; n of 0 or less keeps all."""
    if n <= 0:
        return df
    if per is None:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(per).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def move_to_validation(shards: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """All rows with ``split``: the n first in a fixed pseudo-random order are validation, the rest training."""
    picked = shards.select(key).distinct().orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n).withColumn("_val", F.lit(True))
    return shards.join(picked, key, "left").withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")
