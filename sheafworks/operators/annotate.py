"""The structured half of annotation: gates on documents, then words and entities to annotated pages, in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.config import Annotation
from sheafworks.functions import geometry as G
from sheafworks.functions import text as X
from sheafworks.operators import layout, quality, tables
from sheafworks.session import materialise

#: Categories whose boxes aren't trimmed to their words.
UNTRIMMED = [S.ENTITY_IDS[n] for n in ("table", "table_cell", "table_row", "table_column", "table_header", "table_header_cell", "table_header_row", "figure", "form_field")]


def reject_reason(docs: DataFrame, c: Annotation = Annotation()) -> DataFrame:
    """Parsed documents (column ``docx`` of ``sources.readers.documents``) with ``reason``, null for those that pass: readable,
    not inflated, not too many pages, enough text."""
    d = F.col("docx")
    reason = (
        F.when(d["error"].isNotNull(), d["error"])
        .when(d["ratio"] > c.max_decompress_ratio, F.lit("DecompressionBomb"))
        .when(d["pages"] > c.max_doc_pages, F.lit("TooManyPages"))
        .when(F.length(F.coalesce(d["text"], F.lit(""))) < c.min_text_chars, F.lit("TextTooShort"))
    )
    return docs.withColumn("reason", reason)


def split_failed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that go on, dead letters)."""
    return docs.where("reason is null").drop("reason"), docs.where("reason is not null")


def doc_records(docs: DataFrame, text: Column) -> DataFrame:
    """Documents with the columns of their text metrics."""
    return docs.select("*", *[c.alias(k) for k, c in X.metrics(text).items()])


@dataclass(frozen=True)
class Annotated:
    entities: DataFrame  # page_id, entity_id, category, bbox
    words: DataFrame  # … with entity_ids, entity_categories
    page_counts: DataFrame
    doc_counts: DataFrame


def annotate(words: DataFrame, entities: DataFrame, pages: DataFrame, c: Annotation = Annotation(), doc: str = "doc_id") -> Annotated:
    """``words``: page_id, word_id, bbox (in the document's units); ``entities``: page_id, entity_id, category, bbox (in pixels);
    ``pages``: page_id, doc_id, page_width, page_height (pixels), pdf_width, pdf_height.

    Words are scaled to pixels; entities are deduplicated and too small ones dropped; rows and columns of tables are added;
    words get their entities; entities without words go; the others are trimmed; then counted.
    """
    w = words.join(pages.select("page_id", (F.col("page_width") / F.col("pdf_width")).alias("_fx"), (F.col("page_height") / F.col("pdf_height")).alias("_fy")), "page_id")
    w = w.withColumn("bbox", G.rescale(F.col("bbox"), F.col("_fx"), F.col("_fy"))).drop("_fx", "_fy")
    e = layout.dedup(entities).join(pages.select("page_id", "page_width", "page_height"), "page_id")
    e = e.where(layout.big_enough(F.col("category"), F.col("bbox"), F.col("page_width"), F.col("page_height"))).select("page_id", "entity_id", "category", "bbox")
    # each of these is used several times below, so they are written once
    w, e = materialise(w, "words"), materialise(e, "boxes")
    e = materialise(e.unionByName(table_parts(e)), "entities")
    m = materialise(layout.match(w, e, threshold=c.word_2_entity_overlap_threshold), "matches")
    keys = ["page_id", "entity_id"]
    tagged = layout.assign(w, m, ["page_id", "word_id"])
    e = layout.drop_empty(e, m, keys)
    fixed, loose = e.where(F.col("category").isin(*UNTRIMMED)), e.where(~F.col("category").isin(*UNTRIMMED))
    small = layout.trim(w, m, keys, ["page_id", "word_id"])
    b = G.box(*[F.col(k).cast("double") for k in ("x", "y", "width", "height")])
    e = fixed.unionByName(loose.drop("bbox").join(small.select(*keys, b.alias("bbox")), keys).select("page_id", "entity_id", "category", "bbox"))
    e = materialise(e, "annotated")
    counts = quality.entity_counts(e, ["page_id"])
    none = {f"num_{n}": 0 for n in S.ENTITY_NAMES}
    page_counts = pages.select("page_id", doc).join(counts, "page_id", "left").na.fill(none)
    return Annotated(e, tagged, page_counts, quality.sum_counts(page_counts, doc))


def table_parts(entities: DataFrame) -> DataFrame:
    """Rows and columns of the tables as entities, whose ids are made of table, kind and position."""
    pick = lambda n: entities.where(F.col("category") == S.ENTITY_IDS[n])
    t = pick("table").withColumnRenamed("entity_id", "table_id")
    cells = pick("table_cell").withColumnRenamed("entity_id", "cell_id")
    inside = tables.cells_in_tables(cells, t)
    page = t.select("page_id", "table_id")
    out = None
    for name, groups, at in (("table_row", tables.rows(inside), "group_y"), ("table_column", tables.columns(inside), "group_x")):
        b = G.box(*[F.col(k) for k in ("x", "y", "width", "height")])
        part = groups.join(page, "table_id").select("page_id", F.sha1(F.concat_ws(":", F.col("table_id").cast("string"), F.lit(name), F.col(at).cast("string"))).alias("entity_id"), F.lit(S.ENTITY_IDS[name]).alias("category"), b.alias("bbox"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("entity_id", F.col("entity_id").cast(entities.schema["entity_id"].dataType)) if dict(entities.dtypes)["entity_id"] == "string" else out.withColumn("entity_id", F.conv(F.substring("entity_id", 1, 15), 16, 10).cast(entities.schema["entity_id"].dataType))


def selected_boxes(entities: DataFrame, pages: list[str] | None = None, categories: list[int] | None = None) -> DataFrame:
    """Boxes to look at: of some pages and categories, never rows and columns of tables."""
    hidden = [S.ENTITY_IDS[n] for n in ("table_row", "table_column")]
    out = entities.where(~F.col("category").isin(*hidden))
    out = out.where(F.col("page_id").isin(*pages)) if pages else out
    return out.where(F.col("category").isin(*categories)) if categories else out
