"""Rows and columns of tables from their cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.functions import geometry as G

TOLERANCE, COVER = 5.0, 2.5


def cells_in_tables(cells: DataFrame, tables: DataFrame, page: str = "page_id") -> DataFrame:
    """(table_id, cell_id) of cells that lie wholly in a table of their page."""
    c, t = cells.alias("c"), tables.alias("t")
    return c.join(t, (F.col(f"c.{page}") == F.col(f"t.{page}")) & G.contained(F.col("c.bbox"), F.col("t.bbox"))).select("t.table_id", "c.cell_id", "c.bbox")


def _groups(cells: DataFrame, table: str, pos: str, size: str, cross: str, extent: str, deal: bool = False) -> DataFrame:
    """A group for each distinct position of a table's cells: all cells at most TOLERANCE away (groups may share cells and are
    not merged); then the span from the greatest position over the least size takes in every cell that covers it, and the
    result reaches from the first to the last of these."""
    flat = cells.select(table, F.col("bbox.x").alias("x"), F.col("bbox.y").alias("y"), F.col("bbox.width").alias("width"), F.col("bbox.height").alias("height"))
    # with ``deal``, for cells that are stored: dealt out by table once, so that neither joins nor groups shuffle again, in a number of tasks that adaptive execution doesn't lower:
    # each sorts its cells several times at once
    spark = cells.sparkSession
    flat = flat if not deal else flat.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), table)
    at = flat.select(table, F.col(pos).alias("_at")).distinct()
    near = G.is_close(F.col(pos), F.col("_at"), 1e-9, TOLERANCE)
    a, b = at.alias("a"), flat.alias("b")
    raw = a.join(b, F.col(f"a.{table}") == F.col(f"b.{table}")).where(near).groupBy(F.col(f"a.{table}").alias(table), "_at").agg(F.max(pos).alias("_pos"), F.min(size).alias("_size"), F.count("*").alias("n_near"))
    r = raw.alias("r")
    covers = (F.col(f"b.{pos}") - COVER <= F.col("_pos")) & (F.col(f"b.{pos}") + F.col(f"b.{size}") + COVER >= F.col("_pos") + F.col("_size"))
    full = r.join(b, (F.col(f"r.{table}") == F.col(f"b.{table}")) & covers).groupBy(F.col(f"r.{table}").alias(table), "_at", "_pos", "_size", "n_near").agg(F.min(cross).alias("_lo"), F.max(F.col(cross) + F.col(extent)).alias("_hi"), F.count("*").alias("n_cells"))
    return full.select(table, F.col("_at").alias(f"group_{pos}"), F.col("_lo").alias(cross), F.col("_pos").alias(pos), (F.col("_hi") - F.col("_lo")).alias(extent), F.col("_size").alias(size), "n_near", "n_cells")


def rows(cells: DataFrame, table: str = "table_id", deal: bool = False) -> DataFrame:
    return _groups(cells, table, "y", "height", "x", "width", deal)


def columns(cells: DataFrame, table: str = "table_id", deal: bool = False) -> DataFrame:
    return _groups(cells, table, "x", "width", "y", "height", deal)


def infer(cells: DataFrame, headers: DataFrame, tables: DataFrame, page: str = "page_id") -> dict[str, DataFrame]:
    """Rows and columns of the body's cells and of the header's cells. (The header's are computed but, as in the
    data model, don't count as entities.)"""
    body, head = cells_in_tables(cells, tables, page), cells_in_tables(headers, tables, page)
    return {"table_row": rows(body), "table_column": columns(body), "table_header_row": rows(head), "table_header_column": columns(head)}
