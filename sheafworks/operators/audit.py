"""Export and audit of downloads; log tables; progress rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.functions.logs import error_codes
from sheafworks.operators.urls import global_position, keep_last
from sheafworks.session import materialise


def export(records: DataFrame, exported: DataFrame, order: list[str]) -> DataFrame:
    """New documents: a real byte hash that wasn't exported, the last record of each, four columns."""
    new = records.where("bytehash is not null and bytehash <> 'None'").join(exported.select("bytehash").distinct(), "bytehash", "left_anti")
    return keep_last(new, ["bytehash"], order).select("url", "url_hash", "crawl_id", "bytehash")


def counters(required: DataFrame, processed: DataFrame, alive: DataFrame, key: str = "url_hash") -> DataFrame:
    """One row: required, processed, missing and alive, in total and distinct."""
    one = lambda df, name: df.agg(F.count("*").alias(f"n_{name}"), F.count_distinct(key).alias(f"n_{name}_distinct"))
    gone = required.select(key).subtract(processed.select(key)).agg(F.count("*").alias("n_missing"))
    return one(required, "required").crossJoin(one(processed, "processed")).crossJoin(one(alive, "alive")).crossJoin(gone)


def error_histogram(lines: DataFrame, col: str = "line") -> DataFrame:
    return lines.where(F.contains(F.col(col), F.lit("ERROR::"))).select(F.explode(error_codes(F.col(col))).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def worker_counters(lines: DataFrame, worker: str = "file", col: str = "line") -> DataFrame:
    """For each worker's log: terminations, downloads, failed batches; strange if downloads aren't whole hundreds."""
    hits = lambda text: F.sum(F.contains(F.col(col), F.lit(text)).cast("bigint"))
    out = lines.groupBy(worker).agg(hits("INFO::Regularly terminated worker").alias("n_terminated"), hits("INFO::downloading doc").alias("n_downloads"), hits("Batch handler error!").alias("n_batch_failures"))
    return out.withColumn("strange", F.col("n_downloads") % 100 != 0)


def last_fetched(lines: DataFrame, worker: str, order: str, col: str = "line") -> DataFrame:
    """For each success line the segment that the worker fetched last before it."""
    segment = F.when(F.col(col).startswith("Fetching "), F.substring(F.col(col), F.lit(10), F.length(col)))
    w = Window.partitionBy(worker).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("segment", F.last(segment, ignorenulls=True).over(w)).where(F.contains(F.col(col), F.lit("Success!"))).select(worker, order, "segment")


def sliding_rate(events: DataFrame, order: list[str], pages: str, start: str, now: str, rows: int = 200, partition: list[str] | None = None) -> DataFrame:
    """Pages of the last ``rows`` documents, and a second's share of them since the oldest's start (0 under a microsecond).

    A window ends at a row and begins at the one ``rows - 1`` before, which is met by its position; pages between are a
    difference of running totals. So a partition (or all rows, without any) may be of any size.
    """
    by = list(partition or [])
    placed = materialise(global_position(events, [*by, *order], "_pos", {"_total": pages}), "placed")
    keys = [F.col(c).alias(f"_key_{c}") for c in by]
    lead = placed.groupBy(*keys).agg(F.min("_pos").alias("_lead"))  # a row a partition
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    met = placed.join(F.broadcast(lead), same).withColumn("_at", F.greatest(F.col("_pos") - (rows - 1), F.col("_lead")))
    first = placed.select(F.col("_pos").alias("_at"), F.col(start).cast("timestamp").cast("double").alias("_start"), (F.col("_total") - F.coalesce(F.col(pages), F.lit(0))).alias("_rest"))
    d = met.join(first, "_at")
    total, span = F.col("_total") - F.col("_rest"), F.col(now).cast("timestamp").cast("double") - F.col("_start")
    out = d.withColumn("pages_in_window", total).withColumn("rate", F.when(span < 1e-6, 0.0).otherwise(total / F.greatest(span, F.lit(1e-6))))
    return out.drop("_at", "_pos", "_total", "_lead", "_start", "_rest", *[f"_key_{c}" for c in by])


def running_totals(events: DataFrame, order: list[str], pages: str, failed: str, partition: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(*(partition or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n, bad = F.count("*").over(w), F.sum(F.col(failed).cast("bigint")).over(w)
    return events.withColumn("n_docs", n).withColumn("n_pages", F.sum(pages).over(w)).withColumn("n_success", n - bad).withColumn("fail_prop", bad / n)
