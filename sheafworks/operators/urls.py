"""URL tables: merging, deduplication, ids, splitting into parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafworks.functions import url as U
from sheafworks.session import materialise


def merge_raw(*tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct URLs of several raw tables, and counts of rows before and after (one row)."""
    union = tables[0].select("url")
    for t in tables[1:]:
        union = union.unionByName(t.select("url"))
    return union.distinct(), union.agg(F.count("*").alias("n_rows"), (F.count_distinct("url") + F.max(F.col("url").isNull().cast("int"))).alias("n_distinct"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an explicit order (rows with a null key form one group)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def add_doc_ids(df: DataFrame, source: str, order: list[str]) -> DataFrame:
    """``source-000000000`` upwards within each source: positions in the whole order, less the source's first one, so a source
    may have any share of the rows."""
    pos = global_position(df, [source, *order], "_pos")
    first = pos.groupBy(source).agg(F.min("_pos").alias("_first")).withColumnRenamed(source, "_source")  # a row a source
    n = F.col("_pos") - F.col("_first")
    met = pos.join(F.broadcast(first), F.col(source).eqNullSafe(F.col("_source")))
    return met.withColumn("doc_id", F.concat(F.col(source), F.lit("-"), U.zero_filled(n, 9))).drop("_pos", "_first", "_source")


def clean(raw: DataFrame, source: str = "source", order: tuple[str, ...] = ("url",), drop_null_urls: bool = False) -> DataFrame:
    """Raw URLs (url, source) → doc_id, url, url_hash, source: one row for each raw URL's hash, ids before cleaning, URLs decoded
    and cut to the innermost document URL; what can't be cleaned is null and stays unless ``drop_null_urls``."""
    hashed = raw.withColumn("url_hash", U.url_hash(F.col("url")))
    first = add_doc_ids(keep_first(hashed, ["url_hash"], [source, *order]), source, list(order))
    out = first.withColumn("url", U.clean_url(U.unquote(F.col("url")))).select("doc_id", "url", "url_hash", source)
    return out.where("url is not null") if drop_null_urls else out


def not_seen(df: DataFrame, history: DataFrame, key: str = "url_hash") -> DataFrame:
    """Rows whose key isn't in the history; null keys stay."""
    return df.join(history.select(key).distinct(), key, "left_anti")


def global_dedup(df: DataFrame, history: DataFrame, source: str = "source", key: str = "url_hash") -> DataFrame:
    """Against all other crawls; an earlier output of the same crawl doesn't count. An empty history changes nothing."""
    own = df.select(F.col(source).alias("_own")).distinct()
    return not_seen(df, history.join(own, F.col(source) == F.col("_own"), "left_anti"), key)


def missing(required: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Distinct required keys without the processed ones."""
    return required.select(key).subtract(processed.select(key))


def global_position(df: DataFrame, order: list[str], name: str = "pos", totals: dict[str, str] | None = None) -> DataFrame:
    """Positions from 0 in a total order, without bringing all rows into one partition: rows are range-partitioned and each
    partition's rows are numbered after the sum of those before it. ``totals`` (name → column) are running totals, each row's own
    value included, got the same way.

    The range partitions are written once: their limits come from a sample that differs from one evaluation to the next, so
    numbers and offsets must be of the same partitions."""
    totals = totals or {}
    ranged = materialise(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{k}") for k, c in totals.items()])
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    before = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    offsets = sizes.select("_part", before("_n").alias("_before"), *[before(f"_sum_{k}").alias(f"_before_{k}") for k in totals])
    own = Window.partitionBy("_part").orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumn("_own", F.row_number().over(own))
    for k, c in totals.items():
        out = out.withColumn(k, F.sum(c).over(upto))
    out = out.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_own") - 1)
    for k in totals:
        out = out.withColumn(k, F.col(k) + F.col(f"_before_{k}"))
    return out.drop("_part", "_own", "_before", *[f"_before_{k}" for k in totals])


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, the same ones each time: those of the least digests of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def near_equal(df: DataFrame, order: list[str], parts: int, name: str = "part") -> DataFrame:
    """Contiguous parts from 0 in a total order, whose sizes differ by one at most, the longer ones first: positions, then the closed
    form, without a window over everything."""
    pos, n = global_position(df, order, "_pos"), df.agg(F.count("*").alias("_n"))
    d = pos.crossJoin(F.broadcast(n)).withColumn("_q", F.floor(F.col("_n") / parts)).withColumn("_r", F.col("_n") % parts)
    long = F.col("_r") * (F.col("_q") + 1)
    part = F.when(F.col("_pos") < long, F.floor(F.col("_pos") / (F.col("_q") + 1))).otherwise(F.col("_r") + F.floor((F.col("_pos") - long) / F.greatest("_q", F.lit(1))))
    return d.withColumn(name, part.cast("int")).drop("_pos", "_n", "_q", "_r")


def batches(df: DataFrame, order: list[str], item: str, size: int = 10) -> DataFrame:
    """(batch, items): the items in a total order, ``size`` at a time."""
    pos = global_position(df, order)
    sets = pos.groupBy(F.floor(F.col("pos") / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("pos", F.col(item).alias("item")))).alias("_i"))
    return sets.select("batch", F.transform("_i", lambda x: x["item"]).alias("items"))
