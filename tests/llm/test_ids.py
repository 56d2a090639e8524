"""Ids that pandas would turn into floats, null ids beside them, ids of other types, many rows of one id."""

import collections

import pytest
from pyspark.sql import functions as F

from sheafworks.llm import exact_dedup, packing

BIG = 1 << 60
ROWS = [(BIG + 1, "one text"), (BIG + 3, "another text"), (BIG + 5, "one text"), (None, "no id"), (None, "one text"), (BIG + 7, None)]


@pytest.mark.parametrize("cut", ["false", "true", f"doc_id < {BIG + 3}", f"doc_id > {BIG + 1}"])
@pytest.mark.parametrize("shard_digests", [1, 100])
def test_dedup_keeps_ids(spark, cut, shard_digests):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.copies) for r in exact_dedup.decide(df, F.expr(cut), shard_digests).collect())
    first = BIG + 5 if ">" in cut else BIG + 1  # the history's winner stays
    assert got == {(first, 3): 1, (BIG + 3, 1): 1, (None, 1): 1, (BIG + 7, 1): 1}


def test_history_of_several_shards(spark):
    """A small or empty history: shards follow from the new documents."""
    df = spark.createDataFrame([(i, f"text {i % 40}") for i in range(120)], "doc_id long, text string")
    for cut in (F.lit(False), F.col("doc_id") < 2):
        rows = exact_dedup.decide(df, cut, 5).collect()
        assert sorted((r.doc_id, r.copies) for r in rows) == [(i, 3) for i in range(40)]
    old = df.where("doc_id < 60").groupBy(exact_dedup._digest("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"))
    index = exact_dedup.build_index(old, 8)
    assert index.count() > 1
    new = df.where("doc_id >= 60").groupBy(exact_dedup._digest("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.lit(1).cast("bigint").alias("same"))
    for _ in range(2):  # the same index serves load after load
        assert all(r.member and r.winner == r.doc_id % 40 for r in exact_dedup.locate(index, new, 8).collect())


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string").withColumn("digest", F.lit(1)).withColumn("Winner", F.lit(2))
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == ["a", "c"]
    (b,) = packing.pack_documents(df).collect()
    assert sorted(zip(b.doc_ids, b.lengths), key=str) == [("a", 3), ("b", 3), ("c", 1), (None, 3)]


def test_packing_keeps_ids(spark):
    rows = packing.pack_documents(spark.createDataFrame(ROWS, "doc_id long, text string")).collect()
    assert collections.Counter(i for r in rows for i in r.doc_ids) == {BIG + 1: 1, BIG + 3: 1, BIG + 5: 1, None: 2}


def test_packing_spreads_equal_rows(spark):
    """Rows of one id and text, and rows of null id, don't gather in one shard."""
    df = spark.range(5_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("x" * 300).alias("text"))
    df = df.unionByName(spark.range(4_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("y" * 300), F.col("id").cast("string")).alias("text")))
    rows = packing.pack_documents(df, shard_chars=200_000).collect()
    n = collections.Counter()
    for r in rows:
        n[r.shard] += len(r.doc_ids)
        assert sum(r.lengths) == r.used <= r.capacity
    assert sum(n.values()) == 9_000 and max(n.values()) < 3_500 and sum(i is None for r in rows for i in r.doc_ids) == 4_000
