"""Positions of tables too large for a sample to hold all their rows."""

from pyspark.sql import functions as F

from sheafworks.operators.urls import global_position


def test_positions_are_those_of_the_order(spark):
    n = 400_000
    rows = spark.range(0, n, 1, 4).select(((F.col("id") * 7919) % n).alias("k"), (F.col("id") % 3).alias("w"), F.md5(F.col("id").cast("string")).alias("more"))
    got = global_position(rows, ["k"], "pos", {"upto": "w"})
    wrong = got.where("pos <> k").count()
    assert wrong == 0 and got.count() == n
    ends = got.agg(F.min("pos"), F.max("pos"), F.max("upto")).collect()[0]
    assert tuple(ends) == (0, n - 1, rows.agg(F.sum("w")).collect()[0][0])


def test_positions_of_nothing(spark):
    assert global_position(spark.range(0).select(F.col("id").alias("k")), ["k"]).count() == 0
