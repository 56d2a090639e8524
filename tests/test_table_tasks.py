"""Rows and columns of tables: their cells are dealt out once, in tasks that stay small."""

from pyspark.sql import functions as F

from sheafworks.functions import geometry as G
from sheafworks.operators import tables


def test_cells_are_dealt_out_by_table_alone(spark):
    k = F.col("id")
    cells = spark.range(4000).select((k % 700).alias("table_id"), G.box((k % 3 * 50).cast("double"), (k % 4 * 20).cast("double"), F.lit(45.0), F.lit(18.0)).alias("bbox"))
    got = tables.rows(cells, deal=True)
    assert got.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism  # not lowered by adaptive execution
    assert "hashpartitioning(table_id" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "hashpartitioning(table_id#" in plan and "_at" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
    assert got.agg(F.sum("n_near")).first()[0] == 4000
