"""Documents are taken in slices, and parsed once."""

import pyarrow as pa
from pyspark.sql import functions as F

from sheafworks.plans import documents as D
from sheafworks.sources import readers, wordml


def test_slices_hold_few_rows():
    b = pa.RecordBatch.from_arrays([pa.array(range(450))], names=["i"])
    assert [x.num_rows for x in readers.slices([b, b.slice(0, 0)])] == [200, 200, 50]


def test_filters_on_the_result_parse_once(spark):
    df = spark.createDataFrame([(i, bytearray(D.word_document(i, "user", "hello") if i % 3 else b"no") if i % 5 else None) for i in range(450)], "id int, content binary")
    d = readers.documents(df).where("docx.error is null").where("docx.pages > 3").select("id", "docx.pages", "docx.ratio")
    assert d._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.id, r.pages) for r in d.collect()) == [(i, i % 200) for i in range(450) if i % 3 and i % 5 and i % 200 > 3]
    marks = wordml.remove_highlights(df).select("id", wordml.has_highlights(F.col("content")).alias("m")).union(df.select(-F.col("id"), wordml.has_highlights(F.col("content"))))
    assert {r.id for r in marks.where("m").collect()} == {-i for i in range(450) if i % 3 and i % 5}
