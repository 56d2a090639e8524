"""Folders of very many small files: written side by side, listed and read by tasks."""

import os

from pyspark.sql import functions as F

from sheafworks.sources import readers, sinks


def test_files_are_spread_over_folders_and_read_back(spark, tmp_path):
    rows = spark.range(500).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("page_id"), F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.col("id").cast("string"), F.lit("  0.5\r\n7 é\n\n"))).alias("content"))
    assert sinks.write_label_files(rows, str(tmp_path), fan_out=16) == 500
    found = [os.path.relpath(os.path.join(d, n), tmp_path) for d, _, names in os.walk(tmp_path) for n in names]
    assert len(found) == 500 and len({os.path.dirname(f) for f in found}) == 16 and all(os.path.basename(f)[0] == "p" for f in found)
    got = sorted((r.page_id, r["class"], r.line) for r in readers.yolo_labels(spark, str(tmp_path)).collect())
    assert got == sorted(x for i in range(500) if i % 4 for x in ((f"p{i}", i, f"{i} 0.5"), (f"p{i}", 7, "7 é")))


def test_files_are_not_listed_by_the_driver(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"a{i}.json").write_text("x" * i)
    (tmp_path / ".hidden").write_text("x")
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary/b.json").write_text("x")
    (tmp_path / "deep/er").mkdir(parents=True)
    (tmp_path / "deep/er/large c.json").write_bytes(b"y" * 3_000_000)
    d = readers.folder_members(spark, f"file://{tmp_path}")
    assert not d.inputFiles() and d.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    got = {r.member: (r.path, r.size, len(r.content)) for r in d.collect()}
    assert got == {f"a{i}.json": (f"file:{tmp_path}", i, i) for i in range(200)} | {"large c.json": (f"file:{tmp_path}/deep/er", 3_000_000, 3_000_000)}


def test_other_paths_go_through_spark(spark, tmp_path):
    (tmp_path / "x.txt").write_text("3 1")
    assert [tuple(r) for r in readers.yolo_labels(spark, f"{tmp_path}/*.txt").select("page_id", "class", "line").collect()] == [("x", 3, "3 1")]
