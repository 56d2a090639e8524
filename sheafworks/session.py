"""Session factory and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def get_session(app: str = "sheafworks", master: str | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_uri(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a single machine) is a temporary folder made, and it
    becomes the session's checkpoint folder.
    """
    uri = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if uri:
        return uri.rstrip("/")
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="sheafworks-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{path}")
    return f"file://{path}"


def work_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the shared folder."""
    shared_uri(spark)
    return f"{shared_uri(spark)}/sheafworks/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path on a mounted shared folder; None for other stores."""
    u = urlparse(uri)
    if u.scheme in ("", "file"):
        return u.path
    return None


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialise(df, name: str):
    """Writes a DataFrame as Parquet into the shared folder and reads it back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    uri = work_uri(spark, name)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def read_spread(spark: SparkSession, sf_dir: str, name: str):
    """A table for work that takes much longer than reading: one that is read in fewer tasks than there are cores is dealt out
    to all of them. Tables of many files aren't moved."""
    df = read_table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df
