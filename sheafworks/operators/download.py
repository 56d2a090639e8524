"""Download gates and records. Fetching itself is a plug-in (see ``sources.fetch``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks.functions import url as U

FATAL = ("vba", "xlm", "flash", "encrypted", "ext_rels", "ObjectPool", "appname", "codepage")
HARMLESS = ("NONE", "INFO", "UNKNOWN", "ERROR")


def header_reason(status: Column, length: Column, content_type: Column, responded: Column) -> Column:
    """Why a HEAD response is turned down, null if it isn't: no response, status, length, then type."""
    return (
        F.when(~responded, F.lit("NoResponse"))
        .when(status != 200, F.format_string("HTTPError=%d", status))
        .when(U.content_length_error(length).isNotNull(), U.content_length_error(length))
        .when(~U.valid_content_type(content_type), F.concat(F.lit("InvalidContentType("), content_type, F.lit(")")))
    )


def body_reason(status: Column, true_length: Column, responded: Column, limit: int = U.MAX_HTTP_BYTES) -> Column:
    return F.when(~responded, F.lit("NoResponse")).when(status != 200, F.format_string("HTTPError=%d", status)).when(true_length > limit, F.format_string("FileSizeExceeded(%d)", true_length))


def maldoc_reason(indicators: Column) -> Column:
    """Of array<struct<id, risk, value>> the fatal ones as ``id=value``, joined by commas; '' if none."""
    bad = F.filter(indicators, lambda i: i["id"].isin(*FATAL) & ~F.upper(i["risk"]).isin(*HARMLESS))
    return F.array_join(F.transform(bad, lambda i: F.concat(i["id"], F.lit("="), i["value"])), ",")


def normalise_sources(df: DataFrame) -> DataFrame:
    """Stored records have only strings and ``None`` for missing ones: nulls instead, languages as an array."""
    out = df.select(*[F.nullif(F.col(c), F.lit("None")).alias(c) for c in df.columns])
    return out.withColumn("content_language", F.split("content_language", ",")) if "content_language" in df.columns else out


def rotate_shards(df: DataFrame, group: str, order: str, size: str, limit: int) -> DataFrame:
    """(group, order, size, shard): a shard closes after the row with which it exceeds the limit.

    The running sum restarts at each close, so rows are taken one after the other: tasks stream through their groups' rows in
    order and hold a batch of them.
    """
    kinds = df.select(group, order).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, shard, begun = None, 0, 0, False
        for b in batches:
            out = []
            for g, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if not begun or g != now:
                    now, total, shard, begun = g, 0, 0, True
                out.append(shard)
                total += n or 0
                if total > limit:
                    total, shard = 0, shard + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[group, order, size, "shard"])

    rows = df.select(group, order, F.col(size).cast("bigint").alias(size)).repartition(group).sortWithinPartitions(group, order)
    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), f"`{size}` bigint, shard int"]))
