"""Best-fit packing of documents into sequences of several permitted lengths.

Documents become segments: whole ones, and for those longer than the longest permitted length full-length chunks and a
rest, so no text is lost or cut away. Segments are spread over shards by a hash of id and text (their number grows with
the input; many equal rows are spread too) and each shard is packed by best fit, longest first: a segment goes to the open bin that it fills best; if
none has room, a new bin of the least-cost size is opened. Which size that is depends on what will join it, so the
sizes are optimised jointly: each candidate rule (the least cost per unit of room among the sizes up to a ceiling, for
every permitted ceiling) packs the shard, and the cheapest outcome stays. Last, each bin is downsized to the smallest
permitted length that holds its contents, before outcomes are compared.

The cost of a sequence of length c is ``c * (1 + c / quadratic_at)``: linear work, and attention's quadratic part that
equals it at ``quadratic_at``. Lengths are characters, so that ``substring(text, start + 1, length)`` is a segment.

Defined results: null and empty texts have no segment; a null id is packed like others (and kept null); repeated rows
are packed once each; ties go to the lower id, null last; an empty table gives no bin. Ids may be of any type that has an order,
and stay in Arrow columns of that type. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.session import read_table

CAPACITIES = (2048, 4096, 8192, 16384, 32768)
QUADRATIC_AT = 65536.0
SHARD_CHARS = 64 << 20  # characters a shard gets, about
TOGETHER = 1_000  # rows of equal id and text that go to one shard


def cost(c: float, quadratic_at: float = QUADRATIC_AT) -> float:
    return c * (1 + c / quadratic_at)


def _downsize(used: int, capacities: Sequence[int]) -> int:
    return next(c for c in capacities if used <= c)


def pack_once(lengths: Sequence[int], ceiling: int, capacities: Sequence[int] = CAPACITIES, quadratic_at: float = QUADRATIC_AT) -> tuple[list[int], list[int]]:
    """Best fit of lengths (longest first), new bins being of the sizes up to ``ceiling``: bin of each segment, contents of each bin.

    Of the sizes that hold the segment the one is opened whose cost is least for each character that can still come
    into it; a segment over the ceiling opens the smallest size that holds it. Open bins are kept by the room that
    is left: ``free`` has a bit for every amount of room that some bin has, so the tightest bin with enough room is
    the lowest set bit from the segment's length on.
    """
    sizes = [c for c in capacities if c <= ceiling]
    where, used = [0] * len(lengths), []
    by_room: dict[int, list[int]] = {}
    free, left = 0, int(sum(lengths))
    for k, n in enumerate(lengths):
        tail = free >> n
        if tail:
            r = n + (tail & -tail).bit_length() - 1
            b = heapq.heappop(by_room[r])
            if not by_room[r]:
                free &= ~(1 << r)
        else:
            r = _downsize(n, capacities) if n > ceiling else min((c for c in sizes if c >= n), key=lambda c: (cost(c, quadratic_at) / min(c, left), c))
            b = len(used)
            used.append(0)
        where[k] = b
        used[b] += n
        left -= n
        r -= n
        if r:
            if not by_room.get(r):
                by_room[r] = []
                free |= 1 << r
            heapq.heappush(by_room[r], b)
    return where, used


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, quadratic_at: float = QUADRATIC_AT) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the candidate packings: bin of each segment, contents and downsized capacity of each bin."""
    best = None
    for ceiling in capacities:
        where, used = pack_once(lengths, ceiling, capacities, quadratic_at)
        final = [_downsize(u, capacities) for u in used]
        total = sum(cost(c, quadratic_at) for c in final)
        if best is None or total < best[0]:
            best = (total, where, used, final)
    return best[1], best[2], best[3]


def segments(df: DataFrame, id_col: str, text_col: str, longest: int) -> DataFrame:
    """(doc_id, start, length, times, h): chunks of ``longest`` characters and a rest. Rows of equal id and text are one segment
    with ``times`` up to ``TOGETHER``, or several; ``h`` is for dealing segments out."""
    d = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.length(F.col(f"`{text_col}`")).alias("n"), F.xxhash64(F.col(f"`{text_col}`")).alias("h")).where("n > 0")
    d = d.groupBy("doc_id", "n", "h").agg(F.count("*").alias("k"))
    d = d.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("k") - 1) / TOGETHER))))
    d = d.withColumn("times", F.least(F.col("k") - F.col("lot") * TOGETHER, F.lit(TOGETHER)).cast("int"))
    d = d.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(longest))))
    length = F.least(F.col("n") - F.col("start"), F.lit(longest)).cast("int")
    return d.select("doc_id", F.col("start").cast("int").alias("start"), length.alias("length"), "times", F.xxhash64("doc_id", "start", "h", "lot").alias("h"))


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: Sequence[int] = CAPACITIES, quadratic_at: float = QUADRATIC_AT, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """A row for each bin: shard, bin, capacity, used, and its segments in order as arrays of ids, starts and lengths."""
    capacities = tuple(sorted(capacities))
    kind = df.schema[id_col].dataType.simpleString()
    total = df.agg(F.sum(F.length(F.col(f"`{text_col}`")).cast("bigint")).alias("n")).collect()[0]["n"] or 0
    shards = max(1, -(-total // shard_chars))
    segs = segments(df, id_col, text_col, capacities[-1]).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).drop("h")

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table["times"].to_numpy()))).combine_chunks()
        where, used, final = pack(table["length"].to_numpy().tolist(), capacities, quadratic_at)
        place = np.array(where)
        table = table.take(pa.array(np.argsort(place, kind="stable"))).combine_chunks()
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(used)))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, table[c].combine_chunks()) for c in ("doc_id", "start", "length")]
        scalars = [np.full(len(used), table["shard"][0].as_py()), np.arange(len(used)), final, used]
        return pa.Table.from_arrays([pa.array(x, pa.int32()) for x in scalars] + lists, names=["shard", "bin", "capacity", "used", "doc_ids", "starts", "lengths"])

    return segs.groupBy("shard").applyInArrow(one, f"shard int, bin int, capacity int, used int, doc_ids array<{kind}>, starts array<int>, lengths array<int>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
