"""Exact dedup against a history, by minimal perfect hashing.

The history's distinct digests (SHA-256 of the text's UTF-8 bytes) are split over shards by their first bytes. Each
shard gets a minimal perfect hash (hash and displace): n digests ↔ n slots, a slot holding the full digest and the
winner's locator (its id). A new document looks its digest up: the slot that the hash names is compared with the digest
byte for byte, so a hit is certain and the document is a repeat of that winner; anything else isn't a member. Nonmembers
are grouped separately by digest, the lowest id of each group staying. Where a text repeats, the history's winner stays
before any new document.

The index is a table in the shared folder, a row a shard: later loads can be looked up in it again (``build_index``, ``locate``).
Shards hold about ``SHARD_DIGESTS`` digests, of the history or of the new documents, whichever has more; documents meet their
shard by a shuffle of (digest, id) only. Ids stay in Arrow columns of their own type all the way.

Defined results: null texts are no copies of anything and stay; empty texts are copies of each other; a null id ranks
last in its group; rows of one id and text are copies too, one of them stays; further columns are carried along untouched,
whatever their names. An empty history makes every document a nonmember. Ids may be of any type that has an order; where
they aren't integers, ``keep_first`` takes the history as empty.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.llm.names import free
from sheafworks.session import materialise, read_table

SHARD_DIGESTS = 50_000
_LOAD = 4  # digests a displacement bucket holds on average
_TRIES = 1 << 16


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest (not the first bytes, which chose the shard)."""
    w = np.ascontiguousarray(digests).view("<u8").reshape(len(digests), 4)
    return w[:, 1], w[:, 2]


class PerfectHash:
    """n distinct 32-byte keys ↔ the slots 0 … n-1, in about 4 bits a key and the slots themselves."""

    def __init__(self, n: int, buckets: int, seeds: np.ndarray, salt: int) -> None:
        self.n, self.buckets, self.seeds, self.salt = n, buckets, seeds, salt

    def slots(self, digests: np.ndarray) -> np.ndarray:
        a, b = _words(digests)
        bucket = (_mix(a + np.uint64(self.salt)) % np.uint64(self.buckets)).astype(np.int64)
        return (_mix(b + self.seeds[bucket].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        """Largest buckets first, each takes the first seed that puts its keys in free, different slots."""
        n = len(digests)
        a, b = _words(digests)
        for salt in range(64):
            buckets = max(1, n // _LOAD)
            bucket = (_mix(a + np.uint64(salt)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            size = np.bincount(bucket, minlength=buckets)
            start = np.concatenate([[0], np.cumsum(size)])
            seeds, taken = np.zeros(buckets, np.uint32), np.zeros(n, bool)
            if cls._place(b[order], size, start, seeds, taken):
                return cls(n, buckets, seeds, salt)
        raise RuntimeError("no perfect hash was found: are the digests distinct?")

    @staticmethod
    def _place(keys: np.ndarray, size: np.ndarray, start: np.ndarray, seeds: np.ndarray, taken: np.ndarray) -> bool:
        n = np.uint64(len(keys))
        step = np.uint64(0x9E3779B97F4A7C15)
        chunk = 64
        for k in np.argsort(-size, kind="stable"):
            m = size[k]
            if m == 0:
                break
            own, lo = keys[start[k] : start[k] + m], 0
            while True:
                tries = np.arange(lo, lo + chunk, dtype=np.uint64) * step
                at = (_mix(own[None, :] + tries[:, None]) % n).astype(np.int64)
                ok = ~taken[at].any(axis=1)
                if m > 1:
                    srt = np.sort(at, axis=1)
                    ok &= (srt[:, 1:] != srt[:, :-1]).all(axis=1)
                hit = np.flatnonzero(ok)
                if len(hit):
                    seeds[k] = lo + hit[0]
                    taken[at[hit[0]]] = True
                    break
                lo += chunk
                chunk = min(4096, chunk * 2)
                if lo > 64 * _TRIES:
                    return False
            chunk = 64
        return True

    def to_bytes(self) -> bytes:
        return struct.pack("<qqq", self.n, self.buckets, self.salt) + self.seeds.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n, buckets, salt = struct.unpack_from("<qqq", data)
        return cls(n, buckets, np.frombuffer(data, "<u4", buckets, 24), salt)


class Index:
    """A shard of the history: the hash, and slots of full digests and winner locators."""

    def __init__(self, hash: PerfectHash, digests: np.ndarray, winners: np.ndarray) -> None:
        self.hash, self.digests, self.winners = hash, digests, winners

    @classmethod
    def build(cls, digests: np.ndarray, winners: np.ndarray) -> Index:
        found = PerfectHash.build(digests)
        order = np.argsort(found.slots(digests))
        return cls(found, digests[order], winners[order])

    def lookup(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each digest is a member (all 32 bytes agree), and the slots."""
        at = self.hash.slots(digests)
        return (self.digests[at] == digests).all(axis=1), at


def _matrix(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, 32)


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(F.col(f"`{text_col}`"), 256))


def _shard(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, digests, winners), a row a shard: of (digest, doc_id), digests distinct, the hash function, the slots' digests
    and, slot by slot, the ids."""
    kind = history.schema["doc_id"].dataType.simpleString()

    def build(table: pa.Table) -> pa.Table:
        index = Index.build(_matrix(table["digest"]), np.arange(table.num_rows))
        winners = table["doc_id"].combine_chunks().take(pa.array(index.winners))
        offsets = pa.array([0, table.num_rows], pa.int32())
        columns = [table["shard"].combine_chunks()[:1], pa.array([index.hash.to_bytes()], pa.binary()), pa.array([index.digests.tobytes()], pa.binary()), pa.ListArray.from_arrays(offsets, winners)]
        return pa.Table.from_arrays(columns, names=["shard", "hash", "digests", "winners"])

    known = history.select("digest", "doc_id").withColumn("shard", _shard(shards))
    return known.groupBy("shard").applyInArrow(build, f"shard int, hash binary, digests binary, winners array<{kind}>")


def locate(index: DataFrame, new: DataFrame, shards: int) -> DataFrame:
    """The rows of ``new`` (digest, doc_id, n, same; digests distinct) with ``winner``, the locator in the slot that a member hits,
    and ``member``. ``index`` was built for as many shards."""
    kind = new.schema["doc_id"].dataType.simpleString()

    def look(old: pa.Table, docs: pa.Table) -> pa.Table:
        docs = docs.select(["digest", "doc_id", "n", "same"])
        member, winner = np.zeros(docs.num_rows, bool), pa.nulls(docs.num_rows, docs.schema.field("doc_id").type)
        if old.num_rows and docs.num_rows:
            digests = np.frombuffer(old["digests"][0].as_py(), np.uint8).reshape(-1, 32)
            shard = Index(PerfectHash.from_bytes(old["hash"][0].as_py()), digests, np.arange(len(digests)))
            member, at = shard.lookup(_matrix(docs["digest"]))
            winner = old["winners"][0].values.take(pa.array(shard.winners[at], mask=~member))
        return docs.append_column("member", pa.array(member)).append_column("winner", winner)

    left = index.groupBy("shard")
    right = new.select("digest", "doc_id", "n", "same").withColumn("shard", _shard(shards)).groupBy("shard")
    return left.cogroup(right).applyInArrow(look, f"digest binary, doc_id {kind}, n bigint, same bigint, member boolean, winner {kind}")


def decide(docs: DataFrame, is_history: Column, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """(doc_id, digest, copies, same, origin) of what stays; ``docs`` has doc_id and text.

    ``origin`` is ``history`` or ``new``; ``copies`` counts the rows that the winner stands for, itself included, and ``same``
    those of them with its id. Counts are combined before they are shuffled, so a text with very many copies is no hot key.
    """
    keyed = docs.select("doc_id", F.coalesce(is_history, F.lit(False)).alias("old"), _digest("text").alias("digest"))
    ids = keyed.groupBy("old", "digest", "doc_id").agg(F.count("*").alias("k"))
    known = ids.where("digest is not null").groupBy("old", "digest").agg(F.min("doc_id").alias("doc_id"), F.sum("k").alias("n"), F.coalesce(F.min_by("k", "doc_id"), F.max("k")).alias("same"))
    blank = ids.where("digest is null").select("old", "digest", "doc_id", F.col("k").alias("n"), F.col("k").alias("same"))
    groups = materialise(known.unionByName(blank), "digests")
    old, new = groups.where("old and digest is not null"), groups.where("not old and digest is not null")
    shards = max(1, -(-max(old.count(), new.count()) // shard_digests))
    index = materialise(build_index(old, shards), "perfect-hash")
    found = materialise(locate(index, new, shards), "located")
    repeats = found.where("member").select("digest", F.col("n").alias("m"))
    kept_old = old.join(repeats, "digest", "left").select("doc_id", "digest", (F.col("n") + F.coalesce("m", F.lit(0))).alias("copies"), "same", F.lit("history").alias("origin"))
    kept_new = found.where("not member").select("doc_id", "digest", F.col("n").alias("copies"), "same", F.lit("new").alias("origin"))
    # a null text is no copy: each such row stands for itself
    null_text = groups.where("digest is null").select("doc_id", "digest", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"), F.when(F.col("old"), "history").otherwise("new").alias("origin"))
    one = F.lit(1).cast("bigint")
    return kept_old.unionByName(kept_new).unionByName(null_text.select("doc_id", "digest", one.alias("copies"), one.alias("same"), "origin"))


def earlier_half(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The ids up to the middle of their range, as what an earlier load brought. Which rows stay doesn't depend on where the
    loads part, as ids rise from load to load. Ids that aren't integers have no middle: nothing is history then."""
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        return F.lit(False)
    r = docs.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).collect()[0]
    return F.lit(False) if r["lo"] is None else F.col(id_col) < F.lit((r["lo"] + r["hi"]) // 2)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_digests: int = SHARD_DIGESTS, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows that stay, with all their columns.

    Texts meet only the digests that have copies. These are broadcast if they are at most ``broadcast_rows`` (a row is some
    80 bytes), else both sides are shuffled.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    digest, winner, same = (free(x, docs.columns) for x in ("digest", "winner", "same"))
    several = materialise(decide(plain, earlier_half(plain), shard_digests).where("copies > 1").select(F.col("digest").alias(digest), F.col("doc_id").alias(winner), F.col("same").alias(same)), "copied")
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*own, _digest(text_col).alias(digest))
    met = rows.join(F.broadcast(several) if several.count() <= broadcast_rows else several, digest, "left")
    stay = met.where(F.col(same).isNull() | F.col(f"`{id_col}`").eqNullSafe(F.col(winner)))
    twice = several.where(F.col(same) > 1)
    if twice.isEmpty():
        return stay.select(*own)
    # rows of one id and text: one of them stays
    several_rows = stay.where(F.col(same) > 1).groupBy(digest).agg(F.first(F.struct(*own)).alias("row")).select("row.*")
    return stay.where(F.col(same).isNull() | (F.col(same) == 1)).select(*own).unionByName(several_rows)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decide(docs, earlier_half(docs)).select("doc_id", "origin")


SQL = """
WITH half AS (SELECT (min(doc_id) + max(doc_id)) // 2 AS mid FROM documents),
     groups AS (SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text
                UNION ALL SELECT doc_id FROM documents WHERE text IS NULL)
SELECT doc_id, CASE WHEN doc_id < mid THEN 'history' ELSE 'new' END AS origin FROM groups, half
"""
