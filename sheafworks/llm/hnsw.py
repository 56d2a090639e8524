"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Vectors are spread over cells by the nearest of some centroids, and a cell over shards of about ``shard_vectors`` by a hash of
the id. A task builds its shard's graph and stores it as flat arrays, a row of a table in the shared folder (any file system that
Spark writes): unit vectors, ids, and for every layer the neighbours of its members (a fixed number a row, -1 where there are
fewer). Layers are built from the top; who is inserted descends through the layers above to where it begins. A query goes
to the shards of its nearest cells, and the best k of all of them are its result. Search and insertion work on whole batches in
numpy: all queries of a batch take their steps together.

Centroids (spherical k-means) are fitted on a sample of at most ``SAMPLE`` vectors, those of the least hashes of their ids. On the
same sample, by brute force, the number of cells is found that ``PROBE_RECALL`` of the true neighbours are in: few where vectors
form clusters, nearly all where they don't. Every row is indexed.

Distance is 1 - cosine, to six decimals. A row is not its own neighbour.

Defined results: null, empty and all-zero vectors, vectors with null, NaN or infinite entries, and vectors of another length than
most (the commonest length; the shorter on a tie) are in no graph and have null neighbours; a null id likewise, and no ``queries``
condition holds for it unless it says so; rows of one id count once (the vector that sorts first); equal vectors are one node of a
graph, so of any number of them those of the lowest ids are returned, as for equal distances of different vectors that were
found; a table of n usable rows gives at most n - 1 neighbours; an empty table gives no row. Ids must be integers. Only the id
and vector columns are read, so others can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.session import materialise, read_table

M, EF_BUILD, EF_SEARCH, K = 16, 96, 96, 10
SHARD_VECTORS = 8_192
STEP = 4  # candidates expanded at a time
BATCH = 256  # queries that take their steps together
TASK_QUERIES = 4_096  # queries that a task takes through its shard
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
CELL_SAMPLE = 40  # vectors of the sample for each centroid, at least
PROBE_RECALL = 0.97


def _levels(ids: np.ndarray, m: int) -> np.ndarray:
    """A layer for each id, from a hash of it, so that building again gives the same graph."""
    h = (ids.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return np.floor(-np.log(u) / np.log(m)).astype(np.int64)


def beam(x: np.ndarray, nbr: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries q at once: positions (-1: none) and distances of the ef nearest found, nearest first.

    ``x`` are the layer's vectors, ``nbr`` its neighbour array, ``entry`` the positions to begin from, a row a query.
    """
    n, rows = len(q), np.arange(len(q))
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, -1] = True  # the position -1
    pos = np.full((n, ef), -1, np.int64)
    dist = np.full((n, ef), np.inf, np.float32)
    done = np.ones((n, ef), bool)

    def offer(at: np.ndarray, new: np.ndarray) -> None:
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1  # found through two candidates
        new = np.where(seen[at[:, None], new], -1, new)
        seen[at[:, None], new] = True
        d = 1 - np.matmul(x[new], q[at][:, :, None])[:, :, 0]
        d[new < 0] = np.inf
        p, dd, f = np.concatenate([pos[at], new], axis=1), np.concatenate([dist[at], d], axis=1), np.concatenate([done[at], new < 0], axis=1)
        best = np.argpartition(dd, ef - 1, axis=1)[:, :ef]
        r = np.arange(len(at))[:, None]
        pos[at], dist[at], done[at] = p[r, best], dd[r, best], f[r, best]

    offer(rows, entry)
    live = rows
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        some = np.isfinite(open_.min(axis=1))
        live, open_ = live[some], open_[some]
        if not len(live):
            break
        take = np.argpartition(open_, min(step, ef) - 1, axis=1)[:, :step]
        r = np.arange(len(live))[:, None]
        ok = np.isfinite(open_[r, take])
        done[live[:, None], take] |= ok
        found = np.where(ok[:, :, None], nbr[np.where(ok, pos[live[:, None], take], 0)], -1)
        offer(live, found.reshape(len(live), -1).astype(np.int64))
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(pos, order, 1), np.take_along_axis(dist, order, 1)


def _diverse(x: np.ndarray, cand: np.ndarray, dist: np.ndarray, m: int) -> np.ndarray:
    """Of each row's candidates (nearest first) those nearer to the row than to any chosen before, filled up with the rest."""
    b, c = cand.shape
    v = x[cand]
    between = 1 - np.matmul(v, v.transpose(0, 2, 1))
    chosen, barred, count = np.zeros((b, c), bool), cand < 0, np.zeros(b, np.int64)
    for k in range(c):
        ok = ~barred[:, k] & (count < m)
        chosen[ok, k] = True
        count += ok
        nearer = ok[:, None] & (between[:, k, :] < dist)
        nearer[:, : k + 1] = False
        barred |= nearer
    rank = np.where(chosen, 0, np.where(cand >= 0, 1, 2)) * c + np.arange(c)
    pick = np.argsort(rank, axis=1)[:, :m]
    out = np.take_along_axis(cand, pick, 1)
    return out if out.shape[1] == m else np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


def build_layer(x: np.ndarray, m: int, ef: int, above: list[np.ndarray] = ()) -> np.ndarray:
    """Neighbours of each vector, -1 where there are fewer than m: batches are inserted one after the other; each finds its
    neighbours in the graph so far, from where the layers above (top first, prefixes of this one) lead to, and in itself, and
    links back, pruned by the same rule."""
    n = len(x)
    nbr = np.full((n, m), -1, np.int32)
    first = min(n, max(2 * m, 256))
    lo, hi = 0, first
    while lo < n:
        own = x[lo:hi]
        inner = 1 - own @ own.T
        np.fill_diagonal(inner, np.inf)
        c = min(ef, hi - lo)
        near = np.argpartition(inner, c - 1, axis=1)[:, :c]
        cand, dist = near + lo, np.take_along_axis(inner, near, 1)
        if lo:
            entry = descend(x, above, own, 8)
            entry = np.where(entry < lo, entry, -1)  # upper layers know members that this one doesn't have yet
            entry = np.where((entry < 0).all(axis=1, keepdims=True), 0, entry)
            pos, d = beam(x[:lo], nbr[:lo], own, entry, ef)
            cand, dist = np.concatenate([pos, cand], axis=1), np.concatenate([d, dist], axis=1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :ef]
        cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
        cand = np.where(np.isfinite(dist), cand, -1)
        mine = _diverse(x, cand, dist, m)
        nbr[lo:hi] = mine
        # links back
        src = np.repeat(np.arange(lo, hi), m)
        dst = mine.reshape(-1)
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        targets, start, count = np.unique(dst, return_index=True, return_counts=True)
        for a in range(0, len(targets), 512):
            t, s, k = targets[a : a + 512], start[a : a + 512], count[a : a + 512]
            width = int(k.max())
            at = s[:, None] + np.arange(width)
            new = np.where(np.arange(width) < k[:, None], src[np.minimum(at, len(src) - 1)], -1)
            both = np.sort(np.concatenate([nbr[t].astype(np.int64), new], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            d = 1 - np.matmul(x[both], x[t][:, :, None])[:, :, 0]
            d[both < 0] = np.inf
            order = np.argsort(d, axis=1, kind="stable")[:, : 4 * m]
            both, d = np.take_along_axis(both, order, 1), np.take_along_axis(d, order, 1)
            nbr[t] = _diverse(x, np.where(np.isfinite(d), both, -1), d, m)
        lo, hi = hi, min(n, hi + max(256, min(1024, hi // 4)))
    return nbr


def descend(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray, ef: int) -> np.ndarray:
    """Positions to begin from, after a search through the layers (top first)."""
    entry = np.zeros((len(q), 1), np.int64)
    for nbr in layers:
        entry, _ = beam(x[: len(nbr)], nbr, q, entry, min(len(nbr), ef))
    return entry


class Graph:
    """Distinct unit vectors, the ids of each (ascending; ``starts`` says where each vector's begin) and the layers, top first."""

    def __init__(self, vectors: np.ndarray, starts: np.ndarray, ids: np.ndarray, layers: list[np.ndarray]) -> None:
        self.vectors, self.starts, self.ids, self.layers = vectors, starts, ids, layers

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, m: int = M, ef: int = EF_BUILD) -> Graph:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, inv, count = np.unique(vectors.view(f"V{vectors.shape[1] * 4}").reshape(-1), return_index=True, return_inverse=True, return_counts=True)
        level = _levels(ids[first], m)
        place = np.lexsort((ids[first], -level))  # upper layers are prefixes, so positions in a layer are rows of the vectors
        where = np.empty_like(place)
        where[place] = np.arange(len(place))
        ids = ids[np.argsort(where[inv.reshape(-1)], kind="stable")]
        starts = np.concatenate([[0], np.cumsum(count[place])]).astype(np.int64)
        x, level, layers = np.ascontiguousarray(vectors[first[place]]), level[place], []
        for k in range(int(level.max(initial=0)), -1, -1):
            layers.append(build_layer(x[: int((level >= k).sum())], 2 * m if k == 0 else m, ef, layers))
        return cls(x, starts, ids, layers)

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """ids and distances of the k nearest, nearest and lowest id first, for each row of q; -1 positions have infinite distance."""
        out_ids, out_d = np.full((len(q), k), -1, np.int64), np.full((len(q), k), np.inf)
        for lo in range(0, len(q), BATCH):
            part = q[lo : lo + BATCH]
            pos, d = beam(self.vectors, self.layers[-1], part, descend(self.vectors, self.layers[:-1], part, 8), max(ef, k))
            for r, (p, dist) in enumerate(zip(pos[:, :k], np.maximum(np.round(d[:, :k].astype(np.float64), 6), 0) + 0.0)):
                p, dist = p[p >= 0], dist[p >= 0]
                many = np.minimum(self.starts[p + 1] - self.starts[p], k)
                at = np.repeat(self.starts[p], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                i, dd = self.ids[at], np.repeat(dist, many)
                best = np.lexsort((i, dd))[:k]
                out_ids[lo + r, : len(best)], out_d[lo + r, : len(best)] = i[best], dd[best]
        return out_ids, out_d

    def arrays(self) -> dict:
        return {"dim": self.vectors.shape[1], "vectors": self.vectors.tobytes(), "starts": self.starts.tobytes(), "ids": self.ids.astype(np.int64).tobytes(), "layers": [x.tobytes() for x in self.layers], "widths": [x.shape[1] for x in self.layers]}

    @classmethod
    def of(cls, row: dict) -> Graph:
        """The graph over a stored row's flat arrays, which are read where they lie."""
        layers = [np.frombuffer(b, np.int32).reshape(-1, w) for b, w in zip(row["layers"], row["widths"])]
        return cls(np.frombuffer(row["vectors"], np.float32).reshape(-1, row["dim"]), np.frombuffer(row["starts"], np.int64), np.frombuffer(row["ids"], np.int64), layers)


STORED = "dim int, vectors binary, starts binary, ids binary, layers array<binary>, widths array<int>"


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.float32)
    return x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True).astype(np.float32)


def _centroids(x: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; a centroid that loses all its vectors stays where it was."""
    c = x[np.random.default_rng(5).permutation(len(x))[:cells]].copy()
    for _ in range(rounds if cells > 1 else 0):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = total[norm > 0] / norm[norm > 0, None]
    return c


def _probes(x: np.ndarray, c: np.ndarray, k: int, recall: float) -> int:
    """How many of a query's nearest cells hold ``recall`` of its k neighbours, over the sample."""
    q = x[np.random.default_rng(6).permutation(len(x))[:400]]
    sims = q @ x.T
    k = min(k + 1, len(x))
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    cell = (x @ c.T).argmax(axis=1)
    rank = np.argsort(np.argsort(-(q @ c.T), axis=1, kind="stable"), axis=1)
    found = np.take_along_axis(rank, cell[near], axis=1)
    return next(p for p in range(1, len(c) + 1) if (found < p).mean() >= recall)


class Index:
    """The graphs of a table, by cell and shard, with what a query needs to find its shards."""

    def __init__(self, df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, m: int = M, ef_build: int = EF_BUILD, shard_vectors: int = SHARD_VECTORS, probe_recall: float = PROBE_RECALL) -> None:
        if df.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
            raise TypeError(f"{id_col} must be of an integer type")
        d = df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<float>").alias("v"))
        self.rows = d
        sound = F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("v", lambda e: e != 0)
        sizes = d.where(sound).groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
        self.n = sizes[0]["n"] if sizes else 0
        self.good = F.coalesce(sound & (F.size("v") == (sizes[0]["dim"] if sizes else -1)), F.lit(False))
        if not self.n:
            return
        dim = sizes[0]["dim"]
        usable = d.where(self.good)
        repeated = usable.groupBy("vec_id").count().where("count > 1").select("vec_id")
        if not repeated.isEmpty():  # the only case in which vectors are shuffled before they go to their shards
            one = usable.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
            usable = usable.join(repeated, "vec_id", "left_anti").unionByName(one)
        few = max(1, min(SAMPLE, SAMPLE_BYTES // (4 * dim)))
        taken = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(few).select("v").toArrow()["v"].combine_chunks()
        x = _unit(taken.flatten().to_numpy().reshape(-1, dim))
        cells = max(1, min(-(-self.n // shard_vectors), len(x) // CELL_SAMPLE))
        self.centroids = c = _centroids(x, cells)
        self.probes = _probes(x, c, k, probe_recall)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = _unit(batch.column(1).flatten().to_numpy().reshape(-1, dim))
                    cell = (x @ c.T).argmax(axis=1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), _binary(x), pa.array(cell)], names=["vec_id", "v", "cell"])

        self.vectors = materialise(usable.mapInArrow(assign, "vec_id bigint, v binary, cell int"), "vectors")
        count = {r["cell"]: r["count"] for r in self.vectors.groupBy("cell").count().collect()}  # a row a centroid
        self.shards = [-(-count.get(i, 0) * 2 // (3 * shard_vectors)) for i in range(cells)]

        def build(table: pa.Table) -> pa.Table:
            vectors = np.frombuffer(b"".join(table["v"].to_pylist()), np.float32).reshape(-1, dim)
            g = Graph.build(table["vec_id"].to_numpy(), vectors, m, ef_build).arrays()
            return pa.Table.from_pylist([{"cell": table["cell"][0].as_py(), "shard": table["shard"][0].as_py()} | g], schema=_STORED)

        shard = F.pmod(F.xxhash64("vec_id"), F.array(*[F.lit(max(1, s)) for s in self.shards])[F.col("cell")]).cast("int")
        self.graphs = materialise(self.vectors.withColumn("shard", shard).groupBy("cell", "shard").applyInArrow(build, f"cell int, shard int, {STORED}"), "graphs")


_STORED = pa.schema([("cell", pa.int32()), ("shard", pa.int32()), ("dim", pa.int32()), ("vectors", pa.binary()), ("starts", pa.binary()), ("ids", pa.binary()), ("layers", pa.list_(pa.binary())), ("widths", pa.list_(pa.int32()))])
_FOUND = pa.schema([("vec_id", pa.int64()), ("found", pa.list_(pa.struct([("distance", pa.float64()), ("id", pa.int64())])))])


def _binary(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (4 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x, np.float32))])


def search(index: Index, queries: Column, k: int = K, ef_search: int = EF_SEARCH) -> DataFrame:
    """(vec_id, neighbours, distances) of the indexed rows for which ``queries`` (over vec_id) holds."""
    c, probes, shards = index.centroids, index.probes, index.shards

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, c.shape[1])
                cell = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
                at = pa.array(np.repeat(np.arange(len(x)), cell.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(cell.reshape(-1))], names=["vec_id", "v", "cell"])

    routed = index.vectors.where(queries).select("vec_id", "v").mapInArrow(route, "vec_id bigint, v binary, cell int")
    many = {r["cell"]: r["count"] for r in routed.groupBy("cell").count().collect()}  # a row a centroid
    pieces = F.array(*[F.lit(max(1, -(-many.get(i, 0) // TASK_QUERIES))) for i in range(len(c))])[F.col("cell")]
    top = F.array(*[F.lit(s - 1) for s in shards])[F.col("cell")]
    routed = routed.where(top >= 0).withColumn("piece", F.pmod(F.xxhash64("vec_id"), pieces).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), top)))
    graphs = index.graphs.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))

    def look(graph: pa.Table, asked: pa.Table) -> pa.Table:
        if not graph.num_rows or not asked.num_rows:
            return _FOUND.empty_table()
        row = graph.slice(0, 1)
        stored = {n: row[n][0].as_py() for n in ("dim", "layers", "widths")} | {n: row[n][0].as_buffer() for n in ("vectors", "starts", "ids")}
        q, own = np.frombuffer(b"".join(asked["v"].to_pylist()), np.float32).reshape(-1, stored["dim"]), asked["vec_id"].to_numpy()
        ids, d = Graph.of(stored).search(q, k + 1, ef_search)
        keep = (ids >= 0) & (ids != own[:, None])
        offsets = pa.array(np.concatenate([[0], np.cumsum(keep.sum(axis=1))]).astype(np.int32))
        found = pa.StructArray.from_arrays([pa.array(d[keep]), pa.array(ids[keep])], names=["distance", "id"])
        return pa.Table.from_arrays([pa.array(own), pa.ListArray.from_arrays(offsets, found)], schema=_FOUND)

    key = ("cell", "shard", "piece")
    met = graphs.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(look, "vec_id bigint, found array<struct<distance: double, id: bigint>>")
    best = met.groupBy("vec_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("best"))  # at most k + 1 a shard
    return best.select("vec_id", F.col("best.id").alias("neighbours"), F.col("best.distance").alias("distances"))


def neighbours(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, m: int = M, ef_build: int = EF_BUILD, ef_search: int = EF_SEARCH, shard_vectors: int = SHARD_VECTORS, probe_recall: float = PROBE_RECALL, queries: Column | None = None) -> DataFrame:
    """(vec_id, neighbours, distances): for each row for which ``queries`` (a condition on vec_id; all rows without it) holds the ids
    of its k nearest other rows, nearest first, and 1 - cosine."""
    index = Index(df, id_col, vector_col, k, m, ef_build, shard_vectors, probe_recall)
    asked = F.lit(True) if queries is None else queries
    none = index.rows.where(~index.good).where(asked).select("vec_id", F.lit(None).cast("array<bigint>").alias("neighbours"), F.lit(None).cast("array<double>").alias("distances"))
    return search(index, asked, k, ef_search).unionByName(none) if index.n else none


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 100 is a query, against all rows."""
    return neighbours(read_table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 100 == 0)
