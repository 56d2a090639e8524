"""LM scoring: an interpolated modified Kneser-Ney n-gram model over characters.

Counting is a Spark aggregation: every partition counts its own n-grams of the highest order in numpy, one row for each
that occurs there, and Spark adds those up; all documents are counted, whole. Continuation counts of the lower orders,
counts of counts, discounts, context totals and the interpolated probabilities are DataFrame aggregations and joins over
the distinct n-grams. The model is stored in the shared folder as arrays sorted by a 64-bit hash of the n-gram (order by
order, split into shards by the hash's leading bits), which workers map into memory; they look up whole batches at once.

A text is lower-cased, runs of white space and control characters become one space, and it is preceded by ``order - 1`` start symbols and followed by an end
symbol; ``perplexity = 10 ** (-log10 p / (characters + 1))``. For n-grams that begin with a start symbol raw counts stand
in place of continuation counts. Symbols that were never seen have the uniform share of the lowest order.

Defined results: null text has null scores and is not counted; an empty text is the end symbol alone; repeated rows are
counted each time and score alike; an empty table gives no row; ids may be null. Only the id and text columns are read.
Where counts of counts are too few for a discount's formula (tiny inputs), see ``discounts``.
"""

from __future__ import annotations

import json
import math
import os
import re
import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.session import local_path, materialise, work_uri

ORDER = 5
BOS, EOS = "\x02", "\x03"
SHARD_NGRAMS = 8_000_000  # n-grams in a file of the model
CHUNK = 2_000_000  # symbols a worker handles at once
_CONTROL = re.compile(r"[\x00-\x1f]")
_R = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def symbols(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the padded texts in a row, and each one's length with its padding."""
    clean = [" ".join(t.lower().split()) for t in texts]
    pad = BOS * (order - 1)
    codes = np.frombuffer("".join([f"{pad}{t}{EOS}" for t in clean]).encode("utf-32-le", "surrogatepass"), "<u4")
    lens = np.fromiter(map(len, clean), np.int64, len(clean)) + order
    if np.count_nonzero(codes < 32) != order * len(clean):  # control characters, which count as spaces
        return symbols([_CONTROL.sub(" ", t) for t in texts], order)
    return codes, lens


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position (from position n - 1 on)."""
    m = codes.astype(np.uint64)
    m = (m + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
    m ^= m >> np.uint64(32)
    h = np.zeros(len(m) - n + 1, np.uint64)
    for k in range(n):
        h = h * _R + m[k : len(m) - n + 1 + k]
    return _mix(h)


def _ends(lens: np.ndarray, order: int) -> np.ndarray:
    """Which n-grams of highest order end at a text's own symbols or its end symbol (their index is that of their start)."""
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    ok = np.ones(int(lens.sum()) - order + 1, bool)
    for k in range(1, order):  # those that begin in the text before
        at = starts[1:] - k
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def _chunks(texts: Iterator[str], limit: int = CHUNK) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def count_highest(df: DataFrame, text_col: str, order: int = ORDER) -> DataFrame:
    """(gram, n): counts over the whole table, combined first in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, grams = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, order), np.uint32)
        texts = (t for b in batches for t in b.column(0).to_pylist() if t is not None)
        for part in _chunks(texts):
            codes, lens = symbols(part, order)
            whole = np.flatnonzero(_ends(lens, order))
            for lo in range(0, len(whole), 2 * CHUNK):  # one window, unless a text is longer
                ok = whole[lo : lo + 2 * CHUNK]
                h = hashes(codes[ok[0] : ok[-1] + order], order)[ok - ok[0]]
                u, first, n = np.unique(h, return_index=True, return_counts=True)
                rows = codes[ok[first][:, None] + np.arange(order)]
                at = np.searchsorted(keys, u)
                old = at < len(keys)
                old[old] = keys[at[old]] == u[old]
                counts[at[old]] += n[old]
                new = ~old
                keys, counts, grams = np.insert(keys, at[new], u[new]), np.insert(counts, at[new], n[new]), np.insert(grams, at[new], rows[new], axis=0)
        for lo in range(0, len(keys), 100_000):
            strings = np.ascontiguousarray(grams[lo : lo + 100_000]).view(f"<U{order}").reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(counts[lo : lo + 100_000])], names=["gram", "n"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of an order from its counts of counts. Each follows its formula; one whose counts are missing, or that
    falls outside (0, its count), is the plain Kneser-Ney discount n1 / (n1 + 2 n2) instead, for itself alone (one half where no
    n-gram occurs once)."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = []
    for k, (n, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * more / n if n1 and n else -1.0
        out.append(d if 0 < d < k else y if y < 1 else 0.5)
    return out[0], out[1], out[2]


def _discount(d: tuple[float, float, float]) -> Column:
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


class Trained:
    """Where the model lies, with the little that workers need beside it."""

    def __init__(self, path: str, meta: dict) -> None:
        self.path, self.meta = path, meta


def train(spark: SparkSession, df: DataFrame, text_col: str = "text", order: int = ORDER) -> Trained:
    uri = work_uri(spark, "kn")
    path = local_path(uri)
    if path is None:
        raise ValueError("the shared folder must be mounted on the workers, which map the model into memory")
    os.makedirs(path, exist_ok=True)
    levels = {order: materialise(count_highest(df, text_col, order), "kn-counts")}
    for k in range(order - 1, 0, -1):
        up = levels[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.sum("n").alias("raw"), F.count("*").alias("kinds"))
        levels[k] = materialise(up.select("gram", F.when(F.col("gram").startswith(BOS), F.col("raw")).otherwise(F.col("kinds")).alias("n")), f"kn-counts-{k}")
    meta: dict = {"order": order, "shards": {}, "unknown": 0.0}
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        level = levels[k]
        stats = level.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)], F.count("*").alias("types")).collect()[0]
        d = discounts(stats["n1"], stats["n2"], stats["n3"], stats["n4"])
        cut = _discount(d)
        context = F.expr(f"substring(gram, 1, {k - 1})")
        totals = level.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(cut).alias("cut"))
        totals = totals.select("context", "total", (F.col("cut") / F.col("total")).alias("gamma"))
        own = level.withColumn("context", context).join(totals, "context").select("gram", ((F.col("n") - cut) / F.col("total")).alias("p"), "gamma")
        if k == 1:
            types = stats["types"] + 1  # the unknown symbol is one more
            scored = own.select("gram", (F.col("p") + F.col("gamma") / types).alias("p"))
            gamma = totals.collect()
            meta["unknown"] = math.log10(gamma[0]["gamma"] / types) if gamma else 0.0
        else:
            low = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            scored = own.withColumn("suffix", F.expr("substring(gram, 2)")).join(low, "suffix").select("gram", (F.col("p") + F.col("gamma") * F.col("q")).alias("p"))
        scored = materialise(scored, f"kn-p-{k}")
        meta["shards"][f"p{k}"] = _store(scored.select("gram", F.log10("p").alias("v")), path, f"p{k}", k, stats["types"])
        if k > 1:
            meta["shards"][f"g{k}"] = _store(totals.select(F.col("context").alias("gram"), F.log10("gamma").alias("v")), path, f"g{k}", k - 1, stats["types"])
        lower = scored
    with open(os.path.join(path, "meta.json"), "w") as f:
        json.dump(meta, f)
    return Trained(path, meta)


def _store(df: DataFrame, path: str, name: str, n: int, size: int) -> int:
    """Sorted arrays of hashes and values, one pair of files for each range of hashes; returns the leading bits that number them."""
    bits = max(0, math.ceil(math.log2(max(1, size / SHARD_NGRAMS))))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = b.column(0).to_pylist()
            if not grams:
                continue
            codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), "<u4")
            h = hashes(codes, n)[::n] if n else np.zeros(len(grams), np.uint64)
            shard = (h >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(h.view(np.int64)), b.column(1)], names=["shard", "h", "v"])

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        shard = int(pdf["shard"].iloc[0])
        for kind, values in (("h", h[order]), ("v", pdf["v"].to_numpy()[order].astype(np.float32))):
            target = os.path.join(path, f"{name}-{shard}-{kind}.npy")
            temporary = f"{target}.{uuid.uuid4().hex}.tmp"
            with open(temporary, "wb") as f:
                np.save(f, values)
            os.replace(temporary, target)  # a task that runs again leaves the same file
        return pd.DataFrame({"shard": [shard], "n": [len(h)]})

    df.mapInArrow(hashed, "shard int, h bigint, v double").groupBy("shard").applyInPandas(write, "shard int, n bigint").collect()
    return bits


class _Arrays:
    """One order's sorted arrays, mapped; batches are looked up by a start table over the hashes' leading bits."""

    def __init__(self, path: str, name: str, bits: int) -> None:
        self.bits, self.parts = bits, []
        for shard in range(1 << bits):
            at = os.path.join(path, f"{name}-{shard}-")
            if os.path.exists(at + "h.npy"):
                h, v = np.load(at + "h.npy", mmap_mode="r"), np.load(at + "v.npy", mmap_mode="r")
                b = max(0, min(22, int(math.log2(max(1, len(h)))) + 1))
                edges = (np.arange(1 << b, dtype=np.uint64) << np.uint64(64 - bits - b)) + (np.uint64(shard) << np.uint64(64 - bits) if bits else np.uint64(0)) if b else np.zeros(1, np.uint64)
                start = np.append(np.searchsorted(h, edges), len(h)).astype(np.int32)
                self.parts.append((h, v, b, start))
            else:
                self.parts.append(None)

    def get(self, q: np.ndarray) -> np.ndarray:
        """Values; NaN where the hash isn't there."""
        out = np.full(len(q), np.nan, np.float32)
        if not self.bits:
            self._get(self.parts[0], q, np.arange(len(q)), out)
            return out
        shard = (q >> np.uint64(64 - self.bits)).astype(np.int64)
        for s, part in enumerate(self.parts):
            if len(at := np.flatnonzero(shard == s)):
                self._get(part, q, at, out)
        return out

    def _get(self, part: tuple | None, q: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        if part is None or not len(part[0]):
            return
        h, v, b, start = part
        own = q[at] if len(at) != len(q) else q
        low = (own << np.uint64(self.bits)) >> np.uint64(64 - b) if b else np.zeros(len(own), np.uint64)
        pos, end = start[low], start[low.astype(np.int64) + 1]
        live = np.flatnonzero(pos < end)
        while len(live):
            p = pos[live]
            found = h[p] == own[live]
            hit = live[found]
            out[at[hit]] = v[p[found]]
            live = live[~found]
            pos[live] += 1
            live = live[pos[live] < end[live]]


class Model:
    def __init__(self, path: str, meta: dict) -> None:
        self.order, self.unknown = meta["order"], meta["unknown"]
        self.p = {k: _Arrays(path, f"p{k}", meta["shards"][f"p{k}"]) for k in range(1, self.order + 1)}
        self.g = {k: _Arrays(path, f"g{k}", meta["shards"][f"g{k}"]) for k in range(2, self.order + 1)}

    def log10(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability and number of symbols (end symbol included) of each text."""
        if not texts:
            return np.zeros(0), np.zeros(0, np.int64)
        n = self.order
        codes, lens = symbols(texts, n)
        at = np.flatnonzero(_ends(lens, n)) + n - 1  # positions of the predicted symbols
        score = np.zeros(len(at), np.float64)
        for lo in range(0, len(at), 2 * CHUNK):  # one window, unless a text is longer
            self._score(codes, at[lo : lo + 2 * CHUNK], score[lo : lo + 2 * CHUNK])
        sizes = lens - n + 1
        return np.add.reduceat(score, np.concatenate([[0], np.cumsum(sizes)[:-1]])), sizes


    def _score(self, codes: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        base = at[0] - self.order + 1
        codes, at = codes[base : at[-1] + 1], at - base
        live = np.arange(len(at))
        for k in range(self.order, 0, -1):
            got = self.p[k].get(hashes(codes, k)[at[live] - k + 1])
            there = ~np.isnan(got)
            score[live[there]] += got[there]
            live = live[~there]
            if not len(live):
                break
            if k > 1:
                back = self.g[k].get(hashes(codes, k - 1)[at[live] - k + 1])
                score[live] += np.where(np.isnan(back), 0.0, back)
            else:
                score[live] += self.unknown


def score(df: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, symbols, log10 probability and perplexity of each row."""
    path, meta = trained.path, trained.meta

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path, meta)
        for b in batches:
            texts = b.column(1).to_pylist()
            logs, sizes = np.full(len(texts), np.nan), np.zeros(len(texts), np.int64)
            todo, room = [], 0
            for i, t in enumerate(texts):
                if t is not None:
                    todo.append(i)
                    room += len(t)
                if todo and (room >= CHUNK or i == len(texts) - 1):
                    logs[todo], sizes[todo] = model.log10([texts[j] for j in todo])
                    todo, room = [], 0
            if todo:
                logs[todo], sizes[todo] = model.log10([texts[j] for j in todo])
            none = np.isnan(logs)
            ppl = np.power(10.0, -logs / np.maximum(sizes, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, mask=none), pa.array(logs, mask=none), pa.array(ppl, mask=none)], names=["doc_id", "n_symbols", "log10_prob", "perplexity"])

    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_symbols bigint, log10_prob double, perplexity double")


def discard(trained: Trained) -> None:
    shutil.rmtree(trained.path, ignore_errors=True)
