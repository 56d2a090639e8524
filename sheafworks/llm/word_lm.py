"""LM scoring: an interpolated modified Kneser-Ney n-gram model over words.

The model is that of ``kn_lm`` (counts, continuation counts, discounts, interpolation) with words as symbols. A text is
lower-cased and split at white space, preceded by ``order - 1`` start symbols and followed by an end symbol. A word is its
64-bit hash. All documents are counted, whole.

Word n-grams grow with the corpus, so no worker holds the model and it is never stored: the n-grams of highest order, one a
position, go once to shards by the word before the last, and as a context ends with that word, a shard has all that counts
for its positions in all orders above the first. Each shard works twice on what it got: first it counts (counts of counts
and the words that follow, whose continuation counts and probabilities are then taken over all shards), then it scores, and
only sums by document leave it. Where one word is before too many positions (``_Plan.hot``), these go by the two words
before, and so on, down to the whole n-gram and the document; the orders up to there (``depth``) are then counted over all
shards as words are. What is hot and which words get short codes is taken from a sample; neither changes a result.

Workers are reused and stand beside an executor's heap, so each holds no more than it needs at a time: texts, the sample and the
orders of a shard are taken one after the other, and what a task frees goes back to the system (``_freed``).

``perplexity = 10 ** (-log10 p / (words + 1))``. For n-grams that begin with a start symbol raw counts stand in place of
continuation counts. Words that were never seen have the uniform share of the lowest order.

Defined results: null text has null scores and is not counted; an empty text is the end symbol alone; repeated rows are
counted each time and score alike; an empty table gives no row; ids may be null. Only the id and text columns are read.
Where counts of counts are too few for a discount's formula (tiny inputs), see ``kn_lm.discounts``.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.llm.kn_lm import ORDER, _chunks, _ends, _mix, discounts
from sheafworks.session import read_spread

WIDTH = 8  # bytes of a word in an n-gram
BOS, EOS = 0, 1
SHARD = 2_000_000  # positions in a shard
CHUNK = 1_000_000  # positions that a worker packs at once
SAMPLE, SAMPLE_CHARS = 10_000, 20_000  # texts, and characters of each, that the plan is made from
CODES = 1 << 19  # words with a short code at most
ROWS = 2048  # rows that are Python objects at once
_R = np.uint64(0x9E3779B97F4A7C15)
_BYTES = _mix(np.arange(1, 65537, dtype=np.uint64) * _R)  # a number for each byte at each of 256 places


def _hashes(joined: str) -> np.ndarray:
    """Hash of each word of a string of words with a space between each two."""
    if not joined:
        return np.zeros(0, np.uint64)
    buf = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    space = np.flatnonzero(buf == 32)
    start = np.concatenate([[0], space + 1])
    at = np.arange(len(buf)) - np.repeat(start, np.diff(np.append(start, len(buf) + 1)))[: len(buf)]
    v = _BYTES[((at & 255) << 8) | buf]
    if at.max() > 255:
        v *= (2 * (at >> 8) + 1).astype(np.uint64)
    v[space] = 0
    return np.maximum(_mix(np.add.reduceat(v, start)), np.uint64(2))  # 0 and 1 are the start and the end


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library


def _release() -> None:
    """Gives free memory back to the system, which would otherwise count as the worker's until its next task."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _freed(run: Callable) -> Callable:
    """The same function of a partition, that gives its memory back at the end."""

    def outer(*args: object) -> Iterator:
        yield from run(*args)
        _release()

    return outer


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS))


class _Words(dict):
    """Hash of each word."""

    def __missing__(self, word: str) -> int:
        return int(_hashes(word)[0])


def symbols(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the padded texts in a row, and each one's length with its padding."""
    words = [t.lower().split() for t in texts]
    n = np.fromiter(map(len, words), np.int64, len(words))
    lens = n + order
    ends = np.cumsum(lens)
    codes = np.full(int(lens.sum()), BOS, np.uint64)
    codes[np.arange(n.sum()) + np.repeat(ends - lens + order - 1 - np.cumsum(n) + n, n)] = _hashes(" ".join(chain.from_iterable(words)))
    codes[ends - 1] = EOS
    return codes, lens


def _step(h: np.ndarray | None, word: np.ndarray) -> np.ndarray:
    """Hash of words one by one, from that of those so far."""
    own = _mix((word + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93))
    return own if h is None else _mix(h * _R + own)


def _groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct values, in order: the value, one place of it; the number of each row's value."""
    o = np.argsort(h)
    s = h[o]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inverse = np.empty(len(h), np.int32)
    inverse[o] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return s[new], o[new], inverse


def _pieces(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal numbers."""
    start = np.flatnonzero(np.diff(x, prepend=-1))
    return zip(start.tolist(), [*start[1:].tolist(), len(x)][: len(start)], strict=True)


_CODEC = pa.Codec("zstd", 1)


def _pack(x: np.ndarray) -> tuple[str, int, bytes]:
    """An array's bytes by place, compressed: high ones are mostly alike."""
    return x.dtype.str, len(x), _CODEC.compress(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes(), asbytes=True)


def _unpack(packed: tuple[str, int, bytes]) -> np.ndarray:
    kind, n, data = packed
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(_CODEC.decompress(data, n * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, n).T).view(kind).reshape(-1)


class _Plan:
    """Number of shards, contexts (hashes of the words before, from the last on, by their number) that are too frequent for one
    shard, and the words with short codes (sorted hashes, and the code of each)."""

    def __init__(self, order: int, shards: int, hot: list[np.ndarray], words: np.ndarray) -> None:
        self.order, self.shards, self.hot, self.words = order, shards, hot, words
        self.sorted = np.argsort(words)
        self.depth = 1 + next((k for k in range(order - 1, 0, -1) if len(hot[k - 1])), 0)

    def place(self, hashes: np.ndarray, ids: list[np.ndarray], row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and depth of n-grams; ids: which hash is each of their words', from the last on."""
        depth = np.ones(len(row), np.int8)
        own = _step(None, hashes)
        shard = (_mix(own * _R) % np.uint64(self.shards)).astype(np.int32)[ids[min(1, self.order - 1)]]
        if self.depth == 1:
            return shard, depth
        live = np.flatnonzero(np.isin(own, self.hot[0])[ids[1]])
        path = own[ids[1][live]]
        for d in range(1, self.order):
            path = _step(path, hashes[ids[d + 1][live]]) if d + 1 < self.order else _step(_step(path, hashes[ids[0][live]]), row[live].view(np.uint64))
            shard[live], depth[live] = (_mix(path * _R) % np.uint64(self.shards)).astype(np.int32), d + 1
            if d + 1 == self.order:
                break
            deeper = np.isin(path, self.hot[d])
            live, path = live[deeper], path[deeper]
        return shard, depth


class _Tally:
    """How often each value comes, of arrays that come one by one; values in order."""

    def __init__(self) -> None:
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, x: np.ndarray) -> None:
        u, n = np.unique(x, return_counts=True)
        values, n = np.concatenate([self.values, u]), np.concatenate([self.counts, n])
        self.values, inverse = np.unique(values, return_inverse=True)
        self.counts = np.bincount(inverse, n, len(self.values)).astype(np.int64)


def _plan(df: DataFrame, text_col: str, order: int, shard: int) -> _Plan:
    text = F.col(text_col)
    n, chars = df.where(text.isNotNull()).agg(F.count("*"), F.sum(F.length(text).cast("bigint"))).first()
    part = df.where(text.isNotNull()).select(F.substring(text, 1, SAMPLE_CHARS).alias("t"))
    part = part.sample(min(1.0, 1.2 * SAMPLE / n), seed=1) if n > SAMPLE else part
    if not n:
        return _Plan(order, 1, [np.zeros(0, np.uint64)] * (order - 1), np.array([BOS, EOS], np.uint64))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, found, seen = [], 0, 0, _Tally()
        seen.add(np.array([BOS, EOS], np.uint64))
        for b in _slices(batches):
            for texts in _chunks(iter(b.column(0).to_pylist())):
                codes, lens = symbols(texts, order)
                parts.append((codes, np.flatnonzero(_ends(lens, order)).astype(np.int32) + np.int32(order - 1)))
                size += sum(map(len, texts))
                found += len(parts[-1][1])
                seen.add(codes)
        total = int(max(found, (chars or 0) * (found / max(1, size)), n))
        most, hot = 0.75 * shard / total * found, []
        for d in range(1, order):
            here = _Tally()
            for codes, ok in parts if d == 1 or len(hot[-1]) else ():
                path = None
                for k in range(1, d + 1):
                    path = _step(path, codes[ok - k])
                    if k < d:
                        keep = np.isin(path, hot[k - 1])
                        ok, path = ok[keep], path[keep]
                here.add(path)
            hot.append(here.values[here.counts > most])
        x = pickle.dumps((-(-total // shard), hot, seen.values[np.argsort(-seen.counts, kind="stable")][:CODES]), 5)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary())], names=["x"])

    return _Plan(order, *pickle.loads(part.limit(SAMPLE).repartition(1).mapInArrow(_freed(look), "x binary").first()[0]))


def _bundles(plan: _Plan, codes: np.ndarray, at: np.ndarray, row: np.ndarray, counted: bool) -> Iterator[tuple[int, dict]]:
    """Shard and packed n-grams that end at places of a stream of words."""
    u, _, inverse = _groups(codes)
    near = np.minimum(np.searchsorted(plan.words, u, sorter=plan.sorted), len(plan.words) - 1)
    code = plan.sorted[near].astype(np.uint32)
    rare = np.flatnonzero(plan.words[code] != u)
    code[rare] = len(plan.words) + np.arange(len(rare), dtype=np.uint32)
    ids = code[inverse]
    words = u[rare]
    columns = [ids[at - k] for k in range(plan.order)]
    hashes = np.concatenate([plan.words, words])
    shard, depth = plan.place(hashes, columns, row)
    group = shard.astype(np.int64) * (plan.order + 1) + depth
    near = group.astype(np.uint64)
    for x in columns[1:3]:  # by the words before, for the sake of compression
        near = (near << np.uint64(20)) | np.minimum(x, (1 << 20) - 1)
    o = np.argsort(near)
    group = group[o]
    base = int(row.min()) if len(row) else 0
    for lo, hi in _pieces(group):
        k = o[lo:hi]
        used = np.zeros(len(hashes) - len(plan.words), bool)
        own = [x[k] for x in columns]
        for x in own:
            used[x[x >= len(plan.words)] - len(plan.words)] = True
        new = np.concatenate([np.arange(len(plan.words), dtype=np.uint32), len(plan.words) + np.cumsum(used, dtype=np.uint32) - np.uint32(1)]) if used.any() else None
        gap = row[k] - base
        gap = gap.astype(np.uint32) if not len(gap) or gap.max() < 1 << 32 else gap
        yield (
            int(group[lo] // (plan.order + 1)),
            {"depth": int(group[lo] % (plan.order + 1)), "counted": counted, "rare": _pack(words[used]), "words": [_pack(x if new is None else new[x]) for x in own], "row": _pack(gap), "base": base},
        )


def _same(key: int) -> int:
    return key


def _spread(df: DataFrame, run: Callable, shards: int) -> RDD:
    """What a function of Arrow batches makes, pairs of shard and object, by shard."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, x in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pickle.dumps(x, 5)], pa.binary())], names=["shard", "x"])

    return df.mapInArrow(_freed(packed), "shard int, x binary").rdd.map(lambda r: (r[0], bytes(r[1]))).partitionBy(shards, _same)


def _texts(plan, row: bool, counted: bool) -> Callable:
    """Function of batches of (row, id, text): n-grams by shard, and of each batch, if it is to be scored, the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        p, order = plan.value, plan.value.order
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> Iterator[tuple[int, dict]]:
            sizes = np.cumsum([0, *(len(c) for c, _, _ in held[:-1])])
            codes, at, rows = (np.concatenate(x) for x in zip(*((c, a + s, r) for (c, a, r), s in zip(held, sizes, strict=True)), strict=True))
            held.clear()
            yield from _bundles(p, codes, at, rows, counted)

        for b in _slices(batches):
            texts, rows = b.column(2).to_pylist(), b.column(0).to_numpy()
            lives = [i for i, t in enumerate(texts) if t is not None]
            n = np.full(len(texts), -1, np.int64)
            i = 0
            for part in _chunks((texts[j] for j in lives)):
                codes, lens = symbols(part, order)
                which = np.array(lives[i : i + len(part)])
                i += len(part)
                n[which] = lens - order + 1
                ends = np.flatnonzero(_ends(lens, order)) + order - 1
                row_of = np.repeat(rows[which], lens - order + 1)
                for lo in range(0, len(ends), CHUNK):  # one window, unless a text is longer
                    at = ends[lo : lo + CHUNK]
                    held.append((codes[at[0] - order + 1 : at[-1] + 1], at - (at[0] - order + 1), row_of[lo : lo + CHUNK]))
                    if sum(len(a) for _, a, _ in held) >= CHUNK:
                        yield from out()
            if row and len(texts):
                ids = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n)], names=["row", "doc_id", "n"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, ids.schema) as w:
                    w.write_batch(ids)
                yield int(rows[0] % p.shards), {"ids": sink.getvalue().to_pybytes()}
        if held:
            yield from out()

    return run


def _runs(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of rows by columns of so many bits, and where the rows so far differ in the first column, the first two, and so on."""

    def key(some: list[np.ndarray], at: np.ndarray | slice) -> np.ndarray:
        out = some[0][at].astype(np.uint64)
        for x in some[1:]:
            out <<= np.uint64(bits)
            out |= x[at]
        return out

    def differs(k: np.ndarray) -> np.ndarray:
        new = np.ones(len(k), bool)
        np.not_equal(k[1:], k[:-1], out=new[1:])
        return new

    done = 64 // bits
    k = key(columns[:done], slice(None))
    o = np.argsort(k).astype(np.int32)
    new = differs(k[o])
    del k
    while done < len(columns):  # equal ones by further columns
        run = np.cumsum(new, dtype=np.int32)
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        some = columns[done : done + max(1, (64 - int(run[-1]).bit_length()) // bits)]
        k = (run[tied].astype(np.uint64) << np.uint64(bits * len(some))) | key(some, o[tied])
        q = np.argsort(k)
        o[tied], new[tied] = o[tied][q], differs(k[q])
        done += len(some)
    out = []
    for x in columns:
        new = differs(x[o])
        out.append(new | out[-1] if out else new)
    return o, out


def _sums_of(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of the runs that begin at places, the first of which is 0."""
    return np.diff(np.cumsum(x, dtype=np.int64)[np.append(start[1:], len(x)) - 1], prepend=0).astype(np.int32)


class _Shard:
    """The n-grams of one depth in a shard, by order: counts, and, if they are to be scored, what their contexts have. ids: which of
    the words each of the n-grams' words is, from the last on, a list that is used up; order_of: the places in which n-grams come
    out. What follows from where an order's n-grams begin is made anew for each order, as all at once are several times the
    n-grams' own size."""

    def __init__(self, order: int, depth: int, words: np.ndarray, ids: list[np.ndarray], counted: np.ndarray | None, scores: bool) -> None:
        self.depth, self.order = depth, order
        self.n: dict[int, np.ndarray] = {}
        self.inverse: dict[int, np.ndarray] = {}  # of places, and of words: of the n-grams of the order above
        bits = max(1, len(words).bit_length())
        self.order_of, new = _runs([ids[1], ids[0], *ids[2:]] if order > 1 else ids, bits)
        at = np.flatnonzero(new[order - 1])
        self.n[order] = np.diff(np.append(at, len(self.order_of))).astype(np.int32) if counted is None else _sums_of(counted[self.order_of], at)
        if scores:
            self.inverse[order] = np.cumsum(new[order - 1], dtype=np.int32) - np.int32(1)
        self.new = [x[at] for x in new]  # of the n-grams of highest order: where those of each order begin
        new, top = self.new, self.order_of[at]  # a place of each n-gram of highest order
        del at
        for k in range(order):
            ids[k] = ids[k][top]
        del top
        low = max(depth, min(2, order))
        for k in range(order - 1, low - 1, -1):
            start = np.flatnonzero(new[k - 1][new[k]])
            n = _sums_of(self.n[k + 1] > 0, start)
            begins = words[ids[k - 1][new[k - 1]]] == BOS  # these have raw counts
            self.n[k] = np.where(begins, _sums_of(self.n[k + 1], start), n)
        base = [x[new[low - 1]] for x in ids[:low]]
        if depth < low:  # of words
            n = np.bincount(base[0], self.n[2] > 0, len(words)).astype(np.int32)
            there = np.bincount(base[0], minlength=len(words)) > 0
            self.inverse[1], self.n[1] = (np.cumsum(there, dtype=np.int32) - np.int32(1))[base[0]], n[there]
            base = [np.flatnonzero(there)]
        self.base = [words[x] for x in base]  # the words of the n-grams of lowest order
        if scores and order > max(2, depth):
            del ids[0]
            self.by_context = _runs(ids, bits)

    def _context(self, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which context each n-gram of an order has, and the contexts' counts: of all, and of n-grams by kind."""
        n, first = self.n[k], np.flatnonzero(self.new[k - 1])
        if k == 2:
            here = self.new[0][first]
            at = np.cumsum(here, dtype=np.int32) - np.int32(1)
        else:
            o, runs = self.by_context
            here, n, at = runs[k - 2], np.zeros(len(o), np.int32), np.empty(len(o), np.int32)
            n[first] = self.n[k]
            n = n[o]
            at[o] = np.cumsum(here, dtype=np.int32) - np.int32(1)
            at = at[first]
        start = np.flatnonzero(here)
        return at, [_sums_of(x, start) for x in (n, n == 1, n == 2, n > 2)]

    def stats(self) -> dict[int, list[int]]:
        return {k: [int(np.count_nonzero(self.n[k] == i)) for i in range(1, 5)] for k in range(max(2, self.depth + 1), self.order + 1)}

    def log10(self, p: np.ndarray, cuts: dict[int, tuple[float, float, float]]) -> np.ndarray:
        """Of each place, from the probabilities of the n-grams of lowest order. Uses up what the shard holds."""
        for k in range(self.depth, self.order + 1):
            if k > self.depth:
                at, (total, *kinds) = self._context(k)
                n = self.n.pop(k)
                share = 1 / np.maximum(total, 1)
                gamma = np.where(total > 0, sum(x * y for x, y in zip(cuts[k], kinds, strict=True)) * share, 1.0)
                p *= gamma[at]
                own = np.array([0.0, *cuts[k]])[np.minimum(n, 3)]
                np.subtract(n, own, out=own)
                own *= share[at]
                p += own
                del at, total, kinds, n, share, gamma, own
            if k == self.order:
                self.new, self.by_context = [], None
                np.log10(p, out=p)
            p = p[self.inverse.pop(k) if k in self.inverse else np.cumsum(self.new[k - 1][self.new[k]], dtype=np.int32) - np.int32(1)]
        return p


def _decoded(bundles: list[dict], plan: _Plan, scores: bool = True) -> Iterator[tuple[_Shard, np.ndarray | None, np.ndarray | None]]:
    """By depth: the n-grams' counts, and if they are to be scored, their rows in order of places, and which of these are (None:
    all). Uses up the bundles."""
    for depth in sorted({b["depth"] for b in bundles}):
        own = [b for b in bundles if b["depth"] == depth]
        known = len(plan.words)
        rare = [_unpack(b.pop("rare")) for b in own]
        sizes, total = [len(x) for x in rare], sum(b["row"][1] for b in own)
        u, _, new = _groups(np.concatenate(rare))
        del rare
        ids, lo = [np.empty(total, np.uint32) for _ in range(plan.order)], 0
        for b, part in zip(own, np.split(new, np.cumsum(sizes)[:-1]), strict=True):
            code = np.concatenate([np.arange(known, dtype=np.uint32), part.astype(np.uint32) + np.uint32(known)])
            for x, packed in zip(ids, b.pop("words"), strict=True):
                x[lo : lo + packed[1]] = code[_unpack(packed)]
            lo += b["row"][1]
        del new, part, code, x, packed
        _release()
        flag = lambda what: np.repeat([what(b) for b in own], [b["row"][1] for b in own])  # noqa: E731, B023
        counted = None if all(b["counted"] is not False for b in own) else flag(lambda b: b["counted"] is not False)
        s = _Shard(plan.order, depth, np.concatenate([plan.words, u]), ids, counted, scores)
        del ids, u
        _release()
        if not scores:
            yield s, None, None
            continue
        scored = None if all(b["counted"] is not True for b in own) else flag(lambda b: b["counted"] is not True)
        rows = np.concatenate([_unpack(b.pop("row")).astype(np.int64) + b["base"] for b in own])[s.order_of]
        scored, s.order_of = None if scored is None else scored[s.order_of], None
        yield s, rows, scored


def _block(row: np.ndarray, shards: int) -> np.ndarray:
    return (_mix((row >> 12).view(np.uint64) * _R) % np.uint64(shards)).astype(np.int64)


class Trained:
    """The counted table. Shards count it when they score, as each holds what the scores of its n-grams need."""

    def __init__(self, spark: SparkSession, df: DataFrame, text_col: str, order: int, shard: int) -> None:
        self.spark, self.df, self.text_col, self.order, self.shard = spark, df, text_col, order, shard


def train(spark: SparkSession, df: DataFrame, text_col: str = "text", order: int = ORDER, shard: int = SHARD) -> Trained:
    return Trained(spark, df, text_col, order, shard)


def _key(c: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams."""
    h = None
    for x in c:
        h = _step(h, x)
    return h


def _parts(c: list[np.ndarray], parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which n-grams belong to each part, in the order of their hashes. Those of one context belong to one."""
    part = (_mix(_key(c[1:] or c) * _R) % np.uint64(parts)).astype(np.int64)
    o = np.lexsort([_key(c), part])
    for lo, hi in _pieces(part[o]):
        yield int(part[o[lo]]), o[lo:hi]


def _ask(c: list[np.ndarray], n: np.ndarray, parts: int, asker: int) -> Iterator[tuple[int, bytes]]:
    """N-grams, with their counts, to the parts they belong to. asker: a shard, or -1 - the part of the order above."""
    for part, k in _parts(c, parts):
        yield part, pickle.dumps({"level": len(c), "asked": [_pack(x[k]) for x in c], "n": _pack(n[k]), "asker": asker}, 5)


class _Level:
    """A part of the n-grams of an order that several shards have: their words, from the last on, counts over all shards, and
    which of them each asker asked for, in its order."""

    def __init__(self, items: Iterator[tuple[int, bytes]], k: int) -> None:
        parts, ns, askers, self.given = [[np.zeros(0, np.uint64)] * k], [np.zeros(0, np.int64)], [], {}
        for _, b in items:
            x = pickle.loads(b)
            if "p" in x:
                self.given[x["part"]] = _unpack(x["p"])
            elif "asked" in x and x["level"] == k:
                parts.append([_unpack(w) for w in x["asked"]])
                ns.append(_unpack(x["n"]).astype(np.int64))
                askers.append(x["asker"])
        c = [np.concatenate(x) for x in zip(*parts, strict=True)]
        u, first, inverse = _groups(_key(c))
        self.c, self.n = [x[first] for x in c], np.bincount(inverse, np.concatenate(ns), len(u)).astype(np.int64)
        self.asks = [*zip(askers, np.split(inverse, np.cumsum([len(x) for x in ns[1:]])[:-1]), strict=True)] if askers else []

    def below(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The n-grams of the order below that these end with, what these add to their counts, and which each ends with."""
        c = self.c[:-1]
        _, first, inverse = _groups(_key(c))
        c = [x[first] for x in c]
        kinds, raw = (np.bincount(inverse, x, len(first)).astype(np.int64) for x in (self.n > 0, self.n))
        return c, np.where(c[-1] == BOS, raw, kinds), inverse

    def p(self, cuts: tuple[float, float, float], parts: int) -> np.ndarray:
        """Probabilities, above the first order."""
        c, _, inverse = self.below()
        low = np.empty(len(c[0]))
        for part, k in _parts(c, parts):
            low[k] = self.given[part]
        n, (u, _, at) = self.n, _groups(_key(self.c[1:]))
        cut = np.array([0.0, *cuts])[np.minimum(n, 3)]
        total, left = np.bincount(at, n, len(u))[at], np.bincount(at, cut, len(u))[at]
        return np.where(total > 0, (n - cut + left * low[inverse]) / np.maximum(total, 1), low[inverse])


def _run(m: Trained, make: Callable[[object], tuple[list[RDD], int]]) -> RDD:
    """Pairs of a block of rows and (ids) or (rows, sums of log10 probabilities); make: the n-grams by shard, for a plan."""
    spark = m.spark
    plan = _plan(m.df, m.text_col, m.order, m.shard)
    shared, shards = spark.sparkContext.broadcast(plan), plan.shards
    bundles, *more = make(shared, shards)
    for x in more:
        bundles = bundles.union(x)

    parts = -(-shards // 16)

    def count(shard: int, items: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        own = [x for _, b in items if "words" in (x := pickle.loads(b))]
        for s, _, _ in _decoded(own, shared.value, False):
            yield shard % parts, pickle.dumps({"stats": s.stats()}, 5)
            yield from _ask(s.base, s.n[s.depth], parts, shard)

    def below(k: int) -> Callable:
        def run(part: int, items: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
            c, n, _ = _Level(items, k).below()
            yield from _ask(c, n, parts, -1 - part)

        return run

    def few(k: int) -> Callable:
        def run(items: Iterator[tuple[int, bytes]]) -> Iterator[np.ndarray]:
            n = _Level(items, k).n
            yield np.array([*(np.count_nonzero(n == i) for i in range(1, 5)), np.count_nonzero(n > 0), n.sum()])

        return run

    counted = bundles.mapPartitionsWithIndex(_freed(count)).partitionBy(parts, _same)
    stats = {k: np.zeros(6, np.int64) for k in range(1, m.order + 1)}
    for x in counted.map(lambda x: pickle.loads(x[1]).get("stats")).filter(bool).toLocalIterator():
        for k, c in x.items():
            stats[k][:4] += c
    levels = {plan.depth: counted}
    for k in range(plan.depth, 0, -1):
        if k < plan.depth:
            levels[k] = counted.union(levels[k + 1].mapPartitionsWithIndex(_freed(below(k + 1))).partitionBy(parts, _same))
        stats[k] += sum(levels[k].mapPartitions(_freed(few(k))).collect())
    cuts = {k: discounts(*map(int, x[:4])) for k, x in stats.items()}
    once, twice, _, _, types, total = map(int, stats[1])
    rest = once * cuts[1][0] + twice * cuts[1][1] + (types - once - twice) * cuts[1][2]
    total, share = max(total, 1), rest / total / (types + 1) if total else 1.0  # the unknown word is one more

    def of_words(n: np.ndarray) -> np.ndarray:
        return (n - np.array([0.0, *cuts[1]])[np.minimum(n, 3)]) / total + share

    def answer(k: int, above: bool) -> Callable:
        """To shards, their own counts of words or probabilities; or probabilities to the order above."""

        def run(part: int, items: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
            x = _Level(items, k)
            v = x.n if k == 1 and not above else of_words(x.n) if k == 1 else x.p(cuts[k], parts)
            for asker, at in x.asks:
                if (asker < 0) == above:
                    yield -1 - asker if above else asker, pickle.dumps({"level": k, "part": part, "p": _pack(v[at])}, 5)

        return run

    both = bundles
    for k in range(1, plan.depth + 1):
        both = both.union(levels[k].mapPartitionsWithIndex(_freed(answer(k, False))).partitionBy(shards, _same))
        if k < plan.depth:
            levels[k + 1] = levels[k + 1].union(levels[k].mapPartitionsWithIndex(_freed(answer(k, True))).partitionBy(parts, _same))

    def score_shard(items: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        own, given, n = [], {}, shared.value.shards
        for shard, b in items:
            x = pickle.loads(b)
            if "ids" in x:
                ids = pa.ipc.open_stream(x["ids"]).read_all().combine_chunks()
                block = _block(ids.column(0).to_numpy(), n)
                for k in np.unique(block):
                    part, sink = ids.filter(pa.array(block == k)), pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema) as w:
                        w.write_table(part)
                    yield int(k), pickle.dumps({"ids": sink.getvalue().to_pybytes()}, 5)
            elif "part" in x:
                given[x["level"], x["part"]] = _unpack(x["p"])
            else:
                own.append(x)
        for s, rows, scored in _decoded(own, shared.value):
            p = np.empty(len(s.base[0]))
            for part, k in _parts(s.base, parts):
                v = given[s.depth, part]
                p[k] = of_words(v) if s.depth == 1 else v
            v = s.log10(p, cuts)
            if scored is not None:
                rows, v = rows[scored], v[scored]
            u, _, inverse = _groups(rows.view(np.uint64))
            u, v = u.view(np.int64), np.bincount(inverse, v, len(u))
            block = _block(u, n)
            o = np.argsort(block, kind="stable")
            for lo, hi in _pieces(block[o]):
                k = o[lo:hi]
                yield int(block[k[0]]), pickle.dumps({"row": _pack(np.diff(u[k], prepend=0)), "v": _pack(v[k].view(np.uint64) & ~np.uint64(0xFFFF))}, 5)

    return both.mapPartitions(_freed(score_shard)).partitionBy(shards, _same)


def _sums(items: Iterator[tuple[int, bytes]]) -> tuple[list[pa.Table], np.ndarray, np.ndarray]:
    """Tables of ids, the distinct rows in order and their sums."""
    ids, rows, vs = [], [np.zeros(0, np.int64)], [np.zeros(0)]
    for _, b in items:
        x = pickle.loads(b)
        if "ids" in x:
            ids.append(pa.ipc.open_stream(x["ids"]).read_all())
        else:
            rows.append(np.cumsum(_unpack(x["row"])))
            vs.append(_unpack(x["v"]).view(np.float64))
    row, v = np.concatenate(rows), np.concatenate(vs)
    u, _, inverse = _groups(row.view(np.uint64))
    return ids, u.view(np.int64), np.bincount(inverse, v, len(u))


def _table(spark: SparkSession, made: RDD, schema: str) -> DataFrame:
    """Rows of Arrow tables that come as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                yield from pa.ipc.open_stream(x).read_all().to_batches(max_chunksize=10_000)

    return spark.createDataFrame(made.map(lambda x: (x,)), "x binary").mapInArrow(rows, schema)


def _bytes(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _score_grams(grams: DataFrame, m: Trained) -> DataFrame:
    """(h, v): log10 probability of the last word of each n-gram (h, gram)."""

    order = m.order

    def make(plan, shards: int) -> list[RDD]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
            for b in batches:
                if b.num_rows:
                    codes = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").astype(np.uint64)
                    yield from _bundles(plan.value, codes, np.arange(1, b.num_rows + 1) * order - 1, b.column(0).to_numpy(), False)

        return [_spread(_rows(m.df, None, m.text_col), _texts(plan, False, True), shards), _spread(grams.select("h", "gram"), run, shards)]

    def out(items: Iterator[tuple[int, bytes]]) -> Iterator[bytes]:
        _, row, v = _sums(items)
        yield _bytes(pa.table({"h": row, "v": v}))

    return _table(m.spark, _run(m, make).mapPartitions(_freed(out)), "h bigint, v double")


def _rows(df: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), (F.col(id_col) if id_col else F.lit(0)).alias("doc_id"), F.col(text_col).alias("text"))


def score(df: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, symbols (words and the end), log10 probability and perplexity of each row. The table that was counted is packed once."""
    m = trained

    def make(plan, shards: int) -> list[RDD]:
        if df is m.df and text_col == m.text_col:
            return [_spread(_rows(df, id_col, text_col), _texts(plan, True, None), shards)]
        return [_spread(_rows(m.df, None, m.text_col), _texts(plan, False, True), shards), _spread(_rows(df, id_col, text_col), _texts(plan, True, False), shards)]

    def out(items: Iterator[tuple[int, bytes]]) -> Iterator[bytes]:
        ids, row, v = _sums(items)
        for t in ids:
            at, n = np.searchsorted(row, t["row"].to_numpy()), t["n"].to_numpy()
            none = n < 0
            log = np.full(len(n), np.nan)
            log[~none] = v[at[~none]]
            ppl = np.power(10.0, -log / np.maximum(n, 1))
            yield _bytes(pa.table([t["doc_id"], pa.array(n, mask=none), pa.array(log, mask=none), pa.array(ppl, mask=none)], names=["doc_id", "n_symbols", "log10_prob", "perplexity"]))

    kind = df.schema[id_col].dataType.simpleString()
    return _table(m.spark, _run(m, make).mapPartitions(_freed(out)), f"doc_id {kind}, n_symbols bigint, log10_prob double, perplexity double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_spread(spark, sf_dir, "documents")
    return score(documents, train(spark, documents))
