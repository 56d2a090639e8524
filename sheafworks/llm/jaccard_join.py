"""N-gram Jaccard join: documents whose sets of word n-grams have a Jaccard similarity of at least ``threshold``.

It is the blocked sparse product of the incidence matrix (documents by n-grams) with its transpose, from which pairs below
size-derived bounds are discarded. N-grams are 64-bit hashes of which ``48 + bits`` (at most 64) bits are compared, so two
different n-grams of N fall together with a probability of about N / 2^(48 + bits); but for that it is exact.

1. Equal texts are one row of the matrix, under their lowest id; the others are its copies.
2. Columns: n-grams go to column blocks by the leading bits of their hash, in packed arrays that hold only what is there, dealt
   out in passes of ``RADIX`` bits, so what is moved is in proportion to the text whatever the number of blocks. A block counts
   in how many documents each n-gram occurs. N-grams of one document add to no product and are dropped; the rest goes back
   to its documents with its frequency class. N-grams very frequent already within a worker's piece of the table are only
   counted there and share the highest class, so no column gathers its documents in one task.
3. Bounds: with a partner of at least the threshold a document of N n-grams shares ``ceil(threshold * N)``, so one of its
   ``N - ceil(threshold * N) + 1`` first in any common order; the order is rarest first. For rare columns the overlaps of
   the listed parts are accumulated by pair, and pairs are linked that can still reach their bound with all the rest. Over
   frequent columns only documents can meet that have ``threshold * N`` frequent n-grams or more; those of one column and
   of agreeing sizes are linked along a chain.
4. Row blocks: pairs can reach the threshold only within a connected group of these links. Small groups share tasks; a large
   one's rows are cut into blocks by size, and each pair of blocks whose sizes can agree is a task. Blocks are multiplied:
   frequent columns as dense matrices, rare ones as lists; counts under ``threshold / (1 + threshold) * (Na + Nb)`` are discarded.

Nothing caps partners, candidates or frequencies; nothing that grows with the input is collected, or broadcast unless counted.

``classes`` returns a row for each document: the group it belongs to by links (under its lowest id) and how many documents it is
linked with, copies included. ``pairs`` returns the links between different texts, under their lowest ids.

Defined results: ids are integers (others raise a TypeError); null ids are in no row; null texts and texts without words are
alone in their group, without links; of rows with one id the text with words whose SHA-256 sorts first is taken; equal sets have similarity 1;
texts of any length are read whole; texts of fewer than n words have one n-gram, all their words; an empty table gives no
row. Only the id and text columns are read, so further columns may have any name; ``keep_one`` keeps them all, and rows of
null id or text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.llm import grams
from sheafworks.llm.components import components, union_find
from sheafworks.llm.names import free
from sheafworks.session import materialise, read_spread

N, THRESHOLD = 3, 0.5
BLOCK_CHARS = 6_000_000  # text of which a worker packs the n-grams at once
COLUMN_CHARS = 12_000_000  # text whose n-grams a column block gets, about
RADIX = 12  # bits of a block's number by which one pass deals out
ROW_BLOCK = 600_000  # non-zeros in a block of rows
ROWS = 2_000  # documents whose product is held at once
DENSE = 16  # documents from which on a column of a block is multiplied as a dense one
RARE = 8  # documents up to which a column is rare
HOT = 256  # documents of a worker's piece from which on a column is only counted
BROADCAST = 2_000_000  # rows up to which a side is broadcast


# -- packed tables ---------------------------------------------------------------------------------
def _pack_key(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack_key(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.reshape(-1).view("<u8")


def _pack_ids(ids: np.ndarray) -> bytes:
    """Differences, in the least width that holds them."""
    if not len(ids):
        return b""
    d = np.diff(ids)
    top = int(max(d.max(initial=0), -int(d.min(initial=0)))) if len(d) else 0
    code = 0 if top < 1 << 7 else 1 if top < 1 << 15 else 2 if 0 <= top < 1 << 31 else 3
    return bytes([code]) + ids[:1].astype("<i8").tobytes() + d.astype(("<i1", "<i2", "<i4", "<i8")[code]).tobytes()


def _unpack_ids(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    d = np.frombuffer(data, ("<i1", "<i2", "<i4", "<i8")[data[0]], offset=9)
    out = np.empty(len(d) + 1, np.int64)
    out[0] = np.frombuffer(data, "<i8", 1, 1)[0]
    out[1:] = d
    return out.cumsum()


class Layout:
    """Several tables of columns in one binary value. Column kinds: ``id`` (int64), ``key`` (uint64 of ``width`` bytes), ``i4``, ``u1``."""

    def __init__(self, width: int, *tables: tuple[str, ...]) -> None:
        self.width, self.tables = width, tables

    def encode(self, tables: list[list[np.ndarray]]) -> bytes:
        parts = []
        for kinds, cols in zip(self.tables, tables):
            for kind, c in zip(kinds, cols):
                parts.append(_pack_ids(c) if kind == "id" else _pack_key(c, self.width) if kind == "key" else c.astype(f"<{kind}").tobytes())
        return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)

    def decode(self, data: bytes) -> list[list[np.ndarray]]:
        n = sum(map(len, self.tables))
        sizes, at, out = iter(np.frombuffer(data, "<u4", n).tolist()), 4 * n, []
        for kinds in self.tables:
            cols = []
            for kind in kinds:
                size = next(sizes)
                part = data[at : at + size]
                at += size
                cols.append(_unpack_ids(part) if kind == "id" else _unpack_key(part, self.width) if kind == "key" else np.frombuffer(part, f"<{kind}"))
            out.append(cols)
        return out

    def gather(self, rows: Iterator[bytes]) -> list[list[np.ndarray]]:
        """The tables of many values, one under the other."""
        every = [self.decode(r) for r in rows]
        return [[np.concatenate([e[t][c] for e in every]) for c in range(len(kinds))] for t, kinds in enumerate(self.tables)]

    def deal(self, tables: list[list[np.ndarray]], targets: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """A value for each target that has rows; rows keep their order."""
        dealt = []
        for cols, to in zip(tables, targets):
            order = np.argsort(to, kind="stable")
            u, start = np.unique(to[order], return_index=True)
            dealt.append(([c[order] for c in cols], dict(zip(u.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(to)])))))
        for target in sorted({t for _, where in dealt for t in where}):
            yield target, self.encode([[c[slice(*where.get(target, (0, 0)))] for c in cols] for cols, where in dealt])


def _rows(found: Iterator[tuple[int, bytes]], size: int = 64) -> Iterator[pa.RecordBatch]:
    part: list[tuple[int, bytes]] = []
    for row in found:
        part.append(row)
        if len(part) == size:
            yield _batch(part)
            part = []
    if part:
        yield _batch(part)


def _batch(part: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary())], names=["block", "data"])


class Shape:
    """The numbers that all steps share."""

    def __init__(self, bits: int, t: Fraction, radix: int, rare: int, hot: int) -> None:
        self.bits, self.t, self.coarse = bits, t, min(bits, radix)
        self.key_bits = min(64, 48 + bits)
        self.width = (self.key_bits + 7) // 8
        self.rare, self.cap, self.hot = int(8 * math.log2(rare)), int(8 * math.log2(hot)), hot
        self.band = math.log(1 / float(t)) / 2
        # n-grams of documents, n-grams counted only, documents and sizes, n-grams of known class
        self.spread = Layout(self.width, ("id", "key"), ("key", "i4"), ("id", "i4"), ("id", "key"))
        self.back = Layout(self.width, ("id", "key", "u1"), ("id", "i4"))
        # listed rare n-grams with size and rest; listed frequent ones with band, least and greatest size
        self.listed = Layout(self.width, ("id", "key", "i4", "i4"), ("id", "key", "i4", "i4", "i4"))

    def of_key(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(self.key_bits - self.bits)).astype(np.int64) if self.bits else np.zeros(len(key), np.int64)

    def of_id(self, ids: np.ndarray) -> np.ndarray:
        h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)

    def of_listed(self, key: np.ndarray) -> np.ndarray:
        return self.of_id(key.astype("<u8").view("<i8"))

    def bound(self, size: np.ndarray) -> np.ndarray:
        """ceil(t * size), in integers."""
        return -((-size * self.t.numerator) // self.t.denominator)

    def needed(self, both: np.ndarray) -> np.ndarray:
        """The least overlap of two sets of that many n-grams together."""
        return -((-both * self.t.numerator) // (self.t.numerator + self.t.denominator))

    def bands(self, size: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(size, 1)) / self.band).astype(np.int64)


def _regroup(rows: DataFrame, shape: Shape, layout: Layout, targets: Callable[[list[list[np.ndarray]]], list[np.ndarray]], limit: int = 2_000_000) -> DataFrame:
    """Rows by the leading bits of their target → rows by the whole target. Streams: what is held is ``limit`` entries."""
    if shape.coarse == shape.bits:
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for data in batch.column(1).to_pylist():
                held.append(data)
                size += len(data)
                if size >= 8 * limit:
                    tables = layout.gather(held)
                    yield from _rows(layout.deal(tables, targets(tables)))
                    held, size = [], 0
        if held:
            tables = layout.gather(held)
            yield from _rows(layout.deal(tables, targets(tables)))

    return rows.repartition("block").mapInArrow(run, "block int, data binary")


# -- columns ---------------------------------------------------------------------------------------
def _spread_targets(s: Shape, tables: list[list[np.ndarray]]) -> list[np.ndarray]:
    (_, key), (counted, _), (own, _), (through, _) = tables
    return [s.of_key(key), s.of_key(counted), s.of_id(own), s.of_id(through)]


def pack_texts(s: Shape, n: int, ids: list[int], texts: list[str]) -> Iterator[tuple[int, bytes]]:
    """A piece of the table → (leading bits of a column block, packed n-grams)."""
    order = np.argsort(np.asarray(ids, np.int64), kind="stable")
    doc = np.asarray(ids, np.int64)[order]
    h, size = grams.sets([texts[i] for i in order.tolist()], n)
    each = np.repeat(doc, size)
    key = h >> np.uint64(64 - s.key_bits)
    del h
    # columns that are frequent in this piece: by counts of slots first, which no such column can escape
    slot = (key & np.uint64((1 << 20) - 1)).astype(np.int64)
    full = (np.bincount(slot, minlength=1 << 20) >= s.hot)[slot]
    counted, times, through = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(key), bool)
    if full.any():
        u, inv, times = np.unique(key[full], return_inverse=True, return_counts=True)
        through[np.flatnonzero(full)] = (times >= s.hot)[inv]
        counted, times = u[times >= s.hot], times[times >= s.hot]
    some = size > 0
    tables = [[each[~through], key[~through]], [counted, times], [doc[some], size[some]], [each[through], key[through]]]
    yield from s.spread.deal(tables, [t >> (s.bits - s.coarse) for t in _spread_targets(s, tables)])


def _spread(s: Shape, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, chars = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                chars += len(t)
                if chars >= BLOCK_CHARS or len(ids) >= 60_000:
                    yield from _rows(pack_texts(s, n, ids, texts))
                    ids, texts, chars = [], [], 0
        if ids:
            yield from _rows(pack_texts(s, n, ids, texts))

    return run


def _back_targets(s: Shape, tables: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [s.of_id(tables[0][0]), s.of_id(tables[1][0])]


def _return(s: Shape):
    """A column block: n-grams of two or more documents go back to them with the class of their frequency."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        (doc, key), (counted, times), own, (far, far_key) = s.spread.gather(pdf["data"])
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(edge, len(key)))
        df = count.copy()
        if len(counted) and len(edge):
            u, inv = np.unique(counted, return_inverse=True)
            more = np.bincount(inv, weights=times).astype(np.int64)
            at = np.minimum(np.searchsorted(u, key[edge]), len(u) - 1)
            df += np.where(u[at] == key[edge], more[at], 0)
        rank = np.minimum(s.cap, np.floor(8 * np.log2(np.maximum(df, 1)) + 1e-9).astype(np.int64))
        shared, rank = np.repeat(df > 1, count), np.repeat(rank, count)
        doc, key, rank = np.append(doc[shared], far), np.append(key[shared], far_key), np.append(rank[shared], np.full(len(far), s.cap))
        order = np.argsort(doc, kind="stable")
        tables = [[doc[order], key[order], rank[order]], own]
        rows = list(s.back.deal(tables, [t >> (s.bits - s.coarse) for t in _back_targets(s, tables)]))
        return pd.DataFrame(rows, columns=["block", "data"])

    return run


# -- bounds ----------------------------------------------------------------------------------------
def _list_first(s: Shape):
    """Documents with all their shared n-grams → their rows (kind 0), links of those that meet here (kind 1), and what they list
    (kind 2), by blocks of n-grams."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        (doc, key, rank), (mine, sizes) = s.back.gather(pdf["data"])
        by_id = np.argsort(mine)
        mine, sizes = mine[by_id], sizes[by_id].astype(np.int64)
        at = np.searchsorted(mine, doc)
        shared = np.bincount(at, minlength=len(mine))
        room = sizes - s.bound(sizes) + 1 - (sizes - shared)  # first ones that aren't the document's alone
        live = (room > 0) & (shared > 0)
        keep = live[at]
        at, key, rank = at[keep], key[keep], rank[keep]
        order = np.lexsort((key, rank, at))
        at, key, rank = at[order], key[order], rank[order]
        start = np.searchsorted(at, np.arange(len(mine)))
        first, rare = np.arange(len(at)) - start[at] < room[at], rank <= s.rare
        often = np.bincount(at[~rare], minlength=len(mine))
        listed = np.bincount(at[rare & first], minlength=len(mine))
        rest = shared - listed  # n-grams that may be shared beside the listed rare ones
        # the sign says whether all rare ones are listed
        rest = np.where(rest == often, rest, -rest)
        e = np.flatnonzero(first & rare)
        thin = [mine[at[e]], key[e], sizes[at[e]], rest[at[e]]]
        # frequent columns: documents that have enough frequent n-grams, one for each column and band
        e = np.flatnonzero(first & ~rare & (often >= s.bound(sizes))[at])
        who, column, band = at[e], key[e], s.bands(sizes)[at[e]]
        order = np.lexsort((who, band, column))
        who, column, band = who[order], column[order], band[order]
        new = np.append(True, (column[1:] != column[:-1]) | (band[1:] != band[:-1])) if len(who) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        leader = np.repeat(who[begin], np.diff(np.append(begin, len(who))))
        linked, root = union_find(who[~new], leader[~new]) if (~new).any() else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        low, high = (np.minimum.reduceat(sizes[who], begin), np.maximum.reduceat(sizes[who], begin)) if len(begin) else (who, who)
        tables = [thin, [mine[who[begin]], column[begin], band[begin], low, high]]
        rows = [(2, int(b), 0, 0, data) for b, data in s.listed.deal(tables, [s.of_listed(c[1]) >> (s.bits - s.coarse) for c in tables])]
        rows += [(1, 0, int(mine[a]), int(mine[b]), None) for a, b in zip(linked.tolist(), root.tolist()) if a != b]
        for i in np.flatnonzero(live).tolist():
            rows.append((0, 0, int(mine[i]), int(sizes[i]), _pack_key(key[start[i] : start[i] + shared[i]], s.width)))
        return pd.DataFrame(rows, columns=["kind", "block", "doc_id", "size", "data"])

    return run


def _link(s: Shape):
    """A block of listed n-grams → (a, b, overlap so far, overlap needed so far, sure)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        (doc, key, size, rest), (leader, column, band, low, high) = s.listed.gather(pdf["data"])
        order = np.lexsort((doc, key))
        doc, key, size, rest = doc[order], key[order], size[order].astype(np.int64), rest[order].astype(np.int64)
        i, j, step = [], [], 1
        while step < len(key):
            x = np.flatnonzero(key[step:] == key[:-step])
            if not len(x):
                break
            fits = np.minimum(size[x], size[x + step]) * s.t.denominator >= np.maximum(size[x], size[x + step]) * s.t.numerator
            i.append(x[fits])
            j.append(x[fits] + step)
            step += 1
        out = []
        if i:
            i, j = np.concatenate(i), np.concatenate(j)
            order = np.lexsort((doc[j], doc[i]))
            i, j = i[order], j[order]
            new = np.append(True, (doc[i][1:] != doc[i][:-1]) | (doc[j][1:] != doc[j][:-1])) if len(i) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(i)))
            i, j = i[begin], j[begin]
            whole = (rest[i] >= 0) & (rest[j] >= 0)
            a, b = np.abs(rest[i]), np.abs(rest[j])
            need = s.needed(size[i] + size[j]) - np.where(whole, np.minimum(a, b), np.maximum(a, b))
            out.append(pd.DataFrame({"a": doc[i], "b": doc[j], "n": count, "need": need, "sure": False}))
        order = np.lexsort((leader, band, column))
        leader, column, band, low, high = (c[order] for c in (leader, column, band.astype(np.int64), low.astype(np.int64), high.astype(np.int64)))
        if len(leader):
            begin = np.flatnonzero(np.append(True, (column[1:] != column[:-1]) | (band[1:] != band[:-1])))
            times = np.diff(np.append(begin, len(leader)))
            head, low, high = leader[begin], np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
            on = (column[begin][1:] == column[begin][:-1]) & (high[:-1] * s.t.denominator >= low[1:] * s.t.numerator)
            a, b = np.append(np.repeat(head, times), head[:-1][on]), np.append(leader, head[1:][on])
            links = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
            links = links[links["a"] != links["b"]].drop_duplicates()
            out.append(links.assign(n=1, need=0, sure=True))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": [], "need": [], "sure": []}).astype({"a": int, "b": int, "n": int, "need": int, "sure": bool})

    return run


# -- products --------------------------------------------------------------------------------------
def overlaps(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """The n x n product of an incidence matrix given by its non-zeros (row, column key); the upper triangle is right."""
    out = np.zeros((n, n), np.int32)
    order = np.lexsort((doc, key))
    doc, key = doc[order], key[order]
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    df = np.diff(np.append(edge, len(key)))
    each = np.repeat(df, df)
    flat = out.reshape(-1)
    rare = (each > 1) & (each < DENSE)
    d, k = doc[rare], key[rare]
    for step in range(1, DENSE - 1):
        same = k[step:] == k[:-step] if len(k) > step else np.zeros(0, bool)
        if not same.any():
            break
        codes, times = np.unique(d[:-step][same] * n + d[step:][same], return_counts=True)
        flat[codes] += times.astype(np.int32)
    often = np.flatnonzero(df >= DENSE)
    wide = max(64, min(4096, (24 << 20) // (4 * max(n, 1))))
    for lo in range(0, len(often), wide):
        cols = often[lo : lo + wide]
        m = np.zeros((n, len(cols)), np.float32)
        at = np.repeat(edge[cols], df[cols]) + np.arange(df[cols].sum()) - np.repeat(np.cumsum(df[cols]) - df[cols], df[cols])
        m[doc[at], np.repeat(np.arange(len(cols)), df[cols])] = 1
        used = np.flatnonzero(m.any(axis=1))
        m = m[used]
        out[np.ix_(used, used)] += (m @ m.T).astype(np.int32)
    return out


def _multiply(s: Shape, every_pair: bool):
    """Rows of a task → its pairs, or (doc_id, peer, n): each linked document, the least one it hangs together with here, and
    how many documents it is linked with."""

    def product(pdf: pd.DataFrame, cross: bool) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        ids, size = pdf["doc_id"].to_numpy(), pdf["size"].to_numpy().astype(np.int64)
        sets = [_unpack_key(x, s.width) for x in pdf["data"]]
        lens = np.array([len(x) for x in sets])
        group = pdf["label"].to_numpy().astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key = np.concatenate(sets) ^ np.repeat(group, lens)  # columns of different groups are different ones
        o = overlaps(np.repeat(np.arange(len(ids)), lens), key, len(ids))
        i, j = np.nonzero(np.triu(o, 1))
        both, n = o[i, j].astype(np.int64), size[i] + size[j]
        ok = both >= s.needed(n)
        label = pdf["label"].to_numpy()
        ok &= label[i] == label[j]
        if cross:
            side = pdf["side"].to_numpy()
            ok &= side[i] != side[j]
        i, j, both, n = i[ok], j[ok], both[ok], n[ok]
        if every_pair:
            return pd.DataFrame({"doc_a": ids[i], "doc_b": ids[j], "overlap": both, "jaccard": both / (n - both)})
        copies = pdf["copies"].to_numpy().astype(np.int64)
        times = np.bincount(np.append(i, j), weights=np.append(copies[j], copies[i]), minlength=len(ids)).astype(np.int64)
        who, root = union_find(i, j) if len(i) else (i, j)
        return pd.DataFrame({"doc_id": ids[who], "peer": ids[root], "n": times[who]})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["big"].iloc[0]:
            return product(pdf, bool(pdf["side"].iloc[0] >= 0))
        # many small groups: as many at once as make up a block
        pdf = pdf.sort_values("label", kind="stable")
        label = pdf["label"].to_numpy()
        edge = np.flatnonzero(np.append(True, label[1:] != label[:-1]))
        out, lo = [], 0
        for k, hi in enumerate([*edge[1:].tolist(), len(pdf)]):
            last = hi == len(pdf)
            after = len(pdf) if last else edge[k + 2] if k + 2 < len(edge) else len(pdf)
            if last or after - lo > ROWS:
                out.append(product(pdf.iloc[lo:hi], False))
                lo = hi
        return pd.concat(out)

    return run


# -- the join --------------------------------------------------------------------------------------
def _small(df: DataFrame) -> DataFrame:
    """Broadcast while there are at most ``BROADCAST`` rows; beyond that both sides of a join are shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


class Join:
    """Copies (``members``: doc_id, rep, copies) and ``product``, the rows of the last step, of a table."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, every_pair: bool = False, column_chars: int = COLUMN_CHARS, row_block: int = ROW_BLOCK, radix: int = RADIX, rare: int = RARE, hot: int = HOT) -> None:
        if df.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
            raise TypeError(f"{id_col} must be of an integer type")
        t = Fraction(str(threshold))
        docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id is not null and text is not null")
        digest = F.when(F.col("text").rlike("[^ \\t\\n\\f\\r]"), F.unhex(F.sha2("text", 256)))  # texts without words are no copies
        keyed = materialise(docs.select("doc_id", digest.alias("digest"), F.length("text").cast("bigint").alias("chars")), "keyed")
        one = keyed.groupBy("doc_id").agg(F.min("digest").alias("digest"), F.max("chars").alias("chars"), F.count("*").alias("k"))
        several = one.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
        several = materialise(several, "copied")
        members = one.join(_small(several), "digest", "left")
        self.members = materialise(members.select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies"), "digest", "chars", "k"), "members")
        sums = self.members.agg(F.sum(F.when(F.col("doc_id") == F.col("rep"), F.col("chars"))).alias("chars"), F.max("k").alias("k")).collect()[0]
        if (sums["k"] or 1) == 1:
            texts = docs.join(_small(self.members.where("doc_id <> rep").select("doc_id")), "doc_id", "left_anti")
        else:  # the only case in which texts are shuffled whatever their number
            rows = docs.withColumn("digest", digest)
            texts = rows.join(self.members.where("doc_id = rep").select("doc_id", "digest"), ["doc_id", "digest"]).groupBy("doc_id").agg(F.first("text").alias("text"))
        bits = max(0, math.ceil(math.log2(max(1, (sums["chars"] or 0) / column_chars))))
        self.shape = s = Shape(bits, t, radix, rare, hot)
        packed = texts.select("doc_id", "text").mapInArrow(_spread(s, n), "block int, data binary")
        packed = _regroup(packed, s, s.spread, lambda x: _spread_targets(s, x))
        back = packed.groupBy("block").applyInPandas(_return(s), "block int, data binary")
        back = _regroup(back, s, s.back, lambda x: _back_targets(s, x))
        listed = materialise(back.groupBy("block").applyInPandas(_list_first(s), "kind int, block int, doc_id bigint, size bigint, data binary"), "listed")
        lists = _regroup(listed.where("kind = 2").select("block", "data"), s, s.listed, lambda x: [s.of_listed(c[1]) for c in x])
        met = lists.groupBy("block").applyInPandas(_link(s), "a bigint, b bigint, n bigint, need bigint, sure boolean")
        met = met.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need"), F.max("sure").alias("sure")).where("sure or n >= need")
        groups = components(met.select("a", "b").unionByName(listed.where("kind = 1").select(F.col("doc_id").alias("a"), F.col("size").alias("b"))))
        self.product = self._products(listed.where("kind = 0").select("doc_id", "size", "data"), groups, several, row_block, every_pair)

    def _products(self, content: DataFrame, groups: DataFrame, several: DataFrame, row_block: int, every_pair: bool) -> DataFrame:
        s = self.shape
        weight = F.greatest(F.floor(F.length("data") / s.width), F.lit(max(1, row_block // ROWS)))
        band = F.floor(F.log(F.greatest("size", F.lit(1)).cast("double")) / s.band).cast("int")
        rows = content.join(groups.withColumnRenamed("id", "doc_id"), "doc_id").join(several.select(F.col("rep").alias("doc_id"), "copies"), "doc_id", "left")
        rows = materialise(rows.select("doc_id", "label", "size", F.coalesce("copies", F.lit(1)).alias("copies"), band.alias("band"), weight.alias("w"), "data"), "rows")
        bands = materialise(rows.groupBy("label", "band").agg(F.sum("w").alias("w"), F.count("*").alias("members")), "bands")
        labels = bands.groupBy("label").agg(F.sum("w").alias("w"), F.sum("members").alias("members"))
        big = _small(labels.where((F.col("w") > row_block) | (F.col("members") > ROWS)).select("label"))
        bins = max(1, -(-(labels.agg(F.sum("w").alias("w")).collect()[0]["w"] or 0) // row_block))
        carried = ["doc_id", "label", "size", "copies", "data"]
        task = F.concat(F.lit("s"), F.pmod(F.xxhash64("label"), F.lit(bins)).cast("string"))
        small = rows.join(big, "label", "left_anti").select(*carried, task.alias("task"), F.lit(0).alias("side"), F.lit(False).alias("big"))
        # blocks of the large groups, and the pairs of them whose sizes can agree
        cut = bands.join(big, "label", "left_semi").withColumn("parts", F.ceil(F.greatest(F.col("w") / row_block, F.col("members") / ROWS)).cast("int"))
        block = _small(cut.select("label", "band", "parts"))
        placed = rows.join(block, ["label", "band"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        whole = cut.select("label", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        left, right = (whole.select("label", F.col("band").alias(f"band_{x}"), F.col("part").alias(f"part_{x}")) for x in "ij")
        near = (F.abs(F.col("band_i") - F.col("band_j")) <= 2) & (F.struct("band_i", "part_i") <= F.struct("band_j", "part_j"))
        met = left.join(right, "label").where(near).withColumn("task", F.concat_ws("-", "label", "band_i", "part_i", "band_j", "part_j"))
        other = (F.col("band_i") != F.col("band_j")) | (F.col("part_i") != F.col("part_j"))
        sides = met.select("label", "task", F.col("band_i").alias("band"), F.col("part_i").alias("part"), F.when(other, 0).otherwise(-1).alias("side"))
        sides = sides.unionByName(met.where(other).select("label", "task", F.col("band_j").alias("band"), F.col("part_j").alias("part"), F.lit(1).alias("side")))
        large = placed.join(sides, ["label", "band", "part"]).select(*carried, "task", "side", F.lit(True).alias("big"))
        schema = "doc_a bigint, doc_b bigint, overlap bigint, jaccard double" if every_pair else "doc_id bigint, peer bigint, n bigint"
        return small.unionByName(large).groupBy("task").applyInPandas(_multiply(s, every_pair), schema)


def pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, **sizes: int) -> DataFrame:
    """(doc_a, doc_b, overlap, jaccard): the links between different texts, each under its lowest id, the lower one first."""
    return Join(df, id_col, text_col, n, threshold, every_pair=True, **sizes).product


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, **sizes: int) -> DataFrame:
    """(doc_id, class_id, n_links): for each id the lowest id of the documents it hangs together with by links, itself if there
    are none, and the number of documents it is linked with, copies included."""
    j = Join(df, id_col, text_col, n, threshold, **sizes)
    linked = materialise(j.product, "linked")
    label = components(linked.select(F.col("doc_id").alias("a"), F.col("peer").alias("b"))).select(F.col("id").alias("rep"), "label")
    times = linked.groupBy(F.col("doc_id").alias("rep")).agg(F.sum("n").alias("n"))
    known = _small(materialise(label.join(times, "rep"), "labels"))
    out = j.members.join(known, "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    blank = df.where(F.col(f"`{text_col}`").isNull() & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id")).distinct()
    blank = blank.join(j.members, "doc_id", "left_anti")
    return out.unionByName(blank.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, **sizes: int) -> DataFrame:
    """The rows, with all their columns, without those whose group has a document of lower id."""
    name = free("gone", df.columns)
    gone = materialise(classes(df, id_col, text_col, n, threshold, **sizes).where("doc_id <> class_id").select(F.col("doc_id").alias(name)), "gone")
    return df.join(_small(gone), F.col(f"`{id_col}`") == F.col(name), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read_spread(spark, sf_dir, "documents"))


SQL = f"""
WITH RECURSIVE
     one AS (SELECT doc_id, arg_min(text, CASE WHEN regexp_matches(text, '[^ \\t\\n\\f\\r]') THEN sha256(text) END) AS text FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id),
     words AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \\t\\n\\f\\r]+'), lambda w: w <> '') AS w FROM one WHERE text IS NOT NULL),
     grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {N} THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - {N - 2}), lambda i: array_to_string(w[i:i + {N - 1}], ' ')) END) AS g FROM words),
     sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
     shared AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
     kept AS (SELECT doc_id, g FROM grams SEMI JOIN shared USING (g)),
     met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap FROM kept a JOIN kept b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     links AS MATERIALIZED (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE overlap * {1 + THRESHOLD} >= {THRESHOLD} * (x.n + y.n)),
     reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
     least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
     times AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(b, doc_id)) AS class_id, coalesce(n, 0) AS n_links
FROM one LEFT JOIN least ON least.a = doc_id LEFT JOIN times ON times.a = doc_id
"""
