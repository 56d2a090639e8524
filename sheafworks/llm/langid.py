"""Language ID: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are byte n-grams (orders 1-4) of the lower-cased text, without punctuation and without words that hold digits or signs of markup,
addresses and code, which belong to no language (a text of nothing else is taken as it is). Each is hashed to a bucket of an embedding table; a
text is the mean of its subwords' embeddings, classified by a linear softmax. Both layers are trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows: ``per_label`` different texts of each of the ``LABELS``
commonest labels, the first ``SAMPLE_CHARS`` characters of each (documented limits of the training alone).

Rejection is calibrated on held-out texts and pieces of texts. A temperature is fitted, then the confidence under which a
text is rejected: ``reject_rate`` of the held-out ones fall below. As a softmax over known languages says little about unknown
ones, a text's mean log frequency of subwords (over all labels alike) is compared to that of held-out texts of like length as
well, by how many times their usual deviation it falls below their median; the limit is ``MARGIN`` times what ``reject_rate`` of the
held-out ones exceed. Texts without any words but those that hold digits or signs are judged by confidence alone.

As both layers are linear, workers use their product (bucket → logits, log frequency), a table of fixed size. Whole texts are
scored. Defined results: null, empty and white-space texts have label null, confidence 0 and are rejected; equal
scores go to the first label in alphabetical order; repeated rows get equal results, and count once in the sample; ids may be null
or of any type; with no labelled row everything is rejected; further input columns are ignored (``identify``) or kept as they
are, whatever their names (``keep_identified``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks.session import read_spread

BUCKET_BITS, DIM, ORDERS = 16, 16, (1, 2, 3, 4)
PER_LABEL, LABELS, SAMPLE_CHARS = 600, 400, 20_000
MARGIN = 1.25
_ODD = re.compile(r"\S*[0-9@#$%&=_/\\<>{}\[\]*+|~^]\S*")
_SIGNS = re.compile(r"[!-&(-/:-@\[-`{-~\u00a1-\u00bf\u2010-\u2018\u201a-\u205e\u3000-\u3002\uff01-\uff0f]+")
WINDOW = 1 << 20  # bytes scored at once
REJECT_RATE = 0.001


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # buckets x labels: embeddings times weights; last column: log frequency
    temperature: float
    threshold: float
    usual: np.ndarray | None = None  # median and deviation of the log frequency, by length
    limit: float = np.inf


def _plain(text: str) -> tuple[str, bool]:
    """The words that count, in lower case, and whether there are any; otherwise all that there is."""
    words = _SIGNS.sub(" ", _ODD.sub(" ", text)).lower().split()
    return " ".join(words or text.lower().split()), bool(words)


def _buffer(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts, each between spaces, and where each begins; runs of white space become one space."""
    return _bytes(_plain(t)[0] for t in texts)


def _bytes(plain: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    enc = [b" " + t.encode("utf-8", "replace") + b" " for t in plain]
    lens = np.fromiter(map(len, enc), np.int64, len(enc))
    return np.frombuffer(b"".join(enc), np.uint8), np.concatenate([[0], np.cumsum(lens)])


def _grams(buf: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that begin at each byte, one row an order. Those over a text's end are the next text's."""
    pad = np.concatenate([buf, np.zeros(4, np.uint8)]).astype(np.uint64)
    window, n = np.zeros(len(buf), np.uint64), len(buf)
    out = np.empty((len(ORDERS), n), np.int32)
    for k in range(4):
        window = (window << np.uint64(8)) | pad[k : k + n]
        if k + 1 in ORDERS:
            h = (window + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
            out[ORDERS.index(k + 1)] = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    return out


def _mean(table: np.ndarray, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Means of the table's rows over each text's subwords, window by window, so that long texts take no more memory."""
    total = np.zeros((len(at) - 1, table.shape[1]))
    for lo in range(0, len(buf), WINDOW):
        n = min(len(buf), lo + WINDOW) - lo
        first = int(np.searchsorted(at, lo, "right")) - 1
        last = int(np.searchsorted(at, lo + n, "left"))
        cuts = np.maximum(at[first:last] - lo, 0)
        ends = at[first + 1 : last + 1] - lo
        for g, k in zip(_grams(buf[lo : lo + n + 3]), ORDERS):
            rows = table[g[:n]]
            for back in range(1, k):  # not over a text's end
                over = ends - back
                rows[over[(over >= 0) & (over < n)]] = 0
            total[first:last] += np.add.reduceat(rows, cuts, axis=0)
    count = sum(np.maximum(np.diff(at) - k + 1, 0) for k in ORDERS)
    return total / count[:, None]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pieces(texts: list[str], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Whole texts cut up at random lengths, so that short texts are learnt too."""
    out, of = [], []
    for t, y in zip(texts, labels):
        i = 0
        while i < len(t):
            n = int(np.exp(rng.uniform(np.log(12), np.log(1500))))
            if t[i : i + n].strip():
                out.append(t[i : i + n])
                of.append(y)
            i += n
    return out, np.array(of, dtype=np.int64)


def gradient(emb: np.ndarray, w: np.ndarray, buf: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Weighted cross-entropy of some texts, its gradient by w, and by the rows ``hit`` of emb."""
    n = len(y)
    hidden = _mean(emb, buf, at)
    p = _softmax(hidden @ w)
    loss = float(-(weight * np.log(p[np.arange(n), y].clip(1e-300))).sum() / n)
    p[np.arange(n), y] -= 1
    p *= weight[:, None] / n
    grad_h = p @ w.T
    lens = np.diff(at)
    per = grad_h / (sum(np.maximum(lens - k + 1, 0) for k in ORDERS))[:, None]
    each, grams = np.repeat(np.arange(n), lens), _grams(buf)
    left = np.repeat(at[1:], lens) - np.arange(len(buf))  # bytes to the text's end
    inside = np.stack([left >= k for k in ORDERS])
    flat, who = grams[inside], np.broadcast_to(each, grams.shape)[inside]
    hit, inv = np.unique(flat, return_inverse=True)
    acc = np.stack([np.bincount(inv, weights=per[who, d], minlength=len(hit)) for d in range(emb.shape[1])], axis=1)
    return loss, hidden.T @ p, hit, acc


def _frequencies(texts: list[str], y: np.ndarray, labels: int) -> np.ndarray:
    """Log of each bucket's frequency, averaged over labels."""
    total = np.zeros(1 << BUCKET_BITS)
    for k in range(labels):
        count = np.full(1 << BUCKET_BITS, 0.5)
        buf, _ = _buffer([t for t, of in zip(texts, y) if of == k])
        for lo in range(0, len(buf), WINDOW):
            for g in _grams(buf[lo : lo + WINDOW]):
                count += np.bincount(g, minlength=1 << BUCKET_BITS)
        total += count / count.sum() / labels
    return np.log(total)


def _length(n: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(n, 1)).astype(np.int64)


def _unusual(usual: np.ndarray, n: np.ndarray, score: np.ndarray) -> np.ndarray:
    """How many deviations below that of like texts a log frequency is."""
    middle, sd = usual[np.minimum(_length(n), len(usual) - 1)].T
    return (middle - score) / sd


def train(texts: list[str], labels: list[str], reject_rate: float = REJECT_RATE, epochs: int = 3, rate: float = 4.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over pieces of the texts; a fifth of the texts is held out for calibration."""
    names = sorted(set(labels))
    if not names:
        return Model([], np.zeros((1 << BUCKET_BITS, 1), np.float32), 1.0, np.inf)
    rng = np.random.default_rng(seed)
    y = np.array([names.index(x) for x in labels])
    order = rng.permutation(len(texts))
    held, used = (order[: len(order) // 5], order[len(order) // 5 :]) if len(order) >= 20 else (order, order)
    pieces, py = _pieces([texts[i] for i in used], y[used], rng)
    emb = rng.normal(0, 0.01, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    w = rng.normal(0, 0.3, (DIM, len(names))).astype(np.float32)
    weight = 1.0 / np.bincount(py, minlength=len(names)).clip(1)
    weight = weight / weight[py].mean()
    for epoch in range(epochs):
        perm = rng.permutation(len(pieces))
        for lo in range(0, len(perm), 64):
            part = perm[lo : lo + 64]
            buf, at = _buffer([pieces[i] for i in part])
            _, by_w, hit, by_emb = gradient(emb, w, buf, at, py[part], weight[py[part]])
            step = rate * (1 - (epoch * len(perm) + lo) / (epochs * len(perm)))
            w -= (0.1 * step * by_w).astype(np.float32)
            emb[hit] -= (step * len(part) * by_emb).astype(np.float32)
    logs = _frequencies([texts[i] for i in used], y[used], len(names))
    table = np.ascontiguousarray(np.column_stack([emb @ w, logs]), dtype=np.float32)
    hp, hy = _pieces([texts[i] for i in held], y[held], rng)
    plain = [_plain(t) for t in [*(texts[i] for i in held), *hp] if t.strip()]
    buf, at = _buffer(hp)
    logits = _mean(table, buf, at)[:, :-1]
    grid = np.exp(np.linspace(np.log(0.02), np.log(5), 60))
    nll = [-np.log(_softmax(logits / t)[np.arange(len(hy)), hy].clip(1e-12)).mean() if len(hy) else 0.0 for t in grid]
    temperature = float(grid[int(np.argmin(nll))])
    buf, at = _bytes(t for t, _ in plain)
    out, n, worded = _mean(table, buf, at), np.diff(at), np.array([ok for _, ok in plain], bool)
    conf = _softmax(out[:, :-1] / temperature).max(axis=1)
    # median and deviation by length; where too few texts have a length, with those of the lengths next to it
    score, n, usual, limit = out[worded, -1], n[worded], np.zeros((24, 2)), np.inf
    if len(n):
        size = _length(n)
        for k in range(len(usual)):
            near = np.abs(size - k)
            own = score[near <= np.sort(near)[min(len(near), 50) - 1]]
            usual[k] = np.median(own), max(np.median(own) - np.quantile(own, 0.16), 0.05)
        limit = MARGIN * float(np.quantile(_unusual(usual, n, score), 1 - reject_rate))
    threshold = float(np.quantile(conf, reject_rate)) if len(names) > 1 else 0.0
    return Model(names, table, temperature, threshold, usual, limit)


def predict(model: Model, texts: Iterable[str | None], chunk: int = 1 << 20) -> list[tuple[str | None, float, bool]]:
    """(label, confidence, accepted) of each text."""
    texts = list(texts)
    out: list[tuple[str | None, float, bool]] = [(None, 0.0, False)] * len(texts)
    if not model.labels:
        return out
    todo: list[int] = []
    size = 0

    def flush() -> None:
        plain = [_plain(texts[i]) for i in todo]
        buf, at = _bytes(t for t, _ in plain)
        got = _mean(model.table, buf, at)
        p = _softmax(got[:, :-1] / model.temperature)
        best, odd = p.argmax(axis=1), _unusual(model.usual, np.diff(at), got[:, -1])
        for i, k, c, z, (_, worded) in zip(todo, best.tolist(), p[np.arange(len(best)), best].tolist(), odd.tolist(), plain):
            out[i] = (model.labels[k], round(c, 6), c >= model.threshold and (z <= model.limit or not worded))

    for i, t in enumerate(texts):
        if t is None or not t.strip():
            continue
        todo.append(i)
        size += len(t)
        if size >= chunk:
            flush()
            todo, size = [], 0
    if todo:
        flush()
    return out


def sample(df: DataFrame, text_col: str, label_col: str, per_label: int) -> tuple[list[str], list[str]]:
    """At most ``per_label`` different texts of each label, those of the least hashes of the text, whatever their ids and however
    often they repeat. Labels, texts and characters are limited, and so is what the driver holds."""
    d = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").cast("string").alias("label")).where("label is not null and trim(text) <> ''")
    d = d.select("label", "text", F.xxhash64("text").alias("h"))
    kinds = {r["label"]: r["kinds"] for r in d.groupBy("label").agg(F.approx_count_distinct("h").alias("kinds"), F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(LABELS).collect()}
    if not kinds:
        return [], []
    # by hash about twice as many as are wanted (all of rare labels), then exactly as many
    spread = 1 << 30
    limit = F.create_map(*[x for k, n in kinds.items() for x in (F.lit(k), F.lit(min(spread, int(spread * (2 * per_label + 50) / n) + 1) if n > 2 * per_label else spread))])
    few = d.where(F.pmod("h", F.lit(spread)) < limit[F.col("label")]).groupBy("label", "h").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    order = Window.partitionBy("label").orderBy(F.pmod("h", F.lit(spread)), "h")
    rows = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_label).select("label", "h", "text").toPandas()
    rows = rows.sort_values(["label", "h"], kind="stable")
    return rows["text"].tolist(), rows["label"].tolist()


def fit(df: DataFrame, text_col: str = "text", label_col: str = "lang", per_label: int = PER_LABEL, reject_rate: float = REJECT_RATE) -> Model:
    return train(*sample(df, text_col, label_col, per_label), reject_rate=reject_rate)


_OUT = T.StructType([T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("accepted", T.BooleanType())])


def _udf(model: Model):
    @F.pandas_udf(_OUT)
    def classify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(predict(model, texts), columns=["label", "confidence", "accepted"])

    return classify


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    d = df.select(F.col(f"`{id_col}`").alias("doc_id"), _udf(model)(F.col(f"`{text_col}`")).alias("p"))
    return d.select("doc_id", F.col("p.label").alias("label"), F.col("p.confidence").alias("confidence"), F.col("p.accepted").alias("accepted"))


def keep_identified(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that aren't rejected, with all their columns."""
    return df.where(_udf(model)(F.col(f"`{text_col}`"))["accepted"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_spread(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
