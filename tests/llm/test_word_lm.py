"""The word model against a brute-force one: each word stands for one character of the character model's brute force."""

import pandas as pd
import pytest

from sheafworks.llm import kn_lm, registry, word_lm

from test_methods import SF, brute_kn


def test_word_model_brute_force(spark):
    texts = pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist()
    train, other = texts[:40], [*texts[:6], *texts[100:106], "", "zzz qqq", "of the zzz and of the", " ".join(reversed(texts[3].split()))]
    ids: dict[str, str] = {}
    as_one = lambda t: "".join(ids.setdefault(w, chr(0x20000 + len(ids))) for w in t.lower().split())
    df = lambda t: spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = word_lm.score(df(other), word_lm.train(spark, df(train))).orderBy("doc_id").collect()
    assert [r.log10_prob for r in got] == pytest.approx(brute_kn([as_one(t) for t in train], kn_lm.ORDER, [as_one(t) for t in other]), rel=1e-6, abs=1e-6)
    assert got[-1].log10_prob < got[3].log10_prob  # the same words in another order


def test_word_model_small(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (3, "a b a b"), (3, "a b a b"), (4, "A  b\ta B")], "doc_id long, text string")
    m = word_lm.train(spark, df)
    rows = word_lm.score(df, m).collect()
    by = sorted(((r.doc_id or 0, r.n_symbols, r.log10_prob and round(r.log10_prob, 9)) for r in rows), key=str)
    assert len(rows) == 5 and by[0][1] == 1 and by[1] == (1, None, None) and by[2] == by[3] and by[4][1:] == by[2][1:]
    assert by[2][1] == 5
    none = df.limit(0)
    assert word_lm.score(none, word_lm.train(spark, none)).count() == 0


def test_query_counts_words(spark):
    want = {d: len(t.lower().split()) + 1 for d, t in pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False) if t is not None}
    got = {r.doc_id: r.n_symbols for r in registry.QUERIES["op6_lm_scoring"](spark, SF).collect() if r.n_symbols is not None}
    assert got == want


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_sum_to_one(spark, order):
    """After contexts that occur, occur in part and never occur: all words of the corpus, the end and one unknown word."""
    import numpy as np

    texts = pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist()[:12]
    m = word_lm.train(spark, spark.createDataFrame([(t,) for t in texts], "text string"), order=order)
    known = word_lm._Words()
    words = sorted({w for t in texts for w in t.lower().split()})
    codes = [known[w] for w in words] + [word_lm.EOS, known["never-seen-word"]]
    first = texts[0].lower().split()
    contexts = [[word_lm.BOS] * (order - 1), [known[w] for w in first[: order - 1]], [known["never-seen-word"], known[first[0]]][: order - 1], [known["x-y"], known["never-seen-word"]][: order - 1]]
    rows = [(i * 100_000 + k, bytearray(np.array([*c, w], "<u8").tobytes())) for i, c in enumerate(contexts) for k, w in enumerate(codes)]
    got = word_lm._score_grams(spark.createDataFrame(rows, "h long, gram binary"), m).toPandas()
    assert len(got) == len(rows)
    total = (10 ** got["v"]).groupby(got["h"] // 100_000).sum()
    assert total.tolist() == pytest.approx([1.0] * len(contexts), rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_words_before_many_positions(spark, order):
    """Shards so small that contexts of every length, and one whole n-gram, are split."""
    texts = pd.read_parquet(f"{SF}/documents.parquet")["text"].tolist()
    train = [*(" ".join(t.split()[:60]) for t in texts[:30]), *["a a a a a a a a a b"] * 40]
    other = [*train[:4], train[-1], *(" ".join(t.split()[:60]) for t in texts[100:104]), "", "zzz qqq a a a a a zzz", "of the zzz and of the"]
    ids: dict[str, str] = {}
    as_one = lambda t: "".join(ids.setdefault(w, chr(0x20000 + len(ids))) for w in t.lower().split())
    df = lambda t: spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    one = df(train)
    m = word_lm.train(spark, one, order=order, shard=150)
    assert word_lm._plan(one, "text", order, 150).depth == order
    for table, own in ((one, train), (df(other), other)):
        got = word_lm.score(table, m).orderBy("doc_id").collect()
        assert [r.log10_prob for r in got] == pytest.approx(brute_kn([as_one(t) for t in train], order, [as_one(t) for t in own]), rel=1e-6, abs=1e-6)


def test_disk_a_word(spark):
    """What the query writes, its shuffles and tables, against the words it counts."""
    from pathlib import Path

    from sheafworks.session import local_path, shared_uri

    shared = Path(local_path(shared_uri(spark)))
    executors = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True)
    used = lambda: sum(p.stat().st_size for p in shared.rglob("*") if p.is_file()) + sum(executors().apply(i).totalShuffleWrite() for i in range(executors().size()))
    before = used()
    words = sum(r.n_symbols or 0 for r in registry.QUERIES["op6_lm_scoring"](spark, SF).collect())
    assert used() - before < 30 * words  # a small table: most words are new


def test_words_of_any_length():
    """A word's hash has all its bytes in their order."""
    long = ["a" * 300 + "b" + "c" * 300, "c" + "a" * 299 + "b" + "c" * 299 + "a", "a" * 300 + "c" + "b" + "c" * 299, "é", "e", "ee", ""]
    assert len({word_lm._Words()[w] for w in long if w}) == 6
    codes, lens = word_lm.symbols(["A  b\ta", "", " ".join(long)], 3)
    k = word_lm._Words()
    assert lens.tolist() == [6, 3, 9] and codes.tolist() == [0, 0, k["a"], k["b"], k["a"], 1, 0, 0, 1, 0, 0, *(k[w] for w in long if w), 1]


def test_memory_a_position():
    """Most that a shard's decoding, counting and scoring hold at once, beside the bundles it gets."""
    import tracemalloc

    import numpy as np

    n, rng = 200_000, np.random.default_rng(1)
    words = np.unique(rng.integers(2, 1 << 63, 3000, dtype=np.uint64))
    codes = words[(len(words) * rng.random(n) ** 3).astype(int)]
    plan = word_lm._Plan(5, 1, [np.zeros(0, np.uint64)] * 4, words[:1000])
    bundles = [x for _, x in word_lm._bundles(plan, codes, np.arange(4, n), np.arange(4, n) // 100, None)]
    tracemalloc.start()
    try:
        for s, rows, _ in word_lm._decoded(bundles, plan):
            out = s.log10(np.full(len(s.base[0]), 1e-3), dict.fromkeys(range(1, 6), (0.5, 1.0, 1.5)))
            assert len(out) == len(rows) == n - 4
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 150 * n


@pytest.mark.skipif(not word_lm._TRIM, reason="no malloc_trim")
def test_tasks_give_memory_back():
    """What a task freed doesn't stay with its worker, though something above it is still in use."""
    from pathlib import Path

    import numpy as np

    def rss() -> int:
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096

    kept = []

    def run(items):
        held = [np.zeros(2000, np.uint8) + np.uint8(x) for x in items for _ in range(60_000)]
        kept.append((rss(), held[-1]))
        yield len(held)

    word_lm._release()
    before = rss()
    assert list(word_lm._freed(run)([1])) == [60_000]
    assert kept[0][0] - before > 100e6 and rss() - before < 40e6
