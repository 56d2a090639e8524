"""The sample, the arithmetic against plain loops and differences, and what is rejected."""

import numpy as np
import pandas as pd
import pytest

from sheafworks.llm import langid as L

FOREIGN = [
    "Il comune ha deciso che la nuova biblioteca sarà aperta anche la sera, perché molti studenti non hanno un posto tranquillo per studiare. La decisione è stata presa dopo una lunga discussione con i cittadini del quartiere.",
    "De gemeente heeft besloten dat de nieuwe bibliotheek ook in de avond open is, omdat veel studenten geen rustige plek hebben om te werken. Het besluit werd genomen na een lang gesprek met de bewoners van de wijk.",
    "A câmara decidiu que a nova biblioteca também estará aberta à noite, porque muitos estudantes não têm um lugar tranquilo para estudar. A decisão foi tomada depois de uma longa conversa com os moradores do bairro.",
    "Rada miasta zdecydowała, że nowa biblioteka będzie otwarta także wieczorem, ponieważ wielu studentów nie ma spokojnego miejsca do nauki. Decyzja zapadła po długiej rozmowie z mieszkańcami dzielnicy.",
    "Baraza la mji limeamua kwamba maktaba mpya itafunguliwa pia wakati wa jioni, kwa sababu wanafunzi wengi hawana mahali pa utulivu pa kusomea. Uamuzi huo ulifanywa baada ya mazungumzo marefu.",
]


def test_mean_brute_force():
    rng = np.random.default_rng(2)
    table = rng.normal(size=(1 << L.BUCKET_BITS, 3))
    texts = ["a", "Hello  world", "ça va ☃", "x" * 300, "\n one\ttwo "]
    buf, at = L._buffer(texts)
    got = L._mean(table, buf, at)
    for t, row in zip(texts, got):
        b = (" " + " ".join(t.lower().split()) + " ").encode()
        rows = []
        for k in L.ORDERS:
            for i in range(len(b) - k + 1):
                h = ((int.from_bytes(b[i : i + k], "big") + k) * 0x9E3779B97F4A7C15) % (1 << 64) >> (64 - L.BUCKET_BITS)
                rows.append(table[h])
        assert row == pytest.approx(np.mean(rows, axis=0))


def test_gradient_by_differences():
    rng = np.random.default_rng(3)
    emb, w = rng.normal(size=(1 << L.BUCKET_BITS, 4)), rng.normal(size=(4, 3))
    buf, at = L._buffer(["some text here", "ein kleiner Text", "x"])
    y, weight = np.array([0, 2, 1]), np.array([1.0, 0.5, 2.0])
    loss, by_w, hit, by_emb = L.gradient(emb, w, buf, at, y, weight)
    step = 1e-6
    for i, j in [(0, 0), (1, 2), (3, 1)]:
        moved = w.copy()
        moved[i, j] += step
        assert (L.gradient(emb, moved, buf, at, y, weight)[0] - loss) / step == pytest.approx(by_w[i, j], rel=1e-3, abs=1e-8)
    for k in range(0, len(hit), 5):
        moved = emb.copy()
        moved[hit[k], 1] += step
        assert (L.gradient(moved, w, buf, at, y, weight)[0] - loss) / step == pytest.approx(by_emb[k, 1], rel=1e-3, abs=1e-8)
    other = np.setdiff1d(np.arange(1 << L.BUCKET_BITS), hit)[:1]
    emb[other] += 1
    assert L.gradient(emb, w, buf, at, y, weight)[0] == loss


def test_sample_is_bounded(spark):
    """Null ids, one id for all rows, one text for all rows, very long texts: the sample depends on texts alone."""
    for ids in ("cast(null as bigint)", "7L", "id"):
        df = spark.range(5_000).selectExpr(f"{ids} as doc_id", "concat('text ', id) as text", "'en' as lang")
        texts, labels = L.sample(df, "text", "lang", 10)
        assert len(texts) == len(set(texts)) == 10 and set(labels) == {"en"}
        first = texts if ids.startswith("cast") else first
        assert texts == first
    one = spark.range(5_000).selectExpr("id as doc_id", "'same' as text", "'en' as lang").unionByName(spark.range(3).selectExpr("id as doc_id", "repeat('fin ', 100000) as text", "'fr' as lang"))
    texts, labels = L.sample(one, "text", "lang", 10)
    assert sorted(zip(labels, map(len, texts))) == [("en", 4), ("fr", L.SAMPLE_CHARS)]


def test_rejects_other_languages():
    d = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    m = L.train(d["text"][:600].tolist(), d["lang"][:600].tolist())
    assert not any(ok for _, _, ok in L.predict(m, FOREIGN))
    rest = L.predict(m, d["text"][600:])
    assert np.mean([ok for _, _, ok in rest]) > 0.99
