"""Every operator and pipeline stage over nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sheafworks.llm import exact_dedup, hnsw, html_blocks, jaccard_join, kn_lm, langid, packing, secrets, sp_wfst, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
WORDS = {"en": "the of and to in that was for with his they this have from".split(), "fr": "le la les des une est dans pour pas sur avec tout mais elle".split()}


def prose(lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "ing", "tion", "eau", "ly"]) for _ in range(n))


LONG = prose("en", 60_000)
BASE = prose("en", 80)
ROWS = [(i, prose(lang, 40), lang, "s", 0) for i, lang in enumerate(["en", "fr"] * 12)] + [
    (100, None, "en", "s", None),
    (101, "", "en", "s", 0),
    (102, " \t\n ", None, None, 4),
    (103, LONG, "en", "s", len(LONG)),
    (104, BASE, "en", "s", len(BASE)),
    (105, BASE, "en", "s", len(BASE)),
    (105, BASE, "en", "s", len(BASE)),
    (106, BASE + " extra words here", "en", "s", 0),
    (107, BASE + " password=b7db7aa4a5fcc78305 " + prose("fr", 30), "en", "s", 0),
    (None, prose("fr", 30), "fr", "s", 0),
    (108, "", "en", "s", 0),
    (109, "one", "en", "s", 3),
]
#: names that operators use inside
CLASHING = ["id", "label", "digest", "shard", "bin", "block", "data", "size", "part", "task", "h", "n", "p", "a", "b", "old", "v", "gram", "start", "length", "found", "row", "winner", "lo", "entries"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, DOCS)
    return d.select("*", *[F.lit("x").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, none, k):
    stage = corpus_pipeline.STAGES[k][1]
    out = stage(spark, docs, "")
    if k < 4:
        assert out.columns == docs.columns
        assert out.count() > 20
        assert stage(spark, none, "").columns == docs.columns
    assert stage(spark, none, "").count() == 0


def test_language_id(spark, docs, none):
    model = langid.fit(docs)
    got = {(r.doc_id, r.label, r.accepted) for r in langid.identify(docs, model).collect()}
    assert {(100, None, False), (101, None, False), (102, None, False)} <= got
    assert sum(1 for i, lang, ok in got if ok and i is not None and i < 24 and lang == ["en", "fr"][i % 2]) >= 22
    assert langid.identify(none, langid.fit(none)).count() == 0
    assert not langid.identify(docs, langid.fit(none)).where("accepted").count()


def test_exact_dedup(spark, docs, none):
    kept = exact_dedup.keep_first(docs)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids.count(104) == 1 and 105 not in ids and ids.count(101) == 1 and 108 not in ids and 100 in ids and 103 in ids
    assert kept.where("doc_id is null").count() == 1
    plain = docs.select("doc_id", "text")
    for cut in (F.lit(True), F.lit(False), F.col("doc_id") < 105, F.col("doc_id") < 50):
        got = {r.doc_id: r.copies for r in exact_dedup.decide(plain, cut, shard_digests=7).collect()}
        assert got[104] == 3 and got[101] == 2 and 105 not in got and len(got) == len({t for _, t, *_ in ROWS if t is not None}) + 1
    assert exact_dedup.decide(none.select("doc_id", "text"), F.lit(True)).count() == 0


def test_near_dedup(spark, docs, none):
    p = {(r.doc_a, r.doc_b) for r in jaccard_join.pairs(docs).collect()}
    assert p == {(104, 106), (104, 107), (106, 107)} or p == {(104, 106), (104, 107)}
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(docs).collect()}
    assert len(got) == len({i for i, *_ in ROWS if i is not None}) and {got[i][0] for i in (104, 105, 106, 107)} == {104} and got[104][1] == 3
    assert all(got[i] == (i, 0) for i in (100, 101, 102, 103, 108, 109))
    kept = jaccard_join.keep_one(docs).collect()
    ids = [r.doc_id for r in kept]
    assert 104 in ids and 106 not in ids and 100 in ids and None in ids and 101 in ids and 109 in ids
    assert jaccard_join.pairs(none).count() == 0 and jaccard_join.classes(none).count() == 0
    assert "gone" in jaccard_join.keep_one(docs.withColumn("gone", F.lit(1)).withColumn("__gone", F.lit(1))).columns
    with pytest.raises(TypeError):
        jaccard_join.classes(docs.withColumn("doc_id", F.lit("a")))


def test_secrets(spark, docs, none):
    f = secrets.scan(docs).collect()
    assert [(r.doc_id, r.is_secret) for r in f] == [(107, True)]
    text = {r.doc_id: (r.text, r.n_chars) for r in secrets.mask_secrets(docs).collect()}
    assert "password=[SECRET] " in text[107][0] and text[107][1] == len(text[107][0]) and text[100] == (None, None) and text[103][0] == LONG
    assert secrets.scan(none).count() == 0


def test_packing(spark, docs, none):
    got = packing.pack_documents(docs, shard_chars=100_000).collect()
    texts = {}
    for b in got:
        assert sum(b.lengths) == b.used <= b.capacity and b.capacity in packing.CAPACITIES and b.capacity == min(c for c in packing.CAPACITIES if c >= b.used)
        for i, s, n in zip(b.doc_ids, b.starts, b.lengths):
            texts.setdefault(i, []).append((s, n))
    assert sorted(texts[103])[-1][0] + sorted(texts[103])[-1][1] == len(LONG) and len(texts[105]) == 2 and None in texts and 100 not in texts and 101 not in texts
    assert packing.pack_documents(none).count() == 0


def test_sentencepiece(spark, docs, none):
    enc = sp_wfst.encode(docs).cache()
    rows = {r.doc_id: r for r in enc.collect()}
    assert rows[100].ids is None and rows[100].n_pieces is None and rows[101].ids == [] and all(r.round_trip for r in rows.values() if r.ids is not None)
    back = {r.doc_id: r.text for r in sp_wfst.decode(enc).collect()}
    assert back[103] == LONG and back[100] is None and back[101] == "" and back[102] == " \t\n "
    assert sp_wfst.encode(none).count() == 0


def test_language_model(spark, docs, none):
    m = kn_lm.train(spark, docs)
    rows = {r.doc_id: r for r in kn_lm.score(docs, m).collect()}
    assert rows[100].perplexity is None and rows[101].n_symbols == 1 and rows[103].n_symbols == len(" ".join(LONG.split())) + 1 and 1 < rows[103].perplexity < 20
    assert kn_lm.score(none, kn_lm.train(spark, none)).count() == 0


def test_neighbours(spark):
    x = np.random.default_rng(1).normal(size=(60, 8))
    vec = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(100, None), (101, []), (102, [0.0] * 8), (103, [1.0, float("nan")] * 4), (104, [1.0] * 5), (None, [1.0] * 8), (7, [float(v) for v in x[7]]), (200, [float(v) for v in x[3]])]
    d = spark.createDataFrame(vec, "vec_id long, embedding array<double>").select("*", *[F.lit("x").alias(c) for c in ("shard", "v", "cell", "found", "piece", "ids", "best")])
    rows = {r.vec_id: r for r in hnsw.neighbours(d, k=5, shard_vectors=25).collect()}
    assert all(rows[i].neighbours is None for i in (100, 101, 102, 103, 104, None)) and len(rows) == 60 + 7
    assert rows[3].neighbours[0] == 200 and rows[200].neighbours[0] == 3 and all(len(rows[i].neighbours) == 5 and i not in rows[i].neighbours for i in range(60))
    assert hnsw.neighbours(d.limit(0)).count() == 0
    one = hnsw.neighbours(d.where("vec_id = 5")).collect()
    assert one[0].neighbours == []


def test_html(spark):
    page = "<html><body><nav><a href='/'>Home</a></nav><p>" + "This is the text of the page and it was written for the reader to see. " * 5 + "</p><p>Short one.</p><p>" + "And this is the rest of it, which is also for the reader of the page. " * 5 + "</p><footer>© x</footer>"
    d = spark.createDataFrame([(1, page), (1, page), (2, None), (3, ""), (4, "<p>a < b & c<script>never closed"), (5, "<!-- open"), (6, "<p>" + "the of and to " * 100_000)], "page_id long, html string").withColumn("text", F.lit("x"))
    rows = {r.page_id: r for r in html_blocks.extract_text(d).collect()}
    assert "Short one." in rows[1].text and "Home" not in rows[1].text and "©" not in rows[1].text
    assert rows[2].text is None and rows[3].text == "" and rows[5].n_blocks == 0 and rows[4].n_blocks == 1 and len(rows[6].text) == 1_400_000 - 1
    assert html_blocks.extract_text(d.limit(0)).count() == 0


def test_archives(spark):
    one = warc.version_block("a.arc", "20080101000000", 1) + warc.arc_record("http://a b/c", "20080102030405", "text/html", b"HTTP/1.1 200 OK\r\n\r\nhi", 1, "1.2.3.4")
    bad = one + b"http://x 1.2.3.4 20080102030405 text/html 99\nshort"
    d = spark.createDataFrame([("a", bytearray(one)), ("a", bytearray(one)), ("b", bytearray(bad)), ("c", None), ("d", bytearray(b"")), ("e", bytearray(b"nonsense\n"))], "arc_id string, content binary").withColumn("uri", F.lit(1))
    rows = warc.convert(d).collect()
    assert len([r for r in rows if r.arc_id == "a"]) == 4 and len({r.record_id for r in rows if r.arc_id == "a"}) == 2
    b = sorted((r for r in rows if r.arc_id == "b"), key=lambda r: r.position)
    assert [r.error is None for r in b] == [True, True, False] and b[1].uri == "http://a b/c" and b[1].date == "2008-01-02T03:04:05Z"
    assert not [r for r in rows if r.arc_id in "cd"] and [r.error for r in rows if r.arc_id == "e"] == ["no version block of version 1 or 2"]
    assert warc.convert(d.limit(0)).count() == 0
