"""Hand-made edge cases, and expressions against small plain-Python versions."""

import io
import random
import re
import tarfile
import unicodedata
import urllib.parse
import zipfile

import pytest
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.functions import geometry as G
from sheafworks.functions import text as X
from sheafworks.functions import url as U
from sheafworks.functions.logs import error_codes
from sheafworks.operators import audit, datasets, download, labels, layout, structure, tables, urls, whitelist
from sheafworks.sources import readers, sinks
from sheafworks.streaming import flows


def column(spark, values, kind, expr):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("o")).collect()]


def test_doc_url(spark):
    v = ["http://a.com/x.doc", "http://a.com/x.DOC", "http://a.com/x.docx\n", "http://a.com/a b.doc", "www.a.com/x.doc", "http://ab.com/xé.docx", ".doc", "http://a/x.docm", None]
    assert column(spark, v, "string", U.is_doc_url) == [bool(re.match(r"(^(www|http:|https:)+[^\s]+[\w]\.(doc|docx)$)", x)) if x is not None else None for x in v]


def test_unquote(spark):
    v = ["a+b", "%2B", "%zz", "%", "%41%", "%C3%A9", "é%20x", "", "http://x/%e2%82%ac?a=%zz+%20", None]
    assert column(spark, v, "string", U.unquote) == [urllib.parse.unquote(x) if x is not None else None for x in v]


def plain_clean(u):
    starts = [m.start() for m in re.finditer("http", u)]
    ends = [m.start() + (5 if u[m.start() : m.start() + 5] == ".docx" else 4) for m in re.finditer(r"\.doc", u)]
    if not starts or not ends:
        return None
    m = min(ends)
    if len(starts) == 1:
        s = starts[0]
    elif len(ends) == 1:
        s = starts[-1]
    else:
        s = starts[max(0, sum(x < m for x in starts) - 1)]
    return u[s:m] if s < m else ""


def test_clean_url(spark):
    rng = random.Random(1)
    v = ["".join(rng.choice(["http", ".doc", ".docx", "x", "://a", "/"]) for _ in range(rng.randint(0, 9))) for _ in range(400)] + [""]
    assert column(spark, v, "string", U.clean_url) == [plain_clean(u) for u in v]


def test_names(spark):
    assert column(spark, [5, 123456789, 1234567890], "long", lambda c: U.zero_filled(c, 9)) == ["000000005", "123456789", "1234567890"]
    assert column(spark, ["a/b.docx", "a.b/c", ".hidden", "x.tar.gz", ""], "string", U.extension) == [".docx", "", "", ".gz", ""]
    assert column(spark, ["z/doc_ab_doc_c.doc", "none"], "string", U.member_id) == ["ab_c.doc", "none"]
    assert column(spark, ["doc_x_p00012", "a_p1_p00003", "bad"], "string", U.page_number) == [12, 3, None]
    with pytest.raises(Exception, match="no crawl id"):
        column(spark, ["x"], "string", U.crawl_of)


def test_text_metrics(spark):
    v = ["", "...!", "一二三 a1", "½ x", "a　b c", "Hello, World 42", "é" * 3]
    df = spark.createDataFrame(list(enumerate(v)), "i int, v string")
    rows = df.orderBy("i").select(*[c.alias(k) for k, c in X.metrics(F.col("v")).items()]).collect()
    for t, r in zip(v, rows):
        words = t.translate({ord(c): None for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"}).lower().split()
        assert (r.word_count, r.char_count) == (len(words), len(t))
        assert r.alph_chars_count == sum(c.isalpha() for c in t) and r.numeric_chars_count == sum(c.isnumeric() for c in t) and r.alphnum_chars_count == sum(unicodedata.category(c)[0] in "LN" for c in t)


def test_normalised(spark):
    v = ["  Àé １２ — x…\n", "", " \t ", "a\tb\x07c", "«q» “z” ½", "．", None]
    got = column(spark, v, "string", X.normalised)
    assert got == ["ae 00  -  x...", "", "", "abc", '"q" "z" ½', ". ", None]


def test_short_numbers(spark):
    v = [0.0, 0.5, 1.0, 0.0005, 0.00012345678912, 0.123456789012, 1 / 3, 123.25, 0.1]
    assert column(spark, v, "double", X.short_number) == [str(x)[:10] for x in v]


def test_top_label(spark):
    df = spark.sql("select map('a', 0.2D, 'b', 0.9D, 'c', 0.9D) m union all select map() union all select null")
    assert [(r.t.label if r.t else None) for r in df.select(X.top_label(F.col("m")).alias("t")).collect()] == ["b", None, None]


def test_error_codes(spark):
    v = ["HTTP HEAD request HTTPError=404", "HTTP HEAD request what", "HTTP HEAD request TooManyRedirects", "HTTP GET no response", "x max filesize", "maldoc not passed: vba = 1, xlm=2", "maldoc not passed: a suspicious b,none", "Batch handler error", "other"]
    assert column(spark, v, "string", error_codes) == [["HTTP-404"], ["HTTP-Other"], ["HTTP-TooManyRedirects"], ["HTTP-None"], ["MaxFileSize"], ["maldoc-vba", "maldoc-xlm"], ["maldoc-suspicious"], [], ["Other"]]


def _box(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, ax double, ay double, aw double, ah double, bx double, by double, bw double, bh double")


def test_geometry(spark):
    rows = [(0, 0, 10, 10, 10, 0, 5, 5), (0, 0, 10, 10, 20, 20, 5, 5), (0, 0, 10, 10, 2, 2, 3, 3), (0, 0, 10, 10, 5, 5, 10, 10), (0, 0, 0, 5, 0, 0, 9, 9)]
    df = _box(spark, [tuple(map(float, r)) for r in rows]).orderBy("i")
    a, b = G.box(*[F.col("a" + k) for k in "xywh"]), G.box(*[F.col("b" + k) for k in "xywh"])
    got = df.select(G.overlap_area(a, b).alias("o"), G.distance(a, b).alias("d"), G.contained(b, a).alias("c"), G.overlap_ratio(a, b).alias("r")).collect()
    assert [r.o for r in got] == [0.0, 0.0, 9.0, 25.0, 0.0]
    assert [round(r.d, 4) for r in got] == [0.0, 14.1421, 0.0, 0.0, 0.0]
    assert [r.c for r in got] == [False, False, True, False, False] and got[4].r is None
    assert df.select(G.overlap_area(F.lit(None).cast(S.BOX), b).alias("o")).first().o is None


def test_size_filter(spark):
    df = spark.createDataFrame([(10, 6.0, 6.0), (10, 5.0, 6.0), (26, 1.0, 1.0), (26, 0.0, 0.0)], "c int, w double, h double")
    ok = df.select(layout.big_enough(F.col("c"), G.box(F.lit(0.0), F.lit(0.0), F.col("w"), F.col("h")), F.lit(650.0), F.lit(650.0)).alias("k")).collect()
    assert [r.k for r in ok] == [True, False, True, True]


def plain_rows(cells):
    out = []
    for y in {c[1] for c in cells}:
        near = [c for c in cells if abs(c[1] - y) <= 5]
        top, h = max(c[1] for c in near), min(c[3] for c in near)
        cover = [c for c in cells if c[1] <= top + 2.5 and c[1] + c[3] >= top + h - 2.5]
        x = min(c[0] for c in cover)
        out.append((y, x, top, max(c[0] + c[2] for c in cover) - x, h))
    return sorted(out)


def test_table_rows(spark):
    rng = random.Random(2)
    groups = {"chain": [(0.0, 0.0, 5.0, 4.0), (5.0, 4.0, 5.0, 4.0), (9.0, 8.0, 5.0, 4.0)], "five": [(0.0, 0.0, 5.0, 5.0), (6.0, 5.0, 5.0, 5.0)], "merged": [(0.0, 0.0, 5.0, 20.0), (6.0, 0.0, 5.0, 9.0), (6.0, 10.0, 5.0, 10.0)], "one": [(1.0, 2.0, 3.0, 4.0)]}
    for k in range(20):
        groups[f"r{k}"] = [tuple(float(rng.randint(0, 30)) for _ in range(2)) + tuple(float(rng.randint(1, 12)) for _ in range(2)) for _ in range(rng.randint(1, 9))]
    df = spark.createDataFrame([(t, *c) for t, cs in groups.items() for c in cs], "table_id string, x double, y double, width double, height double").select("table_id", G.box(*map(F.col, ("x", "y", "width", "height"))).alias("bbox"))
    got = {}
    for r in tables.rows(df).collect():
        got.setdefault(r.table_id, []).append((r.group_y, r.x, r.y, r.width, r.height))
    assert {t: sorted(v) for t, v in got.items()} == {t: plain_rows(c) for t, c in groups.items()}


def test_grid_matches_plain(spark):
    rng = random.Random(3)
    box = lambda: [float(rng.randint(0, 600)), float(rng.randint(0, 600)), float(rng.randint(0, 300)), float(rng.randint(0, 300))]
    w = spark.createDataFrame([(1, i, box()) for i in range(80)], "page_id int, word_id int, b array<double>").select("page_id", "word_id", G.box(*[F.col("b")[k] for k in range(4)]).alias("bbox"))
    e = spark.createDataFrame([(1, i, 10, box()) for i in range(40)], "page_id int, entity_id int, category int, b array<double>").select("page_id", "entity_id", "category", G.box(*[F.col("b")[k] for k in range(4)]).alias("bbox"))
    plain = {tuple(r) for r in layout.match(w, e, threshold=0.3).collect()}
    assert plain and {tuple(r) for r in layout.match_dense(w, e, threshold=0.3, cell=100.0).collect()} == plain and layout.match_dense(w, e, threshold=0.3, cell=100.0).count() == len(plain)


def test_whitelist_edges(spark):
    nan = float("nan")
    rows = [("a", "__label__en", 1.0, 0.5), ("b", "__label__en", 2.0, 0.5), ("c", "__label__en", nan, 0.9), ("d", "__label__fr", 5.0, 0.1), ("e", None, 5.0, 0.9), ("f", "__label__unknown", 1.0, 0.9), ("g", "__label__en", None, 0.9)]
    d = {r.url_hash: r for r in whitelist.judge_documents(spark.createDataFrame(rows, "url_hash string, top_lang string, perplexity double, quality double")).collect()}
    assert [d[k].blacklisted for k in "abcdefg"] == [True, True, True, True, False, True, True]  # the median is 0.9
    assert d["e"].bucket == "low-mid" and d["c"].bucket is None and d["b"].bucket == "high" and len(d) == 7
    kept = whitelist.judge_documents(spark.createDataFrame([("x", "__label__en", 3.0, 0.5), ("y", "__label__en", 3.0, 0.5)], "url_hash string, top_lang string, perplexity double, quality double"), ["__label__de"])
    assert not kept.where("blacklisted").count()  # equal to the median, equal to the threshold
    pages = [("p1", "x", 1, 1, 0, 0.9), ("p2", "x", 1, 1, 2, 0.9), ("p3", "x", 1, 0, 0, 0.9), ("p4", "x", 0, 0, 3, 0.9), ("p5", "x", 1, 0, 3, 0.5), ("p6", "x", 1, None, 3, 0.6)]
    p = spark.createDataFrame(pages, "page_id string, url_hash string, pdf_word_count int, num_heading_1 int, num_text int, top_lang_score double")
    assert sorted(r.page_id for r in whitelist.filter_pages(p, kept).collect()) == ["p1", "p2", "p6"]
    assert sorted(r.page_id for r in whitelist.filter_pages(p, kept, strict_headings=True).collect()) == ["p2", "p6"]


def test_url_tables(spark):
    raw = spark.createDataFrame([("http://a/x.doc", "CC-MAIN-2020-01"), ("http://a/x.doc", "CC-MAIN-2021-02"), ("nothing", "CC-MAIN-2020-01"), (None, "CC-MAIN-2020-01")], "url string, source string")
    rows = urls.clean(raw).collect()
    assert sorted((r.doc_id, r.url) for r in rows) == [("CC-MAIN-2020-01-000000000", None), ("CC-MAIN-2020-01-000000001", "http://a/x.doc"), ("CC-MAIN-2020-01-000000002", None)]
    assert urls.clean(raw, drop_null_urls=True).count() == 1
    h = spark.createDataFrame([("k1", "A"), (None, "A")], "url_hash string, source string")
    assert urls.global_dedup(h, h.limit(0)).count() == 2 and urls.global_dedup(h, h).count() == 2
    assert [r.url_hash for r in urls.global_dedup(h, spark.createDataFrame([("k1", "B")], "url_hash string, source string")).collect()] == [None]
    n = spark.range(10)
    for parts, sizes in ((3, [4, 3, 3]), (10, [1] * 10), (12, [1] * 10), (4, [3, 3, 2, 2])):
        got = urls.near_equal(n, ["id"], parts, "p").groupBy("p").count().orderBy("p").collect()
        assert [r["count"] for r in got] == sizes
    assert [r.pos for r in urls.global_position(spark.range(100), ["id"]).orderBy("id").collect()] == list(range(100))


def test_shard_rotation(spark):
    sizes = [60, 60, 10, 200, 5, 99, 1, 1]
    df = spark.createDataFrame([("w", i, s) for i, s in enumerate(sizes)], "g string, o int, s long")
    want, shard, total = [], 0, 0
    for s in sizes:
        want.append(shard)
        total += s
        if total > 100:
            shard, total = shard + 1, 0
    assert [r.shard for r in download.rotate_shards(df, "g", "o", "s", 100).orderBy("o").collect()] == want


def test_rates(spark):
    df = spark.createDataFrame([(i, 1, float(i // 2)) for i in range(6)], "i int, pages int, t double")
    got = audit.sliding_rate(df.withColumn("t", F.timestamp_seconds("t")), ["i"], "pages", "t", "t", rows=3).orderBy("i").collect()
    assert [r.pages_in_window for r in got] == [1, 2, 3, 3, 3, 3] and got[0].rate == 0.0 and got[2].rate == 3.0


def test_class_map():
    s = labels.Settings.parse({"elem_drops": [0, 3], "elem_mergings": {"masters": {"1": "heading"}, "mapping": {"2": 1, "3": 1}}})
    names, classes = labels.class_map(s)
    assert names[0] == "heading" and classes[1] == classes[2] == classes[3] == 0 and 0 not in classes and len(names) == 31 - 3
    assert labels.class_map(labels.Settings.parse({}))[1] == {k: k for k in range(31)}
    with pytest.raises(ValueError):
        labels.Settings.parse({"elem_mergings": {"masters": {}, "mapping": {"2": 1}}})
    q = labels.Settings.parse({"max_img": 9, "elem_mins": {"4": 2, "5": 3}}).quotas()
    assert [(x.elem_accepts, x.max_img) for x in q] == [((4,), 2), ((5,), 3)]


def test_quota_sample(spark):
    c = spark.createDataFrame([(f"p{i}", k) for i in range(10) for k in (1, 2) if (i + k) % 3], "page_id string, category int")
    got = datasets.quota_sample(c, {1: 100, 2: 2}, 8, F.md5("page_id")).collect()
    assert sum(r.chosen_by == "quota" for r in got) >= 6 and len({r.page_id for r in got}) == len(got) == max(8, sum(r.chosen_by == "quota" for r in got))
    assert datasets.quota_sample(c, {1: 3}, 0, F.md5("page_id")).count() == 3
    assert datasets.quota_sample(c, {}, 4, F.md5("page_id")).count() == 4


def test_structure(spark):
    v = ["Heading 1", "heading 12", "Intense Quote", "unknown", None, "List Bullet"]
    assert column(spark, v, "string", structure.style_entity) == [1, 1, S.ENTITY_IDS["quote"], None, None, S.ENTITY_IDS["list"]]
    t = ["Name ____", '"x"', "1. a", "a) b", "- x", "plain", "", "ab. c", "'"]
    i = S.ENTITY_IDS
    assert column(spark, t, "string", structure.content_entity) == [i["form_field"], i["quote"], i["list"], i["list"], i["list"], None, None, None, None]
    for s in ["Name: ____ Age: ......", "____", "", "none"]:
        df = spark.createDataFrame([(s,)], "v string")
        parts = df.select(structure.form_segments(F.col("v")).alias("p")).first().p
        assert [(p.text, p.label) for p in parts] == structure.split_form(s) and "".join(p.text for p in parts) == s


def test_headings(spark):
    fonts = spark.createDataFrame([("d", "30.0b", 10, 1), ("d", "20.0b", 40, 3), ("d", "20.0n", 40, 3), ("d", "12.0n", 900, 40), ("d", "8.0n", 20, 2)], "doc_id string, font string, n_chars long, n_paragraphs long")
    assert {r.font: r.level for r in structure.heading_levels(fonts).collect()} == {"30.0b": -20, "20.0b": 1, "20.0n": 2, "12.0n": -10, "8.0n": -10}
    runs = spark.createDataFrame([("d", 1, 1, "20.0b", "Head"), ("d", 1, 2, "12.0n", " "), ("d", 1, 3, "12.0n", "body text is longer"), ("d", 2, 1, "12.0n", "x"), ("d", 2, 2, "20.0b", "late")], "doc_id string, paragraph int, run int, font string, text string")
    got = {(r.paragraph, r.run): r.entity_id for r in structure.vote(runs, structure.heading_levels(fonts)).collect()}
    assert got == {(1, 1): 1, (1, 2): 10, (1, 3): 10, (2, 1): 10, (2, 2): 10}


def test_builtin_headings_and_marks(spark):
    kinds = "doc_id string, font string, n_chars long, n_paragraphs long"
    fonts = spark.createDataFrame([("d", "30.0b", 10, 3), ("d", "12.0n", 900, 40), ("d", "14.0n", 9, 2), ("e", "20.0n", 10, 2), ("e", "12.0n", 90, 9)], kinds)
    builtin = spark.createDataFrame([("d", "14.0n", 1), ("d", "14.0n", 2)], "doc_id string, font string, level int")
    got = {(r.doc_id, r.font): r.level for r in structure.heading_levels_with_builtin(fonts, builtin).collect()}
    assert got == {("d", "30.0b"): -10, ("d", "12.0n"): -10, ("d", "14.0n"): 2, ("e", "20.0n"): 1, ("e", "12.0n"): -10}
    texts = ['"quoted text"', "'a'", "1. item", "- item\nmore", "x) y", "plain", '""', "• b"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    kind = structure.content_entity(F.col("v"))
    for r in df.select("v", structure.split_affixes(F.col("v"), kind).alias("p")).collect():
        assert "".join(p.text for p in r.p) == r.v, r
    rows = {r.v: [(p.text, p.label) for p in r.p] for r in df.select("v", structure.split_affixes(F.col("v"), kind).alias("p")).collect()}
    assert rows["1. item"] == [("1. ", "mark"), ("item", "list")] and rows["'a'"] == [("'", "mark"), ("a", "quote"), ("'", "mark")]


def _docx(paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:rPr><w:lang w:val='en-US'/></w:rPr><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document xmlns:w='{w}'><w:body>{body}{table}</w:body></w:document>")
        z.writestr("docProps/app.xml", "<Properties xmlns='http://schemas.openxmlformats.org/officeDocument/2006/extended-properties'><Pages>3</Pages></Properties>")
        z.writestr("docProps/core.xml", "<c:coreProperties xmlns:c='x' xmlns:d='y'><d:title>T</d:title></c:coreProperties>")
    return out.getvalue()


def test_documents_and_tar(spark, tmp_path):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for n, c in (("doc_a.docx", _docx(["Hello", "", "World"])), ("doc_b.doc", b"\xd0\xcf"), ("note.txt", b"x")):
            info = tarfile.TarInfo(n)
            info.size = len(c)
            tar.addfile(info, io.BytesIO(c))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/s.tar.gz").write_bytes(buf.getvalue())
    (tmp_path / "in/bad.tar.gz").write_bytes(b"no tar")
    m = readers.tar_members(spark.read.format("binaryFile").load(str(tmp_path / "in")))
    assert m.where("error is not null").count() == 1
    rows = {r.member: r.docx for r in readers.documents(m.where("error is null")).collect()}
    d = rows["doc_a.docx"]
    assert d.text == "Hello\nWorld\na\tb" and d.pages == 3 and d.languages == ["en-US"] and d.core == {"title": "T"} and d.error is None
    assert rows["doc_b.doc"].error == "NoZipFile" and len(rows) == 2
    packed = sinks.tar_archives(m.where("error is null").withColumn("shard", F.lit("s1")), "shard")
    again = readers.tar_members(packed.select(F.col("shard").alias("path"), "content"))
    assert sorted(r.member for r in again.collect()) == ["doc_a.docx", "doc_b.doc"]


def test_archives_and_json(spark, tmp_path):
    payload = b'{"a": "http://x/y.doc", "b": [{"c": "www.z/q.docx"}, 1, null], "k.doc": {"d": "http://x/y.doc", "e": "no"}}'
    rec = lambda kind, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://t\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    import gzip

    (tmp_path / "a.wat.gz").write_bytes(gzip.compress(rec("warcinfo", b"x")) + gzip.compress(rec("metadata", payload)))
    d = readers.archives(spark.read.format("binaryFile").load(str(tmp_path)))
    assert [(r.type, r.target) for r in d.collect()] == [("metadata", "http://t")]
    found = readers.json_strings(d.select("target", F.decode("payload", "UTF-8").alias("j")), "j", ["target"], U.DOC_URL).collect()
    assert [r.value for r in found] == ["http://x/y.doc", "www.z/q.docx", "http://x/y.doc"]
    bad = readers.json_strings(spark.createDataFrame([(1, "{"), (2, None)], "i int, j string"), "j", ["i"])
    assert bad.count() == 0


def test_text_sources_and_sinks(spark, tmp_path):
    files = spark.createDataFrame([("p1", "0 0.5 0.5 0.1 0.1\n0 0.5 0.5 0.1 0.1\n3 1 1 1 1"), ("p2", "")], "page_id string, content string")
    assert sinks.write_label_files(files, str(tmp_path / "labels")) == 2
    lines = readers.yolo_labels(spark, str(tmp_path / "labels"))
    report = {r["class"]: r.n for r in datasets.label_report(lines, files.select("page_id")).collect()}
    assert report == {0: 1, 3: 1, -1: 1}
    (tmp_path / "l.jsonl").write_text('{"split":"train","filename":"f","html":{"cells":[{"bbox":[1,2,4,8]},{}]}}\nbroken\n')
    got = datasets.table_cell_boxes(readers.json_lines(spark, str(tmp_path / "l.jsonl"), S.TABLE_LINE).cache()).collect()
    assert [(r.x, r.y, r.width, r.height) for r in got] == [(1.0, 2.0, 3.0, 6.0)]
    (tmp_path / "c.json").write_text('{"images":[{"id":1,"file_name":"a.png","width":10,"height":10}],"annotations":[{"image_id":1,"category_id":2,"bbox":[0,0,5,10]}],"categories":[{"name":"t"}]}')
    r = datasets.coco_boxes(readers.coco(spark, str(tmp_path / "c.json"))).first()
    assert (r["class"], r.cx, r.cy, r.w, r.h) == (1, 0.25, 0.5, 0.5, 1.0)
    (tmp_path / "w.log").write_text("a::INFO::downloading doc\nb::ERROR::HTTP GET no response\n")
    logs = readers.logs(spark, str(tmp_path / "w.log"))
    assert audit.worker_counters(logs).first().n_downloads == 1 and audit.error_histogram(logs).first().code == "HTTP-None"
    assert "nc: 2" in sinks.dataset_yaml("n", "/r", ["a", "b"])
    shards = sinks.shard_json(spark.createDataFrame([("s", ["a", "b"])], "annotated_shard_id string, page_ids array<string>")).first().value
    assert shards == '{"s":["a","b"]}'


def test_plug_ins(spark):
    df = spark.createDataFrame([("Hello  World",), ("",), (None,)], "t string")
    got = readers.predict_languages(df, F.col("t"), lambda ts: [{"__label__en": 0.9, "__label__fr": 0.1} if t == "hello world" else {} for t in ts]).collect()
    assert [r.languages for r in got] == [{"__label__en": 0.9, "__label__fr": 0.1}, {"__label__unknown": 1.0}, {"__label__unknown": 1.0}]

    def get(u):
        if "bad" in u:
            raise OSError("x")
        return {"status": 200, "body": b"1"}

    r = {x.url: x for x in readers.fetch(spark.createDataFrame([("u1", "h"), ("bad", "h")], "url string, url_hash string"), get, 2).collect()}
    assert r["u1"].status == 200 and "OSError" in r["bad"].error


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    docs = spark.createDataFrame([("a", "__label__en", 1.0, 0.5), ("b", "__label__en", None, 0.5)], "url_hash string, top_lang string, perplexity double, quality double")
    docs.write.parquet(src)
    q = flows.for_each(flows.read_files(spark, src, docs.schema), whitelist.judge_documents, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {r.url_hash: r.blacklisted for r in out.collect()} == {r.url_hash: r.blacklisted for r in whitelist.judge_documents(docs).collect()}
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.write.parquet(str(tmp_path / "ev"))
    w = flows.windowed_counts(flows.read_files(spark, str(tmp_path / "ev"), ev.schema)).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    w.awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == ev.count()


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_same_at_any_partitioning(spark, parts):
    from sheafworks.plans import registry

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [tuple(r) for r in registry.QUERIES["whitelist_pages"](spark, "/root/testdata/sf0.001").orderBy("annotated_shard_id").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert rows == test_same_at_any_partitioning.__dict__.setdefault("first", rows)
