"""The pipelines from end to end, on small hand-made inputs, and annotation against a plain-Python version."""

import colorsys
import gzip
import json

from pyspark.sql import functions as F

from sheafworks import config, schemas as S
from sheafworks.functions import color
from sheafworks.functions import geometry as G
from sheafworks.operators import annotate, labels
from sheafworks.plans import pipelines
from sheafworks.sources import readers


def _wat(*payloads):
    out = b""
    for p in payloads:
        body = json.dumps(p).encode()
        out += gzip.compress(f"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Target-URI: http://t\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
    return out


def test_url_mining(spark, tmp_path):
    (tmp_path / "CC-MAIN-2020-01-a.wat.gz").write_bytes(_wat({"l": ["http://a/x.doc", "http://a/x.doc", "http://b/y.docx"]}, {"l": "no"}))
    history = spark.createDataFrame([("http://b/y.docx",)], "url string").select(F.sha2("url", 256).alias("url_hash"), F.lit("CC-MAIN-2019-01").alias("source"))
    rows = pipelines.mine_urls(spark.read.format("binaryFile").load(str(tmp_path)), history).collect()
    assert [(r.url, r.source, r.doc_id) for r in rows] == [("http://a/x.doc", "CC-MAIN-2020-01", "CC-MAIN-2020-01-000000000")]


def test_download(spark):
    t = spark.createDataFrame([(u, f"h{i}", "c") for i, u in enumerate(["ok1", "ok2", "big", "html", "gone", "fail"])], "url string, url_hash string, source string")

    def get(u):
        if u == "fail":
            raise OSError("no")
        return {"status": 404 if u == "gone" else 200, "content_type": "text/html" if u == "html" else "application/msword", "content_length": str(10**9) if u == "big" else "3", "body": b"abc"}

    new, bad = pipelines.download_and_export(t, get, spark.createDataFrame([], "bytehash string"), 2)
    assert new.count() == 1  # the same bytes twice
    assert {r.url: r.reason for r in bad.collect()} == {"big": "FileSizeExceeded(1000000000)", "html": "InvalidContentType(text/html)", "gone": "HTTPError=404", "fail": "NoResponse"}


BOX = "struct<x:double,y:double,width:double,height:double>"


def _tables(spark):
    i = S.ENTITY_IDS
    ents = [("p", "t1", i["text"], (10.0, 10.0, 80.0, 40.0)), ("p", "t1", i["text"], (10.0, 10.0, 80.0, 40.0)), ("p", "t2", i["text"], (200.0, 150.0, 50.0, 20.0)), ("p", "tiny", i["text"], (0.0, 0.0, 1.0, 1.0)), ("p", "tab", i["table"], (100.0, 0.0, 100.0, 60.0)), *[("p", f"c{k}", i["table_cell"], (100.0 + 50 * (k % 2), 20.0 * (k // 2), 50.0, 20.0)) for k in range(6)], ("q", "f", i["figure"], (0.0, 0.0, 90.0, 90.0))]
    e = spark.createDataFrame(ents, f"page_id string, entity_id string, category int, bbox {BOX}")
    w = spark.createDataFrame([("p", 1, (10.2, 10.2, 10.0, 5.0)), ("p", 2, (30.0, 12.0, 5.0, 5.0)), ("p", 3, (55.0, 3.0, 5.0, 5.0)), ("p", 4, (140.0, 90.0, 5.0, 5.0))], f"page_id string, word_id int, bbox {BOX}")
    p = spark.createDataFrame([("p", "d", 300.0, 200.0, 150.0, 100.0), ("q", "d", 300.0, 200.0, 150.0, 100.0), ("r", "d", 300.0, 200.0, 150.0, 100.0)], "page_id string, doc_id string, page_width double, page_height double, pdf_width double, pdf_height double")
    return w, e, p


def test_annotation(spark):
    got = annotate.annotate(*_tables(spark))
    ents = {(r.page_id, r.entity_id): tuple(r.bbox) for r in got.entities.collect()}
    # in pixels the words are twice as large: (20.4, 20.4, 20, 10) and (60, 24, 10, 10)
    assert ents["p", "t1"] == (20.0, 20.0, 50.0, 14.0)
    assert ("p", "t2") not in ents and ("p", "tiny") not in ents and ("q", "f") in ents
    counts = {r.page_id: r for r in got.page_counts.collect()}
    assert counts["p"].num_text == 1 and counts["p"].num_table_cell == 6 and counts["p"].num_table_row == 3 and counts["p"].num_table_column == 2 and counts["p"].num_table_header_row == 0
    assert counts["q"].num_figure == 1 and counts["r"].num_text == 0
    doc = got.doc_counts.first()
    assert doc.num_table_row == 3 and doc.num_figure == 1
    tags = {r.word_id: len(r.entity_ids) for r in got.words.collect()}
    assert tags == {1: 1, 2: 1, 3: 4, 4: 0}  # word 3: the table, a cell, its row and its column
    assert annotate.selected_boxes(got.entities, ["p"]).where(F.col("category").isin(28, 29)).count() == 0


def test_training_set(spark):
    found = annotate.annotate(*_tables(spark))
    counts = found.page_counts.drop("doc_id")
    pages = counts.withColumns({"url_hash": F.lit("u"), "pdf_word_count": F.lit(4), "top_lang_score": F.lit(0.9), "page_width": F.lit(300.0), "page_height": F.lit(200.0)})
    docs = spark.createDataFrame([("u", "__label__en", 2.0, 0.5)], "url_hash string, top_lang string, perplexity double, quality double")
    s = labels.Settings.parse({"max_img": 5, "elem_accepts": [10], "elem_mins": {"10": 1}, "language_codes": ["en"]})
    files = pipelines.training_set(pages, docs, found, s).collect()
    assert [r.page_id for r in files] == ["p"] and len(files[0].content.split("\n")) == 1 + 1 + 6 + 3 + 2


def test_gates_and_config(spark, tmp_path):
    docs = spark.createDataFrame([(1, ("x" * 300, 3, 10, 2.0, None)), (2, ("x" * 300, 151, 10, 2.0, None)), (3, ("short", None, 10, 2.0, None)), (4, (None, None, None, None, "NoZipFile")), (5, ("x" * 300, 3, 10, 50.0, None))], "i int, docx struct<text:string,pages:int,uncompressed:bigint,ratio:double,error:string>")
    d = annotate.reject_reason(docs)
    assert {r.i: r.reason for r in d.collect()} == {1: None, 2: "TooManyPages", 3: "TextTooShort", 4: "NoZipFile", 5: "DecompressionBomb"}
    good, bad = annotate.split_failed(d)
    assert good.count() == 1 and bad.count() == 4
    (tmp_path / "c.yaml").write_text("DOCUMENTS:\n  MAX_DOC_PAGES: 7\nIMAGES:\n  IMAGE_DPI: 90\n  IMAGE_WIDTH: null\n")
    assert config.load(str(tmp_path / "c.yaml")) == config.Annotation(max_doc_pages=7)


def test_colors(spark):
    rows = [(h, s, v) for h in (0, 17, 60, 119, 179) for s in (0, 100, 255) for v in (0, 201, 255)]
    df = spark.createDataFrame(rows, "h int, s int, v int")
    for r in df.select("*", color.hsv_to_rgb(F.col("h"), F.col("s"), F.col("v")).alias("rgb")).collect():
        want = [255 * c for c in colorsys.hsv_to_rgb(r.h / 180, r.s / 255, r.v / 255)]
        assert all(abs(a - b) <= 0.5 + 1e-9 for a, b in zip(r.rgb, want))
    assert df.select(color.rgb_to_hsv(F.lit(0), F.lit(255), F.lit(0)).alias("x")).first().x == [60, 255, 255]
    assert [r.c for r in spark.range(30).orderBy("id").select(color.cycled_value(F.col("id")).alias("c")).collect()][26:] == [203, 201, 255, 253]


def test_page_archives(spark):
    ent = {"doc_id": "d", "page_id": "p", "page_num": 1, "entity_category": 10, "bbox": {"x": 1, "y": 2, "width": 3, "height": 4}, "id": "e1", "area": 12}
    word = {"doc_id": "d", "entity_ids": ["e1"], "entity_categories": [10], "page_num": 1, "bbox": {"x": 1, "y": 2, "width": 3, "height": 4}, "text": "hi", "upright": True, "direction": 1}
    files = [("t", "entities_p.json", json.dumps({"entities": {"10": [ent], "11": []}}).encode()), ("t", "words_p.json", json.dumps({"words": [word, word]}).encode()), ("t", "x.jpg", b"")]
    m = spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in files], "path string, member string, content binary")
    assert [(r.id, r.bbox.width, r.area) for r in readers.annotated_entities(m).collect()] == [("e1", 3.0, 12.0)]
    assert [(r.word_pos, r.text, r.entity_ids) for r in readers.annotated_words(m).orderBy("word_pos").collect()] == [(0, "hi", ["e1"]), (1, "hi", ["e1"])]
    assert G.valid(F.col("b")) is not None
