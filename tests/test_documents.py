"""Documents as files: table styles, the walk's order, compound files, images, PDFs, archives that are cut off, databases."""

import gzip
import io
import struct
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from sheafworks import schemas as S
from sheafworks.operators import structure
from sheafworks.plans import documents as D
from sheafworks.sources import readers, safety, sinks, wordml

W = wordml.W
NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def cells(table, style=""):
    styles = {s.get(W + "styleId"): s for s in ElementTree.fromstring(f"<w:styles {NS}>{style}</w:styles>")}
    return [(wordml._text(c), h, b, s) for c, h, b, s in wordml.table_cells(ElementTree.fromstring(f"<w:tbl {NS}>{table}</w:tbl>"), styles)]


def row(*texts, props=""):
    return f"<w:tr>{props}" + "".join(f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>" for t in texts) + "</w:tr>"


def test_borders_by_place():
    table = '<w:tblPr><w:tblBorders><w:top w:val="T"/><w:left w:val="L"/><w:bottom w:val="B"/><w:right w:val="R"/><w:insideH w:val="h"/><w:insideV w:val="v"/></w:tblBorders></w:tblPr>'
    got = {t: tuple(b[f"{k}.val"] for k in ("top", "left", "bottom", "right")) for t, _, b, _ in cells(table + row("a", "b", "c") + row("d", "e", "f") + row("g", "h", "i"))}
    assert got == {"a": ("T", "L", "h", "v"), "b": ("T", "v", "h", "v"), "c": ("T", "v", "h", "R"), "d": ("h", "L", "h", "v"), "e": ("h", "v", "h", "v"), "f": ("h", "v", "h", "R"), "g": ("h", "L", "B", "v"), "h": ("h", "v", "B", "v"), "i": ("h", "v", "B", "R")}
    assert [tuple(b[f"{k}.val"] for k in ("top", "left", "bottom", "right")) for _, _, b, _ in cells(table + row("x"))] == [("T", "L", "h", "v")]


def test_cascade():
    """Cell, table, style of tables, style of cells, conditional format: each fills in what those before leave open."""
    style = '<w:style w:styleId="s" w:type="table"><w:tblPr><w:shd w:color="3"/><w:tblBorders><w:top w:sz="3"/></w:tblBorders></w:tblPr><w:tcPr><w:shd w:color="4" w:val="4"/><w:tcBorders><w:top w:sz="4" w:space="4"/></w:tcBorders></w:tcPr><w:tblStylePr w:type="lastRow"><w:tblPr><w:shd w:fill="6"/></w:tblPr><w:tcPr><w:shd w:val="5"/><w:tcBorders><w:top w:color="5"/></w:tcBorders></w:tcPr></w:tblStylePr></w:style>'
    look = lambda v: f'<w:tblPr><w:tblStyle w:val="s"/><w:tblLook w:lastRow="{v}"/><w:tblBorders><w:top w:val="2"/></w:tblBorders></w:tblPr>'
    last = '<w:tr><w:trPr><w:cnfStyle w:lastRow="1"/></w:trPr><w:tc><w:tcPr><w:tcBorders><w:top w:val="1"/></w:tcBorders></w:tcPr></w:tc></w:tr>'
    ((_, _, b, s),) = cells(look("true") + last, style)
    assert s == {"color": "3", "val": "4", "fill": "6"} and b == {"top.val": "1", "top.sz": "3", "top.space": "4", "top.color": "5"}
    ((_, _, b, s),) = cells(look("0") + last, style)
    assert "fill" not in s and "top.color" not in b
    assert cells(look("true") + last, style.replace('w:type="lastRow"', 'w:type="firstRow"'))[0][3].get("fill") is None


def test_header_rows_and_tables_in_cells():
    head = "<w:trPr><w:tblHeader/></w:trPr>"
    off = '<w:trPr><w:tblHeader w:val="false"/></w:trPr>'
    inner = f"<w:tbl>{row('in', props=head)}</w:tbl>"
    got = cells(row("a", props=head) + row("b", props=off) + row("c", props=head) + f"<w:tr><w:tc><w:p/>{inner}</w:tc></w:tr>")
    assert [(t, h) for t, h, *_ in got] == [("a", True), ("b", False), ("c", False), ("", False), ("in", False)]


def test_walk_and_errors(spark):
    df = spark.createDataFrame([(1, bytearray(D.word_document(6, "user", "hello"))), (2, bytearray(b"no")), (3, None)], "id int, content binary")
    found = wordml.document_entities(df, ["id"])
    rows = found.where("id = 1").orderBy("pos").collect()
    assert [r.step for r in rows] == sorted(r.step for r in rows) and [r.pos for r in rows] == list(range(len(rows)))
    assert [r.error for r in found.where("id > 1").collect()] == ["Unreadable(BadZipFile)"]
    last = {(r.text, r.entity_id) for r in wordml.decided(found, ["id"]).collect()}
    ids = S.ENTITY_IDS
    assert {("user", ids["header"]), ("page", ids["footer"]), ("part one", ids["toc"]), ("Name: ", ids["form_tag"]), ("user", ids["form_field"]), (None, ids["figure"])} <= last
    assert wordml.document_entities(df.limit(0), ["id"]).count() == 0


def test_a_content_control_with_one_paragraph_is_a_form():
    """Contents of one paragraph are claimed as contents, then as a form field, which decides."""
    body = '<w:sdt><w:sdtPr><w:docPartObj><w:docPartGallery w:val="x"/></w:docPartObj></w:sdtPr><w:sdtContent><w:p><w:r><w:t>a</w:t></w:r></w:p></w:sdtContent></w:sdt>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{body}</w:body></w:document>")
    got = [(wordml.STEPS[c["step"]], c["entity_id"]) for c in wordml.claims(out.getvalue())]
    assert got == [("toc", S.ENTITY_IDS["toc"]), ("toc", S.ENTITY_IDS["toc"]), ("form", S.ENTITY_IDS["form_field"])]


def test_highlights():
    with_mark = D.word_document(3, "user", "text")
    clean = wordml.without_highlights(with_mark)
    read = lambda d, n: zipfile.ZipFile(io.BytesIO(d)).read(n)
    assert b"w:highlight" in read(with_mark, "word/document.xml") and b"w:highlight" not in read(clean, "word/document.xml")
    assert read(clean, "word/styles.xml") == read(with_mark, "word/styles.xml") and readers.parse_docx(clean)["text"] == readers.parse_docx(with_mark)["text"]


def compound(streams):
    """A compound file of 512-byte sectors whose streams are all large enough for sectors of their own."""
    names, data, fat, starts = list(streams), b"", [], []
    for body in streams.values():
        body = body.ljust(max(4096, -(-len(body) // 512) * 512), b"\0")
        starts.append(len(fat))
        n = len(body) // 512
        fat += [len(fat) + i + 1 for i in range(n - 1)] + [0xFFFFFFFE]
        data += body
    first_dir = len(fat)
    entries = [("Root Entry", 5, 0xFFFFFFFE, 0)] + [(n, 2, s, max(4096, len(streams[n]))) for n, s in zip(names, starts)]
    entries += [("", 0, 0, 0)] * (-len(entries) % 4)
    directory = b"".join((n.encode("utf-16-le") + b"\0\0").ljust(64, b"\0") + struct.pack("<H", 2 * len(n) + 2 if n else 0) + bytes([k, 1]) + struct.pack("<III", *[0xFFFFFFFF] * 3) + bytes(36) + struct.pack("<IQ", s, z) for n, k, s, z in entries)
    blocks = len(directory) // 512
    fat += [len(fat) + i + 1 for i in range(blocks - 1)] + [0xFFFFFFFE]
    fat_at = len(fat)
    fat.append(0xFFFFFFFD)
    table = struct.pack(f"<{len(fat)}I", *fat).ljust(512, b"\xff")
    assert len(table) == 512
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<IIIIIIIIII", 0, 1, first_dir, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0, fat_at)
    return head.ljust(512, b"\xff") + data + directory + table


def test_compound_files():
    props = [(1, struct.pack("<IHxx", 2, 1252)), (4, struct.pack("<II", 30, 4) + b"J\xf6e\0"), (18, struct.pack("<II", 30, 8) + b"Writer\0\0")]
    at, index, body = 8 + 8 * len(props), b"", b""
    for pid, value in props:
        index += struct.pack("<II", pid, at + len(body))
        body += value
    section = struct.pack("<II", at + len(body), len(props)) + index + body
    summary = bytes(44) + struct.pack("<I", 48) + section
    word = bytearray(4096)
    got = lambda d: {i["id"]: (i["value"], i["risk"]) for i in safety.indicators(d)}
    plain = compound({"WordDocument": bytes(word), "\x05SummaryInformation": summary})
    file = safety.CompoundFile(plain)
    assert set(file.entries) == {"WordDocument", "\x05SummaryInformation"} and file.stream("\x05SummaryInformation")[: len(summary)] == summary
    seen = got(plain)
    assert seen["container"][0] == "OLE" and seen["appname"][0] == "Writer" and seen["author"][0] == "Jöe" and seen["codepage"][0] == "1252"
    assert all(r in ("INFO", "NONE") for _, r in seen.values())
    word[10:12] = struct.pack("<H", 0x0100)
    bad = got(compound({"WordDocument": bytes(word), "VBA": b"x", "ObjectPool": b"y", "Flash": b"FWS\x09" + bytes(4) + b"\x78"}))
    assert {k for k, (_, r) in bad.items() if r in ("HIGH", "LOW")} == {"encrypted", "vba", "ObjectPool", "flash"}
    assert got(plain[:700])["container"][0] == "OLE" and got(b"")["container"][0] == "Unknown" and safety.indicators(None) == []


def test_images():
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 30, 40) + b"\x01\x01\x11\x00"
    tiff = b"II*\0" + struct.pack("<IH", 8, 2) + struct.pack("<HHII", 256, 4, 1, 70) + struct.pack("<HHIHxx", 257, 3, 1, 80)
    known = {b"GIF89a" + struct.pack("<HH", 3, 4): (3, 4), b"BM" + bytes(16) + struct.pack("<ii", 5, -6): (5, 6), jpeg: (40, 30), tiff: (70, 80), D.png_header(7, 8): (7, 8), b"RIFF\0\0\0\0WEBPVP8X" + bytes(8) + (9).to_bytes(3, "little") + (19).to_bytes(3, "little"): (10, 20)}
    assert {k: safety.image_size(k) for k in known} == known
    assert safety.image_size(b"") is None and safety.image_size(b"\xff\xd8\xff") is None and safety.image_size(b"<svg/>") is None
    packed = D._zip({"word/media/a.png": D.png_header(20_000, 20_000), "x/b.gif": b"GIF89a" + struct.pack("<HH", 60_000, 60_000), "c.png": b"broken"})
    assert safety.image_bombs(packed) == ["word/media/a.png", "x/b.gif"] and safety.image_bombs(packed, folder="word/media") == ["word/media/a.png"]
    assert safety.image_bombs(b"no zip") is None and safety.bomb_reason(packed) == "ImageBomb(word/media/a.png)" and safety.bomb_reason(None) is None
    assert safety.bomb_reason(D._zip({"z": bytes(10**6)})).startswith("ZipBomb(") and safety.bomb_reason(D._zip({"a": b"abc"})) is None


def test_pdf_pages():
    assert [safety.pdf_pages(D.pdf_document(k, "", "")) for k in range(12)] == [1 + k % 9 for k in range(12)]
    nested = b"%PDF-1.4 <</Type/Pages/Count 7>> <</Count 3/Type/Pages>>" + b"<</Type/Page>>" * 7
    assert safety.pdf_pages(nested) == 7 and safety.pdf_pages(b"%PDF") is None and safety.pdf_pages(b"x") is None and safety.pdf_pages(None) is None


def test_archives_are_streams():
    rec = lambda i: f"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Target-URI: u{i}\r\nContent-Length: 5\r\n\r\n".encode() + b"WARC/" + b"\r\n\r\n"

    class Slow(io.BytesIO):
        """Gives seven bytes at a time."""

        def read(self, n=-1):
            return super().read(min(n, 7) if n >= 0 else 7)

    want = [("metadata", f"u{i}", b"WARC/") for i in range(5)]
    for data in (b"".join(map(rec, range(5))), gzip.compress(b"".join(map(rec, range(5)))), b"".join(gzip.compress(rec(i)) for i in range(5))):
        assert list(readers.warc_stream(Slow(data))) == want == list(readers.warc_records(data))
    broken = b"".join(gzip.compress(rec(i)) for i in range(3))
    assert len(list(readers.warc_records(broken[:-20]))) in (2, 3)
    assert list(readers.warc_records(b"")) == []


def test_ranges(tmp_path):
    (tmp_path / "f x").write_bytes(b"0123456789")
    assert readers.open_range(str(tmp_path / "f x"), 2, 3).read() == b"234" and readers.open_range(f"file://{tmp_path}/f%20x").read() == b"0123456789"
    assert readers.open_range(str(tmp_path / "f x"), -1, 5).read() == b"0123456789"
    with pytest.raises(NotImplementedError):
        readers.open_range("s3://b/k")


def test_ranges_over_http(tmp_path):
    import http.server
    import threading

    seen = []

    class H(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.headers.get("Range"))
            self.send_response(206)
            self.end_headers()
            self.wfile.write(b"part")

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/x"
        assert readers.open_range(url, 10, 5).read() == b"part" and readers.open_range(url).read() == b"part"
    finally:
        server.shutdown()
    assert seen == ["bytes=10-14", None]


def test_schema_gate(spark, tmp_path):
    spark.createDataFrame([("a",)], "url string").write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([("a", 1)], "url string, n int").write.parquet(str(tmp_path / "bad"))
    assert readers.checked_urls(spark, str(tmp_path / "good")).count() == 1
    with pytest.raises(ValueError, match="url string, n int"):
        readers.checked_urls(spark, str(tmp_path / "bad"))


def test_databases(spark):
    url, keep = "jdbc:derby:memory:sheaf;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = lambda *k: spark.createDataFrame([(x, f"v{x}") for x in k], "id int, v string")
    rows(1, 2).write.jdbc(url, "docs", properties=keep)
    sinks.write_jdbc(rows(2, 3, 3, 4), url, "docs", "id", keep)
    sinks.write_jdbc(rows(2, 3), url, "docs", "id", keep)
    assert sorted(r.id for r in spark.read.jdbc(url, "docs", properties=keep).collect()) == [1, 2, 3, 4]


def test_long_and_circular_styles(spark):
    rows = [(f"s{i}", f"s{i - 1}" if i else None, "base" if i == 0 else None) for i in range(150)] + [("a", "b", None), ("b", "a", None), ("c", "c", "own")]
    got = {r.style: r.font for r in structure.resolve_fonts(spark.createDataFrame(rows, "style string, base string, font string")).collect()}
    assert got == {f"s{i}": "base" for i in range(150)} | {"a": None, "b": None, "c": "own"}


def test_tar_parts(spark):
    rows = spark.range(40).select((F.col("id") % 2).alias("s"), F.format_string("m%02d", "id").alias("member"), F.encode(F.repeat(F.lit("x"), 100), "UTF-8").alias("content"))
    packed = sinks.tar_archives(rows.unionByName(spark.createDataFrame([(None, "x", bytearray(b"x")), (1, "y", None)], "s long, member string, content binary")), "s", max_bytes=700)
    parts = packed.orderBy("shard", "part").collect()
    assert [(r.shard, r.part) for r in parts] == [(s, k) for s in "01" for k in range(3)]
    assert readers.tar_members(packed.select(F.col("shard").alias("path"), "content"), "^m").count() == 40
