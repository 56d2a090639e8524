"""Queries over documents as files: what their XML states, what is dangerous in them, what they say about themselves.

The driver's tables hold no documents, so every row of ``conversations`` becomes one, whose parts follow from the row's numbers;
the SQL lists what must be read from them.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.operators.download import maldoc_reason
from sheafworks.plans.base import query
from sheafworks.session import read_table
from sheafworks.sources import readers, safety, wordml

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_RELS = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
_STYLES = f"""<w:styles {_NS}><w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/></w:style>
<w:style w:type="table" w:styleId="T1"><w:name w:val="Grid"/><w:tblPr><w:tblBorders><w:top w:val="single" w:sz="4"/><w:insideH w:val="dashed" w:sz="2"/></w:tblBorders></w:tblPr>
<w:tcPr><w:shd w:val="clear" w:fill="DDDDDD"/></w:tcPr><w:tblStylePr w:type="firstRow"><w:tcPr><w:shd w:val="pct10" w:color="auto" w:fill="AAAAAA"/></w:tcPr></w:tblStylePr></w:style></w:styles>"""


def _run(text: str, props: str = "") -> str:
    return f'<w:r>{props}<w:t xml:space="preserve">{escape(text)}</w:t></w:r>'


def _par(text: str, style: str = "", props: str = "") -> str:
    return f'<w:p>{f"""<w:pPr><w:pStyle w:val="{style}"/></w:pPr>""" if style else ""}{_run(text, props)}</w:p>'


def _zip(members: dict[str, bytes | str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED)  # without a date, so equal documents have equal bytes
    return out.getvalue()


def word_document(k: int, role: str, text: str) -> bytes:
    """A document with a header, a footer of one table cell, a heading, a text box, a table, perhaps contents or a bibliography, a
    form field, a highlighted run and perhaps a picture."""
    cell = lambda t, shade="": f"<w:tc><w:tcPr>{shade}</w:tcPr>{_par(t)}</w:tc>"
    own = f'<w:shd w:val="solid" w:fill="{k % 1000000:06d}"/>' if k % 2 else ""
    table = f"""<w:tbl><w:tblPr><w:tblStyle w:val="T1"/><w:tblLook w:firstRow="1" w:noHBand="0"/></w:tblPr>
<w:tr><w:trPr><w:cnfStyle w:firstRow="1"/><w:tblHeader/></w:trPr>{cell("name")}{cell("value", own)}</w:tr><w:tr>{cell(role)}{cell(str(k))}</w:tr></w:tbl>"""
    gallery = {0: "Table of Contents", 1: "Bibliographies"}.get(k % 3)
    parts = f'<w:sdt><w:sdtPr><w:docPartObj><w:docPartGallery w:val="{gallery}"/></w:docPartObj></w:sdtPr><w:sdtContent>{_par("part one")}{_par("part two")}</w:sdtContent></w:sdt>' if gallery else ""
    box = f"<w:p>{_run('beside')}<w:r><w:pict><w:txbxContent>{_par('in the box')}</w:txbxContent></w:pict></w:r></w:p>"
    form = f"<w:p>{_run('Name: ')}<w:sdt><w:sdtContent>{_run(role)}</w:sdtContent></w:sdt></w:p>"
    body = _par(f"Part {k}", "H1") + box + table + _par(text, "", '<w:rPr><w:highlight w:val="yellow"/><w:lang w:val="fr-FR"/></w:rPr>') + parts + form
    ends = '<w:sectPr><w:headerReference w:type="default" r:id="h"/><w:footerReference w:type="default" r:id="f"/></w:sectPr>'
    members: dict[str, bytes | str] = {
        "[Content_Types].xml": "<Types/>",
        "word/document.xml": f"<w:document {_NS}><w:body>{body}{ends}</w:body></w:document>",
        "word/styles.xml": _STYLES,
        "word/header1.xml": f"<w:hdr {_NS}>{_par(role)}<w:p/></w:hdr>",
        "word/footer1.xml": f"<w:ftr {_NS}><w:tbl><w:tblPr/><w:tr>{cell('page')}</w:tr></w:tbl></w:ftr>",
        "word/_rels/document.xml.rels": f'<Relationships {_RELS}><Relationship Id="h" Type="t/header" Target="header1.xml"/><Relationship Id="f" Type="t/footer" Target="footer1.xml"/></Relationships>',
        "docProps/app.xml": f'<Properties xmlns="x"><Pages>{k % 200}</Pages></Properties>',
        "docProps/core.xml": f'<p xmlns:dc="d" xmlns:cp="c"><dc:title>{role} {k}</dc:title><cp:keywords>k{k % 7}</cp:keywords></p>',
    }
    if k % 2 == 0:
        members["word/media/image1.png"] = png_header(10, 10)
    return _zip(members)


def png_header(width: int, height: int) -> bytes:
    head = b"IHDR" + struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + head + struct.pack(">I", zlib.crc32(head))


def risky_document(k: int, role: str, text: str) -> bytes:
    """By turns harmless, with a link, with a remote template, with macros, no archive at all, with a picture of very many pixels,
    of zeros that inflate."""
    link = lambda kind: f'<Relationships {_RELS}><Relationship Id="x" Type="http://y/relationships/{kind}" Target="http://z" TargetMode="External"/></Relationships>'
    base = {"[Content_Types].xml": "<Types/>", "word/document.xml": f"<w:document {_NS}><w:body>{_par(text)}</w:body></w:document>"}
    more = {1: {"word/_rels/document.xml.rels": link("hyperlink")}, 2: {"word/_rels/settings.xml.rels": link("attachedTemplate")}, 3: {"word/vbaProject.bin": b"x"}, 5: {"word/media/a.png": png_header(20_000, 9_000)}, 6: {"word/zeros.bin": bytes(300_000)}}
    return b"plain " + text.encode() if k % 7 == 4 else _zip(base | more.get(k % 7, {}))


def pdf_document(k: int, role: str, text: str) -> bytes:
    """A PDF of 1 + k % 9 pages: its page tree plain, in a compressed object stream, or missing."""
    n = 1 + k % 9
    pages = b"".join(b"%d 0 obj<</Type/Page/Parent 2 0 R>>endobj\n" % (i + 3) for i in range(n))
    tree = b"<</Type /Pages /Count %d /Kids []>>" % n
    head = b"%PDF-1.5\n" + pages
    if k % 3 == 0:
        return head + b"2 0 obj" + tree + b"endobj\n%%EOF"
    if k % 3 == 1:
        packed = zlib.compress(tree)
        return b"%PDF-1.5\n9 0 obj<</Type/ObjStm/N 1/Length " + str(len(packed)).encode() + b">>stream\n" + packed + b"\nendstream endobj\n%%EOF"
    return head + b"%%EOF"


def files(spark: SparkSession, sf_dir: str, make: Callable[[int, str, str], bytes]) -> DataFrame:
    """(conv_id, turn, content) of every row of conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in readers.slices(batches):
            rows = zip(*(b.column(k).to_pylist() for k in range(4)))
            made = [make(c * 10 + t, role or "", text or "") for c, t, role, text in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())], names=["conv_id", "turn", "content"])

    rows = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("int"), "role", "text")
    return rows.mapInArrow(run, "conv_id bigint, turn int, content binary")


_K = "c AS (SELECT conv_id, turn::INT AS turn, conv_id * 10 + turn AS k, role, text FROM conversations)"
_ENTITIES = f"""WITH {_K},
  e AS (SELECT *, 0 AS step, 12 AS entity_id, 'builtin' AS source, role AS t, NULL AS fill, NULL AS top, NULL AS style FROM c
  UNION ALL SELECT *, 1, 13, 'builtin', 'page', NULL, NULL, NULL FROM c
  UNION ALL SELECT *, 2, 10, 'xml_pattern', 'in the box', NULL, NULL, NULL FROM c
  UNION ALL SELECT *, 3, 16, 'builtin', NULL, NULL, NULL, NULL FROM c
  UNION ALL SELECT *, 3, 14, 'builtin', 'name', 'DDDDDD', 'single', NULL FROM c
  UNION ALL SELECT *, 3, 14, 'builtin', 'value', CASE WHEN k % 2 = 1 THEN printf('%06d', k % 1000000) ELSE 'DDDDDD' END, 'single', NULL FROM c
  UNION ALL SELECT *, 3, 16, 'builtin', role, 'DDDDDD', 'dashed', NULL FROM c
  UNION ALL SELECT *, 3, 16, 'builtin', k::VARCHAR, 'DDDDDD', 'dashed', NULL FROM c
  UNION ALL SELECT *, 4, NULL, NULL, concat('Part ', k), NULL, NULL, 'heading 1' FROM c
  UNION ALL SELECT *, 4, NULL, NULL, 'beside', NULL, NULL, 'Normal' FROM c
  UNION ALL SELECT *, 4, NULL, NULL, text, NULL, NULL, 'Normal' FROM c
  UNION ALL SELECT *, 4, NULL, NULL, concat('Name: ', role), NULL, NULL, 'Normal' FROM c
  UNION ALL SELECT c.*, 5, CASE k % 3 WHEN 0 THEN 18 ELSE 19 END, 'xml_pattern', unnest(['part one', 'part one', 'part two', 'part two']), NULL, NULL, NULL FROM c WHERE k % 3 < 2
  UNION ALL SELECT *, 6, 27, 'xml_pattern', 'Name: ', NULL, NULL, NULL FROM c
  UNION ALL SELECT *, 6, 26, 'xml_pattern', role, NULL, NULL, NULL FROM c
  UNION ALL SELECT *, 7, 22, 'builtin', NULL, NULL, NULL, NULL FROM c WHERE k % 2 = 0)"""


@query("document_entities", f"{_ENTITIES} SELECT conv_id, turn, step, entity_id, source, t AS text, style, fill, top FROM e")
def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wordml.document_entities(files(spark, sf_dir, word_document), ["conv_id", "turn"])
    return found.where("error is null").select("conv_id", "turn", "step", "entity_id", "source", "text", "style", F.col("shading")["fill"].alias("fill"), F.col("borders")["top.val"].alias("top"))


@query("decided_entities", f"{_ENTITIES} SELECT conv_id, turn, entity_id, count(*) AS n FROM e WHERE entity_id IS NOT NULL GROUP BY 1, 2, 3")
def decided_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["conv_id", "turn"]
    return wordml.decided(wordml.document_entities(files(spark, sf_dir, word_document), keys), keys).groupBy(*keys, "entity_id").agg(F.count("*").alias("n"))


@query("highlights_removed", f"WITH {_K} SELECT conv_id, turn, concat('Part ', k, chr(10), 'beside', chr(10), 'name', chr(9), 'value', chr(10), role, chr(9), k, chr(10), text, chr(10), 'Name: ', role) AS text FROM c")
def highlights_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents without highlighting; those that still have some are left out, which none may be."""
    clean = wordml.remove_highlights(files(spark, sf_dir, word_document))
    d = readers.documents(clean)
    lines = F.filter(F.split("docx.text", "\n"), lambda x: ~x.isin("part one", "part two"))
    marked = wordml.has_highlights(F.col("content"))
    return d.where(~marked).select("conv_id", "turn", F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, "^besidein the box$", "beside")), "\n").alias("text"))


@query("document_properties", f"WITH {_K} SELECT conv_id, turn, (k % 200)::INT AS pages, 'fr-FR' AS languages, concat(role, ' ', k) AS title, concat('k', k % 7) AS keywords, true AS inflates FROM c")
def document_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = readers.documents(files(spark, sf_dir, word_document)).where("docx.error is null")
    return d.select("conv_id", "turn", "docx.pages", F.array_join("docx.languages", ",").alias("languages"), F.col("docx.core")["title"].alias("title"), F.col("docx.core")["keywords"].alias("keywords"), (F.col("docx.ratio") > 1).alias("inflates"))


@query("document_size_gates", f"WITH {_K} SELECT conv_id, turn, CASE k % 7 WHEN 4 THEN 'NoZipFile' WHEN 6 THEN 'UncompressedTooLarge' END AS error FROM c")
def document_size_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = readers.documents(files(spark, sf_dir, risky_document), max_bytes=290_000)
    return d.select("conv_id", "turn", "docx.error")


@query("risk_indicators", f"WITH {_K} SELECT conv_id, turn, CASE k % 7 WHEN 4 THEN 'Unknown' ELSE 'OpenXML' END AS container, CASE k % 7 WHEN 2 THEN 'ext_rels=attachedTemplate' WHEN 3 THEN 'vba=Yes' ELSE '' END AS reason FROM c")
def risk_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = files(spark, sf_dir, risky_document).withColumn("i", safety.indicators_of(F.col("content")))
    container = F.filter("i", lambda x: x["id"] == "container")[0]["value"]
    return d.select("conv_id", "turn", container.alias("container"), maldoc_reason(F.col("i")).alias("reason"))


@query("document_bombs", f"WITH {_K} SELECT conv_id, turn, CASE k % 7 WHEN 4 THEN 'NoZipFile' WHEN 5 THEN 'ImageBomb' WHEN 6 THEN 'ZipBomb' END AS reason, CASE k % 7 WHEN 4 THEN NULL WHEN 5 THEN 'word/media/a.png' ELSE '' END AS images FROM c")
def document_bombs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = files(spark, sf_dir, risky_document)
    reason = F.regexp_extract(safety.bomb_reason_of(F.col("content")), r"^\w+", 0)
    return d.select("conv_id", "turn", reason.alias("reason"), F.array_join(safety.image_bombs_of(F.col("content")), ",").alias("images"))


@query("pdf_page_counts", f"WITH {_K} SELECT conv_id, turn, (1 + k % 9)::INT AS pages FROM c")
def pdf_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir, pdf_document).select("conv_id", "turn", safety.pdf_pages_of(F.col("content")).alias("pages"))
