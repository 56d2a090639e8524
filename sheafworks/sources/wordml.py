"""Entities that a document's XML states outright: headers, footers, text boxes, tables and their cells with the styles that
apply, contents, bibliographies, form fields, figures; and the paragraphs between them, which styles and fonts decide.

A document's elements are visited in a fixed order (``STEPS``), and the last step that claims an element decides
(``decided``), as contents are also content controls and text boxes are also paragraphs. Documents are independent of
each other, so this is one Arrow pass; a row for each claim comes out.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks import schemas as S
from sheafworks.sources.readers import slices

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
STEPS = ("header", "footer", "text_box", "table", "paragraph", "toc", "form", "figure")
BUILTIN, XML_PATTERN = "builtin", "xml_pattern"
IMAGES = (".bmp", ".gif", ".jpeg", ".jpg", ".png", ".tiff", ".ico", ".pcx", ".ppm", ".pgm", ".pbm", ".pnm", ".webp", ".hdr", ".dds", ".im", ".eps", ".svg")
_SIDES = ("top", "left", "bottom", "right", "insideH", "insideV", "tl2br", "tr2bl")
_BORDER, _SHADE = ("val", "sz", "space", "color"), ("val", "color", "fill")
#: Region of a conditional format: its flag on the cell or row, the table's switch, and the switch's value that turns it on.
_REGIONS = (("firstRow", "firstRow", "firstRow", True), ("band2Horz", "evenHBand", "noHBand", False), ("band1Horz", "oddHBand", "noHBand", False), ("lastRow", "lastRow", "lastRow", True), ("firstCol", "firstColumn", "firstColumn", True), ("band2Vert", "evenVBand", "noVBand", False), ("band1Vert", "oddVBand", "noVBand", False), ("lastCol", "lastColumn", "lastColumn", True))

Styles = dict[str, str]


def _on(value: str | None) -> bool:
    return (value or "").lower() in ("1", "true", "on")


def _text(e: ElementTree.Element) -> str:
    """Text of an element's runs, without that of text boxes in it; a cell's paragraphs are joined by line feeds."""
    if e.tag == W + "tc":
        return "\n".join(map(_text, e.findall(W + "p")))
    out = []
    for x in e:
        if x.tag == W + "t":
            out.append(x.text or "")
        elif x.tag == W + "tab":
            out.append("\t")
        elif x.tag in (W + "r", W + "hyperlink", W + "ins", W + "sdt", W + "sdtContent", W + "smartTag"):
            out.append(_text(x))
    return "".join(out)


# -- tables ----------------------------------------------------------------------------------------
def _borders(e: ElementTree.Element | None) -> Styles:
    """``top.val`` and so on of a borders element."""
    out: Styles = {}
    for side in _SIDES if e is not None else ():
        if (b := e.find(W + side)) is not None:
            out |= {f"{side}.{a}": v for a in _BORDER if (v := b.get(W + a)) is not None}
    return out


def _shading(e: ElementTree.Element | None) -> Styles:
    return {a: v for a in _SHADE if e is not None and (v := e.get(W + a)) is not None}


def _part(e: ElementTree.Element | None, holder: str, borders: str) -> tuple[Styles, Styles]:
    """(borders, shading) of a style's table or cell properties."""
    own = e.find(W + holder) if e is not None else None
    return (_borders(own.find(W + borders)), _shading(own.find(W + "shd"))) if own is not None else ({}, {})


def cell_location(cell: int, cells: int, row: int, rows: int) -> tuple[bool, bool, bool, bool]:
    """Whether a cell has the table's top, bottom, left and right border. A table's first column counts before its last,
    its first row before its last, so a single column has no right border and a single row no bottom one."""
    top, left = row == 0, cell == 0
    return top, not top and row == rows - 1, left, not left and cell == cells - 1


def on_cell(table: Styles, at: tuple[bool, bool, bool, bool]) -> Styles:
    """A table's borders as those of a cell: the inside ones where the cell doesn't lie at an edge."""
    top, bottom, left, right = at
    pick = {"top": "top" if top else "insideH", "bottom": "bottom" if bottom else "insideH", "left": "left" if left else "insideV", "right": "right" if right else "insideV"}
    return {f"{side}.{a}": v for side, source in pick.items() for a in _BORDER if (v := table.get(f"{source}.{a}")) is not None}


def conditional_region(cell: ElementTree.Element, row: ElementTree.Element, look: ElementTree.Element | None) -> str | None:
    """The first region of conditional formats that a cell lies in and that its table uses; flags of the cell before the row's."""
    if look is None:
        return None
    flags: Styles = {}
    for holder in (cell.find(W + "tcPr"), row.find(W + "trPr")):
        cnf = holder.find(W + "cnfStyle") if holder is not None else None
        if cnf is not None:
            for _, flag, _, _ in _REGIONS:
                if (v := cnf.get(W + flag)) is not None:
                    flags.setdefault(flag, v)
    for region, flag, switch, value in _REGIONS:
        told = look.get(W + switch)
        if flags.get(flag) in ("1", "true") and told in (("1", "true") if value else ("0", "false")):
            return region
    return None


def is_header_row(row: ElementTree.Element) -> bool:
    mark = row.find(f"{W}trPr/{W}tblHeader")
    return mark is not None and _on(mark.get(W + "val", "true"))


def table_cells(table: ElementTree.Element, styles: dict[str | None, ElementTree.Element]) -> Iterator[tuple[ElementTree.Element, bool, Styles, Styles]]:
    """(cell, in a header row, borders, shading) in order, tables in cells after their cell. What a cell leaves open the table
    says, then the table's style (as table, as cell), then the style's conditional format. Rows count as header rows up to the first
    that isn't one; those of tables in cells never do."""
    yield from _cells(table, styles, True)


def _cells(table: ElementTree.Element, styles: dict[str | None, ElementTree.Element], outer: bool) -> Iterator[tuple[ElementTree.Element, bool, Styles, Styles]]:
    props = table.find(W + "tblPr")
    named = props.find(W + "tblStyle") if props is not None else None
    style = styles.get(named.get(W + "val") if named is not None else None)
    own_borders, own_shade = (_borders(props.find(W + "tblBorders")), _shading(props.find(W + "shd"))) if props is not None else ({}, {})
    style_borders, style_shade = _part(style, "tblPr", "tblBorders")
    cell_borders, cell_shade = _part(style, "tcPr", "tcBorders")
    regions = {e.get(W + "type"): e for e in style.findall(W + "tblStylePr")} if style is not None else {}
    rows = table.findall(W + "tr")
    heading = outer
    for r, row in enumerate(rows):
        heading = heading and is_header_row(row)
        cells = row.findall(W + "tc")
        for c, cell in enumerate(cells):
            at = cell_location(c, len(cells), r, len(rows))
            inner_borders, inner_shade = _part(cell, "tcPr", "tcBorders")
            region = regions.get(conditional_region(cell, row, props.find(W + "tblLook") if props is not None else None))
            by_cell, by_table = _part(region, "tcPr", "tcBorders"), _part(region, "tblPr", "tblBorders")
            borders = by_table[0] | by_cell[0] | cell_borders | on_cell(style_borders, at) | on_cell(own_borders, at) | inner_borders
            shade = by_table[1] | by_cell[1] | cell_shade | style_shade | own_shade | inner_shade
            yield cell, heading, borders, shade
            for inside in cell.findall(W + "tbl"):
                yield from _cells(inside, styles, False)


# -- the walk --------------------------------------------------------------------------------------
class _Document:
    """A document's parts, and the place of every element of the body in document order."""

    def __init__(self, content: bytes) -> None:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            self.names = z.namelist()
            have = set(self.names)
            self.body = ElementTree.fromstring(z.read("word/document.xml")).find(W + "body")
            sheet = ElementTree.fromstring(z.read("word/styles.xml")) if "word/styles.xml" in have else None
            rels = ElementTree.fromstring(z.read("word/_rels/document.xml.rels")) if "word/_rels/document.xml.rels" in have else ()
            targets = {r.get("Id"): "word/" + r.get("Target", "") for r in rels if r.get("TargetMode") != "External"}
            self.parts: dict[str, list[ElementTree.Element]] = {"header": [], "footer": []}
            for section in self.body.iter(W + "sectPr"):
                for kind, found in self.parts.items():  # sections without a part of their own go on with the one before
                    for ref in section.findall(f"{W}{kind}Reference"):
                        if ref.get(W + "type", "default") == "default" and (name := targets.get(ref.get(_REL + "id"))) in have:
                            found.append(ElementTree.fromstring(z.read(name)))
        self.styles = {s.get(W + "styleId"): s for s in sheet.findall(W + "style")} if sheet is not None else {}
        self.style_names = {k: s.find(W + "name").get(W + "val") for k, s in self.styles.items() if s.find(W + "name") is not None}
        # tables without a style have the default one
        self.styles |= {None: s for s in self.styles.values() if s.get(W + "type") == "table" and _on(s.get(W + "default"))}
        self.parent = {c: p for p in self.body.iter() for c in p}
        self.place = {e: k for k, e in enumerate(self.body.iter())}

    def up(self, e: ElementTree.Element, tag: str) -> ElementTree.Element | None:
        while (e := self.parent.get(e)) is not None:
            if e.tag == W + tag:
                return e
        return None

    def style_of(self, p: ElementTree.Element) -> str | None:
        s = p.find(f"{W}pPr/{W}pStyle")
        return self.style_names.get(s.get(W + "val"), s.get(W + "val")) if s is not None else "Normal"


def _claim(step: str, element: str, entity: str | None, source: str | None, text: str | None, style: str | None = None, borders: Styles | None = None, shade: Styles | None = None) -> dict:
    return {"step": STEPS.index(step), "element": element, "entity_id": S.ENTITY_IDS[entity] if entity else None, "source": source, "text": text, "style": style, "borders": list((borders or {}).items()), "shading": list((shade or {}).items())}


def claims(content: bytes) -> Iterator[dict]:
    """What each step claims: ``element`` names it, by part and place."""
    d = _Document(content)
    for kind in ("header", "footer"):
        for k, part in enumerate(d.parts[kind]):
            for n, p in enumerate(part.findall(W + "p")):
                if text := _text(p):
                    yield _claim(kind, f"{kind}{k}/p{n}", kind, BUILTIN, text)
            for n, t in enumerate(part.findall(W + "tbl")):
                for c, (cell, _, borders, shade) in enumerate(table_cells(t, d.styles)):
                    yield _claim(kind, f"{kind}{k}/t{n}/c{c}", kind, BUILTIN, _text(cell), None, borders, shade)
    at = lambda e: f"body/{d.place[e]}"
    for box in d.body.iter(W + "txbxContent"):
        for p in box.iter(W + "p"):
            yield _claim("text_box", at(p), "text", XML_PATTERN, _text(p))
    for table in d.body.findall(W + "tbl"):
        yield _claim("table", at(table), "table", BUILTIN, None)
        for cell, heading, borders, shade in table_cells(table, d.styles):
            yield _claim("table", at(cell), "table_header" if heading else "table", BUILTIN, _text(cell), None, borders, shade)
    for p in d.body.findall(W + "p"):
        yield _claim("paragraph", at(p), None, None, _text(p), d.style_of(p))
    for sdt in d.body.iter(W + "sdt"):
        gallery = sdt.find(f"{W}sdtPr/{W}docPartObj/{W}docPartGallery")
        if gallery is None:
            continue
        entity = "bibliography" if "bib" in (gallery.get(W + "val") or "").lower() else "toc"
        for inside in sdt.iter(W + "sdtContent"):
            if d.up(inside, "sdt") is sdt:
                for e in inside.iter():
                    if e.tag in (W + "r", W + "p"):
                        yield _claim("toc", at(e), entity, XML_PATTERN, _text(e))
    yield from _forms(d, at)
    for name in sorted(d.names):
        if name.startswith("word/media") and name.lower().endswith(IMAGES):
            yield _claim("figure", name, "figure", BUILTIN, None)


def _forms(d: _Document, at) -> Iterator[dict]:
    """A content control's only paragraph or run is a field; the run before its control is the tag."""
    content = [e for box in d.body.iter(W + "sdtContent") for e in box.iter()]
    pars = list(dict.fromkeys(e for e in content if e.tag == W + "p"))
    covered = {r for p in pars for r in p.iter(W + "r")}
    runs = [e for e in dict.fromkeys(content) if e.tag == W + "r" and e not in covered]
    for e in [x for x in (*pars, *runs) if len(d.parent[x]) == 1]:
        outer, control = d.up(e, "p"), d.up(e, "sdt")
        if outer is not None and control is not None:
            tag = None
            for child in outer:
                if child is control:
                    break
                tag = child if child.tag == W + "r" else tag
            else:
                tag = [c for c in outer if c.tag == W + "r"][-1:]
                tag = tag[0] if tag else None
            if tag is not None:
                yield _claim("form", at(tag), "form_tag", XML_PATTERN, _text(tag))
        yield _claim("form", at(e), "form_field", XML_PATTERN, _text(e))


_PAIRS = pa.map_(pa.string(), pa.string())
_FIELDS = {"pos": pa.int32(), "step": pa.int32(), "element": pa.string(), "entity_id": pa.int32(), "source": pa.string(), "text": pa.string(), "style": pa.string(), "borders": _PAIRS, "shading": _PAIRS, "error": pa.string()}
_SCHEMA = "pos int, step int, element string, entity_id int, source string, text string, style string, borders map<string,string>, shading map<string,string>, error string"


def document_entities(df: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """(keys…, pos, step, element, entity_id, source, text, style, borders, shading, error): a row for each claim, in the order of
    the walk. A document that can't be read has one row with ``error``; a null one has none."""
    types = df.select(*keys).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, which = [], []
            for i, data in enumerate(batch.column(len(keys)).to_pylist()):
                if data is None:
                    continue
                try:
                    found = [c | {"pos": k} for k, c in enumerate(claims(data))]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, AttributeError) as e:
                    found = [{"pos": 0, "error": f"Unreadable({type(e).__name__})"}]
                rows += found
                which += [i] * len(found)
            if rows:
                own = [batch.column(k).take(pa.array(which, pa.int64())) for k in range(len(keys))]
                yield pa.RecordBatch.from_arrays(own + [pa.array([r.get(k) for r in rows], t) for k, t in _FIELDS.items()], names=[*keys, *_FIELDS])

    return df.select(*keys, content).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in types), _SCHEMA]))


def decided(found: DataFrame, keys: list[str]) -> DataFrame:
    """The last claim on each element, where it isn't undecided."""
    last = found.where("error is null").groupBy(*keys, "element").agg(F.max_by(F.struct("entity_id", "source", "text"), F.when(F.col("entity_id").isNotNull(), F.col("pos"))).alias("c"))
    return last.select(*keys, "element", "c.*").where("entity_id is not null")


_HIGHLIGHT = re.compile(rb"<w:highlight\b[^>]*?(?:/>|>\s*</w:highlight\s*>)")


def without_highlights(content: bytes) -> bytes:
    """The document with no highlighted run; all other members and bytes stay as they are."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for info in old.infolist():
            data = old.read(info)
            new.writestr(info, _HIGHLIGHT.sub(b"", data) if info.filename == "word/document.xml" else data)
    return out.getvalue()


def remove_highlights(df: DataFrame, content: str = "content") -> DataFrame:
    """The rows with documents freed of highlighting; what isn't a readable archive stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, out = batch.schema.get_field_index(content), []
            for data in batch.column(at).to_pylist():
                try:
                    out.append(None if data is None else without_highlights(data))
                except zipfile.BadZipFile:
                    out.append(data)
            yield batch.set_column(at, content, pa.array(out, pa.binary()))

    return df.mapInArrow(run, df.schema)


def has_highlights(content: Column) -> Column:
    @F.arrow_udf(T.BooleanType())
    def marked(contents: pa.Array) -> pa.Array:
        out = []
        for c in contents:
            try:
                with zipfile.ZipFile(io.BytesIO(c.as_py())) as z:
                    out.append(bool(_HIGHLIGHT.search(z.read("word/document.xml"))))
            except (zipfile.BadZipFile, KeyError, TypeError):
                out.append(False)
        return pa.array(out, pa.bool_())

    return marked(content)
