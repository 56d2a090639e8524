"""Checks of documents before anything opens them: indicators of active content, image bombs, inflation, pages of a PDF.

Old binary documents are compound files, whose directory and streams are read here; new ones are archives of XML.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks.sources.wordml import IMAGES

#: Twice the pixels of a 24-bit image of 256 MiB; larger ones are bombs.
MAX_IMAGE_PIXELS = 2 * (1024 * 1024 * 1024 // 4 // 3)
MAX_RATIO = 100
HARMLESS_RELATIONS = ("hyperlink",)
_OLE = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
_END = 0xFFFFFFFA  # sector numbers from here on aren't sectors


# -- compound files --------------------------------------------------------------------------------
class CompoundFile:
    """Directory and streams of a compound file; a ValueError where it isn't one."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != _OLE or len(data) < 512:
            raise ValueError("not a compound file")
        self.data = data
        shift, mini_shift = struct.unpack_from("<HH", data, 30)
        self.size, self.mini_size = 1 << min(shift, 20), 1 << min(mini_shift, 12)
        first_dir = struct.unpack_from("<I", data, 48)[0]
        self.cutoff, first_mini, _, first_difat = struct.unpack_from("<IIII", data, 56)
        sectors = [s for s in struct.unpack_from("<109I", data, 76) if s < _END]
        seen: set[int] = set()
        while first_difat < _END and first_difat not in seen and (block := self._sector(first_difat)):
            seen.add(first_difat)
            entries = struct.unpack(f"<{len(block) // 4}I", block)
            sectors += [s for s in entries[:-1] if s < _END]
            first_difat = entries[-1]
        self.fat = [x for s in sectors if (block := self._sector(s)) for x in struct.unpack(f"<{len(block) // 4}I", block)]
        mini = self._chain(first_mini)
        self.mini_fat = list(struct.unpack(f"<{len(mini) // 4}I", mini[: len(mini) // 4 * 4]))
        directory = self._chain(first_dir)
        self.entries: dict[str, tuple[int, int]] = {}
        root = None
        for at in range(0, len(directory) - 127, 128):
            n = struct.unpack_from("<H", directory, at + 64)[0]
            kind = directory[at + 66]
            start, length = struct.unpack_from("<IQ", directory, at + 116)
            if kind == 5:
                root = start
            if kind in (1, 2) and 2 <= n <= 64:
                self.entries[directory[at : at + n - 2].decode("utf-16-le", "replace")] = (start, length & 0xFFFFFFFF)
        self.mini_stream = self._chain(root) if root is not None else b""

    def _sector(self, s: int) -> bytes:
        block = self.data[(s + 1) * self.size : (s + 2) * self.size]
        return block[: len(block) // 4 * 4]

    def _chain(self, s: int) -> bytes:
        out, seen = [], set()
        while s < _END and s not in seen and s < len(self.fat):
            seen.add(s)
            out.append(self._sector(s))
            s = self.fat[s]
        return b"".join(out)

    def stream(self, name: str) -> bytes | None:
        if name not in self.entries:
            return None
        s, length = self.entries[name]
        if length >= self.cutoff:
            return self._chain(s)[:length]
        out, seen = [], set()
        while s < _END and s not in seen and s < len(self.mini_fat):
            seen.add(s)
            out.append(self.mini_stream[s * self.mini_size : (s + 1) * self.mini_size])
            s = self.mini_fat[s]
        return b"".join(out)[:length]


def summary(data: bytes) -> dict[int, int | bytes]:
    """Numbers and strings of a property stream, by id (1 code page, 4 author, 18 application)."""
    out: dict[int, int | bytes] = {}
    try:
        base = struct.unpack_from("<I", data, 44)[0]
        for k in range(min(struct.unpack_from("<I", data, base + 4)[0], 256)):
            pid, at = struct.unpack_from("<II", data, base + 8 + 8 * k)
            kind = struct.unpack_from("<I", data, base + at)[0]
            if kind == 2:
                out[pid] = struct.unpack_from("<H", data, base + at + 4)[0]
            elif kind == 30:
                n = struct.unpack_from("<I", data, base + at + 4)[0]
                out[pid] = data[base + at + 8 : base + at + 8 + n].split(b"\0", 1)[0]
    except struct.error:
        pass
    return out


# -- indicators ------------------------------------------------------------------------------------
def external_relations(z: zipfile.ZipFile) -> set[str]:
    """Kinds of relationships to outside the document, without harmless ones."""
    out = set()
    for name in z.namelist():
        if name.endswith(".rels"):
            try:
                root = ElementTree.fromstring(z.read(name))
            except ElementTree.ParseError:
                continue
            out |= {r.get("Type", "").rsplit("/", 1)[-1] for r in root if r.get("TargetMode") == "External"}
    return out - set(HARMLESS_RELATIONS)


def indicators(data: bytes | None) -> list[dict]:
    """(id, value, risk) of a document's bytes: container, properties, encryption, macros, external relationships, object pool,
    Flash. Nothing for null."""
    if data is None:
        return []
    out = []

    def say(name: str, value: str, risk: str) -> None:
        out.append({"id": name, "value": value, "risk": risk})

    ole = z = None
    try:
        ole = CompoundFile(data)
    except (ValueError, struct.error):
        if zipfile.is_zipfile(io.BytesIO(data)):
            try:
                z = zipfile.ZipFile(io.BytesIO(data))
            except zipfile.BadZipFile:
                z = None
    names = z.namelist() if z else []
    say("container", "OLE" if ole else "OpenXML" if "[Content_Types].xml" in names else "ZIP" if z else "Unknown", "INFO")
    if ole:
        props = summary(ole.stream("\x05SummaryInformation") or b"")
        page = props.get(1)
        codec = {65001: "utf-8", 1200: "utf-16-le", 10000: "mac-roman"}.get(page, f"cp{page}") if isinstance(page, int) else "latin-1"
        for pid, name in ((18, "appname"), (4, "author")):
            raw = props.get(pid)
            try:
                text = raw.decode(codec) if isinstance(raw, bytes) else "None"
            except (UnicodeDecodeError, LookupError):
                text = repr(raw)
            say(name, text, "INFO")
        say("codepage", str(page), "INFO")
    encrypted = bool(ole and {"EncryptedPackage", "EncryptionInfo"} & set(ole.entries)) or any(i.flag_bits & 1 for i in (z.infolist() if z else ()))
    if ole and (word := ole.stream("WordDocument")) and len(word) >= 12:
        encrypted |= bool(struct.unpack_from("<H", word, 10)[0] & 0x0100)
    say("encrypted", str(encrypted), "LOW" if encrypted else "NONE")
    macros = bool(ole and {"VBA", "_VBA_PROJECT", "Macros", "_VBA_PROJECT_CUR"} & set(ole.entries)) or any(n.lower().endswith("vbaproject.bin") for n in names)
    say("vba", "Yes" if macros else "No", "HIGH" if macros else "NONE")
    outside = sorted(external_relations(z)) if "[Content_Types].xml" in names else []
    say("ext_rels", ",".join(outside) or "None", "HIGH" if outside else "NONE")
    pool = bool(ole and "ObjectPool" in ole.entries)
    say("ObjectPool", str(pool), "LOW" if pool else "NONE")
    flash = len(re.findall(rb"[FC]WS[\x01-\x28].{4}[\x60-\x80]", data, re.S)) if ole else 0
    say("flash", str(flash), "HIGH" if flash else "NONE")
    return out


# -- images, archives, pages -----------------------------------------------------------------------
def image_size(data: bytes) -> tuple[int, int] | None:
    """Width and height that an image's header declares; None for kinds that aren't known. Nothing is decoded."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack_from(">II", data, 16)
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack_from("<HH", data, 6)
        if data[:2] == b"BM":
            w, h = struct.unpack_from("<ii", data, 18)
            return abs(w), abs(h)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            kind = data[12:16]
            if kind == b"VP8X":
                return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
            if kind == b"VP8L":
                bits = struct.unpack_from("<I", data, 21)[0]
                return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
            w, h = struct.unpack_from("<HH", data, 26)
            return w & 0x3FFF, h & 0x3FFF
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(data):
                if data[at] != 0xFF:
                    at += 1
                    continue
                mark = data[at + 1]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack_from(">HH", data, at + 5)
                    return w, h
                at += 2 if mark in (0xFF, 0x01) or 0xD0 <= mark <= 0xD9 else 2 + struct.unpack_from(">H", data, at + 2)[0]
            return None
        if data[:4] in (b"II*\0", b"MM\0*"):
            end = "<" if data[:2] == b"II" else ">"
            at, found = struct.unpack_from(f"{end}I", data, 4)[0], {}
            for k in range(struct.unpack_from(f"{end}H", data, at)[0]):
                tag, kind = struct.unpack_from(f"{end}HH", data, at + 2 + 12 * k)
                found[tag] = struct.unpack_from(f"{end}{'H' if kind == 3 else 'I'}", data, at + 10 + 12 * k)[0]
            return (found[256], found[257]) if {256, 257} <= set(found) else None
    except (struct.error, IndexError):
        pass
    return None


def image_bombs(data: bytes | None, max_pixels: int = MAX_IMAGE_PIXELS, folder: str = "") -> list[str] | None:
    """Names of an archive's images (under ``folder``) that declare more pixels than allowed; None if it is no archive."""
    if data is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            out = []
            for name in z.namelist():
                if name.startswith(folder) and name.lower().endswith(IMAGES):
                    with z.open(name) as f:
                        size = image_size(f.read(1 << 16))  # headers lie at the front; an image is never inflated whole
                    if size and size[0] * size[1] > max_pixels:
                        out.append(name)
            return out
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
        return None


def bomb_reason(data: bytes | None, max_ratio: float = MAX_RATIO, max_pixels: int = MAX_IMAGE_PIXELS) -> str | None:
    """Why an archive is a bomb: all its members together inflate too much, or an image declares too many pixels. Null if it isn't."""
    if data is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            size, packed = sum(i.file_size for i in z.infolist()), sum(i.compress_size for i in z.infolist())
    except zipfile.BadZipFile:
        return "NoZipFile"
    if packed and size / packed > max_ratio:
        return f"ZipBomb({size / packed:.1f})"
    bombs = image_bombs(data, max_pixels, "word/media")
    return f"ImageBomb({bombs[0]})" if bombs else None


def _objects(data: bytes) -> Iterator[bytes]:
    yield data
    for m in re.finditer(rb"/Type\s*/ObjStm\b.*?stream\r?\n", data, re.S):
        end = data.find(b"endstream", m.end())
        try:
            yield zlib.decompressobj().decompress(data[m.end() : end if end >= 0 else len(data)])
        except zlib.error:
            continue


def pdf_pages(data: bytes | None) -> int | None:
    """Pages of a PDF: the largest count of its page trees, else its page objects; None if there are none."""
    if data is None or b"%PDF" not in data[:1024]:
        return None
    counts, pages = [], 0
    for part in _objects(data):
        for m in re.finditer(rb"/Type\s*/Pages\b", part):
            lo, hi = part.rfind(b"<<", 0, m.start()), part.find(b">>", m.end())
            counts += [int(n) for n in re.findall(rb"/Count\s+(\d+)", part[max(lo, 0) : hi if hi >= 0 else len(part)])]
        pages += len(re.findall(rb"/Type\s*/Page\b(?!s)", part))
    return max(counts) if counts else pages or None


_INDICATORS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("id", "value", "risk")]))


def _each(f, kind: T.DataType, *args) -> Column:
    @F.pandas_udf(kind)
    def run(contents: pd.Series) -> pd.Series:
        return pd.Series([f(None if c is None else bytes(c), *args) for c in contents], dtype=object)

    return run


def indicators_of(content: Column) -> Column:
    return _each(indicators, _INDICATORS)(content)


def image_bombs_of(content: Column, max_pixels: int = MAX_IMAGE_PIXELS) -> Column:
    return _each(image_bombs, T.ArrayType(T.StringType()), max_pixels)(content)


def bomb_reason_of(content: Column, max_ratio: float = MAX_RATIO, max_pixels: int = MAX_IMAGE_PIXELS) -> Column:
    return _each(bomb_reason, T.StringType(), max_ratio, max_pixels)(content)


def pdf_pages_of(content: Column) -> Column:
    return _each(lambda c: pdf_pages(c), T.IntegerType())(content)
