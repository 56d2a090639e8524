"""Sources: crawl listings, archives, tar members, JSON lines, label files, logs, documents."""

from __future__ import annotations

import io
import itertools
import json
import os
import re
import tarfile
import urllib.parse
import urllib.request
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sheafworks import schemas as S
from sheafworks.session import local_path

MAX_MEMBER_BYTES = 10 * 1024 * 1024


#: So many rows of documents are Python objects at once; a batch has up to 10,000.
SLICE = 200


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def listing(spark: SparkSession, paths: str, base_url: str = "") -> DataFrame:
    """Lines of (gzipped) crawl listings, as full addresses."""
    return spark.read.text(paths).select(F.concat(F.lit(base_url), F.col("value")).alias("uri"))


def raw_urls(spark: SparkSession, paths: str) -> DataFrame:
    """URL tables of the one accepted schema, only the column that is needed."""
    return spark.read.schema(S.RAW_URLS).parquet(paths)


def schema_mismatches(spark: SparkSession, paths: str, schema: T.StructType = S.RAW_URLS) -> DataFrame:
    """(path, found) of Parquet files whose schema isn't the one accepted: names, types and order. Only footers are read, by tasks."""
    want = [(f.name, f.dataType.simpleString()) for f in schema]
    kinds = {"int64": "bigint", "int32": "int", "float": "float", "double": "double", "bool": "boolean", "large_string": "string"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                found = [(f.name, kinds.get(str(f.type), str(f.type))) for f in pq.read_schema(io.BytesIO(content))]
                if found != want:
                    rows.append((path, ", ".join(f"{n} {t}" for n, t in found)))
            yield pd.DataFrame(rows, columns=["path", "found"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths).select("path", "content").mapInPandas(run, "path string, found string")


def checked_urls(spark: SparkSession, paths: str) -> DataFrame:
    """``raw_urls``, or a ValueError that names a file of another schema."""
    if (bad := schema_mismatches(spark, paths).first()) is not None:
        raise ValueError(f"{bad['path']} has the columns {bad['found']}")
    return raw_urls(spark, paths)


class _Plain:
    """Bytes of a file as they are, or of its gzip members one after the other, a piece at a time."""

    def __init__(self, f: BinaryIO, piece: int = 1 << 20) -> None:
        self.f, self.piece, self.rest = f, piece, b""
        self.zipped = None
        self.buffer = bytearray()
        self.ended = False

    def _more(self) -> bool:
        raw = self.rest or self.f.read(self.piece)
        self.rest = b""
        if not raw:
            self.ended = True
            return False
        if self.zipped is None and not self.buffer and raw[:2] != b"\x1f\x8b":
            self.zipped = False
        if self.zipped is False:
            self.buffer += raw
            return True
        if self.zipped is None or self.zipped.eof:
            raw = raw.lstrip(b"\0")
            if not raw:
                return True
            self.zipped = zlib.decompressobj(31)
        try:
            self.buffer += self.zipped.decompress(raw)
            self.rest = self.zipped.unused_data
        except zlib.error:  # what was read before a damaged member stays
            self.ended = True
        return not self.ended

    def line(self) -> bytes:
        """Up to and with the next line feed; empty at the end."""
        at = 0
        while (k := self.buffer.find(b"\n", at)) < 0:
            at = len(self.buffer)
            if self.ended or not self._more():
                k = len(self.buffer) - 1
                break
        out = bytes(self.buffer[: k + 1])
        del self.buffer[: k + 1]
        return out

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and not self.ended and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def warc_stream(f: BinaryIO) -> Iterator[tuple[str, str | None, bytes]]:
    """(type, target, payload) of the records of a WARC file, gzipped by record, as a whole, or not at all. One record is held at a
    time, besides a piece of the file."""
    plain = _Plain(f)
    while line := plain.line():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := plain.line()) not in (b"\r\n", b"\n", b""):
            name, colon, value = line.decode("utf-8", "replace").partition(":")
            if colon:
                head[name.strip().lower()] = value.strip()
        if not line:
            return
        n = head.get("content-length", "0")
        yield head.get("warc-type", ""), head.get("warc-target-uri"), plain.read(int(n) if n.isdigit() else 0)


def warc_records(data: bytes) -> Iterator[tuple[str, str | None, bytes]]:
    return warc_stream(io.BytesIO(data))


_RECORD = "path string, type string, target string, payload binary"


def _record_batches(path: str, records: Iterator[tuple[str, str | None, bytes]], record_type: str | None) -> Iterator[pd.DataFrame]:
    rows, size = [], 0
    for kind, target, payload in records:
        if record_type in (None, kind):
            rows.append((path, kind, target, payload))
            size += len(payload)
            if size > 8 << 20:
                yield pd.DataFrame(rows, columns=["path", "type", "target", "payload"])
                rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["path", "type", "target", "payload"])


def archives(files: DataFrame, record_type: str | None = "metadata") -> DataFrame:
    """Records of WARC/WAT files (``binaryFile`` rows): path, type, target, payload."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                yield from _record_batches(path, warc_stream(io.BytesIO(content)), record_type)

    return files.select("path", "content").mapInPandas(run, _RECORD)


def open_range(uri: str, offset: int | None = None, length: int | None = None, timeout: float = 60) -> BinaryIO:
    """A file, ``file:`` or http(s) address as a stream, or the ``length`` bytes of it from ``offset`` on."""
    scheme = uri.split(":", 1)[0].lower() if "://" in uri or uri.startswith("file:") else ""
    ranged = offset is not None and offset > -1 and length is not None and length > 0
    if scheme in ("http", "https"):
        head = {"Range": f"bytes={offset}-{offset + length - 1}"} if ranged else {}
        return urllib.request.urlopen(urllib.request.Request(uri, headers=head), timeout=timeout)
    if scheme not in ("", "file"):
        raise NotImplementedError(f"{scheme} addresses need an opener of their own")
    f = open(urllib.parse.unquote(urllib.parse.urlparse(uri).path) if scheme else uri, "rb")
    if not ranged:
        return f
    with f:
        f.seek(offset)
        return io.BytesIO(f.read(length))


def fetched_archives(addresses: DataFrame, base: str = "", record_type: str | None = "metadata", opener: Callable[[str, int | None, int | None], BinaryIO] = open_range) -> DataFrame:
    """Records of archives by address (uri, offset, length; the last two may be null or -1 for whole files), read as streams where
    they lie: path, type, target, payload, error. Relative addresses follow ``base``; what can't be read is a row with ``error``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for uri, offset, length in zip(b["uri"], b["offset"], b["length"]):
                full = uri if "://" in uri or uri.startswith(("file:", "/")) else base + uri
                try:
                    with opener(full, None if pd.isna(offset) else int(offset), None if pd.isna(length) else int(length)) as f:
                        for part in _record_batches(uri, warc_stream(f), record_type):
                            yield part.assign(error=None)
                except (OSError, NotImplementedError) as e:
                    yield pd.DataFrame([(uri, None, None, None, f"{type(e).__name__}: {e}")], columns=["path", "type", "target", "payload", "error"])

    wide = addresses.select("uri", F.col("offset").cast("bigint").alias("offset"), F.col("length").cast("bigint").alias("length"))
    return wide.mapInPandas(run, f"{_RECORD}, error string")


def _strings(text: str | None) -> list[str]:
    """All strings of a JSON text, depth first in document order, repeats kept; keys aren't values."""
    try:
        todo = [json.loads(text)] if text is not None else []
    except ValueError:
        return []
    out = []
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, dict):
            todo.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            todo.extend(reversed(x))
    return out


def json_strings(df: DataFrame, col: str, keep: list[str], pattern: str | None = None) -> DataFrame:
    """(keep…, value): every string value of the JSON column that matches the pattern. Columns to keep stay in Arrow."""
    kinds = df.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_strings(t) for t in batch.column(len(keep)).to_pylist()]
            at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(at) for k in range(len(keep))] + [pa.array([s for f in found for s in f], pa.string())], names=[*keep, "value"])

    out = df.select(*keep, col).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "value string"]))
    return out.where(F.col("value").rlike(pattern)) if pattern else out


def json_lines_by_position(spark: SparkSession, paths: str) -> DataFrame:
    """(file, pos, line) of (gzipped) JSON lines: the file's name and the line's number from 0. A file is one stream of lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                plain, rows = _Plain(io.BytesIO(content)), []
                while line := plain.line():
                    rows.append((path.rsplit("/", 1)[-1], len(rows), line.decode("utf-8", "replace").rstrip("\r\n")))
                yield pd.DataFrame(rows, columns=["file", "pos", "line"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "file string, pos bigint, line string")


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name


def _walk(folder: str, deep: bool) -> Iterator[str]:
    with os.scandir(folder) as entries:
        for e in entries:
            if not _hidden(e.name):
                if e.is_dir():
                    yield from _walk(e.path, True) if deep else ()
                else:
                    yield e.path


def _read(path: str) -> bytes:
    f = os.open(path, os.O_RDONLY)
    try:
        parts = [os.read(f, 1 << 16)]
        while len(parts[-1]) == 1 << 16:
            parts.append(os.read(f, 1 << 16 if len(parts) < 16 else 1 << 24))
        if len(parts) > 16:  # large reads may be short
            while more := os.read(f, 1 << 24):
                parts.append(more)
        return b"".join(parts)
    finally:
        os.close(f)


def small_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """(path, length, content) of the files in a folder and those below it, without hidden ones. In a mounted folder, tasks list and
    read them: Spark's own reader lists every file in the driver and has a task for some thirty."""
    top = local_path(folder)
    if top is None or not os.path.isdir(top):
        d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        return d.where(F.col("path").endswith(suffix)).select("path", "length", "content")
    top = os.path.abspath(top)
    with os.scandir(top) as entries:
        roots = [(top, False), *((e.path, True) for e in entries if e.is_dir() and not _hidden(e.name))]
    tasks = 4 * spark.sparkContext.defaultParallelism  # which stream, so that they may be large

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for root, deep in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = (p for p in _walk(root, deep) if p.endswith(suffix))
                while part := list(itertools.islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["path"])

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        data: list[bytes] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(["file:" + p for p in paths]), pa.array(list(map(len, data)), pa.int64()), pa.array(data, pa.binary())], names=["path", "length", "content"])

        for b in batches:
            for p in b.column(0).to_pylist():
                paths.append(p)
                data.append(_read(p))
                size += len(data[-1])
                if size > 8 << 20 or len(paths) >= 10_000:
                    yield batch()
                    paths, data, size = [], [], 0
        if paths:
            yield batch()

    listed = spark.createDataFrame(roots, "path string, deep boolean").repartition(min(len(roots), tasks)).mapInArrow(names, "path string")
    return listed.repartition(tasks, "path").mapInArrow(contents, "path string, length bigint, content binary")


def folder_members(spark: SparkSession, folder: str, pattern: str = r"\.json$") -> DataFrame:
    """(path, member, size, content, error) of an unpacked archive's files, like ``tar_members``: path is the folder, member the name."""
    d = small_files(spark, folder)
    parts = [F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("member")]
    return d.select(*parts, F.col("length").alias("size"), "content", F.lit(None).cast("string").alias("error")).where(F.col("member").rlike(pattern))


class _Stream:
    """Bytes of a plain or gzipped file from the front, a piece at a time."""

    def __init__(self, data: memoryview, piece: int = 1 << 18) -> None:
        self.data, self.piece, self.at, self.buffer, self.pos = data, piece, 0, b"", 0
        self.zip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def _more(self) -> bytes:
        if self.zip is None:
            out = bytes(self.data[self.at : self.at + self.piece])
            self.at += len(out)
            return out
        while True:
            if self.zip.eof:  # perhaps another member follows
                rest = self.zip.unused_data.lstrip(b"\0")
                if not rest and self.at >= len(self.data):
                    return b""
                self.zip, raw = zlib.decompressobj(31), rest
            else:
                raw = self.zip.unconsumed_tail
            if not raw:
                raw = bytes(self.data[self.at : self.at + self.piece])
                self.at += len(raw)
                if not raw:
                    raise EOFError("Compressed file ended before the end-of-stream marker was reached")
            try:
                out = self.zip.decompress(raw, 4 * self.piece)
            except zlib.error as e:
                raise tarfile.ReadError(f"zlib error: {e}") from None
            if out:
                return out

    def read(self, n: int) -> bytes:
        """The next n bytes, fewer only at the end."""
        end = self.pos + n
        if end > len(self.buffer):
            parts = [self.buffer[self.pos :]]
            have = len(parts[0])
            while have < n and (more := self._more()):
                parts.append(more)
                have += len(more)
            self.buffer, self.pos, end = b"".join(parts), 0, n
        out = self.buffer[self.pos : end]
        self.pos += len(out)
        return out


class _Back:
    """A stream with a block put back."""

    def __init__(self, head: bytes, rest: _Stream) -> None:
        self.head, self.rest = head, rest

    def read(self, n: int) -> bytes:
        out, self.head = self.head[:n], self.head[n:]
        return out + self.rest.read(n - len(out)) if len(out) < n else out


_ZEROS, _PREFIX = bytes(512), bytes(155)


def _tar_files(data: memoryview, wanted: Callable[[str], object]) -> Iterator[tuple[str, int, bytes]]:
    """(name, size, content) of a tar file's regular members of wanted names. Plain headers are read here, at a fraction of the cost
    of ``tarfile``; from any other header on, that takes over."""
    if data[:2] != b"\x1f\x8b" and bytes(data[257:262]) != b"ustar":  # other ways to compress, other kinds of archive, none
        with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as tar:
            yield from ((m.name, m.size, tar.extractfile(m).read()) for m in tar if m.isfile() and wanted(m.name))
        return
    stream, first = _Stream(data), True
    while True:
        head = stream.read(512)
        if head == _ZEROS:
            return
        name, size = head[:100].rstrip(b"\0"), head[124:135]
        if not (head[156:157] == b"0" and head[345:500] == _PREFIX and size.isdigit() and name.isascii() and b"\0" not in name and _checked(head)):
            try:
                tar = tarfile.open(fileobj=_Back(head, stream), mode="r|")
            except tarfile.ReadError:
                if first:
                    raise
                return  # as tarfile ends at what is no header after the first
            with tar:
                yield from ((m.name, m.size, tar.extractfile(m).read()) for m in tar if m.isfile() and wanted(m.name))
            return
        first = False
        n, member = int(size, 8), name.decode()
        padded = n + (-n & 511)
        content = stream.read(padded)
        if len(content) < padded:
            raise tarfile.ReadError("unexpected end of data")
        if wanted(member):
            yield member, n, content[:n]


def _checked(head: bytes) -> bool:
    """Whether a header is whole and its sum is the one that it states (of which Adler's first half is the rest by 65,521)."""
    told = head[148:154]
    return len(head) == 512 and head[257:262] == b"ustar" and told.isdigit() and (zlib.adler32(head) & 0xFFFF) == (int(told, 8) + sum(head[148:156]) - 255) % 65521


_MEMBER = pa.schema([("path", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())])


def tar_members(files: DataFrame, pattern: str = r"\.docx?$", limit: int = 0) -> DataFrame:
    """(path, member, size, content) of tar files' members by name; at most ``limit`` a file if that is over 0. Broken
    archives give one row with ``error``. Many members go out at once, up to about 8 MB."""
    wanted = re.compile(pattern).search

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _MEMBER.types)], schema=_MEMBER)

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    members = _tar_files(memoryview(content.as_buffer()).cast("B"), wanted)
                    for name, length, data in itertools.islice(members, limit) if limit > 0 else members:
                        rows.append((path, name, length, data, None))
                        size += length
                        if size > 8 << 20 or len(rows) >= 10_000:
                            yield batch()
                            rows, size = [], 0
                except (tarfile.TarError, EOFError, OSError) as e:
                    rows.append((path, None, None, None, repr(e)))
        if rows:
            yield batch()

    return files.select(F.col("path").cast("string").alias("path"), "content").mapInArrow(run, "path string, member string, size bigint, content binary, error string")


def json_lines(spark: SparkSession, paths: str, schema: T.StructType) -> DataFrame:
    """JSON lines of an explicit schema; lines that can't be read have ``_corrupt_record``."""
    full = schema if "_corrupt_record" in schema.fieldNames() else T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)


def coco(spark: SparkSession, paths: str) -> DataFrame:
    return spark.read.schema(S.COCO).option("multiLine", True).json(paths)


def yolo_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(image, class, line) of a folder of label files, and of those below it."""
    text = F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "")
    d = small_files(spark, folder).select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("page_id"), F.explode(F.split(text, r"\r\n|\r|\n")).alias("value"))
    d = d.select("page_id", F.array_join(F.filter(F.split("value", r"\s+"), lambda x: x != ""), " ").alias("line"))
    return d.where("line <> ''").withColumn("class", F.split("line", " ")[0].try_cast("int"))


def logs(spark: SparkSession, paths: str) -> DataFrame:
    """(file, line) of worker logs."""
    return spark.read.text(paths).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("file"), F.col("value").alias("line"))


def zip_join_by_position(texts: DataFrame, metas: DataFrame, position: str = "pos", file: str = "file") -> DataFrame:
    """Texts and metadata that belong together by file and line."""
    return texts.join(metas, [file, position])


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_CORE = {"category": "category", "description": "comments", "contentStatus": "content_status", "identifier": "identifier", "keywords": "keywords", "subject": "subject", "title": "title", "version": "version", "created": "created", "lastPrinted": "last_printed", "modified": "modified"}


def _paragraph(p: ElementTree.Element) -> str:
    return "".join("\t" if x.tag == _W + "tab" else (x.text or "") if x.tag == _W + "t" else "" for x in p.iter())


def docx_text(body: ElementTree.Element) -> str:
    """Paragraphs and tables in order; cells by tabs, rows by line feeds, empty ones left out."""
    out = []
    for x in body:
        if x.tag == _W + "p":
            out.append(_paragraph(x))
        elif x.tag == _W + "tbl":
            out.extend("\t".join("".join(map(_paragraph, c.iter(_W + "p"))) for c in r.iter(_W + "tc")) for r in x.iter(_W + "tr"))
    return "\n".join(t for t in out if t.strip())


_DOCX = T.StructType([T.StructField("text", T.StringType()), T.StructField("pages", T.IntegerType()), T.StructField("uncompressed", T.LongType()), T.StructField("ratio", T.DoubleType()), T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("core", T.MapType(T.StringType(), T.StringType())), T.StructField("error", T.StringType())])


def parse_docx(content: bytes | None, max_bytes: int = MAX_MEMBER_BYTES) -> dict:
    """Text, pages, sizes, languages and core properties of a document; ``error`` says why there is none."""
    out: dict = {k: None for k in ("text", "pages", "uncompressed", "ratio", "languages", "core", "error")}
    if content is None:
        return out
    if len(content) > max_bytes:
        return out | {"error": "FileTooLarge"}
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            size = sum(i.file_size for i in z.infolist())
            packed = sum(i.compress_size for i in z.infolist())
            out |= {"uncompressed": size, "ratio": size / packed if packed else 0.0}
            if size > max_bytes:
                return out | {"error": "UncompressedTooLarge"}
            names = set(z.namelist())
            doc = ElementTree.fromstring(z.read("word/document.xml"))
            out["text"] = docx_text(doc.find(_W + "body"))
            langs = {v for n in ("word/document.xml", "word/styles.xml") if n in names for e in ElementTree.fromstring(z.read(n)).iter(_W + "lang") for k, v in e.attrib.items() if k == _W + "val"}
            out["languages"] = sorted(langs)
            if "docProps/app.xml" in names:
                page = next((e.text for e in ElementTree.fromstring(z.read("docProps/app.xml")) if e.tag.endswith("}Pages")), None)
                out["pages"] = int(page) if page and page.strip().isdigit() else None
            if "docProps/core.xml" in names:
                out["core"] = {_CORE[e.tag.split("}")[-1]]: e.text or "" for e in ElementTree.fromstring(z.read("docProps/core.xml")) if e.tag.split("}")[-1] in _CORE}
    except zipfile.BadZipFile:
        out["error"] = "NoZipFile"
    except (KeyError, ElementTree.ParseError, ValueError, AttributeError) as e:
        out["error"] = f"Unreadable({type(e).__name__})"
    return out


def documents(df: DataFrame, content: str = "content", max_bytes: int = MAX_MEMBER_BYTES) -> DataFrame:
    """The rows with a struct column ``docx``; failed ones have ``docx.error``, so they can go to a dead-letter table."""

    @F.arrow_udf(_DOCX)
    def parsed(contents: pa.Array) -> pa.Array:
        kind = to_arrow_type(_DOCX)
        parts = [pa.array([parse_docx(c, max_bytes) for c in contents.slice(at, SLICE).to_pylist()], kind) for at in range(0, len(contents), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    # not deterministic for the planner, which else parses once more for each filter on the result, by another Python process
    return df.withColumn("docx", parsed.asNondeterministic()(F.col(content)))


def predict_languages(df: DataFrame, text: Column, predict: Callable[[list[str]], list[dict[str, float]]], name: str = "languages", k: int = 5) -> DataFrame:
    """A plug-in language identifier's k best labels with scores; empty text is unknown for sure."""

    @F.pandas_udf(T.MapType(T.StringType(), T.DoubleType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            clean = [" ".join((t or "").lower().split()) for t in s]
            got = iter(predict([t for t in clean if t]))
            yield pd.Series([dict(sorted(next(got).items(), key=lambda x: -x[1])[:k]) if t else {"__label__unknown": 1.0} for t in clean])

    return df.withColumn(name, run(text))


def fetch(urls: DataFrame, get: Callable[[str], dict], tasks: int = 64) -> DataFrame:
    """A plug-in fetcher over the URLs, spread at random over tasks: url, url_hash, status, content_type, content_length, body, error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, h in zip(b["url"], b["url_hash"]):
                try:
                    r = get(u)
                except Exception as e:  # a failed fetch is a row
                    r = {"error": repr(e)}
                rows.append({"url": u, "url_hash": h} | {k: r.get(k) for k in ("status", "content_type", "content_length", "body", "error")})
            yield pd.DataFrame(rows, columns=["url", "url_hash", "status", "content_type", "content_length", "body", "error"])

    return urls.select("url", "url_hash").repartition(tasks).mapInPandas(run, "url string, url_hash string, status int, content_type string, content_length string, body binary, error string")




def annotated_entities(members: DataFrame) -> DataFrame:
    """Entities of the ``entities_*.json`` members of page archives, a row each."""
    schema = T.StructType([T.StructField("entities", T.MapType(T.StringType(), T.ArrayType(S.ENTITY)))])
    d = members.where(F.col("member").rlike(r"(^|/)entities_[^/]*\.json$")).select("path", F.from_json(F.decode("content", "UTF-8"), schema).alias("j"))
    return d.select("path", F.explode(F.flatten(F.map_values("j.entities"))).alias("e")).select("path", "e.*")


def annotated_words(members: DataFrame) -> DataFrame:
    """Words of the ``words_*.json`` members, in order."""
    schema = T.StructType([T.StructField("words", T.ArrayType(S.WORD))])
    d = members.where(F.col("member").rlike(r"(^|/)words_[^/]*\.json$")).select("path", "member", F.from_json(F.decode("content", "UTF-8"), schema).alias("j"))
    return d.select("path", "member", F.posexplode("j.words").alias("word_pos", "w")).select("path", "member", "word_pos", "w.*")
