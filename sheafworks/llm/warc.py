"""Legacy archives: ARC files to WARC records.

An ARC file begins with a version block (``filedesc://…``) whose second line names the version:

* 1: record lines ``URL IP-address Archive-date Content-type Archive-length``
* 2: record lines ``URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length``

Each record line is followed by as many bytes as it declares and a line feed. A file may be compressed with gzip, as a whole or
record by record. For each record an equivalent WARC record
is synthesised: type (``warcinfo`` for the version block, ``response`` for HTTP records, ``resource`` for others), date
(ISO 8601 from the 14 digits), a record id that depends only on URL, date and block digest (so converting again, or
after a lost executor, gives equal ids), block and payload digests (SHA-1 in base 32), and lengths.

Defined results: a null or empty file gives no record; where a record line should be and isn't, or declares more bytes than the
file has, a row with ``error`` and without a record stands for the bytes up to the next line that is a record line of the version
and whose length fits, and conversion goes on there; likewise for the bytes up to the first record of a file without a version block
(its records are read as version 2 or 1 by their own lines), and for damaged gzip members; ``-`` or empty fields are null; a date
of fewer than 14 digits is filled up with the earliest instant; an impossible date gives a row with ``error`` and no record,
since a WARC record must have a date; URLs with spaces are kept, as fields are counted from the right, and control characters
in them are percent-encoded; repeated records are kept, with equal ids. Files are read one at a time, each as a whole.
Only the id and content columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
import calendar
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.session import read_table

FIELDS = {1: ("ip", "date", "mime", "length"), 2: ("ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length")}
_NAMESPACE = uuid.UUID("6f1d2c0e-5c3a-5d6b-9a43-0b7a5c9d1e77")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_STATUS = re.compile(rb"HTTP/\d(?:\.\d)?[ \t]+(\d{3})")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso_date(stamp: str | None) -> str | None:
    """``20080430204825`` → ``2008-04-30T20:48:25Z``."""
    if not stamp or not stamp.isascii() or not stamp.isdigit() or not 4 <= len(stamp) <= 14 or len(stamp) % 2:
        return None
    s = stamp + "00000101000000"[len(stamp) :]
    y, mo, d, h, mi, sec = int(s[:4]), int(s[4:6]), int(s[6:8]), int(s[8:10]), int(s[10:12]), int(s[12:])
    if not (y and 1 <= mo <= 12 and 1 <= d <= calendar.monthrange(y, mo)[1] and h < 24 and mi < 60 and sec < 61):
        return None
    return f"{y:04d}-{mo:02d}-{d:02d}T{h:02d}:{mi:02d}:{sec:02d}Z"


def parse_line(line: bytes, version: int) -> dict:
    names = FIELDS[version]
    parts = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names))
    if len(parts) != len(names) + 1 or not parts[-1].isdigit():
        raise ValueError(f"not a version-{version} record line: {line[:120]!r}")
    return {"url": parts[0]} | {k: (None if v in ("-", "") else v) for k, v in zip(names, parts[1:])} | {"length": int(parts[-1])}


_MAGIC = b"\x1f\x8b\x08"
_RECORD_LINE = re.compile(rb"^[A-Za-z][A-Za-z0-9+.-]*:[^\r\n]* [0-9]+\r?$", re.M)


def inflate(data: bytes) -> Iterator[tuple[bytes, str | None]]:
    """Runs of plain bytes of a gzip file's members, and damaged stretches with what is wrong. Other data are one run."""
    if data[:3] != _MAGIC:
        yield data, None
        return
    at, plain, view = 0, [], memoryview(data)
    while at < len(data):
        member, out, to = zlib.decompressobj(31), [], at
        try:
            if data[at : at + 3] != _MAGIC:
                raise zlib.error("no gzip member begins here")
            while not member.eof:
                if to >= len(data):
                    raise zlib.error("a gzip member is cut off")
                out.append(member.decompress(view[to : to + 65536]))
                to = min(len(data), to + 65536)
            plain += out
            at = to - len(member.unused_data)
        except zlib.error as e:
            if plain:
                yield b"".join(plain), None
                plain = []
            after = data.find(_MAGIC, at + 1)
            after = len(data) if after < 0 else after
            yield data[at:after], str(e)
            at = after
    if plain:
        yield b"".join(plain), None


def parse_arc(data: bytes | None) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record, the version block first; those with ``error`` stand for bytes that are no record."""
    version = None
    for plain, error in inflate(data or b""):
        if error:
            yield {"url": None, "version": version, "error": error}, plain
            continue
        for head, block in _records(plain, version):
            version = head["version"]
            yield head, block


def _place(data: bytes, at: int, version: int | None) -> tuple[dict, int]:
    """The record line at a position, and where its block begins; a ValueError if there is none that fits."""
    end = data.find(b"\n", at)
    line = data[at : end if end >= 0 else len(data)]
    if line.startswith(b"filedesc://"):
        # the version block's own line has the fields of its version, which its first block line names
        second = data[end + 1 : end + 64].split(b"\n", 1)[0].split(b" ") if end >= 0 else []
        if not second or second[0] not in (b"1", b"2"):
            raise ValueError("no version block of version 1 or 2")
        version = int(second[0])
        head = parse_line(line, version if len(line.rsplit(b" ", 9)) == 10 else 1)
    elif version is None:
        long = re.search(rb" \S* \S* \S* \S* \d+ \S* \d+\r?$", line)  # the fields from status to length
        version = 2 if long else 1
        head = parse_line(line, version)
    else:
        head = parse_line(line, version)
    if end < 0 or end + 1 + head["length"] > len(data):
        raise ValueError(f"the declared length {head['length']} runs over the file's end")
    return head | {"version": version}, end + 1


def _records(data: bytes, version: int | None) -> Iterator[tuple[dict, bytes]]:
    at, size = 0, len(data)
    while at < size:
        if data[at] in b"\r\n":
            at += 1
            continue
        try:
            head, start = _place(data, at, version)
            if version is None and not head["url"].startswith("filedesc://"):
                raise ValueError
        except ValueError as e:
            end, error = size, "no version block of version 1 or 2" if version is None else str(e)
            # the next line that is a record line, after this one
            for m in _RECORD_LINE.finditer(data, at if version is None else at + 1):
                try:
                    head, _ = _place(data, m.start(), version)
                except ValueError:
                    continue
                if head["url"].startswith("filedesc://") or iso_date(head["date"]):
                    end = m.start()
                    if version is None:
                        version = head["version"]
                    break
            yield {"url": None, "version": version, "error": error}, data[at:end]
            at = end
            continue
        version = head["version"]
        at = start + head["length"]
        yield head, data[start:at]


def to_warc(head: dict, block: bytes) -> dict:
    """The equivalent WARC record's fields and its bytes."""
    url, out = head.get("url"), {"version": head.get("version"), "error": head.get("error")}
    if not out["error"] and iso_date(head.get("date")) is None:
        out["error"] = f"impossible date {head.get('date')!r}"
    if out["error"]:
        return out | {"n_bytes": len(block)}
    url = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)
    scheme = url.split(":", 1)[0].lower()
    http = scheme in ("http", "https") and block[:5] == b"HTTP/"
    out["type"] = "warcinfo" if scheme == "filedesc" else "response" if http else "resource"
    out["uri"] = None if out["type"] == "warcinfo" else url
    out["date"] = iso_date(head["date"])
    out["ip"] = None if head.get("ip") in (None, "0.0.0.0") else head["ip"]
    out["content_type"] = {"warcinfo": "text/plain", "response": "application/http; msgtype=response"}.get(out["type"]) or head.get("mime") or "application/octet-stream"
    payload, status, mime = block, None, head.get("mime")
    if http:
        cut = min((k + n for k, n in ((block.find(b"\r\n\r\n"), 4), (block.find(b"\n\n"), 2)) if k >= 0), default=len(block))
        payload = block[cut:]
        status = int(m.group(1)) if (m := _STATUS.match(block)) else int(head["status"]) if (head.get("status") or "").isdigit() else None
    out |= {"payload_type": mime, "http_status": status, "block_digest": digest(block), "payload_digest": digest(payload) if http else None, "n_bytes": len(block)}
    out["record_id"] = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{url} {head.get("date")} {out["block_digest"]}')}>"
    lines = [("WARC-Type", out["type"]), ("WARC-Record-ID", out["record_id"]), ("WARC-Date", out["date"]), ("WARC-Target-URI", out["uri"]), ("WARC-IP-Address", out["ip"]), ("WARC-Filename", url[len("filedesc://") :] if out["type"] == "warcinfo" else None), ("WARC-Block-Digest", out["block_digest"]), ("WARC-Payload-Digest", out["payload_digest"]), ("WARC-Identified-Payload-Type", mime if http else None), ("Content-Type", out["content_type"]), ("Content-Length", str(len(block)))]
    out["record"] = b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode() + b"\r\n" + block + b"\r\n\r\n"
    return out


_COLUMNS = {"arc_id": pa.string(), "position": pa.int32(), "version": pa.int32(), "record_id": pa.string(), "type": pa.string(), "uri": pa.string(), "date": pa.string(), "ip": pa.string(), "content_type": pa.string(), "payload_type": pa.string(), "http_status": pa.int32(), "block_digest": pa.string(), "payload_digest": pa.string(), "n_bytes": pa.int64(), "error": pa.string(), "record": pa.binary()}
SCHEMA = ", ".join(f"{k} {({pa.string(): 'string', pa.int32(): 'int', pa.int64(): 'bigint', pa.binary(): 'binary'})[v]}" for k, v in _COLUMNS.items())


def convert(files: DataFrame, id_col: str = "arc_id", content_col: str = "content") -> DataFrame:
    """WARC records of ARC files (for instance of ``spark.read.format("binaryFile")``), a row a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arc_id, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for k, (head, block) in enumerate(parse_arc(content.as_py())):
                    rows.append({"arc_id": arc_id, "position": k} | to_warc(head, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.select(F.col(id_col).cast("string").alias("arc_id"), F.col(content_col).alias("content")).mapInArrow(run, SCHEMA)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], t) for k, t in _COLUMNS.items()], names=list(_COLUMNS))


def arc_record(url: str, stamp: str, mime: str, block: bytes, version: int, ip: str = "0.0.0.0", status: int = 200, offset: int = 0, filename: str = "-") -> bytes:
    url = _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)
    if version == 1:
        head = f"{url} {ip} {stamp} {mime} {len(block)}"
    else:
        head = f"{url} {ip} {stamp} {mime} {status} {hashlib.md5(block).hexdigest()} - {offset} {filename} {len(block)}"
    return head.encode() + b"\n" + block + b"\n"


def version_block(name: str, stamp: str, version: int) -> bytes:
    text = f"{version} 0 Crawler\n" + ("URL IP-address Archive-date Content-type Archive-length" if version == 1 else "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length") + "\n"
    return arc_record(f"filedesc://{name}", stamp, "text/plain", text.encode(), version, filename=name)


PAGES = 100  # page ids that an archive's range has


def pages_as_arc(pages: DataFrame, target_bytes: int = 4 << 20) -> DataFrame:
    """Every page as an HTTP record of ARC files, the archive that the query converts. A file holds the pages of a range of
    ``PAGES`` ids, or, of a range of more than ``target_bytes``, part of them; versions 1 and 2, plain and compressed record by
    record come in turn. Files depend on the rows alone, not on how the table is cut up. Pages of null id go to many ranges, by hash."""
    part = F.coalesce(F.floor(F.col("page_id") / PAGES), -1 - F.pmod(F.xxhash64("url", "html"), F.lit(1024)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(parts)], pa.binary())], names=["arc_id", "content"])

        def add(record: bytes) -> int:
            if now % 4 > 1:
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                record = z.compress(record) + z.flush()
            parts.append(record)
            return len(record)

        parts: list[bytes] = []
        size, now, turn, name = 0, None, 0, ""
        for batch in batches:
            for key, page_id, url, page in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if parts and (key != now or size >= target_bytes):
                    yield close()
                    parts, size = [], 0
                turn = turn + 1 if key == now and not parts else 0 if key != now else turn
                now, number = key, page_id or 0
                version = 1 + now % 2
                stamp = f"2008{1 + number % 12:02d}{1 + number % 28:02d}{number % 24:02d}{number % 60:02d}{number * 7 % 60:02d}"
                if not parts:
                    name = f"crawl-{now:012d}-{turn:05d}.arc" + (".gz" if now % 4 > 1 else "")
                    size += add(version_block(name, stamp, version))
                body = (page or "").encode("utf-8", "surrogatepass")
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body
                ip = f"10.{number >> 16 & 255}.{number >> 8 & 255}.{number & 255}"
                size += add(arc_record(url or "http://url.invalid/", stamp, "text/html", block, version, ip, offset=size, filename=name))
        if parts:
            yield close()

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").withColumn("part", part)
    rows = rows.repartition("part").sortWithinPartitions("part", "page_id", "url", "html")
    return rows.select("part", "page_id", "url", "html").mapInArrow(run, "arc_id string, content binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert(pages_as_arc(read_table(spark, sf_dir, "pages")))
