"""ARC files against a plain parser written from the format, broken files, compressed files, and what the query returns."""

import base64
import collections
import datetime
import gzip
import hashlib
import io
import random

import pandas as pd
import pytest

from sheafworks.llm import registry, warc

HTTP = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"


def record(name, version=1, body=b"hi", stamp="20080102030405", length=None):
    out = warc.arc_record(f"http://{name}/", stamp, "text/html", HTTP + body, version, "1.2.3.4")
    return out if length is None else out.replace(b" %d\n" % len(HTTP + body), b" %d\n" % length, 1)


def urls(data):
    return [("error" if h.get("error") else h["url"]) for h, _ in warc.parse_arc(data)]


@pytest.mark.parametrize("version", [1, 2])
def test_goes_on_after_errors(version):
    first = warc.version_block("x.arc", "20080101000000", version)
    a, b, c = (record(n, version) for n in "abc")
    top, ua, ub, uc = "filedesc://x.arc", "http://a/", "http://b/", "http://c/"
    assert urls(first + a + b"garbage\nmore garbage 12\n" + b + c) == [top, ua, "error", ub, uc]
    assert urls(first + a + record("b", version, length=10**6) + c) == [top, ua, "error", uc]
    assert urls(first + a + record("b", version, length=3) + c) == [top, ua, ub, "error", uc]
    assert urls(first + a + record("b", version, stamp="20081302030405") + c) == [top, ua, ub, uc]
    assert urls(a + b) == ["error", ua, ub] and urls(b"junk\n" + a + b) == ["error", ua, ub]
    rows = [warc.to_warc(h, x) for h, x in warc.parse_arc(first + record("b", version, stamp="20081302030405") + c)]
    assert [r.get("record") is None for r in rows] == [False, True, False] and "impossible date" in rows[1]["error"]
    whole = first + a + b"garbage\n" + b
    assert b"".join(x for h, x in warc.parse_arc(whole) if h.get("error")) == b"garbage\n"


def test_compressed():
    parts = [warc.version_block("x.arc", "20080101000000", 1), *(record(n, 1, random.Random(n).randbytes(100_000)) for n in "abcd")]
    plain = list(warc.parse_arc(b"".join(parts)))
    assert list(warc.parse_arc(b"".join(map(gzip.compress, parts)))) == plain == list(warc.parse_arc(gzip.compress(b"".join(parts))))
    members = list(map(gzip.compress, parts))
    broken = members[2][:50_000] + bytes(20) + members[2][50_020:]
    assert urls(b"".join([*members[:2], broken, *members[3:]])) == ["filedesc://x.arc", "http://a/", "error", "http://c/", "http://d/"]
    assert urls(b"".join(members)[:-9])[-1] == "error" and len(urls(b"".join(members)[:-9])) == 5


def test_line_feeds_in_urls():
    data = warc.version_block("x.arc", "20080101000000", 2) + warc.arc_record("http://a/\nb c\t", "20080102030405", "text/html", HTTP, 2) + record("b", 2)
    assert urls(data) == ["filedesc://x.arc", "http://a/%0Ab c%09", "http://b/"]
    rows = [warc.to_warc(h, x) for h, x in warc.parse_arc(data)]
    assert all(line.startswith((b"WARC", b"Content-")) for line in rows[1]["record"].split(b"\r\n\r\n")[0].splitlines())


def plain_parser(data):
    """Reads as the format says, line by line."""
    f, out = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data), []
    while line := f.readline():
        fields = line[:-1].decode().split(" ")
        body = f.read(int(fields[-1]))
        assert f.read(1) == b"\n"
        n = 4 if len(fields) == 5 or not out and not fields[-2].endswith(("arc", "gz")) else 9
        url, date = " ".join(fields[: len(fields) - n]), fields[len(fields) - n + 1]
        out.append((url, datetime.datetime.strptime(date, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ"), fields[len(fields) - n], body))
    return out


def test_query_brute_force(spark):
    """Every archive of the query by the plain parser; every page comes out with its own bytes, whatever the partitions."""
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    files = {r.arc_id: bytes(r.content) for r in warc.pages_as_arc(pages, target_bytes=200_000).collect()}
    other = {r.arc_id: bytes(r.content) for r in warc.pages_as_arc(pages.repartition(7), target_bytes=200_000).collect()}
    assert files == other and len(files) > 4 and {f[-2:] for f in files} == {"gz", "rc"}
    sha = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
    want = collections.Counter()
    for name, data in files.items():
        for k, (url, date, ip, body) in enumerate(plain_parser(data)):
            http = body.startswith(b"HTTP/")
            want[name, k, None if not k else url, date, None if ip == "0.0.0.0" else ip, sha(body), sha(body.split(b"\r\n\r\n", 1)[1]) if http else None, len(body), "response" if http else "warcinfo"] += 1
    got = warc.convert(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "arc_id string, content binary")).collect()
    assert collections.Counter((r.arc_id, r.position, r.uri, r.date, r.ip, r.block_digest, r.payload_digest, r.n_bytes, r.type) for r in got) == want
    rows = registry.QUERIES["op7_arc_to_warc"](spark, sf).collect()
    d = pd.read_parquet(f"{sf}/pages.parquet")
    assert not [r for r in rows if r.error]
    assert collections.Counter((r.uri, r.payload_digest) for r in rows if r.type == "response") == collections.Counter((u, sha(h.encode())) for u, h in zip(d["url"], d["html"]))


def test_small_pages(spark):
    odd = [(1, "http://a/", "x"), (1, "http://a/", "x"), (None, None, None), (None, "http://b\n/", ""), (2, "http://c/", "y" * 300_000), (150, "", "z")]
    df = spark.createDataFrame(odd, "page_id long, url string, html string").selectExpr("*", "1 as part", "2 as content")
    rows = warc.convert(warc.pages_as_arc(df, target_bytes=1000)).collect()
    assert not [r for r in rows if r.error]
    assert sorted(r.uri for r in rows if r.type == "response") == ["http://a/", "http://a/", "http://b%0A/", "http://c/", "http://url.invalid/", "http://url.invalid/"]
    assert warc.pages_as_arc(df.limit(0)).count() == 0
