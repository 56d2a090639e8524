"""URL and identifier expressions: Column → Column, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A document URL. ``(?U)``: white space and word characters as in Unicode; a final line feed is allowed.
DOC_URL = r"(?U)^(www|http:|https:)+[^\s]+\w\.(doc|docx)\n?\z"
CONTENT_TYPE = r"(?is)^(application|text)/.*(openxml|word|doc|msword|msdownload|rtf).*"
CRAWL_ID = r"(CC-MAIN-\d{4}-\d{2})"
MAX_HTTP_BYTES = 90 * 1024 * 1024


def is_doc_url(url: Column) -> Column:
    return url.rlike(DOC_URL)


def url_hash(url: Column) -> Column:
    """SHA-256 of the URL as it came, in hexadecimal."""
    return F.sha2(url, 256)


def crawl_of(path: Column) -> Column:
    """The first crawl id in a file name; an error where there is none."""
    found = F.regexp_extract(path, CRAWL_ID, 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit("no crawl id in "), path)))


def unquote(url: Column) -> Column:
    """Percent-decoding that leaves ``+`` and malformed escapes as they are."""
    escaped = F.replace(F.regexp_replace(url, "%(?![0-9a-fA-F]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(escaped)


def clean_url(url: Column) -> Column:
    """The innermost document URL of a (redirect) URL.

    With starts = offsets of ``http`` and ends = ends of ``.doc``/``.docx``: null without either; with one start or
    several and one end, from the last start (or the only one) to the first end; otherwise from the last start before
    the first end. Empty where the end precedes the start.
    """
    n = F.length(url)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(at, lambda i: F.substring(url, i, F.lit(4)) == "http")
    dots = F.filter(at, lambda i: F.substring(url, i, F.lit(4)) == ".doc")
    ends = F.transform(dots, lambda i: i - 1 + F.when(F.substring(url, i, F.lit(5)) == ".docx", 5).otherwise(4))
    first = F.array_min(ends)
    before = F.size(F.filter(starts, lambda s: s <= first))
    k = F.when(F.size(ends) == 1, F.size(starts)).otherwise(F.greatest(F.lit(1), before))
    k = F.when(F.size(starts) == 1, F.lit(1)).otherwise(k)
    begin = F.element_at(starts, k)
    return F.when((F.size(starts) > 0) & (F.size(ends) > 0), F.substring(url, begin, F.greatest(F.lit(0), first - begin + 1)))


def zero_filled(number: Column, width: int) -> Column:
    """Left-filled with zeros; longer numbers stay whole."""
    s = number.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def valid_content_type(content_type: Column) -> Column:
    plain = F.replace(F.lower(content_type), F.lit("-"), F.lit(""))
    return F.coalesce(plain.rlike(CONTENT_TYPE), F.lit(True))


def content_length_error(length: Column) -> Column:
    """``FileSizeExceeded(n)`` for a readable length over the limit, else null."""
    n = length.try_cast("bigint")
    return F.when(n > MAX_HTTP_BYTES, F.concat(F.lit("FileSizeExceeded("), n.cast("string"), F.lit(")")))


def extension(name: Column) -> Column:
    """What a file name's last dot begins, '' without one; leading dots begin none."""
    return F.regexp_extract(name, r"[^./][^/]*?(\.[^./]*)$", 1)


def doc_filename(hash_: Column, url: Column) -> Column:
    return F.concat(F.lit("doc_"), hash_, extension(url))


def member_id(name: Column) -> Column:
    """From the first ``doc_`` on, without any ``doc_``."""
    return F.replace(F.substring(name, F.greatest(F.lit(1), F.instr(name, "doc_")), F.length(name)), F.lit("doc_"), F.lit(""))


def page_id(doc_id: Column, page: Column) -> Column:
    return F.concat(doc_id, F.lit("_p"), zero_filled(page, 5))


def page_number(page_id_: Column) -> Column:
    return F.element_at(F.split(page_id_, "_p"), -1).try_cast("int")
