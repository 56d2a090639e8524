"""Log lines as data: the error taxonomy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_codes(line: Column) -> Column:
    """The codes that a log line counts under: none or one, several for documents that failed the malware gate."""
    has = lambda *texts: F.exists(F.array(*map(F.lit, texts)), lambda t: F.contains(line, t))
    after = lambda sep: F.trim(F.element_at(F.split(line, sep), -1))
    head = (
        F.when(has("HTTPError"), F.concat(F.lit("HTTP-"), after("=")))
        .when(has("MaxRetryError"), F.lit("HTTP-MaxRetry"))
        .when(has("InvalidContentType"), F.lit("HTTP-ContentType"))
        .when(has("InvalidURL", "Invalid URL", "InvalidSchema"), F.lit("HTTP-InvalidURL"))
        .when(has("TooManyRedirects"), F.lit("HTTP-TooManyRedirects"))
        .otherwise(F.lit("HTTP-Other"))
    )
    tokens = F.split(F.element_at(F.split(line, ":"), -1), ",")
    maldoc = F.filter(
        F.transform(tokens, lambda t: F.when(F.contains(t, F.lit("=")), F.concat(F.lit("maldoc-"), F.trim(F.get(F.split(t, "="), F.lit(0))))).when(F.contains(t, F.lit("suspicious")), F.lit("maldoc-suspicious"))),
        lambda c: c.isNotNull(),
    )
    none = F.array().cast("array<string>")
    return (
        F.when(has("HTTP HEAD request"), F.array(head))
        .when(has("HTTP GET no response"), F.array(F.lit("HTTP-None")))
        .when(has("max filesize", "FileSizeExceeded"), F.array(F.lit("MaxFileSize")))
        .when(has("maldoc not passed"), maldoc)
        .when(has("Batch handler"), none)
        .otherwise(F.array(F.lit("Other")))
    )
