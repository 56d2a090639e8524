"""Queries over download records and logs: gates, export, audit, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.operators import audit, download
from sheafworks.plans.base import query
from sheafworks.session import read_table

HTTP = """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 200 END AS status, event_id % 13 <> 0 AS responded,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'application/msword' WHEN 2 THEN 'text/html' WHEN 3 THEN 'Application/vnd.openxmlformats-officedocument' ELSE 'application/x-ms-word' END AS content_type,
  CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(CAST(event_id * 1000003 % 200000000 AS BIGINT) AS VARCHAR(20)) END AS content_length FROM events"""
LOGS = """SELECT event_id, user_id, concat('2023::w::', CASE event_id % 12 WHEN 0 THEN 'ERROR::HTTP HEAD request HTTPError=404' WHEN 1 THEN 'ERROR::HTTP HEAD request MaxRetryError(x)' WHEN 2 THEN 'ERROR::HTTP HEAD request InvalidContentType(text)'
  WHEN 3 THEN 'ERROR::HTTP HEAD request InvalidSchema' WHEN 4 THEN 'ERROR::HTTP GET no response' WHEN 5 THEN 'ERROR::FileSizeExceeded(5)' WHEN 6 THEN 'ERROR::maldoc not passed: vba=Yes, xlm=No'
  WHEN 7 THEN 'ERROR::maldoc not passed: suspicious thing,flash=1' WHEN 8 THEN 'ERROR::Batch handler error!' WHEN 9 THEN 'INFO::downloading doc' WHEN 10 THEN 'INFO::Regularly terminated worker' ELSE 'ERROR::strange' END) AS line FROM events"""
_L = f"logs AS ({LOGS})"


def _events(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=read_table(spark, sf_dir, "events"))


_TYPE = "regexp_matches(replace(lower(content_type), '-', ''), '^(application|text)/.*(openxml|word|doc|msword|msdownload|rtf)')"


@query("content_gate", f"""WITH h AS ({HTTP}) SELECT event_id, CASE WHEN NOT responded THEN 'NoResponse' WHEN status <> 200 THEN concat('HTTPError=', status::VARCHAR)
  WHEN TRY_CAST(content_length AS BIGINT) > 94371840 THEN concat('FileSizeExceeded(', content_length, ')') WHEN NOT coalesce({_TYPE}, true) THEN concat('InvalidContentType(', content_type, ')') END AS reason FROM h""")
def content_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _events(spark, sf_dir, HTTP)
    return h.select("event_id", download.header_reason(F.col("status"), F.col("content_length"), F.col("content_type"), F.col("responded")).alias("reason"))


@query("body_gate", f"""WITH h AS ({HTTP}) SELECT event_id, CASE WHEN NOT responded THEN 'NoResponse' WHEN status <> 200 THEN concat('HTTPError=', status::VARCHAR)
  WHEN event_id * 1000003 % 200000000 > 94371840 THEN concat('FileSizeExceeded(', (event_id * 1000003 % 200000000)::VARCHAR, ')') END AS reason FROM h""")
def body_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _events(spark, sf_dir, HTTP)
    return h.select("event_id", download.body_reason(F.col("status"), F.expr("event_id * 1000003 % 200000000"), F.col("responded")).alias("reason"))


@query("reject_histogram", f"""WITH h AS ({HTTP}) SELECT CASE WHEN NOT responded THEN 'NoResponse' WHEN status <> 200 THEN 'HTTPError' WHEN TRY_CAST(content_length AS BIGINT) > 94371840 THEN 'FileSizeExceeded'
  WHEN NOT coalesce({_TYPE}, true) THEN 'InvalidContentType' ELSE 'ok' END AS reason, count(*) AS n FROM h GROUP BY 1""")
def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = content_gate(spark, sf_dir)
    return r.groupBy(F.coalesce(F.regexp_extract("reason", "^([A-Za-z]+)", 1), F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


@query("maldoc_gate", """WITH k AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
  SELECT event_id, array_to_string(list_filter([CASE WHEN k % 2 = 1 THEN concat('vba=', k::VARCHAR) END, CASE WHEN k % 3 = 1 THEN concat('xlm=', (k + 1)::VARCHAR) END], lambda x: x IS NOT NULL), ',') AS reason FROM k""")
def maldoc_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    ind = lambda i, risk, value: F.struct(F.lit(i).alias("id"), risk.alias("risk"), value.cast("string").alias("value"))
    arr = F.array(ind("vba", F.when(k % 2 == 1, "HIGH").otherwise("NONE"), k), ind("xlm", F.when(k % 3 == 1, "MEDIUM").otherwise("info"), k + 1), ind("other", F.lit("HIGH"), k))
    return read_table(spark, sf_dir, "events").select("event_id", download.maldoc_reason(arr).alias("reason"))


_CODES = r"""codes AS (SELECT unnest(CASE WHEN contains(line, 'HTTP HEAD request') THEN [CASE WHEN contains(line, 'HTTPError') THEN concat('HTTP-', list_last(string_split(line, '='))) WHEN contains(line, 'MaxRetryError') THEN 'HTTP-MaxRetry'
     WHEN contains(line, 'InvalidContentType') THEN 'HTTP-ContentType' WHEN contains(line, 'InvalidSchema') THEN 'HTTP-InvalidURL' ELSE 'HTTP-Other' END]
   WHEN contains(line, 'HTTP GET no response') THEN ['HTTP-None'] WHEN contains(line, 'FileSizeExceeded') THEN ['MaxFileSize']
   WHEN contains(line, 'maldoc not passed') THEN list_filter(list_transform(string_split(list_last(string_split(line, ':')), ','), lambda t: CASE WHEN contains(t, '=') THEN concat('maldoc-', trim(string_split(t, '=')[1])) WHEN contains(t, 'suspicious') THEN 'maldoc-suspicious' END), lambda c: c IS NOT NULL)
   WHEN contains(line, 'Batch handler') THEN [] ELSE ['Other'] END) AS code FROM logs WHERE contains(line, 'ERROR::'))"""


@query("error_taxonomy", f"WITH {_L}, {_CODES} SELECT code, count(*) AS n FROM codes GROUP BY code")
def error_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.error_histogram(_events(spark, sf_dir, LOGS))


@query("worker_log_audit", f"""WITH {_L}, c AS (SELECT user_id % 10 AS worker, count(*) FILTER (contains(line, 'INFO::Regularly terminated worker')) AS n_terminated, count(*) FILTER (contains(line, 'INFO::downloading doc')) AS n_downloads,
  count(*) FILTER (contains(line, 'Batch handler error!')) AS n_batch_failures FROM logs GROUP BY 1) SELECT *, n_downloads % 100 <> 0 AS strange FROM c""")
def worker_log_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.worker_counters(_events(spark, sf_dir, LOGS).withColumn("worker", F.col("user_id") % 10), "worker")


@query("log_last_fetch", """WITH l AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN concat('Fetching seg', event_id::VARCHAR) WHEN event_id % 3 = 1 THEN 'Success!' ELSE 'noise' END AS line FROM events),
  f AS (SELECT *, last_value(CASE WHEN line LIKE 'Fetching %' THEN substr(line, 10) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS segment FROM l)
  SELECT user_id, event_id, segment FROM f WHERE line = 'Success!'""")
def log_last_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr("case when event_id % 3 = 0 then concat('Fetching seg', event_id) when event_id % 3 = 1 then 'Success!' else 'noise' end")
    return audit.last_fetched(read_table(spark, sf_dir, "events").select("user_id", "event_id", line.alias("line")), "user_id", "event_id")


@query("rate_last_200", """WITH w AS (SELECT event_id, sum(1 + event_id % 4) OVER o AS pages, epoch(ts) - epoch(first_value(ts) OVER o) AS span FROM events WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW))
  SELECT event_id, pages::BIGINT AS pages_in_window, round(CASE WHEN span < 1e-6 THEN 0 ELSE pages / span END, 6) AS rate FROM w""")
def rate_last_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", (1 + F.col("event_id") % 4).alias("pages"))
    return audit.sliding_rate(e, ["ts", "event_id"], "pages", "ts", "ts", partition=["event_type"]).select("event_id", "pages_in_window", F.round("rate", 6).alias("rate"))


@query("running_totals", """SELECT event_id, count(*) OVER o AS n_docs, (sum(1 + event_id % 4) OVER o)::BIGINT AS n_pages, (count(*) OVER o - sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER o)::BIGINT AS n_success,
  round(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER o / count(*) OVER o, 6) AS fail_prop FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", (1 + F.col("event_id") % 4).alias("pages"), (F.col("event_type") == "error").alias("failed"))
    return audit.running_totals(e, ["ts", "event_id"], "pages", "failed", ["user_id"]).select("event_id", "n_docs", "n_pages", "n_success", F.round("fail_prop", 6).alias("fail_prop"))


@query("bytehash_export", """WITH r AS (SELECT doc_id, concat('http://', source, '/', doc_id::VARCHAR) AS url, sha256(doc_id::VARCHAR) AS url_hash, source AS crawl_id, CASE WHEN doc_id % 17 = 0 THEN 'None' ELSE sha256(text) END AS bytehash FROM documents),
  n AS (SELECT *, row_number() OVER (PARTITION BY bytehash ORDER BY doc_id DESC) AS rn FROM r WHERE bytehash <> 'None' AND bytehash NOT IN (SELECT bytehash FROM r WHERE doc_id % 23 = 0))
  SELECT url, url_hash, crawl_id, bytehash FROM n WHERE rn = 1""")
def bytehash_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    r = d.select("doc_id", F.concat(F.lit("http://"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"), F.sha2(F.col("doc_id").cast("string"), 256).alias("url_hash"), F.col("source").alias("crawl_id"), F.when(F.col("doc_id") % 17 == 0, "None").otherwise(F.sha2("text", 256)).alias("bytehash"))
    return audit.export(r, r.where("doc_id % 23 = 0"), ["doc_id"])


@query("audit_counters", """WITH q AS (SELECT doc_id, sha256(text) AS h FROM documents), p AS (SELECT * FROM q WHERE doc_id % 3 <> 0), a AS (SELECT * FROM p WHERE doc_id % 2 = 0)
  SELECT (SELECT count(*) FROM q) AS n_required, (SELECT count(DISTINCT h) FROM q) AS n_required_distinct, (SELECT count(*) FROM p) AS n_processed, (SELECT count(DISTINCT h) FROM p) AS n_processed_distinct,
   (SELECT count(*) FROM a) AS n_alive, (SELECT count(DISTINCT h) FROM a) AS n_alive_distinct, (SELECT count(*) FROM (SELECT h FROM q EXCEPT SELECT h FROM p)) AS n_missing""")
def audit_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("url_hash"))
    p = q.where("doc_id % 3 <> 0")
    return audit.counters(q, p, p.where("doc_id % 2 = 0"))


@query("normalise_sources", "SELECT event_id, nullif(CASE WHEN event_id % 4 = 0 THEN 'None' ELSE event_type END, 'None') AS status_code, array_to_string(string_split(nullif(CASE WHEN event_id % 5 = 0 THEN 'None' ELSE 'en,de' END, 'None'), ','), '|') AS langs FROM events")
def normalise_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    s = e.select(F.col("event_id").cast("string").alias("event_id"), F.when(F.col("event_id") % 4 == 0, "None").otherwise(F.col("event_type")).alias("status_code"), F.when(F.col("event_id") % 5 == 0, "None").otherwise("en,de").alias("content_language"))
    return download.normalise_sources(s).select(F.col("event_id").cast("bigint").alias("event_id"), "status_code", F.array_join("content_language", "|").alias("langs"))


@query("shard_rotation", """WITH RECURSIVE o AS (SELECT source, doc_id, strlen(text)::BIGINT AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
  r AS (SELECT source, doc_id, rn, size, 0 AS shard, CASE WHEN size > 100000 THEN 0 ELSE size END AS total, size > 100000 AS closed FROM o WHERE rn = 1
   UNION ALL SELECT o.source, o.doc_id, o.rn, o.size, r.shard + r.closed::INT, CASE WHEN r.total + o.size > 100000 THEN 0 ELSE r.total + o.size END, r.total + o.size > 100000 FROM r JOIN o ON o.source = r.source AND o.rn = r.rn + 1)
  SELECT source, doc_id, size, shard FROM r""")
def shard_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("source", "doc_id", F.octet_length("text").alias("size"))
    return download.rotate_shards(d, "source", "doc_id", "size", 100_000)
