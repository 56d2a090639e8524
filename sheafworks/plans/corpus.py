"""Queries over documents: metrics, normalisation, corpus filters, perplexity, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.functions import text as X
from sheafworks.operators import quality, urls, whitelist
from sheafworks.plans.base import query
from sheafworks.session import read_spread, read_table

# metadata that the documents table hasn't, by integer arithmetic; the same text runs in both engines
DOC_META = """SELECT doc_id, sha256_hex AS url_hash, lang,
  CASE WHEN doc_id % 29 = 0 THEN '__label__unknown' ELSE concat('__label__', lang) END AS top_lang,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(100 + (n_chars * 37 + doc_id * 13) % 900 AS DOUBLE) END AS perplexity,
  CAST((doc_id * 7919) % 1000 AS DOUBLE) / 1000 AS quality, concat('shard_', CAST(doc_id % 5 AS VARCHAR(20))) AS shard, n_chars
FROM hashed"""
PAGE_META = """SELECT concat('doc_', url_hash, '_p', lpad(CAST(p AS VARCHAR(9)), 5, '0')) AS page_id, url_hash, shard AS annotated_shard_id,
  CAST((doc_id * 3 + p * 5) % 7 AS INT) AS pdf_word_count, CAST((doc_id + p) % 3 AS INT) AS num_heading_1, CAST((doc_id + 2 * p) % 4 AS INT) AS num_text,
  CASE WHEN (doc_id * p) % 9 = 0 THEN 1 ELSE 0 END AS num_table, CAST((doc_id * 31 + p * 17) % 100 AS DOUBLE) / 100 AS top_lang_score
FROM paged"""
_D = f"hashed AS (SELECT *, sha256(CAST(doc_id AS VARCHAR)) AS sha256_hex FROM documents), doc_meta AS ({DOC_META})"
_P = f"{_D}, paged AS (SELECT d.*, p.p FROM doc_meta d JOIN (SELECT unnest([1, 2, 3]) AS p) p ON p.p <= 1 + d.doc_id % 3), page_meta AS ({PAGE_META})"


def doc_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", F.sha2(F.col("doc_id").cast("string"), 256).alias("sha256_hex"))
    return spark.sql(DOC_META.replace("hashed", "{hashed}"), hashed=hashed)


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_meta(spark, sf_dir)
    paged = d.withColumn("p", F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + F.col("doc_id") % 3)))
    return spark.sql(PAGE_META.replace("FROM paged", "FROM {paged}"), paged=paged)


_BLACK = """ medians AS (SELECT median(quality) AS m FROM doc_meta), limits AS (SELECT top_lang, quantile_cont(perplexity, 0.8) AS t FROM doc_meta GROUP BY top_lang),
  judged AS (SELECT d.*, t, (quality < m OR perplexity IS NULL OR coalesce(perplexity > t, false) OR top_lang = '__label__unknown') AS blacklisted,
    CASE WHEN perplexity IS NULL THEN NULL WHEN perplexity > t THEN 'high' ELSE 'low-mid' END AS bucket FROM doc_meta d JOIN limits USING (top_lang), medians)"""
_PAGES = """ kept AS (SELECT p.* FROM page_meta p ANTI JOIN (SELECT url_hash FROM judged WHERE blacklisted) b USING (url_hash)
    WHERE pdf_word_count > 0 AND num_heading_1 + num_text + num_table > 0 {strict} AND top_lang_score > 0.5)
  SELECT annotated_shard_id, count(*) AS n_pages, string_agg(page_id, ',' ORDER BY page_id) AS page_ids FROM kept GROUP BY annotated_shard_id"""


@query("whitelist_docs", f"WITH {_D}, {_BLACK} SELECT doc_id, url_hash, bucket, blacklisted FROM judged")
def whitelist_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.judge_documents(doc_meta(spark, sf_dir)).select("doc_id", "url_hash", "bucket", "blacklisted")


def _whitelist_pages(spark: SparkSession, sf_dir: str, strict: bool) -> DataFrame:
    kept = whitelist.filter_pages(page_meta(spark, sf_dir), whitelist.judge_documents(doc_meta(spark, sf_dir)), strict)
    return whitelist.pages_by_shard(kept).select("annotated_shard_id", F.size("page_ids").cast("bigint").alias("n_pages"), F.array_join("page_ids", ",").alias("page_ids"))


@query("whitelist_pages", f"WITH {_P}, {_BLACK}, {_PAGES.format(strict='')}")
def whitelist_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whitelist_pages(spark, sf_dir, False)


@query("whitelist_pages_strict", f"WITH {_P}, {_BLACK}, {_PAGES.format(strict='AND NOT (num_heading_1 > 0 AND num_text + num_table = 0)')}")
def whitelist_pages_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whitelist_pages(spark, sf_dir, True)


@query("excluded_languages", f"WITH {_D} SELECT doc_id FROM doc_meta WHERE top_lang NOT IN ('__label__de', '__label__es')")
def excluded_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_meta(spark, sf_dir).where(~F.col("top_lang").isin("__label__de", "__label__es")).select("doc_id")


@query("quality_median", f"WITH {_D} SELECT round(median(quality), 6) AS median_quality FROM doc_meta")
def quality_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_meta(spark, sf_dir).agg(F.round(F.median("quality"), 6).alias("median_quality"))


@query("perplexity_p80_lang", f"WITH {_D} SELECT top_lang, round(quantile_cont(perplexity, 0.8), 6) AS threshold FROM doc_meta GROUP BY top_lang")
def perplexity_p80(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.perplexity_thresholds(doc_meta(spark, sf_dir)).withColumn("threshold", F.round("threshold", 6))


@query("perplexity_bucket", f"WITH {_D}, {_BLACK} SELECT coalesce(bucket, 'none') AS bucket, top_lang, count(*) AS n FROM judged GROUP BY 1, 2")
def perplexity_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = whitelist.judge_documents(doc_meta(spark, sf_dir))
    return d.groupBy(F.coalesce("bucket", F.lit("none")).alias("bucket"), "top_lang").agg(F.count("*").alias("n"))


@query("page_entity_sums", f"WITH {_P} SELECT page_id, CAST(num_heading_1 + num_text + num_table AS INT) AS n_entities FROM page_meta")
def page_entity_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_meta(spark, sf_dir).select("page_id", whitelist.row_sum(["num_heading_1", "num_text", "num_table"]).cast("int").alias("n_entities"))


@query("pages_of_documents", f"WITH {_P} SELECT p.page_id, d.top_lang, d.quality FROM page_meta p JOIN doc_meta d USING (url_hash)")
def pages_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.page_documents(page_meta(spark, sf_dir), doc_meta(spark, sf_dir)).select("page_id", "top_lang", "quality")


@query("page_number_parse", f"WITH {_P} SELECT page_id, CAST(list_last(string_split(page_id, '_p')) AS INT) AS page_number, replace(page_id, 'doc_', '') AS member FROM page_meta")
def page_number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sheafworks.functions import url as U

    return page_meta(spark, sf_dir).select("page_id", U.page_number(F.col("page_id")).alias("page_number"), U.member_id(F.concat(F.lit("x/"), F.col("page_id"))).alias("member"))


@query(
    "text_metrics",
    r"""WITH m AS (SELECT doc_id, text, len(list_filter(string_split_regex(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g'), '\s+'), lambda w: w <> '')) AS word_count,
      length(text) AS char_count, len(regexp_extract_all(text, '\p{L}')) AS alph_chars_count, len(regexp_extract_all(text, '\p{N}')) AS numeric_chars_count, len(regexp_extract_all(text, '[\p{L}\p{N}]')) AS alphnum_chars_count FROM documents)
    SELECT doc_id, word_count, char_count, alph_chars_count, numeric_chars_count, alphnum_chars_count, round(CASE WHEN char_count = 0 THEN 0 ELSE alphnum_chars_count / char_count END, 6) AS alnum_prop,
      round(CASE WHEN numeric_chars_count = 0 THEN 0 ELSE alph_chars_count / numeric_chars_count END, 6) AS alph_to_num_ratio FROM m""",
)
def text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_spread(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in X.metrics(F.col("text")).items()])
    return d.withColumn("alnum_prop", F.round("alnum_prop", 6)).withColumn("alph_to_num_ratio", F.round("alph_to_num_ratio", 6))


_SIGNS = "，。、„”“«»１」「《》´∶：？！（）；–～’━〈〉【】％►—．…"
_PLAIN = [",", ".", ",", *['"'] * 10, "'", ":", ":", "?", "!", "(", ")", ";", "-", "~", "'", "-", "<", ">", "[", "]", "%", "-", " - ", ". ", "..."]
_REPLACED = "t"
for _a, _b in zip(_SIGNS, _PLAIN):
    _REPLACED = f"replace({_REPLACED}, '{_a}', '{_b.replace(chr(39), chr(39) * 2)}')"


@query("normalize_text", rf"""WITH s AS (SELECT doc_id, concat(text, ' ', '{_SIGNS}'[(doc_id % {len(_SIGNS)} + 1)::INT], 'x', '{_SIGNS}'[(doc_id * 7 % {len(_SIGNS)} + 1)::INT], chr(5), 'É3') AS text FROM documents),
  t AS (SELECT doc_id, regexp_replace(strip_accents(lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))), '\p{{Nd}}', '0', 'g') AS t FROM s)
  SELECT doc_id, sha256(regexp_replace({_REPLACED}, '[\x00-\x1f\x7f-\x9f]', '', 'g')) AS digest FROM t""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with two of the signs that are replaced, by turns all of them, a control character and an accent at their ends."""
    sign = lambda k: F.substring(F.lit(_SIGNS), (k % len(_SIGNS) + 1).cast("int"), F.lit(1))
    text = F.concat("text", F.lit(" "), sign(F.col("doc_id")), F.lit("x"), sign(F.col("doc_id") * 7), F.lit("\x05É3"))
    return read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.normalised(text), 256).alias("digest"))


@query("lang_clean", r"SELECT doc_id, array_to_string(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> ''), ' ') AS cleaned FROM documents")
def lang_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", X.squeezed(F.col("text")).alias("cleaned"))


@query("top_lang_map", """WITH s AS (SELECT doc_id, [(doc_id * 7) % 10, (doc_id * 3) % 10, (doc_id * 5 + n_chars) % 10] AS v FROM documents)
  SELECT doc_id, CASE WHEN v[1] >= v[2] AND v[1] >= v[3] THEN 'en' WHEN v[2] >= v[3] THEN 'fr' ELSE 'de' END AS top_lang, greatest(v[1], v[2], v[3]) / 10.0 AS top_lang_score FROM s""")
def top_lang_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    m = F.create_map(*[x for k, e in (("__label__en", "doc_id * 7"), ("__label__fr", "doc_id * 3"), ("__label__de", "doc_id * 5 + n_chars")) for x in (F.lit(k), F.expr(f"cast(({e}) % 10 as double) / 10"))])
    top = X.top_label(m)
    return d.select("doc_id", X.language_code(top["label"]).alias("top_lang"), top["score"].alias("top_lang_score"))


@query("min_text_filter", "SELECT doc_id FROM documents WHERE length(text) >= 200")
def min_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").where(F.length("text") >= 200).select("doc_id")


@query("exact_dedup_first", "SELECT min(doc_id) AS doc_id, sha256(text) AS bytehash FROM documents GROUP BY text")
def exact_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("bytehash"))
    return urls.keep_first(d, ["bytehash"], ["doc_id"])


@query("exact_dedup_keep_last", "SELECT max(doc_id) AS doc_id, sha256(text) AS bytehash FROM documents GROUP BY text")
def exact_dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("bytehash"))
    return urls.keep_last(d, ["bytehash"], ["doc_id"])


@query("distinct_rows", "SELECT DISTINCT lang, source FROM documents")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("checksums", f"WITH {_D} SELECT url_hash, sha256(text) AS bytehash FROM documents JOIN doc_meta USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM labels)")
def checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("url_hash"), F.encode("text", "UTF-8").alias("content"))
    ids = read_table(spark, sf_dir, "labels").select(F.sha2(F.col("doc_id").cast("string"), 256).alias("url_hash"))
    return whitelist.checksums(members, ids)


@query("perplexity_lines", """WITH l AS (SELECT conv_id, -CAST((length(text) * 7 + turn * 13) % 500 AS DOUBLE) / 10 AS lp, length(text) % 50 AS n FROM conversations)
  SELECT conv_id, round(pow(10.0, -sum(lp) / sum(n + 1)), 6) AS perplexity FROM l GROUP BY conv_id""")
def perplexity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "conversations").select("conv_id", F.expr("-cast((length(text) * 7 + turn * 13) % 500 as double) / 10").alias("log10_prob"), (F.length("text") % 50).alias("n_tokens"))
    return quality.perplexity(lines, "conv_id").withColumn("perplexity", F.round("perplexity", 6))


@query("perplexity_update", f"WITH {_D} SELECT doc_id, CASE WHEN replace(top_lang, '__label__', '') = 'fr' THEN CAST(n_chars AS DOUBLE) ELSE perplexity END AS perplexity FROM doc_meta")
def perplexity_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_meta(spark, sf_dir).select("doc_id", quality.update_perplexity(F.col("top_lang"), "fr", F.col("n_chars").cast("double"), F.col("perplexity")).alias("perplexity"))


@query("conversation_rollup", "SELECT conv_id, count(*) AS n_turns, sum(length(text))::BIGINT AS n_chars, count(DISTINCT role) AS n_roles FROM conversations GROUP BY conv_id")
def conversation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sum(F.length("text").cast("bigint")).alias("n_chars"), F.count_distinct("role").alias("n_roles"))


@query("union_all_sources", "SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark")
def union_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read_table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    return a.unionByName(read_table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"), "text"))


@query("fill_source_columns", f"WITH {_D} SELECT d.doc_id, p.url, CASE WHEN p.url IS NULL THEN NULL ELSE concat('doc_', d.url_hash, '.docx') END AS filename FROM doc_meta d LEFT JOIN pages p ON p.page_id = d.doc_id")
def fill_source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.sha2(F.col("page_id").cast("string"), 256)
    sources = read_table(spark, sf_dir, "pages").select(key.alias("url_hash"), "url", F.concat(F.lit("doc_"), key, F.lit(".docx")).alias("filename"))
    return whitelist.fill_sources(doc_meta(spark, sf_dir), sources).select("doc_id", "url", "filename")
