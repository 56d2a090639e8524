"""Queries over document structure: styles, content rules, fonts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks.operators import structure
from sheafworks.plans.base import query
from sheafworks.session import read_table

_STYLES = ("Heading 1", "heading 10 x", "Title Page", "Normal", "List Bullet", "Intense Quote", "Caption", "My Own", "Footnote Text")


@query("style_entities", "SELECT event_id, [1, 1, 0, 10, 11, 20, 23, NULL, 24][event_id % 9 + 1] AS entity_id FROM events")
def style_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    style = F.element_at(F.array(*map(F.lit, _STYLES)), (F.col("event_id") % 9 + 1).cast("int"))
    return read_table(spark, sf_dir, "events").select("event_id", structure.style_entity(style).alias("entity_id"))


_LINES = "SELECT conv_id, turn, CASE (conv_id + turn) % 6 WHEN 0 THEN concat('Name: ____', text) WHEN 1 THEN concat('\"', text, '\"') WHEN 2 THEN concat('1) ', text) WHEN 3 THEN concat('• ', text) WHEN 4 THEN concat('a. ', text) ELSE text END AS line FROM conversations"


@query("content_entities", rf"""WITH l AS ({_LINES}), t AS (SELECT *, trim(line) AS s FROM l) SELECT conv_id, turn, CASE WHEN regexp_matches(s, '[_.…]{{4,}}') THEN 26 WHEN length(s) > 1 AND s[1] = s[length(s)] AND s[1] IN ('"', '''') THEN 20
  WHEN regexp_matches(s, '^([0-9]+|[\p{{L}}0-9_])(\.|:|\))') OR (s <> '' AND contains('{structure.BULLETS}', s[1])) THEN 11 END AS entity_id FROM t""")
def content_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_LINES.replace("FROM conversations", "FROM {c}"), c=read_table(spark, sf_dir, "conversations"))
    return lines.select("conv_id", "turn", structure.content_entity(F.col("line")).alias("entity_id"))


_FONT = "concat(['24.0', '16.0', '12.0', '12.0'][turn % 4 + 1], CASE WHEN turn % 2 = 0 THEN 'b' ELSE 'n' END)"
_HIST = f"SELECT conv_id AS doc_id, {_FONT} AS font, sum(length(text))::BIGINT AS n_chars, count(DISTINCT turn // 2) AS n_paragraphs FROM conversations GROUP BY 1, 2"
_LEVELS = f"""f AS ({_HIST}), g AS (SELECT *, CAST(regexp_extract(font, '^([0-9.]+)', 1) AS DOUBLE) AS size, CASE regexp_extract(font, '([a-z]*)$', 1) WHEN 'b' THEN 0 WHEN 'bi' THEN 1 WHEN 'i' THEN 2 ELSE 3 END AS style FROM f),
  r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, style, font) AS pos, first_value(font) OVER (PARTITION BY doc_id ORDER BY n_chars DESC, size DESC, font DESC) AS common FROM g),
  t AS (SELECT *, max(CASE WHEN font = common THEN pos END) OVER (PARTITION BY doc_id) AS body_pos, max(CASE WHEN pos = 1 AND n_paragraphs = 1 AND font <> common THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS titled FROM r),
  levels AS (SELECT doc_id, font, CAST(CASE WHEN pos = 1 AND titled = 1 THEN -20 WHEN pos >= body_pos OR pos - titled > 9 THEN -10 ELSE pos - titled END AS INT) AS level FROM t)"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn")
    font = F.concat(F.element_at(F.array(*map(F.lit, ("24.0", "16.0", "12.0", "12.0"))), (k % 4 + 1).cast("int")), F.when(k % 2 == 0, "b").otherwise("n"))
    return read_table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.floor(k / 2).alias("paragraph"), F.col("turn").alias("run"), font.alias("font"), "text")


@query("font_histogram", _HIST)
def font_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.font_histogram(_runs(spark, sf_dir))


@query("heading_levels", f"WITH {_LEVELS} SELECT * FROM levels")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.heading_levels(structure.font_histogram(_runs(spark, sf_dir)))


@query("run_voting", f"""WITH {_LEVELS}, runs AS (SELECT conv_id AS doc_id, turn // 2 AS paragraph, turn AS run, {_FONT} AS font, text FROM conversations),
  h AS (SELECT r.*, l.level, coalesce(l.level > 0 OR l.level = -20, false) AS head FROM runs r LEFT JOIN levels l ON r.doc_id = l.doc_id AND r.font = l.font),
  p AS (SELECT *, min(head::INT) OVER (PARTITION BY doc_id, paragraph ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 AND sum(CASE WHEN head THEN length(text) ELSE 0 END) OVER (PARTITION BY doc_id, paragraph) <= 150 AS heads FROM h),
  e AS (SELECT *, CASE WHEN heads AND level = -20 THEN 0 WHEN heads THEN level ELSE 10 END AS e FROM p)
  SELECT doc_id, paragraph, run, text, CAST(CASE WHEN trim(text) = '' THEN first_value(e) OVER (PARTITION BY doc_id, paragraph ORDER BY length(trim(text)) DESC, run) ELSE e END AS INT) AS entity_id FROM e""")
def run_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _runs(spark, sf_dir)
    return structure.vote(runs, structure.heading_levels(structure.font_histogram(runs)))


@query("form_segments", rf"""WITH l AS ({_LINES}), p AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(line, '([_.…]{{4,}})', chr(1) || '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS parts FROM l)
  SELECT conv_id, turn, array_to_string(parts, '|') AS parts, array_to_string(list_transform(parts, lambda x: CASE WHEN regexp_full_match(x, '[_.…]{{4,}}') THEN 'form_field' ELSE 'form_tag' END), '|') AS labels FROM p""")
def form_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_LINES.replace("FROM conversations", "FROM {c}"), c=read_table(spark, sf_dir, "conversations"))
    s = structure.form_segments(F.col("line"))
    return lines.select("conv_id", "turn", F.array_join(F.transform(s, lambda x: x["text"]), "|").alias("parts"), F.array_join(F.transform(s, lambda x: x["label"]), "|").alias("labels"))


@query("affix_parts", rf"""WITH l AS ({_LINES}), k AS (SELECT *, (conv_id + turn) % 6 AS k FROM l WHERE (conv_id + turn) % 6 BETWEEN 1 AND 4)
  SELECT conv_id, turn, CASE k WHEN 1 THEN concat('"|', line[2:-2], '|"') WHEN 2 THEN concat('1) |', line[4:]) WHEN 3 THEN concat('• |', line[3:]) ELSE concat('a. |', line[4:]) END AS parts, CASE k WHEN 1 THEN 'mark|quote|mark' ELSE 'mark|list' END AS labels FROM k""")
def affix_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes and list items, cut into marks and content (texts here don't begin with white space)."""
    lines = spark.sql(_LINES.replace("FROM conversations", "FROM {c}"), c=read_table(spark, sf_dir, "conversations")).where("(conv_id + turn) % 6 BETWEEN 1 AND 4")
    kind = F.when((F.col("conv_id") + F.col("turn")) % 6 == 1, 20).otherwise(11)
    s = structure.split_affixes(F.col("line"), kind)
    return lines.select("conv_id", "turn", F.array_join(F.transform(s, lambda x: x["text"]), "|").alias("parts"), F.array_join(F.transform(s, lambda x: x["label"]), "|").alias("labels"))


@query("style_inheritance", """WITH RECURSIVE s AS (SELECT concat('s', n_nationkey::VARCHAR) AS style, CASE WHEN n_nationkey >= 5 THEN concat('s', (n_nationkey - 5)::VARCHAR) END AS base, CASE WHEN n_nationkey % 5 = 0 AND n_nationkey > 5 THEN NULL WHEN n_nationkey < 10 THEN concat('f', n_nationkey::VARCHAR) END AS font FROM nation),
  up AS (SELECT style, base, font, 0 AS depth FROM s UNION ALL SELECT u.style, s.base, s.font, u.depth + 1 FROM up u JOIN s ON u.base = s.style WHERE u.font IS NULL)
  SELECT style, min_by(font, depth) FILTER (font IS NOT NULL) AS font FROM up GROUP BY style""")
def style_inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    name = lambda c, p: F.concat(F.lit(p), c.cast("string"))
    n = read_table(spark, sf_dir, "nation")
    return structure.resolve_fonts(n.select(name(k, "s").alias("style"), F.when(k >= 5, name(k - 5, "s")).alias("base"), F.when((k % 5 == 0) & (k > 5), None).when(k < 10, name(k, "f")).alias("font")))
