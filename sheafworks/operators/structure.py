"""Document structure: styles, fonts, headings, content rules over paragraphs and runs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks import schemas as S

#: Style prefixes in order; the last that a style begins with decides.
STYLE_PREFIXES = (
    *[(p, "text") for p in ("body", "normal", "plain text", "no spacing", "default")],
    ("title", "title"),
    *[(f"heading {k}", f"heading_{k}") for k in range(1, 10)],
    *[(p, p) for p in ("header", "footer", "list", "toc", "bibliography", "quote")],
    ("intense quote", "quote"),
    ("caption", "table_caption"),
    ("footnote", "footnote"),
    ("annotation", "annotation"),
)
BULLETS = "-•➢◦▪▫●○■□▶⁃◆◇◐◑"
MAX_HEADING_CHARS = 150


def style_entity(style: Column) -> Column:
    """Entity id of a style's name; null for unknown styles."""
    s = F.lower(style)
    out = F.lit(None).cast("int")
    for prefix, name in STYLE_PREFIXES:
        out = F.when(s.startswith(prefix), S.ENTITY_IDS[name]).otherwise(out)
    return out


def content_entity(text: Column) -> Column:
    """Form, then quote, then list, by the text alone; null if none."""
    t = F.trim(text)
    first, last = F.substring(t, 1, 1), F.substring(t, -1, 1)
    quoted = (F.length(t) > 1) & (first == last) & first.isin('"', "'")
    listed = t.rlike(r"(?U)^(\d+|\w)(\.|:|\))") | F.contains(F.lit(BULLETS), first) & (first != "")
    return F.when(t.rlike("[_.…]{4,}"), S.ENTITY_IDS["form_field"]).when(quoted, S.ENTITY_IDS["quote"]).when(listed, S.ENTITY_IDS["list"])


def font_histogram(runs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, font, n_chars, n_paragraphs) of runs (doc, paragraph, font, text)."""
    return runs.groupBy(doc, "font").agg(F.sum(F.length("text")).cast("bigint").alias("n_chars"), F.count_distinct("paragraph").alias("n_paragraphs"))


def heading_levels(fonts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, font, level) from font sizes: the commonest font is body (-10); a largest font that appears once is the title
    (-20); larger ones get levels 1 to 9 from the largest on; all others are body.

    A font is ``size`` followed by b, i and n for bold, italic, plain; order is by size, then b, bi, i, n.
    """
    size = F.regexp_extract("font", r"^([0-9.]+)", 1).try_cast("double")
    style = F.regexp_extract("font", r"([a-z]*)$", 1)
    f = fonts.withColumn("_size", size).withColumn("_style", F.when(style == "b", 0).when(style == "bi", 1).when(style == "i", 2).otherwise(3))
    every = Window.partitionBy(doc)
    rank = Window.partitionBy(doc).orderBy(F.desc("_size"), "_style", "font")
    common = F.max_by("font", F.struct("n_chars", "_size", F.col("font"))).over(every)
    f = f.withColumn("_common", common).withColumn("_pos", F.row_number().over(rank))
    f = f.withColumn("_body_pos", F.max(F.when(F.col("font") == F.col("_common"), F.col("_pos"))).over(every))
    titled = F.max(((F.col("_pos") == 1) & (F.col("n_paragraphs") == 1) & (F.col("font") != F.col("_common"))).cast("int")).over(every)
    level = F.col("_pos") - titled
    is_title = (F.col("_pos") == 1) & (titled == 1)
    return f.withColumn("level", F.when(is_title, -20).when((F.col("_pos") >= F.col("_body_pos")) | (level > 9), -10).otherwise(level).cast("int")).select(doc, "font", "level")


def heading_levels_with_builtin(fonts: DataFrame, builtin: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Documents that style headings (``builtin``: doc, font, level) give those fonts their levels, the greatest where they
    disagree, and all others are body; the rest go by size."""
    known = builtin.groupBy(doc, "font").agg(F.max("level").alias("_level"))
    styled = known.select(doc).distinct()
    own = fonts.join(styled, doc, "left_semi").select(doc, "font").distinct().join(known, [doc, "font"], "left")
    own = own.select(doc, "font", F.coalesce("_level", F.lit(-10)).cast("int").alias("level"))
    return own.unionByName(heading_levels(fonts.join(styled, doc, "left_anti"), doc))


def split_affixes(text: Column, kind: Column) -> Column:
    """A quote or list paragraph as (text, label) parts that join to it again: its quotation marks or its bullet or number are
    ``mark``, the rest is the entity."""
    quote = F.array(F.struct(F.regexp_extract(text, r"(?s)^(\s*[\"'])", 1).alias("text"), F.lit("mark").alias("label")), F.struct(F.regexp_extract(text, r"(?s)^\s*[\"'](.*)[\"']\s*$", 1).alias("text"), F.lit("quote").alias("label")), F.struct(F.regexp_extract(text, r"(?s)^\s*[\"'].*?([\"']\s*)$", 1).alias("text"), F.lit("mark").alias("label")))
    head = rf"(?s)^(\s*(?:(?U:\d+|\w)[.:)]|[{BULLETS}])\s*)"
    listed = F.array(F.struct(F.regexp_extract(text, head, 1).alias("text"), F.lit("mark").alias("label")), F.struct(F.regexp_replace(text, head, "").alias("text"), F.lit("list").alias("label")))
    plain = F.array(F.struct(text.alias("text"), F.lit("text").alias("label")))
    parts = F.when(kind == S.ENTITY_IDS["quote"], quote).when(kind == S.ENTITY_IDS["list"], listed).otherwise(plain)
    return F.filter(parts, lambda p: p["text"] != "")


def resolve_fonts(styles: DataFrame) -> DataFrame:
    """(style, font) with what a style lacks taken from the nearest ancestor that has it, however far: a recursive query over
    (style, base, font). Where bases lead in a circle without a font, there is none."""
    return styles.sparkSession.sql(
        """
        WITH RECURSIVE up(style, base, font, depth, seen) MAX RECURSION LEVEL 10000 AS (
            SELECT style, base, font, 0, array(style) FROM {styles}
            UNION ALL
            SELECT u.style, s.base, s.font, u.depth + 1, array_append(u.seen, s.style) FROM up u JOIN {styles} s ON u.base = s.style
            WHERE u.font IS NULL AND NOT array_contains(u.seen, s.style)
        )
        SELECT style, min_by(font, depth) FILTER (WHERE font IS NOT NULL) AS font FROM up GROUP BY style""",
        styles=styles,
    )


def vote(runs: DataFrame, levels: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Entity of each run (doc, paragraph, run, font, text): a heading only as the paragraph's first runs and up to
    MAX_HEADING_CHARS characters, white space takes the paragraph's main entity, the rest is text."""
    r = runs.join(levels, [doc, "font"], "left")
    par = Window.partitionBy(doc, "paragraph")
    order = par.orderBy("run")
    is_head = F.coalesce((F.col("level") > 0) | (F.col("level") == -20), F.lit(False))
    prefix = F.min(is_head.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1
    short = F.sum(F.when(is_head, F.length("text")).otherwise(0)).over(par) <= MAX_HEADING_CHARS
    entity = F.when(prefix & short & (F.col("level") == -20), S.ENTITY_IDS["title"]).when(prefix & short, F.col("level")).otherwise(S.ENTITY_IDS["text"])
    r = r.withColumn("_e", entity)
    main = F.max_by("_e", F.struct(F.length(F.trim("text")), -F.col("run"))).over(par)
    return r.withColumn("entity_id", F.when(F.trim("text") == "", main).otherwise(F.col("_e")).cast("int")).select(doc, "paragraph", "run", "text", "entity_id")


_SEGMENTS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())]))
_FORM = re.compile(r"([_.…]{4,})")


def split_form(text: str | None) -> list[tuple[str, str]]:
    """Labels and blanks of a form line; the parts join to the text again."""
    if not text:
        return []
    return [(p, "form_field" if _FORM.fullmatch(p) else "form_tag") for p in _FORM.split(text) if p]


def form_segments(text: Column) -> Column:
    """``split_form`` in the JVM: the text is cut at the blanks by a mark that it can't hold."""
    cut = F.split(F.regexp_replace(text, r"([_.…]{4,})", "\u0000$1\u0000"), "\u0000")
    return F.transform(F.filter(cut, lambda p: p != ""), lambda p: F.struct(p.alias("text"), F.when(p.rlike(r"^[_.…]{4,}$"), "form_field").otherwise("form_tag").alias("label")))
