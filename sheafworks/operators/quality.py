"""Entity counts, annotation quality, sources of annotations, perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafworks import schemas as S

BUILTIN = ("builtin", "xml_pattern")
HEURISTIC = ("content_aware_heuristic", "body_heading_heuristic_usingbuiltin", "body_heading_heuristic_base")
SOURCES = (*BUILTIN, *HEURISTIC, "text_builtin", "text_fallback")


def entity_counts(entities: DataFrame, keys: list[str], category: str = "category") -> DataFrame:
    """A column ``num_<name>`` for each of the 31 categories; without a pivot's extra pass, as the names are known."""
    return entities.groupBy(*keys).agg(*[F.count_if(F.col(category) == k).cast("int").alias(f"num_{n}") for k, n in enumerate(S.ENTITY_NAMES)])


def sum_counts(pages: DataFrame, key: str) -> DataFrame:
    return pages.groupBy(key).agg(*[F.sum(f"num_{n}").cast("int").alias(f"num_{n}") for n in S.ENTITY_NAMES])


def builtin_proportions(decisions: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, category, builtin share of the characters); a decision without text counts as one character."""
    n = F.coalesce(F.length("text"), F.lit(1)).cast("double")
    is_builtin = F.col("source").isin(*BUILTIN)
    return decisions.groupBy(doc, F.col("entity_id").alias("category")).agg(F.coalesce(F.try_divide(F.sum(F.when(is_builtin, n).otherwise(0.0)), F.sum(n)), F.lit(0.0)).alias("proportion"))


def quality_score(counts: DataFrame, proportions: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Σ count · builtin share over the categories that count, by Σ count over all; 0 for a document without entities.

    ``counts`` is (doc, category, n).
    """
    j = counts.join(proportions, [doc, "category"], "left")
    kept = ~F.col("category").isin(*S.IGNORED_IN_QUALITY)
    total = F.sum(F.when(kept, F.col("n") * F.coalesce("proportion", F.lit(0.0))).otherwise(0.0))
    return j.groupBy(doc).agg(F.coalesce(F.try_divide(total, F.sum("n")), F.lit(0.0)).alias("annotation_quality_score"))


def source_counts(decisions: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Characters by source, a column a source; a decision without text counts none. Running text has two sources of its
    own, builtin or not."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    running = F.col("entity_id") == S.ENTITY_IDS["text"]
    bucket = F.when(running & (F.col("source") == "builtin"), "text_builtin").when(running, "text_fallback").otherwise(F.col("source"))
    return decisions.withColumn("_b", bucket).groupBy(doc).agg(*[F.sum(F.when(F.col("_b") == s, n).otherwise(0)).alias(f"chars_{s}") for s in SOURCES])


def perplexity(lines: DataFrame, doc: str = "doc_id", log10_prob: str = "log10_prob", n_tokens: str = "n_tokens") -> DataFrame:
    """10 ** (-Σ log10 p / Σ (tokens + 1)) over a document's lines."""
    return lines.groupBy(doc).agg(F.pow(F.lit(10.0), -F.sum(log10_prob) / F.sum(F.col(n_tokens) + 1)).alias("perplexity"))


def update_perplexity(top_lang: Column, lang: str, new: Column, old: Column) -> Column:
    """The new value for documents of the language that was scored, else the one before."""
    return F.when(F.replace(top_lang, F.lit("__label__"), F.lit("")) == lang, new).otherwise(old)


def was_builtin_source(builtin: Column, overridden: Column, recommended: Column) -> Column:
    """A paragraph is builtin unless one of its runs was overridden."""
    return F.when(builtin & ~overridden, F.lit("builtin")).otherwise(recommended)
