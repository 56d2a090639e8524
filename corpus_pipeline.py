"""The document pipeline: what an ingested corpus goes through before training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last keep the columns of ``documents``; each works on all that its predecessor kept.

* language ID: documents whose language isn't identified with calibrated confidence go;
* exact dedup: of equal texts the one of lowest id stays;
* near dedup: of documents linked by a word-3-gram Jaccard similarity of at least 0.5 the one of lowest id stays;
* secret scan: secrets in credential context are masked, the documents stay;
* packing: segments of the documents are packed into training sequences of the permitted lengths.

Null texts are rejected by the first stage; an empty table gives no sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafworks.llm import exact_dedup, jaccard_join, langid, packing, secrets
from sheafworks.session import materialise, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: A trained classifier and a greedy packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
