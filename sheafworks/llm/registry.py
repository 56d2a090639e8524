"""The subpackage's queries, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from sheafworks.llm import exact_dedup, hnsw, html_blocks, jaccard_join, langid, packing, secrets, sp_wfst, warc, word_lm

QUERIES = {
    "op1_ann_search": hnsw.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_best_fit_packing": packing.query,
    "op4_html_extraction": html_blocks.query,
    "op5_secret_scan": secrets.query,
    "op6_lm_scoring": word_lm.query,
    "op7_arc_to_warc": warc.query,
    "op8_sentencepiece": sp_wfst.query,
    "op9_language_id": langid.query,
    "op10_ngram_jaccard_join": jaccard_join.query,
}
ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op10_ngram_jaccard_join": jaccard_join.SQL,
}
