"""Explicit schemas and small dimension tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY_NAMES = ["title", *[f"heading_{k}" for k in range(1, 10)], "text", "list", "header", "footer", "table_header", "table_header_cell", "table", "table_cell", "toc", "bibliography", "quote", "equation", "figure", "table_caption", "footnote", "annotation", "form_field", "form_tag", "table_row", "table_column", "table_header_row"]
ENTITY_IDS = {name: k for k, name in enumerate(ENTITY_NAMES)}
IGNORED_IN_QUALITY = [ENTITY_IDS[n] for n in ("table_row", "table_column", "table_cell")]
EMPTY_ALLOWED = [ENTITY_IDS[n] for n in ("table", "table_cell", "table_header", "table_header_cell", "table_row", "table_column", "table_header_row", "figure", "form_field")]
SIZE_FRACTION = {k: 5e-4 if n in ("form_field", "form_tag") else 1e-2 for k, n in enumerate(ENTITY_NAMES)}

_str = T.StringType()


_PLAIN = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "timestamp": T.TimestampType, "binary": T.BinaryType}


def _split(text: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[at:i].strip())
            at = i + 1
    return [*out, text[at:].strip()]


def _type(text: str) -> T.DataType:
    if text in _PLAIN:
        return _PLAIN[text]()
    kind, inner = text[:-1].split("<", 1)
    if kind == "array":
        return T.ArrayType(_type(inner))
    if kind == "map":
        return T.MapType(*map(_type, _split(inner)))
    return T.StructType([T.StructField(n, _type(t)) for n, t in (f.split(":", 1) for f in _split(inner))])


def _fields(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _type(t)) for n, t in (f.split(" ", 1) for f in _split(text))])


def _struct(text: str) -> T.StructType:
    """From `name type, …`, without a session: the types are those that the tables here use."""
    return _fields(text)


RAW_URLS = _struct("url string")
CLEAN_URLS = _struct("doc_id string, url string, url_hash string, source string")
SOURCE_FIELDS = "url url_hash crawl_id shard_id filename bytehash status_code content_type content_length content_encoding content_language last_modified source_filename olet_ftype olet_container olet_appname olet_codepage olet_encrypted olet_vba olet_xlm olet_ext_rels olet_ObjectPool olet_flash olet_python_codec olet_pass timestamp exception".split()
SOURCES = T.StructType([T.StructField(c, _str) for c in SOURCE_FIELDS])
BOX = _struct("x double, y double, width double, height double")
ENTITY = _struct("doc_id string, page_id string, page_num int, entity_category int, bbox struct<x:double,y:double,width:double,height:double>, id string, area double")
WORD = _struct("doc_id string, entity_ids array<string>, entity_categories array<int>, page_num int, bbox struct<x:double,y:double,width:double,height:double>, text string, upright boolean, direction int")
_COUNTS = ", ".join(f"num_{n} int" for n in ENTITY_NAMES)
DOC_META = _struct(f"url_hash string, crawl_id string, sources_shard_id string, annotated_shard_id string, num_pages int, sources_filename string, url string, filename string, word_count int, char_count int, alph_chars_count int, numeric_chars_count int, alphnum_chars_count int, alnum_prop double, alph_to_num_ratio double, languages_fasttext map<string,double>, languages_autocorrect array<string>, top_lang string, top_lang_score double, {_COUNTS}, annotation_quality_score double, builtin_proportion_per_entity map<int,double>, annotation_sources map<string,bigint>, template_name string, core_category string, core_comments string, core_content_status string, core_identifier string, core_keywords string, core_subject string, core_title string, core_version string, core_created timestamp, core_last_printed timestamp, core_modified timestamp, perplexity double")
PAGE_META = _struct(f"page_id string, url string, url_hash string, crawl_id string, sources_shard_id string, annotated_shard_id string, filename string, pdf_word_count int, languages_fasttext map<string,double>, top_lang string, top_lang_score double, page_height double, page_width double, page_number int, {_COUNTS}")
FAILED = _struct("annotator_id string, url_hash string, doc_fn string, exception string, msg string, sources_shard_id string")
DECISIONS = _struct("doc_id string, text string, source string, entity_id int")
LAYOUT_ROW = _struct("id string, tokens array<string>, word_bboxes array<array<bigint>>, entity_bboxes array<array<bigint>>, entity_labels array<int>, image struct<path:string,bytes:binary>")
COCO = _struct("images array<struct<id:bigint,file_name:string,width:int,height:int>>, annotations array<struct<image_id:bigint,category_id:int,bbox:array<double>>>, categories array<struct<name:string>>")
TABLE_LINE = _struct("split string, filename string, html struct<cells:array<struct<bbox:array<double>>>>, _corrupt_record string")
