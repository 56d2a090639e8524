"""Text expressions: metrics, normalisation, labels."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUNCT = r"[!-/:-@\[-`{-~]"
UNKNOWN = "__label__unknown"

#: One-to-one punctuation, as the two strings of ``translate``.
_FROM = '，。、„”“«»１」「《》´∶：？！（）；–～’━〈〉【】％►'
_TO = ',.,""""""""""\'::?!();-~\'-<>[]%-'
_WIDE = (("—", " - "), ("．", ". "), ("…", "..."))


@functools.lru_cache(maxsize=1)
def _numeral_letters() -> str:
    """Letters that have a numeric value (CJK numerals)."""
    return "".join(c for c in map(chr, range(0x3400, 0x30000)) if c.isnumeric() and unicodedata.category(c)[0] != "N")


def words(text: Column) -> Column:
    """Without ASCII punctuation, in lower case, split at Unicode white space."""
    plain = F.lower(F.regexp_replace(text, PUNCT, ""))
    return F.filter(F.split(plain, r"(?U)\s+"), lambda w: w != "")


def metrics(text: Column) -> dict[str, Column]:
    # runs are taken out, so the pattern matches once a word and not once a character
    rest = F.regexp_replace(text, r"\p{L}+", "")
    chars = F.length(text)
    letters = chars - F.length(rest)
    digits = F.length(rest) - F.length(F.regexp_replace(rest, r"\p{N}+", ""))
    # a class of so many single letters is compared with one by one, at every character; these are looked up, and only where they can be
    wide = F.regexp_replace(text, r"[^\x{3400}-\x{2FFFF}]+", "")
    numbers = digits + F.length(wide) - F.length(F.translate(wide, _numeral_letters(), ""))
    both = letters + digits
    n_words = F.regexp_count(F.regexp_replace(text, PUNCT, ""), F.lit(r"(?U)\S+"))
    return {
        "word_count": n_words.cast("bigint"),
        "char_count": chars.cast("bigint"),
        "alph_chars_count": letters.cast("bigint"),
        "numeric_chars_count": numbers.cast("bigint"),
        "alphnum_chars_count": both.cast("bigint"),
        "alnum_prop": F.coalesce(F.try_divide(both, chars), F.lit(0.0)),
        "alph_to_num_ratio": F.coalesce(F.try_divide(letters, numbers), F.lit(0.0)),
    }


def squeezed(text: Column) -> Column:
    """Lower case, white-space runs as one space, none at the ends."""
    return F.array_join(F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != ""), " ")


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    """Canonical decomposition without non-spacing marks; plain ASCII passes through."""
    return texts.map(lambda t: t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn"))


def normalised(text: Column) -> Column:
    """What the language model reads: stripped, lower case, no accents, digits as 0, plain punctuation, no control characters."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")
    t = F.regexp_replace(strip_accents(F.lower(t)), r"(?U)\d", "0")
    t = F.translate(t, _FROM, _TO)
    for wide, plain in _WIDE:
        t = F.replace(t, F.lit(wide), F.lit(plain))
    return F.regexp_replace(t, r"[\x00-\x1f\x7f-\x9f]", "")


def top_label(scores: Column) -> Column:
    """(label, score) of a map's greatest score, the first one on a tie."""
    entries = F.map_entries(scores)
    placed = F.transform(entries, lambda e, i: F.struct((-e["value"]).alias("s"), i.alias("i"), e["key"].alias("label"), e["value"].alias("score")))
    first = F.get(F.array_sort(placed), F.lit(0))
    return F.struct(first["label"].alias("label"), first["score"].alias("score"))


def language_code(label: Column) -> Column:
    return F.replace(label, F.lit("__label__"), F.lit(""))


def short_number(x: Column) -> Column:
    """The first 10 characters of the shortest decimal form that reads back as x (for 0 and from 1e-4 up to 1e16)."""
    plain = F.regexp_replace(F.format_string("%s", x.cast("decimal(38,18)")), "0+$", "")
    text = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    direct = x.cast("string")
    return F.substring(F.when(direct.contains("E"), text).otherwise(direct), 1, 10)
