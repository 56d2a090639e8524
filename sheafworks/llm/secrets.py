"""Secret scans: guess-cost dynamic programming over values in credential context.

A value counts as in credential context when it follows a credential word of English, German, French or
Spanish (``password = …``, ``token: "…"``, ``mot de passe : …``, ``Bearer …``), sits in the user part of a URL, or carries an issuer's prefix
(``AKIA…``, ``ghp_…``). Each such value is segmented at least total cost into dictionary words,
dates, repeats, keyboard walks or sequences, and brute-force spans; the cost is log10 of the guesses.
Values that cost at least ``min_log10_guesses`` are secrets, cheaper ones are placeholders or prose.

After an opening quote a value goes up to the matching quote on the line, else up to white space, without
trailing stops, commas, colons, brackets and quotes. After ``is``, ``ist``, ``est`` and ``es`` in place of a sign, values without quotes
count only if they hold a digit, a sign or a capital after a small letter: ``the password is lost`` is prose.

Defined results: null and empty texts give no finding and stay as they are; a null id is kept as null;
repeated rows give their findings once each; findings in a text don't overlap (leftmost, longest); texts of
any length are scanned whole, and the segmentation takes time in proportion to the value's length.
Only ``id_col`` and ``text_col`` of the input are read, so further columns can have any name.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafworks.session import read_table

#: Word list with ranks (a public tokenizer's whole-word entries). The file must be on every worker: verdicts don't depend on
#: where a task runs. ``None`` in its place takes the short list below alone.
WORDS_PATH = "/opt/tokenizers/word_bpe_49k.json"
MIN_LOG10_GUESSES = 6.0
SEGMENT_LOG10 = 0.6  # what another segment adds: the guesser must also find the order of segment kinds

_WORDS = r"pass(?:word|wd|phrase|code)?|pwd|secret(?:[_-]?key)?|(?:api|access|auth|secret|private|client|account)[_-]?(?:key|token|secret|id)|token|credentials?"
#: German, French and Spanish; letters with marks also as letter and combining mark.
_FOREIGN = "|".join((
    r"zugangs(?:code|schl(?:ü|u\u0308|ue)ssel|token)|(?:api|geheim|privat|zugriffs)[ _-]?schl(?:ü|u\u0308|ue)ssel|geheimnis|zugangsdaten",
    r"mots?[ _-]de[ _-]passe|motdepasse|mdp|jeton|cl(?:é|e\u0301)s?[ _-](?:secr(?:è|e\u0300|e)te|priv(?:é|e\u0301|e)e|(?:d['’])?(?:api|acc(?:è|e\u0300|e)s))|cle[_-](?:secrete|privee|api|acces)|identifiants",
    r"contrase(?:ñ|n\u0303|n)as?|clave[ _-](?:secreta|privada|api|de[ _-](?:api|acceso))|secreto|credencial(?:es)?",
))
_PREFIXES = r"AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z_-]{20,}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}"
_GAP = r"[ \t\u00a0\u202f]"
#: Values in quotes, for each kind of quote; a backslash keeps the next character from closing them.
_PAIRS = {"double": ('"', '"'), "single": ("'", "'"), "tick": ("`", "`"), "angle": ("«", "»"), "high": ("“", "”"), "low": ("„", "“”")}
_QUOTED = "|".join(rf"{a}(?P<kv_{k}>(?:[^{b}\\\r\n]|\\[^\r\n]){{4,}})[{b}]" for k, (a, b) in _PAIRS.items())
#: Before a value without quotes: nothing, or a quote that the line doesn't close.
_OPEN = "".join(rf"(?!{a}[^{b}\r\n]*[{b}])" for a, b in _PAIRS.values()) + r"[\"'`«“„]?(?![\"'`«“„])"
_BARE = r"\S{3,}[^\s.,;:)\]}>\"'`»”“]"
_ODD = r"\S*(?:[0-9]|[a-z][A-Z]|[^\w\s.,;:!?()\[\]{}<>\"'’`»”“…–—-])"
CONTEXT = (
    rf"(?:(?<![A-Za-z0-9])(?i:{_WORDS}|{_FOREIGN})|(?i:passw(?:ort|örter|o\u0308rter)|kennwort))[\"']?(?:{_GAP}{{0,8}}(?:(?i:{_GAP}(?:is|ist|est|es)){_GAP}{{0,8}})?(?::=|=>|=|:){_GAP}{{0,8}}(?:{_QUOTED}|{_OPEN}(?P<kv>{_BARE}))"
    rf"|{_GAP}{{1,8}}(?i:is|ist|est|es){_GAP}{{1,8}}(?:{_QUOTED.replace('<kv_', '<kv_is_')}|{_OPEN}(?={_ODD})(?P<kv_is>{_BARE})))"
    rf"|(?<![A-Za-z0-9])(?i:bearer)[ \t]{{1,8}}(?P<bearer>[A-Za-z0-9._~+/=-]{{8,}})"
    rf"|(?<![A-Za-z0-9])[A-Za-z][A-Za-z0-9+.-]{{1,15}}://[^\s/:@\"']{{1,64}}:(?P<url>[^\s/:@\"']{{4,}})@"
    rf"|(?<![A-Za-z0-9])(?P<prefixed>{_PREFIXES})"
)
#: Cheap first look in the JVM, at the lower-cased text: every match of CONTEXT contains one of these. Plain substrings, which
#: the engine finds several times as fast as alternatives of a regular expression.
HINTS = ("pass", "pwd", "secret", "key", "token", "credential", "_id", "-id", "accountid", "apiid", "accessid", "authid", "privateid", "clientid", "kennwort", "schlüssel", "schlu\u0308ssel", "schluessel", "geheim", "zugang", "mdp", "jeton", "clé", "cle\u0301", "cle_", "cle-", "identifiants", "contrase", "clave", "credencial", "bearer", "://", "akia", "asia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "aiza")
_RE = re.compile(CONTEXT)

COMMON = "password 123456 12345678 qwerty letmein admin welcome changeme secret example default master monkey dragon login guest test user root abc123 iloveyou passw0rd hello sample dummy placeholder null none undefined redacted true false yourpassword token value here your my the key string text foo bar baz xxxx todo".split()
_LEET = str.maketrans("013457@$!8", "oieastasib")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d{2}(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d{2}|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d{2}")
#: A unit is costed by brute force, so repeats of units over 12 characters cost 10^12 guesses or more and can't change a verdict.
_REPEAT = re.compile(r"(.{1,12}?)\1+", re.S)


def _neighbours() -> dict[str, str]:
    at = {c: (r, k) for r, row in enumerate(_ROWS) for k, c in enumerate(row)}
    return {c: "".join(d for d, (r2, k2) in at.items() if d != c and abs(r - r2) <= 1 and k2 - k in ((-1, 0, 1) if r == r2 else (0, 1) if r2 < r else (-1, 0))) for c, (r, k) in at.items()}


_NEAR = _neighbours()


class Words(dict):
    """Lower-case word → log10 of its rank; ``longest`` is the length of the longest."""

    longest = 0


@functools.lru_cache(maxsize=4)
def dictionary(path: str | None = WORDS_PATH) -> Words:
    ranks = Words({w: math.log10(k + 2) for k, w in enumerate(COMMON)})
    if path:
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        words = sorted((i, w[:-4]) for w, i in vocab.items() if w.endswith("</w>") and len(w) > 6 and w[:-4].isalpha())
        for k, (_, w) in enumerate(words):
            ranks.setdefault(w, math.log10(len(COMMON) + k + 2))
    ranks.longest = max(map(len, ranks))
    return ranks


def _cardinality(value: str) -> int:
    n = 0
    for test, size in ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26)):
        n += size * any(test(c) and c.isascii() for c in value)
    n += 33 * any(c.isascii() and not c.isalnum() for c in value)
    n += 100 * any(not c.isascii() for c in value)
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        n = 10 if value.isdigit() else 16
    return max(n, 2)


def matches(value: str, words: dict[str, float]) -> Iterator[tuple[int, int, str, float]]:
    """Spans (start, end, kind, log10 guesses) other than brute force."""
    low, n = value.lower(), len(value)
    if len(low) != n:  # a few letters change length with case
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain, longest = low.translate(_LEET), getattr(words, "longest", None) or max(map(len, words), default=0)
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            w, extra = low[i:j], 0.0
            if w not in words:
                w, extra = plain[i:j], math.log10(4)
            if w in words:
                part = value[i:j]
                case = 0.0 if part.islower() or not part.isalpha() else math.log10(2) if part.istitle() or part.isupper() else 0.3 * sum(c.isupper() for c in part)
                yield i, j, "word", words[w] + case + (extra if w != low[i:j] else 0)
    for i in range(n):
        if m := _DATE.match(value, i):
            yield i, m.end(), "date", math.log10(365.0) + 2 if m.end() - i > 4 else 2.0
    i = 0
    while m := _REPEAT.search(value, i):
        base, times = m.group(1), (m.end() - m.start()) // len(m.group(1))
        if m.end() - m.start() >= 3:
            yield m.start(), m.end(), "repeat", len(base) * math.log10(_cardinality(base)) + math.log10(times + 1)
        i = m.start() + 1 if m.end() - m.start() < 3 else m.end() - len(base) + 1 if len(base) > 1 else m.end()
    for kind, joined in (("walk", lambda a, b: b in _NEAR.get(a, "")), ("sequence", lambda a, b: abs(ord(a) - ord(b)) == 1 and a.isalnum() and b.isalnum())):
        i = 0
        while i < n - 1:
            j = i
            while j + 1 < n and joined(low[j], low[j + 1]):
                j += 1
            if j - i >= 2:
                turns = sum(low[k] != low[k + 1] for k in range(i, j)) if kind == "walk" else 0
                yield i, j + 1, kind, math.log10(47.0) + (turns * math.log10(4.6) * 0.5 if kind == "walk" else math.log10(2) + math.log10(j - i + 1))
            i = max(j, i + 1)


def guess_cost(value: str, words: dict[str, float] | None = None) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses under the cheapest segmentation, and that segmentation.

    ``best[j]`` is the least cost of the first j characters; ``run[j]`` the least that ends inside a brute-force
    span, so a span of any length is extended a character at a time and the whole takes linear time.
    """
    words = dictionary() if words is None else words
    n = len(value)
    if not n:
        return 0.0, []
    per_char = math.log10(_cardinality(value))
    ending: list[list[tuple[int, str, float]]] = [[] for _ in range(n + 1)]
    for i, j, kind, cost in matches(value, words):
        ending[j].append((i, kind, cost))
    best = [0.0] + [math.inf] * n
    run = [math.inf] * (n + 1)
    run_from, back = [0] * (n + 1), [(0, "")] * (n + 1)
    for j in range(1, n + 1):
        fresh, longer = best[j - 1] + SEGMENT_LOG10 + per_char, run[j - 1] + per_char
        run[j], run_from[j] = (longer, run_from[j - 1]) if longer <= fresh else (fresh, j - 1)
        best[j], back[j] = run[j], (run_from[j], "brute")
        for i, kind, cost in ending[j]:
            if (c := best[i] + SEGMENT_LOG10 + cost) < best[j]:
                best[j], back[j] = c, (i, kind)
    out, j = [], n
    while j:
        i, kind = back[j]
        out.append((i, j, kind))
        j = i
    return best[n] - SEGMENT_LOG10, out[::-1]


def find(text: str | None, min_log10_guesses: float = MIN_LOG10_GUESSES, words: dict[str, float] | None = None) -> list[dict]:
    """All credential-context values of a text, with their verdicts."""
    out = []
    for m in _RE.finditer(text or ""):
        value, start = m.group(m.lastgroup), m.start(m.lastgroup)
        cost, parts = guess_cost(value, words)
        out.append({"kind": m.lastgroup.split("_")[0], "start": start, "end": start + len(value), "log10_guesses": round(cost, 4), "parts": "+".join(p[2] for p in parts), "is_secret": cost >= min_log10_guesses})
    return out


def redact(text: str, min_log10_guesses: float = MIN_LOG10_GUESSES, mask: str = "[SECRET]") -> str:
    for f in reversed(find(text, min_log10_guesses)):
        if f["is_secret"]:
            text = text[: f["start"]] + mask + text[f["end"] :]
    return text


_FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("log10_guesses", T.DoubleType()), T.StructField("parts", T.StringType()), T.StructField("is_secret", T.BooleanType())]))


def _hinted(text: Column) -> Column:
    # inside the lambda the lower-cased text is a variable; written out, it would be made again for every hint
    return F.exists(F.array(F.lower(text)), lambda low: functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(h)) for h in HINTS]))


def _suspect(text: Column) -> Column:
    """The text where it may hold a credential, else null: only these cross to Python."""
    return F.when(_hinted(text), text)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_log10_guesses: float = MIN_LOG10_GUESSES) -> DataFrame:
    """A row for each credential-context value: id, kind, character span, log10 guesses, segmentation, verdict."""

    @F.pandas_udf(_FOUND)
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: find(t, min_log10_guesses))

    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(_hinted(F.col("text")))
    d = d.select("doc_id", F.explode(found("text")).alias("f"))
    return d.select("doc_id", F.col("f.kind").alias("kind"), F.col("f.start").alias("start"), F.col("f.end").alias("end"), F.col("f.log10_guesses").alias("log10_guesses"), F.col("f.parts").alias("parts"), F.col("f.is_secret").alias("is_secret"))


def mask_secrets(df: DataFrame, text_col: str = "text", min_log10_guesses: float = MIN_LOG10_GUESSES) -> DataFrame:
    """The same rows and columns with every secret replaced by ``[SECRET]``; ``n_chars`` follows if there is one."""

    @F.pandas_udf(T.StringType())
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, min_log10_guesses) if t is not None else None)

    text = F.coalesce(masked(_suspect(F.col(text_col))), F.col(text_col))
    out = df.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
    if "n_chars" in df.columns and text_col == "text":
        n = F.length("text").cast(df.schema["n_chars"].dataType)
        out = out.select(*[F.when(F.col("text").isNotNull(), n).otherwise(F.col("n_chars")).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in df.columns])
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
