"""HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one looks at each block alone: high link density is boilerplate;
short blocks stay open (``short``, or boilerplate if they hold links); long ones are good or near-good by stop-word
density. Pass two settles the open ones from the nearest decided neighbours: a short or near-good block takes the
label both sides share; between two different labels near-good blocks and those with a near-good neighbour side with
the good one. Headings before good text are kept.

Stop words are those of the language, of ``STOPWORDS``, that covers most of the page's longer blocks without links. Where it
covers less than ``FIT`` of their words no list fits, as in languages without a list or without spaces between words, and
density doesn't decide: long blocks are good or near-good by length, unless signs between words (``|``, bullets, arrows) make
them lists. Characters of scripts without spaces count twice.

Defined results: null HTML gives null text and no block; an empty page, or one without text, gives an empty text;
unclosed or stray tags are accepted, an unclosed script, style or comment runs to the page's end, other elements without text
of the page (``_SKIP``) are dropped with their content only if they are closed; pages of any length are read
whole; repeated rows get equal results; ties between languages go to the first of STOPWORDS. Ids may be null or of any type.
Only the id and HTML columns are read, so others may have any name.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheafworks.session import read_spread

LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.18  # for the short lists below, which cover about 40 % of running prose
FIT = 0.15  # share of words that a language's stop words cover at least, where its list fits
MAX_LINK_DENSITY = 0.2
MAX_SIGNS = 0.1  # signs that stand alone, a word, where no list fits
HEADING_REACH = 200

STOPWORDS = {
    "en": "the of and to in a is that it was for on are as with his they at be this have from or one had by but not what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than been its who now did get come made may part".split(),
    "fr": "le la les de des du un une et est en que qui dans pour pas sur au aux ce se son sa ses il elle ils elles on nous vous je tu ne plus par avec tout mais ou où comme si leur y été être avoir fait sont cette ces même aussi bien".split(),
    "de": "der die das und ist in den von zu mit sich des auf für nicht ein eine einen einem einer als auch es an werden aus er hat dass sie nach wird bei noch wie um am im über so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei ich".split(),
    "es": "el la los las de del que y a en un una es se no por con para su al lo como más o pero sus le ya este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante uno ni contra otros ese eso ante ellos e esto mí antes algunos qué unos yo otro".split(),
    "it": "il lo la i gli le un uno una di a da in con su per tra fra e è che non si del della dei delle dello degli al alla ai alle dal dalla nel nella nei nelle sul sulla come ma più anche sono ha ho era essere questo questa quello suo sua loro se ci molto dopo".split(),
    "pt": "o a os as um uma de do da dos das em no na nos nas por para com sem que e é não se ao aos à às pelo pela mais como mas foi ser são tem seu sua ou quando muito já está também só eu ele ela isso entre depois".split(),
    "nl": "de het een en van in is dat die te op aan met voor niet zijn er om ook als maar bij uit door naar dan nog wel over hij zij ze ik je we wordt worden werd was heeft hebben had kan meer geen dit deze tot".split(),
    "ro": "și de la în a cu pe nu că un o din pentru care este se mai ca au fost sau după prin dar este sunt lui ei lor al ale ai cel cea între până acest această".split(),
    "ca": "el la els les un una de del dels a al als en i que és no per amb es seu seva com més però són ha va aquest aquesta o si ja molt també entre".split(),
    "sv": "och i att det som en på är av för med den till inte har de ett om var men sig så från vi man hade jag kan han hon när eller nu ut där efter vid under också".split(),
    "da": "og i at det er en til på som for med den af de ikke et har der var han jeg fra men vi kan om sig så ved hun eller efter også blev over skal når ud".split(),
    "no": "og i det er på som en til å for med av at de ikke den har et om han var jeg fra men vi kan seg så ved hun eller etter også ble over skal når ut".split(),
    "fi": "ja on ei se että oli hän mutta ovat myös kun ole joka kuin niin tai sen hänen jos vain mitä nyt sitä ne olla olen sekä mukaan jo".split(),
    "pl": "i w na z do się nie to jest że o jak po za od dla przez ale czy być tym tak są był była było oraz który która które jego jej ich już tylko także przy ze".split(),
    "cs": "a v se na je že to s z do o i k ve pro jako za by ale po si od jsem jsou byl byla bylo které který která nebo už jen při až než také jeho".split(),
    "hu": "a az és hogy nem is egy ez van volt meg de ha csak mint már még el vagy lesz azt ezt minden nagyon után között majd ki fel".split(),
    "tr": "ve bir bu da de için ile olarak çok daha o ne gibi kadar sonra olan ama en var her ya değil ise mi onun bunu şu ben sen biz".split(),
    "id": "yang dan di ke dari untuk pada dengan ini itu adalah tidak dalam akan oleh juga sebagai ada mereka dia kami atau karena sudah telah dapat bisa saat lebih".split(),
    "vi": "và của là có cho không được trong một những các với người này đã để khi từ đến cũng như về ra vào nhưng tại trên theo nhiều".split(),
    "ru": "и в не на что с он как по это но из у к за от так же о для бы то его все она мы был было были или ее их мне если уже еще только при до чтобы я вы они".split(),
    "uk": "і в у не на що з та як до він це але за від по так для або його вона ми був було були про їх якщо вже ще при то я ви вони також".split(),
    "bg": "и в на да се не от за е с че по като но са си до това ще или който която което при ако има той тя ги му след още само".split(),
    "el": "και το η ο να του της με που την από για τα στο είναι στην δεν σε τον οι των τις θα μια ένα ως στη αυτό ή κατά μας αλλά".split(),
    "ar": "في من على إلى أن عن مع هذا هذه التي الذي لا ما كان كانت هو هي أو بعد قد كل بين ثم كما لم لن عند حتى غير".split(),
    "hi": "के का की है में से को और पर यह कि हैं ने भी एक था थे नहीं इस तो लिए हो कर या जो वह साथ ही तक".split(),
}
_STOP = {k: frozenset(v) for k, v in STOPWORDS.items()}
_OF = {w: tuple(k for k, s in _STOP.items() if w in s) for w in set().union(*_STOP.values())}

_BLOCK = frozenset("address article aside blockquote body br caption center col colgroup dd details div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose content isn't text of the page.
_SKIP = frozenset("noscript template textarea select svg iframe title object math".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|[^<]+|<", re.S | re.I)
_CLOSING = {k: re.compile(rf"</{k}\s*>", re.I) for k in _SKIP}
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f\u064b-\u0652\u0900-\u0dff])*")
_SIGN = re.compile(r"(?<!\S)[|¦•·●▪»«›‹>/\\~*=]+(?!\S)")
_WIDE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    heading: bool
    label: str = ""


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    parts: list[str] = []
    linked = depth = 0
    heading = False

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, linked, heading))
        parts.clear()
        linked = 0

    at, size, unclosed = 0, len(page), set()
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m.group(3)
        if name is None:
            if (s := m.group(0))[0] != "<" or s == "<":
                parts.append(s)
                if depth:
                    linked += len(html_lib.unescape(s).strip())
            continue
        name = name.lower()
        if name in _SKIP:
            if not m.group(2) and name not in unclosed and not m.group(4).endswith("/"):
                if end := _CLOSING[name].search(page, at):
                    at = end.end()
                else:
                    unclosed.add(name)  # there is none from here on
        elif name == "a":
            depth = max(0, depth - 1) if m.group(2) else 1
        elif name in _BLOCK:
            close()
            heading = len(name) == 2 and name[0] == "h" and name[1].isdigit() and not m.group(2)
    close()
    return out


def length(text: str) -> int:
    """Characters, those of scripts without spaces twice."""
    return len(text) if text.isascii() else len(text) + sum(1 for _ in _WIDE.finditer(text))


def first_pass(found: list[Block]) -> None:
    """Each block by itself, with the stop words of the page's language if there is a list that fits."""
    words = [_WORD.findall(b.text.lower()) for b in found]
    sizes = [length(b.text) for b in found]
    far = [b.linked / len(b.text) > MAX_LINK_DENSITY or "©" in b.text for b in found]
    cover, total = dict.fromkeys(_STOP, 0), 0
    for ws, n, bad in zip(words, sizes, far):
        if n >= LENGTH_LOW and not bad:
            total += len(ws)
            for w in ws:
                for k in _OF.get(w, ()):
                    cover[k] += 1
    best = max(cover, key=cover.__getitem__)
    stop = _STOP[best] if cover[best] >= FIT * total else None
    for b, ws, n, bad in zip(found, words, sizes, far):
        if bad:
            b.label = "bad"
        elif n < LENGTH_LOW:
            b.label = "bad" if b.linked else "short"
        elif stop is None:
            listed = len(_SIGN.findall(b.text)) > MAX_SIGNS * len(ws)
            b.label = "bad" if listed else "good" if n > LENGTH_HIGH else "neargood"
        else:
            density = sum(w in stop for w in ws) / len(ws) if ws else 0.0
            if density >= STOP_HIGH:
                b.label = "good" if n > LENGTH_HIGH else "neargood"
            else:
                b.label = "neargood" if density >= STOP_LOW else "bad"


def second_pass(found: list[Block]) -> list[bool]:
    """Open blocks from the nearest decided ones before and after; a page's edges count as boilerplate."""
    n = len(found)
    before, after = ["bad"] * n, ["bad"] * n
    near_before, near_after = [False] * n, [False] * n  # a near-good block lies between this one and that neighbour
    label, near = "bad", False
    for i in range(n):
        before[i], near_before[i] = label, near
        if found[i].label in ("good", "bad"):
            label, near = found[i].label, False
        elif found[i].label == "neargood":
            near = True
    label, near = "bad", False
    for i in reversed(range(n)):
        after[i], near_after[i] = label, near
        if found[i].label in ("good", "bad"):
            label, near = found[i].label, False
        elif found[i].label == "neargood":
            near = True
    keep = []
    for i, b in enumerate(found):
        if b.label in ("good", "bad"):
            keep.append(b.label == "good")
        elif before[i] == after[i]:
            keep.append(before[i] == "good")
        elif b.label == "neargood":
            keep.append(True)
        else:
            keep.append(near_before[i] if before[i] == "bad" else near_after[i])
    away, ahead = float("inf"), [float("inf")] * n  # characters to the next kept block
    for i in reversed(range(n)):
        ahead[i] = away
        away = 0 if keep[i] else away + len(found[i].text)
    return [k or (b.heading and b.label == "short" and d <= HEADING_REACH) for k, b, d in zip(keep, found, ahead)]


def extract(page: str | None) -> tuple[str | None, int, int]:
    """Main text, number of blocks, number kept."""
    if page is None:
        return None, 0, 0
    found = blocks(page)
    first_pass(found)
    keep = second_pass(found)
    return "\n".join(b.text for b, k in zip(found, keep) if k), len(found), sum(keep)


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, main text, blocks and blocks kept, a row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [extract(h) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32())], names=["page_id", "text", "n_blocks", "n_kept"])

    d = df.select(df[id_col].alias("page_id"), df[html_col].alias("html"))
    return d.mapInArrow(run, f"page_id {d.schema['page_id'].dataType.simpleString()}, text string, n_blocks int, n_kept int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_spread(spark, sf_dir, "pages"))
