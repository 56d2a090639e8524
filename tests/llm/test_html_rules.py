"""Pages in many languages, broken pages, and both passes against a plain version."""

import random

import pytest

from sheafworks.llm import html_blocks as H

ARTICLES = {
    "it": "Il comune ha deciso che la nuova biblioteca sarà aperta anche la sera, perché molti studenti non hanno un posto tranquillo per studiare. La decisione è stata presa dopo una lunga discussione con i cittadini del quartiere, che da anni chiedono più spazi pubblici nella zona.",
    "nl": "De gemeente heeft besloten dat de nieuwe bibliotheek ook in de avond open is, omdat veel studenten geen rustige plek hebben om te werken. Het besluit werd genomen na een lang gesprek met de bewoners van de wijk, die al jaren om meer ruimte vragen en niet langer willen wachten.",
    "ru": "Городской совет решил, что новая библиотека будет открыта и вечером, потому что у многих студентов нет тихого места для работы. Решение было принято после долгого обсуждения с жителями района, которые уже много лет просят о новых общественных местах для встреч и учёбы.",
    "ja": "市議会は、多くの学生が静かに勉強できる場所を持っていないため、新しい図書館を夜間も開館することを決定しました。この決定は、長年にわたり公共の場所を求めてきた地域の住民との長い話し合いの後に行われました。新しい図書館は来年の春に開館する予定で、多くの本と広い閲覧室が用意されます。",
    "sw": "Baraza la mji limeamua kwamba maktaba mpya itafunguliwa pia wakati wa jioni, kwa sababu wanafunzi wengi hawana mahali pa utulivu pa kusomea. Uamuzi huo ulifanywa baada ya mazungumzo marefu pamoja na wakazi wa mtaa huo, ambao kwa miaka mingi wameomba nafasi zaidi za umma katika eneo lao.",
    "de": "Die Stadt hat beschlossen, dass die neue Bibliothek auch am Abend geöffnet ist, weil viele Studenten keinen ruhigen Platz zum Lernen haben. Der Beschluss wurde nach einem langen Gespräch mit den Bewohnern des Viertels gefasst, die seit Jahren um mehr Raum bitten und nicht länger warten wollen.",
}
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/about'>About</a></li></ul></nav>"


@pytest.mark.parametrize("lang", ARTICLES)
def test_languages(lang):
    text = ARTICLES[lang]
    got, _, _ = H.extract(f"<html><head><title>t</title></head><body>{MENU}<h1>Kop</h1><p>{text}</p><p>{text[:90]}</p><footer>© 2020 x</footer></body></html>")
    assert got == f"Kop\n{text}\n{text[:90]}"


def test_density_still_decides_where_a_list_fits():
    text, junk = ARTICLES["de"], "Preisvergleich Turnschuhe Angebote Rabatt Versand Größe Farbe Marke Modell Bestellung Lieferung Gutschein Newsletter Kundenkonto Warenkorb Zahlung Rückgabe Impressum Datenschutz Kontakt Filialen Karriere Presse Partner Hilfe"
    assert H.extract(f"<p>{text}</p><p>{text}</p><div>{junk}</div>")[0] == f"{text}\n{text}"


@pytest.mark.parametrize("page", ["<html><head><title>t</title><meta charset=x><p>{}", "<head><title>t<p>{}", "<body><svg><p>{}", "<select><option>a</option><p>{}</p>", "<title>x</title><noscript><p>{}</p>", "<svg/><iframe src=x><p>{}</p>", "<svg><title>no</title><text>no no</text></svg><p>{}</p>"])
def test_unclosed_elements(page):
    assert ARTICLES["de"] in H.extract(page.format(ARTICLES["de"]))[0] and "no" != H.extract(page.format(ARTICLES["de"]))[0][:2]


def test_lists_without_links_in_a_language_without_a_list():
    menu = " | ".join("abcdefgh ijklmnop qrstuvwx".split() * 10)
    assert H.extract(f"<div>{menu}</div><p>{ARTICLES['sw']}</p>")[0] == ARTICLES["sw"]


def test_many_unclosed_tags_take_linear_time():
    assert len(H.extract("<svg><select><p>x" * 50_000)[0]) == 0
    assert H.extract("<svg>" * 100_000 + "</svg>")[0] == ""


def plain_keep(found):
    """Both passes written down as the rules say, looking through all neighbours for each block."""
    words = [[w for w in H._WORD.findall(b.text.lower())] for b in found]
    linky = [b.linked > H.MAX_LINK_DENSITY * len(b.text) or "©" in b.text for b in found]
    body = [w for b, ws, far in zip(found, words, linky) if H.length(b.text) >= H.LENGTH_LOW and not far for w in ws]
    score = {k: sum(w in v for w in body) for k, v in H.STOPWORDS.items()}
    lang = next(k for k in H.STOPWORDS if score[k] == max(score.values()))
    fits = score[lang] >= H.FIT * len(body)
    labels = []
    for b, ws, far in zip(found, words, linky):
        n, density = H.length(b.text), sum(w in H.STOPWORDS[lang] for w in ws) / max(len(ws), 1)
        if not fits:
            density = 0.0 if sum(t in ("|", "•", "»") for t in b.text.split()) > 0.1 * len(ws) else 1.0
        labels.append("bad" if far else ("bad" if b.linked else "short") if n < 70 else ("good" if n > 200 else "neargood") if density >= 0.18 else "neargood" if density >= 0.1 else "bad")
    keep = []
    for i, label in enumerate(labels):
        left = next((j for j in range(i - 1, -1, -1) if labels[j] in ("good", "bad")), None)
        right = next((j for j in range(i + 1, len(labels)) if labels[j] in ("good", "bad")), None)
        a, b = "bad" if left is None else labels[left], "bad" if right is None else labels[right]
        if label in ("good", "bad"):
            keep.append(label == "good")
        elif a == b or label == "neargood":
            keep.append("good" in (a, b))
        else:
            between = labels[(0 if left is None else left + 1) : i] if a == "bad" else labels[i + 1 : len(labels) if right is None else right]
            keep.append("neargood" in between)
    out = []
    for i, b in enumerate(found):
        ahead = next((j for j in range(i + 1, len(found)) if keep[j]), None)
        near = ahead is not None and sum(len(x.text) for x in found[i + 1 : ahead]) <= H.HEADING_REACH
        out.append(keep[i] or (b.heading and labels[i] == "short" and near))
    return out


def test_both_passes_brute_force():
    rng = random.Random(11)
    vocabulary = {k: [w for w in v if len(w) > 1] for k, v in H.STOPWORDS.items()}
    for _ in range(300):
        lang = rng.choice([*vocabulary, "none"])
        found = []
        for _ in range(rng.randint(1, 25)):
            share, n = rng.choice([0, 0.05, 0.12, 0.15, 0.2, 0.4]), rng.choice([3, 10, 14, 20, 45, 80])
            ws = [rng.choice(vocabulary[lang]) if lang != "none" and rng.random() < share else "".join(rng.choice("bcdfgkxqz") for _ in range(rng.randint(4, 8))) for _ in range(n)]
            if rng.random() < 0.2:
                ws = [x for w in ws for x in (w, rng.choice("|•»"))]
            text = " ".join(ws) + (" ©" if rng.random() < 0.05 else "")
            found.append(H.Block(text, rng.choice([0, 0, 0, int(len(text) * rng.random())]), rng.random() < 0.2))
        want = plain_keep(found)
        H.first_pass(found)
        assert H.second_pass(found) == want
