"""Whole values of secrets, and credential words of four languages."""

import unicodedata

import pytest

from sheafworks.llm import secrets


def values(text):
    return [text[f["start"] : f["end"]] for f in secrets.find(text)]


@pytest.mark.parametrize("text, want", [
    ('password = "Tr0ub,4dor&3xQ!" and so on', "Tr0ub,4dor&3xQ!"),
    ('secret: "a,9Kq#xL2;<z>"', "a,9Kq#xL2;<z>"),
    ("pwd: 'it\"s 9Kq#xL2'", 'it"s 9Kq#xL2'),
    ('{"password": "a\\"9Kq#xL2", "n": 1}', 'a\\"9Kq#xL2'),
    ('passphrase = "correct horse battery staple"', "correct horse battery staple"),
    ("(token=a,9Kq#xL2<z;Q).", "a,9Kq#xL2<z;Q"),
    ('token: "Zx81kQ0pLm77', "Zx81kQ0pLm77"),
    ("mot de passe : « Zx81 kQ0p,Lm77 »", " Zx81 kQ0p,Lm77 "),
    ("the password is Tr0ub,4dor&3xQ!", "Tr0ub,4dor&3xQ!"),
    ('the password is "Tr0ub 4dor 3xQ"', "Tr0ub 4dor 3xQ"),
    ("the password is: Zx81kQ0pLm77.", "Zx81kQ0pLm77"),
])
def test_whole_value(text, want):
    assert values(text) == [want]
    assert secrets.redact(text) == text.replace(want, "[SECRET]")


@pytest.mark.parametrize("word", ["Passwort", "Datenbankpasswort", "Kennwort", "API-Schlüssel", "Geheimschluessel", "Zugangscode", "Zugangsdaten", "Geheimnis", "mot de passe", "mdp", "jeton", "clé secrète", "clé d'API", "cle_api", "identifiants", "contraseña", "contrasena", "clave secreta", "clave de acceso", "secreto", "credenciales", "password"])
@pytest.mark.parametrize("sign", [": ", " : ", " = ", " is ", " ist ", " est ", " es "])
def test_words_of_four_languages(word, sign):
    for w in (word, word.upper(), unicodedata.normalize("NFD", word)):
        text = f"x {w}{sign}Zx81kQ0pLm77, y"
        assert values(text) == ["Zx81kQ0pLm77"], text
        assert any(h in text.lower() for h in secrets.HINTS), text


@pytest.mark.parametrize("text", ["the password is lost", "das Passwort ist falsch, el secreto es evidente", 'password = "", user = "robert"', "token='ab', x='abcdefgh'", "the token is case-sensitive."])
def test_no_value(text):
    assert values(text) == []


def test_words():
    """No worker goes on without the list; words of any length of it count."""
    with pytest.raises(FileNotFoundError):
        secrets.dictionary("/nowhere/words.json")
    words = secrets.dictionary()
    longest = max((w for w in words if w.isascii()), key=len)
    assert words.longest == max(map(len, words)) and any(m[:3] == (0, len(longest), "word") for m in secrets.matches(longest, words))
    long = "qzkvw" * 9 + "x"
    assert secrets.guess_cost(long, {long: 1.0}) == (1.0, [(0, len(long), "word")])
