"""Models in the public format, of other kinds than the one at hand, against the library: unigram and BPE, with character maps, white
space as the library treats it, with and without byte fallback. The models are written by hand, not trained."""

import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from sheafworks.llm import sp_normaliser, sp_wfst

ODD = [*"abcdeé", "A", "B", "ﬁ", "①", "Å", "e\u0301", "ｱ", "ﾞ", "㌔", "☃", "漢", "\t", "\n", "\u3000", "\u00a0", "\u200b", " ", "  ", "▁", "Ω", "ß", "𝒳"]


def charsmap(rule):
    proto = pb.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    return proto.normalizer_spec.precompiled_charsmap


def model(path, kind, rule, seed=1, squeeze=True, prefix=True, suffix=False, fallback=False, user=()):
    rng = random.Random(seed)
    m = pb.ModelProto()
    add = lambda piece, score, t: m.pieces.add(piece=piece, score=score, type=t)
    add("<unk>", 0, 2)
    add("<s>", 0, 3)
    add("</s>", 0, 3)
    for u in user:
        add(u, 0, 4)
    if fallback:
        for b in range(256):
            add(f"<0x{b:02X}>", 0, 6)
    pieces = [*"abcdeé▁kmω1fi"]
    while len(pieces) < 90:
        a, b = rng.choice(pieces), rng.choice(pieces)
        x = a + b
        if x not in pieces and len(x) <= 6 and "▁" not in (x[:-1] if suffix else x[1:]):
            pieces.append(x)
    for k, p in enumerate(pieces):
        add(p, -float(k) if kind == 2 else -rng.uniform(1, 9) * (1 if len(p) > 1 else 1.3), 1)
    m.trainer_spec.model_type = kind
    m.trainer_spec.byte_fallback = fallback
    m.trainer_spec.treat_whitespace_as_suffix = suffix
    m.trainer_spec.vocab_size = len(m.pieces)
    m.normalizer_spec.name = rule or "identity"
    m.normalizer_spec.precompiled_charsmap = charsmap(rule) if rule else b""
    m.normalizer_spec.add_dummy_prefix = prefix
    m.normalizer_spec.remove_extra_whitespaces = squeeze
    m.normalizer_spec.escape_whitespaces = True
    path.write_bytes(m.SerializeToString())
    return str(path)


CASES = [
    (1, "nmt_nfkc", {}), (1, "nfkc_cf", {"fallback": True}), (1, None, {"squeeze": False, "fallback": True}), (1, "nmt_nfkc", {"suffix": True}),
    (1, "nmt_nfkc", {"prefix": False}), (1, "nmt_nfkc", {"user": ("abcab", "☃")}), (2, "nmt_nfkc", {}), (2, "nmt_nfkc_cf", {"fallback": True, "squeeze": False}), (2, "nfkc", {"suffix": True, "fallback": True}),
]


@pytest.mark.parametrize("kind,rule,more", CASES)
def test_equals_library(tmp_path, kind, rule, more):
    path = model(tmp_path / "m.model", kind, rule, **more)
    t, lib = sp_wfst.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ["", " ", "  a  b  ", "abc", *("".join(rng.choice(ODD) for _ in range(rng.randint(0, 20))) for _ in range(1500))]
    for text in texts:
        assert t.normalise(text) == lib.normalize(text), text
        ids = t.encode(text)
        assert ids == lib.encode(text), (text, t.normalise(text))
        assert t.decode(ids) == lib.decode(ids), text


def test_character_maps_unfold():
    rules = sp_normaliser.unfold(charsmap("nmt_nfkc"))
    assert rules["ﬁ"] == "fi" and rules["①"] == "1" and rules["\t"] == " " and rules["\u200b"] == " " and len(rules) > 3000
    assert sp_normaliser.unfold(b"") == {}
