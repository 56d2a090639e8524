"""The normaliser of a SentencePiece model as a transducer from text to text.

A model's compiled character map is a double-array trie from byte strings to replacements. It is unfolded into the states and arcs
of a deterministic transducer over characters: from where it stands in the text it reads as far as arcs lead, writes the
replacement of the longest string that it read whole, and goes on behind that; a character that begins none is
written as it is. White space is squeezed, escaped, and set before or behind the text as the model says.
"""

from __future__ import annotations

import re
import struct

SPACE = "▁"


def unfold(charsmap: bytes) -> dict[str, str]:
    """The replacements of a compiled character map."""
    if not charsmap:
        return {}
    size = struct.unpack_from("<I", charsmap)[0]
    units = struct.unpack_from(f"<{size // 4}I", charsmap, 4)
    pool = charsmap[4 + size :]
    children: dict[int, list[tuple[int, int]]] = {}  # a node's base → (byte, place) of the arcs that leave it
    for at, unit in enumerate(units):
        if 0 < unit & 0x800000FF < 256:
            children.setdefault(at ^ unit & 0xFF, []).append((unit & 0xFF, at))
    out: dict[bytes, bytes] = {}
    todo = [(b"", (units[0] >> 10) << ((units[0] & 512) >> 6))]
    while todo:
        key, base = todo.pop()
        for byte, at in children.get(base, ()):
            below = at ^ ((units[at] >> 10) << ((units[at] & 512) >> 6))
            if units[at] >> 8 & 1:
                start = units[below] & 0x7FFFFFFF
                out[key + bytes([byte])] = pool[start : pool.index(b"\0", start)]
            todo.append((key + bytes([byte]), below))
    return {k.decode(): v.decode() for k, v in out.items()}


class Normaliser:
    """``states[k]`` maps a character to the next state, ``writes[k]`` is what is written on leaving the text there (None: nothing ends there)."""

    def __init__(self, rules: dict[str, str], prefix: bool, suffix: bool, squeeze: bool, escape: bool) -> None:
        self.states: list[dict[str, int]] = [{}]
        self.writes: list[str | None] = [None]
        for source, target in rules.items():
            k = 0
            for c in source:
                if c not in self.states[k]:
                    self.states[k][c] = len(self.states)
                    self.states.append({})
                    self.writes.append(None)
                k = self.states[k][c]
            self.writes[k] = target
        self.begins = re.compile("[" + "".join(map(re.escape, self.states[0])) + "]") if self.states[0] else None
        self.space, self.squeeze = SPACE if escape else " ", squeeze
        self.before, self.behind = self.space if prefix and not suffix else "", self.space if prefix and suffix else ""

    @classmethod
    def of(cls, spec, suffix: bool) -> Normaliser:
        return cls(unfold(spec.precompiled_charsmap), spec.add_dummy_prefix, suffix, spec.remove_extra_whitespaces, spec.escape_whitespaces)

    def mapped(self, text: str) -> str:
        """The text after the character map."""
        if self.begins is None:
            return text
        out, at, states, writes = [], 0, self.states, self.writes
        while (m := self.begins.search(text, at)) is not None:
            start = m.start()
            out.append(text[at:start])
            k, end, target, i = 0, start + 1, text[start], start
            while i < len(text) and (k := states[k].get(text[i], -1)) >= 0:
                i += 1
                if writes[k] is not None:
                    end, target = i, writes[k]
            out.append(target)
            at = end
        out.append(text[at:])
        return "".join(out)

    def __call__(self, text: str) -> str:
        t = self.mapped(text)
        if self.squeeze:
            t = re.sub(" +", " ", t).strip(" ")
        if not t:
            return ""
        t = self.before + t.replace(" ", self.space)
        return (t.rstrip(self.space) if self.squeeze else t) + self.behind
