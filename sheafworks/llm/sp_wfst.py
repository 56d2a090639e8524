"""SentencePiece encoding and decoding by weighted finite-state transduction.

The model is compiled into a cascade: the normaliser (character map, white space; ``sp_normaliser``), the piece lexicon with
byte fallback, and the piece grammar. Composed with an input it is a lattice whose states are text positions and whose
arcs are pieces; its shortest path in the tropical semiring (min, +) is the encoding.

* Unigram models: an arc weighs the negative log-probability of its piece, the grammar has one state.
* BPE models: scores are merge ranks, which don't add up along a path. Here the grammar has a state for each piece and
  an arc from piece a to piece b of weight 0 if merging the string ab yields just a, b, and infinity otherwise. A path
  of finite weight is unique and is the BPE encoding, so the shortest path again gives the library's pieces.
* A character without a piece leaves the lexicon by its UTF-8 bytes (byte fallback), or, with those beside it, by ``<unk>``.

Where every path passes through one state, the lattice is cut: before an escaped space that follows another
character (no piece spans that), and around characters without a piece. Parts between cuts recur, so their paths are
remembered, in a table of bounded size. Defined results: null text gives null pieces, empty text no piece; texts of any
length are encoded whole; repeated rows get equal pieces; only the id and text columns are read. Decoding joins the
pieces' bytes and undoes white space; for models without a character map it reproduces every input without U+2581.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheafworks.llm.sp_normaliser import Normaliser
from sheafworks.session import read_spread

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MEMORY = 1_000_000  # parts whose paths a worker remembers
_SPACE = "▁"
_TWO = (2,)
_HEAD = 5  # characters of a part's beginning whose lattice states are shared
_INF = float("inf")


class _Paths(dict):
    """part → its piece ids as little-endian int32 bytes. Bounded: two generations, the older is dropped when both are full."""

    def __init__(self, solve, limit: int) -> None:
        super().__init__()
        self.solve, self.limit, self.older = solve, limit // 2, {}

    def __missing__(self, part: str) -> bytes:
        out = self.older.get(part)
        if out is None:
            out = self.solve(part)
        if len(part) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[part] = out
        return out


class Transducer:
    def __init__(self, path: str = MODEL_PATH, memory: int = MEMORY) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type not in (1, 2):
            raise NotImplementedError("only unigram and BPE models")
        self.bpe = trainer.model_type == 2
        self.normalise = Normaliser.of(spec, trainer.treat_whitespace_as_suffix)
        self.plain = self.normalise.begins is None and not spec.remove_extra_whitespaces and spec.escape_whitespaces and not self.normalise.behind
        self.prefix, self.suffix = self.normalise.before, self.normalise.behind
        self.stripped, self.squeezed = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.pieces = [p.piece for p in proto.pieces]
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.lexicon = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (1, 4)}
        self.weight = [-p.score for p in proto.pieces]
        if not self.bpe:  # pieces that users define go before any others
            top = max((p.score for p in proto.pieces if p.type == 1), default=0.0)
            for i, p in enumerate(proto.pieces):
                if p.type == 4:
                    self.weight[i] = 0.1 - len(p.piece.encode()) * top
        self.unk_weight = max((-p.score for p in proto.pieces if p.type == 1), default=0.0) + 10.0
        by_rank = sorted(self.lexicon.values(), key=lambda i: (self.weight[i], i))
        self.rank = {i: k + 1 for k, i in enumerate(by_rank)}
        self.longest = max(map(len, self.lexicon), default=1)
        self.spans: dict[str, tuple[int, ...]] = {}
        self._index()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.grammar: dict[int, bool] = {}
        self.heads: dict[str, tuple[list[int], list[int]]] = {}
        self.inside = {p[i : i + 2] for p in self.lexicon for i in range(len(p) - 1)}
        alphabet = {c for p in self.lexicon for c in p}
        inner = any(_SPACE in p.lstrip(_SPACE) for p in self.lexicon)
        rest = "".join(re.escape(c) for c in sorted(alphabet - {_SPACE}))
        known = rest + _SPACE
        self.cuts = re.compile(f"[{known}]+|[^{known}]" if inner else f"{_SPACE}*[{rest}]+|{_SPACE}+|[^{known}]", re.S)
        self.paths = _Paths(self._solve, memory)
        self.raw = [bytes([int(p.piece[3:-1], 16)]) if p.type == 6 else b"" if p.type == 3 else p.piece.encode() if p.type != 2 else " ⁇ ".encode() for p in proto.pieces]

    def _index(self) -> None:
        """Last three characters → lengths of the pieces that end in them, longest first; where there are none, two is tried."""
        found: dict[str, set[int]] = {}
        for p in self.lexicon:
            if len(p) > 2:
                found.setdefault(p[-3:], {2}).add(len(p))
        self.spans = {c: tuple(sorted(n, reverse=True)) for c, n in found.items()}

    # -- grammar -----------------------------------------------------------------------------------
    def _split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one; None for a single character."""
        if piece not in self.halves:
            text, out = self.pieces[piece], None
            if len(text) > 1:
                parts = self._merge(text, self.rank[piece])
                out = (parts[0], parts[1]) if len(parts) == 2 else None  # None too if no merges lead to it
            self.halves[piece] = out
        return self.halves[piece]

    def whole(self, piece: int) -> bool:
        """Whether merging the piece's characters yields it: so for every piece that some merges lead to."""
        return self._split(piece) is not None or len(self.pieces[piece]) == 1

    def _merge(self, text: str, below: float = _INF) -> list[int]:
        """Merges by rank, leftmost first: used to compile the grammar, on strings of two pieces at most."""
        parts = list(text)
        while True:
            best, at = below, -1
            for k in range(len(parts) - 1):
                i = self.lexicon.get(parts[k] + parts[k + 1])
                if i is not None and self.rank[i] < best:
                    best, at = self.rank[i], k
            if at < 0:
                return [self.lexicon.get(p, -1) for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether the grammar has an arc from a to b: no merge of the string ab crosses the border between them.

        Undoes the merges of both sides from the latest on and looks at the pair of pieces that then met at the
        border: had their merge come before the next one on either side, a and b would not both have formed.
        """
        key = a << 20 | b
        ok = self.grammar.get(key)
        if ok is not None:
            return ok
        rank, joined, halves = self.rank, self.joined, self.halves
        left, right, limit = a, b, _INF
        while True:
            merged = joined(left, right)
            if merged is not None and rank[merged] < limit:
                ok = False
                break
            inner = halves.get(left) or self._split(left)
            outer = halves.get(right) or self._split(right)
            if not inner and not outer:
                ok = True
                break
            if inner and (not outer or rank[left] > rank[right]):
                limit, left = rank[left], inner[1]
            else:
                limit, right = rank[right] + 1, outer[0]
        if len(self.grammar) > 400_000:
            self.grammar.clear()
        self.grammar[key] = ok
        return ok

    def joined(self, a: int, b: int) -> int | None:
        return self.lexicon.get(self.pieces[a] + self.pieces[b])

    # -- lattice -----------------------------------------------------------------------------------
    def _fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")] if self.byte_ids else [self.unk]

    def _solve(self, part: str) -> bytes:
        """Cuts where no piece holds the characters on both sides, then solves what is between, or looks it up."""
        inside, cuts = self.inside, [0]
        for i in range(1, len(part)):
            if part[i - 1 : i + 1] not in inside:
                cuts.append(i)
        if len(cuts) > 1:
            cuts.append(len(part))
            return b"".join([self.paths[part[i:j]] for i, j in zip(cuts, cuts[1:])])
        return np.array(self._solve_bpe(part) if self.bpe else self._solve_unigram(part), dtype="<i4").tobytes()

    def _solve_bpe(self, part: str) -> list[int]:
        """The path of finite weight. ``last[j]`` is the piece that ends it at position j (-1: a bare character)."""
        n, head = len(part), part[:_HEAD]
        known = self.heads.get(head)
        if known is None:
            known = self._advance(head, [0], [1])
            if len(self.heads) >= 100_000:
                self.heads.clear()
            self.heads[head] = known
        last, size = known if n <= _HEAD else self._advance(part, *known)
        out, j = [], n
        while j:
            i = j - size[j]
            out.append([last[j]] if last[j] >= 0 else self._fallback(part[i:j]))
            j = i
        return [x for ids in reversed(out) for x in ids]

    def _advance(self, part: str, last: list[int], size: list[int]) -> tuple[list[int], list[int]]:
        """Extends the states of a beginning of the part, which don't depend on what follows, to the whole part."""
        last, size = last.copy(), size.copy()
        lexicon, spans, follows, grammar = self.lexicon.get, self.spans.get, self.follows, self.grammar.get
        for j in range(len(last), len(part) + 1):
            for length in (spans(part[j - 3 : j], _TWO) if j > 2 else _TWO if j == 2 else ()):
                i = j - length
                if i < 0:
                    continue
                p = lexicon(part[i:j])
                if p is None:
                    continue
                before = last[i] if i else -1
                if before < 0:
                    ok = self.whole(p)
                else:
                    ok = grammar(before << 20 | p)
                    if ok is None:
                        ok = follows(before, p)
                if ok:
                    last.append(p)
                    size.append(length)
                    break
            else:
                last.append(lexicon(part[j - 1], -1))
                size.append(1)
        return last, size

    def _solve_unigram(self, part: str) -> list[int]:
        n, unk_weight = len(part), self.unk_weight
        best, back = [0.0] + [_INF] * n, [(0, -1)] * (n + 1)
        for j in range(1, n + 1):
            for length in (*(self.spans.get(part[j - 3 : j], _TWO) if j > 2 else _TWO if j == 2 else ()), 1):
                i = j - length
                if i >= 0 and (p := self.lexicon.get(part[i:j])) is not None and best[i] + self.weight[p] < best[j]:
                    best[j], back[j] = best[i] + self.weight[p], (i, p)
            if best[j - 1] + unk_weight < best[j] and part[j - 1] not in self.lexicon:
                best[j], back[j] = best[j - 1] + unk_weight, (j - 1, -1)
        out, j = [], n
        while j:
            i, p = back[j]
            out.append([p] if p >= 0 else self._fallback(part[i:j]))
            j = i
        return [x for ids in reversed(out) for x in ids]

    # -- whole texts -------------------------------------------------------------------------------
    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        escaped = self.prefix + text.replace(" ", _SPACE) if self.plain else self.normalise(text)
        parts = self.cuts.findall(escaped) if len(text) < 4_000_000 else (m.group() for m in self.cuts.finditer(escaped))
        out = b"".join(map(self.paths.__getitem__, parts))
        return out if self.byte_ids else self._one_unknown(out)

    def _one_unknown(self, blob: bytes) -> bytes:
        """Unknown characters side by side are one unknown piece."""
        ids = np.frombuffer(blob, "<i4")
        again = (ids[1:] == self.unk) & (ids[:-1] == self.unk)
        return np.delete(ids, np.flatnonzero(again) + 1).tobytes() if again.any() else blob

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode(self, ids) -> str:
        raw = self.raw
        if not self.squeezed:
            text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace").replace(_SPACE, " ")
            return text[1:] if self.stripped and text.startswith(" ") else text
        # a space goes from the beginning of each piece until something is written
        parts, mark = [], _SPACE.encode()
        for i in ids:
            parts.append(raw[i] if parts else raw[i].removeprefix(mark))
            if not parts[0]:
                parts.clear()
        return b"".join(parts).decode("utf-8", "replace").replace(_SPACE, " ")


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The compiled model; a worker process keeps it, and the paths it remembers, from task to task."""
    return Transducer(path)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """id, piece ids, their number, and whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model_path)
        for batch in batches:
            step = 500
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                blobs, same, nulls = [], [], []
                for text in part.column(1).to_pylist():
                    if text is None:
                        blobs.append(b"")
                        same.append(None)
                        nulls.append(True)
                        continue
                    blob = t.encode_bytes(text)
                    blobs.append(blob)
                    same.append(t.decode(np.frombuffer(blob, "<i4").tolist()) == text)
                    nulls.append(False)
                counts = np.array([len(b) // 4 for b in blobs], dtype=np.int32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(blobs), "<i4")), mask=pa.array(nulls))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(counts, mask=np.array(nulls)), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_pieces", "round_trip"])

    d = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_pieces int, round_trip boolean")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """id and text of piece ids; null where the ids are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model_path)
        for batch in batches:
            texts = [None if ids is None else t.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    d = df.select(df[id_col].alias("doc_id"), df[ids_col].alias("ids"))
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_spread(spark, sf_dir, "documents"))
