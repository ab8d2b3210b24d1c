"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model file is compiled into three transducers, composed lazily with every input:

* the normaliser: space to the word mark, and the mark before the text;
* the pieces: one arc for each piece, from the position where it begins to the one where it ends;
* byte fallback: for a character that no piece covers, one arc for each of its UTF-8 bytes.

The encoding is the shortest path of the composition in the tropical semiring. For a unigram
model an arc weighs its negative score, and fallback more than any piece. For a BPE model the
pieces' transducer also remembers the last piece: a transition is free if merging the two
pieces' characters gives back just these two pieces, else it weighs infinity. A sequence of
pieces is the BPE encoding of its text exactly if that holds for all neighbours, so one path
of finite weight is left (Berglund and van der Merwe, "Formalizing BPE Tokenization", 2023).
Transitions are computed when first needed and remembered.

Where two neighbouring characters stand together in no piece, every path passes between them.
The input is cut at such places (word marks, line ends), and the shortest paths of its parts
are remembered, for repeated words. Decoding runs the transducers backwards.

A word mark that stands in the text itself decodes as a space, as in the library. Models with
a normalisation table (``precompiled_charsmap``), user-defined symbols, or a word mark as
suffix are refused with an error.

Results for odd input: null or empty text has no ids; text that no piece covers falls back to
bytes, or to the unknown id in models without byte pieces; repeated rows are encoded each; a
null id passes through; an id out of range raises; other columns are ignored. One narrow pass,
without a shuffle, over whole texts.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, ship

MARK = "▁"
#: Parts that a task remembers, and transitions into one piece.
PARTS_CACHE = 400_000
PAIRS_CACHE = 20_000
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _USER, _UNUSED, _BYTE = 1, 2, 4, 5, 6
_UNKNOWN_PENALTY = 10.0


class Parts(dict):
    """Part of an input -> ids of its shortest path, as bytes. Remembers PARTS_CACHE recent parts, and as many before them."""

    def __init__(self, fst: Transducer):
        super().__init__()
        self.fst, self.older = fst, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("I", self.fst.shortest(part)).tobytes()
        if len(part) <= 64:  # longer parts rarely come again
            if len(self) >= PARTS_CACHE:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class Transducer:
    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if norm.precompiled_charsmap or _USER in kinds or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with a normalisation table, user-defined symbols or a suffix mark are not supported")
        self.bpe = proto.trainer_spec.model_type == _BPE
        if not self.bpe and proto.trainer_spec.model_type != _UNIGRAM:
            raise ValueError("only unigram and BPE models are supported")
        self.prefix, self.squeeze, self.escape = norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces
        self.surface = [p.piece for p in proto.pieces]
        self.kind = [p.type for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.unknown = self.kind.index(_UNKNOWN)
        # inside, the word mark is a space, as it is in texts, so that these need not be rewritten
        inner = (lambda t: t.replace(MARK, " ")) if self.escape else (lambda t: t)
        self.surface = [inner(t) for t in self.surface]
        self.pieces = {self.surface[i]: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        by_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.bytes = [by_byte[b] for b in range(256)] if len(by_byte) == 256 else None
        self.byte_ids = {i: b for b, i in by_byte.items()}
        # the pieces as a tree of characters: a node is (children by character, piece that ends here or -1)
        self.start: list = [{}, -1]
        for text, i in self.pieces.items():
            node = self.start
            for c in text:
                node = node[0].setdefault(c, [{}, -1])
            node[1] = i
        self.follow: list[dict[int, bool]] = [{} for _ in range(len(proto.pieces) + 1)]  # piece (-1: none) -> next piece -> may it follow
        self.split: dict[int, tuple[int, int] | None] = {}
        self.width = [len(t) for t in self.surface]
        self.longest = max(map(len, self.pieces), default=1)
        self.low = min((self.score[i] for i in self.pieces.values()), default=0.0) - _UNKNOWN_PENALTY
        # places that no piece spans: before a word mark that follows another character, around line ends that are in no piece
        spans = any(" " in p.lstrip(" ") for p in self.pieces)
        apart = "".join(c for c in "\n\r\t" if not any(c in p for p in self.pieces))
        other = f"[^ {apart}]"
        # unknown characters side by side are one piece in models without bytes, so those are not cut apart
        safe = not spans and self.bytes is not None
        self.cut = re.compile(f" +{other}*|{other}+" + (f"|[{apart}]+" if apart else "") if safe else r"[\s\S]+")
        self.parts = Parts(self)
        self.text_of = [self._decoded(i) for i in range(len(self.surface))]

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = " " + text if self.prefix else text
        return text.replace(MARK, " ") if self.escape else text

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.cut.findall(self.normalise(text))
        return np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), "<u4")

    def shortest(self, part: str) -> list[int]:
        return self._joined(part) if self.bpe else self._weighed(part)

    def _fallback(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]

    def _weighed(self, part: str) -> list[int]:
        """Unigram: best total score. back[i] is where the best last arc into i begins, and its piece (-1: fallback)."""
        # scores add up in single precision, as in the library: else ties would fall differently
        best, back, new = array("f", bytes(4 * len(part) + 4)), [None] * (len(part) + 1), array("f", [0])

        def arc(j: int, i: int, piece: int, score: float) -> None:
            new[0] = best[j] + score
            if back[i] is None or new[0] > best[i]:
                best[i], back[i] = new[0], (j, piece)

        for j in range(len(part)):
            for i in range(j + 1, min(len(part), j + self.longest) + 1):
                piece = self.pieces.get(part[j:i])
                if piece is not None:
                    arc(j, i, piece, self.score[piece])
            if part[j] not in self.pieces:
                arc(j, j + 1, -1, self.low)
        out, i, gap = [], len(part), False
        while i:
            j, piece = back[i]
            if piece >= 0:
                out.append([piece])
            elif self.bytes or not gap:  # neighbouring unknown characters are one unknown piece
                out.append(self._fallback(part[j:i]))
            gap, i = piece < 0, j
        return [x for ids in reversed(out) for x in ids]

    def _joined(self, part: str) -> list[int]:
        """BPE: the one path whose neighbours all belong together. last[i] is the piece that ends at i on the path to i."""
        follow, start, longest, n = self.follow, self.start, self.longest, len(part)
        last = [-1] * (n + 1)
        for i in range(n):
            before = last[i]  # < 0: the beginning, or after a character in no piece, which merges with nothing
            may = follow[before]
            node, j = start, i
            for c in part[i : i + longest]:
                node = node[0].get(c)
                if node is None:
                    break
                j += 1
                piece = node[1]
                if piece >= 0 and last[j] < 0:
                    free = may.get(piece)
                    if free is None:
                        free = self.free(before, piece)
                    if free:
                        last[j] = piece
        out, i, width = [], n, self.width
        while i:
            piece = last[i]
            if piece >= 0:
                out.append(piece)
                i -= width[piece]
            elif self.bytes:
                out += reversed(self._fallback(part[i - 1]))
                i -= 1
            else:  # neighbouring unknown characters are one unknown piece
                while i and last[i] < 0:
                    i -= 1
                out.append(self.unknown)
        out.reverse()
        return out

    def free(self, a: int, b: int) -> bool:
        """May piece b follow piece a (a < 0: nothing)? Remembered."""
        known = self.follow[a]
        if len(known) >= PAIRS_CACHE:
            known.clear()
        known[b] = free = self._stays_apart(a, b) if a >= 0 else self.halves(b) is not None
        return free

    def halves(self, piece: int) -> tuple[int, int] | None:
        """The pieces whose merge gives this one; (-1, -1) for a character; None if its characters merge otherwise."""
        if piece not in self.split:
            text = self.surface[piece]
            parts = self._merged(text, 2) if len(text) > 1 else []
            whole = len(text) == 1 or self._merged(text) == [text]
            self.split[piece] = None if not whole else tuple(self.pieces[x] for x in parts) or (-1, -1)
        return self.split[piece]

    def _stays_apart(self, a: int, b: int) -> bool:
        """Does no merge cross the boundary of a and b? Walks the merges next to it backwards in time.

        A crossing merge of r (the end of a, at some time) and l (the start of b) happens if its score
        beats the merge that takes up r, and is not beaten by the one that takes up l: of equal scores
        the leftmost goes first.
        """
        if self.halves(a) is None or self.halves(b) is None:
            return False
        x, y, score = self.surface[a], self.surface[b], self.score
        if not (x + y).strip(" "):  # runs of marks share one score
            return self._merged(x + y) == [x, y]
        r, l, up_r, up_l = a, b, -float("inf"), -float("inf")
        while True:
            both = self.pieces.get(self.surface[r] + self.surface[l])
            if both is not None and score[both] > up_r and score[both] >= up_l:
                return False
            one_r, one_l = len(self.surface[r]) == 1, len(self.surface[l]) == 1
            if one_r and one_l:
                return True
            if one_l or not one_r and score[r] < score[l]:
                up_r, r = score[r], self.halves(r)[1]
            else:
                up_l, l = score[l], self.halves(l)[0]

    def _merged(self, text: str, stop: int = 1) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until ``stop`` are left or none is a piece."""
        parts = list(text)
        while len(parts) > stop:
            found = [(-self.score[p], k) for k in range(len(parts) - 1) if (p := self.pieces.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _decoded(self, i: int) -> bytes:
        kind = self.kind[i]
        if kind == _BYTE:
            return bytes([self.byte_ids[i]])
        if kind == _UNKNOWN:
            return " ⁇ ".encode()
        return self.surface[i].encode() if kind == _NORMAL else b""

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids; bytes that are not UTF-8 become replacement characters."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


_compiled: dict[str, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    key = hashlib.sha1(model).hexdigest()
    if key not in _compiled:
        _compiled[key] = Transducer(model)
    return _compiled[key]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids, ids_crc32) of every row."""
    rows = id_and_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())  # a vocabulary file: fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 250):
                batch = whole.slice(at, 250)
                ids = [fst.encode(t.as_py()) for t in batch.column(1)]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                crc = pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, crc], ["doc_id", "text", "ids", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>, ids_crc32 long")


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column decoded; null ids give null."""
    ship(rows.sparkSession)
    model = rows.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for whole in batches:
            for begin in range(0, whole.num_rows, 250):
                batch = whole.slice(begin, 250)
                texts = [None if not x.is_valid else fst.decode(x.values.to_pylist()) for x in batch.column(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("decoded", "string")])
    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32, and whether decoding gives the text back: both ways in one pass over each text."""
    rows = id_and_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 250):
                batch = whole.slice(at, 250)
                sizes, crcs, exact = [], [], []
                for cell in batch.column(1):
                    text = cell.as_py()
                    ids = fst.encode(text)
                    sizes.append(len(ids)), crcs.append(zlib.crc32(ids)), exact.append(fst.decode(ids.tolist()) == text)
                columns = [pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(exact)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_crc32", "exact"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, exact boolean")
