"""Best-fit packing of tokenised documents into fixed-length sequences, in bulk-synchronous steps.

Documents become pieces of at most ``capacity`` tokens. Piece lengths and gaps (the room
left in a sequence) are integers up to the capacity, so the range-sorted list of pieces,
or of gaps, is a list of at most ``capacity`` runs of equal size, whatever the number of
rows. A step takes one run of pieces, longest first, and sweeps the runs of gaps from its
own length upwards: each piece gets the successor, the smallest gap that holds it. Many
pieces may want one run of gaps; rank decides (piece rank r meets gap rank r, the rest
sweep on). Only as many gaps of a run take part as the pieces fill up, or one for the pieces
that remain. The gaps that took a piece shrink and join their new run, and the step repeats
until its pieces are placed; only when no gap is left are sequences opened. This is
best-fit decreasing, with all pieces of one length placed at once.

Spark counts the runs and ranks the rows within their run, over salted sub-runs so that a
length shared by a third of all rows is dealt over many tasks. The sweeps walk counts
only, on the driver; they produce a table of flows (bounded by the capacity, not by the data) that is
broadcast, and every row looks its sequence and offset up by its rank: tracing which
earlier flow left the gap it took, back to the opening of the sequence. No rows are joined
or gathered.

Results for odd input: null or empty text is one piece holding only the end token; very long
texts are tokenised whole, those with a white-space run of LONG_BLANK or more by the slower
tokenizer, whose splitter needs no stack for them (the ids are the same); repeated rows are packed each; a null id passes through; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, materialise

CAPACITY = 1024
END_ID = 2
#: Rows of one length that a task ranks, about.
RANK_ROWS = 200_000
_SHIFT = 44

#: Characters that every regex library classes alike; texts with others take the slower tokenizer.
_PLAIN = re.compile(
    "[^\\t\\n\\r\\x20-\\x7e\\u00a1-\\u00ac\\u00ae-\\u024f\\u0391-\\u03a1\\u03a3-\\u03c9\\u0410-\\u044f"
    "\\u2010-\\u2015\\u2018-\\u2027\\u20ac]"
)
#: The faster tokenizer's splitter steps back through a run of white space, and ends the process near 1,000,000.
LONG_BLANK = 50_000
_BLANK = re.compile(r"(?<!\s)\s{%d}" % LONG_BLANK)  # a run is tried once, from its beginning
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of a `tokenizers` file. Where the file is plain byte-level BPE in rank order, texts of
    plain characters go through tiktoken with the same merges, which gives the same ids faster."""

    def __init__(self, content: str):
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_str(content)
        spec = json.loads(content)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._ranked(spec)

    def _ranked(self, spec: dict):
        import tiktoken

        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        if model.get("type") != "BPE" or not level or spec.get("normalizer") or model.get("ignore_merges"):
            return None
        vocab = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        if [vocab.get(a + b) for a, b in pairs] != [*range(256, 256 + len(model["merges"]))]:
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        plain = self.fast is not None and not _PLAIN.search(text) and not any(s in text for s in self.special)
        plain = plain and (len(text) < LONG_BLANK or not _BLANK.search(text))
        return self.fast.encode_ordinary(text) if plain else self.exact.encode(text, add_special_tokens=False).ids


_encoders: dict[str, Encoder] = {}


def encoder(content: str) -> Encoder:
    key = hashlib.sha1(content.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(content)
    return _encoders[key]


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, capacity) for s in range(first, n, capacity))]


def tokenised(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    rows = id_and_text(docs, id_col, text_col)
    content = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text())  # a vocabulary file: fixed size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(content.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                out: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.array([*enc.ids(text.as_py()), END_ID], "<u4")
                    for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                        out.append((doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes()), ids[s : s + n] if with_ids else None))
                cols = list(zip(*out, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], kinds, strict=False)], names[:n])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(cut, schema)


class Plan:
    """Flows of all steps, from the count of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        waiting = [0] * (capacity + 1)  # gaps of each size, as a queue: how many have joined
        head = [0] * (capacity + 1)  # and how many of those have been taken
        flows: list[tuple[int, int, int, int]] = []  # (length and piece rank, gap size, first rank taken there, sequence or -1)
        joins: list[tuple[int, int]] = []  # (gap size and rank in its queue, flow that left it)
        for length in range(capacity, 0, -1):
            n, rank, gap = counts.get(length, 0), 0, length
            while rank < n:
                while gap < capacity and head[gap] == waiting[gap]:
                    gap += 1
                # as many as these pieces fill up, as best fit does one after the other; what then remains shares one
                m = max((n - rank) // (gap // length), 1)
                if gap == capacity:  # no gap holds this length
                    flows.append((length << _SHIFT | rank, capacity, 0, self.sequences))
                    self.sequences += m
                else:
                    m = min(m, waiting[gap] - head[gap])
                    flows.append((length << _SHIFT | rank, gap, head[gap], -1))
                    head[gap] += m
                left = gap - length
                if left:
                    joins.append((left << _SHIFT | waiting[left], len(flows) - 1))
                    waiting[left] += m
                    gap = min(gap, max(left, length))
                rank += m
        order = sorted(range(len(flows)), key=lambda i: flows[i][0])
        back = {i: k for k, i in enumerate(order)}
        table = np.array([flows[i] for i in order], np.int64).reshape(-1, 4)
        self.key, self.gap, self.taken, self.opened = table.T.copy()
        joins.sort()
        self.join_key = np.array([k for k, _ in joins], np.int64)
        self.join_flow = np.array([back[f] for _, f in joins], np.int64)

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces given by length and rank within the length."""
        at = lengths.astype(np.int64) << _SHIFT | ranks.astype(np.int64)
        flow = np.searchsorted(self.key, at, "right") - 1
        offset = self.capacity - self.gap[flow]
        index = at - self.key[flow]
        sequence = np.empty(len(at), np.int64)
        todo = np.arange(len(at))
        while len(todo):
            f = flow[todo]
            new = self.opened[f] >= 0
            sequence[todo[new]] = self.opened[f[new]] + index[todo[new]]
            todo, f = todo[~new], f[~new]
            # the gap taken: its rank in the queue of its size, then the flow that left it there
            gap = self.gap[f] << _SHIFT | (self.taken[f] + index[todo])
            j = np.searchsorted(self.join_key, gap, "right") - 1
            index[todo], flow[todo] = gap - self.join_key[j], self.join_flow[j]
        return sequence, offset


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with rank, 0, 1, ... within each length, from salted sub-runs and their offsets."""
    spark = pieces.sparkSession
    salts = spark.createDataFrame([(n, max(1, -(-c // RANK_ROWS))) for n, c in counts.items()], "length long, salts long")
    rows = pieces.join(F.broadcast(salts), "length")  # at most `capacity` rows
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    runs = rows.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    rows = rows.withColumn("own", own).join(runs, ["length", "salt"])
    return rows.withColumn("rank", F.col("before") + F.col("own") - 1).drop("salt", "own", "before")


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces with sequence_id and offset; the pieces of a sequence lie gapless from offset 0."""
    pieces = materialise(tokenised(docs, tokenizer_path, capacity, with_ids, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    held = docs.sparkSession.sparkContext.broadcast(Plan(counts, capacity))
    names = [c for c in pieces.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(batch.schema.names.index(c))  # noqa: E731, B023
            sequence, offset = held.value.place(column("length").to_numpy(), column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    rows = ranked(pieces, counts).select(*names, "rank")
    schema = ", ".join(f"`{c}` {t}" for c, t in [*pieces.dtypes, ("sequence_id", "long"), ("offset", "long")])
    return rows.mapInArrow(place, schema)
