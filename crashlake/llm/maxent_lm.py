"""Hashed maximum-entropy language model with a class-factored softmax.

A token's probability is P(class group | history) P(class | group, history) P(token | class).
The most frequent tokens are classes of their own; every other token's class follows from its
last letters, so it needs no dictionary. Both softmaxes are log-linear in hashed features of
the history: the token before, the pair before, and the token two back alone (skip). Inside a
class tokens have smoothed frequencies, and the class's unseen tokens are one event, as likely
as its tokens seen once; the probabilities of all tokens and these events add up to one.

Counts and training cover all training documents. Counting merges per-task sums in a shuffle.
Training is one pass in ``ROUNDS`` rounds. Documents are dealt by a hash into shares of about ``SHARE``
tokens, so how the input is split, and on how many tasks, does not matter: every share is taken in
the order of the hash in mini-batches that update a copy of the weights by Adagrad, and gives back
the rows that moved; rows are averaged over shares, weighted by how often they were used. The
weight tables have a fixed size and are what is sent out. Token counts are not: tokens with at least N / ``HEAD`` occurrences
(there cannot be more than ``HEAD`` of them) are sent to every task, and the counts of all others
meet the documents that use them in a join. Scoring works on numpy batches.

Tokens are told apart by 64-bit hashes. Results for odd input: null or empty text is the end token
alone; repeated rows are scored each (and train each); a null id counts as empty text for the split,
so it is held out; without training documents the base score is 0 per token; a text of any length is
scored whole, in one task; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialise, release

ADD = 0.1
GROUPS = SIZE = 16  # classes: GROUPS groups of SIZE
SINGLES = 128  # classes of one frequent token; the others go by last letters
TAIL = GROUPS * SIZE - SINGLES
FEATURE_BITS = 15
ROWS = 1 << FEATURE_BITS
HEAD = 1 << 22
ROUNDS = 2
BATCH = 8192
SHARE = 8_000_000  # training tokens of a share
RATE = 0.3
CAUTION = 10.0  # squared gradient that a weight has at first: rows seen a few times move little
SLICE_BYTES = 8 << 20  # text that a task works on at once
HELD_COUNTS = 3_000_000  # token counts that a task holds before it passes them on
MARKS = b".,;:!?"  # not part of a token's ending
END = b"\n"  # not a word: words hold no white space


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hash(token: bytes) -> int:
    """Signed 64-bit hash."""
    h = xxhash.xxh3_64_intdigest(token)
    return h - (1 << 64) if h >> 63 else h


def tail_class(token: bytes) -> int:
    """Class by last letters, before numbering: 0 ... TAIL - 1."""
    return zlib.crc32(token.rstrip(MARKS)[-3:]) % TAIL


class Tokens:
    """Tokens of a batch of texts, the end token last in each: numbers into the batch's distinct tokens."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        if b"" in words:  # beside white space at a text's ends
            real = numbers != words.index(b"")
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sizes = np.bincount(owner[real], minlength=len(sizes))
            numbers = numbers[real]
        self.sizes = sizes + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        self.numbers = np.full(int(self.sizes.sum()), len(words), np.int64)
        inside = np.ones(len(self.numbers), bool)
        inside[self.first + sizes] = False
        self.numbers[inside] = numbers
        words.append(END)
        digest, crc = xxhash.xxh3_64_intdigest, zlib.crc32
        self.hash = np.array([digest(t) for t in words], np.uint64).view(np.int64)
        self.tail = np.array([crc(t.rstrip(MARKS)[-3:]) % TAIL for t in words], np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about SLICE_BYTES of text."""
    for batch in batches:
        at = batch.schema.names.index("text")
        total = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, before + SLICE_BYTES, "right")), begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def _tokens(batch: pa.RecordBatch) -> Tokens:
    return Tokens(batch.column(batch.schema.names.index("text")))


def token_counts(rows: DataFrame) -> DataFrame:
    """(h, tail, c) of every distinct token, from rows with a column text."""

    def merged(parts: list[tuple]) -> tuple[np.ndarray, ...]:
        h, tail, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h = h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[first], tail[order][first], np.add.reduceat(c[order], first)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in _slices(batches):
            t = _tokens(batch)
            c = np.bincount(t.numbers, minlength=len(t.hash))
            used = c > 0  # without documents not even the end token
            parts.append((t.hash[used], t.tail[used], c[used]))
            if sum(len(p[0]) for p in parts) > HELD_COUNTS:
                parts = [merged(parts)]
                if len(parts[0][0]) > HELD_COUNTS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts.pop()], ["h", "tail", "c"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], ["h", "tail", "c"])

    parts = rows.mapInArrow(count, "h long, tail long, c long")
    return parts.groupBy("h").agg(F.first("tail").alias("tail"), F.sum("c").alias("c"))


class Model:
    """Everything of a fixed size: totals, head counts, class masses, weights."""

    def __init__(self, total: int, distinct: int, head: pd.DataFrame, masses: pd.DataFrame):
        """head: (h, tail, c) of frequent tokens; masses: (tail, c, n, once) over all tokens by last letters."""
        self.total, self.distinct = total, distinct
        self.log_base = float(np.log10(total + ADD * (distinct + 1)))
        head = head.sort_values("h")
        self.head_h, self.head_c = head["h"].to_numpy(np.int64), head["c"].to_numpy(np.int64)
        end = token_hash(END)
        top = head.assign(end=head["h"] == end).sort_values(["end", "c", "h"], ascending=[False, False, True]).head(SINGLES)
        self.single_h = top["h"].to_numpy(np.int64)
        mass = np.zeros(GROUPS * SIZE)
        mass[: len(top)] = top["c"] + ADD
        ends = masses["tail"].to_numpy(np.int64)
        # unseen tokens of a class are one event; tokens seen once tell how likely it is
        self.unseen = np.full(TAIL, ADD)
        np.add.at(self.unseen, ends, masses["once"].to_numpy(np.float64))
        mass[SINGLES:] = self.unseen
        np.add.at(mass, SINGLES + ends, masses["c"].to_numpy() + ADD * masses["n"].to_numpy())
        np.add.at(mass, SINGLES + top["tail"].to_numpy(np.int64), -(top["c"].to_numpy() + ADD))
        self.log_mass = np.log10(np.maximum(mass, 1e-300))
        order = np.argsort(self.single_h)
        self.single_sorted, self.single_class = self.single_h[order], order
        by_group = np.maximum(mass, 0).reshape(GROUPS, SIZE)
        with np.errstate(divide="ignore"):
            bias1 = np.maximum(np.log(by_group.sum(axis=1)), -1e9)
            bias2 = np.maximum(np.log(by_group), -1e9)
        self.bias1 = (bias1 - bias1.max()).astype(np.float32)
        self.bias2 = (bias2 - bias2.max(axis=1, keepdims=True)).astype(np.float32)
        self.w1 = np.zeros((ROWS, GROUPS), np.float32)
        self.w2 = np.zeros((ROWS, SIZE), np.float32)

    def classes(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        if not len(self.single_sorted):
            return SINGLES + tail
        at = np.minimum(np.searchsorted(self.single_sorted, h), len(self.single_sorted) - 1)
        return np.where(self.single_sorted[at] == h, self.single_class[at], SINGLES + tail)

    def head_counts(self, h: np.ndarray) -> np.ndarray:
        """Counts of head tokens; -1 for others, whose count comes from the join."""
        if not len(self.head_h):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.head_h, h), len(self.head_h) - 1)
        return np.where(self.head_h[at] == h, self.head_c[at], -1)


def history(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature rows (3 x tokens) of documents that begin at ``first`` in ``hashes``: token before, pair before, token two back."""
    h = hashes.view(np.uint64)
    one, two = np.zeros_like(h), np.zeros_like(h)
    one[1:], two[2:] = h[:-1], h[:-2]
    one[first] = two[first] = 0  # nothing stands before a document
    second = first + 1
    two[second[second < len(h)]] = 0
    shift = np.uint64(64 - FEATURE_BITS)
    rows = np.empty((3, len(h)), np.uint16)
    rows[0] = _mix(one ^ np.uint64(0x1234567)) >> shift
    rows[1] = _mix(one * np.uint64(0x9E3779B97F4A7C15) ^ two * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift
    rows[2] = _mix(two ^ np.uint64(0x7654321ABC)) >> shift
    return rows


def _second(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Rows of the second table: feature and group, hashed."""
    x = (rows.astype(np.uint32) * np.uint32(GROUPS) + group.astype(np.uint32)) * np.uint32(2654435761)
    return (x >> np.uint32(32 - FEATURE_BITS)).astype(np.uint16)


def _softmax(logits: np.ndarray) -> np.ndarray:
    # the biases are at most 0 and the weights small, so exp stays in range
    np.exp(np.minimum(logits, 60, out=logits), out=logits)
    logits *= (1 / np.einsum("ij->i", logits))[:, None]
    return logits


def probabilities(m: Model, rows: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Softmax over groups, over classes of the right group, and the rows used of the second table."""
    group = classes // SIZE
    second = _second(rows, group)
    p1 = np.take(m.w1, rows[0], axis=0)
    p2 = np.take(m.w2, second[0], axis=0)
    p1 += m.bias1
    p2 += np.take(m.bias2, group, axis=0)
    for k in range(1, len(rows)):
        p1 += np.take(m.w1, rows[k], axis=0)
        p2 += np.take(m.w2, second[k], axis=0)
    return _softmax(p1), _softmax(p2), second


def log_classes(m: Model, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 of P(group | history) P(class | group, history)."""
    out = np.empty(len(classes))
    for s in range(0, len(classes), BATCH):
        c = classes[s : s + BATCH]
        p1, p2, _ = probabilities(m, rows[:, s : s + BATCH], c)
        i = np.arange(len(c))
        out[s : s + BATCH] = np.log10(np.maximum(p1[i, c // SIZE].astype(np.float64) * p2[i, c % SIZE], 1e-300))
    return out


def _update(w: np.ndarray, seen: np.ndarray, used: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """Adagrad step of the rows in use; grad is summed over the tokens of a row."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    at = ordered[first]
    total = np.add.reduceat(np.take(grad, order, axis=0), first, axis=0)
    squares = np.take(seen, at, axis=0)
    squares += total * total
    seen[at] = squares
    squares += CAUTION
    total *= RATE
    total /= np.sqrt(squares, out=squares)
    w[at] -= total
    used[at] += np.diff(first, append=len(rows))


def _dealt(rows: DataFrame, shares: int) -> DataFrame:
    """A partition a share, in an order of its own: the same whatever the partitions of ``rows``."""
    placed = rows.withColumn("place", F.xxhash64("doc_id", "text", F.lit("share")))
    return placed.repartitionById(shares, F.pmod("place", F.lit(shares)).cast("int")).sortWithinPartitions("place").drop("place")


def _train_round(rows: DataFrame, model: Model) -> None:
    """One round over ``rows``: local updates in every partition, averaged into ``model``."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"d{i}" for i in range(SIZE)]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = held.value
        m = Model.__new__(Model)
        m.__dict__ = {**start.__dict__, "w1": start.w1.copy(), "w2": start.w2.copy()}
        seen = [np.zeros_like(m.w1), np.zeros_like(m.w2)]
        used = [np.zeros(ROWS, np.int64), np.zeros(ROWS, np.int64)]
        for batch in _slices(batches):
            t = _tokens(batch)
            feature = history(t.hash[t.numbers], t.first)
            classes = m.classes(t.hash, t.tail)[t.numbers]
            for s in range(0, len(classes), BATCH):
                f, c = feature[:, s : s + BATCH], classes[s : s + BATCH]
                p1, p2, second = probabilities(m, f, c)
                i = np.arange(len(c))
                p1[i, c // SIZE] -= 1
                p2[i, c % SIZE] -= 1
                for k in range(len(f)):
                    _update(m.w1, seen[0], used[0], f[k], p1)
                    _update(m.w2, seen[1], used[1], second[k], p2)
        for table, (now, before) in enumerate(((m.w1, start.w1), (m.w2, start.w2))):
            at = np.flatnonzero(used[table])
            moved = ((now - before)[at].astype(np.float64) * used[table][at, None]).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(at + table * ROWS), pa.array(used[table][at]), *map(pa.array, moved)], ["row", "n", *names]
            )

    moved = rows.mapInArrow(train, "row long, n long, " + ", ".join(f"{d} double" for d in names))
    table = materialise(moved.groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(d).alias(d) for d in names]), "moved")
    found = table.toPandas()  # at most 2 * ROWS rows
    release(table)
    at = found["row"].to_numpy(np.int64)
    step = (found[names].to_numpy() / found[["n"]].to_numpy()).astype(np.float32)
    for table, w in enumerate((model.w1, model.w2)):
        mine = at // ROWS == table
        w[at[mine] % ROWS] += step[mine]


def fit(rows: DataFrame) -> tuple[Model, DataFrame]:
    """Model of rows (doc_id, text), and the counts of all tokens (h, tail, c)."""
    counts = materialise(token_counts(rows), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = counts.where(F.col("c") * HEAD >= totals["n"]).toPandas()  # at most HEAD rows
    masses = counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("n"), F.count_if(F.col("c") == 1).alias("once"))
    masses = masses.toPandas()  # at most TAIL rows
    model = Model(totals["n"], totals["v"], head, masses)
    if totals["n"]:
        shares = -(-totals["n"] // (ROUNDS * SHARE))
        for r in range(ROUNDS):
            _train_round(_dealt(rows.where(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS)) == r), shares), model)
    return model, counts


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """Per row: sums without the counts of tail tokens, and the tail tokens as (h, tf)."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in _slices(batches):
            t = _tokens(batch)
            n, count, kind = t.numbers, m.head_counts(t.hash), m.classes(t.hash, t.tail)
            log_c = np.log10(np.where(count >= 0, count + ADD, 1.0))
            inside = np.where(kind < SINGLES, 0.0, log_c - m.log_mass[kind])
            own = log_classes(m, history(t.hash[n], t.first), kind[n]) + inside[n]
            add = lambda x: pa.array(np.add.reduceat(x, t.first))  # noqa: E731, B023
            # tail tokens: distinct (document, token) and how often
            rare = np.flatnonzero(count[n] < 0)
            doc = np.searchsorted(t.first, rare, "right") - 1
            pairs, tf = np.unique(doc * len(t.hash) + n[rare], return_counts=True)
            doc, token = pairs // len(t.hash), pairs % len(t.hash)
            ends = np.searchsorted(doc, np.arange(len(t.first) + 1))
            fields = [pa.array(t.hash[token]), pa.array(tf.astype(np.int32)), pa.array(t.tail[token].astype(np.int16))]
            tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["h", "tf", "tail"]))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(names.index("doc_id")), batch.column(names.index("held_out")), pa.array(t.sizes),
                    add((count > 0).astype(np.int64)[n]), add((log_c - m.log_base)[n]), add(own), tails,
                ],
                ["doc_id", "held_out", "n_tokens", "head_known", "base", "own", "tails"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, head_known long, base double, own double, tails array<struct<h:long,tf:int,tail:short>>"
    return rows.mapInArrow(score, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; learns from the rows not held out."""
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", held_out(F.col("doc_id")).alias("held_out")
    )
    model, counts = fit(rows.where("not held_out").select("doc_id", "text"))
    part = materialise(_scored(rows, model).withColumn("uid", F.monotonically_increasing_id()), "scored")  # uid is drawn once

    used = part.select("uid", F.explode("tails").alias("t")).select("uid", "t.h", "t.tf", "t.tail")
    rest = counts.where(F.col("c") * HEAD < model.total).select("h", "c")
    tf, c = F.col("tf"), F.col("c")
    unseen = F.array(*[F.lit(float(x)) for x in np.log10(model.unseen)])
    tail = used.join(rest, "h", "left").groupBy("uid").agg(
        F.sum(F.when(c.isNotNull(), tf).otherwise(0)).alias("known"),
        F.sum(tf * F.log10(F.coalesce(c, F.lit(0)) + ADD)).alias("base_tail"),
        F.sum(tf * F.when(c.isNotNull(), F.log10(c + ADD)).otherwise(F.element_at(unseen, F.col("tail") + 1))).alias("own_tail"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return part.drop("tails").join(tail, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + zero("known")).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_tail")).alias("base_score"), (F.col("own") + zero("own_tail")).alias("score"),
    )
