"""Filter interaction audit: what each filter removes in every order of a set of filters.

A document's failures are a row of a mask matrix: 0 where it fails a filter, infinity
where it passes. An order of filters is a column of a position matrix, the inverse of
its permutation: the step at which each filter runs. Their min-plus product

    step(document, order) = min over filters (mask(document, filter) + position(filter, order))

is the step at which the order removes the document (infinity: it stays). Counts are
then scattered by (order, step), weighted by how many documents share a row of the
mask matrix; a filter that runs after a document's removal step, and that the document
fails, is redundant for it.

Spark finds the failures in one narrow pass over whole texts and counts documents per
(part, failures, labels) with partial aggregates, so a part or a text that holds a third
of all rows is a few rows before anything is shuffled on it. The matrices are then built
per part, from at most 2^filters x 4 weighted rows.

Defined results: a null text is an empty one (it fails A only, and E if another empty
text has a smaller id); a null part is the empty string; a row with a null id is never a
later copy nor the first of one; rows with the same id and text are not copies of each
other; ties of ids therefore all stay. A document has a label if any of its label rows
says so. Very long texts are split into words piece by piece, so that memory follows the
different words of one text. Columns not named are not read, so extra ones cannot clash.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ship, text_or_empty

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITALS_PERCENT = 200, 50, 3
SYMBOLS = re.compile(rb"[#$%&*|]")
_COPY = FILTERS.index("E")
_PIECE = 1 << 20
_NOT_CAPITAL = bytes(c for c in range(256) if not 65 <= c <= 90)


def _words(raw: bytes) -> tuple[int, int]:
    """Words and different words; bytes.split() parts at the six ASCII white-space characters only."""
    if len(raw) <= _PIECE:
        words = raw.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    blank = re.compile(rb"[\x20\x09-\x0D]")
    while at < len(raw):
        cut = blank.search(raw, at + _PIECE)
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_failures(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode()
    n, different = _words(raw)
    capitals = len(raw.translate(None, _NOT_CAPITAL))
    return (
        (n < MIN_WORDS)
        | (100 * different < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * len(text)) << 2
        | bool(SYMBOLS.search(raw)) << 3
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        yield pa.record_batch(
            [
                b.column("doc_id"),
                b.column("part"),
                pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                pa.array([text_failures(t) for t in texts], pa.int32()),
            ],
            names=["doc_id", "part", "digest", "mask"],
        )


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, digest of the text, mask of the filters A to D that it fails), a row per document."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(part_col).alias("part"), text_or_empty(text_col).alias("text")
    )
    return rows.mapInArrow(_judge, "doc_id long, part string, digest binary, mask int")


def weights(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per (part, mask, good, toxic), with filter E (a copy of a smaller id's text) added to the masks."""
    lab = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    # a row per document and text, so that repeated rows are one before the joins
    once = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = once.join(lab, "doc_id", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")})
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    texts = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("no_id"), first.alias("first")
    )
    least = texts.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    texts = texts.join(least, "digest")
    stays = F.coalesce(F.col("no_id"), F.lit(0)) + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("mask").alias("mask"), stays.alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << _COPY)).alias("mask"), (F.col("n") - stays).alias("n")),
    )
    split = texts.select("part", "good", "toxic", F.inline(sides)).where("n > 0")
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").cast("long").alias("n"))


def positions(n_filters: int, orders: Sequence[Sequence[int]]) -> np.ndarray:
    """Inverse permutations as a (filter, order) matrix of steps from 1."""
    p = np.empty((n_filters, len(orders)), np.int64)
    for j, order in enumerate(orders):
        p[list(order), j] = np.arange(1, n_filters + 1)
    return p


def removal_steps(masks: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Min-plus product of the mask matrix and the positions: (row, order) -> step, or n_filters + 1 if never removed."""
    n = len(position)
    never = n + 1
    out = np.full((len(masks), position.shape[1]), never, np.int64)
    for f in range(n):
        fails = (masks >> f) & 1
        cost = np.where(fails == 1, 0, never)  # 0 or infinity
        np.minimum(out, cost[:, None] + position[f][None, :], out=out)
    return out


def _tables(frame: pd.DataFrame, names: str) -> pd.DataFrame:
    """All orders and steps of one part, from its weighted mask rows."""
    orders = list(permutations(range(len(names))))
    k, m = len(names), len(orders)
    position = positions(k, orders)
    masks, n = frame["mask"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
    good, toxic = n * frame["good"].to_numpy(np.int64), n * frame["toxic"].to_numpy(np.int64)
    step = removal_steps(masks, position)
    shape = (m, k + 2)
    columns = np.broadcast_to(np.arange(m), step.shape)

    def scatter(weight: np.ndarray, where: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(shape, np.int64)
        np.add.at(out, (columns[chosen], where[chosen]), np.broadcast_to(weight[:, None], step.shape)[chosen])
        return out

    gone = step <= k
    removed, good_lost, toxic_lost = (scatter(w, step, gone) for w in (n, good, toxic))
    redundant = np.zeros(shape, np.int64)
    for f in range(k):
        at = np.broadcast_to(position[f][None, :], step.shape)
        redundant += scatter(n, at, (((masks >> f) & 1) == 1)[:, None] & (at > step))
    kept = n.sum() - np.cumsum(removed[:, : k + 1], axis=1)
    alone = np.array([n[masks == 1 << f].sum() for f in range(k)])
    by_filter = np.array([removed[np.arange(m), position[f]].sum() for f in range(k)])
    order_of = np.array(orders)
    o, s = np.repeat(np.arange(m), k), np.tile(np.arange(1, k + 1), m)
    f = order_of[o, s - 1]
    text = np.array(["".join(names[i] for i in order) for order in orders], object)
    part = frame["part"].iloc[0]
    return pd.DataFrame(
        {"part": part, "filter_order": text[o], "step": s.astype(np.int32), "kept": kept[o, s], "removed": removed[o, s],
         "redundant": redundant[o, s], "unique_fails": alone[f], "good_lost": good_lost[o, s], "toxic_lost": toxic_lost[o, s],
         "shapley": by_filter[f]}
    )


def tabulate(weighted: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every order of the filters ``names``, step by step, for each part of (part, mask, good, toxic, n).

    Works for any filters whose failures are bits of ``mask``, in the order of ``names``.
    """
    ship(weighted.sparkSession)
    schema = (
        "part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long"
    )
    return weighted.groupBy("part").applyInPandas(lambda g: _tables(g, names), schema)


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """The audit of the filters A to E over whole texts, per value of ``part_col``."""
    with Scratch() as scratch:
        rows = scratch.table(failures(docs, part_col=part_col), "failures")
        return scratch.result(tabulate(weights(rows, labels)), "audit")
