"""Quality classifier by co-training.

Two logistic classifiers see different views of a document. The text view has the words:
hashed shapes, endings and identities of tokens. The page-metadata view has the columns lang,
source and n_chars and the layout profile (line lengths, shares of capitals, digits, symbols,
spaces), no words. Both start from a sample of labelled rows. In every round each view labels all
unlabelled documents that it is sure of, and the other view takes these pseudo-labels into its
training: a few gradient steps over the whole corpus, whose gradients are summed in a shuffle and
added to those of the labelled sample. At the end each view is calibrated on labelled rows kept
out of training, and a logistic blend of the calibrated views scores every document.

The only sample is that of labelled rows, at most ``LABELLED`` (by a hash of the id, so the same
rows are taken at every run); a fifth of it calibrates. Features of all documents are written once.

Results for odd input: null text counts as empty and null columns as a value of their own; repeated
rows are scored each; of several labels of an id the smallest counts, labels that are null or belong
to no document do nothing; if labels of one kind or of none are left, every score is the share of
good labels (1 without labels); a null id passes through unlabelled; a text of any length is read whole,
in one task; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, release, ship, text_or_empty

LABELLED = 20_000
ROUNDS = 3
STEPS = 2
SURE = 0.99
#: Weight of all pseudo-labels together, against the labelled rows.
PSEUDO_WEIGHT = 0.25
#: Penalty of a squared weight, against the summed loss of the labelled rows.
RIDGE = 0.5
#: A document is rejected only where bad is clearly the likelier.
ACCEPT = 0.3
VOCABULARY = 300_000

_SHAPES, _ENDINGS, _TOKENS = 64, 64, 128
TEXT_DIM = _SHAPES + _ENDINGS + _TOKENS
_BINS = 10
_NUMBERS = 7  # binned numbers of the metadata view
META_DIM = 16 + 32 + _BINS * _NUMBERS

#: Kind of each byte: 0 lower case and beyond ASCII, 1 capital, 2 digit, 3 line end, 4 space, 5 other.
_KIND = np.full(256, 5, np.uint8)
_KIND[128:] = 0
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[10] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_SHAPE = re.compile(rb"([A-Z]+)|([a-z\x80-\xff]+)|([0-9]+)|(.)\4*", re.S)


def _shape(token: bytes) -> bytes:
    return b"".join(b"A" if m[1] else b"a" if m[2] else b"0" if m[3] else m[4] for m in _SHAPE.finditer(token[:64]))


class Tokens(dict):
    """Token -> its three features."""

    def __missing__(self, token: bytes) -> tuple[int, int, int]:
        if len(self) >= VOCABULARY:
            self.clear()
        self[token] = f = (
            zlib.crc32(_shape(token)) % _SHAPES,
            _SHAPES + zlib.crc32(token[-3:]) % _ENDINGS,
            _SHAPES + _ENDINGS + zlib.crc32(token, 7) % _TOKENS,
        )
        return f


def text_view(text: bytes, tokens: Tokens) -> np.ndarray:
    found = np.array([*map(tokens.__getitem__, text.split())], np.int16).reshape(-1)
    share = np.bincount(found, minlength=TEXT_DIM) / max(len(found) // 3, 1)
    return np.round(255 * np.sqrt(share)).astype(np.uint8)


def meta_view(text: bytes, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=6)
    n, lines = max(len(text), 1), kinds[3] + 1
    letters = max(kinds[0] + kinds[1], 1)
    size = -1 if n_chars is None else max(n_chars, 0)
    numbers = (
        0 if size < 0 else 1 + np.log10(1 + size) * 1.5,
        np.log10(1 + len(text) / lines) * 2.5,
        10 * kinds[1] / letters,
        40 * kinds[2] / n,
        25 * kinds[5] / n,
        25 * (kinds[4] + kinds[3]) / n,
        np.log10(1 + lines) * 4,
    )
    out = np.zeros(META_DIM, np.uint8)
    out[zlib.crc32((lang or "").encode()) % 15 if lang is not None else 15] = 255
    out[16 + (zlib.crc32((source or "").encode()) % 31 if source is not None else 31)] = 255
    for i, x in enumerate(numbers):
        out[48 + _BINS * i + min(int(x), _BINS - 1)] = 255
    return out


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    have = set(docs.columns)
    meta = [F.col(f"`{c}`").cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"), *meta)


def _views(batch: pa.RecordBatch, tokens: Tokens) -> tuple[list[np.ndarray], list[np.ndarray]]:
    at = {c: batch.column(batch.schema.names.index(c)).to_pylist() for c in ("text", "lang", "source", "n_chars")}
    a = [text_view(t, tokens) for t in at["text"]]
    b = [meta_view(*x) for x in zip(at["text"], at["lang"], at["source"], at["n_chars"], strict=True)]
    return a, b


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a binary, b binary): both views of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in _slices(batches, 500):
            a, b = _views(batch, tokens)
            columns = [batch.column(0), *(pa.array([x.tobytes() for x in v], pa.binary()) for v in (a, b))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b"])

    return _columns(docs, id_col, text_col).mapInArrow(run, "doc_id long, a binary, b binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of feature bytes as numbers from 0 to 1, with a constant."""
    raw = column.to_pylist()
    x = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1).astype(np.float32) / 255
    return np.hstack([x, np.ones((len(raw), 1), np.float32)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 20) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        grad, hess = loss(x, y, w, ridge)
        w -= np.linalg.solve(hess, grad)
    return w


def loss(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the summed loss; the constant is not held back."""
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    p = sigmoid(x @ w)
    return x.T @ (p - y) + penalty * w, (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)


class Classifier:
    def __init__(self, share: float):
        self.share = share  # of good labels; the score of everything while there are no weights
        self.w: tuple[np.ndarray, np.ndarray] | None = None
        self.scale: list[tuple[float, float]] = [(1.0, 0.0), (1.0, 0.0)]
        self.blend = np.array([1.0, 1.0, 0.0])

    def view_scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Calibrated log odds of both views."""
        return tuple(s * (x @ w) + o for x, w, (s, o) in zip((a, b), self.w, self.scale, strict=True))

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of being good: by the text, by the metadata, by both."""
        if self.w is None:
            return (np.full(len(a), self.share),) * 3
        za, zb = self.view_scores(a, b)
        return sigmoid(za), sigmoid(zb), sigmoid(self.blend[0] * za + self.blend[1] * zb + self.blend[2])


def _pseudo_gradients(rows: DataFrame, start: tuple, now: tuple) -> tuple[list[np.ndarray], list[float]]:
    """For each view, summed gradient and number of the rows that the other view (at the round's start) is sure of."""
    held = rows.sparkSession.sparkContext.broadcast((start, now))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, now = held.value
        dims = [len(w) for w in now]
        g, n = [np.zeros(d) for d in dims], [0, 0]
        for batch in _slices(batches, 4000):
            x = [_matrix(batch.column(0)), _matrix(batch.column(1))]
            belief = [sigmoid(x[v] @ start[v]) for v in (0, 1)]
            for v in (0, 1):
                other = belief[1 - v]
                use = (other >= SURE) | (other <= 1 - SURE)
                g[v] += x[v][use].T @ (sigmoid(x[v][use] @ now[v]) - (other[use] > 0.5))
                n[v] += int(use.sum())
        view = np.repeat([0, 1], dims)
        dim = np.concatenate([np.arange(d) for d in dims])
        count = np.where(dim == 0, np.repeat(n, dims), 0)
        columns = [pa.array(view, pa.int32()), pa.array(dim, pa.int32()), pa.array(np.concatenate(g)), pa.array(count, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["v", "d", "g", "n"])

    sums = rows.select("a", "b").mapInArrow(run, "v int, d int, g double, n long")
    found = sums.groupBy("v", "d").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas()  # a row per weight
    g, n = [np.zeros(len(w)) for w in now], [0.0, 0.0]
    for v in (0, 1):
        mine = found[found["v"] == v]
        g[v][mine["d"].to_numpy()], n[v] = mine["g"].to_numpy(), float(mine["n"].sum())
    return g, n


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> tuple[Classifier, DataFrame]:
    """Classifier, and the feature table of all documents (doc_id, a, b, y)."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{target}`").cast("int").alias("y"))
    known = known.where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y"))
    total = known.count()
    keep = min(1.0, 0.95 * LABELLED / max(total, 1))
    lot = F.pmod(F.xxhash64("doc_id", F.lit("label")), F.lit(1 << 20))
    sample = known.where(lot < int(keep * (1 << 20)))
    rows = materialise(featured(docs, id_col, text_col).join(F.broadcast(sample), "doc_id", "left"), "features")

    taken = rows.where("y is not null").dropDuplicates(["doc_id"]).withColumn("lot", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)))
    taken = taken.orderBy("doc_id").toPandas()  # at most LABELLED rows
    y = taken["y"].to_numpy(np.float64)
    fitted = Classifier(float(y.mean()) if len(y) else 1.0)
    x = [_matrix(pa.array(taken[v], pa.binary())).astype(np.float64) for v in ("a", "b")] if len(y) else []
    train = taken["lot"].to_numpy() != 0
    if not len(y) or min(len(set(y[train])), len(set(y[~train]))) < 2:
        return fitted, rows

    w = [logistic(v[train], y[train]) for v in x]
    rest = rows.where("y is null")
    for _ in range(ROUNDS):
        start = tuple(w)
        for _ in range(STEPS):
            g, n = _pseudo_gradients(rest, start, tuple(w))
            for v in (0, 1):
                own, curve = loss(x[v][train], y[train], w[v], RIDGE)
                weight = PSEUDO_WEIGHT * train.sum() / max(n[v], 1.0)
                # the labelled rows' curvature stands for all rows; half a step, as it is not exact
                w[v] = w[v] - 0.5 * np.linalg.solve((1 + PSEUDO_WEIGHT) * curve, own + weight * g[v])
    fitted.w = tuple(w)
    z = [v[~train] @ u for v, u in zip(x, w, strict=True)]
    one = np.ones((~train).sum())
    for v in (0, 1):
        s, o = logistic(np.stack([z[v], one], axis=1), y[~train], 1.0)
        fitted.scale[v] = (max(float(s), 0.0), float(o))
    calibrated = fitted.view_scores(x[0][~train], x[1][~train])
    fitted.blend = logistic(np.stack([*calibrated, one], axis=1), y[~train], 1.0)
    return fitted, rows


_SCORES = ["p_text", "p_meta", "score"]


def score(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """doc_id, p_text, p_meta, score and accepted of every row."""
    model, rows = fit(docs, labels, target)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 4000):
            found = held.value.scores(_matrix(batch.column(1)), _matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p.astype(np.float64)) for p in found)], ["doc_id", *_SCORES])

    out = rows.select("doc_id", "a", "b").mapInArrow(run, "doc_id long, p_text double, p_meta double, score double")
    return out.withColumn("accepted", accepted(F.col("score")))


def accepted(score: Column) -> Column:
    return score >= ACCEPT


def keep_good(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """The rows of ``docs`` that are accepted, with all their columns: scored where they stand, without a join."""
    model, rows = fit(docs, labels, target)
    release(rows)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names, schema = docs.columns, docs.schema
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in _slices(batches, 500):
            column = lambda c: batch.column(names.index(c)).to_pylist() if c in names else [None] * batch.num_rows  # noqa: E731, B023
            texts = [(t or "").encode() for t in batch.column(text).to_pylist()]
            parts = [pa.array(texts, pa.binary()), *(pa.array(column(c), t) for c, t in (("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())))]
            a, b = _views(pa.RecordBatch.from_arrays(parts, ["text", "lang", "source", "n_chars"]), tokens)
            views = [_matrix(pa.array([x.tobytes() for x in v], pa.binary())) for v in (a, b)]
            yield batch.filter(pa.array(held.value.scores(*views)[2] >= ACCEPT))

    return docs.mapInArrow(run, schema)
