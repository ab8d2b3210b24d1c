"""Exact top-k inner products by columnar branch and bound.

Vectors are turned into integers and laid out vertically: a block of candidates is a
(dimensions x rows) matrix. Queries and candidates are dealt into blocks, and every
query block meets every candidate block once (the query set is fixed by the caller; no
pair is emitted). In a block pair, scores are accumulated a few dimensions at a time.
After each step a candidate survives only if its partial score plus the largest score
its remaining dimensions allow (remaining mass of the query times remaining mass of the
candidate, by Cauchy-Schwarz) can still reach the query's k-th best score so far, and the
survivors are compacted. Integer scores are exact in float64 while they stay below 2^53;
where they may pass that, candidates survive by float scores with a bound on their error,
and survivors are scored in Python integers. Block results (k rows a query and block) are ranked by a window.

Results for odd input: vectors that are null, empty, or hold null or non-finite components
take no part; rows with a null id neither; vectors only meet vectors of their own length;
components and scores beyond 64 bits count as the largest or smallest long; repeated rows of an id are candidates each, but never of a query with that id; the hits of
all rows of a query id are ranked together, as the query's SQL does; ties go to
the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
DIMENSION_BLOCK = 8
#: Rows of a candidate block whose scores are computed in full first, to get a k-th best score to prune with.
SEED_ROWS = 512


def _usable(vec: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, bad)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id long, v array<long>): floor(scale * x) of every usable vector."""
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    out = out.where(F.col("vec_id").isNotNull() & F.coalesce(_usable(F.col("v")), F.lit(False)))
    return out.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


_MOST = 2**63 - 1


def _exact_best(query: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """Best k rows of one query by exact integer scores, held within 64 bits, whatever the components."""
    q, c = query.astype(np.float64), rows.astype(np.float64)
    about = c @ q
    # float sums of d products err by less than this (rounding of products and sums, and of the components themselves)
    error = (len(q) + 4) * 2.0**-50 * np.sqrt((q**2).sum()) * np.sqrt((c**2).sum(axis=1)) + 1
    low = np.minimum(about - error, _MOST)
    alive = np.arange(len(ids))
    if len(ids) > k:
        alive = np.flatnonzero(np.minimum(about + error, _MOST) >= np.partition(low, len(low) - k)[len(low) - k])
    whole = query.tolist()
    scores = [min(max(sum(a * b for a, b in zip(whole, row)), -_MOST - 1), _MOST) for row in rows[alive].tolist()]
    best = sorted(range(len(alive)), key=lambda i: (-scores[i], ids[alive[i]]))[:k]
    return ids[alive[best]] if best else ids[:0], [scores[i] for i in best]


def search_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Best k candidates of each query in one block pair, as (query ids, candidate ids, scores)."""
    if np.abs(q.astype(np.float64)).max(initial=0) * np.abs(c.astype(np.float64)).max(initial=0) * q.shape[1] >= 2.0**53:
        found = [(i, *_exact_best(row, c_ids[c_ids != i], c[c_ids != i], k)) for i, row in zip(q_ids, q)]
        columns = [np.repeat([f[0] for f in found], [len(f[1]) for f in found]), np.concatenate([f[1] for f in found]), [x for f in found for x in f[2]]]
        return tuple(np.asarray(x, np.int64) for x in columns)
    order = np.argsort(-np.abs(q).sum(axis=0), kind="stable")  # heavy dimensions first: bounds fall sooner
    q = q[:, order].astype(np.float64)
    columns = np.ascontiguousarray(c[:, order].T.astype(np.float64))  # vertical layout: a row per dimension
    d, n = columns.shape
    steps = range(0, d, DIMENSION_BLOCK)
    q_rest = np.array([np.sqrt((q[:, s:] ** 2).sum(axis=1)) for s in [*steps, d]])
    c_rest = np.array([np.sqrt((columns[s:] ** 2).sum(axis=0)) for s in [*steps, d]])
    seed = min(n, SEED_ROWS)
    seeds = q @ columns[:, :seed]
    first = q[:, :DIMENSION_BLOCK] @ columns[:DIMENSION_BLOCK]  # the first block of dimensions, for all queries at once
    out_q, out_c, out_s = [], [], []
    for i in range(len(q_ids)):
        other = c_ids != q_ids[i]
        known = seeds[i][other[:seed]]
        least = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        alive, partial = np.flatnonzero(other), first[i]
        partial = partial[alive]
        for at, s in enumerate(steps):
            if at:
                partial = partial + q[i, s : s + DIMENSION_BLOCK] @ columns[s : s + DIMENSION_BLOCK, alive]
            bound = partial + q_rest[at + 1, i] * c_rest[at + 1, alive] * (1 + 1e-12) + 1e-6
            if len(alive) > k:
                # a lower bound of the k-th best: partial scores less all the mass that remains
                low = 2 * partial - bound
                least = max(least, np.partition(low, len(low) - k)[len(low) - k])
            keep = bound >= least
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
        best = np.lexsort((c_ids[alive], -partial))[:k]
        out_q.append(np.full(len(best), q_ids[i]))
        out_c.append(c_ids[alive[best]])
        out_s.append(partial[best].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_q, out_c, out_s))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of every query; is_query is a condition on vec_id."""
    ship(vectors.sparkSession)
    with Scratch() as scratch:
        rows = quantised(vectors, id_col, vec_col, scale).withColumn("q", F.coalesce(is_query, F.lit(False)))
        rows = scratch.table(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")  # drawn once
        counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("m")).first()
        n_c = -(-max(counts["n"], 1) // CANDIDATE_BLOCK)
        n_q = -(-max(counts["m"], 1) // QUERY_BLOCK)
        deal = lambda n: F.pmod(F.xxhash64("row", F.lit(17)), F.lit(n)).cast("int")  # noqa: E731  rows, so that copies of one id spread
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        queries = rows.where("q").select(F.size("v").alias("d"), deal(n_q).alias("qb"), every(n_c).alias("cb"), "vec_id", "v", F.lit(True).alias("q"))
        candidates = rows.select(F.size("v").alias("d"), every(n_q).alias("qb"), deal(n_c).alias("cb"), "vec_id", "v", F.lit(False).alias("q"))

        def block(left: pd.DataFrame) -> pd.DataFrame:
            qs, cs = left[left["q"]], left[~left["q"]]
            if not len(qs) or not len(cs):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            a, b, s = search_block(qs["vec_id"].to_numpy(), np.stack(qs["v"]), cs["vec_id"].to_numpy(), np.stack(cs["v"]), k)
            return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

        both = queries.unionByName(candidates)
        found = both.groupBy("d", "qb", "cb").applyInPandas(block, "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return scratch.result(found.select("query_id", "rank", "vec_id", "score"), "hits")
