"""URL filter: host and path rules, and a character language-model ratio for the rest.

URLs that a rule settles train two variable-order Markov models over the characters of
host and path, one of accepted and one of rejected URLs. A model blends orders 0 to
``ORDER`` by Witten-Bell smoothing: a context that was seen often trusts its own counts,
a new one falls back to the next shorter context. Counts are exact (contexts are told apart
by 64-bit hashes), summed by a shuffle over all training URLs, and stay a table that grows
with them: URLs are dealt into blocks of bounded characters, the contexts and grams of a block meet their counts
in a join, and the counts found meet the block's URLs.

Other URLs are judged by the difference of the two log-likelihoods per character. The
threshold is calibrated on settled URLs held out of training (by a hash of the URL): the
midpoint between neighbouring scores that gives the best balanced accuracy, from a
histogram of fixed size.

Results for odd input: a null url or one without ``://`` has an empty host and path, no
rule, and the score 0; without training URLs of both kinds every score is 0; a score of
at least the threshold allows. Repeated rows are judged alike. A URL of any length is read whole,
slice by slice; a block holds at most its share of characters and one longer URL. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import input_partitions, materialise, release, ship

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5
#: Characters of the URLs whose contexts are looked up together, about.
BLOCK_CHARS = 65_536
#: Characters whose keys are held at once.
SLICE_CHARS = 262_144
#: Characters that a counting task should get: at least, and at most where the cluster's partitions are too few.
COUNT_CHARS = (131_072, 1 << 26)
HOLD_OUT = 5
BINS = 2000
SPAN = 5.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, F.when(F.startswith(path, F.lit("/")), path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: list[str]) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first, last + 1) of the characters and ends of all texts in order, in groups of at most SLICE_CHARS."""
    group, room = [], SLICE_CHARS
    for i, text in enumerate(texts):
        at = 0
        while at <= len(text):
            stop = min(at + room, len(text) + 1)
            group.append((i, at, stop))
            room -= stop - at
            at = stop
            if not room:
                yield group
                group, room = [], SLICE_CHARS
    if group:
        yield group


def context_keys(text: str, first: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each order and each character of ``text`` and its end (of those from first to stop): keys of its context, and of context and character."""
    stop = len(text) + 1 if stop is None else stop
    lead = text[max(first - ORDER, 0) : first].rjust(ORDER, "\x02")
    codes = np.frombuffer((lead + text[first:stop] + "\x03" * (stop > len(text))).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - ORDER
    contexts, grams = np.empty((ORDER + 1, n), np.uint64), np.empty((ORDER + 1, n), np.uint64)
    h = np.zeros(n, np.uint64)
    for o in range(ORDER + 1):
        if o:
            h = _mix((h ^ codes[ORDER - o : ORDER - o + n]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(o))
        contexts[o] = _mix(h ^ np.uint64(0x1234567))
        grams[o] = _mix((h + np.uint64(0x7654321ABC)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ codes[ORDER:])
    return contexts.view(np.int64), grams.view(np.int64)


def per_character(texts: list[str], counts: dict[str, np.ndarray], alphabet: int = 256) -> np.ndarray:
    """Log-likelihood a character of ``texts`` under both models (2 x texts): Witten-Bell blend of orders 0..ORDER.
    ``counts``: by key, of a context its total and distinct followers (n, kinds), of a gram how often it stood (n)."""
    order = np.argsort(counts["key"], kind="stable")
    known = counts["key"][order]

    def find(keys: np.ndarray, name: str) -> np.ndarray:
        if not len(known):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, counts[name][order][at], 0)

    sizes = np.array([len(t) + 1 for t in texts])
    out = np.zeros((2, len(texts)))
    for group in slices(texts):
        contexts, grams = (np.concatenate(x, axis=1) for x in zip(*(context_keys(texts[i], *span) for i, *span in group), strict=True))
        lengths = np.array([stop - first for _, first, stop in group])
        owner = [i for i, _, _ in group]  # a text has one slice a group
        for k in (0, 1):
            p = np.full(contexts.shape[1], 1.0 / alphabet)
            for o in range(ORDER + 1):
                n, t, c = find(contexts[o], f"n{k}"), find(contexts[o], f"kinds{k}"), find(grams[o], f"n{k}")
                p = np.where(n > 0, (c + t * p) / np.maximum(n + t, 1), p)
            out[k, owner] += np.add.reduceat(np.log(p), np.cumsum(lengths) - lengths)
    return out / sizes


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(accepted, context, gram, n): how often a character followed a context; partial sums of a batch."""
    for batch in batches:
        rows = [*zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
        for kind in (False, True):
            own = [(t, n) for t, accepted, n in rows if accepted == kind]
            for group in slices([t for t, _ in own]):
                keys = [(*context_keys(own[i][0], *span), own[i][1]) for i, *span in group]
                context = np.concatenate([c.ravel() for c, _, _ in keys])
                gram = np.concatenate([g.ravel() for _, g, _ in keys])
                weight = np.concatenate([np.full(c.size, n) for c, _, n in keys])
                found, at, back = np.unique(gram, return_index=True, return_inverse=True)  # a gram has one context
                n = np.bincount(back, weight).astype(np.int64)
                columns = [pa.array(np.full(len(found), kind, np.int32)), pa.array(context[at]), pa.array(found), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["accepted", "context", "gram", "n"])


def counting_tasks(chars: int, partitions: int) -> int:
    """Tasks that count ``chars`` characters: enough to keep the cluster busy, each with a bounded share."""
    least, most = COUNT_CHARS
    return max(1, min(-(-chars // least), max(partitions, -(-chars // most))))


def fit(settled: DataFrame) -> DataFrame | None:
    """Counts (key, n0, kinds0, n1, kinds1) of rejected and accepted from (text, accepted) rows; None without rows of both kinds."""
    rows = settled.groupBy("text", "accepted").agg(F.count("*").alias("n"))
    chars = [r["chars"] for r in rows.groupBy("accepted").agg(F.sum(F.length("text") + 1).alias("chars")).collect()]  # at most two rows
    if len(chars) < 2:
        return None
    tasks = counting_tasks(sum(chars), input_partitions(settled.sparkSession))
    # a character makes twelve keys, so the few bytes of the texts do not tell Spark the work
    grams = rows.repartition(tasks, "text", "accepted").select("text", "accepted", "n").mapInArrow(_count_grams, "accepted int, context long, gram long, n long")
    pairs = materialise(grams.groupBy("accepted", "context", "gram").agg(F.sum("n").alias("n")), "grams")
    own = lambda k, x: F.coalesce(F.sum(F.when(F.col("accepted") == k, x)), F.lit(0))
    sums = [f(k) for k in (0, 1) for f in (lambda k: own(k, F.col("n")).alias(f"n{k}"), lambda k: own(k, F.lit(1)).alias(f"kinds{k}"))]
    counts = pairs.groupBy(F.col("context").alias("key")).agg(*sums).unionByName(pairs.groupBy(F.col("gram").alias("key")).agg(*sums))
    counts = materialise(counts, "counts")
    release(pairs)
    return counts


def _scored(rows: DataFrame, counts: DataFrame | None) -> DataFrame:
    """``rows`` (with a column block) with a column score: log-likelihood difference per character of the column text."""
    if counts is None:
        return rows.withColumn("score", F.lit(0.0))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[int, set[str]] = {}
            for b, t in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                texts.setdefault(b, set()).add(t)
            for b, own in texts.items():
                own = [*own]
                for group in slices(own):
                    keys = np.unique(np.concatenate([x.ravel() for i, *span in group for x in context_keys(own[i], *span)]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b)), pa.array(keys)], ["block", "key"])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.column("text").to_pylist()
        own = sorted({t for t in texts if t})
        known = {"": 0.0}
        if own:
            low, high = per_character(own, {c: right.column(c).to_numpy() for c in right.column_names if c != "block"})
            known |= dict(zip(own, (high - low).tolist(), strict=True))
        return left.append_column("score", pa.array([known[t] for t in texts], pa.float64()))

    found = rows.where("text <> ''").select("block", "text").mapInArrow(wanted, "block long, key long")
    # sorted, never broadcast: the keys are twelve a character, but Spark takes them for no larger than the URLs' table.
    # a key may come twice, from two batches or slices of a block: once is enough below
    found = found.join(counts.hint("merge"), "key")
    found = found.select("block", *counts.columns)
    schema = ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("score", "double")])
    return rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, schema)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with a column block: neighbouring rows with about BLOCK_CHARS characters of text, or one longer text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, before = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            ends = before + np.cumsum(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            if len(ends):
                before = int(ends[-1])
            yield batch.append_column("block", pa.array(start + ends // BLOCK_CHARS))

    return rows.mapInArrow(deal, ", ".join(f"`{c}` {t}" for c, t in [*rows.dtypes, ("block", "bigint")]))


def calibrate(scored: DataFrame) -> float:
    """Threshold of best balanced accuracy over (score, accepted) rows, from BINS counts of each kind; 0 without rows."""
    b = F.least(F.greatest(F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = np.zeros((2, BINS))
    for r in scored.groupBy(b.alias("bin"), "accepted").count().collect():  # at most 2 * BINS rows
        counts[int(r["accepted"]), r["bin"]] = r["count"]
    if not counts[0].any() or not counts[1].any():
        return 0.0
    passed = 1 - np.concatenate([[0], np.cumsum(counts[1])]) / counts[1].sum()
    stopped = np.concatenate([[0], np.cumsum(counts[0])]) / counts[0].sum()
    good = passed + stopped
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 * (2 * SPAN / BINS) - SPAN)


def judge(pages: DataFrame, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score."""
    ship(pages.sparkSession)
    host, path = parts(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("settled"), F.concat("host", "path").alias("text"))
    rows = materialise(_in_blocks(rows), "urls")  # blocks are drawn once
    settled = rows.where("settled is not null").select("text", (F.col("settled") == "allow").alias("accepted"))
    held_out = F.pmod(F.xxhash64("text"), F.lit(HOLD_OUT)) == 0
    counts = fit(settled.where(~held_out))
    out, threshold = _scored(rows, counts), 0.0
    if counts is not None:
        out = materialise(out, "scored")
        release(rows, counts)
        settled = out.where("settled is not null").select("text", "score", (F.col("settled") == "allow").alias("accepted"))
        threshold = calibrate(settled.where(held_out))
    own = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("settled", own).alias("verdict"), "score")
