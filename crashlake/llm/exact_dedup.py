"""Exact duplicates by composable polynomial fingerprints.

The fingerprint of a text is its UTF-8 bytes read as a polynomial modulo two
31-bit primes, with the byte length. It composes: if ``A`` and ``B`` have hashes
``a`` and ``b``, the hash of ``AB`` is ``a * x^len(B) + b``. Texts up to
``CHUNK_BYTES`` are hashed where they are read. Longer ones are cut into chunks that
are dealt over the cluster, hashed in parallel and folded together by that rule.

Texts with equal fingerprints are then compared with their group's representative,
chunk by chunk, in a join that Spark can split when one group is huge. Rows that
differ from the representative (a hash collision) are grouped by their whole text
instead, so the result never rests on the hash.

Results for odd input: null text counts as empty; empty texts are copies of each
other; repeated rows (same id and text) are copies, one of which stays; a null id
is smaller than any other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, input_partitions, materialise, release, text_or_empty

CHUNK_BYTES = 1 << 16
#: Two 31-bit primes and the points at which the text polynomial is taken.
PRIMES = (2147483629, 2147483587)
POINTS = (1000003, 916132831)

_powers: dict[int, np.ndarray] = {}


def powers(i: int) -> np.ndarray:
    """x^0 ... x^CHUNK_BYTES modulo the i-th prime."""
    if i not in _powers:
        p, table = PRIMES[i], np.ones(1, np.uint64)
        while len(table) <= CHUNK_BYTES:
            step = np.uint64(pow(POINTS[i], len(table), p))
            table = np.concatenate([table, table * step % np.uint64(p)])
        _powers[i] = table
    return _powers[i]


def chunk_hash(data: bytes) -> tuple[int, int, int, int]:
    """(hash, hash, shift, shift) of at most CHUNK_BYTES bytes; shift is x^len."""
    codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(codes)
    out = [int(np.dot(codes, powers(i)[:n][::-1]) % np.uint64(PRIMES[i])) for i in (0, 1)]
    return out[0], out[1], int(powers(0)[n]), int(powers(1)[n])


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [chunk_hash(memoryview(x.as_buffer())) if x.is_valid else (0, 0, 1, 1) for x in batch.column("data")]
        keep = [batch.column(c) for c in batch.schema.names if c != "data"]
        hashes = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(
            [*keep, *hashes], [*[c for c in batch.schema.names if c != "data"], "h1", "h2", "s1", "s2"]
        )


def _chunked() -> Column:
    """Rows (position, chunk) of the binary column data; an empty text has one empty chunk."""
    count = F.greatest(F.ceil(F.length("data") / CHUNK_BYTES).cast("int"), F.lit(1))
    piece = lambda i: F.substring(F.col("data"), i * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
    return F.posexplode(F.transform(F.sequence(F.lit(0), count - 1), piece))


def _fold(chunks: Column, i: int) -> Column:
    """Length-shifted composition of the chunk hashes, in order."""
    h, s, p = f"h{i + 1}", f"s{i + 1}", F.lit(PRIMES[i]).cast("long")
    return F.aggregate(chunks, F.lit(0).cast("long"), lambda acc, c: (acc * c[s] + c[h]) % p)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, h1, h2, n_bytes, text_sha256) of every row, written once. uid tells rows apart within this table."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    rows = rows.select("doc_id", "data", F.length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("text_sha256"))
    schema = "doc_id long, n_bytes long, text_sha256 string, h1 long, h2 long, s1 long, s2 long"
    short = rows.where(F.col("n_bytes") <= CHUNK_BYTES).select("doc_id", "n_bytes", "text_sha256", "data")
    short = short.mapInArrow(_hash_batches, schema).drop("s1", "s2")

    # long texts: chunks are dealt out, hashed in parallel, and folded by row
    cut = rows.where(F.col("n_bytes") > CHUNK_BYTES).withColumn("row", F.expr("uuid()"))
    cut = cut.select("row", "doc_id", "n_bytes", "text_sha256", _chunked().alias("chunk", "data"))
    stored = materialise(cut, "chunks")  # before it is dealt out: uuid() must not be drawn again if a task is repeated
    dealt = stored.repartition(input_partitions(docs.sparkSession), "row", "chunk")
    hashed = dealt.mapInArrow(_hash_batches, f"row string, doc_id long, n_bytes long, text_sha256 string, chunk int, {schema.split('string, ')[1]}")
    part = F.struct("chunk", "h1", "s1", "h2", "s2")
    folded = hashed.groupBy("row", "doc_id", "n_bytes", "text_sha256").agg(F.sort_array(F.collect_list(part)).alias("c"))
    folded = folded.select("doc_id", "n_bytes", "text_sha256", _fold(F.col("c"), 0).alias("h1"), _fold(F.col("c"), 1).alias("h2"))
    both = short.unionByName(folded).withColumn("uid", F.monotonically_increasing_id())
    out = materialise(both, "fingerprints")
    release(stored)
    return out


_FP = ["h1", "h2", "n_bytes"]


def _differing(docs: DataFrame, prints: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, fingerprint) of rows whose text differs from their group's representative: normally none."""
    found = prints.join(groups.select(*_FP, "top_id"), _FP).select("doc_id", "text_sha256", *_FP, "top_id")
    # one row per id and digest; not by fingerprint, so that the join above can be split where one fingerprint is hot
    found = found.dropDuplicates(["doc_id", "text_sha256"])
    texts = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    texts = texts.withColumn("text_sha256", F.sha2("data", 256))
    # the text of a row is found again by its id and its own digest, so repeated ids do not mix
    match = texts.alias("t").join(
        found.alias("f"),
        F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("t.text_sha256") == F.col("f.text_sha256")),
    )
    members = match.select("f.doc_id", "f.text_sha256", *[f"f.{c}" for c in _FP], "f.top_id", _chunked().alias("chunk", "data"))
    chunks = materialise(members, "members")
    model = (
        chunks.where(F.col("doc_id").eqNullSafe(F.col("top_id")))
        .groupBy(*_FP, "chunk")
        .agg(F.min("data").alias("model"))
    )
    model = materialise(model, "models")  # apart from the join, so that a group with many copies can be split there
    compared = chunks.select("doc_id", "text_sha256", *_FP, "chunk", "data").join(model, [*_FP, "chunk"], "left")
    unlike = compared.where(~F.col("data").eqNullSafe(F.col("model"))).select("doc_id", "text_sha256", *_FP).distinct()
    out = materialise(unlike, "differing")
    release(chunks, model)
    return out


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Of equal texts the row with the largest id stays.
    """
    prints = fingerprints(docs, id_col, text_col)
    best = F.max(F.struct("doc_id", "uid"))
    groups = materialise(
        prints.groupBy(*_FP).agg(F.count("*").alias("group_size"), best.alias("top")).where("group_size > 1")
        .select(*_FP, "group_size", F.col("top.doc_id").alias("top_id"), F.col("top.uid").alias("top_uid")),
        "groups",
    )
    differing = _differing(docs, prints, groups, id_col, text_col)

    own = prints.join(groups, _FP, "left")
    out = own.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("top_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("top_uid").isNull() | (F.col("uid") == F.col("top_uid"))).alias("kept"),
        "text_sha256",
        "n_bytes",
        *[F.col(c).alias(f"_{c}") for c in _FP[:2]],
        F.col("uid").alias("_uid"),
    )
    if differing.isEmpty():
        return out.drop("_h1", "_h2", "_uid")
    # collisions: every row of an affected fingerprint is grouped by its whole text instead
    hit = differing.select(*_FP).distinct()
    rest = out.join(hit.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "n_bytes"), ["_h1", "_h2", "n_bytes"], "left_anti")
    texts = id_and_text(docs, id_col, text_col).withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    affected = prints.join(hit, _FP, "left_semi").select("doc_id", "uid", "text_sha256", "n_bytes").alias("p")
    distinct_text = texts.dropDuplicates(["doc_id", "text_sha256", "text"]).alias("t")
    full = affected.join(
        distinct_text, F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.text_sha256") == F.col("t.text_sha256"))
    ).select("p.*", "t.text")
    same = Window.partitionBy("text")
    full = full.withColumn("top", F.max(F.struct("doc_id", "uid")).over(same)).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), F.count("*").over(same).alias("group_size"),
        (F.col("uid") == F.col("top.uid")).alias("kept"), "text_sha256", "n_bytes",
    )
    return rest.drop("_h1", "_h2", "_uid").unionByName(full)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = materialise(deduplicate(docs, id_col, text_col).select("doc_id", "keep_id", "text_sha256"), "found")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = found.where(~stays).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_gone")).distinct()
    own_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.withColumn("_sha", F.sha2(text_or_empty(text_col).cast("binary"), 256))
    # merged at every size: both sides grow with the corpus
    rows = rows.join(gone.hint("merge"), own_id.eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_gone")), "left_anti")
    again = found.where(stays).groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    again = materialise(again.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_again")), "again")
    if again.isEmpty():
        return rows.drop("_sha")
    # rows that repeat an id and its text: one of them stays
    match = own_id.eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_again"))
    once = rows.join(again, match, "left_semi").dropDuplicates([id_col, "_sha"])
    return rows.join(again, match, "left_anti").unionByName(once).drop("_sha")
