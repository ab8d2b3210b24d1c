"""Repeated passages, removed byte by byte, found with induced suffix arrays of shards.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in the
same document or another. Shards are made so that equal strings of that length meet:

1. Equal texts are one text with a number of copies; if that is two or more, all of its
   strings are repeated.
2. Each string has an anchor, its GRAM-byte substring of least hash (the leftmost of
   equals). Equal strings have equal anchors at equal distances. Strings in a row with one
   anchor form a piece, a few hundred bytes long (where a pattern repeats without a break,
   strings in a row whose anchors are equal).
3. Anchors that occur once in the table cannot hold a repeated string. The pieces of the
   others are cut out of the texts, equal pieces of one anchor are counted together, and
   pieces are dealt to shards of bounded size by their anchor.
4. A shard's pieces, joined by a byte that UTF-8 never uses, get a suffix array by induced
   sorting and its permuted common prefixes (:mod:`suffix_array`): a string is repeated if
   it shares LENGTH bytes with the suffix before it or after it in the array, or if its
   piece occurs twice. As strings of different anchors differ, a shard that the deal made
   larger than meant is sorted in parts of whole anchors, one after the other: sorting takes
   about a hundred bytes of memory a byte.
5. Repeated ranges go back to the texts, and the results of texts to their documents.

An anchor with very many different pieces (a passage in a third of all documents, each
time in other surroundings) is split, in rounds, until no shard is larger than the bound:
its strings are parted by their distance to the anchor, and each half is dealt by the
bytes that all its strings have in common. A half of one distance is dealt by its whole
string, so the split always ends, and equal strings stay together throughout. Groups are
pre-aggregated before every shuffle; nothing is gathered but a shard and the anchors or
ranges of one text.

Defined results: null and empty texts have 0 bytes, nothing removed and the digest of the
empty string; texts shorter than LENGTH are left alone; rows of equal text, repeated rows
and null ids included, are each a document of its own, so all their strings are repeated;
matches neither cross documents nor use what is left after a removal; very long texts are
scanned block by block. Columns not named are not read. An empty table gives no rows.
Texts and pieces are told apart by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_and_text
from .suffix_array import permuted_common_prefixes, suffix_array

LENGTH = 200
GRAM = 64  # long enough that chance seldom repeats it in prose
DIVIDER = 0xFF
RUN = 1024
SHARD_BYTES = 1 << 18  # a shard sorts fastest where its lists stay in the cache
SHARD_PIECES = 4096
_BLOCK = 1 << 18  # numbers of a block stay in the cache
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every GRAM bytes (a power of two): polynomial, by doubling."""
    h, step = _BYTE[data], 1
    while step < GRAM:
        h = h[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + h[step:]
        step *= 2
    return _mixed(h)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Place of the anchor of the string of ``length`` bytes at each place, and the hashes of all grams."""
    h = _gram_hashes(data)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    grams, step = length - GRAM + 1, 1
    while 2 * step <= grams:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = grams - step
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return (least & _PLACE).astype(np.int64), h


def pieces_of(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, one_anchor: bool = False) -> tuple[np.ndarray, ...]:
    """(text, hash, anchor, first, last, anchors) of the pieces of concatenated texts that begin at ``starts`` (with the end, last).

    ``first`` and ``last`` are the places of the first and last string of the piece, ``anchor`` is that of the first.
    Places are those in ``data``; ``anchors`` is 1, or 2 if there are more. Where a pattern repeats without a break, anchors of one hash follow each other
    closely; their strings share pieces of up to RUN strings, unless ``one_anchor`` is asked for.
    """
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    place, h = anchors(data, length)
    at = np.arange(len(place))
    text = np.searchsorted(starts, at, "right") - 1
    inside = at + length <= starts[text + 1]
    new = np.ones(len(at), bool)
    other = place if one_anchor else h[place]
    new[1:] = (other[1:] != other[:-1]) | ~inside[:-1]
    if not one_anchor:
        new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % RUN == 0
    first = np.flatnonzero(new & inside)
    ends = np.append(np.flatnonzero(new[1:] | ~inside[1:]), len(at) - 1) if len(at) > 1 else np.array([0])
    last = ends[np.searchsorted(ends, first)]
    return text[first], h[place[first]].view(np.int64), place[first], first, last, 1 + (place[last] > place[first])


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Texts joined into arrays of about a block, long ones in blocks that overlap by a string: (data, starts, (text, offset))."""
    parts: list[bytes] = []
    named: list[tuple[int, int]] = []
    size = 0

    def joined():
        starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return np.frombuffer(b"".join(parts), np.uint8), starts, list(named)

    for i, raw in enumerate(texts):
        if len(raw) < length:
            continue
        for offset in range(0, len(raw) - length + 1, _BLOCK):
            part = raw[offset : offset + _BLOCK + length - 1]
            parts.append(part)
            named.append((i, offset))
            size += len(part)
            if size >= _BLOCK:
                yield joined()
                parts, named, size = [], [], 0
    if parts:
        yield joined()


def _find_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("tid").to_numpy()
            for rows in range(0, b.num_rows, 512):  # so that few long texts are copied at a time
                texts = [t.as_py().encode() for t in b.column("text").slice(rows, 512)]
                for data, starts, named in _blocks(texts, length):
                    text, h, place, first, last, count = pieces_of(data, starts, length)
                    which = np.array([i for i, _ in named])[text] + rows
                    shift = np.array([o for _, o in named])[text] - starts[text]
                    first, last, place = first + shift, last + shift, place + shift
                    packed = first << 24 | (place - first) << 12 | (last - first)  # distances below 2^12: LENGTH and RUN
                    yield pa.record_batch([pa.array(c) for c in (h, ids[which], packed, count.astype(np.int8))], names=["key", "tid", "packed", "anchors"])

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                raw, tid = b.column("text")[row].as_py().encode(), b.column("tid")[row].as_py()
                found = b.column("found")[row].values
                key, packed = found.field("key").to_numpy(), found.field("packed").to_numpy()
                first = packed >> 24
                anchor, last = first + (packed >> 12 & 0xFFF), first + (packed & 0xFFF)
                for k in range(0, len(key), 4096):
                    part = slice(k, k + 4096)
                    yield _batch(
                        key[part], [tid] * len(key[part]), first[part], anchor[part] - first[part],
                        np.zeros(len(key[part]), np.int64), np.full(len(key[part]), length - GRAM, np.int64),
                        [raw[f : e + length] for f, e in zip(first[part].tolist(), last[part].tolist())],
                    )

    return run


_PIECES = "key long, tid long, at long, anchor long, low long, high long, piece_id binary, piece binary"


def _batch(key, tid, at, anchor, low, high, pieces: list[bytes]) -> pa.RecordBatch:
    """Piece rows: ``at`` in the text, the anchor's place in the piece, least and greatest distance of its strings to the anchor."""
    numbers = [pa.array(c, pa.int64()) for c in (key, tid, at, anchor, low, high)]
    digests = [hashlib.sha256(p).digest()[:16] for p in pieces]
    return pa.record_batch([*numbers, pa.array(digests, pa.binary()), pa.array(pieces, pa.binary())], names=[c.split()[0] for c in _PIECES.split(", ")])


def halves(key: int, at: int, anchor: int, low: int, high: int, piece: bytes, length: int = LENGTH) -> list[tuple]:
    """The piece's strings parted by their distance to the anchor, dealt by the bytes that all strings of a half have in common."""
    mid = (low + high + 1) // 2
    out = []
    for a, b in ((low, mid - 1), (mid, high)) if low < high else ((low, high),):
        # strings start at anchor - distance, for distances a to b
        first, last = max(anchor - b, 0), min(anchor - a, len(piece) - length)
        if first > last:
            continue
        common = piece[anchor - a : anchor - b + length]
        new = xxhash.xxh64_intdigest(b"%d.%d.%d." % (key, a, b) + common) - (1 << 63)
        out.append((new, at + first, anchor - first, a, b, piece[first : last + length]))
    return out


def _single(row: dict, length: int) -> list[tuple[int, int, bytes]]:
    """(place in the piece, anchor, bytes) of the parts of a piece that have one anchor; only pieces not split yet have more."""
    piece = row["piece"]
    if (row["low"], row["high"]) != (0, length - GRAM):
        return [(0, row["anchor"], piece)]
    _, _, anchor, first, last, _ = pieces_of(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]), length, one_anchor=True)
    return [(f, p - f, piece[f : e + length]) for p, f, e in zip(anchor.tolist(), first.tolist(), last.tolist())]


def _split(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for at, anchor, piece in _single(r, length):
                    rows += [(h[0], r["tid"], *h[1:]) for h in halves(r["key"], r["at"] + at, anchor, r["low"], r["high"], piece, length)]
                if len(rows) >= 4096:
                    yield _batch(*map(list, zip(*rows)))
                    rows = []
            if rows:
                yield _batch(*map(list, zip(*rows)))

    return run


def _whole_anchors(table: pa.Table, most: int) -> Iterator[pa.Table]:
    """The shard in parts of whole anchors, each of at most ``most`` bytes of pieces or of one anchor."""
    size = pc.binary_length(table.column("piece")).to_numpy().astype(np.int64)
    if size.sum() <= most:
        yield table
        return
    key = table.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    key, size, table = key[order], size[order], table.take(pa.array(order))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    begin, held = 0, 0
    for at, n in zip(first.tolist(), np.add.reduceat(size, first).tolist()):
        if held and held + n > most:
            yield table.slice(begin, at - begin)
            begin, held = at, 0
        held += n
    yield table.slice(begin)


def _sort_shard(length: int, most: int):
    def run(table: pa.Table) -> pa.Table:
        return pa.concat_tables([_sort_part(part, length) for part in _whole_anchors(table, most)])

    return run


def _sort_part(table: pa.Table, length: int) -> pa.Table:
    """Byte ranges of the pieces that repeated strings cover: (key, piece_id, from_byte, to_byte)."""
    pieces = [p.as_py() for p in table.column("piece")]
    data = np.frombuffer(bytes([DIVIDER]).join(pieces) + bytes([DIVIDER]), np.uint8)
    size = np.array([len(p) for p in pieces])
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    sa = suffix_array(np.append(data.astype(np.int64) + 1, 0), 257)
    before, common = permuted_common_prefixes(data, sa)
    hit = common >= length
    repeated = hit.copy()
    repeated[before[hit]] = True
    often = table.column("n").to_numpy() >= 2
    kind = np.repeat(np.arange(len(pieces)), size + 1)
    place = np.arange(len(data)) - begin[kind]
    string = place + length <= size[kind]  # inside the piece
    repeated = string & (repeated | often[kind])
    # runs of repeated strings, as byte ranges of their piece
    new = repeated & ~np.concatenate(([False], repeated[:-1]))
    end = repeated & ~np.concatenate((repeated[1:], [False]))
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    which = pa.array(kind[first])
    return pa.table(
        {"key": table.column("key").take(which), "piece_id": table.column("piece_id").take(which),
         "from_byte": pa.array(place[first]), "to_byte": pa.array(place[last] + length)}
    )


def remove(raw: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of the bytes, and the number of maximal removed runs."""
    kept, at, spans, end = [], 0, 0, -1
    for a, b in sorted(ranges):
        if a > end:
            spans += 1
            kept.append(raw[at:a])
            end = b
        end = max(end, b)
        at = max(at, b)
    kept.append(raw[at:])
    return b"".join(kept), spans


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for k in range(b.num_rows):
            raw = b.column("text")[k].as_py().encode()
            found = b.column("found")[k].values
            left, spans = remove(raw, list(zip(found.field("from_byte").to_pylist(), found.field("to_byte").to_pylist())))
            rows.append((len(raw) - len(left), spans, hashlib.sha256(left).hexdigest()))
        removed, spans, digest = zip(*rows) if rows else ((), (), ())
        columns = [b.column("tid"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
        yield pa.record_batch(columns, names=["tid", "n_removed", "n_spans", "kept_sha256"])


def repeated_ranges(scratch: Scratch, texts: DataFrame, length: int = LENGTH, most: int = SHARD_PIECES) -> DataFrame:
    """(tid, from_byte, to_byte): byte ranges of the different ``texts`` (tid, text) that repeated strings cover."""
    found = scratch.table(texts.mapInArrow(_find_pieces(length), "key long, tid long, packed long, anchors byte"), "pieces_found")
    again = found.groupBy("key").agg(F.sum("anchors").alias("n")).where("n > 1").select("key")
    rows = found.join(again.hint("merge"), "key", "left_semi")
    live = scratch.table(rows.select("key", "tid", "packed"), "pieces_live")
    scratch.drop(found)
    by_text = live.groupBy("tid").agg(F.collect_list(F.struct("key", "packed")).alias("found"))
    pieces = scratch.table(texts.join(by_text.hint("merge"), "tid").select("tid", "text", "found").mapInArrow(_cut(length), _PIECES), "pieces")
    scratch.drop(live)
    settled = []
    while True:
        large = pieces.select("key", "piece_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
        large = scratch.table(large.select("key"), "large_keys")
        if large.isEmpty():
            settled.append(pieces)
            break
        settled.append(pieces.join(large.hint("merge"), "key", "left_anti"))
        pieces = scratch.table(pieces.join(large.hint("merge"), "key", "left_semi").select(*pieces.columns).mapInArrow(_split(length), _PIECES), "split_pieces")
    parts = settled[0].select("key", "tid", "at", "piece_id", "piece")
    for more in settled[1:]:
        parts = parts.unionByName(more.select(*parts.columns))
    different = scratch.table(parts.groupBy("key", "piece_id").agg(F.first("piece").alias("piece"), F.count(F.lit(1)).alias("n")), "different")
    total = different.agg(F.sum(F.length("piece").cast("long"))).head()[0] or 0
    shards = 1 + int(total // SHARD_BYTES)
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    ranges = scratch.table(
        different.select(shard, "key", "piece_id", "piece", "n").groupBy("shard")
        .applyInArrow(_sort_shard(length, 2 * SHARD_BYTES), "key long, piece_id binary, from_byte long, to_byte long"),
        "ranges",
    )
    placed = parts.select("key", "tid", "at", "piece_id").join(ranges.hint("merge"), ["key", "piece_id"])
    return placed.select("tid", (F.col("at") + F.col("from_byte")).alias("from_byte"), (F.col("at") + F.col("to_byte")).alias("to_byte"))


def dedup(docs: DataFrame, length: int = LENGTH, most: int = SHARD_PIECES) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs and the digest of what is left."""
    base = id_and_text(docs).withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    size = F.octet_length("text").cast("long")
    with Scratch() as scratch:
        texts = scratch.table(
            base.groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
            .withColumn("tid", F.monotonically_increasing_id()).withColumn("n_bytes", size),
            "texts",
        )
        long_enough = texts.where(F.col("n_bytes") >= length)
        ranges = repeated_ranges(scratch, long_enough.select("tid", "text"), length, most)
        by_text = ranges.groupBy("tid").agg(F.collect_list(F.struct("from_byte", "to_byte")).alias("found"))
        once = long_enough.where("copies = 1").select("tid", "text").join(by_text.hint("merge"), "tid")
        partly = scratch.table(once.mapInArrow(_finish, "tid long, n_removed long, n_spans long, kept_sha256 string"), "partly")
        whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
        results = texts.select("tid", "digest", "copies", "n_bytes").join(partly.hint("merge"), "tid", "left").select(
            "digest",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        )
        results = scratch.table(results, "results")
        out = base.select("doc_id", "digest").join(results.hint("merge"), "digest")
        return scratch.result(out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), "deduplicated")
