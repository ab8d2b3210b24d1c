"""Exact Jaccard self-join on word shingles by T-occurrence search (DivideSkip).

Two sets of sizes n and m reach a Jaccard similarity of ``t`` percent exactly when they
share at least T = ceil(t (n + m) / (100 + t)) elements. DivideSkip finds the sets that
share T elements with a query: of the query's inverted lists the longest L are set aside,
the short ones are merged and counted, sets with fewer than T - L hits are skipped, and
the long lists are only probed, by binary search, for the sets still alive.

On a cluster the lists cannot live in one place, so sets that can reach T are first brought
together. Linked sets of at most ``hi`` elements differ in at most d, so if the elements are
dealt into some d parts by a hash, many parts are untouched by the differences, and hold the
same elements in both sets. The hash of a part with at least m elements is a signature; sets
that share one, directly or through others, form a cell. The number of parts, m, and how often
the deal is repeated are chosen for each size so that a linked pair misses its cell with a
chance of at most ``MISS`` (as for the 64-bit hashes below); m keeps passages that many
documents share from making signatures by themselves. Sets so small that at most two elements
may differ are signed by their subsets without one or two elements; where no deal is good
enough there are d + 1 parts and some spare, of which a linked pair always shares one.
Signatures of only one set are dropped by a partially aggregated count. A signature proves no
link, so a template that many documents share can chain them into one large cell. Cells of many
blocks are therefore split by the prefix principle: with the elements of a cell in one order,
rare ones first, linked sets share one of the first n - ceil(t n / 100) + 1 of each. The order is
taken from a block of the cell (any order is right, a good one is cheap), and sets that share
such an element, directly or through others, form the smaller cells. Within a cell the sets
meet in bounded blocks: every pair of blocks is one unit of work, with its own inverted lists,
so a cell of any size is spread over tasks.

Equal sets are one class from the start, so copies cost one row, and the result is one row per
document with its component and its number of links. Elements are 64-bit hashes of shingles;
classes of equal sets are told apart by 128 bits.

Results for odd input: null, empty or blank text has no shingles, and is linked with nothing;
fewer words than ``width`` make one shingle; repeated rows are copies; a row with a null id is
linked like any other but never names a component (component_id is null if all its rows lack
ids); an empty table gives no rows; the shingles of a text of any length all count, and are made in
one task; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, id_and_text, input_partitions, materialise

#: Elements of the sets in one block of a cell, about.
BLOCK_ELEMENTS = 150_000
#: Cells of at least as many blocks are split by rare elements before their blocks are paired.
SPLIT_FROM = 4
#: Blocks that share one copy of the sample which orders a cell's elements.
BLOCKS_PER_SAMPLE = 64
#: Cost of a binary probe against the cost of a merged entry, for the choice of L.
PROBE_COST = 0.5
#: Chance that a linked pair shares no signature, at most.
MISS = 1e-12
#: Most elements that a part must hold to be a signature.
MOST_IN_PART = 3
#: Words that a task remembers the hash of.
WORD_CACHE = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Bijective 64-bit mixing of an array."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, width: int, words: Words) -> np.ndarray:
    """Sorted distinct shingle hashes. Words are runs of other than ASCII space; only A-Z are lower-cased."""
    hashes = np.array([words[w] for w in text.lower().split()], np.uint64)
    if not len(hashes):
        return hashes
    n = max(len(hashes) - width + 1, 1)
    span = min(width, len(hashes))
    h = np.full(n, np.uint64(span))
    for k in range(span):
        h = mix(h ^ hashes[k : k + n], k + 1)
    return np.unique(h)


def needed(n, m, percent: int):
    """Least overlap at which sets of n and m elements link."""
    return -(-percent * (n + m) // (100 + percent))


def levels(n: int, percent: int) -> list[tuple[int, int]]:
    """(level, largest size that may meet there): the size's own level and the next, whose sizes it can still link with."""
    level, hi = 0, 1
    while hi < n:
        level, hi = level + 1, max(hi + 1, hi * 100 // percent)
    return [(level, hi), (level + 1, max(hi + 1, hi * 100 // percent))]


def _at_least(mean: float, m: int) -> float:
    """Chance of m or more, Poisson."""
    term, below = math.exp(-mean), 0.0
    for i in range(m):
        below, term = below + term, term * mean / (i + 1)
    return 1 - below


@lru_cache(maxsize=None)
def scheme(hi: int, percent: int) -> tuple[str, int, int, int]:
    """How sets of one level are signed: (kind, parts, least elements of a part, rounds or spare parts)."""
    d = (100 - percent) * 2 * hi // (100 + percent)  # |x - y| + |y - x| of a linked pair
    if d <= 2:
        return ("subsets", d, 0, 0)
    low = max(1, hi * percent * percent // 10000)  # about the smallest set of the level

    def miss(k: int, m: int) -> float:
        """Chance that no part of k is untouched by a pair's differences and holds m of its common elements."""
        worst = 0.0
        for n in (low, hi):
            apart, common = (100 - percent) * 2 * n / (100 + percent), percent * 2 * n / (100 + percent)
            worst = max(worst, (1 - (1 - 1 / k) ** apart * _at_least(common / k, m)) ** k)
        return worst

    for m in range(MOST_IN_PART, 1, -1):
        found = []
        for k in range(3, d + 3, max(1, d // 60)):
            q = miss(k, m)
            if q < 0.9:
                rounds = max(1, math.ceil(math.log(MISS) / math.log(max(q, 1e-300))))
                found.append((rounds * k, k, rounds))
        if found and min(found)[0] <= hi + 60:
            _, k, rounds = min(found)
            return ("parts", k, m, rounds)
    spare = 1  # parts that may be empty without losing a pair
    while spare <= hi // 3 and (more := math.ceil((d + 1 + spare) * math.exp(-low / (d + 1 + spare)))) > spare:
        spare = more
    return ("strict", d + 1 + spare, 1, spare)


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    out = []
    for level, hi in levels(len(s), percent):
        kind, parts, least, rounds = scheme(hi, percent)
        if kind == "subsets":
            if parts:  # else only equal sets link, and those are one class already
                each = mix(s, 92)
                total = each.sum(dtype=np.uint64)
                subsets = [np.array([total]), total - each]
                if parts == 2 and len(s) > 1:
                    i, j = np.triu_indices(len(s), 1)
                    subsets.append(total - each[i] - each[j])
                out.append(mix(np.concatenate(subsets) ^ np.uint64(level + 100), 93))
            continue
        for r in range(rounds if kind == "parts" else 1):
            part = (mix(s, 1000 + r) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            first = np.searchsorted(part[order], np.arange(parts + 1))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(s[order], 92), dtype=np.uint64)])
            sums = sums[first[1:]] - sums[first[:-1]]
            full = first[1:] - first[:-1] >= least
            keys = mix(sums ^ mix(np.arange(parts, dtype=np.uint64), (level + 1) * 1000 + r), 93)
            # of the strict kind, spare + 1 parts agree, so `spare` empty ones may be left out; a set with more keeps them
            out.append(keys[full] if kind == "parts" or parts - full.sum() <= rounds else keys)
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def class_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    a = np.array([mix(s, 94).sum(dtype=np.uint64), mix(s, 95).sum(dtype=np.uint64)]) ^ np.uint64(len(s))
    return tuple(int(x) for x in a.view(np.int64))


def shingled(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, c1, c2, sigs) per row: size and class of its set, and signatures."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sizes, ones, twos, sigs = [], [], [], []
                for text in batch.column(1):
                    s = shingle_set(text.as_py(), width, words)
                    a, b = class_key(s) if len(s) else (0, 0)
                    sizes.append(len(s)), ones.append(a), twos.append(b)
                    sigs.append(signatures(s, percent).view(np.int64) if len(s) else [])
                longs = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, longs), pa.array(ones, longs), pa.array(twos, longs), pa.array(sigs, pa.list_(longs))],
                    ["doc_id", "n", "c1", "c2", "sigs"],
                )

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n long, c1 long, c2 long, sigs array<long>")


def divide_skip(sets: list[np.ndarray], queries: range, against: range, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every query (an index into sets), the indices in ``against`` it links with; later ones only, so each pair once."""
    base = against.start
    sizes = np.array([len(sets[i]) for i in against], np.int64)
    flat = np.concatenate([sets[i] for i in against])
    owner = np.repeat(np.arange(len(against), dtype=np.int32), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]  # inverted lists: runs of equal element, owners ascending
    heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    elements, ends = flat[heads], np.r_[heads[1:], len(flat)]
    for q in queries:
        s = sets[q]
        n = len(s)
        least = needed(n, -(-percent * n // 100), percent)
        at = np.minimum(np.searchsorted(elements, s), len(elements) - 1)
        at = at[elements[at] == s]
        if len(at) < least:
            continue
        at = at[np.argsort(ends[at] - heads[at], kind="stable")]  # short lists first
        longest = int(ends[at[-1]] - heads[at[-1]])
        n_long = min(least - 1, int(least / (PROBE_COST * np.log2(longest + 1) + 1)))
        short, long = at[: len(at) - n_long], at[len(at) - n_long :]
        merged = np.concatenate([owner[heads[k] : ends[k]] for k in short])
        hits = np.bincount(merged, minlength=len(against))
        must = needed(n, sizes, percent)
        alive = np.flatnonzero(hits + n_long >= must)
        alive = alive[alive + base > q]
        hits, must = hits[alive], must[alive]
        for k, entry in enumerate(long):
            if not len(alive):
                break
            members = owner[heads[entry] : ends[entry]]
            found = np.searchsorted(members, alive)
            hits = hits + (members[np.minimum(found, len(members) - 1)] == alive)
            keep = hits + (n_long - k - 1) >= must
            if not keep.all():
                alive, hits, must = alive[keep], hits[keep], must[keep]
        if len(alive):
            yield q, alive + base


def _links(group: list[tuple], percent: int, twin: bool) -> list[tuple]:
    """Rows (a, b, links) of one unit of work: a spanning forest of its links, and (a, null, linked documents) per class.

    group: (cid, copies, side, set) with distinct cids. side 0 against side 0 if the unit is one block, else against side 1.
    """
    group.sort(key=lambda g: (g[2], len(g[3]), g[0]))
    sets = [g[3] for g in group]
    left = sum(g[2] == 0 for g in group)
    queries, against = (range(left), range(left)) if twin else (range(left), range(left, len(group)))
    if not len(queries) or not len(against):
        return []
    parent = list(range(len(group)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    copies = np.array([g[1] for g in group], np.int64)
    linked = np.zeros(len(group), np.int64)
    out = []
    for q, found in divide_skip(sets, queries, against, percent):
        linked[q] += copies[found].sum()
        linked[found] += copies[q]
        for f in found.tolist():
            a, b = find(q), find(f)
            if a != b:
                parent[a] = b
                out.append((group[q][0], group[f][0], 0))
    return out + [(group[i][0], None, int(linked[i])) for i in np.flatnonzero(linked)]


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links), n_links (rows linked with it, copies too)."""
    with Scratch() as scratch:
        whole = scratch.table(shingled(docs, width, percent, id_col, text_col), "shingled")
        rows = scratch.table(whole.drop("sigs"), "sizes")
        classes = rows.where("n > 0").groupBy("c1", "c2").agg(
            F.first("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least")
        )
        cells = _sharing(whole.select(F.col("c1").alias("node"), F.explode("sigs").alias("sig")), scratch, whole)
        members = classes.join(cells.select(F.col("node").alias("c1"), F.col("root").alias("cell")), "c1")
        members = scratch.table(members.withColumn("cid", F.monotonically_increasing_id()), "members")  # cid is drawn once
        # the texts are dealt out once: the sets of all cells are stored, for splitting and for linking
        sets = scratch.table(_sets(members, (docs, width, id_col, text_col)), "sets")
        source = (sets, percent)
        members = _split_cells(members, source, scratch)

        edges = scratch.table(_cell_links(members, source), "links")
        scratch.drop(sets)
        links = edges.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("linked"))
        roots = components(edges.where("b is not null").select("a", "b")).select(F.col("node").alias("cid"), "root")
        known = members.join(roots, "cid", "left").join(links, "cid", "left")
        known = known.select("c1", "c2", F.coalesce("root", "cid").alias("root"), "least", F.coalesce("linked", F.lit(0)).alias("linked"))
        first = known.groupBy("root").agg(F.min("least").alias("component_id"))
        known = known.join(first, "root").select("c1", "c2", "component_id", "linked")
        named = classes.join(known, ["c1", "c2"], "left").select(
            "c1", "c2", "copies", F.when(F.col("linked").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("linked", F.lit(0)).alias("linked"),
        )
        # written, so that the next join shuffles on its own, and a class with many copies can be split
        named = scratch.table(named, "named")
        scratch.drop(edges)
        out = rows.select("doc_id", "n", "c1", "c2").join(named, ["c1", "c2"], "left")
        out = out.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("linked") + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        )
        return scratch.result(out, "near_duplicates")


def _sharing(sigs: DataFrame, scratch: Scratch, stored: DataFrame) -> DataFrame:
    """(node, root) of nodes that share signatures, directly or through others, from (node, sig) read off ``stored``, which goes."""
    # a signature that only one node has goes first
    shared = sigs.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    shared = scratch.table(shared.select("sig", "low"), "shared")
    # merged at every size: both sides grow with the corpus, and Spark can split a signature that is hot
    edges = sigs.join(shared.hint("merge"), "sig").select(F.col("node").alias("a"), F.col("low").alias("b"))
    edges = scratch.table(edges.where("a <> b").distinct(), "cell_edges")
    scratch.drop(stored, shared)
    return components(edges)


def _sizes(members: DataFrame) -> DataFrame:
    """(cell, blocks, in_cell)."""
    return members.groupBy("cell").agg(F.ceil(F.sum("n") / BLOCK_ELEMENTS).cast("int").alias("blocks"), F.count("*").alias("in_cell"))


def _sets(members: DataFrame, source: tuple) -> DataFrame:
    """(c1, c2, elements) of the classes in ``members``."""
    docs, width, id_col, text_col = source
    # the texts that stand for the classes: those of their smallest id (or of any row, for classes without ids)
    wanted = members.select(F.col("least").alias("want")).distinct()
    texts = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    texts = texts.join(wanted.hint("merge"), texts["doc_id"].eqNullSafe(wanted["want"]), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                found = [shingle_set(t.as_py(), width, words) for t in whole.slice(at, 500).column(0)]
                found = [s for s in found if len(s)]
                keys = [class_key(s) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)] + [pa.array([s.tobytes() for s in found], pa.binary())],
                    ["c1", "c2", "elements"],
                )

    return texts.mapInArrow(sets, "c1 long, c2 long, elements binary")


def rare_first(s: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The elements of a set of which any set that links with it, in the same order, has one among its own.

    Order: by count in the sample (``common``, sorted, and its counts; others zero), then by hash.
    """
    seen = np.zeros(len(s), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        seen = np.where(common[at] == s, counts[at], 0)
    # a linked set shares at least percent of the union, so of this set too
    return s[np.lexsort((s, seen))[: len(s) - -(-percent * len(s) // 100) + 1]]


def _split_cells(members: DataFrame, source: tuple, scratch: Scratch) -> DataFrame:
    """``members`` with large cells split into those whose sets share a rare element; sets that share none are alone."""
    sets, percent = source
    large = scratch.table(_sizes(members).where(F.col("blocks") >= SPLIT_FROM).select("cell", "blocks"), "large_cells")
    if large.isEmpty():
        return members
    inside = members.join(large, "cell")
    units = F.ceil(F.col("blocks") / BLOCKS_PER_SAMPLE).cast("int")
    unit = F.pmod(F.xxhash64("cid", F.lit(5)), units).cast("int")
    sample = F.transform(F.sequence(F.lit(0), units - 1), lambda u: F.struct(u.alias("unit"), F.lit(0).alias("side")))
    own = F.array(F.struct(unit.alias("unit"), F.lit(1).alias("side")))
    # one block of the cell is its sample, which every unit gets before its own sets
    to = F.when(F.pmod(F.xxhash64("cid"), F.col("blocks")) == 0, F.concat(sample, own)).otherwise(own)
    rows = sets.join(inside, ["c1", "c2"]).select("cell", "cid", "elements", F.explode(to).alias("to"))
    rows = rows.select("cell", "to.unit", "to.side", "cid", "elements")
    rows = rows.repartition(input_partitions(sets.sparkSession), "cell", "unit").sortWithinPartitions("cell", "unit", "side", "cid")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen, common, counts = None, {}, None, None
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                nodes, sigs = [], []
                columns = [batch.column(k).to_pylist() for k in range(4)]
                for cell, unit, side, cid, elements in zip(*columns, batch.column(4), strict=True):
                    if (cell, unit) != key:
                        key, seen, common = (cell, unit), {}, None
                    s = np.frombuffer(elements.as_py(), np.uint64)
                    if side == 0:
                        seen[cid] = s  # by class: a class may be read off several rows
                        continue
                    if common is None:
                        common, counts = np.unique(np.concatenate([*seen.values(), s[:0]]), return_counts=True)
                        common, counts, seen = common[counts > 1], counts[counts > 1], {}
                    rare = rare_first(s, common, counts, percent)
                    nodes.append(np.full(len(rare), cid, np.int64))
                    sigs.append(mix(rare ^ np.uint64(cell % 2**64), 96).view(np.int64))
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sigs))], ["node", "sig"])

    rare = scratch.table(rows.mapInArrow(prefixes, "node long, sig long"), "rare_elements")
    found = _sharing(rare, scratch, rare).select(F.col("node").alias("cid"), "root")
    of_large = members.join(large.select("cell", F.lit(True).alias("split")), "cell", "left").join(found, "cid", "left")
    # a cell is named by one of its sets from here on (a clash with another cell's name costs work, not links)
    cell = F.when(F.col("split"), F.coalesce("root", "cid")).otherwise(F.col("cell"))
    return scratch.table(of_large.select("c1", "c2", "n", "copies", "least", cell.alias("cell"), "cid"), "split_members")


def _cell_links(members: DataFrame, source: tuple) -> DataFrame:
    """(a, b, links) between classes of one cell, found block pair by block pair."""
    sets, percent = source
    blocks = _sizes(members).where("in_cell > 1")
    placed = members.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = sets.join(placed, ["c1", "c2"])
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "cid", "copies", "elements",
    )
    rows = rows.repartition(input_partitions(sets.sparkSession), "cell", "i", "j").sortWithinPartitions("cell", "i", "j", "cid")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["a", "b", "links"])

        key, group = None, {}
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for cell, i, j, side, cid, copies, elements in zip(*columns, batch.column(6), strict=True):
                if (cell, i, j) != key:
                    if len(group) > 1:
                        out += _links([*group.values()], percent, key[1] == key[2])
                    key, group = (cell, i, j), {}
                group.setdefault(cid, (cid, copies, side, np.frombuffer(elements.as_py(), np.uint64)))
            yield emit(out)
        if len(group) > 1:
            yield emit(_links([*group.values()], percent, key[1] == key[2]))

    return rows.mapInArrow(join, "a long, b long, links long")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the smallest id of every component, in one row.

    Documents without shingles, and rows without an id, are no near copies of anything and stay.
    """
    found = near_duplicates(docs, width, percent, id_col, text_col)
    own_id = F.col(f"`{id_col}`").cast("long")
    gone = found.where("n_shingles > 0 and doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.join(materialise(gone, "gone"), own_id == F.col("_gone"), "left_anti")  # ids only, of a size that Spark knows
    again = found.where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    again = materialise(again.select(F.col("doc_id").alias("_again")), "again")
    if again.isEmpty():
        return rows
    # rows of one id that are near copies of each other: one of them stays
    once = rows.join(again, own_id == F.col("_again"), "left_semi").dropDuplicates([id_col])
    return rows.join(again, own_id == F.col("_again"), "left_anti").unionByName(once)
