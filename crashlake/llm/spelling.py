"""Spelling variants: words one letter apart, found with PartEnum signatures of their letters.

A word's letter multiset is a binary vector over (letter, k-th occurrence). One inserted
or deleted letter changes one coordinate, one replaced letter two, so near words have a
Hamming distance of at most two. PartEnum deals the coordinates into three parts: two
changes leave one part as it is, and a part's projection is an exact signature. As the
edit also touches only one third of the word, each signature is taken together with the
letters outside a third, at both lengths the shorter of two words can have. Near words
share a signature always; signatures are joined by equality, pairs are verified by their
edit distance inside the join, so only verified pairs leave it, and a pair that meets
under several signatures is counted once.

Runs are counted inside the tasks, then by a partially aggregated sum: a run that makes a
third of all words is one row a task. The signature join is a plain equi-join of narrow
rows, which AQE splits where a signature is frequent. Forms are followed by doubling:
each step at least multiplies the count by the ratio, so a handful of joins settles all.

Defined results: null and empty texts hold no words; rows of a null id take part with an
empty id; repeated rows count each; ties between forms go to the smaller word in
code-point order; very long texts and very long runs are taken whole; other columns are
not read, so extra ones cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_and_text

MIN_LETTERS = 7
MIN_COUNT = 2
FORM_RATIO = 10
DELETE_ONE_IN = 31
PARTS = 3  # PartEnum: more parts than the Hamming distance of two
PIECES = 3  # a word in thirds, of which an edit touches one
LONG = 64

_CAPITALS = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_FLUSH = 300_000


def _lower(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_CAPITALS)


def words_of(doc_id: int | None, text: str, min_letters: int = MIN_LETTERS) -> Counter:
    """Words of at least ``min_letters`` and their occurrences; one run in 31, by hash, loses a letter."""
    found: Counter = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    # shorter runs cannot become long enough; maximal runs, as a match takes all letters that follow
    for run, n in Counter(m[0] for m in re.finditer(f"[A-Za-zÀ-ÿ]{{{min_letters},}}", text)).items():
        word = _lower(run)
        h = zlib.crc32(word.encode(), prefix)
        if h % DELETE_ONE_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= min_letters:
            found[word] += n
    return found


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over whole texts, for words of at least ``min_letters`` letters and ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                total.update(words_of(doc_id, text.as_py(), min_letters))
                if len(total) > _FLUSH:
                    yield flushed()
        yield flushed()

    counted = id_and_text(docs).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def parts_of(word: str, parts: int = PARTS) -> list[str]:
    """The letter multiset dealt into parts: coordinate (letter, k-th occurrence) goes to one part, whatever the word."""
    seen: dict[str, int] = {}
    dealt: list[list[str]] = [[] for _ in range(parts)]
    for letter in sorted(word):
        k = seen.get(letter, 0)
        seen[letter] = k + 1
        dealt[(ord(letter) + k) % parts].append(letter)
    # letters are sorted and each part's k-th occurrences are fixed, so the letters tell the projection;
    # occurrences of one letter go to different parts, hence a count per part says which they are
    return ["".join(p) for p in dealt]


def signatures(word: str) -> tuple[list[int], list[int]]:
    """Signatures of the word as the shorter (or equally long) of two near words, and as the longer one."""
    dealt = parts_of(word)
    size = len(word)

    def keys(shorter: int) -> list[int]:
        cuts = [shorter * j // PIECES for j in range(PIECES + 1)]
        out = []
        for j in range(PIECES):
            rest = shorter - cuts[j + 1]
            outside = f"{shorter}.{j}.{word[: cuts[j]]}.{word[size - rest :] if rest else ''}"
            out += [xxhash.xxh64_intdigest(f"{outside}.{i}.{p}") - (1 << 63) for i, p in enumerate(dealt)]
        return out

    return keys(size), keys(size - 1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.int64())
    for b in batches:
        pairs = [signatures(w) for w in b.column("word").to_pylist()]
        columns = [b.column("word"), b.column("n"), pa.array([p[0] for p in pairs], kind), pa.array([p[1] for p in pairs], kind)]
        yield pa.record_batch(columns, names=["word", "n", "shorter", "longer"])


def one_apart(a: str, b: str) -> bool:
    """Does one inserted, deleted or replaced code point tell the two apart? Linear, by binary search for the first difference."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)  # a[:low] is common
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):  # the words may be very long
            b = batch.slice(at, 64)
            ok = [one_apart(x.as_py(), y.as_py()) for x, y in zip(b.column("a"), b.column("b"))]
            yield b.filter(pa.array(ok, pa.bool_()))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) with a < b: every two words of (word, n) that one inserted, deleted or replaced letter tells apart.

    Pairs with a word of more than LONG letters leave the join unverified and are verified in linear time after it:
    the built-in edit distance takes quadratic time, whatever its threshold.
    """
    signed = words.mapInArrow(_sign, "word string, n long, shorter array<long>, longer array<long>")

    def met(rows: DataFrame, verified: Column) -> DataFrame:
        sides = [rows.select(F.explode(side).alias("key"), F.lit(side == "longer").alias("longer"), "word", "n") for side in ("shorter", "longer")]
        both = sides[0].unionByName(sides[1])
        a = both.select("key", F.col("longer").alias("a_longer"), F.col("word").alias("a"), F.col("n").alias("a_n"))
        b = both.select(F.col("key").alias("b_key"), F.col("longer").alias("b_longer"), F.col("word").alias("b"), F.col("n").alias("b_n"))
        same = (F.col("key") == F.col("b_key")) & (F.col("a") < F.col("b")) & ~(F.col("a_longer") & F.col("b_longer"))
        return a.join(b.hint("merge"), same & verified).select("a", "a_n", "b", "b_n")

    size = F.length("word")
    usual = met(signed.where(size <= LONG), F.levenshtein("a", "b", 1) == 1)
    rare = met(signed.where(size >= LONG), F.greatest(F.length("a"), F.length("b")) > LONG)
    rare = rare.mapInArrow(_verify, rare.schema)
    return usual.unionByName(rare).distinct()


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) for the words of (word, form): each step looks twice as far ahead."""
    at = scratch.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = scratch.table(further, "roots")
        scratch.drop(at)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        at = step


def variants(docs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """Every word with its near words' number, its usual form (a near word ``ratio`` times as frequent) and the form at the end."""
    with Scratch() as scratch:
        words = scratch.table(word_counts(docs), "words")
        pairs = near_pairs(words)
        both = F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
        )
        near = pairs.select(F.inline(both)).groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other"))).alias("top")
        )
        usual = -F.col("top.m") >= ratio * F.col("n")
        graded = scratch.table(
            words.join(near, "word", "left").select(
                "word",
                F.when(usual, F.col("top.other")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(usual, -F.col("top.m")).alias("form_n"),
            ),
            "graded",
        )
        roots = _roots(scratch, graded.where("form IS NOT NULL"))
        out = graded.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return scratch.result(out, "variants")
