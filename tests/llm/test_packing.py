import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crashlake.llm import packing as P

from .conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def check(rows, texts, exact, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r), by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids = np.array([*exact.encode(t or "", add_special_tokens=False).ids, P.END_ID], "<u4")
        at = 0
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == capacity for r in pieces[1:])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] -= n
    return len(gaps)


def gaps_of(plan, counts, capacity):
    """Gaps of the sequences, when every piece is looked up; checks that pieces lie gapless."""
    found = defaultdict(list)
    for length, n in counts.items():
        for s, o in zip(*plan.place(np.full(n, length), np.arange(n)), strict=True):
            found[s].append((o, length))
    assert set(found) == set(range(plan.sequences))
    gaps = []
    for pieces in found.values():
        at = 0
        for o, length in sorted(pieces):
            assert o == at
            at += length
        assert at <= capacity
        gaps.append(capacity - at)
    return sorted(gaps)


def best_fit_gaps(counts, capacity):
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((g for g in gaps if g >= length), default=capacity)
            if fit in gaps:
                gaps.remove(fit)
            gaps.append(fit - length)
    return sorted(gaps)


def test_remainder_of_a_length_is_not_spread():
    counts = {300: 4, 240: 3}
    assert gaps_of(P.Plan(counts), counts, 1024) == best_fit_gaps(counts, 1024) == [4, 124]


def test_gaps_are_those_of_best_fit_decreasing():
    rng = random.Random(11)
    for _ in range(300):
        capacity = rng.choice([1, 7, 64, 100])
        counts = {rng.randint(1, capacity): rng.choice([1, 2, 3, 10, 40]) for _ in range(rng.randint(1, 12))}
        assert gaps_of(P.Plan(counts, capacity), counts, capacity) == best_fit_gaps(counts, capacity), counts


def test_pieces_and_sequences(docs_of, exact, monkeypatch):
    monkeypatch.setattr(P, "RANK_ROWS", 7)
    rng = random.Random(2)
    words = ["the", "année", "Straße", "x1", "  ", "\n", "don't", "привет", "日本", "🙂", "<|endoftext|>", "\x85", "ab" * 30]
    texts = [*ODD_TEXTS, *(" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 9, 40, 400]))) for _ in range(150)), *["same text"] * 60]
    rows = P.pack(docs_of(texts), PATH, capacity=64).collect()
    used = check(rows, texts, exact, 64)
    assert used == best_fit_decreasing([r["length"] for r in rows], 64)


def test_ids_are_those_of_the_tokenizer_file(exact):
    enc = P.encoder(Path(PATH).read_text())
    assert enc.fast is not None
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aZé ß.,!'’\n\t 019€  xs") for _ in range(rng.randint(0, 200)))
        assert enc.ids(text) == exact.encode(text, add_special_tokens=False).ids
    assert enc.ids("a<|endoftext|>b") == exact.encode("a<|endoftext|>b", add_special_tokens=False).ids


def test_plan_is_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.choice([10, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        assert P.Plan(counts, capacity).sequences == best_fit_decreasing(lengths, capacity)


def test_ids_column_repeats_and_empty_table(docs_of):
    rows = P.pack(docs_of([(1, "a b"), (1, "a b"), (None, "c")]), PATH, with_ids=True).collect()
    assert len(rows) == 3 and all(len(r["ids"]) == r["length"] and r["ids"][-1] == P.END_ID for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3
    assert P.pack(docs_of([(0, "a")]).where("false"), PATH).count() == 0


def test_very_long_runs_are_packed(docs_of, exact):
    texts = ["a" + c * 3_000_000 + "b c" for c in " \t\n"] + [" " * 1_200_000, "x" * 1_500_000, "a b " * 100, None, "ab " + "word" * 200_000 + " "]
    rows = P.pack(docs_of(texts), PATH, capacity=1024).collect()
    check(rows, texts, exact, 1024)


def test_blank_runs_around_the_limit(exact):
    enc = P.Encoder(Path(PATH).read_text())
    for n in (P.LONG_BLANK - 1, P.LONG_BLANK, P.LONG_BLANK + 1):
        for text in ("a" + " " * n + "b", "\r\n" * (n // 2) + "\t" * (n % 2), " " * n + "\n a"):
            assert enc.ids(text) == exact.encode(text, add_special_tokens=False).ids
