"""Repeated passages: suffix arrays against sorting, the operator against a dictionary of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crashlake.llm import suffix_array, suffix_dedup
from tests.llm.conftest import ODD_TEXTS


def sorted_suffixes(raw):
    return sorted(range(len(raw) + 1), key=lambda i: raw[i:])


@pytest.mark.parametrize("bucket", [1, 10**9])
@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=40), st.sampled_from([1, 2, 3, 256]), st.integers(1, 4))
def test_suffix_array_and_prefixes(bucket, raw, symbols, times):
    raw = bytes(c % symbols for c in raw) * times
    data = np.frombuffer(raw, np.uint8)
    t, k = np.append(data.astype(np.int64) + 1, 0), 257
    before = suffix_array.BUCKET
    suffix_array.BUCKET = bucket if bucket > 1 else 1e-9  # place by place, or bucket by bucket on every level
    try:
        sa = suffix_array.suffix_array(t, k)
    finally:
        suffix_array.BUCKET = before
    assert sa.tolist() == sorted_suffixes(raw)
    previous, common = suffix_array.permuted_common_prefixes(data, sa)
    for i in range(len(raw)):
        j, m = previous[i], 0
        while j >= 0 and max(i, j) + m < len(raw) and raw[i + m] == raw[j + m]:
            m += 1
        assert common[i] == m


def brute(rows, length=200):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(raw[k : k + length] for _, raw in raws for k in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        left = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def result(docs, **kwargs):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return Counter(tuple(r) for r in suffix_dedup.dedup(docs, **kwargs).select(*columns).collect())


def prose(rng, n, letters="abcdefgh éß"):
    return "".join(rng.choices(letters, k=n))


def corpus(seed):
    rng = random.Random(seed)
    passage, other = prose(rng, 420), prose(rng, 230)
    rows = []
    for i in range(40):
        text = prose(rng, rng.randint(50, 900))
        if i % 3 == 0:
            text = prose(rng, rng.randint(0, 120)) + passage[rng.randint(0, 30) : 400 - rng.randint(0, 60)] + text
        if i % 5 == 0:
            text += other[: rng.randint(190, 230)]
        rows.append((i, text))
    # near copies, copies, a text that repeats itself, runs of one symbol, exactly 199, 200 and 201 bytes in common
    rows += [(100 + k, rows[k][1][: 100 * k] + "X" + rows[k][1][100 * k + 1 :]) for k in range(8)]
    rows += [(120, rows[1][1]), (121, rows[1][1]), (130, passage[:250] + "|" + passage[:250]), (131, "z" * 500), (132, "z" * 199), (133, "q" * 201)]
    for k, n in enumerate((199, 200, 201)):
        same = prose(rng, n, "klmnop")
        rows += [(140 + k, prose(rng, 100) + same + "."), (150 + k, same + "!" + prose(rng, 300))]
    return rows


@pytest.mark.parametrize("most", [suffix_dedup.SHARD_PIECES, 2])
def test_equals_all_strings(docs_of, most):
    rows = corpus(most)
    assert result(docs_of(rows), most=most) == brute(rows)


def test_many_shards_give_the_same(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    rows = corpus(7)
    assert result(docs_of(rows)) == brute(rows)


def test_a_large_shard_is_sorted_in_parts(monkeypatch):
    rng = random.Random(11)
    rows = []
    for key in range(12):
        same = prose(rng, 230, "abcdefgh").encode()
        pieces = [prose(rng, 300, "abcdefgh").encode() for _ in range(20 if key else 200)] + [b"<" + same, same + b">"]
        rows += [(key, b"%d.%d" % (key, k), piece, 1 + (k == 3)) for k, piece in enumerate(pieces)]
    rng.shuffle(rows)
    shard = pa.table(dict(zip(("key", "piece_id", "piece", "n"), map(list, zip(*rows)))))
    sizes = []
    array = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda t, k: sizes.append(len(t)) or array(t, k))
    got = suffix_dedup._sort_shard(200, 20_000)(shard)
    of_one = sum(len(piece) + 1 for key, _, piece, _ in rows if key == 0)
    assert len(sizes) > 3 and sorted(sizes)[-1] <= of_one + 1 and sorted(sizes)[-2] <= 20_200
    expected = Counter({(key, b"%d.3" % key, 0, 300): 1 for key in range(12)})
    for key in range(12):
        n = 20 if key else 200
        expected[key, b"%d.%d" % (key, n), 1, 231] = expected[key, b"%d.%d" % (key, n + 1), 0, 230] = 1
    assert Counter(zip(*(c.to_pylist() for c in got.columns))) == expected


def test_odd_rows(docs_of):
    rows = [*enumerate(ODD_TEXTS), (None, "x" * 4000), (None, "long enough " * 30), (None, "long enough " * 30), (7, None), (7, None)]
    rows += [(9, "row " * 100)] * 3
    assert result(docs_of(rows)) == brute(rows)


def test_empty_table(docs_of):
    assert result(docs_of([])) == Counter()


def test_texts_longer_than_a_block(docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 1000)
    rng = random.Random(4)
    shared = prose(rng, 1500)
    rows = [(1, prose(rng, 3000) + shared + prose(rng, 2345)), (2, shared[300:] + prose(rng, 4000)), (3, prose(rng, 5000))]
    whole = np.frombuffer(rows[0][1].encode(), np.uint8)
    places, hashes = suffix_dedup.anchors(whole)
    covered = []
    for data, starts, named in suffix_dedup._blocks([rows[0][1].encode()], 200):
        text, _, place, first, last, _ = suffix_dedup.pieces_of(data, starts, 200)
        shift = np.array([o for _, o in named])[text] - starts[text]
        for f, e, p in zip(first + shift, last + shift, place + shift):
            assert places[f] == p and (hashes[places[f : e + 1]] == hashes[p]).all()
            covered += range(f, e + 1)
    assert covered == list(range(len(whole) - 199))
    assert result(docs_of(rows)) == brute(rows)


def test_a_megabyte_of_one_byte(docs_of):
    got = result(docs_of([(1, " " * 1_500_000), (2, "a" + " " * 300 + "b")]))
    empty, ab = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"ab").hexdigest()
    assert got == Counter([(1, 1_500_000, 1_500_000, 1, empty), (2, 302, 300, 1, ab)])


def test_splitting_ends_at_single_strings():
    rng = random.Random(1)
    piece = prose(rng, 360, "ab").encode()[:335]
    rows = [(5, 0, 135, 0, 136, piece)]
    for _ in range(9):
        rows = [h for r in rows for h in suffix_dedup.halves(*r)]
    assert all(r[3] == r[4] and len(r[5]) == 200 for r in rows)
    assert sorted(r[1] for r in rows) == list(range(0, 136))


def test_repeated_patterns_make_few_pieces():
    data = np.frombuffer(b"abc" * 20_000, np.uint8)
    assert len(suffix_dedup.pieces_of(data, np.array([0, len(data)]))[0]) < 100
    assert len(suffix_dedup.pieces_of(data, np.array([0, len(data)]), one_anchor=True)[0]) > 19_000


def test_repeated_patterns_are_split_too(docs_of):
    rng = random.Random(8)
    rows = [(k, prose(rng, 30) + "=" * rng.randint(190, 260) + prose(rng, 30) + "ab " * 90 + str(k)) for k in range(30)]
    assert result(docs_of(rows), most=3) == brute(rows)
