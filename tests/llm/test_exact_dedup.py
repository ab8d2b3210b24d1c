from collections import defaultdict

from crashlake.llm import exact_dedup as D

from .conftest import ODD_TEXTS


def expect(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    key = lambda i: (i is not None, i)
    out = []
    for ids in groups.values():
        top = max(ids, key=key)
        rest = sorted(ids, key=key)[:-1]
        out += [(top, top, len(ids), True)] + [(i, top, len(ids), False) for i in rest]
    return sorted(out, key=str)


def rows_of(df):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()], key=str)


def test_hashes_compose():
    data = bytes(range(256)) * 900
    whole = [0, 0]
    for at in range(0, len(data), D.CHUNK_BYTES):
        h = D.chunk_hash(data[at : at + D.CHUNK_BYTES])
        whole = [(whole[i] * h[2 + i] + h[i]) % D.PRIMES[i] for i in (0, 1)]
    for i in (0, 1):
        value = 0
        for b in data:
            value = (value * D.POINTS[i] + b + 1) % D.PRIMES[i]
        assert value == whole[i]


def test_groups_with_odd_and_long_texts(docs_of):
    long = "é" * 40000 + "x" * 90000
    rows = [*enumerate([*ODD_TEXTS, long, long, long[:-1] + "y", "a b c", "a b c"]), (3, "a"), (None, "a"), (None, "zz")]
    assert rows_of(D.deduplicate(docs_of(rows))) == expect(rows)


def test_colliding_fingerprints_are_told_apart(docs_of, monkeypatch):
    same = lambda batches: (b for b in _constant(batches))
    monkeypatch.setattr(D, "_hash_batches", same)
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "bb"), (5, "cc"), (6, "dddd"), (2, "bb")]
    assert rows_of(D.deduplicate(docs_of(rows))) == expect(rows)


def _constant(batches):
    import pyarrow as pa

    for b in batches:
        names = [c for c in b.schema.names if c != "data"]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in names), *([pa.array([1] * b.num_rows, pa.int64())] * 4)], [*names, "h1", "h2", "s1", "s2"]
        )


def test_keep_one_keeps_columns_and_one_row_of_repeats(docs_of):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "q"), (5, "z" * 70000), (6, "z" * 70000)]
    docs = docs_of(rows)
    out = D.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted([(r["doc_id"], (r["text"] or "")[:3]) for r in out.collect()], key=str) == sorted(
        [(2, "a"), (4, ""), (None, "q"), (6, "zzz")], key=str
    )


def test_empty_table(docs_of):
    assert D.deduplicate(docs_of([(0, "a")]).where("false")).count() == 0
