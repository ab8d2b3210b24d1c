import random
import re

import numpy as np
import pytest

from crashlake.llm import ngram_join as J

from .conftest import ODD_TEXTS


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1)))


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                near[i].append(j), near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j), todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None, len(near[i])))
    return sorted(out, key=str)


def got(df, width, percent):
    return sorted([tuple(r) for r in J.near_duplicates(df, width, percent).collect()], key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(80)]
    passage = [rng.choice(vocab) for _ in range(30)]
    rows = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 12, 25, 60, 150]))]
        if rng.random() < 0.3:
            base += passage
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append(copy + ["end"] * rng.choice([0, 0, 1]))
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("width,percent,block", [(3, 90, 150_000), (3, 90, 60), (5, 80, 200), (2, 60, 100)])
def test_against_brute_force(docs_of, monkeypatch, width, percent, block):
    monkeypatch.setattr(J, "BLOCK_ELEMENTS", block)
    rows = corpus(block + width)
    rows += [(10_000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, rows[5][1]), (None, "only null ids here"), (7, rows[7][1]), (8, rows[40][1]), (20_000, rows[7][1])]
    assert got(docs_of(rows), width, percent) == brute(rows, width, percent)


def test_one_large_group_of_near_copies(docs_of):
    rng = random.Random(1)
    base = [f"v{i}" for i in range(90)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.choice([1, 2])):
            words[rng.randrange(90)] = f"x{i}"
        rows.append((i, " ".join(words)))
    assert got(docs_of(rows), 3, 90) == brute(rows, 3, 90)


def test_signatures_of_linked_sets_always_meet():
    rng = np.random.default_rng(5)
    for percent in (90, 80, 60):
        for _ in range(3000):
            n = int(rng.integers(1, rng.choice([12, 40, 120, 900])))
            x = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) < (0.5 + percent / 200 - 0.02)], rng.integers(0, 1 << 60, int(rng.integers(0, 1 + n // 12))).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if len(y) and both >= J.needed(len(x), len(y), percent) and both < max(len(x), len(y)):
                assert len(np.intersect1d(J.signatures(x, percent), J.signatures(y, percent)))


def test_empty_table(docs_of):
    assert J.near_duplicates(docs_of([(0, "a")]).where("false")).count() == 0


def template_corpus(n, links=()):
    """``n`` documents of 200 words, half of them one template: no two link, but for ``links`` (pairs of equal ends)."""
    rng = random.Random(n)
    template = [f"t{i}" for i in range(100)]
    rows = [(i, [*template, *(f"d{i}x{rng.randrange(1 << 30)}" for _ in range(100))]) for i in range(n)]
    for a, b in links:
        rows[b] = (b, [*rows[a][1][:199], f"end{b}"])
    return [(i, " ".join(w)) for i, w in rows]


def test_template_shared_by_many_documents_is_not_compared_in_pairs(docs_of, spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ELEMENTS", 4000)
    compared = []
    links = J._cell_links

    def counted(members, source):
        sizes = J._sizes(members).where("in_cell > 1").collect()
        compared.append((sum(r["in_cell"] ** 2 for r in sizes), max((r["blocks"] for r in sizes), default=0)))
        return links(members, source)

    monkeypatch.setattr(J, "_cell_links", counted)
    for n in (500, 2000):
        rows = template_corpus(n, links=[(3, 5), (5, 400), (17, 18)])
        found = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in J.near_duplicates(docs_of(rows), 5, 80).collect()}
        want = {i: (i, 0) for i, _ in rows} | {3: (3, 2), 5: (3, 2), 400: (3, 2), 17: (17, 1), 18: (17, 1)}
        assert found == want
    (few, one), (many, same) = compared
    assert one == same == 1 and few <= 8 * 500 and many <= 8 * 2000


def test_linked_sets_share_a_rare_element_in_any_order():
    rng = np.random.default_rng(9)
    for percent in (90, 80, 60):
        for _ in range(2000):
            n = int(rng.integers(1, rng.choice([4, 40, 300])))
            x = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) < (0.5 + percent / 200)], rng.integers(0, 1 << 60, int(rng.integers(0, 1 + n // 10))).astype(np.uint64)]))
            common = np.sort(rng.choice(x, int(rng.integers(0, len(x) + 1)), replace=False))
            counts = rng.integers(2, 9, len(common))
            if len(y) and len(np.intersect1d(x, y)) >= J.needed(len(x), len(y), percent):
                assert len(np.intersect1d(J.rare_first(x, common, counts, percent), J.rare_first(y, common, counts, percent)))


def test_scratch_tables_go_but_for_the_result(docs_of, spark):
    from pathlib import Path

    from crashlake.config import scratch_path

    base = Path(scratch_path(spark, "probe").removeprefix("file:")).parents[1]
    tables = lambda: {p for p in base.glob("*/*")} if base.exists() else set()
    before = tables()
    out = J.near_duplicates(docs_of(corpus(3)), 3, 90)
    left = sorted(p.name for p in tables() - before)
    assert out.count() and left.count("near_duplicates") == 1
    assert not {"shingled", "sizes", "shared", "cell_edges", "members", "links", "named"} & set(left)


def test_texts_are_dealt_out_once_for_splitting_and_linking(docs_of, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ELEMENTS", 4000)
    calls = {"_sets": 0, "_split_cells": 0}

    def counted(name, f):
        def run(*args):
            calls[name] += 1
            return f(*args)

        monkeypatch.setattr(J, name, run)

    counted("_sets", J._sets)
    counted("_split_cells", J._split_cells)
    rows = template_corpus(300, links=[(3, 5)])
    found = {r["doc_id"]: r["component_id"] for r in J.near_duplicates(docs_of(rows), 5, 80).collect()}
    assert found == {i: 3 if i == 5 else i for i, _ in rows}
    assert calls == {"_sets": 1, "_split_cells": 1}
