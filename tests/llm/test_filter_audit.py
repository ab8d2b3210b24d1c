"""Filter audit: every order replayed document by document, odd rows, and the matrices themselves."""

import itertools
import re

import numpy as np
import pytest

from crashlake.llm import filter_audit
from tests.llm.conftest import ODD_TEXTS

LABELS = "doc_id long, quality int, toxic int, lang string"


def brute(docs, labels):
    """Every order replayed on every document."""
    docs = [(i, t or "", lang or "") for i, t, lang in docs]
    rows = []
    for i, t, part in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and u == t for j, u, _ in docs):
            fails.add("E")
        good = any(x[0] == i and x[1] == 1 for x in labels if i is not None)
        toxic = any(x[0] == i and x[2] == 1 for x in labels if i is not None)
        rows.append((part, fails, good, toxic))
    out = set()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley, steps = dict.fromkeys("ABCDE", 0), {}
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for s, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in mine) - len(gone)
                left = [r for r in left if f not in r[1]]
                steps["".join(order), s] = (len(left), len(gone), redundant, sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[f] += len(gone)
        out |= {(part, o, s, *v, shapley[o[s - 1]]) for (o, s), v in steps.items()}
    return out


def frame(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, 1, "x") for i, t, lang in docs], "doc_id long, text string, lang string, mask int, part string")
    return filter_audit.audit(d.repartition(3), spark.createDataFrame([(*x, "q") for x in labels], LABELS))


LONG = " ".join(f"w{i}" for i in range(220))
DOCS = [
    (1, LONG, "en"), (2, LONG, "de"), (2, LONG, "de"), (3, LONG + " #", "en"), (4, "same " * 250, "en"), (5, "SAME " * 250, None),
    (6, LONG.upper() + " $ % &", "en"), (7, "", ""), (8, None, "de"), (None, "", "en"), (None, LONG, "de"), (9, LONG, "en"),
    (10, "ÉÈ " * 300, "en"), (11, "a b\x85c\x1cd " * 200, None), (1, "other", "de"),
]
LABS = [(1, 1, 0), (1, 0, 1), (3, 1, 1), (5, 0, 1), (9, 1, None), (None, 1, 1), (77, 1, 1), (4, None, None)]


def test_equals_every_order_replayed(spark):
    got = [tuple(r) for r in frame(spark, DOCS, LABS).collect()]
    assert len(got) == len(set(got)) == 600 * len({d[2] or "" for d in DOCS})
    assert set(got) == brute(DOCS, LABS)


def test_odd_rows_and_no_labels(spark):
    docs = [(i, t, "en") for i, t in enumerate(ODD_TEXTS)] + [(0, None, None)] * 3 + [(50, "x y " * 40_000, "en")]
    assert {tuple(r) for r in frame(spark, docs, []).collect()} == brute(docs, [])


def test_empty_table(spark):
    out = frame(spark, [], [])
    assert out.count() == 0
    assert out.columns[:3] == ["part", "filter_order", "step"]


def test_long_texts_are_split_into_the_same_words():
    raw = (" ".join(f"w{i % 70_000}" for i in range(400_000))).encode()
    assert len(raw) > 2 * filter_audit._PIECE
    assert filter_audit._words(raw) == (400_000, 70_000)
    assert filter_audit._words(b"x" * (3 << 20)) == (1, 1)
    assert filter_audit._words(b" " * (3 << 20)) == (0, 0)


@pytest.mark.parametrize("k", [1, 2, 4])
def test_min_plus_product_is_the_first_failing_step(k):
    orders = list(itertools.permutations(range(k)))
    masks = np.arange(1 << k)
    step = filter_audit.removal_steps(masks, filter_audit.positions(k, orders))
    for m in masks:
        for j, order in enumerate(orders):
            first = next((s for s, f in enumerate(order, 1) if m >> f & 1), k + 1)
            assert step[m, j] == first
