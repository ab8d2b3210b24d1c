import random

import numpy as np

from crashlake.llm import cotrain as C

from .conftest import ODD_TEXTS

WORDS = "the of and tion ing house water reed stone light river green wind".split()


def corpus(n, seed=0):
    rng = random.Random(seed)
    texts, good = [], []
    for _ in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(20, 120))]
        kind = rng.random()
        good.append(int(kind > 0.3))
        if kind < 0.1:
            texts.append(" ".join(w.upper() + "!!" for w in words))
        elif kind < 0.2:
            texts.append(" | ".join(words))
        elif kind < 0.3:
            texts.append(" ".join(w + rng.choice(["%%%", "***", "$$$"]) for w in words))
        else:
            texts.append(". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, len(words), 9)) + ".")
    return texts, good


def test_held_out_accuracy_and_pseudo_labels(docs_of, spark):
    texts, good = corpus(900)
    labels = spark.createDataFrame([(i, good[i], 0) for i in range(300)] + [(299, 1, 0), (5000, 0, 0), (None, 0, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = C.score(docs_of(texts), labels).collect()
    assert len(rows) == 900
    test = [r for r in rows if r["doc_id"] >= 300]
    right = lambda c: np.mean([(r[c] >= 0.5) == good[r["doc_id"]] for r in test])
    assert right("score") > 0.97 and right("p_text") > 0.9 and right("p_meta") > 0.85
    assert all(r["accepted"] == (r["score"] >= C.ACCEPT) for r in rows)


def test_keep_good_scores_like_the_query_and_keeps_columns(docs_of, spark):
    texts, good = corpus(300, 1)
    rows = [*enumerate(texts), *((1000 + i, t) for i, t in enumerate(ODD_TEXTS)), (None, texts[0]), (3, texts[3])]
    docs = docs_of(rows)
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")
    kept = C.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = sorted(str(r["doc_id"]) for r in C.score(docs, labels).collect() if r["accepted"])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_without_labels_or_with_one_kind_everything_stays(docs_of, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    only = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    docs = docs_of(corpus(60)[0])
    for labels in (none, only):
        assert {(r["score"], r["accepted"]) for r in C.score(docs, labels).collect()} == {(1.0, True)}
    assert C.score(docs.where("false"), only).count() == 0


def test_sample_of_labels_is_bounded(docs_of, spark, monkeypatch):
    monkeypatch.setattr(C, "LABELLED", 100)
    texts, good = corpus(600, 2)
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")
    _, rows = C.fit(docs_of(texts), labels)
    assert 40 < rows.where("y is not null").count() <= 140


def test_views_of_odd_values():
    tokens = C.Tokens()
    for text in (b"", b" \n", b"\x00\xff" * 10, b"A!!" * 1000):
        assert C.text_view(text, tokens).shape == (C.TEXT_DIM,)
        for n in (None, -5, 0, 10**12):
            assert C.meta_view(text, None, None, n).shape == (C.META_DIM,)
    assert C._shape(b"ONHA!!%%12ab") == b"A!%0a"


def test_very_long_texts_are_read_whole(docs_of, spark):
    texts, good = corpus(60)
    long = (texts[0] + " ") * 20_000
    docs = docs_of([*enumerate(texts), (500, long), (501, long + (texts[1] + " ") * 20_000)])
    got = {r["doc_id"]: r["score"] for r in C.score(docs, spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")).collect()}
    assert len(got) == 62 and all(0 <= x <= 1 for x in got.values())
    tokens = C.Tokens()
    assert (C.text_view(long.encode(), tokens) != C.text_view((long + (texts[1] + " ") * 20_000).encode(), tokens)).any()
