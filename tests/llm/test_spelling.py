"""Spelling variants: against all pairs of words, and PartEnum's promise on random edits."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from crashlake.llm import spelling
from tests.llm.conftest import ODD_TEXTS


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = top if top is not None and n[top] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def edited(rng, word, letters="abcdeé×ÿ"):
    k, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:k] + ("" if kind == 1 else rng.choice(letters)) + word[k + (kind != 0) :]


def corpus(seed, n_docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeé", k=rng.randint(7, 10))) for _ in range(25)]
    # chains of forms: each word ten times rarer than its near word
    chain = ["mississippi", "mississipp", "mississpp", "misisspp"]
    rows = []
    for i in range(n_docs):
        words = [rng.choice(base) if rng.random() < 0.8 else edited(rng, rng.choice(base)) for _ in range(120)]
        words += [w.upper() if rng.random() < 0.3 else w for w in words[:20]]
        rows.append((i * 7, (rng.choice([" ", "-", "9", "\n"])).join(words)))
    for k, w in enumerate(chain):
        rows.append((10_000 + k, " ".join([w] * (2 * 10 ** (3 - k)))))
    return rows


def result(docs):
    return [tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_equals_all_pairs(docs_of):
    for seed in (1, 2):
        rows = corpus(seed)
        got = result(docs_of(rows))
        assert len(got) == len(set(got))
        assert set(got) == brute(rows)
        assert any(r[1] and r[2] != r[1] for r in got)  # a chain of more than one step


def test_odd_rows(docs_of):
    long_run = "abcdefgh" * 20_000
    rows = [*enumerate(ODD_TEXTS), (None, "lettered Lettered lettere"), (None, "lettered"), (3, "lettere lettere")]
    rows += [(100, long_run), (101, long_run[:-1] + " " + long_run), (102, long_run[:-1])] + [(200, "repeated rowwise")] * 5
    assert set(result(docs_of(rows))) == brute(rows)


def test_empty_table(docs_of):
    assert result(docs_of([])) == []
    assert result(docs_of([None, "", "short words only"])) == []


@settings(max_examples=300, deadline=None)
@given(st.text("abcàÿ×z", min_size=7, max_size=14), st.integers(0, 10**9))
def test_near_words_share_a_signature(word, seed):
    other = edited(random.Random(seed), word, "abcàÿ×z")
    short, long = sorted((word, other), key=len)
    if short == long or len(short) < 6:
        return
    theirs = spelling.signatures(long)[len(long) - len(short)]
    assert set(spelling.signatures(short)[0]) & set(theirs)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=9), st.text("ab", max_size=9))
def test_one_apart(a, b):
    assert spelling.one_apart(a, b) == one_apart(a, b)


def test_words_around_the_long_limit(docs_of):
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefgh", k=spelling.LONG + 3))
    words = [base[:k] for k in range(spelling.LONG - 3, len(base) + 1)]
    words += [edited(rng, w) for w in words for _ in range(3)]
    rows = [(i, " ".join(words)) for i in range(4)]
    assert set(result(docs_of(rows))) == brute(rows)


def test_two_changed_coordinates_leave_a_part():
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choices("abcdef", k=rng.randint(3, 12)))
        a, b = spelling.parts_of(word), spelling.parts_of(edited(rng, word))
        assert any(x == y for x, y in zip(a, b))


def test_neighbours_leave_the_join_once_verified(spark):
    words = [(f"prefix{chr(97 + i)}suffix", i + 2) for i in range(20)] + [("prefixsuffix", 5), ("unrelated", 3)]
    pairs = spelling.near_pairs(spark.createDataFrame(words, "word string, n long")).collect()
    assert len(pairs) == 20 * 19 // 2 + 20
    assert len({(p["a"], p["b"]) for p in pairs}) == len(pairs)
