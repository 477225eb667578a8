"""Similarity classes against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations, permutations

import pytest

from clearledger.llm import jaccard


def brute(rows, n, percent):
    def shingles(text):
        w = [x.translate(LOWER) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((top(a), top(b)))
            root[hi] = lo
    return {d: (len(s), top(d)) for d, s in sets.items()}


LOWER = {i: i + 32 for i in range(65, 91)}


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ä", "B", "b"]
    texts = [None, "", " \t\n", "one", "One", "one two", "one  two\n", "B b", "b B"]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 9, 11, 30, 80, 200]))] for _ in range(14)]
    while len(texts) < n:
        base = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            at = rng.randrange(len(base))
            base[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
        texts.append(" ".join(base))
        if rng.random() < 0.3:
            bases.append(base)  # chains of copies of copies
    return list(enumerate(texts, start=5))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_classes_equal_all_pairs(spark, n, percent):
    rows = corpus(n)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similarity_classes(docs, n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, n, percent)
    assert len(got) == len(rows)


def test_given_tables_equal_all_pairs(spark, small):
    from clearledger.llm.queries import op3_jaccard

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op3_jaccard(spark, small).collect()}
    assert got == brute(rows, 3, 90)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, id long, key long")
    assert jaccard.similarity_classes(empty).count() == 0
    rows = [(1, "a b c d e f", 7), (1, "a b c d e f", 7), (2, "A b c d e f", 7), (None, "a b c d e f", 7), (3, "x " * 5000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in jaccard.similarity_classes(docs).collect())
    assert got == [("1", "1"), ("1", "1"), ("2", "1"), ("3", "3"), ("None", "None")]


def test_distance_never_exceeds_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(50):
        x = rng.integers(0, 2**63, 200, np.uint64)
        y = np.concatenate([x[: rng.integers(0, 200)], rng.integers(0, 2**63, 20, np.uint64)])
        apart = np.bitwise_count(jaccard.parity_sketch(x, 5) ^ jaccard.parity_sketch(y, 5)).sum()
        assert apart <= len(np.setxor1d(x, y))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_order_of_short_texts_counts(spark, n, percent):
    said = [" ".join(p) for k in (1, 2, 3, 4) for p in permutations(["foo", "bar", "Baz", "foo"][:k])]
    rows = list(enumerate(said + ["FOO bar", "bar  foo", "foo foo", "foo", "foo bar baz foo"], start=1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similarity_classes(docs, n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, n, percent)


def test_unlike_words_with_equal_sums_do_not_link(spark):
    pair = ["".join(first if bin(i).count("1") % 2 == 0 else second for i in range(1_024)) for first, second in ("ab", "ba")]
    docs = spark.createDataFrame([(i, f"one two {w} three") for i, w in enumerate(pair)], "doc_id long, text string")
    got = jaccard.similarity_classes(docs, n=3, percent=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {0: (2, 0), 1: (2, 1)}


def test_sets_that_share_half_a_digest(spark):
    rows = [(1, 7, 1, 3), (2, 7, 2, 3), (3, 8, 1, 3), (4, 8, 1, 3)]
    assert jaccard.shared_ids(spark.createDataFrame(rows, "doc long, id long, other long, n_shingles long")) == {7}
    linked = jaccard.Linked(3, 90)
    a, b = linked.set_of(b"one two three"), linked.set_of(b"four five six")
    first, second = jaccard._halves(a)
    apart = jaccard.Linked(3, 90, shared=frozenset([first]))
    assert linked.id_of(a) == first and apart.id_of(a) == second
    assert apart.id_of(b) == linked.id_of(b) == jaccard._halves(b)[0]


def test_rows_of_a_key_carry_narrow_sketches(spark):
    linked = jaccard.Linked(5, 80)
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(size))) for i, size in enumerate((8, 300, 3000))]
    rows = jaccard.sketches_of(spark.createDataFrame(texts, "id long, text string"), linked).collect()
    assert len(rows) == 6
    for r in rows:
        whole = linked.bands.words(r.pair) * 8
        assert len(r.sketch) % 8 == 0 and len(r.sketch) <= max(whole / 8 + 8, 32)


def test_pairs_about_the_limit_equal_all_pairs(spark):
    """Texts with common stretches, which meet in keys, some just above the limit and some just below."""
    n, percent = 5, 80
    rng = random.Random(n)
    bases = [[f"b{b}w{i}" for i in range(240)] for b in range(5)]
    texts = []
    for base in bases:
        for changes in [*range(14)] * 2:
            words = list(base)
            for at in rng.sample(range(len(words)), changes):
                words[at] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(words))
        texts += [" ".join(base[:k] + [f"tail{rng.randrange(10**6)}" for _ in range(240 - k)]) for k in (60, 120, 180, 215, 225)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similarity_classes(docs, n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, n, percent)
