"""Removal of repeated text against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from clearledger.llm import anchors, substrings
from clearledger.llm.suffixes import common, deep_shallow, longest


def runs(gone):
    return sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))


def brute_bytes(rows, window):
    times = {}
    for _, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - window + 1):
            times[raw[i : i + window]] = times.get(raw[i : i + window], 0) + 1
    out = {}
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if times[raw[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), runs(gone), hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, window):
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, d), d)
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone[i : i + window] = b"\1" * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "é", "abc", "x", "lorem", "ipsum", "dolor", "ab"]
    make = lambda k: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(k))
    passages = [make(rng.choice([8, 15, 20, 40])) for _ in range(8)]
    texts = [None, "", "a", "aaaa" * 200, "ab " * 150, "ab " * 80, " \n", make(300)]
    while len(texts) < n:
        parts = [make(rng.randrange(12))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = sorted(rng.sample(range(len(p)), 2)) if rng.random() < 0.4 else (0, len(p))
            parts += [p[slice(*cut)], make(rng.randrange(6))]
        texts.append(rng.choice([" ", "\n"]).join(parts))
        if rng.random() < 0.15:
            texts.append(texts[-1])
        if rng.random() < 0.15:
            t = texts[-1]
            at = rng.randrange(len(t) or 1)
            texts.append(t[:at] + "#" + t[at + 1 :])
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def got_bytes(df):
    return {
        r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
        for r in df.collect()
    }


def got_words(df):
    return {
        r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest())
        for r in df.collect()
    }


@pytest.mark.parametrize(("seed", "limit"), [(1, 20_000), (2, 2)])
def test_bytes_equal_brute_force(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(substrings, "GROUP_ROWS", limit)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_bytes(substrings.remove_repeated_bytes(docs, window=40, gram=8)) == brute_bytes(rows, 40)


@pytest.mark.parametrize(("seed", "limit"), [(3, 20_000), (4, 2)])
def test_words_equal_brute_force(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(substrings, "GROUP_ROWS", limit)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_words(substrings.remove_earlier_windows(docs, window=9, gram=3)) == brute_words(rows, 9)


def test_pieces_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 64)
    rows = corpus(5, 60)
    import numpy as np

    for _, t in rows:  # every window belongs to one anchor, whatever the pieces
        raw = np.frombuffer((t or "").encode(), np.uint8).astype(np.uint64)
        bounds = np.array([0, len(raw)])
        seen = [s + j for _, start, _, n, _, _, _ in anchors.anchored(raw, bounds, 40, 8) for s, k in zip(start, n, strict=True) for j in range(k)]
        assert sorted(seen) == list(range(max(0, len(raw) - 39)))


def test_given_tables(spark, small):
    from clearledger.llm.queries import op1_suffix_array, op7_suffix_tree

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    one = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1_suffix_array(spark, small).collect()}
    assert one == brute_bytes(rows, 400)
    seven = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op7_suffix_tree(spark, small).collect()}
    assert seven == brute_words(rows, 50)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, doc long, spans long")
    assert substrings.remove_repeated_bytes(empty).count() == substrings.remove_earlier_windows(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(None, text, 1), (1, text, 1), (2, text, 1), (3, text + " x", 1)], "doc_id long, text string, spans long")
    bytes_ = {r.doc_id: len(r.spans) for r in substrings.remove_repeated_bytes(docs).collect()}
    assert bytes_ == {None: 0, 1: 1, 2: 1, 3: 1}
    words = {r.doc_id: r.kept for r in substrings.remove_earlier_windows(docs).collect()}
    assert words == {None: text, 1: text, 2: "", 3: "x"}


def alternating(first, second, n=1_024):
    """Words whose sums of powers of any odd base are equal modulo 2**64 when the letters change places."""
    return "".join(first if bin(i).count("1") % 2 == 0 else second for i in range(n))


def test_unlike_stretches_with_equal_sums_stay(spark):
    ahead, behind = (" ".join(f"{c}{i}" for i in range(30)) for c in "vw")
    docs = [(i, f"{ahead} {alternating(*pair)} {behind}") for i, pair in enumerate(("ab", "ba"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: len(r.spans) for r in substrings.remove_earlier_windows(df).collect()} == {0: 0, 1: 0}
    middle = "".join(random.Random(1).choices("9f", k=64))
    docs = [(i, alternating(*pair, 256) + middle + alternating(*pair, 256)) for i, pair in enumerate(("9f", "f9"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: len(r.spans) for r in substrings.remove_repeated_bytes(df).collect()} == {0: 0, 1: 0}


def test_rows_that_share_an_id(spark):
    rng = random.Random(8)
    a, b = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(130)) for _ in range(2))
    docs = [(1, a), (1, b), (2, a), (1, b[:300] + "x" + b[300:]), (3, b), (3, b)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.kept) for r in substrings.remove_earlier_windows(df).collect())
    assert got == sorted([(1, a), (1, b), (2, ""), (1, docs[3][1]), (3, ""), (3, "")])
    alone = spark.createDataFrame(docs[:3], "doc_id long, text string")
    got = sorted((r.doc_id, bytes(r.kept).decode()) for r in substrings.remove_repeated_bytes(alone).collect())
    assert got == sorted([(1, ""), (1, b), (2, "")])


@pytest.mark.parametrize("words", [50, 60, 80])
def test_passages_around_the_length(spark, words):
    """Passages of 50 to 80 words are under or over 400 bytes: bytes go by 400, words by 50."""
    rng = random.Random(words)
    make = lambda k, n: " ".join("".join(rng.choices("abcdefghijkl", k=n)) for _ in range(k))
    passages = [make(words, n) for n in (4, 5, 6, 7)] + [make(70, 6)[:n] for n in (398, 399, 400, 401)]
    rows = [(i, f"{make(20, 7)} {p} {make(20, 7)}") for i, p in enumerate(p for p in passages for _ in range(2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = got_bytes(substrings.remove_repeated_bytes(docs))
    assert one == brute_bytes(rows, 400)
    for i, p in enumerate(passages):
        assert (one[2 * i][1] > 0) == (len(p) + 2 >= 400)  # the blanks around it repeat too
    assert got_words(substrings.remove_earlier_windows(docs)) == brute_words(rows, 50)


def test_order_and_longest():
    rng = random.Random(9)
    for _ in range(60):
        strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(6))).encode() * rng.choice([1, 30]) for _ in range(rng.randrange(1, 30))]
        assert [strings[i] for i in deep_shallow(strings)] == sorted(strings)
        before = [s[: rng.randrange(12)] for s in strings]
        got = longest(before, strings, 10) if len(strings) > 1 else []
        for i, pair in enumerate(got):
            both = [(common(before[i], before[j]), common(strings[i], strings[j])) for j in range(len(strings)) if j != i]
            both = [b for b in both if sum(b) >= 10]
            assert pair == (max((b[0] for b in both), default=0), max((b[1] for b in both), default=0))


def test_tree_of_a_large_group_writes_no_suffix_out():
    rng, window = np.random.default_rng(3), 50
    made = lambda n, words, most: [
        {"gram": int(g), "n": int(k), "units": rng.integers(0, words, k + window - 1).astype(np.uint64).tobytes()}
        for g, k in zip(rng.integers(0, 2, n), rng.integers(1, most + 1, n), strict=True)
    ]
    few = made(60, 1, 4) + made(40, 2, 6)
    row, number, depth, group = substrings.tree_nodes(few, window)
    first = list(dict.fromkeys(r["gram"] for r in few))
    words = [np.frombuffer(r["units"], np.uint64) for r in few]
    said = [(first.index(r["gram"]), *words[i][k : k + window], i, k) for i, r in enumerate(few) for k in range(r["n"])]
    want = sorted(said)
    assert [(g, i, k) for g, i, k in zip(group, row, number, strict=True)] == [(w[0], *w[-2:]) for w in want]
    for i, (a, b) in enumerate(zip(want, want[1:]), 1):
        alike = next((k for k in range(window) if a[k + 1] != b[k + 1]), window)
        assert depth[i] == (alike if a[0] == b[0] else 0)
    many = made(5_000, 3, 20)
    tracemalloc.start()
    substrings.tree_nodes(many, window)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < sum(r["n"] for r in many) * window * 8  # all suffixes of the group, written out once
