"""Planted benchmark passages, whole, in part and with substitutions."""

from __future__ import annotations

import random

from clearledger.llm import decontaminate as d


def make(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def brute(texts, items):
    """Overlaps by trying every shift of every item, without seeds."""
    import re

    split = lambda t: re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (t or "").lower())
    out = set()
    for i, t in texts:
        w = split(t)
        for j, s in items:
            v = split(s)
            if len(v) < d.SHORTEST:
                continue
            for shift in range(-len(v), len(w)):
                best = here = 0
                for a, x in enumerate(v):
                    if 0 <= a + shift < len(w):
                        good = w[a + shift] == x
                        score, equal = here and here[0] or 0, here and here[1] or 0
                        here = (score + (1 if good else -d.PENALTY), equal + good)
                        here = here if here[0] > 0 else 0
                        if here and (not best or here[0] > best[0]):
                            best = here
                if best and best[1] >= min(d.LEAST_WORDS, len(v)):
                    out.add((i, j))
    return out


def test_equals_trying_every_shift(spark):
    rng = random.Random(4)
    items = [(i, " ".join(make(rng, rng.choice([3, 6, 8, 12, 20, 40])))) for i in range(40)] + [(90, None), (91, "")]
    texts = [(0, None), (1, ""), (2, "x")]
    for i in range(3, 160):
        words = make(rng, rng.randrange(60))
        if rng.random() < 0.6:
            planted = items[rng.randrange(40)][1].split()
            lo = rng.randrange(max(1, len(planted) // 2)) if rng.random() < 0.4 else 0
            planted = planted[lo:]
            for _ in range(rng.choice([0, 0, 1, 2])):
                planted[rng.randrange(len(planted))] = "other"
            words += [w.upper() if rng.random() < 0.1 else w for w in planted] + make(rng, 5)
        texts.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(docs, bench).collect()}
    truth = brute(texts, items)
    assert got <= truth and len(got) >= 0.98 * len(truth)  # seeds may all be spoilt by close substitutions
    kept = {r.doc_id for r in d.without_contaminated(docs, bench).collect()}
    assert kept == {i for i, _ in texts} - {i for i, _ in got}


def test_blocks_and_edges(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_BYTES", 40)
    rng = random.Random(5)
    items = [(i, " ".join(make(rng, 15))) for i in range(12)]
    docs = spark.createDataFrame([(i, "before " + t) for i, t in items] + [(None, items[0][1]), (7, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal) for r in d.overlaps(docs, bench).collect()}
    assert got == {(i, i, 1, 15, 15) for i in range(12)} | {(None, 0, 0, 15, 15)}
    assert [r.doc_id for r in d.without_contaminated(docs, bench).collect()] == [7]
    assert d.overlaps(docs.limit(0), bench).count() == d.overlaps(docs, bench.limit(0)).count() == 0
    assert d.without_contaminated(docs, bench.limit(0)).count() == 14


def test_share_of_equal_words_decides():
    rng = random.Random(11)

    def found(n, changed):
        words = make(rng, n)
        said = ["other" if i in changed else w for i, w in enumerate(words)]
        index = d.SeedIndex([(1, " ".join(words))])
        return index.overlaps(d.pa.array([" ".join(["before", *said, "after"])]))[0]

    assert found(59, set(range(3, 59, 5))) and found(38, {4 + 5 * i for i in range(7)})
    assert found(16, {5, 11}) == [(1, 1, 16, 14)] and found(13, {3, 8}) == [(1, 1, 13, 11)]
    assert not found(40, set(range(0, 40, 2)) | set(range(1, 40, 4)))
    for n, rate in ((15, 0.1), (20, 0.1), (20, 0.15), (38, 0.15), (59, 0.2)):
        # what was changed says whether the item is there, not how runs lie
        sets = [{i for i in range(n) if rng.random() < rate} for _ in range(200)]
        sets = [s for s in sets if n - len(s) >= 0.8 * n]
        assert sum(bool(found(n, s)) for s in sets) >= 0.9 * len(sets), (n, rate)
