"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clearledger.llm import neighbours


def brute(rows, k, asked):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if asked(i):
            near = sorted((-float((v * w).sum()), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def test_recall_and_scores_on_given_tables(spark, small):
    from clearledger.llm.queries import op6_multiprobe

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    truth = brute(rows, 20, lambda i: i % 20 == 0)
    got: dict = {}
    for r in sorted(op6_multiprobe(spark, small).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert len(got.setdefault(r.query_id, [])) == r["rank"] - 1
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(truth) and all(len(v) == 20 for v in got.values())
    vectors = {i: np.array(v, float) for i, v in rows}
    hits = 0
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(s - float(vectors[q] @ vectors[i])) < 1e-12 for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in truth[q]})
    assert hits / (20 * len(truth)) >= 0.9


def test_ties_short_tables_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 3)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(12)] + [(20, [0.0, 0.0]), (21, None), (22, [None, 1.0]), (23, [float("nan"), 1.0]), (24, [float("inf"), 1.0]), (25, [3.0, 4.0, 5.0]), (40, [-9.0, 0.5]), (41, [0.1, 0.1]), (0, same)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    asked = lambda i: i % 20 == 0
    got: dict = {}
    for r in sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    truth = brute(list({(i, tuple(v) if v else v): (i, v) for i, v in rows}.values()), 5, asked)
    assert got == {q: v for q, v in truth.items() if v}
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_probes_come_by_success():
    place = np.array([0.1, 0.6, 0.45])
    order = neighbours.probe_order(place, 20)
    cost = [sum((place[i] if s < 0 else 1 - place[i]) ** 2 for i, s in p) for p in order]
    assert order[0] == () and cost == sorted(cost) and len(set(order)) == len(order)


def test_recall_whatever_the_norms(spark):
    rng = np.random.default_rng(7)
    unit = rng.normal(size=(4000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    outlier = unit.copy()
    outlier[3] *= 4
    spread = unit * rng.uniform(1, 2, 4000)[:, None]
    for x in (unit, unit * 2, spread, outlier, unit * 1e140):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got: dict = {}
        for r in neighbours.nearest(df, F.col("vec_id") % 40 == 0).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        small = x / np.abs(x).max()
        near = small[::40] @ small.T
        near[np.arange(100), np.arange(0, 4000, 40)] = -np.inf
        truth = np.argsort(-near, axis=1)[:, :20]
        assert np.mean([len(got[40 * i] & set(t.tolist())) / 20 for i, t in enumerate(truth)]) >= 0.9


def test_queries_with_poor_probes_are_searched_in_full(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found: dict = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 300 == 0, k=2, tables=1, projections=3, probes=1).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    truth = brute(rows, 2, lambda i: i % 300 == 0)
    assert {q: sorted(v) for q, v in found.items()} == {q: sorted(i for i, _ in v) for q, v in truth.items()}
