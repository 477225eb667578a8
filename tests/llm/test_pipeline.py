"""The pipeline's stages on tables with planted cases, and run() as a whole."""

from __future__ import annotations

import corpus_pipeline as p
from clearledger.llm.queries import QUERIES


def test_stages_and_registration(spark, small):
    import __spark_entry__ as entry

    assert [name for name, _ in p.STAGES] == ["quality", "near_copies", "decontamination", "secrets", "encoding"]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_each_stage_decides(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good = {r.doc_id for r in p.good_quality(spark, docs, small).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert all(i in good for i, q in labels.items() if q)
    assert sum(i in good for i, q in labels.items() if not q) <= 1
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    words = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, words, "en", "s", 1), (2, words + " more", "en", "s", 1), (3, "before " + item, "en", "s", 1),
        (4, "a token = '0123456789abcdef0123456789abcdef'", "en", "s", 44), (None, words, None, None, None),
        (6, None, "en", "s", 0), (1, words, "en", "s", 1), (7, "clean text", "en", "s", 10),
    ]
    made = spark.createDataFrame(rows, docs.schema)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=str)
    kept = p.one_of_near_copies(spark, made, small)
    assert ids(kept) == [1, 3, 4, 6, 7, None] and kept.columns == list(p.COLUMNS)
    clean = p.without_benchmark(spark, made, small)
    assert ids(clean) == [1, 1, 2, 4, 6, 7, None] and clean.columns == list(p.COLUMNS)
    cut = {r.doc_id: (r.text, r.n_chars) for r in p.without_secrets(spark, made, small).collect()}
    assert cut[4] == ("a [SECRET]'", 11) and cut[7] == ("clean text", 10) and cut[6] == (None, None)
    assert all(r.decodes for r in p.tokens(spark, made, small).collect())


def test_run(spark, small):
    rows = p.run(spark, small).collect()
    assert rows and all(r.decodes for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
