"""BPE, chat, secrets, quality and licences on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from clearledger.llm import bpe, chat, licenses, oracles, quality, queries, secrets

ODD = [None, "", " ", "\n\n", "x", "a" * 3000, "é漢🙂́ don't <|endoftext|> 12ab\t \x1c\x85", "ab " * 2000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(None, "x", None, None), (4, "x", "clash", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, score int")


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, small, name):
    got = compare.spark_result(queries.QUERIES[name](spark, small))
    assert got == compare.sql_result(compare.connect(small), oracles.ORACLES[name])


# --- byte pair encoding -------------------------------------------------------------------------


def test_encoding_equals_the_library(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.byte_tokenizer())
    rng = random.Random(1)
    letters = "aab bcc  \n\t\r\x1c\x1d\x85  'stdllve.!?0123éßñ漢字🙂"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["".join(rng.choice(["the", "er", "in", "a", "ing", "ion"]) for _ in range(9)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in bpe.encode(df, queries.byte_tokenizer()).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == np.array(ids, "<u4").tobytes(), t
    for r in queries.op9_bpe(spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        said = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_encoding_edges(spark, odd):
    coded = bpe.encode(odd, queries.byte_tokenizer())
    back = bpe.decode(coded, queries.byte_tokenizer())
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert bpe.encode(odd.limit(0), queries.byte_tokenizer()).count() == 0
    broken = spark.createDataFrame([(np.array([162], "<u4").tobytes(),), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(broken, queries.byte_tokenizer()).collect()] == ["�", ""]


# --- chat ---------------------------------------------------------------------------------------


def test_parts_become_placeholders(spark):
    part = lambda kind, **k: (kind, *[k.get(n) for n in ("text", "reference", "width", "height", "seconds", "pages")])
    rows = [
        (1, 0, "user", [part("text", text="see "), part("image", reference="a.png", width=30, height=14), None, part("other")]),
        (1, 1, "assistant", [part("text", text="<|image|> & [INST]"), part("text")]),
        (1, 2, "user", [part("audio", reference="b.wav", seconds=1.5), part("document", reference="c.pdf", pages=2), part("image")]),
        (2, None, None, None),
        (None, 0, "assistant", [part("text", text="x")]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{chat.PART_TYPE}>")
    made = {r.conv_id: r for r in chat.format_chat(df.withColumn("body", F.lit("clash"))).collect()}
    one = made[1]
    assert [(a.kind, a.reference, a.position, a.tokens) for a in one.attachments] == [
        ("image", "a.png", 1, 3), ("audio", "b.wav", 0, 38), ("document", "c.pdf", 1, 512), ("image", None, 2, 1),
    ]
    assert one.attachment_tokens == 554 and one.n_turns == 3
    assert one.formatted.count("<|image|>") == 2 and made[2].formatted == "<|turn|><|body|><|end|>"
    read = chat.format_chat(df).select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    read = {r.conv_id: r for r in read.collect()}
    assert [tuple(t) for t in read[1].t][:2] == [("user", "see <|image|>"), ("assistant", "<|image|> & [INST]")]
    assert read[1].loss == "<|image|> & [INST]" and read[None].loss == "x"
    assert chat.format_chat(df.limit(0)).count() == 0


def test_escaping_is_undone(spark):
    rng = random.Random(2)
    bits = ["&", "amp;", "lt;", "lsqb;", "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<", "[", "é🙂", "<|end|>", "<<SYS>>", "\n", "end"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(9))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r.back == r.t and not any(c in r.e for c in chat.CONTROL)


# --- secrets ------------------------------------------------------------------------------------


def plain_spans(text):
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, good in (
        ("assign", re.compile(assign, re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if good(m)]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_and_random_strings(spark, odd):
    rng = random.Random(3)
    bits = ["password=", "TOKEN: '", "secret", "api_key = ", "apikey:", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "xy", " ", "\n", "=", '"', "é", "tok", "en=", "Kſ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = secrets.fit(secrets.labelled_samples(odd))
    for r in secrets.scan(df, model).collect():
        assert [tuple(s) for s in r.spans if s.kind != "random"] == plain_spans(r.text)
    assert secrets.scan(odd, model).count() == len(ODD) + 2


def test_markov_ratio_separates_held_out_strings(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = secrets.fit(secrets.labelled_samples(docs))
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_ = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(300)]
    words = [w for r in docs.where("doc_id > 150").collect() for w in re.findall(r"[a-z]{3,}", r.text)]
    ordinary = ["_".join(rng.sample(words, 4)) + "_2" for _ in range(300)]
    assert np.mean([model.ratio(s) >= secrets.MIN_RATIO for s in random_]) > 0.97
    assert np.mean([model.ratio(s) >= secrets.MIN_RATIO for s in ordinary]) < 0.01


def test_redaction(spark):
    text = "a token = '0123456789abcdef0123456789abcdef' é password=abcdefgh"
    df = spark.createDataFrame([(1, text), (2, None), (3, "clean")], "doc_id long, text string")
    model = secrets.RatioModel(np.full((len(secrets.ALPHABET),) * 2, -1.0))
    got = {r.doc_id: r.text for r in secrets.redact(secrets.scan(df, model)).collect()}
    assert got == {1: "a [SECRET]' é [SECRET]", 2: None, 3: "clean"}


# --- quality ------------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark, small):
    rows = {r.doc_id: r for r in queries.op8_quality(spark, small.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(f"{small.replace('0.001', '0.01')}/labels.parquet").collect()
    apart = [(rows[r.doc_id].score, r.quality) for r in labels if rows[r.doc_id].held_out]
    good, bad = [s for s, q in apart if q], [s for s, q in apart if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.3) == q for s, q in apart]) > 0.95


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(6)
    d = len(quality.STATISTICS)
    m = quality.Machine(0.3, rng.normal(size=quality.BUCKETS + d), rng.normal(size=(quality.BUCKETS + d, quality.FACTORS)), np.zeros(d), np.ones(d))
    idx, value, stats = np.array([5, 9, 70]), rng.random(3) * 0.1, rng.random((1, d)) * 0.1
    x = np.concatenate([value, m.dense(stats)[0]])
    at = np.concatenate([idx, quality.BUCKETS + np.arange(d)])
    z = m.bias + x @ m.weight[at]
    z += sum(m.factor[at[i]] @ m.factor[at[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert abs(m.score(np.zeros(3, int), idx, value, stats)[0] - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 0), (3, None), (None, 1), (4, 1), (5, 0)], "doc_id long, quality int")
    known = quality.majority_labels(labels)
    assert {r.key: r.label for r in known.collect()} == {0: 1, 1: 0, 4: 1, 5: 0}
    machine = quality.fit(odd, known, metadata=("score",))
    rows = quality.score(odd, machine, metadata=("score",)).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(odd, known.limit(0)) is None
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.score(odd.limit(0), machine, metadata=("score",)).count() == 0


# --- licences -----------------------------------------------------------------------------------


def test_licences(spark, odd, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = licenses.fit(docs)
    rows = [(i, f"Some words here.\n{t}\nand an end", f) for i, (f, t) in enumerate((f, t) for f, ts in licenses.TEMPLATES.items() for t in ts)]
    near = "This project is licensed under the MIT License, see the LICENSE file for all details"
    rows += [(90, near, "MIT"), (91, "The license of the report is a page of notes.", None), (92, "He was granted permission to go.", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string")
    for r in licenses.scan(df, model).collect():
        assert [x.family for x in r.licences] == ([r.family] if r.family else []), r.text
    assert all(not r.licences for r in licenses.scan(odd, model).collect())
    assert licenses.scan(odd.limit(0), licenses.fit(odd.limit(0))).count() == 0


def test_licences_of_given_tables(spark, small):
    said = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    names = {"Apache License": "Apache", "MIT License": "MIT", "GNU General Public": "GPL", "CC BY-NC": "CC-BY-NC"}
    for r in queries.op2_licences(spark, small).collect():
        truth = sorted({f for n, f in names.items() if n in said[r.doc_id]})
        assert r.families == ",".join(truth)


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above""",
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or""",
}


def test_wrapped_titled_and_tagged_licences(spark, small):
    model = licenses.fit(spark.read.parquet(f"{small}/documents.parquet"))
    rows = [(f"Some text.\n\n{t}\nand more\n\nThe end.", f"2:{f}") for f, t in WRAPPED.items()]
    rows += [(f"{WRAPPED['MIT']}\n{WRAPPED['BSD']}", "0:MIT,4:BSD"), (" ".join(WRAPPED["ISC"].split()) + " " + licenses.TEMPLATES["MPL"][1], "0:ISC,0:MPL")]
    rows += [("x\nMIT License\n\nwords", "1:MIT"), ("# SPDX-License-Identifier: MIT\nimport x", "0:MIT"), ("// SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)", "0:GPL,0:BSD")]
    rows += [("SPDX-License-Identifier: CC-BY-SA-4.0\nSPDX-License-Identifier: LGPL-2.1-or-later", "0:CC-BY-SA,1:LGPL")]
    rows += [("He spoke of a license of MIT and its terms.", ""), ("Permission was granted to use the source\n\nand binary forms", "")]
    df = spark.createDataFrame(rows, "text string, truth string")
    for r in licenses.scan(df, model).collect():
        assert ",".join(f"{x.paragraph}:{x.family}" for x in r.licences) == r.truth, r.text
