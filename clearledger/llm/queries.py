"""The registered query of each operator: production parameters, whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import (
    bpe,
    chat,
    decontaminate,
    jaccard,
    languages,
    lexical,
    licenses,
    manifest,
    neighbours,
    quality,
    secrets,
    substrings,
)
from clearledger.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
QUALITY_LEAST = 0.3


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _removed() -> Column:
    """How many bytes or words the spans of a row cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


@query
def op1_suffix_array(spark, folder):
    """Every document without the 400-byte strings that also start elsewhere."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    cut = substrings.remove_repeated_bytes(docs)
    return cut.select(
        "doc_id",
        "n_bytes",
        _removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op2_licences(spark, folder):
    """The licences of every paragraph of every document."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.fit(docs)).drop("text")
    listed = F.transform("licences", lambda x: F.concat_ws(":", x["paragraph"], x["family"]))
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct("licences.family")), ",").alias("families"),
        F.array_join(listed, ",").alias("paragraphs"),
    )


@query
def op3_jaccard(spark, folder):
    """Classes of documents linked by three-word shingles at a similarity of 0.9."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.similarity_classes(docs, n=3, percent=90)


@query
def op4_spaced_seeds(spark, folder):
    """Every overlap of a document with a benchmark item."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.overlaps(docs, read_table(spark, folder, "benchmark"))


@query
def op5_secrets(spark, folder):
    """Every secret of every document, by patterns and by Markov models."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = secrets.fit(secrets.labelled_samples(docs))
    found = secrets.scan(docs, model).drop("text")
    spans = F.col("spans")
    base = secrets.listing(F.filter(spans, lambda s: s["kind"] != "random"))
    return found.select(
        "doc_id",
        *[secrets.count(spans, kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secrets.listing(spans).alias("spans"),
    )


@query
def op6_multiprobe(spark, folder):
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    return neighbours.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op7_suffix_tree(spark, folder):
    """Every document without the 50-word windows that an earlier document has."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    cut = substrings.remove_earlier_windows(docs)
    return cut.select(
        "doc_id",
        "n_words",
        _removed().alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op8_quality(spark, folder):
    """Quality of every document, learnt from the labelled ones that are not held out."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    labels = quality.majority_labels(read_table(spark, folder, "labels"))
    machine = quality.fit(docs, labels.where(~quality.held_out(F.col("key"))), metadata=("n_chars",))
    scored = quality.score(docs, machine, metadata=("n_chars",)).drop("text")
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"),
    )


@query
def op9_bpe(spark, folder):
    """Tokens of every document by the byte-level vocabulary, and the text they decode to."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode_and_decode(docs, byte_tokenizer())
    return coded.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op10_chat(spark, folder):
    """All conversations and number -1, formatted and read back."""
    told = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = told.unionByName(own).withColumn("parts", chat.text_part(F.col("text")))
    made = chat.format_chat(rows)
    read = made.withColumns(
        {
            "turns": chat.read_turns(F.col("formatted")),
            "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans")),
        }
    )
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op11_language(spark, folder):
    """The language of every document, learnt from those that are not held out."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    outside = languages.held_out(F.col("doc_id"))
    network = languages.fit(docs.where(~outside))
    found = languages.predict(docs.select("doc_id", "text"), network)
    return found.select("doc_id", outside.alias("held_out"), "lang_pred", "score")


@query
def op12_lexical(spark, folder):
    """The 20 documents that rank highest for every benchmark item."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return lexical.search(docs, read_table(spark, folder, "benchmark").select("item_id", "text"))


@query
def op13_merkle(spark, folder):
    """Every document's leaf, its proof, and whether a copy of it, at times tampered with, is verified."""
    docs = read_table(spark, folder, "documents").select(*manifest.FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = {n: F.col(n) for n in manifest.FIELDS} | {"text": F.translate("text", capitals, capitals.lower())}
    made = manifest.build(docs, {"tampered": F.when(chosen, manifest.leaf_digest(tampered))})
    proofs = manifest.prove(made, F.coalesce("tampered", "digest"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        "verified",
    )
