"""From raw documents to tokens: five stages, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``; rows with null ids or texts go through like others. The stages decide:
which documents are good enough (quality), which one of each class of near copies stays (the
smallest id), which hold benchmark passages (they go), what is secret (it is cut out of the text,
and ``n_chars`` follows), and how the text is encoded (token ids, checked by decoding).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import bpe, decontaminate, jaccard, quality, secrets
from clearledger.llm.queries import QUALITY_LEAST, byte_tokenizer
from clearledger.llm.tables import written
from clearledger.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL can express neither trained models nor the tokenizer; the stages are tested instead.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at least ``QUALITY_LEAST``."""
    labels = quality.majority_labels(read_table(spark, sf_dir, "labels"))
    machine = quality.fit(docs, labels, metadata=("n_chars",))
    scored = quality.score(docs.select(*COLUMNS), machine, metadata=("n_chars",), into="_score")
    return scored.where(F.col("_score") >= QUALITY_LEAST).select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of five-word shingles at 0.8; of rows that
    share an id the one with the smallest hash, and every row without an id."""
    classes = jaccard.similarity_classes(docs)
    gone = classes.where("doc_id <> component_id").select("doc_id")
    named = docs.where(F.col("doc_id").isNotNull()).join(gone, "doc_id", "left_anti")
    repeated = classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = named.join(repeated, "doc_id", "left_anti")
    several = named.join(repeated, "doc_id", "left_semi")
    own = F.struct(*COLUMNS)
    first = several.groupBy("doc_id").agg(F.min_by(own, F.struct(F.xxhash64(own), "text")).alias("row")).select("row.*")
    return once.unionByName(first).unionByName(docs.where(F.col("doc_id").isNull())).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.without_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of the text."""
    model = secrets.fit(secrets.labelled_samples(docs))
    cut = secrets.without_secrets(docs.select(*COLUMNS), model)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    coded = bpe.encode_and_decode(docs.select(*COLUMNS), byte_tokenizer())
    return coded.select(
        "doc_id",
        "lang",
        "source",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"),
    )


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the tables between them lie in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
