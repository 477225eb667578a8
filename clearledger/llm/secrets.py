"""Secret scanning: fixed patterns plus character Markov models of random and ordinary strings.

Patterns give the base spans, leftmost and non-overlapping per kind. The models add spans of kind
``random``: a run of token characters is one if the log-likelihood ratio of the random to the
ordinary bigram model is at least ``MIN_RATIO`` nats a character. Both models are trained here
from labelled samples: random strings drawn from digests in the alphabets that keys use, and
ordinary identifiers made of words of at most ``SAMPLE_DOCUMENTS`` documents (lowest id hash
first). Only the table of bigram counts, bounded by the alphabet's square, comes to the driver.

Spans are code points, end exclusive, of the whole text; null texts are empty and have none. With
no documents the ordinary model is uniform. Repeated rows are scanned as often as they come, and
a column named like an added one is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearledger.llm.bytewords import CHUNK_BYTES, text_bytes
from clearledger.llm.workers import with_columns

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
RUN = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SPANS_TYPE = "array<struct<kind:string,start:int,end:int>>"
MIN_RUN = 20
MIN_RATIO = 0.5
SAMPLE_DOCUMENTS = 500
RANDOM_STRINGS = 6_000
#: Bytes of text worked on at once.
SLICE_BYTES = 1 << 21
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_IN_RUN = np.zeros(256, bool)
_IN_RUN[[ord(c) for c in ALPHABET]] = True


@dataclass(frozen=True)
class RatioModel:
    """log P(next | previous) under the random model less the same under the ordinary one."""

    table: np.ndarray

    def ratio(self, text: str) -> float:
        """Log-likelihood ratio a transition; needs characters of the alphabet only."""
        codes = np.array([ALPHABET.index(c) for c in text])
        return float(self.table[codes[:-1], codes[1:]].mean()) if len(text) > 1 else 0.0


def labelled_samples(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (sample, label): 1 for random strings, 0 for ordinary identifiers."""
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")).cast("binary"), 512)
    sixty_four = F.base64(F.unhex(digest))
    kind = F.col("id") % 5
    drawn = (
        F.when(kind == 0, F.substring(digest, 1, 40))
        .when(kind == 1, F.substring(sixty_four, 1, 40))
        .when(kind == 2, F.substring(F.translate(sixty_four, "+/=", ""), 1, 32))
        .when(kind == 3, F.substring(F.translate(sixty_four, "+/=", "_-"), 1, 43))
        .otherwise(F.substring(F.upper(F.translate(sixty_four, "+/=", "")), 1, 24))
    )
    random = spark.range(RANDOM_STRINGS).select(drawn.alias("sample"), F.lit(1).alias("label"))
    least = docs.select(F.col(f"`{key}`").alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(SAMPLE_DOCUMENTS)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).join(F.broadcast(least), "k")
    words = F.filter(
        F.regexp_extract_all("t", F.lit(r"([A-Za-z]{2,})"), 1), lambda w: ~F.lower(w).rlike("^[0-9a-f]{8,}$")
    )
    joined = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("w") - 1, F.lit(1)), lambda i: i % 3 == 0),
        lambda i: F.when(i % 2 == 0, F.array_join(F.slice("w", i + 1, 3), "_")).otherwise(
            F.array_join(F.slice("w", i + 1, 3), "")
        ),
    )
    camel = F.transform("joined", lambda s: F.replace(F.initcap(F.replace(s, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit("")))
    ordinary = (
        rows.select(words.alias("w"))
        .where(F.size("w") > 0)
        .select(joined.alias("joined"))
        .select(F.explode(F.concat("joined", camel, F.transform("joined", F.upper))).alias("sample"), F.lit(0).alias("label"))
    )
    return random.unionByName(ordinary)


def fit(samples: DataFrame) -> RatioModel:
    """Both Markov models from labelled samples, add-one smoothed, as one table of ratios."""
    places = F.sequence(F.lit(1), F.length("sample") - 1)
    pairs = (
        samples.where(F.length("sample") > 1)
        .select("label", F.explode(F.transform(places, lambda i: F.substring(F.col("sample"), i, 2))).alias("pair"))
        .groupBy("label", "pair")
        .count()
    )
    counts = np.ones((2, len(ALPHABET), len(ALPHABET)))
    for label, pair, n in pairs.collect():  # at most two alphabets squared
        a, b = ALPHABET.find(pair[0]), ALPHABET.find(pair[1])
        if a >= 0 and b >= 0:
            counts[label, a, b] += n
    likely = np.log(counts / counts.sum(axis=2, keepdims=True))
    return RatioModel(likely[1] - likely[0])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns; matches that are too short are dropped after the scan."""
    low, out = text.lower(), []
    if any(w in low for w in WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out


def run_spans(text: str, model: RatioModel) -> list[tuple[str, int, int]]:
    """Hexadecimal runs, and token runs with letters and digits that look random."""
    out = [("hex", *m.span()) for m in HEX.finditer(text)]
    for m in RUN.finditer(text):
        run = m[0]
        mixed = any(c.isdigit() for c in run) and any(c.isalpha() for c in run)
        if mixed and model.ratio(run) >= MIN_RATIO:
            out.append(("random", *m.span()))
    return out


def rows_with_runs(column: pa.Array, least: int = MIN_RUN) -> set[int]:
    """Rows that hold a run of at least so many token characters."""
    data, offsets = text_bytes(column)
    found: set[int] = set()
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        base = offsets[at]
        inside = np.zeros(offsets[to] - base + 2, np.int8)
        inside[1:-1] = _IN_RUN[data[base : offsets[to]]]
        change = np.diff(inside)
        begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        long = end - begin >= least  # a run may go over row ends; its rows are looked at in vain
        for a, b in zip(begin[long], end[long], strict=True):
            i, j = np.searchsorted(offsets, (a + base, b - 1 + base), "right") - 1
            found.update(range(int(i), int(j) + 1))
        at = to
    return found


def spans_of(column: pa.Array, model: RatioModel) -> tuple[list[str], list[list[tuple[str, int, int]]]]:
    """The texts of a column and the spans of each, by start, then kind as listed."""
    runs, texts, out = rows_with_runs(column), [], []
    for i, raw in enumerate(column.cast(pa.large_binary()).to_pylist()):
        said = (raw or b"").decode("utf-8", "replace")
        found = base_spans(said)
        if i in runs:
            found += run_spans(said, model)
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        texts.append(said)
        out.append(found)
    return texts, out


def scan(df: DataFrame, model: RatioModel, text: str = "text", into: str = "spans") -> DataFrame:
    """Add the spans of every secret: structs (kind, start, end) by start, then kind as listed."""
    place = df.columns.index(text)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        found = spans_of(batch.column(place), model)[1]
        return [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row] for row in found], _SPANS)]

    return with_columns(df, f"`{into}` {SPANS_TYPE}", lambda: work, SLICE_BYTES, text)


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listing(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def cut_out(said: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with ``[SECRET]`` for each stretch covered by spans."""
    at, kept = 0, []
    for _, start, end in spans:
        if start >= at:
            kept += [said[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*kept, said[at:]])


def redact(df: DataFrame, spans: str = "spans", text: str = "text") -> DataFrame:
    """Replace each stretch covered by spans with ``[SECRET]``; the spans column goes."""
    at, of = df.columns.index(text), df.columns.index(spans)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        raws = batch.column(at).cast(pa.large_binary()).to_pylist()
        cut = [
            None if raw is None else cut_out(raw.decode("utf-8", "replace"), [(s["kind"], s["start"], s["end"]) for s in row or []])
            for raw, row in zip(raws, batch.column(of).to_pylist(), strict=True)
        ]
        return [pa.array(cut, pa.string())]

    return with_columns(df, f"`{text}` string", lambda: work, SLICE_BYTES, text).drop(spans)


def without_secrets(df: DataFrame, model: RatioModel, text: str = "text") -> DataFrame:
    """Replace the secrets of each text, found and cut out in one pass; null texts stay null."""
    place = df.columns.index(text)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        column = batch.column(place)
        texts, found = spans_of(column, model)
        there = column.is_valid().to_pylist()
        return [pa.array([cut_out(t, s) if v else None for t, s, v in zip(texts, found, there, strict=True)], pa.string())]

    return with_columns(df, f"`{text}` string", lambda: work, SLICE_BYTES, text)
