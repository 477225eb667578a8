"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's vector holds its hashed words (counts, square-rooted and scaled to length one) and
standardised statistics of its structure and metadata. The score is

    logistic(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2])

where the second sum covers all pairs of features in time linear in their number. Weights are
fitted by Adam on at most ``TRAINING_ROWS`` labelled documents, those with the lowest id hash; this
bounded sample is the only thing gathered in one task, and every document is scored whole.

Null and empty texts have no words and all statistics zero; they get a score like any other. Null
metadata count as 0. Documents with several labels take the majority, none on a tie. Without
labelled documents every score is 0.5. Columns named like the added one are replaced; repeated
rows get equal scores.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearledger.llm.bytewords import CHUNK_BYTES, lowered, text_bytes, word_hashes, words
from clearledger.llm.workers import tidy, with_columns

TRAINING_ROWS = 6_000
BUCKETS = 1 << 12
FACTORS = 6
#: Steps of the fit, whatever the number of rows.
STEPS = 300
BATCH = 256
RATE = 0.02
DECAY = 1e-4
SEED = 11
#: Bytes of text passed on at once.
SLICE_BYTES = 1 << 21

_CLASSES = np.full(256, 6, np.int8)  # other signs
for _k, _bytes in enumerate(
    (range(65, 91), range(97, 123), range(48, 58), (32, 9, 11, 12, 13), (10,), range(128, 256), (), b".,;:'\"()-?")
):
    _CLASSES[list(_bytes)] = _k
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "upper", "lower", "digits", "spaces",
    "lines", "high_bytes", "signs", "punctuation", "words_ending_in_signs", "words_of_signs",
)


def _parts(column: pa.Array, *more: pa.Array):
    """Row slices of about CHUNK_BYTES of text: (bytes, offsets, slices of the other columns)."""
    data, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], [m[at:to] for m in more]
        at = to


def vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse word features (row, bucket, value) and a row of structure statistics per document."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    bucket = (word_hashes(lowered(data), starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    at, idx = key // BUCKETS, key % BUCKETS
    size, n_words = np.diff(offsets).astype(float), np.diff(first).astype(float)
    value = np.sqrt(count / np.maximum(n_words[at], 1))
    kind = _CLASSES[data]
    ends_in_sign = kind[ends - 1] == 6
    of_signs = ends_in_sign & (kind[starts] == 6)
    by_row = lambda weights: np.bincount(row, weights, n)
    of = np.repeat(np.arange(n), np.diff(offsets))
    share = np.bincount(of * 8 + kind, minlength=8 * n).reshape(n, 8) / np.maximum(size, 1)[:, None]
    per_word = np.maximum(n_words, 1)
    stats = np.column_stack(
        [
            np.log1p(size), np.log1p(n_words), by_row(ends - starts) / per_word,
            np.bincount(at, minlength=n) / per_word, share,
            by_row(ends_in_sign) / per_word, by_row(of_signs) / per_word,
        ]
    )
    return at, idx, value, stats


@dataclass
class Machine:
    """Weights, and the mean and scale of the dense features."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -3, 3) / 3

    def linear_parts(self, row, idx, value, dense, n):
        """Per row: the linear sum, the factor sums, and the sum of their squares."""
        d = dense.shape[1]
        vx = self.factor[idx] * value[:, None]
        line = self.bias + np.bincount(row, self.weight[idx] * value, n) + dense @ self.weight[-d:]
        s = np.column_stack([np.bincount(row, vx[:, f], n) for f in range(FACTORS)]) + dense @ self.factor[-d:]
        squares = np.bincount(row, (vx * vx).sum(axis=1), n) + (dense**2) @ (self.factor[-d:] ** 2).sum(axis=1)
        return line, s, squares

    def score(self, row, idx, value, stats) -> np.ndarray:
        line, s, squares = self.linear_parts(row, idx, value, self.dense(stats), len(stats))
        return 1 / (1 + np.exp(-np.clip(line + ((s * s).sum(axis=1) - squares) / 2, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]) -> Machine:
    """Fit to rows (buckets, values, statistics, label) in the order given."""
    label = np.array([r[3] for r in rows], float)
    stats = np.array([r[2] for r in rows])
    d = stats.shape[1]
    rng = np.random.default_rng(SEED)
    scale = stats.std(axis=0)
    m = Machine(0.0, np.zeros(BUCKETS + d), rng.normal(0, 0.01, (BUCKETS + d, FACTORS)), stats.mean(axis=0), np.where(scale > 1e-9, scale, 1.0))
    share = (label.sum() + 1) / (len(label) + 2)
    m.bias = float(np.log(share / (1 - share)))
    dense = m.dense(stats)
    params = [m.weight[:, None], m.factor]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    while step < STEPS:
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            take = order[start : start + BATCH]
            idx = np.concatenate([rows[i][0] for i in take]).astype(np.int64)
            value = np.concatenate([rows[i][1] for i in take])
            row = np.repeat(np.arange(len(take)), [len(rows[i][0]) for i in take])
            x = dense[take]
            line, s, squares = m.linear_parts(row, idx, value, x, len(take))
            p = 1 / (1 + np.exp(-np.clip(line + ((s * s).sum(axis=1) - squares) / 2, -30, 30)))
            g = (p - label[take]) / len(take)
            gx = g[row] * value
            grad_w = np.bincount(idx, gx, BUCKETS + d)
            grad_w[-d:] += x.T @ g
            grad_v = np.column_stack([np.bincount(idx, gx * s[row, f], BUCKETS + d) for f in range(FACTORS)])
            grad_v -= np.bincount(idx, gx * value, BUCKETS + d)[:, None] * m.factor
            grad_v[-d:] += x.T @ (g[:, None] * s) - ((x * x).T @ g)[:, None] * m.factor[-d:]
            m.bias -= RATE * g.sum()
            step += 1
            for parameter, grad, (a, b) in zip(params, (grad_w[:, None], grad_v), moments, strict=True):
                grad += DECAY * parameter
                a += 0.1 * (grad - a)
                b += 0.001 * (grad**2 - b)
                parameter -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return m


def _meta(columns: list[pa.Array], n: int) -> np.ndarray:
    """Metadata as log magnitudes with sign; null, nan and infinite are 0."""
    out = np.zeros((n, len(columns)))
    for i, c in enumerate(columns):
        x = np.nan_to_num(np.array(c.cast(pa.float64()).fill_null(0)), posinf=0, neginf=0)
        out[:, i] = np.sign(x) * np.log1p(np.abs(x))
    return out


def majority_labels(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(key, label) with one row a document; without those whose labels are null or tie."""
    mean = F.avg(F.col(f"`{label}`").cast("double"))
    return (
        labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("key"))
        .agg(mean.alias("mean"))
        .where("mean <> 0.5")
        .select("key", (F.col("mean") > 0.5).cast("int").alias("label"))
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    metadata: tuple[str, ...] = (),
    rows: int = TRAINING_ROWS,
) -> Machine | None:
    """A machine fitted to at most ``rows`` labelled documents, or None without any.

    ``labels`` has (key, label) as from ``majority_labels``."""
    sample = labels.orderBy(F.xxhash64("key"), "key").limit(rows)
    known = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
        *[F.col(f"`{m}`").cast("double").alias(f"m{i}") for i, m in enumerate(metadata)],
    ).join(F.broadcast(sample), "key")  # at most `rows` rows of two numbers
    names = [f"m{i}" for i in range(len(metadata))]

    def featured(batches):
        for batch in batches:
            keys, label = batch.column("key"), batch.column("label")
            for data, offsets, (k, y, *meta) in _parts(batch.column("text"), keys, label, *[batch.column(c) for c in names]):
                row, idx, value, stats = vectors(data, offsets)
                stats = np.hstack([stats, _meta(meta, len(stats))])
                cut = np.searchsorted(row, np.arange(len(stats) + 1))
                packed = [
                    pickle.dumps((idx[a:b].astype(np.int16), value[a:b].astype(np.float32), s, int(label)))
                    for a, b, s, label in zip(cut[:-1], cut[1:], stats, y.to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([k.cast(pa.string()), pa.array(packed, pa.binary())], names=["key", "features"])

    def trained(batches):
        rows = [pickle.loads(f) for b in batches for f in b.column("features").to_pylist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(rows))], pa.binary())], names=["model"])

    made = (
        known.withColumn("key", F.col("key").cast("string"))
        .mapInArrow(tidy(featured), "key string, features binary")
        .repartition(1)  # the bounded sample
        .sortWithinPartitions("key", "features")
        .mapInArrow(tidy(trained), "model binary")
        .collect()
    )
    return pickle.loads(made[0]["model"]) if made else None


def score(
    df: DataFrame,
    machine: Machine | None,
    text: str = "text",
    metadata: tuple[str, ...] = (),
    into: str = "score",
) -> DataFrame:
    """Add the probability that a document is good."""
    if machine is None:
        return df.withColumn(into, F.lit(0.5))

    places = [df.columns.index(c) for c in (text, *metadata)]

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        out = [np.zeros(0)]
        columns = [batch.column(i) for i in places]
        for data, offsets, own in _parts(*columns):
            row, idx, value, stats = vectors(data, offsets)
            out.append(machine.score(row, idx, value, np.hstack([stats, _meta(own, len(stats))])))
        return [pa.array(np.concatenate(out), pa.float64())]

    return with_columns(df, f"`{into}` double", lambda: work, SLICE_BYTES, text)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key's text leaves no remainder by 5; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))
