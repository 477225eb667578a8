"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads a text's UTF-8 bytes in segments of ``SEGMENT`` bytes, forwards and backwards,
with its state at zero where a segment begins, and gives every position a probability of each
language. Gates and candidates are squashed by x / (1 + |x|), which costs a tenth of exponentials. A
document's probabilities are the mean over all its positions; no byte is left out.

Weights are trained here, by backpropagation through time and Adam, on a bounded sample of labelled
documents: at most ``TRAINING_ROWS``, as many of each language as there are, lowest id hash first,
and of each ``TRAINING_SEGMENTS`` segments spread evenly over its text. Only this sample meets in
one task. The languages are those of the sample.

Texts that are null, empty or without a letter are ``und`` with a score of 0, and so are all texts
if nothing can be learnt. Equal probabilities go to the language that sorts first. Rows with a null
language or id are not learnt from. Repeated rows get equal results; columns named like the added
ones are replaced, others pass through. An empty table gives an empty one.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearledger.llm.bytewords import text_bytes
from clearledger.llm.workers import tidy, with_columns

SEGMENT = 64
HIDDEN = 8
TRAINING_ROWS = 3_000
TRAINING_SEGMENTS = 6
STEPS = 220
BATCH = 256
RATE = 0.02
SEED = 5
#: Segments that the network reads side by side.
ABREAST = 2_048
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[[*range(65, 91), *range(97, 123)]] = True


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place; its derivative is (1 - |result|) ** 2."""
    below = np.abs(x)
    below += 1
    x /= below
    return x


@dataclass
class Direction:
    """A gated recurrent layer that reads bytes: by byte what it adds to update gate, reset gate
    and candidate (256, 3 H), and the same from the last state (H, 3 H)."""

    byte: np.ndarray
    state: np.ndarray

    def states(self, bytes_: np.ndarray, valid: np.ndarray, kept: list | None = None) -> np.ndarray:
        """States (T, B, H) after each step of (T, B) bytes; where not valid the state is zero.
        ``kept`` takes what backpropagation needs."""
        steps, n = bytes_.shape
        size = self.state.shape[0]
        h = np.zeros((n, size), np.float32)
        out = np.empty((steps, n, size), np.float32)
        for t in range(steps):
            x, g = self.byte.take(bytes_[t], axis=0), h @ self.state
            gates = _squash(x[:, : 2 * size] + g[:, : 2 * size])
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:, :size], gates[:, size:]
            new = _squash(x[:, 2 * size :] + reset * g[:, 2 * size :])
            if kept is not None:
                kept.append((h, update, reset, new, g[:, 2 * size :]))
            h = h - new
            h *= update
            h += new
            if not valid[t].all():
                h *= valid[t][:, None]
            out[t] = h
        return out

    def gradients(self, bytes_: np.ndarray, valid: np.ndarray, kept: list, into: np.ndarray) -> list[np.ndarray]:
        """Gradients of both weights from those of the states, by going back through time."""
        steps, n = bytes_.shape
        size = self.state.shape[0]
        by_state, back = np.zeros_like(self.state), np.zeros((n, size), np.float32)
        by_byte = np.empty((steps, n, 3 * size), np.float32)
        for t in range(steps - 1, -1, -1):
            h, update, reset, new, g = kept[t]
            d = (into[t] + back) * valid[t][:, None]
            d_new = d * (1 - update) * (1 - np.abs(new)) ** 2
            d_update = d * (h - new) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
            d_reset = d_new * g * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
            by_byte[t] = np.concatenate([d_update, d_reset, d_new], axis=1)
            from_state = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            by_state += h.T @ from_state
            back = d * update + from_state @ self.state.T
        flat = bytes_.ravel()
        order = np.argsort(flat, kind="stable")
        held, first = np.unique(flat[order], return_index=True)
        summed = np.zeros_like(self.byte)
        summed[held] = np.add.reduceat(by_byte.reshape(-1, 3 * size)[order], first)
        return [summed, by_state]


@dataclass
class Network:
    """Both directions and the layer that labels positions with languages."""

    languages: list[str]
    forwards: Direction
    backwards: Direction
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        some = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
        layer = lambda: Direction(some(256, 3 * hidden), some(hidden, 3 * hidden))
        return cls(languages, layer(), layer(), some(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.forwards.byte, self.forwards.state, self.backwards.byte, self.backwards.state, self.out, self.bias]

    def positions(self, bytes_: np.ndarray, valid: np.ndarray, kept: tuple[list, list] | None = None):
        """States of each direction (T, B, H) and probabilities (T, B, languages)."""
        a, b = kept or (None, None)
        ahead = self.forwards.states(bytes_, valid, a)
        behind = self.backwards.states(bytes_[::-1], valid[::-1], b)[::-1]
        size = self.forwards.state.shape[0]
        score = ahead @ self.out[:size]
        score += behind @ self.out[size:]
        score += self.bias
        score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=2, keepdims=True)
        return (ahead, behind), score

    def loss_and_gradients(self, bytes_: np.ndarray, valid: np.ndarray, label: np.ndarray):
        """Mean cross-entropy of the valid positions and its gradients, in the order of weights."""
        kept: tuple[list, list] = ([], [])
        states, p = self.positions(bytes_, valid, kept)
        total = max(float(valid.sum()), 1.0)
        column = np.arange(len(label))
        loss = -(np.log(np.maximum(p[:, column, label], 1e-30)) * valid).sum() / total
        d = p.copy()
        d[:, column, label] -= 1
        d *= (valid / np.float32(total))[:, :, None]
        size = self.forwards.state.shape[0]
        into = d @ self.out.T
        flat = d.reshape(-1, d.shape[2])
        own = [np.concatenate([s.reshape(-1, size).T @ flat for s in states]), d.sum(axis=(0, 1))]
        first = self.forwards.gradients(bytes_, valid, kept[0], into[:, :, :size])
        second = self.backwards.gradients(bytes_[::-1], valid[::-1], kept[1], into[::-1, :, size:])
        return float(loss), [*first, *second, *own]

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each document (rows) over all its bytes; zero for empty ones."""
        length = np.diff(offsets)
        n = -(-length // SEGMENT)
        doc = np.repeat(np.arange(len(length)), n)
        within = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * SEGMENT
        start, size = offsets[doc] + within, np.minimum(SEGMENT, length[doc] - within)
        out = np.zeros((len(length), len(self.languages)))
        steps = np.arange(SEGMENT)[:, None]
        for at in range(0, len(doc), ABREAST):
            s, m, of = start[at : at + ABREAST], size[at : at + ABREAST], doc[at : at + ABREAST]
            valid = (steps < m).astype(np.float32)
            _, p = self.positions(data[np.minimum(s + steps, len(data) - 1)], valid)
            np.add.at(out, of, (p * valid[:, :, None]).sum(axis=0))
        return out / np.maximum(length, 1)[:, None]


def train(segments: list[bytes], labels: list[str], steps: int = STEPS) -> Network:
    """A network fitted to labelled segments in the order given."""
    languages = sorted(set(labels))
    number = {name: i for i, name in enumerate(languages)}
    size = np.array([len(s) for s in segments])
    table = np.frombuffer(b"".join(s.ljust(SEGMENT, b"\0") for s in segments), np.uint8).reshape(-1, SEGMENT).T
    valid = (np.arange(SEGMENT)[:, None] < size).astype(np.float32)
    label = np.array([number[x] for x in labels])
    network = Network.new(languages)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network.weights]
    rng = np.random.default_rng(SEED)
    for step in range(1, steps + 1):
        take = rng.integers(0, len(label), BATCH)
        _, gradients = network.loss_and_gradients(table[:, take], valid[:, take], label[take])
        rate = RATE * (1 - (step - 1) / steps)
        for w, g, (a, b) in zip(network.weights, gradients, moments, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return network


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", language: str = "lang") -> Network | None:
    """A network fitted to a bounded sample of the documents with text, id and language, or None."""
    known = docs.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{language}`").cast("string").alias("l"), F.col(f"`{text}`").alias("t")
    ).where("k IS NOT NULL AND l IS NOT NULL")
    hashed = known.where(F.col("t").rlike(r"\p{L}")).select("k", "l", F.shiftrightunsigned(F.xxhash64("k"), 1).alias("h"))
    # of a language with n rows about twice the wanted ones have so low a hash: the others need no shuffle
    sizes = hashed.groupBy("l").count().orderBy(F.desc("count"), "l").limit(TRAINING_ROWS)
    low = hashed.join(F.broadcast(sizes), "l").where(F.col("h") < F.lit(2.0**64) * TRAINING_ROWS / F.col("count"))
    order = Window.partitionBy("l").orderBy("h", "k")
    placed = low.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TRAINING_ROWS)
    chosen = placed.orderBy("place", "h", "l").limit(TRAINING_ROWS).select("k", "l").distinct()
    rows = known.join(F.broadcast(chosen), ["k", "l"])  # at most TRAINING_ROWS rows of two values

    def cut(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                raw = raw or b""
                n = -(-len(raw) // SEGMENT)
                places = sorted({i * n // TRAINING_SEGMENTS for i in range(TRAINING_SEGMENTS)}) if n else []
                parts = [raw[i * SEGMENT : (i + 1) * SEGMENT] for i in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()), pa.array(parts, pa.binary())], names=["l", "segment"]
                )

    def trained(batches):
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        if rows:
            model = train([r[1] for r in rows], [r[0] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = (
        rows.select("l", "t")
        .mapInArrow(cut, "l string, segment binary")
        .repartition(1)  # the bounded sample
        .sortWithinPartitions("segment", "l")
        .mapInArrow(tidy(trained), "model binary")
        .collect()
    )
    return pickle.loads(made[0]["model"]) if made else None


def _with_letters(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a letter; only texts without an ASCII one are decoded."""
    ascii_ = np.concatenate([[0], np.cumsum(_LETTER_BYTE[data])])
    out = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
    for i in np.flatnonzero(~out & (offsets[1:] > offsets[:-1])):
        raw = data[offsets[i] : offsets[i + 1]].tobytes()
        out[i] = LETTER.search(raw.decode("utf-8", "replace")) is not None
    return out


def predict(
    df: DataFrame, network: Network | None, text: str = "text", into: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the language of each text and the document's probability of it."""
    if network is None:
        return df.withColumns({into: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast(network)  # some 100 KB, whatever the corpus
    place = df.columns.index(text)

    def start():
        own = shared.value

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            data, offsets = text_bytes(batch.column(place))
            p = own.documents(data, offsets)
            best, known = p.argmax(axis=1), _with_letters(batch.column(place), data, offsets)
            names = [own.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            sure = np.where(known, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
            return [pa.array(names, pa.string()), pa.array(sure, pa.float64())]

        return work

    return with_columns(df, f"`{into}` string, `{score}` double", start, SLICE_BYTES, text)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key's text leaves the remainder 1 by 3; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
