"""Benchmark decontamination by spaced seeds.

A seed takes the words at the marked places of a fixed mask and ignores the others, so a
substituted word spoils only the seeds that look at it. Seeds of benchmark items are indexed by
hash; every place of every document is hashed by every mask and looked up. A hit gives an item and
a shift against the document; along that shift the words are compared, and the stretch with most
equal words among those where they make up at least ``SHARE`` of the words (the shorter one if
equal) is an overlap if it holds at least ``LEAST_WORDS`` equal words, or that share of an item of
few more, or all words of a shorter one. However the substitutions lie in a stretch, only their share counts. A best-scoring stretch
(a match counts 1, a substitution ``-PENALTY``, the longer one on ties) is taken where none has
that share.

Words are runs of letters and digits, lower-cased in A-Z. Items shorter than a mask are looked up
as they are; items of fewer than ``SHORTEST`` words are left out, as chance would find them. The
benchmark is taken in blocks of about ``BLOCK_BYTES`` (by a hash of the item), so what is broadcast
is bounded whatever its size; each block meets all documents.

Null and empty texts overlap with nothing. Rows with null ids are looked at like others. Repeated
rows give repeated overlaps; repeated items count by their id. Empty tables give no overlaps.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.llm.bytewords import SIGNS, chunks, lowered, mix, text_bytes, word_hashes, words
from clearledger.llm.tables import written
from clearledger.llm.workers import tidy

#: Fixed masks: 1 looks at a word, 0 ignores it.
MASKS = ("11101001011", "11011000111", "10110110011")
LEAST_WORDS = 13
SHORTEST = 6
PENALTY = 4
SHARE = 0.75
BLOCK_BYTES = 8 << 20
BLOCKS_IN_A_ROW = 4
FILTER_BITS = 22
U64 = np.uint64
_MULTIPLY = mix(np.arange(1, 129, dtype=U64)) | U64(1)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    data = lowered(data)
    starts, ends, first = words(data, offsets, SIGNS)
    return word_hashes(data, starts, ends), first


def _seeds(h: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of the seed that begins at each word (no account of where texts end)."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.full(n, U64(salt))
    for at, looks in enumerate(mask):
        if looks == "1":
            total += h[at : at + n] * _MULTIPLY[at]
    return mix(total)


def least_equal(length: int) -> int:
    """The equal words that an overlap with an item of a length needs."""
    return length if length < LEAST_WORDS else min(LEAST_WORDS, math.ceil(SHARE * length))


def _shared(same: np.ndarray) -> tuple[int, int, int] | None:
    """(begin, end, equal) of the stretch with most equal words, and then fewest others, among those
    whose share of equal words is at least ``SHARE``. It begins and ends with an equal word."""
    at = np.flatnonzero(same)
    if not len(at):
        return None
    # equal - SHARE * words of at[i] .. at[j] is not negative: gain[j] >= lose[i]
    rank = np.arange(len(at))
    gain, lose = rank + 1 - SHARE * (at + 1), rank - SHARE * at
    first = np.minimum.accumulate(lose)  # falls, so the first place where it suffices has most words
    begin = np.searchsorted(-first, -gain - 1e-9, "left")
    equal = rank + 1 - begin
    most = np.flatnonzero(equal == equal.max())
    end = most[np.argmin(at[most] - at[begin[most]])]
    return int(at[begin[end]]), int(at[end]) + 1, int(equal[end])


def _scored(same: np.ndarray) -> tuple[int, int, int]:
    """(begin, end, equal) of the best-scoring stretch, the one with more equal words on ties."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
    lowest = np.minimum.accumulate(total)
    best = total - lowest
    ends = np.flatnonzero(best == best.max())
    begins = [int(np.argmin(total[: e + 1])) for e in ends]
    equal = [int(same[b:e].sum()) for b, e in zip(begins, ends, strict=True)]
    i = int(np.argmax(equal))
    return begins[i], int(ends[i]), equal[i]


class SeedIndex:
    """The seeds of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        h, first = _words(pa.array([t or "" for _, t in items], pa.string()))
        self.words = [h[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        span = max(map(len, MASKS))
        lengths = {len(w) for w in self.words if SHORTEST <= len(w) < span}
        self.masks = [*MASKS, *("1" * n for n in sorted(lengths))]
        found, item, place = [], [], []
        for number, w in enumerate(self.words):
            for salt, mask in enumerate(self.masks):
                if (salt < len(MASKS) and len(w) >= span) or (salt >= len(MASKS) and len(w) == len(mask)):
                    s = _seeds(w, mask, salt)
                    found.append(s)
                    item.append(np.full(len(s), number))
                    place.append(np.arange(len(s)))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        seeds = join(found, U64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], join(item, np.int64)[order], join(place, np.int64)[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.seeds >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, room: np.ndarray):
        """(place in the texts, item, place in the item) of seeds that texts share with items."""
        for salt, mask in enumerate(self.masks):
            s = _seeds(h, mask, salt)
            at = np.flatnonzero(self.maybe[(s >> U64(64 - FILTER_BITS)).astype(np.int64)])
            at = at[room[at] >= len(mask)]
            lo, hi = np.searchsorted(self.seeds, s[at], "left"), np.searchsorted(self.seeds, s[at], "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for k in range(a, b):
                    yield p, int(self.item[k]), int(self.place[k])

    def overlaps(self, column: pa.Array) -> list[list[tuple[int, int, int, int]]]:
        """For each text its overlaps (item id, first word, words, equal words)."""
        h, first = _words(column)
        n = len(first) - 1
        row_of = np.repeat(np.arange(n), np.diff(first))
        room = first[1:][row_of] - np.arange(len(h))
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in range(n)]
        seen: set[tuple[int, int, int]] = set()
        for p, item, place in self.hits(h, room):
            row, shift = int(row_of[p]), p - place
            if (row, item, shift) in seen:
                continue
            seen.add((row, item, shift))
            best = self._stretch(h[first[row] : first[row + 1]], self.words[item], shift - int(first[row]))
            if best:
                out[row].append((self.ids[item], *best))
        return [sorted(set(o)) for o in out]

    @staticmethod
    def _stretch(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
        """(first word, words, equal words) of the best stretch of the item laid at a shift."""
        a, b = max(0, -shift), min(len(item), len(text) - shift)
        same = text[a + shift : b + shift] == item[a:b]
        need = least_equal(len(item))
        if int(same.sum()) < need:
            return None
        found = _shared(same)
        if found is None or found[2] < need:
            found = _scored(same)
        begin, end, equal = found
        if equal < need:
            return None
        return a + begin + shift, end - begin, equal


def _blocks(benchmark: DataFrame, text: str, key: str) -> list[SeedIndex]:
    """Indexes of the items, in blocks of bounded size; only one block at a time is collected."""
    items = benchmark.select(F.col(f"`{key}`").cast("long").alias("i"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).distinct().sort("i", "t").collect()
        yield SeedIndex([(r.i, r.t) for r in rows])


OVERLAP = "doc_id long, item_id long, first_word long, n_words long, n_equal long"


def overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id"
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, n_equal): each overlap of a document with an item."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    found = None
    for index in _blocks(benchmark, text, item):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def look(batches, shared=shared):
            for whole in batches:
                for batch in chunks(whole, 1):
                    ids, told = batch.column(0).to_pylist(), shared.value.overlaps(batch.column(1))
                    out = [(d, *o) for d, found in zip(ids, told, strict=True) for o in found]
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                            names=["doc_id", "item_id", "first_word", "n_words", "n_equal"],
                        )

        part = rows.mapInArrow(tidy(look), OVERLAP)
        found = part if found is None else found.union(part)
    return found


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """The rows, with all their columns, of documents that overlap with no item."""
    place = docs.columns.index(text)
    for number, index in enumerate(_blocks(benchmark, text, item)):
        if number and number % BLOCKS_IN_A_ROW == 0:  # so many indexes at once in a task
            docs = written(docs, "clean")
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches, shared=shared):
            for whole in batches:
                for batch in chunks(whole, place):
                    clean = [not o for o in shared.value.overlaps(batch.column(place))]
                    yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(tidy(keep), docs.schema)
    return docs
