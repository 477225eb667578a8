"""Ranked lexical search by scanning the documents with an automaton of all item terms.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased. A text is normalised to its terms between blanks, and the automaton holds each term
between two blanks, so that a match is a whole term; neighbouring matches share their blank. The
automaton's outputs map to the items that hold the term. No index of the documents is made: one
scan counts documents, terms and document frequencies, a second counts term frequencies and scores.

A term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles; all else is 64-bit integer.
With m = 75 + (25 n N) div L a document scores the sum of w * ((10**9 tf) div (1000 tf + 12 m)) over
the item's terms, repeats included.

Items come in blocks of ``BLOCK_BYTES`` of text (a longer item is a block of its own), which bounds
automaton, broadcast and score table; every block is scanned against all documents. A task keeps the
k best documents of each item and a bounded buffer; these meet in two salted steps, so that no task
ranks what all tasks found for an item.

Null and empty texts have no terms: such documents do not count, such items find nothing. Null ids
of documents rank first among equal scores; rows that share an id are documents of their own, and
items that share an id are ranked one by one. Very long texts are scanned whole. Other columns are
ignored, so they cannot clash. Without documents or items the result is empty.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.llm.bytewords import chunks
from clearledger.llm.tables import written
from clearledger.llm.workers import tidy

BLOCK_BYTES = 1 << 21
#: Cells of a score table (documents by items), and entries added to it, worked on at once.
CELLS = 1 << 20
SALTS = 64
SLICE_BYTES = 1 << 21
N_DOCUMENTS, N_TERMS = -1, -2

#: Bytes that are not in terms become blanks, A-Z become a-z.
_NORMAL = bytearray(b" " * 128 + bytes(range(128, 256)))
for _b in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _NORMAL[_b] = _b
for _b in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _NORMAL[_b] = _b + 32
_NORMAL = bytes(_NORMAL)


def normalised(text: bytes | None) -> bytes:
    """The terms of a text, a character a byte, with blanks between and around them."""
    return b" " + (text or b"").translate(_NORMAL) + b" "


class Items:
    """A block of items: their terms, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[bytes | None]):
        held = [Counter(normalised(t).split()) for t in texts]
        self.n = len(texts)
        self.terms = sorted({t for h in held for t in h})
        number = {t: i for i, t in enumerate(self.terms)}
        entries = sorted((number[t], i, times) for i, h in enumerate(held) for t, times in h.items())
        table = np.array(entries, np.int64).reshape(-1, 3)
        self.begin = np.searchsorted(table[:, 0], np.arange(len(self.terms) + 1))
        self.item, self.times = table[:, 1], table[:, 2]

    def automaton(self) -> ahocorasick.Automaton | None:
        """Each term between blanks, giving its number; None if there are no terms."""
        if not self.terms:
            return None
        find = ahocorasick.Automaton()
        for i, term in enumerate(self.terms):
            find.add_word(f" {term.decode('latin-1')} ", i)
        find.make_automaton()
        return find


def _read(batches, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for batch in chunks(whole, column, SLICE_BYTES):
            yield batch, [normalised(t) for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def _found(find: ahocorasick.Automaton | None, text: bytes) -> Iterator[int]:
    """The number of every occurrence of a term."""
    return map(itemgetter(1), find.iter(text.decode("latin-1"))) if find else iter(())


def frequencies(docs: DataFrame, items) -> DataFrame:
    """(term, n): in how many documents each term of the items (a broadcast) occurs, and under
    ``N_DOCUMENTS`` and ``N_TERMS`` the documents with terms and all their terms."""

    def made(batches):
        find, seen = items.value.automaton(), Counter()
        for _, texts in _read(batches, 0):
            for text in texts:
                n = len(text.split())
                if n:
                    seen[N_DOCUMENTS] += 1
                    seen[N_TERMS] += n
                    seen.update(set(_found(find, text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"]
        )

    return docs.select("text").mapInArrow(tidy(made), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Best:
    """The k best documents of each item seen so far, by score, then id (null first)."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = np.zeros((0, 4), np.int64)  # item, score, whether there is an id, id
        self.room = max(4 * k * n_items, 1 << 16)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """A table of scores (documents by items)."""
        doc, item = np.nonzero(scores >= self.least)
        self.waiting.append(np.column_stack([item, scores[doc, item], known[doc], ids[doc]]))
        self.n_waiting += len(doc)
        if self.n_waiting > self.room:
            self.settle()

    def settle(self) -> None:
        rows = np.concatenate([self.rows, *self.waiting])
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begin = np.searchsorted(rows[:, 0], np.arange(len(self.least)))
        place = np.arange(len(rows)) - begin[rows[:, 0]]
        last = rows[place == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]
        self.rows, self.waiting, self.n_waiting = rows[place < self.k], [], 0


def _scores(items: Items, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The table of scores of some documents, from (document, term, frequency)."""
    part = weight[term] * (10**9 * tf // (1000 * tf + 12 * m[doc]))
    n = items.begin[term + 1] - items.begin[term]
    first = np.cumsum(n) - n
    entry = np.arange(n.sum()) + np.repeat(items.begin[term] - first, n)
    out = np.zeros(len(m) * items.n, np.int64)
    np.add.at(out, np.repeat(doc, n) * items.n + items.item[entry], np.repeat(part, n) * items.times[entry])
    return out.reshape(len(m), items.n)


def best_of_tasks(docs: DataFrame, items, weight, n_documents: int, n_terms: int, k: int, cells: int = CELLS) -> DataFrame:
    """(item, doc, score): the k best documents of each item, task by task, from (doc, text)."""

    def made(batches):
        block, w = items.value, weight.value
        find, best = block.automaton(), _Best(block.n, k)
        held: list[tuple[int | None, int, Counter]] = []  # id, m, frequencies
        added = 0

        def flush():
            if held:
                doc = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
                term = np.fromiter((t for h in held for t in h[2]), np.int64, len(doc))
                tf = np.fromiter((n for h in held for n in h[2].values()), np.int64, len(doc))
                known = np.array([h[0] is not None for h in held], np.int64)
                ids = np.array([h[0] or 0 for h in held], np.int64)
                best.add(_scores(block, w, doc, term, tf, np.array([h[1] for h in held], np.int64)), known, ids)
                held.clear()

        size = np.diff(block.begin)
        for batch, texts in _read(batches, 1):
            for key, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                tf = Counter(_found(find, text))
                if tf:
                    held.append((key, 75 + 25 * len(text.split()) * n_documents // n_terms, tf))
                    added += int(size[list(tf)].sum())
                    if added > cells or len(held) * block.n > cells:
                        flush()
                        added = 0
        flush()
        best.settle()
        rows = best.rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[:, 0].astype(np.int32)),
                pa.array(rows[:, 3], mask=rows[:, 2] == 0),
                pa.array(rows[:, 1]),
            ],
            names=["item", "doc", "score"],
        )

    return docs.select("doc", "text").mapInArrow(tidy(made), "item int, doc long, score long")


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, item: str, text: str, limit: int) -> Iterator[list]:
    """The items (id, text), streamed to the driver in blocks of bounded text."""
    held, size = [], 0
    for row in items.select(F.col(f"`{item}`"), F.col(f"`{text}`").cast("binary")).toLocalIterator():
        n = len(row[1] or b"") + 64
        if held and size + n > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += n
    if held:
        yield held


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    cells: int = CELLS,
) -> DataFrame:
    """(item, rank, key, score): the k documents with the highest scores above 0 of each item.

    ``block_bytes`` and ``cells`` bound what is worked on at once, never what is found."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    id_type = items.schema[item].dataType
    out_type = T.StructType(
        [T.StructField(item, id_type), T.StructField("rank", T.IntegerType()), T.StructField(key, T.LongType()), T.StructField("score", T.LongType())]
    )
    parts = []
    for block in _blocks(items, item, item_text, block_bytes):
        held = spark.sparkContext.broadcast(Items([r[1] for r in block]))
        counted = {r.term: r.n for r in frequencies(read, held).collect()}  # the block's terms
        n = counted.get(N_DOCUMENTS, 0)
        if not n:
            break
        df = [counted.get(i, 0) for i in range(len(held.value.terms))]
        w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df], np.int64)
        found = best_of_tasks(read, held, spark.sparkContext.broadcast(w), n, counted[N_TERMS], k, cells)
        salted = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
        ranked = _ranked(_ranked(salted, ["item", "salt"], k).drop("rank"), ["item"], k)
        names = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("of", id_type)])
        named = spark.createDataFrame([(i, r[0]) for i, r in enumerate(block)], names)
        told = ranked.join(named, "item").select(
            F.col("of").alias(item), "rank", F.col("doc").alias(key), "score"
        )
        parts.append(written(told, "ranked"))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], out_type)
