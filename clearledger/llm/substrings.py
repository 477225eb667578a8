"""Removal of repeated text: byte strings anywhere (suffix arrays) and word windows of earlier
documents (suffix trees).

Both find repeats through the anchors of ``anchors``. ``remove_repeated_bytes`` sorts the suffixes
at the anchors by deep-shallow sorting. ``remove_earlier_windows`` groups the suffixes by a prefix,
the gram at the anchor; a group too large for a task is split by a longer prefix, the whole window;
each group's windows are sorted into a suffix tree, whose nodes a window deep are its repeats.

Rows that share a document id are one document, none of them smaller than another; each has spans of
its own, found by id and text, so equal rows have equal spans. Rows with a null id take no part and
are kept whole. Null texts are empty; texts shorter than a window are kept whole.
Repeats are judged on the input, never on what is left. Columns other than key and text are
ignored, so they cannot clash. An empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.llm import anchors
from clearledger.llm.bytewords import chunks, fresh_seed
from clearledger.llm.suffixes import longest
from clearledger.llm.tables import written
from clearledger.llm.workers import tidy

BYTES, BYTE_GRAM = 400, 64
WORDS, WORD_GRAM = 50, 20
#: Representatives of one gram that a task holds in memory; the rest go by whole windows.
GROUP_ROWS = 20_000
SPAN = "doc long, row long, start long, end long"
_SPAN = ["doc", "row", "start", "end"]


def _input(docs: DataFrame, text: str, key: str, seed: int) -> DataFrame:
    """(doc, row, text); the row is told by a hash of its text, which rows of one id may share."""
    said = F.col(f"`{text}`")
    row = F.xxhash64(F.lit(seed), said).alias("row")
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc"), row, said.alias("text"))


def _spans(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names=_SPAN)


def _by_gram(rows: DataFrame, handle, schema: str, at_least: int) -> DataFrame:
    """Apply handle to lists of whole groups of rows of a gram, at least so many rows a call."""

    def made(batches):
        held: list[dict] = []
        for whole in batches:
            for batch in chunks(whole, whole.schema.get_field_index("units")):
                for r in batch.to_pylist():
                    if len(held) >= at_least and held[-1]["gram"] != r["gram"]:
                        yield from handle(held)
                        held = []
                    held.append(r)
        if held:
            yield from handle(held)

    return rows.repartition("gram").sortWithinPartitions("gram", "context", "check").mapInArrow(tidy(made), schema)


def _repeats(rows: list[dict], window: int):
    """Spans of bytes that another representative of the gram has too."""
    out, at = [], 0
    while at < len(rows):
        to = at + 1
        while to < len(rows) and rows[to]["gram"] == rows[at]["gram"]:
            to += 1
        group = rows[at:to]
        if to - at > 1:
            before = [r["units"][: r["lead"]][::-1] for r in group]
            after = [r["units"][r["lead"] :] for r in group]
            for r, (back, ahead) in zip(group, longest(before, after, window), strict=True):
                if back + ahead:
                    place = r["start"] + r["lead"]
                    out.append((r["doc"], r["row"], place - back, place + ahead))
        at = to
    if out:
        yield _spans(*zip(*out, strict=True))


def remove_repeated_bytes(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = BYTES, gram: int = BYTE_GRAM
) -> DataFrame:
    """(key, n_bytes, spans, kept): each document without the bytes of strings of ``window`` bytes
    that also start anywhere else. ``spans`` are the maximal removed runs, ``kept`` the rest."""
    seed = fresh_seed()
    rows = _input(docs, text, key, seed)
    named = rows.where("doc IS NOT NULL")
    judged = written(anchors.judged_rows(anchors.anchor_rows(named, "byte", window, gram, False, seed), ordered=False), "judged")
    settled = judged.where(F.col("what") == anchors.SETTLED).select(
        "doc", "row", "start", (F.col("start") + F.col("n") - 1 + window).alias("end")
    )
    waiting = anchors.with_units(judged.where(F.col("what") == anchors.REPRESENTATIVE), named, "byte", window, seed)
    small, large = anchors.split_by_size(written(waiting, "waiting"), GROUP_ROWS)
    found = settled.union(written(_by_gram(small, lambda r: _repeats(r, window), SPAN, 500), "found"))
    if large is not None:
        found = found.union(anchors.repeated_windows(large, window, ordered=False).select(*_SPAN))

    def cut(batches):
        for whole in batches:
            for batch in chunks(whole, 1):
                out = []
                for doc, raw, spans in zip(*_columns(batch), strict=True):
                    raw = raw or b""
                    gone = anchors.union_of(spans)
                    edges = [0, *(e for s in gone for e in s), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((doc, len(raw), [{"start": a, "end": b} for a, b in gone], kept))
                yield _rows(out, _CUT_BYTES)

    schema = "doc long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    made = anchors.with_spans(rows, found).select("doc", "text", "spans").mapInArrow(tidy(cut), schema)
    return made.withColumnRenamed("doc", key)


def _columns(batch: pa.RecordBatch):
    return batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_CUT_BYTES = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("spans", _SPANS), ("kept", pa.binary())])
_CUT_WORDS = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS), ("kept", pa.string())])


#: Neighbouring suffixes compared at once.
_ABREAST = 4_096


def tree_nodes(rows: list[dict], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix trees of groups of rows, cut off at window depth: (row, window number) of each
    suffix in order, the depth it has in common with the one before, and its group."""
    grams = {g: i for i, g in enumerate(dict.fromkeys(r["gram"] for r in rows))}
    row = np.repeat(np.arange(len(rows)), [r["n"] for r in rows])
    number = np.concatenate([np.arange(r["n"]) for r in rows])
    group = np.array([grams[r["gram"]] for r in rows])[row]
    text = np.concatenate([np.frombuffer(r["units"], np.uint64) for r in rows])
    begin = np.cumsum([0, *(len(r["units"]) // 8 for r in rows)])[row] + number
    # by the last word first, one word at a time: no suffix is written out, however large the group
    order = np.arange(len(begin))
    for k in reversed(range(window)):
        order = order[np.argsort(text[begin[order] + k], kind="stable")]
    order = order[np.argsort(group[order], kind="stable")]
    begun, words = begin[order], np.arange(window)
    depth = np.full(max(len(order) - 1, 0), window)
    for a in range(0, len(depth), _ABREAST):
        places = begun[a : a + _ABREAST + 1, None] + words
        differ = text[places[1:]] != text[places[:-1]]
        depth[a : a + _ABREAST] = np.where(differ.any(axis=1), differ.argmax(axis=1), window)
    depth[group[order[1:]] != group[order[:-1]]] = 0
    return row[order], number[order], np.append(0, depth), group[order]


def _earlier(rows: list[dict], window: int):
    """(doc, start, end, rep_start) of windows that a smaller document of the group has."""
    row, number, depth, _ = tree_nodes(rows, window)
    docs, own = np.array([r["doc"] for r in rows])[row], np.array([r["row"] for r in rows])[row]
    node = np.flatnonzero(depth < window)  # where another deep node, or a single window, begins
    least = np.repeat(np.minimum.reduceat(docs, node), np.diff(np.append(node, len(docs))))
    again = docs > least
    if again.any():
        rep = np.array([r["start"] for r in rows])[row][again]
        start = rep + number[again]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (docs[again], own[again], start, start + window, rep)], names=[*_SPAN, "rep_start"]
        )


def remove_earlier_windows(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WORDS, gram: int = WORD_GRAM
) -> DataFrame:
    """(key, n_words, spans, kept): each document without the words of windows whose words also
    start in a document with a smaller key. ``spans`` are runs of word numbers, ``kept`` the other
    words, joined by one space."""
    seed = fresh_seed()
    rows = _input(docs, text, key, seed)
    named = rows.where("doc IS NOT NULL")
    judged = written(anchors.judged_rows(anchors.anchor_rows(named, "word", window, gram, True, seed), ordered=True), "judged")
    settled = judged.where(F.col("what") == anchors.SETTLED).select(
        "doc", "row", "start", (F.col("start") + F.col("n") - 1 + window).alias("end")
    )
    waiting = anchors.with_units(judged.where(F.col("what") == anchors.REPRESENTATIVE), named, "word", window, seed)
    small, large = anchors.split_by_size(written(waiting, "waiting"), GROUP_ROWS)
    schema = f"{SPAN}, rep_start long"
    found = written(_by_gram(small, lambda r: _earlier(r, window), schema, 1_000), "found")
    if large is not None:
        found = found.union(anchors.repeated_windows(large, window, ordered=True))
    # the same context again in the same document: the same windows, moved
    twin = judged.where(F.col("what") == anchors.TWIN).select(
        "doc",
        F.col("row").alias("own"),
        F.col("start").alias("moved"),
        F.col("twin_row").alias("row"),
        F.col("twin").alias("rep_start"),
    )
    moved = found.join(twin, ["doc", "row", "rep_start"]).select(
        "doc",
        F.col("own").alias("row"),
        (F.col("start") + F.col("moved") - F.col("rep_start")).alias("start"),
        (F.col("end") + F.col("moved") - F.col("rep_start")).alias("end"),
    )
    found = settled.union(found.select(*_SPAN)).union(moved)

    def cut(batches):
        for whole in batches:
            for batch in chunks(whole, 1):
                out = []
                for doc, raw, spans in zip(*_columns(batch), strict=True):
                    said = (raw or b"").split()
                    gone = anchors.union_of(spans)
                    edges = [0, *(e for s in gone for e in s), len(said)]
                    kept = b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in said[a:b])
                    out.append((doc, len(said), [{"start": a, "end": b} for a, b in gone], kept.decode("utf-8", "replace")))
                yield _rows(out, _CUT_WORDS)

    schema = "doc long, n_words long, spans array<struct<start:long,end:long>>, kept string"
    made = anchors.with_spans(rows, found).select("doc", "text", "spans").mapInArrow(tidy(cut), schema)
    return made.withColumnRenamed("doc", key)
