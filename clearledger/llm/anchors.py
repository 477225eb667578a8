"""Where long stretches of text repeat: anchors that equal stretches choose alike.

A window is a stretch of a fixed number of units (bytes or words) of one document. Its anchor is
the place within it whose gram (a shorter run of units) has the smallest hash, the leftmost if
several have. So equal windows have their anchors at the same offset before the same gram, and a
corpus of n units has only some 2 n / (window - gram) anchors to sort, not n suffixes.

The windows of one anchor are consecutive; they and their anchor make a row (gram, context, check,
doc, row, start, lead, n): the hash of the gram, two independent hashes of all units of its windows,
the document, the hash of its text, the first window's start, the anchor's distance from it and the
number of windows. Both hashes are sums modulo 2**61 - 1 under bases drawn for the job, so rows that
agree in gram, context and check have equal windows but for one in some 2**100 pairs, and are
settled without looking at any text. Of other rows with a common gram one representative of each
context goes on, with its units, to be sorted (see ``suffixes`` and ``substrings``). Every equality
of windows is found that way, for equal windows have equal grams.

Rows that share a document are told apart by the hash of their texts: each has stretches of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.llm.tables import written
from clearledger.llm.workers import tidy
from clearledger.llm.bytewords import SEED, chunks, hashing, mix, reduced, text_bytes, word_hashes, words

U64 = np.uint64
PIECE = 1 << 18
#: Contexts a task remembers, about 170 bytes each.
REMEMBERED = 500_000
PLACE_BITS = U64(20)  # a piece with its overlap has fewer units
KEYS = ["gram", "context", "check", "doc", "row", "start", "lead", "n"]
ROW = "gram long, context long, check long, doc long, row long, start long, lead int, n int"
#: What becomes of a row: its windows repeat; it stands for its context; it shares the document
#: and context of the representative that begins at `twin`.
SETTLED, REPRESENTATIVE, TWIN = 0, 1, 2


def units(column: pa.Array, unit: str, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each unit of all rows, and where each row begins (n + 1)."""
    data, offsets = text_bytes(column)
    if unit == "byte":
        return hashing(seed).values[data], offsets
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends, seed), first


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive values, by windows that double."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - have :]) if have < width else out


def anchored(
    values: np.ndarray, bounds: np.ndarray, window: int, gram: int, seed: int = SEED, others: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (row, start, lead, n, gram hash, context hash, check); starts count from the row's
    first unit. ``others`` are values of the same units by another seed, for the check.

    Long input is cut in pieces. A piece may cut the windows of an anchor in two; their contexts
    then differ from those of uncut copies, which costs sorting but loses nothing."""
    first_sums, second_sums = hashing(seed), hashing(seed + 1)
    others = values if others is None else others
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    room = bounds[1:][row_of] - np.arange(len(values))  # units from here to the row's end
    for at in range(0, len(values) - window + 1, PIECE):
        part = values[at : at + PIECE + window - 1]
        n = len(part) - window + 1
        prefix = first_sums.prefixes(reduced(part))
        second = second_sums.prefixes(reduced(others[at : at + PIECE + window - 1]))
        places = np.arange(len(part) - gram + 1)
        hashes = first_sums.stretches(prefix, places, places + gram)
        packed = (hashes >> PLACE_BITS << PLACE_BITS) | places.astype(U64)
        anchor = (sliding_minimum(packed, window - gram + 1)[:n] & U64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        row = row_of[at : at + n]
        inside = room[at : at + n] >= window
        label = np.where(inside, anchor, -1)
        change = np.flatnonzero((label[1:] != label[:-1]) | (row[1:] != row[:-1])) + 1
        first = np.append(0, change)
        last = np.append(change, n) - 1
        keep = inside[first]
        first, last = first[keep], last[keep]
        if not len(first):
            continue
        a = anchor[first]
        lead, count = a - first, last - first + 1
        shape = mix(lead.astype(U64) * U64(0x100000001B3) + count.astype(U64))
        context = mix(first_sums.stretches(prefix, first, last + window) + shape)
        check = mix(second_sums.stretches(second, first, last + window) + shape)
        yield row[first], at + first - bounds[row[first]], lead, count, hashes[a], context, check


class _Seen:
    """Which rows of a task need not meet rows of others: those that rows before settle.

    ``ordered``: a row whose context a smaller document has. Else: a row whose context two rows
    before have. So a context with very many rows costs each task one or two rows in the shuffle.
    Forgetting contexts, when there are too many to remember, only costs more such rows."""

    def __init__(self, ordered: bool):
        self.ordered, self.contexts = ordered, {}

    def settle(self, gram: np.ndarray, context: np.ndarray, check: np.ndarray, doc: np.ndarray) -> list[bool]:
        if len(self.contexts) > REMEMBERED:
            self.contexts.clear()
        seen, out = self.contexts, []
        for g, c, k, d in zip(gram.tolist(), context.tolist(), check.tolist(), doc.tolist(), strict=True):
            key = (g << 64 | c) << 64 | k
            before = seen.get(key)
            if self.ordered:
                out.append(before is not None and before < d)
                if before is None or d < before:
                    seen[key] = d
            else:
                out.append(before == 2)
                seen[key] = min((before or 0) + 1, 2)
        return out


def anchor_rows(docs: DataFrame, unit: str, window: int, gram: int, ordered: bool, seed: int) -> DataFrame:
    """A row for each anchor of each document (doc, row, text); ``told`` is true for rows that rows
    of the same task settle (see ``judged_rows`` for ``ordered``)."""

    def made(batches):
        seen = _Seen(ordered)
        for whole in batches:
            for batch in chunks(whole, 2):
                doc, own = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                values, bounds = units(batch.column(2), unit, seed)
                others = units(batch.column(2), unit, seed + 1)[0]
                for row, start, lead, n, g, c, k in anchored(values, bounds, window, gram, seed, others):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(k.view(np.int64)),
                            pa.array(doc[row]), pa.array(own[row]),
                            pa.array(start), pa.array(lead.astype(np.int32)), pa.array(n.astype(np.int32)),
                            pa.array(seen.settle(g, c, k, doc[row]), pa.bool_()),
                        ],
                        names=[*KEYS, "told"],
                    )

    return docs.select("doc", "row", "text").mapInArrow(tidy(made), f"{ROW}, told boolean")


def judged_rows(rows: DataFrame, ordered: bool) -> DataFrame:
    """(what, ROW, twin_row, twin): rows that repeat or may.

    Partitions are sorted by gram, context, check, document, row and start, and read as a stream that
    remembers three rows: the first of the gram, the first of the context, and the last. With
    ``ordered`` a row is settled if its context begins in a smaller document; else if any other
    row has its context. Representatives are told only for grams of several contexts. Rows already
    told go to any partition and pass through."""
    def judge(batches):
        last = first = head = None  # rows of one: last seen, first of its gram, first of its context
        last_told = first_told = False
        for batch in batches:
            t = np.column_stack([np.asarray(batch.column(c)).astype(np.int64) for c in KEYS])
            told = np.asarray(batch.column("told").to_numpy(zero_copy_only=False), bool)
            if told.any():
                yield _judged(t[told], SETTLED, t[told])
            t = t[~told]
            if not len(t):
                continue
            carried = last is not None
            if carried:
                t = np.vstack([last, t])
            n = len(t)
            new_gram = np.append(not carried, t[1:, 0] != t[:-1, 0])
            new_context = np.append(not carried, (t[1:, :3] != t[:-1, :3]).any(axis=1))
            index = np.arange(n)
            gram_at = np.maximum.accumulate(np.where(new_gram, index, -1))
            head_at = np.maximum.accumulate(np.where(new_context, index, -1))
            heads = t[np.maximum(head_at, 0)]
            if carried:
                heads[head_at < 0] = head
            own = index > 0 if carried else index >= 0
            later = own & ~new_context
            if ordered:
                settled = later & (t[:, 3] > heads[:, 3])
                twin = later & ~settled
            else:
                follows = np.append(~new_context[1:], False)  # the next row has the same context
                settled = later | (own & follows)
                if carried and follows[0] and not last_told:
                    settled[0] = True
                twin = np.zeros(n, bool)
            chosen = own & new_context & ~new_gram
            grams = np.unique(gram_at[chosen])  # grams with a second context: their first rows too
            chosen[grams[grams >= 0]] = True
            if len(grams) and grams[0] < 0 and not first_told:
                yield _judged(first, REPRESENTATIVE, first)
            out = [(t[m], what, heads[m]) for m, what in ((settled, SETTLED), (chosen, REPRESENTATIVE), (twin, TWIN)) if m.any()]
            for rows_, what, of in out:
                yield _judged(rows_, what, of)
            last_told = bool(settled[-1])
            goes_on = gram_at[-1] < 0
            first_told = (goes_on and first_told) or gram_at[-1] in grams
            if not goes_on:
                first = t[gram_at[-1] :][:1]
            head, last = heads[-1:], t[-1:]

    place = F.when(F.col("told"), F.xxhash64("doc", "start")).otherwise(F.col("gram"))
    sorted_rows = rows.repartition(place).sortWithinPartitions("gram", "context", "check", "doc", "row", "start")
    return sorted_rows.mapInArrow(tidy(judge), f"what int, {ROW}, twin_row long, twin long")


def _judged(rows: np.ndarray, what: int, heads: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(rows), what, np.int32))]
    columns += [pa.array(rows[:, i].astype(np.int32) if i > 5 else rows[:, i]) for i in range(len(KEYS))]
    columns += [pa.array(np.broadcast_to(heads[:, i], len(rows))) for i in (4, 5)]
    return pa.RecordBatch.from_arrays(columns, names=["what", *KEYS, "twin_row", "twin"])


def with_units(rows: DataFrame, docs: DataFrame, unit: str, window: int, seed: int) -> DataFrame:
    """Add ``units``: the bytes, or packed word hashes, of all windows of each row."""
    own = ["gram", "context", "check", "start", "lead", "n"]
    wanted = rows.groupBy("doc", "row").agg(F.collect_list(F.struct(*own)).alias("rows"))
    once = docs.join(wanted, ["doc", "row"]).select("doc", "row", "text", "rows")

    def cut(batches):
        for whole in batches:
            for batch in chunks(whole, 2):
                out, columns = [], (batch.column(i).to_pylist() for i in (0, 1, 3))
                for i, (doc, row, wanted) in enumerate(zip(*columns, strict=True)):
                    text = batch.column(2).slice(i, 1)
                    values = text_bytes(text)[0] if unit == "byte" else units(text, unit, seed)[0]
                    for r in wanted:
                        piece = values[r["start"] : r["start"] + r["n"] - 1 + window].tobytes()
                        out.append({**r, "doc": doc, "row": row, "units": piece})
                    if len(out) > 5_000:
                        yield pa.RecordBatch.from_pylist(out, schema=_UNITS)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_UNITS)

    return once.mapInArrow(tidy(cut), f"{ROW}, units binary")


_UNITS = pa.schema(
    [(n, pa.int64()) for n in KEYS[:6]] + [("lead", pa.int32()), ("n", pa.int32()), ("units", pa.binary())]
)


def split_by_size(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of grams with at most `limit` rows, and the others (None if there are none)."""
    large = written(rows.groupBy("gram").count().where(F.col("count") > limit).select("gram"), "large")
    if not large.limit(1).count():
        return rows, None
    return rows.join(large, "gram", "left_anti"), rows.join(large, "gram", "left_semi")


def repeated_windows(rows: DataFrame, window: int, ordered: bool) -> DataFrame:
    """(doc, row, start, end, rep_start) of windows that repeat, for grams with too many rows for a task.

    The prefix that splits them is the whole window: its 128-bit digest and the smallest document
    or the number of windows, aggregated before the shuffle."""

    def made(batches):
        for batch in batches:
            for r in batch.to_pylist():
                width = len(r["units"]) // (r["n"] - 1 + window)
                digests = [
                    hashlib.blake2b(r["units"][j * width : (j + window) * width], digest_size=16).digest()
                    for j in range(r["n"])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests, pa.binary()), pa.array([r["doc"]] * r["n"], pa.int64()),
                        pa.array([r["row"]] * r["n"], pa.int64()),
                        pa.array(range(r["start"], r["start"] + r["n"]), pa.int64()),
                        pa.array([r["start"]] * r["n"], pa.int64()),
                    ],
                    names=["digest", "doc", "row", "start", "rep_start"],
                )

    told = written(rows.mapInArrow(made, "digest binary, doc long, row long, start long, rep_start long"), "windows")
    known = told.groupBy(F.col("digest").alias("d")).agg(F.min("doc").alias("least"), F.count("*").alias("times"))
    again = F.col("doc") > F.col("least") if ordered else F.col("times") > 1
    # null-safe, so that a digest with very many rows can be split
    return told.join(known, F.col("digest").eqNullSafe(F.col("d"))).where(again).select(
        "doc", "row", "start", (F.col("start") + window).alias("end"), "rep_start"
    )


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, row, text, spans): each row of docs with its stretches, sorted."""
    listed = spans.groupBy(F.col("doc").alias("of"), F.col("row").alias("of_row")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )
    same = (F.col("doc") == F.col("of")) & (F.col("row") == F.col("of_row"))
    return docs.join(listed, same, "left").drop("of", "of_row")


def union_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted stretches with overlapping and touching ones as one."""
    out: list[tuple[int, int]] = []
    for s in spans or []:
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["end"]))
        else:
            out.append((s["start"], s["end"]))
    return out
