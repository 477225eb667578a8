"""What Python workers keep: nothing that outlives the task that made it."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Batches = Iterable[pa.RecordBatch]


def give_back() -> None:
    """Return memory that this worker no longer uses to the system.

    Workers outlive their tasks, and several may wait in an executor; without this each of them
    keeps the pools of its largest batch."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(made: Callable[[Batches], Iterator[pa.RecordBatch]]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """The same function over batches, which gives back its memory when the task ends."""

    def whole(batches: Batches) -> Iterator[pa.RecordBatch]:
        try:
            yield from made(batches)
        finally:
            give_back()

    return whole


def with_columns(
    df: DataFrame, added: str, start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], least: int, column: str
) -> DataFrame:
    """Add columns (in place of any of the same names), worked out from slices of about ``least``
    bytes of a text or binary ``column``.

    ``start`` is called once a task and returns the function of a slice, which has all columns of
    the frame, those to be replaced as well; what it holds ends with the task."""
    from clearledger.llm.bytewords import chunks

    new = T.StructType.fromDDL(added)
    rest = [f for f in df.schema.fields if f.name not in new.names]
    names = df.columns

    def made(batches):
        work = start()
        for whole in batches:
            for batch in chunks(whole, names.index(column), least):
                arrays = work(batch)
                passed = [batch.column(names.index(f.name)) for f in rest]
                yield pa.RecordBatch.from_arrays([*passed, *arrays], names=[*(f.name for f in rest), *new.names])

    schema = T.StructType([*rest, *new.fields])
    return df.mapInArrow(tidy(made), schema)
