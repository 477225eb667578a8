"""Joins whose physical form follows a checked size."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.sources.tables import stored

BROADCAST_ROWS = 100_000
SALTS = 64


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a frame is small; reads no more than ``rows + 1`` of its rows."""
    return df.limit(rows + 1).count() <= rows


def left_join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of a large frame to a narrow lookup on a key with few, unevenly used values.

    A lookup proven small is broadcast, which leaves the facts where they are. Otherwise the
    facts of one key are dealt over ``SALTS`` tasks by a hash of ``spread_by``, and each lookup
    row is copied once per salt, so that a key holding most rows does not land in one task.
    """
    if has_at_most(lookup, broadcast_rows):
        return facts.join(F.broadcast(lookup), key, "left")
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def beside_groups(rows: DataFrame, per_group: DataFrame, by: list[str]) -> DataFrame:
    """Inner join of rows with one result row per group, for groups without missing keys.

    The groups' rows are stored first, so that they are made once, whether counted, broadcast or
    joined. Up to ``BROADCAST_ROWS`` are broadcast. More are joined by shuffle under a null-safe
    condition: its keys are expressions, so neither a grouping before nor one after the join
    shares its partitions, and adaptive execution may split a group too large for one task.
    """
    groups = stored(per_group, "groups")
    if has_at_most(groups, BROADCAST_ROWS):
        return rows.join(F.broadcast(groups), by)
    other = {b: f"_group{i}" for i, b in enumerate(by)}
    same = reduce(and_, [F.col(f"`{b}`").eqNullSafe(F.col(o)) for b, o in other.items()])
    return rows.join(groups.withColumnsRenamed(other), same).drop(*other.values())
