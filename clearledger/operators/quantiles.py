"""Exact quantiles without bringing all values of a column into one task.

Pass 1 brackets every wanted quantile with a mergeable sketch of known rank error; other
aggregates of the same numbers may ride along. Pass 2 counts the values below each bracket and
keeps those inside, a small share of the rows, both merged by value in one shuffle. Ranks are then
found over the stored values: those of a bracket are cut into cells by rank, with edges from a
sketch of the values themselves, so that a cell holds about ``CELL_VALUES`` of them however they
are spread, and only the one or two cells with the wanted rank are sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearledger.operators.frames import as_double, col
from clearledger.operators.joins import beside_groups
from clearledger.sources.tables import stored

ACCURACY = 10_000
# The sketch may be off by 1/ACCURACY of the rows; the bracket allows four times that.
MARGIN = 4.0
# Up to this many rows the margin is less than a few ranks, so all values are kept.
FEW_ROWS = 20_000
CELL_VALUES = 50_000


def _numbers(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Group columns and the numbers as ``_v0, _v1, ...``; rows without a group are left out.

    The numbers pass through a generator of one row, because filters on them must not be pushed
    below it: they would repeat, once per comparison, whatever expressions make the numbers.
    """
    values = [as_double(df, c).alias(f"_v{i}") for i, c in enumerate(columns)]
    numbers = df.select(*[col(b) for b in by], F.inline(F.array(F.struct(*values))))
    for b in by:
        numbers = numbers.filter(col(b).isNotNull())
    return numbers


class Sketch:
    """Brackets of every quantile of every column, from one pass over the numbers.

    ``beside`` are further aggregates, written over ``_v0, _v1, ...``; ``summary`` holds them with
    the brackets, one row, or one row per group. Without groups the edges are numbers in the
    plans that follow; with groups they are joined to the rows of the group.
    """

    def __init__(
        self,
        df: DataFrame,
        columns: list[str],
        quantiles: dict[str, float],
        by: list[str] | None = None,
        accuracy: int = ACCURACY,
        beside: list[Column] | None = None,
    ):
        self.columns, self.quantiles, self.by = columns, quantiles, by or []
        self.numbers = _numbers(df, columns, self.by)
        margin = MARGIN / accuracy
        fractions = [0.0, 1.0]
        for p in quantiles.values():
            fractions += [max(p - margin, 0.0), min(p + margin, 1.0)]
        aggregates = list(beside or [])
        for i in range(len(columns)):
            aggregates += [
                F.count(f"_v{i}").alias(f"n{i}"),
                F.percentile_approx(f"_v{i}", fractions, accuracy).alias(f"e{i}"),
            ]
        made = self.numbers.groupBy(*[col(b) for b in self.by]).agg(*aggregates)
        if self.by:
            self.row, self.summary = None, stored(made, "sketch")
        else:
            self.row = made.first()
            self.summary = df.sparkSession.createDataFrame([self.row], made.schema)

    def _edge(self, i: int, whole: int, near: int) -> Column:
        if self.row is None:
            edges = F.col(f"_s.e{i}")
            return F.when(F.col(f"_s.n{i}") <= FEW_ROWS, edges[whole]).otherwise(edges[near])
        edges = self.row[f"e{i}"]
        if edges is None:
            return F.lit(None).cast("double")
        return F.lit(edges[whole if self.row[f"n{i}"] <= FEW_ROWS else near])

    def _entry(self, i: int, q: int, name: str) -> Column:
        """What a row adds to a quantile: its value inside the bracket, a bare count below."""
        value, low, high = F.col(f"_v{i}"), self._edge(i, 0, 2 + 2 * q), self._edge(i, 1, 3 + 2 * q)
        inside = F.when(value >= low, value)
        entry = F.struct(
            F.lit(self.columns[i]).alias("column"), F.lit(name).alias("_quantile"), inside.alias("_value")
        )
        return F.when(value <= high, entry)

    def _targets(self) -> DataFrame:
        """(by..., column, quantile, position, n): the rank wanted, counted from zero."""
        entries = [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(name).alias("_quantile"),
                (F.lit(p) * (F.col(f"n{i}") - 1)).alias("_position"),
                F.col(f"n{i}").alias("_n"),
            )
            for i, c in enumerate(self.columns)
            for name, p in self.quantiles.items()
        ]
        return self.summary.select(*[col(b) for b in self.by], F.inline(F.array(*entries))).filter("_n > 0")

    def kept(self) -> DataFrame:
        """(by..., column, quantile, value, rows): values in brackets, and null for those below."""
        numbers = self.numbers
        if self.by:
            edges = [c for c in self.summary.columns if c[0] in "ne" and c[1:].isdigit()]
            packed = self.summary.select(*[col(b) for b in self.by], F.struct(*edges).alias("_s"))
            numbers = beside_groups(numbers, packed, self.by)
        entries = [
            self._entry(i, q, name)
            for i in range(len(self.columns))
            for q, name in enumerate(self.quantiles)
        ]
        found = numbers.select(*[col(b) for b in self.by], F.inline(F.array(*entries)))
        return (
            found.filter(F.col("column").isNotNull())
            .groupBy(*[col(b) for b in self.by], "column", "_quantile", "_value")
            .agg(F.count("*").alias("_rows"))
        )

    def exact(self) -> DataFrame:
        """(by..., column, one column per named quantile), linearly interpolated."""
        keys = [*self.by, "column", "_quantile"]
        named = [col(k) for k in keys]
        kept = stored(self.kept(), "quantiles")
        below = kept.filter(F.col("_value").isNull()).select(*named, F.col("_rows").alias("_below"))
        targets = self._targets()
        wanted = (
            targets.join(below, keys, "left")
            .withColumn("_below", F.coalesce("_below", F.lit(0)))
            .withColumn("_lower", F.floor("_position"))
            .withColumn("_upper", F.least(F.col("_lower") + 1, F.col("_n") - 1))
        )
        counts = in_cells(kept.filter(F.col("_value").isNotNull()), keys)
        in_bracket = W.partitionBy(*named).orderBy("_cell")
        cells = (
            counts.groupBy(*named, "_cell")
            .agg(F.sum("_rows").alias("_in_cell"))
            .join(wanted if self.by else F.broadcast(wanted), keys)
            .withColumn(
                "_before",
                F.col("_below") + F.sum("_in_cell").over(in_bracket) - F.col("_in_cell"),
            )
        )
        holds = [
            (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_in_cell"))
            for rank in ("_lower", "_upper")
        ]
        chosen = cells.filter(holds[0] | holds[1]).select(
            *named, "_cell", "_before", "_position", "_lower", "_upper"
        )
        # Ungrouped, at most two cells per column and quantile are chosen.
        detail = counts.join(chosen if self.by else F.broadcast(chosen), [*keys, "_cell"])
        in_cell = W.partitionBy(*named, "_cell").orderBy("_value")
        ranked = detail.withColumn("_upto", F.col("_before") + F.sum("_rows").over(in_cell))

        def at(rank: str) -> Column:
            here = (F.col(rank) < F.col("_upto")) & (F.col(rank) >= F.col("_upto") - F.col("_rows"))
            return F.max(F.when(here, F.col("_value")))

        found = ranked.groupBy(*named).agg(
            at("_lower").alias("_low"),
            at("_upper").alias("_high"),
            F.max(F.col("_position") - F.col("_lower")).alias("_share"),
        )
        return _one_column_each(targets, found, self.by, list(self.quantiles))


def in_cells(counts: DataFrame, keys: list[str], cell_values: int | None = None) -> DataFrame:
    """Add ``_cell``, the position of a value among cells of about ``cell_values`` values a key.

    Edges come from a sketch of the distinct values, so cells are even by rank, whatever the
    distances between values. Keys with few values have a single cell."""
    cell_values = cell_values or CELL_VALUES
    named = [col(k) for k in keys]
    sizes = counts.groupBy(*named).agg(F.count("*").alias("_m"))
    most = sizes.agg(F.max("_m")).first()[0] or 0
    if most <= cell_values:
        return counts.withColumn("_cell", F.lit(0))
    n = math.ceil(most / cell_values) + 1
    edges = counts.groupBy(*named).agg(
        F.percentile_approx("_value", [i / n for i in range(1, n)], 10 * n).alias("_edges")
    )
    joined = beside_groups(counts, edges, keys)
    cell = F.size(F.filter("_edges", lambda e: e < F.col("_value")))
    return joined.withColumn("_cell", cell).drop("_edges")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    quantiles: dict[str, float],
    by: list[str] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """(by..., column, one column per named quantile), linearly interpolated.

    Missing values and rows with a missing group are left out; a column without values has no
    row.
    """
    return Sketch(df, columns, quantiles, by, accuracy).exact()


def _one_column_each(
    targets: DataFrame, found: DataFrame, by: list[str], names: list[str]
) -> DataFrame:
    """Quantiles side by side; a wanted rank that was not found fails instead of going missing."""
    keys = [*by, "column", "_quantile"]
    exact = F.col("_low") + F.col("_share") * (F.col("_high") - F.col("_low"))
    checked = targets.select(*keys).join(found, keys, "left").withColumn(
        "_exact",
        F.when(
            exact.isNull(), F.raise_error(F.lit("quantile outside its bracket")).cast("double")
        ).otherwise(exact),
    )
    return checked.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("_quantile") == n, F.col("_exact"))).alias(n) for n in names]
    )


def approximate_quantiles(
    df: DataFrame,
    columns: list[str],
    quantiles: dict[str, float],
    by: list[str] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """The same shape from the sketch alone: one pass, rank error below 1/accuracy."""
    by = by or []
    sketch = _numbers(df, columns, by).groupBy(*by).agg(
        *[
            F.percentile_approx(f"_v{i}", list(quantiles.values()), accuracy).alias(f"q{i}")
            for i in range(len(columns))
        ]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"q{i}")[j].alias(name) for j, name in enumerate(quantiles)],
        )
        for i, c in enumerate(columns)
    ]
    wide = sketch.select(*[col(b) for b in by], F.inline(F.array(*entries)))
    return wide.filter(F.col(next(iter(quantiles))).isNotNull())
