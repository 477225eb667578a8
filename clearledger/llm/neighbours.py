"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Candidates fall in bands of nearly equal norms. In a band of largest norm m a candidate x becomes
x / m with one more coordinate, sqrt(1 - |x / m|^2), and a query q becomes q / |q| with 0; both have
length 1, whatever the norms given, and the nearest point has the largest inner product. A long row
has a band of its own and moves no other row. Rows of bands too small for hashing (``SMALL_BAND``)
and norms that double precision cannot square are met by every query. A
table hashes a point by K projections on normal (2-stable) directions, cut in steps of a width. A
query looks into its own bucket and into those next to it in the order of their estimated success:
the sum of squared distances from the query to the borders that a set of steps crosses, smallest
first. Candidates of all buckets and tables are ranked by the exact inner product in double
precision on the vectors given.

Every vector is indexed. Equal vectors are one candidate with the ``k + 1`` smallest ids: no query
can need more, as ties go to the smaller id. Buckets are dealt over cells of about ``CELL_ROWS``
rows; a cell with more rows or queries than a task should hold is cut into blocks, each block of
queries meeting each block of rows. A cell gives each query one list of k, whatever the number of
tables and buckets in it. A query is searched again over all rows, in blocks, and so is exact, if it
has fewer than k candidates, or if its probes tell too little: for a row as good as its k-th
candidate the chance to lie in a probed bucket of some table is worked out for every band that can
hold such a row, and must be ``SUCCESS`` or more.

Defaults suit vectors of little contrast (neighbours at a cosine of 0.3 to 0.5), where most rows
have to be visited for a recall over 0.9; raise ``projections`` and lower ``probes`` for others.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do null ids.
Rows repeated with the same id and vector count once. Vectors of different lengths never meet.
Other columns are ignored. No queries or no candidates give no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearledger.llm.tables import written

TABLES, PROJECTIONS, WIDTH, PROBES = 6, 6, 2.0, 40
CELL_ROWS, BLOCK_ROWS, BLOCK_QUERIES = 65_536, 131_072, 4_096
#: Bands for each doubling of the squared norm, and the rows from which a band is hashed.
BANDS, SMALL_BAND = 4, 64
NO_BAND, EVERYBODY = 1 << 20, 0
SUCCESS = 0.75
SEED = 5
FOUND = "query_id long, vec_id long, score double"


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector): distinct rows that take part."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    low = F.lit(float("-inf"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < -low))
    return (
        df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), values.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(good & F.exists("vector", lambda x: x != 0))
        .dropDuplicates(["vec_id", "vector"])
    )


def probe_order(place: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
    """Sets of (projection, step) in order of estimated success, the empty set first.

    ``place`` is where a query lies in its bucket, 0 to 1 by projection. Sets grow from the cheapest
    step, by moving the last step on or by adding the next one."""
    steps = sorted(
        [(x * x, i, -1) for i, x in enumerate(place)] + [((1 - x) ** 2, i, 1) for i, x in enumerate(place)]
    )
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(steps[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({steps[j][1] for j in chosen}) == len(chosen):
            out.append(tuple(steps[j][1:] for j in chosen))
        last = chosen[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
    return out


class Hashes:
    """Directions, shifts and multipliers of all tables for one vector length."""

    def __init__(self, dims: int, tables: int, projections: int, width: float):
        rng = np.random.default_rng([SEED, dims])
        self.width = width
        self.directions = rng.normal(size=(tables, dims + 1, projections))
        self.shift = rng.random((tables, projections)) * width
        self.multiply = (rng.integers(1, 2**62, (tables, projections)) | 1).astype(np.int64)
        self.offset = rng.integers(1, 2**62, tables).astype(np.int64) + dims
        self.of_band = int(rng.integers(1, 2**62)) | 1

    def places(self, points: np.ndarray, table: int) -> np.ndarray:
        return (points @ self.directions[table] + self.shift[table]) / self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """A 64-bit number of each bucket, its table and the vector length (wraps around)."""
        return (cells.astype(np.int64) * self.multiply[table]).sum(axis=1) + self.offset[table]


def _matrix(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) of the rows of each vector length."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten())
    begin = np.append(0, np.cumsum(lengths))
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((int(n), rows, flat[begin[rows][:, None] + np.arange(n)]))
    return out


def _signed(key: int) -> int:
    return (key + 2**63) % 2**64 - 2**63


def norm_band(squared: np.ndarray) -> np.ndarray:
    """The band of squared norms; ``NO_BAND`` where they over- or underflow. Length 1 is mid-band."""
    fits = (squared > 1e-290) & (squared < 1e290)
    return np.where(fits, np.floor(np.log2(np.where(fits, squared, 1)) * BANDS + 0.5), NO_BAND).astype(np.int64)


def _bands(rows: DataFrame) -> dict[int, dict[int, float]]:
    """For each vector length the bands that are hashed, with their largest squared norms."""

    def told(batches):
        for batch in batches:
            for dims, _, x in _matrix(batch.column("vector")):
                with np.errstate(over="ignore"):
                    squared = (x * x).sum(axis=1)
                band = norm_band(squared)
                for b in np.unique(band[band != NO_BAND]):
                    own = squared[band == b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in ((dims, pa.int64()), (int(b), pa.int64()), (len(own), pa.int64()), (own.max(), pa.float64()))],
                        names=["dims", "band", "n", "largest"],
                    )

    parts = rows.select("vector").mapInArrow(told, "dims long, band long, n long, largest double")
    out: dict[int, dict[int, float]] = {}
    for r in parts.groupBy("dims", "band").agg(F.sum("n").alias("n"), F.max("largest").alias("m")).where(F.col("n") >= SMALL_BAND).collect():
        out.setdefault(r.dims, {})[r.band] = r.m
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1, and their lengths, also where squares would overflow."""
    most = np.abs(x).max(axis=1)
    x = x / most[:, None]
    norm = np.sqrt((x * x).sum(axis=1))
    with np.errstate(over="ignore"):
        return x / norm[:, None], most * norm


def _hashed(df: DataFrame, own: str, own_type: str, bands, cells: int, settings, probes: int) -> DataFrame:
    """(cell, buckets, own, vector): a row for each cell that holds buckets, of any table, that a
    point lies in or probes. Rows outside the hashed bands lie in the bucket ``EVERYBODY``, which
    all queries probe."""
    tables, projections, width = settings
    known: dict[int, Hashes] = {}

    def made(batches):
        for batch in batches:
            for dims, rows, x in _matrix(batch.column("vector")):
                h = known.setdefault(dims, Hashes(dims, tables, projections, width))
                take = batch.take(pa.array(rows))
                of: list[dict[int, list[int]]] = [{} for _ in range(len(x))]
                hashed = bands.get(dims, {})
                if probes:
                    points = np.column_stack([_unit(x)[0], np.zeros(len(x))])
                    own_bands, apart = [[b * h.of_band for b in hashed]] * len(x), range(len(x))
                else:
                    with np.errstate(over="ignore"):
                        squared = (x * x).sum(axis=1)
                    band = norm_band(squared).tolist()
                    apart = [i for i, b in enumerate(band) if b not in hashed]
                    own_bands = [[b * h.of_band] if b in hashed else [] for b in band]
                    largest = np.array([hashed.get(b, np.inf) for b in band])
                    points = np.column_stack([x / np.sqrt(largest)[:, None], np.sqrt(np.maximum(1 - squared / largest, 0))]) if hashed else np.zeros((len(x), dims + 1))
                for i in apart:
                    of[i].setdefault(EVERYBODY % cells, []).append(EVERYBODY)
                for table in range(tables if hashed else 0):
                    place = h.places(points, table)
                    base = np.floor(place).astype(np.int64)
                    key = h.keys(base, table)
                    for i in range(len(x)):
                        if not own_bands[i]:
                            continue
                        for steps in probe_order(place[i] - base[i], probes) if probes else [()]:
                            k = int(key[i])
                            for j, step in steps:
                                k += step * int(h.multiply[table, j])
                            for b in own_bands[i]:
                                bucket = _signed(k + b)
                                of[i].setdefault(bucket % cells, []).append(bucket)
                row = [i for i, own_cells in enumerate(of) for _ in own_cells]
                cell = [c for own_cells in of for c in own_cells]
                buckets = [b for own_cells in of for b in own_cells.values()]
                again = take.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int64()), pa.array(buckets, pa.list_(pa.int64())), again.column(own), again.column("vector")],
                    names=["cell", "buckets", own, "vector"],
                )

    return df.select(own, "vector").mapInArrow(made, f"cell long, buckets array<long>, {own} {own_type}, vector array<double>")


def _best_of(k: int):
    """The k best candidates of each query among the rows of its buckets in one block."""

    def ranked(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if queries.num_rows and rows.num_rows:
            queries, rows = queries.combine_chunks(), rows.combine_chunks()
            one = lambda t, c: t.column(c).chunk(0)
            lists = one(rows, "buckets")
            bucket, holder = np.asarray(lists.flatten()), np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            ids = one(rows, "ids").to_pylist()
            asked: dict[int, list[int]] = {}
            for i, buckets in enumerate(one(queries, "buckets").to_pylist()):
                for b in buckets:
                    asked.setdefault(b, []).append(i)
            names = np.asarray(queries.column("vec_id"))
            of_length = {n: (r, x) for n, r, x in _matrix(one(rows, "vector"))}
            for n, q_rows, q in _matrix(one(queries, "vector")):
                if n not in of_length:
                    continue
                x_rows, x = of_length[n]
                place = np.full(rows.num_rows, -1)
                place[x_rows] = np.arange(len(x_rows))
                inside = np.flatnonzero(place[holder] >= 0)
                inside = inside[np.argsort(bucket[inside], kind="stable")]
                sorted_bucket, members = bucket[inside], place[holder[inside]]
                at = {int(i): j for j, i in enumerate(q_rows)}
                heaps: dict[int, dict[int, float]] = {}
                for b, whole in asked.items():
                    lo, hi = np.searchsorted(sorted_bucket, [b, b + 1]) if b < 2**63 - 1 else (0, 0)
                    chosen = [at[i] for i in whole if i in at]
                    if lo == hi or not chosen:
                        continue
                    some_x = x[members[lo:hi]]
                    own_ids = [ids[x_rows[m]] for m in members[lo:hi]]
                    for part in range(0, len(chosen), 256):
                        some = chosen[part : part + 256]
                        near = q[some] @ some_x.T
                        for j, line in zip(some, near, strict=True):
                            heaps.setdefault(j, {}).update(_nearest(line, q[j], some_x, own_ids, names[q_rows[j]], k))
                for j, found in heaps.items():
                    best = heapq.nsmallest(k, ((-s, i) for i, s in found.items()))
                    out += [(int(names[q_rows[j]]), i, -s) for s, i in best]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    return ranked


def _nearest(line, query, x, ids, own, k) -> dict[int, float]:
    """Scores by id of the rows that can be among the k best, scored one row at a time the same way
    wherever the row lies, so that equal vectors tie."""
    if len(line) > k:
        least = np.partition(line, len(line) - k - 1)[-k - 1]
        rows = np.flatnonzero(line >= least - 1e-9 * (1 + abs(least)))
    else:
        rows = np.arange(len(line))
    score = (x[rows] * query).sum(axis=1)
    return {i: float(s) for r, s in zip(rows, score, strict=True) for i in ids[r] if i != own}


def success(place: np.ndarray, steps: list[tuple[tuple[int, int], ...]], at: np.ndarray, cosine: float, width: float) -> float:
    """The chance that a point at a cosine to a query lies in one of the buckets probed in a table.

    ``at`` has the query's projections, ``place`` where they lie in their bucket (0 to 1). Those of
    the point are normal around cosine * at, as directions are."""
    spread = math.sqrt(max(1 - cosine * cosine, 1e-12)) * math.sqrt(2)
    edge = (np.arange(-1, 3)[:, None] - place) * width + at * (1 - cosine)
    below = np.array([[math.erf(e / spread) for e in line] for line in edge]) / 2
    inside = below[1:] - below[:-1]  # by step -1, 0, 1
    total = 0.0
    for probe in steps:
        step = np.ones(len(at), np.int64)
        for j, by in probe:
            step[j] += by
        total += float(inside[step, np.arange(len(at))].prod())
    return min(total, 1.0)


def _unsure(scored: DataFrame, bands, settings, probes: int) -> DataFrame:
    """The queries (vec_id, vector, least: the score of the k-th candidate) whose probes would miss
    an equally good row too often."""
    tables, projections, width = settings
    known: dict[int, Hashes] = {}

    def told(batches):
        for batch in batches:
            least = np.asarray(batch.column("least"))
            keep = np.zeros(batch.num_rows, bool)
            for dims, rows, x in _matrix(batch.column("vector")):
                h = known.setdefault(dims, Hashes(dims, tables, projections, width))
                unit, norm = _unit(x)
                points = np.column_stack([unit, np.zeros(len(x))])
                places = [h.places(points, t) for t in range(tables)]
                for i, row in enumerate(rows):
                    # every band is probed alike, so the one of the longest rows has the least chance
                    largest = max(bands.get(dims, {}).values(), default=0.0)
                    cosine = float(least[row] / norm[i] / math.sqrt(largest)) if largest else 1.0
                    if cosine >= 1:
                        continue
                    missed = 1.0
                    for t in range(tables):
                        place = places[t][i] - np.floor(places[t][i])
                        at = points[i] @ h.directions[t]
                        missed *= 1 - success(place, probe_order(place, probes), at, max(cosine, -1.0), width)
                    keep[row] = not 1 - missed >= SUCCESS
            yield batch.select(["vec_id", "vector"]).filter(pa.array(keep))

    return scored.select("vec_id", "vector", "least").mapInArrow(told, "vec_id long, vector array<double>")


def _search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Up to k candidates for each query, block by block of each cell."""
    of_rows = rows.groupBy("cell").agg(F.count("*").alias("n"))
    of_queries = queries.groupBy("cell").agg(F.count("*").alias("m"))
    sizes = of_rows.join(of_queries, "cell").select(
        "cell",
        F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("query_blocks"),
    )

    def blocks(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str, what: str) -> Column:
        return F.pmod(F.xxhash64(what), F.col(n)).cast("int")

    left = queries.join(sizes, "cell").withColumn("q", own("query_blocks", "vec_id")).withColumn("r", blocks("row_blocks"))
    right = rows.join(sizes, "cell").withColumn("r", own("row_blocks", "ids")).withColumn("q", blocks("query_blocks"))
    left = left.select("cell", "q", "r", "buckets", "vec_id", "vector")
    right = right.select("cell", "q", "r", "buckets", "ids", "vector")
    found = left.groupBy("cell", "q", "r").cogroup(right.groupBy("cell", "q", "r")).applyInArrow(_best_of(k), FOUND)
    return found.dropDuplicates(["query_id", "vec_id"])


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row where ``is_query`` holds
    (an expression on ``vec_id``), among all other rows."""
    points = written(usable(df, key, vector), "vectors")
    n = points.count()
    cells = max(1, math.ceil(n * tables / CELL_ROWS))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    rows = (
        points.withColumn("place", place)
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    rows = written(rows, "candidates")
    queries = points.where(is_query)
    settings = (tables, projections, width)
    bands = _bands(rows)
    index = _hashed(rows, "ids", "array<long>", bands, cells, settings, 0)
    probing = _hashed(queries, "vec_id", "long", bands, cells, settings, probes)
    found = written(_search(probing, index, k), "found")
    # queries with too few or unsure candidates: all rows are one bucket
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    have = (
        found.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.count("*").alias("have"), F.min("score").alias("least"))
    )
    scored = queries.join(have, F.col("vec_id") == F.col("query_id"), "left").withColumn("have", F.coalesce("have", F.lit(0)))
    few = scored.where((F.col("have") < k) & (F.col("have") < F.lit(n) - 1)).select("vec_id", "vector")
    unsure = _unsure(scored.where(F.col("have") >= k), bands, settings, probes)
    short = written(few.union(unsure), "short").select(
        F.lit(0).cast("long").alias("cell"), F.array(F.lit(0).cast("long")).alias("buckets"), "vec_id", "vector"
    )
    everything = rows.select(
        F.lit(0).cast("long").alias("cell"), F.array(F.lit(0).cast("long")).alias("buckets"), "ids", "vector"
    )
    whole = found.union(_search(short, everything, k)).dropDuplicates(["query_id", "vec_id"])
    return (
        whole.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
