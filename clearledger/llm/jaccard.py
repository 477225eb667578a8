"""N-gram Jaccard join by parity sketches, and the classes that its links make.

A document is the set of its distinct word shingles. Sets of sizes a and b reach similarity t only
if they differ in at most (1 - t) / (1 + t) * (a + b) shingles. Sizes fall in bands that grow by
1 / t, so a linked pair lies in one band or in two neighbours; band pair i, of bands i and i + 1,
has a largest difference D(i). For each of its two band pairs a document gets a parity sketch of
more than D(i) words of 64 bits: every shingle flips one bit. The Hamming distance of two sketches
never exceeds the difference of the sets, and by the pigeonhole principle no shingle of some word
differs between linked documents. They are joined on (band pair, place, XOR of the word's shingle
hashes), which tells more than the word's bits. Words without shingles, which unrelated sets share,
are left out wherever the numbers show that linked sets must share another.

Classes are found without writing all pairs of a group:

1. Equal sets are merged first, by a digest of the set, before anything else is shuffled. A set is
   known by 64 bits of the digest; where these are equal but 64 more are not, by the other 64.
2. Every set is paired with the smallest member of one key, the member it shares most keys with,
   and the pair is verified on the sets themselves.
3. Keys that hold several components of these links are compared within, by sketches an eighth as
   wide, whose distance does not exceed the difference either: first the nearest pairs of different
   components are verified, then, where components still differ, all pairs whose sketches are near
   enough. So every pair that agrees in a key is in one component already, or too far apart by its
   sketches, or has been tested.

A key that many sets share has one row of 16 bytes for each; keys are many, as a set has one for
each ten or so of its shingles, so a hot group spreads over many of them.

Null and empty texts and texts without words have no shingles and no links. With fewer words than
a shingle has, the whole sequence is one shingle. Repeated rows have equal sets and one class.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearledger.llm.bytewords import SEED, chunks, fresh_seed, lowered, mix, text_bytes, word_hashes, words
from clearledger.llm.tables import written
from clearledger.llm.workers import tidy

WORDS, PERCENT = 5, 80
#: More than the bands of sizes up to 2**40 at a similarity of 0.95.
PAIR_MASK = 1023
FILTER_BITS = 1 << 26
#: Of the sketch words of a band pair the rows of a key carry one in so many, and so many at least.
SENT_SHARE, SENT_LEAST = 8, 4
U64 = np.uint64


def _sets(data: np.ndarray, offsets: np.ndarray, n: int, seed: int = SEED) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    starts, ends, first = words(data, offsets)
    h = word_hashes(lowered(data), starts, ends, seed)
    rolled = np.zeros(len(h), U64)
    for i in range(min(n, len(h))):
        rolled[: len(h) - i] = mix(rolled[: len(h) - i] + h[i:])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:  # the whole sequence in its order; its length keeps it apart from full shingles
            whole = np.array([b - a], U64)
            for i in range(a, b):
                whole = mix(whole + h[i : i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, U64))
    return out


def set_digests(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """(doc, id, other, n_shingles): two halves of a digest of each document's set; 0 for an empty one."""

    def made(batches):
        for whole in batches:
            for batch in chunks(whole, 1):
                sets = _sets(*text_bytes(batch.column(1)), n, seed)
                halves = np.array([_halves(s) for s in sets], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                        pa.array([len(s) for s in sets], pa.int64()),
                    ],
                    names=["doc", "id", "other", "n_shingles"],
                )

    return docs.mapInArrow(tidy(made), "doc long, id long, other long, n_shingles long")


def _halves(shingles: np.ndarray) -> tuple[int, int]:
    if not len(shingles):
        return 0, 0
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _set_id(shingles: np.ndarray, shared: frozenset[int] = frozenset()) -> int:
    """The first half of the digest, or the second where unlike sets share the first."""
    first, second = _halves(shingles)
    return second if first in shared else first


def shared_ids(digests: DataFrame) -> frozenset[int]:
    """First halves that unlike sets share: by chance n * n / 2**65 of n sets."""
    unlike = digests.groupBy("id").agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low < high")
    return frozenset(r.id for r in unlike.select("id").collect())


class Bands:
    """Size bands and the number of sketch words of each band pair."""

    def __init__(self, percent: int):
        self.percent = percent
        self.first = [1]  # sizes first[i] .. first[i + 1] - 1 make band i
        while self.first[-1] < 1 << 40:
            top = max(self.first[-1] * 100 // percent, self.first[-1])
            self.first.append(top + 1)

    def most_apart(self, total: int) -> int:
        """The largest symmetric difference of linked sets whose sizes sum to total."""
        return (100 - self.percent) * total // (100 + self.percent)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, sizes, "right") - 1

    def furthest(self, pair: int) -> int:
        """D: the largest difference of linked sets of bands pair and pair + 1."""
        small = self.first[pair + 1] - 1
        return self.most_apart(small + small * 100 // self.percent)

    def words(self, pair: int) -> int:
        """D + 1, and about as many more as a set leaves empty, so that it need not tell these."""
        least = self.furthest(pair) + 1
        apart = (100 - self.percent) / (100 + self.percent)
        empty = least * math.exp(-0.8 / (apart * (1 + 100 / self.percent))) if apart else 0
        return least + (math.ceil(empty + 2 * math.sqrt(empty)) if empty >= 0.5 else 0)

    def sent_words(self, pair: int) -> int:
        """The width of the sketches that rows of a key carry. Each has some eight bits for each shingle
        that linked sets may differ in: two such sets stay below that number, unlike ones reach several times it,
        and pairs just short of a link are told apart on their sets."""
        n_words = self.words(pair)
        return min(n_words, max(SENT_LEAST, math.ceil(n_words / SENT_SHARE)))


def told_words(shingles: np.ndarray, n_words: int, furthest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, XOR of the shingles' hashes) of the sketch words to join on.

    Linked sets differ in at most ``furthest`` words, so they agree in n_words - furthest or more.
    A set with fewer empty words than that agrees in one that is not, and leaves out empty ones."""
    place = (mix(shingles) % U64(n_words * 64)) >> U64(6)
    order = np.argsort(place, kind="stable")
    filled, first = np.unique(place[order], return_index=True)
    value = np.bitwise_xor.reduceat(mix(shingles[order] + U64(1)), first)
    if n_words - len(filled) < n_words - furthest:
        return filled, value
    whole = np.zeros(n_words, U64)
    whole[filled.astype(np.int64)] = value
    return np.arange(n_words, dtype=U64), whole


def parity_sketch(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """n_words words of 64 bits, each bit the parity of the shingles that fall on it."""
    bit = (mix(shingles) % U64(n_words * 64)).astype(np.int64)
    parity = (np.bincount(bit, minlength=n_words * 64) & 1).astype(np.uint8)
    return np.packbits(parity).view(U64)


def join_keys(docs: DataFrame, linked: Linked) -> DataFrame:
    """(key, id): for each set the hash of (band pair, place, told word) of both of its sketches. The
    band pair stands in the key's low bits.

    A task sends a set once, however many of its documents have it."""
    bands = linked.bands

    def made(batches):
        sent: set[int] = set()
        for whole in batches:
            for batch in chunks(whole, 1):
                ids, keys = [], []
                for shingles in linked.sets(*text_bytes(batch.column(1))):
                    own = linked.id_of(shingles)
                    if not len(shingles) or own in sent:
                        continue
                    sent.add(own)
                    band = int(bands.of(np.array([len(shingles)]))[0])
                    for pair in range(max(band - 1, 0), band + 1):
                        place, value = told_words(shingles, bands.words(pair), bands.furthest(pair))
                        key = mix(mix(value) + mix(place + (U64(pair) << U64(48))))
                        keys.append((key & ~U64(PAIR_MASK) | U64(pair)).view(np.int64))
                        ids.append(np.full(len(place), own))
                if keys:
                    yield _batch(key=np.concatenate(keys), id=np.concatenate(ids))

    return docs.mapInArrow(tidy(made), "key long, id long")


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(key, id, leader) for keys of several sets; the leader is the smallest id of the key.

    Partitions are sorted by (key, id), so between batches only the last row is kept."""

    def led(batches):
        key, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lead_of_first, told = None, False
        for batch in batches:
            key = np.concatenate([key, np.asarray(batch.column(0))])
            ids = np.concatenate([ids, np.asarray(batch.column(1))])
            if not len(key):
                continue
            keep = np.ones(len(key), bool)
            keep[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])  # a set sent by several tasks
            key, ids = key[keep], ids[keep]
            same = key[1:] == key[:-1]
            new = np.append(True, ~same)
            at = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            lead = ids[at]
            if lead_of_first is not None:
                lead[at == 0] = lead_of_first
            shared = np.append(False, same) | np.append(same, False)
            out = shared.copy()
            out[0] &= not told
            if out.any():
                yield _batch(key=key[out], id=ids[out], leader=lead[out])
            told = bool(shared[-1]) or (len(key) == 1 and told)
            key, ids, lead_of_first = key[-1:], ids[-1:], lead[-1]

    return (
        keyed.repartition("key").sortWithinPartitions("key", "id").mapInArrow(tidy(led), "key long, id long, leader long")
    )


class Linked:
    """Whether two texts link: sizes, then sketches of a common band pair, then the sets."""

    def __init__(self, n: int, percent: int, seed: int = SEED, shared: frozenset[int] = frozenset()):
        self.n, self.percent, self.seed, self.shared, self.bands = n, percent, seed, shared, Bands(percent)

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return _sets(data, offsets, self.n, self.seed)

    def set_of(self, text: bytes) -> np.ndarray:
        return self.sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]

    def id_of(self, shingles: np.ndarray) -> int:
        return _set_id(shingles, self.shared)

    def __call__(self, x: np.ndarray, y: np.ndarray) -> bool:
        band = self.bands.of(np.array([len(x), len(y)]))
        if abs(int(band[0]) - int(band[1])) > 1:
            return False
        n_words = self.bands.words(int(band.min()))
        apart = int(np.bitwise_count(parity_sketch(x, n_words) ^ parity_sketch(y, n_words)).sum())
        if apart > self.bands.most_apart(len(x) + len(y)):
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= self.percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, texts: DataFrame, linked: Linked) -> DataFrame:
    """The pairs (a, b) of set ids whose texts link. ``texts`` has (id, text)."""
    joined = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").select("a", "b", "x", "y")

    def checked(batches):
        for whole in batches:
            for batch in chunks(whole, 2):
                x, y = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("x", "y"))
                sets = {t: linked.set_of(t) for t in {*x, *y}}
                good = pa.array([linked(sets[p], sets[q]) for p, q in zip(x, y, strict=True)], pa.bool_())
                yield batch.select(["a", "b"]).filter(good)

    return joined.mapInArrow(tidy(checked), "a long, b long")


def sketches_of(texts: DataFrame, linked: Linked) -> DataFrame:
    """(id, pair, n, sketch): both sketches of each set of texts (id, text), as wide as rows carry them."""
    bands = linked.bands

    def made(batches):
        for whole in batches:
            for batch in chunks(whole, 1):
                out = []
                sets = linked.sets(*text_bytes(batch.column(1)))
                for own, shingles in zip(batch.column(0).to_pylist(), sets, strict=True):
                    band = int(bands.of(np.array([len(shingles)]))[0])
                    for pair in range(max(band - 1, 0), band + 1):
                        out.append((own, pair, len(shingles), parity_sketch(shingles, bands.sent_words(pair)).tobytes()))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = list(zip(*out, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "pair", "n", "sketch"]
                )

    return texts.select("id", "text").mapInArrow(tidy(made), "id long, pair long, n long, sketch binary")


class _Held:
    """Sets of one key that later ones are compared with, their sketches as a matrix."""

    def __init__(self, width: int):
        self.count = 0
        self.ids, self.label, self.size = (np.zeros(8, np.int64) for _ in range(3))
        self.sketch = np.zeros((8, width), U64)

    def add(self, own: int, label: int, size: int, sketch: np.ndarray) -> None:
        if self.count == len(self.ids):
            self.ids, self.label, self.size = (np.concatenate([x, x]) for x in (self.ids, self.label, self.size))
            self.sketch = np.vstack([self.sketch, self.sketch])
        at = self.count
        self.ids[at], self.label[at], self.size[at], self.sketch[at] = own, label, size, sketch
        self.count += 1


def near_pairs(rows: DataFrame, percent: int, every: bool) -> DataFrame:
    """Distinct pairs (a, b) of sets of different components that share a key and whose sketches
    are no further apart than those of linked sets.

    ``rows`` has (key, main, id, component, n, sketch); main is true for the component of the key's
    leader. Rows come sorted with main last: the others are kept, main's pass by them, so a
    component with very many rows is not held. A row is compared with all kept ones at once. With
    ``every`` all such pairs are told. Without, a row tells its nearest pair with each component,
    which then counts as the row's own within the key: enough to join most components."""
    bands = Bands(percent)

    def found(batches):
        key = held = None
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c).to_pylist() for c in ("key", "main", "id", "component", "n", "sketch")]
            for k, main, own, label, size, raw in zip(*columns, strict=True):
                sketch = np.frombuffer(raw, U64)
                if k != key:
                    key, held = k, _Held(len(sketch))
                at = np.flatnonzero(held.label[: held.count] != label)
                if len(at):
                    apart = np.bitwise_count(held.sketch[at] ^ sketch).sum(axis=1)
                    near = apart <= bands.most_apart(held.size[at] + size)
                    at, apart = at[near], apart[near]
                    if not every and len(at):
                        at = at[np.argsort(apart, kind="stable")]
                        at = at[np.sort(np.unique(held.label[at], return_index=True)[1])]
                        told = held.label[at]
                        held.label[np.isin(held.label, told)] = label
                    a += [own] * len(at)
                    b += held.ids[at].tolist()
                if not main:
                    held.add(own, label, size, sketch)
            if a:
                yield _batch(a=np.maximum(a, b), b=np.minimum(a, b))

    return (
        rows.repartition("key")
        .sortWithinPartitions("key", "main", "id")
        .select("key", "main", "id", "component", "n", "sketch")
        .mapInArrow(tidy(found), "a long, b long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable by links (a, b), for nodes that have any.

    Each round a label goes to all neighbours, and a node takes the label of its label, so labels
    travel twice as far every round; tables are written between rounds."""
    both = written(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "links")
    first = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = written(first.toDF("node", "label"), "labels")
    while True:
        near = both.join(labels.toDF("b", "seen"), "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        step = labels.join(near, "node", "left").select("node", F.least("label", "seen").alias("next"), "label")
        label_of = labels.toDF("next", "far")
        jumped = step.join(label_of, "next", "left").select("node", F.least("next", "far").alias("next"), "label")
        done = written(jumped, "labels")
        labels = done.select("node", F.col("next").alias("label"))
        if not done.where("next < label").limit(1).count():
            return labels.toDF("node", "component")


def similarity_classes(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """(key, n_shingles, component_id): one row a document, its set's size and its class.

    The class is the smallest key reachable by links of at least percent similarity, itself
    included. A null key has no class but its own null."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    seed = fresh_seed()
    digests = written(set_digests(rows, n, seed), "digests")
    linked = Linked(n, percent, seed, shared_ids(digests))
    known_by = F.when(F.col("id").isin(*linked.shared), F.col("other")).otherwise(F.col("id")) if linked.shared else F.col("id")
    members = digests.select("doc", known_by.alias("id"), "n_shingles")
    reps = written(
        members.where("n_shingles > 0 AND doc IS NOT NULL").groupBy("id").agg(F.min("doc").alias("rep")), "reps"
    )
    shared = written(shared_keys(join_keys(rows.where("doc IS NOT NULL"), linked)), "shared")
    involved = written(shared.select("id").distinct().join(reps, "id"), "involved")
    texts = written(_texts_of(involved, rows, linked), "texts")
    # each set with the leader it shares most keys with
    counted = shared.where("id <> leader").groupBy("id", "leader").count()
    ranked = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("count"), "leader"))
    best = counted.withColumn("r", ranked).where("r = 1").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    links = written(verified(best, texts, linked), "linked")
    # within keys that still hold several components: the nearest pairs, then every pair left
    sketches = written(sketches_of(texts, linked), "sketches")
    open_rows = _open_rows(shared, written(components(links), "components")).join(sketches, ["id", "pair"])
    pairs = written(near_pairs(open_rows, percent, every=False), "pairs")
    good = written(verified(pairs, texts, linked), "linked")
    links = links.union(good)
    # A pair taken for linked that is not may have hidden others in the keys of its sets
    failed = written(pairs.join(good, ["a", "b"], "left_anti"), "failed")
    if failed.limit(1).count():
        known = written(components(links), "components")
        again = shared.join(failed.select(F.col("a").alias("id")).distinct(), "id").select("key").distinct()
        open_rows = _open_rows(shared.join(again, "key", "left_semi"), known).join(sketches, ["id", "pair"])
        rest = near_pairs(open_rows, percent, every=True).join(failed, ["a", "b"], "left_anti")
        links = links.union(written(verified(written(rest, "pairs"), texts, linked), "linked"))
    # the same graph with documents as nodes, whose smallest is the class
    as_docs = links.join(reps.toDF("a", "x"), "a").join(reps.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    classes = written(components(as_docs), "classes")
    of_set = reps.join(classes, F.col("rep") == F.col("node"), "left").select(
        F.col("id").alias("set"), F.coalesce("component", "rep").alias("component")
    )
    # the null-safe condition lets a set with very many documents be split
    return members.join(of_set, F.col("id").eqNullSafe(F.col("set")) & (F.col("n_shingles") > 0), "left").select(
        F.col("doc").alias(key),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"),
    )


def _open_rows(shared: DataFrame, known: DataFrame) -> DataFrame:
    """(key, main, id, component, pair) of keys with several components; of keys with the same
    sets one only."""
    placed = _with_component(shared, known, "id", "component")
    sign = placed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    pair = F.col("key").bitwiseAND(F.lit(PAIR_MASK))
    keys = sign.where("low < high").groupBy(pair.alias("pair"), "n", "sum").agg(F.min("key").alias("key"))
    lead = _with_component(placed, known, "leader", "lead")
    return lead.join(keys.select("key", "pair"), "key").select(
        "key", (F.col("component") == F.col("lead")).alias("main"), "id", "component", "pair"
    )


def _likely(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows whose document is, or by its hash may be, the representative of a set, so that few
    texts are shuffled to meet them. One bit a hash: ``FILTER_BITS`` of them are broadcast, however
    many sets there are; the join that follows does not rely on it."""

    def place(column: str):
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)) + 1

    bitmaps = (
        sets.groupBy(F.bitmap_bucket_number(place("rep")).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place("rep"))).alias("bits"))
        .collect()  # FILTER_BITS / 8 bytes at most
    )
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bitmaps:
        bits = np.frombuffer(r.bits, np.uint8)
        whole[(r.bucket - 1) * len(bits) : r.bucket * len(bits)] = bits
    shared = rows.sparkSession.sparkContext.broadcast(whole)

    @F.arrow_udf("boolean")
    def may_be(places: pa.Array) -> pa.Array:
        at = np.asarray(places) - 1
        return pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return rows.where(may_be(place("doc")))


def _texts_of(sets: DataFrame, rows: DataFrame, linked: Linked) -> DataFrame:
    """(id, text) of each set (id, rep); of rows that share a document id, one that has the set."""

    @F.arrow_udf("boolean")
    def has_set(ids: pa.Array, texts: pa.Array) -> pa.Array:
        said = texts.cast(pa.large_binary()).to_pylist()
        return pa.array([linked.id_of(linked.set_of(t or b"")) == i for i, t in zip(ids.to_pylist(), said, strict=True)])

    of = sets.join(_likely(rows, sets), F.col("rep") == F.col("doc")).withColumn("hash", F.xxhash64("text"))
    once = of.dropDuplicates(["rep", "id", "hash"])  # the rows lie by rep already
    return once.where(has_set("id", "text")).select("id", "text")


def _with_component(df: DataFrame, known: DataFrame, column: str, into: str) -> DataFrame:
    """Add the component of the node in a column; a node without links is its own."""
    own = known.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return df.join(own, F.col(column) == F.col("_n"), "left").withColumn(into, F.coalesce("_c", F.col(column))).drop("_n", "_c")
