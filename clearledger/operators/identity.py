"""The same person under different ids: classes of ids linked by any of several contacts.

Two ids are linked if they share a value of one kind (an e-mail address, a phone number, a name);
a class is everything that links reach. A value that many ids share links each of them to the
smallest, so links grow with the rows, not with pairs. Classes are found in rounds over written
tables: a lost executor costs its share of one round.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearledger.operators.frames import col
from clearledger.operators.joins import beside_groups
from clearledger.sources.tables import stored


def contact_entries(df: DataFrame, person: str, contacts: dict[str, Column]) -> DataFrame:
    """(person, kind, value): the distinct contacts of each id, as text; missing ones are left out."""
    entries = [
        F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
        for kind, value in contacts.items()
    ]
    listed = df.filter(col(person).isNotNull()).select(col(person).alias("person"), F.inline(F.array(*entries)))
    return listed.filter("value IS NOT NULL").distinct()


def contact_links(entries: DataFrame) -> DataFrame:
    """(a, b): for each contact that several ids have, each of them with the smallest."""
    first = entries.groupBy("kind", "value").agg(F.min("person").alias("b"), F.max("person").alias("_last"))
    shared = first.filter(F.col("b") < F.col("_last")).drop("_last")
    joined = beside_groups(entries, shared, ["kind", "value"])
    return joined.filter(F.col("person") != F.col("b")).select(F.col("person").alias("a"), "b").distinct()


def _rounds(links: DataFrame) -> Iterator[tuple[DataFrame, bool]]:
    """Labels (node, label) after each round, and whether they are final.

    In a round a node and the node it is labelled with take the smallest label around it, and then
    the label of that label: whole classes join their neighbours at once, so rounds grow with the
    logarithm of the longest chain. Both joins put the side with one row a node under a null-safe
    condition, so that adaptive execution splits a node with very many links."""
    ends = [F.col("a"), F.col("b")], [F.col("b"), F.col("a")]
    both = stored(links.select(*ends[0]).union(links.select(*ends[1])).toDF("node", "near").distinct(), "links")
    labels = stored(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")), "labels")
    while True:
        told = labels.select(F.col("node").alias("of"), F.col("label").alias("heard"))
        around = both.join(told, F.col("near").eqNullSafe(F.col("of"))).groupBy("node").agg(F.min("heard").alias("heard"))
        both_told = labels.join(around, "node").select(F.inline(F.array(F.struct("node", "heard"), F.struct(F.col("label").alias("node"), "heard"))))
        least = both_told.groupBy("node").agg(F.min("heard").alias("heard"))
        taken = labels.join(least, "node").select("node", "label", F.least("label", "heard").alias("next"))
        above = labels.select(F.col("node").alias("of"), F.col("label").alias("far"))
        moved = taken.join(above, F.col("next").eqNullSafe(F.col("of"))).select(
            "node", "label", F.least("next", "far").alias("next")
        )
        done = stored(moved, "labels")
        labels = done.select("node", F.col("next").alias("label"))
        yield labels, not done.filter("next < label").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for nodes that have any."""
    for labels, final in _rounds(links):
        if final:
            return labels.withColumnRenamed("label", "component")
    raise AssertionError("unreachable")


def linked_persons(df: DataFrame, person: str, contacts: dict[str, Column]) -> DataFrame:
    """(person, class): every id once, with the smallest id that shared contacts lead to.

    ``contacts`` are columns by kind; null values link nothing, so blanks and placeholders have to
    be null. Rows of one id are one person, rows without an id are left out."""
    entries = stored(contact_entries(df, person, contacts), "contacts")
    classes = components(contact_links(entries))
    ids = df.filter(col(person).isNotNull()).select(col(person).alias("person")).distinct()
    of = F.col("person") == F.col("node")
    return ids.join(classes, of, "left").select("person", F.coalesce("component", "person").alias("class"))


def linked_person_report(classes: DataFrame) -> DataFrame:
    """(persons, classes, linked_persons, largest_class): one row, from ``linked_persons``."""
    sizes = classes.groupBy("class").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("persons"),
        F.count("*").alias("classes"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("linked_persons"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest_class"),
    )
