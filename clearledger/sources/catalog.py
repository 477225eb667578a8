"""Databases, tables and columns as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.operators.frames import stack

COLUMN_SCHEMA = "table_name string, column_name string, data_type string, nullable boolean, ordinal int"


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema_name"))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return (
        spark.sql(f"SHOW TABLES IN `{database}`")
        .filter(~F.col("isTemporary"))
        .select(F.col("tableName").alias("table_name"))
        .orderBy("table_name")
    )


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")


def describe_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column, from the schemas alone."""
    rows = [
        (table, field.name, field.dataType.simpleString(), field.nullable, position)
        for table, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def table_columns(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Columns of a catalogue table in order: name, type, nullable."""
    df = spark.table(f"`{database}`.`{table}`")
    return describe_columns(spark, {table: df}).orderBy("ordinal")


def schema_columns(spark: SparkSession, database: str) -> DataFrame:
    """Columns of every table of a database, ordered by table and position."""
    names = [r.table_name for r in list_tables(spark, database).collect()]
    tables = {name: spark.table(f"`{database}`.`{name}`") for name in names}
    return describe_columns(spark, tables).orderBy("table_name", "ordinal")


def columns_with_capitals(columns: DataFrame) -> DataFrame:
    """Columns whose name starts with an upper-case letter, so not in snake case."""
    return columns.filter(F.col("column_name").rlike(r"^\p{Lu}"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return stack(counted)


def present_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Catalogue entry per column: type, position, rows and present values, one scan a table."""
    entries = []
    for name, df in tables.items():
        totals = df.agg(
            F.count("*").alias("row_count"),
            *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)],
        )
        entry = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(i + 1).alias("ordinal"),
                F.col(f"_{i}").alias("present"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        entries.append(
            totals.select(F.lit(name).alias("table_name"), "row_count", F.inline(F.array(*entry)))
        )
    return stack(entries)


CATALOGUE_SCHEMA = (
    "schema_name string, table_name string, table_type string, table_comment string,"
    " column_name string, column_type string, column_comment string, ordinal int"
)
KINDS = {"VIEW": "VIEW", "TEMPORARY": "VIEW"}


def data_catalogue(spark: SparkSession, databases: list[str]) -> DataFrame:
    """One row per column of every table and view of some databases, with its table's kind and
    the comments on both. Made from the catalogue alone, no table is read."""
    rows = []
    for database in databases:
        for t in spark.catalog.listTables(database):
            if t.isTemporary:
                continue
            fields = spark.table(f"`{database}`.`{t.name}`").schema.fields
            for position, f in enumerate(fields, 1):
                kind = KINDS.get(t.tableType, "BASE TABLE")
                comment = (f.metadata or {}).get("comment")
                rows.append(
                    (database, t.name, kind, t.description, f.name, f.dataType.simpleString(), comment, position)
                )
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA).orderBy("schema_name", "table_name", "ordinal")


def explore_tables(tables: dict[str, DataFrame], limit: int = 5) -> DataFrame:
    """(table_name, row_count, place, row): the number of rows of every table, with its first
    rows as JSON; an empty table has one row without any."""
    parts = []
    for name, df in tables.items():
        shown = df.limit(limit).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
        listed = shown.agg(F.collect_list("row"))  # `limit` rows
        total = df.agg(F.count("*").alias("row_count")).withColumn("rows", listed.scalar())
        parts.append(
            total.select(
                F.lit(name).alias("table_name"), "row_count", F.posexplode_outer("rows").alias("place", "row")
            )
        )
    return stack(parts).select("table_name", "row_count", (F.col("place") + 1).alias("place"), "row")


def write_catalogue(catalogue: DataFrame, path: str) -> None:
    """Write a catalogue as JSON lines."""
    catalogue.write.mode("overwrite").json(path)
