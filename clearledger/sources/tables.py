"""Scans, seeds and the folder shared by driver and executors."""

from __future__ import annotations

import math
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Bytes of source files per task of a stage that holds its rows in memory, and the most such tasks.
TASK_BYTES = 8 << 20
MOST_TASKS = 10_000


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";"
) -> DataFrame:
    """Delimited text with a header; a byte order mark at the start is dropped.

    The schema is required, so that no extra pass over the file infers it.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .schema(schema)
        .csv(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited text with a header, one file per partition; blanks around values are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def load_seed(
    spark: SparkSession, path: str, table: str, schema: T.StructType | str, sep: str = ","
) -> DataFrame:
    """Load a delimited seed file as a table, replacing the old content."""
    seed = read_delimited(spark, path, schema, sep)
    seed.write.mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """Run any SQL statement."""
    return spark.sql(sql)


def table_sample(
    df: DataFrame, limit: int | None = None, order_by: list[str] | None = None
) -> DataFrame:
    """The table, or its first rows; a limit of None or 0 means all rows."""
    ordered = df.orderBy(*order_by) if order_by and limit else df
    return ordered.limit(limit) if limit else ordered


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: later plans neither repeat the work
    behind them nor depend on the executors that did it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame is read from, by their listing; 0 for rows that come from no file."""
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        return 0
    return df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0


def tasks_for(df: DataFrame) -> int | None:
    """How many tasks rows as many as those of a frame are dealt to, so that a task's share does not
    grow with the files behind it; None for so few that Spark's own choice holds less per task."""
    tasks = min(math.ceil(file_bytes(df) / TASK_BYTES), MOST_TASKS)
    return tasks if tasks > df.sparkSession.sparkContext.defaultParallelism else None


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's checkpoint folder.

    Only a local session without that setting falls back to a temporary folder, which is then
    recorded in the session.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="clearledger-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
