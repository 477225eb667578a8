"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clearledger.sources.tables import shared_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that no lost executor costs them."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
