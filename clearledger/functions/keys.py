"""Keys derived from column values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published surrogate-key convention.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(df: DataFrame, exclude: list[str] | None = None) -> Column:
    """MD5 over the text of every column but the excluded ones, in column order."""
    skipped = set(exclude or [])
    texts = [
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(NULL_PLACEHOLDER))
        for name in df.columns
        if name not in skipped
    ]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
