"""Intermediate models: rows whose date could be read, without the flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.functions import present
from clearledger.plans.staging import ERROR_FLAG


def without_date_errors(staged: DataFrame) -> DataFrame:
    """Accounts, fx rates, loans and transactions. A row with a missing date stays.

    Date and flag pass through a generator of one row: a filter on the flag itself would be
    pushed below the projection that parses, and every date would be parsed twice.
    """
    dates = [f.name for f in staged.schema.fields if isinstance(f.dataType, T.DateType)]
    judged = [*dates, ERROR_FLAG]
    others = [c for c in staged.columns if c not in judged]
    kept = staged.select(*others, F.inline(F.array(F.struct(*judged)))).filter(~F.col(ERROR_FLAG))
    return kept.select(*[c for c in staged.columns if c != ERROR_FLAG])


def int_customers(staged: DataFrame) -> DataFrame:
    return staged


def int_currencies(seed: DataFrame) -> DataFrame:
    """Distinct trimmed codes; placeholders go, an empty code stays."""
    code = F.col("currency_iso_code")
    return (
        seed.filter(present(code, ["(none)"], trimmed=True))
        .select(F.trim("currency").alias("currency"), F.trim(code).alias("currency_iso_code"))
        .distinct()
    )
