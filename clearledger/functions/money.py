"""Currency conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EUR = "EUR"


def to_eur(amount: Column, currency: Column, rate: Column) -> Column:
    """Amount in EUR: EUR stays as it is, a missing rate counts as 1."""
    return F.when(currency == EUR, amount).otherwise(
        amount * F.coalesce(rate, F.lit(1.0))
    )
