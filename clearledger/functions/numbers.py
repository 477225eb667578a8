"""Numbers written with a decimal comma, a thousands dot, or plainly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearledger.functions.text import strip_whitespace

# Fixed patterns. PLAIN_NUMBER keeps texts such as 1d, inf or 0x1p3 away from the cast, which
# would accept them.
PLAIN_NUMBER = (
    r"^[ \t\r\n]*+[+-]?+(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[ \t\r\n]*+\z"
)
COMMA_OR_GROUPED = r"(?s)^(.*,.*|[0-9]{1,3}(\.[0-9]{3})+)\z"
GERMAN_NUMBER = r"^[0-9]+(\.[0-9]{3})*(,[0-9]+)?\z"


def _plain(text: Column) -> Column:
    """A plainly written number, else null. Only matching texts are cast, because a cast that
    fails costs an exception."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def _decimal_comma(text: Column) -> Column:
    """Read the comma as decimal point; dots group thousands."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_number_warehouse(c: Column) -> Column:
    """Loading rule: a valid plain number wins, then comma, then dots as thousands marks."""
    return F.coalesce(_plain(c), _plain(_decimal_comma(F.trim(c))))


def parse_number_mixed(c: Column) -> Column:
    """Profiling rule: as the loading rule, but dots alone must form groups of three."""
    text = strip_whitespace(c)
    return F.coalesce(
        _plain(text), _plain(_decimal_comma(F.regexp_extract(text, COMMA_OR_GROUPED, 0)))
    )


def looks_like_german_number(c: Column) -> Column:
    """Whether a text has the shape of a German number (used to recommend conversion)."""
    return c.rlike(GERMAN_NUMBER)
