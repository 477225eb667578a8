"""Whitespace, placeholder and substring handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space, plus the four separators
# U+001C..U+001F that text tools also strip.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The characters the whitespace report looks at.
REPORTED_WHITESPACE = (" ", "\t", "\n")


def strip_whitespace(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITESPACE))


def has_outer_whitespace(c: Column) -> Column:
    """True when stripping would change the value; null stays null."""
    return c != strip_whitespace(c)


def whitespace_issue(c: Column) -> Column:
    """'leading', 'trailing' or 'both' for blanks, tabs and newlines at the ends, else null."""
    leading = F.substring(c, 1, 1).isin(*REPORTED_WHITESPACE)
    trailing = F.substring(c, -1, 1).isin(*REPORTED_WHITESPACE)
    return (
        F.when(leading & trailing, F.lit("both"))
        .when(leading, F.lit("leading"))
        .when(trailing, F.lit("trailing"))
    )


def count_digits(c: Column) -> Column:
    """Number of ASCII digits in the text of a value; a null has none."""
    text = c.cast("string")
    return F.coalesce(
        F.length(text) - F.length(F.translate(text, "0123456789", "")), F.lit(0)
    )


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(c).contains(needle.lower())


def present(c: Column, placeholders: list[str], trimmed: bool = False) -> Column:
    """Keep predicate: not null and not one of the placeholder texts.

    With ``trimmed`` the comparison ignores blanks around the value; without it a padded
    placeholder such as ``' - '`` counts as real data.
    """
    compared = F.trim(c) if trimmed else c
    return c.isNotNull() & ~compared.isin(*placeholders)
