"""Dates written in several formats within one column.

One pattern rewrites every accepted notation to year-month-day, and ``try_cast`` reads the
result inside generated code, giving null for impossible days. The text is referred to once,
so expressions behind it, and filters that repeat the whole, stay small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearledger.functions.text import strip_whitespace

# Fixed patterns: a notation, and the groups holding year, month and day.
DOTTED = (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})\z", (3, 2, 1))
# Day up to 31 and month up to 12.
SLASHED_DAY_FIRST = (r"^([0-2]?\d|3[01])/(0?\d|1[0-2])/(\d{4})\z", (3, 2, 1))
SLASHED_MONTH_FIRST = (r"^(0?\d|1[0-2])/(\d{1,2})/(\d{4})\z", (3, 1, 2))
DASHED_DAY_FIRST = (r"^(\d{1,2})-(\d{1,2})-(\d{4})\z", (3, 2, 1))
YEAR_FIRST = (r"^(\d{4})-(\d{1,2})-(\d{1,2})\z", (1, 2, 3))
YEAR_FIRST_SLASHED = (r"^(\d{4})/(\d{1,2})/(\d{1,2})\z", (1, 2, 3))
# Padded, or with a time of day.
TIME_OF_DAY = r"(?:[ T](?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d{1,9})?)?)?"
YEAR_FIRST_LOOSE = (rf"^ *(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){TIME_OF_DAY} *\z", (1, 2, 3))
YEAR_FIRST_LOOSE_SLASHED = (
    rf"^ *(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){TIME_OF_DAY} *\z",
    (1, 2, 3),
)
ANYTHING_ELSE = r"(?s)^.*\z"

# The shapes of the format report, in the order they are tried.
DATE_SHAPES = (
    (r"\d{1,2}/\d{1,2}/\d{4}", "DD/MM/YYYY or MM/DD/YYYY"),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", "DD.MM.YYYY"),
    (r"\d{4}-\d{1,2}-\d{1,2}", "YYYY-MM-DD"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "DD-MM-YYYY"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "YYYY/MM/DD"),
    (r"\d{1,2}\s+[a-zA-Z]{3,}\s+\d{4}", "DD Month YYYY"),
    (r"[a-zA-Z]{3,}\s+\d{1,2},?\s+\d{4}", "Month DD, YYYY"),
    (r"\d{8}", "YYYYMMDD or DDMMYYYY"),
)
UNRECOGNIZED = "unrecognized"

# The shapes that make the table cleaner treat a column as dates.
CLEANER_DATE_SHAPES = (
    r"\d{1,2}/\d{1,2}/\d{4}",
    r"\d{1,2}\.\d{1,2}\.\d{4}",
    r"\d{4}-\d{1,2}-\d{1,2}",
)

# Format names in strptime notation, in the order the profiling rule tries them.
NAMED_NOTATIONS = (
    ("%d/%m/%Y", SLASHED_DAY_FIRST),
    ("%m/%d/%Y", SLASHED_MONTH_FIRST),
    ("%d.%m.%Y", DOTTED),
    ("%Y-%m-%d", YEAR_FIRST),
    ("%d-%m-%Y", DASHED_DAY_FIRST),
    ("%Y/%m/%d", YEAR_FIRST_SLASHED),
)

# Written-out formats tried last, in Spark pattern letters.
WRITTEN_OUT = r"[a-zA-Z]{3}|^\d{8}\z"
FALLBACK_FORMATS = ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd")


def _day(text: Column, notations: list[tuple[str, tuple[int, int, int]]]) -> Column:
    """The date of a text in the first notation that fits, else null.

    All notations are alternatives of one pattern. Groups of those that do not fit are empty,
    so putting the year groups, month groups and day groups after one another leaves the parts
    of the one that does; a text fitting none becomes two dashes, which is no date.
    """
    parts: tuple[list[int], ...] = ([], [], [])
    for i, (_, groups) in enumerate(notations):
        for part, group in zip(parts, groups):
            part.append(3 * i + group)
    pattern = "|".join([p for p, _ in notations] + [ANYTHING_ELSE])
    rewritten = "-".join("".join(f"${g}" for g in part) for part in parts)
    return F.regexp_replace(text, pattern, rewritten).try_cast("date")


def parse_date_warehouse(c: Column) -> Column:
    """Loading rule: dotted day first, slashed day first unless the second part exceeds 12,
    then year first, also padded or with a time of day. Anything else is null."""
    return _day(
        c,
        [
            DOTTED,
            SLASHED_DAY_FIRST,
            SLASHED_MONTH_FIRST,
            YEAR_FIRST_LOOSE,
            YEAR_FIRST_LOOSE_SLASHED,
        ],
    )


def has_parsing_error(parsed: Column, raw: Column) -> Column:
    """A value was given but could not be read; a missing value is no error. Never null."""
    return parsed.isNull() & raw.isNotNull()


def detect_date_format(c: Column) -> Column:
    """Name of the first format whose shape matches and which gives a real day, else null.

    Where day first fits but names no real day, month first cannot either.
    """
    text = strip_whitespace(c)
    named = [
        F.when(_day(text, [notation]).isNotNull(), F.lit(name))
        for name, notation in NAMED_NOTATIONS
    ]
    return F.coalesce(*named)


def parse_date_mixed(c: Column) -> Column:
    """Profiling rule: strip, then the first format that gives a day, then written-out ones."""
    text = strip_whitespace(c)
    day = _day(text, [notation for _, notation in NAMED_NOTATIONS])
    written = [
        F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in FALLBACK_FORMATS
    ]
    return F.coalesce(day, F.when(text.rlike(WRITTEN_OUT), F.coalesce(*written)))


def date_shape(c: Column, anchored: bool) -> Column:
    """First date shape found: in the whole stripped text, or anywhere in the raw text."""
    if anchored:
        return stripped_date_shape(strip_whitespace(c))
    return F.coalesce(*[F.when(c.rlike(pattern), F.lit(name)) for pattern, name in DATE_SHAPES])


def stripped_date_shape(text: Column) -> Column:
    """First date shape that is the whole of a stripped text."""
    return F.coalesce(
        *[F.when(text.rlike(f"^{pattern}\\z"), F.lit(name)) for pattern, name in DATE_SHAPES]
    )


def has_date_shape(c: Column) -> Column:
    """Whether any of the reported shapes occurs in the text."""
    return c.rlike("|".join(pattern for pattern, _ in DATE_SHAPES))


def looks_like_date(c: Column) -> Column:
    """Whether any shape the table cleaner knows occurs in the text."""
    return c.rlike("|".join(CLEANER_DATE_SHAPES))
