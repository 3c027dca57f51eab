"""Parsing of date text that arrives in four layouts, without a Python UDF.

One pattern rewrites any accepted layout to year-month-day, so the expression mentions
its input once. Filters that Spark copies towards the scan then stay small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]*"
YEAR = r"(?!0000)\d{4}"  # Spark would parse year 0 although no calendar has it

# The accepted layouts. A dash date is day first only if its first part
# cannot be a month; the last alternative takes any other text and fills no group.
LAYOUTS = (
    "(?s)^(?:" + BLANKS + "(?:"
    rf"({YEAR})-(\d{{2}})-(\d{{2}})"  # year-month-day
    rf"|(1[3-9]|[2-9]\d)-(\d{{2}})-({YEAR})"  # day-month-year
    rf"|(\d{{2}})([-/])(\d{{2}})\8({YEAR})"  # month-day-year, month/day/year
    ")" + BLANKS + "|.*)$"
)
YEAR_MONTH_DAY = "$1$6$10-$2$5$7-$3$4$9"

# Two parts that are both possible months, so the order of day and month is a guess.
EITHER_ORDER = rf"^{BLANKS}(0[1-9]|1[0-2])-(0[1-9]|1[0-2])-{YEAR}{BLANKS}$"


def parse_mixed_date(text: Column) -> Column:
    """Struct of ``date`` and ``ambiguous`` for a date in any accepted layout.

    A dash date whose first two parts could both be months is read month first and
    marked ambiguous. Blank text, any other layout and days the calendar does not
    have give a NULL date that is not ambiguous.
    """
    return F.struct(
        F.regexp_replace(text, LAYOUTS, YEAR_MONTH_DAY).try_cast("date").alias("date"),
        F.coalesce(text.rlike(EITHER_ORDER), F.lit(False)).alias("ambiguous"),
    )
