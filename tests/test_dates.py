"""Truth table of the mixed date parser."""

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.dates import parse_mixed_date

APRIL = date(2023, 4, 15)
TABLE = [
    ("2023-04-15", APRIL, False),
    (" 04/15/2023 ", APRIL, False),
    ("15-04-2023", APRIL, False),
    ("04-15-2023", APRIL, False),
    ("\t2023-01-01\n", date(2023, 1, 1), False),
    (" 2023-01-01 \x85", date(2023, 1, 1), False),
    ("02-29-2024", date(2024, 2, 29), False),
    ("29-02-2024", date(2024, 2, 29), False),
    ("02-29-2023", None, False),
    ("31-12-2024", date(2024, 12, 31), False),
    ("03-04-2023", date(2023, 3, 4), True),
    ("  03-04-2023\t", date(2023, 3, 4), True),
    ("05-05-2023", date(2023, 5, 5), True),
    ("12-12-2023", date(2023, 12, 12), True),
    ("03/04/2023", date(2023, 3, 4), False),
    ("0001-01-01", date(1, 1, 1), False),
    *[
        (text, None, False)
        for text in (
            "13-13-2023 2023-02-30 02-30-2023 00-00-2023 00-05-2023 05-00-2023 12-00-2023 13/01/2023 99-01-2023 "
            "32-01-2023 2023/01/01 1-2-2023 2023-1-2 2023 2023-01 2023-01-01T00:00 01-02/2023 01/02-2023 abc -- 0000-01-01 "
            "01-01-0000 15-01-0000 01/01/0000 +2023-01-01 12023-01-01 2023-01-011 now today epoch"
        ).split()
    ],
    ("", None, False),
    ("   ", None, False),
    ("2023-01-01\n2023-01-01", None, False),
    ("x\n2023-01-01", None, False),
    ("2023-01-01 x", None, False),
    (None, None, False),
]


def parse(spark, texts):
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    rows = frame.select("i", parse_mixed_date(F.col("text")).alias("p")).orderBy("i").collect()
    return [(row.p.date, row.p.ambiguous) for row in rows]


def test_truth_table(spark):
    parsed = parse(spark, [text for text, _, _ in TABLE])
    for (text, day, ambiguous), found in zip(TABLE, parsed):
        assert found == (day, ambiguous), repr(text)


def by_calendar(text):
    """The same rules through the calendar of another library, one text at a time."""
    layouts = {"-": "%m-%d-%Y", "/": "%m/%d/%Y"}
    if text[4] == "-":
        layout = "%Y-%m-%d"
    elif text[2] == "-" and int(text[:2]) > 12:
        layout = "%d-%m-%Y"
    else:
        layout = layouts[text[2]]
    try:
        day = datetime.strptime(text, layout).date()
    except ValueError:
        return None, False
    return day, layout == "%m-%d-%Y" and day.day <= 12


two, four = st.integers(0, 40).map("{:02d}".format), st.sampled_from(["0000", "0001", "1999", "2000", "2023", "2024", "9999"])
texts = st.one_of(
    st.tuples(four, two, two).map("-".join),
    st.tuples(two, two, four).map("-".join),
    st.tuples(two, two, four).map("/".join),
)


@settings(max_examples=15, deadline=None)
@given(batch=st.lists(texts, min_size=50, max_size=200))
def test_agrees_with_a_calendar(spark, batch):
    assert parse(spark, batch) == [by_calendar(text) for text in batch]
