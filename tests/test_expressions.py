"""Column expressions: codes, amounts, text, keys, money."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyloom.config import STATUS_SPELLINGS, Settings
from tallyloom.functions import money
from tallyloom.functions.codes import canonicalise
from tallyloom.functions.keys import category_key, date_key, surrogate_key
from tallyloom.functions.money import correct_amount
from tallyloom.functions.text import standardise


def column(spark, kind, values):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, v {kind}")


def values(frame, *names):
    return [tuple(row[name] for name in names) for row in frame.orderBy("i").collect()]


def test_status_spellings(spark):
    expected = {
        "completed": "completed",
        "COMPLETE": "completed",
        "DONE": "completed",
        "Pending": "pending",
        "FAILED": "failed",
        "Compleeted": None,
        "nil": None,
        "NULL": None,
        "unknown": None,
        "3": None,
        "yes": None,
        "": None,
        None: None,
    }
    frame = column(spark, "string", expected).select("i", canonicalise(F.col("v"), STATUS_SPELLINGS).alias("s"))
    assert values(frame, "s") == [(status,) for status in expected.values()]


def test_amount_sign(spark):
    frame = column(spark, "double", [-5.0, 5.0, 0.0, None]).withColumnRenamed("v", "amount")
    assert values(correct_amount(frame), "amount", "_amount_corrected") == [
        (5.0, True),
        (5.0, False),
        (0.0, False),
        (None, False),
    ]


def test_amount_text_that_is_no_number_becomes_null(spark):
    frame = column(spark, "string", ["-5", "abc", "", "12.50"]).withColumnRenamed("v", "amount")
    assert values(correct_amount(frame), "amount", "_amount_corrected") == [
        (5.0, True),
        (None, False),
        (None, False),
        (12.5, False),
    ]


def test_standardise(spark):
    frame = spark.createDataFrame(
        [(0, "  gROCERIES ", " Keeps Case ", " DEBIT", " Done "), (1, "\trent", None, None, None), (2, "pet-care for me", "", "", "")],
        "i int, category string, description string, transaction_type string, status string",
    )
    assert values(standardise(frame), "category", "description", "transaction_type", "status") == [
        ("Groceries", "Keeps Case", "debit", "Done"),
        ("\trent", None, None, None),
        ("Pet-care For Me", "", "", ""),
    ]


def test_keys(spark):
    frame = column(spark, "bigint", [1, -7, None]).select("i", surrogate_key(F.col("v")).alias("k"))
    assert values(frame, "k") == [
        ("6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b",),
        (hashlib.sha256(b"-7").hexdigest(),),
        (None,),
    ]
    names = column(spark, "string", ["Rent", "RENT"]).select("i", category_key(F.col("v")).alias("k"))
    assert values(names, "k") == [(hashlib.sha256(b"rent").hexdigest(),)] * 2
    days = column(spark, "string", ["2023-04-05", "0001-01-01", None]).select(
        "i", date_key(F.col("v").cast("date")).alias("k")
    )
    assert values(days, "k") == [("20230405",), ("00010101",), (None,)]


def test_money_is_exact(spark):
    # As doubles, these add up to something else in every order of addition.
    amounts = column(spark, "double", [0.1] * 10 + [1e15, 0.01, None])
    row = amounts.agg(money.total("v").alias("t"), money.average("v").alias("a")).first()
    assert row.t == 1000000000000001.01
    assert row.a == 83333333333333.42
    tie = column(spark, "double", [0.01, 0.0, 0.01, 0.0]).agg(money.average("v").alias("a")).first()
    assert tie.a == 0.01
    empty = amounts.filter("false").agg(money.total("v").alias("t"), money.average("v").alias("a")).first()
    assert tuple(empty) == (None, None)


def test_share(spark):
    frame = column(spark, "bigint", [1, 3, 0]).select("i", money.share(F.col("v"), F.lit(3), 1).alias("s"))
    assert values(frame, "s") == [(33.3,), (100.0,), (0.0,)]
    none = column(spark, "bigint", [0]).select("i", money.share(F.col("v"), F.lit(0), 1).alias("s"))
    assert values(none, "s") == [(None,)]


def test_settings_cannot_change():
    with pytest.raises(AttributeError):
        Settings().trend_years = (1,)
