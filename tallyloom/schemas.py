"""Declared schemas of the raw files.

Dates and codes stay text here: cleaning decides what they mean. With a declared
schema the reader makes one pass and a file of all-ISO dates reads like any other.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("created_date", T.StringType()),
    ]
)

BUDGET = T.StructType(
    [
        T.StructField("budget_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("budget_amount", T.DoubleType()),
    ]
)


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """Reader schema that also keeps the text of a line it could not parse."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
