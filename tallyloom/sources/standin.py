"""Raw finance tables derived from the given order and customer tables.

The order book stands in for the missing transaction file: each order becomes one or
two raw transactions with the defects the cleaning rules look for, chosen by residues
of its key. Everything is an expression over one scan, so it grows with the tables.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.sources.csv import SOURCES, stamp

# The orders run from 1995 to 2001.
SETTINGS = replace(
    Settings(),
    first_valid_date=date(1995, 1, 1),
    last_valid_date=date(2000, 12, 31),
    spine_start=date(1995, 1, 1),
    spine_end=date(2001, 12, 31),
    trend_years=(1999, 2000),
)

# Ids of orders that were sent again: the recipe holds for order keys below this number.
RESENT = 1_000_000_007
# Fixed values that the expected counts depend on.
CREDITED = ("Salary", "Transfer", "Investment")
CATEGORIES = [name for names in SETTINGS.category_groups.values() for name in names]
BUDGETED = [
    name for (_, flow), names in SETTINGS.category_groups.items() if flow == "Outflow" for name in names
]
# Spellings of a status that no rule, or an unusual one, accepts.
ODD_STATUSES = ("DONE", "complete", "Compleeted", "nil", "NULL", "unknown", "3", "yes")


def _messy_day(iso: Column, layout: Column) -> Column:
    """ISO text of a day in one of four layouts."""
    day_first = layout == 2
    first = F.substring(iso, F.when(day_first, 9).otherwise(6), F.lit(2))
    second = F.substring(iso, F.when(day_first, 6).otherwise(9), F.lit(2))
    separator = F.when(layout == 1, "/").otherwise("-")
    return F.when(layout == 0, iso).otherwise(
        F.concat(first, separator, second, separator, F.substring(iso, 1, 4))
    )


def transactions_file(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions as a file would hold them, without provenance."""
    k, tid, copy = F.col("k"), F.col("tid"), F.col("copy")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderdate").cast("date").cast("string").alias("d"),
        F.col("o_totalprice").alias("p"),
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "pending")
        .when(F.col("o_orderstatus") == "F", "failed")
        .otherwise("completed")
        .alias("state"),
    )
    named = orders.withColumn(
        "cat",
        F.element_at(F.array(*map(F.lit, CATEGORIES)), ((k * 7 + F.col("c")) % 10 + 1).cast("int")),
    )
    # One order in 25 is sent twice, under a second id.
    sent = named.withColumn("copy", F.explode(F.when(k % 25 == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = sent.withColumn("tid", k + copy * RESENT).withColumn(
        "p", F.when((copy == 1) & (k % 50 == 31), F.col("p") + 0.01).otherwise(F.col("p"))
    )
    cat, state = F.col("cat"), F.col("state")
    direction = F.when(cat.isin(*CREDITED), "credit").otherwise("debit")
    odd_status = F.element_at(F.array(*map(F.lit, ODD_STATUSES)), (F.floor(k % 400 / 50) + 1).cast("int"))
    return rows.select(
        tid.alias("transaction_id"),
        F.when(k % 80 == 11, F.lit(-1)).when(k % 160 == 51, F.lit(999_999_999)).otherwise(F.col("c")).alias("account_id"),
        F.when(k % 70 == 5, "").when(k % 210 == 17, "1999-02-30").otherwise(_messy_day(F.col("d"), tid % 4)).alias("transaction_date"),
        F.when(k % 60 == 9, "")
        .when(k % 7 == 1, F.upper(cat))
        .when(k % 7 == 2, F.lower(cat))
        .when(k % 13 == 3, F.concat(F.lit("  "), cat, F.lit("  ")))
        .otherwise(cat)
        .alias("category"),
        F.when(k % 65 != 12, F.when(k % 40 == 8, -F.col("p")).otherwise(F.col("p"))).alias("amount"),
        F.when(k % 75 != 20, F.when(k % 9 == 4, F.upper(direction)).otherwise(direction)).alias("transaction_type"),
        F.concat(F.when(k % 14 == 0, "  ").otherwise(""), cat, F.lit(" - "), F.col("priority")).alias("description"),
        F.when(k % 50 == 1, odd_status)
        .when((copy == 0) & (k % 100 == 6), "unknown")
        .when(k % 11 == 2, F.upper(state))
        .otherwise(state)
        .alias("status"),
    )


def accounts_file(spark: SparkSession, folder: str) -> DataFrame:
    """Raw accounts: one per customer, with padded names and mixed case."""
    k = F.col("c_custkey")
    # Nations and regions are fixed lists of 25 and 5 rows.
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    regions = spark.read.parquet(f"{folder}/region.parquet")
    places = nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = spark.read.parquet(f"{folder}/customer.parquet").join(
        F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")
    )
    opened = F.date_add(F.lit(date(2020, 1, 1)), (k % 1000).cast("int")).cast("string")
    return customers.select(
        k.alias("account_id"),
        F.when(k % 4 == 1, F.concat(F.lit("  "), F.col("c_name"))).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(k % 5 == 2, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("account_type"),
        F.when(k % 3 == 1, F.lower("r_name")).otherwise(F.col("r_name")).alias("region"),
        _messy_day(opened, k % 4).alias("created_date"),
    )


# The account that holds a third of the rows where a busy one is wanted, and the days of its yearly snapshots.
BUSY_ACCOUNT = 3
SNAPSHOT_DAYS = (date(1995, 6, 1), date(1997, 1, 15), date(1999, 3, 31))


def busy(transactions: DataFrame) -> DataFrame:
    """The same transactions, every third of them moved to one account."""
    return transactions.withColumn("account_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(BUSY_ACCOUNT)).otherwise(F.col("account_id")))


def account_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Dated states of all accounts: some open after the first snapshot, some move, some move and return."""
    k, n = F.col("account_id"), F.col("n")
    day = F.element_at(F.array(*map(F.lit, SNAPSHOT_DAYS)), n + 1)
    region = F.when((k % 10 == 3) & (n >= 1), "EUROPE").when((k % 10 == 4) & (n == 1), "ASIA").otherwise(F.upper("region"))
    taken = accounts_file(spark, folder).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(len(SNAPSHOT_DAYS) - 1))))
    taken = taken.filter((k % 7 != 5) | (n > 0))
    return taken.select("account_id", F.upper("account_type").alias("account_type"), region.alias("region"), day.alias("snapshot_date"))


def account_feed(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """States of accounts with a version. Feed 0 has all at version 1, later ones what changed since.

    Feed 1 renames accounts, opens new ones and brings stale states; feed 2 changes some of the
    same twice, opens a few again and sends what feed 1 had sent.
    """
    k = F.col("account_id")
    base = accounts_file(spark, folder).select("account_id", F.trim("customer_name").alias("customer_name"), F.upper("account_type").alias("account_type"), F.upper("region").alias("region"))

    def state(rows: DataFrame, version: int, label: str | None = None) -> DataFrame:
        name = F.concat(F.col("customer_name"), F.lit(f" {label}")) if label else F.col("customer_name")
        return rows.withColumns({"customer_name": name, "version": F.lit(version).cast("long")})

    opened = base.filter(k % 50 == 7).withColumn("account_id", k + 10_000_000)
    first = state(base.filter(k % 10 == 3), 2, "renamed").union(state(opened, 1)).union(state(base.filter(k % 10 == 6), 0, "stale"))
    if number == 0:
        return state(base, 1)
    if number == 1:
        return first
    again = state(base.filter(k % 20 == 3), 3, "twice").union(state(base.filter(k % 20 == 3), 4, "thrice"))
    return again.union(state(opened.filter(k % 100 == 7), 5, "kept")).union(first)


def budget_file(spark: SparkSession, settings: Settings = SETTINGS) -> DataFrame:
    """Raw monthly budget of each spending category in the trend years."""
    years, lines = settings.trend_years, len(BUDGETED)
    number = F.col("id")
    month = F.floor(number / lines) % 12 + 1
    name = F.element_at(F.array(*map(F.lit, BUDGETED)), (number % lines + 1).cast("int"))
    year = F.element_at(F.array(*map(F.lit, years)), (F.floor(number / (12 * lines)) + 1).cast("int"))
    return spark.range(0, len(years) * 12 * lines, 1, 1).select(
        (number + 1).alias("budget_id"),
        F.when(month % 5 == 2, F.upper(name)).otherwise(name).alias("category"),
        month.cast("int").alias("month"),
        year.alias("year"),
        (1000.0 + 10 * month).alias("budget_amount"),
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return stamp(transactions_file(spark, folder), SOURCES["transactions"].file)


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return stamp(accounts_file(spark, folder), SOURCES["accounts"].file)


def raw_budget(spark: SparkSession) -> DataFrame:
    return stamp(budget_file(spark), SOURCES["budget"].file)
