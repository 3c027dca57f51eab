"""Labelling of raw transactions: golden counts, rule order, duplicates, hot accounts."""

import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import TESTDATA
from tallyloom.config import Settings
from tallyloom.functions import money
from tallyloom.operators import dedup, references, rules
from tallyloom.plans import silver
from tallyloom.sources import csv, standin
from tallyloom.sources.standin import SETTINGS, raw_accounts, raw_transactions

# Counts of the stand-in data that were derived outside Spark.
GOLDEN = {
    "sf0.001": dict(
        raw=1560, clean=1258, OUT_OF_RANGE_DATE=125, INVALID_STATUS=33, NULL_DATE=30, ORPHANED_ACCOUNT_ID=27,
        DUPLICATE=26, NULL_CATEGORY=23, NULL_AMOUNT=20, NULL_TRANSACTION_TYPE=18, ambiguous=215, corrected=34,
        total=315012361.79,
    ),
    "sf0.01": dict(
        raw=15600, clean=12530, OUT_OF_RANGE_DATE=1335, INVALID_STATUS=351, NULL_DATE=287, ORPHANED_ACCOUNT_ID=272,
        DUPLICATE=239, NULL_CATEGORY=218, NULL_AMOUNT=201, NULL_TRANSACTION_TYPE=167, ambiguous=2411, corrected=335,
        total=3142927719.39,
    ),
    "sf0.1": dict(
        raw=156000, clean=125252, OUT_OF_RANGE_DATE=13464, INVALID_STATUS=3412, NULL_DATE=2858,
        ORPHANED_ACCOUNT_ID=2767, DUPLICATE=2229, NULL_CATEGORY=2283, NULL_AMOUNT=2051, NULL_TRANSACTION_TYPE=1684,
        ambiguous=24486, corrected=3400, total=31334201004.13,
    ),
}

LOADED = datetime(2024, 1, 1)
RAW = (
    "transaction_id long, account_id long, transaction_date string, category string, amount double, "
    "transaction_type string, description string, status string, _ingested_at timestamp, _source_file string"
)


def raw_row(number, account=1, day="2023-05-20", category="Rent", amount=10.0, kind="debit", status="done", at=LOADED):
    return (number, account, day, category, amount, kind, "text", status, at, "file.csv")


def label(spark, rows, settings=Settings(), accounts=(1, 2)):
    known = spark.createDataFrame([(account,) for account in accounts], "account_id long")
    return silver.label(spark.createDataFrame(rows, RAW), known, settings)


def reasons(labelled):
    return {row.transaction_id: row._rejection_reason for row in labelled.collect()}


@pytest.mark.parametrize("scale", GOLDEN)
def test_golden_counts(spark, scale):
    folder = f"{TESTDATA}/{scale}"
    labelled = silver.label(raw_transactions(spark, folder), raw_accounts(spark, folder), SETTINGS)
    accepted = F.col(rules.REASON).isNull()
    row = labelled.agg(
        F.count("*").alias("raw"),
        F.count_if(accepted).alias("clean"),
        F.count_if(accepted & F.col("_date_ambiguous")).alias("ambiguous"),
        F.count_if(accepted & F.col("_amount_corrected")).alias("corrected"),
        F.sum(F.when(accepted, F.col("amount").cast("decimal(18,2)"))).cast("double").alias("total"),
        *[
            F.count_if(F.col(rules.REASON) == name).alias(name)
            for name in GOLDEN[scale]
            if name.isupper()
        ],
    ).first()
    assert row.asDict() == GOLDEN[scale]


def test_first_broken_rule_names_the_row(spark):
    good = raw_row(1)
    rows = [
        good,
        raw_row(2, day="soon", status="3"),
        raw_row(3, day="2022-12-31", category=""),
        raw_row(4, day="2025-01-01"),
        raw_row(5, day="2023-01-01"),
        raw_row(6, day="2024-12-31"),
        raw_row(7, category=None, amount=None),
        raw_row(8, category="   "),
        raw_row(9, amount=None, kind=None),
        raw_row(10, kind=None, status=None, amount=3.0),
        raw_row(11, kind="", amount=4.0),
        raw_row(12, status="yes", account=99),
        raw_row(13, account=99),
        raw_row(14, account=None),
        raw_row(15),
        raw_row(16, status="nil"),
        raw_row(17, amount=10.01),
        raw_row(18, amount=-10.0),
    ]
    assert reasons(label(spark, rows)) == {
        1: None,
        2: "NULL_DATE",
        3: "OUT_OF_RANGE_DATE",
        4: "OUT_OF_RANGE_DATE",
        5: None,
        6: None,
        7: "NULL_CATEGORY",
        8: "NULL_CATEGORY",
        9: "NULL_AMOUNT",
        10: "NULL_TRANSACTION_TYPE",
        11: None,
        12: "INVALID_STATUS",
        13: "ORPHANED_ACCOUNT_ID",
        14: "ORPHANED_ACCOUNT_ID",
        15: "DUPLICATE",
        16: "INVALID_STATUS",
        17: None,
        18: "DUPLICATE",
    }


def test_an_invalid_row_can_survive_its_valid_twin(spark):
    rows = [raw_row(1, status="yes"), raw_row(2)]
    assert reasons(label(spark, rows)) == {1: "INVALID_STATUS", 2: "DUPLICATE"}
    settled = replace(Settings(), dedup_after_validation=True)
    labelled = label(spark, rows, settled)
    assert reasons(labelled) == {1: "INVALID_STATUS", 2: None}
    assert labelled.columns == label(spark, rows).columns


def test_latest_load_survives(spark):
    rows = [raw_row(1), raw_row(2, at=datetime(2024, 1, 2)), raw_row(3, at=datetime(2024, 1, 2))]
    assert reasons(label(spark, rows)) == {1: "DUPLICATE", 2: None, 3: "DUPLICATE"}


def test_repeated_account_does_not_repeat_rows(spark):
    assert reasons(label(spark, [raw_row(1)], accounts=(1, 1, 1))) == {1: None}


def test_raw_values_are_kept_on_request(spark):
    row = label(spark, [raw_row(1, day=" x ", status=" Nil")], replace(Settings(), keep_raw_values=True)).first()
    assert (row._raw_date, row._raw_status, row.transaction_date, row.status) == (" x ", " Nil", None, None)


def test_split_is_whole_and_repeatable(spark):
    folder = f"{TESTDATA}/sf0.001"

    def split():
        labelled = silver.label(raw_transactions(spark, folder), raw_accounts(spark, folder), SETTINGS)
        ids = [
            sorted(row.transaction_id for row in side(labelled).select("transaction_id").collect())
            for side in (rules.clean, rules.quarantine)
        ]
        return ids

    accepted, rejected = split()
    everything = raw_transactions(spark, folder).select("transaction_id").collect()
    assert sorted(accepted + rejected) == sorted(row.transaction_id for row in everything)
    assert split() == [accepted, rejected]


def skewed(spark, keep_amounts):
    """Stand-in rows of which a third belong to one account, and many to a NULL one."""
    k = F.col("transaction_id") % 1_000_000_007
    rows = raw_transactions(spark, f"{TESTDATA}/sf0.001").withColumn(
        "account_id",
        F.when(k % 3 == 0, 7).when(k % 7 == 1, -1).when(k % 7 == 2, F.lit(None)).otherwise(F.col("account_id")),
    )
    if keep_amounts:
        return rows
    # The hot account's rows share one business key as well.
    same = {"amount": F.lit(-5.0), "category": F.lit("rent"), "transaction_date": F.lit("1999-05-20")}
    hot = F.coalesce(F.col("account_id") == 7, F.lit(False))
    return rows.withColumns({name: F.when(hot, value).otherwise(F.col(name)) for name, value in same.items()})


@pytest.mark.parametrize("keep_amounts", [True, False])
@pytest.mark.parametrize("dedup_after_validation", [True, False])
def test_busy_accounts_and_keys_are_labelled_like_others(spark, keep_amounts, dedup_after_validation, monkeypatch):
    rows = skewed(spark, keep_amounts)
    accounts = raw_accounts(spark, f"{TESTDATA}/sf0.001")
    settings = replace(SETTINGS, dedup_after_validation=dedup_after_validation)
    keys = [*settings.business_key, *(["_valid"] if dedup_after_validation else [])]

    def labels():
        return sorted(map(tuple, silver.label(rows, accounts, settings).drop("_ingested_at").collect()))

    pieces = dedup.dedup_rank
    whole = labels()
    monkeypatch.setattr(dedup, "dedup_rank", lambda frame, by, **more: pieces(frame, by, 100, **more))
    cut = labels()
    window = Window.partitionBy(*keys).orderBy(*dedup.newest_first())
    monkeypatch.setattr(dedup, "dedup_rank", lambda frame, by, **more: frame.withColumn(dedup.RANK, F.row_number().over(window)))
    assert whole == cut == labels()


def test_pieces_of_one_key_give_the_ranks_of_one_window(spark):
    rows = spark.range(5000).selectExpr(
        "if(id % 977 = 0, null, id) as transaction_id", "timestamp'2024-01-01' + make_interval(0,0,0,0,0,0,id % 3) as _ingested_at",
        "if(id % 3 = 0, null, 1) as a", "if(id % 5 = 0, id, 0) as b",
    )
    window = Window.partitionBy("a", "b").orderBy(*dedup.newest_first())
    plain = rows.withColumn(dedup.RANK, F.row_number().over(window))
    for size in (1, 64, 10**6):
        cut = dedup.dedup_rank(rows, ["a", "b"], size)
        assert cut.columns == plain.columns
        assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_labelling_is_one_lazy_plan(spark):
    """No job before the result is asked for; accounts are read once, keys are cut into pieces."""
    folder = f"{TESTDATA}/sf0.001"
    rows, accounts = raw_transactions(spark, folder), raw_accounts(spark, folder)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobGroup("labelling", "labelling")
    try:
        labelled = silver.label(rows, accounts, SETTINGS)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("labelling")
        plan = labelled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    dealt = re.findall(r"hashpartitioning\(([^()]*(?:\([^()]*\)[^()]*)*), \d+\)", plan)
    assert any("_key" in by and "_piece" in by for by in dealt)
    assert plan.count("customer.parquet") == 1 and "explode" not in plan.split("customer.parquet")[0].split("_parent")[-1]
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_a_busy_account_is_split_when_accounts_are_checked(spark):
    """Where Spark joins by sorting, adaptive execution splits the partition of an account that holds most rows."""
    rows = spark.range(0, 200_000, 1, 16).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).alias("account_id"), F.sha1(F.col("id").cast("string")).alias("text")
    )
    accounts = spark.range(500).withColumnRenamed("id", "account_id")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        flagged = references.flag_orphans(rows, accounts, "account_id")
        counted = flagged.groupBy("text").agg(F.max(references.ORPHAN).alias("orphan")).groupBy("orphan").count()
        found = {row.orphan: row["count"] for row in counted.collect()}
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    lost = sum(1 for n in range(200_000) if n % 3 == 0 and n % 1000 >= 500)
    assert found == {True: lost, False: 200_000 - lost}
    assert "skew=true" in plan


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), float("-inf"), 1e25, -1e15])
def test_amounts_that_are_none_are_rejected_by_name(spark, amount):
    rows = [raw_row(1, amount=amount), raw_row(2, amount=5.0), raw_row(3, amount=-0.0), raw_row(4, amount=9.9e14)]
    labelled = label(spark, rows)
    assert reasons(labelled) == {1: "NULL_AMOUNT", 2: None, 3: None, 4: None}
    facts = rules.clean(labelled).withColumn("status", F.lit("x"))
    assert facts.agg(money.total("amount").alias("t")).first().t == 990000000000005.0


def test_unreadable_ids_and_surplus_cells_reach_quarantine(spark, tmp_path):
    source = csv.SOURCES["transactions"]
    ids, ends = ("1", "TX-77", "99999999999999999999", "4"), ("", "", "", ",ninth")
    lines = [f"{n},1,2023-05-20,Rent,{10 + k},debit,x,done{end}" for k, (n, end) in enumerate(zip(ids, ends))] + ["5,1,2023-05-20,Rent"]
    (tmp_path / source.file).write_text("\n".join([",".join(source.schema.names), *lines]) + "\n")
    raw = csv.read_csv(spark, str(tmp_path), source)
    labelled = silver.label(raw, spark.createDataFrame([(1,)], "account_id long"), Settings())
    found = {row._corrupt_record: row._rejection_reason for row in rules.quarantine(labelled).collect()}
    assert found == {lines[1]: "MALFORMED_LINE", lines[2]: "MALFORMED_LINE", lines[3]: "MALFORMED_LINE", lines[4]: "NULL_AMOUNT"}
    accepted = rules.clean(labelled)
    assert [row.transaction_id for row in accepted.collect()] == [1] and "_corrupt_record" not in accepted.columns


def test_corrupt_lines_reach_quarantine(spark, tmp_path):
    source = csv.SOURCES["transactions"]
    (tmp_path / source.file).write_text(
        ",".join(source.schema.names)
        + '\n1,1,2023-05-20,Rent,10.5,debit," pad ",done\n2,1,2023-05-20,Rent,abc,debit,x,done\n3,1,2023-05-20,Food\n'
    )
    raw = csv.read_csv(spark, str(tmp_path), source)
    known = spark.createDataFrame([(1,)], "account_id long")
    labelled = silver.label(raw, known, Settings())
    assert reasons(labelled) == {1: None, 2: "NULL_AMOUNT", 3: "NULL_AMOUNT"}
    assert {row.transaction_id for row in raw.filter("_corrupt_record is not null").collect()} == {2, 3}


def test_scan_reads_only_the_columns_a_report_needs(spark):
    import __spark_entry__ as registry

    plan = registry.queries()["total_transactions"](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().toString()
    scanned = plan.split("orders.parquet]")[1].split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderpriority" not in scanned and "o_orderstatus" in scanned
