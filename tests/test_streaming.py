"""Incremental ingest and cleaning of arriving files."""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.operators import rules
from tallyloom.sources import csv
from tallyloom.plans import silver
from tallyloom.streaming import incremental

SOURCE = csv.SOURCES["transactions"]
HEADER = ",".join(SOURCE.schema.names)


def arrive(landing, name, *lines):
    folder = landing / SOURCE.file
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def test_each_file_is_read_once(spark, tmp_path):
    target, progress = str(tmp_path / "bronze"), str(tmp_path / "progress")

    def ingest():
        incremental.append_available(incremental.arriving(spark, str(tmp_path), SOURCE), target, progress)
        rows = spark.read.parquet(target)
        return sorted(row.transaction_id for row in rows.collect()), rows

    arrive(tmp_path, "a.csv", "1,1,2023-05-20,Rent,5,debit,x,done", "2,1,oops,Rent,abc,debit,x,done")
    assert ingest()[0] == [1, 2]
    assert ingest()[0] == [1, 2]
    arrive(tmp_path, "b.csv", "3,1,2023-05-20,Rent,5,debit,x,done")
    ids, rows = ingest()
    assert ids == [1, 2, 3]
    assert rows.filter("_ingested_at is null or _source_file <> 'transactions_raw.csv'").count() == 0
    assert rows.filter("_corrupt_record is not null").count() == 1


def test_stream_is_cleaned_and_keeps_each_key_once(spark, tmp_path):
    settings = replace(Settings(), first_valid_date=date(2023, 1, 1))
    accounts = spark.createDataFrame([(1,), (2,)], "account_id long")
    target, progress = str(tmp_path / "clean"), str(tmp_path / "progress")

    def run():
        rows = incremental.arriving(spark, str(tmp_path), SOURCE)
        labelled = incremental.label_stream(rows, accounts, settings)
        incremental.append_available(incremental.accepted_once(labelled, settings, "7 days"), target, progress)
        return sorted(row.transaction_id for row in spark.read.parquet(target).collect())

    arrive(
        tmp_path,
        "a.csv",
        "1,1,2023-05-20,RENT,-5,debit,x,done",
        "2,2,05/20/2023,Rent,5,debit,x,done",
        "3,9,2023-05-20,Rent,5,debit,x,done",
        "4,1,2023-05-20,Rent,6,debit,x,yes",
    )
    assert run() == [1, 2]
    # A key that was accepted in an earlier batch does not come back.
    arrive(tmp_path, "b.csv", "5,1,20-05-2023, rent ,5,debit,x,done", "6,1,2023-05-20,Rent,5.01,debit,x,done")
    assert run() == [1, 2, 6]


def test_stream_labels_equal_batch_rules(spark, tmp_path):
    accounts = spark.createDataFrame([(1,)], "account_id long")
    arrive(
        tmp_path,
        "a.csv",
        "1,1,2023-05-20,Rent,5,debit,x,done",
        "2,1,2022-05-20,Rent,5,debit,x,done",
        "3,1,2023-05-20,,5,debit,x,done",
        "4,1,2023-05-20,Rent,5,,x,done",
        "5,8,2023-05-20,Rent,5,debit,x,done",
    )
    labelled = incremental.label_stream(incremental.arriving(spark, str(tmp_path), SOURCE), accounts, Settings())
    incremental.append_available(labelled, str(tmp_path / "out"), str(tmp_path / "progress"))
    found = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", F.col(rules.REASON).alias("r"))
    assert {row.transaction_id: row.r for row in found.collect()} == {
        1: None,
        2: "OUT_OF_RANGE_DATE",
        3: "NULL_CATEGORY",
        4: "NULL_TRANSACTION_TYPE",
        5: "ORPHANED_ACCOUNT_ID",
    }


def test_settled_rows_are_all_that_landed(spark, tmp_path):
    """Accepted and rejected rows together are the landed ones; the batch differs where an invalid row comes first."""
    settings = replace(Settings(), first_valid_date=date(2023, 1, 1))
    accounts = spark.createDataFrame([(1,), (2,)], "account_id long")
    store, progress = str(tmp_path / "labelled"), str(tmp_path / "progress")

    def run():
        rows = incremental.arriving(spark, str(tmp_path), SOURCE)
        incremental.append_available(incremental.label_stream(rows, accounts, settings), store, progress)
        settled = incremental.settle(spark.read.parquet(store), settings)
        return {row.transaction_id: row._rejection_reason for row in settled.collect()}

    arrive(tmp_path, "a.csv", "5,1,2023-05-20,Rent,5,debit,x,done", "6,1,2023-05-20,Rent,5,debit,x,done", "7,2,2023-05-20,Rent,5,debit,x,bad")
    assert run() == {5: None, 6: "DUPLICATE", 7: "INVALID_STATUS"}
    arrive(tmp_path, "b.csv", "1,1,2023-05-20,Rent,5,debit,x,done", "8,2,2023-05-20,Rent,5,debit,x,done", "X,2,2023-05-20,Rent,6,debit,x,done")
    assert run() == {5: None, 6: "DUPLICATE", 7: "INVALID_STATUS", 1: "DUPLICATE", 8: None, None: "MALFORMED_LINE"}

    raw = spark.read.parquet(store).drop("_rejection_reason", "_orphaned_account")
    batch = {row.transaction_id: row._rejection_reason for row in silver.label(raw, accounts, settings).collect()}
    # The batch lets the latest load survive and ranks row 8 behind the invalid row 7 only within one load.
    assert {n for n in batch if batch[n] != run()[n]} == {1, 5}
