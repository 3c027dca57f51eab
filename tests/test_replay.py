"""Rows rejected for an unknown account, taken up when the account arrives."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.sources import csv
from tallyloom.streaming import incremental, replay

ROWS, ACCOUNTS = csv.SOURCES["transactions"], csv.SOURCES["accounts"]


def land(folder, source, name, *lines):
    place = folder / source.file
    place.mkdir(exist_ok=True)
    (place / name).write_text("\n".join([",".join(source.schema.names), *lines]) + "\n")


def test_rows_wait_for_their_account(spark, tmp_path):
    """Late accounts, an account sent twice, one that never comes, rows without an account and a broken line."""
    settings, known = Settings(), spark.createDataFrame([(1,)], "account_id long")
    stored, replayed = str(tmp_path / "labelled"), str(tmp_path / "replayed")

    def label():
        labelled = incremental.label_stream(incremental.arriving(spark, str(tmp_path), ROWS), known, settings)
        incremental.append_available(labelled, stored, str(tmp_path / "progress"))

    def take_up():
        schema = spark.read.parquet(stored).schema
        taken = replay.taken_up(spark.readStream.schema(schema).parquet(stored), incremental.arriving(spark, str(tmp_path), ACCOUNTS))
        incremental.append_available(taken, replayed, str(tmp_path / "replay-progress"))
        rows = replay.with_replays(spark.read.parquet(stored), spark.read.schema(schema).parquet(replayed))
        found = {r.transaction_id: r._rejection_reason for r in rows.collect()}
        assert len(found) == rows.count() == spark.read.parquet(stored).count()
        return found

    land(tmp_path, ROWS, "a.csv", "1,1,2023-05-20,Rent,5,debit,x,done", "2,2,2023-05-20,Rent,5,debit,x,done", "3,3,2023-05-20,Rent,5,debit,x,done",
         "4,,2023-05-20,Rent,5,debit,x,done", "5,2,oops,Rent,5,debit,x,done", "6,2,2023-05-20,Rent,5,debit,x,done,surplus", "7,9,2023-05-20,Rent,5,debit,x,done")
    label()
    land(tmp_path, ACCOUNTS, "a.csv", "1,a,b,c,2020-01-01")
    assert take_up() == {1: None, 2: "ORPHANED_ACCOUNT_ID", 3: "ORPHANED_ACCOUNT_ID", 4: "ORPHANED_ACCOUNT_ID", 5: "NULL_DATE", 6: "ORPHANED_ACCOUNT_ID", 7: "ORPHANED_ACCOUNT_ID"}
    land(tmp_path, ACCOUNTS, "b.csv", "2,a,b,c,2020-01-01", "2,a,b,c,2020-01-01")
    second = {1: None, 2: None, 3: "ORPHANED_ACCOUNT_ID", 4: "ORPHANED_ACCOUNT_ID", 5: "NULL_DATE", 6: "MALFORMED_LINE", 7: "ORPHANED_ACCOUNT_ID"}
    assert take_up() == second
    assert take_up() == second
    land(tmp_path, ROWS, "b.csv", "8,2,2023-06-20,Rent,5,debit,x,done", "9,3,2023-06-20,Rent,5,debit,x,done")
    label()
    land(tmp_path, ACCOUNTS, "c.csv", "3,a,b,c,2020-01-01", "2,a,b,c,2020-01-01")
    assert take_up() == second | {3: None, 8: None, 9: None}
    left = spark.read.schema(spark.read.parquet(stored).schema).parquet(replayed)
    assert left.filter(F.col("transaction_date") == date(2023, 5, 20)).count() == 3 and left.filter("_orphaned_account").count() == 0
