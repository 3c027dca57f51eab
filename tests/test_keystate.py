"""Incremental settlement by key state and the keyed merge: results, retries, and what is read and touched."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.operators import rules
from tallyloom.sources.keyed import KeyedTable
from tallyloom.streaming import incremental, keystate

ROW = "transaction_id long, account_id long, transaction_date date, amount double, category string, _rejection_reason string, _ingested_at timestamp"


def lot(spark, number, *rows):
    frame = spark.createDataFrame([(*row, None) for row in rows], ROW)
    return frame.withColumn("_ingested_at", F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.lit(number)))


def row(number, account=1, day=date(2023, 5, 20), amount=5.0, category="Rent", reason=None):
    return number, account, day, amount, category, reason


def reasons(state):
    return {r.transaction_id: r._rejection_reason for r in state.rows().collect()}


@pytest.fixture
def state(spark, tmp_path):
    return keystate.KeyState.of(spark, str(tmp_path / "settled"), Settings())


def test_late_and_invalid_repeats(spark, state):
    keystate.settle_lot(lot(spark, 0, row(5), row(6), row(7, account=2, reason="INVALID_STATUS")), state, 0)
    keystate.settle_lot(lot(spark, 1, row(1), row(8, account=2), row(9, day=None, reason="NULL_DATE")), state, 1)
    keystate.settle_lot(lot(spark, 2, row(2, account=2), row(3, amount=5.01), row(4, day=None, reason="NULL_DATE")), state, 2)
    assert reasons(state) == {5: None, 6: "DUPLICATE", 7: "INVALID_STATUS", 1: "DUPLICATE", 8: None, 9: "NULL_DATE", 2: "DUPLICATE", 3: None, 4: "NULL_DATE"}


def test_a_lot_that_comes_again_replaces_itself(spark, state):
    keystate.settle_lot(lot(spark, 0, row(1)), state, 0)
    for _ in range(2):
        keystate.settle_lot(lot(spark, 1, row(2), row(3, amount=9.0)), state, 1)
    assert reasons(state) == {1: None, 2: "DUPLICATE", 3: None}
    keystate.settle_lot(lot(spark, 2), state, 2)
    keystate.settle_lot(lot(spark, 3, row(4, amount=9.0)), state, 3)
    assert reasons(state)[4] == "DUPLICATE"


def test_equals_the_ranking_of_the_whole_store(spark, state):
    days = [date(2023, 1, 1) + timedelta(days=17 * n) for n in range(12)]
    lots = [[row(1000 * number + n, n % 5, days[(n * 7 + number) % 12], float(n % 3), None if n % 11 == 0 else "Rent", "X" if n % 13 == number else None)
             for n in range(150)] for number in range(4)]
    frames = [lot(spark, number, *rows) for number, rows in enumerate(lots)]
    for number, frame in enumerate(frames):
        keystate.settle_lot(frame.repartition(3), state, number)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    settled = incremental.settle(whole, Settings())
    assert reasons(state) == {r.transaction_id: r._rejection_reason for r in settled.collect()}


def test_what_a_lot_reads_does_not_follow_the_store(spark, state):
    """Each lot brings a new month and one late row of the first; only that month's bucket is opened."""
    for number in range(8):
        day = date(2023 + number // 12, number % 12 + 1, 3)
        rows = [row(1000 * number + n, n, day, float(n)) for n in range(200)] + [row(900_000 + number, 7, date(2023, 1, 3), 7.0)]
        keystate.settle_lot(lot(spark, number, *rows), state, number)
    runs = {r.lot: r for r in state.runs().collect()}
    assert sorted(runs) == list(range(8)) and all(r.rows == 201 for r in runs.values())
    assert sum(r.accepted for r in runs.values()) == 8 * 200
    late = {r.keys_read for lot_number, r in runs.items() if lot_number}
    assert len(late) == 1 and 1 <= late.pop() < 60
    plan = state.accepted(spark, lot(spark, 0, row(1)).schema, 8, ["2023-01-3"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_lot" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_keys_without_a_day_and_with_nulls(spark, tmp_path):
    state = keystate.KeyState(spark, str(tmp_path), ("account_id", "category"))
    keystate.settle_lot(lot(spark, 0, row(1, category=None), row(2, account=None)), state, 0)
    keystate.settle_lot(lot(spark, 1, row(3, category=None), row(4, account=None, day=None), row(5, account=9)), state, 1)
    assert reasons(state) == {1: None, 2: None, 3: "DUPLICATE", 4: "DUPLICATE", 5: None}


def test_clean_and_quarantine_split_the_settled_rows(spark, state):
    keystate.settle_lot(lot(spark, 0, row(1), row(2), row(3, reason="X")), state, 0)
    assert rules.clean(state.rows()).count() == 1 and rules.quarantine(state.rows()).count() == 2


STATE = "id long, part string, value string, version long"


def keyed(spark, tmp_path, buckets=8):
    schema = spark.createDataFrame([], STATE).schema
    return KeyedTable(spark, str(tmp_path / "keyed"), schema, ("id", "part"), "version", buckets)


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def files(tmp_path):
    return {p.parent.name: p.name for p in (tmp_path / "keyed").rglob("*.parquet")}


def test_merge_inserts_updates_and_ignores_stale_rows(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert content(table) == []
    first = table.merge(spark.createDataFrame([(n, "a", "old", 1) for n in range(40)], STATE))
    assert (first["inserted"], first["updated"], first["stale"], first["buckets_written"]) == (40, 0, 0, 8)
    changes = [(1, "a", "new", 2), (1, "a", "newer", 3), (1, "a", "new", 2), (2, "a", "stale", 1), (3, "a", "stale", 0), (99, "a", "x", 1), (99, "a", "y", 1),
               (1, "b", "other", 1), (None, "a", "no key", 9), (5, "a", "no version", None)]
    counts = table.merge(spark.createDataFrame(changes, STATE).repartition(4))
    assert (counts["inserted"], counts["updated"], counts["stale"], counts["unnamed"]) == (2, 1, 2, 2)
    wanted = {(n, "a"): ("old", 1) for n in range(40)} | {(1, "a"): ("newer", 3), (99, "a"): ("y", 1), (1, "b"): ("other", 1)}
    assert content(table) == sorted((*key, *state) for key, state in wanted.items())
    assert table.merge(spark.createDataFrame(changes, STATE))["buckets_written"] == 0


def test_files_of_buckets_without_a_change_keep_their_names(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.merge(spark.createDataFrame([(n, "a", "old", 1) for n in range(200)], STATE))
    before = files(tmp_path)
    counts = table.merge(spark.createDataFrame([(17, "a", "new", 2)], STATE))
    after = files(tmp_path)
    assert len(before) == 8 and before.keys() == after.keys()
    assert (counts["buckets_read"], counts["buckets_written"]) == (1, 1)
    assert sum(before[bucket] != after[bucket] for bucket in before) == 1
    assert len(content(table)) == 200 and (17, "a", "new", 2) in content(table)


def test_a_merge_that_failed_can_run_again(spark, tmp_path):
    table = keyed(spark, tmp_path)
    changes = spark.createDataFrame([(n, "a", "old", 1) for n in range(30)], STATE)
    table.merge(changes.filter("id < 10"))
    table.merge(changes)
    assert table.merge(changes)["stale"] == 30 and len(content(table)) == 30
    assert table.merge(changes.limit(0))["buckets_read"] == 0
