"""Months opened by a query, contracts across runs, merged sketches."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import TESTDATA
from tallyloom.operators import drift, sketches
from tallyloom.plans import slices

FOLDER = f"{TESTDATA}/sf0.001"


def test_only_the_months_asked_for_are_opened(spark, tmp_path):
    frames = registry._star(spark, FOLDER)
    slices.write_by_month(frames.facts, str(tmp_path / "facts"))
    by_month = slices.read_by_month(spark, str(tmp_path / "facts"), frames.facts.schema)
    got = slices.spend_by_day(by_month, frames.dates, (F.col("year") == 1998) & (F.col("quarter") == 2))
    rows = got.collect()
    assert rows and all("19980401" <= r.date_key <= "19980630" for r in rows)
    plan = got._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()

    def scans(node):
        own = [node] if node.nodeName().startswith("Scan parquet") and "month_key" in node.toString() else []
        children = node.children()
        below = [scan for k in range(children.size()) for scan in scans(children.apply(k))]
        inner = node.plan() if node.nodeName().endswith("QueryStage") else node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else None
        return own + below + (scans(inner) if inner is not None else [])

    opened = [int(scan.metrics().apply("numPartitions").value()) for scan in scans(plan)]
    assert opened == [3]
    with_folders = [p.name for p in (tmp_path / "facts").iterdir() if p.is_dir()]
    assert len(with_folders) > 60 and all(re.fullmatch(r"month_key=\d{6}", name) for name in with_folders)
    one = slices.spend_by_day(by_month, frames.dates, F.col("is_month_end") & (F.col("year") == 2050))
    assert one.collect() == []


def test_shift_repeat_and_orphan_are_named(spark):
    before = spark.createDataFrame([(n, "a" if n % 2 else "b") for n in range(200)], "id int, kind string")
    same = spark.createDataFrame([(n, "a" if n % 2 else "b") for n in range(1000, 1300)], "id int, kind string")
    moved = spark.createDataFrame([(n, "a" if n % 10 else None) for n in range(200)], "id int, kind string")
    bins = {"kind": F.col("kind"), "digit": F.col("id") % 10}
    stored = drift.histogram(before, bins)
    assert {r.subject: r.passed for r in drift.shifts(drift.histogram(same, bins), stored).collect()} == {"kind": True, "digit": True}
    found = {r.subject: r for r in drift.shifts(drift.histogram(moved, bins), stored).collect()}
    assert not found["kind"].passed and found["kind"].value > 0.5 and found["digit"].passed
    assert drift.repeats(before, ["id"], "id").first()[2:] == (0.0, True)
    assert drift.repeats(before.union(before.limit(3)), ["id"], "id").first()[2:] == (3.0, False)
    assert drift.repeats(before.limit(0), ["id"], "id").first()[2:] == (0.0, True)
    parents = before.filter("id >= 20")
    assert drift.unmatched(before, "id", parents, "id").first()[2:] == (0.1, False)
    assert drift.unmatched(before, "id", parents, "id", most_share=0.2).first().passed
    assert drift.unmatched(before.limit(0), "id", parents, "id").first()[2:] == (0.0, True)


@pytest.mark.parametrize("values", [1, 300, 40_000])
def test_merged_sketches_stay_within_the_bound(spark, values):
    rows = spark.range(3 * values).select((F.col("id") % values).alias("v"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("day"))
    daily = sketches.by_day(rows.union(rows.limit(5).withColumn("v", F.lit(None).cast("long"))), "v", "day")
    for row in sketches.distinct_in(daily, F.trunc("day", "year"), "period").collect():
        assert abs(row["distinct"] - values) <= max(1, values * sketches.BOUND)
