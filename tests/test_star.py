"""Dimensions, fact, audits, reports and the run over stored tables."""

import dataclasses
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tallyloom import schemas
from tallyloom.config import Settings
from tallyloom.operators import contracts, facts, guards, history, rules
from tallyloom.operators.dimensions import account_dim, category_dim, date_dim
from tallyloom.plans import marts, medallion
from tallyloom.sources import csv, standin
from tallyloom.sources.standin import SETTINGS
from tallyloom.sources.tables import CLEANED, MODELLED, RAW, Layers, View
from twins import duck_rows, spark_rows

import oracles

FOLDER = f"{TESTDATA}/sf0.001"


def test_date_dimension(spark):
    days = date_dim(spark, Settings())
    assert days.count() == 1461
    assert days.columns == [
        "date_key", "full_date", "day_of_week", "day_of_month", "day_of_year", "week_of_year", "month_num",
        "month_name", "quarter", "year", "is_weekend", "is_month_end", "is_month_start",
    ]
    first = days.filter("date_key = '20230101'").first()
    assert tuple(first)[1:] == (date(2023, 1, 1), "Sunday", 1, 1, 52, 1, "January", 1, 2023, True, False, True)
    leap = days.filter("date_key = '20240229'").first()
    assert (leap.is_month_end, leap.day_of_year, leap.day_of_week) == (True, 60, "Thursday")
    assert days.agg(F.min("full_date"), F.max("full_date")).first()[:] == (date(2023, 1, 1), date(2026, 12, 31))


def test_category_dimension(spark):
    rows = category_dim(spark, Settings())
    assert rows.count() == rows.select("category_key").distinct().count() == 10
    groups = {row.category_group: row.n for row in rows.groupBy("category_group").agg(F.count("*").alias("n")).collect()}
    assert groups == {"Income": 3, "Essential": 4, "Discretionary": 3}


def test_account_dimension(spark):
    raw = spark.createDataFrame([(1, "  ann  LEE ", "savings ", "NORTH", "11-09-2020")], schemas.ACCOUNTS)
    assert tuple(account_dim(raw).first())[1:] == (1, "Ann  Lee", "Savings", "North", date(2020, 11, 9))


def test_null_guard(spark):
    raw = spark.createDataFrame([(1, "a", "b", "c", ""), (None, "a", "b", "c", "")], schemas.ACCOUNTS)
    counts = guards.null_counts(account_dim(raw), "account_id", "account_key")
    with pytest.raises(ValueError, match="null_account_id"):
        guards.require_zero(counts, "accounts without a key")
    guards.require_zero(guards.null_counts(account_dim(raw.limit(1)), "account_id"), "accounts without a key")


def small_star(spark):
    clean = spark.createDataFrame(
        [
            (1, 1, date(2023, 1, 5), "Rent", 10.5, "debit", "completed"),
            (2, 1, date(2023, 1, 6), "Travel", 4.5, "debit", "pending"),
            (3, 2, date(2024, 2, 1), "Salary", 100.0, "credit", "completed"),
            (4, 2, date(2025, 2, 1), "Rent", 7.0, "debit", "failed"),
        ],
        "transaction_id long, account_id long, transaction_date date, category string, amount double, "
        "transaction_type string, status string",
    ).withColumns({"_amount_corrected": F.lit(False), "_date_ambiguous": F.lit(False), "_ingested_at": F.current_timestamp()})
    raw = spark.createDataFrame([(1, "A", "Savings", "North", ""), (2, "B", "Savings", "South", "")], schemas.ACCOUNTS)
    return facts.fact(clean), account_dim(raw), date_dim(spark, Settings()), category_dim(spark, Settings())


def test_fk_audit_counts_each_dimension_and_null_keys(spark):
    fact, accounts, dates, categories = small_star(spark)
    audit = facts.fk_audit(fact, accounts, dates, categories)
    assert tuple(audit.first()) == (0, 0, 0)
    guards.require_zero(audit, "orphans")
    broken = facts.fk_audit(
        fact.withColumn("account_key", F.when(F.col("amount") != 4.5, F.col("account_key"))),
        accounts.filter("account_id = 1"),
        dates.filter("year <> 2025"),
        categories.filter("category_name <> 'Rent'"),
    )
    assert tuple(broken.first()) == (3, 1, 2)
    with pytest.raises(ValueError, match="orphaned_dates"):
        guards.require_zero(broken, "orphans")
    assert tuple(facts.fk_audit(fact.filter("false"), accounts, dates, categories).first()) == (0, 0, 0)


def test_reports_on_a_small_star(spark):
    fact, accounts, dates, categories = small_star(spark)
    trend = marts.monthly_spend_trend(fact, dates, categories, (2023, 2024)).collect()
    assert [tuple(row) for row in trend] == [
        (2023, 1, "January", "2023-01", "Discretionary", 4.5, 1),
        (2023, 1, "January", "2023-01", "Essential", 10.5, 1),
    ]
    by_category = marts.spend_by_category(fact, dates, categories).collect()
    assert [tuple(row) for row in by_category] == [
        ("Essential", "Rent", 2023, 10.5, 1, 10.5),
        ("Discretionary", "Travel", 2023, 4.5, 1, 4.5),
        ("Essential", "Rent", 2025, 7.0, 1, 7.0),
    ]
    regions = marts.spend_by_region(fact, accounts).collect()
    assert [tuple(row) for row in regions] == [("North", "Savings", 15.0, 2, 1), ("South", "Savings", 7.0, 1, 1)]
    flows = marts.income_vs_outflow(fact, dates).collect()
    assert [tuple(row)[2:] for row in flows] == [
        ("2023-01", 0.0, 15.0, -15.0),
        ("2024-02", 100.0, 0.0, 100.0),
        ("2025-02", 0.0, 7.0, -7.0),
    ]
    statuses = marts.status_breakdown(fact).collect()
    assert [tuple(row) for row in statuses] == [("completed", 2, 110.5), ("failed", 1, 7.0), ("pending", 1, 4.5)]
    assert marts.total_spend(fact).first().total_spend == 22.0
    assert marts.clean_data_pct(fact, fact.filter("amount > 5")).first().clean_data_pct == 75.0
    assert marts.clean_data_pct(fact.filter("false"), fact).first().clean_data_pct is None


def test_account_listed_twice_counts_twice_as_in_a_join(spark):
    fact, accounts, _, _ = small_star(spark)
    row = marts.spend_by_region(fact, accounts.union(accounts)).first()
    assert (row.total_spend, row.transaction_count, row.unique_accounts) == (30.0, 4, 1)


def test_budget_against_actual(spark):
    fact, _, dates, categories = small_star(spark)
    budget = spark.createDataFrame([(1, "RENT", 1, 2023, 12.0), (2, "Groceries", 1, 2023, 3.0)], schemas.BUDGET)
    rows = marts.budget_vs_actual(fact, dates, categories, budget).collect()
    assert [tuple(row) for row in rows] == [
        (2023, 1, "Groceries", 3.0, None, -3.0),
        (2023, 1, "Rent", 12.0, 10.5, -1.5),
        (2023, 1, "Travel", None, 4.5, 4.5),
        (2025, 2, "Rent", None, 7.0, 7.0),
    ]


def test_history_has_a_version_per_change(spark):
    rows = [
        (1, "Savings", date(2020, 1, 1)),
        (1, "Savings", date(2021, 1, 1)),
        (1, "Savings", date(2021, 1, 1)),
        (1, None, date(2022, 1, 1)),
        (1, "Savings", date(2023, 1, 1)),
        (2, None, date(2020, 1, 1)),
        (2, None, date(2021, 1, 1)),
    ]
    snapshots = spark.createDataFrame(rows, "account_id long, account_type string, snapshot_date date")
    versions = history.account_history(snapshots, ["account_type"]).orderBy("account_id", "version")
    assert [tuple(row)[2:] for row in versions.collect()] == [
        (1, "Savings", 1, date(2020, 1, 1), date(2021, 12, 31), False),
        (1, None, 2, date(2022, 1, 1), date(2022, 12, 31), False),
        (1, "Savings", 3, date(2023, 1, 1), None, True),
        (2, None, 1, date(2020, 1, 1), None, True),
    ]


def test_contracts(spark):
    rows = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    report = contracts.contract_report(rows, {"present": F.col("v").isNotNull(), "small": F.coalesce("v", F.lit(0)) < 9})
    assert [tuple(row) for row in report.collect()] == [("present", 3, 1, False), ("small", 3, 0, True)]


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    csv.write_csv(standin.transactions_file(spark, FOLDER), folder, csv.SOURCES["transactions"])
    csv.write_csv(standin.accounts_file(spark, FOLDER), folder, csv.SOURCES["accounts"])
    csv.write_csv(standin.budget_file(spark), folder, csv.SOURCES["budget"])
    return folder


@pytest.fixture(scope="module")
def stored(spark, landing):
    layers = Layers(spark)
    return layers, medallion.run(layers, landing, SETTINGS)


def test_run_reports_what_it_wrote(stored):
    layers, counts = stored
    assert counts == {
        "raw_transactions": 1560,
        "raw_accounts": 150,
        "raw_budget": 168,
        "bronze_rows": 1560,
        "clean_rows": 1258,
        "rejected_rows": 302,
        "dim_date": 2557,
        "dim_accounts": 150,
        "dim_category": 10,
        "fct_transactions": 1258,
    }
    stamps = layers.read(RAW, "transactions").agg(F.count_distinct("_ingested_at"), F.count_distinct("_source_file"))
    assert tuple(stamps.first()) == (1, 1)


def test_stored_tables_have_the_documented_columns(stored):
    layers, _ = stored
    silver = [
        "transaction_id", "account_id", "transaction_date", "category", "amount", "transaction_type", "description",
        "status", "_ingested_at", "_source_file", "_date_ambiguous", "_amount_corrected",
    ]
    assert layers.read(CLEANED, "transactions").columns == silver
    assert layers.read(CLEANED, "transactions_quarantine").columns == [
        *silver[:8], "_corrupt_record", *silver[8:], "_dedup_rank", "_orphaned_account", "_rejection_reason", "_quarantined_at",
    ]
    assert layers.read(MODELLED, "fct_transactions").columns == [
        "transaction_key", "account_key", "date_key", "category_key", "amount", "transaction_type", "status",
        "_amount_corrected", "_date_ambiguous", "_ingested_at",
    ]
    quarantined = layers.read(CLEANED, "transactions_quarantine")
    assert quarantined.filter("_quarantined_at is null or _rejection_reason is null").count() == 0


@pytest.mark.parametrize(
    "name",
    [
        "monthly_spend_trend", "spend_by_category", "spend_by_region", "income_vs_outflow", "status_breakdown",
        "total_transactions", "total_spend", "clean_data_pct", "quarantine_breakdown", "layer_reconciliation",
        "budget_vs_actual",
    ],
)
def test_reports_over_stored_tables_equal_their_twins(stored, duck, name):
    layers, _ = stored
    assert spark_rows(medallion.reports(layers, SETTINGS)[name]) == duck_rows(duck("sf0.001"), oracles.SQL[name])


def test_rerun_gives_the_same_rows(spark, stored, landing):
    layers, counts = stored
    tables = [(CLEANED, "transactions"), (CLEANED, "transactions_quarantine"), (MODELLED, "fct_transactions")]

    def content():
        drop = ("_ingested_at", "_quarantined_at")
        return [sorted(map(str, layers.read(*table).drop(*drop).collect())) for table in tables]

    before = content()
    assert medallion.run(layers, landing, SETTINGS) == counts
    assert content() == before


def test_sql_over_the_stored_names(spark, stored):
    row = spark.sql(
        """select count(*) as n, count(distinct a.region) as regions
        from gold.fct_transactions f join gold.dim_accounts a on f.account_key = a.account_key
        join gold.dim_date d on f.date_key = d.date_key join gold.dim_category c on f.category_key = c.category_key"""
    ).first()
    assert tuple(row) == (1258, 5)


def test_views_prune_to_their_partition(spark, stored):
    layers, _ = stored
    plan = layers.read(CLEANED, "transactions").select("amount")._jdf.queryExecution().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "isnotnull(_rejected" in filters and "_version" in filters
    assert "ReadSchema: struct<amount:double>" in plan


def star_content(layers):
    """All rows of all four tables, without the time of the run."""
    tables = ("dim_date", "dim_accounts", "dim_category", "fct_transactions")
    return {name: sorted(map(str, layers.read(MODELLED, name).drop("_ingested_at").collect())) for name in tables}


SHORT = dataclasses.replace(SETTINGS, spine_end=date(1999, 12, 31))
LONGER = dataclasses.replace(SETTINGS, spine_end=date(2002, 12, 31))


def test_orphan_facts_stop_the_load_and_leave_the_whole_old_star(spark, landing):
    layers = Layers(spark, prefix="audit_")
    medallion.run(layers, landing, SETTINGS)
    before = star_content(layers)
    with pytest.raises(ValueError, match="orphaned_dates"):
        medallion.build_modelled(layers, SHORT)
    assert star_content(layers) == before
    layers.drop(RAW, CLEANED, MODELLED)


def test_a_run_that_dies_leaves_the_whole_old_star_or_the_whole_new_one(spark, landing, monkeypatch):
    layers = Layers(spark, prefix="dying_")
    medallion.run(layers, landing, SETTINGS)
    before = star_content(layers)
    places = ("stage", "publish", "_define", "_commit", "_remove_old")
    for place in places:
        for calls in range(4 if place in ("stage", "_define") else 1):
            left, real = [calls], getattr(Layers, place)

            def dying(self, *args, left=left, real=real, **more):
                if not left[0]:
                    raise RuntimeError("killed")
                left[0] -= 1
                return real(self, *args, **more)

            with monkeypatch.context() as patch:
                patch.setattr(Layers, place, dying)
                with pytest.raises(RuntimeError, match="killed"):
                    medallion.build_modelled(layers, LONGER)
            if place == "_remove_old":  # the new star was published before
                assert len(star_content(layers)["dim_date"]) == 2922
            else:
                assert star_content(layers) == before
    medallion.build_modelled(layers, SETTINGS)
    assert star_content(layers) == before
    layers.drop(RAW, CLEANED, MODELLED)


def test_old_versions_go_but_the_last_two(spark, tmp_path):
    for layers in (Layers(spark, prefix="old_"), Layers(spark, location=str(tmp_path / "lake"), prefix="old_lake_")):
        layers.create("layer")
        for n in range(1, 5):
            version = layers.new_version()
            staged = layers.stage("layer", "numbers", spark.range(n), version)
            assert layers.spark.catalog.tableExists(layers.name("layer", "shown")) == (n > 1)
            layers.publish("layer", version, {"shown": View(staged)})
            assert layers.read("layer", "shown").count() == n
        stored = layers.read("layer", staged.table)
        assert stored.select("_version").distinct().count() == 2 and stored.count() == 3 + 4
        wide = layers.new_version()
        other = layers.stage("layer", "numbers", spark.range(2).selectExpr("id", "id as more"), wide)
        layers.publish("layer", wide, {"shown": View(other)})
        assert layers.read("layer", "shown").columns == ["id", "more"]
        layers.drop("layer")
    folders = [p.name for p in (tmp_path / "lake" / "layer" / staged.table).iterdir() if p.is_dir()]
    assert len(folders) == 2


def test_tables_can_live_in_a_folder(spark, tmp_path):
    layers = Layers(spark, location=str(tmp_path / "lake"))
    layers.create("folder_layer")
    assert layers.write("folder_layer", "numbers", spark.range(5)) == 5
    assert spark.read.parquet(str(tmp_path / "lake" / "folder_layer" / "numbers")).count() == 5


def test_header_that_differs_is_an_error(spark, tmp_path):
    source = csv.SOURCES["budget"]
    (tmp_path / source.file).write_text("category,budget_id,month,year,budget_amount\nRent,1,1,2023,5\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        csv.read_csv(spark, str(tmp_path), source).collect()


def test_run_into_a_folder_and_again(spark, landing, tmp_path):
    lake = tmp_path / "lake"
    layers = Layers(spark, location=str(lake), prefix="lake_")
    first = medallion.run(layers, landing, SETTINGS)
    assert medallion.run(layers, landing, SETTINGS) == first
    stored = [path for path in (lake / "silver").iterdir() if path.name.startswith(medallion.LABELLED)]
    versions = sorted(path for path in stored[0].iterdir() if path.is_dir())
    assert len(stored) == 1 and len(versions) == 2
    assert sorted(path.name for path in versions[-1].iterdir() if path.is_dir()) == ["_rejected=false", "_rejected=true"]
    assert layers.read(CLEANED, "transactions").count() == 1258
    assert layers.read(MODELLED, "fct_transactions").count() == 1258
    facts_stored = [path for path in (lake / "gold").iterdir() if path.name.startswith("fct_")]
    assert len(facts_stored) == 1 and spark.read.parquet(str(facts_stored[0])).count() == 2 * 1258


def test_year_filter_reaches_the_stored_fact(spark, landing, tmp_path):
    """The trend reads the fact with bounds on its own key, which sorted files can be skipped by."""
    layers = Layers(spark, location=str(tmp_path), prefix="trend_")
    medallion.run(layers, landing, SETTINGS)
    plan = medallion.reports(layers, SETTINGS)["monthly_spend_trend"]._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.split("PushedFilters: ") if "date_key" in line.split("]")[0])
    assert "GreaterThanOrEqual(date_key,19990101)" in pushed and "LessTha" in pushed
