"""As-of join, band join, rolling sums and the cube: plain loops, odd rows, a busy account, plans."""

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as registry
from conftest import TESTDATA
from tallyloom.operators import asof, bands, rolling
from tallyloom.plans import marts
from tallyloom.sources import standin

FOLDER = f"{TESTDATA}/sf0.001"


def plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def some_day(rng, span=400):
    return date(2023, 1, 1) + timedelta(days=rng.randrange(span))


def test_as_of_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(n, 1 if n % 3 == 0 else rng.choice([None, *range(2, 9)]), rng.choice([None, *[some_day(rng)] * 12])) for n in range(600)]
    versions = []
    for key in (1, 2, 3, 4, 5, 6, None):
        starts = sorted({some_day(rng) for _ in range(rng.randint(1, 6))})
        for start, after in zip(starts, [*starts[1:], None]):
            end = (after - timedelta(days=rng.choice([1, 1, 20]))) if after else rng.choice([None, start + timedelta(days=30)])
            versions.append((key, start, end if end is None or end >= start else start, f"v{start}"))
    versions += [(2, None, None, "no start"), (7, date(2023, 6, 1), None, "a"), (7, date(2023, 6, 1), None, "b")]
    frame = spark.createDataFrame(rows, "id int, key int, day date").withColumn("_key", F.lit("clash"))
    known = spark.createDataFrame(versions, "key int, valid_from date, valid_to date, name string")

    def slow(key, day):
        fits = [v for v in versions if key is not None and day is not None and v[0] == key and v[1] is not None and v[1] <= day]
        last = max(fits, key=lambda v: (v[1], v[2] is not None, v[2] or date.min, v[3]), default=None)
        return last[3] if last and (last[2] is None or last[2] >= day) else None

    got = asof.as_of(frame.drop("_key"), known, "key", "day", ["name"])
    assert sorted(tuple(r) for r in got.select("id", "name").collect()) == [(n, slow(key, day)) for n, key, day in rows]
    assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)
    assert asof.as_of(frame.drop("_key").limit(0), known, "key", "day", ["name"]).count() == 0
    assert asof.as_of(frame.drop("_key"), known.limit(0), "key", "day", ["name"]).filter("name is not null").count() == 0


def test_a_busy_account_is_many_small_groups_in_the_as_of_join(spark):
    """Rows of an account are asked for once a day and looked up month by month."""
    rows = spark.range(20_000).select(F.lit(1).alias("key"), F.date_add(F.lit(date(2023, 1, 1)), (F.col("id") % 300).cast("int")).alias("day"), "id")
    known = spark.createDataFrame([(1, date(2023, 2, 10), None, "x")], "key int, valid_from date, valid_to date, name string")
    got = asof.as_of(rows, known, "key", "day", ["name"])
    assert got.count() == 20_000 and got.filter("name = 'x'").count() == rows.filter("day >= '2023-02-10'").count()
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_key#" in text and "_month#" in text


def test_near_pairs_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(n, rng.choice([1, 1, 2, None]), rng.choice([None, *range(-5, 60)]), Decimal(rng.randrange(-300, 300)) / 100) for n in range(500)]
    frame = spark.createDataFrame(rows, "id int, key int, day int, amount decimal(28,6)").repartition(4)
    for width_day, width in ((1, Decimal("0.01")), (3, Decimal("0.25"))):
        got = bands.near_pairs(frame, ["key"], {"day": width_day, "amount": width}, "id")
        wanted = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] is not None and a[1] == b[1]
                        and None not in (a[2], b[2]) and abs(a[2] - b[2]) <= width_day and abs(a[3] - b[3]) <= width)
        assert wanted and sorted((r.left.id, r.right.id) for r in got.collect()) == wanted
        assert "Cartesian" not in plan(got) and "NestedLoop" not in plan(got)
    assert bands.near_pairs(frame.limit(0), ["key"], {"day": 1}, "id").collect() == []


def test_near_repeats_of_a_busy_account_meet_in_small_groups(spark):
    """A key's rows are dealt out by cell, so the join never sees the account as one group."""
    labelled = standin.busy(registry._labelled(spark, FOLDER))
    pairs = registry.repeats.near_repeats(labelled, standin.SETTINGS)
    text = plan(pairs)
    assert "_cell_0" in text and "_cell_1" in text and pairs.count() > 0


def test_rolling_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(n, 1 if n % 3 == 0 else rng.choice([None, 2, 3]), rng.choice([None, *[some_day(rng, 200)] * 9]), rng.choice([None, Decimal(rng.randrange(-999, 999)) / 100])) for n in range(400)]
    frame = spark.createDataFrame(rows, "id int, key int, day date, amount decimal(28,6)").repartition(5)
    for days in (1, 7, 30):
        got = rolling.rolling(frame, "key", "day", "id", {"near": F.col("amount")}, {"so_far": F.col("amount")}, days)
        assert got.columns == ["id", "key", "day", "amount", "near", "so_far"]
        found = {r.id: (r.near, r.so_far) for r in got.collect()}
        for n, key, day, _ in rows:
            if day is None:
                assert found[n] == (None, None)
                continue
            own = [r for r in rows if r[1] == key and r[2] is not None]
            near = sum(r[3] or 0 for r in own if day - timedelta(days=days) < r[2] <= day)
            assert found[n] == (near, sum(r[3] or 0 for r in own if (r[2], r[0]) <= (day, n)))
    assert rolling.rolling(frame.limit(0), "key", "day", "id", {"a": F.col("amount")}, {"b": F.col("amount")}, 30).collect() == []


def test_rolling_windows_of_a_busy_account_hold_a_piece_of_it(spark):
    clean = standin.busy(registry._clean(spark, FOLDER))
    busiest = clean.filter(F.col("account_id") == standin.BUSY_ACCOUNT)
    pieces = busiest.groupBy(F.floor(F.datediff("transaction_date", F.lit("1970-01-01")) / 30)).count().agg(F.max("count"), F.sum("count")).first()
    assert pieces[1] > 0.3 * clean.count() and pieces[0] < pieces[1] / 20
    text = marts.rolling_spend(clean)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_key#" in text and "_piece#" in text


def test_the_cube_gives_the_single_reports_from_one_read(spark, tmp_path):
    frames = registry._star(spark, FOLDER)
    frames.facts.write.parquet(str(tmp_path / "facts"))
    fact = spark.read.parquet(str(tmp_path / "facts"))
    cube = marts.spend_cube(fact, frames.dates, frames.accounts, frames.categories)
    text = cube._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Expand") == 1 and text.count("transaction_type#") and cube._jdf.queryExecution().executedPlan().toString().count("Location: InMemoryFileIndex") <= 4

    def rows(frame, *columns):
        return sorted(tuple(r) for r in frame.select(*columns).collect())

    def of(report):
        return cube.filter(F.col("report") == report)

    spent = of("monthly_spend_trend").filter("debit_count > 0 and year in (1999, 2000)")
    assert rows(spent, "year", "month_num", "category_group", "total_spend", "debit_count") == rows(
        marts.monthly_spend_trend(fact, frames.dates, frames.categories, (1999, 2000)), "year", "month_num", "category_group", "total_spend", "transaction_count")
    assert rows(of("spend_by_category").filter("debit_count > 0"), "year", "category_name", "total_spend", "debit_count") == rows(
        marts.spend_by_category(fact, frames.dates, frames.categories), "year", "category_name", "total_spend", "transaction_count")
    assert rows(of("spend_by_region").filter("debit_count > 0"), "region", "account_type", "total_spend", "debit_count") == rows(
        marts.spend_by_region(fact, frames.accounts), "region", "account_type", "total_spend", "transaction_count")
    flows = of("income_vs_outflow")
    assert rows(flows, "year", "month_num", "total_income", "total_spend") == rows(
        marts.income_vs_outflow(fact, frames.dates), "year", "month_num", "total_income", "total_outflow")
    assert rows(of("status_breakdown"), "status", "transaction_count", "total_amount") == rows(
        marts.status_breakdown(fact), "status", "transaction_count", "total_amount")
    assert cube.filter("report is null").count() == 0
