
from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from tallyloom.functions.codes import canonicalise  # noqa: E402
from tallyloom.functions.dates import parse_mixed_date  # noqa: E402
from tallyloom.functions.keys import category_key, surrogate_key  # noqa: E402
from tallyloom.functions.money import correct_amount  # noqa: E402
from tallyloom.functions.text import standardise  # noqa: E402
from tallyloom.operators import contracts, drift, facts, guards, history, repeats, rules, sketches  # noqa: E402
from tallyloom.operators.dimensions import account_dim  # noqa: E402
from tallyloom.plans import marts, medallion, silver, slices, star  # noqa: E402
from tallyloom.session import importable, shared_folder, tune  # noqa: E402
from tallyloom.sources import csv, standin  # noqa: E402
from tallyloom.sources.keyed import KeyedTable  # noqa: E402
from tallyloom.sources.tables import CLEANED, MODELLED, RAW, Layers  # noqa: E402
from tallyloom.sources.standin import SETTINGS, raw_accounts, raw_budget, raw_transactions  # noqa: E402
from tallyloom.streaming import incremental, keystate, replay  # noqa: E402

try:  # the training-data operators are a separate part that may be absent
    import corpus_pipeline  # noqa: E402
    from tallyloom.llm import queries as training_data  # noqa: E402
except ImportError as missing:  # or a library it needs is
    warnings.warn(f"without the training-data queries: {missing}")
    corpus_pipeline = training_data = None

STAMPS = ("_ingested_at", "_quarantined_at")
Query = Callable[[SparkSession, str], DataFrame]


def _labelled(spark: SparkSession, folder: str, accounts: DataFrame | None = None) -> DataFrame:
    if accounts is None:
        accounts = raw_accounts(spark, folder)
    return silver.label(raw_transactions(spark, folder), accounts, SETTINGS)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean(_labelled(spark, folder))


def _star(spark: SparkSession, folder: str) -> star.Star:
    accounts = raw_accounts(spark, folder)
    return star.star(spark, rules.clean(_labelled(spark, folder, accounts)), accounts, SETTINGS)


def _scratch(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _through_csv(spark: SparkSession, rows: DataFrame, table: str) -> DataFrame:
    """Write rows as landed CSV files, ingest them, store the raw table, read it back."""
    folder, source = _scratch(spark, "landing"), csv.SOURCES[table]
    csv.write_csv(rows, folder, source)
    csv.read_csv(spark, folder, source).write.mode("overwrite").parquet(f"{folder}/bronze/{table}")
    return spark.read.parquet(f"{folder}/bronze/{table}").select(*source.schema.names, "_source_file")


def bronze_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _through_csv(spark, standin.transactions_file(spark, folder), "transactions")


def bronze_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _through_csv(spark, standin.accounts_file(spark, folder), "accounts")


def _arrivals(spark: SparkSession, folder: str, landing: str, lots: Sequence[Column]) -> Iterator[None]:
    """Land the transactions in lots, each picked by a condition."""
    rows = standin.transactions_file(spark, folder)
    for lot in lots:
        csv.write_csv(rows.filter(lot), landing, csv.SOURCES["transactions"], mode="append")
        yield


def _sent_again() -> Column:
    return F.col("transaction_id") >= standin.RESENT


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Each run of the stream takes only the files that are new."""
    scratch, source = _scratch(spark, "arrivals"), csv.SOURCES["transactions"]
    for _ in _arrivals(spark, folder, scratch, [~_sent_again(), _sent_again()]):
        arriving = incremental.arriving(spark, scratch, source)
        incremental.append_available(arriving, f"{scratch}/bronze", f"{scratch}/progress")
    return spark.read.parquet(f"{scratch}/bronze").select(*source.schema.names, "_source_file")


def _settled(spark: SparkSession, folder: str, lots: Sequence[Column]) -> DataFrame:
    """All that arrived in lots, each row labelled by the stream and repeats settled by key state."""
    scratch, source = _scratch(spark, "arrivals"), csv.SOURCES["transactions"]
    accounts = raw_accounts(spark, folder)
    state = keystate.KeyState.of(spark, f"{scratch}/settled", SETTINGS)
    for _ in _arrivals(spark, folder, scratch, lots):
        labelled = incremental.label_stream(incremental.arriving(spark, scratch, source), accounts, SETTINGS)
        keystate.settle_available(labelled, state, f"{scratch}/progress")
    return state.rows()


def incremental_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that incremental cleaning accepts, each business key once, also if its copy arrives in a later run."""
    return rules.clean(_settled(spark, folder, [~_sent_again(), _sent_again()])).drop(*STAMPS, "_source_file")


def incremental_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that incremental cleaning rejects, repeats among them, with the reason."""
    rejected = rules.quarantine(_settled(spark, folder, [~_sent_again(), _sent_again()]))
    return rejected.select("transaction_id", *SETTINGS.business_key, rules.REASON)


def incremental_settled(spark: SparkSession, folder: str) -> DataFrame:
    """Three lots: even orders, what was sent again, odd orders, some of them later than their copies."""
    odd = F.col("transaction_id") % 2 == 1
    settled = _settled(spark, folder, [~_sent_again() & ~odd, _sent_again(), ~_sent_again() & odd])
    return settled.select("transaction_id", *SETTINGS.business_key, rules.REASON)


def quarantine_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions whose account comes after them: rejected first, taken up with the account, then settled as one batch would."""
    scratch, late = _scratch(spark, "replay"), F.col("account_id") % 4 == 1
    accounts, source = standin.accounts_file(spark, folder), csv.SOURCES["accounts"]
    csv.write_csv(standin.transactions_file(spark, folder), scratch, csv.SOURCES["transactions"])
    rows = incremental.arriving(spark, scratch, csv.SOURCES["transactions"])
    labelled = incremental.label_stream(rows, accounts.filter(~late), SETTINGS)
    incremental.append_available(labelled, f"{scratch}/labelled", f"{scratch}/progress")
    stored = spark.read.parquet(f"{scratch}/labelled")
    for lot in (accounts.filter(~late), accounts.filter(late)):
        csv.write_csv(lot, scratch, source, mode="append")
        waiting = spark.readStream.schema(stored.schema).parquet(f"{scratch}/labelled")
        taken = replay.taken_up(waiting, incremental.arriving(spark, scratch, source))
        incremental.append_available(taken, f"{scratch}/replayed", f"{scratch}/replay-progress")
    replayed = spark.read.schema(stored.schema).parquet(f"{scratch}/replayed")
    settled = incremental.settle(replay.with_replays(stored, replayed), SETTINGS)
    return settled.select("transaction_id", *SETTINGS.business_key, rules.REASON)


def merge_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts after three feeds of changes, merged by key; the feeds repeat keys and bring stale states."""
    table = KeyedTable(spark, _scratch(spark, "accounts"), standin.account_feed(spark, folder, 0).schema, ("account_id",), "version", buckets=64)
    for number in range(3):
        table.merge(standin.account_feed(spark, folder, number))
    return table.read()


def stored_run(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of a whole scheduled run: CSV files, three layers of stored tables, audit, published fact."""
    scratch, mark = _scratch(spark, "run"), uuid.uuid4().hex[:8]
    for table, rows in (
        ("transactions", standin.transactions_file(spark, folder)),
        ("accounts", standin.accounts_file(spark, folder)),
        ("budget", standin.budget_file(spark)),
    ):
        csv.write_csv(rows, f"{scratch}/landing", csv.SOURCES[table])
    layers = Layers(spark, location=f"{scratch}/tables", prefix=f"run_{mark}_")
    medallion.run(layers, f"{scratch}/landing", SETTINGS)
    facts_of_run = layers.read(MODELLED, "fct_transactions").drop(*STAMPS)
    facts_of_run.write.parquet(f"{scratch}/result")
    layers.drop(RAW, CLEANED, MODELLED)
    return spark.read.schema(facts_of_run.schema).parquet(f"{scratch}/result")


def text_standardise(spark: SparkSession, folder: str) -> DataFrame:
    return standardise(raw_transactions(spark, folder)).select(
        "transaction_id", "category", "description", "transaction_type", "status"
    )


def mixed_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw_date = F.col("transaction_date")
    parsed = raw_transactions(spark, folder).select(
        "transaction_id", raw_date.alias("raw_date"), parse_mixed_date(raw_date).alias("parsed")
    )
    return parsed.select(
        "transaction_id",
        "raw_date",
        F.col("parsed.date").alias("parsed_date"),
        F.col("parsed.ambiguous").alias("date_ambiguous"),
    )


def status_canonicalise(spark: SparkSession, folder: str) -> DataFrame:
    raw_status = F.trim("status")
    return (
        raw_transactions(spark, folder)
        .select(
            raw_status.alias("raw_status"), canonicalise(raw_status, SETTINGS.status_spellings).alias("status")
        )
        .groupBy("raw_status", "status")
        .agg(F.count(F.lit(1)).alias("transactions"))
    )


def amount_correct(spark: SparkSession, folder: str) -> DataFrame:
    return correct_amount(raw_transactions(spark, folder)).select("transaction_id", "amount", "_amount_corrected")


def dedup_rank(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("transaction_id", *SETTINGS.business_key, "_dedup_rank")


def orphan_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("transaction_id", "account_id", "_orphaned_account")


def rejection_reason(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("transaction_id", "_rejection_reason")


def silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).drop(*STAMPS)


def silver_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quarantine(_labelled(spark, folder)).drop(*STAMPS)


def quarantine_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return rules.profile(rules.quarantine(_labelled(spark, folder)))


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rules.dq_summary(_labelled(spark, folder))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return star.usage(frames.dates, "date_key", frames.facts)


def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return star.usage(frames.categories, "category_key", frames.facts)


def dim_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return account_dim(raw_accounts(spark, folder))


def null_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    return guards.null_counts(dim_accounts(spark, folder), "account_id", "account_key")


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(spark, folder).select(
        "transaction_id",
        surrogate_key(F.col("transaction_id")).alias("transaction_key"),
        surrogate_key(F.col("account_id")).alias("account_key"),
        category_key(F.col("category")).alias("category_key"),
    )


def fct_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder).facts.drop(*STAMPS)


def fk_audit(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return facts.fk_audit(frames.facts, frames.accounts, frames.dates, frames.categories)


def fk_audit_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The audit over accepted and rejected rows alike, where it must find orphans."""
    frames = _star(spark, folder)
    rows = facts.fact(silver.clean_columns(raw_transactions(spark, folder), SETTINGS))
    return facts.fk_audit(rows, frames.accounts, frames.dates, frames.categories)


def monthly_spend_trend(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.monthly_spend_trend(frames.facts, frames.dates, frames.categories, SETTINGS.trend_years)


def spend_by_category(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.spend_by_category(frames.facts, frames.dates, frames.categories)


def spend_by_region(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.spend_by_region(frames.facts, frames.accounts)


def income_vs_outflow(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.income_vs_outflow(frames.facts, frames.dates)


def status_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return marts.status_breakdown(_star(spark, folder).facts)


def total_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return marts.total_transactions(_star(spark, folder).facts)


def total_spend(spark: SparkSession, folder: str) -> DataFrame:
    return marts.total_spend(_star(spark, folder).facts)


def clean_data_pct(spark: SparkSession, folder: str) -> DataFrame:
    return marts.clean_share(_labelled(spark, folder))


def layer_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """From one labelling: the fact has a row for each accepted one."""
    return marts.reconciled(_labelled(spark, folder))


def budget_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.budget_vs_actual(frames.facts, frames.dates, frames.categories, raw_budget(spark))


def _busy_clean(spark: SparkSession, folder: str) -> DataFrame:
    return standin.busy(_clean(spark, folder))


def spend_by_region_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Debits by the region and type that the account had on the day, one account holding a third of them."""
    versions = history.account_history(standin.account_snapshots(spark, folder), ["account_type", "region"])
    spent = _busy_clean(spark, folder).filter("transaction_type = 'debit'")
    return marts.spend_as_of(spent, versions)


def near_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Valid transactions of an account that differ by at most a cent and a day, as pairs of distinct business keys."""
    return repeats.near_repeats(_labelled(spark, folder), SETTINGS)


def rolling_spend(spark: SparkSession, folder: str) -> DataFrame:
    """Spend of the last 30 days and balance at each transaction, one account holding a third of them."""
    return marts.rolling_spend(_busy_clean(spark, folder))


def spend_cube(spark: SparkSession, folder: str) -> DataFrame:
    frames = _star(spark, folder)
    return marts.spend_cube(frames.facts, frames.dates, frames.accounts, frames.categories)


def spend_of_quarter(spark: SparkSession, folder: str) -> DataFrame:
    """Daily debits of one quarter, from a fact stored by month whose other months are not opened."""
    frames, scratch = _star(spark, folder), _scratch(spark, "by-month")
    slices.write_by_month(frames.facts, scratch)
    by_month = slices.read_by_month(spark, scratch, frames.facts.schema)
    return slices.spend_by_day(by_month, frames.dates, (F.col("year") == 1998) & (F.col("quarter") == 2))


def contract_drift(spark: SparkSession, folder: str) -> DataFrame:
    """What a run breaks against the one before: here a planted shift of categories, planted repeats and orphans."""
    clean, number = _clean(spark, folder), F.col("transaction_id")
    before = clean.filter(number % 2 == 0)
    now = clean.filter(number % 2 == 1)
    now = now.withColumn("category", F.when(number % 3 != 0, F.lit("Travel")).otherwise(F.col("category")))
    now = now.withColumn("account_id", F.when(number % 41 == 0, F.lit(-5)).otherwise(F.col("account_id")))
    now = now.union(now.filter(number % 97 == 0))
    bins = {"category": F.col("category"), "status": F.col("status"), "amount": F.floor(F.col("amount") / 50_000), "month": F.month("transaction_date")}
    return (
        drift.shifts(drift.histogram(now, bins), drift.histogram(before, bins))
        .union(drift.repeats(now, ["transaction_id"], "transaction_id"))
        .union(drift.unmatched(now, "account_id", raw_accounts(spark, folder), "account_id"))
    )


def accounts_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """Active accounts of each month, quarter and year: the true number, and whether daily sketches merged for the period come close."""
    clean, day = _clean(spark, folder), F.col("transaction_date")
    periods = {
        "month": F.date_format(day, "yyyy-MM"),
        "quarter": F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")),
        "year": F.year(day).cast("string"),
    }
    scratch = _scratch(spark, "sketches")
    sketches.by_day(clean, "account_id", "transaction_date").write.parquet(scratch)
    daily = spark.read.parquet(scratch)
    once = clean.select("account_id", "transaction_date").distinct()
    results = []
    for name, period in periods.items():
        about = sketches.distinct_in(daily, period, "period")
        exact = once.groupBy(period.alias("period")).agg(F.count_distinct("account_id").alias("accounts"))
        near = F.abs(F.col("distinct") - F.col("accounts")) <= F.ceil(F.col("accounts") * sketches.BOUND)
        results.append(exact.join(about, "period").select(F.lit(name).alias("grain"), "period", "accounts", near.alias("sketch_within_bound")))
    return results[0].union(results[1]).union(results[2])


def account_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three yearly snapshots of the accounts; two in ten change their type on the way."""
    account, year = F.col("account_id"), F.col("year")
    premier = ((account % 10 == 3) & (year >= 2021)) | ((account % 10 == 4) & (year == 2021))
    snapshots = (
        standin.accounts_file(spark, folder)
        .withColumn("year", F.explode(F.array(*[F.lit(year) for year in (2020, 2021, 2022)])))
        .withColumn("account_type", F.when(premier, "PREMIER").otherwise(F.col("account_type")))
        .withColumn("snapshot_date", F.make_date("year", F.lit(1), F.lit(1)))
    )
    return history.account_history(snapshots, ["customer_name", "account_type", "region"])


def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.contract_report(_labelled(spark, folder), contracts.clean_contracts(SETTINGS))


QUERIES: tuple[Query, ...] = (
    bronze_transactions,
    bronze_accounts,
    incremental_ingest,
    incremental_clean,
    incremental_quarantine,
    incremental_settled,
    quarantine_replay,
    merge_accounts,
    stored_run,
    text_standardise,
    mixed_date_parse,
    status_canonicalise,
    amount_correct,
    dedup_rank,
    orphan_accounts,
    rejection_reason,
    silver_clean,
    silver_quarantine,
    quarantine_breakdown,
    dq_summary,
    dim_date,
    null_key_audit,
    dim_accounts,
    dim_category,
    surrogate_keys,
    fct_transactions,
    fk_audit,
    fk_audit_all_rows,
    monthly_spend_trend,
    spend_by_category,
    spend_by_region,
    income_vs_outflow,
    status_breakdown,
    total_transactions,
    total_spend,
    clean_data_pct,
    layer_reconciliation,
    budget_vs_actual,
    spend_by_region_as_of,
    near_repeats,
    rolling_spend,
    spend_cube,
    spend_of_quarter,
    contract_drift,
    accounts_by_period,
    account_history,
    contract_report,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the monthly spend trend, through all three layers."""
    return queries()["monthly_spend_trend"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query, each taking (spark, folder of the given tables)."""

    def tuned(query: Query) -> Query:
        return lambda spark, folder: query(tune(spark), folder)

    registered = {query.__name__: tuned(query) for query in QUERIES}
    if training_data is None:
        return registered

    def reached(query: Query) -> Query:
        return lambda spark, folder: query(importable(spark), folder)

    more = training_data.QUERIES | {"pipeline": corpus_pipeline.run}
    return registered | {name: reached(query) for name, query in more.items()}


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    if training_data is None:
        return dict(oracles.SQL)
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracles.SQL | training_data.SQL | pipeline
