"""The whole run over stored tables: raw files to cleaned rows to the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.config import Settings
from tallyloom.operators import facts as fact_operators
from tallyloom.operators import guards, rules
from tallyloom.plans import marts, silver
from tallyloom.plans.star import star
from tallyloom.schemas import CORRUPT
from tallyloom.sources.csv import ingest
from tallyloom.sources.tables import CLEANED, MODELLED, RAW, Layers, View

LABELLED = "transactions_labelled"


def build_cleaned(layers: Layers, settings: Settings) -> dict[str, int]:
    """Label the raw transactions and store them once, split by outcome.

    The costly plan runs one time: accepted and rejected rows are partitions of one
    table, and the two tables a reader knows are views that prune to their partition.
    Returns the row counts gathered by the write.
    """
    layers.create(CLEANED)
    labelled = silver.label(layers.read(RAW, "transactions"), layers.read(RAW, "accounts"), settings)
    rejected = F.col(rules.REASON).isNotNull()
    split = labelled.withColumns({"_quarantined_at": F.when(rejected, F.current_timestamp()), "_rejected": rejected})
    version = layers.new_version()
    stored = layers.stage(CLEANED, LABELLED, split, version, rules.split_counts(), partition_by=["_rejected"])
    kept = [name for name in labelled.columns if name not in (*rules.HELPERS, CORRUPT)]
    views = {
        "transactions": View(stored, kept, "NOT _rejected"),
        "transactions_quarantine": View(stored, [*labelled.columns, "_quarantined_at"], "_rejected"),
    }
    layers.publish(CLEANED, version, views)
    return stored.counts


def build_modelled(layers: Layers, settings: Settings) -> dict[str, int]:
    """Build and store the star; raises before any of its tables is published if a key is amiss.

    All four tables are computed once, written beside the published ones and audited there.
    Then all are published with one row, so readers find the old star or the new one, whole.
    """
    layers.create(MODELLED)
    frames = star(layers.spark, layers.read(CLEANED, "transactions"), layers.read(RAW, "accounts"), settings)
    guards.require_zero(
        guards.null_counts(frames.accounts, "account_id", "account_key"), "accounts without a key"
    )
    version = layers.new_version()
    # Sorted files let a reader skip what lies outside its days; no shuffle is needed for that.
    tables = {
        "dim_date": frames.dates,
        "dim_accounts": frames.accounts,
        "dim_category": frames.categories,
        "fct_transactions": frames.facts.sortWithinPartitions("date_key"),
    }
    staged = {name: layers.stage(MODELLED, name, rows, version) for name, rows in tables.items()}
    audit = fact_operators.fk_audit(*(staged[name].rows for name in ("fct_transactions", "dim_accounts", "dim_date", "dim_category")))
    guards.require_zero(audit, "fact rows without a dimension row")
    layers.publish(MODELLED, version, {name: View(rows) for name, rows in staged.items()})
    return {name: rows.counts["rows"] for name, rows in staged.items()}


def run(layers: Layers, landing: str, settings: Settings) -> dict[str, int]:
    """All three layers from the landing folder; returns the row count of each table."""
    counts = {f"raw_{table}": rows for table, rows in ingest(layers, landing).items()}
    return counts | build_cleaned(layers, settings) | build_modelled(layers, settings)


def reports(layers: Layers, settings: Settings) -> dict[str, DataFrame]:
    """Every report over the stored tables, by name."""
    facts = layers.read(MODELLED, "fct_transactions")
    dates = layers.read(MODELLED, "dim_date")
    categories = layers.read(MODELLED, "dim_category")
    raw, clean = layers.read(RAW, "transactions"), layers.read(CLEANED, "transactions")
    rejected = layers.read(CLEANED, "transactions_quarantine")
    return {
        "monthly_spend_trend": marts.monthly_spend_trend(facts, dates, categories, settings.trend_years),
        "spend_by_category": marts.spend_by_category(facts, dates, categories),
        "spend_by_region": marts.spend_by_region(facts, layers.read(MODELLED, "dim_accounts")),
        "income_vs_outflow": marts.income_vs_outflow(facts, dates),
        "status_breakdown": marts.status_breakdown(facts),
        "total_transactions": marts.total_transactions(facts),
        "total_spend": marts.total_spend(facts),
        "clean_data_pct": marts.clean_data_pct(raw, clean),
        "quarantine_breakdown": rules.profile(rejected),
        "layer_reconciliation": marts.layer_counts(
            {"bronze": raw, "silver_clean": clean, "silver_quarantine": rejected, "gold_fact": facts}
        ),
        "budget_vs_actual": marts.budget_vs_actual(facts, dates, categories, layers.read(RAW, "budget")),
    }
