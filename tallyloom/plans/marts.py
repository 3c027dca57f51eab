"""Reports over the star.

A fact and its dimensions come in, an ordered report goes out. The date and category
dimensions are bounded by the settings and are broadcast. The account dimension grows
with the business: facts are summed by account before they meet it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import money
from tallyloom.functions.text import title_case
from tallyloom.operators import asof, rolling, rules

def _rows() -> Column:
    return F.count(F.lit(1))


def _of_type(name: str) -> Column:
    return F.col("transaction_type") == name


def _dated(facts: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    return facts.join(F.broadcast(dates.select("date_key", *columns)), "date_key")


def _categorised(facts: DataFrame, categories: DataFrame, *columns: str) -> DataFrame:
    return facts.join(F.broadcast(categories.select("category_key", *columns)), "category_key")


def year_month() -> Column:
    """yyyy-MM text, which sorts by time."""
    return F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month_num").cast("string"), 2, "0"))


def monthly_spend_trend(facts: DataFrame, dates: DataFrame, categories: DataFrame, years: Sequence[int]) -> DataFrame:
    """Debits per month and category group in the given years.

    The days are also bounds on the fact's own key, which a reader of sorted files can skip by.
    """
    shown = dates.filter(F.col("year").isin(list(years)))
    if years:
        facts = facts.filter(F.col("date_key").between(f"{min(years):04d}0101", f"{max(years):04d}1231"))
    spent = _categorised(
        _dated(facts.filter(_of_type("debit")), shown, "year", "month_num", "month_name"),
        categories,
        "category_group",
    )
    return (
        spent.groupBy("year", "month_num", "month_name", "category_group")
        .agg(money.total("amount").alias("total_spend"), _rows().alias("transaction_count"))
        .select(
            "year",
            "month_num",
            "month_name",
            year_month().alias("year_month"),
            "category_group",
            "total_spend",
            "transaction_count",
        )
        .orderBy("year", "month_num", "category_group")
    )


def spend_by_category(facts: DataFrame, dates: DataFrame, categories: DataFrame) -> DataFrame:
    """Debits per category and year, all years, the largest first within a year."""
    spent = _categorised(
        _dated(facts.filter(_of_type("debit")), dates, "year"), categories, "category_group", "category_name"
    )
    return (
        spent.groupBy("category_group", "category_name", "year")
        .agg(
            money.total("amount").alias("total_spend"),
            _rows().alias("transaction_count"),
            money.average("amount").alias("avg_transaction"),
        )
        .orderBy("year", F.desc("total_spend"), "category_name")
    )


def spend_by_region(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Debits per region and account type, the largest first.

    Both sides are summed up before they meet, so neither a busy account nor one that
    the dimension lists many times brings more than a few rows to the join. An account
    listed n times counts n times.
    """
    per_account = (
        facts.filter(_of_type("debit"))
        .groupBy("account_key")
        .agg(F.sum(money.exact("amount")).alias("spend"), _rows().alias("transactions"))
    )
    places = accounts.groupBy("account_key", "region", "account_type").agg(_rows().alias("copies"))
    return (
        per_account.join(places, "account_key")
        .groupBy("region", "account_type")
        .agg(
            money.cents(F.sum(F.col("spend") * F.col("copies"))).alias("total_spend"),
            F.sum(F.col("transactions") * F.col("copies")).alias("transaction_count"),
            _rows().alias("unique_accounts"),
        )
        .orderBy(F.desc("total_spend"), "region", "account_type")
    )


def spend_as_of(spent: DataFrame, versions: DataFrame) -> DataFrame:
    """Debits by the region and account type that were valid on their day; NULL where no version was.

    ``spent`` has natural account ids and days; it is summed by account and day before versions
    are looked up.
    """
    daily = spent.groupBy("account_id", "transaction_date").agg(F.sum(money.exact("amount")).alias("_spend"), _rows().alias("_rows"))
    placed = asof.as_of(daily, versions, "account_id", "transaction_date", ["region", "account_type"])
    return (
        placed.groupBy("region", "account_type")
        .agg(money.cents(F.sum("_spend")).alias("total_spend"), F.sum("_rows").alias("transaction_count"))
        .orderBy(F.desc("total_spend"), "region", "account_type")
    )


def rolling_spend(clean: DataFrame, days: int = 30) -> DataFrame:
    """Debits of the account's last days, and credits less debits up to each of its transactions."""
    amount, none = money.exact("amount"), F.lit(0).cast(money.EXACT)
    spend = F.when(_of_type("debit"), amount).otherwise(none)
    flow = F.when(_of_type("credit"), amount).when(_of_type("debit"), -amount).otherwise(none)
    summed = rolling.rolling(clean, "account_id", "transaction_date", "transaction_id", {"_spend": spend}, {"_balance": flow}, days)
    return summed.select(
        "transaction_id", "account_id", "transaction_date", money.cents(F.col("_spend")).alias(f"spend_{days}d"), money.cents(F.col("_balance")).alias("balance")
    )


def income_vs_outflow(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Credits, debits and their difference per month."""
    income = money.total_where("amount", _of_type("credit"))
    outflow = money.total_where("amount", _of_type("debit"))
    return (
        _dated(facts, dates, "year", "month_num")
        .groupBy("year", "month_num")
        .agg(
            money.cents(income).alias("total_income"),
            money.cents(outflow).alias("total_outflow"),
            money.cents(income - outflow).alias("net_position"),
        )
        .select("year", "month_num", year_month().alias("year_month"), "total_income", "total_outflow", "net_position")
        .orderBy("year", "month_num")
    )


# The sets of columns by which the cube sums, by the report each one answers.
CUBE_SETS: dict[str, tuple[str, ...]] = {
    "monthly_spend_trend": ("year", "month_num", "category_group"),
    "spend_by_category": ("year", "category_group", "category_name"),
    "spend_by_region": ("region", "account_type"),
    "income_vs_outflow": ("year", "month_num"),
    "status_breakdown": ("status",),
}
CUBE_COLUMNS = ("year", "month_num", "category_group", "category_name", "region", "account_type", "status")


def spend_cube(facts: DataFrame, dates: DataFrame, accounts: DataFrame, categories: DataFrame) -> DataFrame:
    """The sums behind five reports from one read of the fact: one row for each group of each of ``CUBE_SETS``.

    ``report`` names the set; columns outside it are NULL. Facts are summed by account and every
    other column of the cube before they meet the accounts, and only these sums are multiplied by
    the sets.
    """
    named = _categorised(_dated(facts, dates, "year", "month_num"), categories, "category_group", "category_name")
    amount = money.exact("amount")
    nothing = F.lit(0).cast(money.EXACT)
    sums = {
        "spend": F.when(_of_type("debit"), amount).otherwise(nothing),
        "income": F.when(_of_type("credit"), amount).otherwise(nothing),
        "amount": amount,
    }
    own = [name for name in CUBE_COLUMNS if name not in ("region", "account_type")]
    small = named.groupBy("account_key", *own).agg(
        *[F.sum(value).alias(f"_{name}") for name, value in sums.items()], F.count_if(_of_type("debit")).alias("_debits"), _rows().alias("_rows")
    )
    placed = small.join(accounts.select("account_key", "region", "account_type"), "account_key", "left")
    sets = [[F.col(name) for name in CUBE_COLUMNS if name in chosen] for chosen in CUBE_SETS.values()]
    cube = placed.groupingSets(sets, *CUBE_COLUMNS).agg(
        F.grouping_id(*CUBE_COLUMNS).alias("_set"),
        *[money.cents(F.sum(f"_{name}")).alias(f"total_{name}") for name in sums],
        F.sum("_debits").alias("debit_count"),
        F.sum("_rows").alias("transaction_count"),
    )
    report = F.lit(None).cast("string")
    for name, chosen in CUBE_SETS.items():
        number = sum(1 << place for place, column in enumerate(reversed(CUBE_COLUMNS)) if column not in chosen)
        report = F.when(F.col("_set") == number, name).otherwise(report)
    return cube.select(report.alias("report"), *CUBE_COLUMNS, *[f"total_{name}" for name in sums], "debit_count", "transaction_count")


def status_breakdown(facts: DataFrame) -> DataFrame:
    """Transactions per status, most frequent first."""
    return (
        facts.groupBy("status")
        .agg(_rows().alias("transaction_count"), money.total("amount").alias("total_amount"))
        .orderBy(F.desc("transaction_count"), "status")
    )


def total_transactions(facts: DataFrame) -> DataFrame:
    return facts.agg(_rows().alias("total_transactions"))


def total_spend(facts: DataFrame) -> DataFrame:
    return facts.filter(_of_type("debit")).agg(money.total("amount").alias("total_spend"))


def clean_data_pct(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Accepted rows as a percentage of raw rows; NULL if there are no raw rows."""
    raw_rows = raw.agg(_rows()).scalar()
    return clean.agg(money.share(_rows(), raw_rows, 2).alias("clean_data_pct"))


def clean_share(labelled: DataFrame) -> DataFrame:
    """``clean_data_pct`` from one pass over labelled rows."""
    counts = labelled.agg(*[count.alias(name) for name, count in rules.split_counts().items()])
    return counts.select(money.share(F.col("clean_rows"), F.col("bronze_rows"), 2).alias("clean_data_pct"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table: raw = accepted + rejected, and accepted = fact."""
    counts = [
        rows.agg(_rows().alias("rows")).select(F.lit(name).alias("layer"), "rows") for name, rows in layers.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def reconciled(labelled: DataFrame) -> DataFrame:
    """``layer_counts`` of all layers from one pass over labelled rows."""
    counts = labelled.agg(*[count.alias(name) for name, count in rules.split_counts().items()])
    layers = {"bronze": "bronze_rows", "silver_clean": "clean_rows", "silver_quarantine": "rejected_rows", "gold_fact": "clean_rows"}
    rows = F.array(*[F.struct(F.lit(layer).alias("layer"), F.col(count).alias("rows")) for layer, count in layers.items()])
    return counts.select(F.inline(rows))


def budget_vs_actual(facts: DataFrame, dates: DataFrame, categories: DataFrame, budget: DataFrame) -> DataFrame:
    """Debits against the budget per month and category, also where one side is missing.

    Budget lines name a category in any case, so names are settled before the join.
    """
    months = ["year", "month_num", "category_name"]
    spent = (
        _categorised(
            _dated(facts.filter(_of_type("debit")), dates, "year", "month_num"), categories, "category_name"
        )
        .groupBy(*months)
        .agg(F.sum(money.exact("amount")).alias("spent"))
    )
    planned = (
        budget.select(
            "year",
            F.col("month").alias("month_num"),
            title_case(F.trim("category")).alias("category_name"),
            "budget_amount",
        )
        .groupBy(*months)
        .agg(F.sum(money.exact("budget_amount")).alias("planned"))
    )
    variance = F.coalesce("spent", F.lit(0)) - F.coalesce("planned", F.lit(0))
    return (
        spent.join(planned, months, "full")
        .select(
            *months,
            money.cents(F.col("planned")).alias("budget_amount"),
            money.cents(F.col("spent")).alias("actual_amount"),
            money.cents(variance).alias("variance"),
        )
        .orderBy(*months)
    )
