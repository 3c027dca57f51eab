"""Mixing sources to target weights by hierarchical budgeting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, stored

LEVELS = ("domain", "lang", "source")
WIDE = "decimal(28,0)"
BUCKET_DIGITS = 3


def leaves_of(documents: DataFrame, domain: Column) -> DataFrame:
    """(doc_id, _domain, _lang, _source, _tokens): the leaf of every row and its number of words; null names are 'unknown'."""
    name = {"_domain": domain, "_lang": F.col("lang"), "_source": F.col("source")}
    return documents.select("doc_id", *[F.coalesce(c.cast("string"), F.lit("unknown")).alias(n) for n, c in name.items()],
                            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_tokens"))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    """Whole-number weight of a node; nodes that are not named weigh 1."""
    given = weights.get(level, {})
    if not given:
        return F.lit(1).cast("decimal(10,0)")
    known = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    return F.coalesce(known[F.col(f"_{level}")], F.lit(1)).cast("decimal(10,0)")


def _pour(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Divide ``budget`` of each parent among its children (weight, cap): adds ``share``.

    Children are taken by rising cap over weight. A child whose cap does not exceed its part of
    what is left takes its cap; what it cannot hold goes to its siblings in proportion. Whole
    numbers throughout: at most one token a child stays undivided.
    """
    weight = F.when(F.col("cap") > 0, F.col("weight")).otherwise(F.lit(0))
    cap = F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0))
    ratio = F.when(cap > 0, cap.cast("double") / weight.cast("double")).otherwise(F.lit(0.0))
    one = Window.partitionBy(*parents).orderBy("_ratio", name)
    before, onward = one.rowsBetween(Window.unboundedPreceding, -1), one.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parents)
    zero = F.lit(0).cast(WIDE)
    nodes = nodes.withColumns({"_w": weight.cast("decimal(10,0)"), "_c": cap.cast(WIDE), "_ratio": ratio})
    nodes = nodes.withColumns({
        "_left": (F.col("budget") - F.coalesce(F.sum("_c").over(before), zero)).cast(WIDE),
        "_rest": F.sum("_w").over(onward).cast("decimal(10,0)"),
    })
    nodes = nodes.withColumn("_full", F.col("_c") * F.col("_rest") <= F.col("_w") * F.col("_left"))
    nodes = nodes.withColumns({
        "_over": (F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_c"))).over(whole), zero)).cast(WIDE),
        "_open": F.sum(F.when(~F.col("_full"), F.col("_w"))).over(whole).cast("decimal(10,0)"),
    })
    share = F.when(F.col("_full"), F.col("_c")).otherwise(F.expr("(_over * _w) div _open"))
    return nodes.withColumn("share", share.cast(WIDE)).drop("_w", "_c", "_ratio", "_left", "_rest", "_full", "_over", "_open")


def leaf_budgets(rows: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: Column, most_epochs: int) -> DataFrame:
    """(_domain, _lang, _source, _tokens, share) of every leaf.

    Caps (tokens times ``most_epochs``) add up from the leaves to the root; the budget, an
    expression over the total ``tokens``, then runs down the tree, each node dividing its part
    by weight among its children. A shortage below a node is therefore met by siblings inside
    it, and only what the whole node cannot hold reaches the siblings of its ancestors.
    """
    names = [f"_{level}" for level in LEVELS]
    leaves = rows.groupBy(*names).agg(F.sum("_tokens").cast(WIDE).alias("tokens"))
    leaves = stored(leaves, "leaves")
    total = leaves.agg(F.sum("tokens").cast(WIDE).alias("tokens"))
    cap = (F.col("tokens") * most_epochs).cast(WIDE)
    above = total.select(F.least(budget.cast(WIDE), cap).alias("budget"))
    for depth, level in enumerate(LEVELS):
        own = names[: depth + 1]
        nodes = leaves.groupBy(*own).agg(F.sum("tokens").cast(WIDE).alias("tokens"))
        nodes = nodes.withColumns({"cap": cap, "weight": _weight(level, weights)})
        nodes = nodes.join(above, names[:depth]) if depth else nodes.withColumn("budget", above.scalar())
        above = _pour(nodes, names[:depth] or [F.lit(0)], names[depth]).select(*own, "tokens", F.col("share").alias("budget"))
        if depth < len(LEVELS) - 1:
            above = above.drop("tokens")
    return above.withColumnRenamed("tokens", "_tokens").withColumnRenamed("budget", "share")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in the seeded order of one epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def plan(rows: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: Column, most_epochs: int, seed: int) -> DataFrame:
    """(_domain, _lang, _source, share, epochs, cut): each leaf's whole epochs and the last key of the part of one.

    The leaf's order is cut into 16^3 ranges of the key. Their sums say in which range the
    budget ends, so only that range of a leaf is sorted, however large the leaf is. Rows with
    one key (repeated ids) are in or out together.
    """
    names = [f"_{level}" for level in LEVELS]
    leaves = leaf_budgets(rows, weights, budget, most_epochs)
    some = F.col("_tokens") > 0
    epochs = F.when(some, F.expr("share div _tokens")).otherwise(F.lit(0)).cast("int")
    leaves = leaves.withColumn("epochs", epochs)
    rest = F.when(some, F.col("share") - F.col("epochs") * F.col("_tokens")).otherwise(F.lit(0)).cast(WIDE)
    leaves = stored(leaves.select(*names, "share", "epochs", rest.alias("rest")), "leaf-plan")
    keyed = rows.join(leaves, names).withColumn("key", order_key(seed, F.col("epochs"), F.col("doc_id")))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*names, "bucket").agg(F.sum("_tokens").cast(WIDE).alias("tokens"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("tokens").over(running).cast(WIDE))
    edge = sums.filter("upto > rest").groupBy(*names).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("tokens")).cast(WIDE).alias("before")), "bucket").alias("e"))
    edge = stored(edge.select(*names, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")), "edges-of-leaves")
    near = keyed.join(edge, [*names, "bucket"])
    ordered = Window.partitionBy(*names).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("upto", F.col("before") + F.sum("_tokens").over(ordered)).filter("upto <= rest")
    cuts = near.groupBy(*names).agg(F.max("key").alias("last"))
    planned = leaves.join(edge, names, "left").join(cuts, names, "left")
    cut = F.when(F.col("rest") <= 0, F.lit("")).otherwise(F.coalesce("last", "bucket", F.lit("g")))
    return stored(planned.select(*names, F.col("share").cast("long").alias("share"), "epochs", cut.alias("cut")), "mix-plan")


def copies(seed: int) -> Column:
    """How often a row with a joined plan is taken: its whole epochs, and once more up to the cut."""
    key = order_key(seed, F.col("epochs"), F.col("doc_id"))
    return (F.col("epochs") + (key <= F.col("cut")).cast("int")).cast("int")


def mix(documents: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget: Column, most_epochs: int, seed: int) -> DataFrame:
    """The documents of the mixture, each as often as it is drawn, with their own columns.

    Null and empty texts have no tokens: they go with the part of the order they stand in.
    Null languages and sources are nodes called 'unknown'. Repeated rows are drawn alike;
    other columns pass through, whatever their names; an empty table gives an empty result.
    """
    rows = stored(leaves_of(documents, domain), "leaf-rows")
    planned = plan(rows, weights, budget, most_epochs, seed)
    renamed = planned.select(*[F.col(c).alias(f"__{c}") for c in planned.columns])
    place = {"_domain": domain, "_lang": F.col("lang"), "_source": F.col("source")}
    match = [F.coalesce(c.cast("string"), F.lit("unknown")) == F.col(f"__{n}") for n, c in place.items()]
    key = order_key(seed, F.col("__epochs"), F.col("doc_id"))
    times = (F.col("__epochs") + (key <= F.col("__cut")).cast("int")).cast("int")
    drawn = documents.join(renamed, match).withColumn("__times", F.array_repeat(F.lit(0), times))
    return drawn.withColumn("__copy", F.explode("__times")).select(*documents.columns)


def drawn_counts(documents: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], budget: Column, most_epochs: int, seed: int) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, tokens, leaf_budget, copies."""
    rows = stored(leaves_of(documents, domain), "leaf-rows")
    planned = plan(rows, weights, budget, most_epochs, seed)
    return rows.join(planned, [f"_{level}" for level in LEVELS]).select(
        "doc_id", *[F.col(f"_{level}").alias(level) for level in LEVELS], F.col("_tokens").alias("tokens"),
        F.col("share").alias("leaf_budget"), copies(seed).alias("copies"))
