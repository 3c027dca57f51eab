"""Exact top-k inner products by a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

QUERIES_AT_ONCE, VECTORS_AT_ONCE, PAIRS_AT_ONCE = 512, 8192, 1 << 18
DEPTH = 10  # length of the first local lists in results asked for: longer lists give a higher safe cutoff


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", factor: int = 64) -> DataFrame:
    """(vec_id, v): floor(factor * x) of each component; vectors that are null, empty or hold a
    null or non-finite component, and rows without an id, take no part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("long"))
    usable = vectors.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    return usable.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v"))


def _ranked(frame: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return frame.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def classes(vectors: DataFrame, most_ids: int) -> DataFrame:
    """(v, cid, ids): equal vectors once, with their ``most_ids`` least ids in order.

    Spark cuts each task's share of a vector to ``most_ids`` rows before the shuffle, so a
    vector that a third of all rows repeat costs no task more than others.
    """
    some = _ranked(vectors, ["v"], [F.col("vec_id")], most_ids)
    grouped = some.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.withColumn("cid", F.element_at("ids", 1))


def _blocks(frame: DataFrame, size: int) -> int:
    return max(1, -(-frame.count() // size))


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def _every(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _grid(queries: DataFrame, vectors: DataFrame, shape: tuple[int, int], nodes: int, work: Callable, schema: str, extra: list[str]) -> DataFrame:
    """Run ``work`` on every (node, block of queries, block of vectors), with that node's components only."""
    length = F.ceil(F.size("v") / nodes).cast("int")

    def share(frame: DataFrame, columns: list[str]) -> DataFrame:
        dealt = frame.select("cid", "v", *columns, _every(nodes).alias("node"))
        return dealt.select("cid", "node", *columns, F.slice("v", F.col("node") * length + 1, length).alias("v"))

    key = ["node", "qb", "vb"]
    asked = share(queries, extra).withColumn("qb", _block("cid", shape[0])).withColumn("vb", _every(shape[1]))
    held = share(vectors, []).withColumn("vb", _block("cid", shape[1])).withColumn("qb", _every(shape[0]))
    return asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(work, schema)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _products(asked: pd.DataFrame, held: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, vector ids and the integer products of their components."""
    width = max(asked["v"].map(len).max(), held["v"].map(len).max(), 1)
    left, right = _matrix(asked["v"], width).astype(float), _matrix(held["v"], width).astype(float)
    exact = float(np.abs(left).max()) * float(np.abs(right).max()) * width < 2**53
    product = left @ right.T if exact else left.astype(np.int64) @ right.astype(np.int64).T
    return asked["cid"].to_numpy(), held["cid"].to_numpy(), product.astype(np.int64)


PARTIAL = "qid long, cid long, node int, part long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, nodes: int = 2) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k highest inner products of each query.

    ``vectors`` and ``queries`` hold (vec_id, v) with integer arrays. Each node owns a share of
    the components and, for each query, a list of partial scores over all vectors.

    1. Each node gives its best partial scores of a query, DEPTH * (k + 1) of them. The exact scores of what they
       name give a cutoff: the (k + 1)-th of them cannot exceed the (k + 1)-th best of all.
    2. A vector that reaches the cutoff reaches a ``nodes``-th of it in at least one node, so
       each node gives every entry from that uniform threshold on. Entries that even the
       threshold in place of each unseen part cannot lift to the cutoff go.
    3. What is left and was not seen by all nodes is resolved exactly.

    Equal scores go to the smaller vec_id; equal vectors are searched once and expanded at the
    end; a query never finds its own id. With at most k other vectors all are returned. Repeated
    rows of one id and vector count once. Empty tables give an empty result.
    """
    most, deep = k + 1, DEPTH * (k + 1)
    found = stored(classes(vectors.select("vec_id", "v").distinct(), most), "vectors")
    rows = queries.select("vec_id", "v").distinct()
    asked = stored(rows.groupBy("v").agg(F.min("vec_id").alias("cid")), "queries")

    def best(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "cid": [], "node": [], "part": []})
        qid, cid, product = _products(left, right)
        few = min(deep, len(cid))
        top = np.argpartition(-product, few - 1, axis=1)[:, :few]
        return pd.DataFrame({"qid": np.repeat(qid, few), "cid": cid[top].ravel(), "node": left["node"].iloc[0],
                             "part": np.take_along_axis(product, top, axis=1).ravel()})

    def above(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "cid": [], "node": [], "part": []})
        qid, cid, product = _products(left, right)
        at = np.nonzero(product * nodes >= left["cutoff"].to_numpy()[:, None])
        return pd.DataFrame({"qid": qid[at[0]], "cid": cid[at[1]], "node": left["node"].iloc[0], "part": product[at]})

    def resolve(_, pairs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if pairs.empty:
            return pd.DataFrame({"qid": [], "cid": [], "score": []})
        width = max(rows["v"].map(len).max(), 1)
        sides = []
        for asks, wanted in ((True, pairs["qid"]), (False, pairs["cid"])):
            own = rows[rows["asks"] == asks]
            sides.append(_matrix(own["v"], width)[pd.Index(own["cid"]).get_indexer(wanted)])
        scores = [np.einsum("ij,ij->i", *(side[at : at + PAIRS_AT_ONCE] for side in sides)) for at in range(0, len(pairs), PAIRS_AT_ONCE)]
        return pairs[["qid", "cid"]].assign(score=np.concatenate(scores))

    def exact(pairs: DataFrame) -> DataFrame:
        """Whole scores of (qid, cid) pairs; pairs meet their vectors block by block."""
        key = ["qb", "vb"]
        placed = pairs.select("qid", "cid", _block("qid", shape[0]).alias("qb"), _block("cid", shape[1]).alias("vb"))
        left = asked.select("cid", "v", F.lit(True).alias("asks"), _block("cid", shape[0]).alias("qb"), _every(shape[1]).alias("vb"))
        right = found.select("cid", "v", F.lit(False).alias("asks"), _every(shape[0]).alias("qb"), _block("cid", shape[1]).alias("vb"))
        both = left.unionByName(right).groupBy(*key)
        return placed.groupBy(*key).cogroup(both).applyInPandas(resolve, "qid long, cid long, score long")

    shape = _blocks(asked, QUERIES_AT_ONCE), _blocks(found, VECTORS_AT_ONCE)
    lists = _grid(asked, found, shape, nodes, best, PARTIAL, [])
    first = _ranked(lists, ["qid", "node"], [F.desc("part"), F.col("cid")], deep)
    scored = _ranked(exact(first.select("qid", "cid").distinct()), ["qid"], [F.desc("score"), F.col("cid")], most)
    cutoffs = scored.groupBy("qid").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    lowest = -(1 << 62) // nodes
    safe = F.when(F.col("n") == most, F.col("low")).otherwise(F.lit(lowest))
    cutoffs = stored(cutoffs.select("qid", safe.alias("cutoff")), "cutoffs")

    bounded = asked.join(cutoffs, asked.cid == cutoffs.qid).select("cid", "v", "cutoff")
    entries = _grid(bounded, found, shape, nodes, above, PARTIAL, ["cutoff"])
    gathered = entries.groupBy("qid", "cid").agg(F.sum("part").alias("seen"), F.count(F.lit(1)).alias("times"))
    most_possible = F.col("seen") + (nodes - F.col("times")) * F.ceil(F.col("cutoff") / nodes)
    left = gathered.join(cutoffs, "qid").filter(most_possible >= F.col("cutoff"))
    left = stored(left.select("qid", "cid", "seen", "times"), "survivors")
    whole = left.filter(F.col("times") == nodes).select("qid", "cid", F.col("seen").alias("score"))
    final = whole.union(exact(left.filter(F.col("times") < nodes).select("qid", "cid")))
    final = _ranked(final, ["qid"], [F.desc("score"), F.col("cid")], most)

    hits = final.join(found.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    hits = _ranked(hits, ["qid"], [F.desc("score"), F.col("vec_id")], most)
    answer = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))).alias("hits"))
    asking = rows.join(asked.select(F.col("cid").alias("qid"), "v"), "v").select(F.col("vec_id").alias("query_id"), "qid")
    own = F.filter("hits", lambda hit: hit["vec_id"] != F.col("query_id"))
    placed = asking.join(answer, "qid").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "hit"))
    return placed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                         (-F.col("hit.less")).alias("score"))
