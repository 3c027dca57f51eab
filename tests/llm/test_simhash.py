from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import simhash
from tallyloom.llm.components import components

SF = "/root/testdata/sf0.01"


def slow_print(text, each=3):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + each]) for i in range(max(1, len(words) - each + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance):
    distinct = sorted(set(prints.values()))
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(distinct, 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = {}
    for doc, p in prints.items():
        least[root(p)] = min(doc, least.get(root(p), doc))
    return {doc: least[root(p)] for doc, p in prints.items()}


def test_whole_table_matches_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    prints = {row.doc_id: slow_print(row.text) for row in documents.collect()}
    wanted = slow_components(prints, 3)
    got = simhash.near_duplicates(documents).collect()
    assert {row.doc_id: row.component_id for row in got} == wanted
    assert {row.doc_id: row.fingerprint for row in got} == {d: f"{p:016x}" for d, p in prints.items()}
    assert len(set(wanted.values())) < len(wanted)


def test_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, None), (3, ""), (4, " \t\n"), (None, "a b c d"), (5, "x"), (6, "A B C D"),
            (None, "lone text of its own"), (7, "y " * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit(9) for name in ("bits", "component_id", "root", "node", "mask")}
    )
    got = sorted((r.doc_id or 0, r.fingerprint == "0" * 16, r.component_id or 0) for r in simhash.near_duplicates(frame).collect())
    assert [g for g in got if g[0]] == [
        (1, False, 1), (1, False, 1), (2, True, 2), (3, True, 2), (4, True, 2), (5, False, 5), (6, False, 1), (7, False, 7)]
    assert [g[2] for g in got if not g[0]] == [0, 1]
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


@pytest.mark.parametrize("most_rows", [20_000, 16])
def test_crowded_groups_lose_no_link(spark, most_rows):
    import random

    rng = random.Random(5)
    bases = [rng.getrandbits(64) for _ in range(4)]
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for base in bases for _ in range(60)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "bits long"), 3, most_rows=most_rows)
    roots = {r.node % (1 << 64): r.root for r in components(edges).collect()}
    wanted = slow_components({p: p for p in prints}, 3)
    for a, b in combinations(prints, 2):
        assert (wanted[a] == wanted[b]) == (roots.get(a, a) == roots.get(b, b))


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 60).selectExpr("id as u", "id - 1 as v").union(spark.sql("select 100L, 101L union all select 7L, 7L"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {n: 0 for n in range(60)} | {100: 100, 101: 100}
