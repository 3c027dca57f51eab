import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, queries
from twins import duck_rows, duck_types, spark_rows, spark_types


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_its_twin(spark, duck, scale):
    frame, sql = queries.op9_mixing(spark, f"/root/testdata/{scale}"), queries.SQL["op9_mixing"]
    assert spark_rows(frame) == duck_rows(duck(scale), sql)
    assert spark_types(frame) == duck_types(duck(scale), sql)


def poured(budget, children):
    """Plain water-filling: {name: (weight, cap)}; whoever is full leaves, the rest share on."""
    share, open_ones = {}, {n: wc for n, wc in children.items() if wc[0] and wc[1]}
    share.update({n: 0 for n in children if n not in open_ones})
    while open_ones:
        total = sum(w for w, _ in open_ones.values())
        left = budget - sum(share.values())
        full = [n for n, (w, cap) in open_ones.items() if cap <= Fraction(left * w, total)]
        if not full:
            return share | {n: left * w // total for n, (w, _) in open_ones.items()}
        for n in full:
            share[n] = open_ones.pop(n)[1]
    return share


def test_against_plain_budgets_and_order(spark):
    rows = [(n, " ".join(["w"] * (n * 7 % 23)), ["en", "de", None][n % 3], f"s{n * n % 7}") for n in range(400)]
    rows += [(None, "a b c", "en", None)] * 3 + [(5, "x " * 40, "de", "s4")] * 4 + [(900, None, "en", "s0"), (901, "", "xx", "s9")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    documents = documents.withColumns({name: F.lit(1) for name in ("share", "epochs", "cut", "key", "_tokens", "cap")})
    domain = F.when(F.col("source").isin("s0", "s1"), "big").otherwise("small")
    weights, most = {"domain": {"big": 1, "small": 5}, "lang": {"en": 3}, "source": {"s4": 0}}, 3
    got = mixing.mix(documents, domain, weights, F.col("tokens") * 2, most, seed=9)
    assert got.columns == documents.columns

    leaf = lambda r: ("big" if r[3] in ("s0", "s1") else "small", r[2] or "unknown", r[3] or "unknown")
    tokens = lambda r: len((r[1] or "").split())
    caps = Counter()
    for r in rows:
        caps[leaf(r)] += tokens(r)
    cap = lambda *at: most * sum(v for k, v in caps.items() if k[: len(at)] == at)
    budget, wanted = min(2 * sum(caps.values()), cap()), Counter()
    names = lambda *at: {k[len(at)] for k in caps if k[: len(at)] == at}
    for d, bd in poured(budget, {d: (weights["domain"][d], cap(d)) for d in names()}).items():
        for lang, bl in poured(bd, {n: (weights["lang"].get(n, 1), cap(d, n)) for n in names(d)}).items():
            for s, bs in poured(bl, {n: (weights["source"].get(n, 1), cap(d, lang, n)) for n in names(d, lang)}).items():
                own = [r for r in rows if leaf(r) == (d, lang, s)]
                total = caps[d, lang, s]
                epochs, rest = divmod(bs, total) if total else (0, 0)
                groups = defaultdict(list)
                for r in own:
                    groups[hashlib.md5(f"9:{epochs}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()].append(r)
                spent, going = 0, rest > 0
                for key in sorted(groups):
                    spent += sum(map(tokens, groups[key]))
                    going = going and spent <= rest
                    for r in groups[key]:
                        wanted[r] += epochs + going
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in got.collect()) == +wanted
    assert mixing.mix(documents.limit(0), domain, weights, F.col("tokens"), 1, 9).collect() == []
