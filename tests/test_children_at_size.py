"""Rows that are joined to the winners of a retrieval: few are shuffled, and no vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import retrieval as rt
from foliant.operators import tables as tb


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block,parts", [(4096, 4), (5, 4), (4096, 1)])
def test_children_of_winners_without_a_shuffle_of_vectors(spark, block, parts):
    rng = random.Random(8)
    vec = lambda n: [float(rng.randrange(-2, 3)) for _ in range(n)] + [1.0]
    rows = [(f"i{i:03d}", f"p{rng.randrange(40):02d}", "r", rng.choice("st"), vec(3 - (i % 7 == 0))) for i in range(500)]  # a space with vectors of two lengths
    qs = [(f"q{i:02d}", rng.choice("st"), vec(3)) for i in range(30)]
    won = [(q, f"p{p:02d}") for q, _, _ in qs for p in rng.sample(range(42), 4)]  # some have no rows
    lex = {(q, f"i{i:03d}"): n + 1 for q, _, _ in qs for n, i in enumerate(rng.sample(range(500), 40))}
    base = spark.createDataFrame(rows, "item string, parent string, record string, space string, v array<double>").repartition(parts)
    tables = [spark.createDataFrame(won, "query string, parent string"), base, spark.createDataFrame(qs, "query string, space string, v array<double>"), spark.createDataFrame([(*k, r) for k, r in lex.items()], "query string, doc string, rank int")]
    df = rt.best_children(*tables, most=3, block=block)
    plan = plan_of(df)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1  # of scores, by winner
    got = {(r.query, r.parent): (r.n_children, r.children) for r in df.collect()}
    want = {}
    for q, space, v in qs:
        for p in [p for q_, p in won if q_ == q]:
            own = [(-round(round(sum(a * b for a, b in zip(v, x)) / math.sqrt(sum(a * a for a in v) * sum(b * b for b in x)), 6) + (0.08 / lex[q, i] if (q, i) in lex else 0), 6), i) for i, p_, _, s, x in rows if p_ == p and s == space and len(x) == len(v)]
            if own:
                want[q, p] = len(own), [i for _, i in sorted(own)[:3]]
    assert got == want


@pytest.mark.parametrize("buckets", [1 << 20, 7])
def test_rows_of_wanted_keys_are_kept_before_a_join(spark, buckets):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    wanted = df.filter("id % 400 = 0").select("k")
    few = tb.maybe_in(df, "k", wanted, buckets)
    assert few.columns == df.columns and few.join(wanted, "k", "left_semi").count() == 5 and few.count() == few.distinct().count()
    assert buckets == 7 or few.count() < 20
