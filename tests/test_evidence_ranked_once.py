"""Ranks of evidence: the second pass reads no texts and meets only questions whose rank isn't known by then."""

import random

import numpy as np

from foliant.operators import gates as gt
from foliant.plans import queries_gates as qg


def test_ranks_known_after_the_first_pass_match_brute_force(spark):
    rng = random.Random(12)
    vec = lambda: [float(rng.randrange(-2, 3)) for _ in range(3)] + [1.0]
    rows = [(rng.choice("ab"), f"i{i:03d}", rng.choice("st"), vec(), rng.choice(["alpha", "beta", "gamma"])) for i in range(120)]
    qs = [(f"q{i:02d}", rng.choice("st"), vec(), rng.choice([["alph"], ["beta", "gam"], ["none"], None, ["a"]]), rng.random() < 0.7) for i in range(80)]
    base = spark.createDataFrame(rows, "profile string, item string, space string, v array<double>, text string").repartition(3)
    questions = spark.createDataFrame(qs, "query string, space string, v array<double>, terms array<string>, ranked boolean")
    df = gt.ranked_evidence(base, questions)
    got = {(r.profile, r.query): r for r in df.collect()}
    kinds = set()
    for q, space, v, terms, ranked in qs:
        for p in "ab":
            own = sorted((-round(float(np.dot(v, x) / np.sqrt(np.dot(v, v) * np.dot(x, x))), 6), i, any(t in text for t in terms or [])) for profile, i, s, x, text in rows if profile == p and s == space)
            first = next((n + 1 for n, x in enumerate(own) if x[2]), None)
            assert got[p, q].first_relevant_rank == (first if ranked else None) and got[p, q].relevant == sum(x[2] for x in own)
            kinds.add((ranked, first and min(first, 2)))
    assert len(kinds) == 6


def test_second_pass_over_the_tables_reads_no_texts(spark, data):
    assert "source_text" not in qg.query_metrics(spark, data)._jdf.queryExecution().executedPlan().toString()
