"""Operators against plain versions on small inputs."""

import math
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import chunks as ch
from foliant.operators import names as nm
from foliant.operators import pages as pg
from foliant.operators import retrieval as rt
from foliant.operators import spans
from foliant.operators import tables as tb


def loop_windows(n, target, overlap):
    out, start = [], 0
    while start < n:
        end = min(start + target, n)
        out.append((start, end))
        if end == n:
            break
        start = max(start + 1, end - overlap)
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 3000), st.integers(2, 300), st.integers(0, 299))
def test_window_closed_form(n, target, overlap):
    if overlap >= target:
        return
    k = 0 if n <= 0 else 1 if n <= target else 1 + math.ceil((n - target) / (target - overlap))
    assert [(i * (target - overlap), min(i * (target - overlap) + target, n)) for i in range(k)] == loop_windows(n, target, overlap)


def test_chunks_are_exact_slices(spark):
    texts = [(1, "Eins zwei, drei."), (2, ""), (3, None), (4, "a😀b c " * 200), (5, "x" * 5000), (6, "Titel\n" + "wort " * 300)]
    df = spark.createDataFrame(texts, "id long, t string")
    got = ch.chunks(df, "id", "t", 64, 16).collect()
    by = {}
    for r in got:
        text = dict(texts)[int(r.doc_id)]
        assert text[r.char_start : r.char_end] == r.chunk_text
        by.setdefault(int(r.doc_id), []).append((r.unit_start, r.unit_end))
    for i, t in texts:
        n = len(re.findall(r"\w+|[^\w\s]", t or ""))
        assert sorted(by.get(i, [])) == loop_windows(n, 64, 16)
    w = ch.windows(df, "id", "t", 64, 16).collect()
    assert sorted((r.id, r.unit_start, r.unit_end) for r in w) == sorted((i, a, b) for i, x in by.items() for a, b in x)


def test_heading_aware_ends_at_headings(spark):
    body = "\n".join("wort " * 20 for _ in range(4)) + "\nNeuer Abschnitt\n" + "wort " * 200
    r = ch.chunks(spark.createDataFrame([(1, body)], "id long, t string"), "id", "t", 100, 10, heading_aware=True).orderBy("window_index").collect()
    assert r[0].unit_end == 80 and r[1].unit_start == 70


def test_last_before_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(200), i) for i in range(400)]
    events = [(rng.choice("abc"), rng.randrange(200), f"v{i}") for i in range(30)]
    got = spans.last_before(spark.createDataFrame(rows, "k string, p int, i int"), spark.createDataFrame(events, "k string, p int, v string"), "k", "p", "v", 16).collect()
    assert len(got) == len(rows)
    for r in got:
        before = [(p, v) for k, p, v in events if k == r.k and p < r.p]
        assert r.v == (max(before)[1] if before else None)


def test_range_owner_and_coverage(spark):
    ranges = spark.createDataFrame([("s", "A", 1, 100), ("s", "B", 101, 300), ("t", "C", 5, 9)], "k string, n string, a int, b int")
    pts = spark.createDataFrame([("s", p) for p in (0, 1, 100, 101, 300, 301)] + [("t", 5), ("u", 5)], "k string, p int")
    got = {(r.k, r.p): r.n for r in spans.range_owner(pts, ranges, "k", "p", "a", "b").collect()}
    assert got == {("s", 1): "A", ("s", 100): "A", ("s", 101): "B", ("s", 300): "B", ("t", 5): "C"}
    c = spans.exact_coverage(spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("y", 3), ("z", 1), ("z", 1)], "g string, p int"), "g", "p")
    assert {r.g: r.exact for r in c.collect()} == {"x": True, "y": False, "z": False}


def test_line_locator(spark):
    t = "eins\nzwei\ndrei\nzwei\n\nende"
    cases = [(1, 1, 1, "ok"), (2, 2, 2, "ambiguous"), (3, 5, 5, "blank"), (4, 3, 1, "bad_range"), (5, 2, 3, "ok"), (6, 0, 1, "bad_range")]
    df = spark.createDataFrame([(i, t, a, b) for i, a, b, _ in cases], "i int, t string, a int, b int")
    got = {r.i: r for r in spans.line_locator(df, "t", "a", "b").collect()}
    assert {i: r.locator_status for i, r in got.items()} == {i: s for i, _, _, s in cases}
    assert t[got[5].char_start : got[5].char_end] == "zwei\ndrei"


def test_packages_and_marked_range(spark):
    df = spark.createDataFrame([(1, list(range(13))), (2, []), (3, [7])], "i int, p array<int>")
    got = sorted((r.i, r.package, r.package_pages) for r in spans.packages(df, "p").collect())
    assert got == [(1, 1, list(range(6))), (1, 2, list(range(6, 12))), (1, 3, [12]), (3, 1, [7])]
    m = spark.createDataFrame([("xx AB mid END yy",), ("xx AB rest",), ("none",)], "t string").select(spans.marked_range(F.col("t"), "AB", "END").alias("m"))
    assert [r.m for r in m.collect()] == ["AB mid", "AB rest", None]


def test_vector_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 12)).round(3)
    base = spark.createDataFrame([(i, r.tolist(), "s" if i % 3 else "t") for i, r in enumerate(x)] + [(900, [0.0] * 12, "s"), (901, None, "s"), (902, [1.0], "s")], "i int, v array<double>, g string")
    q = base.filter("i % 50 = 0")
    got = rt.vector_search(base, q, "i", "v", "i", "v", 4, ["g"], block=3, exclude_same=True).collect()
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 300, 50):
        same = [j for j in range(300) if (j % 3 == 0) == (i % 3 == 0) and j != i]
        best = sorted(same, key=lambda j: (-round(float(n[i] @ n[j]), 6), str(j)))[:4]
        assert [int(r.item) for r in sorted((r for r in got if r.query == str(i)), key=lambda r: r.rank)] == best
    assert not [r for r in got if r.query == "900"]


def test_fusion_collapse_diversify(spark):
    sem = spark.createDataFrame([("q", "a", 0.9, 1), ("q", "b", 0.8, 2), ("q", "c", 0.8, 3)], "query string, item string, cosine double, rank int")
    lex = spark.createDataFrame([("q", "c", 5.0, 1), ("q", "z", 4.0, 2)], "query string, doc string, score double, rank int")
    w = {r.item: r.score for r in rt.fuse_weighted(sem, lex).collect()}
    assert w == {"a": 0.9, "b": 0.8, "c": 0.88}
    hits = rt.fuse_weighted(sem, lex).withColumn("parent", F.when(F.col("item") == "a", "p").otherwise("r"))
    c = rt.collapse(hits, "parent", 2).orderBy("rank").collect()
    assert [(r.parent, r.item, r.children) for r in c] == [("p", "a", ["a"]), ("r", "c", ["c", "b"])]
    many = spark.createDataFrame([("q", f"i{i}", "R" if i < 4 else f"S{i}", i + 1) for i in range(20)], "query string, item string, rec string, rank int")
    d = rt.diversify(many, "rec").orderBy("final_rank").collect()
    assert len(d) == 12 and [r.item for r in d][:3] == ["i0", "i1", "i4"]


def test_latest_upsert_digest_checks(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "k int, v int, t string")
    assert sorted(map(tuple, tb.latest(df, ["k"], ["v"]).collect())) == [(1, 2, "b"), (2, 1, None)]
    new = spark.createDataFrame([(2, 5, "n"), (3, 1, "m")], "k int, v int, t string")
    assert sorted(map(tuple, tb.upsert(tb.latest(df, ["k"], ["v"]), new, ["k"]).collect())) == [(1, 2, "b"), (2, 5, "n"), (3, 1, "m")]
    a = tb.table_digest(df, ["k", "v", "t"]).first()
    b = tb.table_digest(df.orderBy(F.desc("v")).repartition(3), ["k", "v", "t"]).first()
    assert a == b and a.n_rows == 3 and tb.table_digest(df.filter("k > 1"), ["k", "v", "t"]).first().digest != a.digest
    assert tb.table_digest(df.limit(0), ["k"]).first().n_rows == 0
    err = tb.checks(df, "k", {"text": F.col("t").isNotNull(), "positive": F.col("v") > 0})
    assert [tuple(r) for r in err.collect()] == [(2, "text")]
    assert tb.all_or_nothing(df, err).count() == 0 and tb.all_or_nothing(df, err.limit(0)).count() == 3


def test_text_functions(spark):
    df = spark.createDataFrame([("Ärzte-\nhaus  und Cinnamomum camphora 12",)], "t string")
    r = df.select(tx.fold(F.col("t")).alias("f"), tx.joined_quote(F.col("t")).alias("q"), tx.slug(F.lit("A b--C!")).alias("s"), tx.html_text(F.lit("<p>a&amp;b <b>c</b></p>")).alias("h"), tx.query_terms(F.lit("von Öl 一二三四五六七 ab")).alias("qt"), tx.citations(F.lit("x [E2, E1] y [E2]")).alias("c")).first()
    assert r.f.startswith("arzte-") and r.q == "Ärztehaus und Cinnamomum camphora 12" and r.s == "a-b-c" and r.h == "a&b c" and r.c == [2, 1]
    assert r.qt[:2] == ["von", "一二三四"] and "ab" not in r.qt and "六七" in r.qt
    assert df.select(nm.binomial(F.lit("of CORNENIA × Lutana L.")).alias("b")).first().b == "Cornenia lutana"


def test_names(spark):
    e = spark.createDataFrame([(1, "Aus bus"), (2, "Cus dus"), (3, "Eus fus"), (4, None)], "id int, n string")
    m = spark.createDataFrame([("Aus bus", "Aus bus", "accepted"), ("Cus dus", "Cus novus", "alias"), ("Eus fus", "Gus fus", "alias")], "name string, accepted string, kind string")
    got = {r.id: (r.status, r.accepted) for r in nm.resolve(e, m, "id", "n").collect()}
    assert got == {1: ("accepted", "Aus bus"), 2: ("alias", "Cus novus"), 3: ("unresolved", None), 4: ("unresolved", None)}
    s1 = spark.createDataFrame([(1, "A"), (2, None)], "id int, accepted string")
    s2 = spark.createDataFrame([(1, "B"), (2, "C")], "id int, accepted string")
    assert {r.id: (r.accepted, r.step) for r in nm.cascade(e, [s1, s2], "id").collect()} == {1: ("A", 1), 2: ("C", 2), 3: (None, None), 4: (None, None)}


def test_page_rules_at_their_limits(spark):
    rows = [(1, "a" * 7), (2, "a" * 8), (3, "ab " * 39 + "ab"), (4, "ab " * 18 + "x" * 70), (5, None), (6, "\n".join(["abc"] * 40 + ["a long line of words here"] * 20))]
    df = pg.with_metrics(spark.createDataFrame(rows, "i int, best_text string")).withColumn("q", pg.quality())
    assert {r.i: r.q for r in df.collect()} == {1: "empty", 2: "low_text", 3: "low_text", 4: "usable", 5: "empty", 6: "fragmented"}


def test_metrics_and_selection(spark):
    h = spark.createDataFrame([("a", 1, 0.9, False), ("a", 2, 0.8, True), ("b", 1, 0.7, False)], "query string, rank int, cosine double, relevant boolean")
    m = {r.query: r for r in rt.ranking_metrics(h).collect()}
    assert (m["a"].mrr, m["a"].recall_at_1, m["a"].recall_at_3, m["a"].margin) == (0.5, 0, 1, -0.1)
    assert (m["b"].mrr, m["b"].first_relevant_rank, m["b"].margin) == (0.0, None, -1.7)


def test_spans_to_next(spark):
    rng = random.Random(9)
    starts = {k: sorted(rng.sample(range(2000), 40)) for k in "ab"}
    df = spark.createDataFrame([(k, p) for k, ps in starts.items() for p in ps], "k string, p int")
    ends = spark.createDataFrame([("a", 2500), ("b", 2600)], "k string, last int")
    got = {(r.k, r.p): (r.next_start, r.end_page) for r in spans.spans_to_next(df, "k", "p", ends, "last", width=64).collect()}
    for k, ps in starts.items():
        for p, n in zip(ps, [*ps[1:], None]):
            assert got[k, p] == (n, n - 1 if n else {"a": 2500, "b": 2600}[k])
