from pyspark.sql import functions as F

from foliant.operators import boundaries as bd
from foliant.operators import gates as gt
from foliant.operators import receipts as rc
from foliant.operators import retrieval as rt
from foliant.operators import tables as tb
from foliant.plans.engine import EvidenceEngine
from foliant.sources import readers as rd

BASE = "item string, parent string, record string, space string, v array<double>"


def test_hybrid_reaches_beyond_any_depth(spark):
    # a hundred children of one parent are nearest; the lexical hit lies behind them all, and so do the other parents
    rows = [(f"a{i:03d}", "A", "R", "s", [1.0, 0.0005 * i]) for i in range(100)] + [("b", "B", "R", "s", [1.0, 0.30]), ("c", "C", "S", "s", [1.0, 0.31]), ("d", "D", "S", "s", [1.0, 0.9]), ("e", "E", "S", "t", [1.0, 0.0])]
    base = spark.createDataFrame(rows, BASE).repartition(7)
    q = spark.createDataFrame([("q", "s", [2.0, 0.0])], "query string, space string, v array<double>")
    lex = spark.createDataFrame([("q", "d", 1), ("q", "e", 2), ("q", "c", 20)], "query string, doc string, rank int")
    hits = rt.hybrid_parents(base, q, lex, 3)
    assert [(r.parent, r.item) for r in hits.orderBy("rank").collect()] == [("A", "a000"), ("C", "c"), ("B", "b")]
    all_ = {r.parent: r.score for r in rt.hybrid_parents(base, q, lex, 9).collect()}
    assert set(all_) == {"A", "B", "C", "D"} and abs(all_["D"] - round(1 / (1 + 0.81) ** 0.5, 6) - 0.08) < 1e-9
    kids = {r.parent: r for r in rt.best_children(hits, base, q, lex, most=3).collect()}
    assert kids["A"].n_children == 100 and kids["A"].children == ["a000", "a001", "a002"] and kids["C"].children == ["c"]
    assert rt.hybrid_parents(base.limit(0), q, lex, 3).count() == 0 and rt.hybrid_parents(base, q.limit(0), lex, 3).count() == 0
    blocks = rt.hybrid_parents(base, q.unionByName(q.withColumn("query", F.lit("r"))), lex, 3, block=1)
    assert blocks.filter("query = 'q'").count() == 3 and {r.parent for r in blocks.filter("query = 'r'").collect()} == {"A", "B", "C"}


def test_ranked_evidence_and_selection(spark):
    rows = [("p", f"i{i:02d}", "s", [1.0, 0.1 * i], "with senegin" if i in (3, 7) else "nothing") for i in range(10)] + [("w", "j0", "s", [1.0, 0.0], "Senegin here"), ("w", "j1", "s", [1.0, 0.5], "no")]
    base = spark.createDataFrame(rows, "profile string, item string, space string, v array<double>, text string").repartition(5)
    q = spark.createDataFrame([("q", "s", [1.0, 0.0], ["senegin"]), ("n", "s", [1.0, 0.0], ["absent"]), ("z", "s", [1.0, 0.0], None)], "query string, space string, v array<double>, terms array<string>")
    got = {(r.profile, r.query): r for r in gt.ranked_evidence(base, q).collect()}
    assert got["p", "q"].first_relevant_rank == 4 and got["p", "q"].relevant == 2 and got["w", "q"].first_relevant_rank == 1 and got["p", "n"].first_relevant_rank is None
    status = spark.createDataFrame([("q", "answerable"), ("n", "refused"), ("z", "refused")], "query string, expected_status string")
    m = gt.query_metrics(gt.ranked_evidence(base, q), status)
    chunks = spark.createDataFrame([("p", "src", 1)] * 10 + [("w", "src", 2)] * 2, "profile string, source_id string, pdf_page int")
    p = gt.profile_metrics(m, chunks)
    assert tuple(gt.select_profile(p).first()) == ("w", "promote") and tuple(gt.select_profile(p.filter("profile = 'p'")).first()) == (None, "hold_for_evidence")
    assert tuple(gt.select_profile(p.limit(0)).first()) == (None, "hold_for_evidence")


def test_selection_rules(spark):
    ev = spark.createDataFrame([("q", 1, "r1", "Die Wurzel ent-\nhält viel Harz und Schleim."), ("q", 2, "r1", "anderes"), ("q", 3, "r2", "Die Blüten sind ganz und gar grün.")], "query string, ordinal int, record_id string, text string")
    bad = ['{"items": "x"}', "no json", '{"items":[{"evidence_ids":[1,3],"support_quote":"Die Wurzel enthält viel Harz"}]}', '{"items":[{"evidence_ids":[],"support_quote":"Die Wurzel enthält viel Harz"}]}', '{"items":[{"evidence_ids":[1],"support_quote":"Die Wurzel"}]}', '{"items":[{"evidence_ids":[4],"support_quote":"Die Wurzel enthält viel Harz"}]}']
    for payload in bad:
        assert gt.valid_selections(spark.createDataFrame([("q", payload)], "query string, payload string"), ev).count() == 0, payload
    good = '{"items":[{"evidence_ids":[2,1,2],"support_quote":"Wurzel enthält viel Harz und"},{"evidence_ids":[1],"support_quote":"Die Wurzel enthält viel Harz"},{"evidence_ids":[3],"support_quote":"Blüten sind ganz und gar"}]}'
    got = gt.valid_selections(spark.createDataFrame([("q", good)], "query string, payload string"), ev).orderBy("place").collect()
    assert [(r.record_id, r.evidence_ids) for r in got] == [("r1", [2, 1]), ("r2", [3])]


def test_pairs_and_citations(spark):
    t = spark.createDataFrame([(1, "見銀露藤（Calvarium crenana L.）與龍（Aus bus）。"), (2, None), (3, "none")], "k int, t string")
    allowed = spark.createDataFrame([("見銀露藤", "Calvarium Crenana"), ("與龍", "Cus dus"), ("x", "One")], "display string, scientific string")
    assert {(r.display, r.authorized) for r in gt.entity_pairs(t, "k", "t", allowed).collect()} == {("見銀露藤", True), ("與龍", False)}
    d = spark.createDataFrame([(1, "r", "A [E2, E1] b [E9] c [E1,E9]."), (2, "r", "none"), (3, "s", "x [E1]")], "k int, rec string, t string")
    ev = spark.createDataFrame([("r", 1, "one"), ("r", 2, "two")], "record string, ordinal int, label string")
    assert {r.k: r.rendered for r in gt.rendered_citations(d, "k", "t", "rec", ev).collect()} == {1: "A [two; one] b [E9] c [one].", 2: "none", 3: "x [E1]"}


def test_boundary_mutations(spark):
    cols = "id int, local_taxon string, external_taxon string, local_order int, external_order int, local_score int, external_score int, fuzzy boolean, on_page boolean, structural boolean, is_start boolean"
    base = (1, "aus bus", "aus bus", 0, 0, 3, 3, False, False, True, False)
    rows = [base, (2, *base[1:9], False, False), (3, *base[1:10], True), (4, "aus bus", "cus dus", 5, 1, 0, 3, False, False, True, False), (5, "aus bus", "cus dus", 5, 5, 0, 3, False, False, True, False), (6, "aus bus", "cus dus", 5, 5, 0, 3, False, True, True, False),
            (7, None, "cus dus", None, 1, 0, 1, True, True, True, False), (8, None, "cus dus", None, 2, 0, 1, True, True, True, False), (9, None, None, None, None, 0, 0, False, False, True, False), (10, "aus bus", "cus dus", 0, 0, 3, 3, False, False, True, False)]
    got = {r.id: r.decision for r in bd.boundary_decision(spark.createDataFrame(rows, cols)).collect()}
    hidden, needs = "confirmed_hidden_heading", "candidate_needs_secondary_evidence"
    assert got == {1: hidden, 2: needs, 3: "confirmed_parent_heading", 4: hidden, 5: needs, 6: hidden, 7: hidden, 8: needs, 9: "no_page_heading_detected", 10: needs}
    h = spark.createDataFrame([("s", 10, "aus bus"), ("s", 20, "cus dus"), ("t", 5, "x y")], "source_id string, page int, taxon string")
    n = spark.createDataFrame([("s", 11, "aus bus"), ("s", 12, "aus bus"), ("s", 21, "cus dus")], "source_id string, page int, taxon string")
    assert {r.source_id: (r.shift, r.score, r.winners) for r in bd.page_offset(h, n).collect()} == {"s": (1, 4, 1), "t": (None, 0, 0)}


def test_receipts(spark):
    a = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k3", None)], "k string, a string")
    hops = [("one", spark.createDataFrame([("x", "p"), ("y", "q")], "a string, b string"), "a", "b"), ("two", spark.createDataFrame([("p", "z")], "b string, c string"), "b", "c")]
    assert {r.k: r.broken_at for r in rc.follow_chain(a, hops).collect()} == {"k1": None, "k2": "two", "k3": "one"}
    s = spark.createDataFrame([("p", i, st) for i, st in enumerate(["ok", "blank", "ok"])] + [("q", 0, "ok"), ("q", 1, "bad"), ("r", 0, "ok")], "k string, i int, st string")
    assert {r.k: (r.state, r.kept, r.dropped) for r in rc.drop_only_repair(s, "k", "i", "st").collect()} == {"p": ("repaired", [0, 2], [1]), "q": ("unrepairable", [0], [1]), "r": ("pass", [0], [])}
    x = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    y = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    once = sorted(map(tuple, rc.replay([x, y], ["id"]).collect()))
    assert once == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, rc.replay([x, y, x.limit(0), y], ["id"]).collect()))
    assert sorted(map(tuple, rc.both_ways(x.unionByName(x), x).collect())) == [(1, "a", "missing"), (2, "b", "missing")]
    assert tb.table_digest(x, ["id", "v"]).first().digest != tb.table_digest(x.unionByName(x), ["id", "v"]).first().digest


def test_rows_of_recognised_lines(spark):
    # two boxes on both sides of any bucket edge stand in one row; a row goes on while the gaps are small
    boxes = [(0.5001, 0.6, "b"), (0.4999, 0.1, "a"), (0.9, 0.5, "top"), (0.4889, 0.3, "mid"), (0.40, 0.1, "last")]
    df = spark.createDataFrame([(1, boxes), (2, []), (3, None)], "k int, l array<struct<y:double,x:double,text:string>>")
    got = {r.k: r.text for r in rd.recognised_lines(df, "k", "l").collect()}
    assert got[1] == "top\na\nmid\nb\nlast" and got[2] == ""


def test_engine_retrieves_and_responds(spark):
    e = EvidenceEngine(spark)
    rows = [(f"c{i}", f"p{i // 2}", f"r{i // 6}", [1.0, 0.1 * i], "s", "approved" if i % 5 else "hidden", "prof", f"text with senegin {i}" if i == 3 else f"text {i}") for i in range(20)]
    chunks = spark.createDataFrame(rows, "chunk_id string, parent string, record string, vec array<double>, vector_space_id string, review_status string, profile_id string, source_text string")
    q = spark.createDataFrame([("q", "text", [1.0, 0.0], "s"), ("w", "which of all texts", [1.0, 0.0], "s")], "query_id string, question string, vec array<double>, vector_space_id string")
    settings = spark.createDataFrame([("active_review_statuses", "approved,other"), ("active_chunk_profile", "prof")], "key string, value string")
    index = e.build_index(chunks)
    hits = e.retrieve(chunks, index, q, settings, 3, F.col("question").contains("all"))
    got = {k: [r.item for r in hits.filter(F.col("query") == k).orderBy("final_rank").collect()] for k in "qw"}
    assert len(got["q"]) == 3 and "c0" not in got["q"] + got["w"] and len(got["w"]) == 7
    texts = chunks.select("parent", F.col("source_text").alias("text"))
    req = spark.createDataFrame([("q", ["senegin"])], "query string, terms array<string>")
    ans = {r.query: r for r in e.respond(e.retrieve(chunks, index, q, settings, 3), texts, req).collect()}
    assert ans["q"].status == "answerable" and ans["w"].status == "hold_for_evidence" and [x.label for x in ans["q"].evidence] == ["E1", "E2", "E3"]
    assert tuple(e.health(chunks).first()) == ("s", 20, 20, True)
