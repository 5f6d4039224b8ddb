import json
import math
import random

import numpy as np
from pyspark.sql import functions as F

from foliant.llm import knn, mixing, scans, truncation

CHUNKS = "chunk_id string, embedding_json string, dimensions int, vector_space_id string"


def brute(vecs, k):
    """id -> set of the k best by (cosine, id)."""
    ids = sorted(vecs)
    x = np.stack([vecs[i] / np.linalg.norm(vecs[i]) for i in ids])
    s = np.round(x @ x.T, 5)
    return {i: {ids[m] for m in sorted((m for m in range(len(ids)) if m != j), key=lambda m: (-s[j, m], ids[m]))[:k]} for j, i in enumerate(ids)}


def test_recall_and_copies(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 24))
    vecs = {f"v{i:05d}": centres[i % 60] + 0.2 * rng.standard_normal(24) for i in range(3000)}
    hot = rng.standard_normal(24)
    copies = {f"h{i:05d}": hot for i in range(1200)}  # one vector in more than a quarter of the rows
    rows = [(i, json.dumps(v.tolist()), 24, "s") for i, v in (vecs | copies).items()]
    rows += [rows[0], ("n1", None, 24, "s"), ("n2", "", 24, "s"), ("n3", "[1,2]", 24, "s"), ("n4", json.dumps([0.0] * 24), 24, "s"), ("n5", "[NaN" + ",1" * 23 + "]", 24, "s"), ("n6", "[1e400" + ",1" * 23 + "]", 24, "s"), ("lone", "[1.0, 2.0]", 2, "t"), (None, rows[0][1], 24, "s")]
    df = spark.createDataFrame(rows, CHUNKS).withColumn("id", F.lit(1)).withColumn("vec", F.lit(2))
    got = {}
    for r in knn.most_similar(df, k=5, list_rows=100, group_rows=500).collect():
        got.setdefault(r.id, set()).add(r.near_id)
    want = brute(vecs, 5)
    hits = sum(len(got[i] & want[i]) for i in vecs) / (5 * len(vecs))
    assert hits >= 0.9, hits
    h = sorted(copies)
    for i in h[:3] + h[-3:]:
        assert got[i] == set([x for x in h[:6] if x != i][:5])
    assert not {"n1", "n2", "n3", "n4", "n5", "n6", "lone", None} & set(got)
    pairs = knn.similar_pairs(df, k=5, list_rows=100, group_rows=500)
    p = [(r.id_a, r.id_b) for r in pairs.collect()]
    assert len(p) == len(set(p)) and all(a < b for a, b in p)
    assert knn.similar_pairs(df.limit(0)).count() == 0


def test_blocks_give_the_same(spark):
    rng = np.random.default_rng(4)
    rows = [(f"v{i:04d}", json.dumps(rng.standard_normal(8).round(4).tolist()), 8, "s") for i in range(600)]
    q = [(f"q{i}", json.dumps(rng.standard_normal(8).round(4).tolist()), 8, "s" if i else "none") for i in range(9)]
    c, qs = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(q, CHUNKS.replace("chunk_id", "query_id"))
    one = sorted(map(tuple, knn.most_similar(c, qs, 5, list_rows=1000).collect()))
    cut = sorted(map(tuple, knn.most_similar(c, qs, 5, list_rows=1000, task_rows=100).collect()))
    assert one == cut and not [r for r in one if r[0] == "q0"]
    v = {k: np.array(json.loads(j)) for k, j, _, _ in rows}
    want = brute(v, 5)
    got = {}
    for i, is_chunk, n, _ in one:
        if is_chunk:
            got.setdefault(i, set()).add(n)
    assert sum(len(got[i] & want[i]) for i in v) >= 0.999 * 5 * len(v)


def test_spellings():
    assert np.allclose(knn.parse_vector(" [ 3 , 4e0 ]\n", 2), [0.6, 0.8])
    assert all(knn.parse_vector(t, d) is None for t, d in (("[1,2]", 3), ("[1,true]", 2), ("{}", 2), ("[[1],2]", 2), ("[1,2", 2), ("[1,2]", None), ("[Infinity,1]", 2), ('["1",2]', 2)))


LINES = "Die Blätter sind an der Basis grünlich und gegen die Spitze hin\nviolett gefärbt. Unter dem Mikroskop lassen die Zellen der Rinde\nSchleim und vereinzelt Harz erkennen. Man benutzt die Wurzeln als\nTee gegen Husten und Fieber."


def page(i, head, foot="", body=LINES):
    return (i, i, "\n".join(x for x in (head, body, foot) if x), None)


def test_scan_repairs(spark):
    rows = [page(i, "Flora der Heilgewächse    %d" % i if i % 2 else "", "" if i % 2 else "— %d —" % i) for i in range(1, 81)]
    rows += [
        page(101, "101    Aus busella", "Herbal. Bd. 3.   22*"),
        page(102, "", "[102]", LINES.replace("Wurzeln", "Wur-\nzeln").replace("Mikroskop", "Mikro¬\nskop")),
        page(103, "", "", LINES.replace("grünlich", "griinlich").replace("Unter", "Uuter").replace("Husten", "Hnsten")),
        page(104, "", "", LINES + "\nWird die Jod-\nTinktur gemischt, so entsteht ein Niederschlag."),
        (105, 105, "Tafel IX\nAus busella", None),
        (106, 106, "", None),
        (107, 107, None, "· "),
        (108, None, LINES, LINES),
        (103, 103, page(103, "", "", LINES.replace("grünlich", "griinlich"))[2], None),
    ]
    df = spark.createDataFrame(rows, "page_id long, pdf_page int, embedded_text string, ocr_text string").withColumn("kind", F.lit("x")).withColumn("word", F.lit(1))
    got = {(r.page_id, r.kind, r.word_or_line) for r in scans.page_findings(df).collect()}
    of = lambda i: {(k, w) for p, k, w in got if p == i}
    assert of(101) == {("dropped", "101    Aus busella"), ("dropped", "Herbal. Bd. 3.   22*")}
    assert of(102) == {("dropped", "[102]"), ("joined", "Wurzeln"), ("joined", "Mikroskop")}
    assert of(103) == {("corrected", "grünlich"), ("corrected", "Husten")}
    assert of(104) == set() and of(105) == set() and of(106) == set() and of(107) == set() and of(108) == set()
    assert all(of(i) == {("dropped", f"Flora der Heilgewächse    {i}" if i % 2 else f"— {i} —")} for i in range(1, 81))
    few = {(r.page_id, r.kind, r.word_or_line) for r in scans.page_findings(df, top_words=5).collect()}
    assert few == got  # words beyond the broadcast take the join
    assert scans.page_findings(df.limit(0)).count() == 0
    text = {(r.page_id, r.text_field): r.repaired_text for r in scans.repaired_pages(df).collect()}
    whole = LINES.replace("\n", " ")
    assert text[101, "embedded_text"] == text[102, "embedded_text"] == whole and text[5, "embedded_text"] == text[6, "embedded_text"] == whole
    assert text[103, "embedded_text"] == whole.replace("Unter", "Uuter") or text[103, "embedded_text"] == whole
    assert text[104, "embedded_text"] == whole + " Wird die Jod-Tinktur gemischt, so entsteht ein Niederschlag." and text[106, "embedded_text"] == ""


def test_rates():
    r = mixing.repetition_rates({"a": 100, "b": 10, "c": 50}, [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 9), ("d", 0.0, 3), ("e", 0.1, 3)], 160)
    assert r["b"] == 2.0 and r["d"] == r["e"] == 0.0 and math.isclose(100 * r["a"] + 20 + 50 * r["c"], 160) and r["a"] <= 1.0
    assert mixing.repetition_rates({}, [("a", 1.0, 1)], 10) == {"a": 0.0}


def test_mixture(spark):
    docs = [(i, f"text number {i} of the first source with words", "a") for i in range(400)] + [(1000 + i, f"ein anderer Text Nummer {i}", "b") for i in range(40)]
    docs += [(2000, "text number 1 of the first source with words", "a"), (2001, None, "a"), (2002, "", "b"), (2003, "no target", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit(1)).withColumn("copy", F.lit(1))
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    members, report = mixing.mixture(d, t)
    m = members.toPandas()
    assert m.groupby("doc_id").size().max() == 3 and not set(m.doc_id) & {2000, 2001, 2002, 2003}
    assert (m[m.source == "a"].groupby("doc_id").size() <= 1).all()
    r = {x.source: x for x in report.collect()}
    assert r["none"].tokens == 0 and r["b"].rate == 3.0 and abs(sum(x.actual_share for x in r.values()) - 1) < 1e-4
    assert sorted(map(tuple, mixing.mixture(d.repartition(5), t)[0].collect())) == sorted(map(tuple, members.collect()))
    assert mixing.mixture(d.limit(0), t)[0].count() == 0


def test_truncation(spark):
    whole = "Die Blätter sind an der Basis grünlich und gegen die Spitze hin violett gefärbt. Unter dem Mikroskop lassen die Zellen der Rinde Schleim erkennen."
    docs = [(i, f"{whole} Man gibt {i} g.", "s") for i in range(60)]
    docs += [(100 + i, f"{whole}{' Man gibt 3 g.' * i}\n\nGez. Hallwart", "letters") for i in range(8)]
    docs += [(200, whole[:70], "s"), (201, whole[:66], "s"), (202, "Unter dem Mikroskop lassen die", None), (203, None, "s"), (204, "", "s"), (205, "\n".join("• Samen von Aus bus" for _ in range(9)), "s"), (206, whole + "“", "s"), (202, "Unter dem Mikroskop lassen die", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("evidence", F.lit(1)).withColumn("last", F.lit(1))
    got = truncation.truncated(d).collect()
    assert sorted(r.doc_id for r in got) == [200, 201, 202, 202]
    by = {r.source: (r.documents, r.cut_documents, r.cut_share) for r in truncation.truncation_by_source(d).collect()}
    assert by[None] == (2, 2, 1.0) and by["letters"] == (8, 0, 0.0)
    assert truncation.truncated(d.limit(0)).count() == 0
    ends = [whole + " und s\\u00", whole + " und s&auml", whole + " und <i", whole + " \ufffd", whole + " &", whole + " a < b."]
    e = spark.createDataFrame([(i, t, "s") for i, t in enumerate(ends)], "doc_id long, text string, source string")
    assert {r.doc_id: r.evidence for r in truncation.truncated(e).collect()} == {0: "escape", 1: "escape", 2: "escape", 3: "escape"}
    rng = random.Random(5)
    words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(4, 9))) for _ in range(300)]
    run = lambda n: " ".join(rng.choice(words) for _ in range(n))
    limit = [(i, run(90)[:400].rstrip().ljust(400, "x"), "f") for i in range(30)] + [(500 + i, run(rng.randint(15, 45)) + ".", "f") for i in range(200)]
    f = truncation.truncated(spark.createDataFrame(limit, "doc_id long, text string, source string"))
    assert {r.doc_id for r in f.collect()} == set(range(30))
    long = spark.createDataFrame([(1, whole * 3000, "s"), (2, whole * 300 + " Unter dem Mikro", "s")], "doc_id long, text string, source string")
    assert [r.doc_id for r in truncation.truncated(long).collect()] == [2]
