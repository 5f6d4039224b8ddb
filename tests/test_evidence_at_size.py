"""Ranked evidence whose work per question doesn't read the texts again."""

import random

import numpy as np
import pyarrow as pa

from foliant.operators import gates as gt


def test_terms_are_found_as_in_each_text():
    terms = ["contain", "ain", "山柔", "x y", "山柔治", "zz9"]
    texts = ["it contains rain", "", "wo 山柔治牙 x y", "山柔, 治", "xy zz9zz9", "a\nin ain"]
    want = {i: [n for n, x in enumerate(texts) if t in x] for i, t in enumerate(terms)}
    for most in (500_000, 3):  # little room: runs are forgotten
        finder = gt.TermFinder(terms, most)
        for _ in range(2):
            assert {i: x.tolist() for i, x in finder.holders(texts).items()} == {i: x for i, x in want.items() if x}


def test_ranked_evidence_matches_brute_force_on_ties(spark):
    rng = random.Random(2)
    vec = lambda: [float(rng.randrange(-2, 3)) for _ in range(2)] + [1.0]
    words = ["alpha", "beta", "gamma", "delta", "山柔治"]
    rows = [(rng.choice("ab"), f"i{i:03d}", "s", vec(), " ".join(rng.choices(words, k=2))) for i in range(300)]
    qs = [(f"q{i}", "s", vec(), rng.choice([["alph"], ["beta", "山柔"], ["none"], None, ["a"]])) for i in range(300)]
    base = spark.createDataFrame(rows, "profile string, item string, space string, v array<double>, text string").repartition(3)
    got = {(r.profile, r.query): r for r in gt.ranked_evidence(base, spark.createDataFrame(qs, "query string, space string, v array<double>, terms array<string>")).collect()}
    assert len(got) == 600
    for q, _, v, terms in qs:
        for p in "ab":
            own = sorted((-round(float(np.dot(v, x) / np.sqrt(np.dot(v, v) * np.dot(x, x))), 6), i, any(t in text for t in terms or [])) for profile, i, _, x, text in rows if profile == p)
            first = next((n + 1 for n, x in enumerate(own) if x[2]), None)
            top = [next((-s for s, _, rel in own if rel == wanted), None) for wanted in (True, False)]
            r = got[p, q]
            assert (r.chunks, r.relevant, r.first_relevant_rank, r.top_relevant, r.top_other) == (len(own), sum(x[2] for x in own), first, *top)


def test_each_different_run_is_searched_once():
    finder, searched = gt.TermFinder([f"term{i}" for i in range(2000)]), []
    learn = finder.learn
    finder.learn = lambda runs: searched.extend(runs) or learn(runs)
    for _ in range(2):
        held = finder.holders([f"a text with term{i % 7}" for i in range(5000)])
    assert len(searched) == len(set(searched)) == 10 and sum(map(len, held.values())) == 5000


def test_the_parts_of_a_run_are_looked_up_once_however_many_terms():
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    finder = gt.TermFinder([f"term{i:05d}" for i in range(20_000)])
    finder.inside = {script: {n: Counted(terms) for n, terms in by.items()} for script, by in finder.inside.items()}
    held = finder.holders([f"xterm{i:05d}y" for i in range(50)])
    assert held.keys() == set(range(50)) and Counted.asked == 150


def test_a_task_sends_a_row_per_question_whatever_its_batches():
    rng = np.random.default_rng(7)
    unit = lambda n: (x := rng.integers(-2, 3, size=(n, 3)) + [0, 0, 0.5]) / np.linalg.norm(x, axis=1, keepdims=True)
    qm, wanted, rows = unit(9), [(0,), (1,), (), (0, 1), (2,)] + [(0,)] * 4, []

    def parts():
        for n in range(12):
            x, texts, items = unit(40), [["alpha", "beta", "none"][i] for i in rng.integers(0, 3, 40)], [f"i{(n * 7) % 12:02d}{i:02d}" for i in range(40)]
            rows.extend(zip(items, x, texts))
            own = pa.RecordBatch.from_arrays([pa.array(["p"] * 40), pa.array(items), pa.array(["s"] * 40), pa.array(x.tolist()), pa.array(texts)], names=list("pisvt"))
            yield "p", ("s", 3), x, own, iter([(0, qm, qm.astype(np.float32) @ x.astype(np.float32).T)])

    terms = ["alph", "beta", "zz"]
    got = pa.Table.from_batches(gt.best_evidence(parts(), terms, {("s", 3): wanted}, {("s", 3): 0})).to_pylist()
    assert len(got) == 9
    for r in got:
        rel = [(-round(float(qm[r["q"]] @ x), 6), i) for i, x, t in rows if any(terms[w] in t for w in wanted[r["q"]])]
        other = [round(float(qm[r["q"]] @ x), 6) for i, x, t in rows if not any(terms[w] in t for w in wanted[r["q"]])]
        first = min(rel) if rel else (None, None)
        assert (r["chunks"], r["relevant"], r["item"]) == (480, len(rel), first[1]) and r["cosine"] == (-first[0] if rel else None) and r["other"] == max(other)
