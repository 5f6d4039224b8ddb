import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.llm import leakage, quality, splitting

PROSE = "Die Blätter sind an der Basis grünlich und gegen die Spitze hin violett gefärbt.\n" * 4
PAGES = [
    (1, PROSE, "prose"),
    (2, "\n".join(f"• Kapseln von Aus bus{i}" for i in range(12)), "structured"),
    (3, "\n".join(f"Aus bus{i}\t{i}.5\t{i}\tMai" for i in range(12)), "structured"),
    (4, "\n".join(f"Aus bus . . . . . {i}" for i in range(12)), "structured"),
    (5, "\n".join(x for i in range(30) for x in ("Calbecarpus", f"{i},9", "50", "ja")), "structured"),
    (6, "xkcd qwrt zzvb " * 20, "junk"),
    (7, "~<*;{}^|= " * 30, "junk"),
    (8, "", "short"),
    (9, None, "short"),
    (10, "   \n \n", "short"),
    (11, PROSE + "1. Aus bus\n2. Cus dus", "prose"),
    (12, PROSE * 2000, "prose"),
    (13, "ll ll ll ll ll ll ll ll ll\n" * 8, "junk"),
]


def test_classes_and_edges(spark):
    df = spark.createDataFrame(PAGES, "page_id int, best_text string, want string").withColumn("word_count", F.lit(-1)).withColumn("quality", F.lit("stale"))
    df = df.unionByName(df.filter("page_id = 1"))  # a page delivered twice
    got = quality.page_quality(df).collect()
    assert len(got) == len(PAGES) + 1
    assert {r.page_id: r.text_class for r in got} == {i: w for i, _, w in PAGES}
    for r in got:
        text = (r.best_text or "").strip()
        assert r.word_count == len(re.findall(r"[^\W_]+(?:[-'][^\W_]+)*", text)) and r.character_count == len(text) and r.quality != "stale"
        assert (r.text_class == "prose") == (not r.failed_rules)
    assert quality.page_quality(df.limit(0)).count() == 0
    assert {r.page_id for r in quality.not_prose(df).collect()} == {i for i, _, w in PAGES if w in ("structured", "junk")}


def test_leaks_match_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(30)), "de") for i in range(12)]
    items += [(50, "參照圖五十一請依頁判斷雲香之樹皮為何七十八日後轉為鮮紅色不計光滑的莖", "zh"), (60, "kurz", "de"), (61, None, "de"), (62, items[0][1], "en")]
    docs = []
    for d in range(200):
        w = [rng.choice(words) for _ in range(60)]
        if d % 3 == 0:
            src = items[d % 12][1].split()
            n = rng.choice((12, 13, 20, 30))
            a = rng.randrange(0, 31 - n)
            w[20 : 20 + n] = src[a : a + n]
        docs.append((d, (", " if d % 2 else " ").join(w).upper() if d % 5 == 0 else "  ".join(w)))
    docs += [(900, "前文。" + items[12][1][:24] + "後文"), (901, items[12][1][:23]), (902, None), (903, ""), (904, items[3][1]), (904, items[3][1])]
    grams = {}
    for i, t, lang in items:
        seq = (leakage.char_tokens(t) if lang == "zh" else leakage.word_tokens(t)) if t else []
        n = 24 if lang == "zh" else 13
        for j in range(len(seq) - n + 1):
            grams.setdefault((lang == "zh", tuple(seq[j : j + n])), set()).add(i)
    want = set()
    for d, t in docs:
        for zh, n in ((True, 24), (False, 13)):
            seq = (leakage.char_tokens(t) if zh else leakage.word_tokens(t)) if t else []
            for j in range(len(seq) - n + 1):
                want |= {(d, i) for i in grams.get((zh, tuple(seq[j : j + n])), ())}
    D = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(7)).withColumn("lang", F.lit("x"))
    E = spark.createDataFrame(items, "item_id long, text string, lang string")
    for shard in (2_000_000, 40):
        assert {(r.doc_id, r.item_id) for r in leakage.leaked_pairs(D, E, shard_tokens=shard).collect()} == want
    assert leakage.leaked_pairs(D, E.limit(0)).count() == 0 and leakage.leaked_pairs(D.limit(0), E).count() == 0
    spans = leakage.leaked_spans(D, E).filter("doc_id = 904").collect()
    assert all(r.span_end - r.span_start == r.match_tokens == 30 and r.coverage == 1.0 for r in spans)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .,\n。「」xX1ü", max_size=400), st.integers(1, 40), st.integers(0, 50))
def test_pieces_cover_and_overlap(text, limit, overlap):
    pieces = splitting.split_text(text, limit, overlap)
    units = [m.span() for m in splitting.UNIT.finditer(text)]
    assert pieces[0][0] == 0 and pieces[-1][1] == len(units)
    for us, ue, cs, ce, shared, _ in pieces:
        assert ue - us <= max(limit, 0) or len(units) <= limit
        if units:
            assert (cs, ce) == (units[us][0], units[ue - 1][1])
    for a, b in zip(pieces, pieces[1:]):
        assert b[0] == a[1] - min(overlap, limit - 1) and b[4] == min(overlap, limit - 1)


def test_cuts_at_natural_boundaries(spark):
    text = ("Erster Satz ist hier zu lesen. " * 6 + "\n\n" + "Ganz anderes Thema folgt danach jetzt. " * 6).strip()
    rows = [("a:c0", "p", text, 60, 10), ("a:c0", "p", text, 60, 10), ("b:c1", None, text, 60, None), ("c", "p", text, None, 3), ("d", "p", "kurz.", 60, 1), ("e", "p", None, 5, 1), ("f", "p", "", 5, 1), (None, "p", text, 5, 1), ("g", "p", "x" * 100_000 + " y" * 50_000, 1000, 100), ("h", "p", text, 0, 0)]
    df = spark.createDataFrame(rows, "chunk_id string, parent_chunk_id string, source_text string, target_token_units int, overlap_token_units int").withColumn("piece_text", F.lit(1)).withColumn("k", F.lit(2))
    got = splitting.split_oversized(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.chunk_id, []).append(r)
        assert r.unit_end - r.unit_start <= {"g": 1000}.get(r.chunk_id, 60)
    assert set(by) == {"a:c0", "b:c1", "g"} and {r.parent_chunk_id for r in by["b:c1"]} == {"b"} and {r.parent_chunk_id for r in by["a:c0"]} == {"p"}
    first = min(by["a:c0"], key=lambda r: r.piece_index)
    assert first.boundary == "sentence" and first.piece_text.endswith(".")
    assert {r.chunk_id for r in splitting.oversized_keys(df).collect()} == set(by)
    assert splitting.split_oversized(df.limit(0)).count() == 0
    assert splitting._ends_sentence(["Dr", ".", "Kess"], 1, 2, " ") is False
