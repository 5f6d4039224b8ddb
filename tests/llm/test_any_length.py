from pyspark.sql import functions as F

from foliant.llm import leakage, mixing, quality, splitting


def test_repetition_at_any_length(spark):
    phrase = "die Wurzeln sind braun und hart "  # six words
    texts = [(n, phrase * n) for n in (10, 60, 500, 540, 4000)] + [(-1, " ".join(f"Wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} der" for i in range(4000)))]
    got = {r.page_id: (r.text_class, r.failed_rules) for r in quality.page_quality(spark.createDataFrame(texts, "page_id int, best_text string")).collect()}
    assert all(got[n] == ("junk", ["repetition"]) for n in (60, 500, 540, 4000)) and got[-1][0] == "prose"


ITEM = "Die Blätter der Pflanze sind an der Basis grünlich und gegen die Spitze hin violett gefärbt und lang"


def test_spans_and_cleaned_texts(spark):
    plain = "Vorher steht etwas. " + ITEM + ". Nachher auch."
    odd = "Vorher: Straße ﬁn. " + ITEM.replace("ä", "ä").upper() + "! Ende"
    part = "Nur " + " ".join(ITEM.split()[:12]) + " reicht nicht."
    zh = "前文。參照圖五十一請依頁判斷雲香之樹皮為何七十八日後轉為鮮紅色，不計光滑的莖。後文"
    docs = [(1, plain), (2, odd), (3, part), (4, None), (5, ""), (1, plain), (6, zh), (7, ITEM), (8, plain + " Und nochmals: " + ITEM)]
    items = [(10, ITEM, "de"), (11, "參照圖五十一請依頁判斷雲香之樹皮為何七十八日後轉為鮮紅色不計光滑的莖", "zh"), (12, " ".join(ITEM.split()[3:]) + " sowie anderes mehr", "de")]
    D, E = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cleaned_text", F.lit("x")), spark.createDataFrame(items, "item_id long, text string, lang string")
    text = dict(docs)
    spans = leakage.leaked_spans(D, E).collect()
    for r in spans:
        if r.item_id == 10:
            assert leakage.word_tokens(text[r.doc_id][r.char_start : r.char_end]) == leakage.word_tokens(ITEM)
    assert {(r.doc_id, r.item_id) for r in spans} == {(d, i) for d in (1, 2, 7, 8) for i in (10, 12)} | {(6, 11)}
    for shard in (500_000, 10):
        rows = leakage.cleaned_documents(D, E, shard_tokens=shard).collect()
        assert sorted(r.doc_id for r in rows) == [1, 1, 2, 6, 7, 8]
        got = {r.doc_id: r for r in rows}
        assert got[1].cleaned_text == "Vorher steht etwas. . Nachher auch." and got[2].cleaned_text == "Vorher: Straße ﬁn. ! Ende" and got[6].cleaned_text.startswith("前文。") and got[6].cleaned_text.endswith("。後文")
        assert got[7].cleaned_text == "" and got[8].removed_spans == 2 and got[1].removed_chars == len(ITEM)
    assert leakage.cleaned_documents(D, E.limit(0)).count() == 0 and leakage.cleaned_documents(D.limit(0), E).count() == 0
    assert leakage.cleaned_documents(D, E, max_tokens=100).count() == 0


def test_piece_checks(spark):
    text = " ".join(f"Wort{i} steht hier." for i in range(200))
    df = spark.createDataFrame([("a:c0", "p", text, 60, 10), ("b:c1", None, "  " + text + "\n", 50, None), ("c", "p", "kurz.", 60, 1)], "chunk_id string, parent_chunk_id string, source_text string, target_token_units int, overlap_token_units int")
    got = {r.chunk_id: r for r in splitting.piece_checks(df).collect()}
    assert set(got) == {"a:c0", "b:c1"} and all(r.whole and r.within_limit and r.exact_overlap for r in got.values()) and len({r.rebuilt_md5 for r in got.values()}) == 1


def test_pattern_is_given(spark):
    df = spark.createDataFrame([(1, "it's 12 Worte…"), (2, None), (3, "")], "doc_id long, text string")
    n = {r.doc_id: r.tokens for r in mixing.with_token_counts(df).collect()}
    assert n[1] > 4 and n[2] == n[3] == 0
