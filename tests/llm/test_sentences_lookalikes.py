from pyspark.sql import functions as F

from foliant.llm import lookalikes, sentences

# texts with their sentences; | marks a boundary
TRUTH = [
    "Auf dem Markt ist die Pflanze nicht selten.|Die Blätter sind grün.|„Das Kraut hilft sicher!“ schreibt der Sammler.",
    "The roots of the plant are brown.|\"This herb never fails!\" wrote the collector.| Is it sold?|The seeds are red, e.g. those of A.B. Brown.",
    "Selon M. Gontrup (p. 3), les graines sont dures.|On les trouve ici.",
    "Die Knollen gehören, s. o., zur Abt. XXI der Sammlung von Prof. Lobrecht.| Man gibt 3,1 g pro dosi, bzw. 24 Tropfen.",
    "„Das Kraut hilft sicher!“ schreibt der Sammler Jarmund und lobt den Tee.| Die Ernte beginnt am 11. November und dauert ca. 2 Wochen.",
    "Der Verfasser bemerkt: „Die Blätter sind ohne Wirkung.“| Auf dem Querschnitt erscheinen die Knollen purpurn.",
    "Als Beimengungen fanden sich Samen, Wurzeln u. s. w.| Die Blätter sind grün.",
    "The dose is 2.6 grams, i.e. approx. 20 drops.| Dr. Overkamp states (vol. 22, p. 644) that it grows.| See No. 86 in Fig. 16.",
    "採集者寫道：「莖味道極苦，不可多服。」|採收後須陰乾22日。|每次用量為2.1克，約78滴！|民間用於咳嗽。",
    "「根は苦い。」と記録にある。|葉を煎じて用いる。",
    "« Elle guérit toujours ! » écrivait le marchand.| Certaines espèces, p. ex. Halbenum, ont des fleurs.| On les trouve ici.",
    "ดอกมีขนพบมากบนภูเขา| รากมีขนพบมากบนภูเขา",
    "هل تنفع الجذور في علاج السعال؟| تبلغ الجرعة 5.4 غرام مع الصمغ.| تنمو في الجبال.",
    "मात्रा 2.3 ग्राम है।| क्या पत्तियाँ लाभ देती हैं?| जड़ें मिलती हैं।",
    "Доза равна 3,2 г, т. е. около 4 капель (см. рис. 28).| Растение встречается в лесах.",
]


def corpus(spark):
    rows = [(f"t{i}", t.replace("|", "")) for i, t in enumerate(TRUTH)]
    names = ["Lobrecht", "Kessenow", "Hallwart", "Jarmund", "Gontrup", "Sielbeck"]
    months = ["Mai", "Juni", "November", "März"]
    for i in range(900):
        n, m = names[i % 6], months[i % 4]
        de = [f"Die Wurzeln gehören, s. o., zur Abt. XXI der Sammlung von Prof. {n}.", f"Man gibt {i},1 g pro dosi, bzw. 2 Tropfen.", f"Die Ernte beginnt am {i % 28}. {m} und dauert ca. 2 Wochen.", "Auf dem Markt ist die Pflanze nicht selten.", "Der Preis fällt u. s. w."]
        en = [f"Dr. {n} states (vol. {i}, p. 3) that it grows.", "The dose is 2.6 grams, i.e. approx. 20 drops.", f"See No. {i} in Fig. 16.", "The roots of the plant are brown.", "It is sold for 3 pence."]
        fr = [f"Certaines espèces, p. ex. {n}, ont des fleurs.", "On les trouve ici.", f"Selon M. {n} (p. {i}), les feuilles pèsent env. 5 g.", "Les graines sont dures."]
        ru = [f"Доза равна {i},2 г, т. е. около 4 капель (см. рис. {i}).", "Растение встречается в лесах.", "Корни темнеют.", "Настой принимают при кашле и т. д."]
        for lang, x in (("d", de), ("e", en), ("f", fr), ("r", ru)):  # texts begin with every sentence in turn
            rows.append((f"{lang}{i}", " ".join(x[i % len(x) :] + x[: i % len(x)])))
    return spark.createDataFrame(rows, "id string, t string")


def test_sentences(spark):
    c = corpus(spark)
    c = c.unionByName(c.filter("id = 't0'")).unionByName(spark.createDataFrame([("n", None), ("m", ""), ("o", " \n ")], "id string, t string")).withColumn("key", F.lit("clash")).withColumn("sentence_start", F.lit(0))
    got = {}
    for r in sentences.sentences(c, "id", "t").collect():
        got.setdefault(r.key, []).append((r.sentence_start, r.sentence_end))
    for i, t in enumerate(TRUTH):
        text = t.replace("|", "")
        assert [text[a:b] for a, b in sorted(got[f"t{i}"])] == [x.strip() for x in t.split("|")]
    assert not {"n", "m", "o"} & set(got)
    assert sentences.sentences(c.limit(0), "id", "t").count() == 0
    joined = {}
    for r in sentences.sentences(c, "id", "t", max_words=3).collect():  # a model too large to broadcast
        joined.setdefault(r.key, []).append((r.sentence_start, r.sentence_end))
    assert {k: sorted(v) for k, v in joined.items()} == {k: sorted(v) for k, v in got.items()}


def test_learned_words(spark):
    m = sentences.learn(corpus(spark), "t")
    assert {("de", "prof"), ("de", "abt"), ("en", "dr"), ("en", "vol"), ("fr", "ex")} <= m.abbreviations
    assert ("de", "die") in m.starters and ("de", "#", "november") in m.collocations and ("de", "selten") not in m.abbreviations


def test_long_text_and_plain_model():
    text = "Ein Satz steht hier. " * 50_000
    assert len(sentences.split_sentences(text, sentences.Model())) == 50_000
    assert sentences.split_sentences("", sentences.Model()) == []


CASES = [
    ("a", "Ｇｅｈａｌｔ der Blüten", "Gehalt der Blüten"),
    ("b", "sel​ten und ﻿schön", "selten und schön"),
    ("c", "auf dem Markt", "auf dem Markt"),
    ("d", "nie\u0308 u\u0308berall", "ni\u00eb \u00fcberall"),
    ("e", "Bitterstoﬀ und ﬂach", "Bitterstoff und flach"),
    ("f", "die Zwеigе sіnd", "die Zweige sind"),
    ("g", "раrmі les", "parmi les"),
    ("h", "Der Name μελάνθιον deutet", None),
    ("i", "Cesrilis × arviflorum", None),
    ("j", "Осенью цветы темнеют", None),
    ("k", "學名（Aus bus），見第2頁。", None),
    ("l", "", None),
    ("m", None, None),
    ("n", "Ordinary text, „quoted“ – fine…", None),
    ("o", "оr", "or"),
]


def test_unify(spark):
    clean = [(f"v{i}", "die Zweige sind parmi les or Blüten Gehalt und", None) for i in range(3)]
    rows = CASES + clean + [("f", "die Zwеigе sіnd", None)]
    df = spark.createDataFrame([("t", k, "x", s) for k, s, _ in rows], "table_name string, row_key string, field_name string, text string").withColumn("kinds", F.lit(1)).withColumn("plain", F.lit(2))
    got = {r.row_key: r.unified for r in lookalikes.unify(df).collect()}
    assert got == {k: w for k, _, w in CASES if w is not None}
    assert lookalikes.unify(df.limit(0)).count() == 0
    long = spark.createDataFrame([("t", "z", "x", "wort " * 200_000 + "sel​ten")], "table_name string, row_key string, field_name string, text string")
    assert lookalikes.unify(long).first().unified.endswith("selten")


def test_names_equal_their_record(spark, data):
    c = spark.read.parquet(f"{data}/embedding_chunks.parquet")
    f = lookalikes.corpus_fields(spark.read.parquet(f"{data}/pages.parquet"), c)
    u = lookalikes.unify(f).filter("table_name = 'embedding_chunks'").select(F.col("row_key").alias("chunk_id"), "unified")
    n = c.join(u, "chunk_id", "left").join(spark.read.parquet(f"{data}/record_name_metadata.parquet").select("record_id", "book_scientific_name"), "record_id")
    assert n.filter("lower(coalesce(unified, scientific_name)) <> lower(book_scientific_name)").count() == 0


def test_dominant_script(spark):
    schema = "table_name string, row_key string, field_name string, text string"
    clean = ["утром роса и трава", "la poca acqua di Zweige"]
    cases = [("a", "рoсa утром", "роса утром"), ("b", "трaвa росла", "трава росла"), ("c", "die Zwеige", "die Zweige"), ("d", "Мeliklos novum", None), ("e", "росла γάλα μm", None), ("f", "αPinen", None)]
    df = spark.createDataFrame([("t", f"v{i}", "x", t) for i, t in enumerate(clean)] + [("t", k, "x", t) for k, t, _ in cases], schema)
    got = {r.row_key: r for r in lookalikes.unify(df).collect()}
    assert {k: r.unified for k, r in got.items() if r.kinds == ["script"]} == {k: w for k, _, w in cases if w}
    assert got["d"].unified == "Мeliklos novum" and got["d"].unresolved == ["Мeliklos"] and got["d"].kinds == ["mixed script"] and not {"e", "f", "v0", "v1"} & set(got)
    # without the Russian word in the corpus the Latin one is taken
    some = {r.row_key: r.unified for r in lookalikes.unify(df.filter("row_key NOT IN ('v0')")).collect()}
    assert some["a"] == "poca утром"
