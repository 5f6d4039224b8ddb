from foliant.llm import truncation

WHOLE = "Die Blätter sind an der Basis grünlich und gegen die Spitze hin violett gefärbt. Unter dem Mikroskop lassen die Zellen der Rinde Schleim erkennen."


def test_evidence_and_both_ways_to_count(spark):
    docs = [(i, f"{WHOLE} Man gibt {i} g.", "s") for i in range(60)]
    docs += [(100, WHOLE[:70], "s"), (101, WHOLE[:66], "s"), (102, "Unter dem Mikroskop lassen die …", "s"), (103, "Unter dem Mikroskop lassen die...", None), (104, "Ganz neue Worte allein…", "s"), (105, WHOLE + " …", "s"), (106, WHOLE + " \n", "s"), (107, "Unter dem Mikroskop lassen die Zel", "s"), (107, "Unter dem Mikroskop lassen die Zel", "s"), (108, "…", "s"), (109, " 　", "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    few, many = (sorted(map(str, truncation.truncated(d, most_asked=n).select("doc_id", "evidence").collect())) for n in (1_000_000, 0))
    assert few == many
    got = {r.doc_id: r.evidence for r in truncation.truncated(d).collect()}
    assert got == {100: "trigram", 101: "trigram", 102: "trigram", 103: "trigram", 104: "mark", 107: "trigram"}
