from foliant.llm import queries

HEAD = "page_id long, source_id string, pdf_page int, best_text string"
LINES = "Die Blätter sind an der Basis grünlich und gegen die Spitze hin\nviolett gefärbt. Unter dem Mikroskop lassen die Zellen der Rinde\nSchleim und vereinzelt Harz erkennen. Man benutzt die Wurzeln als\nTee gegen Husten und Fieber."


def test_sentences_of_pages(spark, tmp_path):
    rows = [(i, "a", i, f"Flora der Heilgewächse    {i}\n{LINES}") for i in range(1, 60)]
    rows += [(100, "a", 100, LINES.replace("Wurzeln", "Wur-\nzeln")), (101, "a", 101, None), (102, "a", 102, "")]
    spark.createDataFrame(rows, HEAD).write.parquet(f"{tmp_path}/pages.parquet")
    got = {}
    for r in queries.queries()["p6_pages"](spark, str(tmp_path)).orderBy("page_id", "sentence_index").collect():
        got.setdefault(r.page_id, []).append(r.sentence)
    want = [x.strip(".") + "." for x in LINES.replace("\n", " ").split(". ")]
    assert got == {i: want for i in [*range(1, 60), 100]}
