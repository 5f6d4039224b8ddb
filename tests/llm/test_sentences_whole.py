from foliant.llm import sentences


def test_joined_model_at_every_stop(spark):
    rows = [(f"t{i}", f"Man nahm zuvor ca. {i} Gramm, vgl. Bd. {i} der Sammlung und Abt. Lobrecht daselbst. Die Blätter sind grün.\nDie Wurzeln sind hart.\nMan gibt den Tee.") for i in range(300)]
    rows += [("glued", "Sie steht in der Abt.Lobrecht und ist selten.Die Blätter sind grün."), ("space", "Sie steht in der Abt.\u00a0Lobrecht und ist selten.\u00a0Die Blätter sind grün."), ("both", "Sie steht in Abt.\u2003„Lobrecht“ und ist selten.")]
    df = spark.createDataFrame(rows, "id string, t string")
    one = sorted(map(tuple, sentences.sentences(df, "id", "t").collect()))
    assert one == sorted(map(tuple, sentences.sentences(df, "id", "t", max_words=0).collect()))
    assert [r[2] for r in one if r[0] == "glued"] == [0, 45] and len([r for r in one if r[0] == "space"]) == 2
