"""What the lexical index and its ranking leave on disk."""

from pathlib import Path

from pyspark.sql import functions as F

from foliant import session
from foliant.operators import retrieval as rt


def test_an_index_is_kept_in_compressed_columns_and_read_in_fewer_parts(spark):
    df = spark.range(20_000).repartition(12).select(F.concat(F.lit("chunk-of-a-book-"), "id").alias("doc"), F.array(F.lit("alpha"), F.concat(F.lit("t"), F.col("id") % 50)).alias("terms"))
    table = session.stored(spark, ("test", "index"), lambda: df)
    assert session.stored(spark, ("test", "index"), lambda: 1 / 0) is table  # built once
    assert table.dtypes == df.dtypes and sorted(map(tuple, table.select("doc", F.concat_ws(" ", "terms")).collect())) == sorted(map(tuple, df.select("doc", F.concat_ws(" ", "terms")).collect()))
    files = [Path(f.removeprefix("file:")) for f in table.inputFiles()]
    checkpoint = session.cut_lineage(df)
    rdd = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    largest = max(sum(x.stat().st_size for x in d.iterdir()) for d in rdd.iterdir() if d.name.startswith("rdd-"))
    assert files and sum(f.stat().st_size for f in files) < 0.5 * largest
    assert table.rdd.getNumPartitions() <= checkpoint.rdd.getNumPartitions()


def test_ranking_shuffles_no_documents_for_the_bars_and_once_per_question(spark, monkeypatch):
    seen, top_k = [], rt.top_k
    monkeypatch.setattr(rt, "top_k", lambda df, *a, **kw: seen.append(df.columns) or top_k(df, *a, **kw))
    d = spark.createDataFrame([(i, f"alpha beta{i % 7} gamma{i % 3}") for i in range(100)], "d long, t string").repartition(4)
    q = spark.createDataFrame([(f"q{i}", f"alpha beta{i % 7}") for i in range(30)], "q string, t string")
    asked = session.kept(rt.asked_postings(d, "d", "t", q, "t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = rt.bm25_of_asked(asked, q, "q", "t", 5)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert seen[0] == ["term", "part"]
    assert "Exchange hashpartitioning(lead" in plan and "hashpartitioning(lead#" in plan and not any("doc#" in x for x in plan.split("\n") if "Exchange hashpartitioning(" in x)
    assert ranked.count() == 150
