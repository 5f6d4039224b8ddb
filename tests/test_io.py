"""Readers, writers and streams."""

import json

import pytest
from pyspark.sql import functions as F

from foliant.operators.tables import fixed_window_counts
from foliant.sources import readers, writers
from foliant.streaming import jobs


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"a": 1, "b": {"c": "x"}}, indent=1))
    r = readers.read_json(spark, str(tmp_path / "a.json"), "a int, b struct<c:string>").first()
    assert (r.a, r.b.c) == (1, "x") and r.source_file.endswith("a.json")
    (tmp_path / "l.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    assert sorted(r.a for r in readers.read_json_lines(spark, str(tmp_path / "l.jsonl"), "a int").collect()) == [1, 2]
    t = spark.createDataFrame([('said: ```{"a": 3}``` ok',), ("none",)], "t string").select(readers.fenced_json(F.col("t"), "a int").alias("j"))
    assert t.first().j.a == 3
    p = spark.createDataFrame([("30-32,48,31",)], "t string").select(readers.page_ranges(F.col("t")).alias("p")).first().p
    assert p == [30, 31, 32, 48]
    s = readers.sample_pages(spark.createDataFrame([("x", 40)], "k string, n int"), "k", "n")
    assert sorted(r.page for r in s.collect()) == [1, 10, 20, 30]


def test_paged_texts_and_receipts(spark, tmp_path):
    (tmp_path / "v.txt").write_text("eins\fzwei\f")
    assert [(r.pdf_page, r.page_text) for r in readers.read_paged_texts(spark, str(tmp_path / "v.txt")).orderBy("pdf_page").collect()] == [(1, "eins"), (2, "zwei")]
    f = readers.file_receipts(spark, str(tmp_path / "v.txt"))
    good = f.select("path", "length", "sha256")
    more = good.unionByName(spark.createDataFrame([("gone", 1, "x")], "path string, length long, sha256 string"))
    assert sorted(r.state for r in readers.receipt_check(f, more).collect()) == ["missing", "ok"]
    assert readers.receipt_check(f, good.withColumn("sha256", F.lit("no"))).first().state == "hash"


def test_scan_xml(spark, tmp_path):
    (tmp_path / "s.xml").write_text(
        '<DOC><OBJECT usemap="p1"><LINE><WORD coords="10,30,50,20" x-confidence="90">Aus</WORD><WORD coords="60,32,90,18" x-confidence="80">bus</WORD></LINE>'
        '<LINE><WORD coords="5,60,15,50" x-confidence="70">x</WORD></LINE></OBJECT></DOC>'
    )
    r = readers.read_scan_xml(spark, str(tmp_path / "s.xml")).orderBy("line").collect()
    assert [(x.page, x.text, x.x0, x.y0, x.x1, x.y1, x.confidence) for x in r] == [("p1", "Aus bus", 10, 18, 90, 32, 85.0), ("p1", "x", 5, 50, 15, 60, 70.0)]
    lines = spark.createDataFrame([("p", [("b", 0.5, 0.9), ("a", 0.1, 0.901), ("c", 0.1, 0.2)])], "k string, l array<struct<text:string,x:double,y:double>>")
    assert readers.recognised_lines(lines, "k", "l").first().text == "a\nb\nc"


def test_versions(spark, tmp_path):
    t = writers.VersionedTable(spark, str(tmp_path / "t"))
    v1 = t.publish(spark.range(3).toDF("i"), {"rows": F.count("*") == 3})
    with pytest.raises(ValueError, match="rows"):
        t.publish(spark.range(2).toDF("i"), {"rows": F.count("*") == 3})
    assert t.current() == v1 and t.read().count() == 3
    v2 = t.publish(spark.range(5).toDF("i"))
    assert t.read().count() == 5 and t.current() == v2
    t.roll_back()
    assert t.read().count() in (2, 3)


def test_sharded_text(spark, tmp_path):
    df = spark.createDataFrame([("s1", 2, "b"), ("s1", 1, "a"), ("s2", 1, "c")], "s string, o int, t string")
    m = {r.shard: (r.records, r.characters) for r in writers.write_sharded_text(df, str(tmp_path / "x"), "s", "o", "t").collect()}
    assert m == {"s1": (2, 2), "s2": (1, 1)}
    assert [r.value for r in spark.read.text(str(tmp_path / "x" / "shard=s1")).collect()] == ["a", "b"]
    md = df.select(writers.markdown_record(F.col("s"), [("t", F.col("t")), ("none", F.lit(None).cast("string"))]).alias("m")).first().m
    assert md == "## s1\n- t: b"
    assert json.loads(writers.public_json(df.limit(1), ["s", "o"]).first().value) == {"s": "s1", "o": 2}


def test_request_windows_stream_equals_batch(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = jobs.request_windows(jobs.watch_parquet(spark, str(tmp_path / "in"), events.schema), "user_id", "ts", late="3650 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.user_id, r.window_start, r.n) for r in spark.table("windows").collect()}
    want = {(r.user_id, r.window_start, r.n) for r in fixed_window_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 600, 10).collect()}
    assert got == want


def test_refresh_keeps_the_newest(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "k int, v int"
    spark.createDataFrame([(1, 1), (2, 1)], schema).coalesce(1).write.parquet(src)
    step = jobs.latest_by_key(str(tmp_path / "out"), ["k"], "v")
    frame = lambda: jobs.watch_parquet(spark, src, spark.createDataFrame([], schema).schema)
    jobs.refresh(frame(), str(tmp_path / "c"), step).awaitTermination(120)
    spark.createDataFrame([(1, 2)], schema).coalesce(1).write.mode("append").parquet(src)
    jobs.refresh(frame(), str(tmp_path / "c"), step).awaitTermination(120)
    assert sorted(map(tuple, jobs.read_latest(spark, str(tmp_path / "out"), ["k"], "v").collect())) == [(1, 2), (2, 1)]
    old, new = spark.createDataFrame([(1, 1), (2, 1)], schema), spark.createDataFrame([(1, 2), (3, 1)], schema)
    assert {(r.k, r.change) for r in jobs.fingerprint_changes(old, new, "k", ["v"]).collect()} == {(1, "changed"), (2, "removed"), (3, "added")}
