"""Queries on keys, sets, aggregates, lineage and the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.operators import tables as tb
from foliant.registry import query
from foliant.session import read_table, shared_folder
from foliant.streaming import jobs


@query("SELECT chunk_id, count(*) AS n FROM embedding_chunks GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.duplicates(read_table(spark, sf_dir, "embedding_chunks"), ["chunk_id"])


@query("""
    SELECT record_id, 'missing' AS side FROM (SELECT DISTINCT record_id FROM record_name_metadata) WHERE record_id NOT IN (SELECT record_id FROM embedding_chunks WHERE record_id IS NOT NULL)
    UNION ALL SELECT record_id, 'extra' FROM (SELECT DISTINCT record_id FROM embedding_chunks) WHERE record_id NOT IN (SELECT record_id FROM record_name_metadata)""")
def missing_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.missing_and_extra(read_table(spark, sf_dir, "record_name_metadata"), read_table(spark, sf_dir, "embedding_chunks"), "record_id")


@query("SELECT side, key, n FROM (SELECT 'chunks' AS side, record_id AS key, count(*) AS n FROM embedding_chunks GROUP BY ALL UNION ALL SELECT 'documents', record_id, count(*) FROM documents GROUP BY ALL)")
def union_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [read_table(spark, sf_dir, t).groupBy(F.col("record_id").alias("key")).agg(F.count("*").alias("n")).select(F.lit(s).alias("side"), "key", "n") for s, t in (("chunks", "embedding_chunks"), ("documents", "documents"))]
    return tb.union_all(parts)


@query("SELECT page_id FROM pages p WHERE NOT EXISTS (SELECT 1 FROM (SELECT source_id, unnest(approved_overlap_pages) AS pg FROM entries) e WHERE e.source_id = p.source_id AND e.pg = p.pdf_page)")
def anti_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("source_id", F.explode("approved_overlap_pages").alias("pdf_page")).distinct()
    return read_table(spark, sf_dir, "pages").join(e, ["source_id", "pdf_page"], "left_anti").select("page_id")


@query("SELECT DISTINCT page_id FROM pages p WHERE EXISTS (SELECT 1 FROM entries e WHERE e.source_id = p.source_id AND e.start_pdf_page = p.pdf_page)")
def semi_heading_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("source_id", F.col("start_pdf_page").alias("pdf_page")).distinct()
    return read_table(spark, sf_dir, "pages").join(e, ["source_id", "pdf_page"], "left_semi").select("page_id").distinct()


@query("SELECT (SELECT count(*) FROM (SELECT record_id FROM documents INTERSECT SELECT record_id FROM embedding_chunks)) AS shared, (SELECT count(*) FROM (SELECT record_id FROM documents EXCEPT SELECT record_id FROM embedding_chunks)) AS only_documents, (SELECT count(*) FROM (SELECT record_id FROM embedding_chunks EXCEPT SELECT record_id FROM documents)) AS only_chunks")
def set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one pass over each side: every key with the sides that hold it
    d = read_table(spark, sf_dir, "documents").select("record_id", F.lit(1).alias("d"), F.lit(0).alias("c"))
    c = read_table(spark, sf_dir, "embedding_chunks").select("record_id", F.lit(0).alias("d"), F.lit(1).alias("c"))
    k = d.unionByName(c).groupBy("record_id").agg(F.max("d").alias("d"), F.max("c").alias("c"))
    return k.agg(F.count_if(F.expr("d = 1 AND c = 1")).alias("shared"), F.count_if(F.expr("d = 1 AND c = 0")).alias("only_documents"), F.count_if(F.expr("d = 0 AND c = 1")).alias("only_chunks"))


@query("SELECT chunk_id, text_sha256, epoch_us(ingested_at) AS ingested_us FROM embedding_chunks QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at DESC) = 1")
def merge_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "text_sha256", F.unix_micros("ingested_at").alias("ingested_us"))
    return tb.latest(c, ["chunk_id"], ["ingested_us"])


@query("""
    WITH n AS (SELECT record_id, 'chunks' AS origin, count(*) AS n FROM embedding_chunks GROUP BY 1), o AS (SELECT record_id, 'documents' AS origin, count(*) AS n FROM documents GROUP BY 1)
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE record_id NOT IN (SELECT record_id FROM n)""")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda t, s: read_table(spark, sf_dir, t).groupBy("record_id").agg(F.count("*").alias("n")).select("record_id", F.lit(s).alias("origin"), "n")
    return tb.upsert(count("documents", "documents"), count("embedding_chunks", "chunks"), ["record_id"])


_LANES = ", ".join(f"CAST(CAST(sum(CAST(CAST('0x' || substring(h, {1 + 15 * i}, 15) AS BIGINT) AS DECIMAL(38,0))) % 1152921504606846976 AS BIGINT) AS VARCHAR)" for i in range(4))


@query(rf"""
    WITH c AS (SELECT chunk_id, max_by(parent_chunk_id, ingested_at) AS p, max_by(text_sha256, ingested_at) AS t, max_by(vector_space_id, ingested_at) AS s FROM embedding_chunks GROUP BY 1),
    r AS (SELECT sha256(concat_ws('|', chunk_id, coalesce(p, '\N'), coalesce(t, '\N'), coalesce(s, '\N'))) AS h FROM c)
    SELECT count(*) AS n_rows, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {_LANES})) AS digest FROM r""")
def table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract of an index: id, parent, hash and space of each chunk
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "parent_chunk_id", "text_sha256", "vector_space_id", "ingested_at")
    return tb.table_digest(tb.latest(c, ["chunk_id"], ["ingested_at"]), ["chunk_id", "parent_chunk_id", "text_sha256", "vector_space_id"])


@query(r"""
    SELECT record_id, sha256('{"accepted_scientific_name":' || coalesce('"' || accepted_scientific_name || '"', 'null') || ',"record_id":"' || record_id || '"}') AS compact_sha256,
           sha256('{"accepted_scientific_name": ' || coalesce('"' || accepted_scientific_name || '"', 'null') || ', "record_id": "' || record_id || '"}') AS spaced_sha256 FROM record_name_metadata""")
def canonical_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.functions.text import canonical_json_hash

    m = read_table(spark, sf_dir, "record_name_metadata")
    keys = ["record_id", "accepted_scientific_name"]
    return m.select("record_id", canonical_json_hash(keys).alias("compact_sha256"), canonical_json_hash(keys, compact=False).alias("spaced_sha256"))


@query("""
    WITH c AS (SELECT DISTINCT chunk_id, record_id, source_text, text_sha256, token_unit_start, token_unit_end, embedding_json, dimensions FROM embedding_chunks),
    j AS (SELECT c.*, m.record_id IS NOT NULL AS known FROM c LEFT JOIN record_name_metadata m ON m.record_id = c.record_id)
    SELECT chunk_id, 'hash' AS error FROM j WHERE NOT coalesce(sha256(source_text) = text_sha256, false) UNION ALL SELECT chunk_id, 'record' FROM j WHERE NOT known
    UNION ALL SELECT chunk_id, 'units' FROM j WHERE NOT coalesce(token_unit_end > token_unit_start, false) UNION ALL SELECT chunk_id, 'vector' FROM j WHERE embedding_json IS NULL OR embedding_json = ''""")
def hash_chain_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "record_id", "source_text", "text_sha256", "token_unit_start", "token_unit_end", "embedding_json", "dimensions").distinct()
    m = read_table(spark, sf_dir, "record_name_metadata").select("record_id", F.lit(True).alias("known"))
    rules = {"hash": F.sha2("source_text", 256) == F.col("text_sha256"), "record": F.coalesce("known", F.lit(False)), "units": F.col("token_unit_end") > F.col("token_unit_start"), "vector": F.length("embedding_json") > 0}
    return tb.checks(c.join(m, "record_id", "left"), "chunk_id", rules)


@query("SELECT coalesce(a.chunk_id, b.chunk_id) AS chunk_id, CASE WHEN a.chunk_id IS NULL THEN 'no_text' WHEN b.chunk_id IS NULL THEN 'no_vector' ELSE 'ok' END AS state FROM (SELECT DISTINCT chunk_id FROM embedding_chunks WHERE source_text <> '') a FULL JOIN (SELECT DISTINCT chunk_id FROM embedding_chunks WHERE length(embedding_json) > 0) b ON a.chunk_id = b.chunk_id")
def vector_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    a = c.filter("source_text <> ''").select("chunk_id", F.lit(1).alias("a")).distinct()
    b = c.filter("length(embedding_json) > 0").select("chunk_id", F.lit(1).alias("b")).distinct()
    return a.join(b, "chunk_id", "full_outer").select("chunk_id", F.when(F.col("a").isNull(), "no_text").when(F.col("b").isNull(), "no_vector").otherwise("ok").alias("state"))


@query("""
    WITH t AS (SELECT profile_id, count(*) AS total, count(*) FILTER (review_status = 'approved') AS approved, count(*) FILTER (length(embedding_json) > 0) AS embedded FROM embedding_chunks GROUP BY 1)
    SELECT profile_id, total, approved, CASE WHEN total = 0 THEN 0 ELSE round(100.0 * approved / total, 2) END AS approved_percent, CASE WHEN total = 0 THEN 0 ELSE round(100.0 * embedded / total, 2) END AS embedded_percent, total = embedded AS complete FROM t""")
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    percent = lambda n: F.when(F.col("total") == 0, 0.0).otherwise(F.round(100.0 * F.col(n) / F.col("total"), 2))
    t = read_table(spark, sf_dir, "embedding_chunks").groupBy("profile_id").agg(F.count("*").alias("total"), F.count_if(F.col("review_status") == "approved").alias("approved"), F.count_if(F.length("embedding_json") > 0).alias("embedded"))
    return t.select("profile_id", "total", "approved", percent("approved").alias("approved_percent"), percent("embedded").alias("embedded_percent"), (F.col("total") == F.col("embedded")).alias("complete"))


@query("""
    WITH p AS (SELECT 'pages' AS part, 0.4 AS weight, avg(CASE WHEN quality = 'usable' THEN 1.0 ELSE 0 END) AS value FROM pages UNION ALL SELECT 'vectors', 0.4, avg(CASE WHEN length(embedding_json) > 0 THEN 1.0 ELSE 0 END) FROM embedding_chunks
               UNION ALL SELECT 'names', 0.2, avg(CASE WHEN accepted_scientific_name IS NOT NULL THEN 1.0 ELSE 0 END) FROM record_name_metadata)
    SELECT round(sum(weight * value), 6) AS score, count(*) AS parts FROM p""")
def weighted_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = lambda t, c, w: read_table(spark, sf_dir, t).agg(F.avg(F.when(c, 1.0).otherwise(0.0)).alias("value")).withColumn("weight", F.lit(w))
    parts = [share("pages", F.col("quality") == "usable", 0.4), share("embedding_chunks", F.length("embedding_json") > 0, 0.4), share("record_name_metadata", F.col("accepted_scientific_name").isNotNull(), 0.2)]
    return tb.union_all(parts).agg(F.round(F.sum(F.col("weight") * F.col("value")), 6).alias("score"), F.count("*").alias("parts"))


@query("SELECT source_id, record_id, min(pdf_page) AS first_page, max(pdf_page) AS last_page, max(scientific_name) AS name, string_agg(DISTINCT profile_id, '; ' ORDER BY profile_id) AS profiles FROM embedding_chunks GROUP BY ALL")
def record_minmax_listagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = read_table(spark, sf_dir, "embedding_chunks").groupBy("source_id", "record_id")
    # profiles are a handful of configured values
    return g.agg(F.min("pdf_page").alias("first_page"), F.max("pdf_page").alias("last_page"), F.max("scientific_name").alias("name"), F.array_join(F.array_sort(F.collect_set("profile_id")), "; ").alias("profiles"))


@query("SELECT source_id, median(length(best_text)) AS median_length, min(length(best_text)) AS shortest, max(length(best_text)) AS longest, round(avg(length(best_text)), 4) AS mean_length FROM pages GROUP BY 1")
def length_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("best_text")
    return read_table(spark, sf_dir, "pages").groupBy("source_id").agg(F.median(n).alias("median_length"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.round(F.avg(n), 4).alias("mean_length"))


@query("SELECT user_id, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, count(*) > 10 AS limited FROM events GROUP BY ALL")
def rate_limit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.fixed_window_counts(read_table(spark, sf_dir, "events"), "user_id", "ts", 600, 10)


@query("SELECT user_id, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, count(*) > 10 AS limited FROM events GROUP BY ALL")
def stream_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stream emits a window again whenever it changes; the last batch of each counts
    folder = shared_folder(spark, "stream-rate-limit")
    schema = read_table(spark, sf_dir, "events").schema
    windows = jobs.request_windows(jobs.watch_parquet(spark, f"{sf_dir}/events.parquet", schema), "user_id", "ts", late="3650 days")
    jobs.refresh(windows, f"{folder}/state", jobs.write_batches(f"{folder}/out"), output_mode="update").awaitTermination()
    return tb.latest(spark.read.parquet(f"{folder}/out"), ["user_id", "window_start"], ["batch"]).drop("batch")


def _watched_history(spark: SparkSession, sf_dir: str) -> str:
    """The events written as four files, watched as a stream one file at a time; the folder of what the refresh keeps."""
    folder = shared_folder(spark, "stream-history")
    e = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    e.repartition(4, "event_id").write.parquet(f"{folder}/in")
    step = jobs.bounded_history(f"{folder}/kept", "user_id", ["ts", "event_id"], "event_type = 'purchase'")
    jobs.refresh(jobs.watch_parquet(spark, f"{folder}/in", e.schema, 1), f"{folder}/state", step).awaitTermination()
    return f"{folder}/kept"


@query("""
    WITH f AS (SELECT user_id, arg_min(event_id, {'t': ts, 'e': event_id}) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1), l AS (SELECT user_id, arg_max(event_id, {'t': ts, 'e': event_id}) AS event_id FROM events GROUP BY 1)
    SELECT l.user_id, coalesce(f.event_id, l.event_id) AS event_id, f.event_id IS NOT NULL AS terminal FROM l LEFT JOIN f USING (user_id)""")
def stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_states(spark, _watched_history(spark, sf_dir), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "terminal")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events QUALIFY place <= 20")
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = jobs.read_history(spark, _watched_history(spark, sf_dir), "user_id", ["ts", "event_id"])
    return h.select("user_id", "event_id", F.col("place").cast("long").alias("place"))


# Coverage of the engine on the relational tables; not operators of the surveyed pipeline.
@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = read_table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus")
    return g.agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT r_name, n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: read_table(spark, sf_dir, n) for n in ("orders", "customer", "nation", "region")}
    # orders combine by customer before they meet the dimensions
    per = t["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total"))
    j = per.join(t["customer"], "c_custkey").join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.sum("orders").alias("orders"), F.round(F.sum("total"), 2).alias("total"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3")
def top_lines_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    t = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", F.row_number().over(w).cast("long").alias("rank"))
    return t.filter("rank <= 3")
