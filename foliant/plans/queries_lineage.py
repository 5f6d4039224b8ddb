"""Queries on boundaries between sources, audits, reuse, evidence lists and work order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import tables as tb
from foliant.registry import query
from foliant.session import read_table


@query("""
    WITH p AS (SELECT source_id, pdf_page, max(CASE WHEN length(trim(embedded_text, ' ')) > 0 THEN 1 ELSE 0 END) AS e, max(CASE WHEN length(trim(ocr_text, ' ')) > 0 THEN 1 ELSE 0 END) AS o FROM pages GROUP BY ALL)
    SELECT source_id, count(*) AS pages, sum(e) AS embedded, sum(o) AS recognised, sum(greatest(e, o)) AS covered, round(sum(greatest(e, o)) / count(*), 6) AS coverage, sum(greatest(e, o)) = count(*) AS complete FROM p GROUP BY 1""")
def lane_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = lambda c: F.max(F.when(F.length(F.trim(F.col(c))) > 0, 1).otherwise(0))
    p = read_table(spark, sf_dir, "pages").groupBy("source_id", "pdf_page").agg(have("embedded_text").alias("e"), have("ocr_text").alias("o"))
    covered = F.sum(F.greatest("e", "o"))
    return p.groupBy("source_id").agg(F.count("*").alias("pages"), F.sum("e").alias("embedded"), F.sum("o").alias("recognised"), covered.alias("covered"), F.round(covered / F.count("*"), 6).alias("coverage"), (covered == F.count("*")).alias("complete"))


@query("""
    SELECT 'chunks have one record' AS rule, 0 AS expected, count(*) AS observed FROM embedding_chunks WHERE record_id IS NULL
    UNION ALL SELECT 'pages are unique', 0, count(*) FROM (SELECT 1 FROM pages GROUP BY source_id, pdf_page HAVING count(*) > 1)
    UNION ALL SELECT 'entries count their pages', 0, count(*) FROM entries WHERE page_count <> len(pdf_pages)
    UNION ALL SELECT 'records have a book name', 0, count(*) FROM record_name_metadata WHERE book_scientific_name IS NULL""")
def requirement_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: read_table(spark, sf_dir, n) for n in ("embedding_chunks", "pages", "entries", "record_name_metadata")}
    rows = [
        ("chunks have one record", t["embedding_chunks"].filter("record_id IS NULL")),
        ("pages are unique", tb.duplicates(t["pages"], ["source_id", "pdf_page"])),
        ("entries count their pages", t["entries"].filter("page_count <> size(pdf_pages)")),
        ("records have a book name", t["record_name_metadata"].filter("book_scientific_name IS NULL")),
    ]
    return tb.union_all([d.agg(F.count("*").alias("observed")).select(F.lit(n).alias("rule"), F.lit(0).alias("expected"), "observed") for n, d in rows])


@query("SELECT entry_id, page_count, len(pdf_pages) AS counted, end_pdf_page - start_pdf_page + 1 AS spanned, page_count = len(pdf_pages) AND page_count = end_pdf_page - start_pdf_page + 1 AS holds FROM entries")
def recomputed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted, spanned = F.size("pdf_pages"), F.col("end_pdf_page") - F.col("start_pdf_page") + 1
    e = read_table(spark, sf_dir, "entries").select("entry_id", "page_count", counted.cast("long").alias("counted"), spanned.alias("spanned"))
    return e.withColumn("holds", (F.col("page_count") == F.col("counted")) & (F.col("page_count") == F.col("spanned")))


@query(r"""
    WITH l AS (SELECT page_id, unnest(string_split(best_text, chr(10))[1:24]) AS line, generate_subscripts(string_split(best_text, chr(10))[1:24], 1) AS i FROM pages)
    SELECT page_id, min(i) AS line, arg_min(regexp_extract(line, '([A-Z][a-z]{2,}) ([a-z]{3,})', 0), i) AS taxon FROM l WHERE regexp_matches(line, '([A-Z][a-z]{2,}) ([a-z]{3,})') GROUP BY 1""")
def first_taxon_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.slice(F.split("best_text", "\n"), 1, 24)).alias("i", "line"))
    p = p.filter(F.col("line").rlike(tx.BINOMIAL))
    return p.groupBy("page_id").agg((F.min("i") + 1).cast("long").alias("line"), F.min_by(F.regexp_extract("line", tx.BINOMIAL, 0), "i").alias("taxon"))


@query("""
    WITH d AS (SELECT text_sha256, model, vector_space_id, min(chunk_id) AS first_id FROM embedding_chunks WHERE length(embedding_json) > 0 GROUP BY ALL)
    SELECT c.chunk_id, CASE WHEN d.first_id IS NULL THEN 'pending' WHEN d.first_id = c.chunk_id THEN 'own' ELSE 'reused' END AS state FROM (SELECT DISTINCT chunk_id, text_sha256, model, vector_space_id FROM embedding_chunks) c LEFT JOIN d USING (text_sha256, model, vector_space_id)""")
def vector_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    keys = ["text_sha256", "model", "vector_space_id"]
    d = c.filter("length(embedding_json) > 0").groupBy(*keys).agg(F.min("chunk_id").alias("first_id"))
    j = c.select("chunk_id", *keys).distinct().join(d, keys, "left")
    return j.select("chunk_id", F.when(F.col("first_id").isNull(), "pending").when(F.col("first_id") == F.col("chunk_id"), "own").otherwise("reused").alias("state"))


@query("SELECT DISTINCT chunk_id FROM embedding_chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM embedding_chunks WHERE length(embedding_json) > 0)")
def pending_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "embedding_json")
    return c.select("chunk_id").distinct().join(c.filter("length(embedding_json) > 0").select("chunk_id"), "chunk_id", "left_anti")


@query("SELECT entry_id, owner_shard, turn, row_number() OVER (ORDER BY turn, owner_shard, entry_id) AS place FROM (SELECT entry_id, owner_shard, row_number() OVER (PARTITION BY owner_shard ORDER BY start_pdf_page, entry_id) AS turn FROM entries) QUALIFY place <= 200")
def round_robin_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the head of the queue is the feature: the next 200 items, one of each shard in turn
    w = Window.partitionBy("owner_shard").orderBy("start_pdf_page", "entry_id")
    e = read_table(spark, sf_dir, "entries").select("entry_id", "owner_shard", F.row_number().over(w).alias("turn")).filter("turn <= 200").withColumn("turn", F.col("turn").cast("long"))
    head = e.orderBy("turn", "owner_shard", "entry_id").limit(200)
    return head.withColumn("place", F.row_number().over(Window.orderBy("turn", "owner_shard", "entry_id")).cast("long"))


@query("""
    WITH s AS (SELECT source_id, quality, CASE quality WHEN 'fragmented' THEN 3 WHEN 'low_text' THEN 2 WHEN 'empty' THEN 1 ELSE 0 END AS severity FROM pages)
    SELECT source_id, max(severity) AS worst, count(*) FILTER (severity = 3) AS at_worst, count(*) AS pages FROM s GROUP BY 1""")
def severity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sev = F.when(F.col("quality") == "fragmented", 3).when(F.col("quality") == "low_text", 2).when(F.col("quality") == "empty", 1).otherwise(0)
    s = read_table(spark, sf_dir, "pages").select("source_id", sev.alias("severity"))
    return s.groupBy("source_id").agg(F.max("severity").alias("worst"), F.count_if(F.col("severity") == 3).alias("at_worst"), F.count("*").alias("pages"))


@query(r"""
    WITH n AS (SELECT DISTINCT lower(book_scientific_name) AS name FROM record_name_metadata), d AS (SELECT doc_id, record_id, unnest(list_distinct(regexp_extract_all(text, '[A-Z][a-zë]{2,} [a-zë]{3,}'))) AS cand FROM (SELECT doc_id, record_id, text || '. ' || coalesce(own, '') || '; ' || coalesce(other, '') AS text FROM documents LEFT JOIN (SELECT record_id, book_scientific_name AS own FROM record_name_metadata) USING (record_id), (SELECT max(book_scientific_name) AS other FROM record_name_metadata WHERE record_id = 'rec-materia-generalis'))),
    h AS (SELECT DISTINCT doc_id, record_id, lower(cand) AS name FROM d WHERE lower(cand) IN (SELECT name FROM n)), o AS (SELECT record_id, lower(book_scientific_name) AS own FROM record_name_metadata)
    SELECT doc_id, count(*) AS names, count(*) FILTER (own IS NULL OR name <> own) AS foreign_names FROM h LEFT JOIN o USING (record_id) GROUP BY 1""")
def display_name_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # names of the vocabulary are found by an equi-join on candidate pairs of words, never by testing every name on every text
    m = read_table(spark, sf_dir, "record_name_metadata").select("record_id", F.lower("book_scientific_name").alias("own"))
    cand = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Z][a-zë]{2,} [a-zë]{3,}"), F.lit(0))))
    # documents with the name of their record and of the general one added, so that there are names of both kinds
    names = read_table(spark, sf_dir, "record_name_metadata").select("record_id", F.col("book_scientific_name").alias("first"))
    general = names.filter("record_id = 'rec-materia-generalis'").agg(F.max("first").alias("other"))
    d = read_table(spark, sf_dir, "documents").join(names, "record_id", "left").crossJoin(F.broadcast(general))  # one row
    d = d.withColumn("text", F.concat("text", F.lit(". "), F.coalesce("first", F.lit("")), F.lit("; "), F.coalesce("other", F.lit(""))))
    d = d.select("doc_id", "record_id", cand.alias("c")).select("doc_id", "record_id", F.lower("c").alias("name")).distinct()
    h = d.join(m.select(F.col("own").alias("name")).distinct(), "name", "left_semi").join(m, "record_id", "left")
    return h.groupBy("doc_id").agg(F.count("*").alias("names"), F.count_if(F.col("own").isNull() | (F.col("name") != F.col("own"))).alias("foreign_names"))


@query("""
    WITH e AS (SELECT record_id, chunk_id, row_number() OVER (PARTITION BY record_id ORDER BY pdf_page, chunk_id) AS ordinal FROM (SELECT DISTINCT record_id, chunk_id, pdf_page FROM embedding_chunks)),
    w AS (SELECT record_id, unnest([1, 3]) AS ordinal FROM record_name_metadata)
    SELECT record_id, ordinal, 'E' || ordinal || ' = ' || chunk_id AS label FROM w JOIN e USING (record_id, ordinal)""")
def evidence_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("record_id").orderBy("pdf_page", "chunk_id")
    e = read_table(spark, sf_dir, "embedding_chunks").select("record_id", "chunk_id", "pdf_page").distinct().withColumn("ordinal", F.row_number().over(w)).filter("ordinal <= 3")
    wanted = read_table(spark, sf_dir, "record_name_metadata").select("record_id", F.explode(F.array(F.lit(1), F.lit(3))).alias("ordinal"))
    return wanted.join(e, ["record_id", "ordinal"]).select("record_id", "ordinal", F.concat(F.lit("E"), F.col("ordinal").cast("string"), F.lit(" = "), "chunk_id").alias("label"))


@query("""
    SELECT entry_id, i AS place, pdf_pages[i] AS page, approved_overlap_pages[i] AS overlap_page, len(pdf_pages) = len(approved_overlap_pages) AS equal_length
    FROM (SELECT *, unnest(generate_series(1, greatest(len(pdf_pages), len(approved_overlap_pages)))) AS i FROM entries)""")
def positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("entry_id", "pdf_pages", "approved_overlap_pages", (F.size("pdf_pages") == F.size("approved_overlap_pages")).alias("equal_length"))
    z = e.select("entry_id", "equal_length", F.posexplode(F.arrays_zip("pdf_pages", "approved_overlap_pages")).alias("i", "z"))
    return z.select("entry_id", (F.col("i") + 1).cast("long").alias("place"), F.col("z.pdf_pages").alias("page"), F.col("z.approved_overlap_pages").alias("overlap_page"), "equal_length")


@query(r"""
    WITH u AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Z][a-z]{2,} [a-z]{3,}'))) AS n FROM documents)
    SELECT n AS name, count(DISTINCT doc_id) AS documents, length(n) AS letters FROM u GROUP BY n ORDER BY documents DESC, letters DESC, name LIMIT 50""")
def longest_frequent_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a top-50 report
    names = F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"[A-Z][a-z]{2,} [a-z]{3,}"), F.lit(0)), lambda x: F.lower(x))))
    d = read_table(spark, sf_dir, "documents").select("doc_id", names.alias("name"))
    g = d.groupBy("name").agg(F.countDistinct("doc_id").alias("documents")).withColumn("letters", F.length("name").cast("long"))
    return g.orderBy(F.desc("documents"), F.desc("letters"), "name").limit(50)


@query("SELECT source_id, quality AS old_quality, n_q AS new_quality, count(*) AS pages FROM (SELECT source_id, coalesce(quality, 'unknown') AS quality, CASE WHEN needs_ocr THEN 'queued' ELSE 'done' END AS n_q FROM pages) GROUP BY CUBE (source_id, quality, n_q)")
def status_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("source_id", F.coalesce("quality", F.lit("unknown")).alias("old_quality"), F.when(F.col("needs_ocr"), "queued").otherwise("done").alias("new_quality"))
    return p.cube("source_id", "old_quality", "new_quality").agg(F.count("*").alias("pages"))
