"""Queries of receipts: chains between stages, repairs, evidence lists, merged spans, lanes, replays, validators, embedded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import names as nm
from foliant.operators import receipts as rc
from foliant.operators import spans
from foliant.operators import tables as tb
from foliant.registry import query
from foliant.session import read_table


@query("""
    WITH c AS (SELECT DISTINCT chunk_id, record_id, parent_text_sha256 FROM embedding_chunks), p AS (SELECT parent_text_sha256, min(parent_chunk_id) AS parent FROM embedding_chunks WHERE parent_chunk_id IS NOT NULL GROUP BY 1),
    n AS (SELECT record_id, naming_artifact_sha256, accepted_scientific_name AS accepted FROM record_name_metadata), e AS (SELECT lower(book_taxon_candidate) AS accepted, min(entry_id) AS entry FROM entries GROUP BY 1)
    SELECT chunk_id, parent, naming_artifact_sha256, entry, CASE WHEN parent IS NULL THEN 'parent' WHEN naming_artifact_sha256 IS NULL THEN 'naming' WHEN entry IS NULL THEN 'entry' END AS broken_at
    FROM c LEFT JOIN p USING (parent_text_sha256) LEFT JOIN n USING (record_id) LEFT JOIN e ON e.accepted = lower(n.accepted)""")
def receipt_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    parents = c.filter("parent_chunk_id IS NOT NULL").groupBy("parent_text_sha256").agg(F.min("parent_chunk_id").alias("parent"))
    names = read_table(spark, sf_dir, "record_name_metadata").select("record_id", "naming_artifact_sha256", F.lower("accepted_scientific_name").alias("accepted"))
    entries = read_table(spark, sf_dir, "entries").groupBy(F.lower("book_taxon_candidate").alias("accepted")).agg(F.min("entry_id").alias("entry"))
    start = c.select("chunk_id", "record_id", "parent_text_sha256").distinct().join(names.select("record_id", "accepted"), "record_id", "left")
    hops = [("parent", parents, "parent_text_sha256", "parent"), ("naming", names, "record_id", "naming_artifact_sha256"), ("entry", entries, "accepted", "entry")]
    return rc.follow_chain(start, hops).select("chunk_id", "parent", "naming_artifact_sha256", "entry", "broken_at")


@query("SELECT DISTINCT chunk_id FROM embedding_chunks c WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.record_id = c.record_id AND source = 'lectures') AND NOT EXISTS (SELECT 1 FROM record_name_metadata m WHERE m.record_id = c.record_id AND m.display_name IS NULL)")
def anti_two_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "record_id").distinct()
    one = read_table(spark, sf_dir, "documents").filter("source = 'lectures'").select("record_id")
    two = read_table(spark, sf_dir, "record_name_metadata").filter("display_name IS NULL").select("record_id")
    return c.join(one, "record_id", "left_anti").join(two, "record_id", "left_anti").select("chunk_id").distinct()


_STATED = "CASE WHEN pdf_page % 9 = 0 THEN 'none' WHEN pdf_page % 7 = 0 THEN sha256('other') ELSE sha256({c}) END"


@query(f"""
    WITH o AS (SELECT page_id, ocr_text AS t, {_STATED.format(c="ocr_text")} AS h FROM pages WHERE length(trim(ocr_text, ' ')) > 0), e AS (SELECT page_id, embedded_text AS t, sha256(embedded_text) AS h FROM pages WHERE length(trim(embedded_text, ' ')) > 0),
    j AS (SELECT p.page_id, CASE WHEN o.t IS NOT NULL THEN 'ocr' WHEN e.t IS NOT NULL THEN 'embedded' END AS lane, coalesce(o.t, e.t) AS t, CASE WHEN o.t IS NOT NULL THEN o.h ELSE e.h END AS h FROM pages p LEFT JOIN o USING (page_id) LEFT JOIN e USING (page_id))
    SELECT page_id, lane, sha256(t) AS text_sha256, array_to_string(list_filter([CASE WHEN lane IS NULL THEN 'missing_candidate' END, CASE WHEN lane IS NOT NULL AND NOT regexp_matches(h, '^[0-9a-f]{{64}}$') THEN 'invalid_output_sha256' END, CASE WHEN h <> sha256(t) THEN 'receipt_hash_mismatch' END], lambda x: x IS NOT NULL), ',') AS issues FROM j""")
def lane_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # receipts of the recognition, some of them with another hash than their text's, or with none
    p = read_table(spark, sf_dir, "pages").select("page_id", "pdf_page", "embedded_text", "ocr_text")
    stated = F.when(F.col("pdf_page") % 9 == 0, "none").when(F.col("pdf_page") % 7 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.sha2("ocr_text", 256))
    ocr = p.filter(F.length(F.trim("ocr_text")) > 0).select("page_id", F.col("ocr_text").alias("text"), stated.alias("sha256"))
    embedded = p.filter(F.length(F.trim("embedded_text")) > 0).select("page_id", F.col("embedded_text").alias("text"), F.sha2("embedded_text", 256).alias("sha256"))
    return rc.lane_choice(p.select("page_id"), [("ocr", ocr), ("embedded", embedded)], ["page_id"]).withColumn("issues", F.array_join("issues", ","))



@query(f"""
    WITH o AS (SELECT page_id, ocr_text AS t, {_STATED.format(c="ocr_text")} AS h FROM pages WHERE length(trim(ocr_text, ' ')) > 0),
    j AS (SELECT p.source_id, o.t IS NOT NULL OR length(trim(p.embedded_text, ' ')) > 0 AS there, CASE WHEN o.t IS NOT NULL THEN 'ocr' WHEN length(trim(p.embedded_text, ' ')) > 0 THEN 'embedded' ELSE 'none' END AS lane, o.t IS NULL OR o.h = sha256(o.t) AS fine FROM pages p LEFT JOIN o USING (page_id))
    SELECT source_id, count(*) AS queue_total, count(*) FILTER (there AND fine) AS terminal_count, count(*) FILTER (NOT there) AS pending_count, count(*) FILTER (there AND NOT fine) AS invalid_terminal_count, round(count(*) FILTER (there AND fine) / count(*), 6) AS coverage_fraction,
           count(*) FILTER (lane = 'ocr') AS ocr_lane, count(*) FILTER (there AND fine) = count(*) AS complete FROM j GROUP BY 1""")
def lane_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lane_receipts(spark, sf_dir).join(read_table(spark, sf_dir, "pages").select("page_id", "source_id"), "page_id")
    done, missing = F.col("issues") == "", F.col("lane").isNull()
    g = r.groupBy("source_id").agg(F.count("*").alias("queue_total"), F.count_if(done).alias("terminal_count"), F.count_if(missing).alias("pending_count"), F.count_if(~done & ~missing).alias("invalid_terminal_count"), F.count_if(F.col("lane") == "ocr").alias("ocr_lane"))
    return g.select("source_id", "queue_total", "terminal_count", "pending_count", "invalid_terminal_count", F.round(F.col("terminal_count") / F.col("queue_total"), 6).alias("coverage_fraction"), "ocr_lane", (F.col("terminal_count") == F.col("queue_total")).alias("complete"))


@query("""
    WITH e AS (SELECT entry_id, source_id, unnest(pdf_pages) AS pdf_page FROM entries), c AS (SELECT DISTINCT source_id, pdf_page, record_id FROM embedding_chunks WHERE review_status = 'approved')
    SELECT entry_id, string_agg(DISTINCT record_id, ',' ORDER BY record_id) AS records FROM e JOIN c USING (source_id, pdf_page) GROUP BY 1""")
def referenced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("entry_id", "source_id", F.explode("pdf_pages").alias("pdf_page"))
    c = read_table(spark, sf_dir, "embedding_chunks").filter("review_status = 'approved'").select("source_id", "pdf_page", "record_id").distinct()
    return e.join(c, ["source_id", "pdf_page"]).groupBy("entry_id").agg(F.array_join(F.array_sort(F.collect_set("record_id")), ",").alias("records"))


@query("""
    SELECT chunk_kind, source_id, pdf_page, char_start, char_end, text_sha256, min_by(chunk_id, {'i': ingested_at, 'c': chunk_id}) AS first, string_agg(chunk_id, ',' ORDER BY ingested_at, chunk_id) AS provenance, count(*) AS n FROM embedding_chunks GROUP BY ALL""")
def spans_with_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["chunk_kind", "source_id", "pdf_page", "char_start", "char_end", "text_sha256"]
    m = rc.merge_by_span(read_table(spark, sf_dir, "embedding_chunks").select(*key, "ingested_at", "chunk_id"), key, ["ingested_at", "chunk_id"], "chunk_id")
    return m.select(*key, "first", F.array_join("provenance", ",").alias("provenance"), F.size("provenance").cast("long").alias("n"))


@query(r"""
    WITH l AS (SELECT page_id, string_split(best_text, chr(10)) AS l, best_text AS t FROM pages WHERE best_text IS NOT NULL), x AS (SELECT page_id, l, t, unnest([0, 1, 2, 3]) AS i FROM l),
    q AS (SELECT page_id, i, t, CASE WHEN 2 * i + 1 <= len(l) THEN array_to_string(l[2*i+1:2*i+2], chr(10)) END AS quote FROM x),
    s AS (SELECT page_id, i, CASE WHEN quote IS NULL THEN 'not_found' WHEN trim(quote, ' ') = '' THEN 'blank' WHEN instr(t, quote) = 0 THEN 'not_found' WHEN instr(substring(t, instr(t, quote) + 1), quote) > 0 THEN 'ambiguous' ELSE 'ok' END AS st FROM q),
    g AS (SELECT page_id, coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (st = 'ok'), '') AS kept, coalesce(string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FILTER (st <> 'ok'), '') AS dropped, count(*) FILTER (st = 'ok') AS n FROM s GROUP BY 1)
    SELECT page_id, CASE WHEN dropped = '' THEN 'pass' WHEN n >= 2 THEN 'repaired' ELSE 'unrepairable' END AS state, kept, dropped FROM g""")
def section_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # four sections of two lines each, whatever the page has: those without an exact, single place are dropped
    p = read_table(spark, sf_dir, "pages").filter("best_text IS NOT NULL").select("page_id", "best_text", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("section"))
    p = p.withColumn("first_line", 2 * F.col("section") + 1).withColumn("last_line", 2 * F.col("section") + 2)
    s = spans.line_locator(p, "best_text", "first_line", "last_line")
    r = rc.drop_only_repair(s.withColumn("locator_status", F.when(F.size(F.split("best_text", "\n")) < F.col("first_line"), "not_found").otherwise(F.col("locator_status"))), "page_id", "section", "locator_status")
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return r.select("page_id", "state", join("kept"), join("dropped"))


@query("""
    WITH f AS (SELECT record_id, source_id, pdf_page, min({'c': char_start, 'k': chunk_id}) AS o FROM embedding_chunks WHERE char_start IS NOT NULL GROUP BY ALL)
    SELECT record_id, source_id, pdf_page, row_number() OVER (PARTITION BY record_id ORDER BY o, source_id, pdf_page) - 1 AS evidence_index FROM f""")
def evidence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").filter("char_start IS NOT NULL").select("record_id", "source_id", "pdf_page", "char_start", "chunk_id")
    e = rc.evidence_index(c, "record_id", ["char_start", "chunk_id"], ["source_id", "pdf_page"])
    return e.withColumn("evidence_index", F.col("evidence_index").cast("long"))


_UNIT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


@query(rf"""
    WITH a AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS ps FROM documents WHERE text IS NOT NULL), b AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS section FROM a),
    c AS (SELECT doc_id, section, unnest(string_split(p, chr(10))) AS line, generate_subscripts(string_split(p, chr(10)), 1) - 1 AS span FROM b), d AS (SELECT doc_id, section, span, len(regexp_extract_all(line, '{_UNIT}')) AS n FROM c),
    e AS (SELECT *, unnest(generate_series(0, CASE WHEN n <= 24 THEN 0 ELSE CAST(ceil((n - 24) / 18.0) AS BIGINT) END)) AS w FROM d WHERE n > 0)
    SELECT format('d{{}}:s{{:02d}}:x{{:02d}}:c{{:02d}}', doc_id, section, span, w) AS chunk_id, w * 18 AS unit_start, least(w * 18 + 24, n) AS unit_end FROM e""")
def section_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "text")
    w = rc.section_windows(d, "doc_id", "text", 24, 6, tx.unit_count(F.col("line")))
    return w.select(F.format_string("d%d:s%02d:x%02d:c%02d", "doc_id", "section", "span", "window_index").alias("chunk_id"), F.col("unit_start").cast("long").alias("unit_start"), F.col("unit_end").cast("long").alias("unit_end"))


@query("""
    SELECT DISTINCT chunk_id, md5('Scientific name: ' || coalesce(m.accepted_scientific_name, m.book_scientific_name, c.scientific_name) || chr(10) || 'Book taxon: ' || coalesce(m.book_scientific_name, c.scientific_name) || chr(10) || 'Display name: ' || coalesce(m.display_name, 'unresolved') || chr(10)
      || 'Display name source scope: ' || coalesce(m.display_name_source_scope, 'unresolved') || chr(10) || 'Section: ' || chunk_kind || chr(10) || 'Book source: ' || source_id || ', PDF page ' || pdf_page || chr(10) || chr(10) || source_text) AS input_md5 FROM embedding_chunks c LEFT JOIN record_name_metadata m USING (record_id)""")
def embedding_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.operators import chunks as ch

    m = read_table(spark, sf_dir, "record_name_metadata")
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "record_id", "scientific_name", "chunk_kind", "source_id", "pdf_page", "source_text").distinct().join(m, "record_id", "left")
    book = F.coalesce("book_scientific_name", "scientific_name")
    made = ch.full_embedding_input(F.coalesce("accepted_scientific_name", book), book, F.col("display_name"), F.col("display_name_source_scope"), F.col("chunk_kind"), F.col("source_id"), F.col("pdf_page"), F.col("source_text"))
    return c.select("chunk_id", F.md5(made).alias("input_md5")).distinct()


@query("SELECT chunk_id, md5('{' || concat_ws(',', '\"chunk_kind\":\"' || chunk_kind || '\"', '\"parent_chunk_id\":\"' || parent_chunk_id || '\"', '\"text_sha256\":\"' || text_sha256 || '\"', '\"token_unit_start\":' || token_unit_start) || '}') AS chain_md5 FROM (SELECT DISTINCT chunk_id, chunk_kind, parent_chunk_id, text_sha256, token_unit_start FROM embedding_chunks)")
def provenance_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "chunk_kind", "parent_chunk_id", "text_sha256", "token_unit_start").distinct()
    return c.select("chunk_id", F.md5(F.to_json(F.struct("chunk_kind", "parent_chunk_id", "text_sha256", "token_unit_start"))).alias("chain_md5"))


@query("""
    WITH w AS (SELECT unnest(['embedding_chunks.chunk_id', 'embedding_chunks.review_note', 'pages.best_text', 'shards.shard_id', 'shards.owner']) AS c)
    SELECT c AS wanted, EXISTS (SELECT 1 FROM information_schema.columns i WHERE i.table_name || '.' || i.column_name = c) AS present FROM w""")
def schema_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # schemas come from the files' footers, no row is read
    wanted = ["embedding_chunks.chunk_id", "embedding_chunks.review_note", "pages.best_text", "shards.shard_id", "shards.owner"]
    have = {f"{t}.{c}" for t in ("embedding_chunks", "pages", "shards") for c in read_table(spark, sf_dir, t).columns}
    return spark.createDataFrame([(w, w in have) for w in wanted], "wanted string, present boolean")


@query("SELECT source_id, bool_and(coalesce(quality IN ('clean', 'usable'), false)) AS all_usable, bool_or(quality = 'empty') AS any_empty, bool_and(pdf_page > 0) AS all_numbered FROM pages GROUP BY 1")
def group_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").groupBy("source_id")
    return p.agg(F.bool_and(F.coalesce(F.col("quality").isin("clean", "usable"), F.lit(False))).alias("all_usable"), F.bool_or(F.col("quality") == "empty").alias("any_empty"), F.bool_and(F.col("pdf_page") > 0).alias("all_numbered"))


@query("""
    WITH u AS (SELECT source_id, unnest(pdf_pages) AS p FROM entries), g AS (SELECT source_id, list_sort(list(DISTINCT p)) AS e FROM u GROUP BY 1), s AS (SELECT source_id, list_sort(list(DISTINCT pdf_page)) AS p FROM pages GROUP BY 1)
    SELECT source_id, len(list_filter(e, lambda x: NOT list_contains(p, x))) = 0 AS subset, e = p AS equal, len(list_filter(e, lambda x: NOT list_contains(p, x))) + len(list_filter(p, lambda x: NOT list_contains(e, x))) AS symmetric_difference FROM g JOIN s USING (source_id)""")
def page_set_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every page with the sides that hold it: no side is gathered into one row
    e = read_table(spark, sf_dir, "entries").select("source_id", F.explode("pdf_pages").alias("p"), F.lit(1).alias("e"), F.lit(0).alias("s"))
    s = read_table(spark, sf_dir, "pages").select("source_id", F.col("pdf_page").alias("p"), F.lit(0).alias("e"), F.lit(1).alias("s"))
    k = e.unionByName(s).groupBy("source_id", "p").agg(F.max("e").alias("e"), F.max("s").alias("s"))
    only_e, only_s = F.count_if(F.expr("e = 1 AND s = 0")), F.count_if(F.expr("e = 0 AND s = 1"))
    g = k.groupBy("source_id").agg(only_e.alias("a"), only_s.alias("b"), F.max("e").alias("he"), F.max("s").alias("hs")).filter("he = 1 AND hs = 1")
    return g.select("source_id", (F.col("a") == 0).alias("subset"), ((F.col("a") == 0) & (F.col("b") == 0)).alias("equal"), (F.col("a") + F.col("b")).alias("symmetric_difference"))


@query("SELECT side, key, n, count(*) OVER (PARTITION BY key) = 1 AS unique_key FROM (SELECT 'chunks' AS side, record_id AS key, count(*) AS n FROM embedding_chunks GROUP BY ALL UNION ALL SELECT 'documents', record_id, count(*) FROM documents GROUP BY ALL)")
def union_with_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [read_table(spark, sf_dir, t).groupBy(F.col("record_id").alias("key")).agg(F.count("*").alias("n")).select(F.lit(s).alias("side"), "key", "n") for s, t in (("chunks", "embedding_chunks"), ("documents", "documents"))]
    u = tb.union_all(parts)
    return u.join(u.groupBy("key").agg((F.count("*") == 1).alias("unique_key")), "key").select("side", "key", "n", "unique_key")


@query("SELECT book_scientific_name AS name, length(book_scientific_name) AS letters FROM (SELECT DISTINCT book_scientific_name FROM record_name_metadata) ORDER BY letters DESC, name LIMIT 50")
def longest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a top-50 report: longest first, then by name
    n = read_table(spark, sf_dir, "record_name_metadata").select(F.col("book_scientific_name").alias("name")).distinct().withColumn("letters", F.length("name").cast("long"))
    return n.orderBy(F.desc("letters"), "name").limit(50)


@query("SELECT record_id, book_scientific_name FROM record_name_metadata ORDER BY book_scientific_name, record_id LIMIT 20 OFFSET 40")
def page_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the third page of twenty
    return read_table(spark, sf_dir, "record_name_metadata").select("record_id", "book_scientific_name").orderBy("book_scientific_name", "record_id").offset(40).limit(20)


@query("SELECT DISTINCT chunk_id, CASE WHEN profile_id = 'child-160-o32' THEN 'approved' ELSE 'candidate' END AS review_status FROM embedding_chunks")
def status_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "profile_id", "review_status")
    return rc.flip_status(c, F.col("profile_id") == "child-160-o32").select("chunk_id", "review_status").distinct()


@query("SELECT h AS sha256, substring(h, 1, 2) || '/' || h || '.txt' AS archive_name, count(*) AS copies FROM (SELECT sha256(text) AS h FROM documents WHERE text IS NOT NULL) GROUP BY 1")
def archive_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.archive_names(read_table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("text"), "text", ".txt")


@query("""
    WITH a AS (SELECT 0 AS k, record_id, min(doc_id) AS v FROM documents GROUP BY 2 UNION ALL SELECT 1, record_id, -count(DISTINCT chunk_id) FROM embedding_chunks GROUP BY 2 UNION ALL SELECT 2, record_id, length(book_scientific_name) FROM record_name_metadata WHERE display_name IS NULL)
    SELECT record_id, max_by(v, k) AS v FROM a GROUP BY 1""")
def replayed_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read_table(spark, sf_dir, "documents").groupBy("record_id").agg(F.min("doc_id").alias("v"))
    b = read_table(spark, sf_dir, "embedding_chunks").groupBy("record_id").agg((-F.countDistinct("chunk_id")).alias("v"))
    c = read_table(spark, sf_dir, "record_name_metadata").filter("display_name IS NULL").select("record_id", F.length("book_scientific_name").cast("long").alias("v"))
    return rc.replay([a, b, c, a.limit(0), c], ["record_id"])  # the last package once more: nothing changes


@query("SELECT user_id, event_id, place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events) WHERE place <= 20")
def recent_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = rc.recent_history(read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"])
    return h.select("user_id", "event_id", F.col("place").cast("long").alias("place"))


_COUNTED = """
    e AS (SELECT DISTINCT entry_id, source_id, unnest(pdf_pages) AS pdf_page FROM entries), q AS (SELECT source_id, pdf_page, max_by(quality, {'i': ingested_at, 'p': page_id}) AS quality FROM pages GROUP BY ALL),
    a AS (SELECT entry_id, coalesce(quality, 'unknown') AS quality, count(*) AS n FROM e JOIN q USING (source_id, pdf_page) GROUP BY ALL), b AS (SELECT DISTINCT entry_id, x.key AS quality, CAST(x.value AS BIGINT) AS n FROM (SELECT entry_id, unnest(map_entries(page_quality_counts)) AS x FROM entries))"""


@query(f"WITH {_COUNTED} SELECT *, 'missing' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)")
def recomputed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stored counts of page qualities come from an earlier freeze: what differs is the result
    entries, pages = read_table(spark, sf_dir, "entries"), read_table(spark, sf_dir, "pages")
    e = entries.select("entry_id", "source_id", F.explode("pdf_pages").alias("pdf_page")).distinct()
    q = pages.groupBy("source_id", "pdf_page").agg(F.max_by("quality", F.struct("ingested_at", "page_id")).alias("quality"))
    found = e.join(q, ["source_id", "pdf_page"]).groupBy("entry_id", F.coalesce("quality", F.lit("unknown")).alias("quality")).agg(F.count("*").alias("n"))
    stored = entries.select("entry_id", F.explode("page_quality_counts").alias("quality", "n")).select("entry_id", "quality", F.col("n").cast("long").alias("n")).distinct()
    return rc.both_ways(stored, found)


_STAGES = """
    c AS (SELECT DISTINCT chunk_id, parent_chunk_id, parent_text_sha256, text_sha256, record_id, source_text, target_token_units AS t, overlap_token_units AS o, token_unit_start AS us, token_unit_end AS ue, dimensions, embedding_json, vector_space_id FROM embedding_chunks),
    p AS (SELECT parent_chunk_id, count(DISTINCT parent_text_sha256) AS hashes FROM c WHERE parent_chunk_id IS NOT NULL GROUP BY 1), q AS (SELECT DISTINCT vector_space_id FROM embedding_queries),
    j AS (SELECT c.*, p.hashes, m.record_id AS mr, m.naming_artifact_sha256 AS nh, q.vector_space_id AS qs FROM c LEFT JOIN p USING (parent_chunk_id) LEFT JOIN record_name_metadata m ON m.record_id = c.record_id LEFT JOIN q ON q.vector_space_id = c.vector_space_id),
    err AS (SELECT chunk_id, unnest([CASE WHEN NOT coalesce(sha256(source_text) = text_sha256, false) THEN 'text_hash' END, CASE WHEN NOT coalesce(hashes = 1, false) THEN 'parent_hash' END, CASE WHEN mr IS NULL THEN 'record' END,
      CASE WHEN NOT coalesce(regexp_matches(nh, '^[0-9a-f]{64}$'), false) THEN 'naming_hash' END, CASE WHEN NOT coalesce(t > o, false) THEN 'window' END, CASE WHEN NOT coalesce(ue > us, false) THEN 'units' END, CASE WHEN NOT coalesce(length(embedding_json) > 2, false) THEN 'result' END, CASE WHEN qs IS NULL THEN 'space' END]) AS error FROM j)"""


def _stage_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    names = ["chunk_id", "parent_chunk_id", "parent_text_sha256", "text_sha256", "record_id", "source_text", "target_token_units", "overlap_token_units", "token_unit_start", "token_unit_end", "embedding_json", "vector_space_id"]
    c = c.select(*names, "dimensions").distinct()
    parents = c.filter("parent_chunk_id IS NOT NULL").groupBy("parent_chunk_id").agg(F.countDistinct("parent_text_sha256").alias("hashes"))
    m = read_table(spark, sf_dir, "record_name_metadata").select("record_id", "naming_artifact_sha256", F.lit(True).alias("known"))
    spaces = read_table(spark, sf_dir, "embedding_queries").select("vector_space_id", F.lit(True).alias("asked")).distinct()
    j = c.join(parents, "parent_chunk_id", "left").join(m, "record_id", "left").join(spaces, "vector_space_id", "left")
    rules = {
        "text_hash": F.sha2("source_text", 256) == F.col("text_sha256"), "parent_hash": F.col("hashes") == 1, "record": F.col("known"), "naming_hash": F.col("naming_artifact_sha256").rlike("^[0-9a-f]{64}$"),
        "window": F.col("target_token_units") > F.col("overlap_token_units"), "units": F.col("token_unit_end") > F.col("token_unit_start"), "result": F.length("embedding_json") > 2, "space": F.col("asked"),
    }
    return tb.checks(j, "chunk_id", rules)


@query(f"WITH {_STAGES} SELECT chunk_id, error FROM err WHERE error IS NOT NULL")
def stage_chain_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_errors(spark, sf_dir)


@query(f"""
    WITH {_STAGES}, b AS (SELECT chunk_id, count(error) AS n FROM err GROUP BY 1), i AS (SELECT count(*) FILTER (n = 0) AS good, count(*) AS n FROM b)
    SELECT check_name, expected, observed, expected = observed AS holds FROM (
      SELECT 'chunks without error' AS check_name, (SELECT n FROM i) AS expected, (SELECT good FROM i) AS observed UNION ALL SELECT 'one row per chunk', (SELECT count(*) FROM embedding_chunks), (SELECT count(DISTINCT chunk_id) FROM embedding_chunks)
      UNION ALL SELECT 'vectors of one dimension a space', (SELECT count(DISTINCT vector_space_id) FROM embedding_chunks), (SELECT count(*) FROM (SELECT DISTINCT vector_space_id, dimensions FROM embedding_chunks))
      UNION ALL SELECT 'chunks in the text index', (SELECT count(DISTINCT chunk_id) FROM embedding_chunks), (SELECT count(DISTINCT chunk_id) FROM embedding_chunks WHERE regexp_matches(concat_ws(' ', scientific_name, source_text), '[\\p{{L}}\\p{{N}}]')))""")
def index_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    bad = _stage_errors(spark, sf_dir).select("chunk_id").distinct().agg(F.count("*").alias("bad"))
    indexed = F.size(tx.terms(F.concat_ws(" ", "scientific_name", "source_text"))) > 0
    n = c.agg(F.count("*").alias("rows"), F.countDistinct("chunk_id").alias("chunks"), F.countDistinct("vector_space_id").alias("spaces"), F.countDistinct(F.struct("vector_space_id", "dimensions")).alias("dims"), F.countDistinct(F.when(indexed, F.col("chunk_id"))).alias("indexed"))
    j = n.crossJoin(bad)  # one row each
    rows = [("chunks without error", F.col("chunks"), F.col("chunks") - F.col("bad")), ("one row per chunk", F.col("rows"), F.col("chunks")), ("vectors of one dimension a space", F.col("spaces"), F.col("dims")), ("chunks in the text index", F.col("chunks"), F.col("indexed"))]
    return j.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), e.alias("expected"), o.alias("observed"), (e == o).alias("holds")) for k, e, o in rows])).alias("r")).select("r.*")


_SYNONYMS = "SELECT record_id, lower(trim(s, ' ')) AS name, a AS accepted, p FROM (SELECT record_id, accepted_scientific_name AS a, accepted_scientific_name AS s, 0 AS p FROM record_name_metadata UNION ALL SELECT record_id, accepted_scientific_name, unnest(string_split(book_scientific_name || '; ' || string_split(accepted_scientific_name, ' ')[1] || ' synonyma', ';')), 1 FROM record_name_metadata) WHERE a IS NOT NULL"


@query(f"""
    WITH s AS ({_SYNONYMS}), ok AS (SELECT * FROM s WHERE len(string_split(name, ' ')) = 2 AND (p = 0 OR string_split(name, ' ')[1] = lower(string_split(accepted, ' ')[1]))), m AS (SELECT name, min({{'p': p, 'a': accepted}}) AS m FROM ok GROUP BY 1)
    SELECT e.entry_id, CASE WHEN m IS NULL THEN 'unresolved' WHEN m.p = 0 THEN 'accepted' ELSE 'alias' END AS status, m.a AS accepted FROM entries e LEFT JOIN m ON m.name = lower(e.book_taxon_candidate)""")
def synonym_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read_table(spark, sf_dir, "record_name_metadata").filter("accepted_scientific_name IS NOT NULL")
    genus = F.split("accepted_scientific_name", " ")[0]
    table = m.select(F.col("accepted_scientific_name").alias("accepted"), F.concat_ws("; ", "book_scientific_name", F.concat(genus, F.lit(" synonyma"))).alias("synonyms"), F.lit("species").alias("rank"))
    return nm.resolve_synonyms(read_table(spark, sf_dir, "entries"), table, "entry_id", "book_taxon_candidate")


_NAME_RULES = {
    "artifact_hash": ("regexp_matches(naming_artifact_sha256, '^[0-9a-f]{64}$')", lambda: F.col("naming_artifact_sha256").rlike("^[0-9a-f]{64}$")),
    "binomial": ("regexp_matches(book_scientific_name, '^[A-Z][a-zë]+ [a-zë]+$')", lambda: F.col("book_scientific_name").rlike("^[A-Z][a-zë]+ [a-zë]+$")),
    "scope": ("display_name_source_scope IN ('taiwan_public', 'book_only', 'unresolved')", lambda: F.col("display_name_source_scope").isin("taiwan_public", "book_only", "unresolved")),
    "public_name": ("display_name_source_scope <> 'taiwan_public' OR display_name IS NOT NULL", lambda: (F.col("display_name_source_scope") != "taiwan_public") | F.col("display_name").isNotNull()),
    "accepted": ("accepted_scientific_name IS NOT NULL", lambda: F.col("accepted_scientific_name").isNotNull()),
    "same_genus": ("accepted_scientific_name IS NULL OR split_part(accepted_scientific_name, ' ', 1) = split_part(book_scientific_name, ' ', 1)", lambda: F.col("accepted_scientific_name").isNull() | (F.substring_index("accepted_scientific_name", " ", 1) == F.substring_index("book_scientific_name", " ", 1))),
}


@query(" UNION ALL ".join(f"SELECT record_id, '{n}' AS error FROM record_name_metadata WHERE NOT coalesce({s}, false)" for n, (s, _) in _NAME_RULES.items()))
def naming_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.checks(read_table(spark, sf_dir, "record_name_metadata"), "record_id", {n: c() for n, (_, c) in _NAME_RULES.items()})


@query("""
    WITH s AS (SELECT record_id, list({'a': source_id, 'u': CAST(pdf_page AS VARCHAR)} ORDER BY chunk_id) AS l FROM (SELECT DISTINCT record_id, chunk_id, source_id, pdf_page FROM embedding_chunks WHERE chunk_kind = 'page-within-target') GROUP BY 1),
    e AS (SELECT record_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM s), f AS (SELECT record_id, x.a AS authority, x.u AS url, min(i) AS i FROM e GROUP BY ALL)
    SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY i) AS place, authority, url FROM f""")
def name_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sources as nested lists of a record, repeated ones among them
    c = read_table(spark, sf_dir, "embedding_chunks").filter("chunk_kind = 'page-within-target'").select("record_id", "chunk_id", "source_id", "pdf_page").distinct()
    lists = c.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "source_id", "pdf_page"))), lambda x: F.struct(x["source_id"].alias("authority"), x["pdf_page"].cast("string").alias("url"))).alias("sources"))
    return rc.first_of_each(lists, "record_id", "sources", ["authority", "url"]).withColumn("place", F.col("place").cast("long"))


@query("""
    WITH u AS (SELECT shard_id, source_id, unnest(generate_series(start_page, end_page)) AS p FROM shards), o AS (SELECT source_id, p, count(DISTINCT shard_id) AS owners FROM u GROUP BY ALL), s AS (SELECT source_id, count(*) FILTER (owners > 1) AS shared_pages FROM o GROUP BY 1),
    g AS (SELECT source_id, count(DISTINCT pdf_page) FILTER (NOT EXISTS (SELECT 1 FROM shards x WHERE x.source_id = pages.source_id AND pdf_page BETWEEN start_page AND end_page)) AS orphan_pages FROM pages GROUP BY 1), k AS (SELECT source_id, count(*) AS shards, count(DISTINCT shard_id) AS ids FROM shards GROUP BY 1)
    SELECT source_id, shards, shards = ids AS unique_ids, shared_pages, orphan_pages, shared_pages = 0 AND orphan_pages = 0 AND shards = ids AS frozen FROM k JOIN s USING (source_id) JOIN g USING (source_id)""")
def shard_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "shards").select("shard_id", "source_id", "start_page", "end_page")
    pages = s.select("shard_id", "source_id", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page"))
    shared = pages.groupBy("source_id", "pdf_page").agg(F.countDistinct("shard_id").alias("n")).groupBy("source_id").agg(F.count_if(F.col("n") > 1).alias("shared_pages"))
    p = read_table(spark, sf_dir, "pages").select("source_id", "pdf_page").distinct()
    orphan = p.join(pages.select("source_id", "pdf_page", F.lit(1).alias("o")).distinct(), ["source_id", "pdf_page"], "left").groupBy("source_id").agg(F.count_if(F.col("o").isNull()).alias("orphan_pages"))
    k = s.groupBy("source_id").agg(F.count("*").alias("shards"), F.countDistinct("shard_id").alias("ids"))
    j = k.join(shared, "source_id").join(orphan, "source_id").withColumn("unique_ids", F.col("shards") == F.col("ids"))
    return j.select("source_id", "shards", "unique_ids", "shared_pages", "orphan_pages", (F.col("unique_ids") & (F.col("shared_pages") == 0) & (F.col("orphan_pages") == 0)).alias("frozen"))


@query("""
    SELECT record_id, CASE WHEN display_name IS NULL THEN 'removed' WHEN display_name_source_scope = 'book_only' THEN 'changed' END AS change FROM record_name_metadata WHERE display_name IS NULL OR display_name_source_scope = 'book_only'
    UNION ALL SELECT 'new-' || record_id, 'added' FROM record_name_metadata WHERE accepted_scientific_name IS NULL""")
def fingerprint_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.streaming import jobs

    old = read_table(spark, sf_dir, "record_name_metadata").select("record_id", "display_name", "display_name_source_scope", "accepted_scientific_name")
    new = old.filter("display_name IS NOT NULL").withColumn("display_name", F.when(F.col("display_name_source_scope") == "book_only", F.concat("display_name", F.lit("*"))).otherwise(F.col("display_name")))
    added = old.filter("accepted_scientific_name IS NULL").withColumn("record_id", F.concat(F.lit("new-"), "record_id"))
    return jobs.fingerprint_changes(old, new.unionByName(added), "record_id", ["display_name", "display_name_source_scope"])


@query("""
    WITH a AS (SELECT lower(accepted_scientific_name) AS n, min(accepted_scientific_name) AS v FROM record_name_metadata WHERE display_name_source_scope = 'taiwan_public' GROUP BY 1), b AS (SELECT lower(book_scientific_name) AS n, min(accepted_scientific_name) AS v FROM record_name_metadata GROUP BY 1),
    c AS (SELECT lower(scientific_name) AS n, min(record_id) AS v FROM embedding_chunks GROUP BY 1)
    SELECT entry_id, coalesce(a.v, b.v, c.v) AS accepted, CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 END AS step FROM entries e LEFT JOIN a ON a.n = lower(book_taxon_candidate) LEFT JOIN b ON b.n = lower(book_taxon_candidate) LEFT JOIN c ON c.n = lower(book_taxon_candidate)""")
def name_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    # first names with a public source, then the book's, then those of the chunks
    e = read_table(spark, sf_dir, "entries").select("entry_id", F.lower("book_taxon_candidate").alias("n"))
    m, c = read_table(spark, sf_dir, "record_name_metadata"), read_table(spark, sf_dir, "embedding_chunks")
    step = lambda df, name, value: e.join(df.groupBy(F.lower(name).alias("n")).agg(F.min(value).alias("accepted")), "n").select("entry_id", "accepted")
    steps = [step(m.filter("display_name_source_scope = 'taiwan_public'"), "accepted_scientific_name", "accepted_scientific_name"), step(m, "book_scientific_name", "accepted_scientific_name"), step(c, "scientific_name", "record_id")]
    return nm.cascade(e, steps, "entry_id")


@query("""
    SELECT 'names' AS release, record_id AS key FROM record_name_metadata WHERE NOT EXISTS (SELECT 1 FROM record_name_metadata WHERE book_scientific_name IS NULL)
    UNION ALL SELECT 'accepted names', record_id FROM record_name_metadata WHERE NOT EXISTS (SELECT 1 FROM record_name_metadata WHERE accepted_scientific_name IS NULL)""")
def released_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a release with a broken row releases nothing
    m = read_table(spark, sf_dir, "record_name_metadata").select(F.col("record_id").alias("key"), "book_scientific_name", "accepted_scientific_name")
    one = lambda n, c: tb.all_or_nothing(m, tb.checks(m, "key", {c: F.col(c).isNotNull()})).select(F.lit(n).alias("release"), "key")
    return one("names", "book_scientific_name").unionByName(one("accepted names", "accepted_scientific_name"))


@query("SELECT source_id, pdf_page, count(*) AS deliveries, count(DISTINCT sha256(coalesce(best_text, ''))) AS texts, count(*) > 1 AS repeated, count(DISTINCT sha256(coalesce(best_text, ''))) > 1 AS differs FROM pages GROUP BY ALL")
def page_hash_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("source_id", "pdf_page", F.sha2(F.coalesce("best_text", F.lit("")), 256).alias("h"))
    # equal deliveries combine before the shuffle
    g = p.groupBy("source_id", "pdf_page", "h").agg(F.count("*").alias("n")).groupBy("source_id", "pdf_page").agg(F.sum("n").alias("deliveries"), F.count("*").alias("texts"))
    return g.withColumn("repeated", F.col("deliveries") > 1).withColumn("differs", F.col("texts") > 1)


_NEW = "SELECT chunk_id, max_by(text_sha256, ingested_at) AS h FROM embedding_chunks WHERE review_status = '{s}' GROUP BY 1"


@query(f"""
    WITH o AS ({_NEW.format(s='approved')}), n AS (SELECT chunk_id, max_by(text_sha256, ingested_at) AS h FROM embedding_chunks WHERE review_status <> 'candidate' GROUP BY 1), j AS (SELECT coalesce(o.chunk_id, n.chunk_id) AS id, o.h AS a, n.h AS b FROM o FULL JOIN n ON o.chunk_id = n.chunk_id)
    SELECT count(a) AS before, count(*) FILTER (a IS NULL) AS inserted, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND a <> b) AS replaced, count(*) FILTER (a = b) AS unchanged, count(*) AS after, true AS repeats FROM j""")
def migration_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an index of approved chunks takes in all that aren't candidates; taking them in again changes nothing
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", F.col("text_sha256").alias("h"), "review_status", "ingested_at")
    pick = lambda cond: c.filter(cond).groupBy("chunk_id").agg(F.max_by("h", "ingested_at").alias("h"))
    return rc.migration(pick("review_status = 'approved'"), pick("review_status <> 'candidate'"), "chunk_id", "h")


@query(r"""
    WITH c AS (SELECT chunk_id, max_by({'r': record_id, 's': review_status, 'n': scientific_name, 't': source_text, 'v': length(embedding_json) > 0}, ingested_at) AS r FROM embedding_chunks GROUP BY 1)
    SELECT chunk_id, r.s AS review_status, m.display_name, coalesce(m.display_name_source_scope, 'unresolved') AS scope, len(regexp_extract_all(concat_ws(' ', r.n, m.display_name, r.t), '[\p{L}\p{N}]+')) AS n_terms, coalesce(r.v, false) AS has_vector
    FROM c LEFT JOIN record_name_metadata m ON m.record_id = r.r WHERE r.s IN ('approved', 'machine_extracted_beta')""")
def index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "record_id", "review_status", "scientific_name", "source_text", (F.length("embedding_json") > 0).alias("v"), "ingested_at")
    c = tb.latest(c, ["chunk_id"], ["ingested_at"])
    both = c.filter("review_status = 'approved'").unionByName(c.filter("review_status = 'machine_extracted_beta'"))
    j = both.join(read_table(spark, sf_dir, "record_name_metadata").select("record_id", "display_name", "display_name_source_scope"), "record_id", "left")
    terms = F.size(tx.terms(F.concat_ws(" ", "scientific_name", "display_name", "source_text"))).cast("long")
    return j.select("chunk_id", "review_status", "display_name", F.coalesce("display_name_source_scope", F.lit("unresolved")).alias("scope"), terms.alias("n_terms"), F.coalesce("v", F.lit(False)).alias("has_vector"))


@query("""
    WITH j AS (SELECT DISTINCT chunk_id, text_sha256, vector_space_id AS space FROM embedding_chunks WHERE text_sha256 IS NOT NULL), d AS (SELECT DISTINCT text_sha256, vector_space_id AS space FROM embedding_chunks WHERE review_status = 'approved' AND length(embedding_json) > 0),
    p AS (SELECT space, text_sha256, min(chunk_id) AS chunk_id, count(*) AS waiting FROM j WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.text_sha256 = j.text_sha256 AND d.space = j.space) GROUP BY ALL)
    SELECT space, CAST(('0x' || substring(text_sha256, 1, 2)) AS BIGINT) % 16 AS batch, count(*) AS texts, sum(waiting) AS chunks, min(chunk_id) AS first_chunk FROM p GROUP BY ALL""")
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    # texts without an approved vector of their space, each once, in batches told by their hash: a batch that is run again is the same
    c = read_table(spark, sf_dir, "embedding_chunks").withColumnRenamed("vector_space_id", "space")
    jobs = c.filter("text_sha256 IS NOT NULL").select("chunk_id", "text_sha256", "space").distinct()
    done = c.filter("review_status = 'approved' AND length(embedding_json) > 0").select("text_sha256", "space")
    p = jobs.join(done, ["text_sha256", "space"], "left_anti").groupBy("space", "text_sha256").agg(F.min("chunk_id").alias("chunk_id"), F.count("*").alias("waiting"))
    batch = F.conv(F.substring("text_sha256", 1, 2), 16, 10).cast("long") % 16
    return p.groupBy("space", batch.alias("batch")).agg(F.count("*").alias("texts"), F.sum("waiting").alias("chunks"), F.min("chunk_id").alias("first_chunk"))
