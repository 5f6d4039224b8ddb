"""Round trips through readers and writers: what is written to the shared folder comes back as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.registry import query
from foliant.session import read_table, shared_folder
from foliant.sources import readers as rd
from foliant.sources import writers as wr


@query("SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "json-lines")
    wr.public_json(read_table(spark, sf_dir, "documents"), ["doc_id", "text", "lang"]).write.text(path)
    return rd.read_json_lines(spark, path, "doc_id long, text string, lang string").select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("SELECT shard_id, source_id, end_page - start_page + 1 AS pages FROM shards")
def json_objects_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one object to a file, found by a pattern over folders
    path = shared_folder(spark, "json-objects")
    s = read_table(spark, sf_dir, "shards").select("shard_id", "source_id", "start_page", "end_page")
    wr.write_objects(s, path, "shard_id")
    back = rd.read_json(spark, f"{path}/*/*.txt", "shard_id string, source_id string, start_page int, end_page int")
    return back.filter("source_file IS NOT NULL").select("shard_id", "source_id", (F.col("end_page") - F.col("start_page") + 1).alias("pages"))


_WORDS = "list_filter(string_split(string_split(best_text, chr(10))[1], ' '), lambda x: regexp_matches(x, '^[A-Za-z]+$'))"


@query(f"""
    WITH w AS (SELECT page_id, {_WORDS} AS w FROM pages WHERE best_text IS NOT NULL)
    SELECT 'p' || page_id AS page, array_to_string(w, ' ') AS text, 10 AS x0, 20 AS y0, 10 * len(w) + 5 AS x1, 30 + len(w) AS y1, CAST((len(w) + 1) / 2.0 AS DOUBLE) AS confidence FROM w WHERE len(w) > 0""")
def scan_xml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the first lines of pages as a recogniser writes them: words with boxes (left, bottom, right, top) and confidences
    p = read_table(spark, sf_dir, "pages").filter("best_text IS NOT NULL")
    words = F.filter(F.split(F.split("best_text", "\n")[0], " "), lambda x: x.rlike("^[A-Za-z]+$"))
    word = lambda x, i: F.concat(F.lit('<WORD coords="'), (10 * (i + 1)).cast("string"), F.lit(","), (31 + i).cast("string"), F.lit(","), (10 * (i + 1) + 5).cast("string"), F.lit(',20" x-confidence="'), (i + 1).cast("string"), F.lit('">'), x, F.lit("</WORD>"))
    xml = F.concat(F.lit('<OBJECT usemap="p'), F.col("page_id").cast("string"), F.lit('"><LINE>'), F.array_join(F.transform("w", word), ""), F.lit("</LINE></OBJECT>"))
    path = shared_folder(spark, "scan-xml")
    objects = p.withColumn("w", words).filter(F.size("w") > 0).select("source_id", F.floor(F.col("pdf_page") / 50).alias("part"), xml.alias("x"))
    files = objects.groupBy("source_id", "part").agg(F.concat(F.lit("<SCAN><BODY>"), F.array_join(F.collect_list("x"), ""), F.lit("</BODY></SCAN>")).alias("value"))  # fifty pages a file
    wr.write_documents(files.withColumn("key", F.concat_ws("-", "source_id", "part")), path, "key", "value")
    return rd.read_scan_xml(spark, f"{path}/*/*.txt").drop("line")


@query("""
    WITH n AS (SELECT DISTINCT source_id, pdf_page, scientific_name AS found FROM embedding_chunks)
    SELECT DISTINCT source_id || ':' || pdf_page AS page, n.found, m.accepted_scientific_name AS confirmed FROM n LEFT JOIN (SELECT book_scientific_name, min(accepted_scientific_name) AS accepted_scientific_name FROM record_name_metadata GROUP BY 1) m ON m.book_scientific_name = n.found""")
def names_xml_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an index of names by page, each name twice
    c = read_table(spark, sf_dir, "embedding_chunks").select("source_id", "pdf_page", F.col("scientific_name").alias("found")).distinct()
    m = read_table(spark, sf_dir, "record_name_metadata").groupBy(F.col("book_scientific_name").alias("found")).agg(F.min("accepted_scientific_name").alias("confirmed"))
    name = F.concat(F.lit("<Name><NameFound>"), "found", F.lit("</NameFound>"), F.coalesce(F.concat(F.lit("<NameConfirmed>"), "confirmed", F.lit("</NameConfirmed>")), F.lit("")), F.lit("</Name>"))
    body = F.array_join(F.collect_list("n"), "")  # the names of one page
    p = c.join(m, "found", "left").select("source_id", "pdf_page", name.alias("n")).groupBy("source_id", "pdf_page").agg(body.alias("b"))
    path = shared_folder(spark, "names-xml")
    page = F.concat(F.lit("<Page><PageID>"), "source_id", F.lit(":"), F.col("pdf_page").cast("string"), F.lit("</PageID><Names>"), "b", "b", F.lit("</Names></Page>"))
    files = p.select("source_id", F.floor(F.col("pdf_page") / 50).alias("part"), page.alias("x")).groupBy("source_id", "part").agg(F.concat(F.lit("<Pages>"), F.array_join(F.collect_list("x"), ""), F.lit("</Pages>")).alias("value"))
    wr.write_documents(files.withColumn("key", F.concat_ws("-", "source_id", "part")), path, "key", "value")
    return rd.read_names_xml(spark, f"{path}/*/*.txt")


@query("SELECT record_id, book_scientific_name AS name, accepted_scientific_name AS accepted FROM record_name_metadata")
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages of a site whose state lies in an attribute, as escaped JSON with nested lists
    m = read_table(spark, sf_dir, "record_name_metadata")
    state = F.to_json(F.struct(F.struct(F.array(F.array(F.struct(F.col("book_scientific_name").alias("name"), F.col("accepted_scientific_name").alias("accepted")))).alias("results")).alias("data")))
    html = F.concat(F.lit('<html><body><div wire:id="1" wire:snapshot="'), F.replace(F.replace(state, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit('"></div></body></html>'))
    schema = "struct<data:struct<results:array<array<struct<name:string,accepted:string>>>>>"
    s = m.select("record_id", rd.embedded_state(html, "wire:snapshot", schema).alias("s"))
    return s.select("record_id", F.explode(F.flatten("s.data.results")).alias("r")).select("record_id", "r.name", "r.accepted")


_RECORD = "'## ' || book_scientific_name || coalesce(chr(10) || '- Display name: ' || nullif(display_name, ''), '') || coalesce(chr(10) || '- Accepted: ' || accepted_scientific_name, '')"


@query(f"SELECT display_name_source_scope AS shard, count(*) AS records, CAST(sum(length({_RECORD})) AS BIGINT) AS characters, true AS complete FROM record_name_metadata GROUP BY 1")
def sharded_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "export")
    m = read_table(spark, sf_dir, "record_name_metadata")
    text = wr.markdown_record(F.col("book_scientific_name"), [("Display name", F.col("display_name")), ("Accepted", F.col("accepted_scientific_name"))])
    manifest = wr.write_sharded_text(m.select("display_name_source_scope", "record_id", text.alias("t")), path, "display_name_source_scope", "record_id", "t")
    back = spark.read.text(path).groupBy("shard").agg(F.count_if(F.col("value").startswith("## ")).alias("found"))
    return manifest.join(back, "shard").select("shard", "records", "characters", (F.col("found") == F.col("records")).alias("complete"))


@query("""
    WITH e AS (SELECT DISTINCT record_id, chunk_id, source_id, pdf_page, text_sha256 FROM embedding_chunks WHERE review_status = 'approved')
    SELECT count(*) AS items, md5(string_agg('[' || record_id || '] ' || source_id || ' p.' || pdf_page || ' ' || text_sha256, chr(10) ORDER BY record_id, chunk_id)) AS pack_md5 FROM e""")
def evidence_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pack is one file that is handed over; its lines are sorted by all tasks and written in order
    path = shared_folder(spark, "pack")
    e = read_table(spark, sf_dir, "embedding_chunks").filter("review_status = 'approved'").select("record_id", "chunk_id", "source_id", "pdf_page", "text_sha256").distinct()
    line = F.concat(F.lit("["), "record_id", F.lit("] "), "source_id", F.lit(" p."), F.col("pdf_page").cast("string"), F.lit(" "), "text_sha256")
    wr.write_pack(e.select("record_id", "chunk_id", line.alias("value")), path, ["record_id", "chunk_id"])
    pack = spark.read.text(f"{path}/*.txt", wholetext=True)
    t = F.regexp_replace("value", r"\n$", "")
    return pack.select(F.size(F.split(t, "\n")).cast("long").alias("items"), F.md5(t).alias("pack_md5"))


@query("SELECT record_id, book_scientific_name FROM record_name_metadata WHERE display_name IS NOT NULL")
def publish_and_roll_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read_table(spark, sf_dir, "record_name_metadata").select("record_id", "display_name", "book_scientific_name")
    t = wr.VersionedTable(spark, shared_folder(spark, "table"))
    t.publish(m.filter("display_name IS NOT NULL"), {"rows": F.count("*") > 0})
    t.publish(m, {"rows": F.count("*") > 0})
    try:
        t.publish(m.limit(0), {"rows": F.count("*") > 0})  # a version that fails its check doesn't become current
    except ValueError:
        pass
    t.roll_back()
    return t.read().select("record_id", "book_scientific_name")


@query("SELECT lang, count(*) AS files, true AS ok FROM (SELECT DISTINCT coalesce(lang, 'none') AS lang FROM documents) GROUP BY 1")
def receipts_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # files with receipts of size and hash, checked after they were written
    path = shared_folder(spark, "files")
    g = read_table(spark, sf_dir, "documents").groupBy(F.coalesce("lang", F.lit("none")).alias("lang")).agg(F.count("*").cast("string").alias("n"))
    g.select("lang", "n").repartition("lang").write.partitionBy("lang").text(path)
    found = rd.file_receipts(spark, f"{path}/*/*.txt")
    state = rd.receipt_check(found, found.select("path", "length", "sha256"))
    return state.groupBy(F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang")).agg(F.count("*").alias("files"), F.bool_and(F.col("state") == "ok").alias("ok"))


_RANGES = "SELECT entry_id, start_pdf_page || '-' || (start_pdf_page + 1) || ', ' || end_pdf_page || ',' || start_pdf_page AS r, start_pdf_page AS a, end_pdf_page AS b FROM entries"


@query(f"WITH r AS ({_RANGES}), p AS (SELECT DISTINCT entry_id, unnest([a, a + 1, b]) AS page FROM r) SELECT entry_id, page FROM p")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries")
    s, z = F.col("start_pdf_page"), F.col("end_pdf_page").cast("string")
    text = F.concat(s.cast("string"), F.lit("-"), (s + 1).cast("string"), F.lit(", "), z, F.lit(","), s.cast("string"))
    return e.select("entry_id", F.explode(rd.page_ranges(text)).alias("page"))


@query("SELECT source_id AS source, unnest(list_distinct(list_filter([1, 10, CAST(floor(n / 4) AS INTEGER), CAST(floor(n / 2) AS INTEGER), n - 10], lambda p: p >= 1 AND p <= n))) AS page FROM (SELECT source_id, CAST(max(pdf_page) AS INTEGER) AS n FROM pages GROUP BY 1)")
def inspected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "pages").groupBy(F.col("source_id").alias("source")).agg(F.max("pdf_page").alias("n"))
    return rd.sample_pages(n, "source", "n")


@query("SELECT doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL")
def fenced_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    # answers of a model: an object within a fence and words around it
    d = read_table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    answer = F.concat(F.lit("Sure, here it is:\n```json\n"), F.to_json(F.struct(F.length("text").cast("long").alias("n"))), F.lit("\n```\nAnything else?"))
    return d.select("doc_id", rd.fenced_json(answer, "n long")["n"].alias("n"))


@query("SELECT DISTINCT record_id FROM documents WHERE record_id NOT IN (SELECT record_id FROM embedding_chunks WHERE record_id IS NOT NULL)")
def shards_to_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wr.missing_shards(read_table(spark, sf_dir, "documents").select("record_id").distinct(), read_table(spark, sf_dir, "embedding_chunks"), "record_id")


@query("""
    WITH o AS (SELECT page_id, unnest(list_filter(string_split(best_text, chr(10)), lambda x: trim(x, ' ') <> '')[1:6]) AS t, generate_subscripts(list_filter(string_split(best_text, chr(10)), lambda x: trim(x, ' ') <> '')[1:6], 1) AS i FROM pages WHERE best_text IS NOT NULL)
    SELECT page_id, string_agg(t, chr(10) ORDER BY i) AS text FROM o GROUP BY 1""")
def recognised_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    # six lines of a page as boxes in disorder, two to a row and slightly askew, the rows 0.05 apart
    lines = F.slice(F.filter(F.split("best_text", "\n"), lambda x: F.trim(x) != ""), 1, 6)
    boxes = F.reverse(F.transform(lines, lambda t, i: F.struct((0.9 - F.floor(i / 2) * 0.05 + (i % 2) * 0.009).alias("y"), (0.1 + (i % 2) * 0.5).alias("x"), t.alias("text"))))
    p = read_table(spark, sf_dir, "pages").filter("best_text IS NOT NULL").select("page_id", boxes.alias("b")).filter(F.size("b") > 0)
    return rd.recognised_lines(p, "page_id", "b")


@query("SELECT lang, n FROM (SELECT coalesce(lang, 'none') AS lang, count(*) AS n FROM documents GROUP BY 1) WHERE length(CAST(n AS VARCHAR)) + 1 > 3")
def file_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # files of counts: those of more than three bytes break the rule on size, none the one on names
    path = shared_folder(spark, "rules")
    g = read_table(spark, sf_dir, "documents").groupBy(F.coalesce("lang", F.lit("none")).alias("lang")).agg(F.count("*").alias("n"))
    wr.write_documents(g.withColumn("t", F.col("n").cast("string")), path, "lang", "t")
    broken = rd.file_rule_errors(spark, f"{path}/*/*", 3, [".txt"], r"^part-[\w.-]+$")
    return broken.filter("error = 'size'").select(F.regexp_extract("path", "object=([^/]*)/", 1).alias("lang")).join(g, "lang")
