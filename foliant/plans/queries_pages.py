"""Queries on page texts: statistics, kinds, recognition, headings, ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import pages as pg
from foliant.operators import spans
from foliant.registry import query
from foliant.session import read_table

_STRIP = r"regexp_replace(coalesce({c}, ''), '^\s+|\s+$', '', 'g')"
_METRICS = r"""
    m AS (SELECT *, length(t) AS n_characters, len(regexp_extract_all(t, '[\p{L}\p{N}]+(?:[-''][\p{L}\p{N}]+)*')) AS n_words,
                 list_filter(string_split(t, chr(10)), lambda x: trim(x, ' ') <> '') AS ls, length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters FROM t),
    s AS (SELECT *, len(ls) AS n_lines, CASE WHEN len(ls) = 0 THEN 1.0 ELSE floor(10000.0 * len(list_filter(ls, lambda x: length(trim(x, ' ')) <= 4)) / len(ls) + 0.5) / 10000 END AS short_lines,
                 CASE WHEN n_characters = 0 THEN 0.0 ELSE floor(10000.0 * n_letters / n_characters + 0.5) / 10000 END AS letters FROM m),
    q AS (SELECT *, CASE WHEN n_characters < 8 THEN 'empty' WHEN n_characters < 120 OR n_words < 18 THEN 'low_text' WHEN short_lines > 0.38 THEN 'fragmented' ELSE 'usable' END AS quality_class FROM s)"""
_PAGES = "WITH t AS (SELECT *, " + _STRIP.format(c="best_text") + " AS t FROM pages)," + _METRICS
_KIND = r"""CASE WHEN n_characters < 8 THEN 'blank_or_image'
      WHEN regexp_matches(lower(t), '\btafel\s+[ivxlcdm0-9]+\b') OR (n_characters < 320 AND regexp_matches(t, '\b[A-Z][a-z]{3,}\s+[a-z][a-z-]{2,}\b')) THEN 'plate_or_caption'
      WHEN pdf_page <= 12 AND regexp_matches(lower(t), 'inhalt|verzeichnis|register|band ') THEN 'frontmatter_or_index'
      WHEN regexp_matches(lower(t), 'sachregister|namenregister|literatur-verzeichnis') THEN 'index' ELSE 'text' END"""


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pg.with_metrics(read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page", "best_text"))
    return p.withColumn("quality_class", pg.quality())


@query(_PAGES + " SELECT page_id, n_characters, n_words, n_lines, short_lines, letters FROM s")
def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).select("page_id", "n_characters", "n_words", "n_lines", "short_lines", "letters")


@query(_PAGES + " SELECT source_id, quality_class, count(*) AS pages FROM q GROUP BY ALL")
def quality_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(spark, sf_dir).groupBy("source_id", "quality_class").agg(F.count("*").alias("pages"))


@query(_PAGES + " SELECT source_id, count(*) FILTER (quality_class = 'empty') AS empty, count(*) FILTER (quality_class = 'low_text') AS low_text, count(*) FILTER (quality_class = 'fragmented') AS fragmented, count(*) FILTER (quality_class = 'usable') AS usable FROM q GROUP BY source_id")
def quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["empty", "low_text", "fragmented", "usable"]
    return _measured(spark, sf_dir).groupBy("source_id").agg(*[F.count_if(F.col("quality_class") == k).alias(k) for k in kinds])


@query(_PAGES + f" SELECT page_id, {_KIND} AS kind, quality_class FROM q")
def page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.with_kind(read_table(spark, sf_dir, "pages").select("page_id", "pdf_page", "best_text")).select("page_id", "kind", "quality_class")


@query(
    _PAGES
    + f""", k AS (SELECT *, {_KIND} AS kind, max(pdf_page) OVER (PARTITION BY source_id) AS last_page FROM q)
    SELECT page_id, source_id, pdf_page,
      CASE WHEN quality_class = 'fragmented' THEN 'layout_fragmentation' WHEN quality_class = 'low_text' THEN 'insufficient_embedded_text' WHEN kind = 'plate_or_caption' THEN 'plate_caption' ELSE 'blank_or_image_check' END AS reason,
      CASE WHEN quality_class = 'fragmented' THEN 'full_page_layout_ocr' WHEN quality_class = 'low_text' THEN 'full_page_ocr' WHEN kind = 'plate_or_caption' THEN 'caption_ocr' ELSE 'visual_text_check' END AS strategy,
      CASE WHEN quality_class = 'fragmented' THEN 1 WHEN quality_class = 'low_text' THEN 2 WHEN kind = 'plate_or_caption' THEN 3 WHEN pdf_page < last_page - 10 THEN 4 ELSE 5 END AS priority
    FROM k WHERE quality_class <> 'usable' OR kind = 'plate_or_caption'"""
)
def recognition_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pg.with_kind(read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page", "best_text")).drop("best_text")
    return pg.recognition_need(p).filter("reason IS NOT NULL").select("page_id", "source_id", "pdf_page", "reason", "strategy", "priority")


@query(r"""
    WITH a AS (SELECT page_id, coalesce(embedded_text, '') AS e, coalesce(ocr_text, '') AS o FROM pages),
    b AS (SELECT *, CASE WHEN length(e) = 0 THEN 0.0 ELSE floor(10000.0 * length(regexp_replace(e, '[^\p{L}]', '', 'g')) / length(e) + 0.5) / 10000 END AS ae, CASE WHEN length(o) = 0 THEN 0.0 ELSE floor(10000.0 * length(regexp_replace(o, '[^\p{L}]', '', 'g')) / length(o) + 0.5) / 10000 END AS ao FROM a)
    SELECT page_id, CASE WHEN length(trim(o, ' ')) = 0 THEN 'no_text_detected' WHEN length(o) > 1.2 * length(e) AND ao >= ae THEN 'candidate_quality_gain' ELSE 'no_quality_gain' END AS gain FROM b""")
def quality_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", pg.quality_gain(F.col("embedded_text"), F.col("ocr_text")).alias("gain"))


@query(r"""
    SELECT page_id, md5(coalesce(CASE WHEN best_method = 'embedded' AND length(trim(embedded_text, ' ')) > 0 THEN embedded_text END, CASE WHEN best_method = 'ocr' AND length(trim(ocr_text, ' ')) > 0 THEN ocr_text END,
      CASE WHEN length(trim(embedded_text, ' ')) > 0 THEN embedded_text END, CASE WHEN length(trim(ocr_text, ' ')) > 0 THEN ocr_text END, '')) AS text_md5 FROM pages""")
def lane_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").withColumns({"embedded": F.col("embedded_text"), "ocr": F.col("ocr_text")})
    return p.select("page_id", F.md5(pg.chosen_text(["embedded", "ocr"], F.col("best_method"))).alias("text_md5"))


@query("SELECT page_id, source_id, pdf_page FROM (SELECT *, row_number() OVER (PARTITION BY source_id, pdf_page ORDER BY ingested_at DESC, page_id DESC) AS rn FROM pages) WHERE rn = 1")
def pages_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.unique_pages(read_table(spark, sf_dir, "pages").select("source_id", "pdf_page", "page_id", "ingested_at")).select("page_id", "source_id", "pdf_page")


@query("SELECT source_id, pdf_page, count(*) AS n FROM pages GROUP BY ALL HAVING count(*) > 1")
def page_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from foliant.operators.tables import duplicates

    return duplicates(read_table(spark, sf_dir, "pages"), ["source_id", "pdf_page"])


@query("SELECT p.page_id, p.source_id, p.pdf_page, s.shard_id FROM pages p JOIN shards s ON s.source_id = p.source_id AND p.pdf_page BETWEEN s.start_page AND s.end_page")
def range_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page")
    s = read_table(spark, sf_dir, "shards").select("shard_id", "source_id", "start_page", "end_page")
    return spans.range_owner(p, s, "source_id", "pdf_page", "start_page", "end_page").select("page_id", "source_id", "pdf_page", "shard_id")


@query("""
    WITH e AS (SELECT source_id, start_pdf_page, max(book_taxon_candidate) AS taxon FROM entries GROUP BY ALL)
    SELECT p.page_id, p.source_id, p.pdf_page, (SELECT max_by(e.taxon, e.start_pdf_page) FROM e WHERE e.source_id = p.source_id AND e.start_pdf_page < p.pdf_page) AS taxon FROM pages p""")
def asof_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page")
    e = read_table(spark, sf_dir, "entries").select("source_id", F.col("start_pdf_page").alias("pdf_page"), F.col("book_taxon_candidate").alias("taxon"))
    return spans.last_before(p, e, "source_id", "pdf_page", "taxon", 32)


@query("""
    WITH l AS (SELECT source_id, max(pdf_page) AS last_page FROM pages GROUP BY 1), e AS (SELECT DISTINCT source_id, start_pdf_page FROM entries)
    SELECT e.source_id, e.start_pdf_page, lead(start_pdf_page) OVER (PARTITION BY e.source_id ORDER BY start_pdf_page) AS next_start,
           coalesce(lead(start_pdf_page) OVER (PARTITION BY e.source_id ORDER BY start_pdf_page) - 1, last_page) AS end_page FROM e JOIN l USING (source_id)""")
def heading_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = read_table(spark, sf_dir, "pages").groupBy("source_id").agg(F.max("pdf_page").alias("last_page"))
    e = read_table(spark, sf_dir, "entries").select("source_id", "start_pdf_page").distinct()
    return spans.spans_to_next(e, "source_id", "start_pdf_page", ends, "last_page")


@query(r"""
    WITH h AS (SELECT page_id, best_text, instr(best_text, 'dry') AS pos FROM pages),
    x AS (SELECT page_id, substring(array_to_string(list_transform(list_filter(string_split(best_text, chr(10)), lambda x: trim(x, ' ') <> '')[1:6], lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ')), ' | '), 1, 500) AS heading_excerpt FROM h WHERE pos BETWEEN 1 AND 1001)
    SELECT page_id, heading_excerpt, regexp_extract(heading_excerpt, '([A-Z][a-z]{2,}) ([a-z]{3,})', 0) AS taxon FROM x""")
def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.headings(read_table(spark, sf_dir, "pages").select("page_id", "best_text"), marker="dry").select("page_id", "heading_excerpt", "taxon")


@query("SELECT entry_id, heading_excerpt, regexp_extract(heading_excerpt, '([A-Z][a-z]{2,}) ([a-z]{3,})', 0) AS taxon, string_split(heading_excerpt, ' | ')[1] AS first_line, len(string_split(heading_excerpt, ' | ')) AS parts FROM entries")
def heading_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("heading_excerpt", r" \| ")
    return read_table(spark, sf_dir, "entries").select("entry_id", "heading_excerpt", F.regexp_extract("heading_excerpt", tx.BINOMIAL, 0).alias("taxon"), parts[0].alias("first_line"), F.size(parts).cast("long").alias("parts"))


@query("""
    WITH e AS (SELECT DISTINCT entry_id, source_id, unnest(pdf_pages) AS pdf_page FROM entries),
    q AS (SELECT DISTINCT source_id, pdf_page, coalesce(quality, 'unknown') AS quality FROM pages)
    SELECT entry_id, quality, count(*) AS pages FROM e JOIN q USING (source_id, pdf_page) GROUP BY ALL""")
def entry_page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("entry_id", "source_id", F.explode("pdf_pages").alias("pdf_page")).distinct()
    q = read_table(spark, sf_dir, "pages").select("source_id", "pdf_page", F.coalesce("quality", F.lit("unknown")).alias("quality")).distinct()
    return e.join(q, ["source_id", "pdf_page"]).groupBy("entry_id", "quality").agg(F.count("*").alias("pages"))


@query("""
    SELECT entry_id, i + 1 AS package, array_to_string(pdf_pages[i*6+1:i*6+6], ',') AS pages
    FROM (SELECT entry_id, pdf_pages, unnest(generate_series(0, CAST(floor((len(pdf_pages) - 1) / 6) AS BIGINT))) AS i FROM entries WHERE len(pdf_pages) > 0)""")
def split_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spans.packages(read_table(spark, sf_dir, "entries").select("entry_id", "pdf_pages"), "pdf_pages")
    return e.select("entry_id", F.col("package").cast("long").alias("package"), F.array_join(F.transform("package_pages", lambda x: x.cast("string")), ",").alias("pages"))


@query("""
    SELECT source_id, min(pdf_page) AS first_page, max(pdf_page) AS last_page, count(pdf_page) AS n_rows, count(DISTINCT pdf_page) AS n_pages,
           max(pdf_page) - min(pdf_page) + 1 = count(pdf_page) AND count(pdf_page) = count(DISTINCT pdf_page) AS exact FROM pages GROUP BY 1""")
def page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.exact_coverage(read_table(spark, sf_dir, "pages"), "source_id", "pdf_page")


@query("""
    WITH u AS (SELECT source_id, unnest(generate_series(start_page, end_page)) AS p FROM shards)
    SELECT source_id, min(p) AS first_page, max(p) AS last_page, count(p) AS n_rows, count(DISTINCT p) AS n_pages, max(p) - min(p) + 1 = count(p) AND count(p) = count(DISTINCT p) AS exact FROM u GROUP BY 1""")
def shard_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "shards").select("source_id", F.explode(F.sequence("start_page", "end_page")).alias("p"))
    return spans.exact_coverage(s, "source_id", "p")


@query(r"""
    WITH x AS (SELECT page_id, best_text, string_split(best_text, chr(10))[2:4] AS l, len(string_split(best_text, chr(10))) AS n FROM pages WHERE best_text IS NOT NULL),
    y AS (SELECT page_id, best_text, array_to_string(l, chr(10)) AS quote FROM x),
    z AS (SELECT *, instr(best_text, quote) AS pos, instr(substring(best_text, greatest(instr(best_text, quote), 0) + 1), quote) AS again FROM y)
    SELECT page_id, CASE WHEN trim(quote, ' ') = '' THEN 'blank' WHEN pos = 0 THEN 'not_found' WHEN again > 0 THEN 'ambiguous' ELSE 'ok' END AS locator_status,
           CASE WHEN trim(quote, ' ') <> '' AND pos > 0 AND again = 0 THEN pos - 1 END AS char_start, CASE WHEN trim(quote, ' ') <> '' AND pos > 0 AND again = 0 THEN pos - 1 + length(quote) END AS char_end FROM z""")
def line_span_locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").filter("best_text IS NOT NULL").select("page_id", "best_text", F.lit(2).alias("first_line"), F.lit(4).alias("last_line"))
    return spans.line_locator(p, "best_text", "first_line", "last_line").select("page_id", "locator_status", F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"))


@query(r"""
    WITH t AS (SELECT page_id, best_text AS t, instr(best_text, 'The ') AS a FROM pages), u AS (SELECT page_id, substring(t, a) AS tail FROM t WHERE a > 0),
    v AS (SELECT page_id, tail, instr(substring(tail, 5), '.') AS stop FROM u)
    SELECT page_id, trim(CASE WHEN stop > 0 THEN substring(tail, 1, stop + 3) ELSE tail END, ' ') AS passage FROM v""")
def marked_passage(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", spans.marked_range(F.col("best_text"), "The ", ".").alias("passage"))
    return p.filter("passage IS NOT NULL")


@query(r"""
    WITH x AS (SELECT doc_id, string_split(replace(text, chr(10) || chr(10), chr(12)), chr(12)) AS ps FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, i AS pdf_page, md5(ps[i]) AS page_md5 FROM (SELECT doc_id, ps, unnest(generate_series(1, len(ps))) AS i FROM x)""")
def form_feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # paragraphs stand for pages: texts as an extractor writes them, one page after another
    d = read_table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.replace("text", F.lit("\n\n"), F.lit("\f")).alias("body"))
    out = pg.form_feed_pages(d, "doc_id", "body")
    return out.select("doc_id", F.col("pdf_page").cast("long").alias("pdf_page"), F.md5("page_text").alias("page_md5"))
