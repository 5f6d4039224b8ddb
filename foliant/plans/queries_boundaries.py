"""Queries of boundaries: headings of pages, evidence for them, dispositions, scores, plans, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import boundaries as bd
from foliant.operators import pages as pg
from foliant.operators import spans
from foliant.registry import query
from foliant.session import read_table

_L = "A-Za-zÄÖÜäöüßÀ-ÖØ-öø-ÿ"
_HEAD = rf"^\s*([A-ZÄÖÜ][{_L}]{{2,}})\s+([{_L}][{_L}-]{{2,}})(?:[^{_L}0-9_-]|$)"
_STOP = ", ".join(f"'{w}'" for w in bd.OPENING_WORDS)
_PART = ", ".join(f"'{w}'" for w in bd.PARTICLES)


@query(rf"""
    SELECT entry_id, CASE WHEN regexp_matches(regexp_replace(heading_excerpt, '\s+', ' ', 'g'), '{_HEAD}') THEN lower(regexp_extract(regexp_replace(heading_excerpt, '\s+', ' ', 'g'), '{_HEAD}', 1) || ' ' || regexp_extract(regexp_replace(heading_excerpt, '\s+', ' ', 'g'), '{_HEAD}', 2)) END AS taxon FROM entries""")
def canonical_taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "entries").select("entry_id", bd.canonical_taxon(F.col("heading_excerpt")).alias("taxon"))


_CANDIDATES = rf"""
    l AS (SELECT page_id, list_filter(list_transform(string_split(coalesce(best_text, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')[1:12] AS ls, array_to_string(string_split(coalesce(best_text, ''), chr(10))[1:24], chr(10)) AS head FROM pages),
    u AS (SELECT page_id, head, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM l),
    k AS (SELECT page_id, head, line, i, regexp_extract(line, '{_HEAD}', 1) AS genus, regexp_extract(line, '{_HEAD}', 2) AS species FROM u WHERE regexp_matches(line, '{_HEAD}')),
    c AS (SELECT page_id, arg_min(genus || ' ' || species, i) AS taxon, min(i) - 1 AS line_order, arg_min(line, i) AS heading_line, any_value(head) AS head FROM k WHERE genus NOT IN ({_STOP}) AND lower(species) NOT IN ({_PART}) GROUP BY 1),
    cand AS (SELECT page_id, taxon, line_order, heading_line, array_to_string(list_filter([CASE WHEN regexp_matches(head, '(?i)\bBeschreibung\b') THEN 'beschreibung' END, CASE WHEN regexp_matches(head, '(?i)\bFamilie\b') THEN 'familie' END,
               CASE WHEN regexp_matches(head, '(?i)\bGattung\b') THEN 'gattung' END, CASE WHEN regexp_matches(head, '(?i)\bSyn\.?\s*[:.]?') THEN 'synonym' END], lambda x: x IS NOT NULL), ',') AS signals FROM c)"""


@query(f"WITH {_CANDIDATES} SELECT * FROM cand")
def heading_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = bd.heading_candidates(read_table(spark, sf_dir, "pages").select("page_id", "best_text"), "page_id", "best_text")
    return h.select("page_id", "taxon", F.col("line_order").cast("long").alias("line_order"), "heading_line", F.array_join("signals", ",").alias("signals"))


# a verifier's answers, made of the names at hand: exact where a name is accepted, fuzzy where it only stands in the book
_VERIFIED = "v AS (SELECT lower(n) AS name, min(m) AS match FROM (SELECT accepted_scientific_name AS n, 'Exact' AS m FROM record_name_metadata WHERE accepted_scientific_name IS NOT NULL UNION ALL SELECT book_scientific_name, 'Fuzzy' FROM record_name_metadata) GROUP BY 1)"


def _verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read_table(spark, sf_dir, "record_name_metadata")
    names = m.filter("accepted_scientific_name IS NOT NULL").select(F.lower("accepted_scientific_name").alias("name"), F.lit("Exact").alias("match")).unionByName(m.select(F.lower("book_scientific_name").alias("name"), F.lit("Fuzzy").alias("match")))
    return names.groupBy("name").agg(F.min("match").alias("match"))


@query(f"""
    WITH {_VERIFIED}, b AS (SELECT DISTINCT lower(scientific_name) AS name FROM embedding_chunks)
    SELECT entry_id, match, CASE WHEN match = 'Exact' AND b.name IS NOT NULL THEN 3 WHEN match = 'Exact' THEN 2 WHEN match = 'Fuzzy' THEN 1 ELSE 0 END AS score FROM entries e LEFT JOIN v ON v.name = lower(book_taxon_candidate) LEFT JOIN b ON b.name = lower(book_taxon_candidate)""")
def name_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("entry_id", F.lower("book_taxon_candidate").alias("name"))
    found = read_table(spark, sf_dir, "embedding_chunks").select(F.lower("scientific_name").alias("name"), F.lit(True).alias("found")).distinct()
    j = e.join(_verified(spark, sf_dir), "name", "left").join(found, "name", "left")
    return j.select("entry_id", "match", bd.name_score(F.col("match"), F.size(F.split("name", " ")), (F.col("match") == "Exact") & F.col("found")).alias("score"))


_OFFSET = """
    a AS (SELECT DISTINCT source_id, start_pdf_page AS p, lower(book_taxon_candidate) AS n FROM entries), b AS (SELECT DISTINCT source_id, pdf_page + 1 AS p, lower(scientific_name) AS n FROM embedding_chunks),
    s AS (SELECT a.source_id, o.shift, sum(CASE WHEN EXISTS (SELECT 1 FROM b x WHERE x.source_id = a.source_id AND x.n = a.n AND x.p = a.p + o.shift - 1) THEN 1 ELSE 2 END) AS score
          FROM a CROSS JOIN (SELECT unnest(generate_series(-2, 2)) AS shift) o WHERE EXISTS (SELECT 1 FROM b WHERE b.source_id = a.source_id AND b.n = a.n AND b.p = a.p + o.shift) GROUP BY ALL),
    m AS (SELECT source_id, max(score) AS best FROM s GROUP BY 1), w AS (SELECT s.source_id, min(shift) AS shift, max(best) AS score, count(*) AS winners FROM s JOIN m USING (source_id) WHERE score = best GROUP BY 1)"""


@query(f"WITH {_OFFSET} SELECT t.source_id, CASE WHEN winners = 1 THEN shift END AS shift, CAST(coalesce(score, 0) AS BIGINT) AS score, coalesce(winners, 0) AS winners FROM (SELECT DISTINCT source_id FROM entries) t LEFT JOIN w USING (source_id)")
def page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    # another count of the pages, one ahead
    h = read_table(spark, sf_dir, "entries").select("source_id", F.col("start_pdf_page").alias("page"), F.lower("book_taxon_candidate").alias("taxon")).distinct()
    n = read_table(spark, sf_dir, "embedding_chunks").select("source_id", (F.col("pdf_page") + 1).alias("page"), F.lower("scientific_name").alias("taxon"))
    return bd.page_offset(h, n)


_READINGS = rf"""
    {_CANDIDATES.replace("best_text", "embedded_text").replace(" l AS", " l1 AS").replace("FROM l)", "FROM l1)").replace(" u AS", " u1 AS").replace("FROM u WHERE", "FROM u1 WHERE").replace(" k AS", " k1 AS").replace("FROM k WHERE", "FROM k1 WHERE").replace(" c AS", " c1 AS").replace("FROM c)", "FROM c1)").replace("cand AS", "cand1 AS")},
    {_CANDIDATES.replace("best_text", "ocr_text").replace(" l AS", " l2 AS").replace("FROM l)", "FROM l2)").replace(" u AS", " u2 AS").replace("FROM u WHERE", "FROM u2 WHERE").replace(" k AS", " k2 AS").replace("FROM k WHERE", "FROM k2 WHERE").replace(" c AS", " c2 AS").replace("FROM c)", "FROM c2)").replace("cand AS", "cand2 AS")},
    {_VERIFIED}, ix AS (SELECT DISTINCT source_id, pdf_page, lower(scientific_name) AS name FROM embedding_chunks), st AS (SELECT DISTINCT source_id, start_pdf_page AS pdf_page FROM entries),
    r0 AS (SELECT p.page_id, p.source_id, p.pdf_page, lower(a.taxon) AS lt, lower(b.taxon) AS et, a.line_order AS lo, b.line_order AS eo, coalesce(a.signals, '') || coalesce(b.signals, '') <> '' AS structural, st.pdf_page IS NOT NULL AS is_start
           FROM pages p LEFT JOIN cand1 a USING (page_id) LEFT JOIN cand2 b USING (page_id) LEFT JOIN st ON st.source_id = p.source_id AND st.pdf_page = p.pdf_page),
    r1 AS (SELECT r0.*, CASE x.match WHEN 'Exact' THEN 3 WHEN 'Fuzzy' THEN 1 ELSE 0 END AS ls, CASE y.match WHEN 'Exact' THEN 3 WHEN 'Fuzzy' THEN 1 ELSE 0 END AS es FROM r0 LEFT JOIN v x ON x.name = lt LEFT JOIN v y ON y.name = et),
    r2 AS (SELECT *, ls > es AS pl, greatest(ls, es) AS sc, least(ls, es) AS ot, CASE WHEN ls > es OR et IS NULL THEN lt ELSE et END AS pt, coalesce(CASE WHEN ls > es OR et IS NULL THEN lo ELSE eo END, 99) AS po FROM r1),
    r3 AS (SELECT *, EXISTS (SELECT 1 FROM ix WHERE ix.source_id = r2.source_id AND ix.pdf_page = r2.pdf_page AND ix.name = pt) AS on_page FROM r2),
    r4 AS (SELECT *, CASE WHEN structural AND (sc = 3 AND (coalesce(lt = et, false) OR on_page OR coalesce(lt <> et, false) AND ot < 3 AND least(coalesce(lo, 99), coalesce(eo, 99)) <= 1) OR sc = 1 AND on_page AND po <= 1)
                THEN CASE WHEN is_start THEN 'confirmed_parent_heading' ELSE 'confirmed_hidden_heading' END WHEN lt IS NOT NULL OR et IS NOT NULL THEN 'candidate_needs_secondary_evidence' ELSE 'no_page_heading_detected' END AS decision FROM r3)"""


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page", "embedded_text", "ocr_text")
    side = lambda c, n: bd.heading_candidates(p, "page_id", c).select("page_id", F.lower("taxon").alias(f"{n}_taxon"), F.col("line_order").alias(f"{n}_order"), (F.size("signals") > 0).alias(f"{n}_signal"))
    v = _verified(spark, sf_dir).withColumn("score", bd.name_score(F.col("match"), F.lit(2), F.col("match") == "Exact"))
    scored = lambda df, n: df.join(v.select(F.col("name").alias(f"{n}_taxon"), F.col("score").alias(f"{n}_s")), f"{n}_taxon", "left").withColumn(f"{n}_score", F.coalesce(f"{n}_s", F.lit(0))).drop(f"{n}_s")
    starts = read_table(spark, sf_dir, "entries").select("source_id", F.col("start_pdf_page").alias("pdf_page"), F.lit(True).alias("start")).distinct()
    j = p.select("page_id", "source_id", "pdf_page").join(side("embedded_text", "local"), "page_id", "left").join(side("ocr_text", "external"), "page_id", "left").join(starts, ["source_id", "pdf_page"], "left")
    j = scored(scored(j, "local"), "external")
    preferred = F.when((F.col("local_score") > F.col("external_score")) | F.col("external_taxon").isNull(), F.col("local_taxon")).otherwise(F.col("external_taxon"))
    index = read_table(spark, sf_dir, "embedding_chunks").select("source_id", "pdf_page", F.lower("scientific_name").alias("preferred"), F.lit(True).alias("named")).distinct()
    j = j.withColumn("preferred", preferred).join(index, ["source_id", "pdf_page", "preferred"], "left")
    false = lambda c: F.coalesce(F.col(c), F.lit(False))
    j = j.withColumns({"on_page": false("named"), "is_start": false("start"), "structural": false("local_signal") | false("external_signal"), "fuzzy": F.greatest("local_score", "external_score") == 1})
    return bd.boundary_decision(j)


@query(f"WITH {_READINGS} SELECT page_id, lt AS local_taxon, et AS external_taxon, pt AS preferred, on_page, decision FROM r4")
def boundary_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select("page_id", "local_taxon", "external_taxon", "preferred", "on_page", "decision")


_PLAN = f"""{_READINGS}, pa AS (SELECT source_id || ':' || owner_shard AS parent, source_id, min(start_pdf_page) AS s, max(end_pdf_page) AS e, arg_min(book_taxon_candidate, start_pdf_page) AS taxon FROM entries GROUP BY ALL),
    q1 AS (SELECT DISTINCT pa.parent, r4.pdf_page AS p, r4.pt AS taxon FROM r4 JOIN pa ON pa.source_id = r4.source_id AND r4.pdf_page > pa.s AND r4.pdf_page <= pa.e WHERE decision IN ('confirmed_hidden_heading', 'confirmed_parent_heading')),
    q2 AS (SELECT parent, p, min(taxon) AS taxon FROM (SELECT * FROM q1 UNION ALL SELECT parent, s, taxon FROM pa) GROUP BY ALL),
    q3 AS (SELECT q2.parent, taxon, p, coalesce(lead(p) OVER o - 1, e) AS e, row_number() OVER o AS child FROM q2 JOIN (SELECT parent, e FROM pa) z USING (parent) WINDOW o AS (PARTITION BY q2.parent ORDER BY p)),
    rv AS (SELECT DISTINCT pa.parent FROM r4 JOIN pa ON pa.source_id = r4.source_id AND r4.pdf_page BETWEEN pa.s AND pa.e WHERE decision = 'candidate_needs_secondary_evidence' AND sc >= 1 AND po <= 1 AND (structural OR on_page))"""


@query(f"""WITH {_PLAN} SELECT q3.parent, q3.parent || ':child-' || lpad(CAST(child AS VARCHAR), 2, '0') AS child, q3.taxon, p AS start_page, q3.e AS end_page, q3.e - p + 1 AS n_pages, q3.e - p + 1 > 6 AS needs_split,
    sum(q3.e - p + 1) OVER (PARTITION BY q3.parent) = pa.e - pa.s + 1 AS exact_coverage, sum(q3.e - p + 1) OVER (PARTITION BY q3.parent) = pa.e - pa.s + 1 AND rv.parent IS NULL AS safe FROM q3 JOIN pa USING (parent) LEFT JOIN rv USING (parent)""")
def overlay_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the stretch of each shard's entries as a parent, cut where pages confirm a heading
    e = read_table(spark, sf_dir, "entries")
    parent = F.concat_ws(":", "source_id", "owner_shard")
    parents = e.groupBy(parent.alias("parent"), "source_id").agg(F.min_by("book_taxon_candidate", "start_pdf_page").alias("taxon"), F.min("start_pdf_page").alias("start_page"), F.max("end_pdf_page").alias("end_page"))
    d = _decided(spark, sf_dir)
    order = F.coalesce(F.when((F.col("local_score") > F.col("external_score")) | F.col("external_taxon").isNull(), F.col("local_order")).otherwise(F.col("external_order")), F.lit(99))
    d = d.select("source_id", F.col("pdf_page").alias("page"), F.col("preferred").alias("taxon"), "decision", (order <= 1).alias("first"), (F.greatest("local_score", "external_score") >= 1).alias("known"), (F.col("structural") | F.col("on_page")).alias("backed"))
    owned = spans.range_owner(d, parents.select("parent", "source_id", "start_page", "end_page"), "source_id", "page", "start_page", "end_page").select("parent", "page", "taxon", "decision", "first", "known", "backed")
    hidden = owned.filter("decision LIKE 'confirmed%'")
    return bd.overlay_plan(parents.drop("source_id"), hidden, owned.filter("decision = 'candidate_needs_secondary_evidence' AND first AND known AND backed").select("parent", "page").distinct())


_PAGE_ONCE = "pg AS (SELECT source_id, pdf_page, max_by({'q': quality, 'n': needs_ocr, 'a': alpha_ratio, 's': short_line_ratio, 'c': character_count, 't': best_text}, {'i': ingested_at, 'p': page_id}) AS r FROM pages GROUP BY ALL)"
_SPAN = "sp AS (SELECT source_id, start_pdf_page AS s, end_pdf_page AS e, lead(start_pdf_page) OVER (PARTITION BY source_id ORDER BY start_pdf_page) AS nx FROM (SELECT DISTINCT source_id, start_pdf_page, end_pdf_page FROM entries))"


def _page_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page", "ingested_at", "quality", "needs_ocr", "alpha_ratio", "short_line_ratio", "character_count", F.col("best_text").alias("text"))
    return pg.unique_pages(p)


def _entry_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "entries").select("source_id", F.col("start_pdf_page").alias("start_page"), F.col("end_pdf_page").alias("end_page")).distinct()
    ends = e.groupBy("source_id").agg(F.max("end_page").alias("last_page"))
    return spans.spans_to_next(e.drop("end_page"), "source_id", "start_page", ends, "last_page").select("source_id", "start_page", "end_page", "next_start")


@query(f"""
    WITH {_PAGE_ONCE}, {_SPAN}, ap AS (SELECT DISTINCT source_id, pdf_page FROM pages WHERE review_status = 'approved' AND pdf_page % 10 = 0),
    x AS (SELECT sp.source_id, s, coalesce(nx - 1, max(e) OVER (PARTITION BY sp.source_id)) AS e, nx FROM sp), y AS (SELECT x.*, unnest(generate_series(s, e)) AS p FROM x),
    z AS (SELECT y.*, r.q AS q, r.n AS n, ap.pdf_page AS a FROM y JOIN pg ON pg.source_id = y.source_id AND pg.pdf_page = y.p LEFT JOIN ap ON ap.source_id = y.source_id AND ap.pdf_page = y.p),
    h AS (SELECT source_id, s, e, nx, string_agg(c, ',' ORDER BY c) AS qualities FROM (SELECT source_id, s, e, nx, coalesce(q, 'unknown') || '=' || count(*) AS c FROM z GROUP BY source_id, s, e, nx, q) GROUP BY ALL),
    g AS (SELECT source_id, s, e, count(a) AS n_over, coalesce(string_agg(CAST(a AS VARCHAR), ',' ORDER BY a), '') AS overlap_pages, bool_or(NOT coalesce(q IN ('clean', 'usable'), false)) AS poor, bool_or(n) AS ocr FROM z GROUP BY ALL),
    d AS (SELECT h.*, overlap_pages, ocr, CASE WHEN nx IS NULL THEN 'hold_terminal_no_next_heading' WHEN n_over > 0 THEN 'already_approved_overlap' WHEN h.e - h.s + 1 > 20 THEN 'hold_span_over_limit' WHEN poor THEN 'hold_page_quality' ELSE 'eligible_local_structure' END AS disposition FROM h JOIN g ON g.source_id = h.source_id AND g.s = h.s AND g.e = h.e)
    SELECT source_id, s AS start_page, e AS end_page, e - s + 1 AS n_pages, qualities, overlap_pages, disposition, ocr OR disposition IN ('hold_terminal_no_next_heading', 'hold_page_quality') AS needs_review FROM d""")
def entry_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages approved already: of the approved ones those of a round number
    approved = read_table(spark, sf_dir, "pages").filter("review_status = 'approved' AND pdf_page % 10 = 0").select("source_id", "pdf_page")
    d = bd.entry_dispositions(_entry_spans(spark, sf_dir), _page_once(spark, sf_dir).select("source_id", "pdf_page", "quality", "needs_ocr"), approved, 20)
    return d.withColumn("overlap_pages", F.array_join(F.transform("overlap_pages", lambda x: x.cast("string")), ","))


_CLOSING = ("Drogen und Präparate", "Tafelbeschreibung", "Literatur", "Tafel", "Anmerkung")


@query(f"""
    WITH {_PAGE_ONCE}, {_SPAN}, x AS (SELECT sp.source_id, s, coalesce(nx - 1, max(e) OVER (PARTITION BY sp.source_id)) AS e FROM sp), y AS (SELECT x.*, unnest(generate_series(s, e)) AS p FROM x),
    g AS (SELECT y.source_id, s, e, count(*) AS n, bool_and(coalesce(r.q IN ('clean', 'usable'), false)) AS fine, avg(r.a) AS a, avg(r.s) AS sh, avg(r.c) AS c, right(max_by(r.t, p), 1200) AS tail FROM y JOIN pg ON pg.source_id = y.source_id AND pg.pdf_page = y.p GROUP BY ALL)
    SELECT source_id, s AS start_page, round(100 + 24 * a - 28 * sh - 2.5 * abs(n - 3) + CASE WHEN regexp_matches(tail, '{"|".join(_CLOSING)}') THEN 5 ELSE 0 END + least(c / 2500, 3), 4) AS score FROM g WHERE fine AND n = e - s + 1""")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bd.candidate_scores(_entry_spans(spark, sf_dir).drop("next_start"), _page_once(spark, sf_dir), _CLOSING)


@query("""
    WITH d AS (SELECT DISTINCT source_id, pdf_page, needs_ocr FROM pages), p AS (SELECT s.shard_id, count(DISTINCT d.pdf_page) AS pages, count(DISTINCT CASE WHEN needs_ocr THEN d.pdf_page END) AS queued FROM shards s LEFT JOIN d ON d.source_id = s.source_id AND d.pdf_page BETWEEN start_page AND end_page GROUP BY 1),
    e AS (SELECT owner_shard AS shard_id, count(*) AS entries, sum(page_count) AS entry_pages FROM entries GROUP BY 1)
    SELECT s.shard_id, end_page - start_page + 1 AS expected_pages, pages, queued, coalesce(entries, 0) AS entries, coalesce(entry_pages, 0) AS entry_pages, pages <= end_page - start_page + 1 AS holds FROM shards s JOIN p USING (shard_id) LEFT JOIN e USING (shard_id)""")
def shard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "shards").select("shard_id", "source_id", "start_page", "end_page")
    d = read_table(spark, sf_dir, "pages").select("source_id", "pdf_page", "needs_ocr").distinct()
    p = spans.range_owner(d, s, "source_id", "pdf_page", "start_page", "end_page").groupBy("shard_id").agg(F.countDistinct("pdf_page").alias("p"), F.countDistinct(F.when(F.col("needs_ocr"), F.col("pdf_page"))).alias("q"))
    e = read_table(spark, sf_dir, "entries").groupBy(F.col("owner_shard").alias("shard_id")).agg(F.count("*").alias("e"), F.sum("page_count").alias("ep"))
    expected = F.col("end_page") - F.col("start_page") + 1
    j = s.join(p, "shard_id", "left").join(e, "shard_id", "left").na.fill(0, ["p", "q", "e", "ep"])
    return j.select("shard_id", expected.alias("expected_pages"), F.col("p").alias("pages"), F.col("q").alias("queued"), F.col("e").alias("entries"), F.col("ep").alias("entry_pages"), (F.col("p") <= expected).alias("holds"))


@query("SELECT page_id, length(trim(ocr_text, ' ')) > 1.2 * length(embedded_text) AS gained, contains(lower(ocr_text), 'familie') AND contains(lower(ocr_text), 'die') AS tokens, coalesce(length(trim(ocr_text, ' ')) > 1.2 * length(embedded_text) AND contains(lower(ocr_text), 'familie') AND contains(lower(ocr_text), 'die') AND line_count > 0, false) AS qualified FROM pages WHERE ocr_text IS NOT NULL")
def lane_qualification(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").filter("ocr_text IS NOT NULL")
    gained, tokens = F.length(F.trim("ocr_text")) > 1.2 * F.length("embedded_text"), pg.has_tokens(F.col("ocr_text"), ["Familie", "die"])
    return p.select("page_id", gained.alias("gained"), tokens.alias("tokens"), F.coalesce(gained & tokens & (F.col("line_count") > 0), F.lit(False)).alias("qualified"))
