"""Queries on chunks and texts: windows, hashes, ids, gates on answers, names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import chunks as ch
from foliant.operators import names as nm
from foliant.operators import tables as tb
from foliant.registry import query
from foliant.session import read_table

_UNITS = r"len(regexp_extract_all({c}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]'))"
_TARGET, _OVERLAP = 64, 16
_WINDOWS = f"""
    WITH n AS (SELECT doc_id, {_UNITS.format(c="coalesce(text, '')")} AS units FROM documents),
    w AS (SELECT doc_id, units, unnest(generate_series(0, CASE WHEN units <= {_TARGET} THEN 0 ELSE CAST(ceil((units - {_TARGET}) / {_TARGET - _OVERLAP}.0) AS BIGINT) END)) AS window_index FROM n WHERE units > 0)"""


@query(_WINDOWS + f" SELECT doc_id, window_index, window_index * {_TARGET - _OVERLAP} AS unit_start, least(window_index * {_TARGET - _OVERLAP} + {_TARGET}, units) AS unit_end FROM w")
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ch.windows(read_table(spark, sf_dir, "documents"), "doc_id", "text", _TARGET, _OVERLAP)
    return w.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("window_index", "unit_start", "unit_end")])


@query(
    _WINDOWS
    + f""", r AS (SELECT doc_id, window_index, window_index * {_TARGET - _OVERLAP} AS s, least(window_index * {_TARGET - _OVERLAP} + {_TARGET}, units) AS e FROM w)
    SELECT doc_id, window_index, lag(e) OVER (PARTITION BY doc_id ORDER BY window_index) - s AS shared_units, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY window_index) - s = {_OVERLAP}, s = 0) AS overlap_ok FROM r"""
)
def chunk_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ch.chunks(read_table(spark, sf_dir, "documents"), "doc_id", "text", _TARGET, _OVERLAP)
    o = ch.overlap_check(c, "doc_id", "window_index", "unit_start", "unit_end", _OVERLAP)
    return o.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("window_index").cast("long").alias("window_index"), F.col("shared_units").cast("long").alias("shared_units"), "overlap_ok")


@query(
    # a window's text, rebuilt from the text's units and the gaps between them
    rf"""
    WITH p AS (SELECT doc_id, text, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]|\s+') AS p FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM p),
    o AS (SELECT doc_id, i, piece, trim(piece, ' ' || chr(9) || chr(10) || chr(13)) <> '' AS unit, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS till FROM e),
    u AS (SELECT doc_id, till - length(piece) AS a, till AS b, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM o WHERE unit),
    w AS (SELECT doc_id, n, unnest(generate_series(0, CASE WHEN n <= {_TARGET} THEN 0 ELSE CAST(ceil((n - {_TARGET}) / {_TARGET - _OVERLAP}.0) AS BIGINT) END)) AS window_index FROM (SELECT DISTINCT doc_id, n FROM u)),
    x AS (SELECT doc_id, window_index, min(a) AS char_start, max(b) AS char_end FROM w JOIN u USING (doc_id) WHERE k >= window_index * {_TARGET - _OVERLAP} AND k < window_index * {_TARGET - _OVERLAP} + {_TARGET} GROUP BY ALL)
    SELECT x.doc_id, window_index, char_start, char_end, md5(substring(d.text, CAST(char_start + 1 AS BIGINT), CAST(char_end - char_start AS BIGINT))) AS text_md5 FROM x JOIN documents d USING (doc_id)"""
)
def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ch.chunks(read_table(spark, sf_dir, "documents"), "doc_id", "text", _TARGET, _OVERLAP)
    return c.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(x).cast("long").alias(x) for x in ("window_index", "char_start", "char_end")], F.md5("chunk_text").alias("text_md5"))


_BLANK = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_HEADING_LINE = r"length(s) BETWEEN 1 AND 60 AND NOT contains('.,;:!?', right(s, 1)) AND (upper(s) = s AND lower(s) <> s OR regexp_matches(s, '^(?:[IVXLC\d]+[.)] \S|[A-Z][a-zäöüß]+(?: [a-zA-Zäöüß]+){0,4}$)'))"


@query(
    # the window's end depends on the one before: a recursion over the lists of unit places and of headings
    rf"""
    WITH RECURSIVE p AS (SELECT page_id, best_text AS t, regexp_extract_all(best_text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_BLANK}]|[{_BLANK}]+') AS p FROM pages WHERE best_text IS NOT NULL),
    e AS (SELECT page_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM p), o AS (SELECT page_id, i, regexp_full_match(piece, '[{_BLANK}]+') AS blank, length(piece) AS l, sum(length(piece)) OVER (PARTITION BY page_id ORDER BY i) AS till FROM e),
    u AS (SELECT page_id, list(till - l ORDER BY i) AS a, list(till ORDER BY i) AS b, count(*) AS n FROM o WHERE NOT blank GROUP BY 1),
    li AS (SELECT page_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM p),
    lo AS (SELECT page_id, regexp_replace(line, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g') AS s, sum(length(line) + 1) OVER (PARTITION BY page_id ORDER BY i) - length(line) - 1 AS off FROM li),
    mk AS (SELECT lo.page_id, list(DISTINCT len(list_filter(u.a, lambda x: x < off))) AS m FROM lo JOIN u USING (page_id) WHERE {_HEADING_LINE} GROUP BY 1),
    k AS (SELECT u.*, coalesce(list_filter(m, lambda x: x > 0 AND x < n), []) AS m FROM u LEFT JOIN mk USING (page_id)),
    r AS (SELECT page_id, 0 AS w, 0::BIGINT AS s, coalesce(CASE WHEN n > 128 THEN list_max(list_filter(m, lambda x: x BETWEEN 64 AND 128)) END, least(128, n)) AS e, n, m FROM k
          UNION ALL SELECT page_id, w + 1, greatest(s + 1, e - 32), coalesce(CASE WHEN greatest(s + 1, e - 32) + 128 < n THEN list_max(list_filter(m, lambda x: x BETWEEN greatest(s + 1, e - 32) + 64 AND greatest(s + 1, e - 32) + 128)) END, least(greatest(s + 1, e - 32) + 128, n)), n, m FROM r WHERE e < n)
    SELECT r.page_id, w AS window_index, s AS unit_start, e AS unit_end, k.a[s + 1] AS char_start, k.b[e] AS char_end FROM r JOIN k USING (page_id)"""
)
def chunk_heading_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ch.chunks(read_table(spark, sf_dir, "pages"), "page_id", "best_text", 128, 32, heading_aware=True)
    return c.select(F.col("doc_id").cast("long").alias("page_id"), *[F.col(x).cast("long").alias(x) for x in ("window_index", "unit_start", "unit_end", "char_start", "char_end")])


@query(
    """SELECT DISTINCT chunk_id, sha256(source_text) AS exact_sha256, sha256(source_text) = text_sha256 AS hash_ok, coalesce(char_end - char_start, -1) = length(source_text) AS span_ok FROM embedding_chunks"""
)
def chunk_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "source_text", "text_sha256", "char_start", "char_end")
    exact = F.sha2("source_text", 256)
    return c.select("chunk_id", exact.alias("exact_sha256"), (exact == F.col("text_sha256")).alias("hash_ok"), (F.coalesce(F.col("char_end") - F.col("char_start"), F.lit(-1)) == F.length("source_text")).alias("span_ok")).distinct()


@query("""SELECT DISTINCT chunk_id, format('{}:p{:04d}:x{:06d}:c{:02d}', source_id, pdf_page, token_unit_start, 0) AS made_id,
    concat_ws(chr(10), 'title: ' || concat_ws(' / ', scientific_name, display_name), 'source: ' || source_id || ', p. ' || pdf_page, 'text: ' || source_text) AS embedding_input FROM embedding_chunks WHERE token_unit_start IS NOT NULL""")
def chunk_ids_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").filter("token_unit_start IS NOT NULL")
    made = ch.chunk_id(F.col("source_id"), F.col("pdf_page"), F.col("token_unit_start"), F.lit(0))
    return c.select("chunk_id", made.alias("made_id"), ch.embedding_input(F.col("scientific_name"), F.col("display_name"), F.col("source_id"), F.col("pdf_page"), F.col("source_text")).alias("embedding_input")).distinct()


@query("""SELECT DISTINCT chunk_id, token_unit_start, token_unit_end, CASE WHEN target_token_units IS NULL THEN 'unknown' WHEN token_unit_end - token_unit_start >= target_token_units THEN 'child' ELSE 'within_target' END AS kind FROM embedding_chunks""")
def chunk_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    kind = F.when(F.col("target_token_units").isNull(), "unknown").when(F.col("token_unit_end") - F.col("token_unit_start") >= F.col("target_token_units"), "child").otherwise("within_target")
    return c.select("chunk_id", "token_unit_start", "token_unit_end", kind.alias("kind")).distinct()


@query(r"""
    SELECT page_id, array_to_string(list_filter(list_transform(generate_series(1, len(l)), lambda i: CASE WHEN trim(l[i], ' ') <> '' THEN 'L' || lpad(CAST(i AS VARCHAR), 4, '0') || chr(9) || l[i] END), lambda x: x IS NOT NULL), chr(10)) AS numbered
    FROM (SELECT page_id, string_split(best_text, chr(10)) AS l FROM pages WHERE best_text IS NOT NULL)""")
def numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").filter("best_text IS NOT NULL").select("page_id", ch.numbered_page(F.col("best_text")).alias("numbered"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '([A-Za-z])-\s+([A-Za-z])', '\1\2', 'g'), '\s+', ' ', 'g'), ' ') AS quote FROM documents WHERE text IS NOT NULL""")
def joined_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", tx.joined_quote(F.col("text")).alias("quote"))


@query(r"""SELECT query_id, CASE WHEN regexp_matches(question, '[\x{3040}-\x{30ff}]') THEN 'ja' WHEN regexp_matches(question, '[\x{3400}-\x{9fff}]') THEN 'zh' WHEN regexp_matches(question, '[\x{0400}-\x{04ff}]') THEN 'ru' ELSE 'en' END AS route FROM embedding_queries""")
def language_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embedding_queries").select("query_id", tx.language_route(F.col("question")).alias("route"))


@query(r"""
    WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '\[E\d+(?:,\s*E\d+)*\]')) AS m FROM documents), n AS (SELECT doc_id, unnest(regexp_extract_all(m, 'E(\d+)', 1)) AS n FROM m)
    SELECT doc_id, CAST(n AS INTEGER) AS evidence, count(*) AS times FROM n GROUP BY ALL""")
def citation_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = F.explode(F.regexp_extract_all("text", F.lit(r"\[E\d+(?:,\s*E\d+)*\]"), F.lit(0)))
    m = read_table(spark, sf_dir, "documents").select("doc_id", marks.alias("m")).select("doc_id", F.explode(F.regexp_extract_all("m", F.lit(r"E(\d+)"), F.lit(1))).alias("n"))
    return m.groupBy("doc_id", F.col("n").cast("int").alias("evidence")).agg(F.count("*").alias("times"))


@query(r"""
    WITH d AS (SELECT doc_id, text, list_distinct(list_transform(regexp_extract_all(text, 'E(\d+)\b', 1), lambda x: CAST(x AS INTEGER))) AS c,
                      trim(regexp_replace(regexp_replace(text, '[^.!?]*[.!?][“”")]*\s*\[E\d+(?:,\s*E\d+)*\]', '', 'g'), '\s+', ' ', 'g'), ' ') AS rest FROM documents WHERE source = 'answers' AND text IS NOT NULL)
    SELECT doc_id, len(c) AS n_cited, len(list_filter(c, lambda x: x < 1 OR x > 12)) AS out_of_range, length(rest) AS uncited_characters, len(c) > 0 AND len(list_filter(c, lambda x: x < 1 OR x > 12)) = 0 AND length(rest) = 0 AS passes FROM d""")
def citation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").filter("source = 'answers' AND text IS NOT NULL")
    c = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"E(\d+)\b"), F.lit(1)), lambda x: x.cast("int")))
    rest = F.trim(F.regexp_replace(F.regexp_replace("text", r'[^.!?]*[.!?][“”")]*\s*\[E\d+(?:,\s*E\d+)*\]', ""), r"\s+", " "))
    d = d.withColumn("c", c).withColumn("rest", rest)
    bad = F.size(F.filter("c", lambda x: (x < 1) | (x > 12)))
    return d.select("doc_id", F.size("c").cast("long").alias("n_cited"), bad.cast("long").alias("out_of_range"), F.length("rest").cast("long").alias("uncited_characters"), ((F.size("c") > 0) & (bad == 0) & (F.length("rest") == 0)).alias("passes"))


_RULES = {"long_number": r"\d{6,}", "mail": r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]{2,}", "key": r"(?:sk|pk|api)[-_][A-Za-z0-9]{16,}", "address": r"https?://\S+"}


@query("WITH d AS (SELECT doc_id, text || ' ' || CASE doc_id % 5 WHEN 0 THEN 'mail a' || doc_id || '@b.de' WHEN 1 THEN 'http://x.y/' || doc_id WHEN 2 THEN 'No. ' || (1000000 + doc_id) WHEN 3 THEN 'sk-' || repeat('a1', 9) ELSE '' END AS text FROM documents)" + " UNION ALL ".join(f" SELECT doc_id, '{n}' AS rule FROM d WHERE regexp_matches(text, '{r}')" for n, r in _RULES.items()))
def pattern_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents with one planted hit or none, by turns
    i = F.col("doc_id")
    tail = F.when(i % 5 == 0, F.concat(F.lit("mail a"), i, F.lit("@b.de"))).when(i % 5 == 1, F.concat(F.lit("http://x.y/"), i)).when(i % 5 == 2, F.concat(F.lit("No. "), i + 1000000)).when(i % 5 == 3, F.lit("sk-" + "a1" * 9)).otherwise("")
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(" "), tail).alias("text"))
    hits = F.array_compact(F.array(*[F.when(F.col("text").rlike(r), F.lit(n)) for n, r in _RULES.items()]))
    return d.select("doc_id", F.explode(hits).alias("rule"))


@query(r"""SELECT record_id, regexp_replace(regexp_replace(lower(book_scientific_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
    trim(regexp_replace(regexp_replace('<p>' || book_scientific_name || ' &amp; co</p>', '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS raw FROM record_name_metadata""".replace("trim(regexp_replace(regexp_replace('<p>'", "trim(regexp_replace(replace(regexp_replace('<p>'").replace("'<[^>]*>', ' ', 'g')", "'<[^>]*>', ' ', 'g'), '&amp;', '&')"))
def slugs_and_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = read_table(spark, sf_dir, "record_name_metadata")
    return m.select("record_id", tx.slug(F.col("book_scientific_name")).alias("slug"), tx.html_text(F.concat(F.lit("<p>"), "book_scientific_name", F.lit(" &amp; co</p>"))).alias("raw"))


@query("SELECT DISTINCT c.chunk_id, c.record_id, n.display_name, n.accepted_scientific_name FROM embedding_chunks c LEFT JOIN record_name_metadata n ON n.record_id = c.record_id")
def left_name_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "record_id").distinct()
    n = read_table(spark, sf_dir, "record_name_metadata").select("record_id", "display_name", "accepted_scientific_name")
    return c.join(n, "record_id", "left").select("chunk_id", "record_id", "display_name", "accepted_scientific_name")


@query("""
    WITH m AS (SELECT lower(accepted_scientific_name) AS name, accepted_scientific_name AS accepted, 0 AS p FROM record_name_metadata WHERE accepted_scientific_name IS NOT NULL
               UNION ALL SELECT lower(book_scientific_name), accepted_scientific_name, 1 FROM record_name_metadata WHERE accepted_scientific_name IS NOT NULL AND lower(string_split(book_scientific_name, ' ')[1]) = lower(string_split(accepted_scientific_name, ' ')[1])),
    f AS (SELECT translate(name, 'ë', 'e') AS name, min({'p': p, 'a': accepted}) AS m FROM m GROUP BY 1)
    SELECT e.entry_id, CASE WHEN m IS NULL THEN 'unresolved' WHEN m.p = 0 THEN 'accepted' ELSE 'alias' END AS status, m.a AS accepted FROM entries e LEFT JOIN f ON f.name = translate(lower(e.book_taxon_candidate), 'ë', 'e')""")
def name_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "record_name_metadata").filter("accepted_scientific_name IS NOT NULL")
    accepted = n.select(F.col("accepted_scientific_name").alias("name"), F.col("accepted_scientific_name").alias("accepted"), F.lit("accepted").alias("kind"))
    alias = n.select(F.col("book_scientific_name").alias("name"), F.col("accepted_scientific_name").alias("accepted"), F.lit("alias").alias("kind"))
    return nm.resolve(read_table(spark, sf_dir, "entries"), accepted.unionByName(alias), "entry_id", "book_taxon_candidate")


@query(r"""
    WITH x AS (SELECT entry_id, regexp_extract(book_taxon_candidate, '([A-Z][a-zA-Zë]{2,}) (?:× )?([A-Za-z]{3,})', 0) AS f FROM entries), y AS (SELECT entry_id, f, string_split(replace(f, ' × ', ' '), ' ') AS p FROM x)
    SELECT entry_id, CASE WHEN length(f) > 0 THEN upper(p[1][1]) || lower(p[1][2:]) || ' ' || lower(p[2]) ELSE '' END AS binomial FROM y""")
def binomials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "entries").select("entry_id", nm.binomial(F.col("book_taxon_candidate")).alias("binomial"))


@query("SELECT record_id, display_name_source_scope, CASE WHEN display_name IS NULL THEN 'no_name' WHEN display_name_source_scope = 'taiwan_public' THEN 'public' ELSE 'book' END AS name_policy FROM record_name_metadata")
def name_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = F.when(F.col("display_name").isNull(), "no_name").when(F.col("display_name_source_scope") == "taiwan_public", "public").otherwise("book")
    return read_table(spark, sf_dir, "record_name_metadata").select("record_id", "display_name_source_scope", policy.alias("name_policy"))


@query("SELECT display_name_source_scope, count(*) AS records, count(display_name) AS named, count(DISTINCT accepted_scientific_name) AS accepted_names FROM record_name_metadata GROUP BY 1")
def scope_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "record_name_metadata").groupBy("display_name_source_scope").agg(F.count("*").alias("records"), F.count("display_name").alias("named"), F.countDistinct("accepted_scientific_name").alias("accepted_names"))


@query("""
    WITH s AS (SELECT source_text, min(ingested_at) AS first_at, string_agg(DISTINCT profile_id, ',' ORDER BY profile_id) AS provenance FROM embedding_chunks GROUP BY 1)
    SELECT md5(source_text) AS text_md5, provenance FROM s""")
def merged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("source_text", "ingested_at", "profile_id")
    m = tb.merge_spans(c, ["source_text"], "ingested_at", "profile_id")
    return m.select(F.md5("source_text").alias("text_md5"), F.array_join("provenance", ",").alias("provenance"))


@query(
    _WINDOWS
    + """ SELECT doc_id, window_index, window_index % 3 <> 1 AS contained, window_index % 3 <> 1 AS at_place FROM w"""
)
def exact_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every chunk against its own parent; every third one is altered first and must not be found
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("parent_text"))
    c = ch.chunks(read_table(spark, sf_dir, "documents"), "doc_id", "text", _TARGET, _OVERLAP)
    c = c.withColumn("chunk_text", F.when(F.col("window_index") % 3 == 1, F.concat("chunk_text", F.lit("\x00"))).otherwise(F.col("chunk_text")))
    j = ch.child_in_parent(c, d, "doc_id", "parent_text")
    return j.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("window_index").cast("long").alias("window_index"), "contained", "at_place")


@query("""
    WITH r AS (SELECT chunk_id, unnest([CASE WHEN chunk_id IS NULL THEN 'id' END, CASE WHEN NOT coalesce(sha256(source_text) = text_sha256, false) THEN 'hash' END,
      CASE WHEN NOT coalesce(char_end >= char_start, false) THEN 'order' END, CASE WHEN NOT coalesce(char_end - char_start = length(source_text), false) THEN 'length' END,
      CASE WHEN NOT coalesce(target_token_units > overlap_token_units, false) THEN 'limit' END]) AS error FROM embedding_chunks)
    SELECT error, count(DISTINCT chunk_id) AS chunks FROM r WHERE error IS NOT NULL GROUP BY 1""")
def table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks")
    rules = {"id": F.col("chunk_id").isNotNull(), "hash": F.sha2("source_text", 256) == F.col("text_sha256"), "order": F.col("char_end") >= F.col("char_start"), "length": F.col("char_end") - F.col("char_start") == F.length("source_text"), "limit": F.col("target_token_units") > F.col("overlap_token_units")}
    return tb.checks(c, "chunk_id", rules).groupBy("error").agg(F.countDistinct("chunk_id").alias("chunks"))
