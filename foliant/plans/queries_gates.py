"""Queries of gates: required evidence, expansion, profile selection, selections, names in pairs, citations, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as tx
from foliant.operators import gates as gt
from foliant.operators import retrieval as rt
from foliant.operators import tables as tb
from foliant.plans import queries_retrieval as qr
from foliant.registry import query
from foliant.session import cut_lineage, kept, read_table

_FOLD = qr._FOLD


@query("SELECT DISTINCT chunk_id, review_status FROM embedding_chunks WHERE profile_id = 'child-512-o100' AND review_status IN (SELECT unnest(string_split('approved,candidate', ',')))")
def active_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = spark.createDataFrame([("active_review_statuses", "approved,candidate"), ("active_chunk_profile", "child-512-o100")], "key string, value string")
    c = gt.active_rows(read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "review_status", "profile_id"), settings, "review_status", "active_review_statuses")
    return gt.active_rows(c, settings, "profile_id", "active_chunk_profile").select("chunk_id", "review_status").distinct()


_EXPANSIONS = [
    (["contain", "enthalten", "contiennent"], None, ["saponin", "harz"]),
    (["wogegen hilft", "used for", "可以治"], None, ["gegen", "heilmittel"]),
    (["wo wächst", "where"], ["mittelvarden", "nordhalmark", "westkorien"], ["steppe", "wiesen"]),
    (["wo wächst", "where"], ["inselbrannien", "niederveldien"], ["küste", "dünen"]),
    (["petals", "flowers", "blüten", "花"], ["contain", "enthalten", "治"], ["blütezeit", "flores"]),
    (["husks", "果實"], None, ["schalen", "früchte"]),
]


def _any_sql(marks: list[str] | None) -> str:
    return "true" if marks is None else "(" + " OR ".join(f"contains(lower(question), '{m.lower()}')" for m in marks) + ")"


@query("SELECT query_id, array_to_string(list_concat(" + ", ".join(f"CASE WHEN {_any_sql(a)} AND {_any_sql(b)} THEN {t!r} ELSE [] END" for a, b, t in _EXPANSIONS) + "), ' ') AS expanded FROM embedding_queries")
def query_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embedding_queries").select("query_id", F.array_join(gt.expanded_terms(F.col("question"), _EXPANSIONS), " ").alias("expanded"))


@query("SELECT query_id, lower(question) LIKE '%wächst%' OR lower(question) LIKE '%contain%' OR lower(question) LIKE '%治%' AS asks_known FROM embedding_queries")
def any_of_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embedding_queries").select("query_id", gt.any_of(F.col("question"), ["WÄCHST", "contain", "治"]).alias("asks_known"))


# a question's required terms: its longer Latin words and its ideograph terms
_REQUIRED = "req AS (SELECT query_id AS query, list(term) AS terms FROM qt WHERE length(term) >= 7 OR NOT regexp_matches(term, '^[a-z0-9]') GROUP BY 1)"


def required_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.filter(tx.query_terms(F.col("question"), 1000), lambda t: (F.length(t) >= 7) | ~t.rlike("^[a-z0-9]"))
    return read_table(spark, sf_dir, "embedding_queries").select(F.col("query_id").alias("query"), terms.alias("terms")).filter(F.size("terms") > 0)


@query(
    qr._HYBRID
    + f""", {_REQUIRED}, w AS (SELECT query, parent FROM r WHERE rank <= 10), txt AS (SELECT chunk_id, r.parent AS parent, {_FOLD.format(c="r.text")} AS f FROM ({qr._CHUNKS})),
    eg AS (SELECT w.query, w.parent, bool_or(len(list_filter(coalesce(terms, []), lambda x: contains(txt.f, x))) > 0) AS has_required FROM w JOIN txt USING (parent) LEFT JOIN req USING (query) GROUP BY ALL)
    SELECT *, CASE WHEN bool_or(has_required) OVER (PARTITION BY query) THEN 'supporting_book_terms_found' ELSE 'no_supporting_book_relation' END AS answer_gate FROM eg"""
)
def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = qr.hybrid_hits(spark, sf_dir, 10)
    children = qr.chunks_once(spark, sf_dir, "parent", "source_text").select("parent", F.col("source_text").alias("text"))
    return gt.evidence_gate(hits.select("query", "parent"), children, required_terms(spark, sf_dir))


_METRICS = (
    qr._HYBRID
    + f""", {_REQUIRED}, prof AS (SELECT chunk_id, any_value(profile_id) AS profile, {_FOLD.format(c="any_value(source_text)")} AS f FROM embedding_chunks GROUP BY 1),
    ms AS (SELECT profile, sem.query, sem.item, cosine, len(list_filter(coalesce(terms, []), lambda x: contains(f, x))) > 0 AS rel FROM sem JOIN prof ON prof.chunk_id = sem.item LEFT JOIN req USING (query)),
    mo AS (SELECT *, row_number() OVER (PARTITION BY profile, query ORDER BY cosine DESC, item) AS rank FROM ms),
    ma AS (SELECT profile, query, count(*) AS n, count(*) FILTER (rel) AS relevant, min(rank) FILTER (rel) AS fr, coalesce(max(cosine) FILTER (rel), -1) AS tr, coalesce(max(cosine) FILTER (NOT rel), -1) AS tn FROM mo GROUP BY ALL),
    em AS (SELECT profile, query, expected_status, relevant AS relevant_chunk_count, CASE WHEN relevant > 0 THEN 'supporting_book_terms_found' ELSE 'no_supporting_book_relation' END AS answer_gate, x.ok, CASE WHEN ok THEN fr END AS first_relevant_rank,
             CASE WHEN ok THEN round(coalesce(1.0 / fr, 0), 6) END AS mrr, CASE WHEN ok THEN CAST(coalesce(fr = 1, false) AS INTEGER) END AS recall_at_1, CASE WHEN ok THEN CAST(coalesce(fr <= 3, false) AS INTEGER) END AS recall_at_3, CASE WHEN ok THEN round(tr - tn, 6) END AS margin,
             CASE WHEN NOT ok THEN CAST(relevant = 0 AS INTEGER) END AS refusal_correct FROM ma JOIN (SELECT query_id AS query, expected_status, expected_status = 'answerable' AS ok FROM embedding_queries) x USING (query)),
    ep AS (SELECT em.profile, round(avg(mrr), 6) AS mean_mrr, round(avg(recall_at_1), 6) AS answer_recall_at_1, round(avg(recall_at_3), 6) AS answer_recall_at_3, round(avg(margin), 4) AS mean_evidence_margin, round(avg(refusal_correct), 6) AS refusal_precision FROM em GROUP BY 1),
    ec AS (SELECT profile_id AS profile, count(*) AS chunk_count, CASE WHEN bool_and(length(source_id) > 0 AND pdf_page > 0) THEN 1.0 ELSE 0.0 END AS citation_completeness FROM (SELECT DISTINCT chunk_id, profile_id, source_id, pdf_page FROM embedding_chunks) GROUP BY 1),
    pm AS (SELECT * FROM ep JOIN ec USING (profile))"""
)


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, bare = (qr.chunks_once(spark, sf_dir, "profile_id", *more, *qr._VECTOR, "ingested_at").filter("ingested_at IS NOT NULL") for more in (["source_text"], []))
    profile = F.col("profile_id").alias("profile")
    base, bare = qr._usable(c, "chunk_id", profile, F.col("source_text").alias("text")), qr._usable(bare, "chunk_id", profile)
    expected = read_table(spark, sf_dir, "embedding_queries").select(F.col("query_id").alias("query"), "expected_status")
    ranked = expected.select("query", (F.col("expected_status") == "answerable").alias("ranked"))  # of the others no rank is asked for
    q = qr.asked_questions(spark, sf_dir).join(required_terms(spark, sf_dir), "query", "left").join(ranked, "query", "left")
    return gt.query_metrics(gt.ranked_evidence(base, q, bare), expected)


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", F.col("profile_id").alias("profile"), "source_id", "pdf_page").distinct()
    return gt.profile_metrics(_ranked(spark, sf_dir), c)


@query(_METRICS + " SELECT profile, query, expected_status, relevant_chunk_count, answer_gate, first_relevant_rank, mrr, recall_at_1, recall_at_3, margin, refusal_correct FROM em")
def query_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)


@query(_METRICS + " SELECT * FROM pm")
def profile_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)


@query(
    _METRICS
    + """, ok AS (SELECT profile FROM pm WHERE mean_mrr = 1 AND answer_recall_at_1 = 1 AND refusal_precision = 1 AND citation_completeness = 1 ORDER BY mean_evidence_margin DESC, chunk_count, profile LIMIT 1)
    SELECT (SELECT profile FROM ok) AS selected, CASE WHEN (SELECT count(*) FROM ok) > 0 THEN 'promote' ELSE 'hold_for_evidence' END AS verdict"""
)
def profile_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gt.select_profile(_profiles(spark, sf_dir))


_TOPS = (
    qr._HYBRID
    + f""", {_REQUIRED}, txt AS (SELECT chunk_id, {_FOLD.format(c="r.text")} AS f FROM ({qr._CHUNKS})),
    tops AS (SELECT query, b.i AS item, 'hybrid' AS way FROM r WHERE rank = 1 UNION ALL SELECT query, item, 'semantic' FROM vs WHERE rank = 1),
    held AS (SELECT tops.query, way, len(list_filter(coalesce(terms, []), lambda x: contains(txt.f, x))) > 0 AS held FROM tops JOIN txt ON txt.chunk_id = tops.item LEFT JOIN req USING (query)),
    hs AS (SELECT query, way, expected_status, held, held = (expected_status = 'answerable') AS correct FROM held JOIN embedding_queries e ON e.query_id = query)"""
)


_WAYS = {"hybrid": qr.hybrid_hits, "semantic": qr.semantic_hits}


def _tops(spark: SparkSession, sf_dir: str, *ways: str) -> DataFrame:
    """The best chunk of each question by the ``ways`` asked for, whether it holds a required term, and whether that's right."""
    tops = kept(tb.union_all([_WAYS[w](spark, sf_dir, 1).select("query", "item", F.lit(w).alias("way")) for w in ways]))  # read twice
    texts = tb.maybe_in(qr.chunks_once(spark, sf_dir, "source_text").select(F.col("chunk_id").alias("item"), "source_text"), "item", tops)
    held = tops.join(texts, "item").join(required_terms(spark, sf_dir), "query", "left").select("query", "way", gt.holds_any(F.col("source_text"), F.coalesce("terms", F.array().cast("array<string>"))).alias("held"))
    e = read_table(spark, sf_dir, "embedding_queries").select(F.col("query_id").alias("query"), "expected_status", "profile_id")
    return held.join(e, "query").withColumn("correct", F.col("held") == (F.col("expected_status") == "answerable"))


@query(_TOPS + " SELECT query, expected_status, held, CASE WHEN expected_status = 'answerable' THEN CASE WHEN held THEN 'answerable_with_page_evidence' ELSE 'hold_for_evidence' END WHEN held THEN 'unsafe_false_support' ELSE 'refuse_no_book_relation' END AS answer_gate, correct FROM hs WHERE way = 'hybrid'")
def hybrid_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tops(spark, sf_dir, "hybrid")
    gate = F.when(F.col("expected_status") == "answerable", F.when(F.col("held"), "answerable_with_page_evidence").otherwise("hold_for_evidence")).when(F.col("held"), "unsafe_false_support").otherwise("refuse_no_book_relation")
    return t.select("query", "expected_status", "held", gate.alias("answer_gate"), "correct")


@query(_TOPS + " SELECT profile_id, way, count(*) AS queries, round(avg(CAST(correct AS INTEGER)), 6) AS correct_share, bool_and(correct) AS all_gates_pass FROM hs JOIN embedding_queries e ON e.query_id = query GROUP BY ALL")
def semantic_against_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tops(spark, sf_dir, *_WAYS).groupBy("profile_id", "way").agg(F.count("*").alias("queries"), F.round(F.avg(F.col("correct").cast("int")), 6).alias("correct_share"), F.bool_and("correct").alias("all_gates_pass"))


_SELECTED = "e AS (SELECT record_id AS query, chunk_id, source_text, row_number() OVER (PARTITION BY record_id ORDER BY pdf_page, chunk_id) AS ordinal FROM (SELECT DISTINCT record_id, chunk_id, pdf_page, source_text FROM embedding_chunks) QUALIFY ordinal <= 5)"
_QUOTE = r"trim(regexp_replace(regexp_replace({c}, '([A-Za-z])-\s+([A-Za-z])', '\1\2', 'g'), '\s+', ' ', 'g'), ' ')"


@query(rf"""
    WITH {_SELECTED}, i AS (SELECT query, 0 AS pos, [1, 1] AS ids, substring(source_text, 1, 60) AS quote FROM e WHERE ordinal = 1 UNION ALL SELECT query, 1, [2], substring(source_text, 1, 60) FROM e WHERE ordinal = 2
        UNION ALL SELECT query, 2, [9], substring(source_text, 1, 60) FROM e WHERE ordinal = 1 UNION ALL SELECT query, 3, [3], 'nowhere to be found in any text' FROM e WHERE ordinal = 3),
    n AS (SELECT query, pos, ids, {_QUOTE.format(c='quote')} AS quote FROM i),
    ok AS (SELECT DISTINCT n.query, pos, ids, quote, x.record FROM n JOIN (SELECT query, ordinal, CASE WHEN ordinal = 2 THEN query || '-b' ELSE query END AS record, {_QUOTE.format(c='source_text')} AS t FROM e) x ON x.query = n.query AND x.ordinal = n.ids[1] WHERE length(quote) >= 20 AND contains(x.t, quote))
    SELECT query, row_number() OVER (PARTITION BY query ORDER BY pos) AS place, record AS record_id, CASE WHEN pos = 0 THEN '1' ELSE CAST(ids[1] AS VARCHAR) END AS evidence_ids, quote AS support_quote FROM ok""")
def selection_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # selections as a model answers them: two that hold (ids named twice, another record), one out of range, one with a foreign quotation
    from pyspark.sql import Window

    w = Window.partitionBy("record_id").orderBy("pdf_page", "chunk_id")
    e = read_table(spark, sf_dir, "embedding_chunks").select("record_id", "chunk_id", "pdf_page", "source_text").distinct().withColumn("ordinal", F.row_number().over(w)).filter("ordinal <= 5")
    e = cut_lineage(e.select(F.col("record_id").alias("query"), "ordinal", F.when(F.col("ordinal") == 2, F.concat("record_id", F.lit("-b"))).otherwise(F.col("record_id")).alias("record_id"), F.col("source_text").alias("text")))
    text_of = lambda n: F.max(F.when(F.col("ordinal") == n, F.col("text")))
    g = e.groupBy("query").agg(text_of(1).alias("a"), text_of(2).alias("b"), text_of(3).alias("c"))
    item = lambda ids, quote: F.struct(F.array(*[F.lit(i) for i in ids]).alias("evidence_ids"), quote.alias("support_quote"))
    head = lambda c: F.substring(c, 1, 60)
    payload = F.to_json(F.struct(F.array(item([1, 1], head("a")), item([2], head("b")), item([9], head("a")), item([3], F.lit("nowhere to be found in any text"))).alias("items")))
    v = gt.valid_selections(g.select("query", payload.alias("payload")), e)
    return v.select("query", F.col("place").cast("long").alias("place"), "record_id", F.array_join(F.transform("evidence_ids", lambda x: x.cast("string")), ",").alias("evidence_ids"), "support_quote")


@query(r"""
    WITH t AS (SELECT doc_id, text || coalesce(' ' || m.display_name || '（' || m.book_scientific_name || '）', '') AS text FROM documents d LEFT JOIN record_name_metadata m USING (record_id)),
    p AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '([\x{3400}-\x{9fff}]{1,16})[（(]([A-Z][A-Za-z.-]*(?:\s+[A-Za-z.-]+){0,5})[）)]', 1)) AS display, unnest(regexp_extract_all(text, '([\x{3400}-\x{9fff}]{1,16})[（(]([A-Z][A-Za-z.-]*(?:\s+[A-Za-z.-]+){0,5})[）)]', 2)) AS latin FROM t),
    a AS (SELECT DISTINCT display_name AS display, regexp_extract_all(lower(book_scientific_name), '[a-z][a-z.-]*')[1:2] AS two FROM record_name_metadata WHERE display_name IS NOT NULL)
    SELECT doc_id, display, latin, EXISTS (SELECT 1 FROM a WHERE a.display = p.display AND len(a.two) = 2 AND a.two = regexp_extract_all(lower(latin), '[a-z][a-z.-]*')[1:2]) AS authorized FROM p""")
def entity_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents with the names of their record added, so that there are pairs of both kinds
    m = read_table(spark, sf_dir, "record_name_metadata")
    names = m.select("record_id", F.concat(F.lit(" "), "display_name", F.lit("（"), "book_scientific_name", F.lit("）")).alias("tail"))
    d = read_table(spark, sf_dir, "documents").join(names, "record_id", "left").select("doc_id", F.concat("text", F.coalesce("tail", F.lit(""))).alias("text"))
    return gt.entity_pairs(d, "doc_id", "text", m.filter("display_name IS NOT NULL").select(F.col("display_name").alias("display"), F.col("book_scientific_name").alias("scientific")))


@query(r"""
    WITH e AS (SELECT record_id AS rec, row_number() OVER (PARTITION BY record_id ORDER BY pdf_page, chunk_id) AS ordinal, source_id || ' PDF p.' || pdf_page AS label FROM (SELECT DISTINCT record_id, chunk_id, source_id, pdf_page FROM embedding_chunks) QUALIFY ordinal <= 12),
    d AS (SELECT doc_id, record_id, text FROM documents WHERE text IS NOT NULL), m AS (SELECT DISTINCT doc_id, record_id, unnest(regexp_extract_all(text, '\[E\d+(?:\s*,\s*E\d+)*\]')) AS mark FROM d),
    n AS (SELECT doc_id, record_id, mark, unnest(regexp_extract_all(mark, 'E(\d+)', 1)) AS n, generate_subscripts(regexp_extract_all(mark, 'E(\d+)', 1), 1) AS pos FROM m),
    l AS (SELECT doc_id, mark, '[' || string_agg(label, '; ' ORDER BY pos) || ']' AS made FROM n JOIN e ON e.rec = n.record_id AND e.ordinal = CAST(n.n AS BIGINT) GROUP BY ALL),
    s AS (SELECT doc_id, list({'m': mark, 't': made} ORDER BY mark) AS swaps FROM l GROUP BY 1)
    SELECT doc_id, CASE WHEN swaps IS NULL THEN md5(text) ELSE md5(list_reduce(list_concat([{'m': '', 't': text}], swaps), lambda a, b: {'m': '', 't': replace(a.t, b.m, b.t)}).t) END AS rendered_md5 FROM d LEFT JOIN s USING (doc_id)""")
def rendered_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("record_id").orderBy("pdf_page", "chunk_id")
    e = read_table(spark, sf_dir, "embedding_chunks").select("record_id", "chunk_id", "source_id", "pdf_page").distinct().withColumn("ordinal", F.row_number().over(w)).filter("ordinal <= 12")
    e = e.select(F.col("record_id").alias("record"), "ordinal", F.concat("source_id", F.lit(" PDF p."), F.col("pdf_page").cast("string")).alias("label"))
    d = read_table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", "record_id", "text")
    return gt.rendered_citations(d, "doc_id", "text", "record_id", e).select("doc_id", F.md5("rendered").alias("rendered_md5"))


_REQUESTS = {"question": "length(trim(question)) BETWEEN 1 AND 60", "dimensions": "dimensions BETWEEN 1 AND 4096", "status": "expected_status IN ('answerable', 'refused')", "profile": "profile_id IN ('child-96-o16', 'child-160-o32', 'child-512-o100')", "vector": "length(embedding_json) > 0"}


@query(" UNION ALL ".join(f"SELECT query_id, '{n}' AS error FROM embedding_queries WHERE NOT coalesce({c}, false)" for n, c in _REQUESTS.items()))
def request_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col
    rules = {
        "question": F.length(F.trim("question")).between(1, 60), "dimensions": q("dimensions").between(1, 4096), "status": q("expected_status").isin("answerable", "refused"),
        "profile": q("profile_id").isin("child-96-o16", "child-160-o32", "child-512-o100"), "vector": F.length("embedding_json") > 0,
    }
    return tb.checks(read_table(spark, sf_dir, "embedding_queries"), "query_id", rules)


@query("SELECT profile_id, array_to_string(list_sort(list_filter(['answerable', 'refused', 'unspecified', 'ambiguous'], lambda x: NOT list_contains(list(DISTINCT expected_status), x))), ',') AS missing FROM embedding_queries GROUP BY 1")
def fixture_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = F.collect_set("expected_status")  # a handful of values
    g = read_table(spark, sf_dir, "embedding_queries").groupBy("profile_id").agg(have.alias("have"))
    wanted = F.array(*[F.lit(x) for x in ("answerable", "refused", "unspecified", "ambiguous")])
    return g.select("profile_id", F.array_join(F.array_sort(F.array_except(wanted, "have")), ",").alias("missing"))


@query("SELECT e.vec_id AS query, x.vec_id AS item, row_number() OVER (PARTITION BY e.vec_id ORDER BY round(list_cosine_similarity(e.embedding::DOUBLE[], x.embedding::DOUBLE[]), 1) DESC, CAST(x.vec_id AS VARCHAR)) AS rank FROM embeddings e, embeddings x WHERE e.vec_id % 50 = 0 AND x.vec_id <> e.vec_id QUALIFY rank <= 5")
def stable_rounded_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ranks on a rounded score keep ties in the order of the input, which is that of the ids
    e = read_table(spark, sf_dir, "embeddings")
    h = rt.vector_search(e, e.filter("vec_id % 50 = 0"), "vec_id", "embedding", "vec_id", "embedding", 5, exclude_same=True, digits=1)
    return h.select(F.col("query").cast("long").alias("query"), F.col("item").cast("long").alias("item"), F.col("rank").cast("long").alias("rank"))
