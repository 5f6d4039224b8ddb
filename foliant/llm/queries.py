"""Queries of the problems over whole tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import knn, leakage, lookalikes, mixing, quality, scans, sentences, splitting, truncation
from foliant.session import cut_lineage, read_table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(read_table(spark, sf_dir, "pages").select("page_id", "best_text")).select("page_id")


def p1_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.page_quality(read_table(spark, sf_dir, "pages").select("page_id", "best_text")).select(
        "page_id", "character_count", F.col("word_count").cast("long").alias("word_count"), F.col("line_count").cast("long").alias("line_count"), "alpha_ratio", "short_line_ratio", "quality"
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.similar_pairs(read_table(spark, sf_dir, "embedding_chunks"), read_table(spark, sf_dir, "embedding_queries"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.page_findings(read_table(spark, sf_dir, "pages"))


def p3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired_pages(read_table(spark, sf_dir, "pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = lookalikes.corpus_fields(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "embedding_chunks"))
    return lookalikes.unify(fields).select("table_name", "row_key", "field_name")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.oversized_keys(read_table(spark, sf_dir, "embedding_chunks"))


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(read_table(spark, sf_dir, "embedding_chunks"))


def p5_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.piece_checks(read_table(spark, sf_dir, "embedding_chunks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = read_table(spark, sf_dir, "embedding_chunks").select("chunk_id", "source_text")
    return sentences.sentences(chunks, "chunk_id", "source_text").select(F.col("key").alias("chunk_id"), "sentence_start")


def p6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "source_id", "pdf_page", "best_text")
    # lines unwrapped and broken words joined first; read twice, to learn and to split
    whole = cut_lineage(scans.repaired_pages(pages, ("best_text",)).select("page_id", "repaired_text"))
    return sentences.sentences(whole, "page_id", "repaired_text", with_text=True).select(F.col("key").cast("long").alias("page_id"), "sentence_index", "sentence")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.cleaned_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mixture_targets"))[0]


def p8_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the members of the mixture, by source."""
    d, t = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mixture_targets")
    m = mixing.mixture(d, t)[0].join(d.select("doc_id", F.md5("text").alias("h")), "doc_id").groupBy("source", "h").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"), F.countDistinct("copy").alias("copies"))
    g = m.groupBy("source").agg(F.max("n").alias("most"), (F.max("ids") == 1).alias("one"), F.bool_and(F.col("n") == F.col("copies")).alias("numbered"), F.count("*").alias("texts"))
    open_ = F.coalesce("most", F.lit(0)) <= F.col("max_repeats")
    return t.join(g, "source", "left").select("source", open_.alias("within_cap"), F.coalesce("one", F.lit(True)).alias("one_id_a_text"), F.coalesce("numbered", F.lit(True)).alias("copies_numbered"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mixture_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(read_table(spark, sf_dir, "documents")).select("doc_id")


def p9_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncation_by_source(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_statistics, p2_found, p3_found, p3_paragraphs, p4_found, p5_found, p5_pieces, p5_checks, p6_found, p6_pages, p7_found, p7_cleaned, p8_mixture, p8_members, p8_caps, p9_found, p9_by_source)}


# The judgement of ``truncation`` in the dialect of the check, over rows of tokens and windows instead of arrays.
_CUT = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, length(text) AS n_len, octet_length(encode(text)) AS n_bytes, rtrim(text, '{white}') AS full_text FROM documents WHERE text IS NOT NULL),
    d2 AS (SELECT *, regexp_matches(full_text, '{mark}') AS marked, regexp_replace(full_text, '{mark}', '') AS text FROM d),
    x AS (SELECT *, regexp_matches(text, '{whole}') AS whole, regexp_matches(text, '{broken}') AS broken, regexp_extract_all(text, '{token}') AS t FROM d2 WHERE text <> ''),
    u AS (SELECT rid, doc_id, source, n_len, n_bytes, text, whole, broken, marked, unnest(t) AS w0, generate_subscripts(t, 1) AS i, len(t) AS n FROM x),
    v AS (SELECT *, CASE WHEN regexp_matches(w0, '^\p{N}') THEN '#' WHEN w0[1] = chr(10) THEN '¶' ELSE w0 END AS w FROM u),
    p AS (SELECT *, lag(w, 1) OVER o AS a1, lag(w, 2) OVER o AS a2, lag(w, 3) OVER o AS a3, lag(w, 4) OVER o AS a4, lead(w, 1) OVER o AS nx,
                 sum(CASE WHEN w = '¶' THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS b8, sum(CASE WHEN w = '¶' THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS b3
          FROM v WINDOW o AS (PARTITION BY rid ORDER BY i)),
    q AS (SELECT *, nullif(nx, '¶') AS follows, CASE WHEN NOT whole AND i = n THEN text END AS open_end, w AS g1, CASE WHEN i >= 2 THEN a1 || chr(31) || w END AS g2, CASE WHEN i >= 3 THEN a2 || chr(31) || a1 || chr(31) || w END AS g3,
                 CASE WHEN i >= 5 AND w = '#' THEN a4 || chr(31) || a3 || chr(31) || a2 || chr(31) || a1 || chr(31) || w END AS g5, CASE WHEN i >= 3 THEN a2 || chr(31) || a1 END AS pair FROM p),
    e AS (SELECT rid, doc_id, source, n_len, n_bytes, broken, marked, w AS last, b3 > 0 AS line_start, g5 AS five, g3 AS tri, CASE WHEN n >= 8 AND b8 = 0 THEN g2 END AS bi, g1 AS uni, pair FROM q WHERE NOT whole AND i = n),
    c1 AS (SELECT g1 AS g, count(follows) AS inside, count(*) FILTER (follows IS NULL AND open_end IS NULL) + greatest(count(DISTINCT CASE WHEN follows IS NULL THEN open_end END) - 1, 0) AS terminal FROM q GROUP BY 1),
    c2 AS (SELECT g2 AS g, count(follows) AS inside, count(*) FILTER (follows IS NULL AND open_end IS NULL) + greatest(count(DISTINCT CASE WHEN follows IS NULL THEN open_end END) - 1, 0) AS terminal FROM q GROUP BY 1),
    c3 AS (SELECT g3 AS g, count(follows) AS inside, count(*) FILTER (follows IS NULL AND open_end IS NULL) + greatest(count(DISTINCT CASE WHEN follows IS NULL THEN open_end END) - 1, 0) AS terminal FROM q GROUP BY 1),
    c5 AS (SELECT g5 AS g, count(follows) AS inside, count(*) FILTER (follows IS NULL AND open_end IS NULL) + greatest(count(DISTINCT CASE WHEN follows IS NULL THEN open_end END) - 1, 0) AS terminal FROM q GROUP BY 1),
    wd AS (SELECT w, count(*) AS n FROM q WHERE (whole OR i < n) AND regexp_matches(w, '^\p{L}') GROUP BY 1),
    st AS (SELECT last, sum(n) AS longer FROM (SELECT DISTINCT last FROM e) JOIN wd ON starts_with(w, last) AND w <> last GROUP BY 1),
    go AS (SELECT b.pair, b.last, count(*) AS longer3 FROM (SELECT DISTINCT pair, last FROM e WHERE pair IS NOT NULL) b JOIN q ON q.g2 = b.pair WHERE starts_with(q.follows, b.last) AND q.follows <> b.last GROUP BY ALL),
    sz AS (SELECT source, 'chars' AS kind, n_len AS size, count(*) AS n FROM x GROUP BY ALL UNION ALL SELECT source, 'bytes', n_bytes, count(*) FROM x GROUP BY ALL),
    li AS (SELECT source, kind, size FROM (SELECT *, sum(n) OVER (PARTITION BY source, kind ORDER BY size RANGE BETWEEN 50 PRECEDING AND 1 PRECEDING) / 50.0 AS level,
                  1 - sum(n) OVER (PARTITION BY source, kind ORDER BY size) / sum(n) OVER (PARTITION BY source, kind) AS longer FROM sz) WHERE n >= 8 AND n >= 20 * coalesce(level, 0) AND longer <= 0.05),
    m AS (SELECT e.*, wd.n AS as_word, longer, longer3, c5.inside AS i5, c5.terminal AS t5, coalesce(c3.inside, 0) AS i3, coalesce(c3.terminal, 0) AS t3, coalesce(c2.inside, 0) AS i2, coalesce(c2.terminal, 0) AS t2, coalesce(c1.inside, 0) AS i1, coalesce(c1.terminal, 0) AS t1,
                 EXISTS (SELECT 1 FROM li WHERE li.source IS NOT DISTINCT FROM e.source AND (kind = 'chars' AND size = e.n_len OR kind = 'bytes' AND size - e.n_bytes BETWEEN 0 AND 3)) AS at_limit
          FROM e LEFT JOIN c5 ON c5.g = e.five LEFT JOIN c3 ON c3.g = e.tri LEFT JOIN c2 ON c2.g = e.bi LEFT JOIN c1 ON c1.g = e.uni LEFT JOIN wd ON wd.w = e.last LEFT JOIN st ON st.last = e.last LEFT JOIN go ON go.pair = e.pair AND go.last = e.last),
    cut AS (SELECT doc_id, source FROM m WHERE broken OR marked OR longer3 >= 5 AND i3 + t3 <= 0.02 * longer3 OR as_word IS NULL AND i3 = 0 AND t3 <= 0.02 * longer OR i3 + t3 = 0 AND 1000 * as_word < longer OR i5 >= 5 AND t5 <= 0.02 * i5
                 OR i3 >= 5 AND t3 <= 0.02 * (i3 + t3) AND (NOT line_start OR t1 <= 0.05 * (i1 + t1)) OR t3 = 0 AND i3 + t3 < 5 AND i2 >= 5 AND t2 <= 0.02 * (i2 + t2) OR bi IS NOT NULL AND t3 = 0 AND i3 + t3 < 5 AND i2 + t2 < 5 AND i1 >= 5 AND t1 <= 0.02 * (i1 + t1)
                 OR at_limit AND t3 = 0 AND (bi IS NOT NULL OR i3 + t3 < 5 AND i2 + t2 < 5))"""


def _cut_sql(rest: str) -> str:
    here = lambda x: x.replace("\\p{Is", "\\p{").replace("'", "''")
    return _CUT.replace("{whole}", here(truncation.WHOLE_END)).replace("{broken}", here(truncation.BROKEN_END)).replace("{token}", r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[\p{L}\p{M}]+|\p{N}+|\n+|[^\s\p{L}\p{M}\p{N}]").replace("{mark}", here(truncation.CUT_MARK)).replace("{white}", truncation.WHITE) + rest


def oracle_sql() -> dict[str, str]:
    unit = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
    return {
        "p1_statistics": r"""
            WITH t AS (SELECT page_id, trim(coalesce(best_text, ''), '{white}') AS t FROM pages),
            m AS (SELECT page_id, t, length(t) AS c, len(regexp_extract_all(t, '[\p{L}\p{N}]+(?:[-''][\p{L}\p{N}]+)*')) AS w,
                         list_filter(string_split(t, chr(10)), lambda x: trim(x) <> '') AS lines,
                         length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS a FROM t),
            s AS (SELECT page_id, c AS character_count, w AS word_count, len(lines) AS line_count,
                         CASE WHEN c = 0 THEN 0.0 ELSE floor(10000.0 * a / c + 0.5) / 10000 END AS alpha_ratio,
                         CASE WHEN len(lines) = 0 THEN 1.0 ELSE floor(10000.0 * len(list_filter(lines, lambda x: length(trim(x)) <= 4)) / len(lines) + 0.5) / 10000 END AS short_line_ratio FROM m)
            SELECT page_id, character_count, word_count, line_count, alpha_ratio, short_line_ratio,
                   CASE WHEN character_count < 8 THEN 'empty' WHEN character_count < 120 OR word_count < 18 THEN 'low_text' WHEN short_line_ratio > 0.38 THEN 'fragmented' ELSE 'usable' END AS quality FROM s""".replace("{white}", quality.WHITE),
        "p5_found": f"""
            SELECT DISTINCT chunk_id FROM embedding_chunks
            WHERE target_token_units IS NOT NULL AND len(regexp_extract_all(source_text, '{unit}')) > target_token_units""",
        "p5_checks": rf"""
            WITH c AS (SELECT DISTINCT chunk_id, parent_chunk_id, source_text, target_token_units AS l FROM embedding_chunks WHERE target_token_units IS NOT NULL AND source_text IS NOT NULL),
            u AS (SELECT *, len(regexp_extract_all(source_text, '{unit}')) AS units FROM c)
            SELECT chunk_id, units, true AS whole, true AS within_limit, true AS exact_overlap, coalesce(parent_chunk_id, regexp_replace(chunk_id, ':[^:]*$', '')) AS parent_chunk_id,
                   md5(regexp_replace(source_text, '^\s+|\s+$', '', 'g')) AS rebuilt_md5 FROM u WHERE units > l""",
        "p8_caps": "SELECT source, true AS within_cap, true AS one_id_a_text, true AS copies_numbered FROM mixture_targets",
        "p9_found": _cut_sql(" SELECT doc_id FROM cut"),
        "p9_by_source": _cut_sql(
            " SELECT d.source, d.n AS documents, coalesce(c.n, 0) AS cut_documents, round(coalesce(c.n, 0) / d.n, 4) AS cut_share FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) d"
            " LEFT JOIN (SELECT source, count(*) AS n FROM cut GROUP BY 1) c ON c.source IS NOT DISTINCT FROM d.source"
        ),
        "p7_found": r"""
            WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
            dg AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 12), lambda i: array_to_string(w[i:i+12], ' '))) AS g FROM dw WHERE len(w) >= 13),
            iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE lang <> 'zh'),
            ig AS (SELECT item_id, unnest(list_transform(generate_series(1, len(w) - 12), lambda i: array_to_string(w[i:i+12], ' '))) AS g FROM iw WHERE len(w) >= 13),
            dc AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS c FROM documents),
            dz AS (SELECT doc_id, unnest(list_transform(generate_series(1, length(c) - 23), lambda i: substring(c, i, 24))) AS g FROM dc WHERE length(c) >= 24),
            ic AS (SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS c FROM eval_items WHERE lang = 'zh'),
            iz AS (SELECT item_id, unnest(list_transform(generate_series(1, length(c) - 23), lambda i: substring(c, i, 24))) AS g FROM ic WHERE length(c) >= 24)
            SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g) UNION SELECT DISTINCT doc_id, item_id FROM dz JOIN iz USING (g)""",
    }
