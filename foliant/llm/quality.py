"""Per-document text quality statistics and fixed-threshold rules (problem 1).

Everything is a Catalyst expression over one text column: no Python, no shuffle.
The rules follow the published heuristics for web text (symbol-to-word ratio, share of
bullet lines, mean word length, share of common words, share of alphabetic words), with
thresholds set for pages of printed books; each failed rule is recorded by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the corpus languages.
COMMON_WORDS = (
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis "
    "mehr durch man sein deren jedoch unter beim doch wobei während gegen the of and to a is that for it as was with "
    "be by on not he his but at are this have from or had they which one were their there been when who will no if out "
    "them towards against le la les du un une que est pour qui dans par sur au plus avec ce il ne pas son sont on "
    "ont contre vers cette et ex cum est sunt non sed quod"
).split()

# The thresholds of the rules.
THRESHOLDS = {
    "min_chars": 120,
    "max_structured_share": 0.5,
    "max_symbol_ratio": 0.30,
    "min_alpha_ratio": 0.50,
    "max_latin_bytes": 1.5,
    "min_distinct_words": 0.12,
    "min_mean_word": 2.4,
    "max_mean_word": 14.0,
    "min_common_share": 0.06,
    "max_cell_common_share": 0.18,
    "short_line_chars": 4,
    "fragmented_short_share": 0.38,
    "min_words": 18,
    "empty_chars": 8,
}

WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

STATISTICS = (
    "character_count word_count line_count alpha_ratio bytes_per_character short_line_ratio mean_word_length symbol_ratio "
    "punct_end_ratio bullet_ratio common_word_share structured_share distinct_word_share"
).split()

# Lines that carry the structure of a list or a table.
_BULLET = r"[•–—*·▪‣◦-]\s+\S.*"
_NUMBERED = r"(?:\d{1,3}[.)]|\(?[a-z]\)|[IVXLC]{1,6}[.)])\s+\S.*"
_ROMAN = r"[IVXLC]{1,6}\s{2,}\S.*"
_PAGE_TAIL = r"[^\n]*+(?<=(?:[^\S\n]{2,30}|\t|\.[ ]?\.[ ]?\.[ ]{0,2}|,[ ])\d[\d.,;–-]{0,20}[ ]{0,3})"
_REGISTER = r"\p{L}[^\n.!?,]*+,\s\d+(?:,\s\d+)*+;[^\n]*+"
_CELLS = r"[^\n\t]*+\t[^\n]*+|[^\n|]*+\|[^\n|]*+\|[^\n]*+|(?:\S++[ ])*+\S++[ ]{2,}(?:\S++[ ])*+\S++[ ]{2,}\S[^\n]*+"
_STRUCTURED = rf"(?m)^[ ]*+(?:{_BULLET}|{_NUMBERED}|{_ROMAN}|{_PAGE_TAIL}|{_REGISTER}|{_CELLS})$"
_CELL_LINE = r"(?m)^[ ]*(?:\S{1,24}(?: \S{1,20})?)[ ]*$"
_EDGE = 160
WINDOW = 100  # words
_FURNITURE_HEAD = (
    r"\A\s*(?:[\[(—–-]?[ ]?\d{1,4}[ ]?[\])—–-]?[ ]*\n\s*)?"
    r"(?:\d{1,4}[ ]{2,}[^\n]{1,60}\n|[^\n.,;|\t]{1,60}?(?:[ ]{2,}|[ ][—–][ ])\d{1,4}[ ]*\n|[\p{Lu}\d ]{5,60}\n)?"
)
_FURNITURE_FOOT = r"(?:\n[ ]*(?:[\[(—–-]?[ ]?\d{1,4}[ ]?[\])—–-]?|[^\n|\t]{1,40}[ ]\d{1,4}\*?)[ ]*){0,2}\s*\z"


def _len(c: Column) -> Column:
    return F.length(c).cast("double")


def _ratio(a: Column, b: Column) -> Column:
    """Ratio to four digits, rounded by a floor: engines differ in rounding halves of binary fractions."""
    return F.when(b > 0, F.floor(a * 10000.0 / b + 0.5) / 10000.0).otherwise(F.lit(0.0))


def _distinct_in_windows(words: Column) -> Column:
    """Distinct words of each run of ``WINDOW`` words, summed: what a text repeats doesn't depend on its length."""
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(words) / WINDOW) - 1, F.lit(0)).cast("int"))
    return F.aggregate(starts, F.lit(0), lambda a, i: a + F.size(F.array_distinct(F.slice(words, i * WINDOW + 1, F.lit(WINDOW)))))


def text_statistics(df: DataFrame, text: str = "best_text", prefix: str = "") -> DataFrame:
    """Add one column per statistic for ``text``; every row comes out, extra columns stay.

    Null texts count as empty: all counts 0, ratios 0.0 (``short_line_ratio`` 1.0), quality
    ``empty``. Columns whose names clash with a statistic are replaced by the recomputed value
    unless ``prefix`` keeps them apart. Texts of any length are read whole; ``distinct_word_share`` is the mean
    over runs of ``WINDOW`` words, so that it means the same in short and long texts.
    """
    p = lambda n: f"{prefix}{n}"
    raw = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("__t", F.btrim(raw, F.lit(WHITE)))
    t = F.col("__t")
    # furniture stands within the first and last characters only
    body = F.concat(
        F.regexp_replace(F.substring(t, 1, _EDGE), _FURNITURE_HEAD, ""),
        F.substring(t, F.lit(_EDGE + 1), F.greatest(F.length(t) - 2 * _EDGE, F.lit(0))),
        F.regexp_replace(F.expr(f"right(__t, greatest(least(length(__t) - {_EDGE}, {_EDGE}), 0))"), _FURNITURE_FOOT, ""),
    )
    words = F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}]+(?:[-'][\p{L}\p{N}]+)*"), F.lit(0))
    df = df.withColumn("__body", body).withColumn("__w", words)
    b, w = F.col("__body"), F.col("__w")
    letters = _len(F.regexp_replace(t, r"[^\p{L}]+", ""))
    df = (
        df.withColumn("__rest", F.regexp_replace(b, _STRUCTURED, ""))
        .withColumn(p("character_count"), F.length(t))
        .withColumn(p("word_count"), F.size(w))
        .withColumn("__wl", _len(F.array_join(w, "")))
        .withColumn(p("line_count"), F.regexp_count(t, F.lit(r"(?m)^.*\S.*$")))
        .withColumn("__short", F.regexp_count(t, F.lit(r"(?m)^[^\S\n]*+\S(?:[^\n]{0,2}\S)?[^\S\n]*+$")))
        .withColumn(p("alpha_ratio"), _ratio(letters, _len(t)))
        .withColumn(p("bytes_per_character"), _ratio(F.octet_length(t), F.length(t)))
        .withColumn("__punct_end", F.regexp_count(t, F.lit(r"(?m)[.!?:;。！？…][\"'”“»)\]]*[ ]*$")))
        .withColumn("__bullets", F.regexp_count(t, F.lit(rf"(?m)^[ ]*+(?:{_BULLET}|{_NUMBERED})$")))
        .withColumn("__common", F.size(F.filter(w, lambda x: x.isin(*COMMON_WORDS))))
        .withColumn("__distinct", _distinct_in_windows(w))
    )
    lines, n = F.col(p("line_count")), F.col(p("word_count"))
    symbols = _len(F.regexp_replace(t, r"[\p{L}\p{N}\s.,;:!?\"'„“”‚‘’«»()\-]+", ""))
    df = (
        df.withColumn(p("short_line_ratio"), F.when(lines > 0, _ratio(F.col("__short"), lines)).otherwise(F.lit(1.0)))
        .withColumn(p("mean_word_length"), _ratio(F.col("__wl"), n))
        .withColumn(p("symbol_ratio"), _ratio(symbols, _len(t)))
        .withColumn(p("punct_end_ratio"), _ratio(F.col("__punct_end"), lines))
        .withColumn(p("bullet_ratio"), _ratio(F.col("__bullets"), lines))
        .withColumn(p("common_word_share"), _ratio(F.col("__common"), n))
    )
    common = F.col(p("common_word_share"))
    # lines of single cells count where running text is out of the question
    rest = F.when(common < THRESHOLDS["max_cell_common_share"], F.regexp_replace("__rest", _CELL_LINE, "")).otherwise(F.col("__rest"))
    df = df.withColumn(p("structured_share"), _ratio(_len(b) - _len(rest), _len(b)))
    df = df.withColumn(p("distinct_word_share"), _ratio(F.col("__distinct"), n))
    made = [p(x) for x in STATISTICS]
    rest = [c for c in df.columns if c not in made and not c.startswith("__")]
    # through a generator no later filter is pushed down, where it would compute each statistic once more per rule
    return df.select(*[F.col(f"`{c}`") for c in rest], F.inline(F.array(F.struct(*made))))


def apply_rules(df: DataFrame, prefix: str = "") -> DataFrame:
    """Add ``failed_rules`` (names, in fixed order), ``text_class`` and ``quality``.

    ``text_class``: ``short`` (under 120 characters), ``junk``, ``structured`` (list or table) or ``prose``.
    """
    p = lambda n: F.col(f"{prefix}{n}")
    k = THRESHOLDS
    latin = p("bytes_per_character") < k["max_latin_bytes"]  # other scripts take two bytes or more
    spaced = p("word_count") > 0
    rules = [
        ("too_short", p("character_count") < k["min_chars"]),
        ("symbols", p("symbol_ratio") > k["max_symbol_ratio"]),
        ("few_letters", (p("alpha_ratio") < k["min_alpha_ratio"]) & (p("structured_share") <= k["max_structured_share"])),
        ("repetition", (p("distinct_word_share") < k["min_distinct_words"]) & (p("word_count") >= 20)),
        ("word_length", latin & spaced & ~p("mean_word_length").between(k["min_mean_word"], k["max_mean_word"]) & (p("structured_share") <= k["max_structured_share"])),
        ("few_common_words", latin & (p("common_word_share") < k["min_common_share"]) & (p("structured_share") <= k["max_structured_share"])),
        ("structured_lines", p("structured_share") > k["max_structured_share"]),
    ]
    failed = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    junk = ["symbols", "few_letters", "repetition", "word_length", "few_common_words"]
    df = df.withColumn(f"{prefix}failed_rules", failed)
    f = p("failed_rules")
    return df.withColumn(
        f"{prefix}text_class",
        F.when(F.array_contains(f, "too_short"), "short")
        .when(F.arrays_overlap(f, F.array(*[F.lit(x) for x in junk])), "junk")
        .when(F.array_contains(f, "structured_lines"), "structured")
        .otherwise("prose"),
    ).withColumn(
        f"{prefix}quality",
        F.when(p("character_count") < k["empty_chars"], "empty")
        .when((p("character_count") < k["min_chars"]) | (p("word_count") < k["min_words"]), "low_text")
        .when(p("short_line_ratio") > k["fragmented_short_share"], "fragmented")
        .otherwise("usable"),
    )


def page_quality(pages: DataFrame, text: str = "best_text") -> DataFrame:
    """Statistics, failed rules, class and quality for every row of ``pages``.

    Input: any table with a text column. Nulls, empty and very long texts, repeated rows and empty tables
    all give one output row per input row; stored statistics under the same names are recomputed.
    """
    return apply_rules(text_statistics(pages, text))


def not_prose(pages: DataFrame, text: str = "best_text") -> DataFrame:
    """Rows long enough to judge whose larger part is a list, a table or junk."""
    return page_quality(pages, text).filter(F.col("text_class").isin("junk", "structured"))
