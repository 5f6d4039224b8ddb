"""Column functions on text. All stay in whole-stage code: no Python functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+(?:[-'][\p{L}\p{N}]+)*"
UNIT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
TERM = r"[\p{L}\p{N}]+"
BINOMIAL = r"([A-Z][a-z]{2,}) ([a-z]{3,})"
WHITE = " \t\n\x0b\f\r"
# Letters with a diacritic and what they fold to, in the same order.
DIACRITICS = "àáâãäåāăąçćčďèéêëēĕėęěìíîïīĭłñńňòóôõöøōŏőŕřśšťùúûüūŭůűýÿźżž"
FOLDED = "aaaaaaaaacccdeeeeeeeeeiiiiiilnnnooooooooorrsstuuuuuuuuyyzzz"
# Named characters of markup.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def stripped(c: Column) -> Column:
    """Without white space at both ends; null counts as empty. One pass from each end, however long runs of white space are."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))


def ratio(a: Column, b: Column, digits: int = 4, empty: float = 0.0) -> Column:
    """Rounded by a floor, which every engine computes alike where decimal rounding of a binary fraction isn't."""
    scale = float(10**digits)
    return F.when(b > 0, F.floor(a * scale / b + 0.5) / scale).otherwise(F.lit(empty))


def word_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0))).cast("long")


def unit_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(UNIT), F.lit(0))).cast("long")


def lines(c: Column) -> Column:
    """Lines that aren't blank."""
    return F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")


def alpha_ratio(c: Column) -> Column:
    return ratio(F.length(F.regexp_replace(c, r"[^\p{L}]", "")), F.length(c))


def fold(c: Column) -> Column:
    """Lower case without diacritics."""
    return F.translate(F.lower(c), DIACRITICS, FOLDED)


def terms(c: Column) -> Column:
    """Index terms of a text: folded runs of letters and digits."""
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit(TERM), F.lit(0))


def query_terms(c: Column, most: int = 32) -> Column:
    """Terms of a question: Latin runs of three letters or more; ideograph runs of two or more, whole up to
    six, beyond that their runs of four, three and two; each once, in order of appearance."""
    low = fold(F.coalesce(c, F.lit("")))
    latin = F.regexp_extract_all(low, F.lit(r"[a-z0-9]{3,}"), F.lit(0))
    han = F.regexp_extract_all(low, F.lit(r"[\x{3400}-\x{9fff}]{2,}"), F.lit(0))
    grams = lambda r, n: F.transform(F.sequence(F.lit(1), F.length(r) - (n - 1)), lambda i: F.substring(r, i, F.lit(n)))
    cut = F.flatten(F.transform(han, lambda r: F.when(F.length(r) <= 6, F.array(r)).otherwise(F.concat(grams(r, 4), grams(r, 3), grams(r, 2)))))
    return F.slice(F.array_distinct(F.concat(latin, cut)), 1, most)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def html_text(c: Column) -> Column:
    """Text of markup: tags become spaces, named characters are resolved, white space collapses."""
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    for name, char in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def joined_quote(c: Column) -> Column:
    """A quotation for comparison: words hyphenated at line ends joined, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"([A-Za-z])-\s+([A-Za-z])", "$1$2"), r"\s+", " "))


def language_route(c: Column) -> Column:
    """Language of an answer by the script of the question."""
    return F.when(c.rlike(r"[\x{3040}-\x{30ff}]"), "ja").when(c.rlike(r"[\x{3400}-\x{9fff}]"), "zh").when(c.rlike(r"[\x{0400}-\x{04ff}]"), "ru").otherwise("en")


def citations(c: Column) -> Column:
    """Evidence numbers cited as [E1] or [E1, E2], each once, in order of appearance."""
    marks = F.regexp_extract_all(c, F.lit(r"\[E\d+(?:,\s*E\d+)*\]"), F.lit(0))
    numbers = F.flatten(F.transform(marks, lambda m: F.regexp_extract_all(m, F.lit(r"E(\d+)"), F.lit(1))))
    return F.array_distinct(F.transform(numbers, lambda n: n.cast("int")))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def canonical_json_hash(columns: list[str], compact: bool = True) -> Column:
    """Hash of a row's JSON with sorted keys and nulls kept; with spaces after separators if not ``compact``.

    Strings must not hold the separators ``","`` or ``":"`` where ``compact`` is off, as these are spaced in the text."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    if not compact:
        text = F.replace(F.replace(text, F.lit('":'), F.lit('": ')), F.lit(',"'), F.lit(', "'))
    return F.sha2(text, 256)
