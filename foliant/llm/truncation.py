"""Text cut off by field limits or in transfer (problem 9).

Pure SQL over token trigrams: a text that doesn't end a sentence is cut when its last trigram is
frequent inside texts but almost never stands at an end. The last token of a trigram may be the beginning of a
word only. Where a trigram is too rare to tell, fewer tokens, word counts and lengths at which a source's texts pile up (its field limits)
are further evidence. Everything is counted over all documents, in one pass: only grams that some end asks about are counted, as these are known first.
"""

from __future__ import annotations

import uuid
from string import Template

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

# A token is a word, an ideograph, kana or Thai sign; a number (written 0 before); the last line end of several; another sign. Latin words come first, as most are.
TOKEN = r"[a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][\p{L}\p{M}]*+|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}]++|0|\n(?!\n)|[^\s\p{L}\p{M}]"
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# A whole end: a stop, perhaps with closing signs or citations after it.
WHOLE_END = r"[.!?…。！？؟।॥][\x22\x27”“’»」』）)\]\s]*(?:\[\w+(?:,\s*\w+)*\][.\s]*)*$"

# An escape, character name or tag that is begun and not ended, or a character cut in two.
BROKEN_END = r"(?:\\(?:u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?|&(?:[A-Za-z]{1,8}|#x?[0-9A-Fa-f]{0,6})|</?[A-Za-z][A-Za-z0-9]{0,10}(?: [^<>]{0,60})?|</?|\x{FFFD})$"

# An ellipsis that stands for what was cut off.
CUT_MARK = r"\s*(?:…|\.{3})$"
# The stops of a whole end, and the signs after which the whole pattern is asked.
STOPS, CLOSERS = ".!?…。！？؟।॥", "\"'”“’»」』）)]"
BROKEN_SIGNS = 80  # a broken end is shorter

_TEXTS = r"""
SELECT doc_id, source, n_len, n_bytes, marked, text, CASE WHEN instr('$stops', right(text, 1)) > 0 THEN true WHEN instr('$closers', right(text, 1)) > 0 THEN text RLIKE r'$whole_end' ELSE false END AS whole, right(text, $broken_signs) RLIKE r'$broken_end' AS broken
FROM (SELECT *, CASE WHEN marked THEN regexp_replace(full, r'$cut_mark', '') ELSE full END AS text
      FROM (SELECT *, endswith(full, '…') OR endswith(full, '...') AS marked
            FROM (SELECT doc_id, source, length(text) AS n_len, octet_length(text) AS n_bytes, CASE WHEN instr('$white', right(text, 1)) > 0 THEN TRIM(TRAILING '$white' FROM text) ELSE text END AS full FROM $docs WHERE text IS NOT NULL)))
WHERE text <> ''"""

# Tokens of a text, numbers and line ends made alike.
_TOKENS = r"regexp_extract_all(regexp_replace(text, r'\p{N}+', '0'), r'$token', 0)"

# Ends of the texts that don't end a sentence: hashes of the last five (of numbers), three, two and one tokens, and of the two before the last.
# Fewer than three tokens tell nothing in a short last line: a name, a caption or an item of a list is whole. ``same`` tells equal texts apart from different ones.
_ENDS = """
SELECT doc_id, source, n_len, n_bytes, broken, marked, same, t[n-1] AS last, array_contains(slice(t, -least(n, 3), 3), '\\n') AS line_start,
       CASE WHEN n >= 5 AND t[n-1] = '0' THEN xxhash64(t[n-5], t[n-4], t[n-3], t[n-2], t[n-1]) END AS five,
       CASE WHEN n >= 3 THEN xxhash64(t[n-3], t[n-2], t[n-1]) END AS tri,
       CASE WHEN n >= $long_line AND NOT array_contains(slice(t, -$long_line, $long_line), '\\n') THEN xxhash64(t[n-2], t[n-1]) END AS bi,
       xxhash64(t[n-1]) AS uni,
       CASE WHEN n >= 3 THEN xxhash64(t[n-3], t[n-2]) END AS pair
FROM (SELECT *, size(t) AS n FROM (SELECT *, xxhash64(text) AS same FROM $texts WHERE NOT whole) LATERAL VIEW OUTER explode(array($tokens)) e AS t) WHERE n > 0"""

# The grams that the ends ask about; of pairs it matters what follows.
_ASKED = """
SELECT g, max(f) AS pair FROM (SELECT stack(4, five, false, tri, false, bi, false, pair, true) AS (g, f) FROM $ends) WHERE g IS NOT NULL GROUP BY g"""

# Every place of a text: the token, the next one of the line, and the hashes of two, three, or five tokens that end with a number.
# Generators, here and of the ends, keep filters from being pushed below, and outer ones have no filter on the size of what they open: a text is cut into tokens once.
_PLACES = """
SELECT w, nullif(get(t, i + 1), '\\n') AS nx, xxhash64(w) AS g1, CASE WHEN i >= 1 THEN xxhash64(get(t, i - 1), w) END AS g2, CASE WHEN i >= 2 THEN xxhash64(get(t, i - 2), get(t, i - 1), w) END AS g3,
       CASE WHEN i >= 4 AND w = '0' THEN xxhash64(get(t, i - 4), get(t, i - 3), get(t, i - 2), get(t, i - 1), w) END AS g5
FROM (SELECT $tokens AS t FROM $texts) LATERAL VIEW OUTER posexplode(t) e AS i, w WHERE w IS NOT NULL"""

# How often each word, and each gram that is asked about, stands inside lines and at the end of lines or texts; of pairs what follows them.
_FEW = """
SELECT k, g, s, inside, count(*) AS n FROM (
  SELECT stack(4, 1, g1, w, nx IS NOT NULL, 2, b.g, CASE WHEN b.pair THEN nx END, nx IS NOT NULL, 3, c.g, CAST(NULL AS STRING), nx IS NOT NULL, 5, d.g, CAST(NULL AS STRING), nx IS NOT NULL) AS (k, g, s, inside)
  FROM $places p LEFT JOIN $asked b ON b.g = p.g2 LEFT JOIN $asked c ON c.g = p.g3 LEFT JOIN $asked d ON d.g = p.g5)
WHERE g IS NOT NULL GROUP BY k, g, s, inside"""
# The same where more grams are asked about than may be broadcast: all are counted first.
_MANY = """
SELECT k, h.g, CASE WHEN k = 1 OR a.pair THEN s END AS s, inside, sum(n) AS n FROM (
  SELECT k, g, s, inside, count(*) AS n FROM (
    SELECT stack(4, 1, g1, w, nx IS NOT NULL, 2, g2, nx, nx IS NOT NULL, 3, g3, CAST(NULL AS STRING), nx IS NOT NULL, 5, g5, CAST(NULL AS STRING), nx IS NOT NULL) AS (k, g, s, inside) FROM $places)
  WHERE g IS NOT NULL GROUP BY k, g, s, inside) h
LEFT JOIN $asked a ON a.g = h.g WHERE k = 1 OR a.g IS NOT NULL GROUP BY ALL"""

# Of each final gram: how often it stands inside lines, and how often it ends a line or another open text; equal open texts count once, and the end in question is left out.
_COUNTS = """
SELECT e.g, coalesce(inside, 0) AS inside, coalesce(terminal, 0) - ends + texts - 1 AS terminal
FROM (SELECT $column AS g, count(*) AS ends, count(DISTINCT same) AS texts FROM $ends WHERE $column IS NOT NULL GROUP BY $column) e
LEFT JOIN (SELECT g, sum(CASE WHEN inside THEN n ELSE 0 END) AS inside, sum(CASE WHEN inside THEN 0 ELSE n END) AS terminal FROM $hits WHERE k = $k GROUP BY g) h ON h.g = e.g"""

# Words with their counts, ends of open texts left out.
_WORDS = r"""
SELECT w, all_n - coalesce(ends, 0) AS n FROM (SELECT s AS w, sum(n) AS all_n FROM $hits WHERE k = 1 AND s RLIKE r'^\p{L}' GROUP BY s)
LEFT JOIN (SELECT last, count(*) AS ends FROM $ends GROUP BY last) ON last = w WHERE all_n > coalesce(ends, 0)"""

# Last tokens that begin known words, and how often they're words themselves.
_STUBS = """
SELECT p AS last, sum(n) AS longer
FROM (SELECT n, explode(transform(sequence(1, length(w) - 1), i -> left(w, i))) AS p FROM $words WHERE length(w) > 1)
LEFT SEMI JOIN (SELECT DISTINCT last FROM $ends) ON p = last GROUP BY p"""
_KNOWN = "SELECT w AS last, n AS as_word FROM $words LEFT SEMI JOIN (SELECT DISTINCT last FROM $ends) ON w = last"

# Final trigrams whose last token is the beginning of a longer one elsewhere, and how often.
_GOES_ON = """
SELECT pair, last, sum(n) AS longer3
FROM (SELECT DISTINCT pair, last FROM $ends WHERE pair IS NOT NULL) e
JOIN (SELECT g, s, sum(n) AS n FROM $hits WHERE k = 2 AND s IS NOT NULL GROUP BY g, s) ON g = pair
WHERE startswith(s, last) AND s <> last GROUP BY pair, last"""

# Lengths at which the texts of a source pile up: far more than at lengths a little shorter, and hardly any longer. A limit in
# bytes may leave up to three of them empty, where the next character didn't fit.
_LIMITS = """
SELECT source, kind, size FROM (
  SELECT source, kind, size, n, sum(n) OVER (PARTITION BY source, kind ORDER BY size RANGE BETWEEN $near PRECEDING AND 1 PRECEDING) / $near AS level,
         1 - sum(n) OVER (PARTITION BY source, kind ORDER BY size) / sum(n) OVER (PARTITION BY source, kind) AS longer
  FROM (SELECT source, kind, size, count(*) AS n FROM $texts LATERAL VIEW stack(2, 'chars', n_len, 'bytes', n_bytes) s AS kind, size GROUP BY source, kind, size))
WHERE n >= $min_pile AND n >= $pile_ratio * coalesce(level, 0) AND longer <= $max_longer"""

_JUDGED = """
SELECT doc_id, source, CASE
    WHEN broken THEN 'escape'
    WHEN inside3 >= $min_inside AND terminal3 <= $max_share * seen3 AND (NOT line_start OR terminal1 <= $max_line_share * seen1) THEN 'trigram'
    WHEN longer3 >= $min_inside AND seen3 <= $max_share * longer3 THEN 'trigram'
    WHEN inside5 >= $min_inside AND terminal5 <= $max_share * inside5 THEN 'number'
    WHEN as_word IS NULL AND inside3_0 = 0 AND terminal3_0 <= $max_share * longer THEN 'word'
    WHEN seen3 = 0 AND 1000 * as_word < longer THEN 'word'
    WHEN terminal3_0 = 0 AND seen3 < $min_inside AND inside2 >= $min_inside AND terminal2 <= $max_share * seen2 THEN 'bigram'
    WHEN bi IS NOT NULL AND terminal3_0 = 0 AND seen3 < $min_inside AND seen2 < $min_inside AND inside1 >= $min_inside AND terminal1 <= $max_share * seen1 THEN 'last word'
    WHEN at_limit AND terminal3_0 = 0 AND (bi IS NOT NULL OR seen3 < $min_inside AND seen2 < $min_inside) THEN 'limit'
    WHEN marked THEN 'mark' END AS evidence,
    last, as_word, longer, longer3, inside5, terminal5, inside3, terminal3, inside2, terminal2, inside1, terminal1
FROM (
  SELECT e.doc_id, e.source, e.last, e.bi, e.broken, e.marked, e.line_start, v.as_word, s.longer, o.longer3, f.inside AS inside5, f.terminal AS terminal5, a.inside AS inside3, a.terminal AS terminal3,
         b.inside AS inside2, b.terminal AS terminal2, d.inside AS inside1, d.terminal AS terminal1, coalesce(a.inside, 0) AS inside3_0, coalesce(a.terminal, 0) AS terminal3_0,
         coalesce(a.inside + a.terminal, 0) AS seen3, coalesce(b.inside + b.terminal, 0) AS seen2, coalesce(d.inside + d.terminal, 0) AS seen1,
         c.size IS NOT NULL OR y.size IS NOT NULL AS at_limit
  FROM $ends e
  LEFT JOIN $five f ON f.g = e.five
  LEFT JOIN $tri a ON a.g = e.tri
  LEFT JOIN $bi b ON b.g = e.bi
  LEFT JOIN $uni d ON d.g = e.uni
  LEFT JOIN $stubs s ON s.last = e.last
  LEFT JOIN $known v ON v.last = e.last
  LEFT JOIN $goes_on o ON o.pair = e.pair AND o.last = e.last
  LEFT JOIN (SELECT * FROM $limits WHERE kind = 'chars') c ON c.source <=> e.source AND c.size = e.n_len
  LEFT JOIN (SELECT DISTINCT source, explode(sequence(size - 3, size)) AS size FROM $limits WHERE kind = 'bytes') y ON y.source <=> e.source AND y.size = e.n_bytes)"""


def judged_ends(
    documents: DataFrame,
    min_inside: int = 5,
    max_share: float = 0.02,
    max_line_share: float = 0.05,
    long_line: int = 8,
    near: int = 50,
    min_pile: int = 8,
    pile_ratio: float = 20.0,
    max_longer: float = 0.05,
    most_asked: int = 1_000_000,
) -> DataFrame:
    """Every text that doesn't end a sentence, with the counts and the ``evidence`` of a cut, null if there is none.

    Up to ``most_asked`` grams of ends are broadcast to the pass over all texts; of more, all grams are counted and then joined, with the same result.
    Three small tables are written to the checkpoint folder: the ends, the counts of words and of grams that are asked about, and the limits."""
    spark = documents.sparkSession
    names: dict[str, object] = {
        "token": TOKEN, "whole_end": WHOLE_END, "broken_end": BROKEN_END, "broken_signs": BROKEN_SIGNS, "cut_mark": CUT_MARK, "white": WHITE,
        "stops": STOPS, "closers": CLOSERS.replace("'", "\\'"),
        "max_line_share": max_line_share, "max_longer": max_longer, "min_inside": min_inside, "max_share": max_share, "long_line": long_line, "near": near, "min_pile": min_pile, "pile_ratio": pile_ratio,
    }
    made: list[str] = []

    def step(name: str, query: str | None = None, df: DataFrame | None = None, **more) -> DataFrame:
        out = df if df is not None else spark.sql(Template(query).substitute(names | more))
        names[name] = f"cut_{name}_{uuid.uuid4().hex}"
        out.createOrReplaceTempView(names[name])
        made.append(names[name])
        return out

    names["tokens"] = Template(_TOKENS).substitute(names)
    step("docs", df=documents.select("doc_id", "source", "text"))
    step("texts", _TEXTS)
    step("ends", df=cut_lineage(spark.sql(Template(_ENDS).substitute(names))))
    asked = spark.sql(Template(_ASKED).substitute(names))
    few = asked.count() <= most_asked
    step("asked", df=F.broadcast(asked) if few else asked)
    step("places", _PLACES)
    step("hits", df=cut_lineage(spark.sql(Template(_FEW if few else _MANY).substitute(names))))
    for name, column, k in (("five", "five", 5), ("tri", "tri", 3), ("bi", "bi", 2), ("uni", "uni", 1)):
        step(name, _COUNTS, column=column, k=k)
    step("words", _WORDS)
    step("stubs", _STUBS)
    step("known", _KNOWN)
    step("goes_on", _GOES_ON)
    step("limits", df=cut_lineage(spark.sql(Template(_LIMITS).substitute(names))))  # asked for characters and for bytes
    out = step("judged", _JUDGED)
    for name in made:  # the plans stay
        spark.catalog.dropTempView(name)
    return out


def truncated(documents: DataFrame, **options) -> DataFrame:
    """One row per document that was cut, with the evidence: ``doc_id, source, evidence``.

    ``evidence`` is ``escape`` (an escape, character name or tag is begun and not ended), ``trigram`` or ``number`` (the last three tokens, of which the
    last may be the beginning of a longer one, or five, the last being a number, stand at least ``min_inside`` times inside lines and at most ``max_share`` of the
    time at an end without a stop), ``word`` (the last token is the beginning of known words and none itself), ``bigram`` or ``last word`` (as trigram, of fewer
    tokens where the longer run is hardly known), ``limit`` (where the
    last three tokens end no other line: the text has a length, in characters or bytes, at which at least ``min_pile`` texts of its source pile up) or ``mark``
    (an ellipsis stands for the rest of the sentence; it is left out for the other tests). Null and empty texts aren't cut;
    repeated rows each come out; a null source is a source of its own. Line ends count as ends, so lists,
    captions, names and signatures, which end lines elsewhere too, aren't taken for cut texts.
    """
    return judged_ends(documents, **options).filter("evidence IS NOT NULL").select("doc_id", "source", "evidence")


def truncation_by_source(documents: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """Documents, cut documents and their share per source; a null source has its own row."""
    cut = truncated(documents) if cut is None else cut
    return documents.sparkSession.sql(
        """SELECT d.source, d.n AS documents, coalesce(c.n, 0) AS cut_documents, round(coalesce(c.n, 0) / d.n, 4) AS cut_share
           FROM (SELECT source, count(*) AS n FROM {docs} GROUP BY source) d
           LEFT JOIN (SELECT source, count(*) AS n FROM {cut} GROUP BY source) c ON c.source <=> d.source""",
        docs=documents.select("source"),
        cut=cut.select("source"),
    )
