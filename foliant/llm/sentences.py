"""Sentence units for texts in many languages and scripts (problem 6).

Abbreviations, collocations and sentence starters are learned without supervision, per language, by
log-likelihood ratios over counts of the whole corpus; each period is then classified by them. Counting
and segmenting are Arrow batches; the counts are summed and tested by Catalyst, after a sum within each
batch, so a shuffle moves distinct words and not occurrences. Only words that pass the tests reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

# Words that tell the languages in Latin letters apart.
MARKERS = {
    "de": "der die das und den dem ist sind mit von aus auf bei wird man nicht ein eine zur im doch auch als sich".split(),
    "en": "the of and to is are with from that this in by it was were an for on which when or".split(),
    "fr": "le la les des du et sont une un dans avec pour contre se on par ont au que ne".split(),
    "la": "in cum sunt nec quod eo ad ex vel non floret cf usus dosis habitat caulis differt".split(),
    "es": "el los las del y es son con por una en para que no".split(),
    "it": "il gli di e sono con per una nel della che non".split(),
}
_MARK = {w: tuple(lang for lang, ws in MARKERS.items() if w in ws) for ws in MARKERS.values() for w in ws}
_SCRIPTS = (("ja", re.compile("[ぁ-ヿ]")), ("zh", re.compile("[㐀-鿿]")), ("ru", re.compile("[Ѐ-ӿ]{2}")), ("ar", re.compile("[\u0600-ۿ]{2}")), ("hi", re.compile("[\u0900-ॿ]")), ("th", re.compile("[\u0e00-\u0e7f]")))
_OTHER_SCRIPT = re.compile("[ぁ-ヿ㐀-鿿Ѐ-ӿ\u0600-ۿ\u0900-ॿ\u0e00-\u0e7f]")
_THAI = re.compile("[\u0e00-\u0e7f]")
_SOLID = re.compile(r"\S")
_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile("[A-Za-zÀ-ɏ]{2}")
#: a full stop before a space, and what stands after it on the line
_DOT = re.compile(r"\.[ \t]+(?=[\"'„“«»‚‘(\[]*([^\W_]+(?:[-'’][^\W_]+)*|\S))")
_SURE = re.compile(r"(?:^|\n|[!?][ \t]+)[ \t]*([^\W\d_]+)")
_OPEN = "\"'„“”«»‚‘’‹›「『（([《〈“"
_CLOSERS = "\"'“”’»«›‹」』）)]》〉"
_END = re.compile(r"[。！？｡]+|[.!?…]+|[؟।॥۔]+")
_SPACE = re.compile(r"\s+")
COUNT_SCHEMA = "lang string, kind string, word string, after string, n long"
SENTENCE_SCHEMA = "key string, sentence_index int, sentence_start int, sentence_end int"


def language_of(line: str) -> str:
    """Language of a line by script and, for Latin letters, by marker words; '' where nothing tells."""
    hits: dict[str, int] = {}
    for langs in [_MARK[w] for w in _WORD.findall(line.lower()) if w in _MARK]:
        for lang in langs:
            hits[lang] = hits.get(lang, 0) + 1
    latin = max(hits.items(), key=lambda x: (x[1], x[0]))[0] if hits else ""
    if line.isascii() or not _OTHER_SCRIPT.search(line):
        return latin
    for lang, pattern in _SCRIPTS:
        m = pattern.search(line)
        if m:
            # a foreign word or title inside a line doesn't change its language
            if latin and len(_LATIN.findall(line)) > 6 * sum(1 for _ in pattern.finditer(line)) + 4:
                continue
            return lang
    return latin


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[tuple[str, str], Counter] = {}  # of each language and kind
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = [(lang, kind, w, None) for (lang, kind), c in words.items() for w in c] + list(total)
        n = [x for c in words.values() for x in c.values()] + list(total.values())
        cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(4)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64())], names=["lang", "kind", "word", "after", "n"])

    for b in batches:
        for t in b.column(0).to_pylist():
            for line in t.split("\n"):
                if not line or line.isspace():
                    continue
                lang = language_of(line)
                if (lang, "start") not in words:
                    words[lang, "start"], words[lang, "capital"] = Counter(), Counter()
                words[lang, "capital"].update([w.lower() for w in _WORD.findall(line) if w[0].isupper()])
                words[lang, "start"].update([w.lower() for w in _SURE.findall(line) if w[0].isupper()])
                for m in _DOT.finditer(line):
                    w, after = _word_before(line, m.start(), len(line)), m[1]
                    if not w:
                        continue
                    w = "#" if w.isdigit() else w.lower()
                    if after[0].isupper() or not after[0].isalnum():
                        total[lang, "dot", w, after.lower() if after[0].isupper() else "%("] += 1
                    else:
                        total[lang, "dot", w, "%0" if after[0].isdigit() else "%a"] += 1
        if len(total) + sum(map(len, words.values())) > 200_000:
            yield out()
            total.clear()
            words.clear()
    if total or words:
        yield out()


def _xlogp(k: Column, p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return k * F.log(p)


def _llr(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's log-likelihood ratio of two binomials, k1 of n1 against k2 of n2."""
    p, p1, p2 = (k1 + k2) / (n1 + n2), k1 / F.greatest(n1, F.lit(1.0)), k2 / F.greatest(n2, F.lit(1.0))
    one = lambda k, n, q: _xlogp(k, q) + _xlogp(n - k, 1 - q)
    return 2 * (one(k1, n1, p1) + one(k2, n2, p2) - one(k1, n1, p) - one(k2, n2, p))


@dataclass
class Model:
    """What was learned: per language the abbreviations, starters and collocations."""

    abbreviations: set = field(default_factory=set)
    starters: set = field(default_factory=set)
    collocations: set = field(default_factory=set)
    anywhere: set = field(default_factory=set)  # abbreviations of any language


def model_rows(texts: DataFrame, text: str, starter_llr: float = 30.0, abbreviation_llr: float = 12.0, collocation_llr: float = 7.88) -> DataFrame:
    """``lang, kind, word, after`` of what the tests accept; ``kind`` is abbreviation, starter or collocation."""
    counts = texts.select(F.col(text)).filter(F.col(text).isNotNull()).mapInArrow(_counts, COUNT_SCHEMA)
    counts = counts.groupBy("lang", "kind", "word", "after").agg(F.sum("n").cast("double").alias("n"))
    counts = cut_lineage(counts)  # distinct words, used several times
    by_word = counts.filter("kind <> 'dot'").groupBy("lang", "word").agg(
        F.sum(F.when(F.col("kind") == "start", F.col("n")).otherwise(0.0)).alias("s"), F.sum(F.when(F.col("kind") == "capital", F.col("n")).otherwise(0.0)).alias("c")
    )
    totals = by_word.groupBy("lang").agg(F.sum("s").alias("all_s"), F.sum("c").alias("all_c"))
    w = by_word.join(totals, "lang")
    # a starter opens lines more often than capitals do in general
    starters = w.filter((F.col("s") >= 3) & (F.col("s") / F.col("c") > F.col("all_s") / F.col("all_c")) & (_llr(F.col("s"), F.col("c"), F.col("all_s") - F.col("s"), F.col("all_c") - F.col("c")) > starter_llr)).select("lang", "word")
    starters = cut_lineage(starters)
    dots = counts.filter("kind = 'dot'").join(starters.select("lang", F.col("word").alias("after"), F.lit(1.0).alias("starts")), ["lang", "after"], "left")
    per_type = dots.groupBy("lang", "word").agg(F.sum("n").alias("d"), F.sum(F.col("n") * F.coalesce("starts", F.lit(0.0))).alias("b"), F.sum(F.when(F.col("after").isin("%a", "%0"), F.col("n")).otherwise(0.0)).alias("g"))
    per_type = cut_lineage(per_type)
    all_dots = per_type.groupBy("lang").agg(F.sum("d").alias("all_d"), F.sum("b").alias("all_b"), F.sum("g").alias("all_g"))
    t = per_type.join(all_dots, "lang")
    # an abbreviation's full stop is followed by a starter less often than full stops are in general, or by a small letter or figure more often
    share = lambda k, n: F.col(k) / F.col(n)
    apart = lambda k, all_k: _llr(F.col(k), F.col("d"), F.col(all_k) - F.col(k), F.col("all_d") - F.col("d")) > abbreviation_llr
    no_start = (share("b", "d") < 0.5 * share("all_b", "all_d")) & apart("b", "all_b")
    goes_on = (share("g", "d") > 0.5) & (share("g", "d") > share("all_g", "all_d")) & apart("g", "all_g")
    abbreviations = t.filter((F.col("word") != "#") & (F.col("d") >= 3) & (no_start | goes_on)).select("lang", "word")
    abbreviations = cut_lineage(abbreviations)
    # figures and abbreviations that a capital word follows far more often than it follows other full stops
    special = abbreviations.unionByName(all_dots.select("lang", F.lit("#").alias("word")))
    capitals = dots.filter(F.col("after").rlike(r"^\p{L}"))
    others = capitals.join(special, ["lang", "word"], "left_anti").groupBy("lang", "after").agg(F.sum("n").alias("o"))
    others_all = per_type.join(special, ["lang", "word"], "left_anti").groupBy("lang").agg(F.sum("d").alias("all_o"))
    pairs = capitals.join(special, ["lang", "word"], "left_semi").filter(F.col("starts").isNull() & (F.col("n") >= 3)).join(per_type.select("lang", "word", "d"), ["lang", "word"])
    pairs = pairs.join(others, ["lang", "after"], "left").join(others_all, "lang", "left").na.fill(0.0, ["o"]).na.fill(1.0, ["all_o"])
    collocations = pairs.filter((F.col("n") / F.col("d") > 5 * F.col("o") / F.col("all_o")) & (_llr(F.col("n"), F.col("d"), F.col("o"), F.col("all_o")) > collocation_llr)).select("lang", "word", "after")
    none = F.lit(None).cast("string").alias("after")
    return (
        starters.select("lang", F.lit("starter").alias("kind"), "word", none)
        .unionByName(abbreviations.select("lang", F.lit("abbreviation").alias("kind"), "word", none))
        .unionByName(collocations.select("lang", F.lit("collocation").alias("kind"), "word", "after"))
    )


def as_model(rows: list) -> Model:
    """A model of rows ``lang, kind, word, after``."""
    m = Model()
    for lang, kind, word, after in rows:
        if kind == "starter":
            m.starters.add((lang, word))
        elif kind == "abbreviation":
            m.abbreviations.add((lang, word))
            m.anywhere.add(word)
        else:
            m.collocations.add((lang, word, after))
    return m


def learn(texts: DataFrame, text: str, **thresholds) -> Model:
    """The model of a corpus, on the driver."""
    return as_model(model_rows(texts, text, **thresholds).collect())


def _word_before(line: str, at: int, reach: int = 60) -> str:
    """The word or figure, full stops inside it, that ends at ``at`` and begins at most ``reach`` characters before; '' if there is none."""
    low, i = max(0, at - reach), at
    while i > low and line[i - 1].isalnum() or i < at and i - 1 > low and line[i - 1] == "." and line[i - 2].isalnum() and line[i].isalnum():
        i -= 1
    return line[i:at]


_AFTER = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")


def _around(line: str, at: int, nxt: int) -> tuple[str, str]:
    """The words before the full stop at ``at`` and from ``nxt`` on, empty where there is none."""
    j = nxt
    while j < len(line) and line[j] in _OPEN:
        j += 1
    after = _AFTER.match(line, j)
    return _word_before(line, at), after[0] if after else ""


def _breaks_after_dot(line: str, at: int, nxt: int, lang: str, model: Model) -> bool:
    """Whether the full stop at ``at`` ends a sentence, the next word starting at ``nxt``."""
    said, after = _around(line, at, nxt)
    w = said.lower()
    number = w.isdigit()
    abbreviation = (lang, w) in model.abbreviations
    if not after:
        return not abbreviation
    if after[0].islower():
        return False
    if after[0].isdigit():  # a line may be too short to tell its language
        return w not in model.anywhere
    a = after.lower()
    if number:
        return (lang, "#", a) not in model.collocations
    initials = bool(said) and all(len(x) == 1 and x.isupper() for x in said.split("."))
    if not abbreviation and not initials:
        return True
    return (lang, a) in model.starters and (lang, w, a) not in model.collocations


def _glued(line: str, at: int, nxt: int, kind: str) -> bool:
    """Whether a new sentence may follow a stop without white space: a capital word, after a full stop only behind a word or figure that
    isn't short."""
    j = nxt
    while j < len(line) and line[j] in _OPEN:
        j += 1
    if not line[j : j + 1].isupper() or not (line[j + 1 : j + 2].islower() or j > nxt):
        return False
    if kind != ".":
        return True
    last = _word_before(line, at).rpartition(".")[2]
    return line[at - 1 : at] in _CLOSERS if not last else len(last) > 1 or last.isdigit()


def _stops(line: str) -> Iterator[tuple[int, int | None]]:
    """(start of the next sentence, full stop that the model is asked about) of each place where a sentence of the line may end; None where it surely ends."""
    n = len(line)
    for m in _END.finditer(line):
        s, e = m.span()
        if e >= n:
            break
        kind = m[0]
        wide = kind[0] in "。！？｡"
        quoted = False
        while e < n:  # closing signs belong to the sentence, « and » after a space too
            if line[e] in _CLOSERS:
                if line[e] in "\"'“«" and e + 1 < n and line[e + 1].isalnum() and (line[e - 1].isspace() or wide or line[e] == '"' and line.count('"', 0, e) % 2 == 0):
                    break  # it opens the next sentence
                quoted = True
                e += 1
            elif line[e].isspace() and e + 1 < n and line[e + 1] in "»›" and "«" in line[:s]:
                e += 1
            else:
                break
        gap = _SPACE.match(line, e)
        nxt = gap.end() if gap else e
        if nxt >= n:
            continue
        c = line[nxt]
        if not gap and not wide and kind[0] not in "؟।॥۔" and not _glued(line, s, nxt, kind):
            continue
        if wide:
            if quoted and line[nxt] in "とってな":  # the sentence goes on after its quotation
                continue
            yield nxt, None
            continue
        if kind[0] in "!?…" or kind[-1] in "!?":
            if c.islower():
                continue
            yield nxt, None
            continue
        if kind[0] != "." or len(kind) > 1 and not c.islower():
            yield nxt, None
            continue
        if c.islower():
            continue
        yield nxt, None if quoted else s


def split_sentences(text: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of each sentence, white space at both ends left out."""
    cuts: list[int] = []
    offset = 0
    for line in text.split("\n"):
        n = len(line)
        if line and not line.isspace():
            cuts.append(offset)
            lang = None
            for nxt, dot in _stops(line):
                if dot is not None and lang is None:
                    lang = language_of(line)
                if dot is None or _breaks_after_dot(line, dot, nxt, lang, model):
                    cuts.append(offset + nxt)
            if not line.isascii() and _THAI.search(line):  # in Thai a space ends a sentence
                cuts.extend(offset + g.end() for g in re.finditer(r"(?<=[\u0e00-\u0e7f])[ \t\u00a0\u3000]+(?=\S)", line))
        offset += n + 1
    starts = []
    for c in sorted(set(cuts)):
        m = _SOLID.search(text, c)
        if m and (not starts or m.start() > starts[-1]):
            starts.append(m.start())
    ends = [*starts[1:], len(text)]
    return [(a, a + len(text[a:b].rstrip())) for a, b in zip(starts, ends)]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each text that its full stops ask the model about: before a stop, with the word after it, and after a stop."""
    for b in batches:
        cols: list[list] = [[], [], []]
        for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            asked = set()
            for line in t.split("\n"):
                for nxt, dot in _stops(line):
                    if dot is not None:
                        w, after = (x.lower() for x in _around(line, dot, nxt))
                        asked |= {("#" if w.isdigit() else w, after), (after, None)}
            cols[0] += [k] * len(asked)
            cols[1] += [w for w, _ in asked]
            cols[2] += [a for _, a in asked]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["key", "word", "after"])


def sentences(texts: DataFrame, key: str, text: str, model: Model | None = None, max_words: int = 500_000, with_text: bool = False) -> DataFrame:
    """One row per sentence: ``key, sentence_index, sentence_start, sentence_end``, offsets in code points; ``with_text``: the ``sentence`` too.

    Of rows with equal keys one is used (the smallest text). Null keys count as one key. Null, empty and blank
    texts give no rows. A line end ends a sentence, so texts are given unwrapped; whole texts are split, of any length.
    ``model`` defaults to one learned from the same texts, repeated rows included. Up to ``max_words`` accepted words are broadcast; a
    larger model is joined to the words that each text asks about, with the same result.
    """
    one = texts.select(F.col(key).cast("string").alias("key"), F.col(text).alias("t")).filter(F.col("t").isNotNull()).groupBy("key").agg(F.min("t").alias("t"))
    shared = None
    if model is None:
        rows = cut_lineage(model_rows(texts, text))
        few = rows.limit(max_words + 1).collect()
        if len(few) <= max_words:
            model = as_model(few)
    if model is not None:
        shared = texts.sparkSession.sparkContext.broadcast(model)
        ready = one.withColumn("own", F.lit(None).cast("array<struct<lang:string,kind:string,word:string,after:string>>"))
    else:
        asked = one.mapInArrow(_asked, "key string, word string, after string").withColumnRenamed("after", "next")
        hit = asked.join(rows, "word").filter((F.col("kind") != "collocation") | F.col("after").eqNullSafe(F.col("next")))
        own = hit.groupBy("key").agg(F.collect_set(F.struct("lang", "kind", "word", "after")).alias("own"))  # bounded by the text
        ready = one.join(own.withColumnRenamed("key", "k"), F.col("key").eqNullSafe(F.col("k")), "left").select("key", "t", F.coalesce("own", F.array().cast("array<struct<lang:string,kind:string,word:string,after:string>>")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks, i_s, ss, es, said = [], [], [], [], []
            for k, t, own in zip(*(c.to_pylist() for c in b.columns)):
                m = shared.value if shared else as_model([(x["lang"], x["kind"], x["word"], x["after"]) for x in own])
                found = split_sentences(t, m)
                ks += [k] * len(found)
                i_s += range(len(found))
                ss += [a for a, _ in found]
                es += [e for _, e in found]
                said += [t[a:e] for a, e in found] if with_text else []
            cols = [pa.array(ks, pa.string()), pa.array(i_s, pa.int32()), pa.array(ss, pa.int32()), pa.array(es, pa.int32()), *([pa.array(said, pa.string())] if with_text else [])]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "sentence_index", "sentence_start", "sentence_end", "sentence"][: len(cols)])

    return ready.select("key", "t", "own").mapInArrow(run, SENTENCE_SCHEMA + (", sentence string" if with_text else ""))
