"""Text in disguise brought to one form, aware of scripts (problem 4).

Catalyst picks the rows that hold any suspicious character; only those reach Python. There widths,
ligatures, accents, spaces and invisible characters are unified. Letters of another script are decided per
token: its dominant script is determined, and the look-alikes of a token of mixed scripts are put back, into that script before others,
where the result is a word of the corpus, counted over all texts; see ``unify`` for tokens the corpus can't tell about.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    **dict(zip("АВЕЅІЈКМНОРСТУХҮҒԌԚԜ", "ABESIJKMHOPCTYXYFGQW")),
    **dict(zip("аеоруѕіјсхһԁԛԝӏкмтвн", "aeopysijcxhdqwlkmtbh")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX")),
    **dict(zip("αεικνορτυχγ", "aeikvoptuxy")),
    **dict(zip("ϲϳѵԍ", "cjvg")),
    **dict(zip("օսհոցյ", "ouhngj")),
}
_RANGES = (("latin", "A-Za-z\u00aa\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff"), ("cyrillic", "\u0400-\u052f"), ("greek", "\u0370-\u03ff\u1f00-\u1fff"), ("armenian", "\u0531-\u058f"))
_SCRIPTS = [(name, re.compile(f"[{chars}]")) for name, chars in _RANGES]
# Small capitals of Cyrillic and Greek that only resemble Latin letters loosely: used where the word is known.
_LOOSE = set("кмтвнαικτυχγ")
_SAME_LOOK = re.compile("[！-～ﬀ-ﬆ\U0001d400-\U0001d7ffⅠ-ⅿǄ-ǌǱ-ǳĲĳ]")
_INVISIBLE = re.compile("[\u00ad\u034f\u061cᅟᅠ\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff\U000e0000-\U000e0fff]")
_SPACES = re.compile("[\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")
_JOINED_SCRIPTS = re.compile("[\u0600-\u07bf\u0900-\u0fffក-\u18af]")
_CJK = re.compile("[\u3040-ヿ㐀-鿿가-\ud7af豈-\ufaff]")
_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile("[A-Za-zÀ-ɏḀ-ỿ]")
_FOREIGN = re.compile("[\u0370-\u052f\u0531-\u058f\u1f00-\u1fff]")
#: per script the letters of other scripts that look like one of its own, Latin ones from the table, the others by its inverse
_TO = {"latin": LOOKALIKES} | {name: {b: a for a, b in reversed(LOOKALIKES.items()) if pattern.match(a)} for name, pattern in _SCRIPTS if name in ("cyrillic", "greek")}
_LOOK = re.compile("[" + "".join(LOOKALIKES) + "]")
_MARKS = re.compile("[\u0300-\u036f]")
#: the same classes for Catalyst, wide enough to let every case through
SUSPECT_SQL = (
    r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{E0000}-\x{E0FFF}"
    r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{300}-\x{36F}"
    r"\x{370}-\x{52F}\x{531}-\x{58F}\x{FF01}-\x{FF5E}\x{FB00}-\x{FB06}\x{1D400}-\x{1D7FF}\x{2160}-\x{217F}\x{1C4}-\x{1CC}\x{1F1}-\x{1F3}\x{132}\x{133}]"
)
WORD_SQL = r"(?<!\p{L})(?:\p{IsLatin}{2,}|\p{IsCyrillic}{2,}|\p{IsGreek}{2,})(?!\p{L})"
TOKEN_TYPE = "array<struct<token:string,mapped:string,script:string,dominant:string,mixed:boolean,close:boolean>>"
FIRST_SCHEMA = f"table_name string, row_key string, field_name string, plain string, kinds array<string>, tokens {TOKEN_TYPE}"
OUT_SCHEMA = "table_name string, row_key string, field_name string, kinds array<string>, unified string, unresolved array<string>"


def plain_form(text: str) -> tuple[str, list[str]]:
    """Text with widths, ligatures, accents, spaces and invisible characters unified, and which there were."""
    kinds = []
    cjk = bool(_CJK.search(text))
    if _INVISIBLE.search(text):
        keep = _JOINED_SCRIPTS.search(text)
        new = _INVISIBLE.sub(lambda m: m[0] if keep and m[0] in "\u200c\u200d" else "", text)
        if new != text:
            kinds.append("invisible")
            text = new
    if _SPACES.search(text):
        new = _SPACES.sub(lambda m: m[0] if cjk and m[0] == "\u3000" else " ", text)
        if new != text:
            kinds.append("space")
            text = new if text == new.strip() else new.strip(" ")
    if _SAME_LOOK.search(text):
        # full-width signs are ordinary beside ideographs, full-width letters and figures never
        new = _SAME_LOOK.sub(lambda m: m[0] if cjk and "！" <= m[0] <= "～" and not m[0].isalnum() else unicodedata.normalize("NFKC", m[0]), text)
        if new != text:
            kinds.append("width or ligature")
            text = new
    if _MARKS.search(text):
        new = unicodedata.normalize("NFC", text)
        if new != text:
            kinds.append("accent")
            text = new
    return text, kinds


def foreign_tokens(text: str) -> list[tuple[str, str, bool]]:
    """Tokens holding look-alikes of another script: (token, in Latin letters, whether it has Latin letters too)."""
    if text.isascii():
        return []
    out = {}
    done = 0
    for m in _LOOK.finditer(text):
        if m.start() < done:
            continue
        a, b = m.span()
        while a > 0 and text[a - 1].isalpha():
            a -= 1
        while b < len(text) and text[b].isalpha():
            b += 1
        done = b
        w = text[a:b]
        if w not in out:
            mapped = "".join(LOOKALIKES.get(c, c) for c in w)
            if all(_LATIN.match(c) for c in mapped):
                out[w] = (w, mapped, bool(_LATIN.search(w)))
    return list(out.values())


def _script(c: str) -> str:
    return next((name for name, pattern in _SCRIPTS if pattern.match(c)), "other")


def token_readings(text: str) -> list[dict]:
    """What tokens with letters of Greek, Cyrillic or Armenian may stand for, one row per token and script it can be written in wholly.

    A token of mixed scripts has a reading in each script into which all its other letters look; if there is none it has one row without ``mapped``.
    A token of one foreign script has its Latin reading only, if all its letters look Latin. ``dominant`` is the script of most of
    its letters, of equally many the one with more letters that look like none of another, then the foreign one; ``close``: its foreign letters are no loose look-alikes."""
    if text.isascii() or not _FOREIGN.search(text):
        return []
    out: dict[str, list[dict]] = {}
    for m in _WORD.finditer(text):
        w = m[0]
        if w in out or w.isascii() or not _FOREIGN.search(w):
            continue
        scripts = [_script(c) for c in w]
        names = sorted(set(scripts))
        mixed = len(names) > 1
        own = {n: sum(1 for c, x in zip(w, scripts) if x == n and not any(c in to for to in _TO.values())) for n in names}
        dominant = max(names, key=lambda n: (scripts.count(n), own[n], n != "latin"))
        close = not any(c in _LOOSE for c in w) and all(x == "latin" or c in LOOKALIKES for c, x in zip(w, scripts))
        rows = []
        for target in _TO if mixed else ("latin",):
            mapped = [c if x == target else _TO[target].get(c) for c, x in zip(w, scripts)]
            if all(mapped) and "".join(mapped) != w:
                rows.append({"token": w, "mapped": "".join(mapped), "script": target, "dominant": dominant, "mixed": mixed, "close": close})
        if mixed and not rows:
            rows.append({"token": w, "mapped": None, "script": None, "dominant": dominant, "mixed": True, "close": close})
        out[w] = rows
    return [r for rows in out.values() for r in rows]


def corpus_words(texts: DataFrame, least: int = 1) -> DataFrame:
    """Lower-cased words of one script (Latin, Cyrillic or Greek) of all texts with the number of texts that hold them."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(WORD_SQL), F.lit(0)))
    return texts.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("texts")).filter(F.col("texts") >= least)


def unify(texts: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """One row per text in disguise: its ``kinds``, the ``unified`` text and the tokens that stay ``unresolved``.

    ``texts`` has ``table_name, row_key, field_name, text``; other columns don't come out. Null and empty
    texts and texts in one form give no row; each key and field gives one row, whichever delivery of it holds the disguise.
    A token of mixed scripts gets its look-alikes replaced where the result, in its dominant script or else in another, is a corpus word;
    where it isn't (a word cut by a line end, a rare name) the token stays as it is and is named in ``unresolved``, with the kind ``mixed script``, if
    only close look-alikes stand in it beside Latin letters, as no script mixes these itself. Words wholly of another script are left alone
    unless their Latin look is a corpus word in more texts than they are.
    ``vocabulary`` (``word, texts``) defaults to the words of the texts themselves.
    """
    vocabulary = corpus_words(texts) if vocabulary is None else vocabulary
    suspects = texts.select("table_name", "row_key", "field_name", "text").filter(F.col("text").rlike(SUSPECT_SQL))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, k, f, texts_ = (c.to_pylist() for c in b.columns)
            plain, kinds, tokens = [], [], []
            for t in texts_:
                p, kind = plain_form(t)
                plain.append(p)
                kinds.append(kind)
                tokens.append(token_readings(p))
            token_type = pa.list_(pa.struct([(n, pa.string()) for n in ("token", "mapped", "script", "dominant")] + [("mixed", pa.bool_()), ("close", pa.bool_())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.string()), pa.array(k, pa.string()), pa.array(f, pa.string()), pa.array(plain, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(tokens, token_type)],
                names=["table_name", "row_key", "field_name", "plain", "kinds", "tokens"],
            )

    found = cut_lineage(suspects.mapInArrow(first, FIRST_SCHEMA).filter((F.size("kinds") > 0) | (F.size("tokens") > 0)))  # used three times
    looks = found.select(F.explode("tokens").alias("t")).select("t.*").distinct()
    of = lambda c, n: vocabulary.select(F.col("word").alias(c), F.col("texts").alias(n))
    known = looks.join(of("w", "n"), F.lower("mapped") == F.col("w"), "left").join(of("v", "own"), ~F.col("mixed") & (F.lower("token") == F.col("v")), "left")
    right = F.col("n").isNotNull() & (F.col("mixed") | (F.col("n") > F.coalesce("own", F.lit(0))))
    best = F.max_by("mapped", F.when(right, F.struct((F.col("script") == F.col("dominant")).alias("a"), F.col("n").alias("b"), F.col("mapped").alias("c"))))
    decided = known.groupBy("token").agg(best.alias("mapped"), F.max("mixed").alias("mixed"), F.max("close").alias("close"))
    accepted = decided.filter("mapped IS NOT NULL OR mixed AND close").select("token", "mapped")
    per_row = (
        found.select("table_name", "row_key", "field_name", F.explode("tokens").alias("t"))
        .select("table_name", "row_key", "field_name", F.col("t.token").alias("token"))
        .join(accepted, "token")
        .groupBy("table_name", "row_key", "field_name")
        .agg(F.collect_set(F.struct("token", "mapped")).alias("swaps"))
    )
    one = found.groupBy("table_name", "row_key", "field_name").agg(F.max_by(F.struct("plain", "kinds"), F.struct(F.size("kinds"), "plain")).alias("r"))
    rows = one.join(per_row, ["table_name", "row_key", "field_name"], "left").select("table_name", "row_key", "field_name", "r.plain", "r.kinds", "swaps")
    rows = rows.filter((F.size("kinds") > 0) | F.col("swaps").isNotNull())

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, k, f, plain, kinds, swaps = (c.to_pylist() for c in b.columns)
            left: list[list[str]] = [[] for _ in swaps]
            for i, s in enumerate(swaps):
                to = {x["token"]: x["mapped"] for x in s or () if x["mapped"]}
                left[i] = sorted(x["token"] for x in s or () if not x["mapped"])
                if to:
                    plain[i] = _WORD.sub(lambda m, to=to: to.get(m[0], m[0]), plain[i])
                kinds[i] = [*kinds[i], *(["script"] if to else []), *(["mixed script"] if left[i] else [])]
            cols = [pa.array(a, pa.string()), pa.array(k, pa.string()), pa.array(f, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(plain, pa.string()), pa.array(left, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=["table_name", "row_key", "field_name", "kinds", "unified", "unresolved"])

    return rows.mapInArrow(second, OUT_SCHEMA)


def fields(table: DataFrame, name: str, key: Column, columns: list[str]) -> DataFrame:
    """Long form of some text columns of a table for ``unify``."""
    parts = [table.select(F.lit(name).alias("table_name"), key.cast("string").alias("row_key"), F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in columns]
    return reduce(DataFrame.unionByName, parts)


def corpus_fields(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """The fields of problem 4: both page texts and the scientific names of the chunks."""
    return fields(pages, "pages", F.col("page_id"), ["embedded_text", "ocr_text"]).unionByName(fields(chunks, "embedding_chunks", F.col("chunk_id"), ["scientific_name"]))
