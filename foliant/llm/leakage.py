"""Evaluation passages inside a corpus, by a generalised suffix automaton (problem 7).

The normalised test items are sent to the executors, where each worker builds the automaton once; its size is
linear in the items' tokens and bounded by ``shard_tokens``: more items make further automata,
each run in its own pass, so no broadcast grows with the data. Corpus rows stream through it
once: every token moves to the state of the longest item substring that ends there. Spans beyond the limits of length and
coverage are removed from the texts.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W_]+")
HAN = re.compile("[㐀-鿿豈-\ufaff\U00020000-\U0003ffff]")
SPAN_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("match_tokens", T.IntegerType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("span_start", T.IntegerType()),
        T.StructField("span_end", T.IntegerType()),
        T.StructField("char_start", T.IntegerType()),
        T.StructField("char_end", T.IntegerType()),
    ]
)


def _fold(text: str) -> str:
    return text.casefold() if text.isascii() else unicodedata.normalize("NFKC", text).casefold()


def word_tokens(text: str) -> list[str]:
    return WORD.findall(_fold(text))


def char_tokens(text: str) -> str:
    return "".join(WORD.findall(_fold(text)))


def token_places(text: str, characters: bool) -> list[tuple[int, int]]:
    """Where each token of ``word_tokens`` or ``char_tokens`` stands in the text as it is: (start, end) in code points.

    A letter that folds into several, or a combining mark, belongs to the place of its base letter."""
    if text.isascii():
        folded, at = text.casefold(), range(len(text) + 1)
    else:
        parts, at = [], []
        i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and unicodedata.combining(text[j]):
                j += 1
            part = _fold(text[i:j])
            parts.append(part)
            at += [i] * len(part)
            i = j
        folded = "".join(parts)
        at.append(len(text))
    spans = [m.span() for m in WORD.finditer(folded)]
    ends = lambda e: max(at[e], at[e - 1] + 1)
    return [(at[k], ends(k + 1)) for s, e in spans for k in range(s, e)] if characters else [(at[s], ends(e)) for s, e in spans]


class SuffixAutomaton:
    """Generalised suffix automaton over token sequences; ``items[v]`` are the sequences that
    contain the substrings of state ``v``."""

    def __init__(self, sequences: list[tuple[int, list]], least: int) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[int]] = [set()]
        for name, tokens in sequences:
            last = 0
            for t in tokens:
                last = self._extend(last, t, own)
                own[last].add(name)
        order = sorted(range(len(self.length)), key=lambda v: -self.length[v])
        for v in order:
            if self.link[v] >= 0:
                own[self.link[v]] |= own[v]
        self.least = least
        # the shortest suffix class of a state that is still long enough lies in the most items
        self.top: list[int] = [-1] * len(self.length)
        for v in reversed(order):
            if self.length[v] >= least:
                up = self.link[v]
                self.top[v] = self.top[up] if up > 0 and self.length[up] >= least else v
        self.items: dict[int, tuple[int, ...]] = {v: tuple(sorted(own[v])) for v in set(self.top) if v >= 0}

    def _extend(self, last: int, t: object, own: list[set[int]]) -> int:
        if t in self.next[last]:
            q = self.next[last][t]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, t, q, own)
        cur = self._state(self.length[last] + 1, {}, 0, own)
        p = last
        while p >= 0 and t not in self.next[p]:
            self.next[p][t] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][t]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, t, q, own)
        return cur

    def _clone(self, p: int, t: object, q: int, own: list[set[int]]) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], own)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(t) == q:
            self.next[p][t] = clone
            p = self.link[p]
        return clone

    def _state(self, length: int, nxt: dict, link: int, own: list[set[int]]) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        own.append(set())
        return len(self.length) - 1

    def matches(self, tokens: list | str) -> dict[int, list[tuple[int, int]]]:
        """Per item the maximal matched token ranges (start, end) of at least ``least`` tokens."""
        nxt, link, length, top, least = self.next, self.link, self.length, self.top, self.least
        v = size = 0
        found: dict[int, list[tuple[int, int]]] = {}
        for i, t in enumerate(tokens):
            while v and t not in nxt[v]:
                v = link[v]
                size = length[v]
            to = nxt[v].get(t)
            if to is None:
                continue
            v = to
            size += 1
            if size < least:
                continue
            u = v
            while u > 0 and length[link[u]] >= size:  # the class that holds a match of this size
                u = link[u]
            for item in self.items[top[u]]:
                spans = found.setdefault(item, [])
                start = i + 1 - size
                if spans and start <= spans[-1][1] and i <= spans[-1][1] + 1:
                    spans[-1] = (min(spans[-1][0], start), i + 1)
                else:
                    spans.append((start, i + 1))
        return found


def _shards(rows: list, tokens, limit: int) -> list[list]:
    out: list[list] = [[]]
    used = 0
    for r in rows:
        seq = tokens(r[1])
        if used and used + len(seq) > limit:
            out.append([])
            used = 0
        used += len(seq)
        out[-1].append((r[0], seq))
    return [x for x in out if x]


_BUILT: dict[str, tuple] = {}


def _automaton(name: str, shard: list[tuple[int, object]], least: int) -> tuple[SuffixAutomaton, dict[int, int]]:
    """The automaton of a shard and the items' sizes, built once in a worker and kept for its next tasks; a worker keeps one."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = SuffixAutomaton([(k, list(x)) for k, x in shard], least), {k: max(1, len(x)) for k, x in shard}
    return _BUILT[name]


def _plans(items: DataFrame, least_words: int, least_chars: int, char_langs: tuple[str, ...], shard_tokens: int) -> list[tuple]:
    """(kind, least, broadcast shard, name, whether texts without ideographs can't match) of each pass."""
    picked = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")))
    rows = sorted(tuple(r) for r in picked.collect())
    by_word = _shards([r for r in rows if r[2] not in char_langs], word_tokens, shard_tokens)
    by_char = _shards([r for r in rows if r[2] in char_langs], char_tokens, shard_tokens)
    out = []
    for kind, shard in [("word", s) for s in by_word] + [("char", s) for s in by_char]:
        least = least_words if kind == "word" else least_chars
        # where each window of an item holds an ideograph, texts without any can't match
        skip = kind == "char" and all(HAN.search("".join(s[i : i + least])) for _, s in shard for i in range(len(s) - least + 1))
        out.append((kind, least, items.sparkSession.sparkContext.broadcast(shard), uuid.uuid4().hex, skip))
    return out


def _matches(text: str, plan: tuple) -> Iterator[tuple[int, int, int, float]]:
    """(item, start, end, coverage) of the spans of a text that stand in an item, in tokens."""
    kind, least, shared, name, skip = plan
    if skip and not HAN.search(text):
        return
    automaton, sizes = _automaton(name, shared.value, least)
    for item, spans in automaton.matches((word_tokens if kind == "word" else char_tokens)(text)).items():
        for s, e in spans:
            yield item, s, e, (e - s) / sizes[item]


def leaked_spans(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_key: str = "doc_id",
    least_words: int = 13,
    least_chars: int = 24,
    char_langs: tuple[str, ...] = ("zh",),
    min_coverage: float = 0.0,
    shard_tokens: int = 200_000,
) -> DataFrame:
    """One row per document, item and matched span: its tokens, share of the item, range in tokens and in code points of the text.

    Items in ``char_langs`` are matched by letters and digits, others by words; case, width,
    punctuation and spacing don't count. Null or empty texts match nothing; repeated documents each
    come out; an empty table of items gives an empty result. ``min_coverage`` drops spans that cover
    less of their item. Items pass the driver once, as they're the model; documents never do.
    """
    docs = documents.select(F.col(doc_key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    out = None
    for plan in _plans(items, least_words, least_chars, char_langs, shard_tokens):

        def run(batches: Iterator[pa.RecordBatch], plan=plan) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cols: list[list] = [[] for _ in SPAN_SCHEMA]
                for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    places = None
                    for item, s, e, covered in _matches(t, plan):
                        if covered >= min_coverage:
                            places = places or token_places(t, plan[0] == "char")
                            for c, x in zip(cols, (key, item, e - s, min(1.0, covered), s, e, places[s][0], places[e - 1][1])):
                                c.append(x)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), *[pa.int32()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=SPAN_SCHEMA.names)

        part = docs.mapInArrow(run, SPAN_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return documents.sparkSession.createDataFrame([], SPAN_SCHEMA) if out is None else out


def cleaned_documents(documents: DataFrame, items: DataFrame, text: str = "text", doc_key: str = "doc_id", max_tokens: int = 12, max_coverage: float = 1.0, least_words: int = 13, least_chars: int = 24, char_langs: tuple[str, ...] = ("zh",), shard_tokens: int = 200_000) -> DataFrame:
    """``doc_id, removed_spans, removed_chars, cleaned_text`` of every document that loses something: spans of an item of more than ``max_tokens`` tokens, or that
    cover more than ``max_coverage`` of their item, are taken out, overlapping ones together, and what they leave is joined by a space.

    Only spans that ``leaked_spans`` finds (``least_words`` or ``least_chars`` tokens) can be taken out. Documents without such spans, null and empty texts don't come out;
    repeated rows each do. The items' shards are run over a text one after another, as each pass takes out what the shard before it left."""
    keep = documents.select(F.col(doc_key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    df = keep.select("doc_id", F.lit(0).alias("removed_spans"), F.lit(0).alias("removed_chars"), F.col("text").alias("cleaned_text"))
    for plan in _plans(items, least_words, least_chars, char_langs, shard_tokens):

        def run(batches: Iterator[pa.RecordBatch], plan=plan) -> Iterator[pa.RecordBatch]:
            for b in batches:
                spans_, chars, texts = (b.column(i).to_pylist() for i in (1, 2, 3))
                for row, t in enumerate(texts):
                    out = sorted((s, e) for _, s, e, covered in _matches(t, plan) if e - s > max_tokens or covered > max_coverage)
                    if not out:
                        continue
                    places = token_places(t, plan[0] == "char")
                    parts, done = [], 0
                    for s, e in _joined(out):
                        a, z = places[s][0], places[e - 1][1]
                        parts.append(t[done:a].rstrip())
                        spans_[row] += 1
                        chars[row] += z - a
                        done = z
                    texts[row] = " ".join(x for x in (*parts, t[done:].lstrip()) if x)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans_, pa.int32()), pa.array(chars, pa.int32()), pa.array(texts, pa.string())], names=["doc_id", "removed_spans", "removed_chars", "cleaned_text"])

        df = df.mapInArrow(run, "doc_id long, removed_spans int, removed_chars int, cleaned_text string")
    return df.filter("removed_spans > 0")


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that overlap or touch put together."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def leaked_pairs(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document and item that leaked into it, with the longest match and its coverage."""
    return (
        leaked_spans(documents, items, **options)
        .groupBy("doc_id", "item_id")
        .agg(F.max("match_tokens").alias("longest_match"), F.max("coverage").alias("coverage"), F.count("*").cast("long").alias("spans"))
    )
