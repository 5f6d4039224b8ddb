"""Source-exact chunks of texts: windows of token units that overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx

_UNIT = re.compile(r"\w+|[^\w\s]")
CHUNK_SCHEMA = "doc_id string, window_index int, unit_start int, unit_end int, char_start int, char_end int, chunk_text string"


def window_count(n: Column, target: int, overlap: int) -> Column:
    """Number of windows over ``n`` units, in closed form."""
    return F.when(n <= 0, F.lit(0)).when(n <= target, F.lit(1)).otherwise(1 + F.ceil((n - target) / F.lit(target - overlap))).cast("int")


def windows(df: DataFrame, key: str, text: str, target: int = 512, overlap: int = 100) -> DataFrame:
    """Unit ranges of every window: counted and exploded by Catalyst, no text moves on."""
    if not target > overlap >= 0:
        raise ValueError("target must exceed overlap, which must not be negative")
    n = df.select(F.col(key), tx.unit_count(F.coalesce(F.col(text), F.lit(""))).cast("int").alias("units"))
    step = target - overlap
    i = F.explode(F.sequence(F.lit(0), window_count(F.col("units"), target, overlap) - 1)).alias("window_index")
    n = n.filter("units > 0").select(key, "units", i)
    return n.withColumn("unit_start", F.col("window_index") * step).withColumn("unit_end", F.least(F.col("unit_start") + target, F.col("units")))


def _heading(line: str) -> bool:
    s = line.strip()
    return bool(s) and len(s) <= 60 and s[-1] not in ".,;:!?" and (s.isupper() or bool(re.match(r"[IVXLC\d]+[.)] \S|[A-Z][a-zäöüß]+(?: [a-zA-Zäöüß]+){0,4}$", s)))


def chunks(df: DataFrame, key: str, text: str, target: int = 512, overlap: int = 100, heading_aware: bool = False) -> DataFrame:
    """Chunks with unit and character ranges; the text of each is an exact slice of its source.

    ``heading_aware`` ends a window at the last heading line in its second half where there is one. One Arrow
    pass: the next window of a heading-aware text depends on where the last one ended."""
    if not target > overlap >= 0:
        raise ValueError("target must exceed overlap, which must not be negative")

    def cut(t: str) -> list[tuple[int, int, int, int]]:
        spans = [m.span() for m in _UNIT.finditer(t)]
        n, out, start = len(spans), [], 0
        marks: list[int] = []
        if heading_aware:
            offset = unit = 0
            for line in t.split("\n"):
                while unit < n and spans[unit][0] < offset:
                    unit += 1
                if unit and unit < n and _heading(line):
                    marks.append(unit)
                offset += len(line) + 1
        while start < n:
            end = min(start + target, n)
            if end < n:
                inside = [m for m in marks if start + max(64, target // 2) <= m <= end]
                end = inside[-1] if inside else end
            out.append((start, end, spans[start][0], spans[end - 1][1]))
            if end == n:
                break
            start = max(start + 1, end - overlap)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, (us, ue, cs, ce) in enumerate(cut(t)):
                    for c, v in zip(cols, (k, i, us, ue, cs, ce, t[cs:ce])):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int32()) for c in cols[1:6]], pa.array(cols[6], pa.string())],
                names=["doc_id", "window_index", "unit_start", "unit_end", "char_start", "char_end", "chunk_text"],
            )

    return df.select(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit(""))).mapInArrow(run, CHUNK_SCHEMA)


def chunk_id(source: Column, page: Column, span: Column, window: Column) -> Column:
    return F.format_string("%s:p%04d:x%06d:c%02d", source, page, span, window)


def embedding_input(name: Column, display: Column, source: Column, page: Column, text: Column) -> Column:
    """The text that is embedded: names and source before the passage."""
    return F.concat_ws("\n", F.concat(F.lit("title: "), F.concat_ws(" / ", name, display)), F.concat(F.lit("source: "), source, F.lit(", p. "), page.cast("string")), F.concat(F.lit("text: "), text))


def child_in_parent(chunks_: DataFrame, parents: DataFrame, key: str, text: str) -> DataFrame:
    """Chunks with ``contained`` (the chunk's text stands in its parent's) and ``at_place`` (it stands where the chunk says)."""
    j = chunks_.join(parents, key)
    there = F.substring(F.col(text), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")) == F.col("chunk_text")
    return j.withColumn("contained", F.expr(f"instr({text}, chunk_text) > 0")).withColumn("at_place", there)


def full_embedding_input(name: Column, book: Column, display: Column, scope: Column, section: Column, source: Column, page: Column, text: Column) -> Column:
    """The text that is embedded with all that is known of it, one field a line; the passage after a blank line."""
    none = F.lit("unresolved")
    fields = [("Scientific name", name), ("Book taxon", book), ("Display name", F.coalesce(display, none)), ("Display name source scope", F.coalesce(scope, none)), ("Section", section), ("Book source", F.concat(source, F.lit(", PDF page "), page.cast("string")))]
    return F.concat(*[F.concat(F.lit(f"{n}: "), c, F.lit("\n")) for n, c in fields], F.lit("\n"), text)


def overlap_check(df: DataFrame, key: str, index: str, start: str, end: str, overlap: int) -> DataFrame:
    """Windows that don't start ``overlap`` units before the end of the one before."""
    w = Window.partitionBy(key).orderBy(index)
    shared = F.lag(end).over(w) - F.col(start)
    return df.withColumn("shared_units", shared).withColumn("overlap_ok", F.coalesce(shared == overlap, F.col(start) == 0))


def numbered_page(text: Column) -> Column:
    """A page's lines that aren't blank, each after its number."""
    pairs = F.transform(F.split(text, "\n"), lambda x, i: F.when(F.trim(x) != "", F.concat(F.lit("L"), F.lpad((i + 1).cast("string"), 4, "0"), F.lit("\t"), x)))
    return F.array_join(F.array_compact(pairs), "\n")
