"""Receipts between stages: chains, repairs by dropping, evidence lists, merged spans, lanes, replays, bounded histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def follow_chain(start: DataFrame, hops: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """``start`` with what each hop (name, table, key, value) leads to, and ``broken_at``: the name of the first hop that finds nothing, null if the chain is whole.

    A hop looks its ``key`` up by the column of that name, found so far, and adds ``value``. Keys of a hop's table are unique."""
    out = start
    for _, table, key, value in hops:
        out = out.join(table.select(key, value), key, "left")
    broken = F.coalesce(*[F.when(F.col(value).isNull(), F.lit(name)) for name, _, _, value in hops])
    return out.withColumn("broken_at", broken)


def drop_only_repair(sections: DataFrame, key: str, index: str, status: str, least: int = 2) -> DataFrame:
    """``key, state, kept, dropped``: what is left of a package when the sections whose ``status`` isn't ok are dropped. Nothing is guessed: a package with fewer than ``least`` good sections
    isn't repairable, one without bad sections passes."""
    ok = F.col(status) == "ok"
    lists = lambda c: F.array_sort(F.collect_list(F.when(c, F.col(index))))
    g = sections.groupBy(key).agg(lists(ok).alias("kept"), lists(~ok).alias("dropped"))  # the sections of one package
    state = F.when(F.size("dropped") == 0, "pass").when(F.size("kept") >= least, "repaired").otherwise("unrepairable")
    return g.select(key, state.alias("state"), "kept", "dropped")


def evidence_index(rows: DataFrame, key: str, order: list[str], evidence: list[str]) -> DataFrame:
    """``key, evidence..., evidence_index``: the different evidence of each key, numbered from 0 in the order of its first row. Rows combine by evidence before they are ordered."""
    first = rows.groupBy(key, *evidence).agg(F.min(F.struct(*order)).alias("__first"))
    w = Window.partitionBy(key).orderBy("__first", *evidence)
    return first.select(key, *evidence, (F.row_number().over(w) - 1).alias("evidence_index"))


def section_windows(texts: DataFrame, key: str, text: str, target: int, overlap: int, units: Column) -> DataFrame:
    """``key, section, span, window_index, unit_start, unit_end``: windows over the lines of the paragraphs of a text; none crosses a line. ``units`` counts the token units of the column ``line``."""
    s = texts.select(key, F.posexplode(F.split(text, "\n\n")).alias("section", "paragraph")).select(key, "section", F.posexplode(F.split("paragraph", "\n")).alias("span", "line"))
    n = s.withColumn("units", units).filter("units > 0")
    step = target - overlap
    count = F.when(F.col("units") <= target, 1).otherwise(1 + F.ceil((F.col("units") - target) / F.lit(step))).cast("int")
    w = n.select(key, "section", "span", "units", F.explode(F.sequence(F.lit(0), count - 1)).alias("window_index"))
    return w.select(key, "section", "span", "window_index", (F.col("window_index") * step).alias("unit_start"), F.least(F.col("window_index") * step + target, F.col("units")).alias("unit_end"))


def merge_by_span(rows: DataFrame, span: list[str], order: list[str], value: str) -> DataFrame:
    """``span..., first, provenance``: rows of an equal span become one, the first in order, and the ``value`` of each is kept in order."""
    return rows.groupBy(*span).agg(F.min_by(value, F.struct(*order)).alias("first"), F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("__v")))), lambda x: x["__v"]).alias("provenance"))


def lane_choice(queue: DataFrame, lanes: list[tuple[str, DataFrame]], key: list[str]) -> DataFrame:
    """``key..., lane, text_sha256, issues``: of each queued row the first lane (name, table with ``text`` and ``sha256``) that has it, one left join a lane. Issues name what is wrong with it."""
    out = queue
    for name, table in lanes:
        out = out.join(table.select(*key, F.col("text").alias(f"__t_{name}"), F.col("sha256").alias(f"__h_{name}")), key, "left")
    pick = lambda f: F.coalesce(*[F.when(F.col(f"__t_{n}").isNotNull(), f(n)) for n, _ in lanes])
    lane, text, given = pick(F.lit), pick(lambda n: F.col(f"__t_{n}")), pick(lambda n: F.col(f"__h_{n}"))
    issues = F.array_compact(F.array(F.when(lane.isNull(), "missing_candidate"), F.when(lane.isNotNull() & ~F.coalesce(given.rlike("^[0-9a-f]{64}$"), F.lit(False)), "invalid_output_sha256"), F.when(given != F.sha2(text, 256), "receipt_hash_mismatch")))
    return out.select(*key, lane.alias("lane"), F.sha2(text, 256).alias("text_sha256"), issues.alias("issues"))


def replay(packages: list[DataFrame], keys: list[str]) -> DataFrame:
    """The table that upserting packages one after another gives: of each key the row of the last package that has it. One aggregate; replaying again changes nothing."""
    rest = [c for c in packages[0].columns if c not in keys]
    every = reduce(DataFrame.unionByName, [p.withColumn("__at", F.lit(i)) for i, p in enumerate(packages)])
    return every.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__at").alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def recent_history(events: DataFrame, key: str, order: list[str], most: int = 20) -> DataFrame:
    """The last ``most`` rows of each key, newest first (``place`` from 1): what a refresh keeps of its errors."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return events.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def both_ways(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of one side only, repeated rows counted: the columns and ``side`` (missing or extra)."""
    return expected.exceptAll(found).withColumn("side", F.lit("missing")).unionByName(found.exceptAll(expected).withColumn("side", F.lit("extra")))


def archive_names(files: DataFrame, content: str, suffix: str = ".json") -> DataFrame:
    """``sha256, archive_name, copies``: where a content-addressed archive keeps files; equal contents share a place."""
    h = F.sha2(F.col(content), 256)
    return files.groupBy(h.alias("sha256")).agg(F.count("*").alias("copies")).select("sha256", F.concat(F.substring("sha256", 1, 2), F.lit("/"), "sha256", F.lit(suffix)).alias("archive_name"), "copies")


def flip_status(rows: DataFrame, chosen: Column, yes: str = "approved", no: str = "candidate") -> DataFrame:
    """``review_status`` of every row set anew: ``yes`` where chosen, else ``no``."""
    return rows.withColumn("review_status", F.when(F.coalesce(chosen, F.lit(False)), yes).otherwise(no))


def first_of_each(rows: DataFrame, key: str, items: str, identity: list[str]) -> DataFrame:
    """``key, place, identity...``: the structs in the array ``items`` without those whose identity came before, in order, places from 1."""
    e = rows.select(key, F.posexplode(items).alias("at", "i")).select(key, "at", *[F.col("i")[c].alias(c) for c in identity])
    first = e.groupBy(key, *identity).agg(F.min("at").alias("at"))
    return first.select(key, F.row_number().over(Window.partitionBy(key).orderBy("at")).alias("place"), *identity)


def migration(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """One row of counts of an upsert of ``new`` into ``old`` (keys unique): rows before, inserted, replaced, unchanged and after, and whether a repeated upsert changes nothing (``repeats``)."""
    both = lambda a, b: a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key, "full_outer")
    after = both(old, new).select(key, F.coalesce("b", "a").alias(value))
    counts = both(old, new).agg(
        F.count("a").alias("before"), F.count_if(F.col("a").isNull()).alias("inserted"), F.count_if(F.col("a") != F.col("b")).alias("replaced"), F.count_if(F.col("a") == F.col("b")).alias("unchanged"), F.count("*").alias("after")
    )
    again = both(after, new).agg((F.count_if(F.col("a").isNull() | (F.col("a") != F.col("b"))) == 0).alias("repeats"))
    return counts.crossJoin(again)  # one row each
