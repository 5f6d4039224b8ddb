"""Segments, ranges and as-of lookups over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import text as tx


def headings(pages: DataFrame, text: str = "best_text", marker: str = "Familie:", window: int = 1000, excerpt: int = 500) -> DataFrame:
    """Pages whose text has ``marker`` within its first ``window`` characters, with the first six lines that aren't blank as excerpt."""
    t = F.col(text)
    at = F.instr(t, marker)
    six = F.array_join(F.transform(F.slice(tx.lines(t), 1, 6), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), " | ")
    cut = F.substring(six, 1, excerpt)
    return pages.filter((at >= 1) & (at <= window + 1)).withColumn("heading_excerpt", cut).withColumn("taxon", F.regexp_extract(cut, tx.BINOMIAL, 0))


def spans_to_next(rows: DataFrame, key: str, start: str, ends: DataFrame, end: str, width: int = 256) -> DataFrame:
    """From each start to the row before the next one of its key, the last to the key's end. Starts of a key are unique.

    Starts fall into buckets of ``width``: windows run within (key, bucket) and over one row per bucket, so no task holds a whole key."""
    b = rows.withColumn("__b", F.floor(F.col(start) / F.lit(width)))
    inside = b.withColumn("__n", F.lead(start).over(Window.partitionBy(key, "__b").orderBy(start)))
    first = b.groupBy(key, "__b").agg(F.min(start).alias("__f"))
    after = first.withColumn("__a", F.lead("__f").over(Window.partitionBy(key).orderBy("__b"))).drop("__f")
    nxt = inside.join(after, [key, "__b"]).withColumn("next_start", F.coalesce("__n", "__a")).drop("__b", "__n", "__a")
    return nxt.join(ends, key).withColumn("end_page", F.coalesce(F.col("next_start") - 1, F.col(end))).drop(end)


def range_owner(points: DataFrame, ranges: DataFrame, key: str, at: str, start: str, end: str, width: int = 64) -> DataFrame:
    """Points with the range of their key that holds them: an equi-join on buckets of ``width``, never all pairs.

    Ranges of a key mustn't overlap; points outside every range drop out."""
    bucket = lambda c: F.floor(c / F.lit(width))
    cut = ranges.withColumn("__b", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(end)))))
    p = points.withColumn("__b", bucket(F.col(at)))
    return p.join(cut, [key, "__b"]).filter(F.col(at).between(F.col(start), F.col(end))).drop("__b")


def last_before(rows: DataFrame, events: DataFrame, key: str, order: str, value: str, width: int) -> DataFrame:
    """Each row with the last event value of its key strictly before its ``order``, null if there is none.

    Order values fall into buckets of ``width``. Windows run within (key, bucket) and over one row per bucket, so a key
    with a third of all rows is spread over its buckets. Of events at one place the largest value counts."""
    bucket = F.floor(F.col(order) / F.lit(width))
    ev = events.groupBy(key, order).agg(F.max(value).alias("__v")).withColumn("__b", bucket)
    per = ev.groupBy(key, "__b").agg(F.max_by("__v", order).alias("__last"))
    need = rows.select(key, bucket.alias("__b")).distinct()
    both = need.join(per, [key, "__b"], "full_outer")
    carry = both.withColumn("__carry", F.last("__last", ignorenulls=True).over(Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))).select(key, "__b", "__carry")
    marked = rows.withColumn("__b", bucket).withColumn("__is", F.lit(1))
    cols = rows.columns
    events_rows = ev.select(*[F.col(c) if c in (key, order) else F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in cols], "__b", F.lit(0).alias("__is"), "__v")
    every = marked.withColumn("__v", F.lit(None).cast(dict(ev.dtypes)["__v"])).unionByName(events_rows)
    w = Window.partitionBy(key, "__b").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    inside = every.withColumn("__w", F.last("__v", ignorenulls=True).over(w)).filter("__is = 1")
    return inside.join(carry, [key, "__b"], "left").withColumn(value, F.coalesce("__w", "__carry")).select(*cols, value)


def packages(df: DataFrame, pages: str, size: int = 6) -> DataFrame:
    """Arrays of pages cut into packages of at most ``size``, numbered from 1."""
    p = F.col(pages)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / size).cast("int")), lambda i: F.slice(p, i * size + 1, size))
    return df.filter(F.size(p) > 0).select("*", F.posexplode(parts).alias("__i", "package_pages")).withColumn("package", F.col("__i") + 1).drop("__i")


def exact_coverage(df: DataFrame, group: str, page: str) -> DataFrame:
    """Per group whether its pages are one run without gaps or repeats."""
    g = df.groupBy(group).agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count(page).alias("n_rows"), F.countDistinct(page).alias("n_pages"))
    return g.withColumn("exact", (F.col("last_page") - F.col("first_page") + 1 == F.col("n_rows")) & (F.col("n_rows") == F.col("n_pages")))


def marked_range(text: Column, start: str, end: str) -> Column:
    """The part of a text from a start marker up to an end marker after it, or to its end; null without a start."""
    a = F.instr(text, start)
    tail = F.when(a > 0, F.substring(text, a, F.length(text)))
    stop = F.instr(F.substring(tail, F.lit(len(start) + 1), F.length(tail)), end)
    return F.trim(F.when(stop > 0, F.substring(tail, F.lit(1), stop + len(start) - 1)).otherwise(tail))


def line_locator(df: DataFrame, text: str, first: str, last: str, most: int = 60) -> DataFrame:
    """Exact quotation of a line range with its place in the text: valid if the range is in order, at most ``most`` lines, not blank and unique.

    ``char_start`` and ``char_end`` are code points from 0; null where the quotation isn't valid."""
    n = F.col(last) - F.col(first) + 1
    quote = F.when((F.col(first) >= 1) & (n >= 1), F.array_join(F.slice(F.split(F.col(text), "\n"), F.greatest(F.col(first), F.lit(1)), F.greatest(n, F.lit(1))), "\n"))
    df = df.withColumn("quote", quote)
    at = F.instr(F.col(text), F.col("quote"))
    again = F.instr(F.expr(f"substring({text}, greatest(instr({text}, quote), 0) + 1)"), F.col("quote"))
    status = (
        F.when(F.col("quote").isNull(), "bad_range").when(n > most, "too_long").when(F.trim(F.col("quote")) == "", "blank").when(at == 0, "not_found").when(again > 0, "ambiguous").otherwise("ok")
    )
    df = df.withColumn("locator_status", status)
    ok = F.col("locator_status") == "ok"
    return df.withColumn("char_start", F.when(ok, at - 1)).withColumn("char_end", F.when(ok, at - 1 + F.length("quote")))
