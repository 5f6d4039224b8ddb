"""Keys, sets, versions and digests of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key, the one with the greatest version. An aggregate, not a window: it combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(df.columns)


def latest_of_few(df: DataFrame, keys: list[str], version: list[str], buckets: int = 1 << 20) -> DataFrame:
    """As ``latest``, for tables where few keys have more than one row: only rows of such keys are shuffled, all others stay where they are read.

    Repeated keys are known by a hash, of which at most ``buckets`` are broadcast. A key that shares its bucket with a repeated one is shuffled too, with the same result."""
    number = F.xxhash64(*keys)
    twice = df.select(number.alias("h")).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select(F.pmod("h", F.lit(buckets)).alias("bucket")).distinct()
    marked = df.withColumn("bucket", F.pmod(number, F.lit(buckets)))
    once, many = (marked.join(F.broadcast(twice), "bucket", how).select(df.columns) for how in ("left_anti", "left_semi"))
    return once.unionByName(latest(many, keys, version))


def maybe_in(df: DataFrame, key: str, wanted: DataFrame, buckets: int = 1 << 20) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the same column of ``wanted``, and few others, before a join that would shuffle them all. Keys are compared by buckets of their hash, of which at most
    ``buckets`` are broadcast."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).alias("bucket")
    return df.withColumn("bucket", bucket(F.col(key))).join(F.broadcast(wanted.select(bucket(F.col(key))).distinct()), "bucket", "left_semi").select(df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; keys of ``new`` are unique."""
    kept = old.join(new.select(*keys), keys, "left_anti")
    return kept.select(new.columns).unionByName(new)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing_and_extra(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``key, side`` with ``missing`` or ``extra``."""
    e, f = expected.select(key).distinct(), found.select(key).distinct()
    return e.join(f, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(f.join(e, key, "left_anti").withColumn("side", F.lit("extra")))


LANES, LANE_BITS = 4, 60


def multiset_digest(columns: list[str]) -> tuple[Column, Column]:
    """Aggregates (number of rows, digest) of a table's content, whatever the order of its rows: the rows' hashes are cut into lanes of 60 bits, which are
    summed. Sums combine before the shuffle and hold a few numbers, however many rows there are; repeated rows count."""
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)
    lane = lambda i: F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
    parts = [(F.coalesce(F.sum(lane(i)), F.lit(0)) % F.lit(1 << LANE_BITS)).cast("long").cast("string") for i in range(LANES)]
    return F.count("*"), F.sha2(F.concat_ws("|", F.count("*").cast("string"), *parts), 256)


def table_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """``n_rows, digest`` of a table by ``multiset_digest``."""
    n, digest = multiset_digest(columns)
    return df.agg(n.alias("n_rows"), digest.alias("digest"))


def checks(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row per key and broken rule: ``key, error``. Rules are conditions that must hold; null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(F.col(key), F.explode(broken).alias("error"))


def all_or_nothing(df: DataFrame, errors: DataFrame) -> DataFrame:
    """``df`` if there are no errors, else no row. The count of errors is one row."""
    n = errors.agg(F.count("*").alias("__n"))
    return df.crossJoin(F.broadcast(n)).filter("__n = 0").drop("__n")


def merge_spans(df: DataFrame, span: list[str], order: str, provenance: str) -> DataFrame:
    """Equal spans become one, the first in order, with the provenance of all."""
    rest = [c for c in df.columns if c not in (*span, provenance)]
    return df.groupBy(*span).agg(F.min_by(F.struct(*rest), order).alias("r"), F.array_sort(F.collect_set(provenance)).alias("provenance")).select(*span, *[f"r.{c}" for c in rest], "provenance")


def fixed_window_counts(events: DataFrame, who: str, at: str, seconds: int, limit: int) -> DataFrame:
    """Requests per client and fixed window, and whether they pass the limit."""
    w = events.groupBy(who, F.window(at, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n"))
    return w.select(who, F.col("w.start").alias("window_start"), "n", (F.col("n") > limit).alias("limited"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
