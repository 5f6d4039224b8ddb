"""Structured Streaming: refreshed tables, request windows, watched folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def watch_parquet(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 64) -> DataFrame:
    """New Parquet files of a folder as a stream. File sources remember what they have read in the query's checkpoint.

    A path to one file is watched as that name in its folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return reader.option("pathGlobFilter", p.getName()).parquet(str(p.getParent().toString()))
    return reader.parquet(path)


def request_windows(events: DataFrame, who: str, at: str, window: str = "10 minutes", limit: int = 10, late: str = "10 minutes") -> DataFrame:
    """Requests per client and fixed window with the decision on the limit; a window closes when the watermark passes its end.

    State is one row per client and open window. Rows later than ``late`` are dropped by the watermark."""
    e = events.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    g = e.groupBy(F.window("__at", window).alias("w"), who).agg(F.count("*").alias("n"))
    return g.select(who, F.col("w.start").alias("window_start"), "n", (F.col("n") > limit).alias("limited"))


def refresh(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], once: bool = True, every: str = "30 seconds", output_mode: str = "append") -> StreamingQuery:
    """Run ``step`` on every batch of new rows. ``step`` must be idempotent for a batch number, as a batch is repeated after a failure.

    ``once`` works through what there is and ends; otherwise the query goes on."""
    w = stream.writeStream.outputMode(output_mode).foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


def latest_by_key(path: str, keys: list[str], version: str) -> Callable[[DataFrame, int], None]:
    """A step that keeps the newest row per key: each batch is written to its own folder, named by its number, so a repeated
    batch replaces itself; ``read_latest`` merges."""

    def step(batch: DataFrame, number: int) -> None:
        from foliant.operators.tables import latest

        latest(batch, keys, [version]).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def read_latest(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    from foliant.operators.tables import latest

    return latest(spark.read.parquet(path).drop("batch"), keys, [version])


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A step that writes each batch to a folder of its number, so a repeated batch replaces itself."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def fingerprint_changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, change``: rows added, removed or changed between two states by a hash of ``columns``."""
    h = lambda df, n: df.select(key, F.xxhash64(*columns).alias(n))
    j = h(old, "o").join(h(new, "n"), key, "full_outer")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed")
    return j.select(key, change.alias("change")).filter("change IS NOT NULL")


def bounded_history(path: str, key: str, order: list[str], terminal: str, most: int = 20) -> Callable[[DataFrame, int], None]:
    """A step of a refresh that keeps, of each batch and key, the last ``most`` rows and the first row for which the condition ``terminal`` holds, in a folder of the batch's
    number: a repeated batch replaces itself, and what is kept doesn't grow with the rows of a key. ``read_states`` and ``read_history`` merge the batches."""

    def step(batch: DataFrame, number: int) -> None:
        from foliant.operators.receipts import recent_history

        recent_history(batch, key, order, most).drop("place").write.mode("overwrite").parquet(f"{path}/history/batch={number}")
        rest = [c for c in batch.columns if c != key]
        first = batch.filter(terminal).groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])
        first.select(batch.columns).write.mode("overwrite").parquet(f"{path}/terminal/batch={number}")

    return step


def read_history(spark: SparkSession, path: str, key: str, order: list[str], most: int = 20) -> DataFrame:
    """The last ``most`` rows of each key over all batches, newest first (``place`` from 1)."""
    from foliant.operators.receipts import recent_history

    return recent_history(spark.read.parquet(f"{path}/history").drop("batch"), key, order, most)


def read_states(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """One row per key and whether it is ``terminal``: the first terminal row, which nothing later changes, else the last row."""
    pick = lambda df, f: df.groupBy(key).agg(f(F.struct(*[c for c in df.columns if c != key]), F.struct(*order)).alias("r"))
    ended = pick(spark.read.parquet(f"{path}/terminal").drop("batch"), F.min_by)
    last = pick(spark.read.parquet(f"{path}/history").drop("batch"), F.max_by)
    j = last.join(ended.withColumnRenamed("r", "t"), key, "left")
    return j.select(key, F.coalesce("t", "r").alias("r"), F.col("t").isNotNull().alias("terminal")).select(key, "r.*", "terminal")
