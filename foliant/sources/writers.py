"""Writers: versioned tables with an atomic pointer, sharded text exports, public projections."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.tables import multiset_digest


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


class VersionedTable:
    """A Parquet table whose versions are folders; readers follow a pointer file that is replaced by a rename.

    A version that fails its checks never becomes current; the one before stays for a roll-back."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def current(self) -> str | None:
        fs, p, _ = _fs(self.spark, f"{self.path}/CURRENT")
        if not fs.exists(p):
            return None
        return self.spark.read.text(f"{self.path}/CURRENT").first()[0]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.current()}")

    def publish(self, df: DataFrame, checks: dict[str, Column] | None = None, partition_by: list[str] | None = None) -> str:
        """Write a new version, check it (conditions on aggregates) and point to it. Raises with the names of failed checks."""
        version = f"v{time.time_ns()}"
        w = df.write.mode("error")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.path}/{version}")
        if checks:
            row = self.spark.read.parquet(f"{self.path}/{version}").agg(*[c.alias(n) for n, c in checks.items()]).first()
            failed = [n for n in checks if not row[n]]
            if failed:
                raise ValueError(f"version {version} isn't published: {', '.join(failed)}")
        self._point(version)
        return version

    def roll_back(self) -> str:
        """Point to the version before the current one."""
        fs, p, _ = _fs(self.spark, self.path)
        names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("v"))
        older = [n for n in names if n < (self.current() or "")]
        if not older:
            raise ValueError("there is no older version")
        self._point(older[-1])
        return older[-1]

    def _point(self, version: str) -> None:
        fs, new, jvm = _fs(self.spark, f"{self.path}/CURRENT.new")
        out = fs.create(new, True)
        out.write(bytearray(version.encode()))
        out.close()
        old = jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT")
        # replaced in one step: readers see the old pointer or the new one, and a crash leaves one of them
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(old), overwrite)


def markdown_record(title: Column, body: list[tuple[str, Column]]) -> Column:
    """One record as Markdown: a heading and a line per field that has a value."""
    parts = [F.when(F.length(c.cast("string")) > 0, F.concat(F.lit(f"- {n}: "), c.cast("string"))) for n, c in body]
    return F.concat_ws("\n", F.concat(F.lit("## "), title), *parts)


def write_sharded_text(df: DataFrame, path: str, shard: str, order: str, text: str) -> DataFrame:
    """Write ``text`` in one folder per shard, rows in order; returns the manifest ``shard, records, characters, sha256``.

    Rows are range-partitioned by shard and order, so a shard larger than a task is written by several, its parts in order."""
    rows = df.select(F.col(shard).alias("shard"), F.col(order).alias("o"), F.col(text).alias("value"))
    rows.repartitionByRange("shard", "o").sortWithinPartitions("shard", "o").select("shard", "value").write.mode("overwrite").partitionBy("shard").text(path)
    # a digest of row hashes needs no order and combines before the shuffle, however large a shard is
    n, digest = multiset_digest(["o", "value"])
    return rows.groupBy("shard").agg(n.alias("records"), F.sum(F.length("value")).alias("characters"), digest.alias("sha256"))


def write_objects(df: DataFrame, path: str, key: str) -> None:
    """Write each row as a JSON object in a file of its own, in a folder named by its key. For tables of objects, such as receipts, not of rows."""
    write_documents(df.select(key, F.to_json(F.struct(*df.columns)).alias("value")), path, key, "value")


def write_documents(df: DataFrame, path: str, key: str, text: str) -> None:
    """Write each text as a file of its own, in a folder named by its key."""
    rows = df.select(F.col(key).alias("object"), F.col(text).alias("value"))
    rows.repartition("object").write.mode("overwrite").partitionBy("object").option("maxRecordsPerFile", 1).text(path)


def write_pack(df: DataFrame, path: str, order: list[str], text: str = "value") -> None:
    """Write ``text`` as one file, its lines in order. Lines are range-partitioned; one task, as one file has one writer, sorts and
    writes the ranges in turn."""
    df.orderBy(*order).select(F.col(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def public_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows as JSON with the given columns only, nulls left out."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def missing_shards(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Shards that still have to be uploaded."""
    return expected.join(present.select(key).distinct(), key, "left_anti")


def describe(table: VersionedTable) -> str:
    """Pointer and schema as JSON."""
    return json.dumps({"path": table.path, "version": table.current(), "schema": json.loads(table.read().schema.json())}, sort_keys=True)
