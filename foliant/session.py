"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, so that they find it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_foliant_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="foliant-")) / "foliant.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(archive))
    sc._foliant_shipped = True


def local_session(cpus: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("foliant")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir. Where it is unset a local session gets a temporary folder;
    a cluster's executors wouldn't share one, so there it is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliant-checkpoint-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, name: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries of a session read, such as an index: built once and kept beside the checkpoints."""
    sc = spark.sparkContext
    if not hasattr(sc, "_foliant_stored"):
        sc._foliant_stored = {}
    if name not in sc._foliant_stored:
        sc._foliant_stored[name] = kept(build())
    return sc._foliant_stored[name]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, but in compressed columns: a few times less disk, and small parts are read together, as fewer tasks."""
    path = shared_folder(df.sparkSession, "kept")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
