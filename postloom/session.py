"""Session helpers shared by every operator.

``cut`` breaks a long lineage with a reliable checkpoint: the files go to the
folder the cluster names in ``spark.checkpoint.dir``, so they outlive a lost
executor.  Only a session without that setting (tests, a laptop) gets a
temporary folder of its own, and only where Spark runs on one machine.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Largest table, in bytes as estimated from a counted number of rows, that an
#: operator hands to ``broadcast``.  Beyond it the same join is shuffled.
BROADCAST_BYTES = 24 * 1024 * 1024


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that ``spark.checkpoint.dir`` names, on one machine a temporary one if it names none.

    On a cluster without it this fails: a folder of the driver's machine would
    be another one on each executor.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="postloom-ckpt-"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def ship(spark: SparkSession) -> None:
    """Give every Python worker this package, once for each Spark application.

    The workers of a cluster need not have the repository on their path; Spark
    serves the zip from the driver and each executor fetches its own copy.  A
    Python function keeps the files that were there when it was made, so every
    operator ships before it makes one.
    """
    sc = spark.sparkContext
    if getattr(sc, "_postloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="postloom-py-")) / "postloom_src.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._postloom_shipped = True


def ship_active() -> None:
    """``ship`` for functions of columns, which see no session but the active one."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by an eager, reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    ship(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_enough(df: DataFrame, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a (checkpointed, hence cheap to count) table may be broadcast."""
    return df.count() * bytes_per_row <= limit


def spread_out(df: DataFrame) -> DataFrame:
    """The same rows over at least as many partitions as there are cores.

    A table in one small file would keep costly Python work on one core; a
    table of the usual size has partitions enough and is not shuffled.
    """
    ship(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
