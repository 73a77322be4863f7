"""Reading the tables and cutting lineage, alike on a laptop and on a cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables that the open ``scratch`` blocks remove, innermost last.
_OPEN: list[list[str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    A local session without one (a laptop, tests) takes a temporary folder, and
    remembers it.  Any other master without one is an error: its executors
    wouldn't see the driver's disk.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.foliomill.sharedDir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="foliomill-")
        spark.conf.set("spark.foliomill.sharedDir", named)
    return named.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as that knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, if it is there."""
    files, hadoop = hadoop_path(spark, path)
    files.delete(hadoop, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store when the driver ends."""
    files, hadoop = hadoop_path(spark, path)
    files.deleteOnExit(hadoop)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``cut`` inside are removed at its end, but for those that stay.

    What leaves the block must not be read from the removed ones.
    """
    mine: list[str] = []
    _OPEN.append(mine)
    try:
        yield
    finally:
        del _OPEN[next(i for i, x in enumerate(_OPEN) if x is mine)]
        for path in mine:
            remove(spark, path)


def cut(df: DataFrame, name: str, compression: str | None = None, stays: int = 0) -> DataFrame:
    """Write df to the shared folder and read it back.

    It ends the lineage, survives the loss of executors and gives the planner
    the real size of the table.  The files go with the innermost open
    ``scratch`` (the one so many levels around it as the table ``stays``), else with the driver.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    remove_at_end(spark, path)
    if len(_OPEN) > stays:
        _OPEN[-1 - stays].append(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_arrow_batches(spark: SparkSession, size: int = 1 << 19) -> None:
    """Bound the bytes that a Python worker is handed at once: rows of whole texts are large.

    A smaller setting of the user's stays.  Batches of small rows are as before.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= size:
        spark.conf.set(key, str(size))
