"""Body files of norms, published whole.

A store is a folder with ``data/run=…`` (the rows of one write), ``norms/run=…``
(the norms it holds) and ``runs/…`` (one empty file for each published run, named
by its number and name).  A write stages its rows and norms first; the last step
makes the file in ``runs``, and only then do readers see it, all its norms at
once.  A job that fails or is killed leaves a run that no reader sees.  A norm
is read from the last published run that holds it, so its old files never stay
beside new ones.

Only numbers of runs come to the driver; which norm is read from which run is a
join.  Several jobs may publish at once: each takes a number of its
own by the file of that name in ``numbers``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = hadoop_path(spark, path)
    return [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []


def runs(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and name of the published runs, in order."""
    return sorted((int(n.split("-")[0]), n.split("-")[1]) for n in _names(spark, f"{path}/runs"))


def _create(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already."""
    files, where = hadoop_path(spark, path)
    return files.createNewFile(where)


def stage(bodies: DataFrame, path: str, norm: str = "norm") -> str:
    """Write the rows and norms of a run that isn't published yet; its name."""
    spark, run = bodies.sparkSession, uuid.uuid4().hex
    bodies.write.parquet(f"{path}/data/run={run}")
    spark.read.parquet(f"{path}/data/run={run}").select(norm).distinct().write.parquet(f"{path}/norms/run={run}")
    return run


def publish(spark: SparkSession, path: str, run: str) -> int:
    """Show a staged run to readers; its number."""
    number = max((int(n) for n in _names(spark, f"{path}/numbers")), default=0) + 1
    while not _create(spark, f"{path}/numbers/{number:012d}"):
        number += 1
    _create(spark, f"{path}/runs/{number:012d}-{run}")
    return number


def write(bodies: DataFrame, path: str, norm: str = "norm") -> int:
    """Replace the norms that bodies hold, each whole and all at once; other norms stay.  The run's number.

    Null is a norm like others.  Bodies without rows publish a run that changes nothing.
    """
    return publish(bodies.sparkSession, path, stage(bodies, path, norm))


def _published(spark: SparkSession, path: str, kind: str, found: list[tuple[int, str]]) -> DataFrame:
    """Rows of the published runs with ``_run``, the run's number; runs may differ in their columns."""
    named = None
    for number, run in found:
        one = spark.read.parquet(f"{path}/{kind}/run={run}").withColumn("_run", F.lit(number))
        named = one if named is None else named.unionByName(one, allowMissingColumns=True)
    return named


def read(spark: SparkSession, path: str, norm: str = "norm") -> DataFrame:
    """Rows of each norm from the last published run that holds it.

    Of a run's rows those stay whose norm no later run holds.  An error, if nothing was published.
    """
    found = runs(spark, path)
    if not found:
        raise FileNotFoundError(f"no published run in {path}")
    if len(found) == 1:
        return _published(spark, path, "data", found).drop("_run")
    last = _published(spark, path, "norms", found).groupBy(F.col(norm).alias("_norm")).agg(F.max("_run").alias("_last"))
    rows = _published(spark, path, "data", found)
    return rows.join(last, F.col(norm).eqNullSafe(F.col("_norm")) & (F.col("_run") == F.col("_last")), "left_semi").drop("_run")


def compact(spark: SparkSession, path: str, norm: str = "norm") -> int:
    """Write what readers see as one run and remove the runs before; its number.

    To be run while nobody reads or writes: readers of the runs before lose their files.
    """
    before = runs(spark, path)
    number = write(read(spark, path, norm), path, norm)
    for old, run in before:
        for gone in (f"runs/{old:012d}-{run}", f"data/run={run}", f"norms/run={run}"):
            files, where = hadoop_path(spark, f"{path}/{gone}")
            files.delete(where, True)
    return number


def unpublished(spark: SparkSession, path: str) -> list[str]:
    """Names of staged runs that were never published: what failed jobs left, or jobs that still run."""
    known = {run for _, run in runs(spark, path)}
    return sorted({n.removeprefix("run=") for n in _names(spark, f"{path}/data")} - known)
