"""Which interval does a point lie in: an equi-join on bins, so a long document is not quadratic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, low: str, high: str, width: int = 64) -> DataFrame:
    """Each pair of a point and an interval (low to high, both included) of equal keys that holds it, once.

    An interval is listed in every bin of ``width`` numbers that it touches, a
    point in its own, and they meet on keys and bin: the rows compared are those
    of one bin.  The columns of both sides come, keys once; other columns of
    equal names are the caller's to rename.  Null keys, points and ends meet
    nothing, nor do intervals that end before they begin.
    """
    binned = points.withColumn("_bin", F.floor(F.col(at) / width))
    listed = intervals.where(F.col(low) <= F.col(high)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return binned.join(listed, [*keys, "_bin"]).where(F.col(at).between(F.col(low), F.col(high))).drop("_bin")
