"""Rows of vectors that take part in vector operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(vector: Column) -> Column:
    """Neither null nor empty nor with a null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def usual_length(rows: DataFrame, vector: str) -> int:
    """The commonest length (the least of several), 0 without rows."""
    found = rows.groupBy(F.size(vector).alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    return found["dim"] if found else 0
