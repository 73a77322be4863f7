"""Numbers in place of keys that repeat or are null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def numbered(docs: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame | None]:
    """docs with a key of each row's own, and (key, the key it had); docs as it is, and None, where keys are unique and not null."""
    odd = docs.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1))
    if odd.isEmpty():
        return docs, None
    rows = cut(docs.withColumn("_was", F.col(key)).withColumn(key, F.monotonically_increasing_id()), "numbered-docs")
    return rows.drop("_was"), rows.select(key, "_was")


def named(df: DataFrame, names: DataFrame | None, key: str = "doc_id") -> DataFrame:
    """df with the keys that its rows' documents had."""
    if names is None:
        return df
    return df.join(names, key).withColumn(key, F.col("_was")).select(*df.columns)
