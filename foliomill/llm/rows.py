"""Row numbers for operators that compare rows, where keys may repeat."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .vectors import quoted


def under_plain_names(docs: DataFrame, known: list[str], results: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What work makes of docs, whose columns other than the known ones have names that can't clash meanwhile.

    Columns named as one of the results are left out.
    """
    kept = [c for c in docs.columns if c in known or c.lower() not in results]
    names = {c if c in known else f"_x{i}": c for i, c in enumerate(kept)}
    out = work(docs.select(*[quoted(c).alias(n) for n, c in names.items()]))
    return out.toDF(*[names.get(c, c) for c in out.columns])


def number_rows(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """docs with ``_row``: a long that orders rows by key (null first), the same only for rows of equal key and text.

    Where no key has two texts the key itself serves.  Else the distinct pairs
    of key and text hash are sorted, numbered and joined back, so a key of any
    number of rows is spread by the hash; the numbers (key, _row) come too.
    """
    same, hashed = F.col(key).cast("long"), F.xxhash64(text)
    pairs = docs.select(same.alias("_k"), hashed.alias("_t"))
    several = pairs.groupBy("_k").agg(F.min("_t").alias("lo"), F.max("_t").alias("hi")).where("lo <> hi")
    if several.isEmpty():
        return docs.withColumn("_row", F.coalesce(same, F.lit(-(1 << 63)))), None
    # the numbers of a range partition lie above those of the one before
    numbered = cut(pairs.distinct().orderBy("_k", "_t").withColumn("_row", F.monotonically_increasing_id()), "row-numbers", stays=True)
    right = numbered.select(F.col("_k").alias("_k2"), F.col("_t").alias("_t2"), "_row")
    found = docs.withColumn("_k", same).withColumn("_t", hashed).join(right, F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_t") == F.col("_t2")))
    return cut(found.select(*docs.columns, "_row"), "numbered-rows", stays=True), numbered.select(F.col("_k").alias(key), "_row")
