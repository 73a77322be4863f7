"""Running values over the lines of documents of any length, in two levels.

With ``block`` lines are taken in blocks of so many positions.  A running value
inside a block needs the block alone; each block's summary (its maximum, sum or
last value) is scanned over the document, one row a block, and what stood before
is put before the block's own values.  So a document of millions of lines is
many tasks.  Without ``block`` a document is one window, which is one shuffle
less: the right thing for documents of ordinary length.

Null keys are a document too.  Rows of one document and position are unordered
among themselves, as in any window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines in a block, and characters of a text from which its document is taken in blocks.
BLOCK, LONG = 1 << 16, 1 << 22


def block_for(docs: DataFrame, text: str = "text") -> int | None:
    """BLOCK if any text is long, else None."""
    longest = docs.agg(F.max(F.length(text))).first()[0] or 0
    return BLOCK if longest > LONG else None


def _joined(d: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """d with the columns of other (keys, _b, ...), null keys alike."""
    named = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "_b"])], *[c for c in other.columns if c not in (*keys, "_b")])
    same = F.lit(True)
    for i, k in enumerate([*keys, "_b"]):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return d.join(named, same, "left").drop(*[f"_k{i}" for i in range(len(keys) + 1)])


def running(lines: DataFrame, keys: list[str], block: int | None = None, before: bool = False, **values: tuple[str, Column]) -> DataFrame:
    """lines with a column for each of values (kind, column): its "max", "sum" or "last" (non-null) up to the line, or before it."""
    end = -1 if before else 0
    kinds = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, True)}
    d = lines
    for name, (_, c) in values.items():
        d = d.withColumn(f"_v_{name}", c)
    drop = [f"_v_{name}" for name in values]
    if not block:
        w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, end)
        for name, (kind, _) in values.items():
            d = d.withColumn(name, kinds[kind](F.col(f"_v_{name}")).over(w))
        return d.drop(*drop)
    d = d.withColumn("_b", F.floor(F.col("pos") / block))
    whole = {"max": F.max, "sum": F.sum, "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("pos")))}
    summaries = d.groupBy(*keys, "_b").agg(*[whole[kind](F.col(f"_v_{name}")).alias(f"_s_{name}") for name, (kind, _) in values.items()])
    above = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = summaries.select(*keys, "_b", *[kinds[kind](F.col(f"_s_{name}")).over(above).alias(f"_c_{name}") for name, (kind, _) in values.items()])
    d = _joined(d, carried, keys)
    w = Window.partitionBy(*keys, "_b").orderBy("pos").rowsBetween(Window.unboundedPreceding, end)
    for name, (kind, _) in values.items():
        own, carry = kinds[kind](F.col(f"_v_{name}")).over(w), F.col(f"_c_{name}")
        # greatest passes nulls over; a sum of nothing is null on both sides
        d = d.withColumn(name, F.greatest(own, carry) if kind == "max" else F.coalesce(own + carry, own, carry) if kind == "sum" else F.coalesce(own, carry))
    return d.drop(*drop, *[f"_c_{name}" for name in values], "_b")


def looking_back(lines: DataFrame, keys: list[str], reach: int, add: Callable[[DataFrame, list[str]], DataFrame], block: int | None = None) -> DataFrame:
    """lines with what ``add(lines, keys)`` adds by windows that look at most ``reach`` lines back.

    In blocks: each is given the last lines before it, which go again afterwards.
    """
    if not block:
        return add(lines, keys)
    d = lines.withColumn("_b", F.floor(F.col("pos") / block))
    late = Window.partitionBy(*keys, "_b").orderBy(F.desc("pos"))
    ends = d.withColumn("_n", F.row_number().over(late)).where(F.col("_n") <= reach).groupBy(*keys, "_b").agg(F.array_sort(F.collect_list(F.struct("pos", *[c for c in lines.columns if c not in (*keys, "pos")]))).alias("_e"))
    # a block has a line at least, so the last lines are in as many blocks
    above = Window.partitionBy(*keys).orderBy("_b").rowsBetween(-reach, -1)
    held = ends.select(*keys, "_b", F.slice(F.concat(F.array_repeat(F.lit(None).cast(f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in ends.schema['_e'].dataType.elementType.fields)}>"), reach), F.flatten(F.collect_list("_e").over(above))), -reach, reach).alias("_e"))
    halo = held.select(*keys, "_b", F.explode(F.filter("_e", lambda x: x.isNotNull())).alias("_x"))
    halo = halo.select(*[c if c in keys else F.col(f"_x.{c}").alias(c) for c in lines.columns], "_b", F.lit(True).alias("_halo"))
    both = d.withColumn("_halo", F.lit(False)).unionByName(halo)
    return add(both, [*keys, "_b"]).where(~F.col("_halo")).drop("_halo", "_b")
