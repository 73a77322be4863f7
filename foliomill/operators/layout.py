"""Page geometry on arrays of words, boxes and cells; the parsers that fill them are outside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as Q


def words_outside(words: Column, boxes: Column) -> Column:
    """Words whose centre lies in none of the boxes."""
    centre = lambda w: ((w["x0"] + w["x1"]) / 2, (w["top"] + w["bottom"]) / 2)
    return F.filter(words, lambda w: ~F.exists(boxes, lambda b: Q.point_in_box(*centre(w), b)))


def word_lines(words: Column, tolerance: float = 3.0) -> Column:
    """Lines of text: words by (top, x0); one is new when it lies more than tolerance below its line's first word.

    The anchor is the line's first word, so this is a fold.
    """
    ordered = F.array_sort(F.transform(words, lambda w: F.struct(w["top"].alias("top"), w["x0"].alias("x0"), w["text"].alias("text"))))
    start = F.struct(F.array().cast("array<struct<n:int,x0:double,text:string>>").alias("out"), F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("n"))

    def step(a: Column, w: Column) -> Column:
        fresh = a["anchor"].isNull() | (F.abs(w["top"] - a["anchor"]) > tolerance)
        n = a["n"] + F.when(fresh, 1).otherwise(0)
        return F.struct(F.array_append(a["out"], F.struct(n.alias("n"), w["x0"].alias("x0"), w["text"].alias("text"))).alias("out"), F.when(fresh, w["top"]).otherwise(a["anchor"]).alias("anchor"), n.alias("n"))

    placed = F.array_sort(F.aggregate(ordered, start, step, lambda a: a["out"]))
    nothing = F.struct(F.array().cast("array<string>").alias("done"), F.lit(0).alias("n"), F.lit("").alias("open"))

    def gather(a: Column, x: Column) -> Column:
        same, begun = a["n"] == x["n"], a["n"] > 0
        return F.struct(
            F.when(same | ~begun, a["done"]).otherwise(F.array_append(a["done"], a["open"])).alias("done"),
            x["n"].alias("n"),
            F.when(same, F.concat(a["open"], F.lit(" "), x["text"])).otherwise(x["text"]).alias("open"),
        )

    return F.aggregate(placed, nothing, gather, lambda a: F.when(a["n"] > 0, F.array_append(a["done"], a["open"])).otherwise(a["done"]))


def accept_tables(candidates: DataFrame) -> DataFrame:
    """Candidates (doc_id, page_no, mode, data, bbox, page_area) that pass, strict ones before loose ones on a page."""
    area = F.greatest(F.lit(0.0), (F.col("bbox.x1") - F.col("bbox.x0")) * (F.col("bbox.bottom") - F.col("bbox.top")))
    d = candidates.withColumn("s", Q.score_table(F.col("data"), F.when(F.col("page_area") > 0, area / F.col("page_area")).otherwise(0.0)))
    strict = F.max((F.col("mode") == "strict").cast("int")).over(Window.partitionBy("doc_id", "page_no"))
    return d.withColumn("_strict", strict).where("_strict = 0 or mode = 'strict'").drop("_strict").select("*", F.col("s.reject_reason").isNull().alias("accepted"))


def distinct_boxes(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """One of the boxes that agree to a unit, rounding halves to even."""
    return boxes.withColumn("_b", F.struct(*[F.bround(f"bbox.{c}") for c in ("x0", "top", "x1", "bottom")])).dropDuplicates([*keys, "_b"]).drop("_b")


def cell_spans(cells: DataFrame, table: list[str]) -> DataFrame:
    """Merged cells: (r, c, cell_id) grids to the first place and the row and column span of each cell."""
    return cells.groupBy(*table, "cell_id").agg(F.min("r").alias("r"), F.min("c").alias("c"), F.countDistinct("r").alias("rs"), F.countDistinct("c").alias("cs"), F.first("text").alias("text"))


def assemble_page(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Parts (ord, part) of a page joined by blank lines."""
    rows = parts.where("part <> ''").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ord", "part"))).alias("p"))
    return rows.select(*keys, F.array_join(F.transform("p", lambda x: x["part"]), "\n\n").alias("markdown"))
