"""Body files: segments cut at tables and by pages, never inside a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T
from .intervals import interval_join
from .scan import looking_back, running

OPEN, CLOSE = r"(?i)<table\b", r"(?i)</table>"


def table_islands(lines: DataFrame, parts: list[str], out: str = "table_no", block: int | None = None) -> DataFrame:
    """Number the tables of each part; lines outside have null.

    An island runs from a line that opens a table to the first line that closes
    one, or to the end.  Being inside is whether the last line with either mark
    opened without closing, so a window finds it without a fold.
    """
    opens, closes = F.col("line").rlike(OPEN), F.col("line").rlike(CLOSE)
    mark = F.when(closes, F.lit("c")).when(opens, F.lit("o"))
    d = running(lines, parts, block, before=True, _mark=("last", mark))
    d = d.withColumn("_in", F.coalesce("_mark", F.lit("c")) == "o")
    d = d.withColumn("_start", opens & ~F.col("_in"))
    d = running(d, parts, block, _count=("sum", F.col("_start").cast("int")))
    return d.withColumn(out, F.when(F.col("_in") | F.col("_start"), F.col("_count").cast("int"))).drop("_in", "_start", "_mark", "_count")


def table_spans(lines: DataFrame, key: str = "doc_id", block: int | None = None) -> DataFrame:
    """key, table_no, start_pos, end_pos, start_page, end_page and label of every table.

    The label comes from the nearest of the seven lines above that names the
    table: a caption with its page, a heading, or a short line with 表; at most
    36 characters of it, else 表n.
    """
    line = F.col("line")
    body = F.when(line.contains("表"), T.body_after_marker(line))
    paged = T.group(body, "(?U)" + P.PAGED_CAPTION)
    title = T.group(line, "(?U)" + P.HEADING, 2)
    named = body.contains("表") & (F.length(body) < P.PREAMBLE_CHARS) & ~Q.is_table_caption(body)
    candidate = (
        F.when(paged.isNotNull(), F.concat(F.lit("表格第"), paged, F.lit("页")))
        .when(line.rlike(OPEN), None)
        .when(title.isNotNull(), F.substring(T.slug_title(title), 1, P.LABEL_CHARS))
        .when(named, F.substring(T.slug_title(body), 1, P.LABEL_CHARS))
    )

    def above(d: DataFrame, keys: list[str]) -> DataFrame:
        return d.withColumn("_above", F.last("_named", True).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(-P.LABEL_LINES, -1)))

    d = looking_back(table_islands(lines.withColumn("_named", candidate), [key], block=block), [key], P.LABEL_LINES, above, block)
    found = d.where("table_no is not null").groupBy(key, "table_no")
    label = F.coalesce(F.nullif(F.min_by("_above", "pos"), F.lit("")), F.concat(F.lit("表"), F.col("table_no").cast("string")))
    return found.agg(
        F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), F.min("page").alias("start_page"), F.max("page").alias("end_page"), label.alias("label")
    )


def with_preambles(lines: DataFrame, segment: list[str]) -> DataFrame:
    """Lines (with table_no) and ``preamble``: on a table's first line, where its file begins.

    That is up to nine lines above, as far as they are blank, captions, page
    markers or short; not beyond the segment, another table or long prose.
    """
    w = Window.partitionBy(*segment).orderBy("pos")
    body = T.body_after_marker(F.col("line"))
    long = (F.length(body) > P.PREAMBLE_CHARS) & ~F.substring(body, 1, 20).contains("表格") & ~T.has_marker(F.col("line"))
    stop = F.coalesce(F.col("table_no").isNotNull() | (long & ~Q.is_table_caption(body)), F.lit(False))
    d = lines.withColumn("_n", F.row_number().over(w)).withColumn("_stop", F.when(stop, F.col("_n")))
    d = d.withColumn("_last", F.coalesce(F.max("_stop").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.withColumn("_above", F.collect_list("pos").over(w.rowsBetween(-P.PREAMBLE_LINES, 0)))
    first = F.col("table_no").isNotNull() & ~F.col("table_no").eqNullSafe(F.lag("table_no").over(w))
    reach = F.least(F.col("_n") - F.col("_last") - 1, F.size("_above") - 1)
    return d.withColumn("preamble", F.when(first, F.element_at("_above", -1 - reach))).drop("_n", "_stop", "_last", "_above")


def segments(structured: DataFrame, groups: DataFrame, key: str = "doc_id") -> DataFrame:
    """Structured lines with the group and stem of their section."""
    return structured.join(groups.select(key, "chapter_id", "section_id", "group_no", "stem", "merged"), [key, "chapter_id", "section_id"])


def split_chunks(lines: DataFrame, segment: list[str], most_pages: int = 2, preambles: bool = False) -> DataFrame:
    """One row for each body file: segment, part_no, parts, start_pos, end_pos, start_page, end_page, is_table, table_no, range_no, suffix.

    A segment alternates between tables and text.  Text over more than
    most_pages pages is cut into ranges of as many, each after the first
    beginning a page earlier; a piece keeps its own pages.  Text pieces of
    captions and scraps alone are dropped.  Parts are numbered over the segment,
    ranges over their piece.  With preambles a table's file begins with the
    short lines above it, and text that is nothing else has no file of its own.
    The suffix is -表n for tables, -n for text, and empty for a segment's only
    file.
    """
    d = table_islands(lines, segment)
    d = with_preambles(d, segment) if preambles else d.withColumn("preamble", F.lit(None).cast("int"))
    w = Window.partitionBy(*segment).orderBy("pos")
    change = ~F.col("table_no").eqNullSafe(F.lag("table_no").over(w)) | (F.row_number().over(w) == 1)
    d = d.withColumn("_new", change.cast("int"))
    d = d.withColumn("piece", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    d = d.withColumn("_body", T.body_after_marker(F.col("line")))
    scrap = Q.is_table_caption(F.col("_body")) | (F.length("_body") < 4)
    pieces = [*segment, "piece"]
    whole = Window.partitionBy(*pieces)
    d = d.withColumn("_real", F.max((~scrap).cast("int")).over(whole))
    if preambles:
        d = d.withColumn("_next", F.first("preamble", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        d = d.withColumn("_real", F.when(F.min("pos").over(whole) >= F.col("_next"), 0).otherwise(F.col("_real")))
    d = d.where("table_no is not null or _real = 1")
    d = d.withColumn("_lo", F.min("page").over(whole)).withColumn("_hi", F.max("page").over(whole))
    # line to page range: a piece has few ranges, and each line knows which it lies in
    ranges = F.when(F.col("table_no").isNotNull() | (F.col("_hi") - F.col("_lo") < most_pages), F.array(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi")))).otherwise(
        F.transform(
            F.sequence("_lo", "_hi", F.lit(most_pages)),
            lambda s: F.struct(F.greatest(F.col("_lo"), F.when(s > F.col("_lo"), s - 1).otherwise(s)).alias("lo"), F.least(F.col("_hi"), s + most_pages - 1).alias("hi")),
        )
    )
    inside = F.filter(ranges, lambda r: F.col("page").between(r["lo"], r["hi"]))
    cut = d.withColumn("_r", F.explode(inside))
    first = F.coalesce(F.min("preamble"), F.min("pos")) if preambles else F.min("pos")
    found = cut.groupBy(*pieces, "table_no", "_r").agg(first.alias("start_pos"), F.max("pos").alias("end_pos"), F.min("page").alias("start_page"), F.max("page").alias("end_page"))
    every, number = Window.partitionBy(*segment), Window.partitionBy(*segment).orderBy("piece", "start_pos", "end_pos")
    table = F.col("table_no").isNotNull()
    parts = F.count("*").over(every).cast("int")
    texts = F.sum((~table).cast("int")).over(number.rowsBetween(Window.unboundedPreceding, 0))
    suffix = F.when(table, F.concat(F.lit("-表"), F.col("table_no").cast("string"))).when(parts == 1, "").otherwise(F.concat(F.lit("-"), texts.cast("string")))
    return found.select(
        *segment, F.row_number().over(number).alias("part_no"), parts.alias("parts"),
        "start_pos", "end_pos", "start_page", "end_page", table.alias("is_table"), "table_no",
        F.row_number().over(Window.partitionBy(*pieces).orderBy("start_pos", "end_pos")).alias("range_no"), suffix.alias("suffix"),
    )


def render_line(line: Column) -> Column:
    """A line as it stands in a body file."""
    heading = F.regexp_extract(line, "(?U)" + P.HEADING, 2)
    level = F.length(F.regexp_extract(line, "(?U)" + P.HEADING, 1))
    return (
        F.when(T.has_marker(line), F.rtrim(line, F.lit(P.BLANKS)))
        .when(line.rlike("(?U)" + P.HEADING), T.clean_heading(level, heading))
        .otherwise(T.normalize_inline_ocr(F.rtrim(line, F.lit(P.BLANKS))))
    )


def render_bodies(lines: DataFrame, chunks: DataFrame, segment: list[str]) -> DataFrame:
    """segment, part_no and the text of each body file; blank runs become one line."""
    inside = interval_join(lines, chunks.select(*segment, "part_no", "start_pos", "end_pos"), segment, "pos", "start_pos", "end_pos")
    rows = inside.select(*segment, "part_no", F.struct("pos", render_line(F.col("line")).alias("l")).alias("x"))
    body = rows.groupBy(*segment, "part_no").agg(F.array_sort(F.collect_list("x")).alias("x"))
    text = F.array_join(F.transform("x", lambda x: x["l"]), "\n")
    return body.select(*segment, "part_no", F.concat(T.strip(T.compress_blank_lines(text)), F.lit("\n")).alias("text"))
