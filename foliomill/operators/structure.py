"""Chapters, sections and articles from the lines of documents.

One pass of windows over each document's lines: a line's class depends on
itself, but whether （一） opens a section depends on the kind of its chapter,
which chapter lines alone decide.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T
from .lines import with_pages
from .scan import running

#: First characters of 一、, （一）, 附： and tail lines.
OPENERS = [*P.CN_NUM_LONG, "（", "(", "附", "本", "引", "条", "修"]


def classify(lines: DataFrame, key: str = "doc_id", name: Column | None = None) -> DataFrame:
    """Add level (null for plain lines), title, and the marks is_part, is_tail, is_section_line, is_item."""
    heading = F.col("line").rlike("(?U)" + P.HEADING)
    level = F.when(heading, F.length(F.regexp_extract("line", "(?U)" + P.HEADING, 1)))
    d = lines.withColumn("level", level)
    # a plain line is of interest by its first character alone; for all others its text isn't needed
    body = T.strip(F.replace(T.body_after_marker(F.col("line")), F.lit("*"), F.lit("")))
    d = d.withColumn("_body", F.when(F.substring(body, 1, 1).isin(*OPENERS), body).otherwise(F.lit("")))
    d = d.withColumn("_plain", F.when(F.col("_body") != "", T.normalize_title(F.col("_body"))).otherwise(F.lit("")))
    d = d.withColumn("title", T.normalize_title(T.group(F.col("line"), "(?U)" + P.HEADING, 2)))
    d = d.withColumn("_part_title", T.cn_part_title(F.col("_plain")))
    part = F.when(heading, Q.is_document_part(F.col("title"), F.col("level")) & ~Q.is_article(F.col("title"))).otherwise(
        F.col("_part_title").isNotNull() | (F.col("_plain").rlike(P.APPENDED) & (F.length("_plain") <= 48))
    )
    if name is not None:
        part = part & ~F.coalesce(Q.is_document_title(F.col("title"), F.col("level"), name), F.lit(False))
    section = heading & ~Q.is_article(F.col("title")) & ~part & (F.col("level") == 2) & Q.is_section(F.col("title"))
    item = F.coalesce(F.col("title"), F.col("_plain")).rlike(P.CN_ITEM) & ~part
    d = d.withColumn("is_part", F.coalesce(part, F.lit(False))).withColumn("is_section_line", F.coalesce(section, F.lit(False))).withColumn("is_item", item)
    d = d.withColumn("is_tail", Q.is_tail(F.coalesce("title", "_plain")))
    shown = F.when(F.col("is_part") & ~heading, F.coalesce("_part_title", "_plain")).when(item & ~heading, T.cn_item_title(F.col("_plain"))).otherwise(F.col("title"))
    return d.withColumn("title", shown).drop("_body", "_plain", "_part_title")


def structure_lines(lines: DataFrame, origin: str = "document", key: str = "doc_id", block: int | None = None, name: Column | None = None) -> DataFrame:
    """Content lines with page, chapter_id, section_id (0: before the first section) and the marks of classify.

    Content begins at the first part and ends before a tail heading.  Documents
    without a part keep all their lines in chapter 0.  A heading that is the
    document's own title (``name``) is no part.  Long documents are taken in
    blocks (``scan.running``).
    """
    d = with_pages(classify(lines, key, name), origin=origin, key=key, first=F.col("is_part"), block=block)
    d = running(d, [key], block, _chapter=("sum", F.col("is_part").cast("int")))
    d = d.withColumn("chapter_id", F.col("_chapter").cast("int"))
    if block:
        parts = d.groupBy(F.col(key).alias("_key")).agg(F.max("chapter_id").alias("_parts"))
        d = d.join(parts, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    else:
        d = d.withColumn("_parts", F.max("chapter_id").over(Window.partitionBy(key)))
    ended = F.when(F.col("is_tail") & (F.col("chapter_id") > 0), 1).otherwise(0)
    d = running(d, [key], block, _ended=("max", ended))
    d = d.where("(_parts = 0) or (chapter_id > 0 and _ended = 0)").drop("_ended", "_chapter")
    d = running(d, [key], block, _kind=("last", F.when(F.col("is_part"), Q.is_chapter(F.col("title")))))
    d = d.withColumn("starts_section", F.col("is_section_line") | (F.col("is_item") & ~F.coalesce("_kind", F.lit(True))))
    d = running(d, [key, "chapter_id"], block, _section=("sum", F.col("starts_section").cast("int")))
    return d.withColumn("section_id", F.col("_section").cast("int")).drop("_parts", "is_section_line", "is_item", "is_tail", "_kind", "_section")


def chapters(structured: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, chapter_id, title, start_pos, end_pos (inclusive), start_page, n_sections."""
    first = lambda c: F.min_by(c, "pos")
    return structured.groupBy(key, "chapter_id").agg(
        first("title").alias("title"), F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), first("page").alias("start_page"), F.max("section_id").alias("n_sections")
    )


def sections(structured: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sections with the figures that decide whether they are small: lines and characters without marker-only lines."""
    body = T.body_after_marker(F.col("line"))
    counted = F.when(T.page_of_marker(F.col("line")).isNotNull(), body).otherwise(T.strip(F.col("line")))
    first = lambda c: F.min_by(c, "pos")
    return (
        structured.withColumn("_body", counted)
        .groupBy(key, "chapter_id", "section_id")
        .agg(
            first("title").alias("title"), F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), F.min("page").alias("start_page"), F.max("page").alias("end_page"),
            F.count_if(F.col("_body") != "").cast("int").alias("n_lines"), F.sum(F.length("_body")).cast("int").alias("n_chars"),
        )
    )


@F.pandas_udf(ArrayType(IntegerType()))
def _greedy_groups(small: pd.Series, n_lines: pd.Series, n_chars: pd.Series, lines: pd.Series, chars: pd.Series, most: pd.Series) -> pd.Series:
    """Group numbers: a big section stands alone; a full group is closed before the next section."""

    def groups(of: list, lined: list, lettered: list, enough_lines: int, enough_chars: int, limit: int) -> list[int]:
        out, g, n, line, char = [], 0, 0, 0, 0
        for is_small, x, y in zip(of, lined, lettered, strict=True):
            fresh = not is_small or n == 0 or n >= limit or (line >= enough_lines and char >= enough_chars)
            g += fresh
            out.append(g)
            if not is_small:
                n = line = char = 0
            elif fresh:
                n, line, char = 1, x, y
            else:
                n, line, char = n + 1, line + x, char + y
        return out

    return pd.Series([groups(*row) for row in zip(small, n_lines, n_chars, lines, chars, most, strict=True)])


def group_sections(found: DataFrame, key: str = "doc_id", lines: int = P.SMALL_LINES, chars: int = P.SMALL_CHARS, most: int = P.MERGED_MOST) -> DataFrame:
    """Small sections in a row merged until they have enough lines and characters, or ``most`` of them.

    Where a group ends depends on where it began: one walk over the figures of
    each chapter's sections.  Adds group_no, merged and stem.
    """
    small = (F.col("n_lines") < lines) | (F.col("n_chars") < chars)
    cols = ["section_id", "title", "start_pos", "end_pos", "start_page", "end_page", "n_lines", "n_chars"]
    packed = found.withColumn("small", small).groupBy(key, "chapter_id").agg(F.array_sort(F.collect_list(F.struct(*cols, "small"))).alias("s"))
    figures = [F.col(f"s.{c}") for c in ("small", "n_lines", "n_chars")]
    placed = packed.withColumn("ids", _greedy_groups(*figures, F.lit(lines), F.lit(chars), F.lit(most)))
    rows = placed.select(key, "chapter_id", F.explode(F.arrays_zip("s", "ids")).alias("z")).select(key, "chapter_id", *[F.col(f"z.s.{c}").alias(c) for c in cols], F.col("z.ids").alias("group_no"))
    size = F.count("*").over(Window.partitionBy(key, "chapter_id", "group_no"))
    d = rows.withColumn("merged", size > 1)
    number = F.dense_rank().over(Window.partitionBy(key, "chapter_id", "merged").orderBy("group_no"))
    return d.withColumn("stem", F.when(F.col("merged"), F.concat(F.lit(P.MERGED_NAME + "-"), number.cast("string"))).otherwise(T.short_slug(F.coalesce("title", F.lit("")))))
