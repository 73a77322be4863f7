"""The deterministic cleaning rules: text to text, with a counter for each rule.

A document is one row; its lines are an array, so nothing is shuffled.
Order: page furniture, then (outside protected regions) numbers, emphasis,
headings and furniture inside lines, gaps, rejoining of wrapped lines; then
furniture once more over all, and blank lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T
from . import mask as M

COUNTERS = (
    "page_numbers_removed", "boilerplate_removed", "article_spaces_fixed", "chapter_spaces_fixed", "section_spaces_fixed", "bold_removed",
    "bold_short_removed", "h1_normalized", "h2_normalized", "headings_demoted", "inline_boilerplate_removed", "cjk_gaps_removed", "lines_merged", "blank_lines_removed",
)


def _count(lines: Column, hit) -> Column:
    return F.size(F.filter(lines, hit)).cast("int")


def _sum(lines: Column, of) -> Column:
    return F.aggregate(lines, F.lit(0), lambda a, x: a + of(x))


def reflow(docs: DataFrame, text: str, out: str, merged: str) -> DataFrame:
    """Add out (wrapped lines joined) and merged (how many joins); paragraphs keep or lose blank lines by the rules of boundaries.

    Whether a line continues the one before depends only on the two and on a
    blank between, so each looks back one place.  The steps are columns, so
    each array is made once.
    """
    d = docs.withColumn("_all", F.transform(F.split(text, "\n", -1), T.strip))
    every = F.col("_all")
    marked = F.transform(every, lambda x, i: F.struct(x.alias("t"), ((i > 0) & (F.get(every, i - 1) == "")).alias("gap"), Q.is_boundary(x).alias("edge"), Q.starts_paragraph(x).alias("new")))
    d = d.withColumn("_full", F.filter(marked, lambda x: x["t"] != ""))
    full = F.col("_full")

    def glue(x: Column, i: Column) -> Column:
        before = F.get(full, i - 1)
        goes_on = F.when(x["gap"], ~before["t"].rlike(P.SENTENCE_END_OR_COLON)).otherwise(~before["t"].rlike(P.SENTENCE_END))
        joins = (i > 0) & ~before["edge"] & ~x["edge"] & ~x["new"] & goes_on
        words = before["t"].rlike("[A-Za-z0-9]$") & x["t"].rlike("^[A-Za-z0-9]")
        return F.struct(joins.alias("m"), (before["edge"] | x["edge"] | x["gap"]).alias("wide"), words.alias("words"), (i == 0).alias("first"), x["t"].alias("t"))

    d = d.withColumn("_glued", F.transform(full, glue))
    mark = lambda x: F.when(x["first"], "").when(x["m"] & x["words"], " ").when(x["m"], "").when(x["wide"], "\n\n").otherwise("\n")
    joined = F.array_join(F.transform("_glued", lambda x: F.concat(mark(x), x["t"])), "")
    d = d.withColumn(out, F.concat(joined, F.lit("\n"))).withColumn(merged, F.size(F.filter("_glued", lambda x: x["m"])))
    return d.drop("_all", "_full", "_glued")


def apply_rules(docs: DataFrame, text: str = "text", protect_tables: bool = False) -> DataFrame:
    """docs with text cleaned and the columns of COUNTERS; null texts stay null with null counters.

    Page furniture goes from tables too unless protect_tables is set.
    """
    raw = F.col(text)
    d = docs.withColumn("_first", M.protected(raw)) if protect_tables else docs
    d = d.withColumn("_lines", F.split(M.shield(raw) if protect_tables else raw, "\n", -1))
    d = d.withColumn("page_numbers_removed", _count(F.col("_lines"), Q.is_page_number))
    d = d.withColumn("boilerplate_removed", _count(F.col("_lines"), lambda x: Q.is_boilerplate(x) & ~Q.is_page_number(x)))
    kept = F.array_join(F.filter("_lines", lambda x: ~Q.is_page_number(x) & ~Q.is_boilerplate(x)), "\n")
    d = d.withColumn("_kept", M.unshield(kept, F.col("_first")) if protect_tables else kept)
    d = d.withColumn("_regions", M.protected(F.col("_kept"))).withColumn("_lines", F.split(M.shield(F.col("_kept")), "\n", -1))
    d = d.withColumn("article_spaces_fixed", _sum(F.col("_lines"), lambda x: T.legal_space_hits(x, "条")))
    d = d.withColumn("chapter_spaces_fixed", _sum(F.col("_lines"), lambda x: T.legal_space_hits(x, "章")))
    d = d.withColumn("section_spaces_fixed", _sum(F.col("_lines"), lambda x: T.legal_space_hits(x, "[节项]")))
    d = d.withColumn("_lines", F.transform("_lines", lambda x: T.fix_legal_spaces(x)))
    d = d.withColumn("bold_removed", _sum(F.col("_lines"), lambda x: F.regexp_count(x, F.lit(T.BOLD_LEGAL))))
    d = d.withColumn("_lines", F.transform("_lines", lambda x: T.sub(x, T.BOLD_LEGAL, "$1")))
    d = d.withColumn("bold_short_removed", _sum(F.col("_lines"), lambda x: F.regexp_count(x, F.lit(T.BOLD_SHORT))))
    d = d.withColumn("_lines", F.transform("_lines", lambda x: T.sub(x, T.BOLD_SHORT, "$1")))
    bare = lambda x: T.strip(T.strip_heading_marks(T.strip(x)))
    # each step's array is a column of its own, so it is computed once
    d = d.withColumn("h1_normalized", _count(F.col("_lines"), lambda x: T.is_rule_chapter(bare(x))))
    d = d.withColumn("h2_normalized", _count(F.col("_lines"), lambda x: ~T.is_rule_chapter(bare(x)) & T.is_rule_section(bare(x))))
    d = d.withColumn("headings_demoted", _count(F.col("_lines"), lambda x: x.rlike(r"(?U)^#{1,6}\s+") & ~T.is_rule_chapter(bare(x)) & ~T.is_rule_section(bare(x))))
    d = d.withColumn("_lines", F.transform("_lines", T.normalize_heading))
    d = d.withColumn("_shown", F.array_join(F.transform("_lines", T.strip_inline_boilerplate), "\n"))
    d = d.withColumn("_gapless", T.fix_cjk_gaps(F.col("_shown")))
    d = d.withColumn("cjk_gaps_removed", F.length("_shown") - F.length("_gapless"))
    d = reflow(d, "_gapless", "_flowed", "lines_merged")
    d = d.withColumn("_whole", M.unshield(F.col("_flowed"), F.col("_regions")))
    d = d.withColumn("_plain", T.strip_inline_boilerplate(F.col("_whole")))
    found = lambda c: F.regexp_count(c, F.lit(T.P.RULE_HEADER)) + F.regexp_count(c, F.lit(T.P.ISSUED_PHRASE))
    d = d.withColumn("inline_boilerplate_removed", _sum(F.col("_lines"), found) + found(F.col("_whole")))
    d = d.withColumn("_out", T.compress_blank_lines(F.col("_plain")))
    d = d.withColumn("blank_lines_removed", F.length("_plain") - F.length("_out"))
    return d.withColumn(text, F.concat(T.strip(F.col("_out")), F.when(raw.isNotNull(), F.lit("\n")))).drop("_first", "_lines", "_kept", "_regions", "_shown", "_gapless", "_flowed", "_whole", "_plain", "_out")


def run_totals(cleaned: DataFrame) -> DataFrame:
    """One row: documents and the sum of every counter."""
    return cleaned.agg(F.count("*").alias("n_docs"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS])
