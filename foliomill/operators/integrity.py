"""Checks of an index against its sources: pages, lines, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T


def index_refs(index_lines: DataFrame) -> DataFrame:
    """Lines of index files (norm, index_path, pos, line) that cite pages: kind, label, old_start, old_end."""
    line = F.col("line")
    shapes = (("catalog", P.CATALOG_LINE, 2), ("summary", P.SUMMARY_LINE, 2), ("file", P.FILE_LINE, 3), ("summary_file", P.SUMMARY_FILE_LINE, 3))
    ref = None
    for kind, pattern, groups in shapes:
        p = "(?U)" + pattern
        end = F.regexp_extract(line, p, 3).try_cast("int") if groups == 3 else F.lit(None).cast("int")
        found = F.struct(F.lit(kind).alias("kind"), T.strip(F.regexp_extract(line, p, 1)).alias("label"), F.regexp_extract(line, p, 2).try_cast("int").alias("old_start"), end.alias("old_end"))
        ref = F.when(line.rlike(p), found) if ref is None else ref.when(line.rlike(p), found)
    return index_lines.withColumn("_r", ref).where("_r is not null").select("norm", "index_path", "pos", "_r.*")


def body_page_ranges(body_labels: DataFrame, page_map: DataFrame) -> DataFrame:
    """norm, stem and least and greatest page of the labels of each body file."""
    return body_labels.join(page_map, ["norm", "label"]).groupBy("norm", "stem").agg(F.min("page").alias("start_page"), F.max("page").alias("end_page"))


def check_pages(refs: DataFrame, page_map: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """References whose pages differ from the sources': issues with expected pages and delta.

    References with no counterpart are left alone.
    """
    single = refs.where("old_end is null").join(page_map, ["norm", "label"]).select("norm", "index_path", "pos", "kind", "label", "old_start", "old_end", F.col("page").alias("start"), F.lit(None).cast("int").alias("end"))
    found = single
    if ranges is not None:
        spans = ranges.select("norm", F.col("stem").alias("label"), F.col("start_page").alias("start"), F.col("end_page").alias("end"))
        found = found.unionByName(refs.where("old_end is not null").join(spans, ["norm", "label"]).select(*single.columns))
    wrong = (F.col("old_start") != F.col("start")) | ~F.col("old_end").eqNullSafe(F.col("end"))
    return found.where(wrong).withColumn("delta", F.col("start") - F.col("old_start"))


def fix_pages(index_lines: DataFrame, issues: DataFrame) -> DataFrame:
    """Index lines with wrong pages put right, and whether each changed; the rest of a line stays."""
    joined = index_lines.join(issues.select("norm", "index_path", "pos", "start", "end"), ["norm", "index_path", "pos"], "left")
    page = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    one = F.regexp_replace("line", F.lit(r"（第\d+页）"), F.concat(F.lit("（第"), page(F.col("start")), F.lit("页）")))
    both = F.regexp_replace("line", F.lit(r"（第\d+～\d+页）"), F.concat(F.lit("（第"), page(F.col("start")), F.lit("～"), page(F.col("end")), F.lit("页）")))
    fixed = F.when(F.col("start").isNull(), F.col("line")).when(F.col("end").isNull(), one).otherwise(both)
    return joined.select("norm", "index_path", "pos", fixed.alias("line"), F.col("start").isNotNull().alias("changed"))


def line_counts(source: DataFrame, body: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines of each source and of its body files, their difference, ratio and a flag."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    both = n(source, "src_lines").join(n(body, "body_lines"), key, "left").withColumn("body_lines", F.coalesce("body_lines", F.lit(0)))
    ratio = F.col("body_lines") / F.col("src_lines")
    return both.select(key, "src_lines", "body_lines", (F.col("body_lines") - F.col("src_lines")).alias("diff"), ratio.alias("ratio"), Q.split_ratio_flag(F.col("body_lines"), F.col("src_lines")).alias("flag"))


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What has no output yet."""
    return wanted.join(done.select(key), key, "left_anti")


def lost_labels(source: DataFrame, body: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels of the sources that no body file has."""
    return source.select(key, "label").distinct().join(body.select(key, "label").distinct(), [key, "label"], "left_anti")


def repeated_pages(bodies: DataFrame, text: str = "text") -> DataFrame:
    """Texts that more than one body file has: hash and number."""
    return bodies.groupBy(F.md5(F.col(text).cast("binary")).alias("text_md5")).agg(F.count("*").alias("n")).where("n > 1")


def norms_without_todo(summaries: DataFrame) -> DataFrame:
    """norms none of whose lines still asks for a summary."""
    return summaries.groupBy("norm").agg(F.max(F.col("line").contains(P.SUMMARY_TODO).cast("int")).alias("t")).where("t = 0").select("norm")


LINK = r"\[[^\]]*\]\(([^)#\s]+)(?:#[^)]*)?\)"


def links(index_lines: DataFrame) -> DataFrame:
    """norm, index_path and target of the Markdown links of index lines; links to the web are left out."""
    found = index_lines.select("norm", "index_path", F.explode(F.regexp_extract_all("line", F.lit(LINK), F.lit(1))).alias("target"))
    return found.where(~F.col("target").rlike("^[a-z]+:"))


def dead_links(index_lines: DataFrame, files: DataFrame) -> DataFrame:
    """Links whose target is no file (norm, path) of their norm."""
    return links(index_lines).join(files.select("norm", F.col("path").alias("target")), ["norm", "target"], "left_anti").select("norm", "index_path", "target").distinct()


def missing_references(citations: DataFrame, linked: DataFrame, norms: DataFrame) -> DataFrame:
    """Norms (source, norm) that a source's text cites, that exist, and that none of its links (source, norm) leads to."""
    cited = citations.select("source", "norm").distinct().where(F.col("source") != F.col("norm"))
    return cited.join(norms.select("norm"), "norm", "left_semi").join(linked.select("source", "norm"), ["source", "norm"], "left_anti").select("source", "norm")


def resolve_citations(citations: DataFrame, page_map: DataFrame) -> DataFrame:
    """Citations (norm, article, ...) with the page of their target; null where there is none."""
    return citations.join(page_map.select("norm", F.col("label").alias("article"), "page"), ["norm", "article"], "left")


def keyword_search(bodies: DataFrame, words: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and hits (how often the words stand in the text) of the bodies that hold all of them."""
    hold = F.lit(True)
    hits = F.lit(0)
    for word in words:
        hold = hold & F.col(text).contains(word)
        hits = hits + F.size(F.split(text, F.concat(F.lit("\\Q"), F.lit(word), F.lit("\\E")), -1)) - 1
    return bodies.where(hold).select(key, hits.alias("hits"))
