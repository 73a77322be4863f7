"""Whole runs: documents to body files with their indexes, and texts to cleaned texts, one row for each and nothing on the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T
from ..session import cut
from . import chunk, keys, lines, models, outline, rules, scan, split, structure
from .intervals import interval_join

SEGMENT = ["doc_id", "chapter_id", "group_no"]


def segment_lines(docs: DataFrame) -> DataFrame:
    """Structured lines of documents (doc_id, name, text) with group_no, stem, chapter, file title, heading and merged titles of their segment.

    A chapter's lines before its first section are segment 0 (all of a chapter
    without sections); its sections follow in groups.  A document without
    chapters is one segment, and its name is the stem; a heading that is the name
    begins none.
    """
    exploded = lines.explode_lines(docs, universal=True).join(docs.select("doc_id", "name"), "doc_id")
    d = structure.structure_lines(exploded, block=scan.block_for(docs), name=F.col("name"))
    groups = structure.group_sections(structure.sections(d).where("section_id > 0"))
    named = groups.groupBy("doc_id", "chapter_id", "group_no").agg(
        F.first("stem").alias("_stem"), F.first("merged").alias("_merged"), F.array_sort(F.collect_list(F.struct("section_id", "title"))).alias("_titles")
    )
    placed = d.join(groups.select("doc_id", "chapter_id", "section_id", "group_no"), ["doc_id", "chapter_id", "section_id"], "left").withColumn("group_no", F.coalesce("group_no", F.lit(0)))
    placed = placed.join(named, SEGMENT, "left")
    top = Window.partitionBy("doc_id", "chapter_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = Window.partitionBy(*SEGMENT).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = placed.withColumn("chapter", F.when(F.col("chapter_id") > 0, F.first("title").over(top))).withColumn("heading", F.when(F.col("chapter_id") > 0, F.first("line").over(own)))
    first = F.get("_titles", F.lit(0))["title"]
    titles = F.when(F.col("_merged"), F.transform("_titles", lambda x: F.coalesce(x["title"], F.lit(""))))
    stem = F.when(F.col("chapter_id") == 0, T.slug_title(F.col("name"))).when(F.col("group_no") == 0, T.chapter_stem(F.col("chapter"))).otherwise(F.col("_stem"))
    title = F.when(F.col("chapter_id") == 0, F.col("name")).when((F.col("group_no") == 0) | F.col("_merged"), F.col("chapter")).otherwise(first)
    return placed.withColumn("stem", stem).withColumn("file_title", title).withColumn("merged", titles).drop("_stem", "_merged", "_titles")


def split_documents(docs: DataFrame, most_pages: int = 2) -> tuple[DataFrame, DataFrame]:
    """Body files of documents (doc_id, name, text) and the documents' own indexes.

    Files: doc_id, path, stem, chapter_id, group_no, part_no, parts, start_page,
    end_page, is_table, text, index_text.  Indexes: doc_id, path, text and the
    figures of the run: chapters, files, src_lines, body_lines.  Text parts after
    the first of their piece begin with the segment's heading.  Tables keep the
    short lines above them and are listed by their label.  Rows of equal or null
    doc_ids are documents of their own; equal names give equal paths.
    """
    docs, names = keys.numbered(docs.select("doc_id", "name", "text"))
    placed = cut(segment_lines(docs), "segment-lines")  # read several times below
    files = split.split_chunks(placed, SEGMENT, most_pages, preambles=True)
    spans = split.table_spans(placed, "doc_id").select("doc_id", "end_pos", F.lit(True).alias("is_table"), "label")
    files = files.join(spans, ["doc_id", "end_pos", "is_table"], "left")
    facts = placed.groupBy(*SEGMENT).agg(*[F.first(c).alias(c) for c in ("name", "stem", "chapter", "file_title", "heading", "merged")])
    files = files.join(facts, SEGMENT).withColumn("stem", F.concat("stem", "suffix"))
    folder = F.when(F.col("chapter_id") > 0, F.concat("name", F.lit("/"), T.chapter_dir(F.col("chapter")), F.lit("/"))).otherwise(F.concat("name", F.lit("/")))
    files = files.withColumn("path", F.concat(folder, F.col("stem"), F.lit(".md"))).withColumn("file", F.concat_ws("/", *SEGMENT, "part_no"))
    files = cut(files, "body-files")

    at = files.select(*SEGMENT, "file", "start_pos", "end_pos", "is_table", "range_no", F.col("heading").alias("_heading"))
    inside = interval_join(placed.select(*SEGMENT, "pos", "line", "page"), at, SEGMENT, "pos", "start_pos", "end_pos")
    shown = inside.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("pos", split.render_line(F.col("line")).alias("l")))).alias("x"), F.first("_heading").alias("h"), F.first("range_no").alias("n"), F.first("is_table").alias("t"))
    body = F.transform("x", lambda x: x["l"])
    body = F.when(~F.col("t") & (F.col("n") > 1) & F.col("h").isNotNull(), F.concat(F.array(split.render_line(F.col("h")), F.lit("")), body)).otherwise(body)
    texts = shown.select("file", F.concat(T.strip(T.compress_blank_lines(F.array_join(body, "\n"))), F.lit("\n")).alias("text"))
    found = outline.outline(inside.where("not is_table").select("file", "pos", "line", "page"), "file")
    entries = found.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "label", "page"))), lambda e: F.struct(e["label"], e["page"])).alias("entries"))
    joined = files.join(texts, "file").join(entries, "file", "left")
    one = F.array(F.struct(F.col("label"), F.col("start_page").alias("page")))
    listed = F.when(F.col("is_table"), one).otherwise(F.coalesce("entries", F.array().cast("array<struct<label:string,page:int>>")))
    index = outline.body_index(F.col("stem"), F.col("file_title"), listed, F.col("start_page"), F.col("end_page"), F.col("part_no"), F.col("parts"), F.col("merged"))
    written = joined.withColumn("index_text", index)

    lined = F.size(F.split(T.sub(F.col("text"), "\n$", ""), "\n", -1))
    order = F.struct("chapter_id", "group_no", "part_no", "stem", "start_page", "end_page")
    totals = written.groupBy("doc_id").agg(F.array_sort(F.collect_list(order)).alias("files"), F.sum(lined).alias("body_lines"))
    tree = placed.where("chapter_id > 0").groupBy("doc_id", "chapter_id").agg(
        F.first("chapter").alias("title"), F.array_sort(F.collect_list(F.when(F.col("starts_section"), F.struct("pos", "title")))).alias("s")
    )
    tree = tree.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chapter_id", "title", F.transform("s", lambda x: F.coalesce(x["title"], F.lit(""))).alias("sections")))).alias("chapters"))
    flat = outline.outline(placed.where("chapter_id = 0").select("doc_id", "pos", "line", "page"))
    flat = flat.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "label", "page"))).alias("labels"))
    source = docs.select("doc_id", "name", F.size(lines.split_lines(F.col("text"), universal=True)).alias("src_lines"))
    whole = source.join(totals, "doc_id", "left").join(tree, "doc_id", "left").join(flat, "doc_id", "left")
    empty = lambda c, of: F.coalesce(c, F.array().cast(f"array<struct<{of}>>"))
    chapters, listed = empty("chapters", "chapter_id:int,title:string,sections:array<string>"), empty("files", "chapter_id:int,group_no:int,part_no:int,stem:string,start_page:int,end_page:int")
    text = outline.document_index(F.col("name"), chapters, listed, empty("labels", "pos:int,label:string,page:int"))
    indexes = whole.select(
        "doc_id", F.concat("name", F.lit("/"), "name", F.lit("-index.md")).alias("path"), text.alias("text"),
        F.size(chapters).alias("chapters"), F.size(listed).alias("files"), F.coalesce("src_lines", F.lit(0)).alias("src_lines"), F.coalesce("body_lines", F.lit(0)).alias("body_lines"),
    )
    kept = ("doc_id", "path", "stem", "chapter_id", "group_no", "part_no", "parts", "start_page", "end_page", "is_table", "text", "index_text")
    return keys.named(written.select(*kept), names), keys.named(indexes, names)


def clean_documents(docs: DataFrame, make: Callable[[], Callable[[str], str]] | None = None, text: str = "text", store: str | None = None) -> DataFrame:
    """doc_id, text, status, error, figures and rule counters of cleaned documents.

    Rules alone without a model; else their text goes through it by chunks.  A
    chunk whose call fails, or whose answer lacks a placeholder, stays as it was
    and is counted; with a ``store`` of answers (``models.call_model``) equal chunks
    are asked once, in this run and in later ones.  A null text is a failed document; it keeps its row.  Rows of
    equal or null doc_ids are documents of their own.
    """
    docs, names = keys.numbered(docs.select("doc_id", F.col(text).alias("text"))) if make is not None else (docs.select("doc_id", F.col(text).alias("text")), None)
    raw = docs.select("doc_id", "text", F.length("text").alias("chars_before"))
    ruled = rules.apply_rules(raw)
    status = F.when(F.col("chars_before").isNull(), "failed").otherwise("ok").alias("status")
    error = F.when(F.col("chars_before").isNull(), "no text").alias("error")
    if make is None:
        zero = [F.lit(0).cast("long").alias(c) for c in ("chunks", "chunks_ok", "chunks_failed", "tables_recovered")]
        return ruled.select("doc_id", "text", status, error, "chars_before", F.length("text").alias("chars_after"), *zero, *rules.COUNTERS)
    # used twice, and filters that the planner would draw from the chunks mustn't repeat the rules
    ruled = cut(ruled, "ruled")
    # the figures and the texts are both made of it, and calls are to be paid for once
    done = cut(models.clean_chunks(chunk.chunk_documents(ruled.select("doc_id", "text")), make, store), "model-chunks")
    counted = done.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.count_if("ok").alias("chunks_ok"), F.count_if(~F.col("ok")).alias("chunks_failed"), F.sum(F.when(F.col("ok"), F.col("new_tables")).otherwise(0)).cast("long").alias("tables_recovered"))
    joined = ruled.drop("text").join(chunk.reassemble(done), "doc_id", "left").join(counted, "doc_id", "left")
    figures = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("chunks", "chunks_ok", "chunks_failed", "tables_recovered")]
    whole = F.when(F.col("chars_before").isNotNull(), F.coalesce("text", F.lit("\n")))
    found = joined.select("doc_id", whole.alias("text"), status, error, "chars_before", F.length(whole).alias("chars_after"), *figures, *rules.COUNTERS)
    return keys.named(found, names)


def fix_index(index_lines: DataFrame, page_map: DataFrame, body_labels: DataFrame | None = None) -> DataFrame:
    """Index lines with the pages of labels, and of files where their labels are given, put right."""
    from . import integrity

    ranges = integrity.body_page_ranges(body_labels, page_map) if body_labels is not None else None
    return integrity.fix_pages(index_lines, integrity.check_pages(integrity.index_refs(index_lines), page_map, ranges))


def split_flag(indexes: DataFrame) -> DataFrame:
    """Run figures with difference, ratio and flag of each split."""
    ratio = F.col("body_lines") / F.nullif(F.col("src_lines"), F.lit(0))
    return indexes.withColumn("diff", F.col("body_lines") - F.col("src_lines")).withColumn("ratio", ratio).withColumn("flag", F.coalesce(Q.split_ratio_flag(F.col("body_lines"), F.nullif(F.col("src_lines"), F.lit(0))), F.lit(False)))
