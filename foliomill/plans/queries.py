"""Registered queries over the document operators: whole tables in, whole results out."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T
from ..operators import answers, chunk, citations, driver, integrity, layout, lines, mask, models, outline, postings, qa, report, rules, split, structure
from ..session import read_table, remove_at_end, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", "text")


def reg(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents dressed as regulations."""
    return lines.decorated(documents(spark, d))


def reg_docs(spark: SparkSession, d: str) -> DataFrame:
    return lines.join_lines(reg(spark, d))


LINE = F.col


@query
def outline_first(spark, d):
    """The labels of each document and the page where each first stands."""
    return outline.outline(lines.with_pages(reg(spark, d))).select("doc_id", "label", "page")


@query
def line_explode(spark, d):
    return lines.explode_lines(documents(spark, d), universal=True)


@query
def line_clean(spark, d):
    noisy = F.concat(F.lit("　\t "), F.col("line"), F.lit("\u0007  　"), F.col("pos").cast("string"), F.lit(" "))
    return lines.explode_lines(documents(spark, d)).select("doc_id", "pos", T.clean_line(noisy).alias("line"))


@query
def heading_guess(spark, d):
    return reg(spark, d).select("doc_id", "pos", Q.heading_level(T.strip_heading_marks(F.col("line"))).alias("level"))


@query
def quality_gate(spark, d):
    q = Q.text_quality(F.col("line"))
    return reg(spark, d).select("doc_id", "pos", q["ok"].alias("ok"), F.split_part(q["reason"], F.lit("("), F.lit(1)).alias("reason"))


@query
def page_of_line(spark, d):
    return lines.with_pages(reg(spark, d)).select("doc_id", "pos", "page")


@query
def marker_body(spark, d):
    marked = F.concat(F.lit("前"), F.when(F.col("pos") % 3 == 0, T.page_marker(F.col("pos"))).otherwise(F.lit("")), F.lit(" **"), F.col("line"))
    return reg(spark, d).select("doc_id", "pos", T.page_of_marker(marked).alias("page"), T.body_after_marker(marked).alias("body"))


@query
def footer_filter(spark, d):
    return reg(spark, d).where(~Q.is_page_number(F.col("line")) & ~Q.is_boilerplate(F.col("line")))


@query
def footer_counts(spark, d):
    hit = lambda p: F.count_if(p).alias
    return reg(spark, d).groupBy("doc_id").agg(hit(Q.is_page_number(F.col("line")))("page_numbers"), hit(Q.is_boilerplate(F.col("line")))("boilerplate"))


@query
def legal_space_fix(spark, d):
    line = F.col("line")
    return reg(spark, d).select("doc_id", "pos", T.fix_legal_spaces(line).alias("line"), T.legal_space_hits(line, "条").alias("hits"))


@query
def bold_strip(spark, d):
    return lines.explode_lines(documents(spark, d)).select("doc_id", "pos", T.strip_bold(F.regexp_replace("line", r"(\S+)", "**$1**")).alias("line"))


@query
def heading_normalize(spark, d):
    return reg(spark, d).select("doc_id", "pos", T.normalize_heading(T.fix_legal_spaces(F.col("line"))).alias("line"))


@query
def cjk_gap(spark, d):
    return reg(spark, d).select("doc_id", "pos", T.fix_cjk_gaps(F.concat(F.lit("甲 乙丙 ，"), F.col("line"))).alias("line"))


@query
def reflow(spark, d):
    return rules.reflow(documents(spark, d), "text", "flowed", "merged").select("doc_id", F.col("flowed").alias("text"), "merged")


@query
def blank_compress(spark, d):
    spaced = F.array_join(F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(x, F.repeat(F.lit("\n"), (i % 4).cast("int")))), "\n")
    return documents(spark, d).select("doc_id", T.compress_blank_lines(spaced).alias("text"))


@query
def rule_stats(spark, d):
    keep = ["page_numbers_removed", "boilerplate_removed", "article_spaces_fixed", "chapter_spaces_fixed", "section_spaces_fixed"]
    return rules.apply_rules(reg_docs(spark, d)).select("doc_id", *keep)


@query
def rules_clean(spark, d):
    """The whole rule pipeline: cleaned text and all counters."""
    return rules.apply_rules(reg_docs(spark, d))


@query
def clean_report(spark, d):
    return rules.run_totals(rules.apply_rules(reg_docs(spark, d)))


@query
def mask_spans(spark, d):
    rows = read_table(spark, d, "pages").select("page_id", F.posexplode(mask.placeholders(F.col("html"))).alias("pos", "h"))
    return rows.select("page_id", "pos", F.col("h.token").alias("token"), F.col("h.payload").alias("payload"))


@query
def mask_roundtrip(spark, d):
    t = F.concat(F.lit("$a$ <!-- x --> "), F.col("text"))
    return documents(spark, d).select("doc_id", mask.unmask(mask.mask_protected(t), mask.placeholders(t)).alias("text"), F.size(mask.placeholders(t)).alias("n"))


@query
def page_pieces(spark, d):
    return chunk.page_pieces(reg_docs(spark, d)).select("doc_id", F.posexplode("pieces").alias("pos", "p")).select("doc_id", "pos", "p.page_no", "p.page", "p.text")


@query
def size_chunks(spark, d):
    return documents(spark, d).select("doc_id", F.posexplode(chunk.split_by_size(F.col("text"))).alias("pos", "text"))


@query
def greedy_chunks(spark, d):
    """Greedy packing where paragraphs end in blank lines; a fold, so without SQL."""
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return documents(spark, d).select("doc_id", F.posexplode(chunk.split_by_size(spaced, 1000)).alias("pos", "text"))


@query
def chunk_reassemble(spark, d):
    return chunk.reassemble(chunk.chunk_documents(reg_docs(spark, d)))


@query
def chapters(spark, d):
    return structure.chapters(structure.structure_lines(reg(spark, d))).select("doc_id", "chapter_id", "title", "start_pos", "end_pos", "start_page", "n_sections")


@query
def sections(spark, d):
    return structure.sections(structure.structure_lines(reg(spark, d))).select("doc_id", "chapter_id", "section_id", "title", "start_pos", "end_pos", "n_lines", "n_chars")


@query
def section_groups(spark, d):
    """Merged small sections; a fold, so without SQL."""
    return structure.group_sections(structure.sections(structure.structure_lines(reg(spark, d))))


@query
def page_touches(spark, d):
    return lines.page_touches(lines.with_pages(reg(spark, d))).select("doc_id", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


@query
def table_spans(spark, d):
    return split.table_spans(lines.with_pages(reg(spark, d))).select("doc_id", "table_no", "start_pos", "end_pos", "start_page", "end_page", "label")


@query
def split_parts(spark, d):
    """Body files of each chapter: tables apart, text by pages with one page of overlap."""
    s = structure.structure_lines(reg(spark, d))
    return split.split_chunks(s, ["doc_id", "chapter_id"])


@query
def split_bodies(spark, d):
    s = structure.structure_lines(reg(spark, d))
    return split.render_bodies(s, split.split_chunks(s, ["doc_id", "chapter_id"]), ["doc_id", "chapter_id"])


@query
def file_index(spark, d):
    return outline.file_index(outline.outline(lines.with_pages(reg(spark, d))))


@query
def root_index(spark, d):
    c = structure.structure_lines(reg(spark, d)).groupBy("doc_id", F.col("chapter_id").alias("ord")).agg(F.min_by("title", "pos").alias("title"), F.min("page").alias("start_page"), F.max("page").alias("end_page"))
    return outline.root_index(c.withColumn("title", F.coalesce("title", F.lit("-"))))


@query
def slug(spark, d):
    part = read_table(spark, d, "part")
    title = F.concat(F.lit("第 "), F.col("p_size").cast("string"), F.lit(" 条 "), F.col("p_name"), F.lit(" a/b: c"))
    return part.select("p_partkey", T.slug_title(title).alias("slug"), T.short_slug(F.concat(F.lit("2.1 "), F.col("p_name"), F.col("p_type"))).alias("short"))


def _page_map(spark, d):
    return outline.outline(lines.with_pages(reg(spark, d))).select(F.col("doc_id").alias("norm"), "label", "page", "pos")


def _index_lines(spark, d):
    wrong = F.col("page") + (F.col("norm") % 2 + F.col("pos") % 3 * (F.col("norm") % 2)).cast("int")
    return _page_map(spark, d).select("norm", F.lit("a-index.md").alias("index_path"), "pos", F.when(F.col("pos") % 2 == 0, T.catalog_line(F.col("label"), wrong)).otherwise(T.summary_line(F.col("label"), wrong)).alias("line"))


@query
def page_map_check(spark, d):
    found = integrity.check_pages(integrity.index_refs(_index_lines(spark, d)), _page_map(spark, d).select("norm", "label", "page"))
    return found.select("norm", "label", "kind", "old_start", "start", "delta")


@query
def page_map_fix(spark, d):
    index = _index_lines(spark, d)
    issues = integrity.check_pages(integrity.index_refs(index), _page_map(spark, d).select("norm", "label", "page"))
    return integrity.fix_pages(index, issues).select("norm", "pos", "line", "changed")


@query
def body_page_range(spark, d):
    labels = _page_map(spark, d)
    return integrity.body_page_ranges(labels.select("norm", "label", (F.col("pos") % 3).cast("string").alias("stem")), labels.select("norm", "label", "page"))


@query
def norm_semi(spark, d):
    return documents(spark, d).select("doc_id").join(read_table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")


@query
def pending_outputs(spark, d):
    return integrity.pending(documents(spark, d).select("doc_id"), read_table(spark, d, "labels"), "doc_id")


@query
def line_ratio(spark, d):
    source = reg(spark, d)
    return integrity.line_counts(source, source.where(~Q.is_page_number(F.col("line")) & T.page_of_marker(F.col("line")).isNull()))


@query
def dedup_stem(spark, d):
    from ..sources.files import best_format

    ext = F.element_at(F.array(*[F.lit(x) for x in P.FORMATS]), (F.col("doc_id") % 3 + 1).cast("int"))
    files = read_table(spark, d, "documents").select(F.concat(F.lit("/in/"), F.col("source"), F.lit("-"), F.expr("doc_id div 5").cast("string"), ext).alias("path"))
    return best_format(files).select("path", "stem", "ext")


@query
def html_headings(spark, d):
    title = T.group(F.col("html"), r"(?is)<h1[^>]*>(.*?)</h1>")
    return read_table(spark, d, "pages").select("page_id", T.slug_title(F.coalesce(title, F.lit(""))).alias("slug"), F.regexp_count("html", F.lit("(?i)<p[ >]")).alias("n_paragraphs"))


@query
def html_first_table(spark, d):
    """The first table of a fenced answer and of each page; empty where there is none."""
    fenced = F.concat(F.lit("```html\n<table><tr><td>"), F.col("url"), F.lit("</td></tr></table>\n```"))
    page = T.first_table(F.col("html"))
    return read_table(spark, d, "pages").select("page_id", T.first_table(fenced).alias("table_html"), page.alias("of_page"))


def _grids(spark, d):
    item = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    row = F.filter(F.array(F.col("l_partkey").cast("string"), F.when(F.col("l_partkey") % 3 > 0, F.col("l_returnflag")), F.when(F.col("l_partkey") % 7 != 0, F.lit(" x "))), lambda x: x.isNotNull() | (F.col("l_partkey") % 2 == 0))
    return item.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", row.alias("r")))).alias("g")).select("l_orderkey", F.transform("g", lambda x: x["r"]).alias("grid"))


@query
def table_score(spark, d):
    s = Q.score_table(F.col("grid"), (F.col("l_orderkey") % 100) / 100)
    return _grids(spark, d).select("l_orderkey", s.alias("s")).select("l_orderkey", "s.rows", "s.cols", F.round(F.col("s.score") + 1e-9, 6).alias("score"), F.split_part(F.col("s.reject_reason"), F.lit("="), F.lit(1)).alias("reject_reason"))


@query
def bbox_filter(spark, d):
    box = F.struct((F.col("l_quantity") * 10 - 20).cast("double").alias("x0"), (F.col("l_discount") * 1000).cast("double").alias("top"), (F.col("l_quantity") * 14).cast("double").alias("x1"), (F.col("l_discount") * 1000 + F.col("l_tax") * 3000).cast("double").alias("bottom"))
    item = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", box.alias("bbox"))
    clamped = Q.clamp_box(F.col("bbox"), F.lit(500.0), F.lit(100.0))
    return item.select("l_orderkey", "l_linenumber", clamped["x0"].alias("x0"), clamped["x1"].alias("x1"), Q.is_large_image(F.col("bbox"), F.lit(500.0), F.lit(100.0)).alias("is_large"))


@query
def word_lines(spark, d):
    """Words to lines by their height; a fold, so without SQL."""
    item = read_table(spark, d, "lineitem")
    x, y = F.col("l_quantity").cast("double"), (F.col("l_linenumber") * 2).cast("double")
    word = F.struct(F.col("l_partkey").cast("string").alias("text"), x.alias("x0"), y.alias("top"), (x + 3).alias("x1"), (y + 2).alias("bottom"))
    boxes = F.array(F.struct(F.lit(10.0).alias("x0"), F.lit(0.0).alias("top"), F.lit(15.0).alias("x1"), F.lit(99.0).alias("bottom")))
    pages = item.groupBy("l_orderkey").agg(F.collect_list(word).alias("words"))
    return pages.select("l_orderkey", F.posexplode(layout.word_lines(layout.words_outside(F.col("words"), boxes))).alias("pos", "line"))


@query
def html_table_build(spark, d):
    nation, region = read_table(spark, d, "nation"), read_table(spark, d, "region")
    cells = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).groupBy("r_name").agg(F.array_sort(F.collect_list(F.array(F.format_string("%02d", "n_nationkey"), F.col("n_name")))).alias("grid"))
    return cells.select("r_name", T.html_table(F.col("grid")).alias("table_html"))


@query
def excerpt_verify(spark, d):
    """Benchmark items that stand word for word in a document.

    Every item is an excerpt to look for in every document, a stated query set
    against all rows.
    """
    items = read_table(spark, d, "benchmark").select("item_id", F.col("text").alias("excerpt"))
    return qa.find_excerpts(items, documents(spark, d).withColumnRenamed("doc_id", "path")).select("item_id", F.col("path").alias("doc_id"))


@query
def citation_dangling(spark, d):
    talk = read_table(spark, d, "conversations")
    answers = talk.groupBy(F.col("conv_id").alias("answer_id")).agg(F.concat(F.lit("见序号 1、"), F.max("turn").cast("string"), F.lit(" 与序号 "), (F.max("turn") + 1).cast("string")).alias("text"))
    return qa.dangling_citations(answers, talk.select(F.col("conv_id").alias("answer_id"), F.col("turn").cast("int").alias("seq")))


@query
def verdict_counts(spark, d):
    names = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "正确").when(F.col("quality") == 1, "溯源不足").when(F.col("toxic") == 0, "摘抄错误").otherwise("编造")
    labelled = read_table(spark, d, "labels").join(read_table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return qa.verdict_counts(labelled.withColumn("verdict", names), ["lang"])


@query
def clean_identity_model(spark, d):
    """Chunks through a model that changes nothing, put together again."""
    return chunk.reassemble(models.clean_chunks(chunk.chunk_documents(documents(spark, d))))


@query
def clause_citations(spark, d):
    cited = lines.explode_lines(documents(spark, d)).withColumn("line", F.concat(F.lit("依《甲法》第"), F.col("pos").cast("string"), F.lit("条和《乙法》 第二条 "), F.col("line")))
    return qa.clause_citations(cited)


@query
def lost_labels(spark, d):
    found = outline.line_labels(reg(spark, d)).select("doc_id", "label")
    return integrity.lost_labels(found, found.where(~F.col("label").endswith("0 条")))


@query
def repeated_texts(spark, d):
    return integrity.repeated_pages(documents(spark, d))


@query
def report_rows(spark, d):
    """At most 200 issues of each norm, in their order, with how many there are."""
    issues = page_map_check(spark, d)
    w = Window.partitionBy("norm")
    ranked = issues.withColumn("place", F.row_number().over(w.orderBy("label"))).withColumn("n_issues", F.count("*").over(w))
    return ranked.where("place <= 200").select("norm", "place", "label", "delta", "n_issues")


@query
def issue_deltas(spark, d):
    return page_map_check(spark, d).groupBy("norm").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_set("delta")), lambda x: x.cast("string")), ",").alias("deltas"))


@query
def incremental_replay(spark, d):
    """Four arrivals of documents, each processed once: as one run over all."""
    from ..streaming.landing import replay

    return replay(documents(spark, d), lambda df: outline.outline(lines.with_pages(lines.decorated(df))).select("doc_id", "label", "page"), 4)


def rich(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents dressed with what ``reg`` lacks."""
    return lines.dressed(documents(spark, d))


def named_docs(spark: SparkSession, d: str) -> DataFrame:
    return lines.join_lines(rich(spark, d)).select("doc_id", F.concat(F.lit("规范"), F.col("doc_id").cast("string")).alias("name"), "text")


@query
def rich_structure(spark, d):
    """Chapter and section of every line: numbered parts, （一） items, contents, tails, appendices, markers within lines."""
    return structure.structure_lines(rich(spark, d)).select("doc_id", "pos", "page", "chapter_id", "section_id", "starts_section")


@query
def rich_tables(spark, d):
    """Tables of several lines, with their labels."""
    return split.table_spans(lines.with_pages(rich(spark, d)))


@query
def rich_outline(spark, d):
    return outline.outline(lines.with_pages(rich(spark, d))).select("doc_id", "label", "page")


@query
def split_files(spark, d):
    """The split of whole documents: every body file with its text and index."""
    return driver.split_documents(named_docs(spark, d))[0]


@query
def split_indexes(spark, d):
    return driver.split_documents(named_docs(spark, d))[1]


@query
def table_preambles(spark, d):
    """Where the file of each table begins: the table or the short lines above it."""
    placed = split.with_preambles(split.table_islands(lines.with_pages(rich(spark, d)), ["doc_id"]), ["doc_id"])
    return placed.where("preamble is not null").select("doc_id", "table_no", F.col("pos").alias("start_pos"), "preamble")


@query
def split_report(spark, d):
    return report.split_report(driver.split_documents(named_docs(spark, d))[1])


@query
def clean_rules_only(spark, d):
    return driver.clean_documents(reg_docs(spark, d)).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "status", "error", "chars_before", "chars_after", "chunks", "lines_merged")


@query
def clean_with_model(spark, d):
    """The whole cleaning run with a model that changes nothing."""
    done = driver.clean_documents(documents(spark, d), models.identity)
    return done.select("doc_id", "status", "chunks_failed", "tables_recovered", (F.col("chunks") > 0).alias("asked"))


def _never() -> Callable[[str], str]:
    def call(text: str) -> str:
        raise AssertionError("asked again")

    return call


@query
def model_answers(spark, d):
    """The answer to each document's text from the store of a run before, by a model that may not be asked."""
    store = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    remove_at_end(spark, store)
    answers.ask(documents(spark, d), lambda: lambda text: "答：" + text, store)
    again = answers.ask(documents(spark, d), _never, store, attempts=1)
    return again.select("doc_id", F.md5(F.col("model_text").cast("binary")).alias("text_md5"), "model_ok")


@query
def clean_run_report(spark, d):
    """Every line of a cleaning run's report."""
    return report.clean_report(driver.clean_documents(documents(spark, d)))


def _records(spark, d):
    """One record for each order, as if it were a file."""
    o = F.col("o_orderkey")
    status = F.when(o % 11 == 0, "failed").when(o % 7 == 0, "skipped (exists)").otherwise("ok")
    n = lambda k: (o % k).cast("long")
    return read_table(spark, d, "orders").select(
        F.format_string("f%010d.x", "o_orderkey").alias("file"), F.when(o % 3 == 0, "pdf").otherwise("doc/docx").alias("kind"), status.alias("status"), F.when(o % 11 == 0, F.lit("a|b")).alias("error"),
        n(13).alias("n_chars"), n(5).alias("pages"), n(4).alias("tables"), n(6).alias("images"), n(3).alias("model_calls"), n(2).alias("model_ok"), (n(3) - n(2)).alias("model_failed"),
    )


@query
def extraction_totals(spark, d):
    return report.extraction_totals(_records(spark, d))


@query
def extraction_report(spark, d):
    return report.extraction_report(_records(spark, d))


@query
def page_totals(spark, d):
    """Figures of files from those of their pages: line items are pages of their order."""
    item = read_table(spark, d, "lineitem")
    n = lambda k: (F.col("l_partkey") % k).cast("long")
    pages = item.select(F.col("l_orderkey").alias("file"), (F.col("l_linenumber") % 3 + 1).alias("tier"), n(3).alias("tables"), n(5).alias("images"), n(2).alias("model_calls"))
    found = report.page_totals(pages)
    tiers = F.array_join(F.transform(F.map_entries("tier_pages"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))), ",")
    return found.select("file", "pages", "tables", "images", "model_calls", tiers.alias("tiers"))


@query
def page_report(spark, d):
    issues = integrity.check_pages(integrity.index_refs(_index_lines(spark, d)), _page_map(spark, d).select("norm", "label", "page"))
    return report.page_report(issues)


@query
def run_outcome(spark, d):
    issues = integrity.check_pages(integrity.index_refs(_index_lines(spark, d)), _page_map(spark, d).select("norm", "label", "page"))
    return report.outcome(issues)


@query
def norm_warnings(spark, d):
    """Norms without a source, without body files, or without a label."""
    docs = documents(spark, d).select(F.col("doc_id").cast("string").alias("norm"), "doc_id")
    labels = _page_map(spark, d).select(F.col("norm").cast("string").alias("norm"))
    return report.missing_norms(docs, docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 7 <> 0"), labels)


def _file_refs(spark, d):
    """Index lines that give the pages of body files, some of them wrong."""
    labels = _page_map(spark, d)
    body = labels.select("norm", "label", (F.col("pos") % 3).cast("string").alias("stem"))
    ranges = integrity.body_page_ranges(body, labels.select("norm", "label", "page"))
    end = F.col("end_page") + F.col("norm").cast("int") % 2
    line = F.format_string("- %s（第%d～%d页）", "stem", "start_page", end)
    return body, ranges.select("norm", F.lit("r-index.md").alias("index_path"), F.col("stem").cast("int").alias("pos"), line.alias("line"))


@query
def file_ranges_check(spark, d):
    """References to files whose pages differ from those of their labels."""
    body, refs = _file_refs(spark, d)
    pages = _page_map(spark, d).select("norm", "label", "page")
    found = integrity.check_pages(integrity.index_refs(refs), pages, integrity.body_page_ranges(body, pages))
    return found.select("norm", F.col("label").alias("stem"), "kind", "old_start", "old_end", "start", "end")


@query
def file_ranges_fix(spark, d):
    body, refs = _file_refs(spark, d)
    return driver.fix_index(refs, _page_map(spark, d).select("norm", "label", "page"), body).select("norm", "pos", "line", "changed")


def _linked(spark, d):
    """Index lines of documents with links to three files, of which one isn't there for odd documents."""
    docs = documents(spark, d).select(F.col("doc_id").alias("norm"))
    line = F.concat(F.lit("见 [甲](a.md)、[乙](b/c.md#x) 与 [网](https://example.com/a.md)，[丙](d"), F.col("norm").cast("string"), F.lit(".md)"))
    return docs.select("norm", F.lit("i-index.md").alias("index_path"), F.lit(0).alias("pos"), line.alias("line"))


@query
def dead_links(spark, d):
    docs = documents(spark, d).select(F.col("doc_id").alias("norm"))
    names = F.array(F.lit("a.md"), F.when(F.col("norm") % 2 == 0, "b/c.md"), F.when(F.col("norm") % 3 == 0, F.concat(F.lit("d"), F.col("norm").cast("string"), F.lit(".md"))))
    return integrity.dead_links(_linked(spark, d), docs.select("norm", F.explode(F.filter(names, lambda x: x.isNotNull())).alias("path")))


@query
def missing_references(spark, d):
    """Languages as norms: each source cites all, links to itself and to en."""
    docs = read_table(spark, d, "documents")
    norms = docs.select(F.col("lang").alias("norm")).where("norm is not null").distinct()
    cited = docs.select(F.col("source"), F.col("lang").alias("norm")).where("norm is not null and source is not null")
    return integrity.missing_references(cited, cited.select("source").distinct().withColumn("norm", F.lit("en")), norms)


@query
def citation_targets(spark, d):
    """Cited articles with the page where each stands in its norm."""
    cited = reg(spark, d).where("pos % 4 = 0").select(F.concat(F.lit("规范"), F.col("doc_id").cast("string")).alias("norm"), F.concat(F.lit("第 "), F.expr("cast(pos div 4 as string)"), F.lit(" 条")).alias("article"), "pos")
    pages = _page_map(spark, d).select(F.concat(F.lit("规范"), F.col("norm").cast("string")).alias("norm"), "label", "page")
    return integrity.resolve_citations(cited, pages)


@query
def long_document_scan(spark, d):
    """All documents as one long one, taken in blocks: page and table of each line."""
    one = reg(spark, d).select(F.lit("all").alias("doc_id"), (F.col("doc_id") * 1000000 + F.col("pos")).alias("pos"), "line")
    paged = lines.with_pages(one, block=1 << 22)
    return split.table_islands(paged, ["doc_id"], block=1 << 22).select("doc_id", "pos", "page", "table_no")


@query
def long_document_tables(spark, d):
    """Tables of all documents as one long one, taken in blocks."""
    one = rich(spark, d).select(F.lit("all").alias("doc_id"), (F.col("doc_id") * 1000000 + F.col("pos")).alias("pos"), "line")
    return split.table_spans(lines.with_pages(one, block=1 << 22), block=1 << 22)


def prefaced(spark: SparkSession, d: str, line) -> DataFrame:
    """Lines of the dressed documents after one more."""
    return reg(spark, d).unionByName(documents(spark, d).where("text is not null").select("doc_id", F.lit(-1).alias("pos"), line.alias("line")))


@query
def content_pages(spark, d):
    """Pages of lines, where a marker before the first part doesn't count."""
    found = structure.structure_lines(prefaced(spark, d, F.lit("<!-- 第 5 页 -->")), origin="content")
    return found.select("doc_id", "pos", "page", "chapter_id")


@query
def title_lines(spark, d):
    """Structure of documents that begin with their own title: a heading that would be a part but for the document's name."""
    title = F.lit("医疗器械管理规范附则")
    found = structure.structure_lines(prefaced(spark, d, F.concat(F.lit("# "), title)), name=title)
    return found.select("doc_id", "pos", "page", "chapter_id")


def stored_index(spark: SparkSession, d: str) -> str:
    """The folder of an inverted index of the documents: those of even numbers first, the others appended."""
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    docs = documents(spark, d)
    postings.add(docs.where("doc_id % 2 = 0"), path)
    postings.add(docs, path)
    remove_at_end(spark, path)
    return path


def first_words(spark: SparkSession, d: str, n: int) -> DataFrame:
    """Queries of the first words of each benchmark item."""
    items = read_table(spark, d, "benchmark")
    return items.select(F.col("item_id").alias("query_id"), F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), 1, n), " ").alias("text"))


@query
def index_terms(spark, d):
    """Every term of the stored index, how many documents hold it and how often."""
    return postings.term_counts(spark, stored_index(spark, d))


@query
def index_search(spark, d):
    """Documents with all of the first five words of a benchmark item."""
    found = postings.search(spark, stored_index(spark, d), first_words(spark, d, 5))
    return found.select("query_id", F.col("key").alias("doc_id"), "hits", F.round("score", 6).alias("score"))


@query
def index_phrases(spark, d):
    """Documents where the first three words of a benchmark item follow each other."""
    found = postings.search(spark, stored_index(spark, d), first_words(spark, d, 3), phrase=True)
    return found.select("query_id", F.col("key").alias("doc_id"), "hits", F.round("score", 6).alias("score"))


@query
def keyword_search(spark, d):
    return integrity.keyword_search(documents(spark, d), ["the", "and"])


@query
def norm_anti(spark, d):
    """Norms that have summaries and no line that still asks for one."""
    marks = F.when(F.col("toxic") == 1, F.lit(P.SUMMARY_TODO)).otherwise(F.lit("- **第一条**：主题"))
    rows = read_table(spark, d, "labels").join(read_table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id").where("lang is not null")
    return integrity.norms_without_todo(rows.select(F.concat_ws("-", "lang", F.col("doc_id").cast("string")).alias("norm"), marks.alias("line")))


@query
def modal_cols(spark, d):
    """How often each number of columns is the usual one of a grid."""
    s = Q.score_table(F.col("grid"), F.lit(0.5))
    return _grids(spark, d).select(s["cols"].alias("cols")).groupBy("cols").agg(F.count("*").alias("n"))


@query
def table_candidates(spark, d):
    """Table candidates of pages: strict ones before loose ones, accepted by their score."""
    mode = F.when(F.col("l_orderkey") % 2 == 0, "loose").otherwise(F.when(F.col("l_orderkey") % 3 == 0, "strict").otherwise("loose"))
    side = (F.col("l_orderkey") % 10 * 10).cast("double")
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("top"), side.alias("x1"), F.lit(100.0).alias("bottom"))
    rows = _grids(spark, d).select((F.col("l_orderkey") / 4).cast("long").alias("doc_id"), F.lit(1).alias("page_no"), "l_orderkey", mode.alias("mode"), F.col("grid").alias("data"), box.alias("bbox"), F.lit(10000.0).alias("page_area"))
    return layout.accept_tables(rows).select("l_orderkey", "mode", F.col("s.rows").alias("rows"), "accepted")


@query
def box_dedup(spark, d):
    """How many boxes remain on each page when those that agree to a unit are one."""
    x = F.round(F.col("l_quantity").cast("double") / 4, 0)
    box = F.struct((x + 0.2).alias("x0"), F.lit(1.4).alias("top"), (x + 1.1).alias("x1"), F.lit(9.0).alias("bottom"))
    boxes = read_table(spark, d, "lineitem").select("l_orderkey", box.alias("bbox"))
    return layout.distinct_boxes(boxes, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query
def cell_spans(spark, d):
    """Merged cells of order grids: first place and spans."""
    item = read_table(spark, d, "lineitem")
    cells = item.select("l_orderkey", F.col("l_linenumber").alias("r"), (F.col("l_linenumber") % 2).alias("c"), (F.col("l_partkey") % 2).alias("cell_id"), (F.col("l_partkey") % 2).cast("string").alias("text"))
    return layout.cell_spans(cells, ["l_orderkey"])


@query
def page_assembly(spark, d):
    """Parts of a page in order, blank ones left out."""
    parts = read_table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("ord"), F.when(F.col("l_partkey") % 4 == 0, "").otherwise(F.col("l_partkey").cast("string")).alias("part"))
    return layout.assemble_page(parts, ["l_orderkey"])


@query
def blank_runs(spark, d):
    """Lines with runs of blank ones as one: every third line is blanked."""
    spaced = lines.explode_lines(documents(spark, d)).withColumn("line", F.when(F.col("pos") % 5 > 2, F.lit(" ")).otherwise(F.col("line")))
    return lines.collapse_blanks(spaced).select("doc_id", "pos", "line")


@query
def provenance_fill(spark, d):
    """同上 and blanks take the value above: turns of a conversation as rows of its provenance."""
    talk = read_table(spark, d, "conversations")
    rows = talk.select(F.col("conv_id").alias("answer_id"), F.col("turn").cast("int").alias("seq"), F.when(F.col("turn") % 3 == 0, F.concat(F.lit("p"), F.col("turn").cast("string"))).when(F.col("turn") % 3 == 1, "同上").otherwise("").alias("path"))
    return qa.fill_down(rows, ["path"])


@query
def provenance_pages(spark, d):
    """Provenance rows whose page isn't that of the catalog."""
    pages = _page_map(spark, d)
    cited = pages.select("norm", "label", (F.col("page") + F.expr("pos div 4").cast("int") % 2).alias("cited_page"))
    return qa.wrong_pages(cited, pages.select("norm", "label", "page")).select("norm", "label", "cited_page", "page")


@query
def topic_labels(spark, d):
    """Labels of topics, and where and under what name a chapter's files lie."""
    part = read_table(spark, d, "part")
    n = F.col("p_size").cast("string")
    article, clause, other = F.concat(F.lit("第 "), n, F.lit(" 条 x")), F.concat(n, F.lit(".1.2正文")), F.concat(F.col("p_name"))
    chapter = F.concat(F.lit("第 "), n, F.lit(" 章 "), F.col("p_name"))
    return part.select("p_partkey", T.article_label(article).alias("article"), T.article_label(clause).alias("clause"), T.article_label(other).alias("word"), T.chapter_dir(chapter).alias("dir"), T.chapter_stem(chapter).alias("stem"))


@query
def paragraphs_markdown(spark, d):
    """Lines of each document as Markdown paragraphs with guessed headings."""
    lined = F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(F.when(i % 6 == 0, F.concat(F.lit("第"), (i + 1).cast("string"), F.lit("章 ")))  .otherwise(F.lit("")), x))
    return documents(spark, d).select("doc_id", T.paragraphs_to_md(lined).alias("text"))


@query
def prompt_messages(spark, d):
    """Chat messages of each benchmark item, as JSON."""
    return read_table(spark, d, "benchmark").select("item_id", F.to_json(T.chat_messages(F.lit("清洗"), F.col("text"))).alias("messages"))


@query
def verdict_classes(spark, d):
    """Excerpts of every document, right, under another article, misspelt or turned round, judged by the passages of all documents."""
    docs = documents(spark, d).withColumn("path", F.col("doc_id").cast("string"))
    parts = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    lined = docs.select("path", F.explode(parts).alias("l")).select("path", F.expr("l.i div 6 + 1").alias("n"), F.struct("l.i", "l.x").alias("l"))
    grouped = lined.groupBy("path", "n").agg(F.array_sort(F.collect_list("l")).alias("l"))
    passages = grouped.select("path", F.concat(F.lit("第"), F.col("n").cast("string"), F.lit("条")).alias("article"), F.array_join(F.transform("l", lambda x: x["x"]), "\n").alias("text"))
    kind, start = F.col("doc_id") % 4, F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 80)
    excerpt = F.when(kind == 2, F.regexp_replace(start, "(.{17})e", "$1ea")).when(kind == 3, F.reverse(start)).otherwise(start)
    cited = docs.select(F.col("doc_id").alias("answer_id"), F.lit(1).alias("seq"), "path", F.when(kind == 1, "第2条").otherwise("第1条").alias("article"), excerpt.alias("excerpt"))
    return qa.verdicts(cited, passages)


@query
def page_overlap(spark, d):
    """Pages of every document that more than one body file holds."""
    s = structure.structure_lines(reg(spark, d))
    files = split.split_chunks(s, ["doc_id", "chapter_id"]).where("not is_table")
    pages = files.select("doc_id", "chapter_id", "part_no", F.explode(F.sequence("start_page", "end_page")).alias("page"))
    return pages.groupBy("doc_id", "chapter_id", "page").agg(F.count("*").alias("files")).where("files > 1")


def _citing(spark, d):
    """Body lines of the dressed documents as norms; articles cite one another and the next document, other lines what stands before them."""
    i, norm = F.expr("pos div 4"), F.col("doc_id").cast("string")
    following = F.concat(F.lit("《"), (F.col("doc_id") + 1).cast("string"), F.lit("》第 2 条"))
    cites = F.when(i % 8 == 5, F.concat(F.lit(" 见"), following, F.when(F.col("doc_id") % 6 == 0, "、前条").otherwise(F.lit("")), F.when(i % 16 == 13, "、第 10 条").otherwise(F.lit(""))))
    cites = cites.when(i == 1, F.lit(" 见第 6 条")).when(i % 8 == 1, F.lit(" 见前条")).when(i % 4 == 2, F.lit(" 按前款、本条和本章")).otherwise(F.lit(""))
    return reg(spark, d).where("pos % 4 = 0").select(norm.alias("norm"), "pos", F.concat("line", cites).alias("line"))


@query
def citation_graph(spark, d):
    """Every citation of the norms with its target, by name or by position; paragraph 0 where it cites none."""
    return citations.references(_citing(spark, d)).withColumn("target_paragraph", F.coalesce("target_paragraph", F.lit(0).cast("long")))


@query
def citation_reach(spark, d):
    """What each article leads to in at most three citations."""
    cited = _citing(spark, d)
    return citations.reachable(citations.article_links(citations.references(cited)), citations.articles(cited), 3)
