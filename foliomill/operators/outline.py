"""Outlines: which article and clause labels occur, and on which page first; and the index lines made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import predicates as Q
from ..functions import text as T


def line_labels(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines that name a label, with it; lines of a table of contents and those before the body don't count."""
    d = lines.withColumn("_title", T.normalize_title(T.group(F.col("line"), "(?U)" + P.HEADING, 2)))
    d = d.withColumn("_text", T.body_after_marker(F.col("line")))
    title, body, heading = F.col("_title"), F.col("_text"), F.col("_title").isNotNull()
    article = lambda c: T.group(c, "(?U)" + P.ARTICLE, 0)
    clause = lambda c: T.group(c, "(?U)" + P.CLAUSE_NUMBER)
    noise = Q.is_toc_noise(F.col("line")) | (T.strip(F.col("line")) == "")
    in_title = F.coalesce(article(title), clause(title), T.group(title, "(?U)" + P.GUIDE_TITLE))
    in_body = F.coalesce(T.sub(T.strip(article(body)), "[:：]+$", ""), clause(body), T.group(body, "(?U)" + P.GUIDE_CLAUSE))
    d = d.withColumn("_label", F.when(noise, None).when(heading, in_title).otherwise(in_body))
    chapter = heading & title.rlike("(?U)" + P.CHAPTER) & ~noise
    # the body begins at the first chapter, article or numbered line; a clause number alone doesn't begin it
    begins = chapter | F.when(heading, F.col("_label").isNotNull()).otherwise(body.rlike("(?U)" + P.ARTICLE) | body.rlike("(?U)" + P.GUIDE_CLAUSE)) & ~noise
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_body", F.max(begins.cast("int")).over(upto))
    return d.where("_body = 1 and _label is not null and _label <> ''").withColumn("label", F.col("_label")).drop("_label", "_body", "_title", "_text")


def outline(paged: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, label, page and pos of each label's first line."""
    found = line_labels(paged, key).groupBy(key, "label")
    return found.agg(F.min_by("page", "pos").alias("page"), F.min("pos").alias("pos"))


def file_index(entries: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and index text: the catalog of labels, then a line for each summary to be written."""
    rows = entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "label", "page"))).alias("e"))
    catalog = F.array_join(F.transform("e", lambda x: T.catalog_line(x["label"], x["page"])), "\n")
    summary = F.array_join(F.transform("e", lambda x: T.summary_line(x["label"], x["page"])), "\n")
    return rows.select(key, F.concat(catalog, F.lit("\n\n"), summary, F.lit("\n")).alias("text"))


def body_index(stem: Column, title: Column, entries: Column, start: Column, end: Column, part: Column, parts: Column, merged: Column) -> Column:
    """The index of a body file: its catalog (title, titles merged in it, labels, place among the parts) and summaries to be written.

    ``entries`` is an array of struct(label, page), ``merged`` one of titles or null.
    """
    line = lambda *c: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in c])
    nothing = F.array().cast("array<string>")
    titles = F.transform(merged, lambda t: line("    - ", T.slug_title(t)))
    note = F.when(merged.isNull(), nothing).otherwise(F.concat(F.array(F.lit("  - （合并块，含以下二级标题）")), titles, F.array(F.lit(f"  - **文件名**：{P.NAME_TODO}"))))
    place = F.when(parts > 1, F.array(F.format_string("- 拆分段：第 %d 段，共 %d 段", part, parts))).otherwise(nothing)
    catalog = F.concat(F.array(line("- ", T.slug_title(title))), note, F.transform(entries, lambda e: T.catalog_line(e["label"], e["page"])), place)
    todo = F.when(merged.isNull(), F.lit(P.SUMMARY_TODO)).otherwise(F.lit(P.NAME_TODO))
    whole = F.array(line("- **", stem, "**（", T.page_range(start, end), "）：", todo))
    summaries = F.concat(F.transform(entries, lambda e: T.summary_line(e["label"], e["page"])), F.when((F.size(entries) == 0) | merged.isNotNull(), whole).otherwise(nothing))
    return line("# ", stem, "索引\n\n## 条目录\n\n", F.array_join(catalog, "\n"), "\n\n## 条文摘要\n\n", F.array_join(summaries, "\n"), "\n")


def document_index(name: Column, chapters: Column, files: Column, labels: Column) -> Column:
    """The index of a document: its chapters with their sections (a flat one's labels), its files and their summaries to be written.

    chapters: array of struct(title, sections), files: array of struct(stem, start_page, end_page), labels: array of struct(label, page).
    """
    line = lambda *c: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in c])
    tree = F.flatten(F.transform(chapters, lambda c: F.concat(F.array(line("- ", T.slug_title(c["title"]))), F.transform(c["sections"], lambda s: line("  - ", T.slug_title(s))))))
    flat = F.transform(labels, lambda e: F.trim(T.catalog_line(e["label"], e["page"])))
    head = F.when(F.size(chapters) > 0, F.concat(F.array(F.lit("## 章节目录"), F.lit("")), tree)).when(F.size(labels) > 0, F.concat(F.array(F.lit("## 条目录"), F.lit("")), flat)).otherwise(F.array(F.lit("## 章节目录"), F.lit("")))
    pages = lambda f: T.page_range(f["start_page"], f["end_page"])
    listed = F.transform(files, lambda f: line("- ", f["stem"], "（", pages(f), "）"))
    summaries = F.transform(files, lambda f: line("- **", f["stem"], "**（", pages(f), "）：", P.SUMMARY_TODO))
    return line("# ", name, "索引\n\n", F.array_join(head, "\n"), "\n\n## 文件目录\n\n", F.array_join(listed, "\n"), "\n\n## 各文件摘要\n\n", F.array_join(summaries, "\n"), "\n")


def root_index(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and the catalog of a document's body files (title, start_page, end_page, ord)."""
    line = F.concat(F.lit("- "), F.col("title"), F.lit("（"), T.page_range(F.col("start_page"), F.col("end_page")), F.lit("）"))
    rows = files.select(key, F.struct("ord", line.alias("line")).alias("x")).groupBy(key).agg(F.array_sort(F.collect_list("x")).alias("x"))
    return rows.select(key, F.array_join(F.transform("x", lambda x: x["line"]), "\n").alias("text"))
