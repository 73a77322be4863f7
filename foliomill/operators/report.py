"""Run reports: totals, and reports as Markdown lines (part, ord, line) in that order.

A report has a line for each file of a run, so it is a table like any other and
never one string; only a norm's own part, which lists at most 200 issues, is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..session import cut
from .driver import split_flag
from .rules import COUNTERS


def page_totals(pages: DataFrame, key: str = "file") -> DataFrame:
    """Figures of each file from those of its pages (tier, tables, images, model_calls), with the pages of each tier as a map."""
    tiers = pages.groupBy(key, "tier").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("tables", "images", "model_calls")])
    return tiers.groupBy(key).agg(
        F.sum("n").alias("pages"), *[F.sum(c).alias(c) for c in ("tables", "images", "model_calls")],
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", "n")))).alias("tier_pages"),
    )


SUMS = ("pages", "tables", "images", "model_calls", "model_ok", "model_failed")


def _extraction_figures() -> list[Column]:
    is_ = lambda s: F.count_if(F.col("status") == s).alias
    return [
        F.count("*").alias("files"), is_("ok")("ok"), F.count_if(F.col("status").startswith("skipped")).alias("skipped"), is_("failed")("failed"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS],
    ]


def extraction_totals(records: DataFrame) -> DataFrame:
    """One row: files by status (ok, failed, any kind of skipped) and the sums of their figures."""
    return records.agg(*_extraction_figures())


def observed(rows: DataFrame, name: str, *figures: Column) -> tuple[DataFrame, DataFrame]:
    """rows, stored by one pass over what they are made of, and one row of figures that was taken while they were written."""
    seen = Observation(name)
    kept = cut(rows.observe(seen, *figures), name)
    return kept, rows.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in seen.get.items()])


def _cells(*columns: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns]), F.lit(" |"))


def _head(part: int, totals: DataFrame, lines: list[Column | str]) -> DataFrame:
    """Lines made of one row of totals."""
    made = F.array(*[x if isinstance(x, Column) else F.lit(x) for x in lines])
    return totals.select(F.lit(part).alias("part"), F.posexplode(made).alias("n", "line")).select("part", F.format_string("%06d", "n").alias("ord"), "line")


def _rows(part: int, rows: DataFrame, order: Column, line: Column) -> DataFrame:
    return rows.select(F.lit(part).alias("part"), order.cast("string").alias("ord"), line.alias("line"))


def _table(part: int, totals: DataFrame, title: str, heads: tuple[str, ...], rows: DataFrame, order: Column, cells: list[Column]) -> DataFrame:
    """A table with its title; nothing without rows."""
    rule = "| " + " | ".join(["---"] * len(heads)) + " |"
    some = totals.join(rows.limit(1).select(F.lit(1)), how="left_semi")
    return _head(part, some, ["", f"## {title}", "", "| " + " | ".join(heads) + " |", rule]).unionByName(_rows(part + 1, rows, order, _cells(*cells)))


def extraction_report(records: DataFrame) -> DataFrame:
    """The report of an extraction run over records (file, kind, status, error, n_chars, SUMS)."""
    records, t = observed(records, "extraction-records", *_extraction_figures())
    n = lambda c: F.col(c).cast("string")
    head = _head(0, t, [
        "# 文档提取运行报告", "", "## 总览", "", "| 指标 | 数值 |", "| --- | --- |",
        *[_cells(F.lit(name), n(c)) for name, c in (("处理文件总数", "files"), ("✓ 成功", "ok"), ("↷ 跳过", "skipped"), ("✗ 失败", "failed"), ("PDF 总页数", "pages"), ("提取表格总数", "tables"), ("抽取图片总数", "images"))],
        _cells(F.lit("多模态调用"), F.concat(n("model_calls"), F.lit(" 次（成功 "), n("model_ok"), F.lit(" / 失败 "), n("model_failed"), F.lit("）"))),
    ])
    name = T.md_escape(F.col("file"))
    pdf = _table(1, t, "PDF 文件明细", ("文件", "状态", "页数", "表格", "图片", "多模态调用", "输出字符"), records.where("kind = 'pdf'"), F.col("file"), [name, F.col("status"), *[F.col(c) for c in ("pages", "tables", "images", "model_calls", "n_chars")]])
    doc = _table(3, t, "DOC / DOCX 文件明细", ("文件", "状态", "输出字符"), records.where("kind <> 'pdf'"), F.col("file"), [name, F.col("status"), F.col("n_chars")])
    failed = _table(5, t, "失败文件", ("文件", "错误"), records.where("status = 'failed'"), F.col("file"), [name, T.md_escape(F.col("error"))])
    return head.unionByName(pdf).unionByName(doc).unionByName(failed)


RULE_NAMES = (
    ("删除页脚页码行", "page_numbers_removed"), ("修复「第X条」空格", "article_spaces_fixed"), ("修复「第X章」空格", "chapter_spaces_fixed"),
    ("修复「第X节/项」空格", "section_spaces_fixed"), ("规范为一级标题（第X章）", "h1_normalized"), ("规范为二级标题（第X节 / X.X）", "h2_normalized"),
    ("降为正文（第X条 / X.X.X / 误标标题）", "headings_demoted"), ("去除短串错误加粗", "bold_short_removed"), ("去除法条编号错误加粗", "bold_removed"),
    ("修复中文之间多余空格", "cjk_gaps_removed"), ("合并 PDF 硬换行", "lines_merged"), ("压缩多余空行", "blank_lines_removed"),
)


def clean_report(cleaned: DataFrame, key: str = "doc_id") -> DataFrame:
    """The report of a cleaning run over the rows of ``driver.clean_documents``."""
    sums = ("chars_before", "chars_after", "chunks", "chunks_ok", "chunks_failed", "tables_recovered", *COUNTERS)
    figures = (F.count("*").alias("files"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"), *[F.coalesce(F.sum(c), F.lit(0)).cast("string").alias(c) for c in sums])
    cleaned, t = observed(cleaned.select(key, "status", "error", *sums), "cleaned", *figures)
    head = _head(0, t, [
        "# Markdown 清洗运行报告", "", "## 总览", "", "| 指标 | 数值 |", "| --- | --- |",
        *[_cells(F.lit(name), F.col(c)) for name, c in (("文件总数", "files"), ("✓ 成功", "ok"), ("✗ 失败", "failed"), ("总字符（清洗前）", "chars_before"), ("总字符（清洗后）", "chars_after"))],
        _cells(F.lit("LLM chunk 调用"), F.concat("chunks_ok", F.lit("/"), "chunks", F.lit("（失败 "), "chunks_failed", F.lit("）"))), _cells(F.lit("LLM 恢复表格数"), F.col("tables_recovered")),
        "", "## 本地规则命中（累计）", "", "| 规则 | 命中次数 |", "| --- | --- |", *[_cells(F.lit(name), F.col(c)) for name, c in RULE_NAMES],
    ])
    hits = F.lit(0)
    for c in COUNTERS:
        hits = hits + F.coalesce(F.col(c), F.lit(0))
    change = F.col("chars_after") - F.col("chars_before")
    chunks = F.concat(F.col("chunks_ok").cast("string"), F.lit("/"), F.col("chunks").cast("string"))
    order = F.format_string("%020d", key) if dict(cleaned.dtypes)[key] in ("int", "bigint") else F.col(key)
    files = _table(1, t, "文件明细", ("文件", "状态", "本地规则命中", "LLM chunks", "恢复表格", "清洗前字符", "清洗后字符", "变化"), cleaned, order, [T.md_escape(F.col(key).cast("string")), F.col("status"), hits, chunks, F.col("tables_recovered"), F.col("chars_before"), F.col("chars_after"), change])
    failed = _table(3, t, "失败文件", ("文件", "错误"), cleaned.where("status = 'failed'"), order, [T.md_escape(F.col(key).cast("string")), T.md_escape(F.col("error"))])
    return head.unionByName(files).unionByName(failed)


def split_report(indexes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The report of a split run over the indexes of ``driver.split_documents``; suspicious ratios are marked."""
    indexes, t = observed(indexes.select(key, "chapters", "files", "src_lines", "body_lines"), "split-indexes", F.count("*").alias("n"))
    d = split_flag(indexes)
    # in whole hundredths of a percent, halves up: a ratio in doubles lies on either side of a half
    share = F.coalesce(F.expr("(body_lines * 20000L + src_lines) div nullif(2L * src_lines, 0L)"), F.lit(0))
    shown = F.concat(F.format_string("%d.%02d%%", F.floor(share / 100), share % 100), F.when(F.col("flag"), F.lit(" [!]")).otherwise(F.lit("")))
    heads = "| 源文件 | 章数 | 正文文件数 | 源行数 | 拆分行数 | 差值 | 比值 |"
    head = _head(0, t, ["# Wiki 批量拆分报告", "", F.format_string("- 成功：%d 份", "n"), "", heads, "| --- | ---: | ---: | ---: | ---: | ---: | ---: |"])
    order = F.format_string("%020d", key) if dict(indexes.dtypes)[key] in ("int", "bigint") else F.col(key)
    return head.unionByName(_rows(1, d, order, _cells(F.col(key), *[F.col(c) for c in ("chapters", "files", "src_lines", "body_lines")], F.format_string("%+d", "diff"), shown)))


def missing_norms(norms: DataFrame, sources: DataFrame, bodies: DataFrame, page_map: DataFrame) -> DataFrame:
    """norm and warning: no source, no body files, or (with both) no label in the source."""
    d = norms.select("norm").distinct()
    for name, other in (("_source", sources), ("_body", bodies), ("_label", page_map)):
        d = d.join(other.select("norm").distinct().withColumn(name, F.lit(1)), "norm", "left")
    warning = F.when(F.col("_source").isNull(), F.concat(F.lit("缺少 raw/"), "norm", F.lit(".md"))).when(F.col("_body").isNull(), F.concat(F.lit("缺少 wiki/"), "norm", F.lit("/")))
    warning = warning.when(F.col("_label").isNull(), F.concat("norm", F.lit(": raw 未解析到条号/小节（指南类或结构特殊）")))
    return d.select("norm", warning.alias("warning")).where("warning is not null")


def page_report(issues: DataFrame) -> DataFrame:
    """norm and its part of the page check's report: issues with their changes, at most 200 rows, and how many more."""
    order = Window.partitionBy("norm").orderBy("index_path", "pos", "label")
    old = F.when(F.col("old_end").isNull(), F.col("old_start").cast("string")).otherwise(F.concat(F.col("old_start").cast("string"), F.lit("～"), F.col("old_end").cast("string")))
    new = F.when(F.col("end").isNull(), F.col("start").cast("string")).otherwise(F.concat(F.col("start").cast("string"), F.lit("～"), F.col("end").cast("string")))
    line = _cells(F.col("kind"), F.col("label"), F.concat(F.lit("`"), "index_path", F.lit("`")), old, new)
    d = issues.withColumn("_n", F.row_number().over(order)).withColumn("_line", F.when(F.col("_n") <= P.REPORT_ROWS, F.struct("_n", line.alias("l"))))
    deltas = F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.col("old_end").isNull(), F.col("delta")))), lambda x: x.cast("string")), ", ")
    one = d.groupBy("norm").agg(F.count("*").alias("n"), deltas.alias("d"), F.array_sort(F.collect_list("_line")).alias("x"))
    title = F.concat(F.lit("## "), F.col("norm").cast("string"), F.format_string("（%d 处）", "n"), F.when(F.col("d") != "", F.concat(F.lit("（条号 delta: ["), "d", F.lit("]）"))).otherwise(F.lit("")))
    rest = F.when(F.col("n") > P.REPORT_ROWS, F.format_string("\n\n… 另有 %d 处", F.col("n") - P.REPORT_ROWS)).otherwise(F.lit(""))
    return one.select("norm", F.concat(title, F.lit("\n\n| 类型 | 标签 | index | 当前 | 应为 |\n| --- | --- | --- | --- | --- |\n"), F.array_join(F.transform("x", lambda x: x["l"]), "\n"), rest).alias("text"))


def outcome(issues: DataFrame) -> DataFrame:
    """One row: n issues and whether the run is to be taken as failed (``exit_code`` 1)."""
    return issues.agg(F.count("*").alias("n")).select("n", F.when(F.col("n") > 0, 1).otherwise(0).alias("exit_code"))


def text_of(report: DataFrame) -> DataFrame:
    """The lines of a report in order, ready for ``write.text``."""
    return report.orderBy("part", "ord").select(F.col("line").alias("value"))
