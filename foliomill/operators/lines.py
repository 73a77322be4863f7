"""Documents to lines and pages. ``pos`` carries the order of lines, always."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from .scan import looking_back, running


def split_lines(text: Column, universal: bool = False) -> Column:
    """Lines of a text: by newline, or by every line break with a final empty line dropped."""
    if not universal:
        return F.split(text, "\n", -1)
    parts = F.split(text, P.LINE_BREAKS, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def explode_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", universal: bool = False) -> DataFrame:
    """key, pos, line. Null texts have no lines."""
    return docs.select(key, F.posexplode(split_lines(F.col(text), universal)).alias("pos", "line"))


def by_line(key: str = "doc_id") -> Window:
    return Window.partitionBy(key).orderBy("pos")


def with_pages(lines: DataFrame, start: int = 1, origin: str = "document", key: str = "doc_id", first: Column | None = None, block: int | None = None) -> DataFrame:
    """Add the page of each line: a marker ends its page, and its own line is on the next.

    With origin ``content`` markers before the first content line (``first`` is
    true) don't count.  Long documents are taken in blocks (``scan.running``).
    """
    marker = T.page_of_marker(F.col("line"))
    if origin == "content" and first is not None:
        lines = running(lines, [key], block, _begun=("max", first.cast("int")))
        marker = F.when(F.coalesce(F.col("_begun"), F.lit(0)) == 1, marker)
    d = running(lines, [key], block, _seen=("max", marker + 1))
    return d.withColumn("page", F.greatest(F.lit(start), F.coalesce("_seen", F.lit(start)))).drop("_seen", "_begun")


def collapse_blanks(lines: DataFrame, key: str = "doc_id", block: int | None = None) -> DataFrame:
    """Runs of blank lines become one."""
    blank = T.strip(F.col("line")) == ""

    def mark(d: DataFrame, keys: list[str]) -> DataFrame:
        return d.withColumn("_drop", blank & F.lag(blank, 1, False).over(Window.partitionBy(*keys).orderBy("pos")))

    return looking_back(lines, [key], 1, mark, block).where("not _drop").drop("_drop")


def join_lines(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and text of the lines in their order."""
    rows = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l"))
    return rows.select(key, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def page_touches(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and pages: the sorted pages that the lines of each document touch.

    A marker line touches its own page, and the next one if text follows.
    """
    line = F.col("line")
    marked = T.page_of_marker(line)
    body = T.body_after_marker(line)
    touched = F.when(marked.isNotNull(), F.when(body != "", F.array(marked, marked + 1)).otherwise(F.array(marked))).when(T.strip(line) != "", F.array("page"))
    return lines.select(key, F.explode(touched).alias("p")).groupBy(key).agg(F.array_sort(F.collect_set("p")).alias("pages"))


def decorated(docs: DataFrame) -> DataFrame:
    """doc_id, pos, line: documents dressed as regulations, for exercising the operators.

    Every 12th line begins a chapter, others an article, a section, a gap or a
    table; page markers and page numbers come between.
    """
    i, raw = F.col("i"), F.col("raw")
    number = lambda n, of: (F.expr(f"i div {n}") + of).cast("string")
    line = (
        F.when(i % 12 == 0, F.concat(F.lit("# 第 "), number(12, 1), F.lit(" 章 "), raw))
        .when(i % 4 == 1, F.concat(F.lit("第 "), (i + 1).cast("string"), F.lit(" 条 "), raw))
        .when(i % 12 == 3, F.concat(F.lit("## "), number(12, 1), F.lit("."), (i % 12).cast("string"), F.lit(" "), raw))
        .when(i % 10 == 2, F.concat(F.lit("中 文 "), raw))
        .when(i % 9 == 8, F.concat(F.lit('<table border="1" ><tr><td>'), raw, F.lit("</td></tr></table>")))
        .otherwise(raw)
    )
    slot = lambda n, when, c: F.when(when, F.struct((i * 4 + n).cast("int").alias("pos"), c.alias("line")))
    always = F.lit(True)
    rows = F.array(slot(0, always, line), slot(1, i % 5 == 4, T.page_marker(F.expr("i div 5 + 1"))), slot(2, i % 7 == 6, i.cast("string")))
    source = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "raw"))
    return source.select("doc_id", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("doc_id", "r.pos", "r.line")


def dressed(docs: DataFrame) -> DataFrame:
    """doc_id, pos, line: documents dressed with what ``decorated`` lacks.

    A contents page, 一、 parts with （一） items, tables of three lines under a
    caption or a title, headings that are no part, page markers before text on
    one line, articles, clauses, an appendix, and every third document a tail
    heading near its end.  Every fifth document has no part at all.
    """
    i, raw, n = F.col("i"), F.col("raw"), F.col("n")
    short, group = F.substring(raw, 1, 30), F.expr("i div 9")
    flat = F.col("doc_id") % 5 == 4
    numeral = F.element_at(F.array(*[F.lit(x) for x in "一二三四五六七八九十"]), (group % 10 + 1).cast("int"))
    table = [F.lit("<table>"), F.concat(F.lit("<tr><td>"), raw, F.lit("</td></tr>")), F.lit("</table>")]
    made = (
        F.when(i == 0, F.array(F.lit("目录"), F.when(flat, "说明........1").otherwise("一、总则........1"), F.lit("")))
        .when(~flat & (i == n - 2), F.array(F.lit("附：样表"), raw))
        .when((i == n - 1) & (F.col("doc_id") % 3 == 0), F.array(F.lit("# 条文说明"), raw))
        .when(~flat & (i % 9 == 1), F.array(F.concat(numeral, F.lit("、"), short)))
        .when(i % 9 == 2, F.array(F.concat(F.lit("1."), i.cast("string"), F.lit(".3 "), raw)))
        .when(i % 9 == 3, F.array(F.concat(F.lit("（"), numeral, F.lit("）"), short), raw))
        .when(i % 18 == 5, F.array(F.lit("**表格（第2页）**"), *table))
        .when(i % 9 == 5, F.array(F.concat(F.lit("样表 "), i.cast("string")), *table))
        .when(i % 9 == 6, F.array(F.concat(F.lit("#### 说明"), i.cast("string")), raw))
        .when(i % 9 == 7, F.array(F.concat(F.lit("<!-- 第 "), (group + 1).cast("string"), F.lit(" 页 --> "), raw)))
        .when(i % 9 == 8, F.array(F.concat(F.lit("第"), i.cast("string"), F.lit("条 "), raw)))
        .otherwise(F.array(raw))
    )
    source = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "raw"), F.size(F.split("text", "\n", -1)).alias("n"))
    return source.select("doc_id", "i", F.posexplode(made).alias("k", "line")).select("doc_id", (F.col("i") * 4 + F.col("k")).cast("int").alias("pos"), "line")
