"""Scalar text functions as Column expressions; all run in the JVM.

``\\s`` and ``\\d`` of the text rules are Unicode classes, hence ``(?U)``.  Those
are slow to scan for, so rules that few lines meet look for a character that
they can't do without first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

NUMERALS = rf"{P.CN_NUM}\d"
#: Decimal digits of all other scripts, and what each stands for.
DIGITS = "".join(chr(c) for c in range(128, 0x110000) if unicodedata.category(chr(c)) == "Nd")
VALUES = "".join(str(unicodedata.decimal(c)) for c in DIGITS)
LEGAL = rf"第\s*([{NUMERALS}]+(?:\s+[{NUMERALS}]+)*)\s*"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated once, however often use names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """A capture group of the first match, or null where the pattern isn't found."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(n)), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(P.BLANKS))


def number(c: Column) -> Column:
    """A whole number in digits of any script; null for anything else and for numbers that an int can't count on from."""
    found = let(c, lambda x: F.when(x.rlike("^[0-9]*$"), x).otherwise(F.translate(x, DIGITS, VALUES)).try_cast("int"))
    return F.nullif(found, F.lit(2**31 - 1))


def clean_line(c: Column) -> Column:
    """Wide spaces to spaces, control characters dropped, runs of blanks to one, ends stripped."""
    c = F.translate(c, "　 ", "  ")
    c = sub(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return strip(sub(c, r"[ \t]+", " "))


def to_heading(c: Column, level: Column) -> Column:
    return F.concat(F.repeat(F.lit("#"), level), F.lit(" "), strip(c))


def page_marker(n: Column) -> Column:
    return F.format_string("<!-- 第 %d 页 -->", n)


def squeeze(c: Column) -> Column:
    """All white space removed."""
    return sub(c, r"(?U)\s+", "")


def fix_legal_spaces(c: Column, units: str = "条章节项") -> Column:
    """第 二十 一 条 to 第二十一条, however many numerals and blanks."""
    loose = F.lit(rf"(?U){LEGAL}[{units}]")

    def joined(x: Column) -> Column:
        tight = F.transform(F.regexp_extract_all(x, loose, F.lit(0)), squeeze)
        return F.array_join(F.zip_with(F.split(x, loose, -1), tight, lambda gap, y: F.concat(gap, F.coalesce(y, F.lit("")))), "")

    return let(c, lambda x: F.when(x.contains("第") & x.rlike(r"(?U)第[\s" + NUMERALS + r"]*\s"), joined(x)).otherwise(x))


def legal_space_hits(c: Column, unit: str) -> Column:
    """Matches of the rule, those that were tight already included."""
    return F.regexp_count(c, F.lit(rf"(?U){LEGAL}[{unit}]"))


BOLD_LEGAL, BOLD_SHORT = "(?U)" + P.BOLD_LEGAL, "(?U)" + P.BOLD_SHORT


def strip_bold(c: Column) -> Column:
    """Emphasis removed around legal numbers and around one or two characters."""
    return sub(sub(c, BOLD_LEGAL, "$1"), BOLD_SHORT, "$1")


def strip_heading_marks(c: Column) -> Column:
    return sub(c, r"(?U)^#{1,6}\s+", "")


def is_rule_chapter(c: Column) -> Column:
    return c.rlike(rf"(?U)^{LEGAL}章")


def is_rule_section(c: Column) -> Column:
    return c.rlike(rf"(?U)^{LEGAL}节") | (c.rlike(r"(?U)^\d+\.\d+(?:\s|[^\d.]|$)") & ~c.rlike(r"(?U)^\d+\.\d+\.\d+"))


def normalize_heading(c: Column) -> Column:
    """Chapters become #, sections ##, other marked lines plain text."""
    bare = strip(strip_heading_marks(strip(c)))
    return (
        F.when(strip(c) == "", c)
        .when(is_rule_chapter(bare), F.concat(F.lit("# "), bare))
        .when(is_rule_section(bare), F.concat(F.lit("## "), bare))
        .when(c.rlike(r"(?U)^#{1,6}\s+"), bare)
        .otherwise(c)
    )


def fix_cjk_gaps(c: Column) -> Column:
    return sub(sub(c, P.GAP_AFTER, "$1"), P.GAP_BEFORE, "$1")


def strip_inline_boilerplate(c: Column) -> Column:
    return sub(sub(c, P.RULE_HEADER, ""), P.ISSUED_PHRASE, "")


def compress_blank_lines(c: Column) -> Column:
    return sub(c, r"\n{3,}", "\n\n")


def paragraphs_to_md(lines: Column) -> Column:
    """An array of text lines as Markdown: cleaned, headings guessed, blank lines between all."""
    from .predicates import heading_level

    cleaned = F.filter(F.transform(lines, clean_line), lambda x: x != "")
    shown = F.transform(cleaned, lambda x: let(heading_level(x), lambda n: F.when(n.isNull(), x).otherwise(to_heading(x, n))))
    return F.array_join(shown, "\n\n")


def strip_code_fence(c: Column) -> Column:
    """The inside of a text that is one fenced block."""
    return F.coalesce(group(c, r"(?is)\A\s*```(?:markdown|md)?[ \t]*\n(.*?)\n?```\s*\z", 1), c)


def new_tables(before: Column, after: Column) -> Column:
    opened = lambda c: F.regexp_count(c, F.lit(r"(?i)<table\b"))
    return F.greatest(F.lit(0), opened(after) - opened(before))


def first_table(c: Column) -> Column:
    """The first table of a model's answer, with a border; empty if there is none."""
    bare = sub(sub(strip(c), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", "")
    table = F.regexp_extract(bare, r"(?is)(<table.*?</table>)", 1)
    marked = F.when(F.substring(table, 1, 80).contains("border="), table).otherwise(sub(table, r"(?i)^<table", '<table border="1"'))
    return F.when(table == "", F.lit("")).otherwise(marked)


def normalize_inline_ocr(c: Column) -> Column:
    def fixed(x: Column) -> Column:
        x = sub(sub(x, "(?U)" + P.OCR_NUMBER, r"\$$1.$2\$"), "(?U)" + P.OCR_STOP, "$1 的")
        return F.replace(x, *map(F.lit, P.OCR_RANGE))

    return let(c, lambda x: F.when(x.contains("$"), fixed(x)).otherwise(x))


def normalize_title(c: Column) -> Column:
    c = F.replace(normalize_inline_ocr(strip(F.replace(c, F.lit("　"), F.lit(" ")))), F.lit("．"), F.lit("."))
    c = fix_legal_spaces(c, "章节条编项")
    c = let(c, lambda x: F.when(x.rlike(f"[{P.CJK}]"), sub(x, rf"(?U)(?<=[{P.CJK}])\s+(?=[{P.CJK}])", "")).otherwise(x))
    spaced = lambda x: sub(sub(x, r"(?U)^(\d+\.\d+\.\d+)(?=[^\d.\s])", "$1 "), r"(?U)^(\d+\.\d+)(?=[^\d.\s])", "$1 ")
    c = let(c, lambda x: F.when(F.substring(x, 1, 1).rlike(r"(?U)\d"), spaced(x)).otherwise(x))
    odd = P.BLANKS.replace(" ", "")
    return let(c, lambda x: strip(F.when(x.rlike(f"  |[{odd}]"), sub(x, r"(?U)\s+", " ")).otherwise(x)))


def slug_title(c: Column) -> Column:
    return F.translate(F.replace(normalize_title(c), F.lit(" "), F.lit("")), "".join(P.FULL_WIDTH), "".join(P.FULL_WIDTH.values()))


def short_slug(c: Column, most: int = 28) -> Column:
    """A slug whose text after its number has at most ``most`` characters."""
    base = slug_title(c)
    number, rest = F.regexp_extract(base, r"(?U)^(\d+(?:\.\d+)*)(.*)$", 1), F.regexp_extract(base, r"(?U)^(\d+(?:\.\d+)*)(.*)$", 2)
    return F.when(number != "", F.concat(number, F.substring(rest, 1, most))).otherwise(F.substring(base, 1, most + 8))


def chapter_dir(c: Column) -> Column:
    return short_slug(c, 32)


def chapter_stem(c: Column) -> Column:
    """The slug of what follows 第X章, or of the whole title."""
    tail = F.regexp_extract(c, "(?U)" + P.CHAPTER, 2)
    return short_slug(F.when(tail != "", tail).otherwise(c), 32)


def page_of_marker(c: Column) -> Column:
    """The number of the first page marker, or null."""
    return number(F.when(c.contains("<!--"), group(c, "(?U)" + P.PAGE_MARKER)))


def has_marker(c: Column) -> Column:
    """Whether a page marker stands in a line, whatever its number."""
    return c.contains("<!--") & c.rlike("(?U)" + P.PAGE_MARKER)


def body_after_marker(c: Column) -> Column:
    """What follows the first page marker, without emphasis marks."""
    return strip(F.replace(F.when(c.contains("<!--"), sub(c, "(?Us)^.*?" + P.PAGE_MARKER, "")).otherwise(c), F.lit("**"), F.lit("")))


def plain_text(c: Column) -> Column:
    return normalize_title(strip(sub(body_after_marker(c), r"\*+", "")))


def cn_part_title(c: Column) -> Column:
    """一、… cut at the first stop, 18 characters of text at most; null if it is no such line."""
    rest = F.substring_index(F.substring_index(F.substring_index(strip(F.regexp_extract(c, P.CN_PART, 2)), "。", 1), "；", 1), "\n", 1)
    return F.when(c.rlike(P.CN_PART), F.concat(F.regexp_extract(c, P.CN_PART, 1), F.lit("、"), F.substring(rest, 1, 18)))


def cn_item_title(c: Column) -> Column:
    """（一）… cut at the first stop word; null if it is no such line."""
    mark = F.regexp_extract(c, P.CN_ITEM, 0)
    rest = strip(sub(c, P.CN_ITEM, ""))
    for stop in P.SECTION_TITLE_STOPS:
        rest = F.substring_index(rest, stop, 1)
    return F.when(c.rlike(P.CN_ITEM), F.substring(F.concat(mark, F.substring(rest, 1, 18)), 1, 28))


def article_label(c: Column) -> Column:
    """The label of a catalog topic: 第X条, n.n.n, or the first word."""
    t = normalize_title(c)
    return F.coalesce(group(t, "(?U)" + P.ARTICLE, 0), group(t, "(?U)" + P.CLAUSE_NUMBER), F.nullif(F.split_part(t, F.lit(" "), F.lit(1)), F.lit("")), t)


def body_label(c: Column) -> Column:
    """The label of a body line: article, clause or guide clause; else null."""
    article = sub(strip(group(c, "(?U)" + P.ARTICLE, 0)), "[:：]+$", "")
    return F.coalesce(article, group(c, "(?U)" + P.CLAUSE_NUMBER), group(c, "(?U)" + P.GUIDE_CLAUSE))


def page_range(start: Column, end: Column) -> Column:
    return F.when(start == end, F.format_string("第%d页", start)).otherwise(F.format_string("第%d～%d页", start, end))


def catalog_line(label: Column, page: Column) -> Column:
    return F.format_string("  - %s（第%d页）", label, page)


def summary_line(label: Column, page: Column) -> Column:
    return F.format_string(f"- **%s**（第%d页）：{P.SUMMARY_TODO}", label, page)


def md_escape(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def clean_heading(level: Column, c: Column) -> Column:
    """How a heading is written in a body file."""
    from .predicates import is_article, is_chapter, is_section

    t = normalize_title(c)
    marks = F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(4), level)))
    return F.when(is_chapter(t), F.concat(F.lit("# "), t)).when(is_section(t), F.concat(F.lit("## "), t)).when(is_article(t), t).otherwise(F.concat(marks, F.lit(" "), t))


def html_table(rows: Column, spans: Column | None = None) -> Column:
    """A grid of cells (array of arrays) as an HTML table; spans hold (rs, cs) where given."""
    text = lambda x: F.replace(strip(F.coalesce(x, F.lit(""))), F.lit("\n"), F.lit("<br>"))
    if spans is None:
        body = F.transform(rows, lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, lambda x: F.concat(F.lit("<td>"), text(x), F.lit("</td>"))), ""), F.lit("</tr>")))
    else:
        attr = lambda name, n: F.when(n > 1, F.concat(F.lit(f' {name}="'), n.cast("string"), F.lit('"'))).otherwise(F.lit(""))
        cell = lambda x, s: F.concat(F.lit("<td"), attr("rowspan", s["rs"]), attr("colspan", s["cs"]), F.lit(">"), text(x), F.lit("</td>"))
        short = lambda r, s: F.least(F.size(r), F.size(s))
        row = lambda r, s: F.array_join(F.zip_with(F.slice(r, F.lit(1), short(r, s)), F.slice(s, F.lit(1), short(r, s)), cell), "")
        body = F.zip_with(F.slice(rows, F.lit(1), short(rows, spans)), F.slice(spans, F.lit(1), short(rows, spans)), lambda r, s: F.concat(F.lit("<tr>"), row(r, s), F.lit("</tr>")))
    return F.concat(F.lit('<table border="1" >'), F.array_join(body, ""), F.lit("</table>"))


def data_url(content: Column, path: Column) -> Column:
    """An image as a data URL; its kind by the name, png by default."""
    kind = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    mime = F.when(kind.isin("jpg", "jpeg"), F.lit("image/jpeg")).when(kind.isin("gif", "bmp", "webp"), F.concat(F.lit("image/"), kind)).otherwise(F.lit("image/png"))
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), sub(F.base64(content), r"[\r\n]", ""))


def chat_messages(system: Column, user: Column) -> Column:
    pair = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(pair("system", system), pair("user", user))


def docx_paragraph(style: Column, runs: Column) -> Column:
    """A paragraph as Markdown by its style, else by its looks; bold runs keep their marks."""
    from .predicates import heading_level

    text = strip(F.array_join(F.transform(runs, lambda r: r["text"]), ""))
    shown = F.filter(F.transform(runs, lambda r: F.when(r["bold"] & (strip(r["text"]) != ""), F.concat(F.lit("**"), strip(r["text"]), F.lit("**"))).otherwise(strip(r["text"]))), lambda x: x != "")
    level = F.when(style.rlike(r"^(?i)heading \d+"), F.least(F.lit(6), F.regexp_extract(style, r"(\d+)", 1).try_cast("int"))).when(F.lower(style) == "title", F.lit(1)).otherwise(heading_level(text))
    return F.when(text == "", F.lit("")).when(level.isNotNull(), to_heading(text, level)).otherwise(F.array_join(shown, " "))
