"""Predicates and classifiers of lines, tables and boxes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import is_rule_chapter, is_rule_section, squeeze, strip


def is_boundary(c: Column) -> Column:
    """Lines that no paragraph runs across."""
    t, low = strip(c), F.lower(strip(c))
    return (t == "") | t.rlike(P.SHIELD) | t.startswith("#") | low.rlike("^(<table|</table|<tr|<td)") | t.startswith("![") | t.startswith("<!--")


def starts_paragraph(c: Column) -> Column:
    t = strip(c)
    return (t == "") | is_rule_chapter(t) | is_rule_section(t) | t.rlike(rf"(?U)^第[{P.CN_NUM}\d]+条") | t.rlike("(?U)" + P.LIST_ITEM)


def is_page_number(c: Column) -> Column:
    return c.rlike("(?U)" + P.NUMERIC_FOOTER) | c.rlike("(?U)" + P.DASH_PAGE) | c.rlike("(?U)" + P.EM_DASH_PAGE)


def is_boilerplate(c: Column) -> Column:
    return c.rlike(P.ISSUED_LINE) | c.rlike(rf"^[ \t]*{P.RULE_HEADER}[ \t]*$") | c.rlike(P.LONE_X)


def heading_level(c: Column) -> Column:
    """1 to 4 by the looks of a line and its length; else null."""
    t, n = strip(c), F.length(strip(c))
    num = P.GUESS_NUM
    one = t.rlike(rf"(?U)^第{num}[章篇编]\b|^第{num}\s*章")
    two = t.rlike(rf"(?U)^第{num}节\b|^\d+\.\d+\s")
    three = t.rlike(r"(?U)^\d+\.\d+\.\d+\s")
    four = t.rlike(rf"(?U)^第{num}条\b")
    return (
        F.when((t == "") | (n > P.H3_MAX), F.lit(None).cast("int"))
        .when(one & (n <= P.H1_MAX), 1)
        .when(two & (n <= P.H2_MAX), 2)
        .when(three, 3)
        .when(four, 4)
    )


def text_quality(c: Column) -> Column:
    """struct(ok, reason) of an extracted page."""
    t = squeeze(F.coalesce(c, F.lit("")))
    n = F.length(t)
    cn = F.regexp_count(t, F.lit(f"[{P.CJK}]"))
    ratio, garbled = cn / F.greatest(n, F.lit(1)), 1 - F.regexp_count(t, F.lit(P.PRINTABLE)) / F.greatest(n, F.lit(1))
    bad = lambda reason: F.struct(F.lit(False).alias("ok"), reason.alias("reason"))
    return (
        F.when(F.coalesce(c, F.lit("")) == "", bad(F.lit("empty")))
        .when(n < P.MIN_CHARS, bad(F.format_string(f"too_short(%d < {P.MIN_CHARS})", n)))
        .when((cn > 0) & (ratio < P.MIN_CN_RATIO) & (n > 80), bad(F.format_string("cn_ratio_low(%.2f)", ratio)))
        .when(garbled > P.MAX_GARBLED, bad(F.format_string("garbled(%.2f)", garbled)))
        .otherwise(F.struct(F.lit(True).alias("ok"), F.lit("ok").alias("reason")))
    )


def is_chapter(c: Column) -> Column:
    t = strip(c)
    return t.rlike("(?U)" + P.CHAPTER) | t.rlike("(?U)" + P.SUPPLEMENT) | t.rlike("(?U)" + P.APPENDIX)


def is_section(c: Column) -> Column:
    t = strip(c)
    return t.rlike("(?U)" + P.SECTION) | (t.rlike("(?U)" + P.SECTION_NUMBER) & ~t.rlike("(?U)" + P.CLAUSE_NUMBER))


def is_article(c: Column) -> Column:
    t = strip(c)
    return t.rlike("(?U)" + P.ARTICLE) | t.rlike("(?U)" + P.CLAUSE_NUMBER)


def is_numbered_part(c: Column) -> Column:
    """A level-one title such as 2.范围, not a clause that begins with a number."""
    t = strip(c)
    clause = t.contains(P.CLAUSE_WORDS[0])
    for word in P.CLAUSE_WORDS[1:]:
        clause = clause | t.contains(word)
    shape = t.rlike("(?U)" + P.NUMBERED_TITLE) | t.rlike("(?U)" + P.NUMBERED_SHORT)
    long_clause = t.rlike("(?U)" + P.NUMBERED_CLAUSE) & (F.length(t) > 22)
    return ~is_chapter(t) & (F.length(t) <= 80) & ~t.rlike(r"(?U)^\d+\.\d+\.\d+") & ~clause & ~long_clause & shape


def is_cn_part(c: Column) -> Column:
    return strip(c).rlike(P.CN_PART)


def is_document_part(title: Column, level: Column) -> Column:
    return F.when(is_cn_part(title), level.isin(1, 2)).otherwise((level == 1) & (is_chapter(title) | is_numbered_part(title)))


def is_document_title(title: Column, level: Column, name: Column | None = None) -> Column:
    """The title of the whole document, which is no chapter."""
    from .text import slug_title

    long = (F.length(title) > 32) & ~title.rlike(r"(?U)^\d")
    if name is not None:
        long = long | ((F.length(slug_title(name)) > 8) & slug_title(title).contains(slug_title(name)))
    return (level == 1) & ~is_chapter(title) & ~is_numbered_part(title) & ~is_cn_part(title) & long


def is_tail(c: Column) -> Column:
    return strip(c).rlike(P.TAIL)


def is_toc_noise(c: Column) -> Column:
    return c.rlike(r"\.{4,}")


def is_table_caption(c: Column) -> Column:
    return (strip(c) == "") | strip(c).rlike("(?U)" + P.TABLE_CAPTION)


def split_ratio_flag(body: Column, source: Column) -> Column:
    """True where a split kept suspiciously few or many lines."""
    ratio = body / source
    return (ratio > P.SPLIT_RATIO[1]) | (ratio < P.SPLIT_RATIO[0])


def yes_no(c: Column) -> Column:
    """A model's yes or no; null for anything else."""
    t = F.lower(strip(c))
    return F.when(t.startswith("y"), F.lit(True)).when(t.startswith("n"), F.lit(False))


def point_in_box(x: Column, y: Column, box: Column) -> Column:
    return x.between(box["x0"], box["x1"]) & y.between(box["top"], box["bottom"])


def clamp_box(box: Column, width: Column, height: Column) -> Column:
    """The part of a box on its page; null if nothing is left."""
    x0, top = F.greatest(F.lit(0.0), box["x0"]), F.greatest(F.lit(0.0), box["top"])
    x1, bottom = F.least(width, box["x1"]), F.least(height, box["bottom"])
    return F.when((x1 > x0) & (bottom > top), F.struct(x0.alias("x0"), top.alias("top"), x1.alias("x1"), bottom.alias("bottom")))


def is_large_image(box: Column, width: Column, height: Column) -> Column:
    b = clamp_box(box, width, height)
    return F.coalesce((b["x1"] - b["x0"]) * (b["bottom"] - b["top"]) / (width * height) >= P.IMAGE_AREA, F.lit(False))


def score_table(grid: Column, area_ratio: Column) -> Column:
    """struct(rows, cols, score, reject_reason) of a table candidate.

    Equally frequent column counts give the smaller one.
    """
    L = P.TABLE_LIMITS
    rows = F.size(grid)
    counts = F.transform(grid, lambda r: F.size(r))
    often = lambda n: F.size(F.filter(counts, lambda x: x == n))
    ranked = F.array_sort(F.transform(F.array_distinct(counts), lambda n: F.struct((-often(n)).alias("a"), n.alias("n"))))
    cols = F.get(ranked, F.lit(0))["n"]
    cells = F.transform(F.flatten(grid), lambda x: F.length(strip(F.coalesce(x, F.lit("")))))
    total, filled = F.size(cells), F.size(F.filter(cells, lambda n: n > 0))
    too_long = F.size(F.filter(cells, lambda n: n > L["cell"]))
    chars = F.aggregate(cells, F.lit(0), lambda a, n: a + n)
    variance = F.size(F.filter(counts, lambda n: n != cols)) / F.greatest(rows, F.lit(1))
    filled_ratio = filled / F.greatest(total, F.lit(1))
    average = chars / F.greatest(filled, F.lit(1))
    reason = (
        F.when(rows == 0, F.lit("no_rows"))
        .when(rows < L["rows"], F.lit(f"rows<{L['rows']}"))
        .when(cols < L["cols"], F.lit(f"cols<{L['cols']}"))
        .when(area_ratio < L["least_area"], F.lit(f"area_ratio<{L['least_area']}"))
        .when(area_ratio > L["most_area"], F.lit(f"area_ratio>{L['most_area']}"))
        .when(variance > L["variance"], F.format_string(f"col_var=%.2f>{L['variance']}", variance))
        .when(total == 0, F.lit("no_cells"))
        .when(filled_ratio < L["filled"], F.format_string(f"filled_ratio=%.2f<{L['filled']}", filled_ratio))
        .when(average > L["avg"], F.format_string(f"avg_cell_chars=%.0f>{L['avg']}", average))
        .when(too_long / F.greatest(total, F.lit(1)) > 0.2, F.format_string("too_long_cells=%d/%d", too_long, total))
    )
    score = F.least(rows / 6, F.lit(1.0)) * 0.3 + F.least(cols / 4, F.lit(1.0)) * 0.3 + filled_ratio * 0.2 + (1 - F.least(average / L["avg"], F.lit(1.0))) * 0.2
    return F.struct(
        rows.alias("rows"),
        F.coalesce(cols, F.lit(0)).alias("cols"),
        F.when(reason.isNull(), score).otherwise(F.lit(0.0)).alias("score"),
        reason.alias("reject_reason"),
    )
