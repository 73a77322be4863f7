"""The citation graph: what each article cites, by name or by position, and what is reached from it in some steps.

Nodes are articles (norm, article); labels are compared without white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut, scratch
from . import scan

_NUMBER = rf"第\s*[{T.NUMERALS}\s]+"
ARTICLE_LINE = rf"(?U)^\s*(?:#+\s*)?({_NUMBER}条)"
CHAPTER_LINE = rf"(?U)^\s*(?:#+\s*)?({_NUMBER}章)"
#: A named norm's article (1, 2), an article of this norm (2 alone), or a place counted from here (3).
MENTION = rf"(?U)(?:《([^》]+)》\s*)?({_NUMBER}条)|([本前上下]条|前款|上款|本章)"


def label_of(text: Column, pattern: str) -> Column:
    """The label that a line opens with, without white space; null where it opens with none."""
    return F.when(text.rlike(pattern), F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)\s", ""))


def articles(lines: DataFrame, block: int | None = None) -> DataFrame:
    """Articles (norm, article) with the position of their first line and the articles before and after them."""
    first = lines.withColumn("article", label_of(F.col("line"), ARTICLE_LINE)).where("article is not null").groupBy("norm", "article").agg(F.min("pos").alias("pos"))
    # labels differ, so the article after X is the one whose article before is X
    found = scan.running(first, ["norm"], block, before=True, previous=("last", F.col("article")))
    after = found.select(F.col("norm").alias("_n"), F.col("previous").alias("_a"), F.col("article").alias("next"))
    return found.join(after, F.col("norm").eqNullSafe(F.col("_n")) & (F.col("article") == F.col("_a")), "left").select("norm", "article", "pos", "previous", "next")


def references(lines: DataFrame, block: int | None = None) -> DataFrame:
    """What the lines of norms (norm, pos, line) cite: norm, pos, ord, article, kind, target_norm, target_article, target_paragraph, found.

    ``lines`` are body lines; page markers and footers are to be left out before.
    An article's own label isn't a citation, nor is anything before the first
    article with a place counted from there resolved.  kind is the named norm's
    article (named), an article of the same norm (own) or the word of a place
    counted from here: 本条 (this article), 前条 and 上条 (the one before), 下条
    (the one after), 前款 and 上款 (the paragraph before in this article), 本章
    (this chapter, whose label is then target_article).  Paragraphs are an
    article's lines that aren't blank, from 1.  ord numbers a line's citations;
    found says that the target is an article, paragraph or chapter of its norm.
    """
    text = F.col("line")
    d = lines.select("norm", "pos", "line").withColumn("_a", label_of(text, ARTICLE_LINE)).withColumn("_c", label_of(text, CHAPTER_LINE))
    filled = (T.strip(text) != "").cast("long")
    d = scan.running(d, ["norm"], block, article=("last", F.col("_a")), chapter=("last", F.col("_c")), n=("sum", filled), _at=("max", F.when(F.col("_a").isNotNull(), F.col("pos"))))
    starts = d.where("_a is not null").select(F.col("norm").alias("_n"), F.col("pos").alias("_p"), F.col("n").alias("_first"))
    body = F.when(F.col("_a").isNotNull(), F.regexp_replace("line", ARTICLE_LINE, "")).otherwise(text)
    cited = d.withColumn("_m", F.regexp_extract_all(body, F.lit(MENTION), F.lit(0))).where(F.size("_m") > 0)
    cited = cited.join(starts, F.col("norm").eqNullSafe(F.col("_n")) & (F.col("_at") == F.col("_p")), "left")
    cited = cited.select("norm", "pos", "article", "chapter", (F.col("n") - F.col("_first")).alias("before"), F.posexplode("_m").alias("ord", "m"))
    part = lambda i: F.nullif(F.regexp_extract("m", MENTION, i), F.lit(""))
    cited = cited.select("norm", "pos", "ord", "article", "chapter", "before", part(1).alias("name"), F.regexp_replace(part(2), r"(?U)\s", "").alias("label"), part(3).alias("word"))
    known = articles(lines, block)
    near = known.select(F.col("norm").alias("_n"), F.col("article").alias("_a"), "previous", "next")
    cited = cited.join(near, F.col("norm").eqNullSafe(F.col("_n")) & (F.col("article") == F.col("_a")), "left")
    word, back = F.col("word"), F.col("word").isin("前款", "上款")
    placed = F.when(word.isin("本条", "前款", "上款"), F.col("article")).when(word.isin("前条", "上条"), F.col("previous")).when(word == "下条", F.col("next")).when(word == "本章", F.col("chapter"))
    out = cited.select(
        "norm", "pos", "ord", "article",
        F.coalesce(word, F.when(F.col("name").isNotNull(), "named").otherwise("own")).alias("kind"),
        F.coalesce("name", F.col("norm").cast("string")).alias("target_norm"), F.coalesce("label", placed).alias("target_article"),
        F.when(back & (F.col("before") > 0), F.col("before")).alias("target_paragraph"),
    )
    there = known.select(F.col("norm").cast("string").alias("target_norm"), F.col("article").alias("target_article"), F.lit(True).alias("_there"))
    by_position = F.when(F.col("kind").isin("前款", "上款"), F.col("target_paragraph").isNotNull()).otherwise(F.col("target_article").isNotNull())
    found = F.when(F.col("kind").isin("named", "own"), F.coalesce("_there", F.lit(False))).otherwise(by_position)
    return out.join(there, ["target_norm", "target_article"], "left").select(*out.columns, found.alias("found"))


def article_links(references: DataFrame) -> DataFrame:
    """Distinct links between articles (norm, article, target_norm, target_article); chapters and what isn't found are left out."""
    whole = references.where("found and kind <> '本章' and article is not null")
    return whole.select(F.col("norm").cast("string").alias("norm"), "article", "target_norm", "target_article").distinct()


def reachable(links: DataFrame, starts: DataFrame, steps: int) -> DataFrame:
    """What is reached from each start (norm, article) in at most so many links: start_norm, start_article, norm, article, distance, closes.

    A start reaches itself at distance 0.  ``distance`` is the least number of
    links; ``closes`` marks articles that link back to the start, the last ones of
    its cycles.  Each step joins the articles that the last one reached with the links and leaves out
    what was reached before, so cycles end; it stops when a step reaches nothing.
    Steps are stored, none comes to the driver.  The result has a row for each
    start and article within reach, so starts are a set to be chosen.
    """
    node, start = ("norm", "article"), ("start_norm", "start_article")
    spark = links.sparkSession
    with scratch(spark):
        links = cut(links.select(*node, "target_norm", "target_article").distinct(), "citation-links")
        at = starts.select(*node).distinct()
        levels = [cut(at.select(F.col("norm").alias("start_norm"), F.col("article").alias("start_article"), *node, F.lit(0).alias("distance")), "citations-reached")]
        for step in range(1, steps + 1):
            onward = levels[-1].join(links, [*node]).select(*start, F.col("target_norm").alias("norm"), F.col("target_article").alias("article")).distinct()
            seen = levels[0]
            for level in levels[1:]:
                seen = seen.unionByName(level)
            new = cut(onward.join(seen.drop("distance"), [*start, *node], "left_anti").withColumn("distance", F.lit(step)), "citations-reached")
            if new.isEmpty():
                break
            levels.append(new)
        reached = levels[0]
        for level in levels[1:]:
            reached = reached.unionByName(level)
        back = links.select(F.col("target_norm").alias("start_norm"), F.col("target_article").alias("start_article"), *node, F.lit(True).alias("_back"))
        marked = reached.join(back, [*start, *node], "left").select(*start, *node, "distance", F.coalesce("_back", F.lit(False)).alias("closes"))
        return cut(marked, "citations", stays=1)
