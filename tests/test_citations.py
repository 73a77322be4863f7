"""The citation graph against small cases and a walk in plain Python."""

import random

from pyspark.sql import functions as F

from foliomill.operators import citations

NORM = [
    "# 第一章 总则", "依第一条", "第一条 本条与本章", "", "前款和《乙》第 二 条", "上款、前条、下条", "第 二 条：见《乙》第九条、第一条", "## 第二章", "第三条 前款", "本章，前条",
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def lines(spark, norms):
    return spark.createDataFrame([(n, i, t) for n, texts in norms.items() for i, t in enumerate(texts)], "norm string, pos int, line string")


EXPECTED = [
    (1, 0, None, "own", "甲", "第一条", None, True),
    (2, 0, "第一条", "本条", "甲", "第一条", None, True), (2, 1, "第一条", "本章", "甲", "第一章", None, True),
    (4, 0, "第一条", "前款", "甲", "第一条", 1, True), (4, 1, "第一条", "named", "乙", "第二条", None, True),
    (5, 0, "第一条", "上款", "甲", "第一条", 2, True), (5, 1, "第一条", "前条", "甲", None, None, False), (5, 2, "第一条", "下条", "甲", "第二条", None, True),
    (6, 0, "第二条", "named", "乙", "第九条", None, False), (6, 1, "第二条", "own", "甲", "第一条", None, True),
    (8, 0, "第三条", "前款", "甲", "第三条", None, False),
    (9, 0, "第三条", "本章", "甲", "第二章", None, True), (9, 1, "第三条", "前条", "甲", "第二条", None, True),
]


def test_references(spark):
    d = lines(spark, {"甲": NORM, "乙": ["第二条 x", "y"], "空": [""]})
    for block in (None, 2, 3):
        got = citations.references(d, block).where("norm = '甲'").drop("norm")
        assert rows(got) == sorted(EXPECTED, key=str)
    assert citations.references(d.limit(0)).count() == 0
    assert citations.references(spark.createDataFrame([(None, 0, "第一条 见第一条"), (None, 1, None)], d.schema)).count() == 1


def test_chapter_links_are_no_articles(spark):
    d = lines(spark, {"甲": NORM, "乙": ["第二条 x"]})
    assert rows(citations.article_links(citations.references(d))) == [
        ("甲", "第一条", "乙", "第二条"), ("甲", "第一条", "甲", "第一条"), ("甲", "第一条", "甲", "第二条"), ("甲", "第三条", "甲", "第二条"), ("甲", "第二条", "甲", "第一条"),
    ]


def test_reachable_is_a_bounded_walk(spark):
    draw = random.Random(3)
    nodes = [(f"n{i}", f"第{j}条") for i in range(4) for j in range(8)]
    links = {(*draw.choice(nodes), *draw.choice(nodes)) for _ in range(45)} | {("n0", "第0条", "n0", "第0条")}
    starts = nodes[:20]
    for steps in (0, 2, 9):
        want = []
        for s in starts:
            seen, edge = {s: 0}, [s]
            for step in range(1, steps + 1):
                edge = list({k[2:] for at in edge for k in links if k[:2] == at and k[2:] not in seen})
                seen |= dict.fromkeys(edge, step)
            want += [(*s, *n, d, (*n, *s) in links) for n, d in seen.items()]
        df = spark.createDataFrame(sorted(links) * 2, "norm string, article string, target_norm string, target_article string")
        got = citations.reachable(df, spark.createDataFrame(starts + starts[:3], "norm string, article string"), steps)
        assert rows(got) == sorted(want, key=str)
    assert citations.reachable(df, df.select("norm", "article").where(F.lit(False)), 3).count() == 0
