"""Scalar functions and predicates on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from foliomill.functions import predicates as Q
from foliomill.functions import text as T


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        (T.fix_legal_spaces, "第 四 条", "第四条"),
        (T.fix_legal_spaces, "第二十 一 条", "第二十一条"),
        (T.fix_legal_spaces, "x 第 二十 一 条 y", "x 第二十一条 y"),
        (T.strip_bold, "**第三十七条**", "第三十七条"),
        (T.strip_bold, "**应当**", "应当"),
        (T.strip_bold, "**应当记录**", "**应当记录**"),
        (T.normalize_heading, "#### 第一章 总则", "# 第一章 总则"),
        (T.normalize_heading, "### 第一条 为了", "第一条 为了"),
        (T.normalize_heading, "2.3 基本原则", "## 2.3 基本原则"),
        (T.normalize_heading, "## 2.3.1 范围", "2.3.1 范围"),
        (T.normalize_heading, "普通", "普通"),
        (T.fix_cjk_gaps, "生产 企业、 经营企业", "生产企业、经营企业"),
        (T.fix_cjk_gaps, "# 第一章 总 则", "# 第一章总则"),
        (T.fix_cjk_gaps, "使用 A 型", "使用 A 型"),
        (T.body_after_marker, "<!-- 第 3 页 -->**第五条** 内容", "第五条 内容"),
        (T.body_after_marker, "前<!-- 第 3 页 -->后", "后"),
        (T.slug_title, "第 一 章 a/b: c", "第一章a／b：c"),
        (T.clean_line, "　a \t b\u0007 ", "a b"),
        (T.page_of_marker, "<!-- ·12· -->", 12),
        (T.page_of_marker, "none", None),
        (T.strip_code_fence, "```markdown\nx\n```", "x"),
        (T.first_table, "```html\n<table><tr></tr></table>\n```", '<table border="1"><tr></tr></table>'),
        (T.first_table, "no", ""),
        (T.cn_part_title, "一、概述。其余", "一、概述"),
        (T.cn_item_title, "（一）范围；其余", "（一）范围"),
        (T.body_label, "第五条：内容", "第五条"),
        (T.body_label, "4.1 丁", "4.1"),
        (Q.heading_level, "第一章 总则", 1),
        (Q.heading_level, "第一条为了", None),
        (Q.heading_level, "第一条 为了", 4),
        (Q.heading_level, "2.3 原则", 2),
        (Q.heading_level, "2.3.1 范围", 3),
        (Q.is_page_number, "- 12 -", True),
        (Q.is_page_number, "—— 3 ——", True),
        (Q.is_page_number, "12345", False),
        (Q.is_boilerplate, "X", True),
        (Q.is_boilerplate, "国家市场监督管理总局、国家卫生健康委员会发布", True),
        (Q.is_boilerplate, "国家市场监督管理总局规章", True),
        (Q.is_boilerplate, "正文", False),
        (Q.yes_no, "Yes.", True),
        (Q.yes_no, "maybe", None),
    ],
)
def test_scalar(spark, column, value, expected):
    assert one(spark, column, value) == expected


def test_quality(spark):
    q = lambda v: tuple(one(spark, Q.text_quality, v))
    assert q("") == (False, "empty")
    assert q("x" * 10) == (False, "too_short(10 < 30)")
    assert q("中" * 10 + "a" * 90) == (False, "cn_ratio_low(0.10)")
    assert q("a" * 60) == (True, "ok")


def test_table_score(spark):
    def score(grid, area):
        df = spark.createDataFrame([(grid,)], "g array<array<string>>")
        return df.select(Q.score_table(F.col("g"), F.lit(area)).alias("s")).first()["s"]

    assert round(score([["abcd", "abcd"], ["abcd", "abcd"]], 0.5).score, 2) == 0.64
    assert score([["a", "b"]], 0.5).reject_reason == "rows<2"
    assert score([["a", "b"]] * 2, 0.01).reject_reason == "area_ratio<0.02"
    assert score([["a", None], [None, None]], 0.5).reject_reason == "filled_ratio=0.25<0.5"


def test_html_table(spark):
    df = spark.createDataFrame([([["a", "b\nc"]], [[(1, 2), (1, 1)]])], "g array<array<string>>, s array<array<struct<rs:int,cs:int>>>")
    assert df.select(T.html_table(F.col("g"), F.col("s"))).first()[0] == '<table border="1" ><tr><td colspan="2">a</td><td>b<br>c</td></tr></table>'
