"""Whole runs, reports, checks and the cases that once failed."""

import os

import pytest
from pyspark.sql import functions as F

from foliomill.functions import text as T
from foliomill.operators import chunk, driver, integrity, lines, models, qa, report, split
from foliomill.sources import files
from foliomill.sql import register_views

PROSE = "这一段说明很长，" * 12


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("line", "page"),
    [("<!-- 第 7 页 -->", 7), ("<!-- 第 99999999999 页 -->", None), ("<!-- 第 2147483647 页 -->", None), ("<!-- 第 ٣٤ 页 --> x", 34), ("<!-- ·５· -->", 5), ("第 7 页", None), (None, None)],
)
def test_page_numbers_of_any_size_and_script(spark, line, page):
    assert one(spark, line, T.page_of_marker) == page


def test_odd_page_markers_break_nothing(spark):
    text = "a\n<!-- 第 99999999999 页 -->\nb\n<!-- 第 ２ 页 -->\nc"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    paged = lines.with_pages(lines.explode_lines(docs))
    assert [r.page for r in paged.orderBy("pos").collect()] == [1, 1, 1, 3, 3]
    pieces = chunk.page_pieces(docs).select(F.explode("pieces").alias("p")).select("p.*").collect()
    assert [(p.page_no, p.page) for p in pieces] == [(None, None), (None, 2), (2, None)] or [(p.page_no, p.page) for p in pieces][-1] == (2, None)
    cited = spark.createDataFrame([("a", "见序号 99999999999、3 和序号 ４")], "answer_id string, text string")
    found = qa.dangling_citations(cited, spark.createDataFrame([("a", 3)], "answer_id string, seq int")).collect()
    assert {r.seq for r in found} >= {4} and 3 not in {r.seq for r in found}


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("第  一  百  二  十  三  条 x", "第一百二十三条 x"),
        ("按第" + " 一" * 30 + " 条与第 2 章", "按第" + "一" * 30 + "条与第2章"),
        ("第一条", "第一条"), ("第 一 天", "第 一 天"), ("", ""), (None, None), ("第 1 条第 2 节 第 3项", "第1条第2节 第3项"),
    ],
)
def test_legal_spaces_of_any_length(spark, line, want):
    assert one(spark, line, T.fix_legal_spaces) == want


def test_excerpts_short_elided_and_with_a_common_opening(spark):
    bodies = [(i, f"每份文件都这样开头，第{i}份文件写着自己的内容甲{i}乙，然后结束。") for i in range(50)] + [(50, None), (51, "")]
    items = [
        (1, "每份文件都这样开头，第7份文件"), (2, "甲7乙"), (3, "……甲8乙，……结束"), (4, "第9份……甲9乙"), (5, "甲9乙……第9份"), (6, "没有这样的话在任何文件里面"),
        (7, ""), (8, None), (9, "……"), (10, "每份文件都这样开头"), (11, "甲7乙"),
    ]
    docs = spark.createDataFrame(bodies, "path long, text string").repartition(3)
    got = sorted((r.item_id, r.path) for r in qa.find_excerpts(spark.createDataFrame(items, "item_id long, excerpt string"), docs).collect())
    assert got == sorted([(1, 7), (2, 7), (3, 8), (4, 9), (11, 7)] + [(10, i) for i in range(50)])
    assert qa.find_excerpts(spark.createDataFrame([], "item_id long, excerpt string"), docs).count() == 0


def regulation() -> str:
    return "\n".join(
        ["前言不算", "# 第一章 总则", "第一条 甲。", "<!-- 第 1 页 -->", "第二条 乙。", "## 1.1 小节", "短。", "## 1.2 另一小节", "短。", "表 1 样表", "<table><tr><td>1</td></tr>", "</table>", "<!-- 第 2 页 -->"]
        + ["# 第二章 罚则"] + [f"第{n}条 {PROSE}\n<!-- 第 {n} 页 -->" for n in range(3, 9)] + ["# 条文说明", "不算"]
    )


def test_split_documents(spark):
    docs = spark.createDataFrame([(1, "规范甲", regulation()), (2, "指南", "1.1.1 条文\n正文\n<!-- 第 1 页 -->\n第一条 又"), (3, "空", ""), (4, "无", None)], "doc_id long, name string, text string")
    found, indexes = driver.split_documents(docs)
    got = {r.path: r for r in found.collect()}
    assert len(got) == found.count()  # no file overwrites another
    first = got["规范甲/第一章总则/总则.md"]
    assert first.text.startswith("# 第一章总则\n第一条 甲。\n<!-- 第 1 页 -->") and "  - 第一条（第1页）" in first.index_text and "  - 第二条（第2页）" in first.index_text
    table = next(r for p, r in got.items() if r.doc_id == 1 and r.is_table)
    assert table.path.endswith("-表1.md") and "表 1 样表" in table.text and "  - 表1样表（第2页）" in table.index_text and "合并块" in table.index_text
    second = sorted((r for r in got.values() if r.doc_id == 1 and r.chapter_id == 2), key=lambda r: r.part_no)
    assert len(second) > 2 and second[0].stem == "罚则-1" and all(r.text.startswith("# 第二章罚则\n") for r in second) and f"共 {len(second)} 段" in second[1].index_text
    assert not any("不算" in r.text for r in got.values())
    assert next(r for r in got.values() if r.doc_id == 2).path == "指南/指南.md"
    whole = {r.doc_id: r for r in indexes.collect()}
    assert set(whole) == {1, 2, 3, 4} and (whole[1].chapters, whole[2].chapters, whole[4].files) == (2, 0, 0)
    assert "- 第一章总则\n  - 1.1小节\n  - 1.2另一小节\n- 第二章罚则" in whole[1].text and "## 条目录\n\n- 1.1.1（第1页）\n- 第一条（第2页）" in whole[2].text
    flagged = {r.doc_id: r for r in driver.split_flag(indexes).collect()}
    assert flagged[1].flag and not flagged[4].flag
    shown = [r.value for r in report.text_of(report.split_report(indexes)).collect()]
    assert shown[0] == "# Wiki 批量拆分报告" and "- 成功：4 份" in shown and sum("[!]" in x for x in shown) >= 1


def test_preamble_stays_in_its_segment(spark):
    rows = [(1, 1, i, x) for i, x in enumerate(["短", PROSE, "短一", "", "表格（第3页）", "<table></table>", "尾", "<table>", "</table>"])] + [(1, 2, 20, "短"), (1, 2, 21, "<table></table>")]
    placed = split.with_preambles(split.table_islands(spark.createDataFrame(rows, "doc_id long, c int, pos int, line string"), ["doc_id", "c"]), ["doc_id", "c"])
    assert sorted((r.pos, r.preamble) for r in placed.where("preamble is not null").collect()) == [(5, 2), (7, 6), (21, 20)]


def test_clean_documents(spark):
    text = "第 一 条 甲\n\n$x$ 乙 <!-- 第 1 页 -->"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "坏" + text)], "doc_id long, text string")
    plain = {r.doc_id: r for r in driver.clean_documents(docs).collect()}
    assert plain[1].text.startswith("第一条甲") and plain[1].chunks == 0 and (plain[2].status, plain[2].error, plain[3].status) == ("failed", "no text", "ok")

    def make():
        def call(text):
            if "坏" in text:
                return "placeholders lost"
            return "```markdown\n" + text + "\n<table></table>\n```"

        return call

    asked = {r.doc_id: r for r in driver.clean_documents(docs, make).collect()}
    assert set(asked) == {1, 2, 3, 4} and asked[1].tables_recovered == asked[1].chunks_ok > 0 and asked[4].chunks_failed > 0 and "第一条" in asked[4].text
    shown = [r.value for r in report.text_of(report.clean_report(driver.clean_documents(docs))).collect()]
    assert "| 文件总数 | 4 |" in shown and "| ✗ 失败 | 1 |" in shown and "## 失败文件" in shown and any(x.startswith("| 2 | failed |") for x in shown)


def test_model_steps(spark):
    images = spark.createDataFrame([("a.png", bytearray(b"x")), ("b.jpg", bytearray(b"bad"))], "path string, content binary")

    def make():
        def call(url):
            if url.endswith("YmFk"):
                raise ValueError("no")
            return "yes, a table"

        return call

    import foliomill.operators.models as M

    kept, M.with_retries = M.with_retries, lambda call: call
    try:
        told = models.describe_images(images, make)
        assert {r.path: (r.model_text, r.model_ok) for r in told.collect()} == {"a.png": ("yes, a table", True), "b.jpg": ("", False)}
        assert models.call_counts(told).first().asDict() == {"calls": 2, "ok": 1, "failed": 1}
        scored = images.withColumn("accepted", F.lit(False)).withColumn("s", F.struct(F.lit(0.1).alias("score"), F.lit("rows<2").alias("reject_reason")))
        scored = scored.unionByName(scored.where("path = 'a.png'").withColumn("path", F.lit("c.png")).withColumn("accepted", F.lit(True)))
        got = {r.path: (r.accepted, r.score) for r in models.rescue_tables(scored, make).collect()}
        assert got == {"a.png": (True, 0.5), "b.jpg": (False, 0.1), "c.png": (True, 0.1)}
    finally:
        M.with_retries = kept


def test_files_and_views(spark, tmp_path):
    docs = spark.createDataFrame([("n/a.md", "甲\n"), ("n/a-index.md", "i"), ("n/c/b.md", "乙")], "path string, text string")
    assert {(r.path, r.bytes) for r in files.write_markdown(docs, str(tmp_path)).collect()} == {("n/a.md", 4), ("n/a-index.md", 1), ("n/c/b.md", 3)}
    assert (tmp_path / "n/c/b.md").read_text() == "乙" and not any(p.endswith(".part") for _, _, f in os.walk(tmp_path) for p in f)
    body, index = files.split_kinds(files.list_files(spark, str(tmp_path), (".md",), recursive=True))
    assert [r.name for r in body.orderBy("name").collect()] == ["a.md", "b.md"] and index.count() == 1
    assert files.list_files(spark, str(tmp_path), (".md",), only=f"{tmp_path}/n/a.md").count() == 1 and files.list_files(spark, str(tmp_path), only=f"{tmp_path}/n/a.md").count() == 0
    assert {r.stem for r in files.read_markdown(spark, str(tmp_path), recursive=True).collect()} == {"a", "a-index", "b"}
    with pytest.raises(FileNotFoundError):
        files.read_markdown(spark, str(tmp_path / "n"), spark.createDataFrame([("zz.md",)], "name string"))
    files.write_norms(docs.select(F.lit("n").alias("norm"), "path"), f"{tmp_path}-norms")
    assert spark.read.parquet(f"{tmp_path}-norms").count() == 3
    (tmp_path / "x.gif").write_bytes(b"g")
    assert files.image_urls(files.list_files(spark, str(tmp_path), (".gif",))).first().url == "data:image/gif;base64,Zw=="
    register_views(spark.createDataFrame([(1, regulation())], "doc_id long, text string"))
    assert spark.sql("select count(*) n from chapters").first().n == 2 and spark.sql("select page from page_map where label = '第二条'").first().page == 2


def test_write_new_reads_only_the_range_of_new_keys(spark, tmp_path):
    make = lambda *ids: spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    path = str(tmp_path / "out")
    for ids in ((1, 2), (2, 3), (3,), (10, 11)):
        files.write_new(make(*ids), path)
    files.write_new(make(1).limit(0), path)
    assert sorted(r.doc_id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 10, 11]


def test_lints(spark):
    index = spark.createDataFrame([("n", "a-index.md", 0, "[x](b.md) [y](c.md#z) [w](https://e.org/b.md)")], "norm string, index_path string, pos int, line string")
    assert [r.target for r in integrity.dead_links(index, spark.createDataFrame([("n", "b.md"), ("m", "c.md")], "norm string, path string")).collect()] == ["c.md"]
    cited = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "c"), ("a", "zz")], "source string, norm string")
    norms = spark.createDataFrame([("a",), ("b",), ("c",)], "norm string")
    assert [(r.source, r.norm) for r in integrity.missing_references(cited, spark.createDataFrame([("a", "c")], "source string, norm string"), norms).collect()] == [("a", "b")]
