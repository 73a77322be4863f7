"""Document operators on hand-made documents, and their invariants."""

import io
import zipfile

from pyspark.sql import functions as F

from foliomill.operators import chunk, integrity, layout, lines, mask, models, outline, qa, rules, split, structure
from foliomill.plans.queries import QUERIES
from foliomill.sources import docx, files
from foliomill.streaming import landing


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def clean(spark, text):
    return rules.apply_rules(docs(spark, text)).first()


def test_footers_go(spark):
    r = clean(spark, "12\n- 12 -\n—— 3 ——\nX\n2024\n1.\n.5\n正文")
    assert (r["text"], r["page_numbers_removed"], r["boilerplate_removed"]) == ("正文\n", 6, 1)


def test_reflow(spark):
    assert clean(spark, "国家鼓励医疗\n器械研制。\n第五条 内容")["text"] == "国家鼓励医疗器械研制。\n第五条内容\n"
    assert clean(spark, "alpha\nbeta")["text"] == "alpha beta\n"
    assert clean(spark, "alpha，\nbeta")["text"] == "alpha，beta\n"
    assert clean(spark, "包括：\n甲")["text"] == "包括：甲\n"
    assert clean(spark, "包括：\n\n甲")["text"] == "包括：\n\n甲\n"
    assert clean(spark, "前文\n# 第一章\n后文")["text"] == "前文\n\n# 第一章\n\n后文\n"


def test_rules_on_null_and_empty(spark):
    rows = rules.apply_rules(docs(spark, None, "")).orderBy("doc_id").collect()
    assert rows[0]["text"] is None and rows[1]["text"] == "\n"


def test_masks_come_back(spark):
    text = "a <table><tr></tr></table> b <!-- c --> ![x](y) <!-- d --> $$z$$ $w$"
    d = docs(spark, text).select(mask.mask_protected(F.col("text")).alias("m"), mask.placeholders(F.col("text")).alias("h"), mask.unshield(mask.shield(F.col("text")), mask.protected(F.col("text"))).alias("s"))
    r = d.select("m", "s", mask.unmask(F.col("m"), F.col("h")).alias("u"), F.transform("h", lambda x: x["token"]).alias("t")).first()
    assert r["t"] == ["<<TAB_0>>", "<<CMT_1>>", "<<IMG_2>>", "<<MATH_3>>", "<<MATH_4>>"]
    assert r["u"] == r["s"] == text


def test_page_pieces(spark):
    got = chunk.page_pieces(docs(spark, "p1<!-- 第 1 页 -->p2<!-- 第 2 页 -->tail")).first()["pieces"]
    assert [(p.page_no, p.text) for p in got] == [(None, "p1<!-- 第 1 页 -->"), (1, "p2<!-- 第 2 页 -->"), (2, "tail")]


def test_size_split(spark):
    cut = lambda t, n: docs(spark, t).select(chunk.split_by_size(F.col("text"), n)).first()[0]
    assert cut("abc\n\ndefgh", 5) == ["abc\n\n", "defgh"]
    assert cut("abcdefgh", 3) == ["abc", "def", "gh"]


def test_chunks_make_the_text(spark):
    text = "# a\n\n" + "x y\n\n" * 50 + "<!-- 第 1 页 -->\n$q$ end"
    assert chunk.reassemble(chunk.chunk_documents(docs(spark, text), 40)).first()["text"] == text.strip() + "\n"
    assert chunk.reassemble(models.clean_chunks(chunk.chunk_documents(docs(spark, text), 40))).first()["text"] == text.strip() + "\n"


def test_a_model_that_drops_tokens_or_fails(spark):
    chunks = chunk.chunk_documents(docs(spark, "$q$ end"))
    r = models.clean_chunks(chunks, lambda: lambda t: "gone").first()
    assert (r["ok"], r["error"], r["text"]) == (False, "placeholder_missing", "<<MATH_0>> end")


def test_pages(spark):
    d = lines.with_pages(lines.explode_lines(docs(spark, "a\n<!-- 第 1 页 -->第五条\nb\n<!-- 第 2 页 -->\nc")))
    assert [r["page"] for r in d.orderBy("pos").collect()] == [1, 2, 2, 3, 3]
    assert lines.page_touches(d).first()["pages"] == [1, 2, 3]


def test_universal_lines(spark):
    assert [r["line"] for r in lines.explode_lines(docs(spark, "a\r\nb c\n"), universal=True).orderBy("pos").collect()] == ["a", "b", "c"]
    assert lines.explode_lines(docs(spark, None)).count() == 0


def test_structure(spark):
    text = "# 第一章 总则\n第一条 甲\n## 第一节 乙\n内容\n# 第二章 丙\n条文说明\n尾"
    s = structure.structure_lines(lines.explode_lines(docs(spark, text)))
    got = structure.chapters(s).orderBy("chapter_id").collect()
    assert [(c["start_pos"], c["end_pos"], c["n_sections"]) for c in got] == [(0, 3, 1), (4, 4, 0)]


def test_items_are_sections_only_outside_numbered_chapters(spark):
    n = lambda t: structure.chapters(structure.structure_lines(lines.explode_lines(docs(spark, t)))).first()["n_sections"]
    assert n("# 第一章 总则\n（一）甲") == 0
    assert n("# 一、概述\n（一）甲") == 1


def test_section_groups(spark):
    rows = [(0, 1, i, f"s{i}", i * 3, i * 3 + 2, 1, 1, 3, 300) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "doc_id long, chapter_id int, section_id int, title string, start_pos int, end_pos int, start_page int, end_page int, n_lines int, n_chars int")
    got = structure.group_sections(df).orderBy("section_id").collect()
    assert [r["group_no"] for r in got] == [1, 1, 1, 2, 2]
    assert [r["stem"] for r in got] == ["TODO-待LLM命名-1"] * 3 + ["TODO-待LLM命名-2"] * 2


def test_split_keeps_tables_whole_and_overlaps_pages(spark):
    text = "\n".join(f"line {p} text\n<!-- 第 {p} 页 -->" for p in range(1, 6)) + "\n<table><tr>\n<td>1</td>\n</table>\nafter words"
    d = lines.with_pages(lines.explode_lines(docs(spark, text)))
    got = split.split_chunks(d, ["doc_id"]).orderBy("part_no").collect()
    tables = [r for r in got if r["is_table"]]
    assert len(tables) == 1 and tables[0]["end_pos"] - tables[0]["start_pos"] == 2
    assert [(r["start_page"], r["end_page"]) for r in got if not r["is_table"]][:3] == [(1, 2), (2, 4), (4, 6)]


def test_outline(spark):
    d = lines.with_pages(lines.explode_lines(docs(spark, "第一条 甲\n第一条 乙\n2.3.1 丙\n4.1 丁....3")))
    assert [r["label"] for r in outline.outline(d).orderBy("pos").collect()] == ["第一条", "2.3.1"]


def test_page_check_and_fix(spark):
    index = spark.createDataFrame([("n", "i", 0, "  - 第一条（第1页）"), ("n", "i", 1, "- **第一条**（第1页）：说明")], "norm string, index_path string, pos int, line string")
    pages = spark.createDataFrame([("n", "第一条", 2)], "norm string, label string, page int")
    issues = integrity.check_pages(integrity.index_refs(index), pages)
    assert [r["delta"] for r in issues.collect()] == [1, 1]
    fixed = integrity.fix_pages(index, issues).orderBy("pos").collect()
    assert [r["line"] for r in fixed] == ["  - 第一条（第2页）", "- **第一条**（第2页）：说明"]


def test_excerpts(spark):
    bodies = spark.createDataFrame([("p", "企业应当建立制度，并应当记录。")], "path string, text string")
    rows = spark.createDataFrame([("a", 1, "p", "应当建立……应当记录。"), ("a", 2, "p", "不应当"), ("a", 3, "q", "应当")], "answer_id string, seq int, path string, excerpt string")
    assert [r["verified"] for r in qa.verify_excerpts(rows, bodies).orderBy("seq").collect()] == [True, False, False]
    answers = spark.createDataFrame([("a", "见（序号 1）和序号 2、27")], "answer_id string, text string")
    assert [r["seq"] for r in qa.dangling_citations(answers, rows).collect()] == [27]


def test_word_lines(spark):
    w = "array<struct<text:string,x0:double,top:double,x1:double,bottom:double>>"
    words = [("b", 5.0, 1.0, 6.0, 2.0), ("a", 1.0, 2.0, 2.0, 3.0), ("c", 1.0, 9.0, 2.0, 10.0)]
    assert spark.createDataFrame([(words,)], f"w {w}").select(layout.word_lines(F.col("w"))).first()[0] == ["a b", "c"]


def test_best_format(spark):
    df = spark.createDataFrame([("/a.doc",), ("/a.docx",), ("/b.pdf",), ("/b.doc",)], "path string")
    assert sorted(r["path"] for r in files.best_format(df).collect()) == ["/a.docx", "/b.pdf"]


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = (
        f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Title"/></w:pPr><w:r><w:t>Name</w:t></w:r></w:p>'
        "<w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r><w:r><w:t>plain</w:t></w:r></w:p>"
        '<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/></w:tcPr><w:p><w:r><w:t>wide</w:t></w:r></w:p></w:tc></w:tr>'
        "<w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>y</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    )
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "a.docx").write_bytes(data.getvalue())
    (tmp_path / "b.docx").write_bytes(b"no zip")
    blocks = docx.docx_blocks(files.list_files(spark, str(tmp_path)))
    assert blocks.where("status = 'failed'").count() == 1
    text = docx.docx_markdown(blocks).first()["text"]
    assert text == '# Name\n\n**bold** plain\n\n<table border="1" ><tr><td colspan="2">wide</td></tr><tr><td>x</td><td>y</td></tr></table>\n'


def test_replay_is_one_run(spark):
    d = docs(spark, *[f"text {i}" for i in range(9)])
    assert sorted(map(tuple, landing.replay(d, lambda x: x, 3).collect())) == sorted(map(tuple, d.collect()))


def test_size_chunks_keeps_short_documents(spark, tmp_path):
    rows = [(1, "short"), (2, ""), (3, "x" * 6000), (4, "y" * 6001)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in QUERIES["size_chunks"](spark, str(tmp_path)).collect())
    assert got == [(1, 0, "short"), (2, 0, ""), (3, 0, "x" * 6000), (4, 0, "y" * 6000), (4, 1, "y")]
