"""Operators whose work must grow with their input: intervals, greedy packing, keys that repeat, texts with control characters."""

import random
import time

from pyspark.sql import functions as F

from foliomill.operators import chunk, driver, integrity, structure
from foliomill.operators.intervals import interval_join


def test_interval_join_against_loops(spark):
    rnd = random.Random(2)
    points = [(rnd.choice("ab"), rnd.choice([None, *range(-300, 300)])) for _ in range(400)] + [(None, 1)]
    spans = [(rnd.choice("ab"), i, lo, lo + rnd.choice([-2, 0, 3, 40, 500])) for i in range(60) for lo in [rnd.randint(-300, 300)]] + [("a", 90, None, 5), (None, 91, 0, 9)]
    p = spark.createDataFrame(points, "k string, pos int")
    s = spark.createDataFrame(spans, "k string, i int, lo int, hi int")
    for width in (7, 64):
        got = sorted((r.k, r.pos, r.i) for r in interval_join(p, s, ["k"], "pos", "lo", "hi", width).collect())
        want = sorted((k, x, i) for k, x in points for k2, i, lo, hi in spans if k is not None and k == k2 and x is not None and lo is not None and lo <= x <= hi)
        assert got == want


def test_a_long_chapter_meets_its_files_in_linear_time(spark):
    """100,000 lines of one chapter in files of ten lines: a join on the chapter alone would compare 10^9 pairs."""
    n = 100_000
    lines = spark.range(n).select(F.lit(1).alias("chapter"), F.col("id").cast("int").alias("pos"))
    files = spark.range(n // 10).select(F.lit(1).alias("chapter"), F.col("id").alias("file"), (F.col("id") * 10).cast("int").alias("lo"), (F.col("id") * 10 + 9).cast("int").alias("hi"))
    start = time.time()
    joined = interval_join(lines, files, ["chapter"], "pos", "lo", "hi")
    assert joined.groupBy("file").count().where("count = 10").count() == n // 10
    assert time.time() - start < 60


def folded(text, most):
    """Greedy packing by a plain fold."""
    import re

    done, open_ = [], ""
    for atom in re.findall(r"\n{2,}|(?:(?!\n{2})[\s\S])+", text):
        if len(open_) + len(atom) <= most:
            open_ += atom
            continue
        if open_:
            done.append(open_)
        open_ = "" if len(atom) > most else atom
        if len(atom) > most:
            done += [atom[i : i + most] for i in range(0, len(atom), most)]
    return [text] if len(text) <= most else done + [open_] * bool(open_)


def test_greedy_chunks_against_a_fold(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice(["a", "é𝒳", "\n", "\n\n", "\n\n\n", "long word "]) for _ in range(rnd.randint(0, 60))) for _ in range(300)] + ["", None]
    for most in (1, 3, 7, 25):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunk.split_by_size(F.col("t"), most).alias("c")).collect()
        assert {r.i: r.c for r in rows} == {i: None if t is None else folded(t, most) for i, t in enumerate(texts)}


def test_greedy_chunks_take_linear_time(spark):
    def took(paragraphs):
        df = spark.range(1).select(F.repeat(F.lit("paragraph of some length " * 120 + "\n\n"), paragraphs).alias("t"))
        start = time.time()
        assert df.select(F.size(chunk.split_by_size(F.col("t"), 6000))).first()[0] >= paragraphs // 2
        return time.time() - start

    took(10)
    assert took(8000) < 8 * took(2000) + 3  # 25 MB; a fold took 100 s


def test_section_groups_of_long_chapters(spark):
    n = 40_000
    rows = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit(1).alias("chapter_id"), F.col("id").cast("int").alias("section_id"), F.lit("t").alias("title"), *[F.lit(1).alias(c) for c in ("start_pos", "end_pos", "start_page", "end_page")], F.lit(3).alias("n_lines"), F.lit(200).alias("n_chars"))
    start = time.time()
    sizes = structure.group_sections(rows).groupBy("group_no").count().groupBy("count").count().collect()
    assert [tuple(r) for r in sizes if r[0] == 3] == [(3, n // 3)]
    assert time.time() - start < 60


def test_control_characters_stay(spark):
    text = "a\x01b<!-- 第 1 页 -->c\x01\x02\x03d<!-- 第 2 页 -->\x01"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    pieces = [tuple(p) for p in chunk.page_pieces(docs).first()["pieces"]]
    assert pieces == [(None, 1, "a\x01b<!-- 第 1 页 -->"), (1, 2, "c\x01\x02\x03d<!-- 第 2 页 -->"), (2, None, "\x01")]
    assert chunk.reassemble(chunk.chunk_documents(docs)).first()["text"].rstrip("\n") == text.strip("\n")
    index = spark.createDataFrame([("n", "i", 0, "  - 第一条\x02（第1页）")], "norm string, index_path string, pos int, line string")
    issues = spark.createDataFrame([("n", "i", 0, 7, None)], "norm string, index_path string, pos int, start int, end int")
    assert integrity.fix_pages(index, issues).first()["line"] == "  - 第一条\x02（第7页）"


def test_documents_of_equal_and_null_keys_are_documents_of_their_own(spark):
    text = "# 第一章 总则\n第一条 {0}\n# 第二章 附则\n第二条 {0}"
    rows = [(1, "甲", text.format("one")), (1, "乙", text.format("two")), (None, "丙", text.format("three")), (2, "丁", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, name string, text string")
    files, indexes = driver.split_documents(docs)
    got = sorted((r.path, r.doc_id is None, r.text) for r in files.collect())
    assert len(got) == 7 and all(sum(w in t for w in ("one", "two", "three", "plain")) == 1 for _, _, t in got)
    assert {p.split("/")[0]: none for p, none, _ in got} == {"甲": False, "乙": False, "丙": True, "丁": False}
    assert sorted((r.path, r.files, r.doc_id) for r in indexes.collect() if r.doc_id) == [("丁/丁-index.md", 1, 2), ("乙/乙-index.md", 2, 1), ("甲/甲-index.md", 2, 1)]
    assert [(r.path, r.files) for r in indexes.where("doc_id is null").collect()] == [("丙/丙-index.md", 2)]
    one = docs.where("name = '乙'")
    alone = {r.path: r.text for r in driver.split_documents(one)[0].collect()}
    assert {p: t for p, _, t in got if p.startswith("乙")} == alone
    cleaned = driver.clean_documents(docs, make=lambda: lambda t: t)
    assert sorted(w for r in cleaned.collect() for w in ("one", "two", "three", "plain") if w in r.text) == ["one", "plain", "three", "two"]
    assert sum(r.doc_id is None for r in cleaned.collect()) == 1
