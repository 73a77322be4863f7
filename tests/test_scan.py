"""Lines of documents in blocks give what whole windows give, and a long document is many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from foliomill.operators import driver, lines, scan, split, structure


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(12)
    pieces = ["# 第一章 总则", "## 1.1 范围", "第一条 内容", "", " ", "<!-- 第 3 页 -->", "<!-- 第 4 页 --> text", "<table>", "</table>", "<table><tr></tr></table>", "样表 1", "（一）甲", "一、概述", "plain", "# 条文说明", "附：样表"]
    rows = [(k, 40 * i + rnd.choice([0, 1, 3]), rnd.choice(pieces)) for k in (1, 2, 3, None) for i in range(rnd.choice([5, 60, 150]))]
    return spark.createDataFrame(sorted(rows, key=str), "doc_id int, pos int, line string").repartition(3).cache()


@pytest.mark.parametrize("block", [90])
def test_blocks_give_what_windows_give(mixed, block):
    assert rows_of(lines.with_pages(mixed, block=block)) == rows_of(lines.with_pages(mixed))
    content = {"origin": "content", "first": F.col("line").startswith("#")}
    assert rows_of(lines.with_pages(mixed, block=block, **content)) == rows_of(lines.with_pages(mixed, **content))
    assert rows_of(lines.collapse_blanks(mixed, block=block)) == rows_of(lines.collapse_blanks(mixed))
    assert rows_of(split.table_islands(mixed, ["doc_id"], block=block)) == rows_of(split.table_islands(mixed, ["doc_id"]))
    paged = lines.with_pages(mixed)
    assert rows_of(split.table_spans(paged, block=block)) == rows_of(split.table_spans(paged))
    for origin in ("document", "content"):
        assert rows_of(structure.structure_lines(mixed, origin, block=block)) == rows_of(structure.structure_lines(mixed, origin))


def test_running_kinds(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.choice([None, *range(9)])) for i in range(300)]
    d = spark.createDataFrame(rows, "k string, pos int, v int")
    for before in (False, True):
        specs = {"m": ("max", F.col("v")), "s": ("sum", F.col("v")), "l": ("last", F.col("v"))}
        want = []
        for k, p, v in rows:
            seen = [x for k2, q, x in rows if k2 == k and (q < p if before else q <= p) and x is not None]
            want.append((k, p, v, max(seen, default=None), sum(seen) if seen else None, seen[-1] if seen else None))
        for block in (None, 7):
            got = scan.running(d, ["k"], block, before, **specs).select("k", "pos", "v", "m", "s", "l").collect()
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_long_document_is_many_tasks(spark):
    """200,000 lines of one document: no partition holds more than a few blocks of them."""
    n = 200_000
    doc = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").alias("pos"), F.when(F.col("id") % 1000 == 999, F.concat(F.lit("<!-- 第 "), F.expr("id div 1000 + 1"), F.lit(" 页 -->"))).otherwise(F.lit("text")).alias("line"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paged = lines.with_pages(doc, block=1 << 12)
        dealt = paged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.count_if(F.col("page") == F.expr("(pos + 1) div 1000 + 1")).alias("right")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.rows for r in dealt) == sum(r.right for r in dealt) == n
    assert len(dealt) > 8 and max(r.rows for r in dealt) < n // 4


def test_drivers_take_long_documents_in_blocks(spark, monkeypatch):
    text = "# 第一章 总则\n第一条 甲\n<!-- 第 1 页 -->\n<table>\n</table>\n# 第二章 附则\n第二条 乙\n" * 3
    docs = spark.createDataFrame([(1, "规范", text), (2, "另一", "无章\n")], "doc_id long, name string, text string")
    whole = [rows_of(x) for x in driver.split_documents(docs)]
    monkeypatch.setattr(scan, "LONG", 10)
    monkeypatch.setattr(scan, "BLOCK", 4)
    assert scan.block_for(docs) == 4
    assert [rows_of(x) for x in driver.split_documents(docs)] == whole
