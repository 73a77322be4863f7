"""Totals of reports are taken while the rows are stored."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from foliomill.operators import driver, report


def test_rows_are_made_once(spark, tmp_path):
    made = str(tmp_path / "made")

    @F.udf("long")
    def marked(n):
        with open(f"{made}-{n}", "a") as f:
            f.write("x")
        return n

    rows, totals = report.observed(spark.range(20).select(marked.asNondeterministic()("id").alias("n")), "numbers", F.count("*").alias("rows"), F.sum("n").alias("sum"))
    assert tuple(totals.first()) == (20, 190) and rows.agg(F.sum("n")).first()[0] == 190 and rows.count() == 20
    assert [len(f.read_text()) for f in tmp_path.glob("made-*")] == [1] * 20


def test_totals_equal_those_of_an_aggregate(spark):
    records = spark.createDataFrame([("a", "pdf", "ok", None, 5, 2, 1, 0, 3, 2, 1), ("b", "doc", "failed", "no", 0, 0, 0, 0, 0, 0, 0), ("c", "pdf", "skipped: old", None, None, None, None, None, None, None, None)], "file string, kind string, status string, error string, n_chars long, pages long, tables long, images long, model_calls long, model_ok long, model_failed long")
    for rows in (records, records.limit(0), records.where("false")):
        kept, totals = report.observed(rows, "records", *report._extraction_figures())
        assert totals.collect() == report.extraction_totals(rows).collect() and kept.count() == rows.count()


def test_reports_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    lines = [r["value"] for r in report.text_of(report.clean_report(driver.clean_documents(none))).collect()]
    assert "| 文件总数 | 0 |" in lines and not any(x.startswith("## 文件明细") for x in lines)
    named = none.withColumn("name", F.lit("n"))
    assert report.text_of(report.split_report(driver.split_documents(named)[1])).count() == 6  # the title, the number of files and the heads


def test_halves_of_a_hundredth_of_a_percent_are_shown_upwards(spark):
    figures = [(169, 160), (171, 160), (7, 32), (1, 3), (2, 3), (0, 5), (0, 0), (3, 1), (1, 20000), (57345, 100000)]
    rows = [(i, 1, 1, source, body) for i, (body, source) in enumerate(figures)]
    found = report.split_report(spark.createDataFrame(rows, "doc_id long, chapters int, files int, src_lines int, body_lines long"))
    shown = [r.line.split(" | ")[-1].split("%")[0] for r in found.where("part = 1").orderBy("ord").collect()]
    exact = [(Decimal(100 * body) / (source or 1)).quantize(Decimal("0.01"), ROUND_HALF_UP) for body, source in figures]
    assert shown == [str(x) for x in exact] and shown[:3] == ["105.63", "106.88", "21.88"]
