"""Word documents as a data source, and body files published whole."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from foliomill.sources import docx, files, norms, word

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def write_docx(path, *texts):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(f'<w:p><w:r><w:t>{t}</w:t></w:r></w:p>' for t in texts)}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    path.write_bytes(data.getvalue())


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def folder(tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    for i in range(6):
        write_docx(at / f"d{i}.docx", *[f"line {i} {j}" for j in range(i)])
    (at / "broken.docx").write_bytes(b"no zip")
    (at / "old.doc").write_bytes(b"old")
    (at / "note.txt").write_bytes(b"text")
    (at / "~lock.docx").write_bytes(b"")
    return at


def test_word_source_reads_what_the_function_reads(spark, folder):
    word.register(spark)
    got = spark.read.format("foliomill_docx").option("partitionBytes", 700).load(str(folder))
    assert got.rdd.getNumPartitions() > 2
    raw = files.list_files(spark, str(folder)).where(~F.col("name").startswith("~"))
    short = F.regexp_replace("path", "^file:", "").alias("path")
    columns = [c for c in got.columns if c != "path"]
    assert as_rows(got.select("path", *columns)) == as_rows(docx.docx_blocks(raw).select(short, *columns))
    assert got.where("status = 'failed'").count() == 2


def test_word_source_opens_only_asked_files(spark, folder):
    word.register(spark)
    os.remove(folder / "d3.docx")
    os.mkfifo(folder / "d3.docx")  # opening it would never end; it isn't a file, so it is not listed
    os.symlink("/nowhere/d.docx", folder / "d9.docx")
    got = spark.read.format("foliomill_docx").load(f"file://{folder}")
    assert as_rows(got.where(F.col("path").endswith("d2.docx")).select("kind").distinct()) == [("paragraph",), ("table",)]
    reader = word.Reader({"path": str(folder)}, ["path"])
    from pyspark.sql.datasource import EqualTo, GreaterThan, StringStartsWith

    left = list(reader.pushFilters([EqualTo(("path",), f"{folder}/d2.docx"), StringStartsWith(("path",), str(folder)), GreaterThan(("block_pos",), 1), EqualTo(("kind",), "table")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert [p.paths for p in reader.partitions()] == [[f"{folder}/d2.docx"]]


def test_word_source_prunes_columns_and_takes_no_files(spark, folder, tmp_path):
    word.register(spark)
    got = spark.read.format("foliomill_docx").schema("path string, status string").load(str(folder))
    assert got.columns == ["path", "status"] and got.where("status = 'ok'").count() == sum(range(6)) + 6
    (tmp_path / "none").mkdir()
    assert spark.read.format("foliomill_docx").load(str(tmp_path / "none")).count() == 0


def test_word_stream_reads_each_file_once(spark, folder, tmp_path):
    word.register(spark)

    def run():
        stream = spark.readStream.format("foliomill_docx").option("log", str(tmp_path / "log")).load(str(folder))
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()

    run()
    late = folder / "late.docx"
    write_docx(late, "late")
    os.utime(late, (1, 1))  # landed later, but older than all
    run()
    run()
    batch = spark.read.format("foliomill_docx").load(str(folder))
    assert as_rows(spark.read.parquet(str(tmp_path / "out"))) == as_rows(batch)


def test_norms_are_published_whole(spark, tmp_path):
    path = str(tmp_path / "norms")
    rows = lambda *x: spark.createDataFrame(x, "norm string, path string, text string")
    with pytest.raises(FileNotFoundError):
        norms.read(spark, path)
    assert norms.write(rows(("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z"), (None, "1", "n")), path) == 1
    old = as_rows(norms.read(spark, path))

    @F.udf("string")
    def fails(text):
        if text == "bad":
            raise ValueError("midway")
        return text

    with pytest.raises(Exception, match="midway"):
        norms.write(rows(("a", "1", "new"), ("b", "1", "bad")).repartition(2, "path", "norm").withColumn("text", fails("text")), path)
    assert as_rows(norms.read(spark, path)) == old and len(norms.unpublished(spark, path)) == 1
    staged = norms.stage(rows(("a", "3", "w"), (None, "2", "m")), path)
    assert as_rows(norms.read(spark, path)) == old
    norms.publish(spark, path, staged)
    now = sorted([("a", "3", "w"), ("b", "1", "z"), (None, "2", "m")], key=str)
    assert as_rows(norms.read(spark, path)) == now
    norms.write(rows(("b", "9", "q")).limit(0), path)
    assert as_rows(norms.read(spark, path)) == now
    assert norms.compact(spark, path) == 4 and len(norms.runs(spark, path)) == 1
    assert as_rows(norms.read(spark, path)) == now
    norms.write(rows(("b", "2", "t")).withColumn("more", F.lit(1)), path)
    assert as_rows(norms.read(spark, path).where("norm = 'b'")) == [("b", "2", "t", 1)]


def test_two_publishers_take_two_numbers(spark, tmp_path):
    path = str(tmp_path / "norms")
    one, two = (norms.stage(spark.createDataFrame([(n, "1")], "norm string, path string"), path) for n in "ab")
    assert {norms.publish(spark, path, two), norms.publish(spark, path, one)} == {1, 2}
    assert as_rows(norms.read(spark, path)) == [("a", "1"), ("b", "1")]
