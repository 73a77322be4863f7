"""Files in and out: listing, choosing, reading whole texts, writing only what is new."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..session import cut, scratch


def name_parts(files: DataFrame) -> DataFrame:
    """Add name, stem and ext (lower case) of path."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.withColumn("name", name).withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", "")).withColumn("ext", F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1)))


def list_files(spark: SparkSession, folder: str, kinds: tuple[str, ...] = P.FORMATS, recursive: bool = False, only: str | None = None) -> DataFrame:
    """Binary files of the given kinds with their name parts, by path; or the one file ``only``, if it is of such a kind."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return name_parts(read.load(only or folder)).where(F.col("ext").isin(*kinds)).orderBy("path")


def best_format(files: DataFrame) -> DataFrame:
    """One file of each stem in the best of its formats."""
    parts = name_parts(files)
    rank = F.array_position(F.array(*[F.lit(x) for x in P.FORMATS]), F.col("ext"))
    known = parts.where(rank > 0).withColumn("_rank", rank)
    first = F.row_number().over(Window.partitionBy("stem").orderBy("_rank", "path"))
    return known.withColumn("_n", first).where("_n = 1").drop("_n", "_rank")


def split_kinds(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Body files and index files (name ends in -index.md) among Markdown files (path)."""
    d = name_parts(files).where("ext = '.md'")
    return d.where(~F.col("name").endswith("-index.md")), d.where(F.col("name").endswith("-index.md"))


def read_markdown(spark: SparkSession, folder: str, only: DataFrame | None = None, recursive: bool = False) -> DataFrame:
    """stem and text of the Markdown files of a folder (names that begin with _ aside); or of those named."""
    raw = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    docs = name_parts(raw).where((F.col("ext") == ".md") & ~F.col("name").startswith("_")).select("stem", "text")
    if only is None:
        return docs
    wanted = only.select(F.regexp_replace("name", r"\.md$", "").alias("stem"))
    missing = wanted.join(docs, "stem", "left_anti").limit(5).collect()
    if missing:
        raise FileNotFoundError(", ".join(r["stem"] for r in missing))
    return docs.join(wanted, "stem", "left_semi")


def write_new(docs: DataFrame, path: str, key: str = "doc_id", overwrite: bool = False) -> None:
    """Append the rows whose key has no output yet; or write all anew.

    Of the keys written before, only those between the least and greatest new
    one are read, so files and row groups of older ranges are skipped.
    """
    spark = docs.sparkSession
    if overwrite:
        docs.write.mode("overwrite").parquet(path)
        return
    try:
        written = spark.read.parquet(path).select(key)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        docs.write.mode("append").parquet(path)
        return
    with scratch(spark):
        docs = cut(docs, "new-rows")
        least, most = docs.agg(F.min(key), F.max(key)).first()
        if least is not None:
            done = written.where(F.col(key).between(F.lit(least), F.lit(most)))
            docs = docs.join(done, key, "left_anti").select(*docs.columns)
        docs.write.mode("append").parquet(path)


def write_norms(bodies: DataFrame, path: str, norm: str = "norm") -> None:
    """Body files by norm; the norms that are written are replaced whole, others stay."""
    bodies.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(norm).parquet(path)


def write_markdown(files: DataFrame, folder: str) -> DataFrame:
    """Write each text to its path below a folder on storage that all executors share; path and bytes of what was written.

    One small file for each row, written by the task that holds it; a task that
    is tried again writes the same bytes.
    """
    import os
    from collections.abc import Iterator

    import pandas as pd

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for path, text in zip(batch["path"], batch["text"], strict=True):
                where = os.path.normpath(os.path.join(folder, path))
                if not where.startswith(os.path.normpath(folder) + os.sep):
                    raise ValueError(f"{path} leaves the folder")
                os.makedirs(os.path.dirname(where), exist_ok=True)
                part = f"{where}.{os.getpid()}.part"
                with open(part, "w", encoding="utf-8", newline="") as f:
                    f.write(text)
                os.replace(part, where)
                sizes.append(len(text.encode()))
            yield pd.DataFrame({"path": batch["path"], "bytes": sizes})

    return files.select("path", "text").mapInPandas(write, "path string, bytes long")


def image_urls(files: DataFrame) -> DataFrame:
    """path and data URL of image files."""
    return files.select("path", T.data_url(F.col("content"), F.col("path")).alias("url"))
