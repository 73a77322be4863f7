"""Model answers that are kept: each distinct text is asked once, however often runs are repeated.

The store is a folder of Parquet files (key, answer) below ``prompt=…``, one for
each prompt.  Tasks write answers there while they work, every few seconds, so a
task that is killed loses at most those of the last seconds; a task that is tried again
reads what its earlier attempts wrote and goes on from there.  Speculative copies
of a task ask twice and change nothing else.

Failed calls aren't kept: the next run tries them again.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Thread

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut, remove, scratch
from ..sources.word import store_of

SCHEMA = "key string, answer string"


def within(call: Callable[[str], str], seconds: float | None) -> Callable[[str], str]:
    """call, given up with an error after so many seconds; its thread goes on in the background, for Python can't stop it."""
    if seconds is None:
        return call

    def timed(text: str) -> str:
        got: list = []

        def work() -> None:
            try:
                got.append((call(text), None))
            except Exception as e:
                got.append((None, e))

        thread = Thread(target=work, daemon=True)
        thread.start()
        thread.join(seconds)
        if not got:
            raise TimeoutError(f"no answer within {seconds} s")
        if got[0][1] is not None:
            raise got[0][1]
        return got[0][0]

    return timed


def with_retries(call: Callable[[str], str], attempts: int = 3, least: float = 2.0, most: float = 15.0) -> Callable[[str], str]:
    """call, tried again with growing pauses; the last error is raised."""

    def tried(text: str) -> str:
        for n in range(attempts):
            try:
                return call(text)
            except Exception:
                if n + 1 == attempts:
                    raise
                time.sleep(min(most, least * 2**n))
        raise AssertionError

    return tried


def key_of(text: Column) -> Column:
    """The key of a text; null for a blank one, which isn't sent."""
    return F.when(F.coalesce(T.strip(text), F.lit("")) != "", F.sha2(text.cast("binary"), 256))


def _folder(store: str, prompt: str) -> str:
    return f"{store}/prompt={hashlib.sha256(prompt.encode()).hexdigest()}"


def kept(spark: SparkSession, store: str, prompt: str = "") -> DataFrame:
    """Answers of a prompt (key, answer), one for each key."""
    try:
        found = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(_folder(store, prompt))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return found.groupBy("key").agg(F.min("answer").alias("answer"))


def keep(folder: str, files: fs.FileSystem, answers: list[tuple[str, str]]) -> None:
    """Write answers (key, answer) as one file, which readers see whole or not at all."""
    name = f"{folder}/{uuid.uuid4().hex}"
    keys, texts = zip(*answers, strict=True)
    pq.write_table(pa.table({"key": pa.array(keys, pa.string()), "answer": pa.array(texts, pa.string())}), f"{name}.part", filesystem=files)
    files.move(f"{name}.part", f"{name}.parquet")


def _asking(folder: str, make: Callable, limits: dict) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """What a task does: ask for the texts (key, text) that none of its attempts has an answer of, some at once; the failures (key, error)."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, where, _ = store_of(folder)
        mine = f"{where}/part={TaskContext.get().partitionId()}"
        files.create_dir(mine, recursive=True)
        done: set[str] = set()
        for f in files.get_file_info(fs.FileSelector(mine)):
            if f.extension == "parquet":
                done.update(pq.read_table(f.path, columns=["key"], filesystem=files, partitioning=None)["key"].to_pylist())
        call = None
        for batch in batches:
            left = [(k, t) for k, t in zip(batch["key"], batch["text"], strict=True) if k not in done]
            if left and call is None:
                call = with_retries(within(make(), limits["seconds"]), limits["attempts"], limits["pause"])
            failed, answers, since = [], [], time.monotonic()
            for at in range(0, len(left), limits["flush"]):
                with ThreadPoolExecutor(limits["at_once"]) as pool:
                    asked = [(k, pool.submit(call, t)) for k, t in left[at : at + limits["flush"]]]
                answers += [(k, f.result()) for k, f in asked if f.exception() is None]
                failed += [(k, str(f.exception()) or type(f.exception()).__name__) for k, f in asked if f.exception() is not None]
                if answers and (time.monotonic() - since >= limits["every"] or at + limits["flush"] >= len(left)):
                    keep(mine, files, answers)
                    answers, since = [], time.monotonic()
            yield pd.DataFrame(failed, columns=["key", "error"])

    return ask


def ask(
    df: DataFrame, make: Callable[[], Callable[[str], str]], store: str, column: str = "text", prompt: str = "", fallback: str | None = None, tasks: int | None = None,
    seconds: float | None = 120.0, attempts: int = 3, pause: float = 2.0, at_once: int = 4, flush: int = 32, every: float = 10.0,
) -> DataFrame:
    """df with model_text, model_ok and model_error; the calls are made at once, those for kept answers not at all.

    ``prompt`` tells apart what is asked of equal texts (model and prompt by
    name); ``make`` builds the client once in each task.  Blank texts aren't sent
    and stay as they are.  A call that fails ``attempts`` times, or takes longer
    than ``seconds``, gives the input back, or ``fallback``.  A task has
    ``at_once`` calls open; after each ``flush`` calls it keeps the answers, if the last
    time was ``every`` seconds ago or the batch is done, so fast models make few files.

    Equal texts are made one before the shuffle.  The join back goes by key:
    a text that very many rows share makes a skewed key there, which adaptive
    execution splits.  df is read twice and must be the same both times.
    """
    spark = df.sparkSession
    added = ("model_text", "model_ok", "model_error")
    # the row goes along whole, so its columns may have any names
    keyed = df.select(key_of(F.col(column)).alias("key"), F.col(column).alias("text"), F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in added]).alias("row"))
    wanted = keyed.where("key is not null").select("key", "text").distinct()
    pending = wanted.join(kept(spark, store, prompt).select("key"), "key", "left_anti")
    limits = {"seconds": seconds, "attempts": attempts, "pause": pause, "at_once": at_once, "flush": flush, "every": every}
    with scratch(spark):
        # rows of a stored table are dealt to tasks alike each time a task is tried
        pending = cut(pending.repartition(tasks, "key") if tasks else pending, "model-pending")
        failed = cut(pending.mapInPandas(_asking(f"{_folder(store, prompt)}/run={uuid.uuid4().hex}", make, limits), "key string, error string"), "model-failed", stays=1)
    found = keyed.join(kept(spark, store, prompt), "key", "left").join(failed, "key", "left")
    text = F.when(F.col("key").isNull(), F.col("text")).otherwise(F.coalesce("answer", "text" if fallback is None else F.lit(fallback)))
    ok = F.col("key").isNull() | F.col("answer").isNotNull()
    return found.select("row.*", text.alias("model_text"), ok.alias("model_ok"), F.when(~ok, F.col("error")).alias("model_error"))


def compact(spark: SparkSession, store: str, prompt: str = "") -> None:
    """Put the answers of a prompt into few files; to be run while nobody asks."""
    folder = _folder(store, prompt)
    files, where, _ = store_of(folder)
    old = [f.path for f in files.get_file_info(fs.FileSelector(where)) if f.type == fs.FileType.Directory]
    kept(spark, store, prompt).write.parquet(f"{folder}/run={uuid.uuid4().hex}")
    prefix = folder.removesuffix(where)
    for path in old:
        remove(spark, prefix + path)
