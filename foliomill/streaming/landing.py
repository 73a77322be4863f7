"""Incremental runs: files that land in a folder are processed once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove, remove_at_end, shared_dir
from ..sources.files import write_new


def process_landing(spark: SparkSession, folder: str, schema, out: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], key: str = "doc_id"):
    """Run step over each batch of files that landed since the last run; keys already written aren't written again.

    A batch that is tried again after a failure adds nothing twice.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(folder)
    work = stream.writeStream.foreachBatch(lambda batch, _: write_new(step(batch), out, key)).option("checkpointLocation", checkpoint)
    run = work.trigger(availableNow=True).start()
    run.awaitTermination()
    return run


def replay(docs: DataFrame, step: Callable[[DataFrame], DataFrame], arrivals: int, key: str = "doc_id") -> DataFrame:
    """docs dealt into arrivals that land one after another; the result of processing each as it comes."""
    spark = docs.sparkSession
    base = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    remove_at_end(spark, base)
    for i in range(arrivals):
        docs.where(F.pmod(F.col(key), F.lit(arrivals)) == i).write.mode("append").parquet(f"{base}/in")
        process_landing(spark, f"{base}/in", docs.schema, f"{base}/out", f"{base}/checkpoint", step, key)
    for done in ("in", "checkpoint"):
        remove(spark, f"{base}/{done}")
    return spark.read.parquet(f"{base}/out")
