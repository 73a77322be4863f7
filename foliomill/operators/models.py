"""Model calls behind an injected callable; the default changes nothing and needs no network."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as Q
from ..functions import text as T
from . import answers
from . import mask as M
from .answers import with_retries


def call_model(df: DataFrame, make: Callable[[], Callable[[str], str]], column: str = "text", fallback: str | None = None, store: str | None = None, prompt: str = "") -> DataFrame:
    """Add model_text, model_ok and model_error.

    ``make`` builds the client once in each Python worker.  Blank texts aren't
    sent.  A failed call gives the input back, or ``fallback`` where it is set.
    Store the result before using it twice, or calls are paid for again; or name
    a ``store`` of answers on storage that all executors share (``answers.ask``),
    where each text is asked once for each prompt.
    """
    if store is not None:
        return answers.ask(df, make, store, column, prompt, fallback)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = with_retries(make())
        for batch in batches:
            out = []
            for text in batch[column]:
                if text is None or not text.strip():
                    out.append((text, True, None))
                    continue
                try:
                    out.append((call(text), True, None))
                except Exception as e:
                    out.append((text if fallback is None else fallback, False, str(e)))
            yield batch.assign(**dict(zip(("model_text", "model_ok", "model_error"), zip(*out, strict=True), strict=True))) if out else batch.assign(model_text=None, model_ok=None, model_error=None)

    return df.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", model_text string, model_ok boolean, model_error string")


def identity() -> Callable[[str], str]:
    return lambda text: text


def clean_chunks(chunks: DataFrame, make: Callable[[], Callable[[str], str]] = identity, store: str | None = None) -> DataFrame:
    """Chunks with the model's text where it kept all placeholders; else as they were, with the reason.

    Adds ok, error and new_tables.  With a store of answers equal chunks are asked once.
    """
    keyed = chunks.withColumn("_json", F.to_json("placeholders")).withColumn("_ord", F.to_json("chunk_ord"))
    flat = keyed.select("doc_id", "_ord", "page_no", "seq", "text", "_json")
    answered = call_model(flat, make, store=store, prompt="clean")
    back = answered.select(
        "doc_id", F.from_json("_ord", chunks.schema["chunk_ord"].dataType.simpleString()).alias("chunk_ord"), "page_no", "seq", "text",
        F.from_json("_json", chunks.schema["placeholders"].dataType.simpleString()).alias("placeholders"), T.strip_code_fence(F.col("model_text")).alias("_new"), "model_ok", "model_error",
    )
    whole = M.tokens_kept(F.col("_new"), F.col("placeholders"))
    return back.select(
        "doc_id", "chunk_ord", "page_no", "seq",
        F.when(F.col("model_ok") & whole, F.col("_new")).otherwise(F.col("text")).alias("text"),
        "placeholders",
        (F.col("model_ok") & whole).alias("ok"),
        F.when(~F.col("model_ok"), F.col("model_error")).when(~whole, F.lit("placeholder_missing")).alias("error"),
        F.when(whole, T.new_tables(F.col("text"), F.col("_new"))).otherwise(0).alias("new_tables"),
    )


def describe_images(images: DataFrame, make: Callable[[], Callable[[str], str]], store: str | None = None) -> DataFrame:
    """Images (path, content) with model_text, model_ok and model_error: the model is given a data URL; a failed call describes nothing."""
    asked = images.withColumn("_url", T.data_url(F.col("content"), F.col("path")))
    return call_model(asked.drop("content"), make, "_url", "", store, "describe").drop("_url")


def rescue_tables(candidates: DataFrame, make: Callable[[], Callable[[str], str]], store: str | None = None) -> DataFrame:
    """Scored candidates (of ``layout.accept_tables``, with path and content of their picture); a rejected one that the model calls a table is accepted.

    Its score is then at least 0.5.  Accepted ones aren't sent; a failed call rescues nothing.
    """
    asked = candidates.withColumn("_url", F.when(~F.col("accepted"), T.data_url(F.col("content"), F.col("path"))))
    keyed = asked.drop("content").withColumn("_s", F.to_json(F.struct(*[c for c in asked.columns if c not in ("content", "_url", "path")])))
    answered = call_model(keyed.select("path", "_url", "_s"), make, "_url", "", store, "rescue")
    schema = asked.drop("content", "_url", "path").schema.simpleString()
    back = answered.select("path", F.from_json("_s", schema).alias("c"), Q.yes_no(F.when(F.col("_url").isNotNull(), F.col("model_text"))).alias("rescued"), "model_ok").select("path", "c.*", "rescued", "model_ok")
    rescued = F.coalesce(F.col("rescued"), F.lit(False))
    score = F.when(rescued, F.greatest(F.col("s.score"), F.lit(0.5))).otherwise(F.col("s.score"))
    return back.withColumn("score", score).withColumn("accepted", F.col("accepted") | rescued)


def call_counts(answered: DataFrame) -> DataFrame:
    """One row: calls that were made, that succeeded and that failed (blank inputs aren't sent)."""
    return answered.agg(F.count("*").alias("calls"), F.count_if("model_ok").alias("ok"), F.count_if(~F.col("model_ok")).alias("failed"))
