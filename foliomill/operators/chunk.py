"""Page-bounded chunks of bounded size for model calls, and their reassembly."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import patterns as P
from ..functions import text as T
from . import mask as M

GAPS = re.compile(r"\n{2,}")
#: Text up to and with a page marker, or what is left after the last.
PIECE = rf"(?U)[\s\S]*?{P.PAGE_END}|[\s\S]+"


def page_pieces(docs: DataFrame, text: str = "text", out: str = "pieces") -> DataFrame:
    """Add array<struct<page_no, page, text>>: pieces that end with their marker.

    ``page_no`` is the marker before the piece (null for the first), ``page`` its
    own; a blank tail goes.
    """
    parts = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    own = F.transform(parts, lambda x: F.struct(F.try_element_at(F.regexp_extract_all(x, F.lit("(?U)" + P.PAGE_END), F.lit(1)), F.lit(-1)).alias("page"), x.alias("text")))
    d = docs.withColumn("_parts", F.transform(own, lambda x: F.struct(T.number(x["page"]).alias("page"), x["text"].alias("text"))))
    every = F.col("_parts")
    pieces = F.transform(every, lambda x, i: F.struct(F.get(every, i - 1)["page"].alias("page_no"), x["page"].alias("page"), x["text"].alias("text")))
    return d.withColumn(out, F.filter(pieces, lambda p: p["page"].isNotNull() | (T.strip(p["text"]) != ""))).drop("_parts")


@F.pandas_udf(ArrayType(StringType()))
def _greedy_chunks(texts: pd.Series, most: pd.Series) -> pd.Series:
    """Paragraphs packed greedily: from each start on, the running sum of lengths says how far a chunk reaches."""

    def chunks(text: str, limit: int) -> list[str]:
        ends = np.array([x for m in GAPS.finditer(text) for x in m.span()] + [len(text)], np.int64)
        ends = np.unique(ends[ends > 0])
        out, at = [], 0
        while at < len(text):
            reach = int(np.searchsorted(ends, at + limit, side="right")) - 1
            if reach >= 0 and ends[reach] > at:
                out.append(text[at : ends[reach]])
                at = int(ends[reach])
            else:  # a paragraph beyond the limit is cut
                end = int(ends[reach + 1])
                out += [text[i : min(i + limit, end)] for i in range(at, end, limit)]
                at = end
        return out

    return pd.Series([None if x is None else chunks(x, int(m)) for x, m in zip(texts, most, strict=True)])


def split_by_size(text: Column, most: int = P.CHUNK_CHARS) -> Column:
    """Paragraphs packed greedily into strings of at most ``most`` characters; longer ones are cut.

    Where a chunk begins depends on all chunks before it, which built-in folds
    can only follow by copying what they have; so texts beyond one chunk, and
    they alone, go through Python, in time linear in their length.
    """
    short = F.length(text) <= most
    return F.when(short, F.array(text)).otherwise(_greedy_chunks(F.when(~short, text), F.lit(most)))


def chunk_documents(docs: DataFrame, most: int = P.CHUNK_CHARS, key: str = "doc_id", text: str = "text", mask_first: bool = False) -> DataFrame:
    """key, chunk_ord, page_no, seq, text (masked), placeholders.

    Sizes are cut before masking, so a long table can fall into two chunks;
    mask_first keeps regions whole and may exceed the size by their length.
    """
    if mask_first:
        docs = docs.withColumn("_holders", M.placeholders(F.col(text))).withColumn(text, M.mask_protected(F.col(text)))
    pages = page_pieces(docs, text, "_pieces").select(key, *(["_holders"] if mask_first else []), F.posexplode("_pieces").alias("_p", "_piece"))
    parts = pages.select("*", F.posexplode(split_by_size(F.col("_piece.text"), most)).alias("seq", "_text"))
    ordered = parts.withColumn("chunk_ord", F.struct("_p", "seq"))
    if mask_first:
        holders, masked = F.filter("_holders", lambda h: F.col("_text").contains(h["token"])), F.col("_text")
    else:
        holders, masked = M.placeholders(F.col("_text")), M.mask_protected(F.col("_text"))
    return ordered.select(key, "chunk_ord", F.col("_piece.page_no").alias("page_no"), "seq", masked.alias("text"), holders.alias("placeholders"))


def reassemble(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and text of the chunks in their order, regions restored, blank runs compressed, one final newline."""
    rows = chunks.select(key, F.struct("chunk_ord", M.unmask(F.col("text"), F.col("placeholders")).alias("t")).alias("c"))
    joined = rows.groupBy(key).agg(F.array_sort(F.collect_list("c")).alias("c"))
    whole = F.array_join(F.transform("c", lambda x: x["t"]), "")
    return joined.select(key, F.concat(T.strip(T.compress_blank_lines(whole)), F.lit("\n")).alias("text"))
