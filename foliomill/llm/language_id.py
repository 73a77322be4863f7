"""Language identification by language-bitmask n-gram filters.

Letter trigrams are counted for each language over all documents that may be
learned from; a trigram belongs to a language if it is frequent there and not
far more frequent elsewhere.  The filters of all languages share one bit-sliced
Bloom table: a row is a hash position, its bits are the languages, so the AND of
a trigram's rows is the set of languages that contain it.  A text's hits are
popcounts of each language over its trigrams, less what false positives alone
would give; the most hits decide.

Null and empty texts and texts without a letter are ``und`` with score 0; a text
of any length is one row, read whole.  Null languages teach nothing; with nothing
learned every text is ``und``.  Languages with equally many hits go to the first
by name.  Repeated rows and rows of equal keys are predicted each by itself, and
no rows give no rows.  Extra columns are ignored by ``predict`` and pass through
``keep_known``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import under_plain_names

UND = "und"
HASHES = 3
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]] = True
    return table


def trigrams(text: str | None) -> np.ndarray:
    """Codes of the trigrams around each letter of the lower-cased text; other characters are one space."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    letter = _letters()[points]
    points[~letter] = 32
    return ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[letter[1:-1]]


def count_trigrams(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = 2_000_000) -> DataFrame:
    """lang, gram, n over all rows; tasks add up their rows before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def settle() -> None:
            for name, parts in held.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                if name in sums:
                    both = np.concatenate([sums[name][0], grams])
                    grams, where = np.unique(both, return_inverse=True)
                    n = np.bincount(where, np.concatenate([sums[name][1], n])).astype(np.int64)
                sums[name] = (grams, n)
            held.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for name, (grams, n) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = trigrams(value.as_py())
                held.setdefault(name, []).append(codes)
                size += len(codes)
                if size > most:
                    settle()
                    size = 0
                    if sum(len(g) for g, _ in sums.values()) > most:
                        yield from out()
        settle()
        yield from out()

    raw = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text).mapInArrow(count, "lang string, gram long, n long")
    return raw.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _rows(grams: np.ndarray, size: int) -> np.ndarray:
    """The filter rows of each gram, one column a hash."""
    mixed = grams.astype(np.uint64)[:, None] * MIX[None, :]
    return ((mixed ^ (mixed >> np.uint64(29))) * MIX[::-1][None, :] >> np.uint64(40)).astype(np.int64) % size


def fit(docs: DataFrame, learn: Column | None = None, lang: str = "lang", text: str = "text", rate: float = 1e-5, share: float = 0.2) -> dict:
    """The filters, from all rows for which learn holds.

    A language has at most 1 / rate grams of that rate, which bounds what comes
    to the driver and the size of the table.
    """
    counts = count_trigrams(docs.where(learn) if learn is not None else docs, lang, text)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    known = rates.where(F.col("rate") >= rate)
    least = known.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("lang", "rate")).alias("of"))
    held = least.select("gram", F.transform(F.filter("of", lambda x: x["rate"] >= share * F.col("most")), lambda x: x["lang"]).alias("langs")).toArrow()
    names = sorted({x for y in held["langs"].to_pylist() for x in y})
    grams = held["gram"].to_numpy()
    size = 1 << max(10, int(8 * max(1, len(grams)) - 1).bit_length())
    words = max(1, -(-len(names) // 64))
    table = np.zeros((size, words), np.uint64)
    number = {x: i for i, x in enumerate(names)}
    masks = np.zeros((len(grams), words), np.uint64)
    for row, of in enumerate(held["langs"].to_pylist()):
        for x in of:
            masks[row, number[x] // 64] |= np.uint64(1 << number[x] % 64)
    for rows in _rows(grams, size).T:
        np.bitwise_or.at(table, rows, masks)
    fill = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(names))])
    return {"names": names, "table": table, "false": fill**HASHES}


def identify(text: str | None, model: dict) -> tuple[str, float]:
    """The language with the most corrected hits and their share of the trigrams."""
    grams = trigrams(text)
    names, table, false = model["names"], model["table"], model["false"]
    if not len(grams) or not names:
        return UND, 0.0
    rows = _rows(grams, len(table))
    found = table[rows[:, 0]]
    for i in range(1, HASHES):
        found = found & table[rows[:, i]]
    hits = np.concatenate([np.unpackbits(np.ascontiguousarray(found[:, w]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for w in range(found.shape[1])])[: len(names)]
    right = np.clip((hits - len(grams) * false) / (1 - np.minimum(false, 0.999)), 0, len(grams))
    best = int(right.argmax())
    return names[best], float(right[best] / len(grams))


def predict(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(x.as_py(), shared.value) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], [key, "lang_pred", "score"])

    return docs.select(key, text).mapInArrow(rows, f"`{key}` {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: dict, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of docs whose language is found with at least that score, with their columns."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(x.as_py(), shared.value) for x in batch.column(at)]
            yield batch.filter(pa.array([name != UND and score >= least for name, score in found], pa.bool_()))

    return under_plain_names(docs, [text], [], lambda d: d.mapInArrow(rows, d.schema))
