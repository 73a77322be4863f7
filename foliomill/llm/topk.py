"""Exact top-k search by distributed histogram selection.

Vectors are quantised to integers and packed into blocks.  Every query block
meets every candidate block; a task scores the pair by a matrix product and
gives back, for each query, only the histogram of its own k best scores (those of
the k best of all that lie in the block are among them).  The summed histograms
show the bin that holds the k-th score; the next pass splits that bin, until a
bin is one score.  A last pass keeps the scores at or above it, in each block
no more than k by (score, smaller id), and k of those remain.

Vectors that are null, or hold null or non-finite components, take no part;
nor do null ids, and vectors of another length than the query's score nothing.
Candidates of equal ids count each; query rows of equal ids ask once, with the
least of their vectors, and none of the candidates of that id is theirs.  Large
finite components are exact, however large; a score beyond 2^62 - 1 counts as
that.  Ties
go to the smaller id.  Fewer than k candidates give all; no rows give none.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, scratch

BLOCK = "ids binary, vectors binary"
#: How components are stored, by their bytes.
KINDS = {2: "<i2", 4: "<f4", 8: "<f8"}
NONE_BELOW = -(1 << 62)
#: Less than any score.
NOBODY = np.iinfo(np.int64).min
#: Scores beyond it count as it, so that differences of scores fit a long.
MOST = (1 << 62) - 1


def quantise(df: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """id, v (whole numbers floor(scale * x)) and dim of the vectors that take part."""
    largest = F.lit(float(np.finfo(np.float64).max))
    # doubles from 2^53 on are whole already; times the scale they are no more than the largest double
    scaled = lambda x: F.greatest(-largest, F.least(largest, x.cast("double") * scale))
    v = F.transform(F.col(vector), lambda x: F.when(F.abs(scaled(x)) < F.lit(2.0**53), F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    whole = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & whole).select(F.col(key).cast("long").alias("id"), v.alias("v"), F.size(vector).alias("dim"))


def _blocks(rows: DataFrame, size: int, more: str = "") -> DataFrame:
    """Rows packed by size into (dim, ids, vectors[, lo, width]) within their partition."""
    extra = more.split() if more else []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, vectors, *rest = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            # whole numbers, in the fewest bytes that hold the block's largest
            largest = np.abs(vectors).max(initial=0)
            vectors = vectors.astype(KINDS[2] if largest < 1 << 15 else KINDS[4] if largest < 1 << 24 else KINDS[8])
            packed = [pa.array([dim], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, vectors, *rest)]]
            return pa.RecordBatch.from_arrays(packed, ["dim", "ids", "vectors", *extra])

        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                ids = part.column(0).to_numpy(zero_copy_only=False).astype("<i8")
                vectors = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(len(ids), dim)
                columns = [ids, vectors, *[part.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in extra]]
                for i in range(0, len(ids), size):
                    held.setdefault(dim, []).append(tuple(c[i : i + size] for c in columns))
                    if sum(len(x[0]) for x in held[dim]) >= size:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    schema = f"dim int, {BLOCK}" + "".join(f", {c} binary" for c in extra)
    return rows.select("id", "v", "dim", *extra).mapInArrow(pack, schema)


def _grid(queries: DataFrame, candidates: DataFrame, n_candidates: int) -> DataFrame:
    """Every query block beside every candidate block of its dimension, by an equi-join on the block's number.

    The planner takes the queries for as small as they are before each goes to
    every block, and would broadcast all their copies; so it is told to merge.
    """
    asked = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(max(n_candidates - 1, 0)))).alias("block")).hint("merge")
    others = candidates.select("block", F.col("dim").alias("dim_"), F.col("ids").alias("c_ids"), F.col("vectors").alias("c_vectors"))
    return asked.join(others, "block").where("dim = dim_").drop("block", "dim_")


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, at most MOST either way: exact in doubles for components below 2^23, else in whole numbers of any size."""
    dim = max(1, q.shape[1])
    reach = np.sqrt(2.0**52 / dim)  # products of two vectors within it stay below 2^53
    q_big, c_big = (np.abs(x).max(axis=1, initial=0) > reach for x in (q, c))
    if not (q_big.any() or c_big.any()):
        return (q @ c.T).astype(np.int64)
    out = np.zeros((len(q), len(c)), np.int64)
    out[np.ix_(~q_big, ~c_big)] = (q[~q_big] @ c[~c_big].T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    for rows, columns in ((q_big, np.ones(len(c), bool)), (~q_big, c_big)):
        if rows.any() and columns.any():
            exact = whole(q[rows]) @ whole(c[columns]).T
            out[np.ix_(rows, columns)] = np.clip(exact, -MOST, MOST).astype(np.int64)
    return out


def _pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of queries and candidates and their scores, NOBODY where a query meets its own id."""
    q_ids, c_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["c_ids"], "<i8")
    shapes = (("vectors", len(q_ids)), ("c_vectors", len(c_ids)))
    q, c = (np.frombuffer(row[x], KINDS.get(len(row[x]) // max(1, n * row["dim"]), "<f8")).astype(np.float64).reshape(n, row["dim"]) for x, n in shapes)
    scores = _scores(q, c)
    own = np.flatnonzero(np.isin(q_ids, c_ids))
    who, which = np.nonzero(q_ids[own, None] == c_ids)
    scores[own[who], which] = NOBODY
    return q_ids, c_ids, scores


def top_k(df: DataFrame, query: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, bins: int = 1024, block: int = 4096, query_block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of df for each row of query, itself left out."""
    with scratch(df.sparkSession):
        return cut(_top_k(df, query, key, vector, k, scale, bins, block, query_block), "topk", stays=True)


def _top_k(df: DataFrame, query: DataFrame, key: str, vector: str, k: int, scale: int, bins: int, block: int, query_block: int) -> DataFrame:
    candidates = _blocks(quantise(df, key, vector, scale), block).withColumn("block", F.monotonically_increasing_id())
    numbers = Window.orderBy("part", "block")
    # one row for a block of thousands of vectors, so numbering them without gaps is small; the planner sees its size
    parts = cut(candidates.withColumn("part", F.spark_partition_id()), "topk-blocks")
    order = cut(parts.select("part", "block", (F.row_number().over(numbers) - 1).alias("number")), "topk-order")
    candidates = cut(parts.join(order, ["part", "block"]).select(F.col("number").alias("block"), "dim", "ids", "vectors"), "topk-numbered")
    n_blocks = candidates.count()
    asked = quantise(query, key, vector, scale).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    most = quantise(df, key, vector, scale).agg(F.max(norm)).first()[0] or 0.0
    most_asked = asked.agg(F.max(norm)).first()[0] or 0.0
    product = most * most_asked
    reach = math.ceil(product) + 2 if product < MOST else MOST
    width = 1  # a power of bins, so that the next pass's bins fill a bin exactly
    while width * bins < 2 * reach:
        width *= bins
    state = asked.select("id", "v", "dim", F.lit(-reach).cast("long").alias("lo"), F.lit(width).cast("long").alias("width"), F.lit(k).cast("long").alias("need"))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, _, scores = _pair(row)
                lo, width = (np.frombuffer(row[x], "<i8")[:, None] for x in ("lo", "width"))
                # a query's own k best: all of the k best there are that lie in this block
                rest = max(0, scores.shape[1] - k)
                top = np.partition(scores, rest, axis=1)[:, rest:] if scores.size else scores
                # below the range: of no use; above it: counted before, so not again
                bin_ = np.where(top >= lo, (np.maximum(top, lo) - lo) // width, bins)
                who, which = np.nonzero(bin_ < bins)
                cells, counts = np.unique(bin_[who, which] + bins * who, return_counts=True)
                if cells.size:
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[cells // bins]), pa.array(cells % bins), pa.array(counts.astype(np.int64))], ["id", "bin", "n"])

    down = Window.partitionBy("id").orderBy(F.desc("bin"))
    while width >= 1:
        state = cut(state, "topk-state")
        grid = _grid(_blocks(state, query_block, "lo width need"), candidates, n_blocks)
        summed = grid.mapInArrow(histogram, "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        running = summed.withColumn("upto", F.sum("n").over(down))
        found = state.select("id", "need").join(running, "id").where("upto >= need and upto - n < need").select("id", "bin", (F.col("upto") - F.col("n")).alias("above"))
        narrower = max(1, width // bins)
        refined = state.join(found, "id", "left").select(
            "id", "v", "dim",
            # fewer candidates than asked for: all scores count
            F.coalesce(F.col("lo") + F.col("bin") * F.col("width"), F.lit(NONE_BELOW)).alias("lo"),
            F.when(F.col("bin").isNull(), 1).otherwise(narrower).cast("long").alias("width"),
            (F.col("need") - F.coalesce("above", F.lit(0))).alias("need"),
        )
        state = refined
        if width == 1:
            break
        width = narrower

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids, scores = _pair(row)
                who, which = np.nonzero(scores >= np.frombuffer(row["lo"], "<i8")[:, None])
                if not len(who):
                    continue
                score = scores[who, which]
                order = np.lexsort((c_ids[which], -score, who))
                who, which, score = who[order], which[order], score[order]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                who, which, score = (x[place < k] for x in (who, which, score))
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[who]), pa.array(c_ids[which]), pa.array(score)], ["query_id", "vec_id", "score"])

    state = cut(state, "topk-state")
    kept = _grid(_blocks(state, query_block, "lo"), candidates, n_blocks).mapInArrow(select, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
