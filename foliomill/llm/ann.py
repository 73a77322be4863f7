"""Approximate nearest neighbours by balanced posting lists.

1. Centroids are fitted on a bounded sample (the SAMPLE vectors whose hashed ids
   are least), by halving at medians and Lloyd rounds that favour short lists.
2. Every vector is indexed: a search of the centroids' graph, which tasks hold in
   memory, finds its nearest ones.  It goes to the nearest list; a boundary
   vector, nearly as close to others, goes to those too.
3. A query searches the same graph, and asks every list whose centroid is at most
   ``ask`` times as far as the nearest one, or as the sample's nearer vectors are
   from theirs (a query that is a centroid itself would ask one list alone); and
   so many of the nearest that they hold k candidates several times over.
4. Lists that lie side by side make blocks of about as many vectors each, and a
   list that holds a third of all vectors is many blocks. A query goes to a block
   once, with the bits of the lists that it asks there. A block and the queries
   that ask it are matrix products; a task keeps k for each query.

Largest inner products are nearest: vectors are divided by the greatest norm and
get the component sqrt(1 - square of the norm), queries get 0, and then the
distance falls as the inner product grows.  One vector that is far longer than
all others flattens the lists of those, and recall with it.

The index is bounded for the driver and for tasks by SAMPLE and LISTS.  Beyond
PER_LIST * LISTS vectors lists grow, and are searched whole in more blocks.

Vectors that are null, zero, or hold null or non-finite components, and null ids,
take no part; nor do those of another length than the commonest.  Rows of equal
ids count each; query rows of equal ids ask once, with the least of their
vectors, and no row of that id is a candidate of theirs.  Ties go to the smaller
id.  Fewer than k candidates found give all; no rows give none.  Extra columns
are ignored, whatever their names.  Scores are inner products in double precision,
summed in one order, so equal vectors score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, scratch
from .lists import balanced_centroids, graph, homes, squares, walk
from .vectors import quoted, usual_length, whole

SAMPLE, LISTS, PER_LIST = 32768, 4096, 128
#: Boundary vectors: as near as this to at most so many lists.
BOUNDARY, COPIES = 1.02, 2
#: A query asks lists up to so many times as far as its nearest one.
ASK = 1.2
#: Vectors in a block, on average; queries that meet one at once, and in one group.
BLOCK, QUERY_BLOCK, ASKING = 8192, 256, 8192


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of norm 1 whose distance from a query (with 0 as its last component) falls as the inner product grows."""
    v = v / longest
    return np.concatenate([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))[:, None]], axis=1)


def fit_lists(rows: DataFrame, dim: int, longest: float, sample: int = SAMPLE, lists: int = LISTS, per_list: int = PER_LIST) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centroids, their graph and its entries, and the first decile of distances from the nearest centroid, of the vectors v of rows (id, v)."""
    taken = rows.select("v", F.xxhash64("id").alias("h"), "id").orderBy("h", "id", "v").limit(sample).select("v").toArrow()
    points = _lifted(_matrix(taken["v"].combine_chunks(), dim), longest)
    centroids = balanced_centroids(points, max(1, min(lists, rows.count() // per_list, len(points) // 8)))
    near = np.concatenate([squares(points[i : i + 4096], centroids).min(axis=1) for i in range(0, len(points), 4096)])
    return centroids, *graph(centroids), float(np.sqrt(np.quantile(near, 0.1)))


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best of each query (query, row, id, score), each row once, by score, then id."""
    query, row, id_, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((row, id_, -score, query))
    query, row, id_, score = (x[order] for x in (query, row, id_, score))
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (row[1:] != row[:-1])
    query, row, id_, score = (x[new] for x in (query, row, id_, score))
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return [x[keep] for x in (query, row, id_, score)]


def nearest(df: DataFrame, query: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, ask: float = ASK, boundary: float = BOUNDARY, copies: int = COPIES, sample: int = SAMPLE, lists: int = LISTS, per_list: int = PER_LIST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of df found for each row of query, itself left out."""
    with scratch(df.sparkSession):
        return cut(_nearest(df, query, key, vector, k, ask, boundary, copies, sample, lists, per_list), "ann", stays=True)


def _nearest(df: DataFrame, query: DataFrame, key: str, vector: str, k: int, ask: float, boundary: float, copies: int, sample: int, lists: int, per_list: int) -> DataFrame:
    spark = df.sparkSession

    def kept(rows: DataFrame) -> DataFrame:
        v = quoted(vector)
        named = rows.where(quoted(key).isNotNull() & whole(v) & F.exists(v, lambda x: x != 0))
        return named.select(quoted(key).cast("long").alias("id"), v.alias("v"))

    # one number a row: a vector that stands in several lists is one candidate
    rows = cut(kept(df).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    dim = usual_length(rows, "v")
    rows = rows.where(F.size("v") == dim)
    asked = kept(query).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest = rows.agg(F.max(norm)).first()[0] or 1.0
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not dim or not np.isfinite(longest):
        longest = rows.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()[0]
        if not longest:
            return empty
        longest = min(longest * np.sqrt(dim), np.finfo(float).max)
    index = spark.sparkContext.broadcast(fit_lists(rows, dim, longest, sample, lists, per_list))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, neighbours, entries, _ = index.value
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids, dist = walk(_lifted(_matrix(part.column(2), dim), longest), centroids, neighbours, entries, boundary, 16)
                row, at = np.nonzero(homes(ids, dist, centroids, boundary, copies))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, at]), *part.take(pa.array(row)).columns], ["list", "row", "id", "v"])

    kind = dict(rows.dtypes)["v"]
    postings = cut(rows.select("row", "id", "v").mapInArrow(place, f"list int, row long, id long, v {kind}"), "ann-postings")
    sizes = cut(postings.groupBy("list").agg(F.count("*").alias("n")), "ann-sizes")  # at most ``lists`` rows
    held = np.zeros(len(index.value[0]), np.int64)
    for r in sizes.collect():
        held[r["list"]] = r["n"]
    enough = 4 * copies * (k + 1)
    sure = 16 + int(enough / max(1.0, held.mean()))
    # the lists' vectors stand in a row, list by list, that is cut into blocks
    ends = np.cumsum(held)
    begins = np.arange(0, int(ends[-1]), BLOCK)
    spans = np.stack([np.searchsorted(ends, begins, "right"), np.searchsorted(ends, np.minimum(begins + BLOCK, ends[-1]) - 1, "right") + 1], axis=1)
    counts = spark.sparkContext.broadcast((held, spans))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, neighbours, entries, usual = index.value
        held, spans = counts.value
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                points = _matrix(part.column(1), dim)
                points = points / np.abs(points).max(axis=1, keepdims=True)
                points = np.append(points / np.linalg.norm(points, axis=1, keepdims=True), np.zeros((len(points), 1)), axis=1)
                ids, dist = walk(points, centroids, neighbours, entries, ask, len(centroids), steps=64, least=usual, sure=sure)
                upto = np.cumsum(np.where(ids >= 0, held[ids], 0), axis=1) - np.where(ids >= 0, held[ids], 0)
                row, at = np.nonzero((ids >= 0) & ((dist <= ask * np.maximum(dist[:, :1], usual)) | (upto < enough)))
                asked = np.zeros((len(points), len(held)), bool)
                asked[row, ids[row, at]] = True
                asked &= held > 0
                for block, (first, end) in enumerate(spans.tolist()):
                    row = np.flatnonzero(asked[:, first:end].any(axis=1))
                    if len(row):
                        lists = pa.array([x.tobytes() for x in np.packbits(asked[row, first:end], axis=1)], pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), block, np.int32)), lists, *part.take(pa.array(row)).columns], ["block", "lists", "id", "v"])

    # a query goes once to each block that has lists it asks, and tells which
    asks = cut(asked.select("id", "v").mapInArrow(choose, f"block int, lists binary, id long, v {dict(asked.dtypes)['v']}"), "ann-asks")
    deals = cut(asks.groupBy("block").agg(F.ceil(F.count("*") / ASKING).alias("deals")), "ann-deals")
    asks = asks.join(deals, "block").withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals"))).drop("deals")
    places = F.broadcast(spark.createDataFrame([(i, int(e - n), int(n)) for i, (e, n) in enumerate(zip(ends, held, strict=True)) if n], "list int, begin long, n long"))
    placed = postings.join(places, "list").withColumn("block", F.expr(f"cast((begin + pmod(xxhash64(row), n)) div {BLOCK} as int)"))
    placed = placed.join(deals, "block").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"), "list", "row", "id", "v")

    def compare(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        names, found = ["query_id", "row", "vec_id", "score"], []
        if candidates.num_rows and queries.num_rows:
            first, _ = counts.value[1][candidates["block"][0].as_py()]
            lists, row, id_ = (candidates[x].to_numpy() for x in ("list", "row", "id"))
            c = _matrix(candidates["v"].combine_chunks(), dim)
            longest = np.linalg.norm(c, axis=1).max()
            keep = min(copies * k, len(c))  # a row stands in so many lists at most
            for i in range(0, queries.num_rows, QUERY_BLOCK):
                part = queries.slice(i, QUERY_BLOCK).combine_chunks()
                who, q = part["id"].to_numpy(), _matrix(part["v"].combine_chunks(), dim)
                asked = np.unpackbits(np.frombuffer(b"".join(part["lists"].to_pylist()), np.uint8).reshape(len(who), -1), axis=1).astype(bool)
                scores = q @ c.T
                scores[~asked[:, lists - first]] = -np.inf
                scores[who[:, None] == id_[None, :]] = -np.inf
                # rows that rounding might put among the k best are scored anew, all in the same order
                least = np.partition(scores, len(c) - keep, axis=1)[:, len(c) - keep]
                a, b = np.nonzero((scores >= (least - 1e-9 * np.linalg.norm(q, axis=1) * longest)[:, None]) & (scores > -np.inf))
                exact = np.concatenate([(q[a[s : s + 8192]] * c[b[s : s + 8192]]).sum(axis=1) for s in range(0, len(a), 8192)] or [np.zeros(0)])
                found.append(_best([(who[a], row[b], id_[b], exact)], k))
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table([pa.array(np.concatenate([np.zeros(0, kind), *[x[i] for x in found]])) for i, kind in enumerate(kinds)], names)

    both = placed.groupBy("block", "deal").cogroup(asks.groupBy("block", "deal"))
    found = both.applyInArrow(compare, "query_id long, row long, vec_id long, score double")
    down = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
    once = found.withColumn("again", F.coalesce(F.lag("row").over(down) == F.col("row"), F.lit(False))).where("not again")
    return once.withColumn("rank", F.row_number().over(down).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
