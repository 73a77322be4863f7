"""Vector code compression: product codes by Yinyang Lloyd rounds in whole numbers.

A component x becomes floor(scale * x); vectors are cut into equal consecutive
parts, each with a codebook of its own.  A codebook starts as that part of the
vectors with the least keys.  A round gives every part its nearest entry (ties to
the lower index), then moves each entry to the floor of its parts' mean.

Entries are clustered into groups once.  A row keeps, for each part, its entry, an
upper bound of the distance from it and one lower bound for each group (of the
distance from the group's nearest other entry).  When entries drift, the bounds
move by the drift; only groups whose bound fails are scanned, by exact distances
in whole numbers, which also settle ties.  A round is one pass over the rows: it
writes the rows with their bounds beside the sums of each task, which Spark adds
up; the codebooks alone (parts x entries x width) come to the driver.

Vectors that are null, empty, or hold null or non-finite components take no part,
nor do those of another length than the commonest, nor those with a component
beyond what keeps a row's error within a long (LIMIT / length, some 2^27 for 64
components).  Vectors whose length is no multiple of parts are filled up with
zeros.  Rows of null keys are coded, and come last among the seeds; rows of equal
keys are seeds each, by their vectors.  Fewer rows than entries give fewer
entries.  No rows give none.  Columns of the input stay, but for the vector and
those named as a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import cut, scratch
from .vectors import quoted, usual_length, whole

#: length * (2 * component)^2 stays below this.
LIMIT = 1 << 61
RESULTS = ("code", "error")


class Books(NamedTuple):
    """The codebooks [part, entry, component], each entry's group, and how far entries moved last."""

    entries: np.ndarray
    groups: np.ndarray
    drift: np.ndarray


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows from entries, in whole numbers."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(most) ** 2 * x.shape[1] < 1 << 52:  # exact in doubles
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in entries], axis=1)


def entry_groups(entries: np.ndarray, wanted: int) -> np.ndarray:
    """A group for each entry of one codebook, by a few rounds of k-means from entries far apart."""
    points, at = entries.astype(np.float64), [0]
    while len(at) < min(wanted, len(points)):
        at.append(int(np.min([((points - points[i]) ** 2).sum(axis=1) for i in at], axis=0).argmax()))
    centres = points[at]
    for _ in range(5):
        group = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([points[group == g].mean(axis=0) if (group == g).any() else centres[g] for g in range(len(centres))])
    return group


#: Bounds are doubles of square roots; what lies closer than this is scanned.
SLACK = 1e-3


def assign(x: np.ndarray, entries: np.ndarray, groups: np.ndarray, k: int, drift: np.ndarray, held: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of each row of x, the upper and the k groups' lower bounds; and how many distances were computed.

    held: the last round's entry, upper and lower bounds, before the drift.
    """
    n, rows = len(x), np.arange(len(x))
    if held is None:
        found = distances(x, entries)
        own = found.argmin(axis=1)
        upper = np.sqrt(found[rows, own].astype(np.float64))
        rest = found.astype(np.float64)
        rest[rows, own] = np.inf
        lower = np.stack([np.sqrt(rest[:, groups == g].min(axis=1)) if (groups == g).any() else np.full(n, np.inf) for g in range(k)], axis=1)
        return own, upper, lower, found.size
    own, upper, lower = (h.copy() for h in held)
    far = np.array([drift[groups == g].max(initial=0) for g in range(k)])
    upper += drift[own]
    lower -= far
    loose = np.flatnonzero(upper + SLACK >= lower.min(axis=1))
    if not len(loose):
        return own, upper, lower, 0
    # tighten the upper bound, then scan the groups whose bound still fails
    gap = x[loose] - entries[own[loose]]
    before = (gap * gap).sum(axis=1)
    upper[loose] = np.sqrt(before.astype(np.float64))
    fails = upper[loose, None] + SLACK >= lower[loose]
    best, least, cost = own[loose].copy(), before.copy(), len(loose)
    scanned: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for g in range(k):
        at, members = np.flatnonzero(fails[:, g]), np.flatnonzero(groups == g)
        if not len(at) or not len(members):
            continue
        found = distances(x[loose[at]], entries[members])
        cost += found.size
        place = found.argmin(axis=1)
        near, entry = found[np.arange(len(at)), place], members[place]
        better = (near < least[at]) | ((near == least[at]) & (entry < best[at]))
        best[at[better]], least[at[better]] = entry[better], near[better]
        scanned.append((at, members, found))
    for at, members, found in scanned:
        others = np.where(members[None, :] == best[at][:, None], np.inf, found.astype(np.float64))
        lower[loose[at], groups[members[0]]] = np.sqrt(others.min(axis=1))
    # an entry that was left is one of its group's others now
    moved = np.flatnonzero(best != own[loose])
    old = groups[own[loose[moved]]]
    lower[loose[moved], old] = np.minimum(lower[loose[moved], old], np.sqrt(before[moved].astype(np.float64)))
    own[loose], upper[loose] = best, np.sqrt(least.astype(np.float64))
    return own, upper, lower, cost


def _state(own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.Array:
    """One binary a row: entries, upper bounds and lower bounds of its parts."""
    n = len(own)
    flat = np.concatenate([x.reshape(n, -1).astype("<f8") for x in (own, upper, lower)], axis=1)
    fixed = pa.Array.from_buffers(pa.binary(8 * flat.shape[1]), n, [None, pa.py_buffer(flat.tobytes())])
    return fixed.cast(pa.binary())


def _round(rows: DataFrame, books: Books, first: bool, last: bool) -> DataFrame:
    """One pass: rows with codes and bounds, and a row of sums of each task; in the last one rows with code and error."""
    parts, entries, width = books.entries.shape
    groups = int(books.groups.max()) + 1
    shared = rows.sparkSession.sparkContext.broadcast(books)
    more = [f for f in rows.schema.fields if f.name not in ("v", "state", "sums", "scanned")]
    own = StructType([*more, *StructType.fromDDL("code string, error long" if last else "v array<int>, state binary, sums array<long>, scanned long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, total, scanned, kinds = shared.value, np.zeros((parts, entries, width + 1), np.int64), 0, None
        for batch in batches:
            n, names = batch.num_rows, batch.schema.names
            kinds = [batch.column(f.name).type for f in more]
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)
            held = None
            if not first:
                flat = np.frombuffer(b"".join(batch.column("state").to_pylist()), "<f8").reshape(n, -1)
                held = flat[:, :parts].astype(int), flat[:, parts : 2 * parts], flat[:, 2 * parts :].reshape(n, parts, groups)
            found = [assign(x[:, p], book.entries[p], book.groups[p], groups, book.drift[p], held and tuple(h[:, p] for h in held)) for p in range(parts)]
            codes = np.stack([f[0] for f in found], axis=1)
            kept = [batch.column(names.index(f.name)) for f in more]
            if last:
                gap = np.stack([x[:, p] - book.entries[p][codes[:, p]] for p in range(parts)], axis=1)
                digits = [row.tobytes().hex() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(digits), pa.array((gap * gap).sum(axis=(1, 2)))], own.names)
                continue
            for p in range(parts):
                np.add.at(total[p, :, :width], codes[:, p], x[:, p])
                total[p, :, width] += np.bincount(codes[:, p], minlength=entries)
            scanned += sum(f[3] for f in found)
            state = _state(codes, *(np.stack([f[i] for f in found], axis=1) for i in (1, 2)))
            none = pa.nulls(n)
            yield pa.RecordBatch.from_arrays([*kept, batch.column("v"), state, none.cast(pa.list_(pa.int64())), none.cast(pa.int64())], own.names)
        if kinds is not None and not last:
            none = [pa.nulls(1).cast(t) for t in (*kinds, pa.list_(pa.int32()), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([total.ravel()], pa.list_(pa.int64())), pa.array([scanned])], own.names)

    return rows.mapInArrow(run, own)


def _moved(books: Books, written: DataFrame) -> tuple[Books, int]:
    """Codebooks after the sums of a round, and how many distances it computed."""
    sums = written.where("sums is not null")
    shape = books.entries.shape
    total = np.zeros(shape[0] * shape[1] * (shape[2] + 1), np.int64)
    for row in sums.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect():
        total[row["pos"]] = row["s"]
    total = total.reshape(*shape[:2], -1)
    count = total[..., -1:]
    entries = np.where(count > 0, total[..., :-1] // np.maximum(count, 1), books.entries)
    gap = (entries - books.entries).astype(np.float64)
    return Books(entries, books.groups, np.sqrt((gap * gap).sum(axis=2)) * (1 + 1e-12)), sums.agg(F.sum("scanned")).first()[0]


class Codes(NamedTuple):
    """Rows with code and error; codebooks [part, entry, component]; distances computed in each round."""

    rows: DataFrame
    books: np.ndarray
    scanned: list[int]


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, groups: int = 4) -> Codes:
    """The columns of df without the vector, and code (two hex digits a part) and error (squared distance), for every row that takes part.

    entries is at most 256.
    """
    spark: SparkSession = df.sparkSession
    with scratch(spark):
        others = [c for c in df.columns if c != vector and c.lower() not in RESULTS]
        numbered = [quoted(c).alias(f"c{i}") for i, c in enumerate(others)]
        kept = df.where(whole(quoted(vector))).select(*numbered, quoted(vector).alias("x"))
        dim = usual_length(kept, "x")
        width = -(-dim // parts)
        most = min((1 << 31) - 1, int(np.sqrt(LIMIT / (4 * max(1, dim)))))
        near = F.forall("x", lambda x: F.abs(x.cast("double") * scale) < most)
        zeros = F.array_repeat(F.lit(0), parts * width - dim)
        scaled = F.concat(F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("int")), zeros)
        kept = cut(kept.where((F.size("x") == dim) & near).select(*[f"c{i}" for i in range(len(others))], scaled.alias("v")), "codes-vectors")
        at = f"c{others.index(key)}"
        seeds = kept.orderBy(F.col(at).asc_nulls_last(), "v").select("v").limit(entries).collect()
        schema = StructType([*[StructField(c, df.schema[i].dataType) for i, c in enumerate(df.columns) if c in others], *StructType.fromDDL("code string, error long").fields])
        if not seeds:
            return Codes(spark.createDataFrame([], schema), np.zeros((parts, 0, width), np.int64), [])
        start = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
        books = Books(start, np.stack([entry_groups(e, groups) for e in start]), np.zeros(start.shape[:2]))
        state, scanned, held = kept, [], ExitStack()
        for i in range(rounds):
            table = ExitStack()  # goes when the next round's table is there
            table.enter_context(scratch(spark))
            written = cut(_round(state, books, i == 0, last=False), "codes-round")
            held.close()
            books, n = _moved(books, written)
            scanned.append(n)
            state, held = written.where("v is not null"), table
        with held:
            coded = cut(_round(state, books, rounds == 0, last=True), "codes", stays=1 + (rounds > 0))
        return Codes(coded.toDF(*others, *RESULTS), books.entries, scanned)
