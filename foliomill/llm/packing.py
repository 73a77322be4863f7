"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities.

Documents are cut into windows; the pieces are dealt at random into groups, and
each group is packed by itself in one task: pieces by descending length, each
into the first sequence that still has room.  There are as many groups as keep
both the documents and the bytes of text of one near a given number, so a group
is bounded whether documents are many or long; a document's pieces are dealt
apart.  The tree holds the free room of the sequences in its leaves and the
larger of two in each inner node, so the first fit is found by one walk from the
root.

A null or empty text has the end id alone; a null key is kept.  A text of any
length is encoded whole, in one row.  Pieces of one length go by key, start and
ids; repeated rows are packed each by itself.  No rows give no pieces.  Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .word_ids import word_encoder

PIECES = "group long, doc_id long, start long, length long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"


class TournamentTree:
    """Free room of ``bins`` open or unopened bins; first() finds the leftmost that fits."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """Take need from the leftmost bin with that much room; its number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < need:
                node += 1
        room[node] -= need
        found = node - self.leaves
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return found


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length; ties go by position."""
    tree, fill, out = TournamentTree(len(lengths), capacity), {}, [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.first(lengths[i])
        out[i] = (at, fill.get(at, 0))
        fill[at] = out[i][1] + lengths[i]
    return out


def _mix(x: int) -> int:
    """A well-spread 64-bit number from a counter."""
    x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, window: int, groups: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most window ids with the random group that packs them.

    The group follows from the row's place in its input partition, not from its
    content, so repeated rows spread as others do; a lost task deals alike again.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer_path).encode_all, np.array([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, window):
                    row += 1
                    piece = ids[4 * s : 4 * (s + window)]
                    out.append((_mix(row) % groups, k, s, len(piece) // 4, n, piece))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), SCHEMA, strict=True)] if out else [pa.array([], f.type) for f in SCHEMA], schema=SCHEMA)

    return docs.select(F.col(key).cast("long"), text).mapInArrow(cut, PIECES)


SCHEMA = pa.schema([("group", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 4096, group_docs: int = 1000, group_bytes: int = 4 << 20, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces with their sequence and offset; sequence_id is group << 32 | number in the group.

    On average a group holds at most ``group_docs`` documents' worth of pieces
    and ``group_bytes`` of text (a byte is one id at most), which bounds what a
    task holds and leaves about one unfilled sequence in a group.
    """
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    groups = max(1, -(-rows // group_docs), -(-size // group_bytes))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        placed = first_fit_decreasing(table["length"].to_pylist(), window)
        base = table["group"][0].as_py() << 32
        sequence = pa.array([base | b for b, _ in placed], pa.int64())
        return table.drop_columns(["group"]).append_column("sequence_id", sequence).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    return cut_pieces(docs, tokenizer_path, end_id, window, groups, key, text).groupBy("group").applyInArrow(pack, PACKED)
