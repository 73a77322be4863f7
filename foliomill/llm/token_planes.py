"""Token-id files of compressed byte or bit planes with a chunk index.

File layout (little endian): magic ``FMPLANE1``; plane kind, width in bytes and
ids per chunk; counts of documents and ids and the length of the index; the
index, compressed with zstandard: documents' ids, their null marks, their
token counts, then (offset, size) of every plane of every chunk; the planes.
A chunk is transposed into its bytes' (or bits') planes, and each plane is
compressed by itself, so a reader can fetch any range of ids by the index.

A null or empty text has one end id; a null document id sorts first.  Equal ids
keep all their rows, by the hash of the text and then the text, so positions are
the same in every run; however many, they spread over parts by the hash.  A text
of any length is one row; a file grows beyond its size by no more than one
document.  No rows give no file.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .word_ids import word_encoder

MAGIC = b"FMPLANE1"
HEAD = struct.Struct("<8sBBIQQQ")
FILES = "part int, seq int, before long, n_docs long, n_ids long, content binary"


def pack_ids(ids: np.ndarray, doc_ids: list[int | None], counts: list[int], planes: str = "byte", chunk: int = 65536) -> bytes:
    """One file of ids (unsigned 32-bit), whose documents have ``counts`` ids each."""
    press = zstandard.ZstdCompressor(level=1)
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    body, index, at = [], [], 0
    for i in range(0, len(ids), chunk):
        raw = ids[i : i + chunk].astype(f"<u{width}").view(np.uint8).reshape(-1, width)
        cells = np.packbits(np.unpackbits(raw, axis=1).T, axis=1) if planes == "bit" else np.ascontiguousarray(raw.T)
        for plane in cells:
            body.append(press.compress(plane.tobytes()))
            index += [at, len(body[-1])]
            at += len(body[-1])
    parts = (
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([d is None for d in doc_ids], "u1"),
        np.array(counts, "<i8"),
        np.array(index, "<i8"),
    )
    table = press.compress(b"".join(p.tobytes() for p in parts))
    return HEAD.pack(MAGIC, planes == "bit", width, chunk, len(doc_ids), len(ids), len(table)) + table + b"".join(body)


def unpack_ids(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, token counts and all ids of one file."""
    magic, bits, width, chunk, n_docs, n_ids, size = HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token-plane file")
    press = zstandard.ZstdDecompressor()
    table = press.decompress(content[HEAD.size : HEAD.size + size])
    docs = np.frombuffer(table, "<i8", n_docs)
    nulls = np.frombuffer(table, "u1", n_docs, 8 * n_docs)
    counts = np.frombuffer(table, "<i8", n_docs, 9 * n_docs)
    index = np.frombuffer(table, "<i8", -1, 17 * n_docs).reshape(-1, 2)
    start, per_chunk, out = HEAD.size + size, width * (8 if bits else 1), []
    for c in range(0, len(index), per_chunk):
        n = min(chunk, n_ids - c // per_chunk * chunk)
        planes = [np.frombuffer(press.decompress(content[start + o : start + o + s]), np.uint8) for o, s in index[c : c + per_chunk]]
        cells = np.stack(planes)
        raw = np.packbits(np.unpackbits(cells, axis=1, count=n).T, axis=1) if bits else np.ascontiguousarray(cells.T)
        out.append(np.ascontiguousarray(raw).view(f"<u{width}").ravel())
    ids = np.concatenate(out).astype("<u4") if out else np.zeros(0, "<u4")
    return [None if x else int(d) for d, x in zip(docs, nulls, strict=True)], counts, ids


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text", planes: str = "byte", file_ids: int = 1 << 18
) -> DataFrame:
    """Files of the ids of all texts in ascending order of key, each about ``file_ids`` ids long.

    ``part`` and ``seq`` order the files; ``before`` counts the ids of the part
    before the file.  Texts are range-partitioned by key before they are
    encoded, so each is encoded once.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer_path).encode_all, np.array([end_id], "<u4").tobytes()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        keys, counts, held, n = [], [], [], 0

        def out() -> pa.RecordBatch:
            content = pack_ids(np.frombuffer(b"".join(held), "<u4"), keys, counts, planes)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "before": before, "n_docs": len(keys), "n_ids": n, "content": content}], SCHEMA)

        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                held.append(ids + end)
                keys.append(k)
                counts.append(len(held[-1]) // 4)
                n += counts[-1]
                if n >= file_ids:
                    yield out()
                    seq, before, keys, counts, held, n = seq + 1, before + n, [], [], [], 0
        if keys:
            yield out()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    ordered = rows.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash", "text")
    return ordered.select("id", "text").mapInArrow(write, FILES)


SCHEMA = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("content", pa.binary())])


def read_token_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start among all ids, n_tokens, ids_crc32 and the ids themselves.

    The offset of a part is the ids of the parts before it: one row per part of
    the writing shuffle, so its broadcast is bounded by the partition count.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                docs, counts, ids = unpack_ids(content.as_py())
                ends = np.cumsum(counts)
                raw = memoryview(ids.tobytes())
                pieces = [raw[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = [
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array(docs, pa.int64()),
                    pa.array(before + ends - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                ]
                names = ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    rows = files.select("part", "before", "content").mapInArrow(read, schema)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("total"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(above), F.lit(0)).alias("offset"))
    start: Column = (F.col("offset") + F.col("local_start")).alias("start")
    return rows.join(F.broadcast(offsets), "part").select("doc_id", start, "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
