"""Media columns: ISO containers written, walked and read.

A payload is stored as a track of raw 8 x 8 frames of 8-bit grey samples (64
bytes a frame).  Reading walks the nested boxes and decodes the sample tables
(sizes, chunk map, chunk offsets, durations, sync samples), so codec, duration
and the byte ranges of keyframes come from the header alone; ``mdat`` is only
skipped.  Several tracks, 64-bit box sizes, boxes that reach the end of the
file, both chunk-offset tables and both header versions are understood.

A null or empty text is an empty payload (one padded frame), a long one is one
row; equal texts give equal containers, and repeated rows stay.  A null container
gives nulls and the status ``null``.  One whose boxes or sample tables contradict
each other or the file gives nulls and ``malformed``: what a table claims is held
against the bytes that are there before anything of its size is made, so a file
of n bytes takes memory in proportion to n.  No rows give no rows.  Extra columns
are ignored when writing and pass through when reading; those called like a fact
give way to it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import under_plain_names

FRAME, GOP, CHUNK, SCALE = 64, 16, 256, 25
DEEPEST = 32
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"}
TRACK = "status string, codec string, width int, height int, timescale long, duration long, n_samples long, keyframes array<struct<offset:long,size:long>>, payload binary"


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad_frames(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of a frame."""
    return data + bytes(max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def write_container(payload: bytes) -> bytes:
    """An ISO container whose one video track holds payload as raw grey frames."""
    frames = len(payload) // FRAME
    chunks, rest = divmod(frames, CHUNK)
    unity = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    runs = [(1, CHUNK)] * (chunks > 0) + [(chunks + 1, rest)] * (rest > 0)
    entry = struct.pack(">6xH16xHHIIIH32sHh", 1, 8, 8, 0x480000, 0x480000, 0, 1, bytes(32), 40, -1)
    offsets_at = [FRAME * CHUNK * i for i in range(chunks + (rest > 0))]
    ftyp = _box(b"ftyp", b"qt  ", struct.pack(">I", 0), b"qt  ")

    def moov(base: int) -> bytes:
        table = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), _box(b"raw ", entry)),
            _full(b"stts", struct.pack(">III", 1, frames, 1)),
            _full(b"stss", struct.pack(">I", -(-frames // GOP)), np.arange(1, frames + 1, GOP).astype(">u4").tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", a, n, 1) for a, n in runs]),
            _full(b"stsz", struct.pack(">II", FRAME, frames)),
            _full(b"co64", struct.pack(">I", len(offsets_at)), (np.array(offsets_at, ">u8") + base).astype(">u8").tobytes()),
        )
        header = struct.pack(">IIIIIH10x", 0, 0, SCALE, frames, 0x10000, 0x100) + unity + bytes(24) + struct.pack(">I", 2)
        track = struct.pack(">IIIIIQHHHH", 0, 0, 1, 0, frames, 0, 0, 0, 0, 0) + unity + struct.pack(">II", 8 << 16, 8 << 16)
        media = _box(
            b"mdia",
            _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, SCALE, frames, 0x55C4, 0)),
            _full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"\0"),
            _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table),
        )
        return _box(b"moov", _full(b"mvhd", header), _box(b"trak", _full(b"tkhd", track, flags=3), media))

    head = ftyp + moov(len(ftyp) + len(moov(0)) + 8)
    return head + struct.pack(">I4s", 8 + len(payload), b"mdat") + payload


def walk_boxes(data: memoryview, start: int, end: int, depth: int = 0) -> Iterator[tuple[bytes, int, int]]:
    """(kind, body start, body end) of the boxes in a range, children after their parents."""
    if depth > DEEPEST:
        raise ValueError("boxes are nested too deeply")
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop > end or stop < body:
            raise ValueError(f"a box {kind!r} leaves its parent")
        yield kind, body, stop
        if kind in CONTAINERS:
            yield from walk_boxes(data, body, stop, depth + 1)
        start = stop


def _numbers(data: memoryview, at: int, stop: int, count: int, kind: str) -> np.ndarray:
    if at + count * int(kind[2]) > stop:
        raise ValueError("a table is longer than its box")
    found = np.frombuffer(data, kind, count, at)
    if kind == ">u8" and count and int(found.max()) >> 62:
        raise ValueError("an offset is too large")
    return found.astype(np.int64)


def _samples(tables: dict[bytes, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset and size of every sample and the numbers (from 0) of the sync samples of a track in a file of that length."""
    sizes = tables.get(b"stsz", np.zeros(0, np.int64))
    n = len(sizes)
    chunks = tables.get(b"co64", tables.get(b"stco", np.zeros((0, 1), np.int64)))[:, 0]
    runs = tables.get(b"stsc", np.zeros((0, 3), np.int64))
    sync = tables[b"stss"][:, 0] - 1 if b"stss" in tables else np.arange(n)
    if len(sync) and (sync.min() < 0 or sync.max() >= n or (np.diff(sync) <= 0).any()):
        raise ValueError("a sync sample isn't among the samples")
    if not n:
        return sizes, sizes, sync
    # samples of each chunk: a run holds until the next run's first chunk
    until = np.append(runs[1:, 0], len(chunks) + 1)
    if not len(runs) or runs[0, 0] != 1 or (until <= runs[:, 0]).any() or until.max() > len(chunks) + 1:
        raise ValueError("the chunk map doesn't fit the chunks")
    ends = np.cumsum(np.repeat(runs[:, 1], until - runs[:, 0]))
    if ends[-1] < n:
        raise ValueError("samples have no chunk")
    of = np.searchsorted(ends, np.arange(n), side="right")
    after = np.cumsum(sizes)
    first = np.append(0, ends)[of]
    offsets = chunks[of] + (after - sizes) - (after - sizes)[first]
    if after[-1] > length or (offsets + sizes).max() > length:
        raise ValueError("samples lie outside the file")
    return offsets, sizes, sync


def read_tracks(content: bytes) -> list[dict]:
    """The tracks: codec, size, timescale, duration, and offset, size and sync mark of every sample."""
    data, tracks, now = memoryview(content), [], {}
    for kind, at, stop in walk_boxes(data, 0, len(data)):
        u32 = lambda o, at=at: struct.unpack_from(">I", data, at + o)[0]
        if kind == b"trak":
            tracks.append(now := {"tables": {}, "codec": None, "width": None, "height": None})
        elif kind == b"mdhd":
            now["timescale"], now["duration"] = (u32(12), u32(16)) if data[at] == 0 else (u32(20), struct.unpack_from(">Q", data, at + 24)[0])
            if now["duration"] >> 63:
                raise ValueError("a duration is too large")
        elif kind == b"hdlr" and "handler" not in now:
            now["handler"] = bytes(data[at + 8 : at + 12])
        elif kind == b"stsd" and u32(4):
            now["codec"] = bytes(data[at + 12 : at + 16]).decode("latin-1").strip()
            if now.get("handler") == b"vide":
                now["width"], now["height"] = struct.unpack_from(">HH", data, at + 40)
        elif kind in (b"stts", b"stss", b"stsc", b"stco", b"co64"):
            each, form = {b"stts": (2, ">u4"), b"stss": (1, ">u4"), b"stsc": (3, ">u4"), b"stco": (1, ">u4"), b"co64": (1, ">u8")}[kind]
            now["tables"][kind] = _numbers(data, at + 8, stop, each * u32(4), form).reshape(-1, each)
        elif kind == b"stsz":
            if u32(4) * u32(8) > len(data):
                raise ValueError("samples lie outside the file")
            now["tables"][kind] = np.full(u32(8), u32(4)) if u32(4) else _numbers(data, at + 12, stop, u32(8), ">u4")
    for t in tracks:
        t["offsets"], t["sizes"], t["sync"] = _samples(t["tables"], len(content))
    return tracks


def encode_media(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes of the UTF-8 text and its container ``media``."""
    kind = dict(docs.dtypes)[key]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            media = pa.array([write_container(pad_frames(x)) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), media], [key, "n_bytes", "media"])

    return docs.select(key, F.col(text).cast("binary")).mapInArrow(encode, f"`{key}` {kind}, n_bytes long, media binary")


def read_media(df: DataFrame, media: str = "media", payload: bool = True) -> DataFrame:
    """Add the first track's facts and, if asked for, its samples read back in order.

    Only the box headers and sample tables are parsed for codec, duration and
    keyframe ranges.  Columns of df with the names of these facts give way.
    """
    return under_plain_names(df, [media], FACTS.names, lambda d: _read_media(d, media, payload))


def _read_media(df: DataFrame, media: str, payload: bool) -> DataFrame:
    columns = df.columns

    def one(content: bytes | None) -> dict:
        if content is None:
            return {"status": "null"}
        try:
            track = next((t for t in read_tracks(content) if "timescale" in t), None)
        except (ValueError, struct.error, KeyError, IndexError) as e:
            return {"status": f"malformed: {type(e).__name__}"}
        if track is None:
            return {"status": "no track"}
        at, size, sync = track["offsets"], track["sizes"], track["sync"]
        out = {k: track[k] for k in ("codec", "width", "height", "timescale", "duration")}
        out |= {"status": "ok", "n_samples": len(size), "keyframes": [{"offset": o, "size": s} for o, s in zip(at[sync].tolist(), size[sync].tolist(), strict=True)]}
        if payload:
            # samples that touch are read as one range
            cuts = np.flatnonzero(at[1:] != (at + size)[:-1]) + 1
            firsts, lasts = np.append(0, cuts)[: len(size)], np.append(cuts, len(size)) - 1
            out["payload"] = b"".join(content[a:b] for a, b in zip(at[firsts].tolist(), (at + size)[lasts].tolist(), strict=True)) if len(size) else b""
        return out

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [one(x.as_py()) for x in batch.column(media)]
            added = [pa.array([f.get(field.name) for f in facts], field.type) for field in FACTS]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*columns, *FACTS.names])

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(read, f"{schema}, {TRACK}")


FACTS = pa.schema(
    [
        ("status", pa.string()), ("codec", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("timescale", pa.int64()), ("duration", pa.int64()),
        ("n_samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("offset", pa.int64()), ("size", pa.int64())]))), ("payload", pa.binary()),
    ]
)
