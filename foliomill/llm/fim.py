"""Fill-in-middle transformation on ropes.

A text is cut into units (code points, or the matches of a pattern; what lies
between matches is a unit as well).  Its rope is a balanced tree whose leaves are
stretches of the text and whose nodes cache how many units and code points lie
below.  The rope is split at two unit ranks, and the parts are joined in another
order with sentinels between them; the text is got back by splitting the rope of
the output at code-point ranks.  Splits and joins cost the depth of the tree, so
texts of any length are rearranged without copying them over and over.

The draws are the first four groups of eight hex digits of sha256("seed:key"), so
a row is cut alike wherever and whenever it is processed.

Null and empty texts are plain, with an empty output; so are texts that hold a
sentinel.  A null key draws by "seed:" alone.  Rows of equal keys draw alike; they
and equal texts are rows of their own.  No rows give none.  Columns of the input
stay, but for the text and those named as a result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .vectors import quoted

#: Units in a leaf.
LEAF = 1024
RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


class Rope(NamedTuple):
    """A leaf (text, and where its units end; None: every code point is one) or a node of two ropes."""

    units: int
    chars: int
    height: int
    text: str = ""
    ends: list[int] | None = None
    left: Rope | None = None
    right: Rope | None = None


def leaf(text: str, ends: list[int] | None = None) -> Rope | None:
    return Rope(len(text) if ends is None else len(ends), len(text), 0, text, ends) if text else None


def node(left: Rope, right: Rope) -> Rope:
    return Rope(left.units + right.units, left.chars + right.chars, 1 + max(left.height, right.height), left=left, right=right)


def join(a: Rope | None, b: Rope | None) -> Rope | None:
    """a before b, balanced: the lower one is put into the higher one's flank."""
    if a is None or b is None:
        return a or b
    if a.height > b.height + 1:
        right = join(a.right, b)
        if right.height <= a.left.height + 1:
            return node(a.left, right)
        if right.left.height > right.right.height:
            return node(node(a.left, right.left.left), node(right.left.right, right.right))
        return node(node(a.left, right.left), right.right)
    if b.height > a.height + 1:
        left = join(a, b.left)
        if left.height <= b.right.height + 1:
            return node(left, b.right)
        if left.right.height > left.left.height:
            return node(node(left.left, left.right.left), node(left.right.right, b.right))
        return node(left.left, node(left.right, b.right))
    return node(a, b)


def split(rope: Rope | None, rank: int, by_chars: bool = False) -> tuple[Rope | None, Rope | None]:
    """The first ``rank`` units (or code points), and the rest."""
    if rope is None or rank <= 0:
        return None, rope
    if rank >= (rope.chars if by_chars else rope.units):
        return rope, None
    if rope.left is None:
        at = rank if by_chars or rope.ends is None else rope.ends[rank - 1]
        if rope.ends is None:
            return leaf(rope.text[:at]), leaf(rope.text[at:])
        k = bisect_left(rope.ends, at)  # a unit that is cut is one on both sides
        head = [*rope.ends[:k], at]
        tail = [e - at for e in rope.ends[k:] if e > at]
        return leaf(rope.text[:at], head), leaf(rope.text[at:], tail)
    below = rope.left.chars if by_chars else rope.left.units
    if rank <= below:
        a, b = split(rope.left, rank, by_chars)
        return a, join(b, rope.right)
    a, b = split(rope.right, rank - below, by_chars)
    return join(rope.left, a), b


def grow(text: str, ends: list[int] | None = None) -> Rope | None:
    """The balanced rope of a text."""
    if ends is None:
        level = [leaf(text[i : i + LEAF]) for i in range(0, len(text), LEAF)]
    else:
        level, start = [], 0
        for i in range(0, len(ends), LEAF):
            part = ends[i : i + LEAF]
            level.append(leaf(text[start : part[-1]], [e - start for e in part]))
            start = part[-1]
    while len(level) > 1:
        level = [node(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else None


def written(rope: Rope | None) -> str:
    """The text of a rope."""
    out, stack = [], [rope] if rope else []
    while stack:
        top = stack.pop()
        if top.left is None:
            out.append(top.text)
        else:
            stack += (top.right, top.left)
    return "".join(out)


def unit_ends(text: str, unit: re.Pattern | None) -> list[int] | None:
    """Where units end: matches of the pattern, and the stretches between them."""
    if unit is None:
        return None
    ends, at = [], 0
    for m in unit.finditer(text):
        if m.start() > at:
            ends.append(m.start())
        if m.end() > m.start():
            ends.append(m.end())
        at = m.end()
    if at < len(text):
        ends.append(len(text))
    return ends


class Marks(NamedTuple):
    """The sentinels before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def check(self) -> Marks:
        """Sentinels that could be found elsewhere than where they were put are refused."""
        for a in self:
            if not a or sum(a in b or b in a for b in self) > 1:
                raise ValueError("sentinels must not be empty or hold each other")
            if any(a.endswith(b[:n]) for b in self for n in range(1, len(b)) if n < len(a)):
                raise ValueError("no sentinel may end as a sentinel begins")
        return self


def rearranged(rope: Rope | None, low: int, high: int, form: str, marks: Marks) -> tuple[str, int, int]:
    """The output of a form, and the code points of prefix and middle: units up to low, and from there up to high."""
    if form == "plain":
        return written(rope), 0, 0
    prefix, rest = split(rope, low)
    middle, suffix = split(rest, high - low)
    chars = [p.chars if p else 0 for p in (prefix, middle)]
    p, s, m = ((leaf(mark), part) for mark, part in zip(marks, (prefix, suffix, middle), strict=True))
    out = None
    for part in (*p, *s, *m) if form == "psm" else (*s, *p, *m):
        out = join(out, part)
    return written(out), *chars


def rebuilt(output: str | None, form: str | None, marks: Marks) -> str | None:
    """The text that ``rearranged`` had; None if the output isn't of the form."""
    if output is None or form not in ("plain", "psm", "spm"):
        return None
    if form == "plain":
        return output
    first, second = (marks.prefix, marks.suffix) if form == "psm" else (marks.suffix, marks.prefix)
    b = output.find(second, len(first))
    c = output.find(marks.middle, b + len(second)) if b >= 0 else -1
    if c < 0 or not output.startswith(first):
        return None
    _, rest = split(grow(output), len(first), by_chars=True)
    one, rest = split(rest, b - len(first), by_chars=True)
    _, rest = split(rest, len(second), by_chars=True)
    two, rest = split(rest, c - b - len(second), by_chars=True)
    _, middle = split(rest, len(marks.middle), by_chars=True)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return written(join(join(prefix, middle), suffix))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str | None = None, marks: Marks = Marks(), seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:  # noqa: B008
    """The columns of docs without the text, and n (units), form, prefix_chars, middle_chars (null if plain) and output.

    Of a hundred texts about ``plain`` stay as they are, and of the others ``spm`` in a hundred have the suffix first.
    """
    marks, pattern = marks.check(), re.compile(unit, re.DOTALL) if unit else None
    results = StructType.fromDDL(RESULTS)
    kept = [c for c in docs.columns if c != text and c.lower() not in results.names]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(key).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], F.coalesce(quoted(text), F.lit("")).alias("t"), *draws)

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, *h in zip(*[c.to_pylist() for c in batch.columns[-5:]], strict=True):
                rope = grow(t, unit_ends(t, pattern))
                n = rope.units if rope else 0
                low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                form = "plain" if not t or h[2] % 100 >= 100 - plain or any(m in t for m in marks) else "spm" if h[3] % 100 < spm else "psm"
                found, *chars = rearranged(rope, low, high, form, marks)
                out.append((n, form, *(chars if form != "plain" else (None, None)), found))
            made = [pa.array(x, {"n": pa.int64(), "form": pa.string(), "output": pa.string()}.get(f, pa.int64())) for f, x in zip(results.names, zip(*out, strict=True) if out else [[]] * 5, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-5], *made], [*batch.schema.names[:-5], *results.names])

    schema = StructType([*[StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)], *results.fields])
    return rows.mapInArrow(arrange, schema).toDF(*kept, *results.names)


def restore(made: DataFrame, marks: Marks = Marks()) -> DataFrame:  # noqa: B008
    """The columns of made and ``restored``: the text rebuilt from output and form, null if the output isn't of its form."""
    marks = marks.check()
    kept = [c for c in made.columns if c.lower() != "restored"]

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("o").to_pylist(), batch.column("f").to_pylist(), strict=True)
            found = pa.array([rebuilt(o, f, marks) for o, f in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], found], [*batch.schema.names[:-2], "restored"])

    schema = StructType([*[StructField(f"c{i}", made.schema[c].dataType) for i, c in enumerate(kept)], *StructType.fromDDL("restored string").fields])
    rows = made.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col("output").alias("o"), F.col("form").alias("f"))
    return rows.mapInArrow(invert, schema).toDF(*kept, "restored")
