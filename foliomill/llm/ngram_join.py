"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts are sets of word shingles.  Two sets link if num/den of their union is
shared.  Sets are ordered by one global order (rare shingles first, by a
frequency sketch of all documents).  If two sets link, then for any m they share
m elements within prefixes that are m - 1 longer than the shortest possible
ones.  Each document takes the m whose prefix costs least by the sketch:
postings to read and candidates to verify.  A pair is verified only if its
prefixes share at least the smaller of its two m.

1. Equal sets are one class; its least document stands for it.
2. Prefix elements found in a single class are dropped.
3. Each document is verified against the least document that holds most of its
   prefix elements; links join components.
4. Components that meet in frequent prefix elements are one cluster, where the
   elements can be the first that linked sets share: what follows them in both
   sets must be enough for a link.  Documents of a cluster are dealt into blocks
   by size; two blocks are compared in one row, which counts each document's
   links and gives back no more links than join their documents.  Pairs of
   blocks are listed by number, salted, before the sets are brought to them, so a
   cluster of any size spreads over all tasks.  A large cluster whose elements
   have few documents each falls into one cluster for each element.
5. Pairs of different clusters that meet in a prefix element of few documents
   are counted, verified if they share enough, and linked.

So every link is counted, once; a group of near copies costs block products,
and no pairs of a group are listed.  Tables of fixed size (bit sets) keep texts and
postings that can't matter out of the shuffles; what they let through by chance
is joined away exactly.

Null, empty and blank texts have the empty set and link with nothing; a null key
is kept but links with nothing.  Long texts are hashed whole, in one row each.
Rows equal in key and text are one document; rows of one key with different
texts are documents of their own that share the key's number.  Equal sets are
linked, and ties between documents go to the smaller key.  No rows give no rows.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, scratch
from . import bitset
from .components import connected_components
from .rows import number_rows, under_plain_names
from .shingles import M2, M3, blocks, mix, shingle_sets

SKETCH, SLICES, MATCHES = 1 << 23, 64, 8
#: Slots of a bit set as a power of two; documents that an element may have to have its pairs listed.
BITS, FEW = 26, 16
#: Elements and documents in a block, on average; blocks of a cluster that share a salt.
BLOCK, BLOCK_DOCS, SALTED = 1 << 16, 2048, 64


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Wrapping sums of values by owner (ascending)."""
    total = np.append(np.uint64(0), np.cumsum(values))
    at = np.searchsorted(owner, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def signatures(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """key, n, sig_a, sig_b of every row; and rows with slice, counts: this task's part of the frequency sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks(texts):
                owner, sets = shingle_sets(texts[a:b], width)
                cells, n = np.unique((sets >> np.uint64(40)).astype(np.int64) & (SKETCH - 1), return_counts=True)
                sketch[cells] += n.astype(np.uint32)
                sigs = [_sums(owner, mix(sets ^ m), b - a).view(np.int64) for m in (M2, M3)]
                counts = np.bincount(owner, minlength=b - a).astype(np.int64)
                none = pa.nulls(b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts), *map(pa.array, sigs), none.cast(pa.int32()), none.cast(pa.binary())], NAMES)
        if sketch.any():
            parts = [press.compress(x.tobytes()) for x in sketch.reshape(SLICES, -1)]
            none = pa.nulls(SLICES).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], NAMES)

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary")).mapInArrow(sign, "id long, n long, sig_a long, sig_b long, slice int, counts binary")


#: What a byte of the sketch stands for.
LEVELS = np.concatenate([np.arange(160), 160 * 1.125 ** np.arange(96)])
NAMES = ["id", "n", "sig_a", "sig_b", "slice", "counts"]


def _sketch(parts: DataFrame) -> np.ndarray:
    """The summed sketch, one byte for each of SKETCH counts: exact below 160, then steps of an eighth.

    Parts are added up by slice in two steps, so no task adds more than a
    64th of the parts of a slice.
    """

    def add(key: tuple, table: pa.Table) -> pa.Table:
        press, total = zstandard.ZstdDecompressor(), np.zeros(SKETCH // SLICES, np.uint64)
        for x in table["counts"].to_pylist():
            total += np.frombuffer(press.decompress(x), "<u4")
        summed = zstandard.ZstdCompressor(level=1).compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([summed], pa.binary())})

    dealt = parts.select("slice", "counts", (F.spark_partition_id() % 64).alias("deal"))
    partial = dealt.groupBy("slice", "deal").applyInArrow(add, "slice int, counts binary")
    out = np.zeros((SLICES, SKETCH // SLICES), np.uint8)
    for row in partial.groupBy("slice").applyInArrow(add, "slice int, counts binary").toArrow().to_pylist():
        out[row["slice"]] = np.searchsorted(LEVELS, np.frombuffer(zstandard.ZstdDecompressor().decompress(row["counts"]), "<u4"), side="right") - 1
    return out.ravel()


def prefix_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Elements of a set of n of which a linked set shares at least one."""
    return n - -(-n * num // den) + 1


def prefixes(docs: DataFrame, width: int, num: int, den: int, sketch: np.ndarray, key: str, text: str) -> DataFrame:
    """id, n, m (matches asked for) and the prefix of each row with two or more possible partners' worth of elements."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    usual = LEVELS[int(np.median(sketch))]

    def cut_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in blocks(texts):
                owner, sets = shingle_sets(texts[a:b], width)
                often = counts[(sets >> np.uint64(40)).astype(np.int64) & (SKETCH - 1)]
                order = np.lexsort((sets, often, owner))
                sets, often = sets[order], np.maximum(LEVELS[often[order]] - usual, 1)
                n = np.bincount(owner, minlength=b - a)
                at = np.cumsum(n) - n
                cost = np.append(0.0, np.cumsum(often))
                base = prefix_length(n, num, den)
                m = np.arange(1, MATCHES + 1)[:, None]
                ends = base + m - 1
                postings = cost[np.minimum(at + ends, len(often))] - cost[np.minimum(at, len(often))]
                # postings to read, and at most postings / m candidates, each about as dear as its prefix
                price = np.where((ends <= n) & (m <= -(-n * num // den)), postings + postings / m * base, np.inf)
                best = price.argmin(axis=0) + 1
                # no partner but an equal set can reach the threshold: n * den < (n + 1) * num
                size = np.where(n * den >= (n + 1) * num, base + best - 1, 0) if num < den else np.zeros_like(n)
                size = np.where(n > 0, np.minimum(size, n), 0)
                take = np.repeat(at, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(sets[take].view(np.int64)))
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(best.astype(np.int32)), lists], ["id", "n", "m", "prefix"])
                yield out.filter(pa.array(size > 0))

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary")).mapInArrow(cut_prefixes, "id long, n long, m int, prefix array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """id and whole set of the wanted documents, and of a few more by chance: joins with their pairs drop those."""
    member = F.xxhash64("id")
    shared = docs.sparkSession.sparkContext.broadcast(bitset.make(wanted, member, BITS))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitset.holds(shared.value, batch.column(2).to_numpy())))
            texts = batch.column(1).to_pylist()
            for a, b in blocks(texts):
                owner, sets = shingle_sets(texts[a:b], width)
                ends = np.append(0, np.cumsum(np.bincount(owner, minlength=b - a)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sets.view(np.int64)))], ["id", "elements"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary")).where("id is not null").withColumn("member", member)
    return rows.mapInArrow(make, "id long, elements array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    sets = cut(_sets(docs, wanted, width, key, text), "pair-sets")
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - same
    return cut(both.where(same * den >= union * num).select("a", "b"), "links")


def _live_postings(firsts: DataFrame) -> DataFrame:
    """element, id, n, m and p (its place in the prefix) of the prefix elements that at least two documents hold."""
    counted = firsts.select(F.explode("prefix").alias("element")).groupBy("element").agg(F.count("*").alias("df"))
    live = cut(counted.where("df > 1"), "elements")
    shared = firsts.sparkSession.sparkContext.broadcast(bitset.make(live, F.col("element"), BITS))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            hit = bitset.holds(shared.value, flat)
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes)[hit])
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(flat[hit]), *[batch.column(c).take(row) for c in range(3)], pa.array(place[hit])], ["element", "id", "n", "m", "p"])

    return firsts.select("id", "n", "m", "prefix").mapInArrow(keep, "element long, id long, n long, m int, p long").join(live, "element")


def _fine(n: str = "n") -> Column:
    """Sizes of about one number: exact below 64, then in steps of a fiftieth."""
    return F.when(F.col(n) < 64, F.col(n)).otherwise(64 + F.floor(F.log(F.col(n).cast("double")) * 50)).cast("long")


def _fit_first(postings: DataFrame, by: list[str], num: int, den: int) -> DataFrame:
    """The postings (by, n, p) that can be the first element, among those of one ``by``, that two linked documents share.

    Elements after place p of a set of n are n - p - 1, so a first shared one
    leaves at most the smaller n - p shared.  Postings of about one size
    (``fine``) are taken together, by their least size and greatest n - p, so an
    element of any number of documents has few rows here.
    """
    rows = postings.withColumn("fine", _fine())
    sized = rows.groupBy(*by, "fine").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("p")).alias("rest"), F.count("*").alias("rows"))
    band = F.floor(F.log(F.col("lo").cast("double")) / float(np.log(den / num))).cast("int")
    left = cut(sized.withColumn("band", band), "posting-sizes")
    right = left.select(*by, F.explode(F.sequence(F.col("band") - 2, F.col("band") + 2)).alias("band"), *[F.col(c).alias(f"{c}_") for c in ("fine", "lo", "hi", "rest")])
    near = F.least("hi", "hi_") * den >= F.greatest("lo", "lo_") * num
    enough = F.least("rest", "rest_") * (num + den) >= (F.col("lo") + F.col("lo_")) * num
    two = (F.col("fine") != F.col("fine_")) | (F.col("rows") > 1)
    fit = left.join(right, [*by, "band"]).where(near & enough & two).select(*by, "fine").distinct()
    return rows.join(cut(fit, "first-elements"), [*by, "fine"], "left_semi").drop("fine")


def _shared(column: np.ndarray, of: np.ndarray, lefts: int, first: int, n: int) -> np.ndarray:
    """How many columns each document before ``lefts`` shares with each from ``first``; column and of are (column, document), ordered.

    Columns of many documents are counted by products of 0/1 matrices, 2,048 at a
    time; those of few by their pairs.
    """
    starts = np.flatnonzero(np.diff(column, prepend=-1))
    at = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(column))))
    left, right = (np.bincount(at[side], minlength=len(starts)) for side in (of < lefts, of >= first))
    rights = n - first
    pairs = left * right
    dense = pairs * 48 > lefts * rights
    common = np.zeros((lefts, rights), np.float32)
    number = np.cumsum(dense) - 1
    big = dense[at]
    row, col = of[big], number[at[big]]
    for low in range(0, int(dense.sum()), 2048):
        a, b = np.searchsorted(col, [low, low + 2048])
        cells = np.zeros((n, min(2048, int(dense.sum()) - low)), np.float32)
        cells[row[a:b], col[a:b] - low] = 1
        common += cells[:lefts] @ cells[first:].T
    few = np.flatnonzero(~dense & (pairs > 0))
    flat = common.ravel()
    steps = np.append(0, np.cumsum(pairs[few]))
    for low in np.searchsorted(steps, range(0, int(steps[-1]), 1 << 20)).tolist() if len(few) else []:
        part = few[low : np.searchsorted(steps, steps[low] + (1 << 20))] if low < len(few) else few[:0]
        if not len(part):
            continue
        chosen = np.zeros(len(starts), bool)
        chosen[part] = True
        inside = chosen[at]
        who, group = of[inside], at[inside]
        x, gx = who[who < lefts], group[who < lefts]
        y, gy = who[who >= first], group[who >= first]
        times = right[gx]
        place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        flat += np.bincount(np.repeat(x, times) * rights + y[np.repeat(np.searchsorted(gy, gx), times) + place] - first, minlength=len(flat)).astype(np.float32)
    return common


def _columns(sets: list[np.ndarray], split: int) -> tuple[np.ndarray, np.ndarray]:
    """(column, document), ordered, of the elements that could be shared: two documents hold them, one on each side if there are two."""
    flat, of = np.concatenate(sets) if sets else np.zeros(0, np.int64), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, of = flat[order], of[order]
    starts = np.flatnonzero(np.diff(flat, prepend=flat[:1] - 1) != 0) if len(flat) else np.zeros(0, np.int64)
    column = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
    left = np.bincount(column[of < split], minlength=len(starts)) if split else np.bincount(column, minlength=len(starts)) - 1
    keep = (left > 0) & (np.bincount(column[of >= split], minlength=len(starts)) > 0)
    return column[keep[column]], of[keep[column]]


def _links_between(ids: list, ats: list, sets: list, split: int, num: int, den: int, lives: list | None = None, element: int = 0) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that join documents of two blocks (before and from split) or, with split 0, of one; and each document's number of all links between them.

    With lives (each document's elements that have blocks of their own) pairs
    that share one below ``element`` are left out: they are met there.
    """
    sizes = np.array([len(x) for x in sets])
    lefts, first = split or len(sets), split  # documents to the left, and the first one to the right
    common = _shared(*_columns(sets, split), lefts, first, len(sets))
    if lives is not None:
        before = _shared(*_columns([x[x < element] for x in lives], split), lefts, first, len(sets))
        common[before > 0] = -1
    degrees, root, out = np.zeros(len(sets), np.int64), {}, []
    at = np.array(ats, np.int64)

    def find(k: int) -> int:
        while root.setdefault(k, k) != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for low in range(0, lefts, 256):
        high = min(low + 256, lefts)
        shared = common[low:high].astype(np.int64)
        hits = (shared >= 0) & (shared * den >= (sizes[low:high, None] + sizes[None, first:] - shared) * num)
        if not split:
            hits[np.arange(high - low), np.arange(low, high)] = False
        degrees[low:high] += hits.sum(axis=1)
        if split:
            degrees[first:] += hits.sum(axis=0)
        x, y = np.nonzero(hits & (at[low:high, None] != at[None, first:]))
        for i, j in zip((x + low).tolist(), (y + first).tolist(), strict=True):
            a, b = find(ats[i]), find(ats[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((ids[i], ids[j]))
    return out, degrees


def _block_links(members: DataFrame, docs: DataFrame, width: int, num: int, den: int, key: str, text: str) -> DataFrame:
    """Links (a, b) between the documents (cluster, id, n, at, element, lives) of each cluster, that join different components (at).

    And rows with a null b: a document's number of links, in parts to be added up.
    Blocks hold documents of one cluster and one band of sizes, with about BLOCK
    elements and at most about BLOCK_DOCS documents in all; sets that differ by
    more than a band can't link.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num)) + 1e-9).cast("int")
    banded = members.withColumn("band", band)
    deals = banded.groupBy("cluster", "band").agg(F.ceil(F.greatest(F.sum("n") / BLOCK, F.count("*") / BLOCK_DOCS)).alias("deals"))
    sets = _sets(docs, members.select("id").distinct(), width, key, text)
    dealt = banded.join(deals, ["cluster", "band"]).withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")))
    packed = dealt.join(sets, "id").groupBy("cluster", "band", "deal").agg(F.collect_list(F.struct("id", "at", "elements", "lives")).alias("x"), F.first("element").alias("element"))
    packed = cut(packed, "blocks")
    place = ["cluster", "band", "deal"]
    every = packed.select(*place)
    salts = every.groupBy("cluster").agg(F.ceil(F.count("*") / SALTED).alias("salts")).where("salts > 1")
    every = cut(every.join(salts, "cluster", "left").withColumn("salts", F.coalesce("salts", F.lit(1))), "block-places")
    left = every.withColumn("salt", F.pmod(F.xxhash64("band", "deal"), F.col("salts")))
    second = every.select("cluster", F.col("band").alias("band_"), F.col("deal").alias("deal_"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    after = F.struct("band", "deal") < F.struct(F.col("band_").alias("band"), F.col("deal_").alias("deal"))
    paired = cut(left.join(second, ["cluster", "salt"]).where(F.col("band_").between(F.col("band"), F.col("band") + 1) & after).select(*place, "band_", "deal_"), "block-pairs")
    other = packed.select("cluster", F.col("band").alias("band_"), F.col("deal").alias("deal_"), F.col("x").alias("y"))
    places = [*place, "band_", "deal_"]
    both = paired.join(packed, place).join(other, ["cluster", "band_", "deal_"]).repartition(*places)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}

        def counts() -> pa.RecordBatch:
            out = [pa.array(list(total), pa.int64()), pa.nulls(len(total)).cast(pa.int64()), pa.array(list(total.values()), pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(out, ["a", "b", "links"])

        for batch in batches:
            for i in range(batch.num_rows):
                sides = [batch.column(0)[i].as_py(), *[column[i].values for column in batch.columns[1:]]]
                element = sides.pop(0)
                ids, ats = ([v for side in sides for v in side.field(f).to_pylist()] for f in (0, 1))
                sets, lives = ([np.array(v.values, np.int64) for side in sides for v in side.field(f)] for f in (2, 3))
                found, degrees = _links_between(ids, ats, sets, len(sides[0]) if len(sides) > 1 else 0, num, den, *((lives, element) if element is not None else ()))
                for k in np.flatnonzero(degrees).tolist():
                    total[ids[k]] = total.get(ids[k], 0) + int(degrees[k])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64()), pa.nulls(len(found)).cast(pa.int64())], ["a", "b", "links"])
                if len(total) > 1 << 18:
                    yield counts()
        yield counts()

    schema = "a long, b long, links long"
    return cut(packed.select("element", "x").mapInArrow(compare, schema).unionByName(both.select("element", "x", "y").mapInArrow(compare, schema)), "block-links")


def _by_element(members: DataFrame, placed: DataFrame, num: int, den: int) -> DataFrame:
    """members (cluster, id, n, at) with element and lives, for the block step.

    All documents of a cluster are compared (element is null), unless comparing
    those that share an element, for each element by itself, is far less: the
    cluster falls into one for each element.  A document is in several then, and
    a pair counts where its least common element is.
    """
    large = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("elements")).where(F.col("docs") > 2 * BLOCK_DOCS)
    large = cut(large, "large-clusters")
    plain = members.select("cluster", "id", "n", "at", F.lit(None).cast("long").alias("element"), F.array().cast("array<long>").alias("lives"))
    if large.isEmpty():
        return plain
    inside = placed.select("element", "id", "n", "p", "at").join(members.join(large, "cluster").select("id", "cluster"), "id")
    inside = cut(_fit_first(inside, ["cluster", "element"], num, den), "large-postings")
    held = inside.groupBy("cluster", "element").agg(F.count("*").cast("double").alias("docs_"), F.sum("n").alias("elements_"))
    cost = held.groupBy("cluster").agg(F.sum(F.col("docs_") * F.col("docs_")).alias("pairs"), F.sum("elements_").alias("moved"))
    less = (F.col("pairs") * 4 < F.col("docs").cast("double") * F.col("docs")) & (F.col("moved") < F.col("elements") * (F.col("docs") / BLOCK_DOCS))
    apart = cut(large.join(cost, "cluster").where(less).select("cluster"), "clusters-by-element")
    shared = cut(inside.join(apart, "cluster", "left_semi").join(held.where("docs_ > 1").select("cluster", "element"), ["cluster", "element"]), "element-members")
    lives = shared.groupBy("id").agg(F.collect_list("element").alias("lives"))
    split = shared.join(lives, "id").select(F.xxhash64("cluster", "element").alias("cluster"), "id", "n", "at", "element", "lives")
    return cut(plain.join(apart, "cluster", "left_anti").unionByName(split), "members-by-element")


def near_duplicates(docs: DataFrame, width: int, num: int, den: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, class_id (least document with the same set), component_id and links of every row.

    ``links`` is the number of other classes that the row's class links with.
    """
    with scratch(docs.sparkSession):
        rows, numbers = number_rows(docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")), "key", "text")
        found = _near_duplicates(rows.select(F.when(F.col("key").isNotNull(), F.col("_row")).alias("id"), "text"), width, num, den)
        if numbers is not None:
            for c in ("id", "class_id", "component_id"):
                names = numbers.select(F.col("_row").alias(c), F.col("key").alias("_key"))
                found = found.join(names, c, "left").withColumn(c, F.col("_key")).drop("_key")
        named = found.select(F.col("id").alias(key), "n_shingles", "class_id", "component_id", "links")
        return cut(named, "near-duplicates", stays=True)


def keep_first(docs: DataFrame, width: int, num: int, den: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are the least of their component, with their columns; of rows equal in key and text the least one."""
    return under_plain_names(docs, [key, text], [], lambda d: _keep_first(d, width, num, den, key, text))


def _keep_first(docs: DataFrame, width: int, num: int, den: int, key: str, text: str) -> DataFrame:
    with scratch(docs.sparkSession):
        rows, _ = number_rows(docs, key, text)
        ids = rows.select(F.when(F.col(key).isNotNull(), F.col("_row")).alias("id"), F.col(text).alias("text"))
        found = cut(_near_duplicates(ids, width, num, den).where("id is not null"), "near-duplicates")
        others = cut(found.where("component_id <> id").select(F.col("id").alias("_row")).distinct(), "other-rows", stays=True)
        repeats = found.where("component_id = id").groupBy(F.col("id").alias("_row")).agg(F.count("*").alias("n")).where("n > 1")
        repeats = cut(repeats.select("_row"), "repeated-rows", stays=True)
    kept = rows.join(others, "_row", "left_anti")
    once = kept.join(repeats, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("x")).select("x.*")
    return kept.join(repeats, "_row", "left_anti").select(*docs.columns).unionByName(once)


def _near_duplicates(docs: DataFrame, width: int, num: int, den: int, key: str = "id", text: str = "text") -> DataFrame:
    """near_duplicates of documents whose ``key`` is theirs alone; ties go to the smaller one."""
    signed = cut(signatures(docs, width, key, text), "signatures")
    sketch = _sketch(signed.where("slice is not null"))
    rows = signed.where("slice is null").select("id", "n", "sig_a", "sig_b")
    named = rows.where("n > 0 and id is not null")
    classes = named.groupBy("sig_a", "sig_b", "n").agg(F.min("id").alias("class_id"), F.count("*").alias("rows"))
    repeated = cut(classes.where("rows > 1").drop("rows"), "classes")
    copies = cut(named.join(repeated, ["sig_a", "sig_b", "n"]).where("id <> class_id").select("id").distinct(), "copies")

    firsts = prefixes(docs, width, num, den, sketch, key, text).where("id is not null").join(copies, "id", "left_anti")
    firsts = cut(firsts.dropDuplicates(["id"]), "prefixes")
    postings = cut(_live_postings(firsts), "postings")
    first = cut(postings.groupBy("element").agg(F.min(F.struct("id", "n", "m")).alias("first")), "firsts")

    fits = lambda x, y: (F.least(x, y) * den >= F.greatest(x, y) * num)
    met = postings.join(first, "element").where((F.col("id") != F.col("first.id")) & fits(F.col("n"), F.col("first.n")))
    counted = met.groupBy(F.col("first.id").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("shared"), F.min(F.least("m", "first.m")).alias("asked"))
    tried = counted.where("shared >= asked").groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
    tried = cut(tried, "first-pairs")
    links = _verified(tried, docs, width, num, den, key, text)
    found = cut(connected_components(links), "components")

    placed = postings.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("at", F.coalesce("component", "id")).select("element", "id", "n", "m", "p", "at")
    placed = cut(placed, "placed")
    open_ = cut(placed.groupBy("element").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("df")).where("lo < hi").select("element", "lo", "df"), "open")
    rest = cut(placed.join(open_, "element"), "open-postings")

    # frequent elements: components that meet in one are of one cluster, where it can be the first that links share
    frequent = rest.where(F.col("df") > FEW)
    often = cut(_fit_first(frequent, ["element"], num, den), "often")
    held = often.groupBy("id").agg(F.count("*").alias("live"))
    loose = frequent.groupBy("id").agg(F.count("*").alias("freq")).join(held, "id", "left")
    loose = cut(loose.select("id", "freq", (F.col("freq") - F.coalesce("live", F.lit(0))).alias("dead")).where("dead > 0"), "dead-elements")
    lows = often.groupBy("element").agg(F.min("at").alias("low"))
    joined = connected_components(often.join(lows, "element").where("at <> low").select(F.col("at").alias("a"), F.col("low").alias("b")).distinct())
    cluster = cut(joined.select(F.col("node").alias("at"), F.col("component").alias("cluster")), "clusters")
    linked = placed.join(found.select(F.col("node").alias("id")), "id", "left_semi").select("id", "n", "at")
    members = often.select("id", "n", "at").unionByName(linked).distinct().join(cluster, "at", "left")
    members = cut(members.select(F.coalesce("cluster", "at").alias("cluster"), "id", "n", "at"), "members")
    blocked = _block_links(_by_element(members, placed, num, den), docs, width, num, den, key, text)

    # rare ones: their pairs are few
    few = rest.where(F.col("df") <= FEW).join(members.select("id", "cluster"), "id", "left").join(loose, "id", "left")
    few = few.select("element", "id", "n", "m", "at", "cluster", F.coalesce("freq", F.lit(0)).alias("freq"), F.coalesce("dead", F.lit(0)).alias("dead"))
    other = few.select("element", *[F.col(c).alias(f"{c}_") for c in ("id", "n", "m", "at", "cluster", "freq", "dead")])
    apart = (F.col("at") != F.col("at_")) & ~F.coalesce(F.col("cluster") == F.col("cluster_"), F.lit(False))
    pairs = few.join(other, "element").where((F.col("id") < F.col("id_")) & apart & fits(F.col("n"), F.col("n_")))
    # they may share frequent elements that are in no cluster of theirs: no more than one of them has dead
    unseen = F.least("freq", "freq_", F.col("dead") + F.col("dead_"))
    enough = pairs.groupBy(F.col("id").alias("a"), F.col("id_").alias("b")).agg((F.count("*") + F.max(unseen)).alias("shared"), F.min(F.least("m", "m_")).alias("asked"))
    asked = cut(enough.where("shared >= asked").select("a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
    apart_links = _verified(asked.select("a", "b"), docs, width, num, den, key, text)
    links = cut(links.unionByName(blocked.where("b is not null").select("a", "b")).unionByName(apart_links), "all-links")
    found = cut(connected_components(links), "all-components")
    counted = apart_links.select(F.explode(F.array("a", "b")).alias("class_id"), F.lit(1).cast("long").alias("links"))
    counted = counted.unionByName(blocked.where("b is null").select(F.col("a").alias("class_id"), "links"))
    degree = counted.groupBy("class_id").agg(F.sum("links").alias("links"))
    facts = cut(found.withColumnRenamed("node", "class_id").join(degree, "class_id", "left"), "class-facts")

    sized = rows.join(repeated, ["sig_a", "sig_b", "n"], "left").withColumn("class_id", F.when(F.col("n") > 0, F.coalesce("class_id", "id")).otherwise(F.col("id")))
    return sized.join(facts, "class_id", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        "class_id",
        F.coalesce("component", "class_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
