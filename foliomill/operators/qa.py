"""Answers held against their sources: excerpts, pages, citations, verdicts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import bitset
from ..functions import text as T
from ..session import cut

#: Characters of a key by which excerpts are looked for, and keys looked for in one pass over the texts.
KEY, KEYS_A_PASS = 12, 1 << 24
#: Characters of texts, or cells of tables, that are worked on together.
AT_ONCE = 1 << 18
#: Stretches by which a body that nearly holds an excerpt is looked for.
SEEDS = 8


def excerpt_found(excerpt: Column, body: Column) -> Column:
    """Whether the parts of an excerpt (split at ……) stand in the body in their order, word for word."""
    parts = F.filter(F.split(excerpt, "…+", -1), lambda p: p != "")
    step = lambda rest, p: F.when(rest.isNotNull() & rest.contains(p), F.substr(rest, F.instr(rest, p) + F.length(p)))
    return (F.size(parts) > 0) & F.aggregate(parts, body, step).isNotNull()


FACTOR = 0x9E3779B97F4A7C15


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _stretch_hashes(points: np.ndarray, lengths: list[int]) -> Iterator[np.ndarray]:
    """For each length, the hash of every stretch of so many of the points; from those of 1, 2, 4 and so on."""
    doubled = [points]
    for n in lengths:
        while 2 << (len(doubled) - 1) <= n:
            size, last = 1 << (len(doubled) - 1), doubled[-1]
            doubled.append(last[: max(0, len(last) - size)] * np.uint64(pow(FACTOR, size, 1 << 64)) + last[size:])
        out, done = np.full(max(0, len(points) - n + 1), n, np.uint64), 0
        for i, part in enumerate(doubled):
            if n >> i & 1:
                out = out * np.uint64(pow(FACTOR, 1 << i, 1 << 64)) + part[done : done + len(out)]
                done += 1 << i
        yield (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _windows(text: str, n: int) -> np.ndarray:
    """Hash of every stretch of n characters."""
    return next(_stretch_hashes(_points(text), [n]))


def _stretches(items: DataFrame, item: str, excerpt: str) -> DataFrame:
    """item, n, h, at: every stretch of KEY characters of each excerpt's longest part (all of a shorter one)."""
    parts = F.filter(F.split(excerpt, "…+", -1), lambda p: p != "")
    longest = F.get(F.array_sort(F.transform(parts, lambda p: F.struct((-F.length(p)).alias("n"), p.alias("p")))), F.lit(0))["p"]

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lengths = [min(KEY, len(t)) for t in texts]
            hashes = [_windows(t, n).view(np.int64) for t, n in zip(texts, lengths, strict=True)]
            row = np.repeat(np.arange(len(texts)), [len(h) for h in hashes])
            if len(row):
                at = np.concatenate([np.arange(len(h)) for h in hashes])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(np.array(lengths)[row].astype(np.int32)), pa.array(np.concatenate(hashes)), pa.array(at)], [item, "n", "h", "at"])

    asked = items.select(item, longest.alias("_part")).where("_part is not null")
    return asked.mapInArrow(stretches, f"`{item}` {dict(items.dtypes)[item]}, n int, h long, at long")


def excerpt_keys(items: DataFrame, item: str, excerpt: str) -> DataFrame:
    """item, n, h: the key of each excerpt, a stretch of KEY characters of its longest part (all of a shorter one).

    Of the stretches the one that fewest excerpts share is taken, so an opening
    that many have in common is no key.
    """
    every = _stretches(items, item, excerpt)
    shared = every.groupBy("n", "h").agg(F.count("*").alias("items"))
    return every.join(shared, ["n", "h"]).groupBy(item).agg(F.min(F.struct("items", "at", "n", "h")).alias("x")).select(item, "x.n", "x.h")


def _pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts of about AT_ONCE characters together, or a longer one alone, and the number of the first."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > AT_ONCE:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, texts[first:]


def _looked_up(keys: DataFrame, bodies: DataFrame) -> DataFrame:
    """path, n, h: which of the keys (n, h) stand in which body, each once a body; and some more, which a join with the keys leaves out.

    Texts are read once for each KEYS_A_PASS keys: every stretch of theirs is
    hashed and kept if a Bloom filter of the keys may hold it.
    """
    wanted = cut(keys.select("n", "h").distinct(), "keys-wanted")
    lengths = sorted(r["n"] for r in wanted.select("n").distinct().collect())  # at most KEY
    n_keys = wanted.count()
    passes = max(1, -(-n_keys // KEYS_A_PASS))
    found = None
    for i in range(passes):
        filled = bitset.make(wanted.where(F.pmod("h", F.lit(passes)) == i), F.col("h"), bitset.fitting_bits(4 * -(-n_keys // passes)))  # so few others pass
        shared = keys.sparkSession.sparkContext.broadcast(filled)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, texts in _pieces([x or "" for x in batch.column(1).to_pylist()]):
                    points = _points("".join(texts))
                    row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in texts])
                    for n, hashes in zip(lengths, _stretch_hashes(points, lengths), strict=True):
                        at = bitset.members_at(shared.value, hashes.view(np.int64))
                        at = at[row[at] == row[at + n - 1]]  # within one text
                        have, of = hashes.view(np.int64)[at], row[at]
                        order = np.lexsort((have, of))
                        have, of = have[order], of[order]
                        new = np.ones(len(of), bool)
                        new[1:] = (of[1:] != of[:-1]) | (have[1:] != have[:-1])
                        have, of = have[new], of[new]
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of + first)), pa.array(np.full(len(of), n, np.int32)), pa.array(have)], ["path", "n", "h"])

        hits = bodies.select("path", "text").mapInArrow(look, f"path {dict(bodies.dtypes)['path']}, n int, h long")
        found = hits if found is None else found.unionByName(hits)
    return found


def find_excerpts(items: DataFrame, bodies: DataFrame, item: str = "item_id", excerpt: str = "excerpt") -> DataFrame:
    """item and path of every excerpt that stands in a body (path, text): a query set held against all rows.

    Only pairs that share a key are compared.
    """
    keys = cut(excerpt_keys(items, item, excerpt), "excerpt-keys")
    pairs = _looked_up(keys, bodies).join(keys, ["n", "h"]).select("path", item).distinct()
    held = verify_excerpts(cut(pairs, "excerpt-pairs").join(items.select(item, F.col(excerpt).alias("excerpt")), item), bodies)
    return held.where("verified").select(item, "path").distinct()


def _bands(excerpts: list[str], texts: list[str], limits: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, int]]:
    """For each pair and each run of nearby diagonals of shared seeds: its number, the points of both, the first and the last diagonal."""
    last, cells, theirs = None, None, {}
    for pair, (excerpt, text, limit) in enumerate(zip(excerpts, texts, limits, strict=True)):
        n = min(KEY, len(excerpt))
        if not n:
            continue
        if text != last:
            last, cells, theirs = text, _points(text).astype(np.int32), {}
        if n not in theirs:
            theirs[n] = _windows(text, n)
        mine = _windows(excerpt, n)
        order = np.argsort(mine)
        ordered = mine[order]
        where = np.flatnonzero(ordered[np.minimum(np.searchsorted(ordered, theirs[n]), len(ordered) - 1)] == theirs[n])
        first, upto = (np.searchsorted(ordered, theirs[n][where], side) for side in ("left", "right"))
        each = upto - first
        place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first, each)
        diagonals = np.unique(np.repeat(where, each) - order[place])
        points = _points(excerpt).astype(np.int32)
        for group in np.split(diagonals, np.flatnonzero(np.diff(diagonals) > limit) + 1) if len(diagonals) else []:
            yield pair, points, cells, int(group[0]), int(group[-1])


def all_edits(excerpts: list[str], texts: list[str], limits: list[int]) -> list[int | None]:
    """``edits`` of each excerpt, text and limit; the tables of many are filled side by side."""
    best = np.array(limits, np.int64).reshape(-1) + 1
    bands = sorted(_bands(excerpts, texts, limits), key=lambda x: (len(x[1]), x[4] - x[3]))
    begin = 0
    while begin < len(bands):
        end, size = begin, 0
        while end < len(bands):
            pair, a, _, low, high = bands[end]
            size = max(size, len(a) + high - low + 2 * limits[pair] + 1)
            if end > begin and (end + 1 - begin) * size > AT_ONCE:
                break
            end += 1
        some, begin = bands[begin:end], end
        pairs, length, limit = np.array([x[0] for x in some]), np.array([len(x[1]) for x in some]), np.array([limits[x[0]] for x in some])
        start = np.array([x[3] for x in some]) - limit  # how much of the text stands before the first cell of the band
        width = np.array([x[4] for x in some]) + limit - start + 1
        in_text = np.array([len(x[2]) for x in some])
        across = np.arange(int(width.max()), dtype=np.int32)
        theirs = np.full((len(some), len(across) + int(length.max())), -1, np.int32)
        mine = np.full((len(some), int(length.max())), -2, np.int32)
        for i, (_, a, b, _, _) in enumerate(some):
            mine[i, : len(a)] = a
            cells = b[max(0, start[i]) : max(0, start[i] + theirs.shape[1])]
            theirs[i, max(0, -start[i]) :][: len(cells)] = cells
        far = np.int32(1 << 29)
        row = np.where((across >= -start[:, None]) & (across <= np.minimum(in_text - start, width - 1)[:, None]), np.int32(0), far)
        for i in range(mine.shape[1]):
            step = row + (theirs[:, i : i + len(across)] != mine[:, i, None])
            np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
            step -= across
            np.minimum.accumulate(step, axis=1, out=step)
            step += across
            outside = (across < (-start - i - 1)[:, None]) | (across > np.minimum(in_text - start - i - 1, width - 1)[:, None])
            step[outside] = far
            row = step
            ended = length == i + 1
            if ended.any():
                np.minimum.at(best, pairs[ended], row[ended].min(axis=1))
    return [int(x) if x <= limit else None for x, limit in zip(best, limits, strict=True)]


def edits(excerpt: str, text: str, limit: int) -> int | None:
    """The least number of edits between the excerpt and some stretch of the text that shares a seed with it; None beyond limit.

    Seeds are shared stretches of KEY characters (of all of a shorter excerpt).
    Seeds on nearby diagonals are extended together, in a band that leaves room
    for limit edits to both sides.
    """
    return all_edits([excerpt], [text], [limit])[0]


def near_passages(items: DataFrame, bodies: DataFrame, share: float = 0.2, item: str = "item_id", excerpt: str = "excerpt") -> DataFrame:
    """item, path and distance where an excerpt (its longest part) is nearly in a body: at most ``share`` of its length in edits.

    Compared are bodies that hold one of the SEEDS stretches of the excerpt that
    are in fewest bodies; a turn of phrase that is everywhere is no evidence
    where a rarer one is.
    """
    every = cut(_stretches(items, item, excerpt).select(item, "n", "h").distinct(), "excerpt-stretches")
    found = cut(_looked_up(every, bodies), "stretches-found")
    often = found.groupBy("n", "h").agg(F.count("*").alias("bodies"))
    rarest = Window.partitionBy(item).orderBy("bodies", "n", "h")
    seeds = every.join(often, ["n", "h"]).withColumn("rank", F.row_number().over(rarest)).where(F.col("rank") <= SEEDS)
    pairs = cut(found.join(seeds, ["n", "h"]).select("path", item).distinct(), "near-pairs")
    parts = F.filter(F.split(excerpt, "…+", -1), lambda p: p != "")
    longest = F.get(F.array_sort(F.transform(parts, lambda p: F.struct((-F.length(p)).alias("n"), p.alias("p")))), F.lit(0))["p"]
    both = pairs.join(items.select(item, longest.alias("_part")), item).join(bodies.select("path", "text"), "path").select(item, "path", "_part", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                excerpts, texts = part.column(2).to_pylist(), [y or "" for y in part.column(3).to_pylist()]
                found = all_edits(excerpts, texts, [int(share * len(x)) for x in excerpts])
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, pa.int32())], [item, "path", "distance"])

    kinds = dict(both.dtypes)
    return both.mapInArrow(compare, f"`{item}` {kinds[item]}, path {kinds['path']}, distance int").where("distance is not null")


def verdicts(provenance: DataFrame, passages: DataFrame, share: float = 0.2) -> DataFrame:
    """answer_id, seq, verdict, and the path, article and distance of the nearest passage, for every row of provenance.

    provenance: answer_id, seq, path, article (null: any), excerpt.  passages:
    path, article, text.  An excerpt that stands word for word in its passage is
    正确; in another one alone 条次误用; nearly in any passage 摘抄错误; in none
    编造.  No excerpt is 溯源不足.  Of several nearest passages the least by path
    and article is told.  Null paths and texts hold nothing.
    """
    rows = provenance.select("answer_id", "seq", "path", "article", F.when(T.strip(F.regexp_replace("excerpt", "…", "")) != "", F.col("excerpt")).alias("excerpt")).withColumn("e", F.sha2("excerpt", 256))
    rows = cut(rows, "provenance")
    bodies = cut(passages.where("text is not null").select(F.monotonically_increasing_id().alias("pid"), F.col("path").alias("at_path"), F.col("article").alias("at_article"), "text"), "passages")
    texts = bodies.select(F.col("pid").alias("path"), "text")
    items = cut(rows.where("excerpt is not null").select("e", "excerpt").distinct(), "excerpts")
    named = bodies.select("pid", "at_path", "at_article")
    exact = cut(find_excerpts(items, texts, "e").join(named, F.col("path") == F.col("pid")).select("e", "at_path", "at_article"), "exact-excerpts")
    left = items.join(exact.select("e"), "e", "left_anti")
    near = near_passages(left, texts, share, "e").join(named, F.col("path") == F.col("pid")).select("e", "at_path", "at_article", "distance")
    best = exact.withColumn("distance", F.lit(0)).unionByName(near).groupBy("e").agg(F.min(F.struct("distance", "at_path", "at_article")).alias("best"))
    claimed = rows.where("path is not null").select("e", "path", "article").distinct()
    same = (F.col("at_path") == F.col("path")) & (F.col("article").isNull() | (F.col("at_article") == F.col("article")))
    right = claimed.join(exact, "e").where(same).select("e", "path", "article").distinct().withColumn("right", F.lit(True))
    joined = rows.join(best, "e", "left").alias("r").join(right.alias("k"), F.col("r.e").eqNullSafe(F.col("k.e")) & F.col("r.path").eqNullSafe(F.col("k.path")) & F.col("r.article").eqNullSafe(F.col("k.article")), "left")
    verdict = F.when(F.col("r.excerpt").isNull(), "溯源不足").when(F.col("right"), "正确").when(F.col("best.distance") == 0, "条次误用").when(F.col("best.distance") > 0, "摘抄错误").otherwise("编造")
    own = lambda c, mine: F.when(F.col("right"), F.coalesce(mine, F.col(f"best.{c}"))).otherwise(F.col(f"best.{c}"))
    return joined.select("r.answer_id", "r.seq", verdict.alias("verdict"), own("at_path", F.col("r.path")).alias("found_path"), own("at_article", F.col("r.article")).alias("found_article"), F.col("best.distance").alias("distance"))


def fill_down(rows: DataFrame, columns: list[str], key: str = "answer_id") -> DataFrame:
    """同上 and blanks take the value of the row above."""
    w = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    for c in columns:
        rows = rows.withColumn(c, F.last(F.when(~F.col(c).isin("同上", ""), F.col(c)), True).over(w))
    return rows


def verify_excerpts(provenance: DataFrame, bodies: DataFrame) -> DataFrame:
    """Provenance rows with verified: the excerpt stands in the body at its path."""
    joined = provenance.join(bodies.select("path", "text"), "path", "left")
    return joined.withColumn("verified", F.coalesce(excerpt_found(F.col("excerpt"), F.col("text")), F.lit(False))).drop("text")


def wrong_pages(provenance: DataFrame, page_map: DataFrame) -> DataFrame:
    """Provenance rows whose page isn't that of the index catalog."""
    return provenance.join(page_map, ["norm", "label"]).where(~F.col("cited_page").eqNullSafe(F.col("page")))


def cited_numbers(text: Column) -> Column:
    """Numbers cited as 序号 n or 序号 n、m, in digits of any script; null for those beyond an int."""
    runs = F.regexp_extract_all(text, F.lit(r"(?U)序号\s*(\d+(?:\s*、\s*\d+)*)"), F.lit(1))
    return F.array_distinct(F.transform(F.filter(F.flatten(F.transform(runs, lambda r: F.split(r, r"(?U)\s*、\s*"))), lambda x: x != ""), T.number))


def dangling_citations(answers: DataFrame, provenance: DataFrame) -> DataFrame:
    """Numbers that an answer cites and its provenance table lacks."""
    cited = answers.select("answer_id", F.explode(cited_numbers(F.col("text"))).alias("seq"))
    return cited.join(provenance.select("answer_id", "seq"), ["answer_id", "seq"], "left_anti")


def verdict_counts(verdicts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of each verdict (a matrix, with ``by`` as its rows)."""
    return verdicts.groupBy(*(by or []), "verdict").agg(F.count("*").alias("n"))


def clause_citations(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """《norm》第x条 mentions: key, norm, article."""
    pair = r"《([^》]+)》\s*(第[一二三四五六七八九十百零〇两\d]+条)"
    whole = F.explode(F.regexp_extract_all(F.col("line"), F.lit(pair), F.lit(0)))
    return lines.select(key, whole.alias("m")).select(key, F.regexp_extract("m", pair, 1).alias("norm"), F.regexp_extract("m", pair, 2).alias("article"))
