"""Substring dedup by sliding sentence spans.

A text is cut into sentences, and a sentence before each word whose hash is the
least in some WINDOW consecutive words of it.  So a unit has at most WINDOW
words, and whether a word starts one depends only on the words less than WINDOW
places away: two texts that share a passage have the same units in it but for
at most 2 * WINDOW - 2 words at either end, wherever in a sentence it begins.

Runs of units are hashed: the runs of ``sentences`` whole sentences (those
without a word not counted), and, so that passages that begin or end inside a
sentence are found too, from each unit and up to each unit the shortest run of
MIN_UNITS units with ``words`` words.  A shared passage of 4 * WINDOW - 3 +
``words`` words holds such a run.  Runs are joined over all documents: one that
lies elsewhere before (by document, then place) is not the first, and the units
it covers go.  The first occurrence stays, in whatever document.

White space and case don't count in a hash.  In scripts written without spaces
each letter counts as a word.  Null texts stay null, empty ones empty; texts that
are all repeats become empty; a text of any length is one row, its work linear
in it.  Null keys sort first.  Rows with equal keys and different texts are
documents of their own, in a fixed order; rows equal in both are one document,
whose repeats aren't compared with each other.  No rows give no rows.  Extra
columns pass through; those called like a result column give way to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, scratch
from . import bitset
from .rows import number_rows, under_plain_names
from .shingles import M1, M2, blocks, mix

#: Letters of Thai, Lao, Burmese, Khmer, kana and Han, which stand without spaces.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_HAS_DENSE = re.compile(f"[{_DENSE}]")
_SENTENCE = re.compile(r"[^.!?\n。！？]*(?:[.!?。！？]+|\n|\Z)\s*")
_WORD = re.compile(rf"(?:[{_DENSE}]|[^\s{_DENSE}]+)\s*")
STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIN_UNITS, WINDOW = 3, 7


def _starts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each word starts a unit; counts are the words of each sentence."""
    n = len(hashes)
    starts = np.zeros(n, bool)
    starts[(np.cumsum(counts) - counts)[counts > 0]] = True
    if n >= WINDOW:
        sentence = np.repeat(np.arange(len(counts)), counts)
        least = hashes[: n - WINDOW + 1]
        for i in range(1, WINDOW):
            least = np.minimum(least, hashes[i : n - WINDOW + 1 + i])
        least = np.where(sentence[: n - WINDOW + 1] == sentence[WINDOW - 1 :], least, 0)
        # a word is the least of a window that holds it if it equals the greatest of their least ones
        greatest = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            part = greatest[i : n - WINDOW + 1 + i]
            np.maximum(part, least, out=part)
        starts |= greatest == hashes
    return starts


def _cut(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Sentences, their numbers of words and the words' hashes (never 0)."""
    sentences = [s for s in _SENTENCE.findall(text) if s]
    if _HAS_DENSE.search(text):
        parts = [[w.strip() for w in _WORD.findall(s.lower())] for s in sentences]
        counts, words = np.array([len(p) for p in parts], np.int64), [w for p in parts for w in p]
    else:
        counts, words = np.array([len(s.split()) for s in sentences], np.int64), " ".join(sentences).lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) | np.uint64(1)
    return sentences, counts, hashes


def _pieces(sentence: str, starts: np.ndarray) -> list[str]:
    """The units of a sentence; ``starts`` marks its words that start one."""
    cuts = [*np.flatnonzero(starts).tolist(), len(starts)]
    if len(cuts) < 3:
        return [sentence]
    words = _WORD.findall(sentence.lstrip())
    words[0] = sentence[: len(sentence) - len(sentence.lstrip())] + words[0]
    return ["".join(words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def units(text: str) -> list[str]:
    """The units of a text; joined they are the text."""
    sentences, counts, hashes = _cut(text)
    starts = np.split(_starts(hashes, counts), np.cumsum(counts)[:-1])
    return [u for s, x in zip(sentences, starts, strict=True) for u in _pieces(s, x)] if sentences else []


def without_spans(text: str, a: np.ndarray, b: np.ndarray) -> tuple[str, int]:
    """A text without its units from each a to b (exclusive), and how many went; only sentences that go in part are cut."""
    sentences, counts, hashes = _cut(text)
    starts = _starts(hashes, counts)
    first = np.cumsum(counts) - counts
    begun = np.append(0, np.cumsum(starts))
    sizes = np.maximum(begun[first + counts] - begun[first], 1)
    at = np.cumsum(sizes) - sizes
    edge = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, b, -1)
    drop = np.cumsum(edge)[:-1] > 0
    kept = []
    for i, (s, gone, n) in enumerate(zip(sentences, np.add.reduceat(drop.astype(np.int64), at).tolist(), sizes.tolist(), strict=True)):
        if not gone:
            kept.append(s)
        elif gone < n:
            pieces = _pieces(s, starts[first[i] : first[i] + counts[i]])
            kept += [u for u, d in zip(pieces, drop[at[i] : at[i] + n].tolist(), strict=True) if not d]
    left = "".join(kept)
    return (left.rstrip() if drop[-1] else left), int(drop.sum())


def _spans(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each stretch from a to b (exclusive)."""
    n = len(hashes)
    powers = np.full(n + 1, STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(n + 1, BACK)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.append(np.uint64(0), np.cumsum(hashes * powers[:-1]))
    return mix((sums[b] - sums[a]) * inverse[a] ^ (b - a).astype(np.uint64) * M1)


def block_runs(texts: list[str | None], sentences: int, words: int) -> tuple[np.ndarray, ...]:
    """text (its number), a, b (units of the text, b exclusive), hash and again of every run of some texts.

    The texts' words stand behind each other, and no run crosses from one to the
    next; ``again`` marks runs that their text holds before.
    """
    parts = [_cut(t) for t in texts if t]
    if not parts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    number = np.flatnonzero([bool(t) for t in texts])
    counts, hashes = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    starts = _starts(hashes, counts)
    of_sentence = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
    first = np.cumsum(counts) - counts
    # units: a sentence without words is one too
    blank = counts == 0
    of_word = np.repeat(of_sentence, counts)
    at = np.concatenate([first[blank], np.flatnonzero(starts)])
    of, is_blank = np.concatenate([of_sentence[blank], of_word[starts]]), np.arange(len(at)) < blank.sum()
    order = np.lexsort((~is_blank, at, of))
    at, of, is_blank = at[order], of[order], is_blank[order]
    ends = np.append(at[1:], len(hashes))
    n = len(at)
    unit = mix(_spans(mix(hashes), at, ends) ^ M2)
    low, high = (np.searchsorted(of, of, side=side) for side in ("left", "right"))
    # the shortest runs with enough words from and up to each unit
    total, here = np.append(0, np.cumsum(ends - at)), np.arange(n)
    upto = np.maximum(np.searchsorted(total, total[:-1] + words), here + MIN_UNITS)
    since = np.minimum(np.searchsorted(total, total[1:] - words, side="right") - 1, here + 1 - MIN_UNITS)
    forth, back = upto <= high, since >= low
    # runs of whole sentences; those with enough words hold runs of units that cover them
    begins = np.zeros(len(hashes) + 1, bool)
    begins[first[~blank]] = True
    begin = np.flatnonzero(begins[at] & ~is_blank)
    last = np.flatnonzero(np.diff(of, append=-1)) + 1
    edges, owner = np.concatenate([begin, last]), np.concatenate([of[begin], of[last - 1]])
    order = np.lexsort((edges, owner))
    edges, owner = edges[order], owner[order]
    a, b = edges[:-sentences], edges[sentences:]
    short = (owner[:-sentences] == owner[sentences:]) & (total[b] - total[a] < words)
    a = np.concatenate([here[forth], since[back], a[short]])
    b = np.concatenate([upto[forth], here[back] + 1, b[short]])
    code = np.unique(a * (n + 1) + b)
    a, b = code // (n + 1), code % (n + 1)
    h = _spans(unit, a, b)
    again = np.ones(len(a), bool)
    again[np.unique(h ^ mix(of[a].astype(np.uint64)), return_index=True)[1]] = False
    return number[of[a]], a - low[a], b - low[a], h, again


def runs(docs: DataFrame, row: str, text: str, sentences: int, words: int, held: Broadcast | None = None) -> DataFrame:
    """h, id, a, b of every run of every text; ``again`` if the text holds the same run before.

    With a filter ``held`` only runs that it holds, and those that come again.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for low, high in blocks(texts, 1 << 18):
                of, a, b, h, again = block_runs(texts[low:high], sentences, words)
                columns = [h.view(np.int64), ids[low:high][of], a.astype(np.int32), b.astype(np.int32), again]
                if held is not None:
                    keep = bitset.holds(held.value, columns[0]) | again
                    columns = [c[keep] for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "id", "a", "b", "again"])

    return docs.select(row, text).mapInArrow(find, "h long, id long, a int, b int, again boolean")


def covered_units(docs: DataFrame, row: str, text: str, sentences: int, words: int) -> DataFrame:
    """id and spans (array of a, b): the runs of each row that aren't the first of their kind.

    A Bloom filter of the repeated runs keeps most others out of the second
    shuffle; what it lets through by chance the join drops.
    """
    every = runs(docs, row, text, sentences, words)
    seen = every.where("not again").groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    repeated = cut(seen.where("first < last").select("h", "first"), "repeated-runs")
    held = docs.sparkSession.sparkContext.broadcast(bitset.make(repeated, F.col("h"), bitset.fitting_bits(repeated.count())))
    later = runs(docs, row, text, sentences, words, held).join(repeated, "h", "left").where("again or id <> first")
    return later.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: int = 3, words: int = 24) -> DataFrame:
    """docs with text cut and the columns removed_units and removed_chars."""
    return under_plain_names(docs, [key, text], ["removed_units", "removed_chars"], lambda d: _remove_repeats(d, key, text, sentences, words))


def _remove_repeats(docs: DataFrame, key: str, text: str, sentences: int, words: int) -> DataFrame:
    columns = docs.columns
    numbered, _ = number_rows(docs, key, text)
    with scratch(docs.sparkSession):
        found = cut(covered_units(numbered, "_row", text, sentences, words), "covered-units", stays=True)
    joined = numbered.join(found.select(F.col("id").alias("_row"), F.col("spans").alias("_spans")), "_row", "left").select(*columns, "_spans")
    at = columns.index(text)

    def cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone, chars = [], [], []
            spans = batch.column(len(columns))
            of, ends = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), spans.flatten()
            a, b = (ends.field(i).to_numpy() for i in (0, 1))
            stop = np.cumsum(of)
            for value, low, high in zip(batch.column(at), (stop - of).tolist(), stop.tolist(), strict=True):
                t, n = value.as_py(), 0
                left = t
                if t and high > low:
                    left, n = without_spans(t, a[low:high], b[low:high])
                texts.append(left)
                gone.append(n)
                chars.append(len(t or "") - len(left or ""))
            arrays = [*batch.columns[: len(columns)], pa.array(gone, pa.int64()), pa.array(chars, pa.int64())]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "removed_units", "removed_chars"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return joined.mapInArrow(cut_text, f"{schema}, removed_units long, removed_chars long")
