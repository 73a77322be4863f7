"""Byte-level BPE by a depth-first walk of a trie of distinct words.

The encoding of a word is fixed by the last token of each of its prefixes: cut
that token off, and what remains is a shorter prefix with its own encoding.
Words that begin alike therefore share the work on their common prefix.  The
distinct words of a batch form a trie (a node per distinct prefix); it is walked
depth first, each node takes the only token that ends its prefix and can follow
the last token of the prefix before it, and a word is read off by going back.

Two tokens can stand side by side when no merge across their border comes
earlier than the merges that use up its two sides.

Null and empty texts have no ids and decode to the empty text; a text of any
length is one row.  Equal texts have equal ids, whatever batch they fall in, and
repeated rows and equal or null keys stay as they are.  Merges of equal rank
apply from the left.  No rows give no rows.  Extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .word_ids import byte_symbols

# Fixed value: the byte-level pre-tokeniser's public pattern.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Where this finds nothing, every space that follows a non-empty field begins a word by itself.
_LONG_GAP = re.compile(r"\s\s(?:\s|\Z)")
_LONG = 48
NONE: tuple[int, ...] = ()
CODES = "ids binary, decoded string"


class TrieBpe:
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str, most: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: b for b, s in byte_symbols().items()}
        raw = lambda token: bytes(byte_of[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.bytes_of = {i: b for b, i in self.id_of.items()} | {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            pair = (self.id_of[a], self.id_of[b])
            self.rank[pair] = r
            self.parts.setdefault(self.id_of[a + b], (*pair, r))
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.bytes_of) + 1)]
        self.special_ids = {t: self.id_bytes[i] for t, i in self.special.items()}
        # by the last three bytes, the lengths of the tokens that end so, longest first
        ends: dict[bytes, set[int]] = {}
        for b in self.id_of:
            ends.setdefault(b[-3:], set()).add(len(b))
        self.lengths = {e: sorted(n, reverse=True) for e, n in ends.items() if len(e) == 3}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fits: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict[int, list[tuple[int, float]]], ...] = ({}, {})
        self.pieces: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.most = most

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens on one side of a token while it is built, each with the merge that uses it up."""
        found = self.edges[side].get(token)
        if found is None:
            found, now, used = [], token, float("inf")
            while True:
                found.append((now, used))
                if now not in self.parts:
                    break
                *sides, used = self.parts[now]
                now = sides[side]
            self.edges[side][token] = found
        return found

    def can_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together encode to just these two."""
        fits = self.fits.get((left, right))
        if fits is None:
            # at equal rank the leftmost merge comes first
            fits = not any(
                (r := self.rank.get((a, b))) is not None and r < used_a and r <= used_b
                for a, used_a in self._edge(left, 1)
                for b, used_b in self._edge(right, 0)
            )
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            self.fits[left, right] = fits
        return fits

    def encode_words(self, words: Iterable[str]) -> None:
        """Put the ids of distinct words into ``pieces``, sharing the work on common prefixes."""
        id_of, lengths, fits, can_follow, id_bytes = self.id_of, self.lengths, self.fits, self.can_follow, self.id_bytes
        token, back = [-1], [0]  # of each trie node; node 0 is the root
        path, last = [0], b""  # nodes of the present word's prefixes
        for data in sorted([w.encode() for w in words]):
            keep = 0
            for x, y in zip(last, data):  # noqa: B905
                if x != y:
                    break
                keep += 1
            del path[keep + 1 :]
            for end in range(keep + 1, len(data) + 1):
                for n in lengths.get(data[end - 3 : end], NONE) if end > 2 else NONE:
                    if n <= end and (t := id_of.get(data[end - n : end])) is not None:
                        before = path[end - n]
                        if before == 0 or ((ok := fits.get((token[before], t))) is None and can_follow(token[before], t)) or ok:
                            break
                else:
                    t, before = id_of.get(data[end - 2 : end]) if end > 1 else None, path[end - 2]
                    if t is None or (before and not can_follow(token[before], t)):
                        t, before = id_of[data[end - 1 : end]], path[end - 1]
                path.append(len(token))
                token.append(t)
                back.append(before)
            last, node, ids = data, path[len(data)], []
            while node:
                ids.append(id_bytes[token[node]])
                node = back[node]
            ids.reverse()
            self.pieces[data.decode()] = b"".join(ids)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for known in (self.first, self.later, self.pieces):
            if len(known) > self.most:
                known.clear()
        # a text is a list of (known ids of words, words), in order
        plans, new_first, new_later, new = [], set(), set(), set()
        for text in texts:
            plan = []
            for i, part in enumerate(self.special_cut.split(text or "") if self.special_cut else [text or ""]):
                if i % 2:
                    plan.append((self.special_ids, [part]))
                elif not part:
                    continue
                elif _LONG_GAP.search(part):
                    found = _WORDS.findall(part)
                    new.update(found)
                    plan.append((self.pieces, found))
                else:
                    fields = part.split(" ")
                    head = fields[:1]
                    del fields[0]
                    new_first.update(head)
                    new_later.update(fields)
                    plan += ((self.first, head), (self.later, fields))
            plans.append(plan)
        cuts = []
        for fields, known, space in ((new_first, self.first, ""), (new_later, self.later, " ")):
            fields.difference_update(known)
            cut = {f: None if f.isalpha() else _WORDS.findall(space + f) for f in fields}
            new.update([space + f for f, found in cut.items() if found is None])
            for found in cut.values():
                if found:
                    new.update(found)
            cuts.append((cut, known, space))
        new.difference_update(self.pieces)
        self.encode_words(new)
        pieces = self.pieces
        for cut, known, space in cuts:
            for f, found in cut.items():
                known[f] = pieces[space + f] if found is None else b"".join([pieces[w] for w in found])
        out = [b"".join([known[w] for known, words in plan for w in words]) for plan in plans]
        for fields, known in ((new, self.pieces), (new_first, self.first), (new_later, self.later)):
            for long in [f for f in fields if len(f) > _LONG]:
                del known[long]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def trie_bpe(path: str) -> TrieBpe:
    """The worker's coder; it stays for later batches and tasks."""
    return TrieBpe(path)


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold ``least`` bytes: a larger trie shares more prefixes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode_decode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", trie_bytes: int = 6 << 20) -> DataFrame:
    """key, ids (binary, little-endian unsigned 32-bit) and the text decoded from them.

    A trie is built of the distinct words of about ``trie_bytes`` of text.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = trie_bpe(tokenizer_path)
        for batch in gathered(batches, trie_bytes):
            ids = coder.encode_batch(batch.column(1).to_pylist())
            decoded = pa.array([coder.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), decoded], [key, "ids", "decoded"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(code, f"`{key}` {kind}, {CODES}")
