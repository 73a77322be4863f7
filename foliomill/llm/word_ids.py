"""Ids of the word BPE by the tokenizers library, each distinct piece encoded once per worker.

The normaliser turns white space to single spaces and the pre-tokeniser drops
it, so no merge, composition or special token spans white space: the ids of a
text are the ids of its words.  Texts of printable ASCII and Latin-1 letters are
cut here as the pre-tokeniser cuts them, a batch at a time on arrays, and the
batch's distinct pieces are given to the library's BPE model.  Other texts are
cut into words: those of the same characters go the same way, every other word
through the library's whole pipeline.  A file whose normaliser or pre-tokeniser
isn't the one below goes through the library alone, text by text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Hashable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_GAPS = re.compile(r"[ \t\n\r]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The normaliser and pre-tokeniser that cutting at white space is right for.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# The same pattern on the characters of _PLAIN.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿÀ-ÖØ-Þ]+|[0-9]|[^\sa-z0-9ß-öø-ÿÀ-ÖØ-Þ]+")
_LONG = 48
# The same on bytes of Latin-1.
_LATIN = bytes(range(256)).decode("latin-1")
_LOWER = _LATIN.lower().encode("latin-1")
_SPACE = b"\t\n\r "
_CUTTABLE = _SPACE + "".join(c for c in _LATIN if _PLAIN.fullmatch(c)).encode("latin-1")
_GAP = re.compile(rb"[\t\n\r ]")
_CONTRACTION = re.compile(rb"'(?:[stmd]|re|ve|ll)")
_KINDS = np.array([0 if c in _SPACE.decode() else 1 if c.isalpha() else 2 if c in "0123456789" else 3 for c in _LATIN], np.uint8)
_BLOCK = 1 << 20


@cache
def byte_symbols() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for each byte (a public convention)."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Remembered(dict):
    """Values made on first use by ``make``; of ``most`` at least the half used last is kept."""

    def __init__(self, make: Callable[[Hashable], bytes], most: int):
        super().__init__()
        self.make, self.half, self.old = make, max(1, most // 2), {}

    def __missing__(self, key: str | bytes) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= _LONG:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


def _cuttable(text: str) -> bytes | None:
    """The text in Latin-1 if it has only the characters that are cut here, and no special token."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if data.translate(None, _CUTTABLE) or b"<|" in data else data


def _parts(data: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts of about size bytes, cut at white space."""
    at = 0
    while len(data) - at > size and (gap := _GAP.search(data, at + size)):
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:] if at else data


def _cut(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the pieces of lower-cased bytes start, and the pieces."""
    kinds = _KINDS[np.frombuffer(data, np.uint8)]
    starts = np.ones(len(data), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    starts |= kinds == 2
    if b"'" in data:
        for found in _CONTRACTION.finditer(data):
            at, end = found.span()
            if starts[at]:
                starts[at + 1] = False
                starts[end : end + 1] = True
    at = np.flatnonzero(starts)
    sizes = np.diff(at, append=len(data))
    words = kinds[at] != 0
    at, sizes = at[words], sizes[words]
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return at, pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data.translate(None, _SPACE))])


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids. At most ``most`` pieces and a third as many other words are remembered."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # special tokens that hold white space or lack "<|" would be missed by the cut
        special = all(t["content"].startswith("<|") and not t["content"].split()[1:] and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"])
        self.by_words = spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _PRE_TOKENIZER and spec["post_processor"] is None and special
        self.model = self.tokenizer.model
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = _Remembered(self._piece, most)
        self.other = _Remembered(self._other, most // 3)

    def _piece(self, piece: bytes) -> bytes:
        symbols = piece.decode("latin-1")
        if not piece.isascii():
            symbols = symbols.encode().decode("latin-1").translate(byte_symbols())
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(symbols)])

    def _library(self, text: str) -> bytes:
        return b"".join([self.id_bytes[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _other(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self.pieces[p.encode("latin-1")] for p in _PIECES.findall(word.lower())])
        return self._library(word)

    def _block(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts of texts, whose distinct pieces are looked up once for all of them."""
        at, pieces = _cut(b" ".join(parts).translate(_LOWER))
        coded = pieces.dictionary_encode()
        found = list(map(self.pieces.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(counts, out=ends[1:])
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        begins = np.cumsum([0, *[len(p) + 1 for p in parts]])
        bounds = (4 * ends[np.searchsorted(at, begins)]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode_all(self, texts: list[str | None], block: int = _BLOCK) -> list[bytes]:
        """The ids of each text. Texts are cut together up to about ``block`` characters; a longer one, in parts."""
        out: list[list[bytes]] = [[] for _ in texts]
        owners, parts, held = [], [], 0

        def flush() -> None:
            for i, ids in zip(owners, self._block(parts), strict=True):
                out[i].append(ids)

        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.by_words:
                out[i].append(self._library(text))
            elif (data := _cuttable(text)) is None:
                out[i] += [self.other[w] for w in _GAPS.split(text)]
            else:
                for part in _parts(data, block):
                    if parts and held + len(part) > block:
                        flush()
                        owners, parts, held = [], [], 0
                    owners.append(i)
                    parts.append(part)
                    held += len(part)
        if parts:
            flush()
        return [b"".join(o) for o in out]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


@cache
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder; it stays for later batches and tasks."""
    return WordEncoder(path)
