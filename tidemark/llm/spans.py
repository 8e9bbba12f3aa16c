"""Words of Arrow text batches as NumPy spans, without a Python loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (A-Z count as a-z).
PLAIN_WORD = np.zeros(256, dtype=bool)
PLAIN_WORD[48:58] = True
PLAIN_WORD[65:91] = True
PLAIN_WORD[97:123] = True
PLAIN_WORD[128:] = True

#: Bytes of words ``[^\x20\x09-\x0D]+``.
SPACED_WORD = np.ones(256, dtype=bool)
SPACED_WORD[32] = False
SPACED_WORD[9:14] = False

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEP = 0x100000001B3


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``most`` bytes, at least one row each."""
    n = len(texts)
    if n == 0:
        return
    offsets = text_offsets(texts)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield texts.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()  # workers stay, and idle ones hold memory


def text_offsets(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    if texts.buffers()[1] is None:
        return np.zeros(len(texts) + 1, dtype=np.int64)
    raw = np.frombuffer(texts.buffers()[1], dtype=kind)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


class TextBatch:
    """The bytes of a slice of texts; nulls are empty texts."""

    def __init__(self, texts: pa.Array):
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = text_offsets(texts)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.rows = len(texts)

    def words(self, alphabet: np.ndarray, *, lower: bool) -> Words:
        return Words(self, alphabet, lower)


class Words:
    """Spans of maximal runs of the alphabet's bytes, none across texts."""

    def __init__(self, batch: TextBatch, alphabet: np.ndarray, lower: bool):
        inside = alphabet[batch.bytes]
        n = len(inside)
        first = batch.offsets[:-1]
        first = first[first < n]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[first] = inside[first]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        before = first[first > 0] - 1
        closes[before] = inside[before]
        self.batch = batch
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        #: Words before each text, and after the last.
        self.bounds = np.searchsorted(self.starts, batch.offsets)
        self.counts = np.diff(self.bounds)
        kept = batch.bytes[inside]
        self.chars = LOWER[kept] if lower else kept
        self.lengths = self.ends - self.starts

    def __len__(self) -> int:
        return len(self.starts)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.batch.rows), self.counts)

    def char_starts(self) -> np.ndarray:
        """Where each word starts in ``chars``, and the end of the last."""
        out = np.zeros(len(self) + 1, dtype=np.int64)
        np.cumsum(self.lengths, out=out[1:])
        return out

    def binary(self) -> pa.Array:
        """The words as an Arrow array."""
        at = self.char_starts()
        if at[-1] < 2**31:
            return pa.Array.from_buffers(
                pa.binary(),
                len(self),
                [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(self.chars)],
            )
        return pa.Array.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(at), pa.py_buffer(self.chars)]
        )

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word and the different words by number."""
        coded = self.binary().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def hashes(self, seed: int = STEP) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial of its bytes, mixed."""
        if not len(self):
            return np.zeros(0, np.uint64)
        at = self.char_starts()[:-1]
        place = np.arange(len(self.chars)) - np.repeat(at, self.lengths)
        weight = powers(seed, int(self.lengths.max()))[place]
        sums = np.add.reduceat((self.chars.astype(np.uint64) + np.uint64(1)) * weight, at)
        return mixed(sums ^ (self.lengths.astype(np.uint64) * GOLDEN))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes, by the place of its first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= GOLDEN
        out += words[j : j + n]
    return mixed(out)


def sliding_minimum(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by doubling."""
    out, span = values, 1
    while span < w:
        step = min(span, w - span)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        span += step
    return out
