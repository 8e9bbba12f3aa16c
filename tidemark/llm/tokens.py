"""Token ids of whole texts by a public tokenizer, in Arrow batches.

A tokenizer that drops white space gives a text the ids of its words in order.
Its words repeat, so each different word is encoded once per worker and the
ids of a text are gathered. Text is cut only where the tokenizer itself must cut:
at ASCII white space, and between an ASCII letter and an ASCII sign other than
the apostrophe; ASCII letters are lowered first. Tokenizers that probes show to be
otherwise encode each text whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.shared import worker_memory
from tidemark.llm.spans import LOWER, SPACED_WORD, TextBatch, Words, slices

#: A worker remembers the words it met lately: twice this many at most, besides those
#: of the slice at hand.
MOST_WORDS = 175_000

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
SIGN = np.zeros(256, dtype=bool)
SIGN[33:48] = SIGN[58:65] = SIGN[91:97] = SIGN[123:127] = True
SIGN[39] = False

#: Bytes as the byte-level step of a tokenizer writes them: printable Latin-1
#: signs stand for themselves, the others follow from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(sorted({*range(256)} - {*PRINTABLE}))}
#: Letters that only change by case: no normalisation, no split inside a word.
LATIN = re.compile("[a-zß-öø-ÿ]+")


class _Pieces(Words):
    """Words that also end between a letter and a sign; ASCII letters in lower case."""

    def __init__(self, batch: TextBatch, plain: bool):
        super().__init__(batch, SPACED_WORD, lower=plain)
        if not plain or len(batch.bytes) < 2:
            return
        letter, sign = LETTER[batch.bytes], SIGN[batch.bytes]
        cut = (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
        inner = batch.offsets[(batch.offsets > 0) & (batch.offsets < len(batch.bytes))]
        cut[inner - 1] = False
        at = np.flatnonzero(cut) + 1
        self.starts = np.sort(np.concatenate([self.starts, at]), kind="stable")
        self.ends = np.sort(np.concatenate([self.ends, at]), kind="stable")
        self.bounds = np.searchsorted(self.starts, batch.offsets)
        self.counts = np.diff(self.bounds)
        self.lengths = self.ends - self.starts


class Encoder:
    """Ids of texts as the tokenizer in ``path`` gives them, no special ones added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        ids = self._whole
        pairs = ("ab", " ", "cd"), ("ab", ",", "cd"), ("it's", "\n", "$x"), ("", "QUITE", "")
        self.by_word = all(
            ids(["".join(p)])[0] == [i for part in ids(list(p)) for i in part]
            and ids(list(p)) == ids([part.lower() for part in p])
            for p in pairs
        )
        self.model = self.tokenizer.model
        probe = [w.encode() for w in ("hello", "été", "straße", "ñandú")]
        self.by_model = [self._modelled(w.decode()) for w in probe] == ids([w.decode() for w in probe])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _modelled(self, word: str) -> list[int]:
        """Ids of one lower-case Latin word, past the steps that leave it as it is."""
        signs = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
        return [t.id for t in self.model.tokenize(signs)]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        rest = []
        for word in words:
            text = word.decode()
            if self.by_model and LATIN.fullmatch(text):
                self.known[word] = np.array(self._modelled(text), dtype=np.uint32).tobytes()
            else:
                rest.append(text)
        for at in range(0, len(rest), 20_000):
            some = rest[at : at + 20_000]
            for text, ids in zip(some, self._whole(some), strict=True):
                self.known[text.encode()] = np.array(ids, dtype=np.uint32).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has. Null is the empty text."""
        if not self.by_word:
            every = self._whole([t or "" for t in texts.to_pylist()])
            counts = np.array([len(x) for x in every], dtype=np.int64)
            return np.array([i for x in every for i in x], dtype=np.uint32), counts
        batch = TextBatch(texts)
        raw = LOWER[batch.bytes].tobytes()
        words = _Pieces(batch, not any(s in raw for s in self.special))
        codes, different = words.codes()
        different = different.to_pylist()
        if len(self.known) > MOST_WORDS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = []
        for w in different:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    missing.append(w)
        self._learn(missing)
        found = [known[w] for w in different]
        sizes = np.array([len(x) // 4 for x in found], dtype=np.int64)
        flat = np.frombuffer(b"".join(found), dtype=np.uint32)
        starts = np.cumsum(sizes) - sizes
        per_word = sizes[codes]
        ends = np.cumsum(per_word)
        total = int(ends[-1]) if len(ends) else 0
        shift = starts[codes] - (ends - per_word)
        ids = flat[np.arange(total) + np.repeat(shift, per_word)]
        upto = np.concatenate([[0], ends])[words.bounds]
        return ids, np.diff(upto)


def encoder(path: str) -> Encoder:
    memory = worker_memory("encoders")
    if path not in memory:
        memory[path] = Encoder(path)
    return memory[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after those of each text."""
    out = np.full(len(ids) + len(counts), end, dtype=np.uint32)
    last = np.cumsum(counts + 1) - 1
    keep = np.ones(len(out), dtype=bool)
    keep[last] = False
    out[keep] = ids
    return out, counts + 1


def encoded(
    texts: pa.Array, path: str, end: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids with end ids, and counts, for consecutive slices of the texts."""
    tool = encoder(path)
    for part in slices(texts):
        yield with_end(*tool.encode(part), end)


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of the bytes of ``data`` as an Arrow column."""
    at = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=at[1:])
    wide = at[-1] >= 2**31
    return pa.Array.from_buffers(
        pa.large_binary() if wide else pa.binary(),
        len(sizes),
        [None, pa.py_buffer(at if wide else at.astype(np.int32)), pa.py_buffer(data)],
    )


def token_ids(path: str, end: int):
    """Column function: a text's ids with the end id, as little-endian bytes.

    Ids take two bytes where the vocabulary allows, else four: see ``id_type``.
    """
    kind = id_type(path, end)

    def ids(texts: pa.Array) -> pa.Array:
        out = [
            pa.StructArray.from_arrays(
                [pa.array(n), binaries(x.astype(kind).view(np.uint8), n * kind.itemsize)],
                names=["n", "ids"],
            )
            for x, n in encoded(texts, path, end)
        ]
        empty = pa.array([], pa.struct([("n", pa.int64()), ("ids", pa.binary())]))
        return pa.concat_arrays(out) if out else empty

    return F.arrow_udf(ids, "struct<n:bigint,ids:binary>")


def id_type(path: str, end: int) -> np.dtype:
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(path).get_vocab_size(), end + 1)
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def vocabulary_size(path: str, end: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab_size(), end + 1)
