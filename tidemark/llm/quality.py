"""Quality rules with a line-labelling CRF.

Base counts are exact and cover whole texts. On top, a linear-chain CRF labels each
line content or boilerplate by Viterbi decoding over the lines of a text. A text is
kept if content lines hold at least ``CONTENT_SHARE`` of its words.

The CRF is fitted on at most ``PER_CLASS`` labelled texts of each class, of at most
``LONGEST`` characters: a bounded, documented sample. Lines carry their text's label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crf import Ascent, Lanes, best_labels, marginals, observed_moves
from tidemark.llm.shared import first_of_each, ready, text_key
from tidemark.llm.spans import SPACED_WORD, TextBatch, Words, mixed, slices

PER_CLASS = 600
LONGEST = 20_000
CONTENT_SHARE = 0.5
MIN_WORDS = 50
EPOCHS = 30

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
LOWER_CASE = np.zeros(256, dtype=bool)
LOWER_CASE[97:123] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[33:48] = PUNCTUATION[58:65] = PUNCTUATION[91:97] = PUNCTUATION[123:127] = True
END = np.zeros(256, dtype=bool)
END[[ord(c) for c in ".!?"]] = True

#: Bin edges of a line's figures; each figure becomes one of its bins.
EDGES = {
    "words": [1, 3, 6, 12, 25, 50, 100],
    "word_length": [2, 3, 4, 5, 6, 8, 12],
    "symbols": [0.001, 0.01, 0.03, 0.08, 0.15, 0.3],
    "upper": [0.02, 0.06, 0.15, 0.4, 0.8],
    "digits": [0.001, 0.02, 0.1, 0.3],
    "punctuation": [0.01, 0.03, 0.06, 0.12, 0.25],
    "same_as_before": [0.001, 0.05, 0.2, 0.5, 0.8],
    "other_words": [0.1, 0.3, 0.5, 0.7, 0.9, 0.999],
}
FLAGS = ("ends", "seen", "first", "last")
WIDTH = sum(len(e) + 1 for e in EDGES.values()) + len(FLAGS) + 1
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray


class Lines:
    """Lines of a batch with their words."""

    def __init__(self, batch: TextBatch):
        self.batch = batch
        self.words: Words = batch.words(SPACED_WORD, lower=False)
        breaks = np.flatnonzero(batch.bytes == 10)
        self.starts = np.sort(np.concatenate([batch.offsets[:-1], breaks + 1]), kind="stable")
        self.bounds = np.arange(batch.rows + 1) + np.searchsorted(breaks, batch.offsets)
        self.n = len(self.starts)
        self.row = np.repeat(np.arange(batch.rows), np.diff(self.bounds))
        upto = np.searchsorted(self.words.starts, np.append(self.starts, len(batch.bytes)))
        self.first_word = upto[:-1]
        self.n_words = np.diff(upto)
        self.ends = np.append(self.starts[1:], len(batch.bytes))
        after_break = np.zeros(self.n, dtype=bool)
        if len(breaks):
            after_break[np.searchsorted(self.starts, breaks, side="right") - 1] = True
        self.stops = self.ends - after_break

    def seen_before(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text, byte for byte."""
        raw = self.batch.bytes.tobytes()
        spans = zip(self.starts.tolist(), self.stops.tolist(), strict=True)
        lines = pa.array([raw[a:b] for a, b in spans], pa.binary())
        codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both = self.row * np.int64(self.n + 1) + codes
        _, first = np.unique(both, return_index=True)
        seen = np.ones(self.n, dtype=bool)
        seen[first] = False
        return seen & (self.n_words > 0)

    def per_line(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each line are flagged."""
        upto = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=upto[1:])
        return upto[self.stops] - upto[self.starts]


def repeated_words(words: Words, codes: np.ndarray) -> np.ndarray:
    """Words of each text inside three-word windows that the text holds twice or more."""
    n = len(words)
    out = np.zeros(words.batch.rows, np.int64)
    if n < 3:
        return out
    rows = words.rows()
    at = np.flatnonzero(rows[:-2] == rows[2:])
    if not len(at):
        return out
    c = codes.astype(np.uint64)
    hashes = mixed(mixed(mixed(c[at]) + c[at + 1]) + c[at + 2])
    hashes = mixed(hashes + rows[at].astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    where = at[order]
    near = hashes[order][1:] == hashes[order][:-1]
    a, b = where[1:], where[:-1]
    equal = (rows[a] == rows[b]) & (codes[a] == codes[b])
    equal &= (codes[a + 1] == codes[b + 1]) & (codes[a + 2] == codes[b + 2])
    if np.any(near != equal):  # a hash collision: compare the windows themselves
        order = np.lexsort((codes[at + 2], codes[at + 1], codes[at], rows[at]))
        where = at[order]
        a, b = where[1:], where[:-1]
        near = (rows[a] == rows[b]) & (codes[a] == codes[b])
        near &= (codes[a + 1] == codes[b + 1]) & (codes[a + 2] == codes[b + 2])
    twice = np.zeros(len(where), dtype=bool)
    twice[1:] |= near
    twice[:-1] |= near
    inside = np.zeros(n, dtype=bool)
    for j in range(3):
        inside[where[twice] + j] = True
    upto = np.zeros(n + 1, np.int64)
    np.cumsum(inside, out=upto[1:])
    return upto[words.bounds[1:]] - upto[words.bounds[:-1]]


def base_counts(lines: Lines, codes: np.ndarray, seen: np.ndarray) -> dict[str, np.ndarray]:
    batch, words = lines.batch, lines.words

    def per_text(flags: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=upto[1:])
        return upto[batch.offsets[1:]] - upto[batch.offsets[:-1]]

    points = SPACED_WORD[batch.bytes] & ((batch.bytes & 0xC0) != 0x80)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_text(points),
        "n_symbols": per_text(SYMBOL[batch.bytes]),
        "n_dup_lines": np.bincount(lines.row[seen], minlength=batch.rows).astype(np.int64),
        "n_repeat_words": repeated_words(words, codes),
    }


def line_features(lines: Lines, codes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """One-hot bins and flags of each line."""
    raw, words = lines.batch.bytes, lines.words
    chars = np.maximum(lines.per_line(SPACED_WORD[raw]), 1)
    n_words = lines.n_words
    line = np.repeat(np.arange(lines.n), n_words)
    again = np.zeros(len(words), dtype=bool)
    if len(words) > 1:
        again[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    some = np.maximum(n_words, 1)
    pairs = np.unique(line * np.int64(len(words) + 1) + codes)
    different = np.bincount(pairs // (len(words) + 1), minlength=lines.n)
    letters = np.maximum(lines.per_line(UPPER[raw] | LOWER_CASE[raw]), 1)
    figures = {
        "words": n_words,
        "word_length": chars / some,
        "symbols": lines.per_line(SYMBOL[raw]) / chars,
        "upper": lines.per_line(UPPER[raw]) / letters,
        "digits": lines.per_line(DIGIT[raw]) / chars,
        "punctuation": lines.per_line(PUNCTUATION[raw]) / chars,
        "same_as_before": np.bincount(line[again], minlength=lines.n) / some,
        "other_words": different / some,
    }
    out = np.zeros((lines.n, WIDTH), np.float32)
    at, index = 0, np.arange(lines.n)
    for name, edges in EDGES.items():
        out[index, at + np.digitize(figures[name], edges)] = 1
        at += len(edges) + 1
    last_byte = raw[np.maximum(lines.stops - 1, 0)] if len(raw) else np.zeros(lines.n, np.uint8)
    flags = (
        END[last_byte] & (lines.stops > lines.starts),
        seen,
        np.isin(index, lines.bounds[:-1]),
        np.isin(index, lines.bounds[1:] - 1),
    )
    for flag in flags:
        out[:, at] = flag
        at += 1
    out[:, at] = 1
    return out


def _lanes(lines: Lines) -> Lanes:
    return Lanes.of(lines.bounds[:-1], np.diff(lines.bounds))


def fit(texts: list[str], good: list[int]) -> Model:
    """Learn weights and moves of (boilerplate, content) lines from labelled texts."""
    weights, moves = Ascent((WIDTH, 2), 0.3), Ascent((2, 2), 0.1)
    lines = Lines(TextBatch(pa.array(texts, pa.string())))
    codes, _ = lines.words.codes()
    x = line_features(lines, codes, lines.seen_before()).astype(np.float64)
    truth = np.asarray(good, dtype=np.int64)[lines.row]
    # Texts weigh alike, classes too: a long text must not outweigh many short ones.
    weight = 1.0 / np.diff(lines.bounds)[lines.row]
    totals = np.bincount(truth, weights=weight, minlength=2)
    weight = weight / np.maximum(totals[truth], 1e-9) * len(texts) / 2
    lanes = _lanes(lines)
    for _ in range(EPOCHS):
        found, expected = marginals(x @ weights.value, lanes, moves.value, pairs=True)
        error = -found
        error[np.arange(len(truth)), truth] += 1
        weights.add(x.T @ (error * weight[:, None]), 0.01)
        moves.add((observed_moves(truth, lanes, 2) - expected) / max(len(texts), 1), 0.2)
    return Model(weights.value, moves.value)


def learn(documents: DataFrame, labels: DataFrame, column: str = "quality") -> Model | None:
    """Fit on a bounded sample of the documents that ``labels`` covers, by hash of the id.

    A document with several labels counts with the least. None without labels of
    both classes.
    """
    ready(documents.sparkSession)
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min(column).alias("label"))
    texts = documents.select("doc_id", F.col("text").alias("text")).where(
        (F.length("text") > 0) & (F.length("text") <= LONGEST)
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.when(F.col("label") == 1, min(1.0, 1.5 * PER_CLASS / sizes[1] + 20 / sizes[1])).otherwise(
        min(1.0, 1.5 * PER_CLASS / sizes[0] + 20 / sizes[0])
    )
    chosen = known.where(pick < share * (1 << 30))
    # The labels are about 3 * PER_CLASS rows of two numbers.
    labelled = texts.join(F.broadcast(chosen), "doc_id").select(
        "label", "text", pick.alias("pick"), text_key(F.col("text")).alias("key")
    )
    different = labelled.groupBy("label", "key").agg(
        F.min("pick").alias("pick"), F.min_by("text", "pick").alias("text")
    )
    rows = (
        first_of_each(different, "label", ["pick", "key"], PER_CLASS)
        .toPandas()
        .sort_values(["pick", "key"])
        .drop_duplicates("key")
    )
    if rows["label"].nunique() < 2:
        return None
    return fit(rows["text"].tolist(), rows["label"].tolist())


def judged(texts: pa.Array, model: Model | None) -> pa.StructArray:
    """Base counts and the share of words in content lines for each text."""
    parts = []
    for part in slices(texts):
        lines = Lines(TextBatch(part))
        codes, _ = lines.words.codes()
        seen = lines.seen_before()
        counts = base_counts(lines, codes, seen)
        share = np.ones(lines.batch.rows)
        if model is not None and lines.n:
            scores = line_features(lines, codes, seen) @ model.weights
            label = best_labels(scores, _lanes(lines), model.moves)
            content = np.bincount(lines.row, weights=label * lines.n_words, minlength=lines.batch.rows)
            share = content / np.maximum(counts["n_words"], 1)
        parts.append(
            pa.StructArray.from_arrays(
                [*(pa.array(counts[k]) for k in BASE), pa.array(share)],
                names=[*BASE, "content_share"],
            )
        )
    kinds = pa.struct([*((k, pa.int64()) for k in BASE), ("content_share", pa.float64())])
    return pa.concat_arrays(parts) if parts else pa.array([], kinds)


def assessed(text: Column, model: Model | None, spark) -> Column:
    """Column with the base counts and ``content_share``; null is the empty text.

    Without a model all lines are content.
    """
    shared = spark.sparkContext.broadcast(None if model is None else (model.weights, model.moves))

    def judge(texts: pa.Array) -> pa.Array:
        return judged(texts, shared.value and Model(*shared.value))

    kinds = ",".join(f"{k}:bigint" for k in BASE)
    return F.arrow_udf(judge, f"struct<{kinds},content_share:double>")(text)


def base_failed() -> Column:
    """Too short, or mostly repetition."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
