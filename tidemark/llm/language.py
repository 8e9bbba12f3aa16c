"""Language of texts by a linear-chain CRF that labels their words.

A word's scores come from its affixes, its inner n-grams and itself (a lexicon
entry), hashed into one weight table; moves between the languages of neighbouring
words are learned with them. Forward-backward gives each word its probabilities,
also where a text switches languages, and a text gets the language of most of its
words. Chains are sentences, cut after ``CHAIN`` words; every word is in one.

The model is fitted on at most ``PER_LANGUAGE`` texts of each language, of at most
``LONGEST`` characters: a bounded, documented sample. All else covers whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crf import Ascent, Lanes, marginals, observed_moves
from tidemark.llm.shared import first_of_each, ready, text_key
from tidemark.llm.spans import GOLDEN, TextBatch, Words, mixed, powers, slices

PER_LANGUAGE = 300
LONGEST = 20_000
CHAIN = 64
BUCKETS = 1 << 18
EPOCHS = 3
BATCH_WORDS = 20_000

#: Languages nobody can tell: the text is null or has no letter.
NONE = "und"

LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
STOP = np.zeros(257, dtype=bool)
STOP[[10, 33, 46, 63, 256]] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' features and the word of each, word by word."""
    n = len(words)
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1]
    chars = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if n else np.zeros(0, np.uint8)
    at = at.astype(np.int64) - (at[0] if n else 0)
    lengths = np.diff(at)
    word = np.repeat(np.arange(n), lengths)
    left = np.repeat(at[1:], lengths) - np.arange(len(chars))  # bytes to the word's end
    place = np.arange(len(chars)) - np.repeat(at[:-1], lengths)
    gram = np.zeros(len(chars), np.uint64)
    buckets, owners = [], []

    def add(kind: int, where: np.ndarray) -> None:
        values = mixed(gram[where] * np.uint64(64) + np.uint64(kind))
        buckets.append((values & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(word[where])

    for size in range(1, 5):
        shifted = np.zeros(len(chars), np.uint64)
        shifted[: max(len(chars) - size + 1, 0)] = chars[size - 1 :]
        gram = gram * np.uint64(257) + shifted + np.uint64(1)
        fits = left >= size
        add(size, np.flatnonzero(fits & (place == 0)))
        add(8 + size, np.flatnonzero(left == size))
        if size > 1:
            add(16 + size, np.flatnonzero(fits))
    if len(chars):
        full = np.flatnonzero(lengths)
        terms = (chars.astype(np.uint64) + np.uint64(1)) * powers(257, int(lengths.max()))[place]
        values = mixed(np.add.reduceat(terms, at[:-1][full]) * GOLDEN + np.uint64(63))
        buckets.append((values & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(full)
    return np.concatenate(buckets), np.concatenate(owners)


def word_scores(words: pa.Array, weights: np.ndarray) -> np.ndarray:
    buckets, owners = features(words)
    columns = [
        np.bincount(owners, weights=weights[buckets, k], minlength=len(words))
        for k in range(weights.shape[1])
    ]
    return np.stack(columns, axis=1) if columns else np.zeros((len(words), 0))


def chains(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the sentences, of at most ``CHAIN`` words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    following = np.append(words.batch.bytes, 0).astype(np.int64)[words.ends]
    opens = np.zeros(n + 1, dtype=bool)
    opens[1:] = STOP[following]
    opens[words.bounds] = True
    opens = opens[:n]
    start = np.flatnonzero(opens)
    place = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    start = np.flatnonzero(place % CHAIN == 0)
    return start, np.diff(np.append(start, n))


def _letters(texts: pa.Array) -> tuple[TextBatch, Words]:
    lowered = pc.utf8_lower(texts.fill_null("") if texts.null_count else texts)
    batch = TextBatch(lowered)
    return batch, batch.words(LETTERS, lower=False)


def fit(texts: list[str], languages: list[str]) -> Model:
    """Learn weights and moves; a text's words all carry its language."""
    names = sorted(set(languages))
    n = len(names)
    weights, moves = Ascent((BUCKETS, n), 0.3), Ascent((n, n), 0.3)
    label = np.array([names.index(x) for x in languages])
    order = np.random.default_rng(7).permutation(len(texts))
    groups, size = [[]], 0
    for i in order:
        groups[-1].append(i)
        size += len(texts[i]) // 6
        if size > BATCH_WORDS:
            groups.append([])
            size = 0
    for _ in range(EPOCHS):
        for group in groups:
            if not group:
                continue
            _, words = _letters(pa.array([texts[i] for i in group], pa.string()))
            if not len(words):
                continue
            truth = label[group][words.rows()]
            codes, different = words.codes()
            buckets, owners = features(different)
            scores = np.stack(
                [
                    np.bincount(owners, weights=weights.value[buckets, k], minlength=len(different))
                    for k in range(n)
                ],
                axis=1,
            )
            lanes = Lanes.of(*chains(words))
            found, expected = marginals(scores[codes], lanes, moves.value, pairs=True)
            error = -found
            error[np.arange(len(truth)), truth] += 1
            for_word = np.stack(
                [np.bincount(codes, weights=error[:, k], minlength=len(different)) for k in range(n)],
                axis=1,
            )
            gradient = np.stack(
                [np.bincount(buckets, weights=for_word[owners, k], minlength=BUCKETS) for k in range(n)],
                axis=1,
            )
            weights.add(gradient, 1e-4)
            # Every text has one language here, so moves need a stronger pull to zero.
            moves.add(observed_moves(truth, lanes, n) - expected, 1.0)
    return Model(names, weights.value.astype(np.float32), moves.value)


def learn(
    documents: DataFrame, text: str = "text", language: str = "lang", where: Column | None = None
) -> Model | None:
    """Fit on a bounded sample of the rows ``where`` holds; None if there are none.

    The sample takes rows by the hash of id and text, the same share of a language's
    rows wherever they lie, and keeps the ``PER_LANGUAGE`` least hashes.
    """
    ready(documents.sparkSession)
    known = documents.where(
        F.col(language).isNotNull() & (F.length(text) <= LONGEST) & (F.length(text) > 0)
    )
    if where is not None:
        known = known.where(where)
    sizes = {r[0]: r[1] for r in known.groupBy(language).count().collect()}
    if not sizes:
        return None
    pick = F.pmod(F.xxhash64("doc_id", text_key(F.col(text))), F.lit(1 << 30))
    share = F.lit(1.0)
    for name, n in sizes.items():
        wanted = min(1.0, 1.3 * PER_LANGUAGE / n + 20 / n)
        share = F.when(F.col(language) == name, wanted).otherwise(share)
    chosen = known.select(
        pick.alias("pick"),
        F.col(language).alias("language"),
        F.col(text).alias("text"),
        text_key(F.col(text)).alias("key"),
    ).where(F.col("pick") < share * (1 << 30))
    rows = (
        first_of_each(chosen, "language", ["pick", "key"], PER_LANGUAGE)
        .toPandas()
        .sort_values(["pick", "language", "text"])
    )
    return fit(rows["text"].tolist(), rows["language"].tolist())


def predict(texts: pa.Array, model: Model) -> pa.StructArray:
    """Language and share of the words for each text."""
    n = len(model.languages)
    names, shares = [], []
    for part in slices(texts):
        batch, words = _letters(part)
        codes, different = words.codes()
        scores = word_scores(different, model.weights)
        found, _ = marginals(scores[codes], Lanes.of(*chains(words)), model.moves)
        sums = np.zeros((batch.rows, n))
        some = np.flatnonzero(words.counts)
        if len(some):
            sums[some] = np.add.reduceat(found, words.bounds[:-1][some], axis=0)
        best = sums.argmax(axis=1)
        share = sums.max(axis=1) / np.maximum(words.counts, 1)
        plain = np.zeros(batch.rows, dtype=bool)
        ascii_words = np.flatnonzero(batch.bytes[words.starts] < 128)
        plain[words.rows()[ascii_words]] = True
        for row in np.flatnonzero(~plain):
            if any(c.isalpha() for c in part[int(row)].as_py() or ""):
                plain[row] = True
        labels = np.array([*model.languages, NONE], dtype=object)
        names.append(labels[np.where(plain, best, n)])
        shares.append(np.where(plain, np.clip(share, 0, 1), 0.0))
    names = np.concatenate(names) if names else np.zeros(0, dtype=object)
    shares = np.concatenate(shares) if shares else np.zeros(0)
    return pa.StructArray.from_arrays(
        [pa.array(names.tolist(), pa.string()), pa.array(shares)], names=["lang_pred", "score"]
    )


def identified(text: Column, model: Model | None, spark) -> Column:
    """Column ``struct<lang_pred, score>``; without a model every text is ``und``."""
    if model is None:
        return F.struct(F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((model.languages, model.weights, model.moves))

    def label(texts: pa.Array) -> pa.Array:
        return predict(texts, Model(*shared.value))

    return F.arrow_udf(label, "struct<lang_pred:string,score:double>")(text)
