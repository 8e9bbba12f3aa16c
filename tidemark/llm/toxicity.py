"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words sums over the subsequences of three and four characters
that both have, with at most ``GAPS`` characters between; each character between
takes a part of a subsequence's weight. Words lose their signs first (``i-d-i-o-t``), and
runs of single letters are one word. Landmarks are insults found in the training texts;
on the Nyström map of the words' kernel values to them, an SVM parts the words that make
a sentence toxic from those of clean sentences.

What is scored are the words of a text and runs of two to ``MOST_JOINED`` neighbouring
words without the spaces (``id iot``), where the words meet as inside a landmark. A word on
the toxic side also scores as what is left of it without up to ``INSERTED`` of its inner
characters (``idxiot``). A sentence scores as its worst word or run, a text by its worst
sentence and how many words and runs are on the toxic side.

Learned from labelled texts only: from at most ``PER_CLASS`` of each class, of at most
``LONGEST`` characters. The label of a text is passed to its sentences: all sentences
of a clean text are clean, those of a toxic text are toxic if they hold a word with a
piece that toxic texts have far more often, and unlabelled otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import first_of_each, ready, text_key
from tidemark.llm.spans import PLAIN_WORD, SPACED_WORD, TextBatch, gram_hashes, mixed, slices

PER_CLASS = 1500
LONGEST = 20_000
LANDMARKS = 160
NEGATIVES = 30_000
GAPS = 2
DECAY = 0.7
LEAST = -3.0
#: Characters that may have been put into a word, and what each takes from its score.
INSERTED = 2
INSERTED_COST = 0.3
#: Neighbouring units that may together be one word.
MOST_JOINED = 4
#: Log-likelihood ratio from which a word or piece tells toxic texts from clean ones.
TELLING = 20.0

#: Offsets of a subsequence's characters after the first, and its weight.
PATTERNS = [
    (offsets, DECAY ** (offsets[-1] + 1 - size))
    for size in (3, 4)
    for offsets in combinations(range(1, size + GAPS), size - 1)
]


@dataclass
class Model:
    features: np.ndarray  # hashes of the landmarks' subsequences, sorted
    weights: np.ndarray  # the SVM's weight of each
    bias: float
    calibration: np.ndarray  # weights of ``text_features``
    near: np.ndarray  # by ``_trigrams``: runs of three bytes that landmarks have
    longest: int  # bytes of the longest landmark


class Units:
    """Words of texts, without signs and with runs of single letters joined."""

    def __init__(self, texts: pa.Array):
        lowered = pc.utf8_lower(texts.fill_null("") if texts.null_count else texts)
        self.batch = TextBatch(lowered)
        words = self.batch.words(SPACED_WORD, lower=False)
        kept = PLAIN_WORD[words.chars]
        upto = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(kept, out=upto[1:])
        at = words.char_starts()
        sizes = upto[at[1:]] - upto[at[:-1]]
        full = np.flatnonzero(sizes)
        rows, sizes = words.rows()[full], sizes[full]
        joined = np.zeros(len(full), dtype=bool)
        joined[1:] = (sizes[1:] == 1) & (sizes[:-1] == 1) & (rows[1:] == rows[:-1])
        first = np.flatnonzero(~joined)
        ends = np.append(first[1:], len(full))
        total = np.concatenate([[0], np.cumsum(sizes)])
        self.offsets = np.append(total[first], total[-1])
        self.chars = words.chars[kept]
        self.rows = rows[first]
        self.counts = np.bincount(self.rows, minlength=self.batch.rows)
        #: Where a unit's last word ends in the text, to find the sentence's end.
        self.stops = words.ends[full[ends - 1]] if len(first) else first

    def __len__(self) -> int:
        return len(self.rows)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        coded = pa.Array.from_buffers(
            pa.binary(),
            len(self),
            [None, pa.py_buffer(self.offsets.astype(np.int32)), pa.py_buffer(self.chars)],
        ).dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def windows(self, near: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of two to ``MOST_JOINED`` neighbouring units that may hide a landmark.

        Where two units meet, the runs of three bytes over the border must be a landmark's,
        and all units together not be longer than the longest one by more than a byte.
        Returns the first unit, the last one and the number of bytes of each run.
        """
        sizes = np.diff(self.offsets)
        border = self.offsets[1:-1]
        same = self.rows[1:] == self.rows[:-1]
        known = np.append(near[_trigrams(self.chars)], [False, False]) if len(self.chars) > 2 else None
        if known is None or not len(border):
            none = np.zeros(0, np.int64)
            return none, none, none
        before = (sizes[:-1] < 2) | known[border - 2]
        after = (sizes[1:] < 2) | known[border - 1]
        meets = same & before & after
        firsts, lasts = [], []
        fits = meets.copy()
        for units in range(2, MOST_JOINED + 1):
            at = np.flatnonzero(fits)
            at = at[self.offsets[at + units] - self.offsets[at] <= longest + 1]
            firsts.append(at)
            lasts.append(at + units - 1)
            fits = fits[:-1] & meets[units - 1 :]
        first, last = np.concatenate(firsts), np.concatenate(lasts)
        return first, last, self.offsets[last + 1] - self.offsets[first]

    def joined(self, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes of runs of units as words: spaces between them are dropped."""
        ends = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=ends[1:])
        at = np.repeat(self.offsets[first] - ends[:-1], sizes) + np.arange(ends[-1])
        return pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(self.chars[at])]
        )

    def sentences(self) -> np.ndarray:
        """A number for each unit's sentence."""
        raw = np.append(self.batch.bytes, 10)
        ends = np.zeros(len(self), dtype=bool)
        for back in (0, 1):
            ends |= np.isin(raw[np.maximum(self.stops - back, 0)], (10, 33, 46, 63))
        opens = np.zeros(len(self), dtype=np.int64)
        opens[1:] = ends[:-1] | (self.rows[1:] != self.rows[:-1])
        return np.cumsum(opens)


def _trigrams(chars: np.ndarray) -> np.ndarray:
    """A number below ``1 << 16`` for each run of three bytes."""
    c = chars.astype(np.int64)
    return (c[:-2] * 7919 + c[1:-1] * 263 + c[2:]) & 0xFFFF


def points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words between a start mark 1 and an end mark 2, and the word of each."""
    joined = b"\x02\x01".join(words.to_pylist())
    chars = (b"\x01" + joined + b"\x02").decode("utf-8", "replace")
    out = np.frombuffer(chars.encode("utf-32-le"), np.uint32).astype(np.uint64)
    return out, np.cumsum(out == 1) - 1


def subsequences(words: pa.Array):
    """For each pattern: hashes of the subsequences, the words they are in, their weight."""
    chars, owner = points(words)
    for number, (offsets, weight) in enumerate(PATTERNS):
        reach = len(chars) - offsets[-1]
        if reach <= 0:
            continue
        where = np.flatnonzero(owner[:reach] == owner[offsets[-1] :])
        h = chars[where]
        for o in offsets:
            h = h * np.uint64(0x100000001B3) + chars[where + o]
        yield mixed(h * np.uint64(8) + np.uint64(len(offsets))), owner[where], weight


def _norms(words: pa.Array) -> np.ndarray:
    """A word's length in the kernel's space if none of its subsequences repeats."""
    out = np.zeros(len(words))
    for _, owner, weight in subsequences(words):
        out += np.bincount(owner, minlength=len(words)) * weight**2
    return np.sqrt(np.maximum(out, 1e-12))


class Landmarks:
    def __init__(self, words: pa.Array):
        parts = list(subsequences(words))
        hashes = np.concatenate([h for h, _, _ in parts])
        self.features, index = np.unique(hashes, return_inverse=True)
        self.table = np.zeros((len(self.features), len(words)))
        owners = np.concatenate([o for _, o, _ in parts])
        weights = np.concatenate([np.full(len(h), w) for h, _, w in parts])
        np.add.at(self.table, (index, owners), weights)
        self.table /= _norms(words)
        self.lookup = Lookup(self.features)

    def kernel(self, words: pa.Array) -> np.ndarray:
        parts = [self._kernel(words.slice(at, 2000)) for at in range(0, len(words), 2000)]
        return np.concatenate(parts)

    def _kernel(self, words: pa.Array) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]))
        for h, owner, weight in subsequences(words):
            hit, feature = self.lookup.find(h)
            np.add.at(out, owner[hit], weight * self.table[feature])
        return out / _norms(words)[:, None]


class Lookup:
    """Places of hashes in a sorted array; a bitmap sorts most misses out first."""

    BITS = 1 << 20

    def __init__(self, features: np.ndarray):
        self.features = features
        self.bitmap = np.zeros(self.BITS, dtype=bool)
        self.bitmap[(features & np.uint64(self.BITS - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hit = np.flatnonzero(self.bitmap[(hashes & np.uint64(self.BITS - 1)).astype(np.int64)])
        at = np.searchsorted(self.features, hashes[hit])
        at = np.minimum(at, len(self.features) - 1)
        right = self.features[at] == hashes[hit]
        return hit[right], at[right]


def word_scores(words: pa.Array, model: Model, lookup: Lookup) -> np.ndarray:
    """The SVM's value for each word: its kernel values with the landmarks, weighted."""
    sums, norms = np.zeros(len(words)), np.zeros(len(words))
    if len(words):
        for h, owner, weight in subsequences(words):
            hit, feature = lookup.find(h)
            sums += np.bincount(owner[hit], model.weights[feature] * weight, len(words))
            norms += np.bincount(owner, minlength=len(words)) * weight**2
    return sums / np.sqrt(np.maximum(norms, 1e-12)) + model.bias


def best_scores(words: pa.Array, model: Model, lookup: Lookup) -> np.ndarray:
    """``word_scores``, or more where a word without some inner characters scores higher.

    An inserted character breaks many subsequences at once, and the whole word's length
    in the kernel's space grows. So from a word on the toxic side, the subsequence that
    leaves out one character and scores best is taken as a word of its own, and again
    from there, up to ``INSERTED`` characters, each at the cost of ``INSERTED_COST``.
    """
    out = word_scores(words, model, lookup)
    near = np.flatnonzero(out > 0).tolist()
    held = {i: words[i].as_py().decode("utf-8", "replace") for i in near}
    for lost in range(1, INSERTED + 1):
        held = {i: w for i, w in held.items() if 5 <= len(w) <= model.longest + INSERTED + 1 - lost}
        shorter = [(i, w[:at] + w[at + 1 :]) for i, w in held.items() for at in range(1, len(w) - 1)]
        if not shorter:
            break
        found = word_scores(pa.array([w.encode() for _, w in shorter], pa.binary()), model, lookup)
        own = np.array([i for i, _ in shorter])
        first = np.flatnonzero(np.diff(own, prepend=-1))
        best = np.maximum.reduceat(found, first)
        out[own[first]] = np.maximum(out[own[first]], best - INSERTED_COST * lost)
        order = np.lexsort((-found, own))
        held = {int(own[i]): shorter[i][1] for i in order[first].tolist()}
    return out


def text_features(texts: pa.Array, model: Model, lookup: Lookup) -> np.ndarray:
    """1, the worst score of a word or run, the number and share of toxic ones (as logs).

    A null or empty text, or one of signs only, has no words: its worst score is ``LEAST``.
    """
    out = []
    for part in slices(texts):
        units = Units(part)
        worst = np.full(units.batch.rows, LEAST)
        toxic = np.zeros(units.batch.rows)
        if len(units):
            codes, different = units.codes()
            scores = best_scores(different, model, lookup)[codes]
            some = np.flatnonzero(units.counts)
            starts = (np.cumsum(units.counts) - units.counts)[some]
            worst[some] = np.maximum(np.maximum.reduceat(scores, starts), LEAST)
            toxic[some] = np.add.reduceat((scores > 0).astype(np.float64), starts)
            first, last, sizes = units.windows(model.near, model.longest)
            if len(first):
                coded = units.joined(first, sizes).dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                found = best_scores(coded.dictionary, model, lookup)[codes]
                np.maximum.at(worst, units.rows[first], found)
                # A run counts if it is toxic and none of its units is by itself.
                upto = np.concatenate([[0], np.cumsum(scores > 0)])
                alone = (found > 0) & (upto[last + 1] == upto[first])
                toxic += np.bincount(units.rows[first[alone]], minlength=len(toxic))
        share = np.log((toxic + 0.1) / (units.counts + 50))
        out.append(np.stack([np.ones(len(worst)), worst, np.log1p(toxic), share], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 4))


def _pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' runs of four to eight characters, marks included."""
    chars, owner = points(words)
    hashes, owners = [], []
    for size in range(4, 9):
        if len(chars) < size:
            continue
        where = np.flatnonzero(owner[: len(chars) - size + 1] == owner[size - 1 :])
        h = chars[where]
        for o in range(1, size):
            h = h * np.uint64(0x100000001B3) + chars[where + o]
        hashes.append(mixed(h * np.uint64(8) + np.uint64(size)))
        owners.append(owner[where])
    return np.concatenate(hashes), np.concatenate(owners)


def _tells(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> np.ndarray:
    """Where ``bad`` of the toxic and ``good`` of the clean texts is far from chance."""
    both = (bad + good) / (n_bad + n_good)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (bad * np.log(bad / (both * n_bad)) + np.nan_to_num(good * np.log(good / (both * n_good))))
    return (g >= TELLING) & (good / n_good <= 0.1 * bad / n_bad)


def suspicious(codes: np.ndarray, rows: np.ndarray, words: pa.Array, toxic: np.ndarray):
    """Groups of words: those that share a telling piece, and single telling words.

    Pieces are taken by how many toxic texts not yet explained they explain.
    """
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    pairs = np.unique(rows * np.int64(len(words)) + codes)
    pair_row, pair_word = pairs // len(words), pairs % len(words)
    hashes, owners = _pieces(words)
    pieces, piece = np.unique(hashes, return_inverse=True)
    order = np.argsort(owners, kind="stable")
    piece, owners = piece[order], owners[order]
    first = np.searchsorted(owners, np.arange(len(words) + 1))

    def in_texts(of_toxic: bool, allowed: np.ndarray | None):
        """(piece, text) pairs, each once, for some hundred texts at a time."""
        use = np.flatnonzero(toxic[pair_row] == of_toxic)
        ends = np.flatnonzero(np.diff(pair_row[use])) + 1
        for some in np.split(use, ends[::200]):
            sizes = (first[1:] - first[:-1])[pair_word[some]]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found = piece[at + np.repeat(first[pair_word[some]], sizes)]
            texts = np.repeat(pair_row[some], sizes)
            if allowed is not None:
                keep = allowed[found]
                found, texts = found[keep], texts[keep]
            both = np.unique(found * np.int64(len(toxic)) + texts)
            yield both // len(toxic), both % len(toxic)

    def counted(of_toxic: bool, allowed: np.ndarray | None) -> np.ndarray:
        out = np.zeros(len(pieces), np.int64)
        for found, _ in in_texts(of_toxic, allowed):
            out += np.bincount(found, minlength=len(pieces))
        return out

    bad_count = counted(True, None)
    good_count = counted(False, bad_count >= 3)
    telling = (bad_count >= 3) & _tells(bad_count, good_count, n_toxic, n_clean)
    bad_piece, bad_text = (np.concatenate(x) for x in zip(*in_texts(True, telling), strict=True))
    open_texts = toxic.copy()
    taken = []
    while len(taken) < LANDMARKS:
        gain = np.bincount(bad_piece[open_texts[bad_text]], minlength=len(pieces)).astype(float)
        gain -= 20 * good_count / n_clean * n_toxic  # what clean texts have explains little
        gain += 1e-3 * bad_count
        best = int(gain.argmax())
        if gain[best] < 1 or best in taken:
            break
        taken.append(best)
        open_texts[bad_text[bad_piece == best]] = False
    of_toxic = toxic[pair_row]
    word_bad = np.bincount(pair_word[of_toxic], minlength=len(words))
    word_good = np.bincount(pair_word[~of_toxic], minlength=len(words))
    alone = np.flatnonzero((word_bad >= 3) & _tells(word_bad, word_good, n_toxic, n_clean))
    alone = alone[np.argsort(-word_bad[alone], kind="stable")]
    return [np.unique(owners[piece == p]) for p in taken] + [np.array([w]) for w in alone]


def unlike(texts: list[str], labels: list[int]) -> list[int]:
    """Places of the texts without near copies of an earlier one of the same label.

    Two texts count as near copies if one of four least hashes of their three-word
    runs agrees: a copied text must not make its rare words look telling.
    """
    words = TextBatch(pa.array(texts, pa.string())).words(SPACED_WORD, lower=True)
    grams = gram_hashes(words.hashes(), 3)
    seen: set[tuple] = set()
    out = []
    for i, label in enumerate(labels):
        own = grams[words.bounds[i] : max(words.bounds[i + 1] - 2, words.bounds[i])]
        least = {(label, k, int(mixed(own + np.uint64(k)).min())) for k in range(4)} if len(own) else set()
        if not least & seen:
            out.append(i)
        seen |= least
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2):
    """Squared-hinge linear SVM by Newton steps; returns weights and bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    damp = np.full(x.shape[1], ridge * weight.sum() / len(x))
    damp[-1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, wa = x[active], weight[active]
        new = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(damp), xa.T @ (wa * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], w[-1]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    damp = np.full(x.shape[1], ridge)
    damp[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(damp)
        step = np.linalg.solve(h, x.T @ (y - p) - damp * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def disguised(words: pa.Array) -> list[bytes]:
    """Each word of five letters or more with a letter put in, taken out and doubled."""
    random = np.random.default_rng(7)
    out = []
    for word in (w.decode("utf-8", "replace") for w in words.to_pylist()):
        if len(word) >= 5:
            at = int(random.integers(1, len(word) - 1))
            letter = chr(97 + int(random.integers(26)))
            forms = (word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[: at + 1] + word[at:])
            out += [f.encode() for f in forms]
    return out


def fit(texts: list[str], labels: list[int], odds: float | None = None) -> Model | None:
    """Learn from texts labelled 1 (toxic) or 0. ``odds`` are those of a toxic text.

    None if nothing tells the two apart.
    """
    kept = unlike(texts, labels)
    texts, labels = [texts[i] for i in kept], [labels[i] for i in kept]
    toxic = np.asarray(labels, dtype=bool)
    units = Units(pa.array(texts, pa.string()))
    if not len(units) or not toxic.any() or toxic.all():
        return None
    codes, words = units.codes()
    families = suspicious(codes, units.rows, words, toxic)
    if not families:
        return None
    in_toxic = np.bincount(codes[toxic[units.rows]], minlength=len(words))
    in_clean = np.bincount(codes[~toxic[units.rows]], minlength=len(words))
    chosen: list[int] = []
    share = max(LANDMARKS // len(families), 1)
    for family in families:
        best = family[np.argsort(-in_toxic[family], kind="stable")][:share]
        chosen += [int(w) for w in best if w not in chosen]
    landmarks = Landmarks(words.take(pa.array(chosen[:LANDMARKS])))
    members = np.unique(np.concatenate(families))
    guilty = np.zeros(len(words), dtype=bool)
    guilty[members] = True
    # Sentences: toxic ones give the words that make them so, clean ones all of theirs.
    sentence = units.sentences()
    bad = np.unique(sentence[guilty[codes] & toxic[units.rows]])
    positive = np.unique(codes[np.isin(sentence, bad) & guilty[codes]])
    clean = np.unique(codes[~toxic[units.rows]])
    order = np.random.default_rng(7).permutation(len(clean))
    negative = clean[np.sort(order[:NEGATIVES])]
    forms = disguised(words.take(pa.array(chosen[:LANDMARKS])))
    own = words.take(pa.array(np.concatenate([positive, negative]))).to_pylist()
    x = landmarks.kernel(pa.array(own + forms, pa.binary()))
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative)), np.ones(len(forms))])
    known, made = np.log1p(in_toxic[positive]), np.ones(len(forms))
    n = np.concatenate([known, np.log1p(in_clean[negative]), made * 0.03 * known.sum() / max(len(forms), 1)])
    n[y > 0] *= n[y < 0].sum() / n[y > 0].sum()
    values, vectors = np.linalg.eigh(landmarks.kernel(words.take(pa.array(chosen[:LANDMARKS]))))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good]) @ vectors[:, good].T
    w, bias = _svm(x @ root, y, n / n.mean())
    insults = [w.as_py() for w in words.take(pa.array(chosen[:LANDMARKS]))]
    near = np.zeros(1 << 16, dtype=bool)
    for insult in insults:
        if len(insult) > 2:
            near[_trigrams(np.frombuffer(insult, np.uint8))] = True
    longest = max(map(len, insults))
    weights = landmarks.table @ (root @ w)
    model = Model(landmarks.features, weights, float(bias), np.zeros(4), near, longest)
    found = text_features(pa.array(texts, pa.string()), model, landmarks.lookup)
    model.calibration = _logistic(found, toxic.astype(float))
    if odds is not None:
        model.calibration[0] += np.log(odds) - np.log(toxic.sum() / (~toxic).sum())
    return model


def learn(
    documents: DataFrame, labels: DataFrame, column: str = "toxic", where: Column | None = None
) -> Model | None:
    """Fit on a bounded sample, by hash of the id, of labelled documents ``where`` holds.

    A document with several labels counts with the greatest. None without both classes.
    """
    ready(documents.sparkSession)
    known = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.groupBy("doc_id").agg(F.max(column).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.when(
        F.col("label") == 1, min(1.0, 1.3 * PER_CLASS / sizes[1] + 20 / sizes[1])
    ).otherwise(min(1.0, 1.3 * PER_CLASS / sizes[0] + 20 / sizes[0]))
    chosen = known.where(pick < share * (1 << 30))
    texts = documents.select("doc_id", "text").where(
        (F.length("text") > 0) & (F.length("text") <= LONGEST)
    )
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
    )
    return fit(rows["text"].tolist(), rows["label"].tolist(), sizes[1] / sizes[0])


def scored(text: Column, model: Model | None, spark) -> Column:
    """Column with the probability of label 1; without a model 0 for every text.

    Null and empty texts score alike, as texts without words; repeated rows score alike.
    """
    if model is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast(
        (model.features, model.weights, model.bias, model.calibration, model.near, model.longest)
    )

    def score(texts: pa.Array) -> pa.Array:
        model = Model(*shared.value)
        x = text_features(texts, model, Lookup(model.features))
        return pa.array(1 / (1 + np.exp(-np.clip(x @ model.calibration, -30, 30))))

    return F.arrow_udf(score, "double")(text)
