"""Phrase collocations by dynamic itemset counting.

Texts are dealt into shards that are read in a cycle, one per step. Counting starts
with the words. As soon as both parts of a longer phrase (without its last and without
its first word) have reached the threshold, that phrase is counted from the next step
on, over one full cycle, so lengths overlap within a pass instead of taking one pass
each. A phrase that is frequent in the end has frequent parts and so is always
activated, and as it is counted over each shard once its count is exact.

Workers learn what has been reached from a table of one byte for each hash slot: the
step at which the first phrase of that slot reached the threshold. Its size is fixed. A
slot that several phrases share activates some phrases early; that costs counting, and
changes no count, as a phrase's first step depends on the slots of its parts alone.
Only words and active phrases leave a worker, as counts over a block of text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import ready, settle, text_of
from tidemark.llm.spans import TextBatch, text_offsets
from tidemark.session import scratch_path

AT_LEAST = 10
LONGEST = 3
SHARDS = 2
NO_LANGUAGE = "und"
#: Slots of the table of reached phrases, for each length: its bytes.
SLOTS = 1 << 24
#: Texts are counted in blocks of this many bytes.
BLOCK = 6 << 20
NEVER = 255

#: Bytes that end a piece, and bytes of words ``[^\x20\x09]+`` within pieces.
BORDER = np.zeros(256, dtype=bool)
BORDER[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
WORD = ~BORDER
WORD[[32, 9]] = False

#: A count's key: phrase, language and the step at which its cycle starts, between tabs,
#: which no word holds. One string takes less room in a shuffle than columns do. The empty
#: phrase stands for all word occurrences of a language.
COUNTS = "key string, n long"
SHARDED = "lang string, text string, shard int"


@dataclass
class Reached:
    """By length and hash slot, the step at which the threshold was reached."""

    slots: int = SLOTS
    steps: dict[int, np.ndarray] = field(default_factory=dict)

    def note(self, size: int, at: np.ndarray, step: int) -> None:
        table = self.steps.setdefault(size, np.full(self.slots, NEVER, np.uint8))
        table[at & (table == NEVER)] = step

    def packed(self) -> dict[int, bytes]:
        """The tables for the workers: at most ``slots`` bytes a length."""
        return {size: zlib.compress(t, 1) for size, t in self.steps.items()}

    def last(self) -> int:
        """The last step at which a slot was reached, -1 if none was."""
        known = [t[t != NEVER] for t in self.steps.values()]
        return max((int(t.max()) for t in known if len(t)), default=-1)


def _folded(before: Column, word: Column) -> Column:
    return F.shiftrightunsigned(before, 20).bitwiseXOR(word)


def slot(lang: str, words: str, slots: int = SLOTS) -> Column:
    """The hash slot of a phrase: its word hashes, folded."""
    one = F.lit(0).cast("long")
    every = F.aggregate(words, one, lambda h, w: _folded(h, F.xxhash64(F.col(lang), w)))
    return every.bitwiseAND(F.lit(slots - 1))


def _read(counted: DataFrame) -> DataFrame:
    """Counts with their keys in parts: ``lang, size, phrase, words, n, start``."""
    phrase = F.substring_index("key", "\t", 1)
    last = F.length(F.substring_index("key", "\t", -1))
    size = F.length("key") - F.length(phrase) - last - 2
    lang = F.substr("key", F.length(phrase) + 2, size)
    rows = counted.select(phrase.alias("phrase"), lang.alias("lang"), _start().alias("start"), "n")
    return rows.withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words"))


def _start() -> Column:
    return F.substring_index("key", "\t", -1).cast("int")


def _cut(texts: pa.Array, langs: np.ndarray, most: int) -> tuple[pa.Array, np.ndarray]:
    """Texts longer than ``most`` bytes in parts that end with a piece."""
    offsets = text_offsets(texts)
    if not len(texts) or np.diff(offsets).max() <= most:
        return texts, langs
    raw = np.frombuffer(texts.buffers()[2], np.uint8)
    cuts, rows = [], []
    for row in range(len(texts)):
        at, end = offsets[row], offsets[row + 1]
        ends = at + np.flatnonzero(BORDER[raw[at:end]]) + 1 if end - at > most else [end]
        while True:
            cuts.append(at)
            rows.append(row)
            if end - at <= most:
                break
            i = np.searchsorted(ends, at + most, side="right")
            following = ends[i - 1] if i and ends[i - 1] > at else ends[i] if i < len(ends) else end
            if following >= end:
                break
            at = following
    at = np.array([*cuts, offsets[-1]], dtype=np.int64)
    out = pa.Array.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(at), texts.buffers()[2]]
    )
    return out, langs[rows]


def _encoded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number of 32 bits for each key, and the different keys by number."""
    coded = pa.array(keys).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy()


class _Block:
    """Counts over some texts."""

    def __init__(self, texts: pa.Array, langs: np.ndarray, names: list[str]):
        batch = TextBatch(texts)
        words = batch.words(WORD, lower=True)
        self.n = len(words)
        if not self.n:
            return
        codes, different = words.codes()
        rows = words.rows()
        #: Words that the next one follows within the piece.
        self.joined = rows[1:] == rows[:-1]
        pieces = np.searchsorted(np.flatnonzero(BORDER[batch.bytes]), words.starts)
        self.joined &= pieces[1:] == pieces[:-1]
        del pieces, words  # a block's arrays are the memory of a worker
        codes += langs[rows] * len(different)
        del rows
        self.ids, keys = _encoded(codes)
        self.langs, which = np.divmod(keys, len(different))
        self.names = names
        self.words = different.take(pa.array(which))
        seeds = [xxhash.xxh64_intdigest(name, 42) for name in names]
        self.hashes = np.array(
            [
                xxhash.xxh64_intdigest(w, seeds[lang])
                for w, lang in zip(self.words.to_pylist(), self.langs.tolist(), strict=True)
            ],
            dtype=np.uint64,
        )

    def counted(self, ids: np.ndarray, parts: list[np.ndarray], start: np.ndarray) -> pa.RecordBatch:
        """Counts of phrases: ``ids`` numbers them, ``parts`` are their words."""
        first = np.full(int(ids.max()) + 1 if len(ids) else 0, -1, dtype=np.int32)
        first[ids[::-1]] = np.arange(len(ids), dtype=np.int32)[::-1]
        counts = np.bincount(ids, minlength=len(first))
        order = np.argsort(parts[0][first], kind="stable")  # equal beginnings side by side
        first = first[order]
        words = [self.words.take(pa.array(p[first])) for p in parts]
        phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, b" ")
        cycle = self.langs[parts[0][first]] * 256 + start[first].astype(np.int64)
        cycles, which = np.unique(cycle, return_inverse=True)
        ends = pa.array([f"{self.names[c >> 8]}\t{c & 255}".encode() for c in cycles.tolist()], pa.binary())
        key = pc.binary_join_element_wise(phrase, ends.take(pa.array(which)), b"\t")
        return pa.RecordBatch.from_arrays([key.cast(pa.string()), pa.array(counts[order])], names=["key", "n"])

    def occurrences(self) -> pa.RecordBatch:
        counts = np.bincount(self.langs[self.ids], minlength=len(self.names))
        keys = pa.array([f"\t{name}\t0" for name in self.names], pa.string())
        return pa.RecordBatch.from_arrays([keys, pa.array(counts)], names=["key", "n"])

    def counts(
        self, step: int, shards: int, longest: int, reached: dict[int, np.ndarray]
    ) -> Iterator[pa.RecordBatch]:
        """What this step counts: words in the first cycle, then all active phrases."""
        if not self.n:
            return
        if step < shards:
            yield self.occurrences()
            yield self.counted(self.ids, [self.ids], np.zeros(self.n, np.uint8))
        at = np.arange(self.n, dtype=np.int32)  # where phrases of the length before start
        folded = self.hashes[self.ids]
        hashes = folded
        for size in range(2, longest + 1):
            table = reached.get(size - 1)
            if table is None:
                return
            since = table[folded & np.uint64(len(table) - 1)].astype(np.int16)
            follows = at[1:] == at[:-1] + 1
            follows &= self.joined[at[:-1] + size - 2]
            start = np.maximum(since[1:], since[:-1]) + 1
            # Longer phrases need places whose parts are reached, active now or not.
            usable = follows & (start <= step)
            here = at[:-1][usable]
            start = start[usable]
            active = start + shards > step
            if active.any():
                places = here[active]
                parts = [self.ids[places + i] for i in range(size)]
                ids = parts[0]
                for p in parts[1:]:
                    keys = ids.astype(np.int64)
                    keys *= int(p.max()) + 1
                    keys += p
                    ids, _ = _encoded(keys)
                    del keys
                yield self.counted(ids, parts, start[active])
                del places, parts, ids
            at = here
            folded = (folded[:-1][usable] >> np.uint64(20)) ^ hashes[at + size - 1]


def _counter(step: int, shards: int, longest: int, known, block: int):
    """Map function: texts to phrase counts of consecutive blocks."""
    reached = {}

    def flush(texts: list, langs: list) -> Iterator[pa.RecordBatch]:
        every = pa.concat_arrays(langs).fill_null(NO_LANGUAGE).dictionary_encode()
        names = every.dictionary.to_pylist()
        codes = every.indices.to_numpy().astype(np.int64)
        whole = pa.concat_arrays([t.cast(pa.large_binary()).fill_null(b"") for t in texts])
        parts, codes = _cut(whole, codes, block)
        offsets = text_offsets(parts)
        at = 0
        while at < len(parts):
            end = int(np.searchsorted(offsets, offsets[at] + block, side="right")) - 1
            end = max(end, at + 1)
            some = _Block(parts.slice(at, end - at), codes[at:end], names)
            yield from some.counts(step, shards, longest, reached)
            at = end

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, table in known.value.items():
            reached[size] = np.frombuffer(zlib.decompress(table), np.uint8)
        texts, langs, held = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            texts.append(b.column("text"))
            langs.append(b.column("lang"))
            held += b.column("text").nbytes
            if held >= block:
                yield from flush(texts, langs)
                texts, langs, held = [], [], 0
        if texts:
            yield from flush(texts, langs)

    return count


def _newly(rows: DataFrame, longest: int, slots: int) -> dict[int, np.ndarray]:
    """By length, a mask of the slots of the phrases in ``rows``: at most ``slots / 64``
    rows a length reach the driver."""
    at = slot("lang", "words", slots)
    bits = (
        _read(rows).where(F.col("size") < longest)
        .select("size", at.alias("at"))
        .groupBy("size", F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63L as int))")).alias("set"))
        .toPandas()
    )
    out = {}
    for size, some in bits.groupby("size"):
        words = np.zeros(slots // 64, "<u8")
        words[some["word"].to_numpy(np.int64)] = some["set"].to_numpy(np.int64).view(np.uint64)
        out[int(size)] = np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)
    return out


def frequent_phrases(
    documents: DataFrame,
    at_least: int = AT_LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    *,
    slots: int = SLOTS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``at_least`` times in a language.

    The first table has ``lang, size, phrase, n``, with exact counts; the second has the
    number of word occurrences as ``lang, n``. ASCII letters count as lower case, phrases
    lie within pieces, null texts have no words and a null language is ``und``. Every row
    counts, also a repeated one; other columns of ``documents`` play no part.
    """
    spark = ready(documents.sparkSession)
    context = spark.sparkContext
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in ("doc_id", "text") if c in documents.columns]), F.lit(shards))
    path = scratch_path(spark, "shards")
    documents.select(
        F.coalesce(documents["lang"].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        text_of(documents).alias("text"),
        dealt.cast("int").alias("shard"),
    ).write.partitionBy("shard").parquet(path)
    texts = spark.read.schema(SHARDED).parquet(path)
    reached = Reached(slots)
    carried, found, step = None, [], 0
    while step < shards or step <= reached.last() + shards:
        known = context.broadcast(reached.packed())
        part = texts.where(F.col("shard") == step % shards).select("lang", "text")
        counts = part.mapInArrow(_counter(step, shards, longest, known, block), COUNTS)
        if carried is not None:
            counts = counts.unionByName(carried)
        sums = counts.groupBy("key").agg(F.sum("n").alias("n"))
        # Of the phrases that complete their cycle now, only the frequent ones stay on.
        open_ = _start() + shards > step + 1
        kept = sums.where(open_ | (F.col("n") >= at_least) | F.col("key").startswith("\t"))
        counted = settle(kept, f"phrases-{step}")
        for size, at in _newly(counted.where(F.col("n") >= at_least), longest, slots).items():
            reached.note(size, at, step)
        found.append(counted.where(_start() + shards == step + 1))
        carried = counted.where(open_)
        known.destroy(blocking=True)  # this step's counts are written
        step += 1
    complete = found[0]
    for more in found[1:]:
        complete = complete.unionByName(more)
    every = settle(_read(complete).select("lang", "size", "phrase", "n"), "frequent-phrases")
    worded = F.col("phrase") != ""
    return every.where(worded), every.where(~worded & (F.col("n") > 0)).select("lang", "n")


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def collocations(frequent: DataFrame, swallowed: int = 50) -> DataFrame:
    """Scored phrases of two words or more: ``lang, phrase, a, l, r, score``.

    ``frequent`` holds a phrase's parts as well as the phrase, as ``frequent_phrases``
    gives them. Of all cuts in two the lowest-scoring counts, ties to the shortest first
    part. Phrases of which ``swallowed`` percent or more lie in one longer phrase are left out.
    """
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("right"),
        ),
    )
    longer = frequent.where(F.col("size") > 1)
    sides = longer.select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(cuts).alias("cut")
    ).select(
        "lang", "phrase", "a", "cut.k",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("first"), F.col("cut.left").alias("part")),
                F.struct(F.lit(False).alias("first"), F.col("cut.right").alias("part")),
            )
        ).alias("side"),
    ).select("lang", "phrase", "a", "k", "side.*")
    counts = frequent.select(
        F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("n").alias("own")
    )
    known = sides.join(
        counts, (sides["lang"] == counts["part_lang"]) & (sides["part"] == counts["part"])
    )
    both = known.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("own"))).alias("l"),
        F.max(F.when(~F.col("first"), F.col("own"))).alias("r"),
    )
    exact = both.select(
        "lang", "phrase", "a", "k", "l", "r",
        *[_exact(c).alias(f"_{c}") for c in "alr"],
    )
    million = "cast(1000000 as decimal(7,0))"
    scored = exact.withColumn("score", F.expr(f"({million} * (_a * _a)) div (_l * _r)"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("size") - m + 1),
                lambda i: F.array_join(F.slice(words, i, m), " "),
            ),
        )
    )
    around = (
        frequent.where(F.col("size") > 2)
        .select("lang", F.explode(inner).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("outer"))
    )
    held = lowest.join(around, ["lang", "phrase"], "left")
    free = F.col("outer").isNull() | (100 * F.col("outer") < swallowed * F.col("a"))
    return held.where(free).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def ranked(scored: DataFrame, totals: DataFrame, best: int = 2000) -> DataFrame:
    """The ``best`` phrases of each language with their rank and its word count."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= best
    )
    return top.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
