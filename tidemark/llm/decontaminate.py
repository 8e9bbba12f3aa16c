"""Benchmark decontamination by winnowing.

Training and test texts are cut into words; of each run of ``window`` words the
least of its ``GRAM``-word hashes is a fingerprint. Two texts that share
``window`` consecutive words therefore share a fingerprint, at the same place of
the shared span. Fingerprints are joined on their hash and every hit is extended
word by word, so only real matches count. Test items shorter than ``window`` are
one span of their own length and are looked up by the hash of that span.

What is broadcast is a bitmap of the test fingerprints: at most ``MOST_BITS``
bits whatever the benchmark's size. A full bitmap only lets more candidates
into the join. Test items of equal text are matched once and expanded at the end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import fresh, ready, same, settle, text_key, text_of
from tidemark.llm.spans import (
    PLAIN_WORD,
    TextBatch,
    Words,
    gram_hashes,
    mixed,
    slices,
    sliding_minimum,
)

WINDOW = 13
GRAM = 5
MOST_BITS = 1 << 27

WORDS = "array<binary>"
FOUND = f"array<struct<h:bigint,pos:bigint,size:int,mid:binary,left:{WORDS},right:{WORDS}>>"
SCAN = f"struct<n_words:bigint,found:{FOUND}>"


def _span_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of whole short items; a family of its own for each size."""
    return mixed(gram_hashes(words, size) + np.uint64(size))


def winnowed(words: Words, hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Places of the grams that are least in some run of ``window`` words."""
    grams = gram_hashes(hashes, gram)
    span = window - gram + 1
    least = sliding_minimum(grams, span)
    if not len(least):
        return np.zeros(0, np.int64)
    rows = words.rows()
    least = np.where(rows[: len(least)] == rows[window - 1 :], least, np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    greatest = ~sliding_minimum(~np.concatenate([edge, least, edge]), span)
    return np.flatnonzero((grams == greatest[: len(grams)]) & (greatest[: len(grams)] > 0))


def _listed(all_words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), all_words.take(pa.array(flat)).cast(pa.binary()))


def _ranges(starts: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """start, start+step, ... for each start, ``sizes`` of them."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts, sizes) + step * (np.arange(sizes.sum()) - np.repeat(first, sizes))


def _described(
    words: Words, hashes: np.ndarray, places: np.ndarray, sizes: np.ndarray, reach: np.ndarray
) -> pa.StructArray:
    """Hits with the words around them, up to ``reach`` on either side."""
    rows = np.searchsorted(words.bounds, places, side="right") - 1
    lefts = np.minimum(reach, places - words.bounds[rows])
    rights = np.minimum(reach, words.bounds[rows + 1] - places - sizes)
    every = words.binary()
    at = words.char_starts()
    # The middle words with a separator each: words hold no byte 0.
    mid = pa.array(
        [
            b"\0".join(words.chars[at[i] : at[i + 1]].tobytes() for i in range(p, p + n))
            for p, n in zip(places.tolist(), sizes.tolist(), strict=True)
        ],
        pa.binary(),
    )
    return pa.StructArray.from_arrays(
        [
            pa.array(hashes.view(np.int64)),
            pa.array(places - words.bounds[rows]),
            pa.array(sizes.astype(np.int32)),
            mid,
            _listed(every, _ranges(places - 1, lefts, -1), lefts),
            _listed(every, _ranges(places + sizes, rights, 1), rights),
        ],
        names=["h", "pos", "size", "mid", "left", "right"],
    )


def _scanner(
    window: int, gram: int, sizes: list[int], keep: Callable[[np.ndarray], np.ndarray] | None
) -> Callable[[pa.Array], pa.Array]:
    """Texts to word counts and fingerprints.

    ``keep`` selects hashes; without it the texts are test items, of which those
    below ``window`` words give one span, themselves.
    """

    def one(texts: pa.Array) -> pa.StructArray:
        words = TextBatch(texts).words(PLAIN_WORD, lower=True)
        hashes = words.hashes()
        places, kinds, values = [], [], []

        def add(at: np.ndarray, size: int, found: np.ndarray) -> None:
            if keep is not None:
                passed = keep(found)
                at, found = at[passed], found[passed]
            places.append(at)
            kinds.append(np.full(len(at), size))
            values.append(found)

        if keep is None:
            for size in np.unique(words.counts[(words.counts > 0) & (words.counts < window)]):
                at = words.bounds[:-1][words.counts == size]
                add(at, int(size), _span_hash(hashes, int(size))[at])
        else:
            rows = words.rows()
            for size in sizes:
                if len(hashes) >= size:
                    at = np.flatnonzero(rows[: len(rows) - size + 1] == rows[size - 1 :])
                    add(at, size, _span_hash(hashes, size)[at])
        at = winnowed(words, hashes, window, gram)
        add(at, gram, gram_hashes(hashes, gram)[at] if len(at) else np.zeros(0, np.uint64))
        place, kind, value = (np.concatenate(x) for x in (places, kinds, values))
        whole = np.concatenate(
            [np.full(len(x), i < len(places) - 1) for i, x in enumerate(places)]
        )
        order = np.argsort(place, kind="stable")
        place, kind, value, whole = place[order], kind[order], value[order], whole[order]
        found = _described(words, value, place, kind, np.where(whole, 0, window - gram))
        ends = np.searchsorted(place, words.bounds).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), found)
        return pa.StructArray.from_arrays(
            [pa.array(words.counts.astype(np.int64)), lists], names=["n_words", "found"]
        )

    def scan(texts: pa.Array) -> pa.Array:
        parts = [one(part) for part in slices(texts)]
        return pa.concat_arrays(parts) if parts else one(texts)

    return scan


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _bitmap(tests: DataFrame) -> np.ndarray:
    """Two bits for each hash, set by a grouped aggregate: a bounded collect."""
    n = tests.count()
    bits = 1 << 16
    while bits < 64 * n and bits < MOST_BITS:
        bits *= 2
    at = F.explode(
        F.array(
            F.col("h").bitwiseAND(F.lit(bits - 1)),
            F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(bits - 1)),
        )
    )
    words = (
        tests.select(at.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63L as int))")).alias("set"))
        .toPandas()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["set"].to_numpy(np.int64).view(np.uint64)
    return out


def _rows(scanned: DataFrame, *names: str) -> DataFrame:
    return scanned.select(*names, F.explode("scan.found").alias("f")).select(*names, "f.*")


def _agreeing(a: str, b: str) -> F.Column:
    """How many leading words two lists share."""
    equal = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(equal, False)
    return F.when(first == 0, F.size(equal)).otherwise(first - 1).cast("long")


def scan_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> tuple[DataFrame, DataFrame]:
    """Documents with their word counts, and the spans they share with test items.

    The first table has ``doc_id, text_key, n_words`` for each row, the second
    ``doc_id, text_key, item, start, end``: words ``start`` to ``end`` of the
    document, all inside runs of at least ``window`` words (or a whole shorter
    item) of the item texts with hash ``item``. Spans may overlap.
    """
    spark = ready(documents.sparkSession)
    items = benchmark.select(text_of(benchmark).alias("text")).distinct()
    test_scan = F.arrow_udf(_scanner(window, gram, [], None), SCAN)
    tests = settle(
        _rows(
            items.select(F.sha2("text", 256).alias("item"), test_scan("text").alias("scan")),
            "item",
        ),
        "test-fingerprints",
    )
    short = tests.where(F.size("left") + F.size("right") == 0).select("size").distinct()
    sizes = [r["size"] for r in short.collect()]  # at most ``window`` of them
    bitmap = spark.sparkContext.broadcast(_bitmap(tests))

    def keep(h: np.ndarray) -> np.ndarray:
        table = bitmap.value
        a, b = _places(h, len(table) * 64)
        one = np.uint64(1)
        six, low = np.uint64(6), np.uint64(63)
        return ((table[a >> six] >> (a & low)) & (table[b >> six] >> (b & low)) & one).astype(bool)

    scan = F.arrow_udf(_scanner(window, gram, sorted(sizes), keep), SCAN)
    text = text_of(documents)
    scanned = settle(
        documents.select("doc_id", text_key(text).alias("text_key"), scan(text).alias("scan")),
        "document-fingerprints",
    )
    found = _rows(scanned, "doc_id", "text_key")
    other = tests.select(
        "h", "size", "mid", "item",
        F.col("left").alias("item_left"), F.col("right").alias("item_right"),
    )
    spans = (
        found.join(other, ["h", "size", "mid"])
        .withColumn("before", _agreeing("left", "item_left"))
        .withColumn("after", _agreeing("right", "item_right"))
        .where(
            (F.size("item_left") + F.size("item_right") == 0)
            | (F.col("before") + F.col("size") + F.col("after") >= window)
        )
        .select(
            "doc_id", "text_key", "item",
            (F.col("pos") - F.col("before")).alias("start"),
            (F.col("pos") + F.col("size") + F.col("after")).alias("end"),
        )
    )
    return scanned.select("doc_id", "text_key", F.col("scan.n_words").alias("n_words")), spans


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> DataFrame:
    """Per document: words, words inside shared windows, and the items they come from.

    Columns ``doc_id, text_key, n_words, n_hit, items`` (sorted item ids as
    strings). A null text has no words. Rows of equal ``doc_id`` and text get
    equal results; items without an id mark words but are not listed.
    """
    base, spans = scan_documents(documents, benchmark, window)
    spans = settle(spans, "shared-spans")
    key = ["doc_id", "text_key"]
    order = Window.partitionBy(*key).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hits = (
        spans.select(*key, "start", "end").distinct()
        .withColumn("reached", F.coalesce(reached, F.lit(0)))
        .groupBy(*key)
        .agg(
            F.sum(
                F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))
            ).alias("n_hit")
        )
    )
    members = benchmark.select(
        F.sha2(text_of(benchmark), 256).alias("item"),
        F.col("item_id").cast("string").alias("item_id"),
    )
    items = (
        spans.select(*key, "item").distinct()
        .join(members, "item")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    out = base.join(hits, same(base, hits, *key), "left").select(
        base["doc_id"], base["text_key"], "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
    )
    return out.join(items, same(out, items, *key), "left").select(
        out["doc_id"], out["text_key"], "n_words", "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(share: int = 20) -> F.Column:
    """At least one ``share``-th of the words lies in shared windows."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = settle(
        contamination(documents, benchmark).where(contaminated()).select("doc_id", "text_key"),
        "contaminated",
    ).distinct()
    key = fresh(documents, "text_key")
    keyed = documents.withColumn(key, text_key(text_of(documents)))
    on = keyed["doc_id"].eqNullSafe(found["doc_id"]) & (keyed[key] == found["text_key"])
    return keyed.join(found, on, "left_anti").drop(key)
