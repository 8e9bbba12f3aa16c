"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link when two or fewer bits differ. Cut into two segments
of 32 bits, one segment of such a pair differs in at most one bit. Each segment is
indexed under its 32 variants with one bit left out, so the pair meets in an
equality join; the full distance is then verified. Equal fingerprints count once.

A bucket of up to ``PAIRED`` fingerprints is compared pair by pair. Those in larger
buckets (a group of near copies) meet by points instead: a fingerprint and its 64
neighbours at one bit. Two fingerprints share a point exactly if two or fewer bits
differ, and no point has more than 65 fingerprints, so work stays linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import fresh, partitions, ready, same, settle, text_key, text_of
from tidemark.llm.spans import SPACED_WORD, TextBatch, slices

SHINGLE = 3
SEED = 42
DISTANCE = 2
PAIRED = 64


def shingle_hashes(batch: TextBatch, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, repeats included, and how many each text has."""
    words = batch.words(SPACED_WORD, lower=True)
    n = len(words)
    at = words.char_starts()
    spaced = np.full(int(at[-1]) + n, 32, np.uint8)
    starts = at[:-1] + np.arange(n)
    spaced[np.arange(len(words.chars)) + np.repeat(np.arange(n), words.lengths)] = words.chars
    ends = starts + words.lengths
    rows = words.rows()
    full = np.flatnonzero(rows[: max(n - size + 1, 0)] == rows[size - 1 :])
    short = words.bounds[:-1][(words.counts > 0) & (words.counts < size)]
    first = np.concatenate([full, short])
    last = np.concatenate(
        [full + size - 1, words.bounds[1:][(words.counts > 0) & (words.counts < size)] - 1]
    )
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    data, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    pairs = zip(starts[first].tolist(), ends[last].tolist(), strict=True)
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in pairs), dtype=np.uint64, count=len(first)
    )
    counts = np.where(words.counts >= size, words.counts - size + 1, words.counts > 0)
    return hashes, counts.astype(np.int64)


def fingerprints(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """Bit i is 1 if more than half of a text's shingle hashes have it."""
    out = []
    for part in slices(texts):
        hashes, counts = shingle_hashes(TextBatch(part), size)
        value = np.zeros(len(counts), np.uint64)
        some = np.flatnonzero(counts)
        if len(some):
            bits = np.unpackbits(
                hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            starts = (np.cumsum(counts) - counts)[some]
            ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            most = (2 * ones > counts[some, None]).astype(np.uint8)
            value[some] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
        out.append(value)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprint_column(size: int = SHINGLE):
    """Column function: the fingerprint of a text as a long."""

    def column(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(fingerprints(batch, size).view(np.int64))

    return F.arrow_udf(column, "bigint")


def _variants(prints: DataFrame) -> DataFrame:
    """``fp`` under the 64 keys of its segments' one-bit-less variants."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)

    def keys(segment: F.Column, first: int) -> list[F.Column]:
        return [
            segment.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << b))).bitwiseOR(F.lit((first + b) << 32))
            for b in range(32)
        ]

    return prints.select("fp", F.explode(F.array(*keys(low, 0), *keys(high, 32))).alias("key"))


def _near(a: F.Column, b: F.Column) -> F.Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``u, v`` that connect all different fingerprints within ``DISTANCE`` bits.

    ``prints`` is a written table of different ``fp``. Small buckets give all their
    verified pairs, larger ones a star for each point.
    """
    # A small file becomes 64 times as many rows: deal them out first.
    variants = _variants(prints.repartition(partitions(prints.sparkSession)))
    buckets = settle(
        variants.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .where("n > 1"),
        "buckets",
    )
    twos = buckets.where("n = 2").where(_near(F.col("u"), F.col("v"))).select("u", "v")
    # Variants are far more rows than the table they come from: never to be broadcast.
    members = settle(
        variants.hint("merge").join(buckets.where("n > 2").select("key", "n"), "key"),
        "bucket-members",
    )
    lists = (
        members.where(F.col("n") <= PAIRED)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    pairs = F.flatten(
        F.transform(
            "fps",
            lambda x, i: F.transform(
                F.filter(F.slice("fps", i + 2, PAIRED), lambda y: _near(x, y)),
                lambda y: F.struct(x.alias("u"), y.alias("v")),
            ),
        )
    )
    small = lists.select(F.inline(pairs))
    crowded = members.where(F.col("n") > PAIRED).select("fp").distinct()
    flips = [F.col("fp").bitwiseXOR(F.lit((1 << b) - (1 << 64 if b == 63 else 0))) for b in range(64)]
    points = crowded.select("fp", F.explode(F.array("fp", *flips)).alias("point"))
    stars = (
        points.groupBy("point")
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("u"), F.explode("fps").alias("v"))
        .where("u <> v")
    )
    return twos.union(small).union(stars)


def groups(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, key, fp, root, component_id`` for each row.

    ``root`` names the component; ``component_id`` is its least ``doc_id`` (null if it
    has none). A null text has no words and fingerprint 0, linked like any other.
    """
    ready(documents.sparkSession)
    text = text_of(documents)
    prints = settle(
        documents.select(
            "doc_id", text_key(text).alias("key"), fingerprint_column(size)(text).alias("fp")
        ),
        "fingerprints",
    )
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp")))
    named = settle(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "roots",
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = settle(named.join(least, "root").select("fp", "root", "component_id"), "classes")
    return prints.join(classes, "fp")


def deduplicated(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns.

    It is the one with the least ``doc_id`` (null last), then text hash; of rows
    that share both, one stays.
    """
    members = settle(groups(documents, size).select("doc_id", "key", "root"), "members")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")
    first = members.groupBy("root").agg(F.min(order).alias("first"))
    first = first.select("first.doc_id", "first.key")
    gone = settle(
        members.select("doc_id", "key").distinct().join(
            first, same(members, first, "doc_id", "key"), "left_anti"
        ),
        "removed",
    )
    repeated = settle(
        members.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key"),
        "repeated",
    )
    key = fresh(documents, "key")
    keyed = documents.withColumn(key, text_key(text_of(documents)))

    def among(rows: DataFrame) -> F.Column:
        return keyed["doc_id"].eqNullSafe(rows["doc_id"]) & (keyed[key] == rows["key"])

    kept = keyed.join(gone, among(gone), "left_anti")
    if repeated.isEmpty():
        return kept.drop(key)
    once = kept.join(repeated, among(repeated), "left_semi").dropDuplicates(["doc_id", key])
    return kept.join(repeated, among(repeated), "left_anti").union(once).drop(key)
