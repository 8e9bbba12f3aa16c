"""Best-two-fit packing of token sequences.

Only the lengths of the pieces matter, and there are at most ``size`` different
ones. The plan is therefore made from how many pieces have each length: a table
of ``size`` rows whatever the corpus holds. A bin is filled greedily with the
longest pieces that fit. Then its shortest piece gives way to two unpacked
pieces, where two fit the widened gap more tightly. The bin is used as often as
the counts allow, so every step uses up a length. Pieces get numbers within their
length, salted so that a length that holds a third of all pieces is numbered by
many tasks, and the number tells the sequence and the place in it, by a search among
the plan's places of that length.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions, ready, settle, text_key, text_of
from tidemark.llm.tokens import encoded

SIZE = 4096

#: Pieces numbered by one task, about.
PER_TASK = 1 << 20


def best_two(counts: np.ndarray, room: int, above: int) -> tuple[int, int]:
    """Two available lengths with the greatest sum in (above, room]; zeros if none."""
    have = np.flatnonzero(counts[1 : room + 1]) + 1
    if not len(have):
        return 0, 0
    at = np.searchsorted(have, room - have, side="right") - 1
    fits = at >= 0
    first, second = have[fits], have[at[fits]]
    alone = (first == second) & (counts[first] < 2)
    lower = np.searchsorted(have, second, side="left") - 1
    second = np.where(alone, np.where(lower >= 0, have[np.maximum(lower, 0)], 0), second)
    sums = np.where(second > 0, first + second, 0)
    if not len(sums) or sums.max() <= above:
        return 0, 0
    best = int(np.argmax(sums))
    return int(first[best]), int(second[best])


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[int, list[int]]]:
    """Bins as (how often, lengths) that use up ``counts[length]`` pieces of each length."""
    left = np.array(counts, dtype=np.int64)
    out = []
    top = len(left) - 1
    while True:
        while top > 0 and left[top] == 0:
            top -= 1
        if top <= 0:
            return out
        free, room, pieces = left.copy(), size, []
        while True:
            have = np.flatnonzero(free[1 : room + 1])
            if not len(have):
                break
            length = int(have[-1]) + 1
            n = int(min(free[length], room // length))
            pieces += [length] * n
            free[length] -= n
            room -= n * length
        if room and len(pieces) > 1:
            small = pieces[-1]
            a, b = best_two(free, room + small, small)
            if a:
                pieces[-1:] = [a, b]
        lengths, need = np.unique(pieces, return_counts=True)
        times = int((left[lengths] // need).min())
        left[lengths] -= need * times
        out.append((times, pieces))


def places(bins: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first, each, sequence, offset): of a length's pieces, from number ``first``
    on, ``each`` at a time go side by side to ``sequence``, ``sequence`` + 1, ... from
    ``offset`` on, up to the ``first`` of the length's next row."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, pieces in bins:
        offset = 0
        for length, run in groupby(pieces):
            each = len(list(run))
            first = used.get(length, 0)
            out.append((length, first, each, sequence, offset))
            used[length] = first + times * each
            offset += length * each
        sequence += times
    return out


#: A piece's length and number as one number that sorts by both.
NUMBER_BITS = 50


def _placing(slots: list[tuple[int, int, int, int, int]]):
    """Column function of length and number: sequence and offset, by binary search."""
    table = np.array(sorted(slots) or np.zeros((0, 5)), dtype=np.int64).reshape(-1, 5)

    def place(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        length, number = (x.to_numpy(zero_copy_only=False) for x in (lengths, numbers))
        starts = (table[:, 0] << NUMBER_BITS) + table[:, 1]
        at = np.searchsorted(starts, (length << NUMBER_BITS) + number, side="right") - 1
        _, first, each, sequence, offset = table[at].T
        full, rest = np.divmod(number - first, each)
        return pa.StructArray.from_arrays(
            [pa.array(sequence + full), pa.array(offset + rest * length)],
            names=["sequence_id", "offset"],
        )

    return F.arrow_udf(place, "struct<sequence_id:bigint,offset:bigint>")


def token_pieces(documents: DataFrame, path: str, end: int, size: int = SIZE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's ids.

    A null text is empty: its one piece holds the end id. Repeated rows are
    documents of their own.
    """
    ready(documents.sparkSession)

    def cut(texts: pa.Array) -> pa.Array:
        parts = []
        for ids, counts in encoded(texts, path, end):
            raw = memoryview(ids.astype("<u4").view(np.uint8))
            ends = np.cumsum(counts)
            sums, n = [], []
            for start, stop in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                cuts = range(start, stop, size)
                sums += [zlib.crc32(raw[4 * c : 4 * min(c + size, stop)]) for c in cuts]
                n.append(len(cuts))
            at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(sums, pa.int64()))
            parts.append(
                pa.StructArray.from_arrays([pa.array(counts), lists], names=["n", "sums"])
            )
        kind = pa.struct([("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    pieces = F.arrow_udf(cut, "struct<n:bigint,sums:array<bigint>>")
    text = text_of(documents)
    return (
        documents.select("doc_id", text_key(text).alias("key"), pieces(text).alias("cut"))
        .select("doc_id", "key", "cut.n", F.posexplode("cut.sums").alias("piece", "ids_crc32"))
        .select(
            "doc_id",
            "key",
            "piece",
            (F.col("piece").cast("long") * size).alias("start"),
            F.least(F.lit(size), F.col("n") - F.col("piece") * size).cast("long").alias("length"),
            "ids_crc32",
        )
    )


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    ``pieces`` must be a written table with ``length`` from 1 to ``size``. Its
    rows are numbered by ``doc_id`` and ``piece`` within a length and a salt.
    """
    spark = pieces.sparkSession
    counts = np.zeros(size + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``size`` rows
        counts[row["length"]] = row["count"]
    # A plan has at most some thousand bins, whatever the number of pieces.
    placed = _placing(places(plan(counts, size)))
    salts = max(partitions(spark), -(-int(counts.sum()) // PER_TASK))
    salted = pieces.withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "key", "piece"), F.lit(salts)).cast("int")
    )
    group = Window.partitionBy("salt", "length").orderBy("doc_id", "piece", "key")
    ranked = salted.withColumn("rank", F.row_number().over(group).cast("long") - 1)
    before = Window.partitionBy("length").orderBy("salt")
    bases = (
        salted.groupBy("salt", "length")
        .count()
        .withColumn("base", F.sum("count").over(before) - F.col("count"))
        .select("salt", "length", "base")
    )
    numbered = ranked.join(bases, ["salt", "length"]).withColumn(
        "number", F.col("rank") + F.col("base")
    )
    return numbered.select(
        "doc_id", "piece", "start", "length", "ids_crc32", placed("length", "number").alias("p")
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "p.*")


def pack_documents(documents: DataFrame, path: str, end: int, size: int = SIZE) -> DataFrame:
    """All documents as pieces of at most ``size`` tokens in as few sequences as possible."""
    return pack(settle(token_pieces(documents, path, end, size), "pieces"), size)
