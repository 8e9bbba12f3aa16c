"""Token-id files in canonical length-limited Huffman code.

One code for the whole corpus comes from global counts: a grouped aggregate over
the vocabulary, so what the driver sees is bounded. Documents are coded where they
lie, sorted by ``doc_id``, and written as files of independent blocks:

    file    magic ``TMHC``, u32 number of symbols, u8 longest code, u32 size and
            bytes of the zlib-packed code lengths (canonical: lengths are the code)
    block   u32 documents, then for each: u8 has-id, i64 doc_id, u64 ids,
            u64 payload bytes, u32 checkpoints, and its checkpoints (u32 bits since
            the one before); then the payloads, each from a full byte on

A checkpoint stands before every ``CHECK`` ids, the first at bit 0. Decoding reads
a table indexed by the next ``longest`` bits and steps through all checkpoints of
a block at once. Writers keep file names of their own; only files in the written
manifest count, so a repeated or lost task does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import (
    open_folder,
    partitions,
    ready,
    settle,
    text_key,
    text_of,
)
from tidemark.llm.tokens import binaries, id_type, token_ids, vocabulary_size
from tidemark.session import scratch_path

MAGIC = b"TMHC"
LONGEST = 18
CHECK = 256
BLOCK_IDS = 1 << 20
DOC = "<BqQQI"

BLOCKS = "part int, block int, path string, at long, size long, n_ids long, n_docs long"
DECODED = "part int, block int, place int, doc_id long, n_tokens long, ids_crc32 long"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Best code lengths of at most ``longest`` bits, 0 for ids that never occur.

    Package-merge: ``longest`` times, packages of two are merged with the single
    ids; an id's length is how often it is among the cheapest packages.
    """
    out = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.int64)
    levels = []  # for each level: which of its sorted entries are single ids
    weights = single
    levels.append(np.ones(n, dtype=bool))
    for _ in range(longest - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        every = np.concatenate([single, pairs])
        by = np.argsort(every, kind="stable")
        weights = every[by]
        levels.append(by < n)
    take = 2 * n - 2
    lengths = np.zeros(n, dtype=np.uint8)
    for is_single in reversed(levels):
        chosen = is_single[:take]
        alone = int(chosen.sum())
        lengths[:alone] += 1
        take = 2 * (len(chosen) - alone)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then by id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    sizes = lengths[order].astype(np.int64)
    steps = 1 << (int(sizes.max(initial=0)) - sizes)
    at = np.cumsum(steps) - steps
    codes[order] = (at >> (int(sizes.max(initial=0)) - sizes)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray, longest: int) -> np.ndarray:
    """Id * 256 + length for each value of the next ``longest`` bits."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    sizes = lengths[order].astype(np.int64)
    table = np.zeros(1 << longest, dtype=np.uint64)
    entries = order.astype(np.uint64) << np.uint64(8) | sizes.astype(np.uint64)
    filled = np.repeat(entries, 1 << (longest - sizes))
    table[: len(filled)] = filled
    return table


def encode(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """Payload bytes, their sizes per document, checkpoints and how many each has."""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(counts)
    bits = np.concatenate([[0], np.cumsum(sizes)])
    doc_bits = bits[ends] - bits[ends - counts]
    doc_bytes = -(-doc_bits // 8)
    first = np.cumsum(doc_bytes) - doc_bytes
    at = bits[:-1] + np.repeat(8 * first - bits[ends - counts], counts)
    total = int(doc_bytes.sum())
    # Every code lies in two neighbouring 32-bit words; sums are exact and never carry.
    word, room = at >> 5, 64 - (at & 31) - sizes
    both = codes[ids] << room.astype(np.uint64)
    n = total // 4 + 2
    high = np.bincount(word, (both >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(word + 1, (both & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    payload = (high[:n] + low[:n]).astype(np.uint64).astype(">u4").view(np.uint8)[:total]
    n_checks = -(-counts // CHECK)
    nth = np.arange(n_checks.sum()) - np.repeat(np.cumsum(n_checks) - n_checks, n_checks)
    check_at = at[np.repeat(ends - counts, n_checks) + CHECK * nth] if len(nth) else at[:0]
    since = np.diff(check_at, prepend=0)
    since[nth == 0] = 0
    return payload, doc_bytes, since.astype("<u4"), n_checks


def decode(
    payload: np.ndarray, checks: np.ndarray, left: np.ndarray, table: np.ndarray, longest: int
) -> np.ndarray:
    """Ids of all checkpoints' runs in order; ``left`` ids follow each checkpoint."""
    padded = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
    words = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    out = np.zeros(int(left.sum()), dtype=np.uint32)
    start = np.cumsum(left) - left
    order = np.argsort(-left, kind="stable")
    at, to, left = checks[order].copy(), start[order], left[order]
    down = np.uint32(32 - longest)
    for step in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -step, side="left"))
        here = at[:n]
        bits = words[here >> 3] << (here & 7).astype(np.uint32) >> down
        entry = table[bits]
        out[to[:n] + step] = entry >> np.uint64(8)
        at[:n] += (entry & np.uint64(255)).astype(np.int64)
    return out


def _counts(tokens: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_bytes_of(batch.column(0)).view(kind), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    rows = (
        tokens.select("ids")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most one row for each id of the vocabulary
    )
    out = np.zeros(size, dtype=np.int64)
    for row in rows:
        out[row["id"]] = row["n"]
    return out


def _bytes_of(column: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(
        column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32
    )[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]


CODED = "struct<n:bigint,payload:binary,checks:binary>"


def write(
    documents: DataFrame,
    path: str,
    end: int,
    folder: str | None = None,
    longest: int = LONGEST,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode all documents and write them in ascending ``doc_id`` order.

    Returns the manifest, one row per block. Null ids come first; rows of equal
    id follow their text's hash. A null text is empty and holds the end id.
    """
    spark = ready(documents.sparkSession)
    folder = folder or scratch_path(spark, "token-files")
    kind = id_type(path, end)
    size = vocabulary_size(path, end)
    text = text_of(documents)
    tokens = settle_packed(
        documents.select("doc_id", text_key(text).alias("key"), token_ids(path, end)(text).alias("t"))
        .select("doc_id", "key", "t.n", "t.ids")
    )
    lengths = code_lengths(_counts(tokens, kind, size), longest)
    shared = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def code(n: pa.Array, ids: pa.Array) -> pa.Array:
        lens, codes = shared.value
        counts = n.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = _bytes_of(ids).view(kind)
        out, at, done = [], np.concatenate([[0], np.cumsum(counts)]), 0
        while done < len(counts):  # some million ids at a time
            stop = int(np.searchsorted(at, at[done] + block_ids, side="right")) - 1
            stop = min(max(stop, done + 1), len(counts))
            payload, sizes, checks, n_checks = encode(
                flat[at[done] : at[stop]].astype(np.int64), counts[done:stop], lens, codes
            )
            out.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array(counts[done:stop]),
                        binaries(payload, sizes),
                        binaries(checks.view(np.uint8), 4 * n_checks),
                    ],
                    names=["n", "payload", "checks"],
                )
            )
            done = stop
        kinds = pa.struct([("n", pa.int64()), ("payload", pa.binary()), ("checks", pa.binary())])
        return pa.concat_arrays(out) if out else pa.array([], kinds)

    head = zlib.compress(lengths.tobytes())
    header = MAGIC + struct.pack("<IBI", size, longest, len(head)) + head

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        name, sink, rows = f"{base}/{uuid.uuid4().hex}.tmhc", None, []
        part, block, place = 0, 0, 0
        docs: list[tuple] = []

        def flush() -> None:
            nonlocal block, place, docs
            heads = b"".join(
                struct.pack(DOC, i is not None, i or 0, n, len(p), len(c) // 4) + c for i, n, p, c in docs
            )
            data = struct.pack("<I", len(docs)) + heads + b"".join(p for _, _, p, _ in docs)
            sink.write(data)
            rows.append((part, block, place, len(data), sum(d[1] for d in docs), len(docs)))
            place, block, docs = place + len(data), block + 1, []

        waiting = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for number, doc_id, n, payload, checks in zip(*columns, strict=True):
                if sink is None:
                    part = number
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(name)
                    sink.write(header)
                    place = len(header)
                docs.append((doc_id, n, payload, checks))
                waiting += n
                if waiting >= block_ids:
                    flush()
                    waiting = 0
        if sink is not None:
            if docs:
                flush()
            sink.close()
            p, b, at, data, n_ids, n_docs = (list(x) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(p, pa.int32()),
                    pa.array(b, pa.int32()),
                    pa.array([f"{folder}/{name.rsplit('/', 1)[1]}"] * len(rows)),
                    pa.array(at, pa.int64()),
                    pa.array(data, pa.int64()),
                    pa.array(n_ids, pa.int64()),
                    pa.array(n_docs, pa.int64()),
                ],
                ["part", "block", "path", "at", "size", "n_ids", "n_docs"],
            )

    coder = F.arrow_udf(code, CODED)
    coded = tokens.select("doc_id", "key", coder("n", "ids").alias("c")).select(
        "doc_id", "key", "c.n", "c.payload", "c.checks"
    )
    ordered = (
        coded.repartitionByRange(partitions(spark), "doc_id", "key")
        .sortWithinPartitions("doc_id", "key")
        .select(F.spark_partition_id().alias("part"), "doc_id", "n", "payload", "checks")
    )
    return settle(ordered.mapInArrow(save, BLOCKS), "token-manifest")


def settle_packed(tokens: DataFrame) -> DataFrame:
    """Write the ids with a stronger codec: two bytes an id, of which ten bits count."""
    path = scratch_path(tokens.sparkSession, "tokens")
    tokens.write.option("compression", "zstd").parquet(path)
    return tokens.sparkSession.read.schema(tokens.schema).parquet(path)


def read_header(store, path: str) -> tuple[np.ndarray, int]:
    with store.open_input_file(path) as f:
        magic, size, longest, packed = struct.unpack("<4sIBI", f.read(13))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        return np.frombuffer(zlib.decompress(f.read(packed)), np.uint8)[:size], longest


def read_block(data: bytes, table: np.ndarray, longest: int):
    """Document ids (or None), id counts and all ids of one block."""
    n_docs, at = struct.unpack_from("<I", data)[0], 4
    doc_ids, counts, sizes, checks = [], [], [], []
    for _ in range(n_docs):
        has, doc_id, n, n_bytes, n_checks = struct.unpack_from(DOC, data, at)
        at += struct.calcsize(DOC)
        doc_ids.append(doc_id if has else None)
        counts.append(n)
        sizes.append(n_bytes)
        checks.append(np.frombuffer(data, "<u4", n_checks, at))
        at += 4 * n_checks
    counts, sizes = np.array(counts, np.int64), np.array(sizes, np.int64)
    n_checks = np.array([len(c) for c in checks], np.int64)
    first = np.cumsum(n_checks) - n_checks
    run = np.cumsum(np.concatenate(checks).astype(np.int64))
    inside = run - np.repeat(run[first], n_checks)
    starts = inside + np.repeat(8 * (np.cumsum(sizes) - sizes), n_checks)
    left = np.full(len(starts), CHECK, np.int64)
    left[first + n_checks - 1] = counts - CHECK * (n_checks - 1)
    ids = decode(np.frombuffer(data, np.uint8, offset=at), starts, left, table, longest)
    return doc_ids, counts, ids


def read(manifest: DataFrame) -> DataFrame:
    """Decode all blocks of the manifest: per document its ids' number and checksum.

    ``start`` counts the ids of all documents before it: sums per file, then
    per block within a file, then per document within a block.
    """
    spark = ready(manifest.sparkSession)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_folder(row["path"])
                if path not in tables:
                    lengths, longest = read_header(store, path)
                    tables.clear()
                    tables[path] = decode_table(lengths, longest), longest
                with store.open_input_file(path) as f:
                    f.seek(row["at"])
                    data = f.read(row["size"])
                doc_ids, counts, ids = read_block(data, *tables[path])
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                ends = 4 * np.cumsum(counts)
                sums = [
                    zlib.crc32(raw[a:b])
                    for a, b in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)
                ]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)),
                        pa.array(np.full(n, row["block"], np.int32)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(counts),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "block", "place", "doc_id", "n_tokens", "ids_crc32"],
                )

    # One row per file here, so this one window stays small.
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("file_ids"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("files_before", F.coalesce(F.sum("file_ids").over(upto), F.lit(0)))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = manifest.withColumn(
        "blocks_before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    ).join(files, "part")
    blocks = blocks.select(
        "part", "block", (F.col("files_before") + F.col("blocks_before")).alias("base")
    )
    spread = manifest.repartitionByRange(partitions(spark), "part", "block")
    docs = spread.mapInArrow(load, DECODED)
    within = Window.partitionBy("part", "block").orderBy("place")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        docs.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .hint("merge")  # the manifest's size says nothing about the documents in it
        .join(blocks, ["part", "block"])
        .select(
            "doc_id",
            (F.col("base") + F.col("ahead")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )
