"""Repair of conversation structure by a square-root checkpointed dynamic programme.

A conversation's rows become an edit sequence: keep, give another role, delete, insert.
The result must read as role initials ``(s?(ua)+)?``, which four states follow. The least
cost of the rest of a conversation by state is a vector of four numbers, computed from
the end backward; it is kept at checkpoints only. Rows are dealt by ranges of conversation
and turn, and each range cuts its conversations into blocks that grow one by one, so n
rows have some square root of n checkpoints with as many rows between them. A block says
what it costs from each state to each state, so a conversation's blocks, few and small,
give the vectors at all checkpoints. Walking forward, a block's vectors are recomputed from
its checkpoint, and the first tight edit in ASCII order is taken; the state in which each
block is entered follows from the exits of the blocks before it. No task holds more of a
conversation than one block or its list of checkpoints.

Nulls in role and text count as one space. A row is known by conversation, turn, role and
a digest of its text; equal rows are one row with a number, whose later copies go. Of one
turn, rows are taken by role, then digest. Texts are joined to the outcome alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema

from tidemark.llm.shared import partitions, ready, settle

KEEP, REROLE, DELETE, INSERT = "KRDI"
#: What the edits cost, and what a cut-off row costs that is not deleted.
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: States: nothing yet, after the system's turn, after the user's, after the assistant's.
STATES = range(4)
ACCEPTED = (0, 3)
FOLLOWS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The state that an inserted or re-roled turn leads to, and its role.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
LEGAL = ("su", "ua", "au")
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
FAR = 1 << 50

#: The first block of a conversation in a range has so many rows, the n-th n times as many.
FIRST_BLOCK = 64
ROWS_A_RANGE = 2_000_000
FLUSH_ROWS = 20_000

SPACE = "\x20\x09-\x0d"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults: ``conv_id, turn, role, text, copies``.

    Nulls in role and text become one space. Of 20 remainders of a checksum of
    ``conv_id:turn``, 0 drops the row, 1 empties its text, 2 removes the sentence ends,
    3 repeats the row, 4 makes it the user's.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(conversations[name].cast("string"), F.lit(" "))

    key = F.concat_ws(":", spaced("conv_id"), spaced("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    text = spaced("text")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
        fault.alias("fault"),
    ).where(F.col("fault") != 0).drop("fault")


def _with(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """``left`` with the other columns of ``right``, null where it has no such row."""
    keyed = right.withColumnsRenamed({n: f"_own_{n}" for n in names})
    match = F.lit(True)
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"_own_{n}"))
    return left.join(keyed, match, "left").drop(*[f"_own_{n}" for n in names])


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def faulty(rows: DataFrame) -> DataFrame:
    """Different rows with their first fault: ``conv_id, turn, role, digest, copies, fault``.

    ``rows`` are as ``damaged`` returns them. The fault is that of the first copy; further
    copies are duplicates, or blank as it is.
    """
    ended = F.regexp_extract("text", f"([^{SPACE}])[{SPACE}]*\\z", 1)
    single = rows.groupBy("conv_id", "turn", "role", _digest(F.col("text")).alias("digest")).agg(
        F.sum("copies").alias("copies"), F.min(ended).alias("ended")
    )
    single = settle(single, "conversation-rows")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    again = (
        single.groupBy("conv_id", "role", "digest")
        .agg(F.min(place)["turn"].alias("first_turn"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    joined = _with(single, again, "conv_id", "role", "digest")
    later = F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = (
        F.when(F.col("ended") == "", BLANK)
        .when(later, DUPLICATE)
        .when(~F.col("ended").isin(".", "!", "?"), CUT_OFF)
        .otherwise(SOUND)
    )
    return joined.select("conv_id", "turn", "role", "digest", "copies", fault.alias("fault"))


def _forced(row: dict) -> bool:
    return row["fault"] in (BLANK, DUPLICATE)


def _with_inserts(v: list[int]) -> list[int]:
    """The costs if turns may be inserted first."""
    step = COST[INSERT]
    user, assistant = min(v[2], v[3] + step), min(v[3], v[2] + step)
    return [min(v[0], user + step), min(v[1], user + step), user, assistant]


def _edits(row: dict, q: int, after: list[int]) -> Iterator[tuple[str, int, int]]:
    """Edits of a row that may stay, the state after them, and the cost of all the rest."""
    copies = COST[DELETE] * (row["copies"] - 1)
    extra = copies + (TRUNCATED if row["fault"] == CUT_OFF else 0)
    yield DELETE, q, COST[DELETE] + copies + after[q]
    kept = FOLLOWS.get(row["role"][:1], {}).get(q)
    if kept is not None:
        yield KEEP, kept, COST[KEEP] + extra + after[kept]
    yield REROLE, NEXT[q], COST[REROLE] + extra + after[NEXT[q]]


def _before(row: dict, after: list[int]) -> list[int]:
    """The vector before a row, from that after it."""
    if _forced(row):
        return [v + COST[DELETE] * row["copies"] for v in after]
    return _with_inserts([min(c for _, _, c in _edits(row, q, after)) for q in STATES])


def crossing(rows: list[dict]) -> list[int]:
    """The least cost of a block from each state to each state, row by row."""
    columns = []
    for end in STATES:
        v = [0 if q == end else FAR for q in STATES]
        for row in reversed(rows):
            v = [min(x, FAR) for x in _before(row, v)]
        columns.append(v)
    return [columns[end][q] for q in STATES for end in STATES]


def walk(rows: list[dict], end: list[int], q: int) -> tuple[str, int, list[tuple[str, dict | None]]]:
    """The ASCII-least tight edits of a block, the state it leaves, and the rows it keeps.

    ``end`` is the vector at the checkpoint after the block; those of the rows before it
    are recomputed here.
    """
    vectors = [end]
    for row in reversed(rows):
        vectors.append(_before(row, vectors[-1]))
    vectors.reverse()
    audit, kept = [], []
    for i, row in enumerate(rows):
        if _forced(row):
            audit.append(DELETE * row["copies"])
            continue
        here, after = vectors[i], vectors[i + 1]
        while True:
            options = [(e, to) for e, to, cost in _edits(row, q, after) if cost == here[q]]
            if COST[INSERT] + here[NEXT[q]] == here[q]:
                options.append((INSERT, NEXT[q]))
            edit, to = min(options)
            if edit == INSERT:
                audit.append(edit)
                kept.append((ROLE[q], None))
                q = to
                continue
            audit.append(edit + DELETE * (row["copies"] - 1))
            if edit != DELETE:
                kept.append((row["role"] if edit == KEEP else ROLE[q], row))
            q = to
            break
    return "".join(audit), q, kept


def last_vector() -> list[int]:
    return _with_inserts([0 if q in ACCEPTED else FAR for q in STATES])


def closing(q: int) -> tuple[str, list[str]]:
    """What must be inserted after the last row."""
    audit, roles = "", []
    while q not in ACCEPTED:
        audit, roles, q = audit + INSERT, [*roles, ROLE[q]], NEXT[q]
    return audit, roles


_LONG, _TEXT = pa.int64(), pa.string()
_PLACE = [("part", pa.int32()), ("block", _LONG)]
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")
TOTALS = pa.struct(
    [
        *[(name, _LONG) for name in _COUNTS],
        ("ends", pa.list_(pa.struct([*_PLACE, ("vector", pa.list_(_LONG))]))),
    ]
)
ENTRIES = pa.list_(pa.struct([*_PLACE, ("entry", pa.int32()), ("last", pa.bool_())]))
WALKED = pa.struct(
    [
        ("audit", _TEXT),
        ("turns", pa.list_(pa.struct([("role", _TEXT), ("old", _TEXT), ("digest", _TEXT)]))),
    ]
)
ROW = "struct<turn:{turn},role:string,digest:string,copies:bigint,fault:int>"
SUMMARY = (
    "cost:array<bigint>,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,"
    "first:string,last:string,turns:bigint,low:{turn},high:{turn}"
)


def _summary(rows: list[dict]) -> dict:
    initials = [r["role"][:1] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    of = {f: [r["copies"] for r in rows if r["fault"] == f] for f in range(4)}
    return {
        "cost": crossing(rows),
        "blank": sum(of[BLANK]),
        "duplicate": sum(of[DUPLICATE]) + sum(n - 1 for f in (SOUND, CUT_OFF) for n in of[f]),
        "truncated": len(of[CUT_OFF]),
        "illegal": sum(r["copies"] - 1 for r in rows)
        + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0],
        "last": initials[-1],
        "turns": len(set(turns)),
        "low": turns[0] if turns else None,
        "high": turns[-1] if turns else None,
    }


def _blocks(names: list[str], schema: pa.Schema):
    """Map function: sorted rows to blocks of one conversation each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number, conv, rows, room, ready_blocks, held = 0, None, [], FIRST_BLOCK, [], 0

        def close() -> None:
            nonlocal number, rows
            if rows:
                ready_blocks.append(
                    {"conv_id": conv, "part": part, "block": number, "rows": rows, **_summary(rows)}
                )
                number, rows = number + 1, []

        for batch in batches:
            for row in batch.select(names).to_pylist():
                own = row.pop("conv_id")
                if not rows and room == FIRST_BLOCK:
                    conv = own
                if own != conv:
                    close()
                    conv, room = own, FIRST_BLOCK
                elif len(rows) == room:
                    close()
                    room += FIRST_BLOCK
                rows.append(row)
                held += 1
            if held >= FLUSH_ROWS:
                yield pa.RecordBatch.from_pylist(ready_blocks, schema)
                ready_blocks, held = [], 0
        close()
        if ready_blocks:
            yield pa.RecordBatch.from_pylist(ready_blocks, schema)

    return cut


def blocks(found: DataFrame) -> DataFrame:
    """Rows of ``faulty`` as numbered blocks with what each adds up to."""
    spark = found.sparkSession
    turn = found.schema["turn"].dataType
    conv = found.schema["conv_id"].dataType
    kinds = {"turn": turn.simpleString()}
    text = f"part int, block bigint, rows array<{ROW}>, ".format(**kinds)
    inner = T._parse_datatype_string(f"struct<{SUMMARY.format(**kinds)}>")
    schema = T.StructType(
        [T.StructField("conv_id", conv), *T._parse_datatype_string(text.rstrip(", ")).fields, *inner.fields]
    )
    found = settle(found, "conversation-faults")
    n = max(partitions(spark), ceil(found.count() / ROWS_A_RANGE))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest")]
    names = ["conv_id", "turn", "role", "digest", "copies", "fault"]
    dealt = found.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return settle(dealt.mapInArrow(_blocks(names, to_arrow_schema(schema)), schema), "conversation-blocks")


def _checkpoints(every: pa.Array) -> pa.Array:
    """Blocks of a conversation in order to its totals and the vector after each block."""
    out = []
    for blocks_ in every.to_pylist():
        v, vectors = last_vector(), []
        for b in reversed(blocks_):
            vectors.append(v)
            c = b["cost"]
            v = [min(c[4 * q + e] + v[e] for e in STATES) for q in STATES]
        vectors.reverse()
        total = {k: sum(b[k] for b in blocks_) for k in ("blank", "duplicate", "truncated", "illegal")}
        for a, b in zip(blocks_, blocks_[1:]):
            total["illegal"] += a["last"] + b["first"] not in LEGAL
        turns, low, high = 0, None, None
        for b in blocks_:
            if b["turns"]:
                turns += b["turns"] - (b["low"] == high)
                low, high = b["low"] if low is None else low, b["high"]
        total["gaps"] = high - low + 1 - turns if turns else 0
        ends = [
            {"part": b["part"], "block": b["block"], "vector": x}
            for b, x in zip(blocks_, vectors, strict=True)
        ]
        out.append({**total, "cost": v[0], "ends": ends})
    return pa.array(out, TOTALS)


def _exits(rows: pa.Array, vectors: pa.Array) -> pa.Array:
    out = [
        [walk(r, v, q)[1] for q in STATES]
        for r, v in zip(rows.to_pylist(), vectors.to_pylist(), strict=True)
    ]
    return pa.array(out, pa.list_(pa.int32()))


def _entries(every: pa.Array) -> pa.Array:
    """Exits of a conversation's blocks in order to the state each is entered in."""
    out = []
    for blocks_ in every.to_pylist():
        q, entries = 0, []
        for b in blocks_:
            entries.append({"part": b["part"], "block": b["block"], "entry": q})
            q = b["exits"][q]
        for e in entries:
            e["last"] = e is entries[-1]
        out.append(entries)
    return pa.array(out, ENTRIES)


def _walked(rows: pa.Array, vectors: pa.Array, entries: pa.Array, last: pa.Array) -> pa.Array:
    out = []
    for r, v, q, end in zip(
        rows.to_pylist(), vectors.to_pylist(), entries.to_pylist(), last.to_pylist(), strict=True
    ):
        audit, left, kept = walk(r, v, q)
        more, roles = closing(left) if end else ("", [])
        kept += [(role, None) for role in roles]
        turns = [
            {"role": role, "old": x and x["role"], "digest": x and x["digest"]} for role, x in kept
        ]
        out.append({"audit": audit + more, "turns": turns})
    return pa.array(out, WALKED)


def _in_order(df: DataFrame, *names: str) -> DataFrame:
    """Each conversation's blocks as one sorted array of small rows."""
    return df.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "block", *names))).alias("blocks")
    )


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest edits of each conversation of ``damaged``-like rows.

    The first table has a row per conversation that has rows: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost``. The second has a row per block of a
    conversation, in order of ``part, block``: its ``audit`` and its ``turns`` as they
    are after the repair, ``role, old, digest``, the latter two null if inserted.
    """
    ready(rows.sparkSession)
    cut = blocks(faulty(rows))
    parts = [f.name for f in T._parse_datatype_string(f"struct<{SUMMARY.format(turn='bigint')}>").fields]
    summed = F.arrow_udf(_checkpoints, from_arrow_type(TOTALS))
    totals = settle(
        _in_order(cut, *parts).select("conv_id", summed("blocks").alias("t")).select("conv_id", "t.*"),
        "conversation-checkpoints",
    )
    ends = totals.select(F.explode("ends").alias("e")).select("e.*")
    held = cut.select("conv_id", "part", "block", "rows").join(ends, ["part", "block"])
    exits = held.select("conv_id", "part", "block", F.arrow_udf(_exits, "array<int>")("rows", "vector").alias("exits"))
    entered = _in_order(exits, "exits").select(
        F.explode(F.arrow_udf(_entries, from_arrow_type(ENTRIES))("blocks")).alias("e")
    ).select("e.*")
    done = held.join(entered, ["part", "block"]).select(
        "conv_id", "part", "block",
        F.arrow_udf(_walked, from_arrow_type(WALKED))("rows", "vector", "entry", "last").alias("w"),
    ).select("conv_id", "part", "block", "w.*")
    return totals.drop("ends"), settle(done, "conversation-edits")


def turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired turns with their texts: ``conv_id, part, block, nth, role, text``."""
    told = edits.select("conv_id", "part", "block", F.posexplode("turns").alias("nth", "t"))
    told = told.select("conv_id", "part", "block", "nth", "t.*")
    texts = rows.select("conv_id", F.col("role").alias("old"), _digest(F.col("text")).alias("digest"), "text")
    texts = texts.groupBy("conv_id", "old", "digest").agg(F.first("text").alias("text"))
    return _with(told, texts, "conv_id", "old", "digest").select(
        "conv_id", "part", "block", "nth", "role", F.coalesce("text", F.lit("")).alias("text")
    )


def _hashed(names: list[str], schema: pa.Schema):
    """Map function: sorted turns to a digest of each conversation, one row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, out = None, None, []
        for batch in batches:
            for row in batch.select(names).to_pylist():
                line = f"{row['role']}:{row['text']}".encode()
                if state is None or row["conv_id"] != conv:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = row["conv_id"], hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if state is not None:
            out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def digests(told: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. A digest takes its lines one
    after the other, so they stream through one task in order; none are held."""
    schema = T.StructType([told.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    names = ["conv_id", "role", "text"]
    ordered = told.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "nth")
    return ordered.mapInArrow(_hashed(names, to_arrow_schema(schema)), schema)


def audited(conversations: DataFrame) -> DataFrame:
    """Each conversation after ``damaged``: its faults, cheapest edits and repaired digest.

    A conversation without rows has zeros, no edits and the digest of nothing. A null
    ``conv_id`` is a conversation of its own.
    """
    rows = damaged(conversations)
    totals, edits = repaired(rows)
    listed = edits.groupBy("conv_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("part", "block", "audit"))), lambda b: b["audit"]
            ),
            "",
        ).alias("audit")
    )
    hashed = digests(turns(rows, edits))
    out = conversations.select("conv_id").distinct()
    for more in (totals, listed, hashed):
        out = _with(out, more, "conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
