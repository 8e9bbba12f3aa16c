"""Stream forms of the stateful operators: DataFrame in, DataFrame out.

Inputs are streams with a watermark on ``ts``, whose delay is how far rows may be
out of order: rows wait in state until the watermark passes them and are then
handled in order of time. ``tie`` is a long column that orders rows of equal time.
Rows without a time are left out. Event times leave as ``*_us`` microseconds.

Nothing is dropped in silence: a row behind the watermark leaves as a row with
``late_us`` and ``late_tie``; ``results`` and ``late_rows`` part the two.

A ``ttl_ms`` drops state of quiet keys by the clock. Such a stream handles rows in
order within a micro-batch only, and always has another batch to run, so it is for
continuous triggers, not ``availableNow``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.hashing import bit_offset
from tidemark.functions.times import micros
from tidemark.operators.windows import WINDOW_END, window_end_ms
from tidemark.streaming import processors as P


LATE = ("late_us", "late_tie")


def results(out: DataFrame) -> DataFrame:
    """An operator's results without the rows that came too late."""
    return out.filter(F.col(LATE[0]).isNull()).drop(*LATE)


def late_rows(out: DataFrame, key: str) -> DataFrame:
    """Key, time and tie of the rows that came too late."""
    return out.filter(F.col(LATE[0]).isNotNull()).select(key, *LATE)


def _prepare(df: DataFrame, key: str, ts: str, tie: str, **columns: Column) -> DataFrame:
    # Without the event-time column Spark passes late rows on instead of dropping them.
    return df.filter(F.col(ts).isNotNull()).select(
        F.col(key),
        F.unix_micros(ts).alias("_t"),
        F.col(tie).cast("long").alias("_tie"),
        *[c.alias(n) for n, c in columns.items()],
    )


#: Keys are dealt over this many groups, each of which is one group of the stream's state.
GROUPS = 1024


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch by their first column, those of one value packed."""
    for batch in batches:
        groups, *columns = (c.to_pylist() for c in batch.columns)
        of_group = defaultdict(list)
        for group, row in zip(groups, zip(*columns, strict=True), strict=True):
            of_group[group].append(row)
        packed = pa.array([P.pack(rows) for rows in of_group.values()], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(of_group.keys(), pa.int32()), packed], ["bucket", "packed"]
        )


def _unpacked(schema: T.StructType):
    arrow = to_arrow_schema(schema)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                columns = zip(*P.unpack(value), strict=True)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return unpacked


def _output(df: DataFrame, keys: Sequence[str], schema: str) -> T.StructType:
    out = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(schema).fields)
    for f in out.fields:
        f.nullable = True
    return out


WITH_LATE = f", {LATE[0]} long, {LATE[1]} long"


def _run(df: DataFrame, keys: Sequence[str], machine: P.Emitting, schema: str) -> DataFrame:
    """Keys dealt over groups. Rows cross to Python and state as packed values, many in one."""
    if getattr(machine, "ttl_ms", None):
        out = _output(df, keys, schema)
        machine.fields = tuple(out.names)
        return df.groupBy(*keys).transformWithState(machine, out, "Append", "ProcessingTime")
    out = _output(df, keys, schema + WITH_LATE)
    columns = [c for c in df.columns if c not in keys]
    processor = P.Dealt(machine, len(keys), tuple(columns))
    processor.fields = tuple(out.names)
    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).cast("int")
    # Dealt first: rows are packed many at a time, and not by the few tasks that scan a file.
    rows = df.select(group.alias("bucket"), *keys, *columns).repartition("bucket")
    packed = rows.mapInArrow(_packed, "bucket int, packed binary")
    done = packed.groupBy("bucket").transformWithStateInPandas(
        processor, "packed binary", "Append", "EventTime"
    )
    return done.mapInArrow(_unpacked(out), out)


def _run_held(df: DataFrame, keys: Sequence[str], machine: P.Emitting, schema: str) -> DataFrame:
    """Each key a group of its own, for machines with much state a key."""
    out = _output(df, keys, schema + WITH_LATE)
    columns = [f for f in df.schema if f.name not in keys]
    row = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in columns)
    processor = P.Held(machine, tuple(f.name for f in columns), row)
    processor.fields = tuple(out.names)
    return df.groupBy(*keys).transformWithState(processor, out, "Append", "EventTime")


def _run_plain(df: DataFrame, keys: Sequence[str], processor: P.Emitting, schema: str) -> DataFrame:
    out = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(schema).fields)
    processor.fields = tuple(out.names)
    return df.groupBy(*keys).transformWithState(processor, out, "Append", "EventTime")


def jumps(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    value: str,
    threshold: float,
    *,
    first_is_zero: bool,
    ttl_ms: int | None = None,
) -> DataFrame:
    rows = _prepare(df, key, ts, tie, value=F.col(value).cast("double"))
    return _run(
        rows,
        [key],
        P.Jumps(threshold, first_is_zero, ttl_ms),
        "ts_us long, tie long, previous double, value double",
    )


def timers(df: DataFrame, key: str, ts: str, tie: str, after: str) -> DataFrame:
    rows = _prepare(df, key, ts, tie)
    return _run(rows, [key], P.Callbacks(micros(after)), "fires_ms long")


ARMED = "opened_us long, fires_us long, n long"


def rising_runs(
    df: DataFrame, key: str, ts: str, tie: str, value: str, hold: str
) -> DataFrame:
    rows = _prepare(df, key, ts, tie, value=F.col(value).cast("double"))
    return _run(rows, [key], P.Armed(micros(hold), rising=True), ARMED)


def repeated_failures(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    failed: Column,
    succeeded: Column,
    hold: str,
    *,
    at_least: int = 3,
) -> DataFrame:
    """Rows that are neither failure nor success change nothing: filter them out."""
    arms, resets = (F.coalesce(c, F.lit(False)) for c in (failed, succeeded))
    rows = _prepare(df, key, ts, tie, arms=arms, resets=resets)
    return _run(rows, [key], P.Armed(micros(hold), at_least), ARMED)


def order_timeouts(
    df: DataFrame, key: str, ts: str, tie: str, created: Column, wait: str
) -> DataFrame:
    rows = _prepare(df, key, ts, tie, created=F.coalesce(created, F.lit(False)))
    return _run(
        rows,
        [key],
        P.OrderSlot(micros(wait)),
        "create_us long, tie long, fires_us long",
    )


def reconcile(
    orders: DataFrame, pays: DataFrame, key: str, ts: str, tie: str, wait: str
) -> DataFrame:
    """One-slot matching of two streams that share a watermark column."""
    both = _prepare(orders, key, ts, tie, side=F.lit("order")).unionByName(
        _prepare(pays, key, ts, tie, side=F.lit("pay"))
    )
    return _run(
        both,
        [key],
        P.Reconciler(micros(wait)),
        "side string, superseded boolean, first_us long, first_tie long, "
        "second_us long, second_tie long",
    )


def reconcile_by_join(
    orders: DataFrame, pays: DataFrame, key: str, ts: str, wait: str
) -> DataFrame:
    """Full outer interval join, for keys with one event per side.

    Both streams need a watermark on ``ts``. Stays in the JVM.
    """
    o = orders.select(F.col(key).alias("o_key"), F.col(ts).alias("o_ts"))
    p = pays.select(F.col(key).alias("p_key"), F.col(ts).alias("p_ts"))
    near = F.expr(
        f"o_key = p_key AND p_ts >= o_ts - INTERVAL {wait} AND p_ts <= o_ts + INTERVAL {wait}"
    )
    side = (
        F.when(F.col("p_key").isNull(), "order")
        .when(F.col("o_key").isNull(), "pay")
        .otherwise("matched")
    )
    return o.join(p, near, "full_outer").select(
        F.coalesce("o_key", "p_key").alias(key),
        side.alias("side"),
        F.unix_micros("o_ts").alias("order_us"),
        F.unix_micros("p_ts").alias("pay_us"),
    )


def gate(
    readings: DataFrame,
    switches: DataFrame,
    key: str,
    ts: str,
    tie: str,
    duration_us: str,
    *,
    mode: str = "union",
) -> DataFrame:
    both = _prepare(
        readings, key, ts, tie, is_switch=F.lit(False), duration_us=F.lit(None).cast("long")
    ).unionByName(
        _prepare(
            switches, key, ts, tie, is_switch=F.lit(True),
            duration_us=F.col(duration_us).cast("long"),
        )
    )
    return _run(both, [key], P.Gate(mode), "ts_us long, tie long")


def match_sequence(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    steps: Sequence[Column],
    *,
    within: str | None = None,
    on_timeout: bool = False,
) -> DataFrame:
    """Outcome with the times and ties of the rows of each match or timed-out attempt."""
    fits = F.array(*[F.coalesce(s, F.lit(False)) for s in steps])
    rows = _prepare(df, key, ts, tie, fits=fits)
    bound = micros(within) if within else None
    if on_timeout and bound is None:
        raise ValueError("timeouts need a time bound")
    return _run(
        rows,
        [key],
        P.Sequences(len(steps), bound, on_timeout),
        "outcome string, times_us array<long>, ties array<long>",
    )


def min_max_changelog(
    df: DataFrame, key: str, ts: str, tie: str, value: str, *, ttl_ms: int | None = None
) -> DataFrame:
    rows = _prepare(df, key, ts, tie, value=F.col(value).cast("long"))
    return _run(
        rows, [key], P.MinMaxLog(ttl_ms), "tie long, is_add boolean, lo long, hi long"
    )


def allowed_lateness_counts(
    df: DataFrame, key: str, ts: str, size: str, *, delay: str, allowed: str
) -> DataFrame:
    """Window counts with late updates; ``df`` must not have a watermark yet."""
    lag_us = micros(allowed) + micros(size)
    spark_delay = micros(delay) + lag_us
    rows = (
        df.withWatermark(ts, f"{spark_delay // 1000} milliseconds")
        .select(F.col(key), window_end_ms(ts, size).alias(WINDOW_END), F.col(ts))
    )
    return _run_plain(
        rows,
        [key, WINDOW_END],
        P.LateWindow(lag_us // 1000, micros(allowed) // 1000),
        "kind string, n long",
    )


#: A window's bitmap is spread over this many keys.
BITMAP_PARTS = 64


def bitmap_marks(
    df: DataFrame, ts: str, tie: str, visitor: str, size: str, *, parts: int = BITMAP_PARTS
) -> DataFrame:
    """Each row with whether it sets a new bit of its window's 2^29-bit map: ``fresh``.

    The map is keyed state in chunks of 2^12 bits that exist once they are needed. Its
    chunks are dealt over ``parts`` keys, so a window is the work of many tasks, and a
    key's state is at most ``2^29 / 8 / parts`` bytes. Null visitors share one place.
    """
    bit = F.coalesce(bit_offset(F.col(visitor).cast("string")), F.lit(-1)).cast("long")
    chunk = F.shiftright(bit, P.BitmapChunks.CHUNK_BITS)
    keyed = df.withColumns(
        {WINDOW_END: window_end_ms(ts, size), "part": F.pmod(chunk, F.lit(parts)).cast("long")}
    )
    rows = keyed.filter(F.col(ts).isNotNull()).select(
        WINDOW_END,
        "part",
        F.unix_micros(ts).alias("_t"),
        F.col(tie).cast("long").alias("_tie"),
        bit.alias("bit"),
    )
    return _run_held(rows, [WINDOW_END, "part"], P.BitmapChunks(), "ts_us long, tie long, fresh boolean")


def top_changelog(df: DataFrame, key: str, ts: str, tie: str, value: str, n: int) -> DataFrame:
    """Remove-old and add-new rows for the changed places of each key's ``n`` greatest values."""
    rows = _prepare(df, key, ts, tie, value=F.col(value).cast("long"))
    return _run(rows, [key], P.TopLog(n), "tie long, is_add boolean, value long, rank int")


def early_fire(df: DataFrame, key: str, ts: str, tie: str, size: str, every: str) -> DataFrame:
    """Running counts of a window at each ``every`` after its first row, by timers."""
    rows = _prepare(df, key, ts, tie, end=window_end_ms(ts, size))
    schema = f"{WINDOW_END} long, fire_at long, n long"
    return _run(rows, [key], P.EarlyFire(micros(every)), schema)


def in_order(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Each key's rows in order of time once the watermark has passed them; late rows aside."""
    return _run(_prepare(df, key, ts, tie), [key], P.Passed(), "ts_us long, tie long")


def gate_by_join(
    readings: DataFrame, switches: DataFrame, key: str, ts: str, duration: str
) -> DataFrame:
    """Readings inside ``[switch, switch + duration)`` of any switch of their key.

    A left semi interval join, all in the JVM. Each stream has its own watermark; a row
    leaves the state when both have passed what it could still meet. Null keys are a key.
    """
    s = switches.select(F.col(key).alias("_s_key"), F.col(ts).alias("_s_ts"))
    open_ = F.expr(
        f"`{key}` <=> _s_key AND `{ts}` >= _s_ts AND `{ts}` < _s_ts + INTERVAL {duration}"
    )
    return readings.join(s, open_, "left_semi")


def without_partner_by_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, within: str
) -> DataFrame:
    """Rows of ``left`` that no row of ``right`` with their key comes within ``within`` of.

    A left outer interval join that keeps what found no partner, all in the JVM. A null key
    has no partner.
    """
    r = right.select(F.col(key).alias("_r_key"), F.col(ts).alias("_r_ts"))
    near = F.expr(
        f"`{key}` = _r_key AND _r_ts >= `{ts}` - INTERVAL {within} AND _r_ts <= `{ts}` + INTERVAL {within}"
    )
    return left.join(r, near, "left_outer").filter(F.col("_r_ts").isNull()).select(*left.columns)
