"""Stream operators over several micro-batches, against batch or simulation."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, distinct, joins, topn, windows
from tidemark.session import scratch_path
from tidemark.sources.tables import register
from tidemark.streaming import stateful
from tidemark.streaming.late import batch_folders, split_late
from tidemark.streaming.run import drain, drain_batches

SCHEMA = "k long, ts timestamp, id long, kind string, v double, len long"


def rows_of(n=240, seed=3):
    rng = random.Random(seed)
    t, out = 1_700_000_000, []
    for i in range(n):
        t += rng.choice([0, 1, 1, 2, 4, 15])
        out.append((rng.randrange(1, 5), t, i, rng.choice("abc"), float(rng.randrange(9)),
                    rng.randrange(1, 8) * 1_000_000))
    return out


def frame(spark, rows):
    raw = spark.createDataFrame(
        rows, "k long, s long, id long, kind string, v double, len long"
    )
    return raw.select("k", F.timestamp_seconds("s").alias("ts"), "id", "kind", "v", "len")


def feed(spark, batches):
    """A stream that reads one of the batches per trigger, in order."""
    path = scratch_path(spark, "feed")
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


END = [[(-1, t, -1, "end", 0.0, 0)] for t in (7_000_000_000, 8_000_000_000)]


def run(df):
    """Results of a keyed operator; nothing may have come too late."""
    out = drain(df, "t")
    assert stateful.late_rows(out, "k").isEmpty()
    return stateful.results(out)


def cut(rows, parts=3):
    step = -(-len(rows) // parts)
    return [rows[i:i + step] for i in range(0, len(rows), step)]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def stream(spark, rows):
    shuffled = random.Random(9).sample(rows, len(rows))
    return feed(spark, [*cut(shuffled), *END]).withWatermark("ts", "100000 seconds")


@pytest.fixture(scope="module")
def batch(spark, rows):
    return frame(spark, rows).cache()


def bag(df, *cols):
    return collections.Counter(tuple(r) for r in df.filter("k > 0").select(*cols).collect())


def test_order_timeouts(stream, batch):
    created = F.col("kind") == "a"
    got = run(stateful.order_timeouts(stream, "k", "ts", "id", created, "6 seconds"))
    want = alerts.order_timeouts(batch, "k", ["ts", "id"], created, "6 seconds")
    assert bag(got, "k", "tie", "fires_us") == bag(
        want, "k", "id", F.unix_micros("fires_at")
    )
    assert got.count() > 5


def test_rising_runs(stream, batch):
    got = run(stateful.rising_runs(stream, "k", "ts", "id", "v", "3 seconds"))
    want = alerts.rising_runs(batch, "k", ["ts", "id"], "v", "3 seconds")
    assert bag(got, "k", "opened_us", "n") == bag(want, "k", F.unix_micros("opened_at"), "n")


def test_reconcile(stream, batch):
    is_pay = F.col("kind") == "c"
    is_end = F.col("ts") > F.timestamp_seconds(F.lit(6_000_000_000))
    pays = stream.filter(F.when(is_end, True).otherwise(is_pay))
    orders = stream.filter(F.when(is_end, True).otherwise(~is_pay))
    got = run(stateful.reconcile(orders, pays, "k", "ts", "id", "5 seconds"))
    want = joins.reconcile(
        batch.filter(~is_pay), batch.filter(is_pay), "k", ["ts", "id"], wait="5 seconds"
    )
    assert bag(got, "k", "side", "superseded", "first_tie", "second_tie") == bag(
        want, "k", "side", "superseded", "first.id", "second.id"
    )


def gate_simulation(rows, first_close):
    out, state = set(), collections.defaultdict(lambda: [False, []])
    for r in sorted(rows, key=lambda r: (r[1], r[3] != "a", r[2])):
        s, t = state[r[0]], r[1] * 1_000_000
        s[1].sort()
        while s[1] and s[1][0] <= t:
            s[1].pop(0)
            s[0] = s[0] and bool(s[1]) and not first_close
        if r[3] == "a":
            s[0] = True
            s[1].append(t + r[5])
        elif s[0]:
            out.add(r[2])
    return out


@pytest.mark.parametrize("mode", ["union", "first_close"])
def test_gate(stream, batch, rows, mode):
    is_switch = F.col("kind") == "a"
    is_end = F.col("ts") > F.timestamp_seconds(F.lit(6_000_000_000))
    readings = stream.filter(F.when(is_end, True).otherwise(~is_switch))
    switches = stream.filter(F.when(is_end, True).otherwise(is_switch))
    got = run(stateful.gate(readings, switches, "k", "ts", "id", "len", mode=mode))
    ids = {r["tie"] for r in got.filter("k > 0").collect()}
    assert ids == gate_simulation(rows, mode == "first_close")
    if mode == "union":
        switches = batch.filter(is_switch).select("k", "ts", "len")
        want = joins.gate(batch.filter(~is_switch), switches, "k", "ts", "len")
        assert ids == {r["id"] for r in want.collect()}


def test_sliding_counts_and_top_n(stream, batch):
    counts = windows.sliding_count(
        stream.filter("kind <> 'c'"), "ts", "60 seconds", "20 seconds", ["k"]
    )  # the end rows are of kind "end"
    path = scratch_path(stream.sparkSession, "top")
    write = batch_folders(path)
    drain_batches(
        counts, "top",
        lambda b, i: write(topn.top_n(b, ["window_end"], "n", 2, ["k"]), i),
    )
    got = stream.sparkSession.read.parquet(path)
    want = topn.top_n(
        windows.sliding_count(
            batch.filter("kind <> 'c'"), "ts", "60 seconds", "20 seconds", ["k"]
        ),
        ["window_end"], "n", 2, ["k"],
    )
    cols = ["k", "window_end", "n", "rank"]
    assert bag(got, *cols) == bag(want, *cols)


def test_sql_over_a_registered_stream(stream, batch):
    register(stream, "t_stream")
    out = stream.sparkSession.sql(
        "SELECT k, unix_millis(window.end) AS window_end, count(*) AS n FROM t_stream "
        "GROUP BY k, window(ts, '60 seconds', '20 seconds')"
    )
    want = windows.count(batch, "ts", "60 seconds", ["k"], slide="20 seconds")
    cols = ["k", "window_end", "n"]
    assert bag(drain(out, "sql"), *cols) == bag(want, *cols)


def test_two_stage_visitors(stream, batch):
    got = drain(distinct.two_stage(stream, "ts", "60 seconds", "k"), "t")
    want = distinct.exact(batch, "ts", "60 seconds", "k")
    rows = sorted(tuple(r) for r in got.filter("window_end < 6000000000000").collect())
    assert rows == sorted(tuple(r) for r in want.select("window_end", "uv").collect())


def test_approximate_visitors(batch):
    approx = distinct.approximate(batch, "ts", "60 seconds", "k").collect()
    exact = {r["window_end"]: r["uv"] for r in distinct.exact(batch, "ts", "60 seconds", "k").collect()}
    assert {r["window_end"]: r["uv"] for r in approx} == exact


def test_update_mode_fires_early(spark, rows):
    """Every micro-batch reports the counts it changed, before the window ends."""
    counts = windows.count(
        feed(spark, cut(rows)).withWatermark("ts", "0 seconds"), "ts", "1 day", ["k"]
    )
    path = scratch_path(spark, "early")
    drain_batches(counts, "early", batch_folders(path), mode="update")
    seen = spark.read.parquet(path).collect()
    totals, want = collections.Counter(), set()
    for part in cut(rows):
        touched = set()
        for r in part:
            end = (r[1] // 86_400 + 1) * 86_400_000
            totals[(r[0], end)] += 1
            touched.add((r[0], end))
        want |= {(*k, totals[k]) for k in touched}
    assert {(r["k"], r["window_end"], r["n"]) for r in seen} == want


def test_ingest_time_windows(spark, rows):
    stamped = windows.ingest_time(feed(spark, cut(rows))).withWatermark("ingest_ts", "0 seconds")
    out = scratch_path(spark, "ingest")
    drain_batches(
        windows.count(stamped, "ingest_ts", "5 seconds", ["k"]), "ingest",
        batch_folders(out), mode="complete",
    )
    last = spark.read.parquet(out).filter(
        F.col("batch") == spark.read.parquet(out).agg(F.max("batch")).first()[0]
    )
    assert last.agg(F.sum("n")).first()[0] == len(rows)


def test_interval_join(spark):
    orders = [(1, 100, 0, "o", 0.0, 0), (2, 103, 1, "o", 0.0, 0), (3, 109, 2, "o", 0.0, 0)]
    pays = [(1, 105, 3, "p", 0.0, 0), (2, 112, 4, "p", 0.0, 0), (4, 110, 5, "p", 0.0, 0)]
    end = [(-1, 900, -1, "end", 0.0, 0)]
    left = feed(spark, [orders, end]).withWatermark("ts", "0 seconds")
    right = feed(spark, [pays, end]).withWatermark("ts", "0 seconds")
    got = drain(stateful.reconcile_by_join(left, right, "k", "ts", "5 seconds"), "join")
    assert {(r["k"], r["side"]) for r in got.filter("k > 0").collect()} == {
        (1, "matched"), (2, "order"), (2, "pay"), (3, "order"), (4, "pay"),
    }


def test_late_rows_leave_to_the_side(spark):
    """Lateness is judged row by row, also within and across micro-batches."""
    times = [100, 130, 95, 129, 160, 101, 158, 90]
    rows = [(1, t, i, "a", 0.0, 0) for i, t in enumerate(times)]
    for parts in (1, 3):
        base = scratch_path(spark, "late")
        run = split_late(
            ["id"], "ts", f"{base}/state",
            batch_folders(f"{base}/main"), batch_folders(f"{base}/late"),
            delay="10 seconds",
        )
        drain_batches(feed(spark, cut(rows, parts)), "late", run)
        late = {r["id"] for r in spark.read.parquet(f"{base}/late").collect()}
        main = {r["id"] for r in spark.read.parquet(f"{base}/main").collect()}
        before = [None, *itertools.accumulate(times, max)]
        want = {i for i, t in enumerate(times) if i and t < before[i] - 10}
        assert late == want and main == set(range(len(times))) - want


def test_allowed_lateness(spark):
    """Windows of 10 s, delay 10 s, 10 s of updates, one micro-batch per list."""
    t = 1_700_000_000
    batches = [
        [t + 1, t + 3],          # window ends t+10
        [t + 21],                # watermark t+11 from the next batch on: closed
        [t + 4, t + 5],          # late, still counted: two updates
        [t + 8],                 # one more
        [t + 45],                # watermark t+35: the window is gone
        [t + 46],
        [t + 2],                 # dropped
    ]
    ids = itertools.count()
    data = [[(1, s, next(ids), "a", 0.0, 0) for s in b] for b in batches]
    out = stateful.allowed_lateness_counts(
        feed(spark, data), "k", "ts", "10 seconds", delay="10 seconds", allowed="10 seconds"
    )
    got = drain(out, "lateness").filter(F.col("window_end") == (t + 10) * 1000)
    assert sorted((r["kind"], r["n"]) for r in got.collect()) == [
        ("first", 2), ("update", 3), ("update", 4), ("update", 5),
    ]


def test_state_with_ttl_is_planned(stream):
    """TTL follows the clock, so such a stream runs until it is stopped: plan only."""
    out = stateful.jumps(
        stream, "k", "ts", "id", "v", 4.0, first_is_zero=False, ttl_ms=3_600_000
    )
    assert out.isStreaming and out.columns == ["k", "ts_us", "tie", "previous", "value"]


def test_rows_behind_the_watermark_come_out_as_late(spark):
    t = 1_700_000_000
    batches = [[(1, t + 50, 0, "a", 1.0, 0)], [(1, t + 45, 1, "a", 9.0, 0), (1, t + 10, 2, "a", 5.0, 0)], *END]
    stream = feed(spark, batches).withWatermark("ts", "10 seconds")
    out = drain(stateful.jumps(stream, "k", "ts", "id", "v", 4.0, first_is_zero=False), "late")
    assert [tuple(r) for r in stateful.late_rows(out, "k").collect()] == [(1, (t + 10) * 1_000_000, 2)]
    assert [r["tie"] for r in stateful.results(out).filter("k > 0").collect()] == [0]


def test_a_stopped_stream_goes_on_where_it_was(spark, rows):
    """Half of the input, a stop, then the rest from the same checkpoint."""
    path = scratch_path(spark, "restart")
    parts = [*cut(rows, 4), *END]
    for some in (parts[:2], parts[2:]):
        for part in some:
            frame(spark, part).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        out = stateful.jumps(
            stream.withWatermark("ts", "0 seconds"), "k", "ts", "id", "v", 4.0, first_is_zero=False
        )
        writer = out.writeStream.format("parquet").option("path", f"{path}/out")
        writer = writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
        writer.start().awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{path}/out").filter("k > 0")
    last, want = {}, set()
    for k, t, i, _, v, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if k in last and abs(v - last[k]) > 4.0:
            want.add((k, i))
        last[k] = v
    late = {(r["k"], r["late_tie"]) for r in got.filter("late_us is not null").collect()}
    assert not late
    assert {(r["k"], r["tie"]) for r in got.collect()} == want
