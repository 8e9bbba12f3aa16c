"""Change logs of greatest values, sliding distinct counts, and their stream parts."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.functions.hashing import bit_offset
from tidemark.operators import distinct, ranklog, rolling
from tidemark.operators.skew import SkewPolicy
from tidemark.sinks import committed
from tidemark.streaming import processors as P
from tidemark.streaming import stateful
from tidemark.streaming.run import replay_arrivals
from tidemark.streaming.totals import running_totals

S = 1_000_000
POLICIES = {"whole": SkewPolicy(), "split": SkewPolicy(max_hot=60, min_rows=8, oversplit=3)}


@pytest.mark.parametrize("policy", POLICIES)
@pytest.mark.parametrize("n", [1, 3])
def test_top_changelog(spark, policy, n):
    make = random.Random(n)
    rows = [
        (1 if i % 3 == 0 else make.choice([2, 3, None]), i, make.choice([None, *range(12)]))
        for i in range(150)
    ]
    df = spark.createDataFrame(rows, "k long, id long, v long").withColumn(
        "ts", F.timestamp_seconds(F.col("id") / 2)
    )
    out = rolling.top_changelog(df, ["k"], ["ts", "id"], "v", n, policy=POLICIES[policy])
    got = sorted(map(repr, (tuple(r) for r in out.select("k", "id", "is_add", "value", "rank").collect())))
    want, top = [], {}
    for k, i, v in rows:
        if v is None:
            continue
        old = top.get(k, [])
        new = sorted([*old, v], reverse=True)[:n]
        for place in range(len(new)):
            before = old[place] if place < len(old) else None
            if before != new[place]:
                if before is not None:
                    want.append((k, i, False, before, place + 1))
                want.append((k, i, True, new[place], place + 1))
        top[k] = new
    assert got == sorted(map(repr, want))


def test_top_log_merges_partial_accumulators():
    merge = P.TopLog.merged
    assert merge([5, 3], [4], 2) == merge(merge([5], [4], 2), [3], 2) == [5, 4]
    assert merge([], [], 2) == []
    assert merge([7], [7, 1], 2) == [7, 7]


def windows_of(rows, size, slide):
    out = {}
    for t, who in rows:
        pane = t // slide * slide
        for end in range(pane + slide, pane + size + slide, slide):
            out.setdefault(end * 1000, set()).update([who] if who is not None else [])
    return out


@pytest.fixture(scope="module")
def visits(spark):
    make = random.Random(9)
    rows = [(make.randrange(40_000), make.choice([None, *range(900)])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "t long, who long").withColumn("ts", F.timestamp_seconds("t"))
    return rows, df


@pytest.mark.parametrize("slide", [None, "15 minutes"])
def test_bitmap_windows(spark, visits, slide):
    rows, df = visits
    names = {r.who: r.b for r in spark.range(900).select(F.col("id").alias("who"), bit_offset(F.col("id").cast("string")).alias("b")).collect()}
    want = windows_of(rows, 3600, 900 if slide else 3600)
    got = {r.window_end: r.uv for r in distinct.bitmap(df, "ts", "1 hour", "who", slide=slide).collect()}
    assert got == {w: len({names[x] for x in some}) for w, some in want.items()}


def test_sketches_stay_within_their_error(visits):
    rows, df = visits
    want = windows_of(rows, 3600, 900)
    got = {r.window_end: r.uv for r in distinct.sketched(df, "ts", "1 hour", "who", slide="15 minutes").collect()}
    assert set(got) == set(want)
    assert all(abs(got[w] - len(x)) <= 5 * 1.04 / 64 * len(x) + 1 for w, x in want.items())
    with pytest.raises(ValueError):
        distinct.sketched(df, "ts", "1 hour", "who", slide="7 minutes")


class FakeMap:
    def __init__(self):
        self.held = {}

    def containsKey(self, k):
        return k in self.held

    def getValue(self, k):
        return self.held[k]

    def updateValue(self, k, v):
        self.held[k] = v

    def clear(self):
        self.held = {}


def test_bitmap_state_is_bounded_and_goes_with_its_window():
    machine, state, timers = P.BitmapChunks(), FakeMap(), []
    machine.fields = ("w", "part", "t", "tie", "fresh")
    machine.init(SimpleNamespace(getMapState=lambda *a: state, registerTimer=timers.append))
    make = random.Random(1)
    bits = [make.randrange(1 << 14) for _ in range(5000)] + [-1, -1]
    rows = [Row(_t=i, _tie=i, bit=b) for i, b in enumerate(bits)]
    out = []
    for at in range(0, len(rows), 500):
        out += machine.handleInputRows((3_600_000, 0), iter(rows[at : at + 500]), None)
    seen, want = set(), []
    for b in bits:
        want.append(b not in seen)
        seen.add(b)
    assert [r["fresh"] for r in out] == want
    assert len(state.held) == len({b >> 12 for b in bits})
    assert {len(v[0]) for v in state.held.values()} == {512}
    assert set(timers) == {3_600_000}
    at = SimpleNamespace(getExpiryTimeInMs=lambda: 3_600_000)
    assert list(machine.handleExpiredTimer((3_600_000, 0), None, at)) == []
    assert not state.held


def test_totals_carry_over_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    count = running_totals(f"{tmp_path}", ["us", "id"], F.col("v"), "n", at_us="us")
    batches = [
        [(1000, 1, 1, 1), (1000, 2, 2, 1)],
        [],
        [(1000, 500_000, 3, 1), (2000, 1_500_000, 4, 1)],
        [(2000, 1_600_000, 5, 0), (2000, 1_700_000, 6, 1)],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "window_end long, us long, id long, v long")
        count(df, i)
        if i == 2:
            count(df, i)
    got = spark.read.parquet(f"{tmp_path}/rows").select("id", "n").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 1), (6, 2)]
    last = spark.read.parquet(f"{tmp_path}/totals/batch=3").collect()
    assert [tuple(r) for r in last] == [(2000, 2)]


def ranking_log(rows, size, slide, n):
    """(t, id, item) rows in order to their changes of each window's first ``n`` items."""
    out, counts, tops = [], {}, {}
    for t, i, item in rows:
        pane = t // slide * slide
        for end in range(pane + slide, pane + size + slide, slide):
            own = counts.setdefault(end, {})
            own[item] = own.get(item, 0) + 1
            order = sorted(own.items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:n]
            old = tops.get(end, [])
            for place, pair in enumerate(order):
                before = old[place] if place < len(old) else None
                if before != pair:
                    if before:
                        out.append((end * 1000, i, False, *before, place + 1))
                    out.append((end * 1000, i, True, *pair, place + 1))
            tops[end] = order
    return out


@pytest.mark.parametrize("seed,items,slide", [(1, 6, 600), (2, 60, 3600), (3, 3, 1200)])
def test_ranked_changelog(spark, seed, items, slide):
    """A window that holds most rows lies in several ranges; ties and null items rank."""
    make = random.Random(seed)
    times = sorted(make.choice([make.randrange(3600), make.randrange(20_000)]) for _ in range(900))
    rows = [(t, i, make.choice([None, *range(items)])) for i, t in enumerate(times)]
    df = spark.createDataFrame([*rows, (None, 10_000, 1)], "t long, id long, item long").withColumn(
        "ts", F.timestamp_seconds("t")
    )
    out = ranklog.ranked_changelog(
        df.repartition(5), "ts", ["ts", "id"], "item", "1 hour", 3, slide=f"{slide} seconds"
    )
    got = out.select("window_end", "id", "is_add", "item", "n", "rank").collect()
    want = ranking_log(rows, 3600, slide, 3)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert ranklog.ranked_changelog(df.limit(0), "ts", ["ts", "id"], "item", "1 hour", 3).count() == 0


def test_rankings_of_stretches_merge():
    make = random.Random(5)
    for _ in range(50):
        pairs = [(make.randrange(1, 9), make.choice([None, 1, 2, 3, 4])) for _ in range(12)]
        cut = make.randrange(13)
        both = ranklog.best(ranklog.best(pairs[:cut], 3) + ranklog.best(pairs[cut:], 3), 3)
        assert both == ranklog.best(pairs, 3)


def test_committed_sink_ignores_failed_tasks_and_repeated_batches(spark, tmp_path):
    """Files of a task that died, of an aborted batch and of a second commit are not read."""
    folder = str(tmp_path / "sink")
    sink = committed.CommittedWriter(folder)
    rows = [Row(doc_id=str(i), document="é") for i in range(2500)]
    first = [sink.write(iter(rows[:1200])), None, sink.write(iter(rows[1200:1500]))]
    assert len(first[0].files) == 2
    sink.write(iter(rows[:700]))  # a first try that never reported
    sink.commit(first, 0)
    sink.commit([sink.write(iter(rows[:1500]))], 0)  # the batch once more
    sink.abort([sink.write(iter(rows[1500:]))], 1)
    sink.commit([sink.write(iter(rows[1500:])), sink.write(iter(()))], 1)
    got = committed.committed(spark, folder, "doc_id string, document string").collect()
    assert sorted((int(r.doc_id), r.document, r.batch) for r in got) == [
        (i, "é", int(i >= 1500)) for i in range(2500)
    ]


def test_state_shrinks_while_a_bounded_stream_runs(spark, tmp_path):
    """With a delay of an hour a stream over ten days never holds more than a slice."""
    make = random.Random(12)
    rows = [(i % 7, 1_700_000_000 + i * 2000 + make.randrange(3000), i) for i in range(430)]
    df = spark.createDataFrame(rows, "k long, t long, id long").select(
        "k", "id", F.timestamp_seconds("t").alias("ts"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 2000).alias("arrival")
    )
    replay = replay_arrivals(spark, df, "arrival", lambda x: x.withWatermark("ts", "1 hour"), slices=8)
    out = stateful.in_order(replay.rows.filter(replay.present()), "k", "ts", "id")
    held = []
    for step in replay.finish:
        step()
        query = (
            out.writeStream.format("parquet").option("path", f"{tmp_path}/rows")
            .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        held += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    drained = spark.read.schema(out.schema).parquet(f"{tmp_path}/rows")
    assert drained.count() == 430 and stateful.late_rows(drained, "k").count() == 0
    # A waiting row is an entry and a timer: 54 rows a slice, and those of the last hour.
    assert max(held) < 2.5 * 2 * 54 < 2 * 430
    assert held[-1] <= 2
