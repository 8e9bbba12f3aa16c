"""State-machine operators against step-by-step simulation.

One key holds a third of the rows. Each operator runs with whole keys and with
that key cut into many slices; both must equal the simulation.
"""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, distinct, joins, lateness, patterns, rolling
from tidemark.operators.skew import SkewPolicy, find_hot, with_slice

POLICIES = {
    "whole": SkewPolicy(),
    "split": SkewPolicy(max_hot=60, min_rows=8, oversplit=3),
}
S = 1_000_000


@pytest.fixture(params=list(POLICIES))
def policy(request):
    return POLICIES[request.param]


def make(seed, n=400, kinds="abcd"):
    rng = random.Random(seed)
    rows, t = [], 1_700_000_000
    for i in range(n):
        t += rng.choice([0, 0, 1, 1, 2, 3, 5, 9, 30])
        key = 1 if i % 3 == 0 else rng.randrange(2, 8)
        rows.append((key, t * S, i, rng.choice(kinds), float(rng.randrange(0, 12))))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make(5)


@pytest.fixture(scope="module")
def df(spark, rows):
    mixed = rows[:]
    random.Random(6).shuffle(mixed)
    out = spark.createDataFrame(mixed, "k long, us long, id long, kind string, v double")
    return out.withColumn("ts", F.timestamp_micros("us")).drop("us").cache()


def per_key(rows):
    out = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out[r[0]].append(r)
    return out


ORDER = ["ts", "id"]


def armed(events, hold, at_least):
    """events: (t, arms, resets). Timers are handled after rows of their time."""
    out, opened, n = [], None, 0
    for t, arms, resets in [*events, (None, False, False)]:
        if opened is not None and (t is None or t > opened + hold):
            if n >= at_least:
                out.append((opened, n))
            opened, n = None, 0
        if resets:
            opened, n = None, 0
        elif arms:
            opened, n = (t if opened is None else opened), n + 1
    return out


def test_repeated_failures(df, rows, policy):
    got = alerts.repeated_failures(
        df, "k", ORDER, F.col("kind") == "a", F.col("kind") == "b", "15 seconds",
        at_least=2, policy=policy,
    )
    want = [
        (k, o, n)
        for k, rs in per_key(rows).items()
        for o, n in armed([(r[1], r[3] == "a", r[3] == "b") for r in rs], 15 * S, 2)
    ]
    got = [(r[0], r[1], r[2]) for r in got.select("k", F.unix_micros("opened_at"), "n").collect()]
    assert want and sorted(got) == sorted(want)


def test_rising_runs(df, rows, policy):
    want = []
    for k, rs in per_key(rows).items():
        prev, events = None, []
        for r in rs:
            fresh = prev is None or prev == 0.0
            events.append((r[1], not fresh and r[4] > prev, fresh or r[4] < prev))
            prev = r[4]
        want += [(k, o, n) for o, n in armed(events, 3 * S, 1)]
    got = alerts.rising_runs(df, "k", ORDER, "v", "3 seconds", policy=policy)
    got = [tuple(r) for r in got.select("k", F.unix_micros("opened_at"), "n").collect()]
    assert want and sorted(got) == sorted(want)


def test_order_timeouts(df, rows, policy):
    wait, want = 8 * S, []
    for k, rs in per_key(rows).items():
        slot, due = None, []

        def fire(upto):
            nonlocal slot
            for at in sorted(d for d in due if upto is None or d < upto):
                due.remove(at)
                if slot is not None and slot[3] == "a":
                    want.append((k, slot[2], at))
                slot = None

        for r in rs:
            fire(r[1])
            if r[3] != "a" or slot is None:
                slot = r
            due.append(r[1] + wait)
        fire(None)
    got = alerts.order_timeouts(
        df, "k", ORDER, F.col("kind") == "a", "8 seconds", policy=policy
    )
    got = [tuple(r) for r in got.select("k", "id", F.unix_micros("fires_at")).collect()]
    assert want and sorted(got) == sorted(want)


@pytest.mark.parametrize("wait", [None, "6 seconds"])
def test_reconcile(df, rows, policy, wait):
    orders = df.filter("kind in ('a', 'b')")
    pays = df.filter("kind = 'c'")
    limit = None if wait is None else 6 * S
    want = []
    for k, rs in per_key(r for r in rows if r[3] in "abc").items():
        held = None
        for r in rs:
            side = "pay" if r[3] == "c" else "order"
            if held and limit is not None and r[1] - held[1][1] > limit:
                want.append((k, held[0], False, held[1][2], None))
                held = None
            if held and held[0] != side:
                want.append((k, "matched", False, held[1][2], r[2]))
                held = None
                continue
            if held:
                want.append((k, side, True, held[1][2], None))
            held = (side, r)
        if held:
            want.append((k, held[0], False, held[1][2], None))
    got = joins.reconcile(orders, pays, "k", ORDER, wait=wait, policy=policy).select(
        "k", "side", "superseded", F.col("first.id"), F.col("second.id")
    )
    got = [tuple(r) for r in got.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = [i for r in got for i in r[3:] if i is not None]
    assert sorted(ids) == sorted(r[2] for r in rows if r[3] in "abc")


def test_without_partner(df, rows, policy):
    lhs = [r for r in rows if r[3] == "a"]
    rhs = [r for r in rows if r[3] == "c"]
    alone = {
        r[2] for r in lhs
        if not any(o[0] == r[0] and abs(o[1] - r[1]) <= 4 * S for o in rhs)
    }
    args = (df.filter("kind = 'a'"), df.filter("kind = 'c'"), "k", "ts", "4 seconds")
    got = {r["id"] for r in joins.without_partner(*args, policy=policy).collect()}
    assert got == alone and alone
    kept = joins.without_partner(*args, keep_matched=True, policy=policy).collect()
    assert {r["id"] for r in kept} == {r[2] for r in lhs} - alone


def test_gate(df, rows, policy):
    switches = df.filter("kind = 'd'").select(
        "k", "ts", (F.col("v") * S).cast("long").alias("len")
    )
    want = {
        r[2] for r in rows if r[3] != "d" and any(
            s[3] == "d" and s[0] == r[0] and s[1] <= r[1] < s[1] + s[4] * S for s in rows
        )
    }
    got = joins.gate(df.filter("kind <> 'd'"), switches, "k", "ts", "len", policy=policy)
    assert {r["id"] for r in got.collect()} == want and want


def test_match_sequence(df, rows, policy):
    steps = [("x", F.col("kind").isin("a", "b")), ("y", F.col("kind").isin("a", "c")),
             ("z", F.col("kind") != "d")]
    fits = [lambda r: r[3] in "ab", lambda r: r[3] in "ac", lambda r: r[3] != "d"]
    within, want = 9 * S, []
    for k, rs in per_key(rows).items():
        for i in range(len(rs)):
            if not fits[0](rs[i]):
                continue
            outcome, j = "matched", 1
            while j < 3:
                nxt = rs[i + j] if i + j < len(rs) else None
                if nxt is None or nxt[1] - rs[i][1] >= within:
                    outcome = "timeout"
                    break
                if not fits[j](nxt):
                    outcome = None
                    break
                j += 1
            if outcome:
                ids = [r[2] for r in rs[i:i + j]]
                want.append((outcome, *ids, *[None] * (3 - len(ids))))
    got = patterns.match_sequence(
        df, "k", ORDER, steps, within="9 seconds", on_timeout=True, policy=policy
    ).select("outcome", "x.id", "y.id", "z.id")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_changelog(df, rows, policy):
    want = []
    for k, rs in per_key(rows).items():
        old = None
        for r in rs:
            new = (r[4], r[4]) if old is None else (min(old[0], r[4]), max(old[1], r[4]))
            if new != old:
                if old:
                    want.append((k, r[2], False, *old))
                want.append((k, r[2], True, *new))
            old = new
    got = rolling.changelog(
        df, ["k"], ORDER, [("lo", "min", F.col("v")), ("hi", "max", F.col("v"))], policy=policy
    ).select("k", "id", "is_add", "lo", "hi")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_jumps_and_rolling(df, rows, policy):
    want_jump, want_sum = [], []
    for k, rs in per_key(rows).items():
        total, prev = 0.0, 0.0
        for r in rs:
            total += r[4]
            want_sum.append((k, r[2], total, rs[0][3]))
            if abs(r[4] - prev) > 5:
                want_jump.append(r[2])
            prev = r[4]
    got = rolling.jumps(df, ["k"], ORDER, "v", 5.0, first_is_zero=True, policy=policy)
    assert sorted(r["id"] for r in got.collect()) == sorted(want_jump)
    got = rolling.rolling(df, ["k"], ORDER, "v", "sum", policy=policy)
    got = [tuple(r) for r in got.select("k", "id", "v", "kind").collect()]
    assert sorted(got) == sorted(want_sum)


def arrivals(rows):
    """Arrival order with delays, as (arrival us, row)."""
    rng = random.Random(9)
    return [(r[1] + rng.randrange(0, 60) * S, r) for r in rows]


@pytest.fixture(scope="module")
def arriving(spark, rows):
    data = [(a, r[2], r[0], r[1]) for a, r in arrivals(rows)]
    out = spark.createDataFrame(data, "a long, id long, k long, us long")
    return out.select(
        F.timestamp_micros("a").alias("arrival"), "id", "k",
        F.timestamp_micros("us").alias("ts"),
    ).cache()


def test_lateness(arriving, rows, policy):
    size, delay, allowed = 10 * S, 5 * S, 20 * S
    seen, classes, behind = None, {}, set()
    results, counts = [], collections.Counter()
    firsts = collections.Counter()
    for _, r in sorted(arrivals(rows), key=lambda x: (x[0], x[1][2])):
        end = (r[1] // size + 1) * size
        wm = None if seen is None else seen - delay
        if wm is None or end > wm:
            kind = "on_time"
            firsts[(r[0], end // 1000)] += 1
            counts[(r[0], end // 1000)] += 1
        elif wm < end + allowed:
            kind = "update"
            counts[(r[0], end // 1000)] += 1
            n = counts[(r[0], end // 1000)]
            results.append((r[0], end // 1000, "first" if n == 1 else "update", n))
        else:
            kind = "dropped"
        classes[r[2]] = kind
        if seen is not None and r[1] < seen:
            behind.add(r[2])
        seen = r[1] if seen is None else max(seen, r[1])
    results += [(k, e, "first", n) for (k, e), n in firsts.items()]
    args = dict(delay="5 seconds", allowed="20 seconds", policy=policy)
    got = lateness.classify_lateness(arriving, ["arrival", "id"], "ts", "10 seconds", **args)
    assert {r["id"]: r["lateness"] for r in got.collect()} == classes
    assert set(classes.values()) == {"on_time", "update", "dropped"}
    late = lateness.behind_watermark(arriving, ["arrival", "id"], "ts", policy=policy)
    assert {r["id"] for r in late.filter("is_late").collect()} == behind
    got = lateness.allowed_lateness_results(
        arriving, "k", ["arrival", "id"], "ts", "10 seconds", **args
    )
    assert sorted(tuple(r) for r in got.collect()) == sorted(results)


def test_running_bitmap(df, rows, policy):
    want, seen = {}, collections.defaultdict(set)
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        end = (r[1] // (60 * S) + 1) * 60_000
        seen[end].add(r[0])
        want[r[2]] = len(seen[end])
    got = distinct.running_bitmap(
        df, "ts", ORDER, "1 minute", "k", keep=["id"], policy=policy
    )
    assert {r["id"]: r["uv"] for r in got.collect()} == want


def test_stray_times_do_not_gather_rows(spark):
    """One row at time 0 and one far ahead: slices of the others stay small."""
    rows = spark.range(20_000).select(
        F.lit(1).alias("k"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 1_000_000).alias("ts"),
        "id",
    )
    stray = spark.range(2).select(
        F.lit(1).alias("k"), F.timestamp_micros(F.col("id") * 4_000_000_000_000_000).alias("ts"), F.lit(-1).alias("id")
    )
    both = rows.unionByName(stray)
    hot = find_hot(both, ["k"], "ts", SkewPolicy(max_hot=10, min_rows=1000))
    sizes = [r["count"] for r in with_slice(both, "ts", hot).groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_002 and max(sizes) < 1000
