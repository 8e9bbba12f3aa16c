"""Ordered operators against brute force, whole and split into slices."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import Neighbour, Running, neighbours, running
from tidemark.operators.skew import SkewPolicy, find_hot

SPLIT = SkewPolicy(max_hot=50, min_rows=10, oversplit=3)
WHOLE = SkewPolicy()


def skewed_rows(n=600, seed=1):
    """Key 1 holds a third of the rows, with bursts and gaps in time."""
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rng.choice([1, 1, 2, 50, 400])
        key = 1 if i % 3 == 0 else rng.choice([None, 2, 3, 4, 5, 6, 7])
        value = None if rng.random() < 0.1 else rng.randrange(100)
        rows.append((key, t, i, value))
    return rows


SCHEMA = "k int, t long, id long, v int"


@pytest.fixture(scope="module")
def data(spark):
    rows = skewed_rows()
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, SCHEMA).repartition(5)


def brute_running(rows, kind, reverse=False):
    state, out = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2]), reverse=reverse):
        old = state.get(k)
        new = old
        if v is not None:
            new = {
                "sum": lambda: (old or 0) + v,
                "count": lambda: (old or 0) + 1,
                "min": lambda: v if old is None else min(old, v),
                "max": lambda: v if old is None else max(old, v),
                "first": lambda: v if old is None else old,
                "last": lambda: v,
            }[kind]()
        elif kind == "count":
            new = old or 0
        out[i] = (new, old)
        state[k] = new
    return out


@pytest.mark.parametrize("policy", [WHOLE, SPLIT], ids=["whole", "split"])
@pytest.mark.parametrize("descending", [False, True])
def test_running(data, policy, descending):
    rows, df = data
    kinds = ["sum", "count", "min", "max", "first", "last"]
    aggs = [Running(f"r_{k}", k, F.col("v"), previous=f"p_{k}") for k in kinds]
    out = running(df, ["k"], ["t", "id"], aggs, descending=descending, policy=policy)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for kind in kinds:
        want = brute_running(rows, kind, descending)
        for i, (new, old) in want.items():
            assert got[i][f"r_{kind}"] == new, (kind, i)
            assert got[i][f"p_{kind}"] == old, (kind, i)


@pytest.mark.parametrize("policy", [WHOLE, SPLIT], ids=["whole", "split"])
def test_running_over_whole_table(data, policy):
    rows, df = data
    out = running(
        df, [], ["t", "id"], [Running("m", "max", F.col("v"))], policy=policy
    )
    best, want = None, {}
    for _, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        if v is not None and (best is None or v > best):
            best = v
        want[i] = best
    assert {r["id"]: r["m"] for r in out.collect()} == want


@pytest.mark.parametrize("policy", [WHOLE, SPLIT], ids=["whole", "split"])
def test_neighbours(data, policy):
    rows, df = data
    wanted = [Neighbour(f"n{o}", "id", o) for o in (-3, -1, 1, 2, 4)]
    out = neighbours(df, ["k"], ["t", "id"], wanted, policy=policy)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    per = {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        per.setdefault(k, []).append(i)
    for ids in per.values():
        for pos, i in enumerate(ids):
            for o in (-3, -1, 1, 2, 4):
                want = ids[pos + o] if 0 <= pos + o < len(ids) else None
                assert got[i][f"n{o}"] == want


def test_hot_key_bound(data):
    _, df = data
    hot = find_hot(df, ["k"], "t", SPLIT)
    assert 1 in [r[0] for r in hot.rows]
    assert len(hot.rows) <= SPLIT.max_hot
    assert not find_hot(df, ["k"], "t", WHOLE)


def test_slices_spread_a_hot_key(data):
    from tidemark.operators.skew import SLICE, with_slice

    rows, df = data
    hot = find_hot(df, ["k"], "t", SPLIT)
    sizes = with_slice(df, "t", hot).filter("k = 1").groupBy(SLICE).count().collect()
    assert max(r["count"] for r in sizes) <= 3 * SPLIT.min_rows
    assert sum(r["count"] for r in sizes) == sum(1 for r in rows if r[0] == 1)


@pytest.mark.parametrize("descending", [False, True])
def test_running_over_a_whole_table(spark, descending):
    """Ranges carry state, also when many rows share one time or one is far off."""
    rng = random.Random(8)
    rows = [(0 if i == 7 else rng.choice([50, 50, 50, 60, 61]), i, rng.choice([None, 1, 2, 9])) for i in range(500)]
    df = spark.createDataFrame(rows, "t long, i long, v long").repartition(3)
    kinds = ("sum", "count", "min", "max", "first", "last")
    out = running(
        df, [], ["t", "i"], [Running(k, k, F.col("v"), previous=f"p_{k}") for k in kinds],
        descending=descending,
    )
    got = {r["i"]: r for r in out.collect()}
    seen, before = [], dict.fromkeys(kinds)
    for t, i, v in sorted(rows, reverse=descending):
        if v is not None:
            seen.append(v)
        now = {
            "sum": sum(seen) if seen else None, "count": len(seen), "min": min(seen, default=None),
            "max": max(seen, default=None), "first": seen[0] if seen else None,
            "last": seen[-1] if seen else None,
        }
        for k in kinds:
            assert got[i][k] == now[k], (i, k)
            assert got[i][f"p_{k}"] == before[k], (i, k)
        before = now
