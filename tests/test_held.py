"""Rows that wait for the watermark: their order, and how often state is accessed."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.streaming import processors as P
from tidemark.streaming.totals import running_totals


class Store:
    """States and timers of one key; counts accesses, as each is a message to the JVM."""

    def __init__(self):
        self.maps, self.values, self.timers, self.accesses = {}, {}, set(), 0

    def _count(self, result=None):
        self.accesses += 1
        return result

    def registerTimer(self, ms):
        self._count(self.timers.add(ms))

    def getMapState(self, name, *args):
        held = self.maps.setdefault(name, {})
        return SimpleNamespace(
            exists=lambda: self._count(bool(held)),
            containsKey=lambda k: self._count(k in held),
            getValue=lambda k: self._count(held[k]),
            updateValue=lambda k, v: self._count(held.update({k: v})),
            removeKey=lambda k: self._count(held.pop(k)),
            keys=lambda: self._count(iter(list(held))),
            clear=lambda: self._count(held.clear()),
        )

    def getValueState(self, name, *args):
        def put(value):
            if isinstance(value, list) and not value:
                raise ValueError("an empty list cannot be written")
            self.values[name] = value

        return SimpleNamespace(
            get=lambda: self._count(self.values.get(name)),
            update=lambda v: self._count(put(v)),
            put=lambda v: self._count(put(v)),
            clear=lambda: self._count(self.values.pop(name, None)),
        )

    def getListState(self, name, *args):
        state = self.getValueState(name)
        state.get = lambda: self._count(iter(self.values.get(name, [])))
        return state


def replayed(machine, fields, batches, step_ms, columns=("_t", "_tie"), key=("k",)):
    """Results over batches of rows, the watermark ``step_ms`` behind each batch's last row."""
    store = Store()
    held = P.Held(machine, columns, "")
    held.fields = (*fields, "late_us", "late_tie")
    held.init(store)
    out, watermark, top = [], 0, 0
    for rows in [*batches, []]:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)  # noqa: B023
        if rows:
            out += held.handleInputRows(key, (Row(*columns)(*r) for r in rows), now)
            top = max(top, *(r[0] // 1000 for r in rows))
        watermark = max(watermark, top - step_ms) if rows else 1 << 50
        while due := sorted(t for t in store.timers if t <= watermark):
            at = SimpleNamespace(getExpiryTimeInMs=lambda: due[0])  # noqa: B023
            out += held.handleExpiredTimer(key, now, at)
            store.timers.discard(due[0])
    return out, store


def rows_of(n, seed=1):
    make = random.Random(seed)
    return [(make.randrange(40 * n) * 500, i) for i in range(n)]


@pytest.mark.parametrize("run", [1, 3, 512])
def test_rows_leave_in_order_whatever_the_batches(run, monkeypatch):
    monkeypatch.setattr(P.Held, "RUN", run)
    monkeypatch.setattr(P.Held, "SORTED", 4 * run)
    rows = sorted(rows_of(300))
    # Out of order by less than the delay, in batches that overlap.
    make = random.Random(2)
    arrived = sorted(rows, key=lambda r: r[0] + make.randrange(2_000_000))
    batches = [arrived[i : i + 23] for i in range(0, len(arrived), 23)]
    out, store = replayed(P.Passed(), ("k", "t", "tie"), batches, 2000)
    assert [(r["t"], r["tie"]) for r in out] == rows
    assert not store.maps["held"]


@pytest.mark.parametrize(
    "machine, fields, key",
    [
        (P.Passed(), ("k", "t", "tie"), ("k",)),
        (P.Callbacks(5_000_000), ("k", "ms"), ("k",)),
        (P.EarlyFire(3_600_000_000), ("k", "end", "at", "n"), ("k",)),
        (P.TopLog(2), ("k", "tie", "add", "v", "rank"), ("k",)),
        (P.BitmapChunks(), ("end", "part", "t", "tie", "fresh"), (86_400_000, 0)),
    ],
    ids=lambda x: type(x).__name__ if isinstance(x, P.Emitting) else "",
)
def test_state_is_not_accessed_for_each_row(machine, fields, key):
    columns = ("_t", "_tie", "value", "end", "bit")
    some = [(t, i, i % 50, 86_400_000, i % 4096) for t, i in rows_of(400)]
    out, store = replayed(machine, fields, [some], 10**9, columns, key)
    assert out
    assert store.accesses < 40


def test_a_ranking_of_nulls_has_no_state():
    rows = [(1000, 1, None), (2000, 2, None)]
    out, store = replayed(P.TopLog(2), ("k", "tie", "add", "v", "rank"), [rows], 0, ("_t", "_tie", "value"))
    assert out == [] and not store.values


def test_windows_fire_at_every_boundary_and_end():
    hour = 3_600_000
    rows = [(hour * 500, 1, 4 * hour), (hour * 2500, 2, 4 * hour), (hour * 5000, 3, 8 * hour)]
    for batches in ([rows], [[r] for r in rows], [rows[::-1]]):
        out, store = replayed(
            P.EarlyFire(hour * 1000), ("k", "end", "at", "n"), batches, 3 * hour, ("_t", "_tie", "end")
        )
        got = sorted((r["end"] // hour, r["at"] // hour, r["n"]) for r in out)
        assert got == [(4, 1, 1), (4, 2, 1), (4, 3, 2), (4, 4, 2), (8, 6, 1), (8, 7, 1), (8, 8, 1)]
        assert not store.values.get("s")


def test_totals_compute_their_batch_once(spark, tmp_path):
    """A batch comes out of the stream's state, which each further run would read again."""
    seen, schema = spark.sparkContext.accumulator(0), "window_end long, us long, id long, v long"

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(1000, i, i, 1) for i in range(20)], schema)
    count = running_totals(f"{tmp_path}", ["us", "id"], F.col("v"), "n", at_us="us")
    count(rows.mapInArrow(counted, schema), 0)
    assert seen.value == 20
