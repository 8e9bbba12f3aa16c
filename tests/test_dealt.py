"""Keys dealt over groups: the same results as key by key, and how often state is accessed."""

import os
import random
import uuid
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_held import Store, replayed

from tidemark.sources.tables import stream_table
from tidemark.streaming import processors as P
from tidemark.streaming import run, stateful

HOUR = 3_600_000_000


def dealt(machine, fields, batches, step_ms, columns):
    """Results over batches of rows with their keys in front, the watermark ``step_ms`` behind."""
    store = Store()
    group = P.Dealt(machine, 1, columns)
    group.fields = (*fields, "late_us", "late_tie")
    group.init(store)
    out, watermark, top = [], 0, 0

    def take(frames):
        for frame in frames:
            for packed in frame["packed"]:
                out.extend(P.unpack(packed))

    for rows in [*batches, []]:
        group.done = {}  # as for a new task
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)  # noqa: B023
        if rows:
            halves = [rows[: len(rows) // 2], rows[len(rows) // 2 :]]
            take(group.handleInputRows((3,), iter([pd.DataFrame({"packed": [P.pack(h) for h in halves]})]), now))
            top = max(top, *(r[1] // 1000 for r in rows))
        watermark = max(watermark, top - step_ms) if rows else 1 << 50
        while due := sorted(t for t in store.timers if t <= watermark):
            at = SimpleNamespace(getExpiryTimeInMs=lambda: due[0])  # noqa: B023
            take(group.handleExpiredTimer((3,), now, at))
            store.timers.discard(due[0])
    return out, store


COLUMNS = (
    "_t", "_tie", "value", "end", "arms", "resets", "created", "side", "is_switch", "duration_us", "fits",
)
MACHINES = [
    (lambda: P.Passed(), 2),
    (lambda: P.Jumps(50.0, False), 4),
    (lambda: P.Callbacks(HOUR), 1),
    (lambda: P.Armed(2 * HOUR, rising=True), 3),
    (lambda: P.Armed(2 * HOUR, 2), 3),
    (lambda: P.OrderSlot(HOUR), 3),
    (lambda: P.Reconciler(HOUR), 6),
    (lambda: P.Gate("union"), 2),
    (lambda: P.Gate("first_close"), 2),
    (lambda: P.Sequences(2, HOUR, True), 3),
    (lambda: P.Sequences(3, None, False), 3),
    (lambda: P.MinMaxLog(), 4),
    (lambda: P.TopLog(2), 4),
    (lambda: P.EarlyFire(HOUR), 3),
]


def some_rows(n, seed):
    make = random.Random(seed)
    rows = []
    for i in range(n):
        t = make.randrange(30 * 24) * HOUR // 24 + make.randrange(3) + HOUR
        create = make.random() < 0.5
        rows.append((
            make.choice([None, 0, 1, 2, 3, "é'"]), t, make.choice([i, i, i, None]), make.choice([None, *range(100)]),
            (t // (4 * HOUR) + 1) * 4 * HOUR // 1000, create, make.random() < 0.2, create,
            "order" if create else "pay", make.random() < 0.3, HOUR // make.choice([1, 2, 7]),
            [make.random() < 0.6 for _ in range(3)],
        ))
    return rows


def sizes(monkeypatch, run, piece, out):
    for name, value in (("RUN", run), ("SLICE", piece), ("OUT", out)):
        monkeypatch.setattr(P.Dealt, name, value)


@pytest.mark.parametrize("run, piece, out", [(1, 3, 1), (4, 16, 5), (512, 1 << 16, 1 << 12)])
@pytest.mark.parametrize("case", range(len(MACHINES)))
def test_a_group_of_keys_gives_what_each_key_gives(case, run, piece, out, monkeypatch):
    sizes(monkeypatch, run, piece, out)
    make, width = MACHINES[case]
    fields = ("k", *(f"c{i}" for i in range(width)))
    # Distinct places: what ties leave open is not compared.
    rows = list({(r[0], r[1], r[2]): r for r in some_rows(300, case)}.values())
    # A disorder of less than the delay, and batches that share no watermark with one key alone.
    shuffled = sorted(rows, key=lambda r: r[1] + random.Random(repr(r)).randrange(2 * HOUR))
    for batches in ([rows], [shuffled[i : i + 37] for i in range(0, len(shuffled), 37)]):
        got, store = dealt(make(), fields, batches, 2 * HOUR // 1000, COLUMNS)
        want = []
        for key in {r[0] for r in rows}:
            # All rows of the key at once, of which none is late.
            own, _ = replayed(make(), fields, [[r[1:] for r in rows if r[0] == key]], 0, COLUMNS, (key,))
            want += [tuple(r) for r in own]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert not store.maps["held"] and not store.maps["deadlines"]


def test_late_rows_leave_with_their_keys():
    rows = [(k, HOUR * t, t, *[None] * 9) for k in ("a", None) for t in (5, 6)]
    got, _ = dealt(P.Passed(), ("k", "t", "tie"), [rows, [("a", HOUR, 9, *[None] * 9)]], 0, COLUMNS)
    assert ("a", None, None, HOUR, 9) in got and len(got) == 5


def test_keys_with_few_rows_cost_few_accesses():
    rows = [(k, HOUR + 1000 * i, 9 * k + i, 50 + i, *[None] * 8) for k in range(1000) for i in range(5)]
    for machine, width in ((P.Passed, 2), (P.MinMaxLog, 4), (lambda: P.Jumps(0.0, True), 4)):
        fields = ("k", *"abcd"[:width])
        out, store = dealt(machine(), fields, [rows], 0, COLUMNS)
        assert len(out) >= len(rows)
        # One key has no entry yet and gets one, and rows cost by the run of 512.
        assert store.accesses < 60 + (0 if width == 2 else 1000)
        alone = replayed(machine(), fields, [[r[1:] for r in rows if r[0] == 7]], 0, COLUMNS, (7,))[1]
        assert 3 * store.accesses < 1000 * alone.accesses


def test_rows_of_one_file_are_packed_by_many_tasks(spark, tmp_path, monkeypatch):
    n, folder, packed = 3000, str(tmp_path / "rows"), stateful._packed
    at = F.timestamp_seconds(F.col("id") + 1_704_067_200)
    table = spark.range(0, n, 1, 1).select(F.col("id").alias("event_id"), (F.col("id") % 500).alias("k"), at.alias("ts"))
    table.write.parquet(folder)

    def spied(batches):
        from pyspark import TaskContext

        for batch in batches:
            for out in packed(iter([batch])):
                task = TaskContext.get().partitionId()
                with open(tmp_path / f"{task}-{batch.num_rows}-{out.num_rows}-{uuid.uuid4().hex}", "w"):
                    yield out

    monkeypatch.setattr(stateful, "_packed", spied)
    rows = stream_table(spark, folder, table.schema).withWatermark("ts", "0 seconds")
    done = run.drain(stateful.in_order(rows, "k", "ts", "event_id"), "one-file")
    assert done.filter("tie IS NOT NULL").count() == n
    seen = [tuple(map(int, name.split("-")[:3])) for name in os.listdir(tmp_path) if name != "rows"]
    assert sum(s[1] for s in seen) == n
    # Each of the 4 partitions packs a part of the rows; a group's are in one value a batch.
    assert len({s[0] for s in seen}) == 4 and sum(s[2] for s in seen) <= 500
