"""Keyed state machines for ``transformWithState``.

Only for streams whose semantics need state or timers; bounded data has set
based forms in ``tidemark.operators``. Conventions:

* Rows carry ``_t`` (event time in microseconds) and ``_tie``. ``Held`` keeps rows
  in state until the watermark has passed them and then hands a machine all that have
  waited, in that order: results do not depend on how rows fall into micro-batches.
  Rows wait in sorted runs, of which only those that overlap are in memory at once.
* Each access to state is a message to the JVM. A key costs a fixed number of them for
  each micro-batch that brings it rows or passes a deadline of it, not some for each row.
  ``Dealt`` deals keys over a fixed number of groups: rows wait by group, and a key costs
  messages only when rows or deadlines of its own are due.
* A row that comes behind the watermark leaves as a late row.
* A deadline that lies before a row is handled before that row, whether or not
  its timer has fired; a row at the deadline comes first. A timer that finds
  nothing due does nothing. A machine sets a timer for the earliest of its deadlines.
"""

from __future__ import annotations

import heapq
import pickle
import random
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby, islice
from types import SimpleNamespace
from typing import Any

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def place(t: int, tie: int | None) -> tuple:
    """A row's place in its key: by time, then tie; a null tie first, as in ascending order."""
    return t, tie is not None, tie or 0


def in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=lambda r: place(r["_t"], r["_tie"]))


def timer_ms(us: int) -> int:
    """The first millisecond not before a time in microseconds."""
    return -(-us // 1000)


class Emitting(StatefulProcessor):
    """Common parts: output rows by field name."""

    fields: tuple[str, ...] = ()
    #: Whether rows come in order, however many, as those that waited do.
    ordered = False

    def in_order(self, rows: Iterator[Row]) -> Iterator[Row]:
        return rows if self.ordered else iter(in_order(rows))

    def row(self, *values: Any) -> Row:
        return Row(*self.fields)(*values)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(())

    def close(self) -> None:
        pass


class Keyed(Emitting):
    """One value state ``s`` with named fields."""

    state_schema = ""
    ttl_ms: int | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.s = handle.getValueState("s", self.state_schema, self.ttl_ms)

    def load(self, *default: Any) -> list[Any]:
        got = self.s.get()
        return list(got) if got is not None else list(default)


class KeptValue:
    """A value state that is read and written at most once between two calls of ``flush``."""

    def __init__(self, state):
        self.state = state
        self.forget()

    def forget(self) -> None:
        self.known = self.changed = False
        self.stored = self.value = None

    def read(self) -> Any:
        return self.state.get()

    def write(self) -> None:
        self.state.update(self.value)

    def get(self) -> Any:
        if not self.known:
            self.stored = self.value = self.read()
            self.known = True
        return self.value

    def update(self, value: Any) -> None:
        if not self.changed:
            self.get()
        self.value, self.changed = value, True

    def clear(self) -> None:
        self.update(None)

    def flush(self) -> None:
        if self.changed and self.value != self.stored:
            if self.value:
                self.write()
            else:
                self.state.clear()  # also for an empty list, which cannot be written
        self.forget()


class KeptList(KeptValue):
    """The same for a list state."""

    def read(self) -> list:
        return list(self.state.get())

    def write(self) -> None:
        self.state.put(self.value)

    put = KeptValue.update


class KeptMap:
    """The same for the entries of a map state."""

    def __init__(self, state):
        self.state = state
        self.forget()

    def forget(self) -> None:
        self.stored: bool | None = None
        self.cleared = False
        self.changed: dict[tuple, tuple] = {}

    def _stored(self) -> bool:
        if self.stored is None:
            self.stored = self.state.exists()
        return self.stored and not self.cleared

    def containsKey(self, key: tuple) -> bool:
        return key in self.changed or self._stored() and self.state.containsKey(key)

    def getValue(self, key: tuple) -> tuple:
        return self.changed[key] if key in self.changed else self.state.getValue(key)

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.changed[key] = value

    def clear(self) -> None:
        self.cleared = True
        self.changed = {}

    def flush(self) -> None:
        if self.cleared and (self.stored is None or self.stored):
            self.state.clear()
        for key, value in self.changed.items():
            self.state.updateValue(key, value)
        self.forget()


class KeptHandle:
    """A machine's states and its next timer, taken to the store by ``flush``."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.states: list[KeptValue | KeptMap] = []
        self.timer: int | None = None

    def _kept(self, state):
        self.states.append(state)
        return state

    def getValueState(self, *args) -> KeptValue:
        return self._kept(KeptValue(self.handle.getValueState(*args)))

    def getListState(self, *args) -> KeptList:
        return self._kept(KeptList(self.handle.getListState(*args)))

    def getMapState(self, *args) -> KeptMap:
        return self._kept(KeptMap(self.handle.getMapState(*args)))

    def registerTimer(self, ms: int) -> None:
        self.timer = ms

    def flush(self, watermark: int) -> None:
        for state in self.states:
            state.flush()
        if self.timer is not None and self.timer > watermark:
            self.handle.registerTimer(self.timer)
        self.timer = None


class Held(Emitting):
    """A machine that gets a key's rows in order of time, whenever they arrive.

    Rows wait in sorted runs, in a map by the millisecond at which the watermark passes
    the run's first row, and a number. The machine's rows leave with two more fields,
    null for them: time and tie of a row that came too late.
    """

    #: Rows of a run, and rows of a key that are sorted at once.
    RUN, SORTED = 512, 1 << 16

    def __init__(self, machine: Emitting, columns: tuple[str, ...], row_schema: str):
        self.machine = machine
        self.columns = columns
        self.row_schema = row_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = f"rows array<struct<{self.row_schema}>>"
        self.held = handle.getMapState("held", "ms long, no long", schema)
        self.t, self.tie = (self.columns.index(c) for c in ("_t", "_tie"))
        self.make = Row(*self.columns)
        self.kept = KeptHandle(handle)
        self.machine.fields = self.fields[:-2]
        self.machine.ordered = True
        self.machine.init(self.kept)

    def _place(self, row: tuple) -> tuple:
        return place(row[self.t], row[self.tie])

    def _hold(self, run: list[tuple]) -> None:
        ms, no = timer_ms(run[0][self.t]), 0
        while self.held.containsKey((ms, no)):
            no += 1
        self.held.updateValue((ms, no), (run,))
        if no == 0:
            self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        blank = [None] * (len(self.fields) - len(key) - 2)
        while some := [tuple(r[c] for c in self.columns) for r in islice(rows, self.SORTED)]:
            fresh = []
            for r in some:
                if watermark > 0 and timer_ms(r[self.t]) <= watermark:
                    yield self.row(*key, *blank, r[self.t], r[self.tie])
                else:
                    fresh.append(r)
            fresh.sort(key=self._place)
            for at in range(0, len(fresh), self.RUN):
                self._hold(fresh[at : at + self.RUN])

    def _taken(self, run: tuple, watermark: int) -> list[tuple]:
        """The rows of a run that the watermark has passed; the others wait on."""
        rows = [tuple(r) for r in self.held.getValue(run)[0]]
        self.held.removeKey(run)
        due = len(rows)
        while timer_ms(rows[due - 1][self.t]) > watermark:
            due -= 1
        if due < len(rows):
            self._hold(rows[due:])
        return rows[:due]

    def _due(self, runs: list[tuple], watermark: int) -> Iterator[Row]:
        """Rows of all runs in order; a run is read when the first of its rows is near."""
        heap: list[tuple] = []

        def upto(ms: int | None) -> Iterator[Row]:
            while heap and (ms is None or timer_ms(heap[0][0][0]) < ms):
                _, no, row, more = heap[0]
                yield self.make(*row)
                following = next(more, None)
                if following is None:
                    heapq.heappop(heap)
                else:
                    heapq.heapreplace(heap, (self._place(following), no, following, more))

        for no, run in enumerate(runs):
            yield from upto(run[0])
            rows = iter(self._taken(run, watermark))
            first = next(rows)
            heapq.heappush(heap, (self._place(first), no, first, rows))
        yield from upto(None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        runs = sorted(tuple(k) for k in self.held.keys() if k[0] <= watermark)
        if runs:
            for out in self.machine.handleInputRows(key, self._due(runs, watermark), timerValues):
                yield self.row(*out, None, None)
        now = SimpleNamespace(getExpiryTimeInMs=lambda: watermark)
        for out in self.machine.handleExpiredTimer(key, timerValues, now):
            yield self.row(*out, None, None)
        self.kept.flush(watermark)


def pack(rows: Iterable[tuple]) -> bytes:
    """Rows as one value, which neither Spark nor the state store takes apart."""
    return pickle.dumps(list(rows), 5)


unpack = pickle.loads


class OwnState:
    """A state of the key at hand: one field of its entry in the group's map."""

    def __init__(self, empty: Any = None):
        self.empty = empty
        self.value: Any = None

    def get(self) -> Any:
        return self.empty if self.value is None else self.value

    def update(self, value: Any) -> None:
        self.value = value or None

    put = update

    def clear(self) -> None:
        self.value = None


class OwnHandle:
    """States and timer of the key at hand, for a machine that serves one key after another."""

    def __init__(self) -> None:
        self.states: list[OwnState] = []
        self.timer: int | None = None

    def _own(self, state: OwnState) -> OwnState:
        self.states.append(state)
        return state

    def getValueState(self, *args) -> OwnState:
        return self._own(OwnState())

    def getListState(self, *args) -> OwnState:
        return self._own(OwnState(()))

    def registerTimer(self, ms: int) -> None:
        self.timer = ms

    def load(self, values: list | None) -> None:
        for state, value in zip(self.states, values or [None] * len(self.states), strict=True):
            state.value = value
        self.timer = None

    def values(self) -> list | None:
        values = [s.value for s in self.states]
        return values if any(v is not None for v in values) else None


class Dealt(Emitting):
    """As ``Held``, for a group of many keys: a machine gets each key's rows in order of time.

    Rows come and leave packed, each with its key in front. They wait in sorted runs of the
    whole group, in a map by the millisecond at which the watermark passes the run's first
    row. What is due is taken in slices of time, so that only a slice is in memory at once.
    Each key has an entry of its own, with its next deadline and the machine's states, and
    is in the list of deadlines if it has one. The group has a timer for each run and for
    its next deadline.
    """

    #: Rows of a run, rows that are sorted at once, and results that leave as one value.
    RUN, SLICE, OUT = 512, 1 << 16, 1 << 12

    def __init__(self, machine: Emitting, keys: int, columns: tuple[str, ...]):
        self.machine = machine
        self.keys = keys
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "ms long, no long", "rows binary")
        self.entries = handle.getMapState("entries", "key string", "entry binary")
        self.deadlines = handle.getMapState("deadlines", "ms long, key string", "key binary")
        self.t, self.tie = (self.keys + self.columns.index(c) for c in ("_t", "_tie"))
        self.blank = (None,) * (len(self.fields) - self.keys - 2)
        self.own = OwnHandle()
        self.machine.ordered = True
        self.machine.row = lambda *values: values
        self.machine.init(self.own)
        self.done: dict[tuple, int] = {}
        self.any_entry = False

    def _place(self, row: tuple) -> tuple:
        return place(row[self.t], row[self.tie])

    def _ms(self, row: tuple) -> int:
        return timer_ms(row[self.t])

    def _hold(self, run: list[tuple]) -> None:
        at = self._ms(run[0]), 0
        while self.held.containsKey(at):
            at = at[0], random.getrandbits(62)
        self.held.updateValue(at, (pack(run),))
        if at[1] == 0:
            self.handle.registerTimer(at[0])

    def _hold_all(self, rows: list[tuple]) -> None:
        rows.sort(key=self._place)
        for at in range(0, len(rows), self.RUN):
            self._hold(rows[at : at + self.RUN])

    def _out(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while some := list(islice(rows, self.OUT)):
            yield pd.DataFrame({"packed": [pack(some)]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._out(self._arrived(rows, timerValues.getCurrentWatermarkInMs()))

    def _arrived(self, frames: Iterator[pd.DataFrame], watermark: int) -> Iterator[tuple]:
        """The rows that come too late; the others are held."""
        fresh: list[tuple] = []
        for frame in frames:
            for packed in frame["packed"]:
                for r in unpack(packed):
                    if watermark > 0 and self._ms(r) <= watermark:
                        yield *r[: self.keys], *self.blank, r[self.t], r[self.tie]
                    else:
                        fresh.append(r)
                if len(fresh) >= self.SLICE:
                    self._hold_all(fresh)
                    fresh = []
        self._hold_all(fresh)

    def _taken(self, run: tuple, watermark: int) -> list[tuple]:
        """The rows of a run that the watermark has passed; the others wait on."""
        rows = unpack(self.held.getValue(run)[0])
        self.held.removeKey(run)
        due = bisect_left(rows, True, key=lambda r: self._ms(r) > watermark)
        if due < len(rows):
            self._hold(rows[due:])
        return rows[:due]

    def _slices(self, runs: list[tuple], watermark: int) -> Iterator[tuple[list[tuple], bool]]:
        """All due rows in order, cut where no later run begins; and whether it is the last."""
        rows: list[tuple] = []
        limit = self.SLICE
        for run, following in zip(runs, [*runs[1:], None]):
            rows += self._taken(run, watermark)
            if following is None:
                rows.sort(key=self._place)
                yield rows, True
            elif len(rows) >= limit:
                rows.sort(key=self._place)
                cut = bisect_left(rows, following[0], key=self._ms)
                if cut:
                    yield rows[:cut], False
                rows = rows[cut:]
                limit = max(self.SLICE, 2 * len(rows))

    def _serve(self, key: tuple, rows: list[tuple], timerValues, expire: bool) -> Iterator[tuple]:
        """The machine's results for rows of one key and, at the end, its deadlines."""
        name, watermark = repr(key), timerValues.getCurrentWatermarkInMs()
        stored = None
        if self.any_entry and self.entries.containsKey((name,)):
            stored = self.entries.getValue((name,))[0]
        deadline, values = unpack(stored) if stored else (None, None)
        self.own.load(values)
        if rows:
            made = (dict(zip(self.columns, r[self.keys :], strict=True)) for r in rows)
            for out in self.machine.handleInputRows(key, made, timerValues):
                yield *out, None, None
        following = deadline if self.own.timer is None else self.own.timer
        if expire and following is not None and following <= watermark:
            self.own.timer = None
            now = SimpleNamespace(getExpiryTimeInMs=lambda: watermark)
            for out in self.machine.handleExpiredTimer(key, timerValues, now):
                yield *out, None, None
            following = self.own.timer
        if following != deadline:
            if deadline is not None:
                self.deadlines.removeKey((deadline, name))
            if following is not None:
                self.deadlines.updateValue((following, name), (pack(key),))
        values = self.own.values()
        if values is not None or following is not None:
            entry = pack((following, values))
            if entry != stored:
                self.entries.updateValue((name,), (entry,))
        elif stored:
            self.entries.removeKey((name,))

    def _passed(self, timerValues) -> Iterator[tuple]:
        watermark = timerValues.getCurrentWatermarkInMs()
        self.any_entry = bool(self.own.states) and self.entries.exists()
        runs = sorted(tuple(k) for k in self.held.keys() if k[0] <= watermark)
        for rows, last in self._slices(runs, watermark):
            of_key: dict[tuple, list[tuple]] = {}
            for r in rows:
                of_key.setdefault(r[: self.keys], []).append(r)
            for key, some in of_key.items():
                yield from self._serve(key, some, timerValues, last)
            self.any_entry = bool(self.own.states)
        # What is due but had no row in the last slice.
        for ms, name in sorted(tuple(k) for k in self.deadlines.keys() if k[0] <= watermark):
            key = tuple(unpack(self.deadlines.getValue((ms, name))[0]))
            yield from self._serve(key, [], timerValues, True)
        following = min((k[0] for k in self.deadlines.keys()), default=None)
        if following is not None:
            self.handle.registerTimer(following)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.done.get(key) != timerValues.getCurrentWatermarkInMs():  # the first takes all that is due
            self.done[key] = timerValues.getCurrentWatermarkInMs()
            yield from self._out(self._passed(timerValues))


class Jumps(Keyed):
    """Rows whose value moved by more than a threshold since the key's last row.

    A null value never alerts, and the row after it has no previous value.
    """

    state_schema = "prev double"

    def __init__(self, threshold: float, first_is_zero: bool, ttl_ms: int | None = None):
        self.threshold = threshold
        self.first = 0.0 if first_is_zero else None
        self.ttl_ms = ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (prev,) = self.load(None)
        for r in self.in_order(rows):
            value, before = r["value"], self.first if prev is None else prev
            if value is not None and before is not None and abs(value - before) > self.threshold:
                yield self.row(key[0], r["_t"], r["_tie"], before, value)
            prev = value
        self.s.update((prev,))


class Callbacks(Keyed):
    """A callback ``after`` each distinct event time of a key, in milliseconds."""

    state_schema = "due array<long>"

    def __init__(self, after_us: int):
        self.after_us = after_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (due,) = self.load([])
        due = deque(due)  # rows come in order of time, so do their callbacks
        for r in self.in_order(rows):
            while due and due[0] < r["_t"] // 1000:
                yield self.row(key[0], due.popleft())
            ms = (r["_t"] + self.after_us) // 1000
            if not due or due[-1] != ms:
                due.append(ms)
        self._keep(due)

    def _keep(self, due: deque) -> None:
        if due:
            self.handle.registerTimer(due[0])
            self.s.update((list(due),))
        else:
            self.s.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (due,) = self.load([])
        due = deque(due)
        while due and due[0] <= expiredTimerInfo.getExpiryTimeInMs():
            yield self.row(key[0], due.popleft())
        self._keep(due)


class Armed(Keyed):
    """Alert ``hold`` after an arming row unless a reset comes by then.

    ``rising`` derives arming and reset from the value's course; otherwise the
    rows carry both flags.
    """

    state_schema = "opened long, n long, prev double"

    def __init__(self, hold_us: int, at_least: int = 1, rising: bool = False):
        self.hold = hold_us
        self.at_least = at_least
        self.rising = rising

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        opened, n, prev = self.load(None, 0, None)
        before = opened
        for r in self.in_order(rows):
            t = r["_t"]
            if opened is not None and t > opened + self.hold:
                if n >= self.at_least:
                    yield self.row(key[0], opened, opened + self.hold, n)
                opened, n = None, 0
            if self.rising:
                value = r["value"]
                fresh = prev is None or prev == 0.0
                resets = fresh or (value is not None and value < prev)
                arms = not fresh and value is not None and value > prev
                prev = value
            else:
                arms, resets = r["arms"], r["resets"]
            if resets:
                opened, n = None, 0
            elif arms:
                opened = t if opened is None else opened
                n += 1
        if opened != before and opened is not None:
            self.handle.registerTimer(timer_ms(opened + self.hold))
        self.s.update((opened, n, prev))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        opened, n, prev = self.load(None, 0, None)
        now = expiredTimerInfo.getExpiryTimeInMs()
        if opened is not None and timer_ms(opened + self.hold) <= now:
            self.s.update((None, 0, prev))
            if n >= self.at_least:
                yield self.row(key[0], opened, opened + self.hold, n)


class OrderSlot(Keyed):
    """Creates that no other event of the order overwrote before a timer.

    Every event sets a timer, and any of the order's timers empties the slot,
    so the pending ones are part of the state.
    """

    state_schema = "slot_t long, slot_tie long, created boolean, due array<long>"

    def __init__(self, wait_us: int):
        self.wait = wait_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        slot_t, slot_tie, created, due = self.load(None, None, None, [])
        due = deque(due)  # rows come in order of time, so do their deadlines
        for r in self.in_order(rows):
            t = r["_t"]
            while due and due[0] < t:
                at = due.popleft()
                if slot_t is not None and created:
                    yield self.row(key[0], slot_t, slot_tie, at)
                slot_t = slot_tie = created = None
            if slot_t is None or not r["created"]:
                slot_t, slot_tie, created = t, r["_tie"], r["created"]
            due.append(t + self.wait)
        self.handle.registerTimer(timer_ms(due[0]))
        self.s.update((slot_t, slot_tie, created, list(due)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        slot_t, slot_tie, created, due = self.load(None, None, None, [])
        due = deque(due)
        now = expiredTimerInfo.getExpiryTimeInMs()
        while due and timer_ms(due[0]) <= now:
            at = due.popleft()
            if slot_t is not None and created:
                yield self.row(key[0], slot_t, slot_tie, at)
            slot_t = slot_tie = created = None
        if due:
            self.handle.registerTimer(timer_ms(due[0]))
        if slot_t is None and not due:
            self.s.clear()
        else:
            self.s.update((slot_t, slot_tie, created, list(due)))


class Reconciler(Keyed):
    """One waiting event per key; taken by the other side, superseded, or expired."""

    state_schema = "side string, t long, tie long"

    def __init__(self, wait_us: int):
        self.wait = wait_us

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        side, t, tie = self.load(None, None, None)
        before = t
        for r in self.in_order(rows):
            if side is not None and r["_t"] - t > self.wait:
                yield self.row(key[0], side, False, t, tie, None, None)
                side = None
            if side is not None and side != r["side"]:
                yield self.row(key[0], "matched", False, t, tie, r["_t"], r["_tie"])
                side = None
                continue
            if side is not None:
                yield self.row(key[0], side, True, t, tie, None, None)
            side, t, tie = r["side"], r["_t"], r["_tie"]
        after = t if side is not None else None
        if after != before and after is not None:
            self.handle.registerTimer(timer_ms(after + self.wait))
        if side is None:
            self.s.clear()
        else:
            self.s.update((side, t, tie))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        side, t, tie = self.load(None, None, None)
        if side is not None and timer_ms(t + self.wait) <= expiredTimerInfo.getExpiryTimeInMs():
            self.s.clear()
            yield self.row(key[0], side, False, t, tie, None, None)


class Gate(Keyed):
    """Readings that pass while a switch of their key holds the gate open.

    mode ``union``: open during any ``[switch, switch + duration)``.
    mode ``first_close``: the first of the pending closing times shuts the gate,
    even if a later switch came in between.
    """

    state_schema = "open boolean, closes array<long>"

    def __init__(self, mode: str = "union"):
        if mode not in ("union", "first_close"):
            raise ValueError(f"unknown gate mode {mode!r}")
        self.first_close = mode == "first_close"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        is_open, closes = self.load(False, [])
        closes = sorted(closes)
        for r in self._switches_first(rows):
            t = r["_t"]
            while closes and closes[0] <= t:
                closes.pop(0)
                is_open = bool(closes) and not self.first_close and is_open
            if r["is_switch"]:
                is_open = True
                closes = sorted([*closes, t + r["duration_us"]])
                if not self.first_close:
                    closes = closes[-1:]
            elif is_open:
                yield self.row(key[0], t, r["_tie"])
        if closes:
            self.handle.registerTimer(timer_ms(closes[0]))
        self.s.update((is_open, closes))

    def _switches_first(self, rows: Iterator[Row]) -> Iterator[Row]:
        """A switch comes before readings of its own instant."""
        for _, some in groupby(self.in_order(rows), lambda r: r["_t"]):
            yield from sorted(some, key=lambda r: (not r["is_switch"], r["_tie"] or 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        is_open, closes = self.load(False, [])
        now = expiredTimerInfo.getExpiryTimeInMs()
        left = [c for c in closes if timer_ms(c) > now]
        if len(left) < len(closes):
            is_open = bool(left) and not self.first_close and is_open
        if left:
            self.handle.registerTimer(timer_ms(min(left)))
            self.s.update((is_open, left))
        else:
            self.s.clear()
        return iter(())


class Sequences(Emitting):
    """Consecutive rows that meet one step each, with a strict time bound.

    Keeps at most N - 1 rows per key, each with whether the attempt that began
    at it is still open. Rows carry ``fits``, one flag per step.
    """

    def __init__(self, steps: int, within_us: int | None, on_timeout: bool):
        self.steps = steps
        self.within = within_us
        self.on_timeout = on_timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "t long, tie long, open boolean")

    def _row(self, key, outcome: str, rows: list) -> Row:
        return self.row(key[0], outcome, [r[0] for r in rows], [r[1] for r in rows])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = [list(r) for r in self.recent.get()]
        for r in self.in_order(rows):
            t, fits = r["_t"], r["fits"]
            now = [t, r["_tie"], bool(fits[0])]
            for i, start in enumerate(kept):
                if not start[2]:
                    continue
                place = len(kept) - i
                if self.within is not None and t - start[0] >= self.within:
                    start[2] = False
                    if self.on_timeout:
                        yield self._row(key, "timeout", kept[i:])
                elif not fits[place]:
                    start[2] = False
                elif place == self.steps - 1:
                    start[2] = False
                    yield self._row(key, "matched", [*kept[i:], now])
            kept.append(now)
            kept = kept[-(self.steps - 1):] if self.steps > 1 else []
            if now[2] and self.steps == 1:
                yield self._row(key, "matched", [now])
        self._keep(kept)

    def _keep(self, kept: list[list]) -> None:
        begun = [k[0] for k in kept if k[2]]
        if begun and self.on_timeout:
            self.handle.registerTimer(timer_ms(begun[0] + self.within))
        self.recent.put([tuple(k) for k in kept])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.on_timeout:
            return
        now = expiredTimerInfo.getExpiryTimeInMs()
        kept = [list(r) for r in self.recent.get()]
        for i, start in enumerate(kept):
            if start[2] and timer_ms(start[0] + self.within) <= now:
                start[2] = False
                yield self._row(key, "timeout", kept[i:])
        self._keep(kept)


class MinMaxLog(Keyed):
    """Remove-old and add-new rows for each change of a key's (min, max).

    Nulls change nothing; a key whose rows so far are null has (null, null).
    """

    state_schema = "lo long, hi long, seen boolean"

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lo, hi, seen = self.load(None, None, False)
        for r in self.in_order(rows):
            v = r["value"]
            new = (lo, hi)
            if v is not None:
                new = (v if lo is None else min(lo, v), v if hi is None else max(hi, v))
            if not seen or new != (lo, hi):
                if seen:
                    yield self.row(key[0], r["_tie"], False, lo, hi)
                lo, hi = new
                seen = True
                yield self.row(key[0], r["_tie"], True, lo, hi)
        self.s.update((lo, hi, seen))


class LateWindow(Keyed):
    """Count of one (key, window): a first result, then one per late row.

    The stream's watermark lags the logical one by ``lag_ms`` so that Spark
    hands over late rows that still count.
    """

    state_schema = "n long, fired boolean"

    def __init__(self, lag_ms: int, allowed_ms: int):
        self.lag = lag_ms
        self.allowed = allowed_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[1]
        watermark = timerValues.getCurrentWatermarkInMs() + self.lag
        if watermark >= end + self.allowed:
            return
        n, fired = self.load(0, False)
        if n == 0:
            self.handle.registerTimer(end - self.lag)
            self.handle.registerTimer(end + self.allowed - self.lag)
        elif watermark >= end and not fired:
            # closed since the last batch; its timer runs after these rows
            yield self.row(key[0], end, "first", n)
            fired = True
        for _ in rows:
            n += 1
            if watermark >= end:
                yield self.row(key[0], end, "update" if fired else "first", n)
                fired = True
        self.s.update((n, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = key[1]
        n, fired = self.load(0, False)
        if expiredTimerInfo.getExpiryTimeInMs() >= end + self.allowed - self.lag:
            self.s.clear()
        elif n:
            self.s.update((n, True))
        if n and not fired:
            yield self.row(key[0], end, "first", n)


class BitmapChunks(Emitting):
    """Which rows set a bit of their window's map that no earlier row set.

    Keys are (window end in milliseconds, part of the map). A part holds its bits in
    chunks that come into being when a bit of theirs is set, and goes when the watermark
    reaches the window's end.
    """

    CHUNK_BITS = 12

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk long", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.handle.registerTimer(key[0])
        loaded: dict[int, bytearray] = {}
        for r in self.in_order(rows):
            chunk, place = divmod(r["bit"], 1 << self.CHUNK_BITS)
            bits = loaded.get(chunk)
            if bits is None:
                if self.chunks.containsKey((chunk,)):
                    bits = bytearray(self.chunks.getValue((chunk,))[0])
                else:
                    bits = bytearray(1 << (self.CHUNK_BITS - 3))
                loaded[chunk] = bits
            at, mask = place >> 3, 1 << (place & 7)
            fresh = not bits[at] & mask
            bits[at] |= mask
            yield self.row(*key, r["_t"], r["_tie"], fresh)
        for chunk, bits in loaded.items():
            self.chunks.updateValue((chunk,), (bytes(bits),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if expiredTimerInfo.getExpiryTimeInMs() >= key[0]:
            self.chunks.clear()
        return iter(())


class TopLog(Emitting):
    """Remove-old and add-new rows for each place of a key's greatest values that changes.

    The accumulator is a list of at most ``n`` values, equal ones kept; nulls change nothing.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getListState("top", "value long")

    @staticmethod
    def merged(some: list[int], more: list[int], n: int) -> list[int]:
        return sorted([*some, *more], reverse=True)[:n]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = [r[0] for r in self.top.get()]
        for r in self.in_order(rows):
            if r["value"] is None:
                continue
            new = self.merged(kept, [r["value"]], self.n)
            for i, value in enumerate(new):
                if i < len(kept) and kept[i] == value:
                    continue
                if i < len(kept):
                    yield self.row(key[0], r["_tie"], False, kept[i], i + 1)
                yield self.row(key[0], r["_tie"], True, value, i + 1)
            kept = new
        self.top.put([(v,) for v in kept])


class EarlyFire(Keyed):
    """Counts of a key's windows at each boundary after their first row and at their ends.

    Rows carry ``end``, their window's end in milliseconds. The state holds the open
    windows with their counts and next boundaries. A row at a boundary belongs to what
    follows it.
    """

    state_schema = "open array<struct<end: long, n: long, due_us: long>>"

    def __init__(self, every_us: int):
        self.every = every_us

    def _fire(self, key, open_: dict[int, list[int]], until: int) -> Iterator[Row]:
        """Results of the boundaries up to ``until``; closed windows go."""
        for end in [e for e, (_, due) in open_.items() if due <= until]:
            window, last = open_[end], end * 1000
            while window[1] <= min(until, last):
                n, due = window
                yield self.row(key[0], end, due // 1000, n)
                window[1] = min(due + self.every, last) if due < last else last + 1
            if window[1] > last:
                del open_[end]

    def _load(self) -> dict[int, list[int]]:
        return {end: [n, due] for end, n, due in self.load([])[0]}

    def _keep(self, open_: dict[int, list[int]]) -> None:
        if open_:
            self.handle.registerTimer(timer_ms(min(due for _, due in open_.values())))
            self.s.update(([(end, *window) for end, window in open_.items()],))
        else:
            self.s.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        open_ = self._load()
        for r in self.in_order(rows):
            t, end = r["_t"], r["end"]
            yield from self._fire(key, open_, t)
            if end not in open_:
                open_[end] = [0, min((t // self.every + 1) * self.every, end * 1000)]
            open_[end][0] += 1
        self._keep(open_)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        open_ = self._load()
        yield from self._fire(key, open_, expiredTimerInfo.getExpiryTimeInMs() * 1000)
        self._keep(open_)


class Passed(Emitting):
    """Rows as they are, in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in self.in_order(rows):
            yield self.row(*key, r["_t"], r["_tie"])
