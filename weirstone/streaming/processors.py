"""Keyed stateful processors for `transformWithState`.

Two families: those that follow arrival (`ArrivalOrdered`, rows of a micro-batch
sorted by `_seq`) and those that follow event time (`EventOrdered`, rows wait
until the watermark has passed them). Inputs carry `_us` (event time in
microseconds) and `_seq` (arrival number) where the family needs them. Each call of a
state variable is a round trip to the JVM, so what a key holds is one packed value
(`Held`) where it is short; a micro-batch's size is set by the source
(`maxFilesPerTrigger`, `maxOffsetsPerTrigger`).
"""

from __future__ import annotations

import pickle
import sys
import zlib
from collections import defaultdict, deque
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from weirstone import schemas
from weirstone.schemas import struct

# Spark starts a processor in a process of the driver too, which gets no shipped packages: send these classes whole.
for _module in (sys.modules[__name__], schemas):
    cloudpickle.register_pickle_by_value(_module)

# Rows of a key in one entry of a buffer; up to as many wait in its packed value.
PACKED = 10_000
# Values in a page of what a key has seen, on average at most.
PAGE = 1_000


def stateful(
    df: DataFrame,
    *,
    keys: Sequence[str],
    processor: StatefulProcessor,
    output: str,
    time_mode: str = "None",
    mode: str = "Update",
) -> DataFrame:
    """Apply a processor per key; `output` is the DDL of the rows it yields."""
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=struct(output), outputMode=mode, timeMode=time_mode
    )


class Held:
    """One picklable value per key, None for none: a call reads it and a call writes it, whatever it consists of."""

    def __init__(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("held", struct("packed binary"))

    def get(self):
        held = self.state.get()
        return None if held is None else pickle.loads(held[0])

    def put(self, value) -> None:
        if value is None:
            self.state.clear()
        else:
            self.state.update((pickle.dumps(value),))


class ArrivalOrdered(StatefulProcessor):
    """Base: `step(key, row)` per row, in arrival order within the micro-batch.

    `load` and `save` run once per key and micro-batch, so a state variable costs
    two round trips however many rows the key has.
    """

    def __init__(self, out: str) -> None:
        self.names = struct(out).fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.make = handle, Row(*self.names)
        self.setup(handle)

    def setup(self, handle: StatefulProcessorHandle) -> None: ...

    def load(self) -> None: ...

    def save(self) -> None: ...

    def row(self, *values) -> Row:
        return self.make(*values)

    def step(self, key: tuple, row: Row) -> Iterator[Row]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.load()
        for row in sorted(rows, key=lambda r: r["_seq"]):
            yield from self.step(key, row)
        self.save()

    def close(self) -> None: ...


class EventOrdered(ArrivalOrdered):
    """Base: rows buffered by key and stepped in (event time, arrival) order at the watermark.

    Steps work on plain values, which `unpack` sets and `pack` gives back once per key and firing.
    They are held with the key's timer and its waiting rows in one packed value; beyond PACKED
    rows they go to a list, which only firings read. A key has one timer at a time, for the first
    waiting row or what `due` tells, whichever is earlier.
    """

    def __init__(self, out: str, buffered: str) -> None:
        super().__init__(out)
        self.fields = struct("_us long, _seq long, " + buffered)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = Held(handle)
        self.buffer = handle.getListState("buffer", struct("rows binary"))
        super().init(handle)

    def unpack(self, state) -> None:
        """Set the plain values of a key; `state` is what `pack` returned, None for a new key."""

    def pack(self):
        """The plain values as something picklable; None if there is nothing to hold."""
        return None

    def _read(self) -> tuple[int | None, object, list[tuple], bool]:
        """Time of the key's timer, its packed values, waiting rows, and whether the list holds more."""
        return self.held.get() or (None, None, [], False)

    def _write(self, timer: int | None, state, rows: list[tuple], more: bool) -> None:
        self.held.put((timer, state, rows, more) if timer is not None or state is not None or rows or more else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.fields.fieldNames()
        fresh = [tuple(row[n] for n in names) for row in rows]
        if fresh:
            timer, state, waiting, more = self._read()
            at = to_millis(min(r[0] for r in fresh))
            if timer is None or at < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(at)
                timer = at
            waiting += fresh
            if len(waiting) > PACKED:
                self.buffer.appendList(packed(waiting))
                waiting, more = [], True
            self._write(timer, state, waiting, more)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        _, state, rows, more = self._read()
        if more:
            rows = [r for (some,) in self.buffer.get() for r in pickle.loads(some)] + rows
        ready = sorted((r for r in rows if r[0] <= upto), key=lambda r: r[:2])
        waiting = [r for r in rows if r[0] > upto]
        self.unpack(state)
        yield from self.fire(key, ready, upto)
        wakes = [us for us in (min((r[0] for r in waiting), default=None), self.due()) if us is not None]
        timer = to_millis(min(wakes)) if wakes else None
        if timer is not None:
            self.handle.registerTimer(timer)
        if len(waiting) > PACKED:
            self.buffer.put(packed(waiting))
            waiting, more = [], True
        elif more:
            self.buffer.clear()
            more = False
        self._write(timer, self.pack(), waiting, more)

    def fire(self, key: tuple, ready: list[tuple], upto: int) -> Iterator[Row]:
        names = self.fields.fieldNames()
        for values in ready:
            yield from self.expire(key, values[0])
            yield from self.step(key, dict(zip(names, values)))
        yield from self.expire(key, upto)

    def expire(self, key: tuple, upto: int) -> Iterator[Row]:
        """Close what ended before `upto`, ahead of the next row."""
        return iter(())

    def due(self) -> int | None:
        """When, in microseconds and later than the last `expire`, the next one has something to close."""
        return None


def packed(rows: list[tuple]) -> list[tuple[bytes]]:
    return [(pickle.dumps(rows[i : i + PACKED]),) for i in range(0, len(rows), PACKED)]


def to_millis(us: int) -> int:
    """The first millisecond that is not before a time."""
    return -(-us // 1000)


class Reduce(ArrivalOrdered):
    """(accumulated, row) -> accumulated, emitted at each row. First row starts it."""

    def __init__(self, out: str, state: str, start: Callable[[Row], tuple], fold: Callable[[tuple, Row], tuple],
                 emit: Callable[[tuple, Row], tuple]) -> None:
        super().__init__(out)
        self.state_ddl, self.start, self.fold, self.emit = state, start, fold, emit

    def setup(self, handle) -> None:
        self.state = handle.getValueState("acc", struct(self.state_ddl))

    def load(self) -> None:
        held = self.state.get()
        self.acc = None if held is None else tuple(held)

    def save(self) -> None:
        self.state.update(self.acc)

    def step(self, key, row) -> Iterator[Row]:
        self.acc = self.start(row) if self.acc is None else self.fold(self.acc, row)
        yield self.row(*key, *self.emit(self.acc, row))


class CountChangelog(ArrivalOrdered):
    """Count per key as a changelog: (key, step, added, ct)."""

    def setup(self, handle) -> None:
        self.state = handle.getValueState("count", struct("n long"))

    def load(self) -> None:
        held = self.state.get()
        self.count = held[0] if held else 0

    def save(self) -> None:
        self.state.update((self.count,))

    def step(self, key, row) -> Iterator[Row]:
        self.count += 1
        if self.count > 1:
            yield self.row(*key, self.count, False, self.count - 1)
        yield self.row(*key, self.count, True, self.count)


class CountWindow(ArrivalOrdered):
    """Every `slide` rows of a key: (key, fired_at, sum of `value` over the last `size` rows)."""

    def __init__(self, out: str, value: str, size: int, slide: int | None = None, full_only: bool = False) -> None:
        super().__init__(out)
        self.value, self.size, self.slide = value, size, slide or size
        self.full_only = full_only

    def setup(self, handle) -> None:
        self.held = Held(handle)

    def load(self) -> None:
        self.count, tail = self.held.get() or (0, ())
        self.tail = deque(tail, maxlen=self.size)

    def save(self) -> None:
        self.held.put((self.count, tuple(self.tail)))

    def step(self, key, row) -> Iterator[Row]:
        self.count += 1
        self.tail.append(row[self.value])
        if self.count % self.slide == 0 and (self.count >= self.size or not self.full_only):
            yield self.row(*key, self.count, sum(self.tail))


class TopList(ArrivalOrdered):
    """The key's `n` largest values so far, on every row: (key, _seq, list)."""

    def __init__(self, out: str, value: str, n: int = 3) -> None:
        super().__init__(out)
        self.value, self.n = value, n

    def setup(self, handle) -> None:
        self.state = handle.getListState("best", struct("v long"))

    def load(self) -> None:
        self.best = [t[0] for t in self.state.get()]

    def save(self) -> None:
        self.state.put([(v,) for v in self.best])

    def step(self, key, row) -> Iterator[Row]:
        self.best = sorted([*self.best, row[self.value]], reverse=True)[: self.n]
        yield self.row(*key, row["_seq"], self.best)


class JumpAlert(ArrivalOrdered):
    """A row whose value differs from the key's previous one by more than `limit`."""

    def __init__(self, out: str, value: str, limit: int) -> None:
        super().__init__(out)
        self.value, self.limit = value, limit

    def setup(self, handle) -> None:
        self.state = handle.getValueState("last", struct("v long"))

    def load(self) -> None:
        held = self.state.get()
        self.last = held[0] if held else None

    def save(self) -> None:
        self.state.update((self.last,))

    def step(self, key, row) -> Iterator[Row]:
        before, self.last = self.last, row[self.value]
        if before is not None and abs(self.last - before) > self.limit:
            yield self.row(*key, row["_seq"], before, self.last)


class FirstSeen(ArrivalOrdered):
    """A row whose value the key has not had before: (key, _seq, value).

    A key's values lie in pages of a map state, by the hash of the value; page 0 also tells how
    many there are. When pages hold more than PAGE values on average, each is split in two. A
    micro-batch reads and writes the pages of its values, one in memory at a time besides page 0.
    """

    def __init__(self, out: str, value: str) -> None:
        super().__init__(out)
        self.value = value

    def setup(self, handle) -> None:
        self.pages = handle.getMapState("pages", struct("page long"), struct("packed binary"))

    def _read(self, page: int, empty):
        held = self.pages.getValue((page,))
        return empty if held is None else pickle.loads(held[0])

    def _write(self, page: int, packed) -> None:
        self.pages.updateValue((page,), (pickle.dumps(packed),))

    def _split(self, page: int, values: set, bits: int) -> set:
        """Move to a new page the values whose next bit of the hash is 1; return the others."""
        moved = {v for v in values if hashed(v) >> bits & 1}
        if moved:
            self._write(page + (1 << bits), moved)
        return values - moved

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = {}
        for row in rows:
            value, seq = row[self.value], row["_seq"]
            if value not in first or seq < first[value]:
                first[value] = seq
        bits, total, zero = self._read(0, (0, 0, set()))
        before, places = total, defaultdict(list)
        for value in first:
            places[hashed(value) & (1 << bits) - 1].append(value)
        for page, values in places.items():
            held = zero if page == 0 else self._read(page, set())
            fresh = [v for v in values if v not in held]
            for v in fresh:
                yield self.row(*key, first[v], v)
            held.update(fresh)
            total += len(fresh)
            if page and fresh:
                self._write(page, held)
        while total > PAGE << bits:
            zero = self._split(0, zero, bits)
            for page in range(1, 1 << bits):
                self._write(page, self._split(page, self._read(page, set()), bits))
            bits += 1
        if total > before:
            self._write(0, (bits, total, zero))


def hashed(value) -> int:
    """The same in every process."""
    return zlib.crc32(repr(value).encode())


class ControlSwitch(ArrivalOrdered):
    """Tagged union of control and data rows: data rows with the newest control value.

    The control rows must have been replicated to every key; a control row has a
    non-null `control`, a data row a null one.
    """

    def setup(self, handle) -> None:
        self.state = handle.getValueState("current", struct("v string"))

    def load(self) -> None:
        held = self.state.get()
        self.current = held[0] if held else None

    def save(self) -> None:
        if self.current is not None:
            self.state.update((self.current,))

    def step(self, key, row) -> Iterator[Row]:
        if row["control"] is not None:
            self.current = row["control"]
            return
        yield self.row(*key, row["_seq"], self.current)


class DailyLimit(ArrivalOrdered):
    """Pass the first `limit` - 1 rows of a key per local day, alert once, drop the rest.

    Yields (key, _seq, tag). The key's counters of past days are cleared by an event-time
    timer at the end of the earliest local day; a key has one timer at a time.
    """

    DAY = 86_400_000

    def __init__(self, out: str, limit: int, offset_hours: int) -> None:
        super().__init__(out)
        self.limit, self.offset = limit, offset_hours * 3_600_000

    def setup(self, handle) -> None:
        self.held = Held(handle)

    def load(self) -> None:
        self.days = self.held.get() or {}
        self.watched = min(self.days, default=None)

    def end_of(self, day: int) -> int:
        return (day + 1) * self.DAY - self.offset

    def save(self) -> None:
        self.held.put(self.days or None)
        first = min(self.days, default=None)
        if first is not None and first != self.watched:
            if self.watched is not None and first < self.watched:
                self.handle.deleteTimer(self.end_of(self.watched))
            self.handle.registerTimer(self.end_of(first))

    def step(self, key, row) -> Iterator[Row]:
        day = (row["_us"] // 1000 + self.offset) // self.DAY
        n = self.days[day] = self.days.get(day, 0) + 1
        if n < self.limit:
            yield self.row(*key, row["_seq"], "pass")
        elif n == self.limit:
            yield self.row(*key, row["_seq"], "alert")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.load()
        now = timerValues.getCurrentWatermarkInMs()
        self.days = {day: n for day, n in self.days.items() if self.end_of(day) > now}
        self.save()
        return iter(())


class RepeatingTimer(ArrivalOrdered):
    """Processing-time timer re-registered each time it fires: (key, fires)."""

    def __init__(self, out: str, every_ms: int) -> None:
        super().__init__(out)
        self.every = every_ms

    def setup(self, handle) -> None:
        self.fires = handle.getValueState("fires", struct("n long"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        for _ in rows:
            pass
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.fires.get()
        n = (held[0] if held else 0) + 1
        self.fires.update((n,))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        yield self.row(*key, n)


class NoDropAlert(EventOrdered):
    """Alert when `value` has not dropped for `hold_us`: (key, run_start, alert_at).

    `rearm` starts a new wait at the next rising row after an alert; without it a
    run alerts once, as the bounded form does.
    """

    def __init__(self, out: str, value: str, hold_us: int, strict: bool = False, rearm: bool = True) -> None:
        super().__init__(out, f"{value} long")
        self.value, self.hold, self.strict, self.rearm = value, hold_us, strict, rearm

    def unpack(self, state) -> None:
        # Whether there was a row, its value, start of the run if one is on, whether it has alerted.
        self.seen, self.last, self.since, self.fired = state or (False, None, None, False)

    def pack(self) -> tuple:
        return self.seen, self.last, self.since, self.fired

    def step(self, key, row) -> Iterator[Row]:
        value = row[self.value]
        fell = self.seen and (value <= self.last if self.strict else value < self.last)
        self.seen, self.last = True, value
        if fell:
            self.since, self.fired = None, False
        elif self.since is None:
            self.since, self.fired = row["_us"], False
        return iter(())

    def expire(self, key, upto) -> Iterator[Row]:
        if self.since is not None and not self.fired and self.since + self.hold < upto:
            yield self.row(*key, self.since, self.since + self.hold)
            if self.rearm:
                self.since = None
            else:
                self.fired = True

    def due(self) -> int | None:
        return self.since + self.hold + 1 if self.since is not None and not self.fired else None


class StrictRepeat(EventOrdered):
    """`times` consecutive hits in less than `within_us`: (key, first_us, last_us)."""

    def __init__(self, out: str, times: int, within_us: int) -> None:
        super().__init__(out, "hit boolean")
        self.times, self.within = times, within_us

    def unpack(self, state) -> None:
        self.chain = deque(state or (), maxlen=self.times)

    def pack(self) -> tuple | None:
        return tuple(self.chain) or None

    def step(self, key, row) -> Iterator[Row]:
        if not row["hit"]:
            self.chain.clear()
            return
        self.chain.append(row["_us"])
        if len(self.chain) == self.times and self.chain[-1] - self.chain[0] < self.within:
            yield self.row(*key, self.chain[0], self.chain[-1])


class FollowedBy(EventOrdered):
    """Start followed by an end within the limit: (key, start_us, end_us, tag)."""

    def __init__(self, out: str, within_us: int) -> None:
        super().__init__(out, "starts boolean, ends boolean")
        self.within = within_us

    def unpack(self, state) -> None:
        # In order of time, as rows are stepped in it.
        self.open = deque(state or ())

    def pack(self) -> tuple | None:
        return tuple(self.open) or None

    def step(self, key, row) -> Iterator[Row]:
        if row["ends"]:
            for us in self.open:
                yield self.row(*key, us, row["_us"], "matched")
            self.open.clear()
        if row["starts"]:
            self.open.append(row["_us"])

    def expire(self, key, upto) -> Iterator[Row]:
        while self.open and self.open[0] + self.within <= upto:
            us = self.open.popleft()
            yield self.row(*key, us, us + self.within, "timeout")

    def due(self) -> int | None:
        return self.open[0] + self.within if self.open else None


class PayMonitor(EventOrdered):
    """Paid / paid without create / not paid: (key, create_us, other_us, tag)."""

    def __init__(self, out: str, within_us: int) -> None:
        super().__init__(out, "creates boolean")
        self.within = within_us

    def unpack(self, state) -> None:
        self.open = state

    def pack(self) -> int | None:
        return self.open

    def step(self, key, row) -> Iterator[Row]:
        if row["creates"]:
            self.open = row["_us"]
        elif self.open is None:
            yield self.row(*key, None, row["_us"], "no_create")
        else:
            yield self.row(*key, self.open, row["_us"], "paid")
            self.open = None

    def expire(self, key, upto) -> Iterator[Row]:
        if self.open is not None and self.open + self.within < upto:
            yield self.row(*key, self.open, self.open + self.within, "no_pay")
            self.open = None

    def due(self) -> int | None:
        return None if self.open is None else self.open + self.within + 1


class FailWindow(EventOrdered):
    """Fails within `within_us` of the first: (key, first_us, last_us, fails).

    After a window closes, the next fail opens a new one only after a success,
    as in the bounded form.
    """

    def __init__(self, out: str, within_us: int, at_least: int) -> None:
        super().__init__(out, "fail boolean")
        self.within, self.at_least = within_us, at_least

    def unpack(self, state) -> None:
        # First and last fail, their number, whether the window is closed.
        self.window = state

    def pack(self) -> tuple | None:
        return self.window

    def _report(self, key, held) -> Iterator[Row]:
        if not held[3] and held[2] >= self.at_least:
            yield self.row(*key, held[0], held[1], held[2])

    def step(self, key, row) -> Iterator[Row]:
        held = self.window
        if not row["fail"]:
            if held is not None:
                yield from self._report(key, held)
                self.window = None
        elif held is None:
            self.window = (row["_us"], row["_us"], 1, False)
        elif not held[3]:
            self.window = (held[0], row["_us"], held[2] + 1, False)

    def expire(self, key, upto) -> Iterator[Row]:
        held = self.window
        if held is not None and not held[3] and held[0] + self.within < upto:
            yield from self._report(key, held)
            self.window = (held[0], held[1], held[2], True)

    def due(self) -> int | None:
        return None if self.window is None or self.window[3] else self.window[0] + self.within + 1


class Reconcile(EventOrdered):
    """Two tagged inputs (`side` left or right): match within bounds or time out.

    A right row matches left rows with right - left in [lower_us, upper_us]; each
    row waits until no partner can come any more. Yields
    (key, left_us, right_us, tag) with tag matched, no_right or no_left.
    """

    def __init__(self, out: str, lower_us: int, upper_us: int) -> None:
        super().__init__(out, "side string")
        self.lower, self.upper = lower_us, upper_us

    def unpack(self, state) -> None:
        # [time, matched] in order of time, as rows are stepped in it.
        left, right = state or ((), ())
        self.sides = {"left": deque(left), "right": deque(right)}

    def pack(self) -> tuple | None:
        return (list(self.sides["left"]), list(self.sides["right"])) if any(self.sides.values()) else None

    def _gap_ok(self, left: int, right: int) -> bool:
        return self.lower <= right - left <= self.upper

    def step(self, key, row) -> Iterator[Row]:
        mine, other = row["side"], "right" if row["side"] == "left" else "left"
        us, found = row["_us"], False
        for held in self.sides[other]:
            left, right = (us, held[0]) if mine == "left" else (held[0], us)
            if self._gap_ok(left, right):
                found = held[1] = True
                yield self.row(*key, left, right, "matched")
        self.sides[mine].append([us, found])

    def _wait(self, side: str) -> int:
        return self.upper if side == "left" else -self.lower

    def expire(self, key, upto) -> Iterator[Row]:
        for side, held in self.sides.items():
            while held and held[0][0] + self._wait(side) < upto:
                us, matched = held.popleft()
                if not matched:
                    pair = (us, None, "no_right") if side == "left" else (None, us, "no_left")
                    yield self.row(*key, *pair)

    def due(self) -> int | None:
        return min((held[0][0] + self._wait(side) + 1 for side, held in self.sides.items() if held), default=None)


class RangeCount(EventOrdered):
    """Event-time OVER count per key, rows of equal time being peers: (key, _seq, ct)."""

    def __init__(self, out: str) -> None:
        super().__init__(out, "payload long")

    def unpack(self, state) -> None:
        self.count = state or 0

    def pack(self) -> int:
        return self.count

    def fire(self, key, ready, upto) -> Iterator[Row]:
        for _, same_time in groupby(ready, key=lambda r: r[0]):
            peers = list(same_time)
            self.count += len(peers)
            for r in peers:
                yield self.row(*key, r[1], self.count)


class LeftJoinChangelog(ArrivalOrdered):
    """Left join of two tagged inputs (`side` left or right) as a changelog.

    A left row without a partner is put out padded with null, and retracted when
    its first partner arrives. `keep_ms` is the retention of the state, which
    needs `time_mode="ProcessingTime"` and a query that keeps running (such a query
    has no end of its own under `availableNow`). Yields (key, added, left value, right value); a null `left`
    never occurs.
    """

    def __init__(self, out: str, value: str = "value", keep_ms: int | None = None) -> None:
        super().__init__(out)
        self.value, self.keep = value, keep_ms

    def setup(self, handle) -> None:
        one = struct("v string")
        self.states = {side: handle.getListState(side, one, self.keep) for side in ("left", "right")}

    def load(self) -> None:
        self.held = {side: [t[0] for t in state.get()] for side, state in self.states.items()}
        self.fresh = {side: [] for side in self.states}

    def save(self) -> None:
        for side, values in self.fresh.items():
            if values:
                self.states[side].appendList([(v,) for v in values])

    def step(self, key, row) -> Iterator[Row]:
        side, value = row["side"], row[self.value]
        lefts = self.held["left"] + self.fresh["left"]
        rights = self.held["right"] + self.fresh["right"]
        if side == "left":
            for right in rights or [None]:
                yield self.row(*key, True, value, right)
        else:
            for left in lefts:
                if not rights:
                    yield self.row(*key, False, left, None)
                yield self.row(*key, True, left, value)
        self.fresh[side].append(value)
