"""A key's rows cost a stream a fixed number of state calls and timers per micro-batch, not some per row."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from weirstone.streaming import processors as S

SEC, DAY = 1_000_000, 86_400_000_000


class State:
    """A value, list or map state of one key; each call and each item of a map's keys counts."""

    def __init__(self, handle, empty):
        self.handle, self.empty, self.held = handle, empty, empty

    def __getattribute__(self, name):
        if name in ("get", "update", "put", "appendList", "appendValue", "clear", "getValue", "updateValue", "keys", "removeKey"):
            object.__getattribute__(self, "handle").calls += 1
        return object.__getattribute__(self, name)

    def get(self):
        return iter(self.held) if isinstance(self.held, list) else self.held

    def update(self, value):
        self.held = tuple(value)

    def put(self, values):
        self.held = [tuple(v) for v in values]

    def appendList(self, values):
        self.held = [*self.held, *map(tuple, values)]

    def appendValue(self, value):
        self.held = [*self.held, tuple(value)]

    def clear(self):
        self.held = self.empty

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held = {**self.held, key: value}

    def keys(self):
        self.handle.calls += len(self.held)
        return iter(list(self.held))

    def removeKey(self, key):
        self.held = {k: v for k, v in self.held.items() if k != key}


class Handle:
    """The state and timers of one key."""

    def __init__(self):
        self.calls, self.timers = 0, set()
        self.getValueState = lambda *_: State(self, None)
        self.getListState = lambda *_: State(self, [])
        self.getMapState = lambda *_: State(self, {})

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)


def batches(processor, parts):
    """What comes out for a key of (time, arrival, ...) rows, calls per micro-batch, and the most timers at a time."""
    handle, out, calls, most = Handle(), [], [], 0
    processor.init(handle)
    for part in [*parts, []]:
        before = handle.calls
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: wm)
        if part:
            out += processor.handleInputRows(("k",), iter(part), values)
            wm = max(r["_us"] for r in part) // 1000
        else:
            wm += 10 * DAY
        most = max(most, len(handle.timers))
        for at in sorted(t for t in handle.timers if t < wm):
            out += processor.handleExpiredTimer(("k",), values, SimpleNamespace(getExpiryTimeInMs=lambda: at))
            handle.timers.discard(at)
        calls.append(handle.calls - before)
    return [tuple(r) for r in out], calls, most


def rows(n, step_us, seed=4):
    rng, at = random.Random(seed), 0
    for seq in range(n):
        at += rng.randrange(step_us)
        kind = rng.random() < 0.5
        yield Row(_us=at, _seq=seq, vc=rng.randrange(50), starts=kind, ends=not kind, creates=kind, hit=kind, fail=kind, side="left" if kind else "right", payload=0)


PROCESSORS = {
    "no_drop": lambda: S.NoDropAlert("k string, a long, b long", "vc", 6 * SEC, rearm=False),
    "no_drop_rearm": lambda: S.NoDropAlert("k string, a long, b long", "vc", 3 * SEC),
    "followed_by": lambda: S.FollowedBy("k string, a long, b long, tag string", 6 * SEC),
    "pay_monitor": lambda: S.PayMonitor("k string, a long, b long, tag string", 6 * SEC),
    "strict_repeat": lambda: S.StrictRepeat("k string, a long, b long", 2, 5 * SEC),
    "fail_window": lambda: S.FailWindow("k string, a long, b long, n long", 6 * SEC, 2),
    "reconcile": lambda: S.Reconcile("k string, a long, b long, tag string", -3 * SEC, 6 * SEC),
    "range_count": lambda: S.RangeCount("k string, seq long, ct long"),
}


@pytest.mark.parametrize("name", PROCESSORS)
def test_calls_do_not_grow_with_rows(name):
    """Ten micro-batches of 200 rows put out what 2,000 of one row do, at a few calls each."""
    given = list(rows(2000, 4 * SEC))
    large, calls, timers = batches(PROCESSORS[name](), [given[i : i + 200] for i in range(0, 2000, 200)])
    small, _, _ = batches(PROCESSORS[name](), [[r] for r in given])
    assert large and sorted(large, key=str) == sorted(small, key=str)
    assert max(calls) <= 16 and timers <= 1


def test_daily_limit_has_one_timer_a_key():
    given = list(rows(2000, DAY // 3))
    make = lambda: S.DailyLimit("k string, seq long, tag string", 3, 8)
    large, calls, timers = batches(make(), [given[i : i + 500] for i in range(0, 2000, 500)])
    small, _, _ = batches(make(), [[r] for r in given])
    assert large and sorted(large) == sorted(small)
    assert max(calls) <= 16 and timers <= 1
