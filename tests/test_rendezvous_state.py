"""The rendezvous' keyed state against a plain fold, by states held in memory."""

import random
from types import SimpleNamespace

import pytest

from umpire.functions.events import MSG_TRIGGERED, MSG_WAITING
from umpire.streaming import rendezvous as RV


class Handle:
    """State and timers of one batch id; every access is counted."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def getValueState(self, name, schema):
        return State(self)

    def getMapState(self, name, key, value):
        return State(self)


class State:
    def __init__(self, handle):
        self.handle, self.held = handle, {}

    def _called(self):
        self.handle.calls += 1

    def exists(self):
        self._called()
        return () in self.held

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def clear(self):
        self._called()
        self.held.pop((), None)

    def containsKey(self, key):
        self._called()
        return key in self.held

    def getValue(self, key):
        self._called()
        return self.held.get(key)

    def updateValue(self, key, value):
        self._called()
        self.held[key] = value

    def removeKey(self, key):
        self._called()
        self.held.pop(key, None)

    def keys(self):
        self._called()
        return iter(list(self.held))


def answers(batches, expiry_ms=None):
    """(event id, message) in the order given, over (watermark before, arrivals) batches."""
    handle, processor, out = Handle(), RV.RendezvousProcessor(expiry_ms), []
    processor.init(handle)
    for i, (mark, arrivals) in enumerate(batches):
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
        if arrivals:
            list(processor.handleInputRows(("b",), iter(arrivals), times))
        for at in sorted(t for t in handle.timers if t <= mark):
            handle.timers.discard(at)
            info = SimpleNamespace(getExpiryTimeInMs=lambda: at)
            out += [(r.event_id, r.message) for r in processor.handleExpiredTimer(("b",), times, info)]
    return out, handle.calls


def arrival(i, ms, part):
    return {"us": ms * 1000, "event_id": i, "file_type": part, "folder": "data/b/"}


def plain(arrivals, expiry_ms=None):
    out, part, since = [], None, 0
    for a in sorted(arrivals, key=lambda a: (a["us"], a["event_id"])):
        at = a["us"] // 1000
        if part is not None and expiry_ms is not None and at >= since + expiry_ms:
            part = None
        met = part is not None and part != a["file_type"]
        part, since = (None, 0) if met else (a["file_type"], at)
        out.append((a["event_id"], MSG_TRIGGERED if met else MSG_WAITING.format(t=a["file_type"])))
    return out


def test_state_is_read_and_written_once_a_run():
    rows = [arrival(i, 1 + i * 7919 % 1000, random.Random(i).choice(["df", "y"])) for i in range(1000)]
    got, calls = answers([(0, rows), (2000, [])])
    assert got == plain(rows) and calls < 50


@pytest.mark.parametrize("run", [1, 3, 16_384])
@pytest.mark.parametrize("expiry_ms", [None, 40_000])
def test_runs_are_merged_in_event_time(monkeypatch, run, expiry_ms):
    monkeypatch.setattr(RV, "RUN", run, raising=False)
    monkeypatch.setattr(RV, "HOUR_US", 60_000_000, raising=False)
    rnd = random.Random(run)
    # equal times, times ahead of later watermarks and on them; none behind one
    spans = [(0, 1, 300_000), (100_000, 100_001, 400_000), (250_000, 250_001, 500_000), (500_000, 0, 0)]
    rows, batches = [], []
    for mark, lo, hi in spans:
        part = [arrival(len(rows) + i, rnd.randrange(lo, hi) // 5000 * 5000 + 5000, rnd.choice(["df", "y"])) for i in range(40 if hi else 0)]
        rows += part
        batches.append((mark, part))
    got, _ = answers([*batches, (600_000, [])], expiry_ms)
    assert got == plain(rows, expiry_ms)


def test_arrivals_behind_the_watermark_come_after_those_answered(monkeypatch):
    monkeypatch.setattr(RV, "RUN", 2, raising=False)
    late = [arrival(i, 50 - i, "df") for i in range(2, 9)]
    got, _ = answers([(0, [arrival(1, 100, "y")]), (200, []), (200, late), (300, [])])
    assert [e for e, _ in got] == [1, 8, 7, 6, 5, 4, 3, 2] and got[1][1] == MSG_TRIGGERED
