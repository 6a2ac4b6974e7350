"""Two-file rendezvous by batch id (T1): one outcome per accepted arrival.

Semantics: accepted arrivals of one batch id are folded in time order (ties by
event id); the state is the part (``df`` or ``y``) that waits, if any.  An arrival
of the other part finds it: the batch folder is triggered and the state cleared.
Any other arrival leaves its own part waiting.  Each arrival is answered with
one of the two messages.

Two plans with identical output:

* ``rendezvous_stream``: keyed state with ``transformWithState`` (RocksDB store).
  Arrivals are kept in sorted runs, each with a timer at its first one's event time; once
  the watermark passes it, runs are merged up to the watermark, so arrivals are answered in
  time order, whatever order and micro-batch they came in.
  State per batch id: the waiting part, and the arrivals ahead of the watermark.
* ``rendezvous_batch``: one ordered pass over range partitions of (batch id, time).
  An arrival acts on the state as a function; a partition's arrivals compose to a
  function of the part that waits before its first one, so one small row per
  partition settles what waits where, and one busy batch id may span many tasks.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from umpire.functions.events import MSG_TRIGGERED, MSG_WAITING
from umpire.operators.ordered import _checkpointed_ranges
from umpire.streaming.runner import after_watermark

PARTS = ("df", "y")
RUN = 16_384  # arrivals of one batch id in a state entry, at most
HOUR_US = 3_600_000_000
OUTPUT = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("message", T.StringType()),
])


def _fold(batch_ids: pd.Series, parts: pd.Series, before) -> tuple[np.ndarray, str | None]:
    """Which arrivals of a sorted run trigger, and the part that waits at its end, after
    ``before`` = (batch id, part that waits).

    Arrivals alternate between waiting and triggering as long as each differs from the
    one before it, starting anew from the last that does not (or begins its batch)."""
    n = len(parts)
    head = (batch_ids != batch_ids.shift(1)).to_numpy()
    change = (parts != parts.shift(1)).to_numpy() & ~head
    place = np.arange(n)
    if before is not None and batch_ids.iloc[0] == before[0] and before[1] is not None:
        change[0] = parts.iloc[0] != before[1]
    anchor = np.maximum.accumulate(np.where(change, -1, place))  # -1: the arrival before the run waits
    triggered = change & ((place - anchor) % 2 == 1)
    return triggered, None if triggered[-1] else parts.iloc[-1]


def rendezvous_batch(arrivals: DataFrame) -> DataFrame:
    """Batch twin over classified arrivals (``status == 'accepted'``)."""
    acc = arrivals.where(F.col("status") == "accepted").select("batch_id", "event_id", "ts", "file_type", "folder")
    ranged = _checkpointed_ranges(acc, ["batch_id"], ["ts", "event_id"], None)

    def ends(frames):
        """The last batch id, and what waits at the end for each part that may wait before."""
        first, states = None, {w: (None, None) for w in ("none", *PARTS)}
        for pdf in frames:
            if not pdf.empty:
                if first is None:
                    first = pdf["batch_id"].iloc[0]
                    states = {w: (first, None if w == "none" else w) for w in states}
                last = pdf["batch_id"].iloc[-1]
                states = {w: (last, _fold(pdf["batch_id"], pdf["file_type"], s)[1]) for w, s in states.items()}
        if first is not None:
            yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "first": [first], "last": [last], **{w: [s[1]] for w, s in states.items()}})

    starts, held = {}, (None, None)
    for r in sorted(ranged.select("batch_id", "file_type").mapInPandas(ends, "pid int, first string, last string, none string, df string, y string").collect()):
        if held[0] == r["first"]:
            starts[r["pid"]] = held
        waits = held[1] if held[0] == r["first"] else None
        held = (r["last"], r[waits or "none"])

    def answer(frames):
        state = starts.get(TaskContext.get().partitionId())
        for pdf in frames:
            if not pdf.empty:
                triggered, waits = _fold(pdf["batch_id"], pdf["file_type"], state)
                state = (pdf["batch_id"].iloc[-1], waits)
                waiting = pdf["file_type"].map(lambda t: MSG_WAITING.format(t=t))
                yield pd.DataFrame({"batch_id": pdf["batch_id"], "event_id": pdf["event_id"], "folder": pdf["folder"],
                                    "message": waiting.mask(triggered, MSG_TRIGGERED)})

    return ranged.mapInPandas(answer, OUTPUT)


class RendezvousProcessor(StatefulProcessor):
    """Keyed state: the waiting part, and arrivals ahead of the watermark in sorted runs.

    A run is one state entry with one timer, of its first arrival, so the state is read and
    written once a run.  Full runs are cut by hour: a busy batch id holds an hour at a time
    in memory.  With ``expiry_ms`` a part that has waited so long (in event time) is forgotten."""

    def __init__(self, expiry_ms: int | None = None):
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "part string, since long")
        self.runs = handle.getMapState("runs", "at long, us long, n long", "arrivals string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        passed, run, places = timerValues.getCurrentWatermarkInMs(), [], {}
        for r in rows:
            # a time that the watermark has passed is answered at the next one; none is lost
            run.append([max(r["us"] // 1000, passed + 1), r["us"], r["event_id"], r["file_type"], r["folder"]])
            if len(run) == RUN:
                for _, hour in itertools.groupby(sorted(run), lambda a: a[1] // HOUR_US):
                    self._hold(list(hour), places)
                run = []
        if run:
            self._hold(sorted(run), places)
        return iter(())

    def _hold(self, run: list, places: dict) -> None:
        """Keep a sorted run; ``places`` are the next free ones of this call, by first time."""
        first = tuple(run[0][:2])
        n = places.get(first, 0)
        while self.runs.containsKey((*first, n)):
            n += 1
        places[first] = n + 1
        self.runs.updateValue((*first, n), (json.dumps(run),))
        self.handle.registerTimer(first[0])

    def _passed(self, limit: int) -> Iterator[list]:
        """Arrivals up to ``limit`` in order, taken out of the state; a run is read when its
        first arrival is next."""
        due = sorted((tuple(k) for k in self.runs.keys() if k[0] <= limit), reverse=True)
        heads, places = [], {}
        while due or heads:
            while due and (not heads or due[-1][:2] <= tuple(heads[0][0][:2])):
                run = iter(json.loads(self.runs.getValue(due[-1])[0]))
                self.runs.removeKey(due.pop())
                heapq.heappush(heads, (next(run), len(due), run))
            arrival, n, run = heads[0]
            if arrival[0] > limit:
                heapq.heappop(heads)
                self._hold([arrival, *run], places)
                continue
            yield arrival
            following = next(run, None)
            if following is None:
                heapq.heappop(heads)
            else:
                heapq.heapreplace(heads, (following, n, run))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        before = self.waiting.get() if self.waiting.exists() else (None, 0)
        part, since = self._kept(*before, now)
        for at, _, event_id, file_type, folder in self._passed(max(now, timerValues.getCurrentWatermarkInMs())):
            if at != now:
                part, since = self._kept(part, since, at)
                now = at
            met = part is not None and part != file_type
            part, since = (None, 0) if met else (file_type, at)
            yield Row(batch_id=key[0], event_id=event_id, folder=folder, message=MSG_TRIGGERED if met else MSG_WAITING.format(t=file_type))
        if (part, since) == tuple(before):
            return
        if part is None:
            self.waiting.clear()
        else:
            self.waiting.update((part, since))
            if self.expiry_ms is not None:
                self.handle.registerTimer(since + self.expiry_ms)

    def _kept(self, part: str | None, since: int, at: int) -> tuple:
        """What still waits at a time."""
        gone = part is not None and self.expiry_ms is not None and at >= since + self.expiry_ms
        return (None, 0) if gone else (part, since)

    def close(self) -> None:
        pass


def rendezvous_stream(arrivals: DataFrame, lateness: str = "1 hour", expiry_ms: int | None = None) -> DataFrame:
    """Streaming rendezvous over classified arrivals.

    An arrival is answered once the watermark (greatest event time less ``lateness``)
    passes it; the last ones when a later run or a tick (``runner.tick``) moves it on.
    Arrivals later than that are answered too, after those already answered."""
    marked = after_watermark(arrivals.withWatermark("ts", lateness), F.col("status") == "accepted", "ts")
    acc = marked.select("batch_id", "event_id", F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("us"), "file_type", "folder")
    return acc.groupBy("batch_id").transformWithState(RendezvousProcessor(expiry_ms), OUTPUT, "Append", "EventTime")
