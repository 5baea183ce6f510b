"""Requests held in parts: one set of calls to the state store for a part, the same announcements."""

from __future__ import annotations

import json
from collections import Counter

from test_properties import DECLARED, RECEIVED, FakeClock

from tallymark.streaming import processor

KEYS = ["req_id", "fo_id"]


class PartState:
    """State of one part: counts every call."""

    def __init__(self):
        self.calls, self.timers, self.rows, self.due = 0, set(), [], None

    def getListState(self, name, schema):
        state = self

        class Stored:
            def get(self):
                state.calls += 1
                return iter(state.rows)

            def put(self, rows):
                state.calls += 1
                state.rows = list(rows)

            def clear(self):
                state.calls += 1
                state.rows = []

        return Stored()

    def getValueState(self, name, schema):
        state = self

        class Timer:
            def get(self):
                state.calls += 1
                return state.due

            def update(self, due):
                state.calls += 1
                state.due = due

            def clear(self):
                state.calls += 1
                state.due = None

        return Timer()

    def registerTimer(self, due):
        self.calls += 1
        self.timers.add(due)

    def deleteTimer(self, due):
        self.calls += 1
        self.timers.remove(due)


class Fired:
    def __init__(self, at_ms):
        self.at_ms = at_ms

    def getExpiryTimeInMs(self):
        return self.at_ms


def message(n, second, declared=None, received=(0, 0)):
    row = {"req_id": f"REQ-{n}", "fo_id": None, "seq": 0, "is_control": declared is not None, "us": second * 1_000_000}
    row |= dict(zip(DECLARED, declared or (None, None))) | dict(zip(RECEIVED, received))
    return {"part": 0, "message": json.dumps(row)}


class Part:
    def __init__(self, ttl_ms=20_000, reset=False):
        self.state = PartState()
        self.subject = processor.PartProcessor(KEYS, DECLARED, RECEIVED, ttl_ms, reset)
        self.subject.init(self.state)

    def take(self, *rows, watermark_ms=0):
        return [(r["req_id"], r["status"]) for r in self.subject.handleInputRows((0,), iter(rows), FakeClock(watermark_ms))]

    def fire(self, watermark_ms):
        found = []
        for due in sorted(t for t in self.state.timers if t < watermark_ms):
            rows = self.subject.handleExpiredTimer((0,), FakeClock(watermark_ms), Fired(due))
            found += [(r["req_id"], r["status"], r["at_us"]) for r in rows]
            self.state.timers.remove(due)
        return found


def test_calls_are_those_of_a_part_however_many_requests_it_has():
    part = Part()
    rows = [message(n, n % 7, declared=(1, 0)) for n in range(500)] + [message(n, 9, received=(1, 0)) for n in range(0, 500, 2)]
    assert Counter(part.take(*rows)) == Counter((f"REQ-{n}", "COMPLETE") for n in range(0, 500, 2))
    assert len(part.state.timers) == 1 and len(part.state.rows) == 500
    assert part.state.calls <= 6
    part.state.calls = 0
    assert len(part.fire(1_000_000)) == 250
    assert part.state.calls <= 4 and not part.state.rows and not part.state.timers


def test_each_request_expires_at_its_own_time():
    part = Part()
    part.take(message(0, 0, declared=(1, 0)), message(1, 10, declared=(1, 0)), message(2, 5, declared=(None, 0)))
    assert part.state.timers == {20_000}
    assert part.fire(20_000) == []  # not passed yet
    assert part.fire(25_001) == [("REQ-0", "EXPIRED", 20_000_000), ("REQ-2", "BAD_CTRL", 25_000_000)]
    assert part.state.timers == {30_000}
    assert part.take(message(1, 28, received=(1, 0)), watermark_ms=25_001) == [("REQ-1", "COMPLETE")]
    assert part.fire(30_001) == [] and part.state.timers == {48_000}
    assert part.fire(48_001) == [] and not part.state.rows


def test_rows_after_the_watermark_passed_start_afresh_and_others_stay():
    part = Part()
    part.take(message(0, 0, declared=(1, 0)), message(1, 50, declared=(1, 0)))
    assert part.take(message(0, 90, received=(1, 0)), watermark_ms=55_000) == [("REQ-0", "EXPIRED")]
    assert part.fire(55_000) == [] and part.state.timers == {70_000}
    assert part.take(message(1, 60, received=(1, 0)), watermark_ms=55_000) == [("REQ-1", "COMPLETE")]


def test_without_an_idle_time_there_are_no_timers():
    part = Part(ttl_ms=None, reset=True)
    assert part.take(message(0, 0, declared=(1, 0)), message(0, 1, received=(1, 0))) == [("REQ-0", "COMPLETE")]
    assert part.take(message(0, 2, received=(1, 0))) == [("REQ-0", "COMPLETE")]
    assert not part.state.timers
