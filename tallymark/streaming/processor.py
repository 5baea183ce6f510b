"""Executor-side state logic of one request: counters, completion, idle expiry."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

COMPLETE = "COMPLETE"
EXPIRED = "EXPIRED"
BAD_CTRL = "BAD_CTRL"


def combine_batches(batches, keys, declared, received):
    """Map-side combine of feed rows, one Arrow batch at a time.

    Data rows of a request and tick become one row with summed counts and the newest time;
    of its control rows of a tick the newest stays. Whether a row is late is decided by
    its tick, so it does not matter which rows it shares an Arrow batch with.
    """
    groups = [*keys, "tick"]
    for batch in batches:
        is_control = batch["is_control"].to_numpy(dtype=bool)
        records = batch[~is_control]
        if len(records):
            summed = records.groupby(groups, sort=False, as_index=False, dropna=False).agg(
                {"us": "max", "seq": "max", **{name: "sum" for name in received}}
            )
            summed["is_control"] = False
            for name in declared:
                summed[name] = pd.array([None] * len(summed), dtype="Int64")
            yield summed[batch.columns]
        controls = batch[is_control]
        if len(controls):
            yield controls.sort_values(["us", "seq"]).drop_duplicates(groups, keep="last")[batch.columns]


class Delivery:
    """The state of one request while it is being worked on."""

    def __init__(self, width, stored):
        if stored is None:
            self.declared, self.control = None, None
            self.received = [0] * width
            self.last_us = self.timer_ms = None
            self.done = False
            return
        declared, received = stored[:width], stored[width : 2 * width]
        control_us, control_seq, self.last_us, self.timer_ms, self.done = stored[2 * width :]
        self.control = None if control_us is None else (control_us, control_seq)
        self.declared = None if control_us is None else list(declared)
        self.received = list(received)

    def stored(self):
        declared = self.declared or [None] * len(self.received)
        return (*declared, *self.received, *(self.control or (None, None)), self.last_us, self.timer_ms, self.done)

    def declare(self, counts, us, seq):
        """A control message replaces the current one unless it is older."""
        if self.control is None or (us, seq) >= self.control:
            self.declared, self.control = list(counts), (us, seq)

    def receive(self, counts, us):
        self.received = [have + more for have, more in zip(self.received, counts)]
        self.last_us = us if self.last_us is None else max(self.last_us, us)

    def complete(self):
        return not self.done and self.declared == self.received

    def unnamed(self):
        """Whether the current control message lacks a type (its count is null): never complete."""
        return self.declared is not None and None in self.declared


class DeliveryProcessor(StatefulProcessor):
    """Holds one request's newest declaration and received counts until complete or idle too long.

    State: declared counts (null before the first control message), received counts,
    time and sequence number of the control message, time of the last message, the
    pending timer, and whether completion has been announced.
    """

    def __init__(self, keys, declared, received, ttl_ms, per_message, reset_on_complete):
        self.output = [*keys, "status", *declared, *received, "at_us"]
        self.declared = list(declared)
        self.received = list(received)
        self.ttl_ms = ttl_ms
        self.per_message = per_message
        self.reset_on_complete = reset_on_complete

    def _fields(self):
        counts = ", ".join(f"{name} bigint" for name in [*self.declared, *self.received])
        return f"{counts}, control_us bigint, control_seq bigint, last_us bigint, timer_ms bigint, done boolean"

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("delivery", self._fields())

    def _row(self, key, status, delivery, at_us):
        declared = [count or 0 for count in delivery.declared or [0] * len(self.declared)]
        return Row(*self.output)(*key, status, *declared, *delivery.received, at_us)

    def _announce(self, key, delivery, at_us):
        row = self._row(key, COMPLETE, delivery, at_us)
        if self.reset_on_complete:
            delivery.received = [0] * len(self.received)
        else:
            delivery.done = True
        return row

    def _take(self, row, delivery):
        if row["is_control"]:
            delivery.declare([row[name] for name in self.declared], row["us"], row["seq"])
        delivery.receive([row[name] for name in self.received], row["us"])

    def _idle(self, delivery, timerValues):
        """Whether the watermark passed while the request was idle. Spark hands over new
        rows before it fires timers, so what was held has expired already."""
        return delivery.timer_ms is not None and delivery.timer_ms <= timerValues.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows, timerValues):
        delivery = Delivery(len(self.declared), self.state.get())
        if self._idle(delivery, timerValues):
            yield from self._expire(key, delivery)
            self.handle.deleteTimer(delivery.timer_ms)
            delivery = Delivery(len(self.declared), None)
        if self.per_message:
            rows = sorted(rows, key=lambda row: (row.us, not row.is_control, row.seq))
        newest_us = None
        for row in rows:
            self._take(row, delivery)
            newest_us = row.us if newest_us is None else max(newest_us, row.us)
            if self.per_message and delivery.complete():
                yield self._announce(key, delivery, row.us)
        if not self.per_message and delivery.complete():
            yield self._announce(key, delivery, newest_us)
        self._restart_timer(delivery)
        self.state.update(delivery.stored())

    def _due(self, delivery):
        return None if self.ttl_ms is None else delivery.last_us // 1000 + self.ttl_ms

    def _restart_timer(self, delivery):
        due = self._due(delivery)
        if due != delivery.timer_ms:
            if delivery.timer_ms is not None:
                self.handle.deleteTimer(delivery.timer_ms)
            self.handle.registerTimer(due)
            delivery.timer_ms = due

    def _expire(self, key, delivery):
        if not delivery.done:
            status = BAD_CTRL if delivery.unnamed() else EXPIRED
            yield self._row(key, status, delivery, delivery.timer_ms * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        delivery = Delivery(len(self.declared), self.state.get())
        self.state.clear()
        yield from self._expire(key, delivery)

    def close(self):
        pass


class PartProcessor(DeliveryProcessor):
    """The same for a part of all requests: what is held of them comes and goes in one piece.

    Every call to the state store, every timer and every answer of a key is a message to and
    from the JVM, which takes longer than the work on a request; here a part has them, not a request.
    A row is one JSON text, as each of its columns would be converted by itself; rows are folded
    one at a time, so only the deliveries of a part are in memory.

    State: a list of the part's requests, each its key and what ``DeliveryProcessor`` holds, and
    the part's one timer, at the earliest moment at which one of them has been idle too long.
    """

    def __init__(self, keys, declared, received, ttl_ms, reset_on_complete):
        super().__init__(keys, declared, received, ttl_ms, False, reset_on_complete)
        self.keys = list(keys)

    def init(self, handle):
        self.handle = handle
        keys = ", ".join(f"{name} string" for name in self.keys)
        self.state = handle.getListState("delivery", f"{keys}, {self._fields()}")
        if self.ttl_ms is not None:
            self.timer = handle.getValueState("timer", "due_ms bigint")

    def _held(self):
        width = len(self.keys)
        return {stored[:width]: stored[width:] for stored in map(tuple, self.state.get())}

    def _keep(self, held, fired=None):
        """Store the requests of the part and see to its timer; Spark itself removes one that ``fired``."""
        if held:
            self.state.put([(*request, *stored) for request, stored in held.items()])
        else:
            self.state.clear()
        if self.ttl_ms is None:
            return
        due = min((stored[-2] for stored in held.values()), default=None)
        pending = None if fired is not None else self.timer.get()
        if due is None:
            self.timer.clear()
        elif pending is None or due < pending[0]:
            if pending is not None:
                self.handle.deleteTimer(pending[0])
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def handleInputRows(self, key, rows, timerValues):
        held, open_now = self._held(), {}
        for packed in rows:
            row = json.loads(packed["message"])
            request = tuple([row[name] for name in self.keys])
            if request not in open_now:
                delivery = Delivery(len(self.declared), held.get(request))
                if self._idle(delivery, timerValues):
                    yield from self._expire(request, delivery)
                    delivery = Delivery(len(self.declared), None)
                open_now[request] = [delivery, row["us"]]
            current = open_now[request]
            self._take(row, current[0])
            current[1] = max(current[1], row["us"])
        for request, (delivery, newest_us) in open_now.items():
            if delivery.complete():
                yield self._announce(request, delivery, newest_us)
            delivery.timer_ms = self._due(delivery)
            held[request] = delivery.stored()
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Spark fires what lies before the watermark.
        fired = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(fired, timerValues.getCurrentWatermarkInMs() - 1)
        held = self._held()
        idle = [request for request, stored in held.items() if stored[-2] <= passed]
        for request in idle:
            yield from self._expire(request, Delivery(len(self.declared), held.pop(request)))
        self._keep(held, fired)
