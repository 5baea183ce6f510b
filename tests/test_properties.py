"""Laws that must hold for any messages, with a plain Python account of them as the judge."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from frames import NAMES, control_frame, data_frame, key
from hypothesis import HealthCheck, given, settings, strategies as st

from tallymark.operators import history as H, reconcile as R
from tallymark.streaming import processor

REQUESTS = range(4)
COUNTS = st.tuples(st.integers(0, 2), st.integers(0, 2))
CONTROLS = st.lists(st.tuples(st.sampled_from(REQUESTS), COUNTS, st.integers(0, 6)), max_size=6)
RECORDS = st.lists(st.tuples(st.sampled_from(REQUESTS), st.sampled_from("TMU"), st.integers(0, 6)), max_size=12)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
MANY = settings(max_examples=300, deadline=None)


def frames(spark, controls, records):
    control = control_frame(spark, [(n, *counts, ts, i) for i, (n, counts, ts) in enumerate(controls)] or [(99, 0, 0, 0, 0)])
    data = data_frame(spark, [(n, kind, ts, i) for i, (n, kind, ts) in enumerate(records)] or [(98, "U", 0, 0)])
    return control, data


def expected_statuses(controls, records):
    latest = {}
    for i, (n, counts, ts) in enumerate(controls):
        if n not in latest or (ts, i) > latest[n][0]:
            latest[n] = ((ts, i), counts)
    received = Counter((n, kind) for n, kind, _ in records)
    seen = {n for n, *_ in records}
    out = {}
    for n in set(latest) | seen:
        have = (received[n, "T"], received[n, "M"])
        if n not in latest:
            out[key(n)[0]] = "NO_CTRL"
            continue
        want = latest[n][1]
        if want == have:
            out[key(n)[0]] = "COMPLETE"
        elif n not in seen:
            out[key(n)[0]] = "NO_DATA"
        elif want[0] < have[0] or want[1] < have[1]:
            out[key(n)[0]] = "OVER"
        else:
            out[key(n)[0]] = "INCOMPLETE"
    return out


@FEW
@given(controls=CONTROLS, records=RECORDS)
def test_status_of_any_messages(spark, controls, records):
    control, data = frames(spark, controls, records)
    rows = R.reconcile(control, data, order_by=("ts", "seq")).collect()
    found = {r["req_id"]: r["status"] for r in rows if r["req_id"] not in ("REQ-98", "REQ-99")}
    assert found == expected_statuses(controls, records)


@FEW
@given(controls=CONTROLS, records=RECORDS, pick=st.randoms(use_true_random=False))
def test_order_of_arrival_does_not_matter(spark, controls, records, pick):
    control, data = frames(spark, controls, records)
    statuses = lambda c, d: sorted(map(tuple, R.reconcile(c, d, order_by=("ts", "seq")).collect()))
    shuffle = lambda df: spark.createDataFrame(pick.sample(df.collect(), df.count()), df.schema)
    assert statuses(control, data) == statuses(shuffle(control), shuffle(data))


def first_moments(controls, records):
    feed = [(ts, 0, i, n, counts) for i, (n, counts, ts) in enumerate(controls)]
    feed += [(ts, 1, i, n, kind) for i, (n, kind, ts) in enumerate(records)]
    want, have, first = {}, {}, {}
    for ts, kind, _, n, body in sorted(feed, key=lambda m: m[:3]):
        have.setdefault(n, [0, 0])
        if kind == 0:
            want[n] = list(body)
        elif body in "TM":
            have[n]["TM".index(body)] += 1
        if n in want and want[n] == have[n]:
            first.setdefault(n, ts)
    return first


@FEW
@given(controls=CONTROLS, records=RECORDS)
def test_first_completion_of_any_messages(spark, controls, records):
    control, data = frames(spark, controls, records)
    for hot_rows in (None, 1):
        rows = H.first_completion(control, data, hot_rows=hot_rows).collect()
        found = {int(r["req_id"][4:]): r["completed_at"].second for r in rows}
        found.pop(99, None)
        assert found == first_moments(controls, records)


class FakeState:
    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, due):
        self.timers.add(due)

    def deleteTimer(self, due):
        self.timers.remove(due)


class FakeClock:
    def __init__(self, watermark_ms=0):
        self.watermark_ms = watermark_ms

    def getCurrentWatermarkInMs(self):
        return self.watermark_ms


DECLARED = ["declared_trade_data", "declared_market_data"]
RECEIVED = ["received_trade_data", "received_market_data"]
MESSAGES = st.lists(
    st.one_of(
        st.tuples(st.just("C"), COUNTS),
        st.tuples(st.sampled_from("TMU"), st.just(None)),
    ),
    max_size=10,
)


class Message(dict):
    __getattr__ = dict.__getitem__


def feed_row(position, kind, counts):
    flags = [int(kind == "T"), int(kind == "M")]
    return Message(
        us=position * 1_000_000,
        seq=position,
        is_control=kind == "C",
        **dict(zip(DECLARED, counts or (None, None))),
        **dict(zip(RECEIVED, flags)),
    )


def announcements(messages, cuts, per_message):
    state = FakeState()
    subject = processor.DeliveryProcessor(["k"], DECLARED, RECEIVED, 20_000, per_message, False)
    subject.init(state)
    rows = [feed_row(i, *message) for i, message in enumerate(messages)]
    out = []
    for begin, end in zip([0, *cuts], [*cuts, len(rows)]):
        if rows[begin:end]:
            out += [(r["status"], r["at_us"]) for r in subject.handleInputRows(("REQ-0",), iter(rows[begin:end]), FakeClock())]
    return out, state


@MANY
@given(messages=MESSAGES, data=st.data())
def test_micro_batches_do_not_change_what_is_announced_per_message(messages, data):
    cuts = sorted(data.draw(st.sets(st.integers(1, 9), max_size=3)))
    cuts = [cut for cut in cuts if cut < len(messages)]
    split, state = announcements(messages, cuts, True)
    whole, _ = announcements(messages, [], True)
    assert split == whole and len(split) <= 1
    assert len(state.timers) == (1 if messages else 0)


@MANY
@given(messages=MESSAGES)
def test_one_message_per_batch_equals_per_message(messages):
    cuts = list(range(1, len(messages)))
    assert announcements(messages, cuts, False)[0] == announcements(messages, cuts, True)[0]


@MANY
@given(
    rows=st.lists(st.tuples(st.integers(0, 2), st.sampled_from("CTMU"), COUNTS, st.integers(0, 5)), min_size=1, max_size=15)
)
def test_combining_keeps_counts_and_newest_control(rows):
    batch = pd.DataFrame(
        [
            {
                "req_id": key(n)[0], "fo_id": key(n)[1], "seq": i,
                "is_control": kind == "C",
                **dict(zip(DECLARED, counts if kind == "C" else (None, None))),
                **dict(zip(RECEIVED, (int(kind == "T"), int(kind == "M")))),
                "us": ts * 1_000_000,
                "tick": 0,
            }
            for i, (n, kind, counts, ts) in enumerate(rows)
        ]
    ).astype({name: "Int64" for name in DECLARED})
    ticks = batch.assign(tick=batch["us"])
    by_tick = pd.concat(processor.combine_batches([ticks], ["req_id", "fo_id"], DECLARED, RECEIVED))
    assert (by_tick["us"] == by_tick["tick"]).all() and set(by_tick["tick"]) == set(ticks["tick"])
    out = pd.concat(processor.combine_batches([batch], ["req_id", "fo_id"], DECLARED, RECEIVED))
    assert list(out.columns) == list(batch.columns)
    assert len(out) <= 2 * batch["req_id"].nunique()
    for name in RECEIVED:
        assert out.groupby("req_id")[name].sum().to_dict() == batch.groupby("req_id")[name].sum().to_dict()
    assert out.groupby("req_id")["us"].max().to_dict() == batch.groupby("req_id")["us"].max().to_dict()
    controls = [(i, n, counts, ts) for i, (n, kind, counts, ts) in enumerate(rows) if kind == "C"]
    newest = {key(n)[0]: counts for i, n, counts, ts in sorted(controls, key=lambda c: (c[3], c[0]))}
    kept = out[out["is_control"]].set_index("req_id")[DECLARED]
    assert {k: tuple(v) for k, v in zip(kept.index, kept.to_numpy().tolist())} == newest


def test_rows_after_the_watermark_passed_an_idle_request_start_afresh():
    state = FakeState()
    subject = processor.DeliveryProcessor(["k"], DECLARED, RECEIVED, 20_000, False, False)
    subject.init(state)
    take = lambda row, watermark: list(subject.handleInputRows(("REQ-0",), iter([row]), FakeClock(watermark)))
    assert take(feed_row(0, "C", (1, 0)), 0) == []
    assert [r["status"] for r in take(feed_row(90, "T", None), 55_000)] == ["EXPIRED"]
    assert state.timers == {110_000}
    assert state.value[2:4] == (1, 0) and state.value[0] is None


def test_names_match_the_frames():
    assert set(NAMES) == set("TMU")
