"""Streaming: availableNow equals the batch answer; late rows beyond the
watermark are left out of closed windows."""

import datetime as dt

from pyspark.sql import functions as F

from auditlens.streaming import monitors as MS


def events(spark, rows):
    return spark.createDataFrame(rows, MS.EVENT_SCHEMA)


def breach_input(spark, days, area, files):
    """Five breach days in mixed order over several landed files."""
    rows = [(f"2024-01-{d:02d} 00:00:00", g, a) for d, g, a in days]
    step = -(-len(rows) // files)
    for i in range(0, len(rows), step):
        spark.createDataFrame(rows[i : i + step], "window_start STRING, group STRING, air DOUBLE").coalesce(1).write.mode("append").parquet(area)


def test_breach_runs_do_not_depend_on_arrival(spark):
    days = [(5, "a", 0.5), (1, "a", 0.5), (4, "a", 0.7), (2, "a", 0.6), (3, "a", 0.5), (7, "a", 0.1), (6, "a", 0.9), (1, "b", 0.7), (3, "b", 0.7), (4, "b", None), (2, "c", 0.95)]
    for files in (1, 4, 11):
        area = MS.new_area(spark, "breach-test")
        breach_input(spark, days, f"{area}/in", files)
        got = MS.consecutive_breach_stream(spark, f"{area}/in", area, 0.8, max_files=1).collect()
        assert sorted((r.group, r.window_start[8:10], r.run_length) for r in got) == [("a", "02", 2), ("a", "03", 3), ("a", "04", 4), ("a", "05", 5)]


def test_windows_do_not_depend_on_the_session_zone(spark):
    rows = [(i, dt.datetime(2024, 3, 9 + i % 3, i % 24), i % 3, "view", float(i), "{}") for i in range(100)]
    zone, got = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            area = MS.new_area(spark, "zone")
            events(spark, rows).write.mode("append").parquet(f"{area}/landing")
            got.append(sorted(tuple(r) for r in MS.window_air(MS.scored_stream(spark, f"{area}/landing"), area, "view").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0] == got[1] and len(got[0]) == 3


def test_nothing_emitted_is_an_empty_result(spark):
    area = MS.new_area(spark, "none")
    events(spark, []).write.mode("append").parquet(f"{area}/landing")
    assert MS.window_air(MS.scored_stream(spark, f"{area}/landing"), area, "view").collect() == []


def test_stream_equals_batch_and_late_data(spark):
    d = lambda day, h: dt.datetime(2024, 1, day, h)
    first = [(i, d(1 + i % 5, 1 + i % 20), i % 3, ["view", "click"][i % 2], float(10 + 20 * (i % 4)), "{}") for i in range(200)]
    area = MS.new_area(spark, "test")
    landing = f"{area}/landing"
    events(spark, first).write.mode("append").parquet(landing)
    ckpt = f"{area}/ckpt"
    res = MS.window_air(MS.scored_stream(spark, landing), area, "view", watermark="1 day", checkpoint=ckpt)
    got = {(r["window_start"], r["group"]): r["n"] for r in res.collect()}
    b = events(spark, first).groupBy(F.date_trunc("day", "ts").cast("string").alias("w"), "event_type").count().collect()
    assert got == {(r["w"], r["event_type"]): r["count"] for r in b}
    # a late batch for day 1 arrives after the watermark passed day 5 - 1 day
    late = [(1000 + i, d(1, 3), 0, "view", 100.0, "{}") for i in range(5)]
    events(spark, late).write.mode("append").parquet(landing)
    res2 = MS.window_air(MS.scored_stream(spark, landing), area, "view", watermark="1 day", checkpoint=ckpt)
    got2 = {(r["window_start"], r["group"]): r["n"] for r in res2.collect()}
    assert got2[("2024-01-01 00:00:00", "view")] == got[("2024-01-01 00:00:00", "view")]


class State:
    """A group's state as the stream keeps it."""

    def __init__(self):
        self.value, self.mark, self.timeout, self.hasTimedOut = None, 0, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def getCurrentWatermarkMs(self):
        return self.mark

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms


def test_breach_state_is_bounded_and_keeps_runs():
    import json

    import pandas as pd

    judge, state, got = MS.breach_judge(0.8, 2, 10), State(), {}
    air = [0.5] * 20 + [0.9] + [0.5] * 15 + [None] + [0.1] * 14
    for at in range(0, len(air), 5):
        frame = pd.DataFrame([(d, f"d{d}", air[d]) for d in reversed(range(at, min(at + 5, len(air))))], columns=["day", "window_start", "air"])
        for out in judge(("g",), iter([frame]), state):
            got |= {int(r.day): None if pd.isna(r.run_length) else int(r.run_length) for r in out.itertuples()}
        state.mark = max(0, (at + 4 - 10) * 86_400_000)
        assert len(json.loads(state.get[0])["days"]) <= 16
    want, run = {}, 0
    for d, a in enumerate(air):
        run = run + 1 if a is not None and a < 0.8 else 0
        want[d] = run if run >= 2 else None
    assert got == want
    list(judge(("g",), iter([pd.DataFrame([(3, "d3", 0.99)], columns=["day", "window_start", "air"])]), state))  # long judged
    assert json.loads(state.get[0])["from"] > 3 and state.timeout == (len(air) + 10) * 86_400_000
    state.hasTimedOut = True
    assert list(judge(("g",), iter([]), state)) == [] and not state.exists


def test_late_rows_by_two_counts(spark):
    """Three landings; the last holds rows of long closed days."""
    area = MS.new_area(spark, "late-test")
    d = lambda day: dt.datetime(2024, 1, day, 5)
    for days in ([1, 2, 2], [9, 10], [11], [1, 9, 2, 11], []):
        if days:
            events(spark, [(i, d(x), 1, "view", 1.0, "{}") for i, x in enumerate(days)]).coalesce(1).write.mode("append").parquet(f"{area}/in")
    rows = MS.late_rows(lambda: MS.scored_stream(spark, f"{area}/in", max_files=1), area).collect()
    assert {(r.window_start[8:10], r.n_rows, r.n_counted, r.n_late) for r in rows} == {("01", 2, 1, 1), ("02", 3, 2, 1), ("09", 2, 2, 0), ("10", 1, 1, 0), ("11", 2, 2, 0)}
