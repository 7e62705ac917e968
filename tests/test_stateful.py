"""Streams with state, taken in several batches with late rows, against the same rows at once."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import monitor
from lexmill.streaming import stateful, streams

START = dt.datetime(2024, 3, 1)
SCHEMA = "id long, ts timestamp_ntz, cls string, value double"


def event_rows(seed, hours=40, per_hour=12):
    """Rows of two classes, some of them an hour late, one class with a stretch without rows; some nulls."""
    rng = random.Random(seed)
    rows = []
    for k in range(hours * per_hour):
        at = START + dt.timedelta(minutes=5 * k, seconds=rng.randint(0, 200))
        cls = rng.choice(["a", "b"])
        if cls == "b" and 15 * per_hour < k < 22 * per_hour:
            continue
        slow = (k // (per_hour * 4)) % 2
        rows.append((at + dt.timedelta(minutes=rng.choice([0, 0, 50])), (k, at, cls, None if k % 50 == 0 else round(
            rng.gauss(60 if slow else 30, 10), 1))))
    return [r for _, r in sorted(rows, key=lambda x: x[0])]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with four files in order of arrival, and all their rows as a table."""
    folder, rows = tmp_path_factory.mktemp("events"), event_rows(1)
    for k, part in enumerate(np.array_split(np.arange(len(rows)), 4)):
        spark.createDataFrame([rows[i] for i in part], SCHEMA).coalesce(1).write.parquet(str(folder / f"f{k}"))
    return str(folder / "*"), spark.createDataFrame(rows, SCHEMA)


def stream_of(spark, events):
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(events[0])
    return streams.with_event_time(df, "ts", "1 hour")


def finished(events):
    """The watermark's last place: windows that end by then are finished."""
    return events[1].agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)


def run(spark, df, tmp_path, mode="append"):
    with stateful.rocks_state(spark):
        streams.write_updates(df, str(tmp_path / "out"), str(tmp_path / "log"), mode=mode).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_drift_of_a_stream_equals_the_batch(spark, events, tmp_path):
    base = spark.createDataFrame([(c, float(v)) for c in "ab" for v in range(20, 45)], "cls string, value double")
    hours = 4 * 3_600_000
    stream = stateful.drift_by_window(stream_of(spark, events), base, "ts", "cls", "value", hours)
    got = {(r["class"], dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=r["start_ms"])): tuple(r)[2:7]
           for r in run(spark, stream, tmp_path).drop("batch").collect()}
    batch = monitor.ks_by_window(base, events[1], "value", "ts", "cls", "4 hours")
    want = {(r["cls"], r["window_start"]): tuple(r)[2:7] for r in batch.collect()
            if r["window_start"] + dt.timedelta(hours=4) <= finished(events)}
    assert got.keys() == want.keys() and len(want) > 10
    for k, row in want.items():
        assert row == pytest.approx(got[k], abs=1e-12)
    assert {r[4] for r in want.values()} == {True, False}


def test_alerts_of_a_stream_equal_the_batch(spark, events, tmp_path):
    options = {"limit_ms": 45.0, "max_share": 0.3, "width": "1 hour"}
    windows = monitor.class_latency(stream_of(spark, events), "ts", "cls", "value", **options)
    changes = stateful.alert_states(windows, 2)
    run(spark, changes, tmp_path)
    newest = streams.current_rows(spark, str(tmp_path / "out"), changes.schema, "class", "start_ms")
    got = {(r["class"], dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=r["start_ms"])): (r["windows"], r["state"]) for r in newest.collect()}
    whole = monitor.class_latency(events[1], "ts", "cls", "value", **options).where(F.col("window_end") <= F.lit(finished(events)).cast("timestamp_ntz"))
    want = {(r["class"], r["alert_start"]): (r["windows"], r["state"]) for r in monitor.alert_intervals(whole, 2).collect()}
    assert got == want and len(want) >= 4 and {s for _, s in want.values()} >= {"resolved"}


def test_alert_intervals_by_hand(spark):
    def w(cls, hour, breach):
        at = START + dt.timedelta(hours=hour)
        return cls, at, at + dt.timedelta(hours=1), breach

    rows = [w("a", 0, True), w("a", 1, True), w("a", 2, False), w("a", 3, True), w("a", 4, False), w("a", 5, True), w("a", 6, True),
            w("a", 7, True), w("b", 0, True), w("b", 2, True), w("b", 3, True), w("b", 5, False), w("c", 0, False)]
    df = spark.createDataFrame(rows, "class string, window_start timestamp_ntz, window_end timestamp_ntz, breach boolean")
    got = sorted((r["class"], r["alert_start"].hour, r["alert_end"].hour, r["windows"], r["state"])
                 for r in monitor.alert_intervals(df, 2).collect())
    assert got == [("a", 0, 2, 2, "resolved"), ("a", 5, 8, 3, "firing"), ("b", 2, 4, 2, "resolved")]


def test_ks_test_equals_the_batch(spark):
    a, b = [1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 9.0]
    tables = [tuple(np.unique(np.array(x), return_counts=True)) for x in (a, b)]
    got = stateful.ks_test(*tables)
    row = monitor.ks_drift(*[spark.createDataFrame([(v,) for v in x], "v double") for x in (a, b)], "v").first()
    assert got == pytest.approx((row["statistic"], row["n"], row["m"], row["p_value"]), abs=1e-12)
