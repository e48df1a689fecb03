from datetime import datetime, timedelta

from pyspark.sql import functions as F

from accountwise.session import run_dir
from accountwise.streaming import activity

START = datetime(2024, 1, 1)


def stream_of(spark, batches, schema):
    """One file per batch, read one file per trigger."""
    folder = run_dir(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


EVENT = "account_id string, ts timestamp, value double"


def at(hours):
    return START + timedelta(hours=hours)


def test_late_events_are_dropped_and_open_windows_wait(spark):
    # a batch drops what was late when the batch before it ended
    batches = [[("A", at(1), 1.0), ("A", at(30), 1.0)], [("A", at(100), 1.0)], [("A", at(101), 1.0)],
               [("A", at(2), 5.0), ("A", at(102), 1.0)]]
    stream = activity.windowed_activity(stream_of(spark, batches, EVENT), "24 hours", "24 hours", "24 hours")
    got = {r["window_start"]: r["value"] for r in activity.drain(spark, stream, "w").collect()}
    assert got == {START: 1.0, START + timedelta(days=1): 1.0}  # the late 5.0 is gone, the last window still open
    rows = [r for batch in batches for r in batch]
    closed = spark.createDataFrame([("A", k, k + timedelta(days=1), 1, v) for k, v in got.items()], "account_id string, window_start timestamp, window_end timestamp, events long, value double")
    compute = lambda df: activity.windowed_activity(df, "24 hours", "24 hours", "24 hours")
    both = activity.with_open(closed, spark.createDataFrame(rows, EVENT), compute, "window_end", "24 hours")
    assert {(r["window_start"], r["is_open"], r["value"]) for r in both.collect()} == {
        (START, False, 1.0), (START + timedelta(days=1), False, 1.0), (START + timedelta(days=4), True, 3.0)}


def test_sessions(spark):
    batches = [[("A", at(0), 1.0), ("A", at(5), 2.0), ("A", at(20), 4.0), ("B", at(1), 8.0)], [("A", at(300), 0.0)]]
    stream = activity.activity_sessions(stream_of(spark, batches, EVENT), "1 hour", "6 hours")
    got = sorted((r["account_id"], r["events"], r["value"]) for r in activity.drain(spark, stream, "s").collect())
    assert got == [("A", 1, 4.0), ("A", 2, 3.0), ("B", 1, 8.0)]


def test_first_alert_once_per_week(spark):
    schema = "account_id string, risk_level string, churn_risk_score double, scored_at timestamp"
    batches = [[("A", "High", 0.9, at(0)), ("B", "Low", 0.1, at(0))], [("A", "High", 0.8, at(24)), ("B", "High", 0.6, at(24))],
               [("C", "High", 0.7, at(24 * 30))], [("A", "High", 0.7, at(24 * 31))]]
    out = activity.drain(spark, activity.first_alerts(stream_of(spark, batches, schema)), "a")
    assert {r["account_id"]: r["n"] for r in out.groupBy("account_id").agg(F.count("*").alias("n")).collect()} == {"A": 2, "B": 1, "C": 1}


def test_cooling_out_of_order_late_rows_and_restart(spark):
    schema = "account_id string, risk_level string, churn_risk_score double, scored_at timestamp"
    folder, base = run_dir(spark, "in"), run_dir(spark, "cooled")

    def arrive(*batches):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        out = activity.drain(spark, activity.cooled_alerts(stream), "c", base)
        return sorted((r["account_id"], r["kind"], r["at"], r["late_rows"]) for r in out.collect() if r["kind"] == "alert"), sum(
            r["late_rows"] for r in out.collect())

    first = arrive(
        # out of order within a batch: the earlier one alerts, the later one is in its cooling period
        [("A", "High", 0.8, at(24)), ("A", "High", 0.9, at(0)), ("B", "Low", 0.1, at(0))],
        [("A", "High", 0.7, at(24 * 6)), ("B", "High", 0.6, at(24 * 6))],
    )
    assert first == ([("A", "alert", at(0), 0), ("B", "alert", at(24 * 6), 0)], 0)
    # restarted: the state is still there, A cools down at day 7 and alerts anew, rows of the first days are late
    second = arrive(
        [("A", "High", 0.7, at(24 * 6 + 1)), ("C", "High", 0.7, at(24 * 8))],
        [("C", "High", 0.7, at(1)), ("D", "High", 0.7, at(2)), ("A", "High", 0.7, at(24 * 9))],
        [("B", "High", 0.7, at(24 * 12))],
    )
    assert second == ([("A", "alert", at(0), 0), ("A", "alert", at(24 * 9), 0), ("B", "alert", at(24 * 6), 0), ("C", "alert", at(24 * 8), 0)], 2)


def test_cooling_takes_plain_rows():
    """Rows of one account: late ones are counted, others taken by time; an unknown score stays unknown."""
    from datetime import timezone
    from types import SimpleNamespace

    from pyspark.sql import Row

    kept, timers = {}, []
    state = SimpleNamespace(exists=lambda: "at" in kept, get=lambda: kept["at"], update=lambda v: kept.update(at=v))
    handle = SimpleNamespace(getValueState=lambda *_: state, registerTimer=timers.append, deleteTimer=timers.remove)
    cooling = activity.Cooling(1000)
    cooling.init(handle)
    rows = [Row(at_ms=t, churn_risk_score=s) for t, s in ((5000, 0.9), (10, 0.8), (4500, None), (5600, 0.7))]
    out = list(cooling.handleInputRows((7,), iter(rows), SimpleNamespace(getCurrentWatermarkInMs=lambda: 100)))
    assert [(r["kind"], r["churn_risk_score"], r["late_rows"]) for r in out] == [("late", None, 1), ("alert", None, 0), ("alert", 0.7, 0)]
    assert out[1]["at"] == datetime.fromtimestamp(4.5, timezone.utc) and kept["at"] == (5600,) and timers == [6600]
