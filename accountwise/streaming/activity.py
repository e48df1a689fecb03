"""Incremental account activity with late data, and first-time churn alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from accountwise.session import run_dir

LOCAL_MERGE = ("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def windowed_activity(
    events: DataFrame, lateness: str = "2 days", width: str = "7 days", slide: str = "1 day"
) -> DataFrame:
    """Events and value per account and sliding window. Events later than ``lateness`` are dropped and closed
    windows leave the state. Partial aggregation runs before the shuffle, so a hot account is combined first."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", width, slide), "account_id")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
        .select("account_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "events", "value")
    )


def activity_sessions(events: DataFrame, lateness: str = "2 days", gap: str = "12 hours") -> DataFrame:
    """Sessions per account: events less than ``gap`` apart belong together.

    Run it under ``LOCAL_MERGE`` (``drain`` does), so that a task shuffles sessions instead of events. Start and end are
    aggregates: a filter on the fields of the window would be pushed below the merge of sessions and cut them.
    """
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.session_window("ts", gap), "account_id")
        .agg(F.min("ts").alias("session_start"), (F.max("ts") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
             F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
        .select("account_id", "session_start", "session_end", "events", "value")
    )


def with_open(
    closed: DataFrame, events: DataFrame, compute: Callable[[DataFrame], DataFrame], end: str, lateness: str = "2 days"
) -> DataFrame:
    """``closed`` windows of a drained stream, and those that still wait for the watermark, flagged ``is_open``.

    ``events`` are the stream's events as a batch. A sliding window that is open has dropped no event, so the batch gives
    it exactly; an open session also counts events that were too late for the stream.
    """
    mark = events.agg(F.max("ts") - F.expr(f"INTERVAL {lateness}")).scalar()
    waiting = compute(events).where(F.col(end) > mark)
    return closed.withColumn("is_open", F.lit(False)).unionByName(waiting.withColumn("is_open", F.lit(True)))


def first_alerts(snapshots: DataFrame, lateness: str = "1 day") -> DataFrame:
    """One High alert per account and week, however often the account is scored.

    ``snapshots`` carry ``scored_at``. The week is part of the key, so an account is reported again in the
    next week, and the watermark removes the keys of past weeks from the state.
    """
    # a plain copy of the time: the week must be the only event-time column
    time = F.timestamp_micros(F.unix_micros("scored_at")).alias("scored_at")
    return (
        snapshots.where(F.col("risk_level") == "High")
        .withWatermark("scored_at", lateness)
        .select("account_id", F.window("scored_at", "7 days").alias("week"), time, "churn_risk_score")
        .dropDuplicates(["account_id", "week"])
        .select("account_id", F.col("week.start").alias("week_start"), "scored_at", "churn_risk_score")
    )


ALERT = "account_id {key}, kind string, at timestamp, churn_risk_score double, late_rows long"


class Cooling(StatefulProcessor):
    """Per account: the time of the last alert, kept by a timer until the cooling period is over.

    It takes rows: an account has a few a batch, for which a pandas frame each would cost more than all the rest.
    """

    def __init__(self, cooling_ms: int):
        self.cooling_ms = cooling_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_alert", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        found = [(row["at_ms"], row["churn_risk_score"]) for row in rows]
        on_time = sorted((x for x in found if x[0] >= mark), key=lambda x: x[0])
        out = []
        if len(on_time) < len(found):
            out.append(Row(account_id=key[0], kind="late", at=None, churn_risk_score=None, late_rows=len(found) - len(on_time)))
        last = self.last.get()[0] if self.last.exists() else None
        before = last
        for at, score in on_time:
            if last is None or at >= last + self.cooling_ms:
                last = at
                time = datetime.fromtimestamp(at // 1000, timezone.utc).replace(microsecond=at % 1000 * 1000)
                out.append(Row(account_id=key[0], kind="alert", at=time, churn_risk_score=score, late_rows=0))
        if last != before:
            self.last.update((last,))
            if before is not None:
                self.handle.deleteTimer(before + self.cooling_ms)
            self.handle.registerTimer(last + self.cooling_ms)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def cooled_alerts(snapshots: DataFrame, cooling: timedelta = timedelta(days=7), lateness: str = "1 day") -> DataFrame:
    """A High alert of an account, then none until the cooling period after it is over, in event time.

    Rows of one batch are taken by time. A row that is later than ``lateness`` raises no alert, but is reported in a row of
    kind ``late`` with the number of such rows. State holds one time per account in cooling; its timer removes it. Run it
    under ``STATE_STORE`` (``drain`` does).
    """
    # the watermark follows the batch, but its column does not reach the operator, which would drop late rows unseen
    marked = snapshots.where(F.col("risk_level") == "High").withColumn("seen_at", F.col("scored_at")).withWatermark("seen_at", lateness)
    rows = marked.select("account_id", (F.unix_micros("scored_at") / 1000).cast("long").alias("at_ms"), "churn_risk_score")
    key = snapshots.schema["account_id"].dataType.simpleString()
    return rows.groupBy("account_id").transformWithState(
        Cooling(int(cooling.total_seconds() * 1000)), ALERT.format(key=key), "Append", "eventTime")


STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


def drain(spark: SparkSession, stream: DataFrame, label: str, base: str | None = None) -> DataFrame:
    """Process everything available, then stop. Output and checkpoint live in the shared folder, or below ``base``, where a
    later call goes on from them."""
    base = base or run_dir(spark, label)
    settings = (LOCAL_MERGE, STATE_STORE)
    before = {name: spark.conf.get(name, None) for name, _ in settings}
    for setting in settings:
        spark.conf.set(*setting)
    try:
        query = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
