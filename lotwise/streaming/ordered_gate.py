"""Retrain gate that puts late reports in order: early days wait in state until a timer says that their turn has come."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lotwise.spec import RetrainPolicy

OUTPUT = "model string, day_number int, features_critical int, days_since_retrain int, retrain boolean, blocked boolean"
DAY_MS = 86_400_000
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class OrderedGate(StatefulProcessor):
    """One list of waiting reports, one value with the last retrain day and one timer a day, for each model."""

    def __init__(self, policy: RetrainPolicy, start_day: int):
        self.policy, self.start_day = policy, start_day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "day int, critical int, reliable boolean")
        self.last = handle.getValueState("last", "day int")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for r in rows:
            self.waiting.appendValue((r["day_number"], r["features_critical"], r["drift_reliable"]))
            self.handle.registerTimer(r["day_number"] * DAY_MS)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """Decides all waiting days up to the timer's, in order; the others go on waiting."""
        until = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS
        held = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        due, rest = [r for r in held if r[0] <= until], [r for r in held if r[0] > until]
        if not due:
            return
        last = self.last.get()[0] if self.last.exists() else self.start_day
        for day, critical, reliable in due:
            since = day - last
            drifted = critical >= self.policy.min_drifted_features
            retrain = drifted and since >= self.policy.min_days_between and reliable
            yield Row(model=key[0], day_number=day, features_critical=critical, days_since_retrain=since, retrain=retrain, blocked=drifted and not retrain)
            last = day if retrain else last
        self.last.update((last,))
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()


def ordered_gate(reports: DataFrame, delay_days: int = 3, policy: RetrainPolicy = RetrainPolicy(), start_day: int = 0) -> DataFrame:
    """Decisions for a stream of (model, day_number, features_critical, drift_reliable) rows that may come in any order.

    A day is decided once the newest report is more than ``delay_days`` days ahead, after all earlier days that have come by
    then; so within that delay decisions do not depend on the order of arrival. Reports that are later still are dropped
    by the watermark and counted in the stream's progress. The session needs the state store of ``STORE``.
    """
    timed = reports.withColumn("report_time", F.timestamp_seconds(F.col("day_number").cast("long") * (DAY_MS // 1000)))
    return timed.withWatermark("report_time", f"{delay_days} days").groupBy("model").transformWithState(
        OrderedGate(policy, start_day), OUTPUT, "append", "EventTime")


def closing_report(reports: DataFrame, last_day: int, delay_days: int = 3, model: str = "end of stream") -> DataFrame:
    """A report of no model, far enough ahead that every day up to ``last_day`` is decided when a bounded stream ends."""
    row = [(model, last_day + delay_days + 2, 0, False)]
    return reports.sparkSession.createDataFrame(row, "model string, day_number int, features_critical int, drift_reliable boolean")
