"""Retrain gate as a stateful stream: one small state per model."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lotwise.spec import RetrainPolicy

OUTPUT = "model string, day_number int, features_critical int, days_since_retrain int, retrain boolean, blocked boolean, late boolean"
STATE = "last_retrain_day int, last_seen_day int"


def stream_gate(reports: DataFrame, policy: RetrainPolicy = RetrainPolicy(), start_day: int = 0) -> DataFrame:
    """Decisions for a stream of (model, day_number, features_critical, drift_reliable) rows, one per model and day.

    Days are taken in order within a micro-batch. A day that arrives after a later one was decided is reported with
    ``late`` set and never retrains: its decision could no longer change the ones already made.
    """

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, seen = state.get if state.exists else (start_day, -1)
        rows = pd.concat(list(batches)).sort_values("day_number")
        out = []
        for r in rows.itertuples():
            late = bool(r.day_number <= seen)
            since = int(r.day_number) - last
            drifted = r.features_critical >= policy.min_drifted_features
            retrain = bool(drifted and since >= policy.min_days_between and r.drift_reliable and not late)
            out.append((key[0], int(r.day_number), int(r.features_critical), since, retrain, bool(drifted and not retrain), late))
            last, seen = (int(r.day_number) if retrain else last), max(seen, int(r.day_number))
        state.update((last, seen))
        names = [c.split()[0] for c in OUTPUT.split(", ")]
        yield pd.DataFrame(out, columns=names)

    return reports.groupBy("model").applyInPandasWithState(
        decide, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout
    )
