"""Retrain gates, champion history and other decisions on day-level rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.functions.columns import ratio, weighted_class
from lotwise.spec import RetrainPolicy


def three_criteria_gate(
    reports: DataFrame, policy: RetrainPolicy = RetrainPolicy(), critical: str = "features_critical",
    aucpr: str = "current_aucpr", last: str = "last_retrain_date", today: str = "report_date",
) -> DataFrame:
    """Drift, performance drop and staleness must all hold; an unknown metric or date counts as holding."""
    drop = F.lit(policy.baseline_aucpr) - F.col(aucpr)
    days = F.datediff(F.col(today), F.col(last))
    tests = {
        "drift": F.col(critical) >= policy.min_drifted_features,
        "performance": F.coalesce(drop > policy.aucpr_drop, F.lit(True)),
        "staleness": F.coalesce(days > policy.max_staleness_days, F.lit(True)),
    }
    decision = reduce(lambda a, b: a & b, tests.values())
    words = [F.concat(F.lit(f"{n}="), F.when(c, "YES").otherwise("NO")) for n, c in tests.items()]
    return reports.select(
        "*",
        *[c.alias(f"{n}_triggered") for n, c in tests.items()],
        drop.alias("aucpr_drop"),
        days.alias("days_since_retrain"),
        decision.alias("should_retrain"),
        F.concat(F.when(decision, "RETRAIN (").otherwise("HOLD ("), F.concat_ws(", ", *words), F.lit(")")).alias("reasoning"),
    )


def staleness_gate(
    days: DataFrame, model: Sequence[str] = (), day: str = "day_number", critical: str = "features_critical",
    reliable: str = "drift_reliable", trained: str | None = None, policy: RetrainPolicy = RetrainPolicy(),
    start_day: int = 0,
) -> DataFrame:
    """Walk the days of each model in order: retrain when drifted, reliable and at least 30 days since the last
    success. Only a successful training (column ``trained``, else always) moves the last retrain day.

    The input has one row per model and day, so a group is as long as its calendar, not as its data.
    """
    ok = F.col(trained) if trained else F.lit(True)
    packed = days.select(
        *model,
        F.struct(
            F.col(day).cast("int").alias("day"), F.col(critical).cast("int").alias("critical"),
            F.col(reliable).alias("reliable"), ok.alias("trained"),
        ).alias("entry"),
    )
    grouped = packed.groupBy(*model).agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    start = F.struct(
        F.lit(start_day).alias("last"),
        F.array().cast("array<struct<day:int,critical:int,since:int,retrain:boolean,succeeded:boolean>>").alias("log"),
    )

    def step(state: Column, e: Column) -> Column:
        since = e["day"] - state["last"]
        retrain = (e["critical"] >= policy.min_drifted_features) & (since >= policy.min_days_between) & e["reliable"]
        done = retrain & e["trained"]
        entry = F.struct(
            e["day"].alias("day"), e["critical"].alias("critical"), since.alias("since"), retrain.alias("retrain"),
            done.alias("succeeded"),
        )
        return F.struct(
            F.when(done, e["day"]).otherwise(state["last"]).alias("last"), F.concat(state["log"], F.array(entry)).alias("log")
        )

    folded = grouped.select(*model, F.inline(F.aggregate("entries", start, step, lambda s: s["log"])))
    blocked = (F.col("critical") >= policy.min_drifted_features) & ~F.col("retrain")
    return folded.select(
        *model,
        F.col("day").alias(day),
        F.col("critical").alias("features_critical"),
        F.col("since").alias("days_since_retrain"),
        "retrain",
        F.col("succeeded").alias("retrain_succeeded"),
        blocked.alias("blocked"),
    )


def scheduler_gate(reports: DataFrame, day: str = "day_number", policy: RetrainPolicy = RetrainPolicy()) -> DataFrame:
    action = weighted_class(
        (~F.coalesce(F.col("drift_reliable"), F.lit(True)), "skip_retrain"),
        (F.col(day) < policy.min_days_between, "skip_retrain"),
        (F.coalesce(F.col("should_retrain"), F.lit(False)), "trigger_retrain"),
        otherwise="skip_retrain",
    )
    return reports.withColumn("action", action)


def training_windows(days: DataFrame, day: str = "day_number", policy: RetrainPolicy = RetrainPolicy()) -> DataFrame:
    """(retrain_day, start_day, end_day)."""
    start = F.greatest(F.lit(1), F.col(day) - (policy.training_window_days - 1))
    return days.select(F.col(day).alias("retrain_day"), start.alias("start_day"), F.col(day).alias("end_day"))


def training_rows(
    data: DataFrame, days: DataFrame, day: str = "day_number", policy: RetrainPolicy = RetrainPolicy()
) -> DataFrame:
    """Rows of each training window. The window is spelled out as days, which makes the join an equality."""
    w = training_windows(days, day, policy)
    spelled = w.select("retrain_day", F.explode(F.sequence("start_day", "end_day")).alias("_day"))
    return data.join(spelled, data[day] == spelled["_day"]).drop("_day")


def canary(
    candidates: DataFrame, day: str = "day_number", old: str = "old_auc_pr", new: str = "new_auc_pr",
    policy: RetrainPolicy = RetrainPolicy(),
) -> DataFrame:
    gain = (F.col(new) - F.col(old)) / F.greatest(F.col(old), F.lit(policy.champion_floor)) * 100
    forced = F.col(day) >= policy.canary_forced_failure_day
    return candidates.select(
        "*",
        gain.alias("improvement_pct"),
        forced.alias("forced_failure"),
        ((gain > policy.canary_min_improvement_pct) & ~forced).alias("canary_passed"),
    )


def champion_history(
    registry: DataFrame, model: Sequence[str] = (), day: str = "day_number", version: str = "version",
    metric: str = "new_auc_pr", passed: str = "canary_passed",
) -> DataFrame:
    """Champion on every registry day: the latest version whose canary passed; a failed one keeps its predecessor."""
    w = Window.partitionBy(*model).orderBy(day)
    held = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    kept = F.when(F.col(passed), F.col(version))
    score = F.when(F.col(passed), F.col(metric))
    return registry.select(
        "*",
        F.last(kept, True).over(held).alias("champion"),
        F.last(score, True).over(held).alias("champion_metric"),
        F.last(kept, True).over(before).alias("previous_champion"),
        F.when(F.col(passed), "promote").otherwise("rollback").alias("action"),
    )


def champion_at(days: DataFrame, history: DataFrame, model: Sequence[str] = (), day: str = "day_number") -> DataFrame:
    """As-of lookup: the last champion set on or before each day."""
    marks = history.select(*model, day, F.col("champion"), F.col("champion_metric"), F.lit(0).alias("_asked"))
    asked = days.select(
        *model, day, F.lit(None).cast("string").alias("champion"), F.lit(None).cast("double").alias("champion_metric"),
        F.lit(1).alias("_asked"),
    )
    w = Window.partitionBy(*model).orderBy(day, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionByName(asked)
    return (
        both.withColumns(
            {"champion": F.last("champion", True).over(w), "champion_metric": F.last("champion_metric", True).over(w)}
        )
        .where(F.col("_asked") == 1)
        .drop("_asked")
    )


def promote_if_better(pairs: DataFrame, new: str = "new_auc_pr", current: str = "current_auc_pr", margin: float = 0.0) -> DataFrame:
    """Register a retrained model when it beats the current one by more than ``margin``."""
    return pairs.withColumn("promote", F.col(new) > F.col(current) + F.lit(margin))


def day_event_tags(gate: DataFrame, day: str = "day_number", bad_day: int = 39, end_day: int = 40) -> DataFrame:
    """Event names of each day, in the order in which they happen."""
    critical, warning = F.col("features_critical"), F.col("features_warning")
    drifted = critical >= 3
    tags = F.array(
        F.when(drifted, F.format_string("drift_critical_%d_features", critical))
        .when(warning > 0, F.format_string("drift_warning_%d_features", warning))
        .otherwise(F.lit("drift_clean")),
        F.when(F.col("retrain"), "RETRAIN_TRIGGERED"),
        F.when(F.col("retrain") & ~F.col("retrain_succeeded"), "RETRAIN_FAILED"),
        F.when(F.col("blocked"), F.format_string("retrain_blocked_staleness_%dd", F.col("days_since_retrain"))),
        F.when(F.col(day) == bad_day, "BAD_MODEL_DEPLOYED"),
        F.when(F.col(day) == bad_day, "CANARY_FAILED"),
        F.when(F.col(day) == bad_day, "ROLLBACK_TO_v2"),
        F.when(F.col(day) == end_day, "SYSTEM_RECOVERED"),
    )
    return gate.withColumn("events", F.array_compact(tags))


def headline_event(days: DataFrame, events: str = "events") -> DataFrame:
    """Strongest event of each day, null when there is none."""
    out = F.lit(None).cast("string")
    joined = F.array_join(events, "\n")
    for word, name in reversed(S.HEADLINE_EVENTS):
        out = F.when(F.contains(joined, F.lit(word)), name).otherwise(out)
    return days.withColumn("headline", out)


def event_occurrences(
    days: DataFrame, keep: Sequence[str], events: str = "events", types: Sequence[str] = S.TIMELINE_EVENT_TYPES
) -> DataFrame:
    """One row per day and event type that occurs on it."""
    kinds = F.array(*[F.lit(t) for t in types])
    return days.select(
        *keep, F.explode(F.filter(kinds, lambda t: F.exists(events, lambda e: F.contains(e, t)))).alias("event_type")
    )


def scenario_class(scenario: Column) -> Column:
    low = F.lower(scenario)
    rules = [
        (reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), name)
        for words, name in S.SCENARIO_CLASSES
    ]
    return weighted_class(*rules, otherwise="normal")


def fail_rate_vs_baseline(df: DataFrame, day: str = "day_number", label: str = "is_fail") -> DataFrame:
    """Fail rate of each day next to that of the first day; the window runs over the few day rows."""
    daily = df.groupBy(day).agg(F.avg(label).alias("fail_rate"))
    base = F.first("fail_rate").over(
        Window.partitionBy(F.lit(0)).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return daily.withColumn("baseline", base).withColumn("vs_baseline", ratio(F.col("fail_rate"), F.col("baseline")))


def version_steps(days: DataFrame, model: Sequence[str] = (), day: str = "day_number", version: str = "model_version") -> DataFrame:
    """Dense 0-based index of each version by first appearance, and whether the day changes the version."""
    by_version = Window.partitionBy(*model, version)
    in_order = Window.partitionBy(*model).orderBy(day)
    first = days.withColumn("_first", F.min(day).over(by_version))
    return first.select(
        *days.columns,
        (F.dense_rank().over(Window.partitionBy(*model).orderBy("_first")) - 1).alias("version_index"),
        F.coalesce(F.lag(version).over(in_order) != F.col(version), F.lit(False)).alias("is_transition"),
    )


def flatten_event_log(logs: DataFrame, events: str = "events") -> DataFrame:
    """One row per logged event with its shared fields and those of its category."""
    return logs.select("day", F.explode(events).alias("e")).select("day", "e.*")


def event_log_counts(flat: DataFrame) -> DataFrame:
    return flat.groupBy("category", "event").agg(F.count("*").alias("n"))


def completeness_audit(
    present: DataFrame, first: int, last: int, day: str = "day_number", min_days: int = 30
) -> DataFrame:
    """One row: expected, present and missing days, and whether enough of them exist."""
    have = present.select(F.col(day).cast("int").alias("day")).where(F.col("day").between(first, last)).distinct()
    return have.agg(
        F.lit(last - first + 1).alias("expected_days"),
        F.count("*").alias("present_days"),
        (F.lit(last - first + 1) - F.count("*")).alias("missing_days"),
        (F.count("*") >= min_days).alias("complete"),
    )


def pending(requested: Sequence[int], done: DataFrame, day: str) -> list[int]:
    """Requested days that ``done`` does not have."""
    asked = done.sparkSession.createDataFrame([(int(d),) for d in requested], f"{day} int")
    have = done.select(F.col(day).cast("int").alias(day)).distinct()
    return sorted(r[0] for r in asked.join(have, day, "left_anti").collect())


def missing_days(present: DataFrame, first: int, last: int, day: str = "day_number") -> DataFrame:
    """Days of the range that have no row."""
    expected = present.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(day))
    have = present.select(F.col(day).cast("int").alias(day)).distinct()
    return expected.join(have, day, "left_anti")


def flatten_metrics(nested: DataFrame, keep: Sequence[str], metrics: str = "metrics") -> DataFrame:
    """Nested map split -> metric -> number as (keep, name, value) rows named ``split.metric``."""
    outer = nested.select(*keep, F.explode(metrics).alias("split", "inner"))
    inner = outer.select(*keep, "split", F.explode("inner").alias("metric", "value"))
    number = F.col("value").cast("double")
    return inner.where(number.isNotNull()).select(*keep, F.concat_ws(".", "split", "metric").alias("name"), number.alias("value"))


def best_epoch(
    epochs: DataFrame, run: Sequence[str], epoch: str = "epoch", metric: str = "val_auc_pr",
    policy: RetrainPolicy = RetrainPolicy(),
) -> DataFrame:
    """(run, best_epoch, best_value, stop_epoch): stops once ``patience`` epochs bring no strict improvement."""
    seen = Window.partitionBy(*run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    better = F.col(metric) > F.coalesce(F.max(metric).over(seen), F.lit(-float("inf")))
    marked = epochs.withColumn("_better", better)
    last = F.last(F.when(F.col("_better"), F.col(epoch)), True).over(upto)
    gap = marked.withColumn("_last", last)
    stops = F.min(F.when(F.col(epoch) - F.col("_last") >= policy.early_stop_patience, F.col(epoch))).over(
        Window.partitionBy(*run)
    )
    live = gap.withColumn("_stop", stops).where(F.col("_stop").isNull() | (F.col(epoch) <= F.col("_stop")))
    return live.groupBy(*run).agg(
        F.max_by(F.col(epoch), F.struct(F.col(metric), -F.col(epoch))).alias("best_epoch"),
        F.max(metric).alias("best_value"),
        F.max("_stop").alias("stop_epoch"),
    )


def best_model(metrics: DataFrame, by: Sequence[str] = (), model: str = "model", metric: str = "auc_pr") -> DataFrame:
    """Highest metric; equal ones go to the first name."""
    top = F.min(F.struct((-F.col(metric)).alias("score"), F.col(model).alias("model"))).alias("top")
    return metrics.groupBy(*by).agg(top).select(*by, F.col("top.model").alias("best_model"), (-F.col("top.score")).alias("best_value"))


def metric_table(long: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Wide comparison table from (by, metric, value) rows; the metric names are given, so no discovery job."""
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics])


def unify_metric_layouts(nested: DataFrame, flat: DataFrame) -> DataFrame:
    """Rows (model, split, metric, value) from a nested layout and from one column per metric."""
    a = nested.select("model", F.explode("metrics").alias("split", "inner")).select(
        "model", "split", F.explode("inner").alias("metric", "value")
    )
    names = [c for c in flat.columns if c not in ("model", "split")]
    b = flat.select("model", "split", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["model", "split"], names, "metric", "value"
    )
    return a.unionByName(b)


def traffic_arms(df: DataFrame, key: Column, canary_pct: int = 10) -> DataFrame:
    """Stable split of keys into a canary and a stable arm."""
    bucket = F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(100))
    return df.withColumn("arm", F.when(bucket < canary_pct, "canary").otherwise("stable"))


def compare_arms(df: DataFrame, metric: str, tolerance: float = 0.05, by: Sequence[str] = ()) -> DataFrame:
    """Mean of a higher-is-better metric per arm; roll back when the canary is worse by more than the tolerance."""
    m = F.col(metric).cast("double")
    both = df.groupBy(*by).agg(
        F.count_if(F.col("arm") == "canary").alias("n_canary"),
        F.count_if(F.col("arm") == "stable").alias("n_stable"),
        F.avg(F.when(F.col("arm") == "canary", m)).alias("canary_metric"),
        F.avg(F.when(F.col("arm") == "stable", m)).alias("stable_metric"),
    )
    return both.withColumn("rollback", F.col("canary_metric") < F.col("stable_metric") * (1 - tolerance))


def epochs_from_arrays(runs: DataFrame, run: Sequence[str], arrays: Sequence[str], rows: str, seconds: str) -> DataFrame:
    """One row per epoch from parallel arrays, with rows per second."""
    zipped = runs.select(*run, rows, F.posexplode(F.arrays_zip(*arrays)).alias("_i", "_e"))
    return zipped.select(
        *run,
        (F.col("_i") + 1).alias("epoch"),
        *[F.col("_e")[a].alias(a) for a in arrays],
        ratio(F.col(rows).cast("double"), F.col("_e")[seconds]).alias("rows_per_sec"),
    )
