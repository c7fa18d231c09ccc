"""Registered queries: gates, champion history and day-level decisions, fed by the drift scan of the die table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.operators import drift, lifecycle, metrics, profile
from lotwise.plans.bindings import dies, on_dies, query, rounded, table
from lotwise.plans.drifts import SIX, quantile_ctes, reference, report_cte
from lotwise.spec import RetrainPolicy

_SCAN = [*quantile_ctes(SIX), report_cte(6)]
_GATE = (
    "gate AS (SELECT 1 AS day_number, (SELECT features_critical FROM report WHERE day_number = 1) AS critical, 1 AS since, false AS retrain, 0 AS last "
    "UNION ALL SELECT r.day_number, r.features_critical, r.day_number - g.last, r.features_critical >= 3 AND r.day_number - g.last >= 30, "
    "CASE WHEN r.features_critical >= 3 AND r.day_number - g.last >= 30 THEN r.day_number ELSE g.last END FROM gate g JOIN report r ON r.day_number = g.day_number + 1)"
)
_TAGGED = (
    "tagged AS (SELECT g.day_number, g.retrain, list_filter([CASE WHEN critical >= 3 THEN 'drift_critical_' || critical || '_features' WHEN features_warning > 0 THEN 'drift_warning_' || features_warning || '_features' ELSE 'drift_clean' END, "
    "CASE WHEN retrain THEN 'RETRAIN_TRIGGERED' END, CASE WHEN critical >= 3 AND NOT retrain THEN 'retrain_blocked_staleness_' || since || 'd' END, CASE WHEN g.day_number = 39 THEN 'BAD_MODEL_DEPLOYED' END, "
    "CASE WHEN g.day_number = 39 THEN 'CANARY_FAILED' END, CASE WHEN g.day_number = 39 THEN 'ROLLBACK_TO_v2' END, CASE WHEN g.day_number = 40 THEN 'SYSTEM_RECOVERED' END], lambda x: x IS NOT NULL) AS events "
    "FROM gate g JOIN report r USING (day_number))"
)


def _scan(spark, d):
    df, ref = reference(spark, d)
    return drift.drift_scan(df, ref).withColumn("drift_reliable", F.lit(True))


def _gated(spark, d):
    scan = _scan(spark, d)
    gate = lifecycle.staleness_gate(scan)
    return gate.join(scan.select("day_number", "features_warning"), "day_number")


def _tagged(spark, d):
    return lifecycle.day_event_tags(_gated(spark, d))


# The candidate of a day adds a second measurement to the score; on one day in four it has the wrong sign.
_CANDIDATE = "score + CASE WHEN day_number % 4 = 1 THEN -3e0 ELSE 3e0 END * (idd2p_standby_ma - 9e0) / 25e0"


def _daily_quality(spark, d):
    """Per day: average precision of that day's candidate and of the model in use, on the day's rows."""
    scores = F.array(*[F.struct(F.lit(m).alias("model"), F.expr(e).alias("score")) for m, e in (("old", "score"), ("new", _CANDIDATE))])
    rows = dies(spark, d).select("day_number", F.col("is_fail").alias("label"), F.inline(scores))
    quality = metrics.ranking_metrics(metrics.precision_recall_curve(rows, ["day_number", "model"], "label", "score"), ["day_number", "model"])
    return quality.groupBy("day_number").agg(*[F.max(F.when(F.col("model") == m, F.col("auc_pr"))).alias(f"{m}_auc_pr") for m in ("new", "old")])


_DAILY = (
    f"scored AS (SELECT day_number, is_fail, 'old' AS model, score AS s FROM dies UNION ALL SELECT day_number, is_fail, 'new', {_CANDIDATE} FROM dies), "
    "tied AS (SELECT day_number, model, s, sum(is_fail) AS pos, count(*) AS n FROM scored GROUP BY ALL), "
    "curve AS (SELECT *, sum(pos) OVER w / sum(n) OVER w AS precision_upto, sum(pos) OVER (PARTITION BY day_number, model) AS n_pos FROM tied WINDOW w AS (PARTITION BY day_number, model ORDER BY s DESC)), "
    "daily AS (SELECT day_number, sum(pos * precision_upto / n_pos) FILTER (WHERE model = 'new') AS new_auc_pr, sum(pos * precision_upto / n_pos) FILTER (WHERE model = 'old') AS old_auc_pr FROM curve WHERE n_pos > 0 GROUP BY day_number)"
)
_BASELINE = 0.28


@query("lc01_three_criteria_gate", on_dies(
    f"SELECT day_number, features_critical >= 3 AS drift_triggered, coalesce({_BASELINE} - new_auc_pr > 0.05, true) AS performance_triggered, coalesce(date_diff('day', last_retrain_date, report_date) > 30, true) AS staleness_triggered, "
    f"date_diff('day', last_retrain_date, report_date) AS days_since_retrain, features_critical >= 3 AND coalesce({_BASELINE} - new_auc_pr > 0.05, true) AND coalesce(date_diff('day', last_retrain_date, report_date) > 30, true) AS should_retrain, "
    f"concat(CASE WHEN features_critical >= 3 AND coalesce({_BASELINE} - new_auc_pr > 0.05, true) AND coalesce(date_diff('day', last_retrain_date, report_date) > 30, true) THEN 'RETRAIN (' ELSE 'HOLD (' END, 'drift=', CASE WHEN features_critical >= 3 THEN 'YES' ELSE 'NO' END, "
    f"', performance=', CASE WHEN coalesce({_BASELINE} - new_auc_pr > 0.05, true) THEN 'YES' ELSE 'NO' END, ', staleness=', CASE WHEN coalesce(date_diff('day', last_retrain_date, report_date) > 30, true) THEN 'YES' ELSE 'NO' END, ')') AS reasoning FROM ("
    "SELECT r.day_number, features_critical, CASE WHEN r.day_number % 7 <> 0 THEN new_auc_pr END AS new_auc_pr, date '2026-02-20' + r.day_number - 1 AS report_date, CASE WHEN r.day_number % 5 <> 0 THEN date '2026-02-15' END AS last_retrain_date FROM report r JOIN daily USING (day_number))",
    *_SCAN, _DAILY))
def _(spark, d):
    day = F.col("day_number")
    reports = _scan(spark, d).join(_daily_quality(spark, d), "day_number").select(
        "day_number",
        "features_critical",
        F.when(day % 7 != 0, F.col("new_auc_pr")).alias("current_aucpr"),
        F.date_add(F.lit(S.SIMULATION_START).cast("date"), day - 1).alias("report_date"),
        F.when(day % 5 != 0, F.lit("2026-02-15").cast("date")).alias("last_retrain_date"),
    )
    out = lifecycle.three_criteria_gate(reports, RetrainPolicy(baseline_aucpr=_BASELINE))
    return out.select("day_number", "drift_triggered", "performance_triggered", "staleness_triggered", F.col("days_since_retrain").cast("long").alias("days_since_retrain"), "should_retrain", "reasoning")


@query("lc02_staleness_gate", on_dies(
    "SELECT day_number, critical AS features_critical, since AS days_since_retrain, retrain, retrain AS retrain_succeeded, critical >= 3 AND NOT retrain AS blocked FROM gate", *_SCAN, _GATE, recursive=True))
def _(spark, d):
    return lifecycle.staleness_gate(_scan(spark, d))


@query("lc03_scheduler_gate", on_dies(
    "SELECT day_number, CASE WHEN n < 1400 OR day_number < 30 THEN 'skip_retrain' WHEN should_retrain THEN 'trigger_retrain' ELSE 'skip_retrain' END AS action FROM report JOIN (SELECT day_number, count(*) AS n FROM dies GROUP BY day_number) USING (day_number)", *_SCAN))
def _(spark, d):
    scan = _scan(spark, d).withColumn("drift_reliable", F.col("analysis_rows") >= 1400)
    return lifecycle.scheduler_gate(scan).select("day_number", "action")


@query("lc04_training_windows", on_dies(
    "SELECT w.day_number AS retrain_day, greatest(1, w.day_number - 14) AS start_day, w.day_number AS end_day, count(*) AS n_rows, cast(sum(is_fail) as bigint) AS n_fail FROM (SELECT DISTINCT day_number FROM dies WHERE day_number >= 30) w "
    "JOIN dies d ON d.day_number BETWEEN greatest(1, w.day_number - 14) AND w.day_number GROUP BY w.day_number"))
def _(spark, d):
    daily = dies(spark, d).groupBy("day_number").agg(F.count("*").alias("n"), F.sum("is_fail").alias("f"))
    days = daily.where("day_number >= 30").select("day_number")
    rows = lifecycle.training_rows(daily, days)
    w = lifecycle.training_windows(days)
    sums = rows.groupBy("retrain_day").agg(F.sum("n").alias("n_rows"), F.sum("f").alias("n_fail"))
    return w.join(sums, "retrain_day").select("retrain_day", "start_day", "end_day", "n_rows", "n_fail")


@query("lc05_canary", on_dies(
    "SELECT day_number, round(g, 6) AS improvement_pct, day_number >= 39 AS forced_failure, g > -10 AND day_number < 39 AS canary_passed FROM (SELECT day_number, (new_auc_pr - old_auc_pr) / greatest(old_auc_pr, 0.001e0) * 100 AS g FROM daily)", _DAILY))
def _(spark, d):
    return rounded(lifecycle.canary(_daily_quality(spark, d)).select("day_number", "improvement_pct", "forced_failure", "canary_passed"))


_REG = (
    "registry AS (SELECT day_number, 'v' || day_number AS version, new_auc_pr, (new_auc_pr - old_auc_pr) / greatest(old_auc_pr, 0.001e0) * 100 > -10 AND day_number < 39 AS canary_passed FROM daily), "
    "history AS (SELECT *, last_value(CASE WHEN canary_passed THEN version END IGNORE NULLS) OVER (ORDER BY day_number ROWS UNBOUNDED PRECEDING) AS champion, "
    "last_value(CASE WHEN canary_passed THEN new_auc_pr END IGNORE NULLS) OVER (ORDER BY day_number ROWS UNBOUNDED PRECEDING) AS champion_metric, "
    "last_value(CASE WHEN canary_passed THEN version END IGNORE NULLS) OVER (ORDER BY day_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_champion FROM registry)"
)


def _registry(spark, d):
    """A version a day, with the canary's verdict on its average precision."""
    tested = lifecycle.canary(_daily_quality(spark, d))
    return tested.select("day_number", F.concat(F.lit("v"), F.col("day_number").cast("string")).alias("version"), "new_auc_pr", "canary_passed")


_CHAMPION_HISTORY = on_dies(
    "SELECT day_number, version, canary_passed, champion, round(champion_metric, 9) AS champion_metric, previous_champion, CASE WHEN canary_passed THEN 'promote' ELSE 'rollback' END AS action FROM history", _DAILY, _REG)


@query("lc06_champion_history", _CHAMPION_HISTORY)
@query("lc06_champion_history_daily", _CHAMPION_HISTORY)
def _(spark, d):
    return rounded(lifecycle.champion_history(_registry(spark, d)).drop("new_auc_pr"), 9)


_CHAMPION_AT_DAY = on_dies(
    "SELECT d.day_number, h.champion, round(h.champion_metric, 9) AS champion_metric FROM (SELECT DISTINCT day_number FROM dies) d ASOF LEFT JOIN history h ON d.day_number >= h.day_number", _DAILY, _REG)


@query("lc06_champion_at_day", _CHAMPION_AT_DAY)
@query("lc06_champion_at_day_daily", _CHAMPION_AT_DAY)
def _(spark, d):
    days = dies(spark, d).select("day_number").distinct()
    return rounded(lifecycle.champion_at(days, lifecycle.champion_history(_registry(spark, d))), 9)


@query("lc07_promote_if_better", on_dies("SELECT day_number, new_auc_pr > old_auc_pr + 0.02e0 AS promote FROM daily", _DAILY))
def _(spark, d):
    pairs = _daily_quality(spark, d).withColumnRenamed("old_auc_pr", "current_auc_pr")
    return lifecycle.promote_if_better(pairs, margin=0.02).select("day_number", "promote")


@query("lc08_event_tags", on_dies("SELECT day_number, array_to_string(events, ',') AS events FROM tagged", *_SCAN, _GATE, _TAGGED, recursive=True))
def _(spark, d):
    return _tagged(spark, d).select("day_number", F.array_join("events", ",").alias("events"))


@query("lc09_headline_event", on_dies(
    "SELECT day_number, CASE WHEN s LIKE '%ROLLBACK%' THEN 'ROLLBACK' WHEN s LIKE '%BAD#_MODEL%' ESCAPE '#' THEN 'BAD DEPLOY' WHEN s LIKE '%RETRAIN%' THEN 'RETRAIN' END AS headline FROM (SELECT day_number, array_to_string(events, ',') AS s FROM tagged)",
    *_SCAN, _GATE, _TAGGED, recursive=True))
def _(spark, d):
    return lifecycle.headline_event(_tagged(spark, d)).select("day_number", "headline")


@query("lc10_event_occurrences", on_dies(
    "SELECT day_number, t AS event_type FROM tagged, (SELECT unnest(['RETRAIN_TRIGGERED', 'RETRAIN_FAILED', 'BAD_MODEL_DEPLOYED', 'CANARY_FAILED', 'ROLLBACK']) AS t) WHERE contains(array_to_string(events, ','), t)",
    *_SCAN, _GATE, _TAGGED, recursive=True))
def _(spark, d):
    return lifecycle.event_occurrences(_tagged(spark, d), ["day_number"])


_SCENARIO = "CASE day_number % 8 WHEN 0 THEN 'Normal' WHEN 1 THEN 'gradual_drift' WHEN 2 THEN 'sudden_shift' WHEN 3 THEN 'false_alarm' WHEN 4 THEN 'auto_recover' WHEN 5 THEN 'bad_model_deploy' WHEN 6 THEN 'post_retrain_recovery' ELSE 'threshold_1' END"


@query("lc11_scenario_class", on_dies(
    "SELECT scenario, CASE WHEN s LIKE '%retrain%' THEN 'recovery' WHEN s LIKE '%bad%' THEN 'failure' WHEN s LIKE '%sudden%' OR s LIKE '%worsening%' THEN 'failure' WHEN s LIKE '%drift%' OR s LIKE '%threshold%' OR s LIKE '%continued%' THEN 'drift' "
    "WHEN s LIKE '%false%' THEN 'false_alarm' WHEN s LIKE '%recover%' OR s LIKE '%post%' THEN 'recovery' ELSE 'normal' END AS scenario_class, count(*) AS n FROM (SELECT *, lower(scenario) AS s FROM (SELECT " + _SCENARIO + " AS scenario FROM dies)) GROUP BY ALL"))
def _(spark, d):
    df = dies(spark, d).select(F.expr(_SCENARIO).alias("scenario"))
    counted = df.groupBy("scenario").agg(F.count("*").alias("n"))
    return counted.withColumn("scenario_class", lifecycle.scenario_class(F.col("scenario")))


@query("lc12_fail_rate_vs_baseline", on_dies(
    "SELECT day_number, round(f, 6) AS fail_rate, round(b, 6) AS baseline, round(f / b, 6) AS vs_baseline FROM (SELECT day_number, f, first_value(f) OVER (ORDER BY day_number) AS b FROM (SELECT day_number, avg(is_fail) AS f FROM dies GROUP BY day_number))"))
def _(spark, d):
    return rounded(lifecycle.fail_rate_vs_baseline(dies(spark, d)))


_VERSION_STEPS = on_dies(
    "SELECT day_number, model_version, dense_rank() OVER (ORDER BY f) - 1 AS version_index, coalesce(lag(model_version) OVER (ORDER BY day_number) <> model_version, false) AS is_transition FROM ("
    "SELECT day_number, champion AS model_version, min(day_number) OVER (PARTITION BY champion) AS f FROM history WHERE champion IS NOT NULL)", _DAILY, _REG)


@query("lc13_version_steps", _VERSION_STEPS)
@query("lc13_version_steps_daily", _VERSION_STEPS)
def _(spark, d):
    h = lifecycle.champion_history(_registry(spark, d)).where("champion IS NOT NULL")
    out = lifecycle.version_steps(h.select("day_number", F.col("champion").alias("model_version")))
    return out.withColumn("version_index", F.col("version_index").cast("long"))


_LOG_STRUCT = "array(named_struct('category', 'data_generation', 'event', 'completed', 'rows', n, 'feature', cast(null as string)), named_struct('category', 'drift_detection', 'event', sev, 'rows', n, 'feature', feature))"


@query("lc14_flatten_event_log", on_dies(
    "SELECT day, category, event, rows, feature FROM (SELECT day_number AS day, 'data_generation' AS category, 'completed' AS event, n AS rows, cast(null as varchar) AS feature FROM psi UNION ALL "
    "SELECT day_number, 'drift_detection', CASE WHEN psi > 0.2 THEN 'critical' WHEN psi > 0.1 THEN 'warning' ELSE 'none' END, n, feature FROM psi)", *_SCAN[:-1]))
def _(spark, d):
    df, ref = reference(spark, d)
    logs = drift.psi_report(df, ref, ["day_number"]).select(
        F.col("day_number").alias("day"), F.col("severity").alias("sev"), "n", "feature").select("day", F.expr(_LOG_STRUCT).alias("events"))
    return lifecycle.flatten_event_log(logs)


@query("lc14_event_log_counts", "SELECT role AS category, CASE WHEN turn % 2 = 0 THEN 'even' ELSE 'odd' END AS event, count(*) AS n FROM conversations GROUP BY ALL")
def _(spark, d):
    c = table(spark, d, "conversations").select(F.col("role").alias("category"), F.when(F.col("turn") % 2 == 0, "even").otherwise("odd").alias("event"))
    return lifecycle.event_log_counts(c)


@query("lc15_completeness_audit", "SELECT 40 AS expected_days, count(*) AS present_days, 40 - count(*) AS missing_days, count(*) >= 30 AS complete FROM (SELECT DISTINCT cast(ts as date) FROM events)")
def _(spark, d):
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("day_number")
    return lifecycle.completeness_audit(table(spark, d, "events").select(day), 1, 40)


@query("lc15_missing_days", "SELECT cast(x as int) AS day_number FROM range(1, 41) t(x) WHERE x NOT IN (SELECT date_diff('day', date '2024-01-01', cast(ts as date)) + 1 FROM events)")
def _(spark, d):
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("day_number")
    return lifecycle.missing_days(table(spark, d, "events").select(day), 1, 40)


_WIDE = "wide AS (SELECT tester_id AS model, split, avg(score) AS auc_pr, avg(cast(is_fail as double)) AS recall, count(*)::double AS n_samples FROM dies GROUP BY ALL)"


def _wide_metrics(spark, d):
    return dies(spark, d).groupBy(F.col("tester_id").alias("model"), "split").agg(
        F.avg("score").alias("auc_pr"), F.avg(F.col("is_fail").cast("double")).alias("recall"), F.count("*").cast("double").alias("n_samples"))


def _nested_metrics(spark, d):
    inner = F.create_map(F.lit("auc_pr"), "auc_pr", F.lit("recall"), "recall", F.lit("n_samples"), "n_samples")
    return _wide_metrics(spark, d).groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct("split", inner.alias("m")))).alias("metrics"))


@query("lc16_flatten_metrics", on_dies(" UNION ALL ".join(f"SELECT model, split || '.{m}' AS name, round({m}, 9) AS value FROM wide" for m in ("auc_pr", "recall", "n_samples")), _WIDE))
def _(spark, d):
    return rounded(lifecycle.flatten_metrics(_nested_metrics(spark, d), ["model"]), 9)


_EPOCHS = "epochs AS (SELECT tester_id AS run, day_number AS epoch, avg(score) AS val_auc_pr, count(*) AS n, sum(rw_latency_ns) / 1000e0 AS epoch_time_s FROM dies GROUP BY ALL)"
_BEST = (
    "a AS (SELECT *, coalesce(val_auc_pr > max(val_auc_pr) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better FROM epochs), "
    "b AS (SELECT *, max(CASE WHEN better THEN epoch END) OVER (PARTITION BY run ORDER BY epoch) AS last_better FROM a), "
    "c AS (SELECT *, min(CASE WHEN epoch - last_better >= 12 THEN epoch END) OVER (PARTITION BY run) AS stop FROM b)"
)


def _epochs(spark, d):
    return dies(spark, d).groupBy(F.col("tester_id").alias("run"), F.col("day_number").alias("epoch")).agg(
        F.avg("score").alias("val_auc_pr"), F.count("*").alias("n"), (F.sum("rw_latency_ns") / 1000.0).alias("epoch_time_s"))


@query("lc17_best_epoch", on_dies(
    "SELECT run, arg_max(epoch, val_auc_pr) AS best_epoch, round(max(val_auc_pr), 9) AS best_value, max(stop) AS stop_epoch FROM c WHERE stop IS NULL OR epoch <= stop GROUP BY run", _EPOCHS, _BEST))
def _(spark, d):
    return rounded(lifecycle.best_epoch(_epochs(spark, d), ["run"]), 9)


@query("lc18_best_model", on_dies("SELECT split, arg_max(model, auc_pr) AS best_model, round(max(auc_pr), 9) AS best_value FROM wide GROUP BY split", _WIDE))
def _(spark, d):
    return rounded(lifecycle.best_model(_wide_metrics(spark, d), ["split"]), 9)


@query("lc19_metric_table", on_dies("SELECT model, split, round(auc_pr, 9) AS auc_pr, round(recall, 9) AS recall, n_samples FROM wide UNION ALL SELECT model || '_flat', split, round(auc_pr, 9), round(recall, 9), n_samples FROM wide", _WIDE))
def _(spark, d):
    flat = _wide_metrics(spark, d).withColumn("model", F.concat("model", F.lit("_flat")))
    long = lifecycle.unify_metric_layouts(_nested_metrics(spark, d), flat)
    return rounded(lifecycle.metric_table(long, ["auc_pr", "recall", "n_samples"]), 9)


_ARM = "arms AS (SELECT *, CASE WHEN cast('0x' || substr(md5(cast(l_orderkey as varchar)), 1, 8) as bigint) % 100 < 10 THEN 'canary' ELSE 'stable' END AS arm FROM lineitem)"


@query("lc20_traffic_arms", f"WITH {_ARM} SELECT arm, count(*) AS n, count(DISTINCT l_orderkey) AS n_keys FROM arms GROUP BY arm")
def _(spark, d):
    df = lifecycle.traffic_arms(table(spark, d, "lineitem").select("l_orderkey"), F.col("l_orderkey"))
    keys = df.groupBy("arm", "l_orderkey").agg(F.count("*").alias("k"))
    return keys.groupBy("arm").agg(F.sum("k").alias("n"), F.count("*").alias("n_keys"))


@query("lc20_compare_arms", f"WITH {_ARM} SELECT l_returnflag AS flag, nc AS n_canary, ns AS n_stable, round(c, 6) AS canary_metric, round(s, 6) AS stable_metric, c < s * 0.995e0 AS rollback FROM (SELECT l_returnflag, count(*) FILTER (WHERE arm = 'canary') AS nc, "
    "count(*) FILTER (WHERE arm = 'stable') AS ns, avg(l_discount) FILTER (WHERE arm = 'canary') AS c, avg(l_discount) FILTER (WHERE arm = 'stable') AS s FROM arms GROUP BY l_returnflag)")
def _(spark, d):
    df = lifecycle.traffic_arms(table(spark, d, "lineitem"), F.col("l_orderkey")).withColumn("flag", F.col("l_returnflag"))
    return rounded(lifecycle.compare_arms(df, "l_discount", 0.005, ["flag"]))


@query("lc22_epochs_from_arrays", on_dies("SELECT run, epoch, round(val_auc_pr, 9) AS val_auc_pr, round(epoch_time_s, 6) AS epoch_time_s, round(t / epoch_time_s, 4) AS rows_per_sec FROM epochs JOIN (SELECT run, cast(sum(n) as bigint) AS t FROM epochs GROUP BY run) USING (run)", _EPOCHS))
def _(spark, d):
    packed = _epochs(spark, d).groupBy("run").agg(F.sum("n").alias("train_rows"), F.array_sort(F.collect_list(F.struct("epoch", "val_auc_pr", "epoch_time_s"))).alias("s"))
    arrays = packed.select("run", "train_rows", F.col("s.val_auc_pr").alias("val_auc_pr"), F.col("s.epoch_time_s").alias("epoch_time_s"))
    out = lifecycle.epochs_from_arrays(arrays, ["run"], ["val_auc_pr", "epoch_time_s"], "train_rows", "epoch_time_s")
    return rounded(out, rows_per_sec=4, val_auc_pr=9)


@query("ag24_run_kpis", on_dies(
    "SELECT count(*) AS n_days, cast(sum(n_rows) as bigint) AS total_rows, round(sum(n_rows * 128) / 1e9, 6) AS total_gb, cast(sum(cast(retrain as int)) as bigint) AS retrains, count(*) FILTER (WHERE critical >= 3) AS critical_days, round(sum(n_rows / 1000e0) / 60, 6) AS wall_minutes "
    "FROM gate JOIN (SELECT day_number, count(*) AS n_rows FROM dies GROUP BY day_number) USING (day_number)", *_SCAN, _GATE, recursive=True))
def _(spark, d):
    scan = _scan(spark, d)
    gate = lifecycle.staleness_gate(scan)
    days = gate.join(scan.select("day_number", F.col("analysis_rows").alias("n_rows")), "day_number")
    return rounded(profile.run_kpis(days.withColumn("bytes", F.col("n_rows") * 128).withColumn("elapsed_sec", F.col("n_rows") / 1000.0)))
