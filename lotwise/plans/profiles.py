"""Registered queries: counts, profiles and summaries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.operators import features, profile
from lotwise.plans.bindings import dies, long_cte, on_dies, query, rounded, table

SIX = list(S.KEY_DRIFT_FEATURES)
GAPPY = ["cell_leakage_fa", "retention_time_ms", "disturb_margin_mv", "bit_error_rate", "trcd_ns", "idd4_active_ma"]
CORR = ["cell_leakage_fa", "test_temp_c", "retention_time_ms", "rh_susceptibility", "trcd_ns", "gate_oxide_thickness_a", "vt_shift_mv", "edge_distance"]
AUDIT = list(S.NUMERIC + S.CATEGORICAL + S.SPATIAL)


@query("ag01_daily_fail_rate", on_dies(
    "SELECT day_number, count(*) AS total, cast(sum(is_fail) as bigint) AS n_fail, round(avg(is_fail), 6) AS fail_rate FROM dies GROUP BY day_number"))
def _(spark, d):
    return rounded(profile.daily_fail_rate(dies(spark, d)))


@query("ag01_daily_error_rate_of_events",
    "SELECT cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as int) AS day_number, count(*) AS total, "
    "cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) AS n_fail, "
    "round(avg(case when event_type = 'error' then 1 else 0 end), 6) AS fail_rate FROM events GROUP BY 1")
def _(spark, d):
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("day_number")
    e = table(spark, d, "events").select(day, (F.col("event_type") == "error").cast("int").alias("is_fail"))
    return rounded(profile.daily_fail_rate(e))


@query("ag02_daily_measures", on_dies(
    "SELECT day_number, count(*) AS total, cast(sum(is_fail) as bigint) AS n_fail, round(avg(test_temp_c), 6) AS avg_test_temp_c, "
    "round(avg(cell_leakage_fa), 6) AS avg_cell_leakage_fa FROM dies GROUP BY day_number"))
def _(spark, d):
    return rounded(profile.daily_measures(dies(spark, d), ["test_temp_c", "cell_leakage_fa"]))


@query("ag03_null_audit", on_dies(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
        f"round(100e0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS missing_pct FROM dies" for c in AUDIT
    ) + ") WHERE n_missing > 0"))
def _(spark, d):
    return rounded(profile.null_audit(dies(spark, d), AUDIT))


@query("ag04_quality_summary", on_dies(
    "SELECT count(*) AS total_rows, round(avg(is_fail), 6) AS fail_rate, round(avg(test_temp_c), 6) AS mean_test_temp_c, "
    "round(avg(cell_leakage_fa), 6) AS mean_cell_leakage_fa, round(avg(retention_time_ms), 6) AS mean_retention_time_ms, "
    "round(stddev_samp(test_temp_c), 6) AS std_test_temp_c, cast((SELECT count(*) FROM (" + " UNION ALL ".join(
        f"SELECT count(*) - count({c}) AS n FROM dies" for c in AUDIT) + ") WHERE n > 0) as int) AS null_columns FROM dies"))
def _(spark, d):
    narrow = dies(spark, d).select(*AUDIT, "is_fail")
    return rounded(profile.quality_summary(narrow, ["test_temp_c", "cell_leakage_fa", "retention_time_ms"], ["test_temp_c"]))


@query("ag05_daily_feature_stats", on_dies(
    "SELECT day_number, feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev, "
    "round(quantile_cont(value, 0.25), 8) AS p25, round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.75), 8) AS p75, "
    "round(min(value), 6) AS min_val, round(max(value), 6) AS max_val FROM long GROUP BY day_number, feature",
    long_cte(SIX, keep="day_number")))
def _(spark, d):
    return rounded(profile.daily_feature_stats(dies(spark, d), SIX), p25=8, p50=8, p75=8)


@query("ag06_split_profile", on_dies(
    "SELECT split, count(*) AS n_rows, 37 AS n_columns, 31 AS n_numeric, 6 AS n_other, cast(sum(is_fail) as bigint) AS n_fail, "
    "round(avg(is_fail), 6) AS fail_rate, cast(sum(cast(label_is_noisy as int)) as bigint) AS n_noisy, "
    "cast(sum(" + " + ".join(f"cast({c} IS NULL as int)" for c in AUDIT) + ") as bigint) AS missing_cells, "
    "round(100e0 * sum(" + " + ".join(f"cast({c} IS NULL as int)" for c in AUDIT) + ") / (count(*) * 37), 6) AS missing_pct FROM dies GROUP BY split"))
def _(spark, d):
    df = dies(spark, d).drop("score")
    return rounded(profile.split_profile(df))


@query("ag07_split_feature_profile", on_dies(
    "SELECT split, feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, "
    "round(skewness(value), 5) AS skew, round(100e0 * (count(*) - count(value)) / count(*), 6) AS missing_pct FROM long GROUP BY split, feature",
    "long AS (" + " UNION ALL ".join(f"SELECT split, '{c}' AS feature, cast({c} as double) AS value FROM dies" for c in S.NUMERIC[:15]) + ")"))
def _(spark, d):
    return rounded(profile.split_feature_profile(dies(spark, d), S.NUMERIC[:15]), skew=5)


@query("ag08_pair_correlation", on_dies(
    "SELECT split, round(corr(test_temp_c, cell_leakage_fa), 6) AS correlation FROM dies GROUP BY split"))
def _(spark, d):
    return rounded(profile.pair_correlation(dies(spark, d), "test_temp_c", "cell_leakage_fa", ["split"]))


@query("ag09_correlation_matrix", on_dies(
    " UNION ALL ".join(
        [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM dies" for a in CORR for b in CORR if a != b]
        + [f"SELECT '{a}' AS feature_a, '{a}' AS feature_b, 1e0 AS correlation" for a in CORR])))
def _(spark, d):
    return rounded(profile.correlation_matrix(dies(spark, d), CORR))


@query("ag10_edge_centre_ratio", on_dies(
    "SELECT split, round(e, 6) AS edge_fail_rate, round(c, 6) AS centre_fail_rate, round(e / greatest(c, 1e-6), 6) AS edge_ratio FROM ("
    "SELECT split, avg(is_fail) FILTER (WHERE edge_distance > 0.7) AS e, avg(is_fail) FILTER (WHERE edge_distance < 0.3) AS c FROM dies GROUP BY split)"))
def _(spark, d):
    return rounded(profile.edge_centre_ratio(dies(spark, d), by=["split"]))


_CAUSE = (
    "z AS (SELECT *, (cell_leakage_fa - (SELECT median(cell_leakage_fa) FROM dies)) / (SELECT stddev_pop(cell_leakage_fa) FROM dies) AS lz FROM dies), "
    "s AS (SELECT *, rh_susceptibility * 2 AS s1, greatest(0e0, (50 - retention_time_ms) / 20) AS s2, correctable_errors_per_1m / 5 + uncorrectable_in_extended * 3 AS s3, "
    "greatest(0e0, (trcd_ns - 15) / 2) AS s4, greatest(0e0, lz - 2) * 1.5e0 AS s5, greatest(0e0, (abs(vt_shift_mv) - 30) / 10) AS s6 FROM z), "
    "cause AS (SELECT *, CASE WHEN is_fail <> 1 THEN 'pass' WHEN top = s1 THEN 'row_hammer' WHEN top = s2 THEN 'retention_degradation' WHEN top = s3 THEN 'ecc_uncorrectable' "
    "WHEN top = s4 THEN 'contact_resistance' WHEN top = s5 THEN 'gate_oxide_defect' ELSE 'pass_transistor_weak' END AS root_cause "
    "FROM (SELECT *, greatest(s1, s2, s3, s4, s5, s6) AS top FROM s))"
)


@query("ag11_cause_counts", on_dies("SELECT root_cause, count(*) AS n FROM cause WHERE is_fail = 1 GROUP BY root_cause", _CAUSE))
def _(spark, d):
    df = dies(spark, d)
    return profile.cause_counts(features.dominant_cause(df, features.fit_leakage_scale(df)))


@query("ag12_class_balance", on_dies(
    "SELECT count(*) AS total, count(*) FILTER (WHERE is_fail = 0) AS n_pass, count(*) FILTER (WHERE is_fail = 1) AS n_fail, "
    "round(100e0 * count(*) FILTER (WHERE is_fail = 0) / count(*), 6) AS pass_pct, round(100e0 * count(*) FILTER (WHERE is_fail = 1) / count(*), 6) AS fail_pct, "
    "cast(floor(count(*) FILTER (WHERE is_fail = 0)::double / greatest(count(*) FILTER (WHERE is_fail = 1), 1)) as bigint) AS imbalance_ratio FROM dies"))
def _(spark, d):
    return rounded(profile.class_balance(dies(spark, d)))


@query("ag13_label_noise", on_dies(
    "SELECT is_fail, is_fail_true, count(*) AS n, CASE WHEN is_fail = 1 AND is_fail_true = 0 THEN 'flipped_to_fail' WHEN is_fail = 0 AND is_fail_true = 1 THEN 'flipped_to_pass' "
    "WHEN is_fail_true = 1 THEN 'true_fail' ELSE 'true_pass' END AS kind FROM dies GROUP BY is_fail, is_fail_true"))
def _(spark, d):
    return profile.label_noise(dies(spark, d))


@query("ag14_missing_share", on_dies(
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(100e0 * (count(*) - count({c})) / count(*), 6) AS missing_pct FROM dies" for c in AUDIT)
    + ") WHERE missing_pct > 0"))
def _(spark, d):
    return rounded(profile.missing_share(dies(spark, d), AUDIT))


@query("ag15_missing_patterns", on_dies(
    "SELECT concat(" + ", ".join(f"cast(cast({c} IS NULL as int) as varchar)" for c in GAPPY) + ") AS pattern, count(*) AS n FROM dies GROUP BY 1"))
def _(spark, d):
    return profile.missing_patterns(dies(spark, d), GAPPY)


@query("ag15_co_missing", on_dies(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS n FROM dies" for a, b in combinations(GAPPY, 2))))
def _(spark, d):
    return profile.co_missing(dies(spark, d), GAPPY)


@query("ag16_wafer_map", on_dies("SELECT die_x, die_y, round(avg(is_fail), 6) AS fail_rate, count(is_fail) AS n FROM dies GROUP BY die_x, die_y HAVING count(is_fail) >= 3"))
def _(spark, d):
    return rounded(profile.wafer_map(dies(spark, d)))


@query("ag17_fail_rate_by_distance", on_dies(
    "SELECT bin, round(avg(is_fail), 6) AS fail_rate, count(*) AS n, round((bin - 0.5e0) / 20, 6) AS bin_mid FROM (SELECT cast(ceil(edge_distance * 20) as int) AS bin, is_fail FROM dies "
    "WHERE edge_distance > 0 AND edge_distance <= 1) GROUP BY bin HAVING count(*) >= 20"))
def _(spark, d):
    return rounded(profile.fail_rate_by_distance(dies(spark, d)))


@query("ag18_wafer_map_quantile", on_dies(
    "SELECT round(quantile_cont(fail_rate, 0.95), 6) AS fail_rate_quantile FROM (SELECT avg(is_fail) AS fail_rate FROM dies GROUP BY die_x, die_y HAVING count(is_fail) >= 3)"))
def _(spark, d):
    return rounded(profile.wafer_map_quantile(profile.wafer_map(dies(spark, d))))


@query("ag19_describe", on_dies(
    "SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 8) AS p25, "
    "round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.75), 8) AS p75, round(max(value), 6) AS max FROM long GROUP BY feature", long_cte(S.NUMERIC)))
def _(spark, d):
    return rounded(profile.describe(dies(spark, d), S.NUMERIC), p25=8, p50=8, p75=8)


@query("ag20_class_medians", on_dies("SELECT is_fail, feature, round(median(value), 6) AS median FROM long GROUP BY is_fail, feature", long_cte(SIX, keep="is_fail")))
def _(spark, d):
    return rounded(profile.class_medians(dies(spark, d), SIX))


@query("ag21_wafer_anomaly_correlation", on_dies(
    "SELECT count(*) AS n_positions, round(corr(a, f), 6) AS correlation FROM (SELECT avg(score) AS a, avg(is_fail) AS f FROM dies GROUP BY die_x, die_y HAVING count(is_fail) >= 3)"))
def _(spark, d):
    return rounded(profile.wafer_anomaly_correlation(dies(spark, d), "score"))


@query("ag22_prediction_summary", on_dies(
    "SELECT tester_id, day_number, count(*) AS n_total, cast(sum(cast(score >= 0.5e0 as int)) as bigint) AS n_fail, round(avg(cast(score >= 0.5e0 as int)), 6) AS fail_rate "
    "FROM dies GROUP BY tester_id, day_number"))
def _(spark, d):
    df = dies(spark, d).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return rounded(profile.prediction_summary(df, ["tester_id", "day_number"]))


@query("ag23_latency_summary",
    "SELECT user_id % 8 AS concurrency, count(*) AS total_requests, count(*) FILTER (WHERE event_type = 'error') AS errors, "
    "round(100e0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS error_rate_pct, round(count(*) FILTER (WHERE event_type <> 'error') / 3600e0, 6) AS throughput, "
    "round(quantile_cont(value, 0.5) FILTER (WHERE event_type <> 'error'), 6) AS latency_p50, round(quantile_cont(value, 0.95) FILTER (WHERE event_type <> 'error'), 6) AS latency_p95, "
    "round(quantile_cont(value, 0.99) FILTER (WHERE event_type <> 'error'), 6) AS latency_p99, round(avg(value) FILTER (WHERE event_type <> 'error'), 6) AS latency_mean FROM events GROUP BY 1")
def _(spark, d):
    e = table(spark, d, "events").withColumn("concurrency", F.col("user_id") % 8)
    return rounded(profile.latency_summary(e, ["concurrency"], "value", F.col("event_type") != "error", 3600.0))


@query("ag25_business_impact", on_dies(
    "SELECT split, round(r, 6) AS recall, round(r * 50000 * 1200 * 0.006e0 * 12, 2) AS annual_value_usd FROM ("
    "SELECT split, count(*) FILTER (WHERE is_fail = 1 AND score >= 0.3e0)::double / count(*) FILTER (WHERE is_fail = 1) AS r FROM dies GROUP BY split)"))
def _(spark, d):
    hit = F.count_if((F.col("is_fail") == 1) & (F.col("score") >= 0.3))
    recall = dies(spark, d).groupBy("split").agg((hit / F.count_if(F.col("is_fail") == 1)).alias("recall"))
    return rounded(profile.business_impact(recall), annual_value_usd=2)


@query("ag25_alarm_costs", on_dies(
    "SELECT split, count(*) FILTER (WHERE is_fail = 1 AND score < 0.3e0) AS fn, count(*) FILTER (WHERE is_fail = 0 AND score >= 0.3e0) AS fp, "
    "-(count(*) FILTER (WHERE is_fail = 1 AND score < 0.3e0) * 45000e0 + count(*) FILTER (WHERE is_fail = 0 AND score >= 0.3e0) * 120e0) AS annual_value_usd FROM dies GROUP BY split"))
def _(spark, d):
    counts = dies(spark, d).groupBy("split").agg(
        F.count_if((F.col("is_fail") == 1) & (F.col("score") < 0.3)).alias("fn"),
        F.count_if((F.col("is_fail") == 0) & (F.col("score") >= 0.3)).alias("fp"),
    )
    return profile.business_impact(counts, "cost")


@query("ag26_stage_rates", on_dies(
    "SELECT stage, n_rows, round(seconds, 6) AS seconds, round(n_rows / seconds, 6) AS rows_per_sec, round(seconds / sum(seconds) OVER (), 6) AS time_share FROM ("
    "SELECT recipe_version AS stage, count(*) AS n_rows, sum(rw_latency_ns) / 1000e0 AS seconds FROM dies GROUP BY recipe_version)"))
def _(spark, d):
    stages = dies(spark, d).groupBy(F.col("recipe_version").alias("stage")).agg(
        F.count("*").alias("n_rows"), (F.sum("rw_latency_ns") / 1000.0).alias("seconds")
    )
    return rounded(profile.stage_rates(stages))


_HIST = (
    "span AS (SELECT {k}, feature, min(value) AS lo, max(value) AS hi, count(*) AS total FROM long GROUP BY {k}, feature), "
    "g AS (SELECT l.{k}, l.feature, lo, hi, total, cast(least(floor((value - lo) / (hi - lo) * 50), 49) as int) AS b0, value FROM long l JOIN span s ON l.{k} = s.{k} AND l.feature = s.feature), "
    "g2 AS (SELECT *, CASE WHEN value < lo + b0 * ((hi - lo) / 50) THEN b0 - 1 WHEN b0 < 49 AND value >= lo + (b0 + 1) * ((hi - lo) / 50) THEN b0 + 1 ELSE b0 END AS bin FROM g)"
)
_HIST_BODY = (
    "SELECT {k}, feature, bin, round(lo + bin * ((hi - lo) / 50), 8) AS low, round(lo + (bin + 1) * ((hi - lo) / 50), 8) AS high, count(*) AS n, "
    "round(count(*) / (total * ((hi - lo) / 50)), 6) AS density FROM g2 GROUP BY {k}, feature, lo, hi, total, bin"
)
THREE = ["test_temp_c", "retention_time_ms", "gate_oxide_thickness_a"]


@query("dr17_daily_density", on_dies(_HIST_BODY.format(k="day_number"), long_cte(THREE, keep="day_number"), _HIST.format(k="day_number")))
def _(spark, d):
    return rounded(profile.density_histogram(dies(spark, d), THREE, ["day_number"], 50), low=8, high=8)


@query("dr18_class_density", on_dies(_HIST_BODY.format(k="is_fail"), long_cte(SIX, keep="is_fail"), _HIST.format(k="is_fail")))
def _(spark, d):
    return rounded(profile.density_histogram(dies(spark, d), SIX, ["is_fail"], 50), low=8, high=8)
