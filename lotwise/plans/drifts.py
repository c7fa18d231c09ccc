"""Registered queries: distribution drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.functions.columns import NORMAL_BOTTOM, NORMAL_TOP
from lotwise.operators import drift, sketches
from lotwise.plans.bindings import dies, long_cte, on_dies, query, rounded
from lotwise.plans.scratch import folder
from lotwise.sources import tables as io

SIX = list(S.KEY_DRIFT_FEATURES)
DISCRETE = ["correctable_errors_per_1m", "idd4_active_ma", "uncorrectable_in_extended"]
NINE = SIX + DISCRETE
DAYS = list(range(1, 41))


def quantile_ctes(features, ref: str = "day_number <= 8", key: str = "day_number", prefix: str = "", eps: str = "1e-6", source: str = "dies") -> list[str]:
    """Oracle text of quantile-bin PSI per group: edges, bins, shares and ``psi(key, feature, psi, n)``."""
    p = prefix
    keep = key if key == "day_number" else f"{key}, day_number"
    inner = " + ".join(f"cast(value >= e[{i}] as int)" for i in range(1, 10))
    return [
        long_cte(features, f"{p}long", keep, source),
        # Linear interpolation spelled out, so that an edge on a value falls on the same side in both engines.
        f"{p}edges AS (SELECT feature, [CASE WHEN v[cast(floor((len(v) - 1) * q) as int) + 1] = v[cast(ceil((len(v) - 1) * q) as int) + 1] THEN v[cast(floor((len(v) - 1) * q) as int) + 1] "
        f"ELSE (ceil((len(v) - 1) * q) - (len(v) - 1) * q) * v[cast(floor((len(v) - 1) * q) as int) + 1] + ((len(v) - 1) * q - floor((len(v) - 1) * q)) * v[cast(ceil((len(v) - 1) * q) as int) + 1] END "
        f"for q in [0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0]] AS e FROM (SELECT feature, list(value ORDER BY value) AS v FROM {p}long WHERE {ref} GROUP BY feature))",
        f"{p}binned AS (SELECT l.*, {inner} AS bin FROM {p}long l JOIN {p}edges USING (feature))",
        f"{p}refp AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS p FROM (SELECT feature, bin, count(*) AS n FROM {p}binned WHERE {ref} GROUP BY ALL))",
        f"{p}curp AS (SELECT {key}, feature, bin, n / sum(n) OVER (PARTITION BY {key}, feature) AS p FROM (SELECT {key}, feature, bin, count(*) AS n FROM {p}binned GROUP BY ALL))",
        f"{p}cells AS (SELECT k.{key}, k.feature, g.bin, coalesce(c.p, 0) + {eps} AS a, coalesce(r.p, 0) + {eps} AS r, k.n FROM (SELECT {key}, feature, count(*) AS n FROM {p}binned GROUP BY ALL) k "
        f"CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN {p}curp c ON c.{key} = k.{key} AND c.feature = k.feature AND c.bin = g.bin LEFT JOIN {p}refp r ON r.feature = k.feature AND r.bin = g.bin)",
        f"{p}psi AS (SELECT {key}, feature, max(n) AS n, sum((a - r) * ln(a / r)) AS psi FROM {p}cells GROUP BY {key}, feature)",
    ]


def report_cte(features: int, key: str = "day_number", prefix: str = "", name: str = "report") -> str:
    p = prefix
    return (
        f"{name} AS (SELECT {key}, count(*) FILTER (WHERE psi > 0.2) AS features_critical, count(*) FILTER (WHERE psi > 0.1 AND psi <= 0.2) AS features_warning, "
        f"{features} - count(*) FILTER (WHERE psi > 0.1) AS features_clean, count(*) FILTER (WHERE psi > 0.2) >= 3 AS should_retrain, avg(psi) AS avg_psi, "
        f"string_agg(feature, ',' ORDER BY round(psi, 6) DESC, feature DESC) AS by_psi FROM {p}psi GROUP BY {key})"
    )


def reference(spark, d, features=SIX, kind=drift.QUANTILE, days="day_number <= 8"):
    df = dies(spark, d)
    return df, drift.fit_reference(df.where(days), features, kind)


@query("dr01_quantile_psi", on_dies(
    "SELECT p.day_number, p.feature, p.n, round(p.psi, 6) AS psi, CASE WHEN p.psi > 0.2 THEN 'critical' WHEN p.psi > 0.1 THEN 'warning' ELSE 'none' END AS severity FROM psi p", *quantile_ctes(NINE)))
def _(spark, d):
    df, ref = reference(spark, d, NINE)
    return rounded(drift.psi_report(df, ref, ["day_number"]).select("day_number", "feature", "n", "psi", "severity"))


_WIDTH = [
    long_cte(NINE, keep="day_number"),
    "span AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long WHERE day_number <= 8 GROUP BY feature)",
    "g AS (SELECT l.day_number, l.feature, value, lo, hi, CASE WHEN value BETWEEN lo AND hi THEN cast(least(floor((value - lo) / (hi - lo) * 20), 19) as int) END AS b0 FROM long l JOIN span USING (feature))",
    "g2 AS (SELECT day_number, feature, value, CASE WHEN value < lo + b0 * ((hi - lo) / 20) THEN b0 - 1 WHEN b0 < 19 AND value >= lo + (b0 + 1) * ((hi - lo) / 20) THEN b0 + 1 ELSE b0 END AS bin FROM g)",
    "refp AS (SELECT feature, bin, n / sum(n) OVER (PARTITION BY feature) AS p FROM (SELECT feature, bin, count(*) AS n FROM g2 WHERE day_number <= 8 GROUP BY ALL))",
    "curp AS (SELECT day_number, feature, bin, n / sum(n) OVER (PARTITION BY day_number, feature) AS p FROM (SELECT day_number, feature, bin, count(*) AS n FROM g2 WHERE bin IS NOT NULL GROUP BY ALL))",
    "keys AS (SELECT day_number, feature, count(*) AS n, count(*) FILTER (WHERE bin IS NULL) AS n_out_of_range, avg(value) AS cur_mean FROM g2 GROUP BY ALL)",
    "cells AS (SELECT k.day_number, k.feature, greatest(coalesce(c.p, 0), 1e-10) AS a, greatest(coalesce(r.p, 0), 1e-10) AS r FROM keys k CROSS JOIN (SELECT unnest(range(20)) AS bin) b "
    "LEFT JOIN curp c ON c.day_number = k.day_number AND c.feature = k.feature AND c.bin = b.bin LEFT JOIN refp r ON r.feature = k.feature AND r.bin = b.bin)",
    "norm AS (SELECT *, a / sum(a) OVER (PARTITION BY day_number, feature) AS an, r / sum(r) OVER (PARTITION BY day_number, feature) AS rn FROM cells)",
    "div AS (SELECT day_number, feature, sum((a - r) * ln(a / r)) AS psi, sum(an * ln(an / rn)) AS kl FROM norm GROUP BY ALL)",
]
_STATUS = "CASE WHEN psi >= 0.2 OR kl >= 0.1 THEN 'critical' WHEN psi >= 0.1 OR kl >= 0.05 THEN 'warning' ELSE 'ok' END"


@query("dr02_width_psi", on_dies("SELECT day_number, feature, n, n_out_of_range, round(psi, 6) AS psi FROM div JOIN keys USING (day_number, feature)", *_WIDTH))
def _(spark, d):
    df, ref = reference(spark, d, NINE, drift.WIDTH)
    return rounded(drift.divergence_report(df, ref, ["day_number"]).select("day_number", "feature", "n", "n_out_of_range", "psi"))


@query("dr03_kl_divergence", on_dies("SELECT day_number, feature, round(kl, 6) AS kl FROM div", *_WIDTH))
def _(spark, d):
    df, ref = reference(spark, d, NINE, drift.WIDTH)
    return rounded(drift.divergence_report(df, ref, ["day_number"]).select("day_number", "feature", "kl"))


_KS_TWO_SAMPLE = on_dies(
    "SELECT feature, n_reference, n_current, round(max(abs(ref_below / n_reference - cur_below / n_current)), 6) AS ks_statistic FROM ("
    "SELECT feature, value, sum(ref) OVER w AS ref_below, sum(cur) OVER w AS cur_below, cast(sum(ref) OVER (PARTITION BY feature) as bigint) AS n_reference, cast(sum(cur) OVER (PARTITION BY feature) as bigint) AS n_current "
    "FROM (SELECT feature, value, count(*) FILTER (WHERE day_number <= 8) AS ref, count(*) FILTER (WHERE day_number > 8) AS cur FROM long WHERE day_number <= 8 OR day_number > 8 GROUP BY ALL) "
    "WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)) GROUP BY ALL", long_cte(NINE, keep="day_number"))


@query("dr04_ks_two_sample", _KS_TWO_SAMPLE)
@query("dr04_ks_two_sample_all_days", _KS_TWO_SAMPLE)
def _(spark, d):
    df = dies(spark, d)
    ks = drift.ks_two_sample(df.where("day_number <= 8"), df.where("day_number > 8"), NINE)
    return rounded(ks.select("feature", "n_reference", "n_current", "ks_statistic"))


@query("dr04_ks_daily", on_dies(
    "SELECT day_number, feature, n_reference, n_current, round(max(abs(ref_below / n_reference - cur_below / n_current)), 6) AS ks_statistic FROM ("
    "SELECT day_number, feature, value, sum(ref) OVER w AS ref_below, sum(cur) OVER w AS cur_below, cast(sum(ref) OVER (PARTITION BY day_number, feature) as bigint) AS n_reference, "
    "cast(sum(cur) OVER (PARTITION BY day_number, feature) as bigint) AS n_current FROM (SELECT g.day_number, feature, value, count(*) FILTER (WHERE side = 'r') AS ref, count(*) FILTER (WHERE side = 'c') AS cur FROM ("
    "SELECT d.day_number, feature, value, 'r' AS side FROM long, (SELECT DISTINCT day_number FROM dies WHERE day_number > 8) d WHERE long.day_number <= 8 "
    "UNION ALL SELECT day_number, feature, value, 'c' FROM long WHERE day_number > 8) g GROUP BY ALL) "
    "WINDOW w AS (PARTITION BY day_number, feature ORDER BY value ROWS UNBOUNDED PRECEDING)) GROUP BY ALL", long_cte(SIX, keep="day_number")))
def _(spark, d):
    df = dies(spark, d)
    ks = drift.ks_by_group(df.where("day_number <= 8"), df.where("day_number > 8"), SIX, ["day_number"])
    return rounded(ks.select("day_number", "feature", "n_reference", "n_current", "ks_statistic"))


def normal_curve(z: str) -> str:
    """Oracle text of the normal distribution function."""
    polynomial = lambda given: reduce(lambda total, c: f"({total} * abs({z}) + {c!r})", given[1:], f"{given[0]!r}")
    fraction = reduce(lambda total, k: f"(abs({z}) + {k}e0 / {total})", (4, 3, 2, 1), f"(abs({z}) + 0.65e0)")
    tail = (f"exp(-abs({z}) * abs({z}) / 2) * CASE WHEN abs({z}) < 7.07106781186547e0 THEN {polynomial(NORMAL_TOP)} / {polynomial(NORMAL_BOTTOM)} "
            f"ELSE 1 / ({fraction} * 2.506628274631e0) END")
    return f"CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END"


@query("dr04_ks_against_stored_normal", on_dies(
    "SELECT day_number, feature, n, round(d, 6) AS ks_statistic, round(CASE WHEN x < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END * exp(-2e0 * k * k * x * x))))) END, 6) AS ks_pvalue "
    "FROM (SELECT *, (sqrt(n) + 0.12e0 + 0.11e0 / sqrt(n)) * d AS x FROM (SELECT day_number, feature, cast(max(n) as bigint) AS n, max(greatest(upto / n - curve, curve - (upto - here) / n)) AS d FROM ("
    f"SELECT *, {normal_curve('z')} AS curve FROM (SELECT c.day_number, c.feature, here, (value - mean) / greatest(std, 1e-6) AS z, sum(here) OVER (PARTITION BY c.day_number, c.feature ORDER BY value) AS upto, sum(here) OVER (PARTITION BY c.day_number, c.feature) AS n "
    "FROM (SELECT day_number, feature, value, count(*) AS here FROM long WHERE day_number > 8 GROUP BY ALL) c JOIN (SELECT feature, avg(value) AS mean, stddev_pop(value) AS std FROM long WHERE day_number <= 8 GROUP BY feature) r USING (feature))) GROUP BY day_number, feature))",
    long_cte(NINE, keep="day_number")))
def _(spark, d):
    df, ref = reference(spark, d, NINE, drift.WIDTH)
    return rounded(drift.ks_normal(df.where("day_number > 8"), ref, ["day_number"]))


@query("dr05_reference_stats", on_dies(
    "SELECT feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(median(value), 6) AS median, round(quantile_cont(value, 0.25), 6) AS q25, "
    "round(quantile_cont(value, 0.75), 6) AS q75, count(*) AS n FROM long WHERE day_number <= 8 GROUP BY feature", long_cte(NINE, keep="day_number")))
def _(spark, d):
    _, ref = reference(spark, d, NINE)
    return rounded(ref.to_frame(spark).select("feature", "mean", "std", "median", "q25", "q75", "n"))


@query("dr06_mean_shift", on_dies(
    "SELECT day_number, c.feature, round(rm, 6) AS ref_mean, round(rs, 6) AS ref_std, round(cm, 6) AS cur_mean, round(cs, 6) AS cur_std, round(100 * abs(cm - rm) / (abs(rm) + 1e-10), 6) AS mean_shift_pct FROM ("
    "SELECT day_number, feature, avg(value) AS cm, stddev_pop(value) AS cs FROM long GROUP BY ALL) c JOIN (SELECT feature, avg(value) AS rm, stddev_pop(value) AS rs FROM long WHERE day_number <= 8 GROUP BY feature) r USING (feature)",
    long_cte(SIX, keep="day_number")))
def _(spark, d):
    df, ref = reference(spark, d)
    return rounded(drift.psi_report(df, ref, ["day_number"]).select("day_number", "feature", "ref_mean", "ref_std", "cur_mean", "cur_std", "mean_shift_pct"))


@query("dr07_severity_inclusive", on_dies("SELECT day_number, feature, CASE WHEN psi >= 0.2 THEN 'critical' WHEN psi >= 0.1 THEN 'warning' ELSE 'none' END AS severity FROM psi", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    return drift.psi_report(df, ref, ["day_number"], inclusive=True).select("day_number", "feature", "severity")


@query("dr08_combined_status", on_dies(f"SELECT day_number, feature, {_STATUS} AS status FROM div", *_WIDTH))
def _(spark, d):
    df, ref = reference(spark, d, NINE, drift.WIDTH)
    return drift.divergence_report(df, ref, ["day_number"]).select("day_number", "feature", "status")


@query("dr09_drift_report", on_dies(
    "SELECT day_number, features_critical, features_warning, features_clean, should_retrain, CASE WHEN should_retrain THEN concat(features_critical, ' features with PSI > 0.2 (threshold: 3)') "
    "ELSE concat('Only ', features_critical, ' critical features (need 3)') END AS retrain_reason, by_psi FROM report", *quantile_ctes(NINE), report_cte(9)))
def _(spark, d):
    df, ref = reference(spark, d, NINE)
    s = drift.drift_summary(drift.psi_report(df, ref, ["day_number"]), ["day_number"], 9)
    return s.select("day_number", "features_critical", "features_warning", "features_clean", "should_retrain", "retrain_reason", F.array_join("by_psi", ",").alias("by_psi"))


@query("dr10_top_drifted", on_dies("SELECT day_number, r AS place, feature, round(psi, 6) AS psi FROM (SELECT *, row_number() OVER (PARTITION BY day_number ORDER BY round(psi, 6) DESC, feature DESC) AS r FROM psi) WHERE r <= 5", *quantile_ctes(NINE)))
def _(spark, d):
    df, ref = reference(spark, d, NINE)
    s = drift.drift_summary(drift.psi_report(df, ref, ["day_number"]), ["day_number"], 9)
    top = s.select("day_number", "feature_psi", F.posexplode("top_drifted").alias("i", "feature"))
    return rounded(top.select("day_number", (F.col("i") + 1).cast("long").alias("place"), "feature", F.element_at("feature_psi", F.col("feature")).alias("psi")))


@query("dr11_overall_status", on_dies(
    f"SELECT day_number, c AS features_critical, w AS features_warning, CASE WHEN c >= 3 THEN 'critical' WHEN w > 0 THEN 'warning' ELSE 'ok' END AS overall_status, CASE WHEN c > 0 THEN 'critical' WHEN w > 0 THEN 'warning' ELSE 'ok' END AS max_severity FROM ("
    f"SELECT day_number, count(*) FILTER (WHERE s = 'critical') AS c, count(*) FILTER (WHERE s = 'warning') AS w FROM (SELECT day_number, {_STATUS} AS s FROM div) GROUP BY day_number)", *_WIDTH))
def _(spark, d):
    df, ref = reference(spark, d, NINE, drift.WIDTH)
    s = drift.drift_summary(drift.divergence_report(df, ref, ["day_number"]), ["day_number"], 9, level="status")
    return s.select("day_number", "features_critical", "features_warning", "overall_status", "max_severity")


@query("dr12_drift_scan", on_dies(
    "SELECT day_number, n AS analysis_rows, (SELECT count(*) FROM dies WHERE day_number <= 8) AS reference_rows, features_critical, features_warning, features_clean, should_retrain, by_psi FROM report "
    "JOIN (SELECT day_number, count(*) AS n FROM dies GROUP BY day_number) USING (day_number)", *quantile_ctes(S.NUMERIC), report_cte(22)))
def _(spark, d):
    df, ref = reference(spark, d, S.NUMERIC)
    scan = drift.drift_scan(df, ref)
    return scan.select("day_number", "analysis_rows", F.col("reference_rows").cast("long").alias("reference_rows"), "features_critical", "features_warning", "features_clean", "should_retrain", F.array_join("by_psi", ",").alias("by_psi"))


@query("dr12_scan_summary", on_dies(
    "SELECT count(*) AS total_days_scanned, string_agg(CASE WHEN should_retrain THEN day_number::varchar END, ',' ORDER BY day_number) AS retrain_days, count(*) FILTER (WHERE should_retrain) AS retrain_count FROM report WHERE day_number BETWEEN 9 AND 40",
    *quantile_ctes(NINE), report_cte(9)))
def _(spark, d):
    df, ref = reference(spark, d, NINE)
    s = drift.scan_summary(drift.drift_scan(df, ref, first=9, last=40))
    return s.withColumn("retrain_days", F.array_join(F.transform("retrain_days", lambda x: x.cast("string")), ","))


@query("dr13_prediction_drift", on_dies(
    "SELECT day_number, 0.0062e0 AS reference_fail_rate, round(r, 6) AS current_fail_rate, round(abs(r - 0.0062e0) / (0.0062e0 + 1e-10) * 100, 6) AS relative_change_pct, "
    "CASE WHEN abs(r - 0.0062e0) / (0.0062e0 + 1e-10) > 0.5 THEN 'critical' ELSE 'ok' END AS status, abs(r - 0.0062e0) / (0.0062e0 + 1e-10) > 0.5 AS should_investigate FROM ("
    "SELECT day_number, avg(cast(score >= 0.56e0 as int)) AS r FROM dies GROUP BY day_number)"))
def _(spark, d):
    df = dies(spark, d).withColumn("prediction", (F.col("score") >= 0.56).cast("int"))
    return rounded(drift.prediction_drift(df, ["day_number"]))


_LIGHT = on_dies(
    "SELECT n.day_number, coalesce(c, 0) AS features_critical, coalesce(w, 0) AS features_warning, coalesce(c, 0) >= 3 AND least(n.n, rn) >= 1400 AS should_retrain, least(n.n, rn) >= 1400 AS drift_reliable, "
    "rn AS ref_rows, n.n AS analysis_rows, round(coalesce(temp, 0), 6) AS temp_psi FROM (SELECT day_number, count(*) AS n FROM dies GROUP BY day_number) n CROSS JOIN (SELECT count(*) AS rn FROM dies WHERE day_number = 1) "
    "LEFT JOIN (SELECT day_number, count(*) FILTER (WHERE psi > 0.2) AS c, count(*) FILTER (WHERE psi > 0.1 AND psi <= 0.2) AS w, max(CASE WHEN feature = 'test_temp_c' THEN psi END) AS temp FROM psi WHERE n >= 100 GROUP BY day_number) USING (day_number)",
    *quantile_ctes(SIX, "day_number = 1"))


@query("dr14_light_check", _LIGHT)
def _(spark, d):
    df, ref = reference(spark, d, SIX, days="day_number = 1")
    t = S.DriftThresholds(min_reliable_rows=1400)
    c = drift.light_check(df, ref, t=t)
    return rounded(c.select("day_number", "features_critical", "features_warning", "should_retrain", "drift_reliable", F.col("ref_rows").cast("long").alias("ref_rows"), "analysis_rows",
                            F.coalesce(F.element_at("feature_psi", "test_temp_c"), F.lit(0.0)).alias("temp_psi")))


@query("io13_report_files", _LIGHT)
def _(spark, d):
    """The reports of all days written as one JSON document a day and read back."""
    df, ref = reference(spark, d, SIX, days="day_number = 1")
    report = drift.light_check(df, ref, t=S.DriftThresholds(min_reliable_rows=1400)).withColumnRenamed("day_number", "analysis_day")
    path = folder(spark, "day-reports")
    report.withColumn("day", F.col("analysis_day")).repartition("day").write.partitionBy("day").json(path)
    back = io.read_drift_reports(spark, f"{path}/*").withColumnRenamed("analysis_day", "day_number")
    return rounded(back.select(
        "day_number", F.col("features_critical").cast("long").alias("features_critical"), F.col("features_warning").cast("long").alias("features_warning"), "should_retrain",
        "drift_reliable", "ref_rows", "analysis_rows", F.coalesce(F.element_at("feature_psi", "test_temp_c"), F.lit(0.0)).alias("temp_psi")))


@query("dr15_psi_matrix", on_dies("SELECT feature, " + ", ".join(f"round(coalesce(max(CASE WHEN day_number = {i} THEN psi END), 0), 6) AS day_{i:02d}" for i in DAYS) + " FROM psi GROUP BY feature", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    return rounded(drift.psi_matrix(drift.psi_report(df, ref, ["day_number"]), DAYS))


@query("dr16_average_psi", on_dies(
    "SELECT day_number, round(a, 6) AS avg_psi, CASE WHEN a > 0.2 THEN 'critical' WHEN a > 0.1 THEN 'warning' ELSE 'none' END AS severity FROM (SELECT day_number, avg(psi) AS a FROM psi GROUP BY day_number)", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    return rounded(drift.average_psi(drift.psi_report(df, ref, ["day_number"])))


@query("dr01_psi_by_tester", on_dies("SELECT tester_id, feature, n, round(psi, 6) AS psi FROM psi", *quantile_ctes(SIX, key="tester_id")))
def _(spark, d):
    df, ref = reference(spark, d)
    return rounded(drift.psi_report(df, ref, ["tester_id"]).select("tester_id", "feature", "n", "psi"))


# --- reference windows from stored sketches ----------------------------------------------------------

WIDTH = 8


def _sketched(spark, d):
    """Sketches of all days, written in two runs; the second adds the days that the first did not have."""
    df, path = dies(spark, d), folder(spark, "sketches")
    sketches.update(df.where("day_number <= 20"), path, NINE)
    sketches.update(df, path, NINE)
    return df, sketches.read(spark, path)


_SLIDING = f"days AS (SELECT DISTINCT day_number AS target FROM dies WHERE day_number > {WIDTH}), moved AS (SELECT target, feature, value FROM long JOIN days ON day_number BETWEEN target - {WIDTH} AND target - 1)"


@query("dr05_sliding_reference", on_dies(
    "SELECT target AS day_number, feature, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS low, round(max(value), 6) AS high FROM moved GROUP BY ALL",
    long_cte(NINE, keep="day_number"), _SLIDING))
def _(spark, d):
    """Statistics of the eight days before each day, from one stored sketch a day and feature."""
    _, stored = _sketched(spark, d)
    moving = sketches.sliding(stored, WIDTH).where(f"day_number > {WIDTH}")
    return rounded(moving.select("day_number", "feature", "n", "mean", "std", "low", "high"))


@query("io16_sketch_quantiles", on_dies(
    "SELECT DISTINCT target AS day_number, feature, p AS place, true AS within FROM moved, (SELECT unnest([0.25e0, 0.5e0, 0.75e0]) AS p)", long_cte(NINE, keep="day_number"), _SLIDING))
def _(spark, d):
    """Quartiles of the moving windows, and whether their exact ranks, counted over the rows, are within one percent."""
    df, stored = _sketched(spark, d)
    moving = sketches.sliding(stored, WIDTH).where(f"day_number > {WIDTH}")
    return sketches.rank_check(df, moving, [0.25, 0.5, 0.75], WIDTH, 0.01)


@query("dr12_sliding_scan", on_dies(
    f"SELECT l.day_number, l.feature, count(*) AS n, any_value(r.n) AS n_reference, true AS shares_add_up FROM long l JOIN (SELECT target, feature, count(*) AS n FROM moved GROUP BY ALL) r ON r.target = l.day_number AND r.feature = l.feature WHERE l.day_number > {WIDTH} GROUP BY ALL",
    long_cte(NINE, keep="day_number"), _SLIDING))
def _(spark, d):
    """Every day against the eight days before it, from sketches alone."""
    _, stored = _sketched(spark, d)
    scan = sketches.sliding_psi(stored, WIDTH).where(f"day_number > {WIDTH}")
    return scan.select("day_number", "feature", "n", "n_reference", ((F.col("psi") >= 0) & F.col("psi").isNotNull()).alias("shares_add_up"))
