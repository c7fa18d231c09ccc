"""Registered queries: selection, sampling, cleaning and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.functions.columns import stable_key
from lotwise.operators import balance, clean, features, metrics, quality, running
from lotwise.plans.bindings import dies, long_cte, on_dies, query, rounded, table
from lotwise.plans.profiles import _CAUSE, GAPPY
from lotwise.spec import Bound

KEYED = ["die_key", "day_number"]


def _cols(names) -> str:
    return ", ".join(names)


def _r(names) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in names)


# --- selection and sampling ---------------------------------------------------------------------

@query("pf01_one_day", on_dies("SELECT die_key, is_fail FROM dies WHERE day_number = 15"))
def _(spark, d):
    return dies(spark, d).where(F.col("day_number") == 15).select("die_key", "is_fail")


@query("pf02_only_complete", on_dies(
    "SELECT split, count(*) AS n FROM dies WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in GAPPY) + " GROUP BY split"))
def _(spark, d):
    return quality.only_complete(dies(spark, d), GAPPY).groupBy("split").agg(F.count("*").alias("n"))


@query("pf03_drop_meta", on_dies("SELECT day_number, die_x, die_y, is_fail, count(*) AS n FROM dies GROUP BY ALL"))
def _(spark, d):
    df = quality.drop_meta(dies(spark, d).select("day_number", "die_x", "die_y", "is_fail", "split", "wafer_num", "is_fail_true"), S.META)
    return df.groupBy(*df.columns).agg(F.count("*").alias("n"))


@query("pf04_numeric_columns", on_dies(f"SELECT day_number, {_r([f'avg_{c}' for c in S.NUMERIC])} FROM (SELECT day_number, "
    + ", ".join(f"avg({c}) AS avg_{c}" for c in S.NUMERIC) + " FROM dies GROUP BY day_number)"))
def _(spark, d):
    df = dies(spark, d)
    names = quality.columns_of_type(df, ["double"], exclude=["score", "edge_distance", "day_fraction"])
    return rounded(df.groupBy("day_number").agg(*[F.avg(c).alias(f"avg_{c}") for c in names]))


@query("pf06_fixed_size_sample", on_dies(
    "SELECT die_key, is_fail FROM (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', die_key))) AS r FROM dies) WHERE r <= 5000"))
def _(spark, d):
    return running.sample_exact(dies(spark, d), 5000, ["die_key"]).select("die_key", "is_fail")


@query("pf07_keep_minority", on_dies(
    "SELECT die_key, is_fail FROM dies WHERE is_fail = 1 UNION ALL SELECT die_key, is_fail FROM ("
    "SELECT *, row_number() OVER (ORDER BY md5(concat('42|', die_key))) AS r FROM dies WHERE is_fail <> 1) WHERE r <= 3000"))
def _(spark, d):
    return balance.keep_minority(dies(spark, d).select("die_key", "is_fail"), "is_fail", 3000, ["die_key"])


@query("pf08_stratified_split", on_dies(
    "SELECT die_key, is_fail, CASE WHEN r <= round(n * 0.6e0) THEN 'train' WHEN r <= round(n * 0.75e0) THEN 'val' WHEN r <= round(n * 0.9e0) THEN 'test' ELSE 'unseen' END AS split "
    "FROM (SELECT die_key, is_fail, row_number() OVER (PARTITION BY is_fail ORDER BY md5(concat('42|', die_key))) AS r, count(*) OVER (PARTITION BY is_fail) AS n FROM dies)"))
def _(spark, d):
    return balance.stratified_split(dies(spark, d).select("die_key", "is_fail"), "is_fail", ["die_key"])


@query("pf09_conditional_column", on_dies(
    "SELECT CASE WHEN is_fail = 0 THEN 'pass' ELSE 'unknown' END AS verdict, count(*) AS n FROM dies GROUP BY 1"))
def _(spark, d):
    return dies(spark, d).groupBy(F.when(F.col("is_fail") == 0, "pass").otherwise("unknown").alias("verdict")).agg(F.count("*").alias("n"))


_BOUNDS = (Bound("test_temp_c", 82, 90), Bound("cell_leakage_fa", 8), Bound("retention_time_ms", 0), Bound("vt_shift_mv", -55, 55, 0.0), Bound("edge_distance", 0, 0.95, 0.0))
_RULES = [
    ("test_temp_c:low", "test_temp_c < 82"), ("test_temp_c:high", "test_temp_c > 90"), ("cell_leakage_fa:missing", "cell_leakage_fa IS NULL"),
    ("cell_leakage_fa:low", "cell_leakage_fa < 8"), ("retention_time_ms:missing", "retention_time_ms IS NULL"), ("vt_shift_mv:low", "vt_shift_mv < -55"),
    ("vt_shift_mv:high", "vt_shift_mv > 55"), ("edge_distance:high", "edge_distance > 0.95"),
]


@query("pf10_violation_counts", on_dies("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n FROM dies WHERE {t}" for n, t in _RULES) + ") WHERE n > 0"))
def _(spark, d):
    return quality.violation_counts(quality.check_bounds(dies(spark, d), _BOUNDS))


@query("pf10_quarantine", on_dies("SELECT die_key, " + " + ".join(f"coalesce(cast({t} as int), 0)" for _, t in _RULES) + " AS n_rules FROM dies WHERE " + " OR ".join(f"coalesce({t}, false)" for _, t in _RULES)))
def _(spark, d):
    return quality.quarantined(quality.check_bounds(dies(spark, d), _BOUNDS)).select("die_key", F.size("violations").alias("n_rules"))


@query("pf10_accepted_rows", on_dies("SELECT split, count(*) AS n FROM dies WHERE NOT (" + " OR ".join(f"coalesce({t}, false)" for _, t in _RULES) + ") GROUP BY split"))
def _(spark, d):
    return quality.accepted(quality.check_bounds(dies(spark, d), _BOUNDS)).groupBy("split").agg(F.count("*").alias("n"))


@query("pf10_request_sizes", "SELECT l_suppkey AS request, count(*) AS n_rows, count(*) BETWEEN 1 AND 600 AS accepted FROM lineitem GROUP BY 1")
def _(spark, d):
    return quality.check_request_sizes(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("request")), ["request"], 600)


@query("pf11_defaults", on_dies(
    "SELECT chamber, probe_card_id, count(*) AS n, round(avg(vt), 6) AS mean_vt, round(avg(trcd), 6) AS mean_trcd FROM (SELECT coalesce(chamber_id, 'CH001') AS chamber, probe_card_id, "
    "coalesce(vt_shift_mv, 0e0) AS vt, coalesce(trcd_ns, 0e0) AS trcd FROM dies) GROUP BY 1, 2"))
def _(spark, d):
    df = quality.with_defaults(dies(spark, d))
    return rounded(df.groupBy(F.col("chamber_id").alias("chamber"), "probe_card_id").agg(
        F.count("*").alias("n"), F.avg("vt_shift_mv").alias("mean_vt"), F.avg("trcd_ns").alias("mean_trcd")))


@query("pf12_reliability", on_dies(
    "SELECT day_number, n_ref, n_cur, least(n_ref, n_cur) >= 1500 AS drift_reliable, least(n_ref, n_cur) < 1500 AS low_data_warning FROM ("
    "SELECT day_number, count(*) AS n_cur FROM dies GROUP BY day_number), (SELECT count(*) AS n_ref FROM dies WHERE day_number = 1)"))
def _(spark, d):
    df = dies(spark, d)
    n_ref = df.where("day_number = 1").count()
    counts = df.groupBy("day_number").agg(F.count("*").alias("n_cur")).withColumn("n_ref", F.lit(n_ref))
    t = S.DriftThresholds(min_reliable_rows=1500)
    return quality.reliability(counts, "n_ref", "n_cur", t)


def _odd_scores(spark, d):
    s = F.when(F.col("order_no") % 997 == 1, F.lit(float("nan"))).when(F.col("order_no") % 991 == 2, F.lit(float("inf"))).otherwise(F.col("score"))
    return dies(spark, d).select("die_key", "split", "is_fail", s.alias("score"))


_ODD = "odd AS (SELECT die_key, split, is_fail, CASE WHEN order_no % 997 = 1 THEN 'nan'::double WHEN order_no % 991 = 2 THEN 'inf'::double ELSE score END AS score FROM dies)"


@query("pf13_score_validity", on_dies(
    "SELECT split, count(*) AS n, count(*) FILTER (WHERE isnan(score) OR isinf(score)) AS n_invalid, round(1 - count(*) FILTER (WHERE isnan(score) OR isinf(score)) / count(*)::double, 6) AS valid_ratio, "
    "1 - count(*) FILTER (WHERE isnan(score) OR isinf(score)) / count(*)::double >= 0.999e0 AS usable FROM odd GROUP BY split", _ODD))
def _(spark, d):
    return rounded(metrics.score_validity(metrics.guard_scores(_odd_scores(spark, d))))


@query("pf13_safe_scores", on_dies(
    "SELECT split, is_valid, count(*) AS n, round(sum(s), 4) AS total FROM (SELECT split, NOT (isnan(score) OR isinf(score)) AS is_valid, "
    "CASE WHEN isnan(score) THEN 0e0 WHEN isinf(score) THEN 1e0 ELSE score END AS s FROM odd) GROUP BY ALL", _ODD))
def _(spark, d):
    g = metrics.guard_scores(_odd_scores(spark, d))
    return rounded(g.groupBy("split", "is_valid").agg(F.count("*").alias("n"), F.sum("safe_score").alias("total")), 4)


# --- cleaning -----------------------------------------------------------------------------------

_MED = "med AS (SELECT " + ", ".join(f"median({c}) FILTER (WHERE split = 'train') AS m_{c}" for c in GAPPY) + " FROM dies)"
_IMPUTED = "imputed AS (SELECT d.* REPLACE (" + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in GAPPY) + ") FROM dies d, med)"


@query("fe01_median_impute", on_dies("SELECT die_key, day_number, " + _r(GAPPY) + " FROM imputed", _MED, _IMPUTED))
def _(spark, d):
    df = dies(spark, d)
    fill = clean.fit_medians(df.where("split = 'train'"), GAPPY)
    return rounded(clean.impute(df.select(*KEYED, *GAPPY), fill))


@query("fe02_approx_clean")
def _(spark, d):
    return clean.clean(dies(spark, d).select(*KEYED, *GAPPY, *S.CATEGORICAL), GAPPY, S.CATEGORICAL, "approx")


@query("fe03_mode_impute", on_dies(
    "SELECT chamber, count(*) AS n FROM (SELECT coalesce(chamber_id, (SELECT chamber_id FROM dies WHERE split = 'train' AND chamber_id IS NOT NULL GROUP BY chamber_id "
    "ORDER BY count(*) DESC, chamber_id LIMIT 1)) AS chamber FROM dies) GROUP BY chamber"))
def _(spark, d):
    df = dies(spark, d)
    fill = clean.fit_modes(df.where("split = 'train'"), S.CATEGORICAL)
    return clean.impute(df, fill).groupBy(F.col("chamber_id").alias("chamber")).agg(F.count("*").alias("n"))


@query("fe03_mode_table", on_dies(
    "SELECT feature, value, n FROM (SELECT feature, value, count(*) AS n, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS r FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM dies WHERE {c} IS NOT NULL" for c in S.CATEGORICAL) + ") GROUP BY feature, value) WHERE r = 1"))
def _(spark, d):
    return clean.mode_table(dies(spark, d), S.CATEGORICAL)


@query("fe05_constant_impute", on_dies("SELECT split, " + ", ".join(f"round(avg(coalesce({c}, 0e0)), 6) AS {c}" for c in GAPPY) + " FROM dies GROUP BY split"))
def _(spark, d):
    df = clean.impute(dies(spark, d), {c: 0.0 for c in GAPPY})
    return rounded(df.groupBy("split").agg(*[F.avg(c).alias(c) for c in GAPPY]))


@query("fe06_remaining_nulls", on_dies("SELECT cast(sum(" + " + ".join(f"cast({c} IS NULL as int)" for c in ["vt_shift_mv", "gate_oxide_thickness_a", *GAPPY]) + ") as bigint) AS remaining_nulls FROM imputed", _MED, _IMPUTED))
def _(spark, d):
    df = dies(spark, d)
    filled = clean.impute(df, clean.fit_medians(df.where("split = 'train'"), GAPPY))
    return clean.remaining_nulls(filled, ["vt_shift_mv", "gate_oxide_thickness_a", *GAPPY])


_WIN = ["trcd_ns", "rw_latency_ns", "cell_leakage_fa", "uncorrectable_in_extended"]
_QUART = "quart AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25) FILTER (WHERE split = 'train') AS a_{c}, quantile_cont({c}, 0.75) FILTER (WHERE split = 'train') AS b_{c}" for c in _WIN) + " FROM dies)"


def _clipped(c: str, k: float = 3.0) -> str:
    return f"CASE WHEN {c} IS NULL OR a_{c} = b_{c} THEN {c} ELSE greatest(least({c}, b_{c} + {k}e0 * (b_{c} - a_{c})), a_{c} - {k}e0 * (b_{c} - a_{c})) END"


@query("fe07_winsorize", on_dies("SELECT die_key, day_number, " + ", ".join(f"round({_clipped(c)}, 6) AS {c}" for c in _WIN) + " FROM dies, quart", _QUART))
def _(spark, d):
    df = dies(spark, d)
    return rounded(clean.winsorize(df.select(*KEYED, *_WIN), clean.fit_winsor_bounds(df.where("split = 'train'"), _WIN)))


@query("fe07_clipped_counts", on_dies(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(max(a_{c} - 3e0 * (b_{c} - a_{c})), 6) AS lower, round(max(b_{c} + 3e0 * (b_{c} - a_{c})), 6) AS upper, "
    f"count(*) FILTER (WHERE {c} < a_{c} - 3e0 * (b_{c} - a_{c}) OR {c} > b_{c} + 3e0 * (b_{c} - a_{c})) AS n_clipped FROM dies, quart" for c in _WIN), _QUART))
def _(spark, d):
    df = dies(spark, d)
    return rounded(clean.clipped_counts(df, clean.fit_winsor_bounds(df.where("split = 'train'"), _WIN, strict=True)))


@query("fe08_log_scale", on_dies("SELECT die_key, day_number, " + ", ".join(f"round(ln(1 + CASE WHEN {c} < 0 THEN 0e0 ELSE {c} END), 6) AS {c}" for c in S.LOG_SCALED) + " FROM dies"))
def _(spark, d):
    return rounded(clean.log_scale(dies(spark, d).select(*KEYED, *S.LOG_SCALED), S.LOG_SCALED))


# --- features -----------------------------------------------------------------------------------

_LOGGED = "logged AS (SELECT d.* REPLACE (" + ", ".join(f"ln(1 + CASE WHEN {c} < 0 THEN 0e0 ELSE {c} END) AS {c}" for c in S.LOG_SCALED) + ") FROM {src} d)"
_ENG_LOG = (
    "retention_time_ms * test_temp_c AS retention_temp_interaction, cell_leakage_fa / (retention_time_ms + 1e-8) AS leakage_retention_ratio, edge_distance * edge_distance AS edge_risk, "
    "idd4_active_ma / (idd2p_standby_ma + 1e-8) AS power_ratio, bit_error_rate + ecc_syndrome_entropy + uncorrectable_in_extended AS ecc_burden, trcd_ns + trp_ns - tras_ns AS timing_margin, "
    "rh_susceptibility * ln(1 + adjacent_row_activations) AS rh_risk_composite"
)
_ENG_RAW = (
    "retention_time_ms * test_temp_c AS retention_temp_interaction, CASE WHEN retention_time_ms IS NOT NULL THEN cell_leakage_fa / greatest(retention_time_ms, 0.001e0) END AS leakage_retention_ratio, "
    "edge_distance * cell_leakage_fa AS edge_risk, idd4_active_ma / greatest(idd2p_standby_ma, 0.001e0) AS power_ratio, correctable_errors_per_1m * ecc_syndrome_entropy AS ecc_burden, "
    "(18e0 - trcd_ns) + (18e0 - trp_ns) AS timing_margin, rh_susceptibility * (250e0 - disturb_margin_mv) / 250e0 AS rh_risk_composite"
)


@query("fe09_engineer_log", on_dies(f"SELECT die_key, day_number, {_r(S.ENGINEERED)} FROM (SELECT die_key, day_number, {_ENG_LOG} FROM logged)", _LOGGED.format(src="dies")))
def _(spark, d):
    df = features.engineer(clean.log_scale(dies(spark, d), S.LOG_SCALED), "log")
    return rounded(df.select(*KEYED, *S.ENGINEERED))


@query("fe10_engineer_raw", on_dies(f"SELECT die_key, day_number, {_r(S.ENGINEERED)} FROM (SELECT die_key, day_number, {_ENG_RAW} FROM dies)"))
def _(spark, d):
    return rounded(features.engineer(dies(spark, d), "raw").select(*KEYED, *S.ENGINEERED))


_CODES = "codes AS (SELECT feature, value, cast(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 as int) AS code FROM (" + " UNION ".join(
    f"SELECT '{c}' AS feature, {c} AS value FROM dies WHERE split = 'train' AND {c} IS NOT NULL" for c in S.CATEGORICAL) + "))"


@query("fe11_category_codes", on_dies("SELECT * FROM codes", _CODES))
def _(spark, d):
    return features.category_codes(dies(spark, d).where("split = 'train'"), S.CATEGORICAL)


@query("fe11_encode", on_dies(
    "SELECT die_key, day_number, " + ", ".join(f"coalesce((SELECT code FROM codes WHERE feature = '{c}' AND value = dies.{c}), -1) AS {c}" for c in S.CATEGORICAL) + " FROM dies", _CODES))
def _(spark, d):
    df = dies(spark, d)
    codes = features.category_codes(df.where("split = 'train'"), S.CATEGORICAL)
    return features.encode(df.select(*KEYED, *S.CATEGORICAL), codes, S.CATEGORICAL)


_SCALED = [*GAPPY, "die_x", "die_y", "edge_distance"]


@query("fe12_standardize", on_dies(
    "SELECT die_key, day_number, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED) + " FROM dies, (SELECT "
    + ", ".join(f"avg({c}) FILTER (WHERE split = 'train') AS m_{c}, stddev_pop({c}) FILTER (WHERE split = 'train') AS s_{c}" for c in _SCALED) + " FROM dies)"))
def _(spark, d):
    df = dies(spark, d)
    fitted = features.fit_moments(df.where("split = 'train'"), _SCALED)
    return rounded(features.standardize(df.select(*KEYED, *_SCALED), fitted))


@query("fe13_undersample", on_dies(
    "SELECT die_key, is_fail FROM dies WHERE is_fail = 1 UNION ALL SELECT die_key, is_fail FROM (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', die_key))) AS r FROM dies WHERE is_fail <> 1) "
    "WHERE r <= 10 * (SELECT count(*) FROM dies WHERE is_fail = 1)"))
def _(spark, d):
    return balance.undersample(dies(spark, d).select("die_key", "is_fail"), "is_fail", ["die_key"])


@query("fe16_class_weights", on_dies(
    "SELECT is_fail, n, round(1e0 / n, 9) AS inverse_weight, round(t / (2 * n), 6) AS balanced_weight, round((SELECT count(*) FROM dies WHERE is_fail = 0)::double / (SELECT count(*) FROM dies WHERE is_fail = 1), 6) AS positive_scale "
    "FROM (SELECT is_fail, count(*)::double AS n0, count(*) AS n, (SELECT count(*) FROM dies)::double AS t FROM dies GROUP BY is_fail)"))
def _(spark, d):
    return rounded(features.class_weights(dies(spark, d), "is_fail"), inverse_weight=9)


@query("fe16_weighted_rows", on_dies(
    "SELECT split, round(sum(CASE WHEN is_fail = 1 THEN t / (2 * p) ELSE t / (2 * (t - p)) END), 4) AS total_weight FROM dies, "
    "(SELECT count(*)::double AS t, count(*) FILTER (WHERE is_fail = 1)::double AS p FROM dies) GROUP BY split"))
def _(spark, d):
    df = features.with_class_weight(dies(spark, d), "is_fail")
    return rounded(df.groupBy("split").agg(F.sum("weight").alias("total_weight")), 4)


@query("fe17_vectors", on_dies("SELECT die_key, round(retention_time_ms, 6) AS second_tabular, 4 AS n_tabular, round(edge_distance, 6) AS last_spatial, 3 AS n_spatial FROM dies"))
def _(spark, d):
    df = features.vectors(dies(spark, d), ["test_temp_c", "retention_time_ms", "trp_ns", "tras_ns"], S.SPATIAL)
    return rounded(df.select("die_key", F.col("tabular")[1].alias("second_tabular"), F.size("tabular").alias("n_tabular"),
                             F.col("spatial")[2].alias("last_spatial"), F.size("spatial").alias("n_spatial")))


@query("fe20_centre_distance", on_dies("SELECT die_x, die_y, count(*) AS n, round(max(sqrt(power(die_x - 17.5e0, 2) + power(die_y - 24e0, 2)) / sqrt(17.5e0 * 17.5e0 + 24e0 * 24e0)), 6) AS distance FROM dies GROUP BY die_x, die_y"))
def _(spark, d):
    df = dies(spark, d).withColumn("r", features.centre_distance(F.col("die_x"), F.col("die_y")))
    return rounded(df.groupBy("die_x", "die_y").agg(F.count("*").alias("n"), F.max("r").alias("distance")))


_RISK = (
    "risk AS (SELECT die_key, day_number, root_cause, least(greatest((0.0003e0 + 0.003e0 * least(greatest(lz - 2, 0e0), 5e0) + CASE WHEN retention_time_ms < 45 THEN 0.005e0 ELSE 0e0 END "
    "+ CASE WHEN retention_time_ms < 35 THEN 0.015e0 ELSE 0e0 END + CASE WHEN rh_susceptibility > 0.7e0 THEN 0.004e0 ELSE 0e0 END + CASE WHEN rh_susceptibility > 0.9e0 THEN 0.010e0 ELSE 0e0 END "
    "+ CASE WHEN correctable_errors_per_1m > 10 THEN 0.008e0 ELSE 0e0 END + CASE WHEN trcd_ns > 17 THEN 0.003e0 ELSE 0e0 END + CASE WHEN abs(vt_shift_mv) > 40 THEN 0.004e0 ELSE 0e0 END "
    "+ 0.050e0 * uncorrectable_in_extended + 0.0005e0 * day_fraction) * (1 + 6 * least(greatest((edge_distance - 0.55e0) / 0.45e0, 0e0), 1e0)), 0e0), 0.95e0) AS risk FROM cause WHERE cell_leakage_fa IS NOT NULL)"
)


@query("fe21_risk_score", on_dies("SELECT die_key, day_number, round(risk, 9) AS risk FROM risk", _CAUSE, _RISK))
def _(spark, d):
    df = dies(spark, d)
    scored = features.risk_score(df, features.fit_leakage_scale(df))
    return rounded(scored.where(F.col("cell_leakage_fa").isNotNull()).select(*KEYED, "risk"), 9)


@query("fe22_dominant_cause", on_dies("SELECT die_key, day_number, root_cause FROM cause", _CAUSE))
def _(spark, d):
    df = dies(spark, d)
    return features.dominant_cause(df, features.fit_leakage_scale(df)).select(*KEYED, "root_cause")


@query("fe23_shift_columns", on_dies(
    "SELECT die_key, round(test_temp_c + 2e0 * (SELECT stddev_pop(test_temp_c) FROM dies), 6) AS test_temp_c, round(trcd_ns + 2e0 * (SELECT stddev_pop(trcd_ns) FROM dies), 6) AS trcd_ns FROM dies"))
def _(spark, d):
    return rounded(features.shift_columns(dies(spark, d), ["test_temp_c", "trcd_ns"], 2.0).select("die_key", "test_temp_c", "trcd_ns"))


# --- neighbour-based operators on the embedding table ---------------------------------------------

def _points(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), (F.col("label") == 0).cast("int").alias("rare"))


_DIST = "list_distance(p.e, q.e)"
_PTS = "pts AS (SELECT vec_id, cast(embedding as double[]) AS e, cast(label = 0 as int) AS rare FROM embeddings)"


_FRAC = "cast(('0x' || substr(md5({0}), 1, 8)) AS bigint) / 4294967296e0"
_SMOTE = (
    _PTS, "rare_pts AS (SELECT vec_id, e FROM pts WHERE rare = 1)",
    "need AS (SELECT cast(floor(0.3e0 * count(*) FILTER (WHERE rare = 0)) AS bigint) - count(*) FILTER (WHERE rare = 1) AS needed, count(*) FILTER (WHERE rare = 1) AS pos FROM pts)",
    "nn AS (SELECT p.vec_id, q.vec_id AS donor, q.e AS other, row_number() OVER (PARTITION BY p.vec_id ORDER BY " + _DIST + ", q.vec_id) AS r FROM rare_pts p JOIN rare_pts q ON p.vec_id <> q.vec_id)",
    "near AS (SELECT * FROM nn WHERE r <= 5)", "sized AS (SELECT vec_id, count(*) AS n FROM near GROUP BY vec_id)",
    "ranked AS (SELECT vec_id, e, row_number() OVER (ORDER BY md5('42|' || vec_id)) AS r FROM rare_pts)",
    "seeds AS (SELECT vec_id, e, unnest(range(1, needed // pos + cast(r <= needed % pos AS int) + 1)) AS c FROM ranked, need WHERE needed > 0 AND pos >= 2)",
    "chosen AS (SELECT s.vec_id, s.e, s.c, n.other, " + _FRAC.format("'42-step|' || s.vec_id || '|' || s.c") + " AS u FROM seeds s JOIN sized z ON z.vec_id = s.vec_id JOIN near n ON n.vec_id = s.vec_id AND n.r = cast(floor("
    + _FRAC.format("'42-neighbour|' || s.vec_id || '|' || s.c") + " * z.n) AS bigint) + 1)",
)


@query("fe14_smote", "WITH " + ", ".join(_SMOTE) + " SELECT cast(vec_id AS varchar) AS vec_id, e AS v, rare, false AS synthetic FROM pts UNION ALL "
    "SELECT vec_id || '+' || c, list_transform(range(1, len(e) + 1), lambda i: e[i] + u * (other[i] - e[i])), 1, true FROM chosen")
def _(spark, d):
    return balance.smote(_points(spark, d), "v", "rare", "vec_id")


@query("fe15_tomek_links", f"WITH {_PTS}, nn AS (SELECT p.vec_id AS a, p.rare AS ra, arg_min(q.vec_id, ({_DIST}, q.vec_id)) AS b FROM pts p JOIN pts q ON p.vec_id <> q.vec_id GROUP BY p.vec_id, p.rare) "
    "SELECT x.a, x.b FROM nn x JOIN nn y ON x.b = y.a AND y.b = x.a WHERE x.a < x.b AND x.ra <> y.ra")
def _(spark, d):
    return balance.tomek_links(_points(spark, d), "v", "rare", "vec_id")


@query("fe15_drop_tomek", f"WITH {_PTS}, nn AS (SELECT p.vec_id AS a, p.rare AS ra, arg_min(q.vec_id, ({_DIST}, q.vec_id)) AS b FROM pts p JOIN pts q ON p.vec_id <> q.vec_id GROUP BY p.vec_id, p.rare) "
    "SELECT vec_id, rare FROM pts WHERE vec_id NOT IN (SELECT x.a FROM nn x JOIN nn y ON x.b = y.a AND y.b = x.a WHERE x.ra <> y.ra)")
def _(spark, d):
    return balance.drop_tomek_majority(_points(spark, d), "v", "rare", "vec_id").select("vec_id", "rare")


_GAPPY = ["test_temp_c", "cell_leakage_fa", "trp_ns", "trcd_ns"]
_SQUARES = " + ".join(f"coalesce((q.{c} - t.{c}) * (q.{c} - t.{c}), 0)" for c in _GAPPY)
_SHARED = " + ".join(f"cast(q.{c} IS NOT NULL AND t.{c} IS NOT NULL AS int)" for c in _GAPPY)
_FILLED = ", ".join(
    f"round(coalesce({c}, (SELECT value FROM fill WHERE fill.die_key = dies.die_key AND feature = '{c}'), (SELECT avg({c}) FROM dies WHERE split = 'train')), 6) AS {c}" for c in _GAPPY)
_FILL_CTES = (
    "gaps AS (" + " UNION ALL ".join(f"SELECT die_key, '{c}' AS feature, {', '.join(_GAPPY)} FROM dies WHERE {c} IS NULL" for c in _GAPPY) + ")",
    f"pairs AS (SELECT q.die_key, q.feature, t.die_key AS donor, CASE q.feature {' '.join(f'WHEN {chr(39)}{c}{chr(39)} THEN t.{c}' for c in _GAPPY)} END AS v, "
    f"sqrt(({_SQUARES}) * {len(_GAPPY)} / nullif({_SHARED}, 0)) AS dist FROM gaps q JOIN dies t ON t.split = 'train')",
    "near AS (SELECT die_key, feature, unnest(arg_min({'dist': dist, 'v': v}, {'dist': dist, 'donor': donor}, 5), recursive := true) FROM pairs WHERE v IS NOT NULL AND dist IS NOT NULL GROUP BY die_key, feature)",
    "fill AS (SELECT die_key, feature, CASE WHEN min(dist) = 0 THEN avg(v) FILTER (WHERE dist = 0) ELSE sum(v / dist) / sum(1 / dist) END AS value FROM near GROUP BY die_key, feature)",
)


@query("fe15_resample")
def _(spark, d):
    return balance.resample(_points(spark, d), "v", "rare", "vec_id").groupBy("rare", "synthetic").agg(F.count("*").alias("n"))


@query("fe04_knn_impute", on_dies(f"SELECT die_key, {_FILLED} FROM dies", *_FILL_CTES))
def _(spark, d):
    df = dies(spark, d).select("die_key", "split", *_GAPPY)
    return rounded(clean.knn_impute(df.where("split = 'train'"), df.drop("split"), _GAPPY, "die_key"))
