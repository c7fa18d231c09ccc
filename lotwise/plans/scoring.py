"""Registered queries: classifier metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.losses import focal_gradient, focal_objective
from lotwise.operators import metrics
from lotwise.plans.bindings import dies, on_dies, query, rounded
from lotwise.spec import FocalParams


def _scored(spark, d):
    return dies(spark, d).select("die_key", "tester_id", "split", F.col("is_fail").alias("label"), "score")


_SC = "sc AS (SELECT die_key, tester_id, split, is_fail AS label, score FROM dies)"
_GRP = "grp AS (SELECT split, score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM sc GROUP BY ALL)"
_CURVE = (
    "curve AS (SELECT *, cast(sum(pos) OVER w as bigint) AS tp, cast(sum(neg) OVER w as bigint) AS fp, cast(sum(pos) OVER (PARTITION BY split) as bigint) AS n_pos, cast(sum(neg) OVER (PARTITION BY split) as bigint) AS n_neg, "
    "sum(pos) OVER w / (sum(pos) OVER w + sum(neg) OVER w) AS precision, sum(pos) OVER w / sum(pos) OVER (PARTITION BY split) AS recall FROM grp WINDOW w AS (PARTITION BY split ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"
)
_RANK = (
    "ranked AS (SELECT split, n_pos + n_neg AS n_samples, n_pos AS n_positive, sum(pos * precision) / n_pos AS auc_pr, sum(pos * (n_neg - fp + neg / 2e0)) / (n_pos::double * n_neg) AS auc_roc FROM curve GROUP BY split, n_pos, n_neg)"
)
_BEST = "best AS (SELECT threshold, f1 FROM (SELECT threshold, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM curve WHERE split = 'val') ORDER BY f1 DESC, threshold LIMIT 1)"
_CONF = "count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, count(*) FILTER (WHERE score >= {t} AND label <> 1) AS fp, count(*) FILTER (WHERE score < {t} AND label = 1) AS fn, count(*) FILTER (WHERE score < {t} AND label <> 1) AS tn"
_PRF = "round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::double ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::double ELSE 0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"


@query("me01_confusion", on_dies(f"SELECT split, {_CONF.format(t='0.3e0')} FROM sc GROUP BY split", _SC))
def _(spark, d):
    return metrics.confusion(_scored(spark, d), ["split"], threshold=0.3)


@query("me02_rates", on_dies(f"SELECT *, {_PRF} FROM (SELECT tester_id, split, {_CONF.format(t='0.55e0')} FROM sc GROUP BY ALL)", _SC))
def _(spark, d):
    return rounded(metrics.rates(metrics.confusion(_scored(spark, d), ["tester_id", "split"], threshold=0.55)))


@query("me03_precision_recall_curve", on_dies("SELECT split, round(threshold, 6) AS threshold, pos, neg, tp, fp, n_pos, n_neg, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve", _SC, _GRP, _CURVE))
def _(spark, d):
    return rounded(metrics.precision_recall_curve(_scored(spark, d), ["split"]))


@query("me04_average_precision", on_dies("SELECT split, n_samples, n_positive, round(auc_pr, 6) AS auc_pr FROM ranked", _SC, _GRP, _CURVE, _RANK))
def _(spark, d):
    m = metrics.ranking_metrics(metrics.precision_recall_curve(_scored(spark, d), ["split"]), ["split"])
    return rounded(m.select("split", "n_samples", "n_positive", "auc_pr"))


@query("me05_roc_auc", on_dies("SELECT split, round(auc_roc, 6) AS auc_roc FROM ranked", _SC, _GRP, _CURVE, _RANK))
def _(spark, d):
    m = metrics.ranking_metrics(metrics.precision_recall_curve(_scored(spark, d), ["split"]), ["split"])
    return rounded(m.select("split", "auc_roc"))


@query("me06_best_threshold", on_dies(
    "SELECT split, round(threshold, 6) AS threshold, round(f1, 6) AS best_f1 FROM (SELECT split, threshold, 2 * precision * recall / (precision + recall + 1e-8) AS f1, "
    "row_number() OVER (PARTITION BY split ORDER BY 2 * precision * recall / (precision + recall + 1e-8) DESC, threshold) AS r FROM curve) WHERE r = 1", _SC, _GRP, _CURVE))
def _(spark, d):
    return rounded(metrics.best_threshold(metrics.precision_recall_curve(_scored(spark, d), ["split"]), ["split"]))


@query("me07_evaluate_at_val_threshold", on_dies(
    f"SELECT split, round(threshold, 6) AS threshold, tp, fp, fn, tn, {_PRF}, n_samples, n_positive, round(auc_pr, 6) AS auc_pr, round(auc_roc, 6) AS auc_roc FROM ("
    f"SELECT split, threshold, {_CONF.format(t='threshold')} FROM sc, best GROUP BY ALL) JOIN ranked USING (split)", _SC, _GRP, _CURVE, _RANK, _BEST))
def _(spark, d):
    return rounded(metrics.evaluate(_scored(spark, d)))


@query("me08_decide", on_dies("SELECT die_key, CASE WHEN score >= 0.4e0 THEN 1 ELSE 0 END AS prediction, CASE WHEN score >= 0.4e0 THEN 'FAIL' ELSE 'PASS' END AS decision FROM sc", _SC))
def _(spark, d):
    return metrics.decide(_scored(spark, d), threshold=0.4).select("die_key", "prediction", "decision")


_P = "fp AS (SELECT *, CASE WHEN label = 1 THEN p ELSE 1 - p END AS pt, CASE WHEN label = 1 THEN 0.75e0 ELSE 0.25e0 END AS aw FROM (SELECT *, least(greatest(score, 1e-7), 1 - 1e-7) AS p FROM sc))"


@query("me09_focal_loss", on_dies("SELECT split, round(avg(aw * power(1 - pt, 2) * -ln(pt)), 6) AS focal_loss, round(avg(aw * -ln(pt)), 6) AS log_loss FROM fp GROUP BY split", _SC, _P))
def _(spark, d):
    df = _scored(spark, d)
    focal = metrics.mean_focal_loss(df, ["split"])
    plain = metrics.mean_focal_loss(df, ["split"], params=FocalParams(gamma=0.0)).withColumnRenamed("focal_loss", "log_loss")
    return rounded(focal.join(plain, "split"))


_Z = (
    "zz AS (SELECT *, 6 * score - 3 AS z FROM sc), zp AS (SELECT *, 1 / (1 + exp(-z)) AS s, label * 0.99e0 + 0.005e0 AS soft FROM zz), "
    "zq AS (SELECT *, CASE WHEN label = 1 THEN s ELSE 1 - s END AS pt, CASE WHEN label = 1 THEN 0.75e0 ELSE 0.25e0 END AS aw, greatest(z, 0e0) - z * soft + ln(1 + exp(-abs(z))) AS bce FROM zp)"
)


@query("me10_smoothed_focal_loss", on_dies("SELECT split, round(avg(aw * power(1 - pt, 2) * bce), 6) AS focal_loss FROM zq GROUP BY split", _SC, _Z))
def _(spark, d):
    df = _scored(spark, d).withColumn("logit", 6 * F.col("score") - 3)
    return rounded(metrics.mean_smoothed_focal_loss(df, ["split"]))


@query("me11_focal_gradient", on_dies(
    "SELECT die_key, round(g, 6) AS gradient, round(abs(g) * (1 - abs(g)) + 1e-7, 6) AS hessian, round(og, 6) AS objective_gradient, round(greatest(abs(og) * (1 - abs(og)), 1e-7), 6) AS objective_hessian FROM ("
    "SELECT die_key, CASE WHEN label = 1 THEN -t ELSE t END AS g, og FROM (SELECT f.die_key, f.label, f.aw * power(1 - f.pt, 2) * (2 * f.pt * ln(f.pt) + f.pt - 1) AS t, "
    "f.aw * (2 * (1 - q.pt) * ln(q.pt) * q.s * (1 - q.s) + power(1 - q.pt, 2) * (q.s - f.label)) AS og FROM (SELECT *, row_number() OVER (ORDER BY die_key, score) AS r FROM fp) f "
    "JOIN (SELECT *, row_number() OVER (ORDER BY die_key, score) AS r FROM zq) q ON f.r = q.r))", _SC, _P, _Z))
def _(spark, d):
    df = _scored(spark, d).withColumn("logit", 6 * F.col("score") - 3)
    g, h = focal_gradient(F.col("label"), F.col("score"))
    og, oh = focal_objective(F.col("label"), F.col("logit"))
    return rounded(df.select("die_key", g.alias("gradient"), h.alias("hessian"), og.alias("objective_gradient"), oh.alias("objective_hessian")))


@query("me12_baseline_and_lift", on_dies("SELECT split, round(n_positive / n_samples::double, 6) AS baseline_ap, round(auc_pr / (n_positive / n_samples::double), 6) AS lift FROM ranked", _SC, _GRP, _CURVE, _RANK))
def _(spark, d):
    m = metrics.ranking_metrics(metrics.precision_recall_curve(_scored(spark, d), ["split"]), ["split"])
    return rounded(m.select("split", "baseline_ap", "lift"))


@query("me13_normalized_confusion", on_dies(
    f"SELECT split, round(tn / (tn + fp)::double, 6) AS tn_share, round(fp / (tn + fp)::double, 6) AS fp_share, round(fn / (fn + tp)::double, 6) AS fn_share, round(tp / (fn + tp)::double, 6) AS tp_share FROM (SELECT split, {_CONF.format(t='0.3e0')} FROM sc GROUP BY split)", _SC))
def _(spark, d):
    return rounded(metrics.normalized_confusion(metrics.confusion(_scored(spark, d), ["split"], threshold=0.3), ["split"]))
