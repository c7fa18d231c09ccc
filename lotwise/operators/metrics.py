"""Metrics of rare-event classifiers. Scores are counted per distinct value before anything is ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.columns import is_finite, join_same, ratio
from lotwise.functions.losses import focal_loss, smoothed_focal_loss
from lotwise.operators.running import running_totals
from lotwise.spec import FocalParams


def guard_scores(df: DataFrame, score: str = "score", split: str = "split", min_valid: float = 0.999) -> DataFrame:
    """Flag non-finite scores and add ``safe_score`` (NaN 0, +inf 1, -inf 0)."""
    s = F.col(score).cast("double")
    safe = (
        F.when(s.isNull() | F.isnan(s), 0.0)
        .when(s == float("inf"), 1.0)
        .when(s == float("-inf"), 0.0)
        .otherwise(s)
    )
    return df.withColumns({"is_valid": is_finite(score), "safe_score": safe})


def score_validity(df: DataFrame, by: Sequence[str] = ("split",), min_valid: float = 0.999) -> DataFrame:
    """(by, n, n_invalid, valid_ratio, usable) of guarded scores."""
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("n"), F.count_if(~F.col("is_valid")).alias("n_invalid"))
        .withColumn("valid_ratio", 1 - F.col("n_invalid") / F.col("n"))
        .withColumn("usable", (F.col("valid_ratio") >= min_valid) & (F.col("n_invalid") < F.col("n")))
    )


def require_valid_scores(df: DataFrame, by: Sequence[str] = ("split",), min_valid: float = 0.999) -> DataFrame:
    """Only finite scores; the job fails when a split has too few of them."""
    checked = score_validity(df, by, min_valid)
    guarded = checked.select(
        *by,
        F.when(F.col("usable"), True)
        .otherwise(F.raise_error(F.lit("too many non-finite scores")).cast("boolean"))
        .alias("_usable"),
    )
    return join_same(df.where("is_valid"), guarded, by).where("_usable").drop("_usable")


def confusion(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score", threshold=0.5) -> DataFrame:
    """(by, tp, fp, fn, tn) at ``score >= threshold``; the threshold is a number or a column."""
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"),
        F.count_if(~hit & ~real).alias("tn"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; undefined ones are zero."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2.0 * tp, 2 * tp + fp + fn),
        }
    )


def normalized_confusion(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each count as a share of its true class."""
    pos, neg = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return counts.select(
        *by,
        ratio(F.col("tn"), neg).alias("tn_share"),
        ratio(F.col("fp"), neg).alias("fp_share"),
        ratio(F.col("fn"), pos).alias("fn_share"),
        ratio(F.col("tp"), pos).alias("tp_share"),
    )


def precision_recall_curve(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score") -> DataFrame:
    """(by, threshold, pos, neg, tp, fp, n_pos, n_neg, precision, recall), one row per distinct score.

    Rows whose score is null or NaN have no rank and are left out; ``guard_scores`` gives them one.
    """
    by = list(by)
    ranked = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    grouped = ranked.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    totals = grouped.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    running = running_totals(grouped, "threshold", {"pos_upto": "pos", "neg_upto": "neg"}, by)
    if by:
        joined = join_same(running, totals, by)
    else:
        row = totals.first()
        joined = running.withColumns({"n_pos": F.lit(row["n_pos"]), "n_neg": F.lit(row["n_neg"])})
    tp = F.col("n_pos") - F.col("pos_upto") + F.col("pos")
    fp = F.col("n_neg") - F.col("neg_upto") + F.col("neg")
    return joined.select(
        *by, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "n_pos", "n_neg",
        ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("n_pos")).alias("recall"),
    )


def ranking_metrics(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """Average precision (step-wise) and ROC AUC (ties count half) per group."""
    p, n = F.col("n_pos"), F.col("n_neg")
    neg_below = n - F.col("fp")
    sums = curve.groupBy(*by, "n_pos", "n_neg").agg(
        F.sum(F.col("pos") * F.col("precision")).alias("_ap"),
        F.sum(F.col("pos") * (neg_below + F.col("neg") / 2.0)).alias("_u"),
    )
    return sums.select(
        *by,
        (p + n).alias("n_samples"),
        p.alias("n_positive"),
        ratio(F.col("_ap"), p).alias("auc_pr"),
        ratio(F.col("_u"), p.cast("double") * n).alias("auc_roc"),
        ratio(p, p + n).alias("baseline_ap"),
        ratio(ratio(F.col("_ap"), p), ratio(p, p + n)).alias("lift"),
    )


def best_threshold(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, threshold, f1) with the highest F1; equal ones go to the lowest threshold."""
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-8)
    best = F.min(F.struct((-f1).alias("score"), F.col("threshold"))).alias("best")
    return curve.groupBy(*by).agg(best).select(*by, F.col("best.threshold").alias("threshold"), (-F.col("best.score")).alias("best_f1"))


def evaluate(
    df: DataFrame, fit_split: str = "val", by: Sequence[str] = (), split: str = "split", label: str = "label",
    score: str = "score",
) -> DataFrame:
    """All metrics per (by, split) at the threshold that maximises F1 on ``fit_split``."""
    by, keys = list(by), [*by, split]
    curve = precision_recall_curve(df, keys, label, score)
    chosen = best_threshold(curve.where(F.col(split) == fit_split), by)
    if by:
        cut = join_same(df, chosen.select(*by, "threshold"), by)
        counts = confusion(cut, [*keys, "threshold"], label, score, F.col("threshold"))
    else:
        value = chosen.first()["threshold"]
        counts = confusion(df, keys, label, score, F.lit(value)).withColumn("threshold", F.lit(value))
    ranked = ranking_metrics(curve, keys)
    full = rates(counts)
    return join_same(full, ranked.select(*keys, "n_samples", "n_positive", "auc_pr", "auc_roc"), keys)


def decide(df: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    hit = F.col(score) >= threshold
    return df.withColumns({"prediction": hit.cast("int"), "decision": F.when(hit, "FAIL").otherwise("PASS")})


def mean_focal_loss(
    df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score", params: FocalParams = FocalParams()
) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(focal_loss(F.col(label), F.col(score), params)).alias("focal_loss"))


def mean_smoothed_focal_loss(
    df: DataFrame, by: Sequence[str], label: str = "label", logit: str = "logit", params: FocalParams = FocalParams()
) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(smoothed_focal_loss(F.col(label), F.col(logit), params)).alias("focal_loss"))
