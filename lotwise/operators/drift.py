"""Distribution drift between a reference window and any number of groups (days, testers, ...).

A reference is fitted once and is small: features x bins numbers. Checking every group is then a single
pass that counts bins with map-side combining; no measurement leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import edge_bin, join_same, long_form, normal_cdf, same_key, weighted_class, width_bin
from lotwise.operators.quantiles import quantile_table
from lotwise.operators.running import cut_into_ranges, running_totals
from lotwise.session import stored
from lotwise.spec import DriftThresholds

QUANTILE, WIDTH = "quantile", "width"
REFERENCE_SCHEMA = (
    "feature string, kind string, bins int, edges array<double>, proportions array<double>, mean double, "
    "std double, median double, q25 double, q75 double, n bigint, position int"
)


@dataclass(frozen=True)
class FeatureReference:
    feature: str
    kind: str
    bins: int
    edges: tuple[float, ...]
    proportions: tuple[float, ...]
    mean: float
    std: float
    median: float
    q25: float
    q75: float
    n: int


@dataclass(frozen=True)
class DriftReference:
    """Bin edges, bin shares and statistics of every reference feature."""

    features: tuple[FeatureReference, ...]
    rows: int

    @property
    def names(self) -> list[str]:
        return [f.feature for f in self.features]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (f.feature, f.kind, f.bins, list(f.edges), list(f.proportions), f.mean, f.std, f.median, f.q25, f.q75, f.n, i)
            for i, f in enumerate(self.features)
        ]
        return spark.createDataFrame(rows, REFERENCE_SCHEMA)

    @classmethod
    def from_frame(cls, df: DataFrame) -> DriftReference:
        rows = sorted(df.collect(), key=lambda r: r["position"])
        features = tuple(
            FeatureReference(
                r["feature"], r["kind"], r["bins"], tuple(r["edges"]), tuple(r["proportions"]),
                r["mean"], r["std"], r["median"], r["q25"], r["q75"], r["n"],
            )
            for r in rows
        )
        return cls(features, max((f.n for f in features), default=0))


def fit_reference(
    df: DataFrame, features: Sequence[str], kind: str = QUANTILE, bins: int | None = None,
    t: DriftThresholds = DriftThresholds(),
) -> DriftReference:
    """``quantile``: bins of equal share with open ends; ``width``: equal-width bins on [min, max]."""
    bins = bins or (t.quantile_bins if kind == QUANTILE else t.width_bins)
    inner = [i / bins for i in range(1, bins)]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, *(inner if kind == QUANTILE else [])]
    points = quantile_table(df, features, probs)
    edges = {}
    for f, q in points.items():
        if kind == QUANTILE:
            edges[f] = tuple(q[5:])
        else:
            low, high = (q[0], q[4]) if q[0] < q[4] else (q[0] - 0.5, q[0] + 0.5)
            edges[f] = tuple(low + i * (high - low) / bins for i in range(bins)) + (high,)
    present = [f for f in features if f in points]
    shares = {r["feature"]: r for r in _histogram(df, {f: edges[f] for f in present}, kind, bins, []).collect()}
    out = []
    for f in present:
        r = shares[f]
        total = max(sum(r["hist"]), 1)
        q = points[f]
        out.append(
            FeatureReference(
                f, kind, bins, edges[f], tuple(h / total for h in r["hist"]),
                r["mean"], r["std"], q[2], q[1], q[3], r["n"],
            )
        )
    return DriftReference(tuple(out), df.count())


def _histogram(df: DataFrame, edges: dict[str, Sequence[float]], kind: str, bins: int, by: Sequence[str]) -> DataFrame:
    """(by, feature, n, mean, std, hist): moments and bin counts of all features in one shuffle.

    The edges are one constant map looked up per row; spelling the comparisons out per feature would compile
    to code several times slower.
    """
    pairs = [x for f, e in edges.items() for x in (F.lit(f), constant_array(e))]
    long = long_form(df, list(edges), by).withColumn("e", F.element_at(F.create_map(*pairs), F.col("feature")))
    value, e = F.col("value"), F.col("e")
    if kind == QUANTILE:
        where = edge_bin(value, [e[i] for i in range(bins - 1)])
    else:
        where = width_bin(value, e[0], e[bins], bins)
    counted = (
        long.withColumn("bin", where)
        .groupBy(*by, "feature")
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            *[F.sum(F.when(F.col("bin") == i, 1).otherwise(0)).alias(f"h{i}") for i in range(bins)],
        )
    )
    return counted.select(*by, "feature", "n", "mean", "std", F.array(*[F.col(f"h{i}") for i in range(bins)]).alias("hist"))


def reference_lookup(ref: DriftReference, pick) -> Column:
    pairs = [x for f in ref.features for x in (F.lit(f.feature), pick(f))]
    return F.element_at(F.create_map(*pairs), F.col("feature"))


def constant_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def severity(psi: Column, t: DriftThresholds = DriftThresholds(), inclusive: bool = False) -> Column:
    """critical / warning / none; the boundary value itself counts only when ``inclusive``."""
    above = (lambda x: psi >= x) if inclusive else (lambda x: psi > x)
    return weighted_class((above(t.psi_critical), "critical"), (above(t.psi_warning), "warning"), otherwise="none")


def combined_status(psi: Column, kl: Column, t: DriftThresholds = DriftThresholds()) -> Column:
    """critical / warning / ok when either measure reaches its threshold."""
    return weighted_class(
        ((psi >= t.psi_critical) | (kl >= t.kl_critical), "critical"),
        ((psi >= t.psi_warning) | (kl >= t.kl_warning), "warning"),
        otherwise="ok",
    )


def psi_report(
    df: DataFrame, ref: DriftReference, by: Sequence[str], t: DriftThresholds = DriftThresholds(), inclusive: bool = False
) -> DataFrame:
    """(by, feature, n, psi, severity, ref_mean, ref_std, cur_mean, cur_std, mean_shift_pct) on quantile bins."""
    bins = ref.features[0].bins
    counted = _histogram(df, {f.feature: f.edges for f in ref.features}, QUANTILE, bins, by)
    eps = t.proportion_epsilon
    total = F.greatest(F.col("n"), F.lit(1))
    current = F.transform("hist", lambda c: c / total + eps)
    expected = reference_lookup(ref, lambda f: constant_array([p + eps for p in f.proportions]))
    ref_mean = reference_lookup(ref, lambda f: F.lit(f.mean))
    return counted.select(
        *by,
        "feature",
        "n",
        sum_of(F.zip_with(current, expected, lambda a, r: (a - r) * F.ln(a / r))).alias("psi"),
        ref_mean.alias("ref_mean"),
        reference_lookup(ref, lambda f: F.lit(f.std)).alias("ref_std"),
        F.col("mean").alias("cur_mean"),
        F.col("std").alias("cur_std"),
        mean_shift_pct(F.col("mean"), ref_mean).alias("mean_shift_pct"),
    ).withColumn("severity", severity(F.col("psi"), t, inclusive))


def divergence_report(
    df: DataFrame, ref: DriftReference, by: Sequence[str], t: DriftThresholds = DriftThresholds()
) -> DataFrame:
    """(by, feature, n, n_out_of_range, psi, kl, status, ...) on equal-width bins.

    Values outside the reference range are not binned but counted; a group with nothing in range is critical.
    """
    bins = ref.features[0].bins
    counted = _histogram(df, {f.feature: f.edges for f in ref.features}, WIDTH, bins, by)
    floor = F.lit(t.histogram_floor)
    expected = reference_lookup(ref, lambda f: constant_array([max(p, t.histogram_floor) for p in f.proportions]))
    inside = F.aggregate("hist", F.lit(0).cast("long"), lambda a, x: a + x)
    shaped = counted.withColumn("in_range", inside).withColumns(
        {
            "current": F.transform("hist", lambda c: F.greatest(c / F.greatest(F.col("in_range"), F.lit(1)), floor)),
            "expected": expected,
        }
    )
    current_sum, expected_sum = sum_of(F.col("current")), sum_of(F.col("expected"))
    ref_mean = reference_lookup(ref, lambda f: F.lit(f.mean))
    measured = shaped.withColumns({"cs": current_sum, "es": expected_sum}).select(
        *by,
        "feature",
        "n",
        (F.col("n") - F.col("in_range")).alias("n_out_of_range"),
        F.when(
            F.col("in_range") > 0,
            sum_of(F.zip_with("current", "expected", lambda a, r: (a - r) * F.ln(a / r))),
        ).alias("psi"),
        F.when(
            F.col("in_range") > 0,
            sum_of(
                F.zip_with(
                    "current", "expected",
                    lambda a, r: (a / F.col("cs")) * F.ln((a / F.col("cs")) / (r / F.col("es"))),
                )
            ),
        ).alias("kl"),
        F.col("mean").alias("cur_mean"),
        ref_mean.alias("ref_mean"),
        mean_shift_pct(F.col("mean"), ref_mean).alias("mean_shift_pct"),
    )
    status = F.when(F.col("psi").isNull(), "critical").otherwise(combined_status(F.col("psi"), F.col("kl"), t))
    return measured.withColumn("status", status)


def mean_shift_pct(current: Column, reference: Column) -> Column:
    return 100 * F.abs(current - reference) / (F.abs(reference) + 1e-10)


def drift_summary(
    report: DataFrame, by: Sequence[str], n_features: int, t: DriftThresholds = DriftThresholds(), level: str = "severity"
) -> DataFrame:
    """Per group: counts by severity, recommendation with its reason, features by falling PSI, top five, status.

    The lists hold one entry per feature, so their length is the width of the table. They are ordered by the
    published six digits, so that noise in the last bits cannot swap features.
    """
    counted = report.groupBy(*by).agg(
        F.count_if(F.col(level) == "critical").alias("features_critical"),
        F.count_if(F.col(level) == "warning").alias("features_warning"),
        F.avg("psi").alias("avg_psi"),
        F.sort_array(F.collect_list(F.struct(F.round("psi", 6).alias("shown"), "feature", "psi")), asc=False).alias("ranked"),
    )
    critical, warning = F.col("features_critical"), F.col("features_warning")
    enough = critical >= t.min_drifted_features
    names = F.transform("ranked", lambda r: r["feature"])
    return counted.select(
        *by,
        critical,
        warning,
        (F.lit(n_features) - critical - warning).alias("features_clean"),
        enough.alias("should_retrain"),
        F.when(
            enough,
            F.format_string(f"%d features with PSI > {t.psi_critical} (threshold: {t.min_drifted_features})", critical),
        )
        .otherwise(F.format_string(f"Only %d critical features (need {t.min_drifted_features})", critical))
        .alias("retrain_reason"),
        "avg_psi",
        names.alias("by_psi"),
        F.slice(names, 1, 5).alias("top_drifted"),
        F.map_from_entries(F.transform("ranked", lambda r: F.struct(r["feature"], r["psi"]))).alias("feature_psi"),
        weighted_class((enough, "critical"), (warning > 0, "warning"), otherwise="ok").alias("overall_status"),
        weighted_class((critical > 0, "critical"), (warning > 0, "warning"), otherwise="ok").alias("max_severity"),
    )


def drift_scan(
    df: DataFrame, ref: DriftReference, day: str = "day_number", first: int | None = None, last: int | None = None,
    t: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """One report row per day of a range. The day filter reaches the scan when the table is partitioned by day."""
    window = df
    if first is not None:
        window = window.where(F.col(day) >= first)
    if last is not None:
        window = window.where(F.col(day) <= last)
    rows = window.groupBy(day).agg(F.count("*").alias("analysis_rows"))
    report = psi_report(window, ref, [day], t)
    summary = drift_summary(report, [day], len(ref.features), t)
    return summary.join(rows, day).withColumn("reference_rows", F.lit(ref.rows))


def scan_summary(scan: DataFrame, day: str = "day_number") -> DataFrame:
    """One row: days scanned and the days that recommend retraining, in order."""
    return scan.agg(
        F.count("*").alias("total_days_scanned"),
        F.array_sort(F.collect_list(F.when(F.col("should_retrain"), F.col(day)))).alias("retrain_days"),
        F.count_if("should_retrain").alias("retrain_count"),
    )


def light_check(
    df: DataFrame, ref: DriftReference, day: str = "day_number", t: DriftThresholds = DriftThresholds()
) -> DataFrame:
    """Daily check with reliability tags: short sides never recommend, and a feature with few values counts as
    ``insufficient`` instead of drifted."""
    small = [f.feature for f in ref.features if f.n < t.min_feature_values]
    few = (F.col("n") < t.min_feature_values) | F.col("feature").isin(*small) if small else F.col("n") < t.min_feature_values
    report = psi_report(df, ref, [day], t).withColumn("severity", F.when(few, "insufficient").otherwise(F.col("severity")))
    days = df.groupBy(day).agg(F.count("*").alias("analysis_rows"))
    enough = report.groupBy(day).agg(F.count_if(F.col("severity") != "insufficient").alias("measured"))
    summary = drift_summary(report, [day], len(ref.features), t).join(enough, day)
    joined = days.join(summary, day, "left")
    smaller = F.least(F.col("analysis_rows"), F.lit(ref.rows))
    reliable = smaller >= t.min_reliable_rows
    critical = F.coalesce(F.col("features_critical"), F.lit(0))
    return joined.select(
        day,
        critical.alias("features_critical"),
        F.coalesce(F.col("features_warning"), F.lit(0)).alias("features_warning"),
        (F.lit(len(ref.features)) - F.coalesce("measured", F.lit(0))).alias("features_insufficient"),
        "feature_psi",
        ((critical >= t.min_drifted_features) & reliable).alias("should_retrain"),
        reliable.alias("drift_reliable"),
        F.when(~reliable, F.format_string("Only %d rows: drift is tagged, not acted on", smaller)).alias("low_data_warning"),
        F.lit(ref.rows).alias("ref_rows"),
        "analysis_rows",
    )


def prediction_drift(
    df: DataFrame, by: Sequence[str], prediction: str = "prediction", t: DriftThresholds = DriftThresholds()
) -> DataFrame:
    """Relative change of the predicted fail rate against its published level."""
    rate = df.groupBy(*by).agg(F.avg(prediction).alias("current_fail_rate"))
    change = F.abs(F.col("current_fail_rate") - t.reference_fail_rate) / (t.reference_fail_rate + 1e-10)
    return rate.select(
        *by,
        F.lit(t.reference_fail_rate).alias("reference_fail_rate"),
        "current_fail_rate",
        (change * 100).alias("relative_change_pct"),
        F.when(change > t.fail_rate_tolerance, "critical").otherwise("ok").alias("status"),
        (change > t.fail_rate_tolerance).alias("should_investigate"),
    )


def psi_matrix(report: DataFrame, days: Sequence[int], day: str = "day_number") -> DataFrame:
    """Features by days, absent cells 0. The day list is given so that the pivot needs no extra job."""
    cells = [
        F.coalesce(F.max(F.when(F.col(day) == d, F.col("psi"))), F.lit(0.0)).alias(f"day_{d:02d}") for d in days
    ]
    return report.groupBy("feature").agg(*cells)


def average_psi(report: DataFrame, day: str = "day_number", t: DriftThresholds = DriftThresholds()) -> DataFrame:
    return (
        report.groupBy(day)
        .agg(F.avg("psi").alias("avg_psi"))
        .withColumn("severity", severity(F.col("avg_psi"), t))
    )


def kolmogorov_p_value(d: Column, n_reference: Column, n_current: Column, terms: int = 100) -> Column:
    """Limiting two-sided p-value."""
    return kolmogorov_tail(F.sqrt(n_reference.cast("double") * n_current / (n_reference + n_current)) * d, terms)


def kolmogorov_tail(x: Column, terms: int = 100) -> Column:
    """Share of the limiting distribution above x."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda a, k: a + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))


def ks_two_sample(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n_reference, n_current, ks_statistic, ks_pvalue) from the two empirical distributions.

    Both sides are counted per distinct value first; the running counts are range-partitioned.
    """
    sides = long_form(reference, features).withColumn("is_ref", F.lit(1)).unionByName(
        long_form(current, features).withColumn("is_ref", F.lit(0))
    )
    counted = sides.groupBy("feature", "value").agg(
        F.sum("is_ref").alias("ref"), F.sum(1 - F.col("is_ref")).alias("cur")
    )
    running = running_totals(counted, "value", {"ref_below": "ref", "cur_below": "cur"}, ["feature"])
    totals = counted.groupBy("feature").agg(F.sum("ref").alias("n_reference"), F.sum("cur").alias("n_current"))
    joined = running.join(totals, same_key(running, totals, ["feature"])).drop(totals["feature"])
    gap = F.abs(F.col("ref_below") / F.col("n_reference") - F.col("cur_below") / F.col("n_current"))
    out = joined.groupBy("feature", "n_reference", "n_current").agg(F.max(gap).alias("ks_statistic"))
    return out.withColumn(
        "ks_pvalue", kolmogorov_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current"))
    )


def ks_by_group(reference: DataFrame, current: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, feature, n_reference, n_current, ks_statistic, ks_pvalue): every group of ``current`` against the same reference.

    Both sides are counted per distinct value, which reads them once, and the counts are written down. One pass over value ranges
    then ranks all groups and the reference: each range begins with a row for every group that holds what lies before it.
    Between two values of a group its own distribution stands still, so the largest gap is at one of its values or just before
    it, and the reference need not be repeated for each group.
    """
    by, keys = list(by), [*by, "feature"]
    known = long_form(reference, features).groupBy("feature", "value").agg(F.count("*").alias("ref"))
    own = long_form(current, features, by).groupBy(*keys, "value").agg(F.count("*").alias("cur"))
    none = F.lit(None)
    sides = own.select(F.lit(True).alias("mine"), *keys, "value", F.lit(0).cast("long").alias("ref"), "cur").unionByName(
        known.select(F.lit(False).alias("mine"), *[none.cast(own.schema[c].dataType).alias(c) for c in by], "feature", "value", "ref", F.lit(0).cast("long").alias("cur")))
    counted = cut_into_ranges(stored(sides, "ks"), "value")
    rows = counted.withColumn("n", none.cast("long"))
    for mine, group, count in ((False, ["feature"], "ref"), (True, keys, "cur")):
        totals = (counted.where("mine") if mine else counted).groupBy(*group, "_range").agg(F.sum(count).alias("total"))
        so_far = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        told = {"mine": F.lit(mine), count: F.coalesce(F.sum("total").over(so_far), F.lit(0)), "n": F.sum("total").over(Window.partitionBy(*group))}
        rows = rows.unionByName(totals.select(*group, "_range", *[c.alias(k) for k, c in told.items()], *[
            (F.lit(0) if c in ("ref", "cur") else none).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in {*group, "_range", *told}]))
    here, group = Window.partitionBy("feature", "_range"), Window.partitionBy("feature", "_range", "mine", *by)
    upto = Window.unboundedPreceding, Window.currentRow
    ranked = rows.select(
        "*", F.sum("ref").over(here.orderBy("value").rangeBetween(*upto)).alias("ref_upto"), F.max(F.when(~F.col("mine"), F.col("n"))).over(here).alias("n_reference"),
        F.sum("ref").over(Window.partitionBy("feature", "_range", "value")).alias("ref_here"),
        F.sum("cur").over(group.orderBy("value").rowsBetween(*upto)).alias("cur_upto"), F.max("n").over(group).alias("n_current"),
    ).where("mine AND value IS NOT NULL AND n_reference > 0")
    r, c = F.col("ref_upto") / F.col("n_reference"), F.col("cur_upto") / F.col("n_current")
    before = (F.col("ref_upto") - F.col("ref_here")) / F.col("n_reference") - (F.col("cur_upto") - F.col("cur")) / F.col("n_current")
    out = ranked.groupBy(*keys, "n_reference", "n_current").agg(F.max(F.greatest(F.abs(r - c), F.abs(before))).alias("ks_statistic"))
    return out.withColumn("ks_pvalue", kolmogorov_p_value(F.col("ks_statistic"), F.col("n_reference"), F.col("n_current")))


def ks_normal(df: DataFrame, ref: DriftReference, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, n, ks_statistic, ks_pvalue): every group and reference feature against the normal curve of the stored
    mean and deviation.

    Values are counted per group first; running counts of all groups and features come from one ranged pass. Between two
    values a group's own distribution stands still, so the largest gap is at a value or just before it. The p-value is the
    limiting one with Stephens' correction for short samples.
    """
    keys = [*by, "feature"]
    counted = long_form(df, ref.names, by).groupBy(*keys, "value").agg(F.count("*").alias("rows"))
    running = running_totals(counted.withColumn("here", F.col("rows")), "value", {"upto": "rows"}, keys)
    n = counted.groupBy(*keys).agg(F.sum("rows").alias("n"))
    joined = join_same(running, n, keys)
    mean, std = reference_lookup(ref, lambda f: F.lit(f.mean)), reference_lookup(ref, lambda f: F.lit(max(f.std, 1e-6)))
    curve = normal_cdf((F.col("value") - mean) / std)
    above, below = F.col("upto") / F.col("n") - curve, curve - (F.col("upto") - F.col("here")) / F.col("n")
    out = joined.groupBy(*keys, "n").agg(F.max(F.greatest(above, below)).alias("ks_statistic"))
    return out.withColumn("ks_pvalue", kolmogorov_tail((F.sqrt("n") + 0.12 + 0.11 / F.sqrt("n")) * F.col("ks_statistic")))
