"""Profiles and group summaries. Every report is one or two aggregations whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import join_same, long_form, ratio, right_closed_bin, same_key, struct_rows, width_bin
from lotwise.operators.quantiles import approx_quantiles, exact_quantiles
from lotwise.spec import BusinessCosts

GROUPS_IN_PLAN = 2_000


def daily_fail_rate(df: DataFrame, day: str = "day_number", label: str = "is_fail") -> DataFrame:
    return (
        df.groupBy(day)
        .agg(F.count("*").alias("total"), F.sum(label).alias("n_fail"), F.avg(label).alias("fail_rate"))
        .orderBy(day)
    )


def daily_measures(
    df: DataFrame, measures: Sequence[str], day: str = "day_number", label: str = "is_fail"
) -> DataFrame:
    return (
        df.groupBy(day)
        .agg(
            F.count("*").alias("total"),
            F.sum(label).alias("n_fail"),
            *[F.avg(m).alias(f"avg_{m}") for m in measures],
        )
        .orderBy(day)
    )


def null_audit(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """(feature, n_missing, missing_pct), one aggregation over all columns."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("n_missing"),
            ratio(F.col(c) * 100.0, F.col("_n")).alias("missing_pct"),
        )
        for c in columns
    ]
    out = struct_rows(wide, [], rows)
    return out.where(F.col("n_missing") > 0) if only_missing else out


def quality_summary(df: DataFrame, means: Sequence[str], spread: Sequence[str], label: str = "is_fail") -> DataFrame:
    """One row: size, fail rate, means, sample deviations and number of columns with gaps."""
    gaps = sum((F.max(F.col(c).isNull().cast("int")) for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("total_rows"),
        F.coalesce(F.avg(label), F.lit(0.0)).alias("fail_rate"),
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in means],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in spread],
        gaps.alias("null_columns"),
    )


def feature_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, n, n_missing, mean, std_samp, std_pop, min, max, skew): one pass, no row expansion."""
    def value(c):
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    packed = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(value(c)).alias("n"),
            (F.count("*") - F.count(value(c))).alias("n_missing"),
            F.avg(value(c)).alias("mean"),
            F.stddev_samp(value(c)).alias("std_samp"),
            F.stddev_pop(value(c)).alias("std_pop"),
            F.min(value(c)).alias("min"),
            F.max(value(c)).alias("max"),
            F.skewness(value(c)).alias("_skew_pop"),
        ).alias(f"f{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.groupBy(*by).agg(*packed)
    n = F.col("n").cast("double")
    corrected = F.when(n > 2, F.col("_skew_pop") * F.sqrt(n * (n - 1)) / (n - 2))
    return (
        struct_rows(wide, by, [F.col(f"f{i}") for i in range(len(columns))])
        .withColumn("skew", corrected)
        .drop("_skew_pop")
    )


def daily_feature_stats(
    df: DataFrame, columns: Sequence[str], day: str = "day_number", method: str = "exact"
) -> DataFrame:
    """(day, feature, mean, stddev, p25, p50, p75, min_val, max_val)."""
    moments = feature_moments(df, columns, [day])
    probs = [0.25, 0.5, 0.75]
    if method == "exact":
        q = exact_quantiles(df, columns, probs, [day])
    else:
        q = approx_quantiles(df, columns, probs, [day])
    return moments.join(q, same_key(moments, q, [day, "feature"])).select(
        moments[day].alias("day_number"),
        moments["feature"],
        "mean",
        F.col("std_samp").alias("stddev"),
        *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
        F.col("min").alias("min_val"),
        F.col("max").alias("max_val"),
    )


def split_profile(
    df: DataFrame,
    split: str = "split",
    label: str = "is_fail",
    noisy: str | None = "label_is_noisy",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows, columns by type, fails, noisy labels and missing cells of each split."""
    columns = list(columns or [c for c in df.columns if c != split])
    types = dict(df.dtypes)
    numbers = sum(types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") for c in columns)
    cells = sum((F.sum(F.col(c).isNull().cast("long")) for c in columns), F.lit(0).cast("long"))
    out = df.groupBy(split).agg(
        F.count("*").alias("n_rows"),
        F.sum(label).alias("n_fail"),
        F.avg(label).alias("fail_rate"),
        (F.sum(F.col(noisy).cast("long")) if noisy else F.lit(0).cast("long")).alias("n_noisy"),
        cells.alias("missing_cells"),
    )
    return out.select(
        split,
        "n_rows",
        F.lit(len(columns)).alias("n_columns"),
        F.lit(numbers).alias("n_numeric"),
        F.lit(len(columns) - numbers).alias("n_other"),
        "n_fail",
        "fail_rate",
        "n_noisy",
        "missing_cells",
        ratio(F.col("missing_cells") * 100.0, F.col("n_rows") * len(columns)).alias("missing_pct"),
    )


def split_feature_profile(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    m = feature_moments(df, columns, [split])
    return m.select(
        split,
        "feature",
        "mean",
        F.col("std_samp").alias("std"),
        "min",
        "max",
        "skew",
        ratio(F.col("n_missing") * 100.0, F.col("n") + F.col("n_missing")).alias("missing_pct"),
    )


def pair_correlation(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.corr(a, b).alias("correlation"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, correlation) for every ordered pair, from one aggregation over the upper half."""
    pairs = list(combinations(range(len(columns)), 2))
    wide = df.agg(*[F.corr(columns[i], columns[j]).alias(f"r_{i}_{j}") for i, j in pairs])

    def row(i, j, r):
        return F.struct(F.lit(columns[i]).alias("feature_a"), F.lit(columns[j]).alias("feature_b"), r.alias("correlation"))

    rows = [row(i, i, F.lit(1.0)) for i in range(len(columns))]
    for i, j in pairs:
        rows += [row(i, j, F.col(f"r_{i}_{j}")), row(j, i, F.col(f"r_{i}_{j}"))]
    return struct_rows(wide, [], rows)


def edge_centre_ratio(
    df: DataFrame,
    distance: str = "edge_distance",
    label: str = "is_fail",
    edge: float = 0.7,
    centre: float = 0.3,
    floor: float = 1e-6,
    by: Sequence[str] = (),
) -> DataFrame:
    y = F.when(F.col(distance).isNotNull() & F.col(label).isNotNull(), F.col(label).cast("double"))
    rates = df.groupBy(*by).agg(
        F.avg(F.when(F.col(distance) > edge, y)).alias("edge_fail_rate"),
        F.avg(F.when(F.col(distance) < centre, y)).alias("centre_fail_rate"),
    )
    return rates.withColumn("edge_ratio", F.col("edge_fail_rate") / F.greatest(F.col("centre_fail_rate"), F.lit(floor)))


def cause_counts(df: DataFrame, cause: str = "root_cause", label: str = "is_fail") -> DataFrame:
    return (
        df.where(F.col(label) == 1)
        .groupBy(cause)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), cause)
    )


def class_balance(df: DataFrame, label: str = "is_fail") -> DataFrame:
    row = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == 0).alias("n_pass"),
        F.count_if(F.col(label) == 1).alias("n_fail"),
    )
    return row.select(
        "*",
        ratio(F.col("n_pass") * 100.0, F.col("total")).alias("pass_pct"),
        ratio(F.col("n_fail") * 100.0, F.col("total")).alias("fail_pct"),
        F.floor(F.col("n_pass") / F.greatest(F.col("n_fail"), F.lit(1))).alias("imbalance_ratio"),
    )


def label_noise(df: DataFrame, observed: str = "is_fail", true: str = "is_fail_true") -> DataFrame:
    """Two-by-two grid of observed and true labels with the kind of disagreement."""
    kind = (
        F.when((F.col(observed) == 1) & (F.col(true) == 0), "flipped_to_fail")
        .when((F.col(observed) == 0) & (F.col(true) == 1), "flipped_to_pass")
        .when(F.col(true) == 1, "true_fail")
        .otherwise("true_pass")
    )
    return df.groupBy(observed, true).agg(F.count("*").alias("n")).withColumn("kind", kind)


def missing_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_audit(df, columns).select("feature", "missing_pct").orderBy("missing_pct", "feature")


def missing_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pattern, n): a 0/1 text per row, one digit per column, counted over all rows."""
    pattern = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"))


def co_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, n) rows missing both, built from the pattern counts."""
    patterns = missing_patterns(df, columns)
    wide = patterns.agg(
        *[
            F.sum(
                F.when(
                    (F.substring("pattern", i + 1, 1) == "1") & (F.substring("pattern", j + 1, 1) == "1"), F.col("n")
                ).otherwise(0)
            ).alias(f"n_{i}_{j}")
            for i, j in combinations(range(len(columns)), 2)
        ]
    )
    rows = [
        F.struct(F.lit(columns[i]).alias("feature_a"), F.lit(columns[j]).alias("feature_b"), F.col(f"n_{i}_{j}").alias("n"))
        for i, j in combinations(range(len(columns)), 2)
    ]
    return struct_rows(wide, [], rows)


def wafer_map(
    df: DataFrame,
    x: str = "die_x",
    y: str = "die_y",
    label: str = "is_fail",
    min_count: int = 3,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Fail rate per die position with at least ``min_count`` rows; ``extra`` adds further aggregates."""
    return (
        df.groupBy(x, y)
        .agg(
            F.avg(label).alias("fail_rate"),
            F.count(label).alias("n"),
            *[e.alias(n) for n, e in (extra or {}).items()],
        )
        .where(F.col("n") >= min_count)
    )


def fail_rate_by_distance(
    df: DataFrame, distance: str = "edge_distance", label: str = "is_fail", bins: int = 20, min_count: int = 20
) -> DataFrame:
    """Fail rate in right-closed distance bins on (0, 1]."""
    index = right_closed_bin(F.col(distance), 0.0, 1.0, bins)
    return (
        df.where(F.col(label).isNotNull())
        .select(index.alias("bin"), F.col(label))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.avg(label).alias("fail_rate"), F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
        .withColumn("bin_mid", (F.col("bin") - 0.5) / bins)
    )


def wafer_map_quantile(grid: DataFrame, q: float = 0.95, column: str = "fail_rate") -> DataFrame:
    """Quantile over an aggregated grid."""
    return exact_quantiles(grid, [column], [q]).select(F.col("q")[0].alias("fail_rate_quantile"))


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max per column with exact quartiles."""
    m = feature_moments(df, columns, by)
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by)
    keys = [*by, "feature"]
    return m.join(q, same_key(m, q, keys)).select(
        *[m[k] for k in keys],
        m["n"].alias("count"),
        "mean",
        F.col("std_samp").alias("std"),
        "min",
        *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
        "max",
    )


def class_medians(df: DataFrame, columns: Sequence[str], label: str = "is_fail") -> DataFrame:
    return exact_quantiles(df, columns, [0.5], [label]).select(label, "feature", F.col("q")[0].alias("median"))


def wafer_anomaly_correlation(
    df: DataFrame, score: str, x: str = "die_x", y: str = "die_y", label: str = "is_fail", min_count: int = 3
) -> DataFrame:
    """Correlation over die positions of mean score and fail rate."""
    grid = wafer_map(df, x, y, label, min_count, {"mean_anomaly": F.avg(score)})
    return grid.agg(F.count("*").alias("n_positions"), F.corr("mean_anomaly", "fail_rate").alias("correlation"))


def prediction_summary(df: DataFrame, batch: Sequence[str], decision: str = "prediction") -> DataFrame:
    return df.groupBy(*batch).agg(
        F.count("*").alias("n_total"), F.sum(decision).alias("n_fail"), F.avg(decision).alias("fail_rate")
    )


def latency_summary(
    df: DataFrame, by: Sequence[str], latency: str, ok: Column, duration_s: float = 1.0
) -> DataFrame:
    """Requests, errors and latency percentiles of successful requests, by concurrency or endpoint."""
    marked = df.select(*by, ok.alias("_ok"), F.when(ok, F.col(latency)).alias("latency"))
    counts = marked.groupBy(*by).agg(
        F.count("*").alias("total_requests"),
        F.count_if(~F.col("_ok")).alias("errors"),
        F.avg("latency").alias("latency_mean"),
    )
    q = exact_quantiles(marked, ["latency"], [0.5, 0.95, 0.99], by)
    good = F.col("total_requests") - F.col("errors")
    return counts.join(q, same_key(counts, q, by), "left").select(
        *[counts[k] for k in by],
        "total_requests",
        "errors",
        ratio(F.col("errors") * 100.0, F.col("total_requests")).alias("error_rate_pct"),
        (good / F.lit(float(duration_s))).alias("throughput"),
        *[F.col("q")[i].alias(n) for i, n in enumerate(("latency_p50", "latency_p95", "latency_p99"))],
        "latency_mean",
    )


def run_kpis(days: DataFrame) -> DataFrame:
    """Totals of a run from its day rows (n_rows, bytes, elapsed_sec, retrain, features_critical)."""
    return days.agg(
        F.count("*").alias("n_days"),
        F.sum("n_rows").alias("total_rows"),
        (F.sum("bytes") / 1e9).alias("total_gb"),
        F.sum(F.col("retrain").cast("long")).alias("retrains"),
        F.count_if(F.col("features_critical") >= 3).alias("critical_days"),
        (F.sum("elapsed_sec") / 60.0).alias("wall_minutes"),
    )


def business_impact(metrics: DataFrame, formula: str = "recall", costs: BusinessCosts = BusinessCosts()) -> DataFrame:
    """Yearly value of a detector. ``recall``: saved wafers; ``caught``: caught fails per month at the price of
    a missed one; ``cost``: expected cost of missed and false alarms. The three disagree by design."""
    c = costs
    if formula == "recall":
        value = F.col("recall") * c.wafers_per_month * c.cost_per_wafer_usd * c.defect_rate * c.months
    elif formula == "caught":
        value = F.col("caught_per_month") * c.cost_per_false_negative_usd * c.months
    else:
        value = -(F.col("fn") * c.cost_per_false_negative_usd + F.col("fp") * c.cost_per_false_positive_usd)
    return metrics.withColumn("annual_value_usd", value)


def stage_rates(stages: DataFrame) -> DataFrame:
    """Share of time and rows per second of each stage (stage, n_rows, seconds)."""
    whole = Window.partitionBy(F.lit(0))
    return stages.select(
        "*",
        ratio(F.col("n_rows").cast("double"), F.col("seconds")).alias("rows_per_sec"),
        ratio(F.col("seconds"), F.sum("seconds").over(whole)).alias("time_share"),
    )


def density_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bins: int = 50) -> DataFrame:
    """(by, feature, bin, low, high, n, density) on the value range of each group; the densities integrate to one.

    The ranges of up to GROUPS_IN_PLAN groups become literals, so rows are binned where they are and only counts travel;
    more groups are joined with their ranges.
    """
    by, keys = list(by), [*by, "feature"]
    span = feature_moments(df, columns, by).select(*by, "feature", F.col("min").alias("lo"), F.col("max").alias("hi"), F.col("n").alias("total"))
    flat = F.col("lo") == F.col("hi")
    span = span.withColumns({"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})
    group = F.concat_ws("|", F.lit(""), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in by])
    few = span.withColumn("_group", group).limit(GROUPS_IN_PLAN + 1).collect()
    if len(few) <= GROUPS_IN_PLAN:
        binned = {}
        for c in columns:
            pairs = [x for r in few if r["feature"] == c and r["lo"] is not None for x in (F.lit(r["_group"]), F.struct(F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi")))]
            if pairs:
                range_ = F.element_at(F.create_map(*pairs), F.col("_group"))
                binned[c] = width_bin(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), range_["lo"], range_["hi"], bins)
        if not binned:
            return span.select(*keys, *[F.lit(None).cast(t).alias(n) for n, t in (("bin", "int"), ("low", "double"), ("high", "double"), ("n", "long"), ("density", "double"))]).limit(0)
        wide = df.withColumn("_group", group).select(*by, *[b.alias(c) for c, b in binned.items()])
        found = wide.unpivot(by, list(binned), "feature", "bin").where(F.col("bin").isNotNull())
        joined = join_same(found.groupBy(*keys, "bin").agg(F.count("*").alias("n")), span, keys)
    else:
        values = long_form(df, columns, by)
        ranged = values.join(span, same_key(values, span, keys)).select(
            *[values[k] for k in keys], "lo", "hi", "total",
            width_bin(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"),
        )
        joined = ranged.groupBy(*keys, "lo", "hi", "total", "bin").agg(F.count("*").alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    return joined.select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        "n",
        (F.col("n") / (F.col("total") * width)).alias("density"),
    )
