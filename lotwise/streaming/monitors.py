"""Windowed service metrics. Each takes a batch or a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.columns import edge_bin, long_form
from lotwise.operators.drift import DriftReference, constant_array, reference_lookup, sum_of, severity
from lotwise.spec import DriftThresholds

# Latency histogram bounds in seconds.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)


def _window(df: DataFrame, ts: str, size: str, slide: str | None, late: str | None) -> tuple[DataFrame, Column]:
    """A bounded drain passes ``late=None``: without a watermark no row is late, and the state ends with the run."""
    marked = df.withWatermark(ts, late) if df.isStreaming and late else df
    return marked, (F.window(ts, size, slide) if slide else F.window(ts, size))


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def request_rate(
    df: DataFrame, by: Sequence[str], ts: str = "ts", size: str = "5 minutes", slide: str | None = None,
    late: str | None = "10 minutes", seconds: float = 300.0,
) -> DataFrame:
    """Requests per second of each group and window."""
    marked, w = _window(df, ts, size, slide, late)
    return _flat(marked.groupBy(w, *by).agg(F.count("*").alias("requests"), (F.count("*") / F.lit(seconds)).alias("rate")))


def latency_quantiles(
    df: DataFrame, latency: str, by: Sequence[str] = (), ts: str = "ts", size: str = "5 minutes", slide: str | None = None,
    late: str | None = "10 minutes", accuracy: int = 1000,
) -> DataFrame:
    """p50, p95, p99 from mergeable sketches."""
    marked, w = _window(df, ts, size, slide, late)
    out = marked.groupBy(w, *by).agg(F.count("*").alias("requests"), F.percentile_approx(latency, [0.5, 0.95, 0.99], accuracy).alias("q"))
    return _flat(out.select("window", *by, "requests", *[F.col("q")[i].alias(n) for i, n in enumerate(("p50", "p95", "p99"))]))


def latency_buckets(
    df: DataFrame, latency: str, by: Sequence[str] = (), ts: str = "ts", size: str = "5 minutes",
    bounds: Sequence[float] = LATENCY_BOUNDS, late: str | None = "10 minutes",
) -> DataFrame:
    """Cumulative bucket counts ``le_<i>`` and the total of each window, as a metrics endpoint exposes them."""
    marked, w = _window(df, ts, size, None, late)
    counts = [F.count_if(F.col(latency) <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    return _flat(marked.groupBy(w, *by).agg(F.count("*").alias("requests"), *counts))


def bucket_quantile(buckets: DataFrame, q: float, bounds: Sequence[float] = LATENCY_BOUNDS, name: str = "quantile") -> DataFrame:
    """Quantile interpolated within its bucket; beyond the last bound it is that bound."""
    rank = F.col("requests") * q
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = F.lit(float(bounds[i - 1])) if i else F.lit(0.0)
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - below
        value = low + (F.lit(float(bounds[i])) - low) * F.when(inside > 0, (rank - below) / inside).otherwise(F.lit(0.0))
        out = F.when(F.col(f"le_{i}") >= rank, value).otherwise(out)
    return buckets.withColumn(name, out)


def fail_share(
    df: DataFrame, failed: Column, by: Sequence[str] = (), ts: str = "ts", size: str = "5 minutes", slide: str | None = None,
    late: str | None = "10 minutes", seconds: float = 300.0,
) -> DataFrame:
    """Share of failed predictions, and PASS and FAIL rates, per window."""
    marked, w = _window(df, ts, size, slide, late)
    return _flat(
        marked.groupBy(w, *by).agg(
            F.count("*").alias("n_total"),
            F.avg(failed.cast("double")).alias("fail_share"),
            (F.count_if(failed) / F.lit(seconds)).alias("fail_rate"),
            (F.count_if(~failed) / F.lit(seconds)).alias("pass_rate"),
        )
    )


def mean_batch_size(df: DataFrame, size_column: str, ts: str = "ts", size: str = "5 minutes", late: str | None = "10 minutes") -> DataFrame:
    marked, w = _window(df, ts, size, None, late)
    return _flat(marked.groupBy(w).agg(F.count("*").alias("batches"), F.avg(size_column).alias("mean_batch_size")))


def bin_counts(df: DataFrame, ref: DriftReference, by: Sequence[str]) -> DataFrame:
    """(by, feature, bin, n): the only state the drift monitor keeps."""
    pairs = [x for f in ref.features for x in (F.lit(f.feature), constant_array(f.edges))]
    bins = ref.features[0].bins
    long = long_form(df, ref.names, by).withColumn("e", F.element_at(F.create_map(*pairs), F.col("feature")))
    binned = long.withColumn("bin", edge_bin(F.col("value"), [F.col("e")[i] for i in range(bins - 1)]))
    return binned.groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def psi_from_counts(
    counts: DataFrame, ref: DriftReference, by: Sequence[str], t: DriftThresholds = DriftThresholds()
) -> DataFrame:
    """(by, feature, n, psi, severity) from accumulated bin counts."""
    bins, eps = ref.features[0].bins, t.proportion_epsilon
    wide = counts.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"h{i}") for i in range(bins)]
    )
    current = F.transform(F.array(*[F.col(f"h{i}") for i in range(bins)]), lambda c: c / F.col("n") + eps)
    expected = reference_lookup(ref, lambda f: constant_array([p + eps for p in f.proportions]))
    psi = sum_of(F.zip_with(current, expected, lambda a, r: (a - r) * F.ln(a / r)))
    return wide.select(*by, "feature", "n", psi.alias("psi")).withColumn("severity", severity(F.col("psi"), t))
