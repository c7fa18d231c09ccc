"""Derived columns, encoding, scaling, weights and rule-based scores."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.functions.columns import clip, ratio, struct_rows
from lotwise.operators.quantiles import quantile_table
from lotwise.session import cut_lineage

CODES_IN_PLAN = 10_000


# --- engineered columns ------------------------------------------------------------------------

# Names, inputs and formulas of both feature sets must equal the published ones.
def _recipes_log_scale(c) -> dict[str, tuple[tuple[str, ...], Column]]:
    tiny = 1e-8
    return {
        "retention_temp_interaction": (("retention_time_ms", "test_temp_c"), c("retention_time_ms") * c("test_temp_c")),
        "leakage_retention_ratio": (
            ("cell_leakage_fa", "retention_time_ms"), c("cell_leakage_fa") / (c("retention_time_ms") + tiny),
        ),
        "edge_risk": (("edge_distance",), c("edge_distance") * c("edge_distance")),
        "power_ratio": (("idd4_active_ma", "idd2p_standby_ma"), c("idd4_active_ma") / (c("idd2p_standby_ma") + tiny)),
        "ecc_burden": (
            ("bit_error_rate", "ecc_syndrome_entropy", "uncorrectable_in_extended"),
            c("bit_error_rate") + c("ecc_syndrome_entropy") + c("uncorrectable_in_extended"),
        ),
        "timing_margin": (("trcd_ns", "trp_ns", "tras_ns"), c("trcd_ns") + c("trp_ns") - c("tras_ns")),
        "rh_risk_composite": (
            ("rh_susceptibility", "adjacent_row_activations"),
            c("rh_susceptibility") * F.log1p(c("adjacent_row_activations")),
        ),
    }


def _recipes_raw_scale(c) -> dict[str, tuple[tuple[str, ...], Column]]:
    floor, spec_ns, margin_mv = 0.001, 18.0, 250.0
    return {
        "retention_temp_interaction": (("retention_time_ms", "test_temp_c"), c("retention_time_ms") * c("test_temp_c")),
        "leakage_retention_ratio": (
            ("cell_leakage_fa", "retention_time_ms"), c("cell_leakage_fa") / clip(c("retention_time_ms"), floor),
        ),
        "edge_risk": (("edge_distance", "cell_leakage_fa"), c("edge_distance") * c("cell_leakage_fa")),
        "power_ratio": (
            ("idd4_active_ma", "idd2p_standby_ma"), c("idd4_active_ma") / clip(c("idd2p_standby_ma"), floor),
        ),
        "ecc_burden": (
            ("correctable_errors_per_1m", "ecc_syndrome_entropy"),
            c("correctable_errors_per_1m") * c("ecc_syndrome_entropy"),
        ),
        "timing_margin": (("trcd_ns", "trp_ns"), (spec_ns - c("trcd_ns")) + (spec_ns - c("trp_ns"))),
        "rh_risk_composite": (
            ("rh_susceptibility", "disturb_margin_mv"),
            c("rh_susceptibility") * (margin_mv - c("disturb_margin_mv")) / margin_mv,
        ),
    }


_RECIPES = {"log": _recipes_log_scale, "raw": _recipes_raw_scale}


def engineer(df: DataFrame, scale: str = "log") -> DataFrame:
    """Seven physics features. ``log``: for log-scaled input; ``raw``: for measurement units.

    The two sets share names but not formulas. A feature is skipped when one of its inputs is absent.
    """
    double = lambda name: F.col(name).cast("double")
    present = set(df.columns)
    recipes = _RECIPES[scale](double)
    return df.withColumns({name: e for name, (needs, e) in recipes.items() if present.issuperset(needs)})


# --- encoding and scaling ----------------------------------------------------------------------

def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): 0-based codes in text order, one row per distinct value."""
    distinct = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.lit(1).alias("_seen"))
    )
    w = Window.partitionBy("feature").orderBy("value")
    return distinct.select("feature", "value", (F.row_number().over(w) - 1).cast("int").alias("code"))


def small_or_stored(codes: DataFrame) -> tuple[DataFrame, bool]:
    """Dictionaries of a few values become part of the plan; larger ones are materialised once. Tells which."""
    head = codes.limit(CODES_IN_PLAN + 1).collect()
    if len(head) <= CODES_IN_PLAN:
        return codes.sparkSession.createDataFrame(head, codes.schema), True
    return cut_lineage(codes), False


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str], unseen: int = -1) -> DataFrame:
    """Replace each category by its code, ``unseen`` for values the dictionary lacks.

    A left join per column. Dictionaries of up to ``CODES_IN_PLAN`` rows are broadcast: a few values would meet in as few
    tasks. Larger ones are joined as they are.
    """
    out = df
    codes, small = small_or_stored(codes)
    for c in columns:
        lookup = codes.where(F.col("feature") == c).select(
            F.col("value").alias(f"_{c}_value"), F.col("code").alias(f"_{c}_code")
        )
        lookup = F.broadcast(lookup) if small else lookup
        out = out.join(lookup, F.col(c).cast("string") == F.col(f"_{c}_value"), "left")
    names = [
        F.coalesce(F.col(f"_{c}_code"), F.lit(unseen)).alias(c) if c in columns else F.col(c) for c in df.columns
    ]
    return out.select(*names)


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column in one aggregation."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def standardize(df: DataFrame, moments: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a constant column becomes zero."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in moments.items() if c in df.columns}
    )


def vectors(df: DataFrame, tabular: Sequence[str], spatial: Sequence[str]) -> DataFrame:
    """Two array columns, ``tabular`` and ``spatial``; position i is the i-th name, kept in column metadata."""
    def pack(names):
        return F.array(*[F.col(c).cast("double") for c in names])

    return df.select(
        "*",
        pack(tabular).alias("tabular", metadata={"names": list(tabular)}),
        pack(spatial).alias("spatial", metadata={"names": list(spatial)}),
    )


# --- weights -----------------------------------------------------------------------------------

def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, inverse_weight, balanced_weight, positive_scale) for each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy(F.lit(0))
    negatives = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(whole)
    positives = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(whole)
    return counts.select(
        label,
        "n",
        (1.0 / F.col("n")).alias("inverse_weight"),
        (F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))).alias("balanced_weight"),
        (F.coalesce(negatives, F.lit(0)) / F.greatest(F.coalesce(positives, F.lit(0)), F.lit(1))).alias("positive_scale"),
    )


def with_class_weight(df: DataFrame, label: str, kind: str = "balanced_weight", name: str = "weight") -> DataFrame:
    """Attach the class weight; the few classes come back to the driver and become literals."""
    rows = class_weights(df, label).collect()
    pairs = [x for r in rows for x in (F.lit(r[label]), F.lit(r[kind]))]
    return df.withColumn(name, F.element_at(F.create_map(*pairs), F.col(label)))


# --- wafer geometry and rule scores --------------------------------------------------------------

def centre_distance(x: Column, y: Column, columns: int = S.WAFER_COLUMNS, rows: int = S.WAFER_ROWS) -> Column:
    """Distance from the wafer centre, 1 at the corner."""
    cx, cy = columns / 2.0, rows / 2.0
    return F.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) / math.sqrt(cx * cx + cy * cy)


def fit_leakage_scale(df: DataFrame, column: str = "cell_leakage_fa") -> tuple[float, float]:
    """Median and population deviation used by the leakage score."""
    median = quantile_table(df, [column], [0.5])[column][0]
    return median, df.agg(F.stddev_pop(column)).first()[0]


def risk_score(df: DataFrame, leakage_scale: tuple[float, float], time: str = "day_fraction") -> DataFrame:
    """Additive failure risk, multiplied by the edge factor and capped, as column ``risk``."""
    median, spread = leakage_scale
    z = (F.col("cell_leakage_fa") - median) / spread
    total = F.lit(S.RISK_BASE) + S.RISK_LEAKAGE_WEIGHT * clip(z - S.RISK_LEAKAGE_Z_START, 0.0, S.RISK_LEAKAGE_Z_SPAN)
    for column, test, threshold, weight in S.RISK_TERMS:
        value = F.abs(F.col(column)) if test == "abs>" else F.col(column)
        hit = value < threshold if test == "<" else value > threshold
        total = total + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
    total = total + S.RISK_UNCORRECTABLE_WEIGHT * F.col("uncorrectable_in_extended")
    total = total + S.RISK_TIME_WEIGHT * F.col(time)
    edge = 1.0 + S.RISK_EDGE_GAIN * clip((F.col("edge_distance") - S.RISK_EDGE_START) / S.RISK_EDGE_SPAN, 0.0, 1.0)
    return df.withColumn("risk", clip(total * edge, 0.0, S.RISK_CAP))


def dominant_cause(df: DataFrame, leakage_scale: tuple[float, float], label: str = "is_fail") -> DataFrame:
    """Strongest of six failure mechanisms for failed rows (the first listed wins ties), else ``pass``."""
    median, spread = leakage_scale
    z = (F.col("cell_leakage_fa") - median) / spread
    floor = lambda e: F.greatest(F.lit(0.0), e)
    # Mechanism names and score formulas, in tie order.
    scores = [
        ("row_hammer", F.col("rh_susceptibility") * 2),
        ("retention_degradation", floor((50 - F.col("retention_time_ms")) / 20)),
        ("ecc_uncorrectable", F.col("correctable_errors_per_1m") / 5 + F.col("uncorrectable_in_extended") * 3),
        ("contact_resistance", floor((F.col("trcd_ns") - 15) / 2)),
        ("gate_oxide_defect", floor(z - 2) * 1.5),
        ("pass_transistor_weak", floor((F.abs(F.col("vt_shift_mv")) - 30) / 10)),
    ]
    ranked = F.array(
        *[F.struct(s.cast("double").alias("score"), F.lit(-i).alias("order"), F.lit(n).alias("name")) for i, (n, s) in enumerate(scores)]
    )
    return df.withColumn("root_cause", F.when(F.col(label) == 1, F.array_max(ranked)["name"]).otherwise("pass"))


def shift_columns(df: DataFrame, columns: Sequence[str], magnitude: float = 0.5) -> DataFrame:
    """What-if drift: move columns by a multiple of their population deviation."""
    spread = fit_moments(df, columns)
    return df.withColumns({c: F.col(c) + F.lit(magnitude * spread[c][1]) for c in columns})
