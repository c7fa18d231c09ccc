"""Column contracts, thresholds and policies that every operator receives as parameters."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Column names and their order must equal the published data set.
# ---------------------------------------------------------------------------
NUMERIC = (
    "test_temp_c", "cell_leakage_fa", "retention_time_ms", "row_hammer_threshold",
    "disturb_margin_mv", "adjacent_row_activations", "rh_susceptibility", "bit_error_rate",
    "correctable_errors_per_1m", "ecc_syndrome_entropy", "uncorrectable_in_extended",
    "trcd_ns", "trp_ns", "tras_ns", "rw_latency_ns", "idd4_active_ma", "idd2p_standby_ma",
    "idd5_refresh_ma", "gate_oxide_thickness_a", "channel_length_nm", "vt_shift_mv",
    "block_erase_count",
)
CATEGORICAL = ("tester_id", "probe_card_id", "chamber_id", "recipe_version")
SPATIAL = ("die_x", "die_y", "edge_distance")
ENGINEERED = (
    "retention_temp_interaction", "leakage_retention_ratio", "edge_risk", "power_ratio",
    "ecc_burden", "timing_margin", "rh_risk_composite",
)
LOG_SCALED = (
    "cell_leakage_fa", "retention_time_ms", "rh_susceptibility", "rw_latency_ns",
    "ecc_syndrome_entropy",
)
META = (
    "lot_id", "wafer_num", "day_fraction", "is_fail_true", "root_cause", "label_is_noisy", "split",
)
KEY_DRIFT_FEATURES = (
    "test_temp_c", "cell_leakage_fa", "retention_time_ms", "gate_oxide_thickness_a",
    "vt_shift_mv", "trcd_ns",
)
WAFER_COLUMNS, WAFER_ROWS = 35, 48
SIMULATION_START = "2026-02-20"


@dataclass(frozen=True)
class FeatureSpec:
    """Names the columns of one measurement table."""

    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    spatial: tuple[str, ...] = SPATIAL
    engineered: tuple[str, ...] = ENGINEERED
    log_scaled: tuple[str, ...] = LOG_SCALED
    meta: tuple[str, ...] = META
    target: str = "is_fail"
    day: str = "day_number"

    @property
    def tabular(self) -> tuple[str, ...]:
        return self.numeric + self.categorical + self.engineered

    @property
    def all_features(self) -> tuple[str, ...]:
        return self.tabular + self.spatial


DRAM = FeatureSpec()


@dataclass(frozen=True)
class DriftThresholds:
    # Published thresholds.
    psi_warning: float = 0.1
    psi_critical: float = 0.2
    kl_warning: float = 0.05
    kl_critical: float = 0.1
    min_drifted_features: int = 3
    quantile_bins: int = 10
    width_bins: int = 20
    proportion_epsilon: float = 1e-6
    histogram_floor: float = 1e-10
    min_reliable_rows: int = 10_000
    min_feature_values: int = 100
    reference_fail_rate: float = 0.0062
    fail_rate_tolerance: float = 0.5


@dataclass(frozen=True)
class RetrainPolicy:
    # Published gate settings.
    min_drifted_features: int = 3
    aucpr_drop: float = 0.05
    max_staleness_days: int = 30
    baseline_aucpr: float = 0.0524
    min_days_between: int = 30
    training_window_days: int = 15
    canary_min_improvement_pct: float = -10.0
    canary_forced_failure_day: int = 39
    champion_floor: float = 0.001
    early_stop_patience: int = 12


@dataclass(frozen=True)
class BusinessCosts:
    # Published cost constants.
    wafers_per_month: int = 50_000
    cost_per_wafer_usd: float = 1_200.0
    defect_rate: float = 0.006
    cost_per_false_negative_usd: float = 45_000.0
    cost_per_false_positive_usd: float = 120.0
    months: int = 12


@dataclass(frozen=True)
class FocalParams:
    # Published loss settings.
    alpha: float = 0.75
    gamma: float = 2.0
    epsilon: float = 1e-7
    smoothing: float = 0.01


@dataclass(frozen=True)
class Bound:
    """Accepted range and default of one input column; a bound without default is required."""

    column: str
    low: float | None = None
    high: float | None = None
    default: float | str | None = None


# Accepted ranges and defaults of the prediction input.
INPUT_BOUNDS = (
    Bound("test_temp_c", -50, 200), Bound("cell_leakage_fa", 0), Bound("retention_time_ms", 0),
    Bound("row_hammer_threshold", default=0.0), Bound("disturb_margin_mv", default=0.0),
    Bound("adjacent_row_activations", 0, default=0.0), Bound("rh_susceptibility", 0, default=0.0),
    Bound("bit_error_rate", 0, default=0.0), Bound("correctable_errors_per_1m", 0, default=0.0),
    Bound("ecc_syndrome_entropy", 0, default=0.0), Bound("uncorrectable_in_extended", 0, default=0.0),
    Bound("trcd_ns", default=0.0), Bound("trp_ns", default=0.0), Bound("tras_ns", default=0.0),
    Bound("rw_latency_ns", default=0.0), Bound("idd4_active_ma", 0, default=0.0),
    Bound("idd2p_standby_ma", 0, default=0.0), Bound("idd5_refresh_ma", 0, default=0.0),
    Bound("gate_oxide_thickness_a", 0, default=0.0), Bound("channel_length_nm", 0, default=0.0),
    Bound("vt_shift_mv", default=0.0), Bound("block_erase_count", 0, default=0.0),
    Bound("tester_id", default="T001"), Bound("probe_card_id", default="PC001"),
    Bound("chamber_id", default="CH001"), Bound("recipe_version", default="R1.0"),
    Bound("die_x", default=0.0), Bound("die_y", default=0.0), Bound("edge_distance", 0, default=0.0),
)
MAX_REQUEST_ROWS = 1024

# Event categories shown on the timeline, strongest first within a day.
TIMELINE_EVENT_TYPES = (
    "RETRAIN_TRIGGERED", "RETRAIN_FAILED", "BAD_MODEL_DEPLOYED", "CANARY_FAILED", "ROLLBACK",
)
HEADLINE_EVENTS = (("ROLLBACK", "ROLLBACK"), ("BAD_MODEL", "BAD DEPLOY"), ("RETRAIN", "RETRAIN"))
# Scenario words and the class they stand for; the first match wins.
SCENARIO_CLASSES = (
    (("retrain",), "recovery"),
    (("bad",), "failure"),
    (("sudden", "worsening"), "failure"),
    (("drift", "threshold", "continued"), "drift"),
    (("false",), "false_alarm"),
    (("recover", "post"), "recovery"),
)

# Additive failure risk. (column, test, threshold, weight)
RISK_TERMS = (
    ("retention_time_ms", "<", 45.0, 0.005),
    ("retention_time_ms", "<", 35.0, 0.015),
    ("rh_susceptibility", ">", 0.7, 0.004),
    ("rh_susceptibility", ">", 0.9, 0.010),
    ("correctable_errors_per_1m", ">", 10.0, 0.008),
    ("trcd_ns", ">", 17.0, 0.003),
    ("vt_shift_mv", "abs>", 40.0, 0.004),
)
RISK_BASE, RISK_LEAKAGE_WEIGHT, RISK_UNCORRECTABLE_WEIGHT, RISK_TIME_WEIGHT = 0.0003, 0.003, 0.050, 0.0005
RISK_LEAKAGE_Z_START, RISK_LEAKAGE_Z_SPAN, RISK_CAP = 2.0, 5.0, 0.95
RISK_EDGE_GAIN, RISK_EDGE_START, RISK_EDGE_SPAN = 6.0, 0.55, 0.45

# Columns and types of a message must equal the published ones.
PRODUCTION_DDL = (
    "die_x SMALLINT, die_y SMALLINT, edge_distance FLOAT, tester_id STRING, probe_card_id STRING, "
    "chamber_id STRING, recipe_version STRING, test_temp_c FLOAT, cell_leakage_fa FLOAT, "
    "retention_time_ms FLOAT, row_hammer_threshold INT, disturb_margin_mv FLOAT, "
    "adjacent_row_activations INT, rh_susceptibility FLOAT, bit_error_rate FLOAT, "
    "correctable_errors_per_1m SMALLINT, ecc_syndrome_entropy FLOAT, uncorrectable_in_extended TINYINT, "
    "trcd_ns FLOAT, trp_ns FLOAT, tras_ns FLOAT, rw_latency_ns FLOAT, idd4_active_ma FLOAT, "
    "idd2p_standby_ma FLOAT, idd5_refresh_ma FLOAT, gate_oxide_thickness_a FLOAT, "
    "channel_length_nm FLOAT, vt_shift_mv FLOAT, block_erase_count INT, is_fail TINYINT, "
    "day_number TINYINT, sim_date STRING"
)
