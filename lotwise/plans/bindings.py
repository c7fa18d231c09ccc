"""Binds the measurement-table operators to the driver's tables.

``dies`` derives one die-test row per lineitem row with plain arithmetic that reads the same in Spark SQL and
in the oracle engine, so both sides start from the same full-size table. Gaps, drift over the days, late
categories and label noise are part of the derivation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where one exists, its SQL counterpart."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(tune(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that has fewer splits than the session has cores; larger inputs stay as they are.
    By key, because a round-robin exchange would sort every row first."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column for comparison."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        out.append(F.round(name, special.get(name, digits)).alias(name) if kind in ("double", "float") else F.col(name))
    return df.select(*out)


def _mix(a: int, b: int, c: int, d: int, m: int = 9973) -> str:
    return f"cast((l_orderkey * {a} + l_partkey * {b} + l_suppkey * {c} + l_linenumber * {d}) % {m} as double) / {m}e0"


_BASE = {
    "die_key": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string), '-', cast(cast(floor(l_extendedprice) as bigint) as string))",
    "order_no": "l_orderkey",
    "day_number": "cast((year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate)) % 40 + 1 as int)",
    "die_x": "cast(l_partkey % 35 as int)",
    "die_y": "cast((l_suppkey * 7 + l_linenumber) % 48 as int)",
    "wafer_num": "cast(l_linenumber as int)",
    "qty": "l_quantity",
    "price": "l_extendedprice",
    "disc": "l_discount",
    "tax": "l_tax",
    "supp": "l_suppkey",
    "part_no": "l_partkey",
    "flag": "l_returnflag",
    "u1": _mix(7919, 104729, 1299709, 31),
    "u2": _mix(6101, 15485863, 32452843, 57),
    "u3": _mix(5003, 49979687, 67867967, 101),
    "u4": _mix(4001, 86028121, 104395301, 211),
    "u5": _mix(3001, 122949823, 141650939, 307),
    "u6": _mix(2003, 160481183, 179424673, 401),
    "u7": _mix(1009, 198491317, 217645177, 503),
    "u8": _mix(9001, 236887691, 256203161, 601),
}
_STEP = {
    "edge_distance": "sqrt((die_x - 17.5e0) * (die_x - 17.5e0) + (die_y - 24e0) * (die_y - 24e0)) / 29.702692e0",
    "temp": "85e0 + 6e0 * (u1 + u2 + u3 - 1.5e0) + case when day_number > 16 then 0.12e0 * (day_number - 16) else 0e0 end",
    "true_fail": "case when disc >= 0.095e0 and tax >= 0.055e0 then 1 when edge_fail < 0.02e0 then 1 else 0 end",
}
_DIES = {
    "die_key": "die_key",
    "order_no": "order_no",
    "day_number": "day_number",
    "split": "case when day_number <= 24 then 'train' when day_number <= 30 then 'val' when day_number <= 36 then 'test' else 'unseen' end",
    "day_fraction": "day_number / 40e0",
    "wafer_num": "wafer_num",
    "die_x": "die_x",
    "die_y": "die_y",
    "edge_distance": "edge_distance",
    "tester_id": "concat('T0', cast(supp % 8 as string))",
    "probe_card_id": "case when day_number > 30 and order_no % 20 = 0 then 'PC125' else concat('PC', cast(100 + part_no % 24 as string)) end",
    "chamber_id": "case when order_no % 41 = 0 then null else concat('CH', cast(supp % 6 as string)) end",
    "recipe_version": "concat('R', cast(1 + wafer_num % 4 as string), '.0')",
    "test_temp_c": "temp",
    "cell_leakage_fa": "case when order_no % 33 = 0 then null else 12e0 + 2.2e0 * (temp - 85e0) + 9e0 * u4 * u4 * u4 end",
    "retention_time_ms": "case when order_no % 25 = 1 then null else 30e0 + price / 2000e0 end",
    "row_hammer_threshold": "cast(10000 + part_no * 7 % 5000 as double)",
    "disturb_margin_mv": "case when order_no % 17 = 2 then null else 180e0 + 80e0 * u5 end",
    "adjacent_row_activations": "cast(500 + supp * 13 % 900 as double)",
    "rh_susceptibility": "u6 * u6",
    "bit_error_rate": "case when order_no % 20 = 3 then null else 0.00000001e0 * (0.2e0 + u7 * u7 * 4e0) end",
    "correctable_errors_per_1m": "floor(qty * qty / 200e0) * 1e0",
    "ecc_syndrome_entropy": "3e0 * u8",
    "uncorrectable_in_extended": "case when part_no % 331 = 0 then 1e0 else 0e0 end",
    "trcd_ns": "case when order_no % 50 = 7 then null when order_no % 49 = 5 then 22e0 + u1 else 13.5e0 + u2 end",
    "trp_ns": "13.4e0 + 0.9e0 * u3",
    "tras_ns": "32e0 + 2e0 * u4",
    "rw_latency_ns": "case when u5 < 0.7e0 then 15e0 + u6 else 45e0 + u6 end",
    "idd4_active_ma": "case when order_no % 33 = 9 then null else 90e0 + qty end",
    "idd2p_standby_ma": "9e0 + tax * 25e0",
    "idd5_refresh_ma": "150e0 + 30e0 * disc",
    "gate_oxide_thickness_a": "case when order_no % 12 = 4 then null else 40e0 + 2e0 * u7 - case when day_number > 10 then 0.05e0 * (day_number - 10) else 0e0 end end",
    "channel_length_nm": "18e0 + 0.4e0 * u8",
    "vt_shift_mv": "case when order_no % 14 = 5 then null else 60e0 * (u1 + u5 - 1e0) + case when day_number > 24 then 1.5e0 * (day_number - 24) else 0e0 end end",
    "block_erase_count": "cast(4800 + supp * part_no % 400 as double)",
    "is_fail_true": "true_fail",
    "is_fail": "case when true_fail = 1 and noise < 0.05e0 then 0 when true_fail = 0 and noise < 0.001e0 then 1 else true_fail end",
    "label_is_noisy": "(true_fail = 1 and noise < 0.05e0) or (true_fail = 0 and noise < 0.001e0)",
    "score": "floor((0.55e0 * u3 * u4 + true_fail * 0.35e0 * u6 + 0.1e0 * u8) * 10000e0) / 10000e0",
}
_BASE["edge_fail"] = _mix(8009, 275604541, 295075147, 701)
_BASE["noise"] = _mix(7001, 314606869, 334214459, 809)


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in columns.items()]


def dies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Die-test rows derived from lineitem."""
    base = table(spark, sf_dir, "lineitem").selectExpr(*_named(_BASE))
    return base.selectExpr("*", *_named(_STEP)).selectExpr(*_named(_DIES))


DIES_CTE = (
    f"base AS (SELECT {', '.join(_named(_BASE))} FROM lineitem), "
    f"step AS (SELECT *, {', '.join(_named(_STEP))} FROM base), "
    f"dies AS (SELECT {', '.join(_named(_DIES))} FROM step)"
)


def on_dies(body: str, *ctes: str, recursive: bool = False) -> str:
    """Oracle text: the dies derivation, further common table expressions, then the body."""
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join([DIES_CTE, *ctes]) + " " + body


def long_cte(columns, name: str = "long", keep: str = "", source: str = "dies") -> str:
    """Oracle text of a long table (keep..., feature, value) without missing values."""
    head = f"{keep}, " if keep else ""
    parts = [f"SELECT {head}'{c}' AS feature, cast({c} as double) AS value FROM {source} WHERE {c} IS NOT NULL" for c in columns]
    return f"{name} AS ({' UNION ALL '.join(parts)})"
