"""Registered queries: sources, sinks, ordering and the composed chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise import spec as S
from lotwise.operators import drift, lifecycle, profile
from lotwise.plans import daily, prepare
from lotwise.plans.bindings import dies, on_dies, query, rounded, table
from lotwise.plans.drifts import SIX, quantile_ctes, reference, report_cte
from lotwise.plans.scratch import folder
from lotwise.sources import committed
from lotwise.sources import tables as io

_NARROW = ["die_key", "day_number", "tester_id", "test_temp_c", "cell_leakage_fa", "is_fail"]


def _stored(spark, d, name="days"):
    path = folder(spark, name)
    io.write_days(dies(spark, d).select(*_NARROW), path)
    return path


@query("io01_read_days", on_dies("SELECT day_number, count(*) AS n, round(avg(test_temp_c), 6) AS t FROM dies WHERE day_number BETWEEN 5 AND 20 GROUP BY day_number"))
def _(spark, d):
    df = io.read_days(spark, _stored(spark, d), 5, 20)
    return rounded(df.groupBy("day_number").agg(F.count("*").alias("n"), F.avg("test_temp_c").alias("t")))


@query("io02_read_landing", on_dies("SELECT day_number, tester_id, count(*) AS n, count(cell_leakage_fa) AS n_leakage, 0 AS n_x FROM dies GROUP BY ALL"))
def _(spark, d):
    path = folder(spark, "landing")
    io.write_table(dies(spark, d).select("day_number", "tester_id", "cell_leakage_fa"), path)
    df = io.read_landing(spark, path, "day_number TINYINT, tester_id STRING, cell_leakage_fa FLOAT, die_x SMALLINT")
    return df.groupBy(F.col("day_number").cast("int").alias("day_number"), "tester_id").agg(
        F.count("*").alias("n"), F.count("cell_leakage_fa").alias("n_leakage"), F.count("die_x").cast("int").alias("n_x"))


@query("io03_split_by_column", on_dies("SELECT split, count(*) AS n, cast(sum(is_fail) as bigint) AS n_fail FROM dies GROUP BY split"))
def _(spark, d):
    parts = io.split_by_column(dies(spark, d))
    out = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("split"), F.count("*").alias("n"), F.sum("is_fail").alias("n_fail"))
        out = one if out is None else out.unionByName(one)
    return out


@query("io04_pruned_read", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_shipdate >= timestamp '1996-01-01' GROUP BY l_returnflag")
def _(spark, d):
    df = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp")).select("l_returnflag", "l_quantity")
    return rounded(df.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty")), 2)


@query("io05_replace_one_day", on_dies("SELECT day_number, count(*) AS n, round(avg(CASE WHEN day_number = 7 THEN test_temp_c + 1 ELSE test_temp_c END), 6) AS t FROM dies GROUP BY day_number"))
def _(spark, d):
    path = _stored(spark, d)
    again = dies(spark, d).where("day_number = 7").select(*_NARROW).withColumn("test_temp_c", F.col("test_temp_c") + 1)
    io.write_days(again, path)
    return rounded(spark.read.parquet(path).groupBy("day_number").agg(F.count("*").alias("n"), F.avg("test_temp_c").alias("t")))


@query("io06_stats_table", on_dies("SELECT day_number, count(*) AS total, cast(sum(is_fail) as bigint) AS n_fail, round(avg(is_fail), 6) AS fail_rate FROM dies GROUP BY day_number"))
def _(spark, d):
    path = folder(spark, "stats")
    io.write_stats(profile.daily_fail_rate(dies(spark, d)), path)
    return rounded(spark.read.parquet(path))


@query("io07_preview", on_dies("SELECT die_key, is_fail FROM dies ORDER BY die_key, is_fail LIMIT 1000"))
def _(spark, d):
    path = folder(spark, "preview")
    io.write_preview(dies(spark, d).select("die_key", "is_fail"), path, ["die_key", "is_fail"])
    return spark.read.schema("die_key string, is_fail int").option("header", True).csv(path)


@query("io08_messages", on_dies("SELECT tester_id AS key, count(*) AS n, count(*) FILTER (WHERE cell_leakage_fa IS NULL) AS n_null, round(sum(test_temp_c), 2) AS temp FROM dies GROUP BY tester_id"))
def _(spark, d):
    m = io.as_messages(dies(spark, d).select("tester_id", "cell_leakage_fa", "test_temp_c"))
    body = m.select("key", F.contains("value", F.lit('"cell_leakage_fa":null')).alias("gap"), F.get_json_object("value", "$.test_temp_c").cast("double").alias("t"))
    return rounded(body.groupBy("key").agg(F.count("*").alias("n"), F.count_if("gap").alias("n_null"), F.sum("t").alias("temp")), 2)


@query("io09_publish_range", on_dies("SELECT day_number, count(*) AS messages, count(DISTINCT tester_id) AS keys FROM dies WHERE day_number BETWEEN 3 AND 12 GROUP BY day_number"))
def _(spark, d):
    df = dies(spark, d).where(F.col("day_number").between(3, 12)).select("day_number", "tester_id", "test_temp_c")
    keyed = df.select("day_number", F.col("tester_id").alias("key"), F.to_json(F.struct("tester_id", "test_temp_c")).alias("value"))
    return io.message_stats(keyed, ["day_number"]).select("day_number", "messages", "keys")


@query("io12_report_sink", on_dies("SELECT day_number, feature, round(psi, 6) AS psi, CASE WHEN psi > 0.2 THEN 'critical' WHEN psi > 0.1 THEN 'warning' ELSE 'none' END AS severity FROM psi", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    path = folder(spark, "reports")
    io.append_reports(drift.psi_report(df, ref, ["day_number"]).select("day_number", "feature", "psi", "severity"), path)
    back = spark.read.schema("feature string, psi double, severity string, day_number int").json(path)
    return rounded(back)


@query("io14_feature_matrix", on_dies("SELECT split, label, count(*) AS n, round(avg(test_temp_c), 6) AS first_mean, round(avg(trp_ns), 6) AS last_mean FROM (SELECT split, is_fail AS label, test_temp_c, trp_ns FROM dies) GROUP BY ALL"))
def _(spark, d):
    path = folder(spark, "matrix")
    names = ["test_temp_c", "retention_time_ms", "trp_ns"]
    io.write_features(dies(spark, d), path, names, "is_fail")
    df, stored = io.read_features(spark, path)
    at = {c: i for i, c in enumerate(stored or names)}
    return rounded(df.groupBy("split", "label").agg(
        F.count("*").alias("n"), F.avg(F.col("features")[at["test_temp_c"]]).alias("first_mean"), F.avg(F.col("features")[at["trp_ns"]]).alias("last_mean")))


@query("io16_reference_round_trip", on_dies("SELECT day_number, feature, round(psi, 6) AS psi FROM psi", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    path = folder(spark, "reference")
    io.write_table(ref.to_frame(spark), path)
    again = drift.DriftReference.from_frame(spark.read.parquet(path))
    return rounded(drift.psi_report(df, again, ["day_number"]).select("day_number", "feature", "psi"))


@query("io17_pending_days", "SELECT cast(x as int) AS day_number FROM range(1, 41) t(x) WHERE x NOT IN (SELECT date_diff('day', date '2024-01-01', cast(ts as date)) + 1 FROM events)")
def _(spark, d):
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("day_number")
    pending = io.pending_days(range(1, 41), table(spark, d, "events").select(day))
    return lifecycle.missing_days(table(spark, d, "events").select(day), 1, 40).where(F.col("day_number").isin(pending))


@query("io17_committed_days", on_dies(
    "SELECT day_number, count(*) AS n, round(avg(CASE WHEN day_number = 7 THEN test_temp_c + 1 ELSE test_temp_c END), 6) AS t, CASE WHEN day_number = 7 THEN 2 WHEN day_number <= 20 THEN 1 ELSE 3 END AS sequence, "
    "CASE WHEN day_number > 20 THEN 'second run' WHEN day_number = 7 THEN 'again' ELSE 'first run' END AS state FROM dies GROUP BY day_number"))
def _(spark, d):
    """Half of the days, one of them again, a run that dies before its commit, then the days that are pending."""
    path, rows = folder(spark, "committed"), dies(spark, d).select(*_NARROW)
    committed.write(rows.where("day_number <= 20"), path, "first run")
    committed.write(rows.where("day_number = 7").withColumn("test_temp_c", F.col("test_temp_c") + 1), path, "again")
    committed.stage(rows.where("day_number <= 30").withColumn("test_temp_c", F.lit(0.0)), path)
    left = committed.pending_days(spark, path, range(1, 41))
    committed.write(rows.where(F.col("day_number").isin(*left)), path, "second run")
    found = committed.read(spark, path, rows.schema).groupBy("day_number").agg(F.count("*").alias("n"), F.avg("test_temp_c").alias("t"))
    known = committed.manifest(spark, path).select(F.col("day").alias("day_number"), F.col("sequence").cast("int").alias("sequence"), "state")
    return rounded(found.join(known, "day_number"))


@query("io13_variant_reports", on_dies(
    "SELECT day_number, 'drift.feature_psi.' || feature AS key, round(psi, 6) AS value FROM psi WHERE round(psi, 6) > 0.02 "
    "UNION ALL SELECT day_number, 'drift.severe.features', cast(count(*) as double) FROM psi WHERE psi > 0.2 GROUP BY day_number "
    "UNION ALL SELECT day_number, 'day', cast(day_number as double) FROM psi GROUP BY day_number", *quantile_ctes(SIX)))
def _(spark, d):
    """Reports whose nested keys differ from day to day, read back without a schema as one keyed table."""
    df, ref = reference(spark, d, SIX)
    report = drift.psi_report(df, ref, ["day_number"]).withColumn("psi", F.round("psi", 6))
    drifted = F.collect_list(F.when(F.col("psi") > 0.02, F.struct("feature", "psi")))
    severe = F.count_if(F.col("severity") == "critical")
    nested = F.struct(F.map_from_entries(drifted).alias("feature_psi"), F.when(severe > 0, F.struct(severe.alias("features"))).alias("severe"))
    documents = report.groupBy("day_number").agg(F.to_json(F.struct(F.first("day_number").alias("day"), nested.alias("drift"))).alias("value"))
    path = folder(spark, "day-documents")
    documents.repartition("day_number").write.partitionBy("day_number").text(path)
    leaves = io.read_json_leaves(spark, f"{path}/*").withColumn("value", F.col("value").cast("double"))
    days = leaves.where("key = 'day'").select("file", F.col("value").cast("int").alias("day_number"))
    return rounded(leaves.join(days, "file").select("day_number", "key", "value"))


# --- ordering -----------------------------------------------------------------------------------

@query("so03_top_features_by_spread", on_dies("SELECT feature, round(stddev_pop(value), 6) AS spread FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, cast({c} as double) AS value FROM dies" for c in S.NUMERIC) + ") GROUP BY feature ORDER BY stddev_pop(value) DESC LIMIT 5"))
def _(spark, d):
    m = profile.feature_moments(dies(spark, d), S.NUMERIC)
    return rounded(m.select("feature", F.col("std_pop").alias("spread")).orderBy(F.desc("spread")).limit(5))


@query("so05_row_concatenation", on_dies("SELECT day_number, count(*) AS n FROM dies GROUP BY day_number"))
def _(spark, d):
    df = dies(spark, d).select("day_number", "die_key")
    halves = [df.where("day_number <= 20"), df.where("day_number > 20")]
    return halves[0].unionByName(halves[1]).groupBy("day_number").agg(F.count("*").alias("n"))


# --- composed chains ------------------------------------------------------------------------------

_NUM, _CAT = list(S.NUMERIC), list(S.CATEGORICAL)
_SHOW = ["test_temp_c", "cell_leakage_fa", "trcd_ns", "vt_shift_mv", "tester_id", "probe_card_id", "chamber_id", "leakage_retention_ratio", "ecc_burden", "rh_risk_composite", "uncorrectable_in_extended", "edge_distance"]
_PREP = [
    "m AS (SELECT " + ", ".join(f"median({c}) FILTER (WHERE split = 'train') AS m_{c}" for c in _NUM) + " FROM dies)",
    "cm AS (SELECT chamber_id AS top FROM dies WHERE split = 'train' AND chamber_id IS NOT NULL GROUP BY chamber_id ORDER BY count(*) DESC, chamber_id LIMIT 1)",
    "p1 AS (SELECT dies.* REPLACE (" + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _NUM) + ", coalesce(chamber_id, top) AS chamber_id) FROM dies, m, cm)",
    "q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.25e0) FILTER (WHERE split = 'train') AS a_{c}, quantile_cont({c}, 0.75e0) FILTER (WHERE split = 'train') AS b_{c}" for c in _NUM) + " FROM p1)",
    "p2 AS (SELECT p1.* REPLACE (" + ", ".join(f"CASE WHEN a_{c} = b_{c} THEN {c} ELSE least(greatest({c}, a_{c} - 3e0 * (b_{c} - a_{c})), b_{c} + 3e0 * (b_{c} - a_{c})) END AS {c}" for c in _NUM) + ") FROM p1, q)",
    "p3 AS (SELECT p2.* REPLACE (" + ", ".join(f"ln(1 + greatest({c}, 0e0)) AS {c}" for c in S.LOG_SCALED) + ") FROM p2)",
    "p4 AS (SELECT *, retention_time_ms * test_temp_c AS retention_temp_interaction, cell_leakage_fa / (retention_time_ms + 1e-8) AS leakage_retention_ratio, edge_distance * edge_distance AS edge_risk, idd4_active_ma / (idd2p_standby_ma + 1e-8) AS power_ratio, "
    "bit_error_rate + ecc_syndrome_entropy + uncorrectable_in_extended AS ecc_burden, trcd_ns + trp_ns - tras_ns AS timing_margin, rh_susceptibility * ln(1 + adjacent_row_activations) AS rh_risk_composite FROM p3)",
    "codes AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM (" + " UNION ".join(f"SELECT '{c}' AS feature, {c} AS value FROM p1 WHERE split = 'train'" for c in _CAT) + "))",
    "p5 AS (SELECT p4.* REPLACE (" + ", ".join(f"coalesce((SELECT code FROM codes WHERE feature = '{c}' AND value = p4.{c}), -1)::double AS {c}" for c in _CAT) + ") FROM p4)",
    "mo AS (SELECT " + ", ".join(f"avg({c}) FILTER (WHERE split = 'train') AS u_{c}, stddev_pop({c}) FILTER (WHERE split = 'train') AS s_{c}" for c in _SHOW) + " FROM p5)",
]


@query("fe18_fit_and_transform", on_dies("SELECT die_key, split, " + ", ".join(f"round(({c} - u_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _SHOW) + " FROM p5, mo", *_PREP))
def _(spark, d):
    df = dies(spark, d)
    fitted = prepare.fit(df.where("split = 'train'"))
    return rounded(fitted.transform(df).select("die_key", "split", *_SHOW))


@query("fe19_prepare_requests", on_dies("SELECT split, count(*) AS n, " + ", ".join(f"round(avg(({c} - u_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END), 6) AS {c}" for c in _SHOW) + " FROM p5, mo GROUP BY split", *_PREP))
def _(spark, d):
    df = dies(spark, d)
    path = folder(spark, "parameters")
    io.write_table(prepare.fit(df.where("split = 'train'")).to_frame(spark), path)
    fitted = prepare.Preparation.from_frame(spark.read.parquet(path))
    out = fitted.transform_requests(df)
    return rounded(out.groupBy("split").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in _SHOW]))


_GATE = (
    "light AS (SELECT r.day_number, features_critical AS critical, features_warning, n >= 1400 AND (SELECT count(*) FROM dies WHERE day_number = 1) >= 1400 AS reliable FROM report r JOIN (SELECT day_number, count(*) AS n FROM dies GROUP BY day_number) USING (day_number)), "
    "gate AS (SELECT day_number, critical, features_warning, reliable, 1 AS since, false AS retrain, 0 AS last FROM light WHERE day_number = 1 UNION ALL "
    "SELECT l.day_number, l.critical, l.features_warning, l.reliable, l.day_number - g.last, l.critical >= 3 AND l.day_number - g.last >= 30 AND l.reliable, CASE WHEN l.critical >= 3 AND l.day_number - g.last >= 30 AND l.reliable THEN l.day_number ELSE g.last END "
    "FROM gate g JOIN light l ON l.day_number = g.day_number + 1)"
)


@query("lc21_run_days", on_dies(
    "SELECT g.day_number, total, n_fail, round(fail_rate, 6) AS fail_rate, critical AS features_critical, features_warning, reliable AS drift_reliable, since AS days_since_retrain, retrain FROM gate g "
    "JOIN (SELECT day_number, count(*) AS total, cast(sum(is_fail) as bigint) AS n_fail, avg(is_fail) AS fail_rate FROM dies GROUP BY day_number) USING (day_number)",
    *quantile_ctes(SIX, "day_number = 1"), report_cte(6), _GATE, recursive=True))
def _(spark, d):
    df = dies(spark, d)
    out = daily.run_days(df, df.where("day_number = 1"), SIX, thresholds=S.DriftThresholds(min_reliable_rows=1400))
    return rounded(out.drop("events", "blocked"))


@query("lc21_processed_table", on_dies("SELECT day_number, count(*) AS n, round(avg(power_ratio), 6) AS power_ratio, round(avg(timing_margin), 6) AS timing_margin FROM ("
    "SELECT day_number, coalesce(idd4_active_ma, (SELECT median(idd4_active_ma) FROM dies)) / greatest(idd2p_standby_ma, 0.001e0) AS power_ratio, (18e0 - coalesce(trcd_ns, (SELECT median(trcd_ns) FROM dies))) + (18e0 - trp_ns) AS timing_margin FROM dies) GROUP BY day_number"))
def _(spark, d):
    path = folder(spark, "processed")
    io.write_days(daily.process(dies(spark, d)), path)
    back = spark.read.parquet(path)
    return rounded(back.groupBy("day_number").agg(F.count("*").alias("n"), F.avg("power_ratio").alias("power_ratio"), F.avg("timing_margin").alias("timing_margin")))
