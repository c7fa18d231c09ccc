"""Registered queries: service metrics over time windows, as batch and as streams over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import drift, lifecycle
from lotwise.plans.bindings import dies, on_dies, query, rounded, table
from lotwise.plans.drifts import SIX, quantile_ctes, reference, report_cte
from lotwise.plans.decisions import _GATE as _DAY_GATE
from lotwise.plans.scratch import folder
from lotwise.session import settings
from lotwise.sources import tables as io
from lotwise.streaming import landing, monitors
from lotwise.streaming import ordered_gate as ordered
from lotwise.streaming.gate import OUTPUT, stream_gate

_EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
_BUCKET = "time_bucket(interval '5 minutes', ts)"


def _stream(spark, d):
    """The event table as a stream of files, one a batch, whose last one holds the earliest events."""
    path = folder(spark, "events")
    table(spark, d, "events").repartitionByRange(4, F.desc("ts")).write.parquet(path)
    return landing.file_source(spark, path, _EVENTS, "parquet", files_per_batch=1)


def _drain(df, spark, name, keys, columns):
    """Run an update-mode aggregation to the end; every batch lands under its number, the last state of a key counts."""
    path = folder(spark, name)

    def save(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    run = df.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", folder(spark, name + "-state"))
    run.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(path)
    state = F.max_by(F.struct(*columns), F.col("batch")).alias("s")
    return rows.groupBy(*keys).agg(state).select(*keys, "s.*")


_RATE = f"SELECT {_BUCKET} AS window_start, {_BUCKET} + interval '5 minutes' AS window_end, event_type, count(*) AS requests, round(count(*) / 300e0, 6) AS rate FROM events GROUP BY ALL"


@query("st07_request_rate", _RATE)
def _(spark, d):
    return rounded(monitors.request_rate(table(spark, d, "events"), ["event_type"]))


@query("st07_request_rate_streamed", _RATE)
def _(spark, d):
    rate = monitors.request_rate(_stream(spark, d), ["event_type"], late=None)
    return rounded(_drain(rate, spark, "rate", ["window_start", "window_end", "event_type"], ["requests", "rate"]))


@query("st07_request_rate_sliding", "SELECT w AS window_start, w + interval '5 minutes' AS window_end, event_type, count(*) AS requests, round(count(*) / 300e0, 6) AS rate FROM ("
    "SELECT event_type, unnest([time_bucket(interval '1 minute', ts) - k * interval '1 minute' for k in [0, 1, 2, 3, 4]]) AS w FROM events) GROUP BY ALL")
def _(spark, d):
    return rounded(monitors.request_rate(table(spark, d, "events"), ["event_type"], slide="1 minute"))


@query("st08_latency_sketches")
def _(spark, d):
    return monitors.latency_quantiles(table(spark, d, "events"), "value", ["event_type"], size="1 hour")


_BOUNDS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def _le_sql() -> str:
    return ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS le_{i}" for i, b in enumerate(_BOUNDS))


def _interp(q: float) -> str:
    parts = []
    for i, b in enumerate(_BOUNDS):
        low, below = (_BOUNDS[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        parts.append(f"WHEN le_{i} >= n * {q}e0 THEN {low}e0 + ({b}e0 - {low}e0) * CASE WHEN le_{i} - {below} > 0 THEN (n * {q}e0 - {below}) / (le_{i} - {below}) ELSE 0 END")
    return "CASE " + " ".join(parts) + f" ELSE {_BOUNDS[-1]}e0 END"


@query("st08_latency_from_buckets", f"SELECT window_start, event_type, n AS requests, round({_interp(0.5)}, 6) AS p50, round({_interp(0.95)}, 6) AS p95 FROM ("
    f"SELECT time_bucket(interval '1 hour', ts) AS window_start, event_type, count(*) AS n, {_le_sql()} FROM events GROUP BY ALL)")
def _(spark, d):
    b = monitors.latency_buckets(table(spark, d, "events"), "value", ["event_type"], size="1 hour", bounds=_BOUNDS)
    both = monitors.bucket_quantile(monitors.bucket_quantile(b, 0.5, _BOUNDS, "p50"), 0.95, _BOUNDS, "p95")
    return rounded(both.select("window_start", "event_type", "requests", "p50", "p95"))


_FAIL = (
    f"SELECT {_BUCKET} AS window_start, {_BUCKET} + interval '5 minutes' AS window_end, count(*) AS n_total, round(avg(cast(event_type = 'error' as int)), 6) AS fail_share, "
    "round(count(*) FILTER (WHERE event_type = 'error') / 300e0, 6) AS fail_rate, round(count(*) FILTER (WHERE event_type <> 'error') / 300e0, 6) AS pass_rate FROM events GROUP BY ALL"
)


@query("st09_fail_share", _FAIL)
def _(spark, d):
    return rounded(monitors.fail_share(table(spark, d, "events"), F.col("event_type") == "error"))


@query("st09_fail_share_streamed", _FAIL)
def _(spark, d):
    share = monitors.fail_share(_stream(spark, d), F.col("event_type") == "error", late=None)
    return rounded(_drain(share, spark, "fails", ["window_start", "window_end"], ["n_total", "fail_share", "fail_rate", "pass_rate"]))


@query("st10_mean_batch_size", f"SELECT {_BUCKET} AS window_start, {_BUCKET} + interval '5 minutes' AS window_end, count(*) AS batches, round(avg(cast(props->>'k' as int)), 6) AS mean_batch_size FROM events GROUP BY ALL")
def _(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return rounded(monitors.mean_batch_size(e, "k"))


# --- landing ------------------------------------------------------------------------------------

_MSG = "event_id BIGINT, day_number INT, value DOUBLE, k INT"


def _messages(spark, d):
    """Event rows as JSON messages; every 50th body is cut short."""
    day = (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("day_number")
    body = F.to_json(F.struct("event_id", day, "value", F.get_json_object("props", "$.k").cast("int").alias("k")))
    broken = F.when(F.col("event_id") % 50 == 0, F.substring(body, 1, 10)).otherwise(body)
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), broken.alias("value"))


@query("io10_land_messages", "SELECT cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as int) AS day_number, count(*) AS n, round(sum(value), 2) AS total, cast(sum(cast(props->>'k' as int)) as bigint) AS k FROM events WHERE event_id % 50 <> 0 GROUP BY 1")
def _(spark, d):
    topic, out = folder(spark, "topic"), folder(spark, "landed")
    _messages(spark, d).write.json(topic)
    parsed = landing.parse_messages(landing.file_source(spark, topic, "key STRING, value STRING"), _MSG)
    landing.land(landing.good_rows(parsed), out, folder(spark, "landed-state")).awaitTermination()
    back = io.read_landing(spark, out, _MSG)
    return rounded(back.groupBy("day_number").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.sum("k").alias("k")), 2)


@query("st06_quarantine", "SELECT count(*) AS n_bad FROM events WHERE event_id % 50 = 0")
def _(spark, d):
    topic, out, bad = folder(spark, "topic"), folder(spark, "good"), folder(spark, "bad")
    _messages(spark, d).write.json(topic)
    stream = landing.file_source(spark, topic, "key STRING, value STRING")
    landing.land_with_quarantine(stream, out, bad, folder(spark, "quarantine-state"), _MSG).awaitTermination()
    return spark.read.parquet(bad).agg(F.count("*").alias("n_bad"))


@query("io11_batch_labels",
    "SELECT printf('day_%02d', arg_max(day, (n, -day))) AS label, cast(sum(n) as bigint) AS n_rows FROM (SELECT user_id % 3 AS part, cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as int) AS day, count(*) AS n "
    "FROM events WHERE event_id % 50 <> 0 GROUP BY ALL) GROUP BY part")
def _(spark, d):
    """Three message files, one a batch; which of them comes first is left open, so the batch number is cut off."""
    topic, out = folder(spark, "topic"), folder(spark, "good")
    for part in range(3):
        _messages(spark, d).where(F.col("key").cast("bigint") % 3 == part).coalesce(1).write.mode("append").json(topic)
    stream = landing.file_source(spark, topic, "key STRING, value STRING", files_per_batch=1)
    landing.land_with_quarantine(stream, out, folder(spark, "bad"), folder(spark, "labels-state"), _MSG).awaitTermination()
    return landing.batch_labels(spark.read.parquet(out)).select(F.regexp_extract("label", "^day_[0-9]+", 0).alias("label"), "n_rows")


@query("st05_message_stats", "SELECT count(*) AS messages, count(DISTINCT user_id) AS keys FROM events")
def _(spark, d):
    return io.message_stats(_messages(spark, d)).select("messages", "keys")


# --- drift monitor and gate -----------------------------------------------------------------------

@query("st11_streamed_drift", on_dies("SELECT day_number, feature, n, round(psi, 6) AS psi FROM psi", *quantile_ctes(SIX)))
def _(spark, d):
    df, ref = reference(spark, d)
    path = folder(spark, "dies")
    df.select("day_number", *SIX).write.parquet(path)
    stream = landing.file_source(spark, path, spark.read.parquet(path).schema, "parquet", files_per_batch=4)
    counts = _drain(monitors.bin_counts(stream, ref, ["day_number"]), spark, "bins", ["day_number", "feature", "bin"], ["n"])
    return rounded(monitors.psi_from_counts(counts, ref, ["day_number"]).select("day_number", "feature", "n", "psi"))


@query("st12_streamed_gate", on_dies(
    "SELECT 'all' AS model, day_number, critical AS features_critical, since AS days_since_retrain, retrain, critical >= 3 AND NOT retrain AS blocked, false AS late FROM gate", *quantile_ctes(SIX), report_cte(6), _DAY_GATE, recursive=True))
def _(spark, d):
    df, ref = reference(spark, d)
    path, out = folder(spark, "gate-in"), folder(spark, "gate-out")
    scan = drift.drift_scan(df, ref)
    rows = scan.select(F.lit("all").alias("model"), F.col("day_number").cast("int").alias("day_number"), F.col("features_critical").cast("int").alias("features_critical"), F.lit(True).alias("drift_reliable"))
    rows.write.parquet(path + "-all")
    for first in range(1, 41, 10):  # ten days a file, one file a batch: the state lives on between batches
        spark.read.schema(rows.schema).parquet(path + "-all").where(F.col("day_number").between(first, first + 9)).coalesce(1).write.mode("append").parquet(path)
    stream = landing.file_source(spark, path, rows.schema, "parquet", files_per_batch=1)
    run = stream_gate(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, "gate-state"))
    run.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUTPUT).parquet(out).select(
        "model", "day_number", F.col("features_critical").cast("long").alias("features_critical"), "days_since_retrain", "retrain", "blocked", "late")


_PER_TESTER = (
    "td AS (SELECT *, tester_id || '#' || day_number AS td FROM dies)", *quantile_ctes(SIX, key="td", source="td"),
    "days AS (SELECT split_part(td, '#', 1) AS tester_id, cast(split_part(td, '#', 2) AS int) AS day_number, count(*) FILTER (WHERE psi > 0.2) AS critical FROM psi GROUP BY td)",
    "seq AS (SELECT *, row_number() OVER (PARTITION BY tester_id ORDER BY day_number) AS i FROM days)",
    "gate AS (SELECT tester_id, day_number, critical, i, day_number AS since, critical >= 3 AND day_number >= 30 AS retrain, CASE WHEN critical >= 3 AND day_number >= 30 THEN day_number ELSE 0 END AS last FROM seq WHERE i = 1 "
    "UNION ALL SELECT s.tester_id, s.day_number, s.critical, s.i, s.day_number - g.last, s.critical >= 3 AND s.day_number - g.last >= 30, "
    "CASE WHEN s.critical >= 3 AND s.day_number - g.last >= 30 THEN s.day_number ELSE g.last END FROM gate g JOIN seq s ON s.tester_id = g.tester_id AND s.i = g.i + 1)",
)


@query("st12_gate_per_tester", on_dies(
    "SELECT tester_id, day_number, critical AS features_critical, since AS days_since_retrain, retrain, retrain AS retrain_succeeded, critical >= 3 AND NOT retrain AS blocked FROM gate", *_PER_TESTER, recursive=True))
def _(spark, d):
    df, ref = reference(spark, d)
    report = drift.psi_report(df, ref, ["tester_id", "day_number"])
    s = drift.drift_summary(report, ["tester_id", "day_number"], 6).withColumn("drift_reliable", F.lit(True))
    return lifecycle.staleness_gate(s, ["tester_id"])


@query("st12_ordered_gate", on_dies(
    "SELECT tester_id AS model, day_number, critical AS features_critical, since AS days_since_retrain, retrain, critical >= 3 AND NOT retrain AS blocked FROM gate", *_PER_TESTER, recursive=True))
def _(spark, d):
    """The gate per tester over reports that arrive out of order: early days wait in state for a timer."""
    df, ref = reference(spark, d)
    s = drift.drift_summary(drift.psi_report(df, ref, ["tester_id", "day_number"]), ["tester_id", "day_number"], 6)
    rows = s.select(F.col("tester_id").alias("model"), F.col("day_number").cast("int").alias("day_number"), F.col("features_critical").cast("int").alias("features_critical"), F.lit(True).alias("drift_reliable"))
    path, out = folder(spark, "reports"), folder(spark, "decisions")
    rows.write.parquet(path + "-all")
    rows = spark.read.parquet(path + "-all")
    arrival = F.floor((F.col("day_number") + F.pmod(F.col("day_number") * 7, F.lit(5))) / 14)
    for turn in range(4):  # one file a batch, days up to four too early in each
        rows.where(arrival == turn).orderBy(F.xxhash64("model", "day_number")).coalesce(1).write.mode("append").parquet(path)
    ordered.closing_report(rows, 40, 10).coalesce(1).write.mode("append").parquet(path)
    stream = landing.file_source(spark, path, rows.schema, "parquet", files_per_batch=1)
    with settings(spark, ordered.STORE):
        run = ordered.ordered_gate(stream, 10).writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(spark, "ordered-state"))
        run.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(ordered.OUTPUT).parquet(out).withColumn("features_critical", F.col("features_critical").cast("long"))
