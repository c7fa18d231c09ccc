"""Round trips, partition replacement, landing and streamed results against batch ones."""

import pytest
from pyspark.sql import functions as F

from lotwise import session
from lotwise.operators import lifecycle, quality
from lotwise.sources import committed
from lotwise.sources import tables as io
from lotwise.streaming import landing, ordered_gate
from lotwise.streaming.gate import OUTPUT, stream_gate


def test_writing_one_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.range(100).select((F.col("id") % 4 + 1).cast("int").alias("day_number"), F.col("id").alias("v"))
    io.write_days(df, path)
    io.write_days(df.where("day_number = 2").limit(3), path)
    assert {r["day_number"]: r["count"] for r in spark.read.parquet(path).groupBy("day_number").count().collect()} == {1: 25, 2: 3, 3: 25, 4: 25}
    with pytest.raises(FileNotFoundError):
        io.read_days(spark, path, 8, 9)
    assert io.pending_days(range(1, 7), spark.read.parquet(path)) == [5, 6]


def test_day_files_and_missing_days(spark, tmp_path):
    for d in (1, 3):
        spark.range(d).write.parquet(str(tmp_path / f"day_{d:02d}.parquet"))
    df, missing = io.read_day_files(spark, str(tmp_path), 1, 4)
    assert df.count() == 4 and sorted(r[0] for r in missing.collect()) == [2, 4]


def test_messages_keep_nulls_and_land_once(spark, tmp_path):
    rows = [("T1", 1, 1.5), ("T2", 2, None), (None, 2, 0.5)]
    df = spark.createDataFrame(rows, "tester_id string, day_number int, v double")
    sent = io.as_messages(df)
    assert '"v":null' in sent.where("key = 'T2'").first()["value"] and sent.where("key = 'unknown'").count() == 1
    topic, out, state = (str(tmp_path / n) for n in ("topic", "out", "state"))
    bad = spark.createDataFrame([("T9", "{broken")], "key string, value string")
    sent.unionByName(bad).write.json(topic)
    schema = "tester_id STRING, day_number TINYINT, v FLOAT"
    for _ in range(2):
        stream = landing.parse_messages(landing.file_source(spark, topic, "key STRING, value STRING"), schema)
        landing.land(landing.good_rows(stream), out, state).awaitTermination()
    back = io.read_landing(spark, out, schema)
    assert back.count() == 3 and dict(back.dtypes) == {"tester_id": "string", "day_number": "tinyint", "v": "float"}


def test_quarantine_and_stats(spark, tmp_path):
    topic = str(tmp_path / "topic")
    rows = [("k", '{"day_number": 1, "v": 1.0}'), ("k", '{"day_number": 2, "v": 2.0}'), ("k", "nonsense")]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.json(topic)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    run = landing.land_with_quarantine(
        landing.file_source(spark, topic, "key STRING, value STRING"), good, bad, str(tmp_path / "s"), "day_number INT, v DOUBLE"
    )
    run.awaitTermination()
    assert spark.read.parquet(bad).first()["value"] == "nonsense"
    labels = landing.batch_labels(spark.read.parquet(good)).first()
    assert (labels["label"], labels["n_rows"]) == ("day_01_batch_0000", 2)
    assert landing.run_stats(run)["messages"] == 3


def test_gate_state_survives_batches(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "model string, day_number int, features_critical int, drift_reliable boolean"
    for days in (range(28, 32), range(60, 62)):
        spark.createDataFrame([("m", d, 5, True) for d in days], schema).coalesce(1).write.mode("append").parquet(src)
        run = stream_gate(landing.file_source(spark, src, schema, "parquet")).writeStream.format("parquet").option("path", out)
        run.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(OUTPUT).parquet(out)
    assert sorted(r["day_number"] for r in rows.where("retrain").collect()) == [30, 60]


def test_gate_reports_late_days(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "model string, day_number int, features_critical int, drift_reliable boolean"
    for days in ((50,), (40, 90)):
        spark.createDataFrame([("m", d, 5, True) for d in days], schema).coalesce(1).write.mode("append").parquet(src)
        run = stream_gate(landing.file_source(spark, src, schema, "parquet")).writeStream.format("parquet").option("path", out)
        run.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    rows = {r["day_number"]: (r["retrain"], r["late"]) for r in spark.read.schema(OUTPUT).parquet(out).collect()}
    assert rows == {50: (True, False), 40: (False, True), 90: (True, False)}


def test_ordered_gate_decides_days_in_order(spark, tmp_path):
    """Three batches in mixed order give the decisions of the ordered days; only what is later than the watermark is lost."""
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "model string, day_number int, features_critical int, drift_reliable boolean"
    given = {d: (5 if d in (31, 33, 62, 64, 65) else 1, d != 31) for d in range(28, 70)}
    batches = [[33, 31, 32, 28, 30, 29], [36, 34, 35, *range(40, 60), 38, 37, 39], [62, 61, 60, 63, 69, 66, 64, 65, 67, 68, 30]]
    rows = [[(m, d, given[d][0], given[d][1]) for d in days for m in "ab"] for days in batches]
    with session.settings(spark, ordered_gate.STORE):
        for batch in rows:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
            run = ordered_gate.ordered_gate(landing.file_source(spark, src, schema, "parquet"), 4).writeStream.format("parquet").option("path", out)
            run.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
        early = spark.read.schema(ordered_gate.OUTPUT).parquet(out)
        assert early.agg({"day_number": "max"}).first()[0] < 66  # the last days still wait
        ordered_gate.closing_report(early, 69, 4).coalesce(1).write.mode("append").parquet(src)
        run = ordered_gate.ordered_gate(landing.file_source(spark, src, schema, "parquet"), 4).writeStream.format("parquet").option("path", out)
        run.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {(r.model, r.day_number): (r.features_critical, r.days_since_retrain, r.retrain, r.blocked) for r in spark.read.schema(ordered_gate.OUTPUT).parquet(out).collect()}
    whole = spark.createDataFrame([("a", d, *given[d]) for d in given], schema)
    want = {r.day_number: (r.features_critical, r.days_since_retrain, r.retrain, r.blocked) for r in lifecycle.staleness_gate(whole, ["model"]).collect()}
    assert got == {(m, d): v for d, v in want.items() for m in "ab"}
    assert [d for d in want if want[d][2]] == [33, 64]


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)


def test_validation_record(spark):
    good, wrong = (45.0, 15.2, 68.5), (-999.0, -1.0, -100.0)
    df = spark.createDataFrame([good, wrong], "test_temp_c double, cell_leakage_fa double, retention_time_ms double")
    checked = quality.check_bounds(df)
    assert quality.accepted(checked).count() == 1
    assert sorted(quality.quarantined(checked).first()["violations"]) == ["cell_leakage_fa:low", "retention_time_ms:low", "test_temp_c:low"]
    filled = quality.with_defaults(df).first()
    assert filled["tester_id"] == "T001" and filled["trcd_ns"] == 0.0


def test_timeline_reader(spark, tmp_path):
    p = tmp_path / "timeline.json"
    p.write_text('{"total_days": 2,\n "days": [{"day": 1, "events": ["drift_clean"], "drift": {"feature_psi": {"a": 0.3}}}, {"day": 2, "events": []}]}')
    rows = io.read_timeline(spark, str(p)).orderBy("day").collect()
    assert [r["day"] for r in rows] == [1, 2] and rows[0]["drift"]["feature_psi"] == {"a": 0.3}


def test_readers_see_committed_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60).select((F.col("id") % 3 + 1).cast("int").alias("day_number"), F.col("id").alias("v"))
    shown = lambda: {r.day_number: (r.n, r.v) for r in committed.read(spark, path, rows.schema).groupBy("day_number").agg(F.count("*").alias("n"), F.min("v").alias("v")).collect()}
    assert shown() == {} and committed.pending_days(spark, path, [1, 2, 3]) == [1, 2, 3] and committed.last_state(spark, path) is None
    assert committed.write(rows.where("day_number < 3"), path, "model v1") == [1, 2]
    before = shown()
    lost = committed.stage(rows.withColumn("v", F.lit(-1).cast("long")), path)  # killed between write and commit
    assert shown() == before == {1: (20, 0), 2: (20, 1)} and committed.pending_days(spark, path, [1, 2, 3]) == [3]
    assert committed.broken_runs(spark, path, rows.schema) == [lost]
    assert committed.last_state(spark, path) == (2, "model v1")
    assert committed.commit(spark, path, lost, rows.schema, [2]) == [2]  # or taken over in part
    assert shown() == {1: (20, 0), 2: (20, -1)} and committed.broken_runs(spark, path, rows.schema) == []
    committed.write(rows.where("day_number = 2 AND v > 30"), path)
    assert shown()[2] == (10, 31) and committed.read(spark, path, rows.schema, 2, 2).count() == 10
    assert committed.read(spark, path, rows.schema).columns == rows.columns


def test_json_leaves_of_documents_with_different_keys(spark, tmp_path):
    texts = {"a": '{"x": {"y": [1, {"z": true}], "e": {}}, "n": null}', "b": '{"x": 2.5, "w": "t"}', "c": "no json", "d": "[]", "e": '"s"'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = {(r.file[-6:-5], r.key, r.value) for r in io.read_json_leaves(spark, str(tmp_path)).collect()}
    assert got == {("a", "x.y.0", "1"), ("a", "x.y.1.z", "true"), ("a", "n", None), ("b", "x", "2.5"), ("b", "w", "t"), ("e", "", "s")}
    for name in "de":
        (tmp_path / f"{name}.json").unlink()
    assert "x: VARIANT" in io.json_schema(spark, str(tmp_path)) and "w: STRING" in io.json_schema(spark, str(tmp_path))
