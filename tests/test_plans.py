import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from oreflow.plans import alerts as al
from oreflow.plans import history as hi
from oreflow.plans import monitor as mo
from oreflow.plans import spec as sp
from oreflow.plans.monitor import Thresholds

NOW = dt.datetime(2024, 1, 31, 12, 0)
H = dt.timedelta(hours=1)
METADATA = {
    "dataflows": [
        {
            "dataflow_id": "items", "dataflow_group": "g1", "description": "d", "schedule": {"cron": "0 6 * * *"},
            "source": {"type": "files", "connection": {"connection_name": "db", "jdbc_url": "old"},
                       "extraction": {"log": "/in/log", "main_query": "q", "read_options": {"numPartitions": 8}}},
            "raw_bronze": {"catalog": "c", "schema": "s", "table": "raw"},
            "bronze": {"catalog": "c", "schema": "s", "table": "b", "cluster_by": ["k"],
                       "transformations": [{"type": "filter", "condition": "k > 0"}]},
            "silver": {
                "catalog": "c", "schema": "s", "table": "si",
                "transformations": {"select_expressions": ["k", "v"], "where_clauses": ["k IS NOT NULL"],
                                    "deduplication": {"enabled": True, "partition_by": ["k"], "order_by": ["v"], "row_number": 1}},
                "cdc_apply_changes": {"keys": ["k"], "sequence_by": "seq", "scd_type": "1"},
                "string_transformations": {"rtrim": True},
                "data_quality": {"expectations": [
                    {"name": "r1", "constraint": "k > 0", "action": "fail"}, {"name": "r1", "constraint": "k > 1", "action": "FAIL"},
                    {"name": "r2", "constraint": "v > 0", "action": "hint"}, {"constraint": "true", "action": "drop"},
                ]},
            },
        },
        {"dataflow_id": "off", "enabled": False},
        {"dataflow_id": "bare", "enabled": True, "raw_bronze": {"catalog": "c", "schema": "s", "table": "r2"}},
    ],
    "environments": {"dev": {"catalog": "dev", "source": {"connection": {"jdbc_url": "new", "port": 1}}, "schedule": {"enabled": False}}},
}


class TestSpecs:
    def test_disabled_flows_are_skipped_and_files_are_read(self, spark, tmp_path):
        path = tmp_path / "meta.json"
        path.write_text(json.dumps(METADATA))
        assert [r["dataflow_id"] for r in sp.load_specs(spark, path).collect()] == ["items", "bare"]

    def test_yaml_files_are_read(self, tmp_path):
        yaml = pytest.importorskip("yaml")
        path = tmp_path / "meta.yml"
        path.write_text(yaml.safe_dump(METADATA))
        assert sp.load_metadata(path) == METADATA

    def test_environment_override(self, spark):
        rows = {r["dataflow_id"]: r for r in sp.load_specs(spark, METADATA, "dev").collect()}
        items, bare = rows["items"], rows["bare"]
        assert items["silver"]["catalog"] == items["bronze"]["catalog"] == items["raw_bronze"]["catalog"] == "dev"
        assert items["source"]["connection"] == {"connection_name": "db", "jdbc_url": "new", "port": "1"}
        assert items["schedule"] == {"cron": "0 6 * * *", "enabled": "false"}
        assert bare["schedule"] == {"enabled": "false"} and bare["silver"] is None
        plain = sp.load_specs(spark, METADATA, "unknown").first()
        assert plain["silver"]["catalog"] == "c"

    def test_silver_row(self, spark):
        specs = sp.load_specs(spark, METADATA)
        row = sp.silver_specs(specs, NOW, author="me").where("dataFlowId = 'items'").first()
        assert row.__fields__ == sp.SILVER_SPEC_COLUMNS
        assert row["sourceDetails"] == {"catalog": "c", "database": "s", "table": "b"}
        assert row["targetDetails"] == {"catalog": "c", "database": "s", "table": "si", "comment": ""}
        assert json.loads(row["cdcApplyChanges"])["keys"] == ["k"]
        assert json.loads(row["dataQualityExpectations"]) == {
            "expect": {"r2": "v > 0"}, "expect_or_fail": {"r1": "k > 1"}, "expect_or_drop": {"unnamed": "true"},
        }
        assert json.loads(row["flowOptions"])["rtrim"] is True
        assert (row["version"], row["createdBy"], row["createDate"]) == ("v1", "me", NOW)

    def test_bronze_row_and_rows_without_settings(self, spark):
        specs = sp.load_specs(spark, METADATA)
        row = sp.bronze_specs(specs, NOW).where("dataFlowId = 'items'").first()
        assert row.__fields__ == sp.BRONZE_SPEC_COLUMNS
        assert row["sourceDetails"]["source_table"] == "raw" and row["clusterBy"] == ["k"]
        assert json.loads(row["flowOptions"])["transformations"][0]["condition"] == "k > 0"
        bare = sp.silver_specs(specs).where("dataFlowId = 'bare'").first()
        assert bare["dataQualityExpectations"] is None and bare["cdcApplyChanges"] is None and bare["selectExp"] == []

    def test_rule_counts(self, spark):
        rows = {r["dataFlowId"]: r for r in sp.rule_counts(sp.silver_specs(sp.load_specs(spark, METADATA))).collect()}
        assert rows["items"]["rule_count"] == 3 and rows["items"]["expect_or_quarantine"] == 0
        assert rows["bare"]["rule_count"] == 0


def runs(spark, rows):
    """Rows (flow, stage, status, start, seconds, processed, error)."""
    full = [
        (str(i), f, "g", s, st, at, at + dt.timedelta(seconds=sec) if sec is not None else None, sec, n, e, {}, at)
        for i, (f, s, st, at, sec, n, e) in enumerate(rows)
    ]
    return spark.createDataFrame(full, hi.RUN_HISTORY)


class TestHistory:
    def test_views(self, spark):
        history = runs(spark, [
            ("a", "bronze", "success", NOW - 2 * H, 1.0, 5, None), ("a", "bronze", "failed", NOW - H, 1.0, None, "e"),
            ("a", "silver", "success", NOW - 3 * H, 1.0, 7, None),
        ])
        lineage = spark.createDataFrame([("a", "db", "s", "t"), ("z", "db", "s", "t")], "dataflow_id string, source_system string, source_table string, target_table string")
        latest = {(r["stage"], r["status"]) for r in hi.latest_status(history).collect()}
        assert latest == {("bronze", "failed"), ("silver", "success")}
        complete = [(r["dataflow_id"], r["status"], r["rows_processed"]) for r in hi.complete_dataflow(lineage, history).collect()]
        assert sorted(complete, key=str) == [("a", "failed", None), ("a", "success", 7), ("z", None, None)]
        hi.create_views(spark, history, lineage)
        assert spark.table("v_complete_dataflow").count() == 3

    def test_stage_run_records_success_and_failure(self, spark, tmp_path):
        path = f"{tmp_path}/history"
        with hi.StageRun(spark, path, "items", "bronze", "g", {"env": "dev"}) as run:
            run.rows = 12
        with pytest.raises(ValueError):
            with hi.StageRun(spark, path, "items", "silver"):
                raise ValueError("broken")
        rows = {r["stage"]: r for r in spark.read.parquet(path).collect()}
        assert (rows["bronze"]["status"], rows["bronze"]["rows_processed"], rows["bronze"]["metadata"]) == ("success", 12, {"env": "dev"})
        assert (rows["silver"]["status"], rows["silver"]["error_message"], rows["silver"]["rows_processed"]) == ("failed", "broken", None)
        assert rows["silver"]["created_at"] is not None and rows["bronze"]["duration_seconds"] >= 0

    def test_throughput_of_a_run_without_time(self, spark):
        history = runs(spark, [("a", "b", "success", NOW, 0.0, 5, None), ("a", "b", "success", NOW, 2.0, 5, None)])
        assert [r["rows_per_second"] for r in hi.throughput(history).collect()] == [None, 2.5]

    def test_versions(self, spark):
        specs = sp.load_specs(spark, METADATA)
        first = hi.metadata_versions(specs, "me", as_of=NOW)
        same = hi.metadata_versions(specs, "me", as_of=NOW + H)
        changed = hi.metadata_versions(sp.override_environment(specs, METADATA["environments"]["dev"]), "me", as_of=NOW + 2 * H)
        assert [r["version_id"] for r in first.collect()] == [r["version_id"] for r in same.collect()]
        flagged = hi.with_active_flag(first.unionByName(changed)).collect()
        assert {(r["created_at"], r["is_active"]) for r in flagged} == {(NOW, False), (NOW + 2 * H, True)}
        assert {r["created_at"] for r in hi.active_versions(first.unionByName(changed)).collect()} == {NOW + 2 * H}

    def test_lineage(self, spark):
        edges = hi.lineage_edges(sp.load_specs(spark, METADATA), "run", NOW).collect()
        found = {(r["dataflow_id"], r["source_table"], r["target_table"]) for r in edges}
        assert {("items", "/in/log", "c.s.raw"), ("items", "c.s.raw", "c.s.b"), ("items", "c.s.b", "c.s.si")} <= found
        assert len({r["lineage_id"] for r in edges}) == len(edges)
        assert all(e["target_table"] for e in edges)

    def test_metadata_tables(self, spark):
        names = hi.create_metadata_tables(spark, "meta_test")
        assert hi.create_metadata_tables(spark, "meta_test") == names
        try:
            assert all(spark.catalog.tableExists(n) for n in names)
            assert [c.name for c in spark.catalog.listColumns("meta_test.monitoring_history") if c.isPartition] == ["monitoring_date"]
            assert {f.name for f in spark.table("meta_test.pipeline_execution_history").schema} == set(hi.RUN_HISTORY.names)
        finally:
            spark.sql("DROP DATABASE meta_test CASCADE")


class TestMonitor:
    def test_failures_inside_the_window(self, spark):
        history = runs(spark, [
            ("a", "bronze", "failed", NOW - H, 1.0, None, None), ("a", "bronze", "failed", NOW - H - dt.timedelta(seconds=1), 1.0, None, "old"),
            ("a", "bronze", "success", NOW, 1.0, 1, None), ("b", "bronze", "failed", NOW, 1.0, None, ""), ("c", "x", "failed", NOW + H, 1.0, None, "later"),
        ])
        found = al.failure_alerts(history, NOW, Thresholds(), F.lit(NOW)).collect()
        assert sorted(r["details"]["Dataflow ID"] for r in found) == ["a", "b"]
        assert {r["details"]["Error"] for r in found} == {"No error message"}

    def test_anomaly_needs_samples_and_spread(self, spark):
        def series(flow, values):
            return [(flow, "silver", "success", NOW - n * 24 * H, 1.0, v, None) for n, v in enumerate(values)]

        rows = series("spike", [10_000] + [100, 101] * 10) + series("few", [10_000, 1, 1, 1]) + series("flat", [5] * 8)
        rows += series("zero", [0] * 8) + [("nulls", "silver", "success", NOW, 1.0, None, None)]
        history = runs(spark, rows)
        found = mo.row_anomalies(history, NOW).collect()
        assert [r["dataflow_id"] for r in found] == ["spike"]
        assert found[0]["sample_count"] == 21 and 3 < found[0]["z_score"] <= 20 / 21**0.5 + 0.01
        outside = mo.row_anomalies(history, NOW, Thresholds(exclude_latest=True)).collect()
        assert outside[0]["sample_count"] == 20 and outside[0]["z_score"] > 1000
        alert = al.anomaly_alerts(history, NOW, Thresholds(exclude_latest=True), F.lit(NOW)).first()
        assert alert["severity"] == "critical" and alert["details"]["Latest Rows"] == "10,000" and "surge" in alert["title"]

    def test_stage_limits(self, spark):
        history = runs(spark, [
            ("a", "bronze", "success", NOW, 600.0, 1, None), ("a", "bronze", "success", NOW, 601.0, None, None),
            ("a", "silver", "success", NOW, 899.0, 1, None), ("a", "unknown", "success", NOW, 9e9, 1, None),
            ("a", "bronze", "failed", NOW, 9999.0, 1, "e"),
        ])
        found = mo.limit_breaches(history, NOW).collect()
        assert [(r["stage"], r["duration_seconds"], r["sla_limit"]) for r in found] == [("bronze", 601.0, 600.0)]
        assert al.sla_alerts(history, NOW, Thresholds(), F.lit(NOW)).first()["details"]["Rows Processed"] == "N/A"

    def test_success_rate(self, spark):
        def outcome(flow, text):
            return [(flow, "s", "success" if c == "+" else "failed", NOW - H, 1.0, 1, None) for c in text]

        history = runs(spark, outcome("ok", "++++-") + outcome("low", "++-") + outcome("bad", "+--") + outcome("rare", "--"))
        found = {r["dataflow_id"]: r["success_rate_pct"] for r in mo.low_success_rates(history, NOW).collect()}
        assert found == {"low": 66.67, "bad": 33.33}
        severity = {r["details"]["Dataflow ID"]: r["severity"] for r in al.rate_alerts(history, NOW, Thresholds(), F.lit(NOW)).collect()}
        assert severity == {"low": "warning", "bad": "critical"}

    def test_whole_hours_of_staleness(self, spark):
        second = dt.timedelta(seconds=1)
        ages = {"just": 3 * H - second, "three": 3 * H, "six": 7 * H - second, "seven": 7 * H}
        history = runs(spark, [(name, "s", "success", NOW - age, 1.0, 1, None) for name, age in ages.items()])
        found = {r["details"]["Dataflow ID"]: r["severity"] for r in al.freshness_alerts(history, NOW, Thresholds(), F.lit(NOW)).collect()}
        assert found == {"three": "warning", "six": "warning", "seven": "critical"}
        expected = spark.createDataFrame([("just", 3600), ("seven", 36000)], "dataflow_id string, expected_seconds int")
        assert {r["dataflow_id"] for r in mo.stale_pipelines(history, NOW, frequencies=expected).collect()} == {"just", "three", "six"}


class TestAlerts:
    @pytest.fixture
    def history(self, spark):
        rows = [("a", "bronze", "failed", NOW, 1.0, None, 'bad "x" <y>'), ("b", "bronze", "success", NOW, 700.0, 5, None),
                ("c", "silver", "success", NOW - 5 * H, 1.0, 5, None)]
        return runs(spark, rows)

    def test_all_checks_in_one_frame(self, history):
        found = al.alerts(history, NOW)
        assert found.columns == al.ALERT_COLUMNS
        assert {(r["alert_type"], r["severity"]) for r in found.collect()} == {
            (al.FAILURE, "critical"), (al.SLA, "warning"), (al.FRESHNESS, "warning"),
        }
        assert al.at_level(found, "critical").count() == 1 and al.at_level(found, "warning").count() == 3
        assert tuple(al.alert_summary(found).first()) == (1, 2, 0, 3)

    def test_a_broken_check_is_an_alert(self, history):
        found = al.alerts(history.drop("duration_seconds"), NOW)
        errors = found.where(F.col("alert_type") == al.CHECK_ERROR).collect()
        assert {r["details"]["Check Name"] for r in errors} == {"failures", "stage limits"}
        assert {r["severity"] for r in errors} == {"critical"}

    def test_errors_at_run_time_are_alerts_too(self, history, tmp_path):
        def explode(history, as_of, t, at):
            return al.failure_alerts(history, as_of, t, at).withColumn("title", F.raise_error(F.lit("boom")))

        found = al.run_checks(history, f"{tmp_path}/alerts", NOW, checks={"bad": explode, "freshness": al.freshness_alerts})
        assert {r["alert_type"] for r in found.collect()} == {al.CHECK_ERROR, al.FRESHNESS}

    def test_chat_payload(self, history):
        found = al.alerts(history, NOW)
        row = al.chat_payloads(found.where(F.col("alert_type") == al.FAILURE)).first()
        payload = json.loads(row["payload"])
        attachment = payload["attachments"][0]
        assert payload["text"] == "🔴 *Pipeline failed: a (bronze)*" and attachment["color"] == "#FF0000"
        assert [f["title"] for f in attachment["fields"]] == ["Alert Type", "Severity", "Message", "Timestamp", "Details"]
        assert [f["short"] for f in attachment["fields"]] == [True, True, False, True, False]
        assert attachment["fields"][3]["value"] == "2024-01-31T12:00:00"
        assert '• *Error*: bad "x" <y>' in attachment["fields"][4]["value"].split("\n")

    def test_payload_of_unknown_severity_without_details(self, spark):
        bare = spark.range(1).select(
            F.lit("T").alias("alert_type"), F.lit("odd").alias("severity"), F.lit("t").alias("title"), F.lit("m").alias("message"),
            F.create_map().cast("map<string,string>").alias("details"), F.lit(NOW).alias("timestamp"),
        )
        payload = json.loads(al.chat_payloads(bare).first()["payload"])
        assert payload["text"].startswith("⚪") and payload["attachments"][0]["color"] == "#808080"
        assert len(payload["attachments"][0]["fields"]) == 4
        assert al.html_bodies(bare).first()["html"].count("<tr>") == 3

    def test_html_is_escaped(self, history):
        html = al.html_bodies(al.alerts(history, NOW).where(F.col("alert_type") == al.FAILURE)).first()["html"]
        assert "bad &quot;x&quot; &lt;y&gt;" in html and "border-left:6px solid #FF0000" in html

    def test_history_row(self, history):
        rows = al.monitoring_history(al.alerts(history, NOW), "r", NOW, 1).collect()
        assert len(rows) == 1 and rows[0]["run_id"] == "r"
        row = rows[0]
        assert (row["alert_count"], row["critical_count"], row["warning_count"], row["monitoring_date"]) == (3, 1, 2, NOW.date())
        assert sum(json.loads(row["alerts_json"]).values()) == 3
        assert [f.name for f in hi.MONITORING_HISTORY] == list(row.__fields__)

    def test_history_without_alerts(self, history):
        row = al.monitoring_history(al.alerts(history, NOW).limit(0), "r", NOW).collect()
        assert [(r["alert_count"], r["alerts_json"]) for r in row] == [(0, "{}")]

    def test_many_alerts_are_one_totals_row_and_a_row_each(self, spark):
        history = runs(spark, [("hot", "bronze", "failed", NOW, 1.0, None, "same")] * 1500)
        found = al.failure_alerts(history, NOW, Thresholds(), F.lit(NOW)).repartition(3)
        rows = al.monitoring_history(found, "r", NOW).collect()
        assert [(r["alert_count"], json.loads(r["alerts_json"])) for r in rows] == [(1500, {al.FAILURE: 1500})]
        alerts = al.monitoring_alerts(found, "r", NOW).collect()
        assert len(alerts) == 1500 and {r["run_id"] for r in alerts} == {"r"}
        first = json.loads(alerts[0]["alert_json"])
        assert first["details"]["Error"] == "same" and first["severity"] == "critical"

    def test_status(self, history):
        assert al.monitoring_status(al.alerts(history, NOW), NOW).first()["status"] == "warning"
        assert al.monitoring_status(al.alerts(history, NOW).limit(0), NOW).first()["status"] == "success"
