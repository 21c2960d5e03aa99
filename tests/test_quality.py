from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from oreflow.operators import cdc
from oreflow.operators import quality as q
from oreflow.operators import validation as v
from oreflow.operators.quality import Rule
from oreflow.plans import flows
from oreflow.sources import sinks
from oreflow.sources.readers import open_table
from oreflow.sources.target import ChangeTarget
from oreflow.streaming import flows as st

ROWS = [(1, 5.0, "a@b"), (2, -1.0, "c@d"), (3, None, "e"), (None, 2.0, None)]
RULES = [
    Rule("id_set", "id IS NOT NULL", "quarantine"), Rule("mail", "mail LIKE '%@%'", "warn"),
    Rule("positive", "price >= 0", "drop"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, price double, mail string").cache()


def ids(df):
    return sorted((r["id"] for r in df.collect()), key=lambda i: (i is None, i))


def test_null_results_are_violations(rows):
    found = {r["rule"]: (r["action"], r["passed"], r["failed"], r["total"]) for r in q.metrics(rows, RULES).collect()}
    assert found == {"id_set": ("quarantine", 3, 1, 4), "mail": ("warn", 2, 2, 4), "positive": ("drop", 2, 2, 4)}


def test_actions_split_the_rows(rows):
    result = q.check(rows, RULES)
    assert ids(result.kept) == [1]
    held = result.quarantined.collect()
    assert [(r["id"], r["failed_rules"]) for r in held] == [(None, ["id_set"])]


def test_warn_keeps_rows(rows):
    assert ids(q.check(rows, [RULES[1]]).kept) == [1, 2, 3, None]


def test_fail_rule_raises_with_counts(rows):
    rules = [Rule("id_set", "id IS NOT NULL", "fail"), Rule("fine", "true", "fail"), Rule("price", "price > 0", "fail")]
    with pytest.raises(q.QualityError) as caught:
        q.check(rows, rules)
    assert caught.value.offenders == {"id_set": 1, "price": 2}
    q.check(rows, [rules[1]])
    assert q.check(rows, rules, gate=False).kept.count() == 4


def test_no_rules(rows):
    result = q.check(rows, [])
    assert result.kept.count() == 4 and result.quarantined.count() == 0 and result.metrics.count() == 0


def test_metrics_of_an_empty_table(rows):
    assert {r["total"] for r in q.metrics(rows.limit(0), RULES).collect()} == {0}


def test_corrected_rows_pass_again(rows):
    held = q.check(rows, RULES).quarantined
    again = q.reprocess(held, {"id": "coalesce(id, 99)"}, RULES)
    assert ids(again.kept) == [99] and again.kept.columns == ["id", "price", "mail"]
    assert q.reprocess(held, {}, RULES).quarantined.count() == 1


def test_rules_from_documents():
    rules = q.rules_from([
        {"name": "a", "constraint": "x > 0", "action": "FAIL"}, {"constraint": "y"}, {"name": "b", "action": "odd"},
        {"name": "a", "constraint": "x > 1", "action": "fail"},
    ])
    assert rules == [Rule("a", "x > 1", "fail"), Rule("unnamed", "y", "warn"), Rule("b", "true", "warn")]
    assert q.rules_from(None) == [] and q.rules_from_json(None) == []
    text = '{"expect": {"w": "p"}, "expect_or_quarantine": {"q": "r"}}'
    assert q.rules_from_json(text) == [Rule("w", "p", "warn"), Rule("q", "r", "quarantine")]


def test_event_log_round_trip(spark, rows):
    log = q.event_log(q.metrics(rows, RULES), "items", F.current_timestamp())
    other = log.limit(1).withColumn("details", F.lit('{"other": 1}'))
    back = q.expectation_events(log.unionByName(other)).collect()
    assert {(r["rule"], r["passed"], r["failed"]) for r in back} == {("id_set", 3, 1), ("mail", 2, 2), ("positive", 2, 2)}


def results(df):
    return {(r["table"], r["check"]): (r["status"], r["message"]) for r in df.collect()}


def test_validation_plan(spark, rows):
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None), (None, "x")], "K int, t string")
    found = results(v.validate(spark, {
        "good": v.TableChecks(rows.where("id IS NOT NULL"), required=["ID", "price"], not_null=["id"], unique=["id"]),
        "bad": v.TableChecks(dup, min_rows=6, required=["gone"], not_null=["k", "t", "absent"], unique=["k"]),
        "keyless": v.TableChecks(dup, not_null=["absent"], unique=["absent"]),
        "empty": v.TableChecks(dup.limit(0), not_null=["k"], unique=["k"]),
        "missing": v.TableChecks(None, required=["a"]),
    }))
    assert {s for (t, _), (s, _) in found.items() if t == "good"} == {"PASSED"}
    assert found["bad", "record_count"] == ("FAILED", "too few records: 5 < 6")
    assert found["bad", "metadata_columns"] == ("FAILED", "missing columns: gone")
    assert found["bad", "null_values"] == ("FAILED", "nulls found: k=2, t=2")
    assert found["bad", "duplicates"] == ("FAILED", "duplicate keys: 2")
    assert found["keyless", "duplicates"] == ("PASSED", "key columns not found, check skipped")
    assert found["keyless", "null_values"][0] == "PASSED"
    assert found["empty", "record_count"][0] == "FAILED" and found["empty", "duplicates"][0] == "PASSED"
    assert [k for k in found if k[0] == "missing"] == [("missing", "table_exists")]


def test_validation_is_one_scan_per_table(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, t string").write.parquet(f"{tmp_path}/t")
    checks = v.TableChecks(spark.read.parquet(f"{tmp_path}/t"), not_null=["k", "t"], unique=["k"])
    plan = v.check_table(spark, "t", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_validation_report(spark, rows):
    plan = {"a": v.TableChecks(rows), "b": v.TableChecks(None)}
    report = v.validation_report(v.validate(spark, plan), "items", "2024-01-31 00:00:00").first()
    assert (report["overall_status"], report["total_checks"], report["failed_checks"]) == ("FAILED", 3, 1)
    assert '"dataflow_id":"items"' in report["report_json"] and '"check":"record_count"' in report["report_json"]


def test_counts_of_batches_add_up_to_those_of_the_table(spark):
    """Keys that repeat within a batch, across batches and not at all, null keys, and one with a third of all rows."""
    import random

    from oreflow.operators import validation as va

    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.34 else rnd.choice([None, *range(1, 60)]), rnd.choice(["a", "b", None]), i) for i in range(240)]
    batches = [rows[:5], rows[5:120], [], rows[120:200], rows[200:]]
    schema, seen, added = "k int, l string, v int", [], []
    for batch in batches:
        before, new = spark.createDataFrame(seen, schema), spark.createDataFrame(batch, schema)
        checks = va.TableChecks(new, not_null=["l", "k"], unique=["k", "l"])
        added.append(va.touched_measure(before, new, checks))
        seen += batch
        whole = va.TableChecks(spark.createDataFrame(seen, schema), not_null=["l", "k"], unique=["k", "l"])
        total = va.added_measures(added)
        assert total.select("_rows", "_null_0", "_null_1", "_duplicates").first() == va.measure(whole).select("_rows", "_null_0", "_null_1", "_duplicates").first()
    known = va.TableChecks(whole.frame, not_null=["l", "k"], unique=["k", "l"], measured=total)
    assert sorted(va.check_table(spark, "t", known).collect()) == sorted(va.check_table(spark, "t", whole).collect())
    with pytest.raises(ValueError):
        va.touched_measure(whole.frame, whole.frame, va.TableChecks(whole.frame))


def test_a_batch_reads_the_keys_of_the_table_only(spark, tmp_path):
    from oreflow.operators import validation as va

    spark.range(100).selectExpr("id as k", "'x' as wide").write.parquet(f"{tmp_path}/t")
    found = va.touched_measure(spark.read.parquet(f"{tmp_path}/t"), spark.range(3).selectExpr("id as k"), va.TableChecks(None, unique=["k"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "wide" not in plan and found.first()["_duplicates"] == 3


class TestCountedByTheWrite:
    def flow(self, *rules, changes=True):
        given = cdc.ChangeRules(keys=["k"], sequence_by="seq") if changes else None
        return flows.SilverFlow(source={}, target={}, rules=rules, changes=given)

    def frame(self, spark, n=200, dear=0):
        k = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
        return spark.range(n).select(k.alias("k"), F.col("id").alias("seq"), F.when(F.col("id") % 7 != 0, F.col("id") + dear).alias("v"))

    RULES = (q.Rule("v_set", "v IS NOT NULL", "quarantine"), q.Rule("low", "v < 150"), q.Rule("not_5", "v <> 5", "drop"))

    @pytest.mark.parametrize("changes", [True, False])
    def test_counts_equal_those_of_a_pass(self, spark, tmp_path, monkeypatch, changes):
        flow, rows, used, stored = self.flow(*self.RULES, changes=changes), self.frame(spark).repartition(5), [], {}
        real = st.silver_entries
        monkeypatch.setattr(st, "silver_entries", lambda *a: used.append(1) or real(*a))
        target = ChangeTarget(spark, f"{tmp_path}/t", flow.changes) if changes else f"{tmp_path}/t"
        batches = st.SilverBatches(flow, target, f"{tmp_path}/q", store=lambda counts, place: stored.update({place: counts}))
        batches(rows, 0)
        batches(rows, 0)
        whole = flows.split_silver(rows, flow.rules, flow.changes)
        expected = {r["rule"]: r.asDict() for r in whole.metrics.collect()}
        assert len(used) == 2 and list(stored) == ["_source=batch/_batch=0"]
        assert {c["rule"]: c for c in stored["_source=batch/_batch=0"]} == {k: v for k, v in expected.items() if k != "reject"}
        assert batches.rows == 2 * expected["reject"]["passed"]
        assert spark.read.parquet(f"{tmp_path}/q").count() == whole.quarantined.count()

    def test_empty_batches(self, spark, tmp_path):
        flow = self.flow(*self.RULES)
        batches = st.SilverBatches(flow, ChangeTarget(spark, f"{tmp_path}/t", flow.changes), f"{tmp_path}/q")
        empty = self.frame(spark).limit(0)
        batches(empty, 0)
        batches(spark.createDataFrame([], empty.schema), 1)
        assert batches.rows == 0 and {(m["total"], m["failed"]) for m in batches.metrics.values()} == {(0, 0)}

    def test_tasks_that_ran_twice_are_noticed(self, spark):
        tally = sinks.Tally([F.count(F.lit(1)).alias("total")])
        tally.over(self.frame(spark).repartition(3)).groupBy("k").count().collect()
        assert tally.counts() == {"total": 200}
        tally.seen = SimpleNamespace(get={"total": 260, tally.FIRST: 4, tally.PARTITION: 3})
        assert tally.counts() is None

    def test_a_violated_fail_rule_keeps_the_batch_unseen(self, spark, tmp_path):
        flow = self.flow(q.Rule("cheap", "coalesce(v, 0) < 500", "fail"))
        target = ChangeTarget(spark, f"{tmp_path}/t", flow.changes)
        batches = st.SilverBatches(flow, target, f"{tmp_path}/q")
        with pytest.raises(q.QualityError, match="cheap"):
            batches(self.frame(spark, dear=1000), 0)
        assert target.current() is None
        batches(self.frame(spark), 0)
        seen = sorted(map(tuple, target.current().collect()), key=str)
        # The batch is logged now: when it comes again, it is judged before it takes its own place.
        with pytest.raises(q.QualityError):
            batches(self.frame(spark, dear=1000), 0)
        assert sorted(map(tuple, target.current().collect()), key=str) == seen and batches.rows > 0

    def test_a_plain_table_is_judged_before_it_is_written(self, spark, tmp_path):
        flow = self.flow(q.Rule("cheap", "coalesce(v, 0) < 500", "fail"), changes=False)
        with pytest.raises(q.QualityError):
            st.SilverBatches(flow, f"{tmp_path}/t", f"{tmp_path}/q")(self.frame(spark, dear=1000), 0)
        assert open_table(spark, f"{tmp_path}/t") is None
