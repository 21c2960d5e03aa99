import random

import pytest
from pyspark.sql import functions as F

from oreflow.operators import cdc
from oreflow.operators.cdc import ChangeRules
from oreflow.operators.dedup import latest_by
from oreflow.sources.target import ChangeTarget

RULES = ChangeRules(keys=["k"], sequence_by="seq", delete_when="op = 'D'", except_columns=["seq", "op"])
SCHEMA = "k bigint, seq bigint, op string, v string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def state_of(rows):
    """The same rule in plain Python: greatest (sequence, delete) per key; values of ties are left open."""
    best = {}
    for k, seq, op, v in rows:
        if k is None or seq is None:
            continue
        rank = (seq, op == "D")
        if k not in best or rank > best[k][0]:
            best[k] = (rank, v)
    return {(k, v) for k, (rank, v) in best.items() if not rank[1]}


def live(df):
    return {(r["k"], r["v"]) for r in df.collect()}


def feed(seed, n=300, keys=40):
    """Unique sequences; a third of all rows on one key; some rows without key or sequence."""
    rnd = random.Random(seed)
    rows = []
    for seq in rnd.sample(range(10 * n), n):
        k = 0 if rnd.random() < 0.34 else rnd.randrange(keys)
        rows.append((k, seq, rnd.choice("IUUD"), f"v{seq}"))
    return rows + [(None, 1, "I", "x"), (3, None, "U", "y")]


def test_latest_row_wins_and_deletes_remove(spark):
    rows = [(1, 1, "I", "a"), (1, 3, "U", "c"), (1, 2, "U", "b"), (2, 1, "I", "a"), (2, 2, "D", None), (3, 5, "D", None)]
    result = cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), RULES)
    assert result.columns == ["k", "v"]
    assert live(result) == {(1, "c")}


def test_delete_wins_a_tie(spark):
    rows = [(1, 7, "I", "a"), (1, 7, "D", None), (2, 7, "D", None), (2, 7, "U", "b")]
    assert live(cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), RULES)) == set()


def test_equal_rows_are_ordered_by_content_not_position(spark):
    rows = [(1, 7, "U", c) for c in "abcdefgh"]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(seed + 1)
        seen |= live(cdc.apply_changes(df, RULES))
    assert len(seen) == 1


def test_rows_without_key_or_sequence_are_set_apart(spark):
    rows = [(None, 1, "I", "x"), (1, None, "U", "y"), (None, None, "U", "z"), (2, 1, "I", "ok")]
    usable, rejected = cdc.split_changes(cdc.change_rows(spark.createDataFrame(rows, SCHEMA), RULES), RULES)
    assert [r["v"] for r in usable.collect()] == ["ok"]
    assert {r["v"]: r["failed_rules"] for r in rejected.collect()} == {
        "x": ["null key: k"], "y": ["null sequence"], "z": ["null key: k", "null sequence"],
    }


def test_key_of_a_delete_comes_from_the_log(spark):
    rules = ChangeRules(keys=["k"], key_fallback={"k": "log_k"}, sequence_by="seq", delete_when="op = 'D'")
    df = spark.createDataFrame([(5, 5, 1, "I"), (None, 5, 2, "D"), (6, 6, 1, "I")], "k int, log_k int, seq int, op string")
    assert [r["k"] for r in cdc.apply_changes(df, rules).collect()] == [6]


def test_soft_delete_keeps_and_flags_the_row(spark):
    rules = ChangeRules(keys=["k"], sequence_by="seq", delete_when="op = 'D'", except_columns=["op"], soft_delete=True)
    rows = [(1, 1, "I", "a"), (1, 2, "D", "last"), (2, 1, "I", "b")]
    result = cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), rules)
    assert {(r["k"], r["v"], r["is_del"]) for r in result.collect()} == {(1, "a", "Y"), (2, "b", "N")}


def test_soft_delete_by_key_alone_keeps_the_last_values(spark):
    rules = ChangeRules(keys=["k"], sequence_by="seq", delete_when="op = 'D'", except_columns=["op"], soft_delete=True)
    rows = [(1, 1, "I", "a"), (1, 2, "U", "b"), (1, 5, "D", None), (2, 1, "D", None), (3, 1, "I", "x"), (3, 2, "D", None), (3, 3, "I", "y")]
    want = {(1, "b", "Y"), (2, None, "Y"), (3, "y", "N")}
    whole = cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), rules)
    assert {(r["k"], r["v"], r["is_del"]) for r in whole.collect()} == want
    for batches in (rows[:3], rows[3:]), (rows[2:], rows[:2]):
        for small in (False, True):
            state = None
            for batch in batches:
                state = cdc.apply_changes_incremental(state, spark.createDataFrame(batch, SCHEMA), rules, small)
            assert {(r["k"], r["v"], r["is_del"]) for r in cdc.live_rows(state, rules).collect()} == want
    late = cdc.apply_changes_incremental(state, spark.createDataFrame([(1, 4, "U", "c")], SCHEMA), rules)
    assert {(r["k"], r["v"], r["is_del"]) for r in cdc.live_rows(late, rules).collect()} == {(1, "c", "Y"), (2, None, "Y"), (3, "y", "N")}


SOFT = ChangeRules(keys=["k"], sequence_by="seq", delete_when="op = 'D'", except_columns=["op"], soft_delete=True, delete_columns=["seq"])


def soft_state_of(rows):
    """Per key the newest row's delete flag and sequence, and the values of the newest insert or update."""
    found = {}
    for k in {r[0] for r in rows if r[0] is not None and r[1] is not None}:
        mine = [r for r in rows if r[0] == k and r[1] is not None]
        newest = max(mine, key=lambda r: (r[1], r[2] == "D"))
        upserts = [r for r in mine if r[2] != "D"]
        values = max(upserts, key=lambda r: r[1])[3] if upserts else None
        found[k] = (k, newest[1], values, "Y" if newest[2] == "D" else "N")
    return set(found.values())


@pytest.mark.parametrize("seed", range(3))
def test_soft_deletes_in_one_shuffle_whatever_the_split(spark, seed):
    """A key with a third of all rows, changes dealt out to batches at random; deletes carry no values."""
    rows = [(k, seq, op, None if op == "D" else v) for k, seq, op, v in feed(seed)]
    whole = cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), SOFT)
    plan = plan_of(whole)
    assert {tuple(r) for r in whole.collect()} == soft_state_of(rows)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert "partial_max_by" in plan[plan.index("Exchange hashpartitioning"):]
    rnd, state, parts = random.Random(seed), None, [[], [], []]
    for row in rows:
        parts[rnd.randrange(3)].append(row)
    for part in parts:
        state = cdc.apply_changes_incremental(state, spark.createDataFrame(part, SCHEMA), SOFT)
    assert {tuple(r) for r in cdc.live_rows(state, SOFT).collect()} == soft_state_of(rows)


def test_a_busy_key_of_soft_deletes_is_one_row_per_task(spark):
    rows = spark.range(0, 30_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS seq", "CASE WHEN id % 9 = 0 THEN 'D' ELSE 'U' END AS op", "concat('v', id) AS v")
    reduced = cdc.latest_changes(cdc.change_rows(rows, SOFT), SOFT)
    found = reduced.where("k = 0").first()
    assert found["_sequence"] == 29_997 and found["_deleted"] == (29_997 % 9 == 0) and found["_last"]["at"] == max(i for i in range(0, 30_000, 3) if i % 9)
    reduced.collect()
    plan = reduced._jdf.queryExecution().executedPlan()
    rows_out = written_rows(spark, plan)
    assert reduced.count() == 20_001 and rows_out == 20_000 + 4


def written_rows(spark, plan) -> int:
    """Rows that the exchange of an executed plan has written."""
    while plan.nodeName() != "Exchange":
        name = plan.nodeName()
        plan = plan.executedPlan() if name == "AdaptiveSparkPlan" else plan.plan() if "QueryStage" in name else plan.children().apply(0)
    return plan.metrics().apply("shuffleRecordsWritten").value()


def both_ways(state, changes, rules):
    """The merged state with its feed, and the diff of the states before and after."""
    merged = cdc.merge_with_changes(state, changes, rules)
    after = cdc.merge_changes(state, changes, rules)
    diff = cdc.change_feed(cdc.live_rows(state, rules), cdc.live_rows(after, rules), rules.keys)
    return merged, after, cdc.change_entries(merged), diff


@pytest.mark.parametrize("rules", [RULES, SOFT], ids=["hard", "soft"])
@pytest.mark.parametrize("seed", range(3))
def test_the_merge_tells_its_changes(spark, rules, seed):
    rows = feed(seed)
    old, new = rows[: len(rows) // 2], rows[len(rows) // 2 :] + rows[:20]
    state = cdc.apply_changes_incremental(None, spark.createDataFrame(old, SCHEMA), rules)
    usable, _ = cdc.split_changes(cdc.change_rows(spark.createDataFrame(new, SCHEMA), rules), rules)
    merged, after, entries, diff = both_ways(state, usable, rules)
    assert sorted(map(repr, merged.drop(cdc.CHANGES).select(*after.columns).collect())) == sorted(map(repr, after.collect()))
    assert sorted(map(repr, entries.select(*diff.columns).collect())) == sorted(map(repr, diff.collect())) and diff.count() > 20
    assert live(cdc.live_rows(merged, rules)) == live(cdc.live_rows(after, rules))


def test_changes_without_effect_are_not_told(spark):
    def batch(*rows):
        return cdc.change_rows(spark.createDataFrame(list(rows), SCHEMA), RULES)

    state = cdc.latest_changes(batch((1, 5, "I", "a"), (2, 5, "I", "b"), (3, 5, "D", None), (4, 5, "I", "d")), RULES)
    given = batch((1, 4, "U", "late"), (2, 6, "U", "b"), (3, 6, "D", None), (5, 1, "D", None), (4, 6, "D", None), (6, 1, "I", "new"))
    entries = cdc.change_entries(cdc.merge_with_changes(state, given, RULES))
    assert {(r["k"], r["v"], r["_change_type"]) for r in entries.collect()} == {(4, "d", "delete"), (6, "new", "insert")}


def test_the_merge_with_changes_reads_each_side_once(spark, tmp_path):
    cdc.apply_changes_incremental(None, spark.createDataFrame(feed(2), SCHEMA), RULES).write.parquet(f"{tmp_path}/state")
    cdc.apply_changes_incremental(None, spark.createDataFrame(feed(3), SCHEMA), RULES).write.parquet(f"{tmp_path}/batch")
    merged = cdc.merge_with_changes(spark.read.parquet(f"{tmp_path}/state"), spark.read.parquet(f"{tmp_path}/batch"), RULES, reduced=True)
    plan = plan_of(merged)
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1


def test_only_type_1_is_accepted():
    with pytest.raises(ValueError):
        ChangeRules(keys=["k"], sequence_by="seq", scd_type="2")
    with pytest.raises(ValueError):
        ChangeRules(keys=[], sequence_by="seq")


def test_late_update_does_not_revive_a_deleted_key(spark):
    def batch(*rows):
        return spark.createDataFrame(list(rows), SCHEMA)

    for small in (False, True):
        state = cdc.apply_changes_incremental(None, batch((1, 5, "D", None)), RULES)
        state = cdc.apply_changes_incremental(state, batch((1, 4, "U", "late"), (2, 1, "I", "n")), RULES, small)
        assert live(cdc.live_rows(state, RULES)) == {(2, "n")}
        state = cdc.apply_changes_incremental(state, batch((1, 6, "I", "again")), RULES, small)
        assert live(cdc.live_rows(state, RULES)) == {(1, "again"), (2, "n")}


@pytest.mark.parametrize("seed", range(4))
def test_any_split_and_order_gives_the_one_pass_result(spark, seed):
    rows = feed(seed)
    rnd = random.Random(seed)
    parts = [[] for _ in range(3)]
    for row in rows:
        parts[rnd.randrange(3)].append(row)
        if rnd.random() < 0.1:
            parts[rnd.randrange(3)].append(row)
    state = None
    for number, part in enumerate(parts):
        state = cdc.apply_changes_incremental(
            state, spark.createDataFrame(part, SCHEMA), RULES, small_batch=(seed + number) % 2 == 0
        )
    expected = state_of(rows)
    assert live(cdc.live_rows(state, RULES)) == expected
    assert live(cdc.apply_changes(spark.createDataFrame(rows, SCHEMA), RULES)) == expected


def test_batch_with_a_new_column(spark):
    state = cdc.apply_changes_incremental(None, spark.createDataFrame([(1, 1, "I", "a"), (3, 1, "I", "c")], SCHEMA), RULES)
    wider = spark.createDataFrame([(1, 2, "U", "b", 9), (2, 1, "I", "n", 8)], SCHEMA + ", extra int")
    for small in (False, True):
        merged = cdc.live_rows(cdc.apply_changes_incremental(state, wider, RULES, small), RULES)
        assert {(r["k"], r["v"], r["extra"]) for r in merged.collect()} == {(1, "b", 9), (2, "n", 8), (3, "c", None)}


def test_rows_are_reduced_before_the_only_shuffle(spark):
    """A key with a third of the rows leaves every input partition as one row."""
    plan = plan_of(cdc.apply_changes(spark.createDataFrame(feed(1), SCHEMA), RULES))
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_excepted_columns_are_not_read(spark, tmp_path):
    wide = spark.createDataFrame([(1, 1, "I", "a", "junk")], SCHEMA + ", junk string")
    wide.write.parquet(f"{tmp_path}/wide")
    rules = ChangeRules(keys=["k"], sequence_by="seq", delete_when="op = 'D'", except_columns=["seq", "op", "junk"])
    plan = plan_of(cdc.apply_changes(spark.read.parquet(f"{tmp_path}/wide"), rules))
    assert "junk" not in plan


def test_small_batch_leaves_the_state_unshuffled(spark, tmp_path):
    state = cdc.apply_changes_incremental(None, spark.createDataFrame(feed(2), SCHEMA), RULES)
    state.write.parquet(f"{tmp_path}/state")
    stored = spark.read.parquet(f"{tmp_path}/state")
    batch = spark.createDataFrame([(1, 10**6, "U", "n"), (10**6, 1, "I", "m")], SCHEMA)
    batch.write.parquet(f"{tmp_path}/batch")
    merged = cdc.apply_changes_incremental(stored, spark.read.parquet(f"{tmp_path}/batch"), RULES, small_batch=True)
    merged.collect()
    plan = plan_of(merged)
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "SortMergeJoin" not in final and "BroadcastHashJoin" in final


def test_change_feed_of_two_snapshots(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, None)], "k int, v string, w int")
    after = spark.createDataFrame([(2, 9, "b"), (4, 5, "d"), (3, None, None)], "k int, w int, v string")
    found = {(r["_change_type"], r["k"], r["v"], r["w"]) for r in cdc.change_feed(before, after, ["k"]).collect()}
    assert found == {
        ("delete", 1, "a", None), ("update_preimage", 2, "b", 1), ("update_postimage", 2, "b", 9), ("insert", 4, "d", 5),
    }
    with pytest.raises(ValueError):
        cdc.change_feed(before, after.drop("w"), ["k"])


def test_change_feed_compares_maps(spark):
    before = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "1"})], "k int, m map<string,string>")
    after = spark.createDataFrame([(1, {"b": "2", "a": "1"}), (2, {"a": "2"})], "k int, m map<string,string>")
    kinds = sorted(r["_change_type"] for r in cdc.change_feed(before, after, ["k"]).collect())
    assert kinds == ["update_postimage", "update_preimage"]


def test_snapshot_application_deletes_what_is_missing(spark):
    rules = ChangeRules(keys=["k"], sequence_by="version")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    state = first.withColumns({cdc.SEQUENCE: F.lit(1).cast("long"), cdc.DELETED: F.lit(False)})
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    state = cdc.apply_changes_from_snapshot(state, second, rules, 2)
    assert live(cdc.live_rows(state, rules)) == {(2, "B"), (3, "c")}
    third = spark.createDataFrame([(1, "back")], "k int, v string")
    state = cdc.apply_changes_from_snapshot(state, third, rules, 3)
    assert live(cdc.live_rows(state, rules)) == {(1, "back")}


def test_order_items_and_nth_row(spark):
    df = spark.createDataFrame([(1, "D", 1), (1, "I", 9), (1, "U", 3), (2, None, 4), (2, "I", 5)], "k int, op string, seq int")
    assert {(r["k"], r["op"]) for r in latest_by(df, ["k"], ["op", "seq DESC"]).collect()} == {(1, "D"), (2, None)}
    assert {(r["k"], r["op"]) for r in latest_by(df, ["k"], ["op ASC NULLS LAST"]).collect()} == {(1, "D"), (2, "I")}
    assert {(r["k"], r["seq"]) for r in latest_by(df, ["k"], ["seq desc"], n=2).collect()} == {(1, 3), (2, 4)}


class TestChangeTarget:
    def batches(self, spark, n=3):
        rows = feed(7)
        return rows, [spark.createDataFrame([r for i, r in enumerate(rows) if i % n == b], SCHEMA) for b in range(n)]

    @pytest.mark.parametrize("small", [False, True])
    def test_batches_compaction_and_more_batches(self, spark, tmp_path, small):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        assert target.current() is None and target.compact() is None
        target.append(batches[2], 0)
        target.append(batches[0], 1)
        assert target.compact() == 2
        assert target.compact() == 2
        target.append(batches[1], 2)
        assert live(target.current(small)) == state_of(rows)
        assert target.compact(small) == 3
        again = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        assert live(again.current()) == state_of(rows)
        assert "Exchange" not in plan_of(again.current())

    def test_a_repeated_batch_replaces_itself(self, spark, tmp_path):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        for number in (0, 1, 1, 2, 0):
            target.append(batches[number], number)
        assert live(target.current()) == state_of(rows)
        target.compact()
        target.append(batches[1], 1)
        assert live(target.current()) == state_of(rows)

    def test_a_stream_that_lost_its_checkpoint_replaces_nothing(self, spark, tmp_path):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        target.append(batches[0], 0, "first")
        target.append(batches[1], 0, "second")
        target.compact()
        target.append(batches[2], 0, "third")
        assert live(target.current()) == state_of(rows)

    def test_rows_that_cannot_be_applied_are_kept_aside(self, spark, tmp_path):
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        assert target.rejected() is None
        target.append(spark.createDataFrame([(1, 1, "I", "a"), (None, 2, "I", "b")], SCHEMA), 0)
        assert [(r["v"], r["failed_rules"]) for r in target.rejected().collect()] == [("b", ["null key: k"])]

    def test_an_unfinished_batch_is_not_read(self, spark, tmp_path):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        target.append(batches[0], 0)
        latest = spark.createDataFrame([(1, "ghost", 10**9, False)], f"k bigint, v string, {cdc.SEQUENCE} bigint, {cdc.DELETED} boolean")
        latest.write.parquet(f"{tmp_path}/t/changes/_source=batch/_batch=1")
        assert (1, "ghost") not in live(target.current())

    def test_a_base_that_was_not_logged_is_ignored(self, spark, tmp_path):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        for number, batch in enumerate(batches):
            target.append(batch, number)
        spark.range(3).write.parquet(f"{tmp_path}/t/base/upto=3")
        assert live(target.current()) == state_of(rows)

    def test_schema_growth_over_batches(self, spark, tmp_path):
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES)
        target.append(spark.createDataFrame([(1, 1, "I", "a"), (2, 1, "I", "b")], SCHEMA), 0)
        target.compact()
        target.append(spark.createDataFrame([(1, 2, "U", "c", 5)], SCHEMA + ", extra int"), 1)
        for small in (False, True):
            found = {(r["k"], r["v"], r["extra"]) for r in target.current(small).collect()}
            assert found == {(1, "c", 5), (2, "b", None)}

    @pytest.mark.parametrize("buckets", [None, 4])
    def test_compactions_tell_their_changes(self, spark, tmp_path, buckets):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES, buckets=buckets, feed=True)
        assert target.change_feed() is None
        seen, replayed = {None: set()}, set()
        for number, batch in enumerate(batches):
            target.append(batch, number)
            before, last = live(target.current()), target.compact()
            assert live(target.current()) == before and cdc.CHANGES not in target.state().columns
            entries = [(r["_change_type"], (r["k"], r["v"])) for r in target.change_feed().collect()]
            replayed -= {row for kind, row in entries if kind in ("delete", "update_preimage")}
            replayed |= {row for kind, row in entries if kind in ("insert", "update_postimage")}
            assert replayed == before
            seen[last] = before
        assert replayed == state_of(rows)
        assert {(r["k"], r["v"]) for r in target.change_feed(1).collect()} == seen[1]
        plain = ChangeTarget(spark, f"{tmp_path}/plain", RULES)
        plain.append(batches[0], 0)
        plain.compact()
        with pytest.raises(ValueError):
            plain.change_feed()

    def test_bucketed_base_is_never_shuffled(self, spark, tmp_path):
        rows, batches = self.batches(spark)
        target = ChangeTarget(spark, f"{tmp_path}/t", RULES, buckets=8)
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            target.append(batches[2], 0)
            target.compact()
            target.append(batches[0], 1)
            assert exchanges_above(plan_of(target.state()), "Bucketed: true") == [0]
            target.compact()
            target.append(batches[1], 2)
            # Another session knows the files only; the table is declared again from them.
            for name in (r["tableName"] for r in spark.sql("SHOW TABLES LIKE 'oreflow_*'").collect()):
                spark.sql(f"DROP TABLE {name}")
            again = ChangeTarget(spark, f"{tmp_path}/t", RULES, buckets=8)
            assert live(again.current()) == state_of(rows)
            assert exchanges_above(plan_of(again.state()), "Bucketed: true") == [0]
            again.compact()
            assert live(ChangeTarget(spark, f"{tmp_path}/t", RULES).current()) == state_of(rows)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def exchanges_above(plan: str, scan: str) -> list[int]:
    """Per matching scan of a physical plan, the exchanges on the way up from it."""
    lines = [line for line in plan.split("\n") if "- " in line]
    depth = [line.index("- ") for line in lines]
    found = []
    for i, line in enumerate(lines):
        if scan in line:
            count, level = 0, depth[i]
            for j in range(i, -1, -1):
                if depth[j] < level:
                    level = depth[j]
                    count += "Exchange" in lines[j]
            found.append(count)
    return found
