import random

import pytest
from core import COLUMNS, UUIDS, deliveries, envelope, listing, routing
from pyspark.sql import functions as F

from waybill.operators import attachments as A, audit, gate, lookup
from waybill.operators.lookup import fits_broadcast, join_config, spread_join
from waybill.plans import delivery as P
from waybill.schemas import COORDS, RECORD, SEEN
from waybill.storage import as_table, new_folder

READY = "contract_id string, record_id string, topic string, partition int, offset long"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_delivery_of_a_hot_record(spark):
    """One record holds a third of all rows: it is cut down before the shuffle and the result is exact."""
    rng = random.Random(1)
    rows = [("c", "hot" if i % 3 == 0 else f"r{rng.randrange(2000)}", "t", i % 5, 10_000 - i) for i in range(9000)]
    ready = spark.createDataFrame(rows, READY).repartition(8)
    best = {}
    for contract, record, *at in rows:
        best[contract, record] = min(best.get((contract, record), tuple(at)), tuple(at))
    first = gate.first_delivery(ready)
    assert plan_of(first).count("WindowGroupLimit") == 2  # partial and final
    assert {(r.contract_id, r.record_id): (r.topic, r.partition, r.offset) for r in first.collect()} == best
    coords = gate.first_coords(ready).collect()
    assert {(r.contract_id, r.record_id): tuple(r["first"]) for r in coords} == best
    seen = spark.createDataFrame([("c", "hot"), ("d", "r1")], SEEN)
    left = gate.applied_coords(ready, seen)
    assert {(r.contract_id, r.record_id): (r.topic, r.partition, r.offset) for r in left.collect()} == {
        k: v for k, v in best.items() if k[1] != "hot"}


def brute_force(rows, seen):
    """Deliveries one after the other, as a single reader would take them."""
    known, outcomes = set(seen), {}
    for contract, record, topic, partition, offset, verdict in sorted(rows, key=lambda r: r[2:5]):
        key = (contract, record)
        if key in known:
            outcome = "duplicate"
        elif verdict == P.READY:
            outcome = "applied"
            known.add(key)
        else:
            outcome = "quarantined"
        outcomes[topic, partition, offset] = outcome
    return outcomes


@pytest.mark.parametrize("hot, threshold", [
    (100_000, 10 << 20),  # everything small
    (500, 10 << 20),  # some records are hot
    (500, -1),  # and nothing fits a broadcast: shuffle joins only
])
def test_settle_equals_taking_one_delivery_after_the_other(spark, monkeypatch, hot, threshold):
    monkeypatch.setattr(lookup, "HOT_COPIES", hot)
    if threshold < 0:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_settle(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_settle(spark):
    rng = random.Random(2)
    verdicts = [P.READY, P.READY, P.UNTIMED, P.MISCONFIGURED]
    rows = [
        ("c" if i % 3 else "d", "hot" if i % 3 == 0 else f"r{rng.randrange(400)}", "t", i % 4, i, rng.choice(verdicts))
        for i in range(3000)
    ]
    seen = [("c", f"r{i}") for i in range(0, 400, 7)]
    table = spark.createDataFrame(rows, READY + ", verdict string").repartition(4).withColumns({
        "attachment_id": F.lit("a"), "target": F.lit("t"), "failure_type": F.lit("X")})
    settled = P.settle(table, spark.createDataFrame(seen, SEEN))
    got = {(r.topic, r.partition, r.offset): r.outcome for r in settled.collect()}
    assert len(got) == settled.count() == len(rows)
    assert got == brute_force(rows, seen)


def test_seen_set_meets_each_record_once(spark):
    """With a large seen-set the copies of a record are combined before they are shuffled to it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ready = spark.createDataFrame([("c", "x", "t", 0, i) for i in range(9)], READY)
        seen = spark.createDataFrame([("d", "x")], SEEN)
        plan = plan_of(gate.applied_coords(ready, seen))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("SortMergeJoin") < plan.index("SortAggregate") < plan.index("partial_min")
    assert plan.count("Exchange hashpartitioning") == 2  # one per side; the grouping's is used for the join


def test_records_of_a_failed_target_are_not_writable(spark):
    rows = [("c", "a", "t", 0, 1), ("c", "a", "t", 0, 2), ("c", "b", "t", 0, 3), ("d", "a", "t", 0, 4)]
    table = spark.createDataFrame(rows, READY).withColumns({
        "attachment_id": F.lit("a"), "target": F.concat(F.col("contract_id"), F.lit(".csv")),
        "verdict": F.lit(P.READY), "failure_type": F.lit(None).cast("string")})
    seen = spark.createDataFrame([("c", "b")], SEEN)
    settled = P.settle(table, seen, failures=[P.TargetFailure("c.csv", "RETRY_EXHAUSTED", 3, "disk")])
    got = {r.offset: (r.outcome, r.error_type, r.attempts, r.error_message) for r in settled.collect()}
    lost = ("quarantined", "RETRY_EXHAUSTED", 3, "disk")
    assert got == {1: lost, 2: lost, 3: ("duplicate", None, None, None), 4: ("applied", None, None, None)}


def test_very_many_failed_targets(spark):
    rows = [("c", f"r{i}", "t", 0, i) for i in range(2500)]
    table = spark.createDataFrame(rows, READY).withColumns({
        "attachment_id": F.lit("a"), "target": F.concat(F.lit("t"), F.col("offset")), "verdict": F.lit(P.READY), "failure_type": F.lit(None).cast("string")})
    failures = [P.TargetFailure(f"t{i}", "RETRY_EXHAUSTED", 3, f"disk {i}") for i in range(2000)]
    got = {r.offset: (r.outcome, r.attempts, r.error_message) for r in P.settle(table, spark.createDataFrame([], SEEN), failures=failures).collect()}
    assert got == {i: ("quarantined", 3, f"disk {i}") if i < 2000 else ("applied", None, None) for i in range(2500)}


def test_outcome_precedence(spark):
    r = routing(spark, ("interns", {"columns": COLUMNS}), ("broken", {"columns": []}), ("odd", {"columns": COLUMNS, "format": "CSV"}))
    values = [
        None, "{", "[]", envelope(1, "other", recordId=...), envelope(2, recordId=...), envelope(3), envelope(3), envelope(4),
        envelope(5, "broken"), envelope(6, "broken"), envelope(7, occurredAt="2026-01-01T00:00:00.1234567890Z"),
        envelope(8, "odd"), envelope(9) + " x", envelope(10, "other") + " x", envelope(11, "other", payload=1),
    ]
    seen = spark.createDataFrame([("interns", UUIDS[4]), ("broken", UUIDS[5])], SEEN)
    table = as_table(P.staged(deliveries(spark, values), r), new_folder(spark, "t"))
    outcomes = P.settle(table, seen)
    got = [(r.outcome, r.error_type) for r in outcomes.orderBy("offset").collect()]
    bad, unknown = ("quarantined", "SCHEMA_VIOLATION"), ("quarantined", "UNCLASSIFIED_FAILURE")
    skipped, again = ("unattached", None), ("duplicate", None)
    assert got == [
        unknown, bad, skipped, skipped, bad, ("applied", None), again, again, again, unknown, unknown, unknown, bad,
        skipped, skipped,
    ]
    assert audit.reconcile(deliveries(spark, values), outcomes).first()["missing"] == 0
    letters = {r.offset: r for r in P.quarantined(table, outcomes).collect()}
    assert sorted(letters) == [0, 1, 4, 8 + 1, 10, 11, 12]
    assert "recordId" in letters[4].error_message and letters[4].value == values[4] and letters[4].key == "k4"
    lines = P.pick(table, outcomes, "applied").collect()
    assert [x.line for x in lines] == [f"{UUIDS[3]},Ada,9.5,true,,2026-07-21T14:10:00Z"]


def test_pick_beyond_the_broadcast_limit(spark, monkeypatch):
    r = routing(spark, ("interns", {"columns": COLUMNS}))
    table = as_table(P.staged(deliveries(spark, [envelope(i % 5) for i in range(20)]), r), new_folder(spark, "t"))
    outcomes = P.settle(table, spark.createDataFrame([], SEEN))
    small = sorted(x.offset for x in P.pick(table, outcomes, "applied").collect())
    monkeypatch.setattr(P, "fits_broadcast", lambda df: False)
    assert sorted(x.offset for x in P.pick(table, outcomes, "applied").collect()) == small == [0, 1, 2, 3, 4]


def test_same_id_in_two_contracts(spark):
    ready = spark.createDataFrame([("a", "x", "t", 0, 1), ("b", "x", "t", 0, 2)], READY)
    assert gate.applied_coords(ready, spark.createDataFrame([("a", "x")], SEEN)).select("contract_id").collect() == [("b",)]


def test_inherited_ids_count_for_contracts_without_a_store(spark):
    records = spark.createDataFrame([("old", "1"), ("old", "2"), ("new", "1"), ("new", "3")], SEEN)
    seen = spark.createDataFrame([("old", "2")], SEEN)
    inherited = gate.take_over(seen, spark.createDataFrame([("1",), ("2",)], "record_id string"))
    assert inherited.exempt == ("old",)
    assert sorted(map(tuple, gate.unseen(records, seen, inherited).collect())) == [("new", "3"), ("old", "1")]
    assert sorted(map(tuple, gate.known(records, seen, inherited).collect())) == [("new", "1", "inherited"), ("old", "2", "own")]


def test_union_keeps_each_record_once(spark):
    a = spark.createDataFrame([("c", "1"), ("c", "2")], SEEN)
    b = spark.createDataFrame([("c", "2"), ("d", "2")], SEEN)
    assert sorted(map(tuple, gate.union_seen(a, b).collect())) == [("c", "1"), ("c", "2"), ("d", "2")]


# --- configuration joins -----------------------------------------------------------------------------------------

def test_config_join_is_the_same_with_and_without_broadcast(spark):
    large = spark.createDataFrame([("hot" if i % 3 else f"c{i}", i) for i in range(600)], "k string, i int")
    config = spark.createDataFrame([("hot", "x"), ("c0", "y"), ("none", "z")], "k string, v string")
    for how in ("left", "inner"):
        near = join_config(large, config, ["k"], ["i"], how, broadcast=True)
        far = join_config(large, config, ["k"], ["i"], how, broadcast=False)
        assert sorted(map(str, near.collect())) == sorted(map(str, far.select(near.columns).collect()))
    parts = spread_join(large, config, ["k"], ["i"], "inner").where("k = 'hot'")
    assert parts.count() == 400


def test_size_check(spark):
    table = spark.range(100).selectExpr("cast(id AS string) AS k", "repeat('x', 100) AS v")
    assert fits_broadcast(table, rows=100, size=1 << 20)
    assert not fits_broadcast(table, rows=99, size=1 << 20)
    assert not fits_broadcast(table, rows=100, size=1000)


# --- attachments -------------------------------------------------------------------------------------------------

def test_first_attachment_wins_and_conflicts_are_reported(spark):
    rows = A.active(listing(spark, ("c", {}), ("d", {}), ("c", {"path": "x"}), ("c", "[]")))
    assert sorted(map(tuple, A.index(rows).select("contract_id", "attachment_id").collect())) == [("c", "a0"), ("d", "a1")]
    assert sorted(map(tuple, A.conflicts(rows).collect())) == [("c", 3, "a0", "a2"), ("c", 3, "a0", "a3")]
    assert A.summary(rows).first().asDict() == {"contracts": 2, "attachments": 4, "ignored": 2, "warning": None}
    assert A.summary(rows.limit(0)).first()["warning"]


def test_configuration(spark):
    rows = A.configured(A.active(listing(
        spark, ("a", {"columns": COLUMNS}), ("b", {"columns": COLUMNS, "path": " \t", "format": 5}),
        ("c", {"columns": ["x", {"header": "h"}, {"header": 1, "field": "f"}, {"header": "h", "field": "f"}], "path": "p", "format": "json"}),
        ("d", {"columns": {"header": "h", "field": "f"}}), ("e", {"columns": COLUMNS, "format": "yaml"}), ("f", "null"), ("g", "nonsense"),
    )), "default.csv").orderBy("pos").collect()
    assert [r.target for r in rows] == ["default.csv", "default.csv", "p"] + ["default.csv"] * 4
    assert [r.format for r in rows] == ["csv", "csv", "json", "csv", "yaml", "csv", "csv"]
    assert [tuple(c) for c in rows[2].columns] == [("h", "f")]
    assert [r.config_error is None for r in rows] == [True, True, True, False, False, False, False]
    assert "yaml" in rows[4].config_error and "csv, json, xml" in rows[4].config_error and "a3" in rows[3].config_error


def test_snapshot_changes_do_not_depend_on_key_order(spark):
    before = A.active(listing(spark, ("a", '{"x":1,"y":{"p":1,"q":2}}'), ("b", {"x": 1}), ("c", {})))
    now = A.active(listing(spark, ("a", '{"y":{"q":2,"p":1}, "x":1}'), ("b", {"x": 2}), ("d", {})))
    got = A.changes(before, now).select("contract_id", "change").collect()
    assert sorted(map(tuple, got)) == [("b", "changed"), ("c", "detached"), ("d", "attached")]


def test_only_enabled_attachments_of_the_type(spark):
    rows = listing(spark, ("a", {}), ("b", {}), ("c", {"x": None}))
    off = rows.withColumn("enabled", F.col("contract_id") != "a").withColumn(
        "adapter_type", F.when(F.col("contract_id") == "b", "db").otherwise("csv"))
    assert [r.contract_id for r in A.active(off).collect()] == ["c"]
    assert [r.contract_id for r in A.null_settings(off).collect()] == ["c"]
    assert A.null_settings(listing(spark, ("a", {"x": {"y": None}}))).count() == 0


def test_routed_lines_of_copies_and_seen_records(spark):
    """First deliveries of new records, with their lines; ids of a former store count for all contracts but exempt ones."""
    r = routing(spark, ("a", {"columns": COLUMNS, "format": "json", "path": "a"}), ("b", {"columns": COLUMNS, "path": "b"}))
    sent = [(1, "a"), (2, "a"), (1, "a"), (1, "b"), (3, "b"), (3, "a"), (4, "a"), (3, "b")]
    log = deliveries(spark, [envelope(i, contract) for i, contract in sent])
    seen = spark.createDataFrame([("a", UUIDS[2])], SEEN)
    former = gate.Inherited(spark.createDataFrame([(UUIDS[3],)], "record_id string"), ("b",))

    def lines(inherited):
        return {row.offset: (row.contract_id, row.record_id, row.target, UUIDS.index(row.record_id), row.line.count("Ada")) for row in P.routed_lines(log, r, seen, inherited).collect()}

    new = {at: (contract, UUIDS[i], contract, i, 1) for at, (i, contract) in enumerate(sent) if at in (0, 3, 4, 5, 6)}
    assert lines(None) == new
    assert lines(former) == {at: line for at, line in new.items() if at != 5}
