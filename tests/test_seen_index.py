"""The seen-set with buckets and Bloom blocks, and targets that are written by one job."""

import random
from pathlib import Path

import pytest
from core import COLUMNS, UUIDS, deliveries, envelope, listing
from pyspark.sql import functions as F

from waybill.checks.derived import ENVELOPE_SCHEMA
from waybill.operators.failures import RetryPolicy
from waybill.schemas import SEEN
from waybill.streaming import seen_index
from waybill.streaming.job import DeliveryJob, Settings
from waybill.streaming.seen_index import IndexedSeenTable
from waybill.streaming.targets import TogetherTarget


def records(spark, *rows):
    return spark.createDataFrame(list(rows), SEEN)


def found(df):
    return sorted(map(tuple, df.select("contract_id", "record_id").collect()))


@pytest.fixture
def store(spark, tmp_path):
    return IndexedSeenTable(spark, str(tmp_path), buckets=4)


def marked(store):
    rng = random.Random(3)
    seen = {"a": [], "b": []}
    for commit in range(3):
        rows = [(rng.choice(["x", "y/z%"]), f"r{rng.randrange(300)}") for _ in range(60)]
        rows = sorted(set(rows))
        seen[commit] = rows
        store.mark(store.spark.createDataFrame(rows, SEEN), f"c{commit}")
    return {r for commit in range(3) for r in seen[commit]}


@pytest.mark.parametrize("named", [2000, 0])
def test_known_records_are_found(spark, store, monkeypatch, named):
    """Also if there are too many contracts and parts to name."""
    monkeypatch.setattr(seen_index, "NAMED", named)
    assert found(store.known_among(records(spark, ("x", "r1")))) == []
    seen = marked(store)
    asked = [(c, f"r{i}") for c in ("x", "y/z%", "never") for i in range(300)]
    assert found(store.known_among(records(spark, *asked))) == sorted(seen)
    assert set(found(store.seen())) == seen
    # One id in two contracts is two records.
    only = next((c, i) for c, i in sorted(seen) if ({"x": "y/z%", "y/z%": "x"}[c], i) not in seen)
    other = "x" if only[0] != "x" else "y/z%"
    assert found(store.known_among(records(spark, (other, only[1]), only))) == [only]


def test_false_positives_are_told_apart(spark, store, monkeypatch):
    """Ids that set no bits pass every filter; the ids themselves decide."""
    monkeypatch.setattr(seen_index, "_mask", lambda name: F.lit(0).cast("long"))
    monkeypatch.setattr(seen_index, "_block", lambda name, blocks: F.lit(0).cast("long"))
    store.mark(records(spark, ("x", "1"), ("x", "2")), "c0")
    asked = records(spark, ("x", "1"), ("x", "3"), ("y", "1"))
    hits, parts = store._candidates(asked, None)
    assert found(hits) == [("x", "1"), ("x", "3")] and parts == [("x", "c0")]
    assert found(store.known_among(asked)) == [("x", "1")]


def test_parts_that_cannot_hold_a_record_are_not_read(spark, store, tmp_path):
    store.mark(records(spark, ("x", "1")), "c0")
    store.mark(records(spark, ("x", "2"), ("z", "9")), "c1")
    # Whoever read these files would fail.
    for f in [*Path(tmp_path, "seen", "contract_id=x", "commit=c1").glob("part-*"), *Path(tmp_path, "seen", "contract_id=z").rglob("part-*")]:
        f.write_bytes(b"no parquet")
        crc = f.with_name(f".{f.name}.crc")
        crc.unlink(missing_ok=True)
    assert found(store.known_among(records(spark, ("x", "1"), ("x", "5"), ("q", "9")))) == [("x", "1")]
    with pytest.raises(Exception):
        store.known_among(records(spark, ("x", "2"))).collect()


def test_history_is_not_shuffled(spark, store):
    marked(store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hits, parts = store._candidates(records(spark, ("x", "r1"), ("x", "r2"), ("x", "r3"), ("x", "r4"), ("x", "r5")), None)
        plan = store._confirmed(hits, parts or [("x", "c0")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    scan = next(k for k, x in enumerate(lines) if "FileScan" in x and "waybill_seen_" in x)
    # The last child of the join is the history: nothing but filters and a sort is between it and its scan.
    join = next(k for k, x in enumerate(lines) if "SortMergeJoin" in x)
    child = max(k for k in range(join, scan) if lines[k].startswith("   +- ") or lines[k].startswith("      +- ") and k == join + 1)
    assert not any("Exchange" in x for x in lines[child:scan])
    assert "Bucketed: true" in lines[scan] and "contract_id#" in lines[scan].split("PartitionFilters: [")[1].split("]")[0]


def test_commits_are_repeated_compacted_and_forgotten(spark, store):
    store.mark(records(spark, ("x", "1"), ("x", "2")), "c0")
    store.mark(records(spark, ("x", "3")), "c0")
    assert found(store.known_among(records(spark, ("x", "3"), ("x", "1")), "c0")) == []
    store.mark(records(spark, ("x", "4"), ("y", "4")), "c1")
    store.mark(records(spark, ("x", "5")), "c2")
    before = found(store.known_among(records(spark, *[(c, str(i)) for c in "xy" for i in range(9)])))
    store.compact_all("c2")
    assert found(store.known_among(records(spark, *[(c, str(i)) for c in "xy" for i in range(9)]))) == before
    assert store.folder.names("seen_filters", "contract_id=x") == store.folder.names("seen", "contract_id=x") == ["commit=c2", "commit=merged-2-c1"]
    store.forget("x")
    assert found(store.known_among(records(spark, ("x", "4"), ("y", "4")))) == [("y", "4")]
    assert IndexedSeenTable(spark, store.folder.root, buckets=99).buckets == 4


# --- all targets in one job --------------------------------------------------------------------------------------


def job_of(spark, root, contracts, **options):
    rows = [(f"c{i}", {"columns": COLUMNS[:1], "path": f"t {i}%.csv"}) for i in range(contracts)]
    return DeliveryJob(
        spark, "job", str(root), lambda s: None, lambda s: listing(s, *rows), ENVELOPE_SCHEMA,
        Settings("default.csv", retry=RetryPolicy(2, 1), refresh_seconds=1e9), **options,
    )


def staged(spark, job, contracts):
    log = deliveries(spark, [envelope(i % 7, f"c{i % contracts}", recordId=UUIDS[i]) for i in range(40)])
    table = job._stage(log, "c")
    return table, job._outcomes(table, "c")


def test_jobs_of_a_commit_do_not_grow_with_targets(spark, tmp_path):
    jobs = {}
    for contracts in (1, 4, 40):
        job = job_of(spark, tmp_path / str(contracts), contracts)
        table, outcomes = staged(spark, job, contracts)
        spark.sparkContext.setJobGroup(f"write-{contracts}", "")
        try:
            assert job._write(table, outcomes, "c") == []
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs[contracts] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"write-{contracts}"))
        lines = []
        for i in range(contracts):
            place = tmp_path / str(contracts) / "targets" / f"t {i}%.csv"
            assert (place / "_header").read_text() == "record_id,name,created_at\n"
            got = [x.split(",")[0] for f in sorted(place.glob("commit=c/part-*")) for x in f.read_text().splitlines()]
            assert got == [UUIDS[k] for k in range(40) if k % contracts == i]
            lines += got
        assert len(lines) == 40
    assert len(set(jobs.values())) == 1, jobs


class Stubborn(TogetherTarget):
    """One target cannot be given its lines, and the job dies behind another one."""

    lost, crash_after = "t 1%.csv", None

    def publish(self, lines, target, header, commit):
        if target == self.lost:
            raise OSError("no space")
        super().publish(lines, target, header, commit)
        if target == self.crash_after:
            raise KeyboardInterrupt


def test_a_commit_goes_on_where_it_stopped(spark, tmp_path):
    target = Stubborn(spark, str(tmp_path / "targets"))
    job = job_of(spark, tmp_path, 4, target=target)
    table, outcomes = staged(spark, job, 4)
    target.crash_after = "t 2%.csv"
    with pytest.raises(KeyboardInterrupt):
        job._write(table, outcomes, "c")
    target.crash_after = None
    lost = job._write(table, outcomes, "c")
    assert [(f.target, f.attempts) for f in lost] == [("t 1%.csv", 2)]
    assert target.finished("c") == ["t 0%.csv", "t 2%.csv", "t 3%.csv"]
    # Once more, as after a crash behind the manifest: only the lost target is tried, and nothing is doubled.
    target.lost = None
    assert job._write(table, outcomes, "c") == []
    got = [x for i in range(4) for f in (tmp_path / "targets" / f"t {i}%.csv").glob("commit=c/part-*") for x in f.read_text().splitlines()]
    assert len(got) == len(set(got)) == 40
    assert not (tmp_path / "targets.commits" / "commit=c").exists()
