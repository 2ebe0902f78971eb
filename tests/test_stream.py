import json
import time
from pathlib import Path

import pytest
from core import COLUMNS, UUIDS, deliveries, envelope, listing
from pyspark.sql import functions as F

from waybill.checks.derived import ENVELOPE_SCHEMA
from waybill.operators.failures import RetryPolicy
from waybill.schemas import READBACK
from waybill.sources.config import read_schema_text
from waybill.sources.delivery_log import stream_log
from waybill.sources.stores import import_ids, read_back, read_single_file
from waybill.streaming.gates import SeenTable
from waybill.streaming.job import DeliveryJob, Settings
from waybill.streaming.targets import FileTarget, JsonDeadLetters

CSV = {"columns": COLUMNS, "path": "interns.csv"}


class Setup:
    """A folder with a delivery log, an attachment listing and a job over both."""

    def __init__(self, spark, root, *attachments):
        self.spark, self.root, self.sent = spark, str(root), 0
        self.rows = attachments or (("interns", CSV),)
        self.broken_listing = False
        Path(self.root, "log").mkdir()

    def send(self, *values, topic="interns.created"):
        deliveries(self.spark, values, topic, self.sent).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        self.sent += len(values)

    def listing(self, spark):
        if self.broken_listing:
            raise ConnectionError("registry away")
        return listing(spark, *self.rows)

    def job(self, name="job", **options):
        settings = options.pop("settings", Settings("default.csv", retry=RetryPolicy(3, 1), refresh_seconds=0))
        return DeliveryJob(
            self.spark, name, self.root, lambda s: stream_log(s, f"{self.root}/log"), self.listing, ENVELOPE_SCHEMA,
            settings, **options,
        )

    def lines(self, target="interns.csv"):
        files = sorted(Path(self.root, "targets", target).glob("commit=*/part-*"))
        return [line for f in files for line in f.read_text().split("\n")[:-1]]

    def header(self, target="interns.csv"):
        return Path(self.root, "targets", target, "_header").read_text()


def line(i):
    return f"{UUIDS[i]},Ada,9.5,true,,2026-07-21T14:10:00Z"


def counts(job):
    rows = job.outcomes().groupBy("outcome").count().collect()
    return {r["outcome"]: r["count"] for r in rows}


@pytest.fixture
def setup(spark, tmp_path):
    return Setup(spark, tmp_path)


def test_once_in_order_with_one_header(setup):
    setup.send(*[envelope(i) for i in range(5)], envelope(2))
    job = setup.job()
    job.run_available()
    setup.send(envelope(1), envelope(7))
    setup.job().run_available()  # as after a restart: same name, same checkpoint
    assert setup.lines() == [line(i) for i in (0, 1, 2, 3, 4, 7)]
    assert setup.header() == "record_id,name,score,active,mentor,created_at\n"
    assert counts(job) == {"applied": 6, "duplicate": 2}


def test_poison_is_isolated_and_unattached_is_skipped(setup):
    setup.send(envelope(0), "{ this is not valid json ", envelope(1, recordId=...), None, envelope(2))
    setup.send(envelope(3, "invoices"), envelope(4, "invoices", payload="bad"), topic="invoices.created")
    setup.send(envelope(5), topic="dead-letter")
    job = setup.job()
    job.run_available()
    assert sorted(setup.lines()) == [line(0), line(2)]
    assert counts(job) == {"applied": 2, "quarantined": 3, "unattached": 2}
    letters = {r.originalOffset: r for r in job.dead_letters().collect()}
    assert {k: r.errorType for k, r in letters.items()} == {
        1: "SCHEMA_VIOLATION", 2: "SCHEMA_VIOLATION", 3: "UNCLASSIFIED_FAILURE"}
    assert letters[1].originalPayload == "{ this is not valid json " and letters[1].attemptCount == 1
    assert letters[2].quarantinedAt.endswith("Z") and letters[2].failedAdapter == "waybill"


def test_two_contracts_two_formats_and_a_shared_default(spark, tmp_path):
    s = Setup(spark, tmp_path, ("a", {"columns": COLUMNS[:1], "path": "a.jsonl", "format": "json"}),
              ("b", {"columns": COLUMNS[:1]}), ("c", {"columns": COLUMNS[1:2]}))
    s.send(envelope(0, "a"), envelope(0, "b"), envelope(1, "c"), envelope(2, "b"))
    s.job().run_available()
    stamp = "2026-07-21T14:10:00Z"
    assert s.lines("a.jsonl") == [f'{{"record_id":"{UUIDS[0]}","name":"Ada","created_at":"{stamp}"}}']
    assert s.header("a.jsonl") == ""
    assert sorted(s.lines("default.csv")) == [f"{UUIDS[0]},Ada,{stamp}", f"{UUIDS[1]},9.5,{stamp}", f"{UUIDS[2]},Ada,{stamp}"]
    assert s.header("default.csv") == "record_id,name,created_at\n"


class CrashingGate(SeenTable):
    crash = True

    def mark(self, applied, commit):
        if self.crash:
            raise RuntimeError("crash between write and mark")
        super().mark(applied, commit)


def test_crash_between_write_and_mark_and_routing_change(setup, spark):
    setup.send(envelope(0), envelope(1))
    gate = CrashingGate(spark, setup.root)
    with pytest.raises(Exception, match="crash between write and mark"):
        setup.job(gate=gate).run_available()
    assert setup.lines() == [line(0), line(1)]
    gate.crash = False
    setup.rows = (("interns", {**CSV, "path": "elsewhere.csv"}),)  # must not touch the repeated batch
    setup.send(envelope(2))
    job = setup.job(gate=gate)
    job.run_available()
    assert setup.lines() == [line(0), line(1)]
    assert setup.lines("elsewhere.csv") == [line(2)]
    assert counts(job) == {"applied": 3}


class FailingTarget(FileTarget):
    def __init__(self, spark, root, bad, times, error):
        super().__init__(spark, root)
        self.bad, self.times, self.error, self.tries = bad, times, error, 0

    def write(self, lines, target, header, commit):
        if target == self.bad:
            self.tries += 1
            if self.tries <= self.times:
                raise self.error
        super().write(lines, target, header, commit)


@pytest.mark.parametrize("times, error, tries, outcome", [
    (2, OSError("hiccup"), 3, None),
    (99, OSError("disk full"), 3, ("RETRY_EXHAUSTED", 3, "disk full")),
    (99, FileNotFoundError("no such path"), 1, ("UNCLASSIFIED_FAILURE", 1, "no such path")),
])
def test_bounded_retry_per_target(spark, tmp_path, times, error, tries, outcome):
    s = Setup(spark, tmp_path, ("interns", CSV), ("other", {"columns": COLUMNS, "path": "other.csv"}))
    s.send(envelope(0), envelope(1, "other"), envelope(0))
    target = FailingTarget(spark, f"{s.root}/targets", "interns.csv", times, error)
    job = s.job(target=target)
    job.run_available()
    assert target.tries == tries and s.lines("other.csv") == [line(1)]
    letters = [(r.errorType, r.attemptCount, r.errorMessage) for r in job.dead_letters().collect()]
    assert letters == ([] if outcome is None else [outcome, outcome])
    assert s.lines() == ([line(0)] if outcome is None else [])
    # What was quarantined was not marked: it can be delivered again.
    target.times = 0
    s.send(envelope(0))
    s.job(target=target).run_available()
    assert s.lines() == [line(0)]


def test_target_that_cannot_be_a_folder(setup):
    """A real file in the place of the target folder is an I/O error: retried, then given up."""
    Path(setup.root, "targets").mkdir()
    Path(setup.root, "targets", "interns.csv").write_text("in the way")
    setup.send(envelope(0))
    job = setup.job()
    job.run_available()
    letter = job.dead_letters().first()
    assert (letter.errorType, letter.attemptCount, letter.originalPayload) == ("RETRY_EXHAUSTED", 3, envelope(0))


def test_forget_and_replay_one_contract(setup):
    setup.rows = (("interns", CSV), ("other", {"columns": COLUMNS, "path": "other.csv"}))
    setup.send(envelope(0), envelope(1))
    setup.send(envelope(2, "other"), topic="other.created")
    job = setup.job()
    job.run_available()
    job.gate.forget("interns")
    job.replay("interns.created").run_available()
    assert sorted(setup.lines()) == sorted([line(0), line(1)] * 2)
    assert setup.lines("other.csv") == [line(2)]


def test_listing_failures(setup):
    setup.broken_listing = True
    with pytest.raises(ConnectionError):
        setup.job()
    setup.broken_listing = False
    job = setup.job()
    setup.broken_listing = True
    setup.send(envelope(0))
    job.run_available()  # the last good snapshot stays
    assert setup.lines() == [line(0)]
    setup.broken_listing = False
    setup.rows = (("interns", {**CSV, "note": None}),)
    with pytest.raises(ValueError, match="null setting"):
        setup.job("another")


def test_new_attachment_takes_effect_without_restart(setup):
    setup.rows = (("nobody", CSV),)
    job = setup.job()
    setup.send(envelope(0))
    job.run_available()
    assert counts(job) == {"unattached": 1}
    setup.rows = (("interns", CSV),)
    setup.send(envelope(1))
    job.run_available()
    assert setup.lines() == [line(1)]


def test_pause_and_resume(setup):
    job = setup.job()
    assert job.status() == "paused"
    setup.send(envelope(0))
    job.start("0 seconds").processAllAvailable()
    assert job.status() == "running"
    job.pause()
    assert job.status() == "paused"
    setup.send(envelope(1))
    time.sleep(0.5)
    assert setup.lines() == [line(0)]
    job.resume("0 seconds").processAllAvailable()
    job.pause()
    assert setup.lines() == [line(0), line(1)]


def test_seen_table_compaction_and_take_over(setup, spark):
    gate = SeenTable(spark, setup.root)
    for i in range(3):
        gate.mark(spark.createDataFrame([("interns", UUIDS[i])], "contract_id string, record_id string"), f"c{i}")
    gate.compact("interns", "c2")
    assert len(gate.folder.names("seen", "contract_id=interns")) == 2
    assert sorted(r.record_id for r in gate.seen("c2").collect()) == UUIDS[:2]
    assert gate.seen().count() == 3
    store = Path(setup.root, "old-store")
    store.write_text(f"{UUIDS[8].upper()}\n\n  {UUIDS[9]} \n")
    gate.take_over(str(store))
    setup.rows = (("interns", CSV), ("fresh", {"columns": COLUMNS, "path": "fresh.csv"}))
    setup.send(envelope(8), envelope(9, "fresh"), envelope(0), envelope(7, "fresh"))
    setup.job(gate=gate).run_available()
    assert setup.lines() == [line(8)]  # a store of its own: the old one does not count
    assert setup.lines("fresh.csv") == [line(7)]
    assert store.exists()


def test_import_stops_at_a_line_that_is_no_id(spark, tmp_path):
    (tmp_path / "ids").write_text("not-an-id\n")
    with pytest.raises(Exception, match="not a record id"):
        import_ids(spark, str(tmp_path / "ids")).collect()


def test_schema_document(spark, tmp_path):
    (tmp_path / "schema.json").write_text(ENVELOPE_SCHEMA)
    assert read_schema_text(spark, str(tmp_path / "schema.json")) == ENVELOPE_SCHEMA
    (tmp_path / "empty.json").write_text(" \n")
    with pytest.raises(ValueError):
        read_schema_text(spark, str(tmp_path / "empty.json"))
    with pytest.raises(Exception):
        read_schema_text(spark, str(tmp_path / "absent.json"))


def test_read_back_gives_what_was_delivered(spark, tmp_path):
    fields = ["internId", "firstName", "lastName", "email", "college", "department", "mentor", "startDate", "status"]
    columns = [{"header": h, "field": f} for h, f in zip(READBACK.names[1:-1], fields)]
    s = Setup(spark, tmp_path, ("interns", {"columns": columns, "path": "interns.csv"}))
    hostile = {"internId": "I,1", "firstName": 'a "b"', "lastName": "two\nlines", "email": "cr\rhere", "college": " pad ",
               "department": "", "mentor": None, "startDate": "2026-09-01", "status": "ACTIVE"}
    s.send(envelope(0, payload=hostile))
    s.job().run_available()
    row = read_back(spark, f"{s.root}/targets/interns.csv").first()
    assert tuple(row) == (UUIDS[0], *[hostile[f] or "" for f in fields], "2026-07-21T14:10:00Z")


def test_ordered_target(spark, tmp_path):
    rows = spark.range(1000).repartition(8).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("id").cast("string").alias("line"))
    target = FileTarget(spark, str(tmp_path))
    target.write(rows, "x", "head", "c")
    target.write(rows.withColumn("line", F.lit("more")).limit(2), "x", "another head", "d")
    files = sorted(Path(tmp_path, "x", "commit=c").glob("part-*"))
    assert [int(v) for f in files for v in f.read_text().split()] == list(range(1000))
    target.export_single_file("x", f"{tmp_path}/one.txt")
    assert Path(tmp_path, "one.txt").read_text().split("\n") == ["head", *map(str, range(1000)), "more", "more", ""]
    target.export_single_file("never written", f"{tmp_path}/none.txt")
    assert Path(tmp_path, "none.txt").read_text() == "" and target.header("x") == "head" and target.header("y") is None


def test_order_within_a_topic_partition_across_files(setup, spark):
    """Files of one partition are packed into tasks by size; lines still come by offset."""
    later, earlier = [envelope(i) for i in range(3, 60)], [envelope(i) for i in range(3)]
    setup.sent = 3
    setup.send(*later)
    setup.sent = 0
    setup.send(*earlier)
    setup.job().run_available()
    assert setup.lines() == [line(i) for i in range(60)]


def test_read_back_without_a_target(spark, tmp_path):
    assert read_back(spark, f"{tmp_path}/nothing").count() == 0
    (tmp_path / "only-header.csv").write_text(",".join(READBACK.names) + "\n")
    assert read_back(spark, f"{tmp_path}/only-header.csv", header=True).count() == 0


def test_nothing_kept_before_the_first_batch(setup):
    job = setup.job()
    assert job.outcomes().count() == job.dead_letters().count() == job.attachment_changes().count() == 0
    assert job.dead_letters().columns[-1] == "commit"


def test_forget_finds_escaped_ids(setup, spark):
    gate = SeenTable(spark, setup.root)
    ids = ["a:b", "purchase/orders", "100%", "plain"]
    gate.mark(spark.createDataFrame([(c, UUIDS[0]) for c in ids], "contract_id string, record_id string"), "c0")
    for c in ids[:3]:
        gate.forget(c)
    assert [r.contract_id for r in gate.seen().collect()] == ["plain"]
    with pytest.raises(KeyError):
        gate.forget("a:b")


def test_upkeep_bounds_the_folders_of_the_seen_set(setup, spark):
    gate = SeenTable(spark, setup.root)
    for i in range(6):
        gate.mark(spark.createDataFrame([("a:b", UUIDS[i]), ("c", UUIDS[i])], "contract_id string, record_id string"), f"c{i}")
        gate.compact_all(f"c{i}")
    assert all(len(gate.folder.names("seen", n)) <= 2 for n in gate.folder.names("seen") if n.startswith("contract_id="))
    assert gate.seen().count() == 12


def test_replay_asks_the_source_for_one_topic(setup):
    asked = []

    def source(spark, pattern=r".*\.created"):
        asked.append(pattern)
        return stream_log(spark, f"{setup.root}/log", pattern)

    setup.send(envelope(0))
    setup.send(envelope(1, "other"), topic="other.created")
    job = setup.job()
    job.source = source
    job.run_available()
    job.gate.forget("interns")
    job.replay("interns.created").run_available()
    assert asked[-1] == r"interns\.created" and sorted(setup.lines()) == [line(0), line(0)]


def test_dead_letter_sink_and_refresh_report(setup):
    setup.send(envelope(0), "{")
    job = setup.job(dead_letters=JsonDeadLetters(f"{setup.root}/letters"))
    job.run_available()
    letters = [json.loads(x) for f in Path(setup.root, "letters").glob("commit=*/part-*") for x in f.read_text().splitlines()]
    assert [(x["originalOffset"], x["originalPayload"], x["replayedAt"]) for x in letters] == [(1, "{", None)]
    setup.rows = (("interns", {**CSV, "path": "moved.csv"}), ("new", CSV))
    job.refresh()
    assert sorted((r.contract_id, r.change) for r in job.attachment_changes().collect()) == [("interns", "changed"), ("new", "attached")]


def test_a_topic_that_appears_later_is_found(setup):
    setup.rows = (("interns", CSV), ("other", {"columns": COLUMNS, "path": "other.csv"}))
    setup.send(envelope(0))
    job = setup.job()
    job.run_available()
    setup.send(envelope(1, "other"), topic="brand-new.created")
    job.run_available()
    assert setup.lines("other.csv") == [line(1)]


@pytest.mark.parametrize("split", [1 << 27, 150])
def test_a_single_file_is_read_by_splits(spark, tmp_path, split):
    """Quoted line feeds and quotes, also where splits end within a record that is longer than several of them."""
    texts = ["plain", "", 'a, "b"', "two\nlines", '\n"\n', "x\r\ny", "é, ü\n" * 50, '""', "tail\n"]
    cell = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\n') else x
    rows = [[f"id{i}", *(texts[(i + k) % len(texts)] for k in range(len(READBACK) - 2)), "at"] for i in range(9)]
    file = tmp_path / "one.csv"
    header = ",".join(["it's 5\"", *(["h"] * (len(READBACK) - 1))])
    file.write_bytes("".join(line + "\n" for line in [header, *(",".join(map(cell, r)) for r in rows)]).encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(split))
        got = read_single_file(spark, str(file))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
