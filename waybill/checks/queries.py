"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from waybill.checks import derived as D
from waybill.functions.instants import canonical_instant
from waybill.functions.text import store_name, xml_tag
from waybill.operators import attachments as A, audit, envelope, failures, gate, validation
from waybill.plans import delivery as P
from waybill.schemas import COORDS, LOG, RECORD
from waybill.sources.config import read_listing
from waybill.sources.delivery_log import read_log, stream_log, topic_matches
from waybill.sources.stores import import_ids, read_back, read_single_file
from waybill.storage import as_table, new_folder
from waybill.streaming.job import DeliveryJob, Settings
from waybill.streaming.seen_index import IndexedSeenTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- shared inputs -------------------------------------------------------------------------------------------

def _log(spark: SparkSession, sf: str) -> DataFrame:
    return D.event_log(spark, sf).where(topic_matches())


def _rules() -> list[validation.Rule]:
    return validation.compile_rules(D.ENVELOPE_SCHEMA)


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return P.parsed(_log(spark, sf), _rules())


def _routing(spark: SparkSession) -> P.Routing:
    return P.Routing.from_listing(D.event_listing(spark), D.ENVELOPE_SCHEMA, D.DEFAULT_TARGET)


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    """Valid records of attached contracts, ids and coordinates only."""
    judged = P.judge(_log(spark, sf), _routing(spark), "inner")
    return judged.where(F.size("violations") == 0).select(*COORDS, *RECORD)


def _writable(spark: SparkSession, sf: str) -> DataFrame:
    """Records that can be written, ids and coordinates only."""
    return P.judge(_log(spark, sf), _routing(spark), "inner").where(F.col("verdict") == P.READY).select(*COORDS, *RECORD)


def _staged(spark: SparkSession, sf: str, *texts: str) -> DataFrame:
    """Staged deliveries with what settling looks at, and the texts that are asked for; a line that no one reads is not made."""
    return as_table(P.staged(_log(spark, sf), _routing(spark)).select(*P.NARROW, *texts), new_folder(spark, "staged"))


def _settled(spark: SparkSession, sf: str) -> DataFrame:
    return P.settle(_staged(spark, sf), D.event_seen(spark, sf))


def _lines(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    return P.routed_lines(_log(spark, sf), _routing(spark), D.event_seen(spark, sf), None, *extra)


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    return A.active(D.customer_listing(spark, sf))


def _configured(spark: SparkSession, sf: str) -> DataFrame:
    return A.configured(_listed(spark, sf), D.DEFAULT_TARGET)


# --- sources -------------------------------------------------------------------------------------------------

@query
def topic_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "log")
    D.event_log(spark, sf).write.partitionBy("topic").parquet(path)
    return read_log(spark, path).select(*LOG.names)


@query
def attachments_active(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "listing")
    D.customer_listing(spark, sf).write.json(path)
    return A.active(read_listing(spark, path)).select("pos", "attachment_id", "contract_id")


@query
def seen_import(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "ids")
    padded = F.expr("CASE event_id % 3 WHEN 0 THEN concat('  ', upper(id), ' ') WHEN 1 THEN id ELSE concat(id, '\\n \\n') END")
    events = D.given(spark, sf, "events")
    events.select("event_id", F.expr(D.uuid_of("concat('ev:', cast(event_id AS string))")).alias("id")).select(
        padded.alias("value")
    ).write.text(path)
    return import_ids(spark, path)


def _delivered_documents(spark: SparkSession, sf: str) -> tuple[DeliveryJob, str]:
    """A job that has delivered every document as CSV, and its target."""
    root = new_folder(spark, "documents-job")
    D.document_log(spark, sf).write.parquet(f"{root}/log")
    job = DeliveryJob(
        spark, "documents", root, lambda s: stream_log(s, f"{root}/log"), lambda s: D.document_listing(s, "csv"), D.ENVELOPE_SCHEMA,
        Settings(D.DEFAULT_TARGET),
    )
    job.run_available()
    return job, "interns"


@query
def csv_readback(spark: SparkSession, sf: str) -> DataFrame:
    job, target = _delivered_documents(spark, sf)
    return read_back(spark, job.target.path(target))


@query
def single_file_export(spark: SparkSession, sf: str) -> DataFrame:
    """The delivered target as one file with its header line, read as a file with a header, split by split."""
    job, target = _delivered_documents(spark, sf)
    file = f"{job.folder.root}/export/interns.csv"
    job.target.export_single_file(target, file)
    return read_single_file(spark, file)


# --- reading envelopes ---------------------------------------------------------------------------------------

@query
def parse_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.parse(_log(spark, sf)).select(*COORDS, "shape")


@query
def envelope_project(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        *COORDS, *RECORD, "record_type", "natural_key", "occurred_at",
        F.col("payload")["amount"].alias("amount"), F.col("payload")["props"].alias("props"),
    )


@query
def record_style(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(*COORDS, envelope.is_update_style(F.col("record_type")).alias("is_update"))


@query
def typed_project(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.typed(D.intern_log(spark, sf)).select(
        "key", "record_id", "contract_id", "schema_version", "occurred_at", "trace_id",
        F.col("payload.internId").alias("intern_id"), F.col("payload.mentor").alias("mentor"),
        F.col("payload.startDate").cast("string").alias("start_date"), F.col("payload.status").alias("status"), "error",
    )


# --- validation ----------------------------------------------------------------------------------------------

@query
def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    return validation.validate(_parsed(spark, sf), _rules()).select(
        *COORDS, F.size("violations").alias("n"), F.array_join("violations", "; ").alias("violations")
    )


@query
def violation_counts(spark: SparkSession, sf: str) -> DataFrame:
    checked = validation.validate(_parsed(spark, sf), _rules())
    return (
        checked.select("contract_id", F.explode("violations").alias("violation"))
        .groupBy("contract_id", "violation").agg(F.count(F.lit(1)).alias("n"))
    )


# --- attachments ---------------------------------------------------------------------------------------------

@query
def attachment_config(spark: SparkSession, sf: str) -> DataFrame:
    config = F.try_parse_json("config")
    options = A.config_map(config, "options")
    return _listed(spark, sf).select(
        "attachment_id",
        A.config_string(config, "path", "none").alias("path"),
        A.config_string(config, "format", "csv").alias("format"),
        F.size(options).alias("n_options"), options["depth"].alias("depth"), options["mode"].alias("mode"),
        F.size(A.config_list(config, "columns")).alias("n_entries"),
    )


@query
def target_path(spark: SparkSession, sf: str) -> DataFrame:
    return _configured(spark, sf).select("attachment_id", "target")


@query
def format_route(spark: SparkSession, sf: str) -> DataFrame:
    return _configured(spark, sf).select(
        "attachment_id", "format", P.default_formats().knows(F.col("format")).alias("known"), "header"
    )


@query
def config_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _configured(spark, sf).where("config_error IS NOT NULL").select("attachment_id", "contract_id", "config_error")


@query
def descriptor_errors(spark: SparkSession, sf: str) -> DataFrame:
    return A.descriptor_errors(_listed(spark, sf)).select(
        "attachment_id", F.array_join("problems", "; ").alias("problems")
    )


@query
def attachment_index(spark: SparkSession, sf: str) -> DataFrame:
    return A.index(_listed(spark, sf)).select("contract_id", "attachment_id", "pos")


@query
def attachment_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return A.conflicts(_listed(spark, sf))


@query
def attachment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return A.summary(_listed(spark, sf))


@query
def attachment_changes(spark: SparkSession, sf: str) -> DataFrame:
    before = A.index(A.active(D.customer_listing(spark, sf, changed=True)))
    return A.changes(before, A.index(_listed(spark, sf))).select("contract_id", "change", "attachment_id")


@query
def store_names(spark: SparkSession, sf: str) -> DataFrame:
    return _listed(spark, sf).select("attachment_id", store_name(F.col("contract_id")).alias("store"))


# --- routing -------------------------------------------------------------------------------------------------

@query
def contract_join(spark: SparkSession, sf: str) -> DataFrame:
    return P.route(_parsed(spark, sf), _routing(spark)).select(*COORDS, "contract_id", "attachment_id", "target")


@query
def contract_semi(spark: SparkSession, sf: str) -> DataFrame:
    return P.route(_parsed(spark, sf), _routing(spark), "inner").select(*COORDS, "contract_id")


@query
def contract_anti(spark: SparkSession, sf: str) -> DataFrame:
    return P.route(_parsed(spark, sf), _routing(spark)).where("attachment_id IS NULL").select(*COORDS, "contract_id")


@query
def dynamic_project(spark: SparkSession, sf: str) -> DataFrame:
    routing = _routing(spark)
    judged = P.judge(_log(spark, sf), routing, "inner").where(F.size("violations") == 0)
    return routing.join(judged, "columns").select(*COORDS, "record_id", "payload", F.posexplode("columns").alias("pos", "c")).select(
        *COORDS, "record_id", "pos", F.col("c.header").alias("header"),
        F.coalesce(F.col("payload")[F.col("c.field")], F.lit("")).alias("value"),
    )


# --- formats -------------------------------------------------------------------------------------------------

@query
def canonical_time(spark: SparkSession, sf: str) -> DataFrame:
    return D.event_times(spark, sf).select("event_id", canonical_instant(F.col("stamp")).alias("instant"))


@query
def xml_tags(spark: SparkSession, sf: str) -> DataFrame:
    return D.given(spark, sf, "pages").select(
        "page_id", xml_tag(F.col("url")).alias("url_tag"), xml_tag(F.col("page_id").cast("string")).alias("id_tag")
    )


def _document_lines(spark: SparkSession, log: DataFrame, fmt: str) -> DataFrame:
    routing = D.document_routing(spark, fmt)
    ready = P.judge(log, routing, "inner").where(F.col("verdict") == P.READY)
    return P.with_line(ready, routing).select(*RECORD, "line", "header")


@query
def csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _document_lines(spark, D.document_log(spark, sf), "csv")


@query
def jsonl_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _document_lines(spark, D.document_log(spark, sf), "json")


@query
def xml_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _document_lines(spark, D.page_log(spark, sf), "xml")


# --- idempotency ---------------------------------------------------------------------------------------------

@query
def first_delivery(spark: SparkSession, sf: str) -> DataFrame:
    return gate.first_delivery(_writable(spark, sf))


@query
def unseen_records(spark: SparkSession, sf: str) -> DataFrame:
    return gate.applied_coords(_valid(spark, sf), D.event_seen(spark, sf)).select(*RECORD)


@query
def unseen_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a seen-set with buckets and Bloom blocks, marked by two commits; a third one's own marks do not count."""
    store = IndexedSeenTable(spark, new_folder(spark, "seen"))
    seen, half = D.event_seen(spark, sf), F.pmod(F.xxhash64("record_id"), F.lit(2))
    for commit in (0, 1):
        store.mark(seen.where(half == commit), f"c{commit}")
    records = as_table(_valid(spark, sf).select(*RECORD).distinct(), new_folder(spark, "asked"))
    store.mark(records, "own")
    return gate.unseen(records, store.known_among(records, "own"))


@query
def seen_union(spark: SparkSession, sf: str) -> DataFrame:
    return gate.union_seen(D.event_seen(spark, sf), _settled(spark, sf).where("outcome = 'applied'"))


@query
def seen_migrate(spark: SparkSession, sf: str) -> DataFrame:
    """Which records of the log a migrated seen-set knows. Only `click` and `error` had a store of their own."""
    seen = D.event_seen_by_own_stores(spark, sf)
    inherited = gate.take_over(seen, D.event_legacy(spark, sf))
    return gate.known(_valid(spark, sf).select(*RECORD).distinct(), seen, inherited)


# --- failures ------------------------------------------------------------------------------------------------

@query
def classify_failures(spark: SparkSession, sf: str) -> DataFrame:
    chain = failures.lineages(F.col("types"))
    return D.order_errors(spark, sf).select("error_id", failures.classify(chain).alias("classification"))


@query
def error_labels(spark: SparkSession, sf: str) -> DataFrame:
    chain = failures.lineages(F.col("types"))
    return D.order_errors(spark, sf).select(
        "error_id", failures.label(chain).alias("error_type"),
        failures.root_message(F.col("messages")).alias("error_message"),
    )


# --- whole deliveries ----------------------------------------------------------------------------------------

@query
def routed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(*COORDS, *RECORD, "target", "line")


def _job(spark: SparkSession, sf: str) -> DeliveryJob:
    """A job that has delivered the whole event log, in two micro-batches: the log grows by half of its topic partitions and is read on.

    A topic partition comes whole in one batch, in as many files as tasks have written it. So work is not bound to the few partitions.
    """
    root = new_folder(spark, "job")
    gate = IndexedSeenTable(spark, root)
    gate.mark(D.event_seen(spark, sf), "before")
    job = DeliveryJob(
        spark, "events", root, lambda s: stream_log(s, f"{root}/log"), D.event_listing,
        D.ENVELOPE_SCHEMA, Settings(D.DEFAULT_TARGET), gate=gate,
    )
    for half in (0, 1):
        D.event_log(spark, sf).where(F.col("partition") % 2 == half).write.mode("append").parquet(f"{root}/log")
        job.run_available()
    return job


def _delivered(job: DeliveryJob) -> DataFrame:
    """Every line of every target as it was written: target, place in the target's files, line, and whose it is."""
    at = F.struct("commit", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    targets = job.target.folder.names()
    parts = [
        job.spark.read.schema("value string, commit string").text(job.target.path(t), pathGlobFilter="part-*").select(F.lit(t).alias("target"), at.alias("at"), F.col("value").alias("line"))
        for t in targets
    ]
    lines = functools.reduce(DataFrame.union, parts)
    record = F.regexp_extract("line", "([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)
    applied = job.outcomes().where("outcome = 'applied'").select(*COORDS, *RECORD, F.col("target").alias("_target"))
    whose = (F.col("target") == F.col("_target")) & (record == F.col("record_id"))
    return lines.join(applied, whose, "left").drop("_target")


@query
def delivered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """What the targets hold after the job, and the place of each line among those of its topic partition there."""
    order = Window.partitionBy("target", "topic", "partition").orderBy("at")
    return _delivered(_job(spark, sf)).select("target", "topic", "partition", F.row_number().over(order).alias("pos"), "contract_id", "record_id", "line")


@query
def target_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The header that each target was given by the first commit."""
    job = _job(spark, sf)
    rows = [(t, job.target.header(t)) for t in job.target.folder.names()]
    return spark.createDataFrame(rows, "target string, header string")


@query
def delivery_audit(spark: SparkSession, sf: str) -> DataFrame:
    """How often each record is in its target after the job."""
    return audit.delivery_audit(_delivered(_job(spark, sf)))


@query
def delivery_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return _settled(spark, sf).select(*COORDS, *RECORD, "outcome", "error_type", "attempts")


@query
def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.outcome_counts(_settled(spark, sf))


@query
def delivery_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return audit.reconcile(_log(spark, sf), _settled(spark, sf))


@query
def dlq_entries(spark: SparkSession, sf: str) -> DataFrame:
    table = _staged(spark, sf, "key", "value", "failure_text")
    lost = P.quarantined(table, P.settle(table, D.event_seen(spark, sf)))
    return failures.dead_letters(lost, "waybill", F.lit(None)).drop("quarantinedAt", "replayedAt")


@query
def streamed_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return audit.outcome_counts(_job(spark, sf).outcomes())


@query
def streamed_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """The dead letters of the job, as written."""
    return _job(spark, sf).dead_letters().drop("quarantinedAt", "replayedAt", "commit")
