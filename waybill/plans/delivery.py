"""From deliveries to outcomes and lines.

`judge` looks at each delivery on its own and needs no shuffle. `settle` then decides, from ids and coordinates
only, which deliveries are applied, duplicates or quarantined. A job writes the judged deliveries to a table
once and settles from there, so that the JSON is read a single time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from waybill.functions import json_values as J
from waybill.functions.formats import FormatRegistry, default_formats
from waybill.functions.instants import is_instant
from waybill.operators import attachments as A, envelope, gate, validation
from waybill.operators.failures import SCHEMA_VIOLATION, UNCLASSIFIED_FAILURE
from waybill.operators.lookup import fits_broadcast, join_config, join_unique
from waybill.operators.validation import Rule
from waybill.schemas import COORDS, RECORD
from waybill.storage import as_table, new_folder

# What `judge` can find, in order of precedence. Ready records can be written.
TOMBSTONE, BROKEN, UNATTACHED, INVALID = "tombstone", "broken", "unattached", "invalid"
MISCONFIGURED, UNTIMED, READY = "misconfigured", "untimed", "ready"


@dataclass(frozen=True)
class Routing:
    """Configured attachments, one per contract, and the rules and formats to apply."""

    attachments: DataFrame
    rules: list[Rule]
    formats: FormatRegistry = field(default_factory=default_formats)
    broadcast: bool | None = None  # None: the size is checked when it is needed

    @cached_property
    def small(self) -> bool:
        """Whether the attachments may be broadcast; counted once."""
        return fits_broadcast(self.attachments) if self.broadcast is None else self.broadcast

    def join(self, records: DataFrame, *settings: str, how: str = "left") -> DataFrame:
        """Records with some settings of their contract's attachment."""
        chosen = self.attachments.select("contract_id", *settings)
        return join_config(records, chosen, ["contract_id"], COORDS, how, self.small)

    @classmethod
    def from_listing(cls, listing: DataFrame, schema_text: str, default_path: str, **options) -> Routing:
        formats = options.get("formats") or default_formats()
        chosen = A.index(A.active(listing))
        return cls(A.configured(chosen, default_path, formats), validation.compile_rules(schema_text), **options)


def parsed(log: DataFrame, rules: list[Rule]) -> DataFrame:
    """Deliveries with their envelope fields."""
    return envelope.project(envelope.parse(log, validation.extra_fields(rules)))


def route(records: DataFrame, routing: Routing, how: str = "left") -> DataFrame:
    """Records with the attachment of their contract; `how='inner'` drops what is not attached.

    Only short settings come along. What a line is made of is looked up where the line is made, so that it is
    not carried through the steps between.
    """
    return routing.join(records, "attachment_id", "format", "target", "config_error", how=how)


def judge(log: DataFrame, routing: Routing, how: str = "left") -> DataFrame:
    """Adds `verdict`, `violations` and the routing columns to every delivery."""
    routed = route(parsed(log, routing.rules), routing, how)
    checked = validation.validate(
        routed.withColumn("attached", F.col("attachment_id").isNotNull()), routing.rules
    )
    verdict = (
        F.when(F.col("shape") == "none", TOMBSTONE)
        .when(F.col("shape") == "broken", BROKEN)
        .when(~F.col("attached"), UNATTACHED)
        .when(F.size("violations") > 0, INVALID)
        .when(F.col("config_error").isNotNull(), MISCONFIGURED)
        .when(~is_instant(F.col("occurred_at")), UNTIMED)
        .otherwise(READY)
    )
    return checked.withColumn("verdict", verdict)


def with_line(records: DataFrame, routing: Routing, wanted: Column | None = None) -> DataFrame:
    """Adds `line` and `header` to ready records, or to those that `wanted` says are ready."""
    formats = routing.formats
    needs_types = formats.needs_types(F.col("format"))
    ready = F.lit(True) if wanted is None else wanted
    # Once a record: a line looks into it cell by cell, and would read the text again for each.
    typed = J.once(routing.join(records, "cells", "header"), "typed", F.when(ready & needs_types, J.typed_payload(F.col("value"))))
    return (
        typed
        .withColumn("line", F.when(ready, formats.line(F.col("format"))))
        .withColumn("header", F.when(ready, F.col("header")))
        .drop("typed", "cells")
    )


def failure_text() -> Column:
    """Why a delivery is quarantined."""
    return (
        F.when(F.col("verdict") == TOMBSTONE, "the delivery has no value")
        .when(F.col("verdict") == BROKEN, validation.NOT_JSON)
        .when(F.col("verdict") == INVALID, validation.report(F.col("violations")))
        .when(F.col("verdict") == MISCONFIGURED, F.col("config_error"))
        .when(F.col("verdict") == UNTIMED, F.concat(F.lit("'"), "occurred_at", F.lit("' is not an instant")))
    )


def failure_type() -> Column:
    return (
        F.when(F.col("verdict").isin(BROKEN, INVALID), SCHEMA_VIOLATION)
        .when(F.col("verdict").isin(TOMBSTONE, MISCONFIGURED, UNTIMED), UNCLASSIFIED_FAILURE)
    )


# What `settle` looks at: ids, coordinates and findings, but never texts.
NARROW = [*COORDS, *RECORD, "attachment_id", "target", "verdict", "failure_type"]


def staged(log: DataFrame, routing: Routing) -> DataFrame:
    """Everything later steps need, one row per delivery: verdict, routing, line and failure. No shuffle.

    Deliveries of contracts that are not attached keep their coordinates only.
    """
    judged = with_line(judge(log, routing), routing, F.col("verdict") == READY)
    ours = F.col("verdict") != UNATTACHED
    return judged.select(
        *COORDS, *RECORD, "attachment_id", "target", "verdict",
        F.when(ours, F.col("key")).alias("key"),
        F.when(ours, F.col("value")).alias("value"),
        "line", "header",
        failure_type().alias("failure_type"),
        failure_text().alias("failure_text"),
    )


@dataclass(frozen=True)
class TargetFailure:
    """A target that could not be written, after how many attempts, and why."""

    target: str
    error_type: str
    attempts: int
    message: str


def _lost(spark: SparkSession, failures: list[TargetFailure]) -> DataFrame:
    rows = [(f.target, f.error_type, f.attempts, f.message) for f in failures]
    return spark.createDataFrame(rows, "target string, lost_type string, lost_attempts int, lost_message string")


def settle(
    table: DataFrame, seen: gate.Seen, inherited: gate.Inherited | None = None,
    failures: list[TargetFailure] = (), work: str | None = None,
) -> DataFrame:
    """The outcome of every staged delivery: applied, duplicate, unattached or quarantined; exactly one each.

    Adds outcome, error_type, error_message and attempts to the NARROW columns. `table` is read twice, so it should
    be a written table: once for one row a record, written to the folder `work`, and once to give the outcomes back
    to the deliveries. Only ids, coordinates and findings are shuffled. Records for a target in `failures` count as
    not writable; failures are joined as a table, so their number is no matter.
    """
    spark = table.sparkSession
    narrow = join_config(table.select(*NARROW), _lost(spark, failures), ["target"], COORDS)
    checked = F.col("verdict").isin(READY, MISCONFIGURED, UNTIMED)
    writable = (F.col("verdict") == READY) & F.col("lost_type").isNull()
    seen_records = Observation()
    per_record = gate.by_record(narrow.where(checked), writable).observe(seen_records, F.max("deliveries").alias("most"))
    records = as_table(per_record, work or new_folder(spark, "records"))
    decided = gate.decide(records.drop("deliveries"), seen, inherited)
    valid = join_unique(narrow.where(checked), decided, RECORD, COORDS, seen_records.get["most"] or 0)
    rest = narrow.where(~checked).withColumn("outcome", F.when(F.col("verdict") == UNATTACHED, "unattached").otherwise("quarantined"))
    settled = valid.withColumn("outcome", gate.outcome(writable)).drop("first", "before").unionByName(rest)
    quarantine = F.col("outcome") == "quarantined"
    failed = (F.col("verdict") == READY) & F.col("lost_type").isNotNull()
    return settled.withColumns({
        "error_type": F.when(quarantine, F.when(failed, F.col("lost_type")).otherwise(F.col("failure_type"))),
        "error_message": F.when(quarantine & failed, F.col("lost_message")),
        "attempts": F.when(quarantine, F.when(failed, F.col("lost_attempts")).otherwise(F.lit(1))),
    }).drop("failure_type", "lost_type", "lost_attempts", "lost_message")


def pick(table: DataFrame, outcomes: DataFrame, outcome: str, *extra: str) -> DataFrame:
    """Staged deliveries with a given outcome, with their texts; joined on the coordinates, which are unique.

    Of a few outcomes the list is broadcast, if its counted size allows.
    """
    keep = outcomes.where(F.col("outcome") == outcome).select(*COORDS, *extra)
    return table.join(F.broadcast(keep) if fits_broadcast(keep) else keep, COORDS, "inner")


def applied(table: DataFrame, outcomes: DataFrame, target: str | None = None) -> DataFrame:
    """The deliveries to write, with their lines: all, or those of one target. Both tables are laid out by target, and only that part of them is read.

    Most ready deliveries are applied, so those to leave out are the shorter list.
    """
    wanted = F.col("verdict") == READY
    if target is not None:
        wanted = (F.col("target") == target) & wanted
    ready, here = table.where(wanted), outcomes.where(wanted)
    drop = here.where("outcome <> 'applied'").select(*COORDS)
    if fits_broadcast(drop):
        return ready.join(F.broadcast(drop), COORDS, "left_anti")
    return ready.join(here.where("outcome = 'applied'").select(*COORDS), COORDS, "left_semi")


def quarantined(table: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Quarantined deliveries as `failures.dead_letters` expects them."""
    lost = pick(
        table.select(*COORDS, "key", "value", "failure_text"), outcomes, "quarantined",
        *RECORD, "error_type", "error_message", "attempts",
    )
    return lost.withColumn("error_message", F.coalesce("error_message", "failure_text"))


def routed_lines(
    log: DataFrame, routing: Routing, seen: DataFrame, inherited: gate.Inherited | None = None, *extra: str
) -> DataFrame:
    """The lines to write, straight from a log, for one that is read only for its lines.

    The log is read once for each action on the result, and nothing is written in between. A line is shuffled once, by its record, after each task has cut the deliveries of a record
    down to the first one; the shuffled lines also meet the seen-set. Ids of a former store are looked up without contracts: unless they are few, lines are
    shuffled once more for them.
    """
    ready = with_line(judge(log, routing, how="inner").where(F.col("verdict") == READY), routing)
    lines = gate.first_delivery(ready.select(*COORDS, *RECORD, "target", "line", *extra))
    return gate.unseen(lines, seen, inherited)


def target_headers(lines: DataFrame) -> DataFrame:
    """First line of every target, as the first delivery written to it decides; NULL without a header."""
    return lines.groupBy("target").agg(F.min_by("header", F.struct(*COORDS)).alias("header"))
