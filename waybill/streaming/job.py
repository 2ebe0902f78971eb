"""The continuous job: every micro-batch is staged, settled, written, dead-lettered and marked, in this order.

A batch that is repeated after a crash finds its staged table and outcomes and goes on from there: routing and
decisions stay those of the first try, finished writes are skipped and unfinished ones overwritten. So each
record reaches its target once, although marks come after writes.
"""

from __future__ import annotations

import inspect
import logging
import re
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from waybill.functions.formats import FormatRegistry, default_formats
from waybill.operators import attachments as A, failures
from waybill.operators.failures import RetryPolicy
from waybill.operators.validation import compile_rules
from waybill.plans import delivery as P
from waybill.schemas import CHANGES, DEAD_LETTER, OUTCOMES, STAGED
from waybill.storage import Folder
from waybill.streaming.gates import Gate
from waybill.streaming.seen_index import IndexedSeenTable
from waybill.streaming.targets import DeadLetters, Target, TogetherTarget

log = logging.getLogger("waybill")



@dataclass
class Settings:
    default_target: str
    adapter: str = "waybill"
    adapter_type: str = A.ADAPTER_TYPE
    retry: RetryPolicy = field(default_factory=RetryPolicy)
    refresh_seconds: float = 30.0
    parallel_targets: int = 8
    compact_every: int = 16


class DeliveryJob:
    """A delivery job under a name, with its state below `root`.

    source: session -> streaming deliveries; listing: session -> attachment listing; schema_text: the envelope
    schema document.
    """

    def __init__(
        self, spark: SparkSession, name: str, root: str, source: Callable[[SparkSession], DataFrame],
        listing: Callable[[SparkSession], DataFrame], schema_text: str, settings: Settings,
        target: Target | None = None, gate: Gate | None = None, formats: FormatRegistry | None = None,
        dead_letters: DeadLetters | None = None,
    ):
        self.spark, self.name, self.source, self.listing = spark, name, source, listing
        self.schema_text, self.settings = schema_text, settings
        self.folder = Folder(spark, root)
        self.target = target or TogetherTarget(spark, self.folder.path("targets"))
        self.gate = gate or IndexedSeenTable(spark, root)
        self.formats = formats or default_formats()
        self.dead_letter_sink = dead_letters
        self.rules = compile_rules(schema_text)
        self.query: StreamingQuery | None = None
        self.job_id = self._job_id()
        self._snapshot: DataFrame | None = None
        self._snapshot_no, self._loaded_at = 0, 0.0
        self.refresh()

    def _job_id(self) -> str:
        """Kept beside the checkpoint: batch numbers start anew with a new checkpoint, so commits need it."""
        kept = self.folder.read_text("jobs", self.name, "id")
        if kept is None:
            kept = uuid.uuid4().hex[:12]
            self.folder.write_text(kept, "jobs", self.name, "id")
        return kept

    # --- attachments -----------------------------------------------------------------------------------------

    def refresh(self) -> None:
        """Takes a new snapshot of the attachments, as a whole. The first one must succeed; later failures
        keep the last good one. No attachment at all is legal."""
        try:
            listing = self.listing(self.spark)
            if A.null_settings(listing, self.settings.adapter_type).limit(1).count():
                raise ValueError("an attachment has a null setting; the listing is refused")
            rows = A.configured(
                A.index(A.active(listing, self.settings.adapter_type)), self.settings.default_target, self.formats
            )
            path = self.folder.path("attachments", f"{self.job_id}-{self._snapshot_no + 1}")
            rows.write.mode("overwrite").parquet(path)
            fresh = self.spark.read.schema(rows.schema).parquet(path)
            none = fresh.limit(1).count() == 0
        except Exception as error:  # noqa: BLE001 - whatever went wrong, the last good snapshot stays
            if self._snapshot is None:
                raise
            log.warning("attachments could not be refreshed, the last ones stay: %s", error)
            self._loaded_at = time.monotonic()
            return
        if none:
            log.warning("no contract is attached: every record will be skipped")
        if self._snapshot is not None:
            report = self.folder.path("attachment_changes", f"snapshot={self.job_id}-{self._snapshot_no + 1:06d}")
            A.changes(self._snapshot, fresh).write.mode("overwrite").parquet(report)
        self._snapshot, self._loaded_at = fresh, time.monotonic()
        self._snapshot_no += 1
        self.folder.remove("attachments", f"{self.job_id}-{self._snapshot_no - 2}")

    def _routing(self) -> P.Routing:
        if time.monotonic() - self._loaded_at >= self.settings.refresh_seconds:
            self.refresh()
        return P.Routing(self._snapshot, self.rules, self.formats)

    # --- one batch ---------------------------------------------------------------------------------------------

    def commit_of(self, batch_id: int) -> str:
        return f"{self.job_id}-{batch_id:012d}"

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        commit = self.commit_of(batch_id)
        table = self._stage(batch, commit)
        outcomes = self._outcomes(table, commit)
        lost = self._write(table, outcomes, commit)
        if lost:
            outcomes = self._outcomes(table, commit, lost)
        now = datetime.now(timezone.utc).isoformat().replace("+00:00", "Z")
        entries = failures.dead_letters(P.quarantined(table, outcomes), self.settings.adapter, F.lit(now))
        path = self.folder.path("dead_letters", f"commit={commit}")
        entries.write.mode("overwrite").parquet(path)
        if self.dead_letter_sink is not None:
            written = self.spark.read.schema(DEAD_LETTER).parquet(path)
            self.dead_letter_sink.write(failures.dead_letter_json(written), commit)
        self.gate.mark(outcomes.where("outcome = 'applied'"), commit)
        if batch_id > 0:
            # The stream has committed the batch before this one: it will not be repeated.
            self.folder.remove("staged", f"commit={self.commit_of(batch_id - 1)}")
        if batch_id % self.settings.compact_every == self.settings.compact_every - 1 and hasattr(self.gate, "compact_all"):
            self.gate.compact_all(commit)

    def _stage(self, batch: DataFrame, commit: str) -> DataFrame:
        place = ("staged", f"commit={commit}")
        if not self.folder.complete(*place):
            rows = P.staged(batch, self._routing())
            rows.write.mode("overwrite").partitionBy("target").parquet(self.folder.path(*place))
        return batch.sparkSession.read.schema(STAGED).parquet(self.folder.path(*place))

    def _outcomes(self, table: DataFrame, commit: str, lost: list[P.TargetFailure] = ()) -> DataFrame:
        place = ("outcomes", f"commit={commit}")
        if lost or not self.folder.complete(*place):
            work = self.folder.path("work", f"commit={commit}")
            seen = partial(self.gate.known_among, commit=commit) if isinstance(self.gate, IndexedSeenTable) else self.gate.seen(commit)
            rows = P.settle(table, seen, self.gate.inherited(), lost, work)
            rows.write.mode("overwrite").partitionBy("target").parquet(self.folder.path(*place))
            self.folder.remove("work", f"commit={commit}")
        return table.sparkSession.read.schema(OUTCOMES).parquet(self.folder.path(*place))

    def _write(self, table: DataFrame, outcomes: DataFrame, commit: str) -> list[P.TargetFailure]:
        """Writes every target with bounded retry; a target that fails does not stop the others."""
        if isinstance(self.target, TogetherTarget):
            return self._write_together(table, outcomes, commit)
        # The targets of a batch come one by one from an iterator; there are at most as many as attachments.
        targets = outcomes.where("outcome = 'applied'").select("target").distinct()
        with ThreadPoolExecutor(self.settings.parallel_targets) as pool:
            tried = [pool.submit(self._write_one, table, outcomes, t.target, commit) for t in targets.toLocalIterator()]
            return [t.result() for t in tried if t.result() is not None]

    def _write_one(self, table: DataFrame, outcomes: DataFrame, target: str, commit: str) -> P.TargetFailure | None:
        lines = P.applied(table, outcomes, target)
        header = P.target_headers(lines).first().header
        return self._tried(lambda: self.target.write(lines, target, header, commit), target)

    def _write_together(self, table: DataFrame, outcomes: DataFrame, commit: str) -> list[P.TargetFailure]:
        """One job for the headers and one for the lines of all targets, which then get their parts one after the other.

        Header lines are configuration: there are at most as many as attachments.
        """
        lines, done = P.applied(table, outcomes), self.target.finished(commit)
        headers = {r.target: r.header for r in P.target_headers(lines).collect() if r.target not in done}
        if not headers:
            return []
        failed = self._tried(lambda: self.target.stage(lines, commit), "all")
        if failed is not None:
            return [replace(failed, target=target) for target in headers]
        tried = {t: self._tried(lambda: self.target.publish(lines, t, h, commit), t) for t, h in headers.items()}
        self.target.finish([*done, *(t for t, failure in tried.items() if failure is None)], commit)
        return [failure for failure in tried.values() if failure is not None]

    def _tried(self, write: Callable[[], None], target: str) -> P.TargetFailure | None:
        """Does a write, again if that may help, and tells why it did not work in the end."""
        pauses = self.settings.retry.sleeps()
        for attempt in range(1, self.settings.retry.max_attempts + 1):
            try:
                write()
                return None
            except Exception as error:  # noqa: BLE001 - classified below
                retriable = failures.error_class(error) == failures.RETRIABLE
                if not retriable or attempt == self.settings.retry.max_attempts:
                    log.warning("target %s given up after %d attempt(s): %s", target, attempt, error)
                    return P.TargetFailure(
                        target, failures.error_label(error), attempt, failures.error_root_message(error)
                    )
                time.sleep(pauses[attempt - 1] / 1000)
        return None

    # --- running -----------------------------------------------------------------------------------------------

    def _start(self, **trigger) -> StreamingQuery:
        self.query = (
            self.source(self.spark).writeStream.queryName(self.name)
            .option("checkpointLocation", self.folder.path("jobs", self.name, "checkpoint"))
            .trigger(**trigger).foreachBatch(self.run_batch).start()
        )
        return self.query

    def start(self, every: str = "10 seconds") -> StreamingQuery:
        """Runs until paused."""
        return self._start(processingTime=every)

    def run_available(self) -> None:
        """Delivers what is there now and stops."""
        self._start(availableNow=True).awaitTermination()

    def pause(self) -> None:
        """Stops reading; nothing is lost, the checkpoint keeps the place."""
        if self.query is not None:
            self.query.stop()

    def resume(self, every: str = "10 seconds") -> StreamingQuery:
        return self.query if self.status() == "running" else self.start(every)

    def status(self) -> str:
        return "running" if self.query is not None and self.query.isActive else "paused"

    def replay(self, topic: str) -> DeliveryJob:
        """A job that delivers one topic from its start once more, under a name and commits of its own.

        A source that takes a topic pattern is asked for that topic only; what another one gives is filtered.
        Use it after the gate was told to forget the contract; records of other contracts stay duplicates.
        """
        return DeliveryJob(
            self.spark, f"{self.name}-replay-{uuid.uuid4().hex[:8]}", self.folder.root,
            lambda spark: self.source_of(spark, topic), self.listing, self.schema_text,
            self.settings, self.target, self.gate, self.formats, self.dead_letter_sink,
        )

    def source_of(self, spark: SparkSession, topic: str) -> DataFrame:
        if "pattern" in inspect.signature(self.source).parameters:
            return self.source(spark, pattern=re.escape(topic))
        return self.source(spark).where(F.col("topic") == topic)

    # --- what happened -----------------------------------------------------------------------------------------

    def outcomes(self) -> DataFrame:
        """The outcome of every delivery so far, with the commit that handled it."""
        return self._kept("outcomes", OUTCOMES)

    def dead_letters(self) -> DataFrame:
        return self._kept("dead_letters", DEAD_LETTER)

    def attachment_changes(self) -> DataFrame:
        """Which contracts each refresh attached, changed or detached."""
        return self._kept("attachment_changes", CHANGES)

    def _kept(self, name: str, schema: T.StructType) -> DataFrame:
        key = "snapshot" if name == "attachment_changes" else "commit"
        layout = T.StructType([*schema, T.StructField(key, T.StringType())])
        if not self.folder.exists(name):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).parquet(self.folder.path(name))
