"""Idempotency: first delivery wins, records already applied are dropped, the seen-set and its migration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from waybill.schemas import COORDS, RECORD

#: All records applied before, or what finds those among the records of a batch.
Seen = DataFrame | Callable[[DataFrame], DataFrame]


def first_delivery(ready: DataFrame) -> DataFrame:
    """The first delivery of every record, whole rows.

    Spark applies the rank filter once per task before the shuffle, so a record delivered very often reaches
    the shuffle as at most one row per task. Rows are sorted for that: by ids first, which differ in their first
    characters, while contracts are few.
    """
    order = Window.partitionBy(*reversed(RECORD)).orderBy(*COORDS)
    return ready.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def first_coords(ready: DataFrame) -> DataFrame:
    """Where the first delivery of every record is; combined per task before the shuffle."""
    return ready.groupBy(*RECORD).agg(F.min(F.struct(*COORDS)).alias("first"))


@dataclass(frozen=True)
class Inherited:
    """Ids of a former store that knew no contracts.

    They count as seen for every contract but the `exempt` ones, which had a store of their own when the old one
    was taken over. The ids are kept once and never copied per contract.
    """

    ids: DataFrame
    exempt: tuple[str, ...] = ()

    def matches(self, records: DataFrame) -> Column:
        return (records["record_id"] == self.ids["record_id"]) & ~records["contract_id"].isin(*self.exempt)


def unseen(records: DataFrame, seen: DataFrame, inherited: Inherited | None = None) -> DataFrame:
    """Records that were not applied before. `records` should hold each record once."""
    fresh = records.join(seen.select(*RECORD), RECORD, "left_anti")
    if inherited is not None:
        fresh = fresh.join(inherited.ids, inherited.matches(fresh), "left_anti")
    return fresh


def known(records: DataFrame, seen: DataFrame, inherited: Inherited | None = None) -> DataFrame:
    """Records that were applied before, with the store that knows them: own or inherited."""
    own = records.join(seen.select(*RECORD), RECORD, "left_semi").withColumn("store", F.lit("own"))
    if inherited is None:
        return own
    rest = records.join(seen.select(*RECORD), RECORD, "left_anti")
    old = rest.join(inherited.ids, inherited.matches(rest), "left_semi").withColumn("store", F.lit("inherited"))
    return own.union(old)


def applied_coords(ready: DataFrame, seen: DataFrame, inherited: Inherited | None = None) -> DataFrame:
    """(contract_id, record_id, topic, partition, offset) of the deliveries to apply: one per new record."""
    return unseen(first_coords(ready), seen, inherited).select(*RECORD, "first.*")


def by_record(rows: DataFrame, writable: Column) -> DataFrame:
    """For every record its first writable delivery, or NULL, and how many deliveries it has; combined per task."""
    first = F.min(F.when(writable, F.struct(*COORDS)))
    return rows.groupBy(*RECORD).agg(first.alias("first"), F.count(F.lit(1)).alias("deliveries"))


def decide(records: DataFrame, seen: Seen, inherited: Inherited | None = None) -> DataFrame:
    """Adds `before`: whether a record was applied earlier. `records` (a table) has each record once.

    The seen-set grows for ever while a batch does not: a batch that Spark finds small enough by its files is
    broadcast, and the seen-set is only read. Else both are shuffled, each record once. A seen-set with an index is
    asked for the batch's records instead.
    """
    ids = records.select(*RECORD)
    own = seen(ids) if callable(seen) else seen.join(ids, RECORD, "left_semi")
    found = known(ids, own, inherited).select(*RECORD).distinct()
    return records.join(found.withColumn("before", F.lit(True)), RECORD, "left").fillna(False, ["before"])


def outcome(writable: Column) -> Column:
    """The outcome of a valid delivery, given `first` and `before` of its record.

    Of the writable deliveries of a record that was not applied before, the first one is applied. One that cannot be
    written is a duplicate if its record was applied before or by an earlier delivery; otherwise it is quarantined.
    """
    here = F.struct(*COORDS)
    later = F.coalesce(F.col("before") | (here > F.col("first")), F.lit(False))
    return (
        F.when(writable & ~F.col("before") & (here == F.col("first")), "applied")
        .when(writable | later, "duplicate").otherwise("quarantined")
    )


def union_seen(seen: DataFrame, applied: DataFrame) -> DataFrame:
    """The seen-set with newly applied records, each record once."""
    return seen.select(*RECORD).union(applied.select(*RECORD)).distinct()


def take_over(seen: DataFrame, legacy: DataFrame) -> Inherited:
    """Takes over a store that knew no contracts; contracts that already have seen records are exempt.

    The contract ids of a seen-set are configuration-sized: they name directories.
    """
    exempt = sorted(r.contract_id for r in seen.select("contract_id").distinct().collect())
    return Inherited(legacy.select("record_id").distinct(), tuple(exempt))
