"""Audits: every delivery has one outcome, every record reached its target exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waybill.schemas import RECORD


def outcome_counts(settled: DataFrame) -> DataFrame:
    """Deliveries per contract, outcome and error type."""
    return settled.groupBy("contract_id", "outcome", "error_type").agg(F.count(F.lit(1)).alias("n"))


def delivery_audit(lines: DataFrame) -> DataFrame:
    """How often each record reached its target."""
    return lines.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("times"))


def reconcile(log: DataFrame, settled: DataFrame) -> DataFrame:
    """Deliveries read against deliveries with an outcome, per topic; `missing` must be 0 everywhere."""
    read = log.groupBy("topic").agg(F.count(F.lit(1)).alias("delivered"))
    done = settled.groupBy("topic").agg(F.count(F.lit(1)).alias("settled"))
    return read.join(done, "topic", "full_outer").select(
        "topic",
        F.coalesce("delivered", F.lit(0)).alias("delivered"),
        F.coalesce("settled", F.lit(0)).alias("settled"),
        (F.coalesce("delivered", F.lit(0)) - F.coalesce("settled", F.lit(0))).alias("missing"),
    )
