"""Reading envelopes: parse outcome, envelope columns, typed envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from waybill.functions import json_values as J
from waybill.functions.instants import canonical_instant, is_date_time
from waybill.schemas import STATUSES, TYPED_PAYLOAD

UUID = "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def parse(log: DataFrame, extra_fields: list[str] = ()) -> DataFrame:
    """Adds `shape` and `env`; `extra_fields` are envelope fields to read beyond the fixed ones.

    shape: 'none' (no value), 'object', 'other' (valid JSON that is no object, or empty text),
    'trailing' (an object followed by more text) or 'broken'. The text is parsed once; only texts that are not
    exactly one object are looked at again.
    """
    value = F.col("value")
    schema = J.envelope_type(extra_fields)
    read = J.once(log, "_read", F.from_json(J.wrapped(value), T.ArrayType(schema), J.STRICT))
    first = F.get(F.col("_read"), F.lit(0))
    clean = J.is_whole(F.col("_read"), value)
    # The rest is looked at only where the text is not one object.
    loose = F.from_json(
        value, "contractId variant, _bad string", {**J.STRICT, "columnNameOfCorruptRecord": "_bad"}
    )
    # A non-object root counts as unreadable there; it is still valid JSON if some other reading takes it.
    readable = F.try_parse_json(value).isNotNull() | F.from_json(value, "array<string>", J.STRICT).isNotNull()
    trailing = loose.isNotNull() & loose["_bad"].isNull()
    shape = (
        F.when(value.isNull(), "none")
        .when(clean, "object")
        .when(loose.isNull(), "other")
        .when(trailing, "trailing")
        .when(readable, "other")
        .otherwise("broken")
    )
    # For a text with something after its object, only the contract is read.
    head = F.struct(*[
        (loose["contractId"] if f.name == "contractId" else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])
    return read.select(*log.columns, shape.alias("shape"), F.when(clean, first).when(trailing, head).alias("env"))


def project(parsed: DataFrame) -> DataFrame:
    """Envelope fields as text ('' when absent) and the payload as a map of raw values."""
    env = F.col("env")

    def text(name: str) -> Column:
        # Never NULL, and known as such: no join adds a NULL check that would read the envelope once more.
        return F.coalesce(J.scalar_text(env[name]), F.lit(""))

    return parsed.withColumns({
        "contract_id": text("contractId"),
        "record_id": F.lower(text("recordId")),
        "record_type": text("recordType"),
        "natural_key": text("naturalKey"),
        "occurred_at": text("occurredAt"),
        "payload": J.last_wins(env["payload"]),
    })


def is_update_style(record_type: Column) -> Column:
    return record_type.endswith(".updated")


def typed(log: DataFrame) -> DataFrame:
    """Envelopes bound to static types, extra fields ignored; a value that does not fit its type sets `error`.

    `error` names the first field that does not fit, in declaration order.
    """
    texts = (
        "recordId string, contractId string, recordType string, schemaVersion string, naturalKey string, "
        "occurredAt string, traceId string, payload struct<"
        + ",".join(f"{f.name}:string" for f in TYPED_PAYLOAD) + ">"
    )
    read = J.once(log, "_read", F.from_json(J.wrapped(F.col("value")), f"array<struct<{_colons(texts)},{J.END}:string>>", J.STRICT))
    read = read.withColumn("_t", F.when(J.is_whole(F.col("_read"), F.col("value")), F.get("_read", F.lit(0))))
    t, p = F.col("_t"), F.col("_t")["payload"]

    def misfit(value: Column, fits: Column) -> Column:
        return value.isNotNull() & ~F.coalesce(fits, F.lit(False))

    error = (
        F.when(t.isNull(), "value")
        .when(misfit(t["recordId"], t["recordId"].rlike(UUID)), "recordId")
        .when(misfit(t["schemaVersion"], t["schemaVersion"].try_cast("int").isNotNull()), "schemaVersion")
        .when(misfit(t["occurredAt"], is_date_time(t["occurredAt"])), "occurredAt")
        .when(misfit(t["traceId"], t["traceId"].rlike(UUID)), "traceId")
        .when(misfit(p["startDate"], p["startDate"].rlike(r"^\d{4}-\d{2}-\d{2}$") & p["startDate"].try_cast("date").isNotNull()), "payload.startDate")
        .when(misfit(p["status"], p["status"].isin(STATUSES)), "payload.status")
    )
    return read.withColumn("error", error).select(
        *log.columns,
        F.lower(t["recordId"]).alias("record_id"),
        t["contractId"].alias("contract_id"),
        t["recordType"].alias("record_type"),
        # A missing number reads as 0, as a plain integer does.
        F.when(t.isNotNull(), F.coalesce(t["schemaVersion"], F.lit("0")).try_cast("int")).alias("schema_version"),
        t["naturalKey"].alias("natural_key"),
        canonical_instant(t["occurredAt"]).alias("occurred_at"),
        F.lower(t["traceId"]).alias("trace_id"),
        F.struct(*[
            (p[f.name].try_cast("date") if f.name == "startDate" else p[f.name]).alias(f.name)
            for f in TYPED_PAYLOAD
        ]).alias("payload"),
        "error",
    )


def _colons(ddl: str) -> str:
    """'a string, b string' -> 'a:string,b:string', the form used inside struct<>."""
    return ",".join(part.strip().replace(" ", ":", 1) for part in ddl.split(", "))
