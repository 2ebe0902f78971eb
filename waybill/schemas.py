"""Schemas of the tables this engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT = T.StringType()

# One delivery as it sits on a topic or in a delivery-log table.
LOG = _struct(topic=_TEXT, partition=T.IntegerType(), offset=T.LongType(), key=_TEXT, value=_TEXT)

# (topic, partition, offset) names a delivery uniquely and orders redeliveries.
COORDS = ["topic", "partition", "offset"]

# A record is identified by its contract and its id; copies share both.
RECORD = ["contract_id", "record_id"]

# Envelope fields are read as variants, so that one parse yields both the text and the JSON type. The
# payload keeps every value as raw JSON text, which preserves key order and number text.
ENVELOPE_FIELDS = [
    "recordId", "contractId", "recordType", "schemaVersion", "naturalKey", "occurredAt", "traceId",
]
ENVELOPE = T.StructType(
    [T.StructField(name, T.VariantType()) for name in ENVELOPE_FIELDS]
    + [T.StructField("payload", T.MapType(_TEXT, _TEXT))]
)

# The statically typed reading of an envelope.
TYPED_PAYLOAD = _struct(
    internId=_TEXT, firstName=_TEXT, lastName=_TEXT, email=_TEXT, college=_TEXT, department=_TEXT,
    mentor=_TEXT, startDate=_TEXT, status=_TEXT,
)
STATUSES = ["ACTIVE", "COMPLETED", "WITHDRAWN"]

# Attachment listing. `pos` is the listing position: the first attachment of a contract wins.
ATTACHMENT = _struct(
    pos=T.LongType(), attachment_id=_TEXT, contract_id=_TEXT, adapter_type=_TEXT,
    enabled=T.BooleanType(), config=_TEXT,
)
COLUMNS = T.ArrayType(_struct(header=_TEXT, field=_TEXT))

SEEN = _struct(contract_id=_TEXT, record_id=_TEXT)

# Read-back rows are all text on purpose: reading must not reinterpret what was written.
READBACK = _struct(
    record_id=_TEXT, intern_id=_TEXT, first_name=_TEXT, last_name=_TEXT, email=_TEXT, college=_TEXT,
    department=_TEXT, mentor=_TEXT, start_date=_TEXT, status=_TEXT, created_at=_TEXT,
)

DEAD_LETTER = _struct(
    originalTopic=_TEXT, originalPartition=T.IntegerType(), originalOffset=T.LongType(), originalKey=_TEXT,
    originalPayload=_TEXT, errorType=_TEXT, errorMessage=_TEXT, failedAdapter=_TEXT,
    attemptCount=T.IntegerType(), quarantinedAt=_TEXT, replayed=T.BooleanType(), replayedAt=_TEXT,
)

# What a refresh of the attachments changed.
CHANGES = _struct(contract_id=_TEXT, change=_TEXT, attachment_id=_TEXT, old_config=_TEXT, new_config=_TEXT)

# Staged deliveries (one row per delivery, with texts) and their outcomes (ids and findings only).
_FINDINGS = [("contract_id", _TEXT), ("record_id", _TEXT), ("attachment_id", _TEXT), ("target", _TEXT), ("verdict", _TEXT)]
STAGED = T.StructType(
    [T.StructField(n, LOG[n].dataType) for n in COORDS]
    + [T.StructField(n, t) for n, t in _FINDINGS]
    + [T.StructField(n, _TEXT) for n in ["key", "value", "line", "header", "failure_type", "failure_text"]]
)
OUTCOMES = T.StructType(
    [T.StructField(n, LOG[n].dataType) for n in COORDS]
    + [T.StructField(n, t) for n, t in _FINDINGS]
    + [T.StructField("outcome", _TEXT), T.StructField("error_type", _TEXT), T.StructField("error_message", _TEXT),
       T.StructField("attempts", T.IntegerType())]
)
