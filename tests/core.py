"""What tests of the delivery engine share. A module of its own: a name like conftest is taken by whichever folder was collected last."""

from __future__ import annotations

import json

from waybill.checks import derived as D
from waybill.plans.delivery import Routing
from waybill.schemas import ATTACHMENT, LOG

UUIDS = [f"00000000-0000-4000-8000-{i:012d}" for i in range(100)]


def envelope(i: int = 0, contract: str = "interns", **changes) -> str:
    """An envelope like those on the topics; a value of ... drops the field."""
    fields = {
        "recordId": UUIDS[i], "contractId": contract, "recordType": "intern.created", "schemaVersion": 1,
        "naturalKey": f"K{i}", "occurredAt": "2026-07-21T14:10:00Z", "traceId": None,
        "payload": {"firstName": "Ada", "score": 9.5, "active": True, "college": "X, Y", "mentor": None},
    }
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def deliveries(spark, values, topic: str = "interns.created", start: int = 0):
    rows = [(topic, 0, start + i, f"k{i}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LOG)


COLUMNS = [{"header": "name", "field": "firstName"}, {"header": "score", "field": "score"},
           {"header": "active", "field": "active"}, {"header": "mentor", "field": "mentor"}]


def listing(spark, *attachments):
    """Attachments as (contract, config)."""
    rows = [
        (i, f"a{i}", contract, "csv", True, config if isinstance(config, str) else json.dumps(config))
        for i, (contract, config) in enumerate(attachments)
    ]
    return spark.createDataFrame(rows, ATTACHMENT)


def routing(spark, *attachments, **options) -> Routing:
    return Routing.from_listing(listing(spark, *attachments), D.ENVELOPE_SCHEMA, "default.csv", **options)
