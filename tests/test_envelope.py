import pytest
from core import UUIDS, deliveries, envelope

from waybill.checks.derived import ENVELOPE_SCHEMA
from waybill.operators import envelope as E, validation as V
from waybill.plans import delivery as P


SHAPES = [
    (None, "none", ""),
    ("", "other", ""),
    ("  \n", "other", ""),
    ("null", "other", ""),
    ("[1, 2]", "other", ""),
    ('[{"contractId":"x"}]', "other", ""),
    ("5", "other", ""),
    ('"text"', "other", ""),
    ("{ this is not valid json ", "broken", ""),
    ('{"contractId":"c"', "broken", ""),
    ("[1, 2", "broken", ""),
    ("{'contractId':'c'}", "broken", ""),
    ('{"a":NaN,"contractId":"c"}', "broken", ""),
    ('{"contractId":"c",}', "broken", ""),
    ('{"contractId":"c"} junk', "trailing", "c"),
    ('{"contractId":"c"}}', "trailing", "c"),
    ('{"contractId":"c"}]', "trailing", "c"),
    ('{"contractId":"c"},{"contractId":"d"}', "trailing", "c"),
    ('{"contractId":"c","payload":"text"} junk', "trailing", "c"),
    ('{"contractId":"c"}] garbage }', "trailing", "c"),
    ('{"contractId":"c"}] [{"x":1}', "trailing", "c"),
    ('{"contractId":"c"}] }', "trailing", "c"),
    ('{"contractId":"c"},{}] }', "trailing", "c"),
    ('{"contractId":"c"},{"_end":"0"}] }', "trailing", "c"),
    ('{"contractId":"c","_end":"0"}', "object", "c"),
    ('{"contractId":"c"}', "object", "c"),
    (' {"contractId":"c"} \n', "object", "c"),
    ('{"contractId":"c","contractId":"d"}', "object", "d"),
    ('{"contractId":5}', "object", "5"),
    ('{"contractId":null}', "object", "null"),
    ('{"contractId":{"a":1}}', "object", ""),
    ('{"contractId":["a"]}', "object", ""),
    ('{"contractId":"c","payload":"text"}', "object", "c"),
    ('{"contractId":"c","contractId":"d","payload":"text"}', "object", "d"),
    ("{}", "object", ""),
]


def test_shape_and_contract(spark):
    rows = E.project(E.parse(deliveries(spark, [value for value, *_ in SHAPES]))).orderBy("offset").collect()
    assert [(r["value"], r["shape"], r["contract_id"]) for r in rows] == SHAPES


def test_payload_values_keep_key_order_and_number_text(spark):
    payload = '{"o":{"z":1, "b":2.50},"n":1200.50,"e":1e10,"one":1.0,"nul":null,"s":"x","l":[1, 2.0],"t":true}'
    value = envelope(payload=...)[:-1] + f', "payload":{payload}}}'
    got = E.project(E.parse(deliveries(spark, [value]))).first()["payload"]
    assert got == {
        "o": '{"z":1,"b":2.5}', "n": "1200.5", "e": "1.0E10", "one": "1.0", "nul": None, "s": "x", "l": "[1,2.0]",
        "t": "true",
    }


def test_last_value_of_a_repeated_payload_key_wins(spark):
    value = envelope(payload=...)[:-1] + ', "payload":{"a":1,"b":2,"a":3}}'
    assert E.project(E.parse(deliveries(spark, [value]))).first()["payload"] == {"b": "2", "a": "3"}


def test_update_style(spark):
    values = [envelope(recordType=t) for t in ("intern.updated", "intern.created", "updated", "x.updated.y")]
    rows = E.project(E.parse(deliveries(spark, values))).orderBy("offset")
    assert [r[0] for r in rows.select(E.is_update_style(rows.record_type)).collect()] == [True, False, False, False]


def test_typed_envelope_ignores_unknown_fields_and_reports_misfits(spark):
    good = dict(payload={"internId": "I1", "startDate": "2026-09-01", "status": "ACTIVE", "githubHandle": "x"})
    values = [
        envelope(producedBy="new", **good), envelope(recordId="no", **good), envelope(schemaVersion=..., **good),
        envelope(payload={"status": "GONE"}), envelope(payload={"startDate": "2026-02-30"}), "{",
    ]
    rows = E.typed(deliveries(spark, values)).orderBy("offset").collect()
    assert [r["error"] for r in rows] == [None, "recordId", None, "payload.status", "payload.startDate", "value"]
    assert rows[0]["payload"]["internId"] == "I1" and str(rows[0]["payload"]["startDate"]) == "2026-09-01"
    assert rows[2]["schema_version"] == 0


# --- validation ------------------------------------------------------------------------------------------------

def violations(spark, values, schema=ENVELOPE_SCHEMA):
    rules = V.compile_rules(schema)
    rows = V.validate(P.parsed(deliveries(spark, values), rules), rules).orderBy("offset")
    return [r["violations"] for r in rows.collect()]


CHANGES = [
    ({}, []),
    ({"producedBy": {"a": 1}}, []),
    ({"schemaVersion": 1.0}, []),
    ({"traceId": UUIDS[1]}, []),
    ({"traceId": ...}, []),
    ({"payload": {}}, []),
    ({"recordId": ...}, [" required property 'recordId' not found"]),
    ({"recordId": None}, ["/recordId null found, string expected"]),
    ({"recordId": "no"}, ["/recordId is not a valid uuid"]),
    ({"recordId": UUIDS[0].upper()}, []),
    ({"schemaVersion": 0}, ["/schemaVersion must have a minimum value of 1"]),
    ({"schemaVersion": 1.5}, ["/schemaVersion number found, integer expected"]),
    ({"schemaVersion": "1"}, ["/schemaVersion string found, integer expected"]),
    ({"schemaVersion": 10**30}, []),
    ({"naturalKey": ""}, ["/naturalKey must be at least 1 characters long"]),
    ({"naturalKey": 7}, ["/naturalKey integer found, string expected"]),
    ({"occurredAt": "2026-07-21"}, ["/occurredAt is not a valid date-time"]),
    ({"occurredAt": "2026-02-30T10:00:00Z"}, ["/occurredAt is not a valid date-time"]),
    ({"contractId": "Upper"}, ["/contractId does not match the pattern ^[a-z][a-z0-9-]*$"]),
    ({"traceId": 5}, ["/traceId integer found, string or null expected"]),
    ({"payload": "text"}, ["/payload string found, object expected"]),
    ({"payload": None}, ["/payload null found, object expected"]),
    ({"payload": ...}, [" required property 'payload' not found"]),
    ({"payload": [1], "naturalKey": "", "recordId": ...}, [
        " required property 'recordId' not found", "/naturalKey must be at least 1 characters long",
        "/payload array found, object expected"]),
]


def test_violations(spark):
    found = violations(spark, [envelope(**change) for change, _ in CHANGES])
    assert list(zip([c for c, _ in CHANGES], found)) == CHANGES


def test_text_after_the_object_is_a_violation_but_repeated_keys_are_not(spark):
    values = [envelope() + " x", envelope()[:-1] + ', "naturalKey":"again"}']
    assert violations(spark, values) == [[V.NOT_JSON], []]


def test_fields_beyond_the_fixed_envelope_can_be_constrained(spark):
    schema = '{"required":["producer"],"properties":{"producer":{"type":"string","pattern":"^it\'s \\\\d+$"}}}'
    values = [envelope(producer="it's 12"), envelope(producer="x"), envelope()]
    assert violations(spark, values, schema) == [
        [], ["/producer does not match the pattern ^it's \\d+$"], [" required property 'producer' not found"],
    ]


@pytest.mark.parametrize("schema", [
    "", "  ", '{"properties":{"recordId":{"type":"string","enum":["a"]}}}', '{"additionalProperties":false}',
    '{"properties":{"recordId":{"format":"email"}}}', '{"type":"array"}', '{"properties":{"payload":{"minLength":1}}}',
])
def test_what_cannot_be_checked_is_refused(schema):
    with pytest.raises(ValueError):
        V.compile_rules(schema)
