from core import COLUMNS, UUIDS, deliveries, envelope, routing
from pyspark.sql import functions as F

from waybill.functions.formats import Format, default_formats
from waybill.functions.instants import canonical_instant
from waybill.functions.json_values import quote
from waybill.functions.text import csv_field, store_name, xml_tag
from waybill.plans import delivery as P


def line(spark, config, **change):
    r = routing(spark, ("interns", config))
    judged = P.judge(deliveries(spark, [envelope(**change)]), r)
    return P.with_line(judged, r).first()


def test_csv(spark):
    row = line(spark, {"columns": COLUMNS})
    assert row["header"] == "record_id,name,score,active,mentor,created_at"
    assert row["line"] == f"{UUIDS[0]},Ada,9.5,true,,2026-07-21T14:10:00Z"


def test_csv_quotes_only_where_needed(spark):
    columns = [{"header": "a, b", "field": k} for k in ("comma", "quote", "line", "cr", "plain", "list")]
    row = line(spark, {"columns": columns}, payload={
        "comma": "x,y", "quote": 'say "hi"', "line": "a\nb", "cr": "a\rb", "plain": " a b ", "list": [1, {"k": "v"}]})
    assert row["header"].startswith("record_id,a, b,a, b")
    assert row["line"] == f'{UUIDS[0]},"x,y","say ""hi""","a\nb",a\rb, a b ,"[1,{{""k"":""v""}}]",2026-07-21T14:10:00Z'


def test_json_keeps_types_and_declares_every_key(spark):
    row = line(spark, {"columns": [*COLUMNS, {"header": "no", "field": "absent"}], "format": "json"})
    assert row["header"] is None
    assert row["line"] == (
        f'{{"record_id":"{UUIDS[0]}","name":"Ada","score":9.5,"active":true,"mentor":null,"no":null,'
        '"created_at":"2026-07-21T14:10:00Z"}'
    )


def test_json_texts_that_look_like_something_else(spark):
    columns = [{"header": k, "field": k} for k in ("n", "t", "o", "e", "c")]
    row = line(spark, {"columns": columns, "format": "json"}, payload={
        "n": "9.5", "t": "true", "o": '{"a":1}', "e": "", "c": 'q"\\\u0001\n/é'})
    assert '"n":"9.5","t":"true","o":"{\\"a\\":1}","e":"","c":"q\\"\\\\\\u0001\\n/é"' in row["line"]


def test_json_repeated_header_keeps_first_place_and_last_value(spark):
    columns = [{"header": "a", "field": "firstName"}, {"header": "b", "field": "active"}, {"header": "a", "field": "score"},
               {"header": "record_id", "field": "firstName"}]
    row = line(spark, {"columns": columns, "format": "json"})
    assert row["line"] == '{"record_id":"Ada","a":9.5,"b":true,"created_at":"2026-07-21T14:10:00Z"}'


def test_json_payload_with_repeated_nested_keys(spark):
    r = routing(spark, ("interns", {"columns": [{"header": k, "field": k} for k in "sno"], "format": "json"}))
    value = envelope(payload=...)[:-1] + ', "payload":{"s":"x","n":5,"o":{"y":1,"y":2}}}'
    row = P.with_line(P.judge(deliveries(spark, [value]), r), r).first()
    assert '"s":"x","n":5,"o":{"y":1,"y":2}' in row["line"]


def test_xml(spark):
    columns = [{"header": "name", "field": "firstName"}, {"header": "order total", "field": "v"}, {"header": "1st", "field": "v"},
               {"header": "", "field": "q"}]
    row = line(spark, {"columns": columns, "format": "xml"}, payload={"firstName": "Ada & <Lovelace>", "v": "v", "q": "\"'"})
    assert row["header"] is None
    assert row["line"] == (
        f"<record><record_id>{UUIDS[0]}</record_id><name>Ada &amp; &lt;Lovelace&gt;</name><order_total>v</order_total>"
        "<_1st>v</_1st><_>&quot;'</_><created_at>2026-07-21T14:10:00Z</created_at></record>"
    )


NAMES = [
    ("a b", "a_b", "a_b"), ("1st", "_1st", "1st"), ("-x", "_-x", "-x"), ("_x", "_x", "_x"), ("", "_", ""),
    ("purchase/orders", "purchase_orders", "purchase_orders"), ("é", "_", "_"), ("a.b-c_d", "a.b-c_d", "a.b-c_d"),
]


def test_names(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES], "n string")
    assert [tuple(r) for r in df.select("n", xml_tag(F.col("n")), store_name(F.col("n"))).collect()] == NAMES


INSTANTS = [
    ("2026-07-21T14:10:00Z", "2026-07-21T14:10:00Z"), ("2026-07-21t14:10:00z", "2026-07-21T14:10:00Z"),
    ("2026-07-21T14:10:00.5Z", "2026-07-21T14:10:00.500Z"), ("2026-07-21T14:10:00.000Z", "2026-07-21T14:10:00Z"),
    ("2026-07-21T14:10:00.123400Z", "2026-07-21T14:10:00.123400Z"), ("2026-07-21T14:10:00.1234567Z", "2026-07-21T14:10:00.123456700Z"),
    ("2026-07-21T14:10:00.000000001Z", "2026-07-21T14:10:00.000000001Z"), ("2026-07-21T01:10:00+05:30", "2026-07-20T19:40:00Z"),
    ("2026-12-31T23:30:00.25-01:00", "2027-01-01T00:30:00.250Z"), ("2016-12-31T23:59:60Z", "2016-12-31T23:59:59Z"),
    ("2026-07-21T14:10:00.0123456789Z", None), ("2026-07-21T14:10:00+19:00", None), ("2026-02-30T00:00:00Z", None),
    ("2026-07-21T24:00:00Z", None), ("2026-07-21", None), ("2026-07-21T14:10:00", None), ("", None),
]


def test_canonical_instant(spark):
    texts = spark.createDataFrame([(t,) for t, _ in INSTANTS], "t string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [tuple(r) for r in texts.select("t", canonical_instant(F.col("t"))).collect()] == INSTANTS
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_quoting_helpers(spark):
    df = spark.createDataFrame([('a"b',), ("[x]",), ("plain",)], "t string")
    assert [r[0] for r in df.select(quote(F.col("t"))).collect()] == ['"a\\"b"', '"[x]"', '"plain"']
    assert [r[0] for r in df.select(csv_field(F.col("t"))).collect()] == ['"a""b"', "[x]", "plain"]


def test_registry_order_duplicates_and_plug_ins(spark):
    formats = default_formats()
    extra = Format("ids", lambda: F.upper("record_id"), lambda: F.lit("ids"), lambda: F.array())
    formats.register(extra)
    formats.register(Format("csv", lambda: F.lit("never"), lambda: F.lit("never"), lambda: F.array()))
    assert formats.available() == ["csv", "json", "xml", "ids"]
    r = routing(spark, ("interns", {"columns": COLUMNS, "format": "ids"}), formats=formats)
    row = P.with_line(P.judge(deliveries(spark, [envelope()]), r), r).first()
    assert (row["line"], row["header"]) == (UUIDS[0].upper(), "ids")
