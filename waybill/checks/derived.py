"""Inputs of the registered queries, derived from the given tables by Spark.

Each input exists as SQL text for Spark and for the checking engine, so both start from the same rows. The
operators themselves are not written here.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

DEFAULT_TARGET = "default.csv"

# Envelope rules used by the queries and tests.
ENVELOPE_SCHEMA = json.dumps({
    "type": "object",
    "required": ["recordId", "contractId", "recordType", "schemaVersion", "naturalKey", "occurredAt", "payload"],
    "properties": {
        "recordId": {"type": "string", "format": "uuid"},
        "contractId": {"type": "string", "pattern": "^[a-z][a-z0-9-]*$"},
        "recordType": {"type": "string", "minLength": 1},
        "schemaVersion": {"type": "integer", "minimum": 1},
        "naturalKey": {"type": "string", "minLength": 1},
        "occurredAt": {"type": "string", "format": "date-time"},
        "traceId": {"type": ["string", "null"], "format": "uuid"},
        "payload": {"type": "object"},
    },
})

_EVENT_COLUMNS = [
    {"header": "user_id", "field": "userId"}, {"header": "amount", "field": "amount"},
    {"header": "note", "field": "note"}, {"header": "flag", "field": "flag"},
    {"header": "props", "field": "props"},
]

# Where the deliveries made from `events` go; `view` is not attached.
EVENT_ATTACHMENTS = [
    (1, "a1", "click", {"path": " ", "columns": _EVENT_COLUMNS}),
    (2, "a2", "purchase", {"format": "json", "path": "purchase.jsonl", "columns": _EVENT_COLUMNS}),
    (3, "a3", "signup", {"format": "xml", "path": "signup.xml", "columns": [
        {"header": "user id", "field": "userId"}, {"header": "1st", "field": "note"},
        {"header": "missing", "field": "nothere"}]}),
    (4, "a4", "error", {"path": "error.csv", "columns": ["userId", {"header": "x"}]}),
    (5, "a5", "purchase", {"path": "second.csv", "columns": _EVENT_COLUMNS}),
]


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one that is read in fewer tasks than there are cores is spread over them first.

    Where tasks are only a few more, row groups may fall to some of them: such a table is spread over more.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores, tasks = spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    if tasks >= 4 * cores:
        return rows
    return rows.repartition(cores if tasks < cores else 4 * cores)


def _select(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    """Runs a Spark SQL text over one given table, which it calls `given`."""
    view = f"waybill_{name}_{abs(hash(sf_dir))}"
    given(spark, sf_dir, name).createOrReplaceTempView(view)
    return spark.sql(sql.replace("FROM given", f"FROM {view}"))


def event_listing(spark: SparkSession) -> DataFrame:
    from waybill.schemas import ATTACHMENT

    rows = [(pos, aid, contract, "csv", True, json.dumps(config)) for pos, aid, contract, config in EVENT_ATTACHMENTS]
    return spark.createDataFrame(rows, ATTACHMENT)


# --- deliveries from `events` --------------------------------------------------------------------------------

_UUID_OF = (
    "concat(substr({h},1,8),'-',substr({h},9,4),'-',substr({h},13,4),'-',substr({h},17,4),'-',substr({h},21,12))"
)


def uuid_of(seed: str) -> str:
    """SQL for a record id made from a text; the same in both engines."""
    return _UUID_OF.format(h=f"md5({seed})")


def _event_values(events: str, duck: bool) -> str:
    """One row per event with its envelope text. The faults by event_id % 101 are part of the input."""
    bs = "\\" if duck else "\\\\"
    at = (
        "strftime(ts,'%Y-%m-%dT%H:%M:%S.%f')" if duck else
        "concat(replace(substr(cast(ts AS string),1,19),' ','T'),'.',rpad(substr(cast(ts AS string),21),6,'0'))"
    )
    text = "varchar" if duck else "string"
    return f"""
  SELECT event_id, event_type, m,
    CASE WHEN m = 14 THEN NULL WHEN m = 16 THEN '[1,2]' ELSE concat('{{',
      CASE WHEN m = 1 THEN '' WHEN m = 2 THEN '"recordId":"no-uuid",'
           WHEN m = 19 THEN concat('"recordId":"', upper(id), '",') ELSE concat('"recordId":"', id, '",') END,
      CASE WHEN m = 20 THEN '' ELSE concat('"contractId":"', event_type, '",') END,
      CASE WHEN m = 8 THEN '"producedBy":{{"name":"x","v":[1,2]}},' ELSE '' END,
      '"recordType":"', event_type, CASE WHEN m = 21 THEN '.updated' ELSE '.created' END, '",',
      CASE WHEN m = 3 THEN '"schemaVersion":0,' WHEN m = 17 THEN '"schemaVersion":"1",'
           WHEN m = 18 THEN '"schemaVersion":1.0,' ELSE '"schemaVersion":1,' END,
      CASE WHEN m = 4 THEN '"naturalKey":"",' ELSE concat('"naturalKey":"EV-', cast(event_id AS {text}), '",') END,
      '"occurredAt":"', CASE WHEN m = 5 THEN substr(stamp,1,10) WHEN m = 11 THEN concat(substr(stamp,1,23),'+05:30')
           WHEN m = 12 THEN concat(stamp,'1234Z') WHEN m = 22 THEN concat(substr(stamp,1,19),'z') ELSE concat(stamp,'Z') END, '",',
      CASE WHEN m = 15 THEN '"traceId":"t",' ELSE '"traceId":null,' END,
      CASE WHEN m = 6 THEN '"payload":"text"' ELSE concat('"payload":{{"userId":', cast(user_id AS {text}),
        ',"amount":', cast(amount AS {text}),
        CASE WHEN m = 9 THEN '' WHEN m = 13 THEN ',"note":null'
             WHEN m = 10 THEN ',"note":"a, {bs}"b{bs}" & <x>"'
             ELSE concat(',"note":"event ', cast(event_id AS {text}), '"') END,
        ',"flag":', CASE WHEN m % 2 = 0 THEN 'true' ELSE 'false' END, ',"props":', props, '}}') END,
      CASE WHEN m = 7 THEN '' WHEN m = 23 THEN '}}] garbage }}' WHEN m = 24 THEN '}}] [{{"x":1}}' WHEN m = 25 THEN '}}] }}' ELSE '}}' END) END AS value
  FROM (SELECT event_id, event_type, user_id, props, cast(value AS decimal(18,2)) AS amount, event_id % 101 AS m,
               {uuid_of("concat('ev:', cast(event_id AS " + text + "))")} AS id, {at} AS stamp
        FROM {events}) AS e"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once on its topic; every tenth is delivered again, some also sit on the dead-letter topic."""
    return _select(spark, sf_dir, "events", f"""
SELECT CASE WHEN c = 2 THEN 'dead-letter' ELSE concat(event_type, '.created') END AS topic,
       cast(event_id % 4 AS int) AS partition, event_id + CASE WHEN c = 1 THEN 1000000000 ELSE 0 END AS offset,
       concat('EV-', cast(event_id AS string)) AS key, value
FROM ({_event_values("given", False)}) AS v
LATERAL VIEW explode(array_compact(array(0, IF(event_id % 10 = 0, 1, NULL), IF(event_id % 500 = 0, 2, NULL)))) AS c
""")


EVENT_LOG = f"""
events_as_values AS ({_event_values("events", True)}),
full_log AS (
  SELECT event_type || '.created' AS topic, cast(event_id % 4 AS int) AS "partition", event_id AS "offset",
         'EV-' || event_id AS key, value FROM events_as_values
  UNION ALL
  SELECT event_type || '.created', cast(event_id % 4 AS int), event_id + 1000000000, 'EV-' || event_id, value
  FROM events_as_values WHERE event_id % 10 = 0
  UNION ALL
  SELECT 'dead-letter', cast(event_id % 4 AS int), event_id, 'EV-' || event_id, value
  FROM events_as_values WHERE event_id % 500 = 0),
log AS (SELECT * FROM full_log WHERE regexp_full_match(topic, '.*\\.created'))"""

# Records applied by earlier runs: those of every seventh event; the former single store knew every eleventh.
_SEEN = "SELECT event_type AS contract_id, {id} AS record_id FROM {events} WHERE event_id % 7 = 0"
_LEGACY = "SELECT {id} AS record_id FROM {events} WHERE event_id % 11 = 0"
_EVENT_ID_SPARK = uuid_of("concat('ev:', cast(event_id AS string))")
_EVENT_ID_DUCK = uuid_of("concat('ev:', cast(event_id AS varchar))")


def event_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "events", _SEEN.format(id=_EVENT_ID_SPARK, events="given"))


def event_seen_by_own_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seen records of the two contracts that had a store of their own before the former one was taken over."""
    return _select(spark, sf_dir, "events", _SEEN.format(id=_EVENT_ID_SPARK, events="given") + " AND event_type IN ('click', 'error')")


def event_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "events", _LEGACY.format(id=_EVENT_ID_SPARK, events="given"))


EVENT_SEEN = "seen AS (" + _SEEN.format(id=_EVENT_ID_DUCK, events="events") + ")"
EVENT_LEGACY = "legacy AS (" + _LEGACY.format(id=_EVENT_ID_DUCK, events="events") + ")"


# --- attachment listing from `customer` ----------------------------------------------------------------------

def _listing(customers: str, duck: bool, changed: bool) -> str:
    """One attachment per customer, about three per contract, with the mistakes that configs come with.

    `changed` gives the listing as it was before: other columns here and there, some contracts not yet listed.
    """
    text = "varchar" if duck else "string"
    key = f"cast(c_custkey AS {text})"
    half = "cast(floor(c_custkey / 3) AS bigint)"
    extra = "CASE WHEN c_custkey % 13 = 0 THEN 'old_name' ELSE 'name' END" if changed else "'name'"
    where = "WHERE c_custkey % 17 <> 0" if changed else "WHERE c_custkey % 19 <> 0"
    return f"""
  SELECT c_custkey AS pos, concat('at-', {key}) AS attachment_id,
    concat(lower(c_mktsegment), CASE WHEN c_custkey % 23 = 0 THEN '/ü ' ELSE '-' END, cast({half} AS {text})) AS contract_id,
    CASE WHEN c_custkey % 31 = 0 THEN 'db' ELSE 'csv' END AS adapter_type, c_custkey % 29 <> 0 AS enabled,
    CASE c_custkey % 37 WHEN 1 THEN NULL WHEN 2 THEN '[1]' WHEN 3 THEN '{{}}' WHEN 4 THEN '{{"columns":{{"header":"a"}}}}'
      WHEN 5 THEN '{{"columns":[]}}'
      WHEN 6 THEN concat('{{"columns":[{{"field":"f","header":"h"}}],"path":"dropped","path":"out/', {key}, '.csv"}}')
      WHEN 7 THEN concat('{{"columns":[{{"field":"f","header":"h, 1"}},{{"field":"g","header":"i"}}],"format":"csv","path":"out/', {key}, '.csv"}}')
      ELSE concat('{{',
        CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '"path":"   ",' WHEN 2 THEN '"path":7,'
             ELSE concat('"path":"out/', {key}, '.txt",') END,
        CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '"format":"json",' WHEN 2 THEN '"format":"xml",'
             WHEN 3 THEN '"format":"CSV",' WHEN 4 THEN '"format":true,' ELSE '"format":"csv",' END,
        '"options":{{"depth":', cast(c_nationkey AS {text}), ',"mode":"', lower(c_mktsegment), '"}},',
        '"columns":["', lower(c_mktsegment), '",{{"header":5,"field":"n"}},{{"header":"h"}},{{"field":"', c_name, '","header":"',
        {extra}, '"}},{{"header":"segment","field":"', c_mktsegment, '"}}]}}') END AS config
  FROM {customers} {where}"""


def customer_listing(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    return _select(spark, sf_dir, "customer", _listing("given", False, changed))


CUSTOMER_LISTING = f"listing AS ({_listing('customer', True, False)})"
CUSTOMER_LISTING_BEFORE = f"listing_before AS ({_listing('customer', True, True)})"


# --- errors from `orders`, typed envelopes and documents -------------------------------------------------------

def _errors(orders: str, duck: bool) -> str:
    """One cause chain per order: one to three errors, outermost first."""
    array = "list_value" if duck else "array"
    text = "varchar" if duck else "string"
    return f"""
  SELECT o_orderkey AS error_id,
    CASE o_orderkey % 13
      WHEN 0 THEN {array}('EnvelopeSchemaViolationException') WHEN 1 THEN {array}('RuntimeException','JsonParseException')
      WHEN 2 THEN {array}('UncheckedIOException','NoSuchFileException') WHEN 3 THEN {array}('ConnectException')
      WHEN 4 THEN {array}('UncheckedIOException','IOException') WHEN 5 THEN {array}('IllegalArgumentException')
      WHEN 6 THEN {array}('RuntimeException','RuntimeException','AccessDeniedException')
      WHEN 7 THEN {array}('JsonMappingException','ConnectException') WHEN 8 THEN {array}('SocketTimeoutException','JsonParseException')
      WHEN 9 THEN {array}('IllegalStateException','EnvelopeSchemaViolationException') WHEN 10 THEN {array}('DateTimeParseException')
      WHEN 11 THEN {array}('FileNotFoundException') ELSE {array}('SomethingElse','EOFException') END AS types,
    {array}(concat('outer ', cast(o_custkey AS {text})), concat('root ', cast(o_orderkey AS {text}))) AS messages
  FROM {orders}"""


def order_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "orders", _errors("given", False))


ORDER_ERRORS = f"errors AS ({_errors('orders', True)})"


def _typed_values(orders: str, duck: bool) -> str:
    """One statically typed envelope per order, some of which do not fit their types."""
    text = "varchar" if duck else "string"
    key = f"cast(o_orderkey AS {text})"
    return f"""
  SELECT concat('IN-', {key}) AS key, concat('{{"recordId":"',
      CASE WHEN o_orderkey % 41 = 1 THEN 'zz' WHEN o_orderkey % 41 = 2 THEN upper(id) ELSE id END,
      '","contractId":"interns","recordType":"intern.created",',
      CASE WHEN o_orderkey % 41 = 3 THEN '' WHEN o_orderkey % 41 = 4 THEN '"schemaVersion":"x",' ELSE '"schemaVersion":2,' END,
      CASE WHEN o_orderkey % 41 = 5 THEN '"producedBy":"new",' ELSE '' END,
      '"naturalKey":"', {key}, '","occurredAt":"', CASE WHEN o_orderkey % 41 = 6 THEN 'soon' ELSE concat(day, 'T10:00:00.5Z') END,
      '","traceId":', CASE WHEN o_orderkey % 41 = 7 THEN concat('"', id, '"') ELSE 'null' END,
      ',"payload":{{"internId":"I', {key}, '","mentor":', CASE WHEN o_orderkey % 41 = 8 THEN 'null' ELSE concat('"', o_orderpriority, '"') END,
      ',"githubHandle":{{"a":[1]}},"startDate":"', CASE WHEN o_orderkey % 41 = 9 THEN '2026-02-30' ELSE day END,
      '","status":"', CASE WHEN o_orderkey % 41 = 10 THEN 'GONE' WHEN o_orderstatus = 'O' THEN 'ACTIVE'
                           WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'WITHDRAWN' END,
      CASE WHEN o_orderkey % 41 = 11 THEN '"}}' ELSE '"}}}}' END) AS value
  FROM (SELECT *, {uuid_of(f"concat('or:', cast(o_orderkey AS {text}))")} AS id, substr(cast(o_orderdate AS {text}),1,10) AS day FROM {orders}) AS o"""


def intern_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "orders", _typed_values("given", False))


INTERN_LOG = f"interns AS ({_typed_values('orders', True)})"


def _times(events: str, duck: bool) -> str:
    """One timestamp text per event: 0 to 9 fraction digits, different offsets, some that are no instant."""
    day = "strftime(ts,'%Y-%m-%dT%H:%M:%S')" if duck else "replace(substr(cast(ts AS string),1,19),' ','T')"
    return f"""
  SELECT event_id, concat(CASE WHEN event_id % 53 = 1 THEN concat('2024-02-30', substr(day,11)) ELSE day END,
    CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.120' WHEN 3 THEN '.000' WHEN 4 THEN '.123456'
      WHEN 5 THEN '.1234567' WHEN 6 THEN '.123456780' ELSE '.000000001' END,
    CASE event_id % 7 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' WHEN 2 THEN '-08:00' WHEN 3 THEN 'z' WHEN 4 THEN '+00:00'
      WHEN 5 THEN '+14:00' ELSE CASE WHEN event_id % 3 = 0 THEN '' ELSE '-00:45' END END) AS stamp
  FROM (SELECT event_id, {day} AS day FROM {events}) AS e"""


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spark, sf_dir, "events", _times("given", False))


EVENT_TIMES = f"times AS ({_times('events', True)})"


# --- deliveries that carry whole texts -------------------------------------------------------------------------

def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a record whose `college` is the whole text."""
    return _select(spark, sf_dir, "documents", f"""
SELECT 'interns.created' AS topic, cast(doc_id % 4 AS int) AS partition, doc_id AS offset, cast(doc_id AS string) AS key,
  to_json(named_struct('recordId', {uuid_of("concat('doc:', cast(doc_id AS string))")}, 'contractId', 'interns',
    'recordType', 'intern.created', 'schemaVersion', 1, 'naturalKey', cast(doc_id AS string), 'occurredAt', '2026-07-21T14:10:00Z',
    'payload', named_struct('internId', concat('D-', cast(doc_id AS string)), 'firstName', lang, 'lastName', source,
      'email', CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat('d', cast(doc_id AS string), '@x.org') END, 'college', text,
      'department', n_chars, 'startDate', '2026-09-01', 'status', 'ACTIVE'))) AS value
FROM given""")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record with its whole HTML."""
    return _select(spark, sf_dir, "pages", f"""
SELECT 'pages.created' AS topic, cast(page_id % 4 AS int) AS partition, page_id AS offset, cast(page_id AS string) AS key,
  to_json(named_struct('recordId', {uuid_of("concat('page:', cast(page_id AS string))")}, 'contractId', 'pages',
    'recordType', 'page.created', 'schemaVersion', 1, 'naturalKey', cast(page_id AS string), 'occurredAt', '2026-07-21T14:10:00.25Z',
    'payload', named_struct('pageId', page_id, 'url', url, 'html', html))) AS value
FROM given""")


def document_routing(spark: SparkSession, fmt: str):
    from waybill.plans.delivery import Routing

    return Routing.from_listing(document_listing(spark, fmt), ENVELOPE_SCHEMA, DEFAULT_TARGET)


def document_listing(spark: SparkSession, fmt: str) -> DataFrame:
    from waybill.schemas import ATTACHMENT, READBACK

    fields = ["internId", "firstName", "lastName", "email", "college", "department", "mentor", "startDate", "status"]
    interns = [{"header": h, "field": f} for h, f in zip(READBACK.names[1:-1], fields)]
    pages = [{"header": "page url", "field": "url"}, {"header": "1st", "field": "pageId"},
             {"header": "html", "field": "html"}, {"header": "no", "field": "nothere"}]
    rows = [
        (i, f"d{i}", contract, "csv", True, json.dumps({"format": fmt, "path": contract, "columns": columns}))
        for i, (contract, columns) in enumerate([("interns", interns), ("pages", pages)])
    ]
    return spark.createDataFrame(rows, ATTACHMENT)
