"""The registered queries once more, as SQL over the given tables, written apart from the operators."""

from __future__ import annotations

from waybill.checks import derived as D

C = 'topic, "partition", "offset"'

# --- building blocks -----------------------------------------------------------------------------------------


def _kind(path: str) -> str:
    """JSON type name of a field of the envelope `o`."""
    t = f"json_type(o, '$.{path}')"
    return (
        f"CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'VARCHAR' THEN 'string' WHEN {t} = 'NULL' THEN 'null' "
        f"WHEN {t} = 'DOUBLE' THEN CASE WHEN cast(json_extract_string(o, '$.{path}') AS double) = "
        f"floor(cast(json_extract_string(o, '$.{path}') AS double)) THEN 'integer' ELSE 'number' END "
        f"WHEN {t} IN ('UBIGINT', 'BIGINT') THEN 'integer' ELSE lower({t}) END"
    )


FIELDS = ["recordId", "contractId", "recordType", "schemaVersion", "naturalKey", "occurredAt", "traceId", "payload"]

# A text that goes on after its envelope: what comes before the bracket is one.
_HEAD = r"^(.*\}\})\] (garbage \}|\[\{" + '"x":1' + r"\}|\})$"

ENVELOPES = f"""{D.EVENT_LOG},
docs AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS doc,
  nullif(regexp_extract(value, '{_HEAD}', 1), '') AS head FROM log),
objects AS (SELECT *, CASE WHEN json_type(doc) = 'OBJECT' THEN doc END AS o FROM docs),
envelopes AS (
  SELECT {C}, key, value, doc, o,
    CASE WHEN value IS NULL THEN 'none' WHEN doc IS NULL AND json_valid(head) THEN 'trailing' WHEN doc IS NULL THEN 'broken' WHEN o IS NULL THEN 'other' ELSE 'object' END AS shape,
    coalesce(json_extract_string(coalesce(o, CASE WHEN doc IS NULL AND json_valid(head) THEN head END), '$.contractId'), '') AS contract_id,
    lower(coalesce(json_extract_string(o, '$.recordId'), '')) AS record_id,
    coalesce(json_extract_string(o, '$.recordType'), '') AS record_type,
    coalesce(json_extract_string(o, '$.naturalKey'), '') AS natural_key,
    coalesce(json_extract_string(o, '$.occurredAt'), '') AS occurred_at,
    {", ".join(f"{_kind(f)} AS k_{f}" for f in FIELDS)}
  FROM objects)"""


def _type_rule(field: str, expected: str) -> str:
    allowed = ", ".join(f"'{t}'" for t in expected.split(" or "))
    return (f"CASE WHEN k_{field} NOT IN ('missing', {allowed}) THEN '/{field} ' || k_{field} || "
            f"' found, {expected} expected'")


_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _rules() -> str:
    """Violations in the order in which their texts sort."""
    required = [f"CASE WHEN k_{f} = 'missing' THEN ' required property ''{f}'' not found' END"
                for f in sorted(set(FIELDS) - {"traceId"})]
    stamp = "json_extract_string(o, '$.occurredAt')"
    checks = [
        _type_rule("contractId", "string") + " WHEN k_contractId = 'string' AND NOT regexp_matches(contract_id, '^[a-z][a-z0-9-]*$') "
        "THEN '/contractId does not match the pattern ^[a-z][a-z0-9-]*$' END",
        _type_rule("naturalKey", "string") + " WHEN k_naturalKey = 'string' AND natural_key = '' "
        "THEN '/naturalKey must be at least 1 characters long' END",
        _type_rule("occurredAt", "string") + f" WHEN k_occurredAt = 'string' AND (try_cast(substr({stamp}, 1, 10) AS date) IS NULL OR NOT "
        f"regexp_matches({stamp}, '^[0-9-]{{10}}[Tt][0-9][0-9]:[0-9][0-9]:[0-9][0-9]([.][0-9]+)?([Zz]|[+-][0-9][0-9]:[0-9][0-9])$')) "
        "THEN '/occurredAt is not a valid date-time' END",
        _type_rule("payload", "object") + " END",
        _type_rule("recordId", "string") + f" WHEN k_recordId = 'string' AND NOT regexp_matches(record_id, '{_UUID}') "
        "THEN '/recordId is not a valid uuid' END",
        _type_rule("recordType", "string") + " WHEN k_recordType = 'string' AND record_type = '' "
        "THEN '/recordType must be at least 1 characters long' END",
        _type_rule("schemaVersion", "integer") + " WHEN k_schemaVersion = 'integer' AND "
        "cast(json_extract_string(o, '$.schemaVersion') AS double) < 1 THEN '/schemaVersion must have a minimum value of 1' END",
        _type_rule("traceId", "string or null") + f" WHEN k_traceId = 'string' AND NOT regexp_matches(json_extract_string(o, '$.traceId'), '{_UUID}') "
        "THEN '/traceId is not a valid uuid' END",
    ]
    return ",\n      ".join(required + checks)


VALIDATED = f"""{ENVELOPES},
listed_problems AS (
  SELECT *, [
      {_rules()}] AS found FROM envelopes),
validated AS (
  SELECT * EXCLUDE (found),
    CASE WHEN shape = 'object' THEN coalesce(array_to_string(found, '; '), '')
         WHEN shape = 'other' THEN ' the envelope is not an object' ELSE 'not valid JSON' END AS violations,
    CASE WHEN shape <> 'object' THEN 1 ELSE list_count(found) END AS n
  FROM listed_problems)"""

# The attached contracts with what the configuration amounts to.
ROUTES = """
routes(contract_id, attachment_id, format, target, config_error) AS (VALUES
  ('click', 'a1', 'csv', 'default.csv', NULL), ('purchase', 'a2', 'json', 'purchase.jsonl', NULL),
  ('signup', 'a3', 'xml', 'signup.xml', NULL),
  ('error', 'a4', 'csv', 'error.csv', 'attachment a4 for contract ''error'' has no usable columns'))"""

JUDGED = f"""{VALIDATED},{ROUTES},
judged AS (
  SELECT v.*, r.attachment_id, r.format, r.target, r.config_error,
    CASE WHEN shape = 'none' THEN 'tombstone' WHEN shape = 'broken' THEN 'broken' WHEN r.attachment_id IS NULL THEN 'unattached'
         WHEN n > 0 THEN 'invalid' WHEN r.config_error IS NOT NULL THEN 'misconfigured'
         WHEN length(regexp_extract(occurred_at, '[.]([0-9]+)', 1)) > 9 THEN 'untimed' ELSE 'ready' END AS verdict
  FROM validated AS v LEFT JOIN routes AS r USING (contract_id)),
valid AS (SELECT {C}, contract_id, record_id FROM judged WHERE attachment_id IS NOT NULL AND n = 0)"""

SETTLED = f"""{JUDGED},{D.EVENT_SEEN},
winners AS (
  SELECT contract_id, record_id, min(({C})) AS first FROM judged WHERE verdict = 'ready'
    AND (contract_id, record_id) NOT IN (SELECT (contract_id, record_id) FROM seen) GROUP BY 1, 2),
settled AS (
  SELECT j.*, CASE
      WHEN verdict = 'unattached' THEN 'unattached' WHEN verdict IN ('tombstone', 'broken', 'invalid') THEN 'quarantined'
      WHEN s.record_id IS NOT NULL THEN 'duplicate'
      WHEN verdict = 'ready' THEN CASE WHEN w.first = (j.topic, j."partition", j."offset") THEN 'applied' ELSE 'duplicate' END
      WHEN w.first < (j.topic, j."partition", j."offset") THEN 'duplicate' ELSE 'quarantined' END AS outcome,
    CASE WHEN verdict IN ('broken', 'invalid') THEN 'SCHEMA_VIOLATION' ELSE 'UNCLASSIFIED_FAILURE' END AS label
  FROM judged AS j LEFT JOIN winners AS w ON j.contract_id = w.contract_id AND j.record_id = w.record_id
    LEFT JOIN seen AS s ON j.contract_id = s.contract_id AND j.record_id = s.record_id),
final AS (SELECT *, CASE WHEN outcome = 'quarantined' THEN label END AS error_type,
                    CASE WHEN outcome = 'quarantined' THEN 1 END AS attempts FROM settled)"""


def _q(v: str) -> str:
    """CSV quoting."""
    return f"""CASE WHEN contains({v}, ',') OR contains({v}, '"') OR contains({v}, chr(10)) THEN '"' || replace({v}, '"', '""') || '"' ELSE {v} END"""


def _x(v: str) -> str:
    """XML escaping."""
    return f"""replace(replace(replace(replace({v}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')"""


def _instant(stamp: str) -> str:
    """Canonical UTC text of a checked timestamp text."""
    tail = f"right({stamp}, 6)"
    minutes = (
        f"CASE WHEN upper(right({stamp}, 1)) = 'Z' THEN 0 ELSE (cast(substr({tail}, 2, 2) AS int) * 60 + "
        f"cast(substr({tail}, 5, 2) AS int)) * CASE WHEN {tail}[1] = '-' THEN -1 ELSE 1 END END"
    )
    local = f"cast(replace(upper(substr({stamp}, 1, 19)), 'T', ' ') AS timestamp)"
    digits = f"rtrim(regexp_extract({stamp}, '[.]([0-9]+)', 1), '0')"
    fraction = f"CASE WHEN {digits} = '' THEN '' ELSE '.' || rpad({digits}, cast(ceil(length({digits}) / 3.0) * 3 AS int), '0') END"
    return f"strftime({local} - to_minutes({minutes}), '%Y-%m-%dT%H:%M:%S') || {fraction} || 'Z'"


def _p(field: str) -> str:
    return f"coalesce(json_extract_string(o, '$.payload.{field}'), '')"


def _raw(field: str) -> str:
    return f"coalesce(cast(json_extract(o, '$.payload.{field}') AS varchar), 'null')"


EVENT_FIELDS = [("user_id", "userId"), ("amount", "amount"), ("note", "note"), ("flag", "flag"), ("props", "props")]

LINES = f"""{SETTLED},
applied AS (SELECT *, {_instant("occurred_at")} AS at_text FROM final WHERE outcome = 'applied'),
lines AS (
  SELECT {C}, contract_id, record_id, target, format, CASE format
    WHEN 'csv' THEN record_id || {" || ".join("',' || " + _q(_p(f)) for _, f in EVENT_FIELDS)} || ',' || at_text
    WHEN 'json' THEN '{{"record_id":"' || record_id || '"' || {" || ".join(f"',\"{h}\":' || " + _raw(f) for h, f in EVENT_FIELDS)} || ',"created_at":"' || at_text || '"}}'
    ELSE '<record><record_id>' || record_id || '</record_id><user_id>' || {_x(_p("userId"))} || '</user_id><_1st>' || {_x(_p("note"))}
      || '</_1st><missing></missing><created_at>' || at_text || '</created_at></record>' END AS line
  FROM applied)"""

# --- attachments made from customers ---------------------------------------------------------------------------


def _active(listing: str) -> str:
    # Of a repeated key the last value counts, while this engine's JSON functions take the first.
    return f"""SELECT pos, attachment_id, contract_id,
    CASE WHEN json_type(config) = 'OBJECT' THEN replace(config, '"path":"dropped",', '') ELSE '{{}}' END AS config
  FROM {listing} WHERE adapter_type = 'csv' AND enabled"""


def _text_setting(key: str, default: str) -> str:
    return f"CASE WHEN json_type(config, '$.{key}') = 'VARCHAR' THEN json_extract_string(config, '$.{key}') ELSE '{default}' END"


LISTED = f"{D.CUSTOMER_LISTING}, listed AS ({_active('listing')})"

_ENTRIES = "CASE WHEN json_type(config, '$.columns') = 'ARRAY' THEN json_extract(config, '$.columns[*]') ELSE [] END"
_WHOLE = "coalesce(json_type(e, '$.header') = 'VARCHAR' AND json_type(e, '$.field') = 'VARCHAR', false)"

CONFIGURED = f"""{LISTED},
configured AS (
  SELECT *, {_text_setting("path", "")} AS path, {_text_setting("format", "csv")} AS format,
    list_transform(list_filter({_ENTRIES}, lambda e: {_WHOLE}), lambda e: json_extract_string(e, '$.header')) AS headers
  FROM listed),
usable AS (SELECT *, len(headers) AS n_all FROM configured)"""

KNOWN_FORMAT = "format IN ('csv', 'json', 'xml')"


# What each error type comes to, with its place in the type hierarchy taken into account.
_PERMANENT = "'EnvelopeSchemaViolationException', 'JsonProcessingException', 'JsonParseException', 'JsonMappingException', 'NoSuchFileException'"
_PASSING = """'ConnectException', 'IOException', 'AccessDeniedException', 'FileSystemException', 'FileNotFoundException', 'EOFException', 'SocketException',
  'SocketTimeoutException', 'UnknownHostException'"""
_SCHEMA_TYPES = "'EnvelopeSchemaViolationException', 'JsonProcessingException', 'JsonParseException', 'JsonMappingException'"

CLASSIFIED = f"""{D.ORDER_ERRORS},
causes AS (SELECT error_id, messages, unnest(types) AS type, generate_subscripts(types, 1) AS depth FROM errors),
rated AS (SELECT *, CASE WHEN type IN ({_PERMANENT}) THEN 'NON_RETRIABLE' WHEN type IN ({_PASSING}) THEN 'RETRIABLE' END AS verdict FROM causes),
classified AS (
  SELECT error_id, coalesce(arg_min(verdict, depth) FILTER (verdict IS NOT NULL), 'NON_RETRIABLE') AS classification,
    bool_or(type IN ({_SCHEMA_TYPES})) AS is_schema, any_value(messages[len(messages)]) AS root
  FROM rated GROUP BY error_id)"""

_DOC_ID = D.uuid_of("concat('doc:', cast(doc_id AS varchar))")
_PAGE_ID = D.uuid_of("concat('page:', cast(page_id AS varchar))")
_MAIL = "CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'd' || doc_id || '@x.org' END"

ORACLE: dict[str, str] = {
    "topic_scan": f"WITH {D.EVENT_LOG} SELECT topic, \"partition\", \"offset\", key, value FROM log",
    "attachments_active": f"WITH {LISTED} SELECT pos, attachment_id, contract_id FROM listed",
    "seen_import": f"SELECT DISTINCT {D._EVENT_ID_DUCK} AS record_id FROM events",
    "csv_readback": f"""SELECT {_DOC_ID} AS record_id, 'D-' || doc_id AS intern_id, lang AS first_name, source AS last_name,
      {_MAIL} AS email, text AS college, cast(n_chars AS varchar) AS department, '' AS mentor, '2026-09-01' AS start_date,
      'ACTIVE' AS status, '2026-07-21T14:10:00Z' AS created_at FROM documents""",
    "parse_outcome": f"WITH {ENVELOPES} SELECT {C}, shape FROM envelopes",
    "envelope_project": f"""WITH {ENVELOPES} SELECT {C}, contract_id, record_id, record_type, natural_key, occurred_at,
      CASE WHEN k_payload = 'object' THEN json_extract_string(o, '$.payload.amount') END AS amount,
      CASE WHEN k_payload = 'object' THEN json_extract_string(o, '$.payload.props') END AS props FROM envelopes""",
    "record_style": f"WITH {ENVELOPES} SELECT {C}, suffix(record_type, '.updated') AS is_update FROM envelopes",
    "typed_project": f"""WITH {D.INTERN_LOG},
      docs AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS o FROM interns),
      f AS (SELECT *, json_extract_string(o, '$.recordId') AS rid, json_extract_string(o, '$.schemaVersion') AS sv,
        json_extract_string(o, '$.occurredAt') AS at_raw, json_extract_string(o, '$.payload.startDate') AS sd,
        json_extract_string(o, '$.payload.status') AS st FROM docs)
      SELECT key, lower(rid) AS record_id, json_extract_string(o, '$.contractId') AS contract_id,
        CASE WHEN o IS NOT NULL THEN coalesce(try_cast(sv AS int), CASE WHEN sv IS NULL THEN 0 END) END AS schema_version,
        CASE WHEN at_raw <> 'soon' THEN {_instant("replace(at_raw, 'soon', '2000-01-01T00:00:00Z')")} END AS occurred_at,
        lower(json_extract_string(o, '$.traceId')) AS trace_id, json_extract_string(o, '$.payload.internId') AS intern_id,
        json_extract_string(o, '$.payload.mentor') AS mentor, cast(try_cast(sd AS date) AS varchar) AS start_date, st AS status,
        CASE WHEN o IS NULL THEN 'value' WHEN NOT regexp_matches(rid, '{_UUID}') THEN 'recordId'
             WHEN sv IS NOT NULL AND try_cast(sv AS int) IS NULL THEN 'schemaVersion' WHEN at_raw = 'soon' THEN 'occurredAt'
             WHEN try_cast(sd AS date) IS NULL THEN 'payload.startDate'
             WHEN st NOT IN ('ACTIVE', 'COMPLETED', 'WITHDRAWN') THEN 'payload.status' END AS error
      FROM f""",
    "schema_violations": f"WITH {VALIDATED} SELECT {C}, cast(n AS int) AS n, violations FROM validated",
    "violation_counts": f"""WITH {VALIDATED},
      each AS (SELECT contract_id, unnest(string_split(violations, '; ')) AS violation FROM validated WHERE n > 0)
      SELECT contract_id, violation, count(*) AS n FROM each GROUP BY 1, 2""",
    "attachment_config": f"""WITH {LISTED} SELECT attachment_id, {_text_setting("path", "none")} AS path, {_text_setting("format", "csv")} AS format,
      cast(CASE WHEN json_type(config, '$.options') = 'OBJECT' THEN 2 ELSE 0 END AS int) AS n_options,
      json_extract_string(config, '$.options.depth') AS depth, json_extract_string(config, '$.options.mode') AS mode,
      cast(len(list_filter({_ENTRIES}, lambda e: json_type(e) = 'OBJECT')) AS int) AS n_entries FROM listed""",
    "target_path": f"WITH {CONFIGURED} SELECT attachment_id, CASE WHEN trim(path) = '' THEN 'default.csv' ELSE path END AS target FROM configured",
    "format_route": f"""WITH {CONFIGURED} SELECT attachment_id, format, {KNOWN_FORMAT} AS known,
      CASE WHEN format = 'csv' THEN array_to_string(list_concat(['record_id'], headers, ['created_at']), ',') END
        AS header FROM usable""",
    "config_errors": f"""WITH {CONFIGURED} SELECT attachment_id, contract_id, CASE WHEN n_all = 0
      THEN 'attachment ' || attachment_id || ' for contract ''' || contract_id || ''' has no usable columns'
      ELSE 'unknown format ''' || format || '''; available: csv, json, xml' END AS config_error
      FROM usable WHERE n_all = 0 OR NOT {KNOWN_FORMAT}""",
    "descriptor_errors": f"""WITH {LISTED} SELECT attachment_id, concat_ws('; ',
      CASE WHEN json_type(config, '$.path') <> 'VARCHAR' THEN 'path is not text' END,
      CASE WHEN json_type(config, '$.format') IS NOT NULL AND coalesce({_text_setting("format", "?")}, '?') NOT IN ('csv', 'json', 'xml')
        THEN 'format is not one of csv, json, xml' END,
      CASE WHEN json_type(config, '$.columns') IS NULL THEN 'columns are missing'
        WHEN json_type(config, '$.columns') <> 'ARRAY' THEN 'columns are not a list'
        WHEN json_array_length(config, '$.columns') = 0 THEN 'columns are empty'
        WHEN len(list_filter({_ENTRIES}, lambda e: NOT {_WHOLE})) > 0 THEN 'a column has no header or field' END
      ) AS problems FROM listed""",
    "attachment_index": f"""WITH {LISTED} SELECT contract_id, arg_min(attachment_id, pos) AS attachment_id, min(pos) AS pos
      FROM listed GROUP BY contract_id""",
    "attachment_conflicts": f"""WITH {LISTED}, w AS (SELECT *, count(*) OVER (PARTITION BY contract_id) AS listed_n,
        first_value(attachment_id) OVER (PARTITION BY contract_id ORDER BY pos) AS kept_id FROM listed)
      SELECT contract_id, listed_n AS listed, kept_id, attachment_id AS ignored_id FROM w WHERE attachment_id <> kept_id""",
    "attachment_summary": f"""WITH {LISTED} SELECT count(DISTINCT contract_id) AS contracts, count(*) AS attachments,
      count(*) - count(DISTINCT contract_id) AS ignored,
      CASE WHEN count(*) = 0 THEN 'no contract is attached: every record will be skipped' END AS warning FROM listed""",
    "attachment_changes": f"""WITH {LISTED}, {D.CUSTOMER_LISTING_BEFORE}, listed_before AS ({_active("listing_before")}),
      a AS (SELECT contract_id, arg_min(config, pos) AS config FROM listed_before GROUP BY 1),
      b AS (SELECT contract_id, arg_min(config, pos) AS config, arg_min(attachment_id, pos) AS attachment_id FROM listed GROUP BY 1),
      d AS (SELECT coalesce(a.contract_id, b.contract_id) AS contract_id, attachment_id, CASE WHEN a.contract_id IS NULL THEN 'attached'
        WHEN b.contract_id IS NULL THEN 'detached' WHEN a.config <> b.config THEN 'changed' END AS change
        FROM a FULL JOIN b ON a.contract_id = b.contract_id)
      SELECT contract_id, change, attachment_id FROM d WHERE change IS NOT NULL""",
    "store_names": f"WITH {LISTED} SELECT attachment_id, regexp_replace(contract_id, '[^A-Za-z0-9_.-]', '_', 'g') AS store FROM listed",
    "contract_join": f"""WITH {ENVELOPES},{ROUTES} SELECT {C}, contract_id, attachment_id, target
      FROM envelopes LEFT JOIN routes USING (contract_id)""",
    "contract_semi": f"WITH {ENVELOPES},{ROUTES} SELECT {C}, contract_id FROM envelopes SEMI JOIN routes USING (contract_id)",
    "contract_anti": f"WITH {ENVELOPES},{ROUTES} SELECT {C}, contract_id FROM envelopes ANTI JOIN routes USING (contract_id)",
    "dynamic_project": f"""WITH {JUDGED}, ok AS (SELECT * FROM judged WHERE n = 0 AND contract_id IN ('click', 'purchase', 'signup')),
      wide AS (SELECT {C}, record_id, CASE WHEN contract_id = 'signup' THEN ['user id', '1st', 'missing']
          ELSE ['user_id', 'amount', 'note', 'flag', 'props'] END AS headers,
        CASE WHEN contract_id = 'signup' THEN [{_p("userId")}, {_p("note")}, '']
          ELSE [{", ".join(_p(f) for _, f in EVENT_FIELDS)}] END AS vals FROM ok)
      SELECT {C}, record_id, cast(unnest(range(len(vals))) AS int) AS pos, unnest(headers) AS header, unnest(vals) AS value FROM wide""",
    "canonical_time": f"""WITH {D.EVENT_TIMES}, checked AS (SELECT event_id, CASE WHEN try_cast(substr(stamp, 1, 10) AS date) IS NOT NULL
        AND regexp_matches(stamp, '([Zz]|[+-][0-9][0-9]:[0-9][0-9])$') THEN stamp END AS stamp FROM times)
      SELECT event_id, {_instant("stamp")} AS instant FROM checked""",
    "xml_tags": """WITH t AS (SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]', '_', 'g') AS u, cast(page_id AS varchar) AS i FROM pages)
      SELECT page_id, CASE WHEN regexp_matches(u, '^[A-Za-z_]') THEN u ELSE '_' || u END AS url_tag, '_' || i AS id_tag FROM t""",
    "csv_lines": f"""WITH d AS (SELECT {_DOC_ID} AS record_id, *, {_MAIL} AS mail FROM documents)
      SELECT 'interns' AS contract_id, record_id, record_id || ',D-' || doc_id || ',' || lang || ',' || {_q("source")} || ',' || mail || ','
        || {_q("text")} || ',' || n_chars || ',,2026-09-01,ACTIVE,2026-07-21T14:10:00Z' AS line,
        'record_id,intern_id,first_name,last_name,email,college,department,mentor,start_date,status,created_at' AS header FROM d""",
    "jsonl_lines": f"""WITH d AS (SELECT {_DOC_ID} AS record_id, *, {_MAIL} AS mail FROM documents)
      SELECT 'interns' AS contract_id, record_id, '{{"record_id":"' || record_id || '","intern_id":"D-' || doc_id || '","first_name":"' || lang
        || '","last_name":' || to_json(source) || ',"email":' || CASE WHEN mail = '' THEN 'null' ELSE '"' || mail || '"' END
        || ',"college":' || to_json(text) || ',"department":' || n_chars
        || ',"mentor":null,"start_date":"2026-09-01","status":"ACTIVE","created_at":"2026-07-21T14:10:00Z"}}' AS line,
        cast(NULL AS varchar) AS header FROM d""",
    "xml_lines": f"""SELECT 'pages' AS contract_id, {_PAGE_ID} AS record_id, '<record><record_id>' || {_PAGE_ID} || '</record_id><page_url>'
      || {_x("url")} || '</page_url><_1st>' || page_id || '</_1st><html>' || {_x("html")}
      || '</html><no></no><created_at>2026-07-21T14:10:00.250Z</created_at></record>' AS line, cast(NULL AS varchar) AS header FROM pages""",
    "first_delivery": f"""WITH {JUDGED}, r AS (SELECT *, row_number() OVER (PARTITION BY contract_id, record_id ORDER BY {C}) AS rn FROM judged
        WHERE verdict = 'ready')
      SELECT {C}, contract_id, record_id FROM r WHERE rn = 1""",
    "unseen_records": f"""WITH {JUDGED}, {D.EVENT_SEEN} SELECT DISTINCT contract_id, record_id FROM valid
      ANTI JOIN seen USING (contract_id, record_id)""",
    "unseen_indexed": f"""WITH {JUDGED}, {D.EVENT_SEEN} SELECT DISTINCT contract_id, record_id FROM valid
      ANTI JOIN seen USING (contract_id, record_id)""",
    "seen_union": f"""WITH {SETTLED} SELECT contract_id, record_id FROM seen UNION SELECT contract_id, record_id FROM final WHERE outcome = 'applied'""",
    "seen_migrate": f"""WITH {JUDGED}, {D.EVENT_SEEN}, {D.EVENT_LEGACY},
      records AS (SELECT DISTINCT contract_id, record_id FROM valid),
      own AS (SELECT contract_id, record_id FROM seen WHERE contract_id IN ('click', 'error')),
      migrated AS (SELECT contract_id, record_id, 'own' AS store FROM own
        UNION ALL SELECT c.contract_id, l.record_id, 'inherited' FROM (SELECT DISTINCT contract_id FROM records
          WHERE contract_id NOT IN (SELECT contract_id FROM own)) AS c, legacy AS l)
      SELECT contract_id, record_id, store FROM records JOIN migrated USING (contract_id, record_id)""",
    "classify_failures": f"WITH {CLASSIFIED} SELECT error_id, classification FROM classified",
    "error_labels": f"""WITH {CLASSIFIED} SELECT error_id, CASE WHEN classification = 'RETRIABLE' THEN 'RETRY_EXHAUSTED'
      WHEN is_schema THEN 'SCHEMA_VIOLATION' ELSE 'UNCLASSIFIED_FAILURE' END AS error_type, root AS error_message FROM classified""",
    "routed_lines": f"WITH {LINES} SELECT {C}, contract_id, record_id, target, line FROM lines",
    "delivered_lines": f"""WITH {LINES} SELECT target, topic, "partition",
      cast(row_number() OVER (PARTITION BY target, topic, "partition" ORDER BY "offset") AS int) AS pos, contract_id, record_id, line FROM lines""",
    "target_headers": f"""WITH {LINES} SELECT DISTINCT target, CASE WHEN format = 'csv'
      THEN 'record_id,user_id,amount,note,flag,props,created_at' END AS header FROM lines""",
    "delivery_audit": f"WITH {LINES} SELECT contract_id, record_id, count(*) AS times FROM lines GROUP BY 1, 2",
    "delivery_outcomes": f"WITH {SETTLED} SELECT {C}, contract_id, record_id, outcome, error_type, attempts FROM final",
    "outcome_counts": f"WITH {SETTLED} SELECT contract_id, outcome, error_type, count(*) AS n FROM final GROUP BY ALL",
    "delivery_reconcile": f"""WITH {SETTLED} SELECT topic, count(*) AS delivered, count(outcome) AS settled,
      count(*) - count(outcome) AS missing FROM final GROUP BY topic""",
    "dlq_entries": f"""WITH {SETTLED} SELECT topic AS "originalTopic", "partition" AS "originalPartition", "offset" AS "originalOffset",
      key AS "originalKey", value AS "originalPayload", error_type AS "errorType", CASE verdict WHEN 'tombstone' THEN 'the delivery has no value'
        WHEN 'broken' THEN 'not valid JSON' WHEN 'invalid' THEN 'the envelope breaks its schema: ' || violations WHEN 'misconfigured' THEN config_error
        ELSE '''' || occurred_at || ''' is not an instant' END AS "errorMessage", 'waybill' AS "failedAdapter", attempts AS "attemptCount",
      false AS replayed FROM final WHERE outcome = 'quarantined'""",
}
ORACLE["streamed_outcomes"] = ORACLE["outcome_counts"]
ORACLE["streamed_dead_letters"] = ORACLE["dlq_entries"]
ORACLE["single_file_export"] = ORACLE["csv_readback"]
