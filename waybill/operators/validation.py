"""Envelope validation: a JSON Schema document becomes column predicates, all violations are reported.

The schema keywords in use are covered: type, required, properties, pattern, minLength, minimum and the formats
uuid and date-time. A document that asks for anything else is refused, since a rule that is silently not
checked is worse than none.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from waybill.functions import json_values as J
from waybill.functions.instants import DATE_TIME
from waybill.operators.envelope import UUID
from waybill.schemas import ENVELOPE_FIELDS

# How a violation report starts; the wording is this engine's own.
REPORT_PREFIX = "the envelope breaks its schema: "

NOT_JSON = "not valid JSON"

_ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
_FORMATS = {
    "uuid": lambda text: f"{text} RLIKE {_literal(UUID)}",
    "date-time": lambda text: f"{text} RLIKE {_literal(DATE_TIME)} AND try_cast(substring({text}, 1, 10) AS date) IS NOT NULL",
}

# Fields whose text `envelope.project` has already read.
_TEXT_COLUMNS = {
    "contractId": "contract_id", "recordId": "record_id", "recordType": "record_type", "naturalKey": "natural_key",
    "occurredAt": "occurred_at",
}


@dataclass(frozen=True)
class Rule:
    """One way a record can break the schema; `fields` are the envelope fields it reads."""

    name: str
    field: str
    keyword: str
    argument: object
    types: tuple[str, ...] = ()

    def message(self) -> str:
        """SQL for the text of a violation."""
        if self.keyword == "required":
            return _literal(f" required property '{self.field}' not found")
        where = f"/{self.field} "
        if self.keyword == "type":
            names = " ".join(f"WHEN {_literal(word)} THEN {_literal(name)}" for word, name in J.TYPE_NAMES.items())
            kind = f"CASE WHEN {self._is('integer')} THEN 'integer' ELSE CASE regexp_extract({self._kind}, '^[A-Z]+', 0) {names} END END"
            return f"concat({_literal(where)}, {kind}, {_literal(f' found, {self._expected()} expected')})"
        return _literal(where + {
            "pattern": f"does not match the pattern {self.argument}",
            "minLength": f"must be at least {self.argument} characters long",
            "minimum": f"must have a minimum value of {self.argument}",
            "format": f"is not a valid {self.argument}",
        }[self.keyword])

    def broken(self) -> str:
        """SQL for whether a record breaks the rule; NULL counts as no."""
        if self.keyword == "required":
            return f"{self._kind} IS NULL"
        if self.keyword == "type":
            return f"NOT ({' OR '.join(self._is(t) for t in self.types)})"
        if self.keyword == "minimum":
            return f"{self._is('number')} AND {self._number} < {float(self.argument)}D"
        fails = {
            "pattern": lambda: f"NOT {self._text} RLIKE {_literal(str(self.argument))}",
            "minLength": lambda: f"length({self._text}) < {int(self.argument)}",
            "format": lambda: f"NOT ({_FORMATS[self.argument](self._text)})",
        }[self.keyword]()
        return f"{self._is('string')} AND {fails}"

    def _expected(self) -> str:
        return " or ".join(self.types)

    @property
    def _kind(self) -> str:
        """The variant schema of the field; NULL when it is missing."""
        return f"_kind.`{self.field}`"

    @property
    def _number(self) -> str:
        return "cast(NULL AS double)" if self.field == "payload" else f"try_variant_get(env.`{self.field}`, '$', 'double')"

    @property
    def _text(self) -> str:
        return _TEXT_COLUMNS.get(self.field) or f"try_variant_get(env.`{self.field}`, '$', 'string')"

    def _is(self, json_type: str) -> str:
        kind = self._kind
        number = f"({kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL'))"
        return {
            "integer": f"({kind} = 'BIGINT' OR {number} AND {self._number} % 1D = 0D)",
            "number": f"({kind} = 'BIGINT' OR {number})",
            "object": f"startswith({kind}, 'OBJECT')",
            "array": f"startswith({kind}, 'ARRAY')",
            "string": f"{kind} = 'STRING'",
            "null": f"{kind} = 'VOID'",
            "boolean": f"{kind} = 'BOOLEAN'",
        }[json_type]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def compile_rules(schema_text: str) -> list[Rule]:
    """Rules of a schema document, read once per job."""
    if not schema_text or not schema_text.strip():
        raise ValueError("the envelope schema is empty; refusing to run without validation")
    document = json.loads(schema_text)
    _only(document, {"type", "required", "properties", "additionalProperties"}, "the envelope schema")
    if document.get("type", "object") != "object":
        raise ValueError("the envelope schema must describe an object")
    if document.get("additionalProperties", True) is not True:
        raise ValueError("a closed envelope schema is not supported: extra fields are always allowed")
    rules = [Rule(f"{name}_required", name, "required", True) for name in document.get("required", [])]
    for name, spec in document.get("properties", {}).items():
        where = f"property '{name}' of the envelope schema"
        _only(spec, {"type", "pattern", "minLength", "minimum", "format"}, where)
        if "type" in spec:
            types = (spec["type"],) if isinstance(spec["type"], str) else tuple(spec["type"])
            rules.append(Rule(f"{name}_type", name, "type", None, types))
        if spec.get("format") is not None and spec["format"] not in _FORMATS:
            raise ValueError(f"{where} uses the format '{spec['format']}', which is not checked here")
        rules += [
            Rule(f"{name}_{key}", name, key, spec[key])
            for key in ("pattern", "minLength", "minimum", "format") if key in spec
        ]
    if any(r.field == "payload" and r.keyword not in ("required", "type") for r in rules):
        raise ValueError("the payload is opaque: only its type can be checked")
    return rules


def _only(spec: dict, keywords: set[str], where: str) -> None:
    extra = set(spec) - keywords - _ANNOTATIONS
    if extra:
        raise ValueError(f"{where} uses keywords that are not checked here: {sorted(extra)}")


def extra_fields(rules: list[Rule]) -> list[str]:
    """Fields a schema constrains beyond the fixed envelope; `envelope.parse` has to read them too."""
    return sorted({r.field for r in rules} - set(ENVELOPE_FIELDS) - {"payload"})


def validate(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds `violations`: every broken rule as '<location> <message>', sorted; empty when the record is valid.

    Works row by row without a shuffle. Expects the columns of `envelope.project`.
    """
    # The payload is read again only where it is not an object.
    again = "from_json(concat('[', value, ']'), 'array<struct<payload:variant>>')"
    fields = sorted({r.field for r in rules} - {"payload"})
    kinds = ", ".join(f"'{f}', schema_of_variant(env.`{f}`)" for f in fields)
    payload = f"CASE WHEN env.payload IS NOT NULL THEN 'OBJECT' ELSE schema_of_variant(get({again}, 0).payload) END"
    found = ", ".join(f"CASE WHEN {r.broken()} THEN {r.message()} END" for r in rules)
    any_broken = " OR ".join(f"({r.broken()})" for r in rules) or "false"
    violations = f"""CASE
        WHEN shape = 'object' AND coalesce({any_broken}, false) THEN array_sort(array_compact(array({found or "CAST(NULL AS string)"})))
        WHEN shape = 'object' THEN cast(array() AS array<string>)
        WHEN shape = 'other' THEN array(' the envelope is not an object')
        ELSE array({_literal(NOT_JSON)}) END"""
    typed = records.withColumn("_kind", F.expr(f"CASE WHEN shape = 'object' THEN named_struct({kinds}, 'payload', {payload}) END"))
    return J.once(typed, "violations", F.expr(violations)).drop("_kind")


def report(violations: Column) -> Column:
    """The text under which a record is quarantined."""
    return F.concat(F.lit(REPORT_PREFIX), F.array_join(violations, "; "))
