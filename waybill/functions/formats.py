"""Output formats as column builders, and the registry they are chosen from.

A format turns one record into one line. What depends on the attachment alone is worked out once per attachment,
from its `columns array<struct<header,field>>`: the `header` line (NULL when the format has none) and the `cells`
array<struct<role,label,field>> that the line is made of. The line is a plain column expression over

    record_id, occurred_at, cells, payload map<string,string>,
    typed map<string,variant> (the payload once more, with JSON types; filled where `needs_types` is set)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from waybill.functions.instants import utc_text
from waybill.functions.json_values import quote
from waybill.functions.text import csv_field, xml_tag, xml_text

# Names of the first and last output field, default format.
ID_FIELD = "record_id"
TIME_FIELD = "created_at"
DEFAULT_FORMAT = "csv"


@dataclass(frozen=True)
class Format:
    id: str
    line: Callable[[], Column]
    header: Callable[[], Column]
    cells: Callable[[], Column]
    needs_types: bool = False


def _cell(label: Column, field: Column, role: str = "field") -> Column:
    return F.struct(F.lit(role).alias("role"), label.alias("label"), field.alias("field"))


def _created_at() -> Column:
    return utc_text(F.col("occurred_at"))


def _no_header() -> Column:
    return F.lit(None).cast("string")


def _plain_cells() -> Column:
    return F.transform("columns", lambda c: _cell(c["header"], c["field"]))


def _texts() -> Column:
    """Texts of the cells, in order; '' where the payload has none."""
    return F.transform("cells", lambda c: F.coalesce(F.col("payload")[c["field"]], F.lit("")))


def _csv_header() -> Column:
    return F.concat_ws(
        ",", F.lit(ID_FIELD), F.transform("columns", lambda c: c["header"]), F.lit(TIME_FIELD)
    )


def _csv_line() -> Column:
    # An id and a timestamp never need quotes.
    return F.concat_ws(",", F.col("record_id"), F.transform(_texts(), csv_field), _created_at())


def _json_cells() -> Column:
    none = F.lit(None).cast("string")
    cells = F.concat(
        F.array(_cell(F.lit(ID_FIELD), none, "id")), _plain_cells(), F.array(_cell(F.lit(TIME_FIELD), none, "time"))
    )
    # A repeated name keeps its first place and its last value.
    names = F.array_distinct(F.transform(cells, lambda c: c["label"]))
    unique = F.transform(names, lambda n: F.element_at(F.filter(cells, lambda c: c["label"] == n), -1))
    return F.transform(unique, lambda c: c.withField("label", F.concat(quote(c["label"]), F.lit(":"))))


def _json_value(raw: Column, typed: Column) -> Column:
    # Without a type (payload with repeated nested keys) the text itself decides.
    guess = F.schema_of_variant(F.try_parse_json(raw))
    looks_like_text = ~raw.rlike(r"^[\[{]") & (guess.isNull() | (guess == "STRING"))
    return (
        F.when(raw.isNull(), "null")
        .when(F.schema_of_variant(typed) == "STRING", quote(raw))
        .when(typed.isNull() & looks_like_text, quote(raw))
        .otherwise(raw)
    )


def _json_line() -> Column:
    found = F.transform("cells", lambda c: F.struct(
        c["role"].alias("role"), c["label"].alias("label"), F.col("payload")[c["field"]].alias("raw"),
        F.col("typed")[c["field"]].alias("typed"),
    ))
    members = F.transform(found, lambda m: F.concat(
        m["label"],
        F.when(m["role"] == "field", _json_value(m["raw"], m["typed"]))
        .otherwise(F.concat(F.lit('"'), F.when(m["role"] == "id", F.col("record_id")).otherwise(_created_at()), F.lit('"'))),
    ))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def _xml_cells() -> Column:
    return F.transform("columns", lambda c: _cell(xml_tag(c["header"]), c["field"]))


def _xml_line() -> Column:
    tagged = F.transform("cells", lambda c: F.struct(
        c["label"].alias("label"), F.coalesce(F.col("payload")[c["field"]], F.lit("")).alias("text")
    ))
    fields = F.transform(tagged, lambda e: F.concat(
        F.lit("<"), e["label"], F.lit(">"), xml_text(e["text"]), F.lit("</"), e["label"], F.lit(">"),
    ))
    return F.concat(
        F.lit(f"<record><{ID_FIELD}>"), F.col("record_id"), F.lit(f"</{ID_FIELD}>"), F.array_join(fields, ""),
        F.lit(f"<{TIME_FIELD}>"), _created_at(), F.lit(f"</{TIME_FIELD}></record>"),
    )


class FormatRegistry:
    """Formats by id, in registration order; the first of a repeated id stays."""

    def __init__(self, formats: list[Format] = ()):
        self._by_id: dict[str, Format] = {}
        for f in formats:
            self.register(f)

    def register(self, fmt: Format) -> None:
        self._by_id.setdefault(fmt.id, fmt)

    def available(self) -> list[str]:
        return list(self._by_id)

    def knows(self, format_id: Column) -> Column:
        return format_id.isin(self.available())

    def _choose(self, format_id: Column, build: Callable[[Format], Column], kind: str = "string") -> Column:
        chosen = F.lit(None).cast(kind)
        for f in reversed(list(self._by_id.values())):
            chosen = F.when(format_id == f.id, build(f)).otherwise(chosen)
        return chosen

    def line(self, format_id: Column) -> Column:
        return self._choose(format_id, lambda f: f.line())

    def header(self, format_id: Column) -> Column:
        return self._choose(format_id, lambda f: f.header())

    def cells(self, format_id: Column) -> Column:
        kind = "array<struct<role:string,label:string,field:string>>"
        return self._choose(format_id, lambda f: f.cells().cast(kind), kind)

    def needs_types(self, format_id: Column) -> Column:
        return format_id.isin([f.id for f in self._by_id.values() if f.needs_types])


def default_formats() -> FormatRegistry:
    return FormatRegistry([
        Format("csv", _csv_line, _csv_header, _plain_cells),
        Format("json", _json_line, _no_header, _json_cells, needs_types=True),
        Format("xml", _xml_line, _no_header, _xml_cells),
    ])
