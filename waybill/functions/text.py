"""Small text rules shared by the formatters and stores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_UNSAFE = r"[^A-Za-z0-9_.-]"


def csv_field(text: Column) -> Column:
    """Quoted only when it holds a comma, a double quote or a line feed; inner quotes doubled."""
    doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.contains(",") | text.contains('"') | text.contains("\n"), doubled).otherwise(text)


def xml_text(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def xml_tag(name: Column) -> Column:
    """A legal element name: unsafe characters become '_', a bad first character gets a '_' before it."""
    return F.regexp_replace(F.regexp_replace(name, _UNSAFE, "_"), "^(?![A-Za-z_])", "_")


def store_name(contract_id: Column) -> Column:
    """A contract id as a file or directory name."""
    return F.regexp_replace(contract_id, _UNSAFE, "_")
