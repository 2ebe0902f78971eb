"""JSON reading: one strict parse per record, JSON types from variants, payload lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from waybill.schemas import ENVELOPE

# Plain JSON only: Spark's reader would otherwise take single quotes and NaN.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


# Name of the field that closes a wrapped text.
END = "_end"


def _mark(value: Column) -> Column:
    return F.xxhash64(value).cast("string")


def wrapped(value: Column) -> Column:
    """The text as the first element of a JSON array; the second one holds the text's hash.

    Whatever follows an object in the text (a bracket that closes the array early, further elements) keeps the
    mark from being the second element of two, and no text can hold its own hash.
    """
    return F.concat(F.lit('['), value, F.lit(f',{{"{END}":"'), _mark(value), F.lit('"}]'))


def is_whole(read: Column, value: Column) -> Column:
    """Whether a wrapped text, read as an array of structs with the field END, was one object and nothing else."""
    second = F.get(read, F.lit(1))[END]
    return F.coalesce((F.size(read) == 2) & F.get(read, F.lit(0)).isNotNull() & (second == _mark(value)), F.lit(False))


def envelope_type(extra_fields: list[str] = ()) -> T.StructType:
    extra = [T.StructField(name, T.VariantType()) for name in extra_fields if name not in ENVELOPE.names]
    return T.StructType([*ENVELOPE.fields, *extra, T.StructField(END, T.StringType())])


# JSON type names by the first word of a variant's schema.
TYPE_NAMES = {
    "STRING": "string", "VOID": "null", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array",
    "BIGINT": "integer", "DECIMAL": "number", "DOUBLE": "number",
}


def scalar_text(v: Column) -> Column:
    """Text of a scalar; '' for a missing value, an object or an array, 'null' for an explicit null."""
    kind, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return (
        F.when(kind == "STRING", text).when(kind.isNull() | nested, "").when(kind == "VOID", "null").otherwise(text)
    )


def last_wins(m: Column) -> Column:
    """A JSON map with repeated keys keeps the last value of each key."""
    keys = F.map_keys(m)
    entries = F.map_entries(m)
    kept = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]),
    )
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.map_from_entries(kept)).otherwise(m)


def quote(text: Column) -> Column:
    """A text as a JSON string literal; most texts need nothing escaped."""
    escaped = F.btrim(F.to_json(F.array(text)), F.lit("[]"))
    return F.when(text.rlike(r'["\\\x00-\x1f]'), escaped).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column so that it is computed a single time per row.

    A filter on the column, or on one made from it, would otherwise be moved below the projection together with a
    copy of the whole expression. The condition, which always holds, keeps Spark from that: it copies and moves
    nothing that depends on where it runs.
    """
    return df.withColumn(name, F.when(F.spark_partition_id() >= 0, value))


def typed_payload(value: Column) -> Column:
    """The payload as map<field, variant>; only the JSON output needs the types."""
    read = F.from_json(wrapped(value), "array<struct<payload:map<string,variant>>>", STRICT)
    return F.get(read, F.lit(0))["payload"]
