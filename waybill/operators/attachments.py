"""Attachments: which contracts are delivered, where, in which format, with which columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from waybill.functions import json_values as J
from waybill.functions.formats import DEFAULT_FORMAT, FormatRegistry, default_formats
from waybill.operators.lookup import join_config

ADAPTER_TYPE = "csv"


def active(listing: DataFrame, adapter_type: str = ADAPTER_TYPE) -> DataFrame:
    """Enabled attachments of one adapter type; ids as text, a config that is not an object counts as empty."""
    # A repeated key makes a text no variant; read as a map, its last value counts.
    repeated = F.to_variant_object(J.last_wins(F.from_json("config", "map<string,variant>", J.STRICT)))
    parsed = F.coalesce(F.try_parse_json("config"), repeated)
    # Read a single time, where the rows are: a filter on what comes of it would else be moved below the shuffle that spreads a small file.
    read = J.once(listing.where((F.col("adapter_type") == adapter_type) & F.col("enabled")), "_parsed", parsed)
    is_object = F.coalesce(F.schema_of_variant(F.col("_parsed")).startswith("OBJECT"), F.lit(False))
    return read.select(
        "pos",
        F.coalesce("attachment_id", F.lit("null")).alias("attachment_id"),
        F.coalesce("contract_id", F.lit("null")).alias("contract_id"),
        # Variants print their keys in order, so equal configs have equal text.
        F.when(is_object, F.col("_parsed").cast("string")).otherwise("{}").alias("config"),
    )


def config_string(config: Column, key: str, default: str) -> Column:
    """The value of a config key if it is text, else the default."""
    value = F.try_variant_get(config, f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string")).otherwise(F.lit(default))


def config_map(config: Column, key: str) -> Column:
    """A nested config object with every value as text ('null' for null); empty when absent."""
    nested = F.try_variant_get(config, f"$.{key}", "map<string,variant>")
    texts = F.transform_values(nested, lambda _, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("null")))
    return F.coalesce(texts, F.from_json(F.lit("{}"), "map<string,string>"))


def config_list(config: Column, key: str) -> Column:
    """The entries of a config list that are objects, as variants, in order; empty when absent."""
    nested = F.try_variant_get(config, f"$.{key}", "array<variant>")
    return F.coalesce(
        F.filter(nested, lambda e: F.schema_of_variant(e).startswith("OBJECT")),
        F.array().cast("array<variant>"),
    )


def _columns(config: Column) -> Column:
    """Declared columns in order; an entry whose header or field is not text is dropped."""
    def text(entry: Column, key: str) -> Column:
        value = F.try_variant_get(entry, f"$.{key}", "variant")
        return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))

    pairs = F.transform(
        config_list(config, "columns"),
        lambda e: F.struct(text(e, "header").alias("header"), text(e, "field").alias("field")),
    )
    return F.filter(pairs, lambda c: c["header"].isNotNull() & c["field"].isNotNull())


def target_path(path: Column, default_path: str) -> Column:
    """A blank path means the default target."""
    return F.when(F.coalesce(path, F.lit("")).rlike(r"^\s*$"), F.lit(default_path)).otherwise(path)


def configured(attachments: DataFrame, default_path: str, formats: FormatRegistry | None = None) -> DataFrame:
    """Adds path, format, columns, target, what the format makes of the columns (header, cells), and config_error
    (NULL when the attachment can be written)."""
    formats = formats or default_formats()
    read = J.once(attachments, "_c", F.try_parse_json("config")).withColumns({
        "path": config_string(F.col("_c"), "path", ""),
        "format": config_string(F.col("_c"), "format", DEFAULT_FORMAT),
    })
    return (
        J.once(read, "columns", _columns(F.col("_c")))
        .withColumns({
            "target": target_path(F.col("path"), default_path),
            "header": formats.header(F.col("format")),
            "cells": formats.cells(F.col("format")),
            "config_error": F.when(
                F.size("columns") == 0,
                F.concat(
                    F.lit("attachment "), "attachment_id", F.lit(" for contract '"), "contract_id",
                    F.lit("' has no usable columns"),
                ),
            ).when(
                ~formats.knows(F.col("format")),
                F.concat(
                    F.lit("unknown format '"), "format", F.lit(f"'; available: {', '.join(formats.available())}")
                ),
            ),
        })
        .drop("_c")
    )


def descriptor_errors(attachments: DataFrame, formats: FormatRegistry | None = None) -> DataFrame:
    """Checks configs against what the adapter type declares; one row per attachment with its problems.

    path: text if given; format: one of the formats if given; columns: a non-empty list of entries that
    each have a header and a field as text.
    """
    formats = formats or default_formats()
    config = F.try_parse_json("config")

    def kind(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value), F.lit("MISSING"))

    def given(key: str) -> Column:
        return F.try_variant_get(F.col("_c"), f"$.{key}", "variant")

    entries = F.try_variant_get(F.col("_c"), "$.columns", "array<variant>")
    bad_entries = F.filter(
        entries,
        lambda e: (kind(F.try_variant_get(e, "$.header", "variant")) != "STRING")
        | (kind(F.try_variant_get(e, "$.field", "variant")) != "STRING"),
    )
    problems = F.array_compact(F.array(
        F.when(~kind(given("path")).isin("STRING", "MISSING"), "path is not text"),
        F.when(
            (kind(given("format")) != "MISSING")
            & ~((kind(given("format")) == "STRING") & formats.knows(given("format").cast("string"))),
            "format is not one of " + ", ".join(formats.available()),
        ),
        F.when(kind(given("columns")) == "MISSING", "columns are missing")
        .when(entries.isNull(), "columns are not a list")
        .when(F.size(entries) == 0, "columns are empty")
        .when(F.size(bad_entries) > 0, "a column has no header or field"),
    ))
    return attachments.withColumn("_c", config).withColumn("problems", problems).drop("_c")


def index(attachments: DataFrame) -> DataFrame:
    """One attachment per contract: the first in listing order.

    The rank filter is applied before the shuffle too, so a contract listed many times costs no more than
    one row per task.
    """
    order = Window.partitionBy("contract_id").orderBy("pos")
    return attachments.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def conflicts(attachments: DataFrame) -> DataFrame:
    """One row per ignored attachment of a contract, with the attachment that is used instead."""
    kept = (
        attachments.groupBy("contract_id")
        .agg(F.min("pos").alias("kept_pos"), F.min_by("attachment_id", "pos").alias("kept_id"),
             F.count(F.lit(1)).alias("listed"))
        .where("listed > 1")
    )
    joined = join_config(attachments, kept, ["contract_id"], ["pos"], "inner")
    return joined.where("pos > kept_pos").select(
        "contract_id", "listed", "kept_id", F.col("attachment_id").alias("ignored_id")
    )


def summary(attachments: DataFrame) -> DataFrame:
    """How many contracts are attached; a warning when there is none."""
    per_contract = attachments.groupBy("contract_id").agg(F.count(F.lit(1)).alias("n"))
    return per_contract.agg(
        F.count(F.lit(1)).alias("contracts"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("attachments"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("ignored"),
    ).withColumn(
        "warning",
        F.when(F.col("contracts") == 0, "no contract is attached: every record will be skipped"),
    )


def changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Difference of two snapshots (one attachment per contract): attached, changed or detached contracts."""
    a = previous.select("contract_id", F.col("config").alias("old_config"), F.lit(True).alias("_before"))
    b = current.select(
        "contract_id", "attachment_id", F.col("config").alias("new_config"), F.lit(True).alias("_now")
    )
    change = (
        F.when(F.col("_before").isNull(), "attached")
        .when(F.col("_now").isNull(), "detached")
        .when(F.col("old_config") != F.col("new_config"), "changed")
    )
    return (
        a.join(b, "contract_id", "full_outer")
        .withColumn("change", change)
        .where("change IS NOT NULL")
        .select("contract_id", "change", "attachment_id", "old_config", "new_config")
    )


def null_settings(listing: DataFrame, adapter_type: str = ADAPTER_TYPE) -> DataFrame:
    """Attachments with a top-level null in their config; a listing with one is refused as a whole."""
    entries = F.try_variant_get(F.try_parse_json("config"), "$", "map<string,variant>")
    return listing.where((F.col("adapter_type") == adapter_type) & F.col("enabled")).where(
        F.exists(F.map_values(entries), lambda v: F.schema_of_variant(v) == "VOID")
    ).select("attachment_id", "contract_id")
