"""Configuration inputs: the attachment listing and the envelope schema document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.schemas import ATTACHMENT


def read_listing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Attachment listing from files; the schema is declared, never inferred."""
    return spark.read.schema(ATTACHMENT).format(fmt).load(path)


def read_schema_text(spark: SparkSession, path: str) -> str:
    """The envelope schema document. Missing or empty is an error: there is no run without validation."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None or not text.value.strip():
        raise ValueError(f"no envelope schema at {path}")
    return text.value
