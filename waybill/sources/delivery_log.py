"""Deliveries: from Kafka, or from a delivery-log table with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waybill.schemas import LOG

# Fixed value: topics that carry records. Dead-letter topics must not match, or the job would feed itself.
TOPIC_PATTERN = r".*\.created"


def topic_matches(pattern: str = TOPIC_PATTERN) -> Column:
    """The whole topic name has to match."""
    return F.col("topic").rlike(f"^(?:{pattern})$")


def read_log(spark: SparkSession, path: str, pattern: str = TOPIC_PATTERN) -> DataFrame:
    return spark.read.schema(LOG).parquet(path).where(topic_matches(pattern))


def stream_log(
    spark: SparkSession, path: str, pattern: str = TOPIC_PATTERN, max_files: int | None = None
) -> DataFrame:
    """A growing delivery-log table as a stream; new files, and so new topics, are found on their own."""
    reader = spark.readStream.schema(LOG)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).where(topic_matches(pattern))


def stream_kafka(
    spark: SparkSession, servers: str, pattern: str = TOPIC_PATTERN, max_offsets: int | None = None,
    discovery_ms: int = 5000, **options: str,
) -> DataFrame:
    """All topics matching the pattern, from the earliest offset on. Needs Spark's Kafka connector.

    Progress is kept in the query's checkpoint, so every job reads everything on its own; `discovery_ms` is how
    soon a new topic is noticed.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", "earliest")
        .option("kafka.metadata.max.age.ms", discovery_ms)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return kafka_columns(reader.options(**options).load())


def kafka_columns(messages: DataFrame) -> DataFrame:
    """Kafka's binary key and value as text."""
    return messages.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
