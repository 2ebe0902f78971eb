"""Failures: classification of error chains, dead-letter labels, bounded retry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from waybill.schemas import COORDS, DEAD_LETTER

RETRIABLE = "RETRIABLE"
NON_RETRIABLE = "NON_RETRIABLE"

RETRY_EXHAUSTED = "RETRY_EXHAUSTED"
SCHEMA_VIOLATION = "SCHEMA_VIOLATION"
UNCLASSIFIED_FAILURE = "UNCLASSIFIED_FAILURE"

# Error type and its class, in order of precedence.
RULES = [
    ("EnvelopeSchemaViolationException", NON_RETRIABLE),
    ("JsonProcessingException", NON_RETRIABLE),
    ("NoSuchFileException", NON_RETRIABLE),
    ("ConnectException", RETRIABLE),
    ("IOException", RETRIABLE),
]

# Supertypes of common error types, from the public Java and Jackson class hierarchies.
SUPERTYPES = {
    "JsonProcessingException": ["JacksonException", "IOException"],
    "JsonParseException": ["StreamReadException", "JsonProcessingException", "JacksonException", "IOException"],
    "JsonMappingException": ["DatabindException", "JsonProcessingException", "JacksonException", "IOException"],
    "NoSuchFileException": ["FileSystemException", "IOException"],
    "AccessDeniedException": ["FileSystemException", "IOException"],
    "FileSystemException": ["IOException"],
    "FileNotFoundException": ["IOException"],
    "EOFException": ["IOException"],
    "ConnectException": ["SocketException", "IOException"],
    "SocketException": ["IOException"],
    "SocketTimeoutException": ["InterruptedIOException", "IOException"],
    "UnknownHostException": ["IOException"],
    "UncheckedIOException": ["RuntimeException"],
    "IllegalArgumentException": ["RuntimeException"],
    "IllegalStateException": ["RuntimeException"],
    "DateTimeParseException": ["DateTimeException", "RuntimeException"],
}


def lineages(types: Column) -> Column:
    """array<type name> -> array<array<type name>>: every type with its known supertypes."""
    known = F.create_map(*[x for k, v in SUPERTYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.transform(types, lambda t: F.concat(F.array(t), F.coalesce(known[t], F.array().cast("array<string>"))))


def classify(chain: Column) -> Column:
    """Class of an error, given the lineages of its cause chain, outermost first.

    The first error of the chain that any rule covers decides, by the first rule that covers it. Row by row,
    without a join. What no rule covers is not retried.
    """
    def one(lineage: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, verdict in reversed(RULES):
            found = F.when(F.array_contains(lineage, name), verdict).otherwise(found)
        return found

    return F.coalesce(F.get(F.array_compact(F.transform(chain, one)), F.lit(0)), F.lit(NON_RETRIABLE))


def label(chain: Column) -> Column:
    """Dead-letter error type of an error that is given up on."""
    envelope_error = F.exists(
        chain,
        lambda x: F.array_contains(x, "EnvelopeSchemaViolationException")
        | F.array_contains(x, "JsonProcessingException"),
    )
    return (
        F.when(classify(chain) == RETRIABLE, RETRY_EXHAUSTED)
        .when(envelope_error, SCHEMA_VIOLATION)
        .otherwise(UNCLASSIFIED_FAILURE)
    )


def root_message(messages: Column) -> Column:
    """Message of the deepest cause."""
    return F.try_element_at(messages, F.lit(-1))


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 3
    initial_backoff_ms: int = 200
    multiplier: float = 2.0

    def sleeps(self) -> list[int]:
        """Pause after each failed attempt but the last, in whole milliseconds."""
        pauses, pause = [], self.initial_backoff_ms
        for _ in range(self.max_attempts - 1):
            pauses.append(pause)
            pause = int(pause * self.multiplier)
        return pauses


def dead_letters(quarantined: DataFrame, adapter: str, quarantined_at: Column) -> DataFrame:
    """Dead-letter entries with the original delivery kept as it was.

    Expects topic, partition, offset, key, value, error_type, error_message and attempts.
    """
    topic, partition, offset = (F.col(c) for c in COORDS)
    values = {
        "originalTopic": topic, "originalPartition": partition, "originalOffset": offset,
        "originalKey": F.col("key"), "originalPayload": F.col("value"),
        "errorType": F.col("error_type"), "errorMessage": F.col("error_message"),
        "failedAdapter": F.lit(adapter), "attemptCount": F.col("attempts"),
        "quarantinedAt": quarantined_at, "replayed": F.lit(False), "replayedAt": F.lit(None),
    }
    return quarantined.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in DEAD_LETTER])


def dead_letter_json(entries: DataFrame) -> DataFrame:
    """Dead letters as key and JSON value, all fields present, for a topic."""
    names = [f.name for f in DEAD_LETTER]
    return entries.select(
        F.col("originalKey").alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"),
    )


# --- errors caught on the driver, when a whole target cannot be written ---------------------------------------

# Which error type a Python error stands for.
_PYTHON_ERRORS = [
    (FileNotFoundError, "NoSuchFileException"), (ConnectionError, "ConnectException"), (OSError, "IOException"),
]


def error_lineages(error: BaseException) -> list[list[str]]:
    """Type names, with supertypes, of an error and its causes, outermost first."""
    found, current = [], error
    while current is not None:
        known = [name for kind, name in _PYTHON_ERRORS if isinstance(current, kind)]
        found.append([type(current).__name__, *known])
        java = getattr(current, "java_exception", None) or getattr(current, "_origin", None)
        while java is not None:
            names, cls = [], java.getClass()
            while cls is not None:
                names.append(cls.getSimpleName())
                cls = cls.getSuperclass()
            found.append(names)
            java = java.getCause()
        current = current.__cause__
    return found


def error_class(error: BaseException) -> str:
    for lineage in error_lineages(error):
        for name, verdict in RULES:
            if name in lineage:
                return verdict
    return NON_RETRIABLE


def error_label(error: BaseException) -> str:
    if error_class(error) == RETRIABLE:
        return RETRY_EXHAUSTED
    names = {name for lineage in error_lineages(error) for name in lineage}
    envelope = names & {"EnvelopeSchemaViolationException", "JsonProcessingException"}
    return SCHEMA_VIOLATION if envelope else UNCLASSIFIED_FAILURE


def error_root_message(error: BaseException) -> str:
    while error.__cause__ is not None:
        error = error.__cause__
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if java is None:
        return str(error)
    while java.getCause() is not None:
        java = java.getCause()
    return java.getMessage() or java.toString()
