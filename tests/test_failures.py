import pytest
from core import deliveries
from pyspark.sql import functions as F

from waybill.operators import failures as X

# Cause chains, outermost first, with class and label.
CHAINS = [
    (["EnvelopeSchemaViolationException"], "NON_RETRIABLE", "SCHEMA_VIOLATION"),
    (["JsonParseException"], "NON_RETRIABLE", "SCHEMA_VIOLATION"),
    (["NoSuchFileException"], "NON_RETRIABLE", "UNCLASSIFIED_FAILURE"),
    (["ConnectException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    (["IOException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    (["AccessDeniedException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    (["RuntimeException"], "NON_RETRIABLE", "UNCLASSIFIED_FAILURE"),
    (["RuntimeException", "IOException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    (["RuntimeException", "JsonMappingException"], "NON_RETRIABLE", "SCHEMA_VIOLATION"),
    (["IOException", "JsonParseException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    (["JsonParseException", "IOException"], "NON_RETRIABLE", "SCHEMA_VIOLATION"),
    (["NeverHeardOf", "AnotherOne"], "NON_RETRIABLE", "UNCLASSIFIED_FAILURE"),
    (["NeverHeardOf", "ConnectException"], "RETRIABLE", "RETRY_EXHAUSTED"),
    ([], "NON_RETRIABLE", "UNCLASSIFIED_FAILURE"),
]


def test_classification_and_labels(spark):
    df = spark.createDataFrame([(c,) for c, *_ in CHAINS], "types array<string>")
    chain = X.lineages(F.col("types"))
    assert [tuple(r) for r in df.select("types", X.classify(chain), X.label(chain)).collect()] == CHAINS


def test_root_message(spark):
    df = spark.createDataFrame([(["outer", "root"],), (["only"],), ([],)], "m array<string>")
    assert [r[0] for r in df.select(X.root_message(F.col("m"))).collect()] == ["root", "only", None]


def test_retry_policy():
    assert X.RetryPolicy().sleeps() == [200, 400]
    assert X.RetryPolicy(4, 3, 1.5).sleeps() == [3, 4, 6]  # cut to whole milliseconds each time
    assert X.RetryPolicy(1).sleeps() == []


@pytest.mark.parametrize("error, label", [
    (OSError("disk"), "RETRY_EXHAUSTED"), (ConnectionRefusedError("no"), "RETRY_EXHAUSTED"),
    (FileNotFoundError("gone"), "UNCLASSIFIED_FAILURE"), (ValueError("odd"), "UNCLASSIFIED_FAILURE"),
])
def test_errors_on_the_driver(error, label):
    assert X.error_label(error) == label
    try:
        raise RuntimeError("outer") from error
    except RuntimeError as wrapped:
        assert X.error_label(wrapped) == label
        assert X.error_root_message(wrapped) == str(error)


def test_dead_letters_keep_the_original(spark):
    lost = deliveries(spark, ["{ bad", None]).withColumns({
        "error_type": F.lit("SCHEMA_VIOLATION"), "error_message": F.lit("why"), "attempts": F.lit(1)})
    rows = X.dead_letters(lost, "me", F.lit("2026-01-01T00:00:00Z")).orderBy("originalOffset")
    first, second = rows.collect()
    assert first.originalPayload == "{ bad" and second.originalPayload is None
    assert (first.originalTopic, first.originalKey, first.failedAdapter, first.replayed, first.replayedAt) == (
        "interns.created", "k0", "me", False, None)
    text = X.dead_letter_json(rows).first().value
    assert text.startswith('{"originalTopic":"interns.created","originalPartition":0,"originalOffset":0,')
    assert text.endswith('"attemptCount":1,"quarantinedAt":"2026-01-01T00:00:00Z","replayed":false,"replayedAt":null}')
