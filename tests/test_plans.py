"""What the physical plans of the registered queries must and must not contain."""

import re

import pytest
from core import COLUMNS, deliveries, envelope, routing
from pyspark.sql import functions as F

import __spark_entry__ as registry
from waybill.checks.queries import QUERIES, _job, _staged
from waybill.plans import delivery as P
from waybill.schemas import SEEN
from waybill.storage import as_table, new_folder

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith(("streamed_", "delivered_"))}))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|MapInPandas", plan)


def test_the_envelope_is_parsed_once(spark):
    log = as_table(deliveries(spark, [envelope()]), new_folder(spark, "log"))
    lines = P.with_line(P.judge(log, routing(spark, ("interns", {"columns": COLUMNS}))), routing(spark, ("interns", {"columns": COLUMNS})))
    # Only the strict reading of the whole envelope names every field; others look at odd texts only.
    assert plan_of(lines).count("StructField(naturalKey,VariantType,true),StructField(occurredAt") == 1


def test_staging_shuffles_nothing(spark):
    log = as_table(deliveries(spark, [envelope()]), new_folder(spark, "log"))
    r = routing(spark, ("interns", {"columns": COLUMNS}))
    known = P.Routing(as_table(r.attachments, new_folder(spark, "att")), r.rules, r.formats)
    plan = plan_of(P.staged(log, known))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") == 2  # short settings, then what lines are made of


def test_settling_reads_narrow_columns_only(spark):
    table = as_table(P.staged(deliveries(spark, [envelope()]), routing(spark, ("interns", {"columns": COLUMNS}))), new_folder(spark, "t"))
    settled = P.settle(table, spark.createDataFrame([], SEEN))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", settled._jdf.queryExecution().toString())
    assert schemas and not any(re.search(r"\b(key|value|line|header|failure_text):", s) for s in schemas)


def test_topics_are_pruned_as_partitions(spark):
    plan = registry.queries()["topic_scan"](spark, SF)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*RLIKE", plan)


def test_configs_are_read_where_a_small_file_was_spread(spark):
    plan = QUERIES["config_errors"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" in plan and "Repartition" in plan
    assert "variant" not in plan[plan.index("Repartition"):]


def test_log_of_the_job_is_not_bound_to_its_topic_partitions(spark):
    """Few files mean few tasks for all that reads them; and a topic partition in two commits would lose its order."""
    job = _job(spark, SF)
    log = spark.read.parquet(f"{job.folder.root}/log")
    assert len(log.inputFiles()) == 2 * spark.sparkContext.defaultParallelism
    commits = job.outcomes().groupBy("partition").agg(F.count_distinct("commit").alias("n"))
    assert {r.n for r in commits.collect()} == {1} and job.outcomes().select("commit").distinct().count() == 2


def test_the_exported_file_is_not_read_whole_by_one_task(spark):
    assert "FileScan csv" not in QUERIES["single_file_export"](spark, SF)._jdf.queryExecution().toString()


def test_outcomes_alone_make_no_lines(spark):
    assert _staged(spark, SF).columns == P.NARROW
    assert not {"line", "header"} & set(_staged(spark, SF, "key", "value", "failure_text").columns)


def test_types_of_a_payload_are_read_once_a_record(spark):
    """Not inside the line, which looks into them cell by cell."""
    r = routing(spark, ("interns", {"columns": COLUMNS, "format": "json"}))
    plan = P.with_line(P.judge(deliveries(spark, [envelope()]), r), r)._jdf.queryExecution().optimizedPlan().toString()
    typed = [part for part in plan.splitlines() if "MapType(StringType,VariantType,true)" in part and "StructField(payload" in part]
    assert typed and not any("array_join(" in part for part in typed)


def test_lines_are_shuffled_once_and_written_nowhere(spark, monkeypatch):
    """Also where nothing is small enough to be broadcast; a record delivered often is cut down before the shuffle."""
    monkeypatch.setattr(P, "as_table", lambda *_: pytest.fail("a table was written"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(QUERIES["routed_lines"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(record_id", plan)) == 2  # lines, seen records
    assert re.search(r"Exchange hashpartitioning\(record_id[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plan)
