"""Times the headline queries: one JSON line. $BENCH_SF_DIR names the tables, $BENCH_CPUS the cores."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from waybill.checks import derived as D
from waybill.checks.queries import QUERIES
from waybill.operators import gate
from waybill.plans import delivery as P
from waybill.schemas import COORDS, RECORD
from waybill.sources.delivery_log import topic_matches
from waybill.storage import as_table, new_folder
from waybill.streaming.gates import SeenTable
from waybill.streaming.job import DeliveryJob, Settings

HEADLINE = [
    "topic_scan", "parse_outcome", "envelope_project", "schema_violations", "violation_counts", "contract_join",
    "dynamic_project", "csv_lines", "jsonl_lines", "xml_lines", "first_delivery", "unseen_records", "routed_lines",
    "outcome_counts", "dlq_entries", "attachment_index", "classify_failures", "csv_readback",
]


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("waybill-bench")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    rates: dict[str, int] = {}

    def timed(name, run, rows=None):
        start = time.perf_counter()
        run()
        took = time.perf_counter() - start
        times[name] = round(took, 3)
        if rows:
            rates[name] = int(rows / took)

    # The log as a table, so that rates are those of the operators and not of making the input.
    log = as_table(D.event_log(spark, sf_dir).where(topic_matches()), new_folder(spark, "bench-log"))
    n = log.count()
    noop(QUERIES["routed_lines"](spark, sf_dir))  # warm-up

    for name in HEADLINE:
        timed(name, lambda: noop(QUERIES[name](spark, sf_dir)))

    def routing() -> P.Routing:
        return P.Routing.from_listing(D.event_listing(spark), D.ENVELOPE_SCHEMA, D.DEFAULT_TARGET)

    timed("log_to_lines", lambda: noop(P.routed_lines(log, routing(), D.event_seen(spark, sf_dir))), n)
    timed("log_to_staged", lambda: noop(P.staged(log, routing())), n)

    # The gate with none, half and all of the records seen before.
    judged = P.judge(log, routing(), "inner").where("verdict = 'ready'").select(*COORDS, *RECORD)
    ready = as_table(judged, new_folder(spark, "bench-ready"))
    for share in (0, 50, 100):
        seen = as_table(ready.where(f"pmod(xxhash64(record_id), 100) < {share}").select(*RECORD), new_folder(spark, "bench-seen"))
        timed(f"gate_{share}_percent_seen", lambda: noop(gate.applied_coords(ready, seen)), ready.count())

    def stream() -> None:
        root = new_folder(spark, "bench-job")
        log.repartition(4).write.parquet(f"{root}/log")
        job = DeliveryJob(
            spark, "bench", root, lambda s: s.readStream.schema(log.schema).parquet(f"{root}/log"),
            D.event_listing, D.ENVELOPE_SCHEMA, Settings(D.DEFAULT_TARGET), gate=SeenTable(spark, root),
        )
        job.run_available()

    timed("stream_full_commit", stream, n)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows_per_second": rates, "log_rows": n, "sf": os.path.basename(sf_dir),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
