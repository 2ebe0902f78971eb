"""A seen-set whose cost follows the batch: Bloom blocks tell which parts of the history may hold a record, and only those are read.

Ids are a bucketed Parquet table, partitioned by contract and commit. Whatever is asked for is shuffled to the buckets; the history is not. Beside the ids of each contract and
commit lies a Bloom filter of 64-bit blocks, built by an aggregation: an id sets a few bits of one block, so looking it up is one equality join.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waybill.operators.lookup import join_config
from waybill.schemas import RECORD, SEEN
from waybill.storage import Folder, as_table, new_folder
from waybill.streaming.gates import SeenTable

#: Buckets of a new store. A store keeps the number it was made with.
BUCKETS = 16
#: Ids a block is made for, and bits that each sets: about three ids in ten thousand pass a filter that they are not in.
_IDS, _BITS = 2, 6
#: Contracts, and parts of the history, up to which a filter names them; beyond, the join alone decides.
NAMED = 2_000


def _mask(record_id: str) -> Column:
    """The bits that an id sets in its block."""
    bits = [F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({record_id}, {k}), 64) AS INT))") for k in range(_BITS)]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), bits)


def _block(record_id: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(record_id), F.col(blocks))


def filters_of(ids: DataFrame) -> DataFrame:
    """contract_id, blocks, block, bits: a Bloom filter for each contract of (contract_id, record_id)."""
    sizes = ids.groupBy("contract_id").agg(F.ceil(F.count(F.lit(1)) / _IDS).alias("blocks"))
    placed = join_config(ids, sizes, ["contract_id"], ["record_id"], "inner")
    return placed.groupBy("contract_id", "blocks", _block("record_id", "blocks").alias("block")).agg(F.bit_or(_mask("record_id")).alias("bits"))


class IndexedSeenTable(SeenTable):
    """A `SeenTable` with buckets and Bloom blocks. `known_among` is what a job asks; the other methods are those of the plain one.

    The ids are read as an external table of the session's catalog, which is made anew from the folder by every session; so nothing has to outlast it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        super().__init__(spark, root)
        kept = self.folder.read_text("seen_buckets")
        if kept is None:
            self.folder.write_text(str(buckets), "seen_buckets")
        self.buckets = int(kept or buckets)
        self._name = f"waybill_seen_{hashlib.sha256(self.folder.root.encode()).hexdigest()[:24]}"

    # --- reading -------------------------------------------------------------------------------------------------

    def _table(self) -> DataFrame:
        place = self.folder.path("seen").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name} (record_id STRING, contract_id STRING, commit STRING) USING parquet "
            "OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY (contract_id, commit) CLUSTERED BY (record_id) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        self.spark.catalog.refreshTable(self._name)
        return self.spark.read.table(self._name)

    def _filters(self) -> DataFrame:
        layout = "block long, bits long, blocks long, contract_id string, commit string"
        return self.spark.read.schema(layout).parquet(self.folder.path("seen_filters"))

    def known_among(self, ids: DataFrame, commit: str | None = None) -> DataFrame:
        """Those of (contract_id, record_id), each there once, that another commit applied."""
        hits, parts = self._candidates(ids, commit)
        if hits is None:
            return self.spark.createDataFrame([], SEEN)
        return self._confirmed(hits, parts)

    def _candidates(self, ids: DataFrame, commit: str | None) -> tuple[DataFrame | None, list[tuple[str, str]] | None]:
        """Ids that pass a filter, as a table, and the parts of the history whose filters they pass (None: too many to name). Starts jobs."""
        if not self.folder.exists("seen_filters"):
            return None, None
        filters = self._filters()
        if commit is not None:
            filters = filters.where(F.col("commit") != commit)
        contracts = [r.contract_id for r in ids.select("contract_id").distinct().limit(NAMED + 1).collect()]
        if len(contracts) <= NAMED:
            filters = filters.where(F.col("contract_id").isin(*contracts))
        sizes = filters.select("contract_id", "commit", "blocks").distinct()
        probes = join_config(ids.select(*RECORD), sizes, ["contract_id"], ["record_id"], "inner")
        probes = probes.select(*RECORD, "commit", _block("record_id", "blocks").alias("block"), _mask("record_id").alias("mask"))
        met = probes.join(filters.select("contract_id", "commit", "block", "bits"), ["contract_id", "commit", "block"])
        hits = met.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(*RECORD, "commit")
        hits = as_table(hits, new_folder(self.spark, "seen-hits"))
        parts = [tuple(r) for r in hits.select("contract_id", "commit").distinct().limit(NAMED + 1).collect()]
        return hits.select(*RECORD).distinct(), parts if len(parts) <= NAMED else None

    def _confirmed(self, hits: DataFrame, parts: list[tuple[str, str]] | None) -> DataFrame:
        """Those of hits that are in the named parts of the history. The history is read by buckets and not shuffled."""
        history = self._table()
        if parts is not None:
            by_contract: dict[str, list[str]] = {}
            for contract, commit in parts:
                by_contract.setdefault(contract, []).append(commit)
            named = [(F.col("contract_id") == c) & F.col("commit").isin(*names) for c, names in by_contract.items()]
            history = history.where(functools.reduce(lambda a, b: a | b, named, F.lit(False)))
        h = history.select("record_id", F.col("contract_id").alias("_contract"))
        # Joined on the bucket column alone: a second key would need a shuffle of the history. So the contracts are compared from both sides.
        same = (F.col("contract_id") <= F.col("_contract")) & (F.col("contract_id") >= F.col("_contract"))
        return hits.join(h, (hits["record_id"] == h["record_id"]) & same, "left_semi")

    # --- writing -------------------------------------------------------------------------------------------------

    def mark(self, applied: DataFrame, commit: str) -> None:
        self._put(applied.select(*RECORD), commit)

    def _put(self, ids: DataFrame, commit: str) -> None:
        """Ids and their filters as this commit's; what it wrote before is replaced. Filters go last: without them a repeated commit is not seen by others."""
        self._table()
        ids = ids.withColumn("commit", F.lit(commit))
        rows = ids.repartition(self.buckets, "record_id").select("record_id", "contract_id", "commit")
        rows.write.mode("overwrite").insertInto(self._name)  # which replaces the commit's own parts, by the table's option
        written = self._table().where(F.col("commit") == commit).select(*RECORD)
        filters = filters_of(written).withColumn("commit", F.lit(commit)).hint("rebalance", "contract_id")
        filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("contract_id", "commit").parquet(self.folder.path("seen_filters"))

    def forget(self, contract_id: str) -> None:
        folder = self._contract_folder(contract_id)
        super().forget(contract_id)
        if folder is not None:
            self.folder.remove("seen_filters", folder)

    def compact(self, contract_id: str, last_commit: str) -> None:
        """Merges the commits of a contract into one, with one filter, but for a commit that may be repeated."""
        folder = self._contract_folder(contract_id)
        names = [n for n in self.folder.names("seen", folder) if n != f"commit={last_commit}"] if folder else []
        if len(names) < 2:
            return
        commits = [n.removeprefix("commit=") for n in names]
        ids = self._table().where((F.col("contract_id") == contract_id) & F.col("commit").isin(*commits)).select(*RECORD).distinct()
        self._put(ids, f"merged-{len(names)}-{commits[-1]}")
        # Until the old parts are gone some ids are stored twice, which changes nothing in a set.
        for name in names:
            self.folder.remove("seen_filters", folder, name)
            self.folder.remove("seen", folder, name)
