"""What was applied before. A gate is asked before a commit is written and told afterwards."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from waybill.operators.gate import Inherited, take_over
from waybill.schemas import RECORD
from waybill.sources.stores import import_ids, read_seen
from waybill.storage import Folder, as_table, unescape_path


class Gate(Protocol):
    def seen(self, commit: str) -> DataFrame:
        """(contract_id, record_id) applied by any other commit."""

    def inherited(self) -> Inherited | None:
        """Ids that count as seen for many contracts, if there are any."""

    def mark(self, applied: DataFrame, commit: str) -> None:
        """Remembers what a commit applied; called after the write, and again if the commit is repeated."""


class SeenTable:
    """The seen-set as a Parquet table, one folder per contract and commit.

    A commit does not see its own marks, so a repeated commit decides as it did at first and replaces them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = Folder(spark, root)

    def seen(self, commit: str | None = None) -> DataFrame:
        return read_seen(self.spark, self.folder.path("seen"), self.folder.exists("seen"), commit)

    def mark(self, applied: DataFrame, commit: str) -> None:
        # Rebalancing keeps the number of files low and still splits a contract that dominates.
        rows = applied.select(*RECORD, F.lit(commit).alias("commit")).hint("rebalance", "contract_id")
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("contract_id", "commit").parquet(self.folder.path("seen"))
        )

    def forget(self, contract_id: str) -> None:
        """Drops what is known of one contract, so that its records can be delivered again; an error if nothing is."""
        folder = self._contract_folder(contract_id)
        if folder is None and not self.folder.exists("inherited"):
            raise KeyError(f"no record of contract {contract_id!r} was seen")
        if folder is not None:
            self.folder.remove("seen", folder)
        if self.folder.exists("inherited"):
            self._exempt({*self._exempted(), contract_id})

    def compact(self, contract_id: str, last_commit: str) -> None:
        """Merges the small files of a contract, except those of a commit that may be repeated."""
        folder = self._contract_folder(contract_id)
        names = [n for n in self.folder.names("seen", folder) if n != f"commit={last_commit}"] if folder else []
        if len(names) < 2:
            return
        paths = [self.folder.path("seen", folder, n) for n in names]
        merged = f"commit=merged-{len(names)}-{names[-1].removeprefix('commit=')}"
        ids = self.spark.read.schema("record_id string").parquet(*paths).distinct()
        ids.write.mode("overwrite").parquet(self.folder.path("seen", folder, merged))
        # Until the old files are gone some ids are stored twice, which changes nothing in a set.
        for name in names:
            self.folder.remove("seen", folder, name)

    def compact_all(self, last_commit: str) -> None:
        """Compacts every contract, so that folders stay bounded by contracts and not by commits."""
        for folder in self.folder.names("seen"):
            if folder.startswith("contract_id="):
                self.compact(unescape_path(folder.removeprefix("contract_id=")), last_commit)

    def _contract_folder(self, contract_id: str) -> str | None:
        """The folder of a contract, whose id may be escaped in its name."""
        names = (n for n in self.folder.names("seen") if n.startswith("contract_id="))
        return next((n for n in names if unescape_path(n.removeprefix("contract_id=")) == contract_id), None)

    def take_over(self, text_store: str) -> None:
        """Takes over a text store that knew no contracts; the store itself is left as it is. Done once."""
        if self.folder.complete("inherited", "ids"):
            return
        old = take_over(self.seen(), import_ids(self.spark, text_store))
        self._exempt(set(old.exempt))
        as_table(old.ids, self.folder.path("inherited", "ids"))

    def inherited(self) -> Inherited | None:
        if not self.folder.complete("inherited", "ids"):
            return None
        ids = self.spark.read.schema("record_id string").parquet(self.folder.path("inherited", "ids"))
        return Inherited(ids, tuple(sorted(self._exempted())))

    def _exempted(self) -> set[str]:
        return set((self.folder.read_text("inherited", "exempt") or "").split("\n")) - {""}

    def _exempt(self, contracts: set[str]) -> None:
        self.folder.write_text("\n".join(sorted(contracts)), "inherited", "exempt")
