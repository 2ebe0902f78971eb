"""Where lines go. A target gets all lines of one commit at once and must bear being given them again."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F

from waybill.schemas import COORDS
from waybill.storage import Folder, unescape_path


class Target(Protocol):
    def write(self, lines: DataFrame, target: str, header: str | None, commit: str) -> None:
        """Writes `line` of all rows to `target`; repeating a commit must not add lines."""


class DeadLetters(Protocol):
    def write(self, entries: DataFrame, commit: str) -> None:
        """Publishes the dead letters of a commit, `key` and `value` each; repeating a commit must not add any."""


class FileTarget:
    """A directory per target: `_header`, and `commit=<id>/part-*` with one record per line.

    The header is settled by the first commit and never written again. Lines are in delivery order throughout a commit: by topic,
    partition and offset, also from one part file to the next. So `cat _header commit=*/part-*` gives the target as one file,
    and `export_single_file` makes that file. Order costs one range shuffle of the lines of a commit.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, root)

    def path(self, target: str) -> str:
        return target if target.startswith("/") or "://" in target else self.folder.path(target)

    def write(self, lines: DataFrame, target: str, header: str | None, commit: str) -> None:
        place = Folder(lines.sparkSession, self.path(target))
        if place.complete(f"commit={commit}"):
            return
        if not place.exists("_header"):
            place.write_text("" if header is None else header + "\n", "_header")
        rows = lines.orderBy(*COORDS)
        rows.select("line").write.mode("overwrite").option("lineSep", "\n").text(place.path(f"commit={commit}"))

    def header(self, target: str) -> str | None:
        """The header line of a target, if it was written to and has one."""
        return (Folder(self.folder.spark, self.path(target)).read_text("_header") or "").removesuffix("\n") or None

    def export_single_file(self, target: str, destination: str) -> None:
        """Header and lines in order as one file, streamed through the driver; nothing is held whole. A target that was never written to gives an empty file."""
        place = Folder(self.folder.spark, self.path(target))
        commits = [n for n in place.names() if n.startswith("commit=") and place.complete(n)]
        parts = [(c, n) for c in commits for n in place.names(c) if n.startswith("part-")]
        place.concat([("_header",), *parts] if place.exists("_header") else parts, destination)


class TogetherTarget(FileTarget):
    """File targets that are written all at once: the number of Spark jobs of a commit does not depend on the number of targets.

    The lines of a commit are dealt into ranges of target and delivery order and written by one job to a folder beside the targets, laid out by target. Each
    target's part is then moved to its place, as `commit=<id>`; a move is seen whole or not at all. A manifest names the targets that have theirs, so a commit that is
    repeated goes on with the others. A target on another file system is written by a job of its own.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.commits = Folder(spark, f"{self.folder.root}.commits")

    def stage(self, lines: DataFrame, commit: str) -> None:
        """One write for all targets; nothing is done if it was finished before."""
        if self.commits.complete(f"commit={commit}", "lines"):
            return
        order = ["target", *COORDS]
        rows = lines.repartitionByRange(*order).sortWithinPartitions(*order).select("target", "line")
        rows.write.mode("overwrite").option("lineSep", "\n").partitionBy("target").text(self.commits.path(f"commit={commit}", "lines"))

    def publish(self, lines: DataFrame, target: str, header: str | None, commit: str) -> None:
        """Gives a target its staged lines; repeating it does nothing."""
        place = Folder(self.folder.spark, self.path(target))
        if place.complete(f"commit={commit}"):
            return
        if not self._same_system(place):
            self.write(lines.where(F.col("target") == target), target, header, commit)
            return
        if not place.exists("_header"):
            place.write_text("" if header is None else header + "\n", "_header")
        folder = self._staged(commit)[target]
        self.commits.write_text("", f"commit={commit}", "lines", folder, "_SUCCESS")
        self.commits.move((f"commit={commit}", "lines", folder), place.path(f"commit={commit}"))

    def finish(self, targets: list[str], commit: str) -> None:
        """Writes the manifest and clears away what is left of the commit."""
        self.commits.write_text(json.dumps({"commit": commit, "targets": sorted(targets)}), "manifests", f"commit={commit}.json")
        self.commits.remove(f"commit={commit}")

    def finished(self, commit: str) -> list[str]:
        """The targets that have their lines of a commit, as its manifest says."""
        text = self.commits.read_text("manifests", f"commit={commit}.json")
        return [] if text is None else json.loads(text)["targets"]

    def _staged(self, commit: str) -> dict[str, str]:
        names = (n for n in self.commits.names(f"commit={commit}", "lines") if n.startswith("target="))
        return {unescape_path(n.removeprefix("target=")): n for n in names}

    def _same_system(self, place: Folder) -> bool:
        return place.system() == self.commits.system()


class JsonDeadLetters:
    """Dead letters as JSON lines, a folder per commit."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def write(self, entries: DataFrame, commit: str) -> None:
        entries.select("value").write.mode("overwrite").text(f"{self.root}/commit={commit}")


class TopicDeadLetters:
    """Dead letters to a topic, by Spark's Kafka connector. A commit that is repeated after a crash sends them again."""

    def __init__(self, servers: str, topic: str):
        self.servers, self.topic = servers, topic

    def write(self, entries: DataFrame, commit: str) -> None:
        entries.write.format("kafka").option("kafka.bootstrap.servers", self.servers).option("topic", self.topic).save()
