"""Joining a large table with a configuration table whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A table within both limits is broadcast; anything larger is joined by a spread shuffle.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20

# A key with at least this many rows is kept out of plain shuffles.
HOT_COPIES = 100_000

_FLAT = {"string", "int", "bigint", "boolean"}

# How many ways a hot key is split by the spread shuffle.
SPREAD = 64


def measure(table: DataFrame) -> tuple[int, int]:
    """Rows of a table and bytes of their text; starts one job, which counts per task and adds up."""
    parts = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(1)) if f.dataType.simpleString() in _FLAT
             else F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(1)) for f in table.schema.fields]
    size = parts[0]
    for part in parts[1:]:
        size = size + part
    return tuple(table.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first())


def fits_broadcast(table: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Whether a table is within the limits given, or else within those for configuration."""
    n, total = measure(table)
    return n <= (BROADCAST_ROWS if rows is None else rows) and total <= (BROADCAST_BYTES if size is None else size)


def join_config(
    large: DataFrame, config: DataFrame, keys: list[str], spread: list[str], how: str = "left",
    broadcast: bool | None = None,
) -> DataFrame:
    """`large` joined with `config` (at most one row per key).

    Many rows of `large` may share a key. Below the size limits `config` is broadcast, so nothing is
    shuffled. Beyond them each key is split into SPREAD parts by the `spread` columns, so that a hot key is
    worked on by many tasks.
    """
    if broadcast is None:
        broadcast = fits_broadcast(config)
    if broadcast:
        return large.join(F.broadcast(config), keys, how)
    return spread_join(large, config, keys, spread, how)


def part_of(spread: list[str], parts: int = SPREAD) -> Column:
    return F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int")


def spread_join(
    large: DataFrame, small: DataFrame, keys: list[str], spread: list[str], how: str, parts: int = SPREAD
) -> DataFrame:
    """Shuffle join in which every key of `large` is split into `parts`; `small` is repeated for each part."""
    left = large.withColumn("_part", part_of(spread, parts))
    right = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(right, [*keys, "_part"], how).drop("_part")


def join_unique(
    large: DataFrame, unique: DataFrame, keys: list[str], spread: list[str], most: int | None = None
) -> DataFrame:
    """`large` left-joined with `unique` (one row per key), however many rows of `large` share a key.

    most: the rows of the most frequent key, if they are known already.

    Keys with very many rows are counted first, with partial counts per task. There are few of them, so what
    `unique` knows about them is broadcast; all other keys are joined by a plain shuffle. Should the hot
    keys be too many to broadcast, every key is spread. `large` is read twice and should be a table.
    """
    if most is not None and most < HOT_COPIES:
        return large.join(unique, keys, "left")
    hot = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= HOT_COPIES).select(*keys)
    n, size = measure(hot)
    if n == 0:
        return large.join(unique, keys, "left")
    if n > BROADCAST_ROWS or size > BROADCAST_BYTES:
        return spread_join(large, unique, keys, spread, "left")
    marked = large.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    few = marked.where("_hot IS NULL").drop("_hot").join(unique, keys, "left")
    about_hot = unique.join(F.broadcast(hot), keys, "left_semi")
    many = marked.where("_hot").drop("_hot").join(F.broadcast(about_hot), keys, "left")
    return few.unionByName(many)
