"""Reading what jobs wrote: the seen-set, text stores of ids, delivered CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from waybill.operators.envelope import UUID
from waybill.schemas import READBACK, RECORD, SEEN
from waybill.storage import Folder, as_table, new_folder


def read_seen(spark: SparkSession, path: str, exists: bool = True, but_commit: str | None = None) -> DataFrame:
    """Seen records; `but_commit` leaves out what that commit itself wrote, so that it can be repeated."""
    if not exists:
        return spark.createDataFrame([], SEEN)
    layout = T.StructType([*SEEN.fields, T.StructField("commit", T.StringType())])
    seen = spark.read.schema(layout).parquet(path)
    if but_commit is not None:
        seen = seen.where(F.col("commit") != but_commit)
    return seen.select(*RECORD)


def import_ids(spark: SparkSession, path: str) -> DataFrame:
    """Record ids from a text store: one per line, blanks around them and empty lines ignored.

    A line that is no id stops the import, since a store that is half read would let copies through.
    """
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    wrong = F.raise_error(F.concat(F.lit("not a record id: "), F.col("id")))
    return (
        spark.read.text(path).select(line.alias("id")).where("id <> ''")
        .select(F.when(F.col("id").rlike(UUID), F.lower("id")).otherwise(wrong).alias("record_id"))
        .distinct()
    )


def read_back(spark: SparkSession, path: str, schema: T.StructType = READBACK, header: bool = False) -> DataFrame:
    """Delivered CSV lines as rows of text; an empty field stays ''.

    Lines end with a line feed only, and a quoted value may hold one, so the files are read in multi-line
    mode, one file a task. A target that is not there, or that holds nothing but its header, has no rows.
    """
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("header", header).option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("lineSep", "\n").option("recursiveFileLookup", True)
        .csv(path)
        .fillna("")
    )


def read_single_file(spark: SparkSession, path: str, schema: T.StructType = READBACK) -> DataFrame:
    """What `read_back` gives for one file that begins with a header line, but read by as many tasks as it has splits.

    A line begins a record if the quotes of all lines before it are even in number. They are counted a split at first, so that each split knows how it begins; a record that
    goes on in later splits gets its pieces from there. Pieces are written as a table in the shared folder.
    """
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), "value", quotes.alias("quotes"))
    # The header line is no record; its quotes mean nothing.
    header = F.when(F.col("split") == 0, F.min_by("quotes", "id")).otherwise(0)
    totals = lines.groupBy("split").agg((F.sum("quotes") - header).alias("quotes"))
    earlier = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    opening = totals.select("split", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("opening"))
    # Several places a split, so that few splits meet in one.
    placed = lines.repartition(4 * text.rdd.getNumPartitions(), "split").withColumn("n", F.row_number().over(Window.partitionBy("split").orderBy("id")))
    placed = placed.where("split > 0 OR n > 1").join(F.broadcast(opening), "split")
    before = Window.partitionBy("split").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    so_far = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.col("opening") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 1
    begun = placed.withColumn("inside", inside).withColumn("start", F.last(F.when(~F.col("inside"), F.col("n")), ignorenulls=True).over(so_far))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]), "\n")
    pieces = as_table(begun.groupBy("split", "start").agg(joined.alias("text")), new_folder(spark, "pieces"))
    # A piece without a start, at most one a split, belongs to the last record that began before its split.
    last = pieces.groupBy("split").agg(F.max("start").alias("start"))
    owner = F.last(F.when(F.col("start").isNotNull(), F.struct("split", "start")), ignorenulls=True).over(earlier)
    tails = pieces.where("start IS NULL").select("split", "text").join(last.select("split", owner.alias("owner")), "split")
    tails = tails.groupBy("owner.split", "owner.start").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col("split").alias("at"), "text"))), lambda x: x["text"]), "\n").alias("tail"))
    records = pieces.where("start IS NOT NULL").join(F.broadcast(tails), ["split", "start"], "left").select(F.concat_ws("\n", "text", "tail").alias("record"))
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n"}
    return records.where("record <> ''").select(F.from_csv("record", layout, options).alias("r")).select("r.*").fillna("")
