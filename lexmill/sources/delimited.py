"""CSV with quoted line breaks, read by many tasks a file."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.session import stage

LINES = "file string, block long, row long, value string, odd boolean, flips boolean"


def _mark_lines(batches: Iterator) -> Iterator:
    """(file, block, value) in file order, with each line's number in its block and the parity of the quotes before it.

    Only the count of lines and quotes of the current block is carried from batch to batch.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    here, rows, quotes = None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        names = files.indices.to_numpy()
        first = files.dictionary[int(names[0])].as_py(), int(blocks[0])
        if first != here:
            rows = quotes = 0
        starts = np.flatnonzero((names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        starts = np.concatenate([[0], starts])
        sizes = np.diff(np.append(starts, n))
        count = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(count) - count
        lead_rows, lead_quotes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        lead_rows[0], lead_quotes[0] = rows, quotes
        row = np.arange(n) - np.repeat(starts - lead_rows, sizes)
        before = before - np.repeat(before[starts] - lead_quotes, sizes)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(row), batch.column(2), pa.array(before % 2 == 1),
             pa.array(count % 2 == 1)], names=["file", "block", "row", "value", "odd", "flips"])
        here = files.dictionary[int(names[-1])].as_py(), int(blocks[-1])
        rows, quotes = int(row[-1]) + 1, int(before[-1] + count[-1]) % 2


def csv_records(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """(file, block, row, record): the records of RFC 4180 files, whole, with the place where each begins.

    A line break belongs to a record if the number of quotes before it in the file is odd. Each
    split of a file numbers its lines and takes their parity from its own first line on; one row per split, in
    file order, then tells the parity and the open record with which it begins. So a file is read by as many tasks as it
    has splits. Lines that are a record by themselves go on where they are; only the lines of longer
    records are shuffled, a group for each. The marked lines are written once, so that all steps see the same
    splits whatever executors come and go.

    Blank records are left out, a carriage return before the last line break is no part of a record, and the first record of
    each file is left out with ``header``. A quote that is still open at the end of a file fails the query. Quotes
    inside values must be doubled and their value quoted, as RFC 4180 asks; the text is UTF-8.
    """
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = stage(read.mapInArrow(_mark_lines, LINES), "lines")
    order = W.partitionBy("file").orderBy("block")
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    parity = lines.groupBy("file", "block").agg(F.sum(F.col("flips").cast("long")).alias("n"))
    unclosed = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("file")))
    parity = stage(parity.select(
        "file", "block", F.when(F.sum("n").over(W.partitionBy("file")) % 2 == 1, unclosed).otherwise(
            F.coalesce(F.sum("n").over(upto), F.lit(0)) % 2 == 1).cast("boolean").alias("begins_odd")), "splits")
    placed = lines.join(parity, ["file", "block"]).withColumn("inside", F.col("odd") != F.col("begins_odd"))
    alone = placed.where("not inside and not flips").select("file", "block", "row", F.col("value").alias("record"))

    parts = stage(placed.where("inside or flips").select("file", "block", "row", "value", "inside"), "parts")
    opens = F.when(~F.col("inside"), F.struct("block", "row"))
    last = parts.groupBy("file", "block").agg(F.max(opens).alias("last"))
    carried = last.select("file", "block", F.last("last", ignorenulls=True).over(upto).alias("carried"))
    within = W.partitionBy("file", "block").orderBy("row").rowsBetween(W.unboundedPreceding, 0)
    owned = parts.withColumn("own", F.last(opens, ignorenulls=True).over(within)).join(carried, ["file", "block"])
    owner = F.coalesce("own", "carried")
    joined = owned.withColumn("first", owner).groupBy("file", "first").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "value"))),
                                 lambda x: x["value"]), "\n").alias("record"))
    records = alone.unionByName(joined.select("file", "first.block", "first.row", "record"))
    if header:
        records = records.where((F.col("block") != 0) | (F.col("row") != 0))
    return records.withColumn("record", F.regexp_replace("record", "\r\\z", "")).where(F.trim("record") != "")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """The columns of ``schema`` from CSV whose quoted values may hold line breaks, commas and doubled quotes."""
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return csv_records(spark, path, header).select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
