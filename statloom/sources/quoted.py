"""Delimited text with line breaks inside quotes, read by as many tasks as the files have splits.

Whether a line begins inside quotes depends on the quotes before it in its file: it does if their number
is odd. The quotes of every split are counted first, and a running sum over a file's splits (a row each)
tells every split how it begins. A second pass cuts each split into records on its own. Only records
that reach over the end of a split are put together from pieces, one piece per split.

Every quote has to be part of a quoted field, as RFC 4180 has it. A file whose quotes don't come out
even breaks that rule; the caller reads it as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.session import settle, share_package

RECORDS = "file string, block long, piece string, place long, starts boolean, ends boolean, record string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, line)``: all lines with their file and the place of their split."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def splits(rows: DataFrame, quote: str) -> DataFrame:
    """A row per split: ``(file, block, quotes, odd, broken, before, whole)``.

    ``odd`` says that some line has an odd number of quotes, ``broken`` that one isn't UTF-8; ``before`` and
    ``whole`` count the quotes of the file before the split and in all.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote)))
    facts = rows.groupBy("file", "block").agg(
        F.sum(quotes).alias("quotes"), F.max(quotes % 2 == 1).alias("odd"), F.max(~F.is_valid_utf8("line")).alias("broken")
    )
    facts = settle(facts, "csv-splits")
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("quotes").over(Window.partitionBy("file"))
    return facts.select("*", F.coalesce(F.sum("quotes").over(ahead), F.lit(0)).alias("before"), whole.alias("whole"))


def _cut(opened: dict[tuple[str, int], bool], quote: str):
    """A function from the lines of a task's splits to records and to pieces of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        inside, place = False, 0
        held: list[str] | None = None  # lines of a record that isn't closed yet
        head = False  # it began in an earlier split
        rows: list[tuple] = []

        def flush(end: bool) -> None:
            nonlocal held, place
            if held is not None:
                rows.append((*at, "\n".join(held), place, not head, end))
                held, place = None, place + 1

        for batch in batches:
            marks = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
            change = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
            for start, stop in zip(change[:-1], change[1:]):
                if start == stop:
                    continue
                if marks[start] != at:
                    flush(False)
                    at, place = marks[start], 0
                    inside = head = opened[at]
                some = batch.column("line").slice(start, stop - start)
                odd = pc.count_substring(some, quote).to_numpy() % 2 == 1
                begins = np.logical_xor.accumulate(np.concatenate([[inside], odd]))  # inside quotes at the line's start
                values = some.to_pylist()
                for i, line in enumerate(values):
                    if begins[i]:
                        held = held or []
                        held.append(line)
                    else:
                        held, head = [line], False
                    if not begins[i + 1]:
                        flush(True)
                inside = bool(begins[-1])
            if rows:
                yield _batch(rows)
                rows = []
        flush(False)
        if rows:
            yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        file, block, record, place, starts, ends = zip(*rows)
        whole = [s and e for s, e in zip(starts, ends)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(file, pa.string()),
                pa.array(block, pa.int64()),
                pa.array([None if w else r for w, r in zip(whole, record)], pa.string()),
                pa.array(place, pa.int64()),
                pa.array(starts, pa.bool_()),
                pa.array(ends, pa.bool_()),
                pa.array([r if w else None for w, r in zip(whole, record)], pa.string()),
            ],
            names=["file", "block", "piece", "place", "starts", "ends", "record"],
        )

    return run


def records(rows: DataFrame, parts: DataFrame, quote: str) -> DataFrame:
    """``(file, first, record)``: all records, line breaks included; ``first`` marks the first of a file.

    ``parts`` are the splits; which of them begin inside quotes is sent to all tasks (a row per split of
    the input, two numbers and a flag).
    """
    spark = rows.sparkSession
    share_package(spark)
    known = parts.select("file", "block", (F.col("before") % 2 == 1).alias("inside"))
    opened = {(r["file"], r["block"]): r["inside"] for r in known.collect()}
    found = rows.mapInArrow(_cut(opened, quote), RECORDS)
    whole = found.where("record is not null").select("file", ((F.col("block") == 0) & (F.col("place") == 0)).alias("first"), "record")
    # pieces in the order of their splits; every one that starts a record opens a new one
    pieces = found.where("record is null")
    along = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.withColumn("n", F.sum(F.col("starts").cast("int")).over(along))
    listed = numbered.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("block", "place", "piece"))).alias("l"))
    joined = listed.select(
        "file",
        ((F.col("l")[0]["block"] == 0) & (F.col("l")[0]["place"] == 0)).alias("first"),
        F.array_join(F.transform("l", lambda p: p["piece"]), "\n").alias("record"),
    )
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", "")).where("trim(record) <> ''")


def narrowest(cell: Column) -> Column:
    """How special a text is: 0 none, 1 int, 2 long, 3 double, 4 date, 5 timestamp, 6 boolean, 7 text."""
    whole = cell.rlike(r"^[+-]?\d+$")
    day = cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull()
    moment = cell.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d") & cell.try_cast("timestamp").isNotNull()
    numeric = cell.rlike(r"^[^\s]+$") & cell.try_cast("double").isNotNull()
    kind = F.when(cell.isNull(), 0).when(whole & cell.try_cast("int").isNotNull(), 1).when(whole & cell.try_cast("long").isNotNull(), 2)
    return kind.when(numeric, 3).when(day, 4).when(moment, 5).when(F.lower(cell).isin("true", "false"), 6).otherwise(7)


def inferred(texts: DataFrame) -> T.StructType:
    """The narrowest type that holds all values of every column of texts, in one aggregate."""
    cells = [F.collect_set(narrowest(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(texts.columns)]  # at most 8 numbers each
    facts = texts.agg(*cells).first()
    fields = []
    for i, c in enumerate(texts.columns):
        kinds = set(facts[f"k{i}"]) - {0}
        if kinds and kinds <= {1, 2, 3}:
            kind = {1: T.IntegerType(), 2: T.LongType(), 3: T.DoubleType()}[max(kinds)]
        elif kinds and kinds <= {4, 5}:
            kind = T.DateType() if kinds == {4} else T.TimestampType()
        else:
            kind = T.BooleanType() if kinds == {6} else T.StringType()
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def parsed(found: DataFrame, schema: T.StructType, sep: str, quote: str) -> DataFrame:
    """The fields of records; too short ones are filled up with NULL."""
    row = F.from_csv("record", _ddl(schema), {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"})
    return found.select(row.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
