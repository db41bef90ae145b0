"""Records of large CSV files whose cells hold line breaks, each file read by many tasks.

A file is cut at lines, wherever they are. Quotes tell where a record ends: inside a
cell there is an odd number of them before. So

1. the quotes of every split are counted, which gives, summed up over the splits
   before it, whether a split begins inside a cell;
2. every task joins the lines of its splits to records, knowing how each begins;
3. a record that runs over the end of a split is put together from its pieces.

Quotes within a cell are doubled, and a cell that holds a quote or a line break is
quoted, as usual and as the writers here do. Only pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.session import stage

WHOLE, HEAD, TAIL, MIDDLE = range(4)


def lines(spark: SparkSession, path) -> DataFrame:
    """``file, begin, value``: the lines of each split, in order within it."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")


def splits(spark: SparkSession, path) -> DataFrame:
    """``file, begin, inside, first``: whether a split begins inside a cell, and the first line of the file. A row per split, stored."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    first = F.min_by(F.when(F.col("begin") == 0, F.col("value")), "place")
    placed = lines(spark, path).withColumn("place", F.monotonically_increasing_id())
    each = placed.groupBy("file", "begin").agg(F.sum(quotes).alias("quotes"), first.alias("first"))
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before) % 2 == 1, F.lit(False))
    return stage(each.select("file", "begin", inside.alias("inside"), "first"))


def _pieces(spark: SparkSession, path, inside: DataFrame) -> DataFrame:
    """``file, begin, kind, is_first, record``: records, and pieces of those that run over the end of a split."""
    # A row per split that begins inside a cell: some ten bytes for 128 megabytes of text, two million rows for 256 terabytes.
    known = lines(spark, path).join(F.broadcast(inside.withColumn("inside", F.lit(True))), ["file", "begin"], "left")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "begin", "kind", "is_first", "record"]
        split, held, kind, inside, first, out = None, [], WHOLE, False, False, []

        def done(kind: int) -> None:
            nonlocal first
            piece = "\n".join(held)
            # At the end of a record it belongs to the line end, before that to the cell.
            out.append((*split, kind, first, piece.removesuffix("\r") if kind in (WHOLE, HEAD) else piece))
            held.clear()
            first = False

        def flushed() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names)
            out.clear()
            return made

        for batch in batches:
            odd = pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1).to_pylist()
            for file, begin, value, open_, turns in zip(*(batch.column(n).to_pylist() for n in ("file", "begin", "value", "inside")), odd):
                if (file, begin) != split:
                    if held:
                        done(MIDDLE if kind == HEAD else TAIL)
                    split, inside, first = (file, begin), bool(open_), begin == 0
                    kind = HEAD if inside else WHOLE
                held.append(value)
                inside ^= bool(turns)
                if not inside:
                    done(kind)
                    kind = WHOLE
            yield flushed()
        if held:
            done(MIDDLE if kind == HEAD else TAIL)
            yield flushed()

    schema = "file string, begin bigint, kind int, is_first boolean, record string"
    return known.select("file", "begin", "value", "inside").mapInArrow(joined, schema)


def _put_together(pieces: DataFrame) -> DataFrame:
    """``file, is_first, record`` of the records in pieces. A tail begins one; heads and middles of later splits go on with it."""
    # The head of a split comes before its tail.
    order = ["begin", "kind"]
    so_far = Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.count_if(F.col("kind") == TAIL).over(so_far)
    placed = pieces.select("file", *order).withColumn("number", number)
    parts = F.array_sort(F.collect_list(F.struct(*order, "record")))
    whole = pieces.join(placed, ["file", *order]).groupBy("file", "number").agg(parts.alias("parts"), F.max("is_first").alias("is_first"))
    return whole.select("file", "is_first", F.array_join("parts.record", "\n").alias("record"))


def records(spark: SparkSession, path, known: DataFrame) -> DataFrame:
    """``file, record`` of all records but the first of each file, its header; empty lines are none.

    ``known`` are the ``splits`` of these files. Where none begins inside a cell,
    the files are read once, else those that have such splits once more.
    """
    inside = known.filter("inside").select("file", "begin")
    pieces = _pieces(spark, path, inside)
    found = pieces.filter(F.col("kind") == WHOLE).select("file", "is_first", "record")
    if not inside.isEmpty():
        cut = stage(_pieces(spark, path, inside).filter(F.col("kind") != WHOLE))
        found = found.unionByName(_put_together(cut))
    return found.filter(~F.col("is_first") & (F.col("record") != "")).select("file", "record")
