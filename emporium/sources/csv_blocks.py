"""CSV files with quoted newlines, read by many tasks.

Such a file can't be cut at any newline: whether a newline ends a record depends on all quotes before it. The file
is read as plain lines, which Spark splits into blocks. A first pass takes of each block whether its number of quotes is
odd, and how many lines begin a record if the block begins outside of quotes (or inside). A prefix scan over the blocks of a file
(one row a block) then tells for each block where it begins, and the number of its first record. The second pass
joins lines to records inside the blocks; only the pieces of records that cross blocks, at most two a block, are
shuffled. Every quote must enclose a field or stand doubled inside one (RFC 4180); a record with another quote is an
error, because it would shift all that follows.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

MOST_BLOCKS = 1_000_000  # of which the facts are broadcast, about 100 MB
BLOCK = "file string, block long"
SUMMARY = f"{BLOCK}, odd int, outside long, inside long"
RECORDS = f"{BLOCK}, number long, whole boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in order within each block; a block is read by one task from its start to its end."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _block_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of a batch that lie in one block."""
    if not batch.num_rows:
        return
    block = batch.column(1).to_numpy()
    file = batch.column(0).dictionary_encode().indices.to_numpy()
    cut = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        yield (batch.column(0)[a].as_py(), int(block[a])), batch.slice(a, b - a)


def _odd_before(lines: pa.Array, odd: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside of quotes, and whether the next one does."""
    quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + int(odd)
    inside = np.concatenate([[int(odd)], quotes[:-1]]) & 1
    return inside.astype(bool), bool(quotes[-1] & 1)


def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block (several, if batches of blocks take turns): parity of quotes, records begun."""
    at, odd, outside, lines = None, False, 0, 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]]), pa.array([at[1]]), pa.array([int(odd)], pa.int32()), pa.array([outside]),
             pa.array([lines - outside])], names=["file", "block", "odd", "outside", "inside"])

    for batch in batches:
        for block, part in _block_runs(batch):
            if block != at:
                if at is not None:
                    yield done()
                at, odd, outside, lines = block, False, 0, 0
            inside, odd = _odd_before(part.column(2), odd)
            outside += int((~inside).sum())
            lines += len(inside)
    if at is not None:
        yield done()


def block_table(lines: DataFrame) -> DataFrame:
    """Per block: does it begin inside of quotes, and how many records begin before it in its file."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    started = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    return (lines.mapInArrow(summaries, SUMMARY)
            .withColumn("begins_inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
            .withColumn("first_number", F.coalesce(F.sum(started).over(before), F.lit(0)))
            .select("file", "block", "begins_inside", "first_number"))


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """The lines from each start to the next as one text."""
    if len(starts) == len(lines):
        return lines
    offsets = pa.array(np.append(starts, len(lines)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _records_of_blocks(header: Sequence[str]):
    """Function of batches ``(file, block, value, begins_inside, first_number)`` to records and pieces of records."""
    columns = ["file", "block", "number", "whole", "text"]

    def made(at: tuple[str, int], number: np.ndarray, whole: np.ndarray, text: pa.Array) -> pa.RecordBatch:
        n = len(text)
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * n, pa.string()), pa.array(np.full(n, at[1])), pa.array(number),
                                           pa.array(whole), text.cast(pa.string())], names=columns)

    def check(text: str) -> None:
        names = next(csv.reader([text.removesuffix("\r")], strict=True), [])
        if names != list(header):
            raise ValueError(f"a file has the header {names}, another one {list(header)}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, odd, number = None, False, 0
        held: list[str] = []  # lines of the record that is open
        begun = False  # whether it began in this block

        def tail() -> Iterator[pa.RecordBatch]:
            """What is open at the end of a block: a whole record unless it ends inside of quotes."""
            if held:
                yield made(at, np.array([number - 1 if begun else -1]), np.array([begun and not odd]),
                           pa.array(["\n".join(held)]))

        for batch in batches:
            for block, part in _block_runs(batch):
                if block != at:
                    if at is not None:
                        yield from tail()
                    at, held, begun = block, [], False
                    odd, number = part.column(3)[0].as_py(), part.column(4)[0].as_py()
                lines = part.column(2)
                inside, after = _odd_before(lines, odd)
                starts = np.flatnonzero(~inside)
                first = int(starts[0]) if len(starts) else len(lines)
                held += lines[:first].to_pylist()
                if len(starts):
                    if held:  # closed by this start; pieces of an earlier block's record stay pieces
                        odd = False
                        yield made(at, np.array([number - 1 if begun else -1]), np.array([begun]), pa.array(["\n".join(held)]))
                    found = _joined(lines[first:], starts - first)
                    if at[1] == 0 and number == 0 and (len(found) > 1 or not after):
                        check(found[0].as_py())
                    yield made(at, number + np.arange(len(found) - 1), np.ones(len(found) - 1, bool), found[:-1])
                    number += len(found)
                    held, begun = [found[-1].as_py()], True
                odd = after
        if at is not None:
            yield from tail()

    return run


def stray_quotes(text: F.Column) -> F.Column:
    """Whether a record has a quote that neither encloses a field nor stands doubled inside one."""
    left = F.regexp_replace(text, r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)', "$1")
    return F.contains(text, F.lit('"')) & F.contains(left, F.lit('"'))


def csv_records(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """``(file, number, text)``: every record below the header, numbered in its file from 1; empty lines are left out.

    The first pass runs here; its result, a row of some 100 bytes for each block, is kept and sent to all executors."""
    lines = _lines(spark, path)
    ensure_checkpoint_dir(spark)
    blocks = block_table(lines).checkpoint()
    if blocks.count() > MOST_BLOCKS:
        raise ValueError(f"more than {MOST_BLOCKS} blocks; raise spark.sql.files.maxPartitionBytes")
    told = lines.join(F.broadcast(blocks), ["file", "block"]).select(
        "file", "block", "value", "begins_inside", "first_number")  # a broadcast keeps the lines in their order
    return _stitched(told.mapInArrow(_records_of_blocks(list(header)), RECORDS))


def _stitched(found: DataFrame) -> DataFrame:
    """Whole records, and those put together from pieces of several blocks."""
    pieces = found.where(~F.col("whole"))
    record = F.max(F.when(F.col("number") >= 0, F.col("number"))).over(
        Window.partitionBy("file").orderBy("block", "number"))
    joined = (pieces.withColumn("of", record).groupBy("file", F.col("of").alias("number"))
              .agg(F.array_sort(F.collect_list(F.struct("block", "number", "text"))).alias("p"))
              .select("file", "number", F.array_join("p.text", "\n").alias("text")))
    records = found.where("whole").select("file", "number", "text").unionByName(joined)
    return (records.where("number > 0").withColumn("text", F.regexp_replace("text", r"\r$", ""))
            .where("text <> ''"))


def parsed(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The records' fields by ``schema`` (with its corrupt-record column), beside ``file`` and ``number``."""
    stray = F.raise_error(F.concat(F.lit("a quote inside an unquoted field; read this source in one task: "),
                                   F.substring("text", 1, 200))).cast("string")
    fields = F.from_csv(F.when(stray_quotes(F.col("text")), stray).otherwise(F.col("text")),
                        ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), options)
    return records.select("file", "number", fields.alias("r")).select("file", "number", "r.*")
