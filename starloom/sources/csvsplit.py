"""CSV records of files that are read in blocks, though quoted fields may hold line breaks.

Whether a line starts inside quotes depends on all quotes before it in its file. A first pass over the lines gives
for each block of a file the state it ends in for either state it starts in; composing these in the order
of the blocks, one short row each, gives the state that each block really starts in. The second pass then cuts
every block into records at the line ends outside quotes. A record that runs over the end of a block comes in
fragments, at most two per block, which are put together by the block it started in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LINES = "file string, block long, seq long, line string"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with their file, the block they start in, and a number that rises inside a block."""
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(list(paths))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut where another block begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(1).to_numpy()
        file = batch.column(0).dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(start, end - start)


def _odd(lines: pa.Array, comment: str) -> tuple[np.ndarray, np.ndarray]:
    """Which lines hold an odd number of quotes, and which look like comments."""
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2 == 1
    return odd, pc.starts_with(lines, comment).to_numpy(zero_copy_only=False)


def _passed(batches: Iterator[pa.RecordBatch], comment: str) -> Iterator[pa.RecordBatch]:
    """(file, block, from_out, from_in): whether a block ends inside quotes, for either start."""
    key, ends = None, [False, True]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [key[0]], "block": [key[1]], "from_out": [ends[0]], "from_in": [ends[1]]})

    for part in _stretches(batches):
        mine = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
        if key is not None and mine != key:
            yield row()
            ends = [False, True]
        key = mine
        odd, noted = _odd(part.column(3), comment)
        for is_comment in noted[odd].tolist():
            ends = [inside if is_comment and not inside else not inside for inside in ends]
    if key is not None:
        yield row()


def _cut(batches: Iterator[pa.RecordBatch], comment: str) -> Iterator[pa.RecordBatch]:
    """Records and fragments of blocks, whose lines come in order with the state that the block starts in."""
    key, inside, held, kind, number = None, False, [], 0, 0
    files, blocks, numbers, kinds, records = [], [], [], [], []

    def end(opened: bool) -> None:
        """Give out what is held: 0 a record, 1 the start of one, 2 its end, 3 a middle."""
        nonlocal held, kind, number
        if held:
            text = "\n".join(held)
            files.append(key[0])
            blocks.append(key[1])
            numbers.append(number)
            kinds.append(kind + (1 if opened else 0))
            records.append(text)
            number += 1
        held, kind = [], 0

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(numbers, pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string())],
            ["file", "block", "number", "kind", "record"],
        )
        for column in (files, blocks, numbers, kinds, records):
            column.clear()
        return batch

    for part in _stretches(batches):
        mine = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
        if mine != key:
            end(inside)
            key, inside, number = mine, bool(part.column(4)[0].as_py()), 0
            kind = 2 if inside else 0
        odd, noted = _odd(part.column(3), comment)
        for line, is_odd, is_comment in zip(part.column(3).to_pylist(), odd.tolist(), noted.tolist()):
            if not inside and (is_comment or not line.strip()):
                continue
            held.append(line)
            inside ^= is_odd
            if not inside:
                end(False)
        yield made()
    end(inside)
    if records:
        yield made()


def csv_records(spark: SparkSession, paths: Sequence[str], comment: str = "#") -> DataFrame:
    """(``file``, ``block``, ``number``, ``record``) of all records of CSV files, header lines among them.

    A record is the text between two line ends outside quotes; its place is the block it starts in and its
    number there. Comment and blank lines between records are left out, line breaks in quotes stay as they are.
    Quotes inside quotes are doubled; one inside an unquoted field is not allowed. A quote that is
    never closed makes one record of the rest of its file. Large files are read by as many tasks as they have
    blocks. Lines are not shuffled, unless the states of the blocks (one row each) are too many to be broadcast.
    """
    lines = _lines(spark, paths)
    passed = lines.mapInArrow(lambda b: _passed(b, comment), "file string, block long, from_out boolean, from_in boolean")
    order = Window.partitionBy("file").orderBy("block")
    # the state after a block is that of the last block with one end for both starts, turned over by the turning ones since
    fixed = F.col("from_out") == F.col("from_in")
    turning = F.col("from_out") & ~F.col("from_in")
    blocks = passed.groupBy("file", "block").agg(F.first("from_out").alias("from_out"), F.first("from_in").alias("from_in"))
    blocks = blocks.withColumn("run", F.sum(fixed.cast("int")).over(order))
    within = Window.partitionBy("file", "run").orderBy("block")
    base = F.first(F.when(fixed, F.col("from_out")).otherwise(False)).over(within)
    turned = F.sum(turning.cast("int")).over(within) % 2 == 1
    after = blocks.select("file", "block", (base != turned).alias("after"))
    states = after.select("file", "block", F.coalesce(F.lag("after").over(order), F.lit(False)).alias("inside"))

    placed = lines.join(states, ["file", "block"]).select("file", "block", "seq", "line", "inside")
    cut = placed.sortWithinPartitions("file", "block", "seq").mapInArrow(
        lambda b: _cut(b, comment), "file string, block long, number long, kind int, record string"
    )
    whole = cut.where("kind = 0").drop("kind")
    before = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    edges = cut.where("kind > 0").withColumn("begin", F.last(F.when(F.col("kind") == 1, F.struct("block", "number")), True).over(before))
    pieces = edges.groupBy("file", "begin").agg(F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), "record"))).alias("parts"))
    joined = pieces.select("file", "begin.block", "begin.number", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined)
