"""Fixed-size batches of records with a content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import stage

BATCH_SIZE = 1000
#: (catalogue, task) runs that are broadcast, about 10 MB; with more, the records are shuffled to meet them.
MOST_RUNS = 100_000


def batch_records(
    df: DataFrame, catalog: str, order: Sequence[str], record: Sequence[str], size: int = BATCH_SIZE
) -> DataFrame:
    """Cut every catalogue into batches of ``size`` records in the given order.

    Returns ``catalog``, ``batch_no`` (from 0), ``n_records``, ``data`` (JSON array of the
    records) and ``hash`` (SHA-256 of ``data``). The last batch of a catalogue is short.

    A catalogue may be most of the table, so positions are not counted by a window over it.
    The rows are range-sorted once over all tasks and staged with their place inside the
    task; the rows per (catalogue, task) then give each task its starting position. Equal
    records are interchangeable, and a running number spreads them over tasks as well.
    """
    keys = [catalog, *order, *(c for c in record if c not in order and c != catalog)]
    # a running number must be the same when a lost task is repeated, and a file's rows stay in place
    rows = stage(df.select(*keys), "batch-input")
    rows = rows.withColumn("__copy", F.monotonically_increasing_id())
    placed = stage(
        rows.repartitionByRange(*keys, "__copy")
        .sortWithinPartitions(*keys, "__copy")
        .withColumns({"__task": F.spark_partition_id(), "__place": F.monotonically_increasing_id()})
        .drop("__copy"),
        "batches",
    )
    # at most (catalogues + tasks) rows; within one catalogue at most one row per task
    runs = placed.groupBy(catalog, "__task").agg(F.count("*").alias("__rows"), F.min("__place").alias("__first"))
    before = Window.partitionBy(catalog).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows"), "batch-runs")
    # the planner's estimate of so narrow a table is too high for a broadcast, its rows are known
    runs = F.broadcast(runs) if runs.count() <= MOST_RUNS else runs.hint("merge")
    position = F.col("__start") + F.col("__place") - F.col("__first")
    l, r = placed.alias("l"), runs.alias("r")
    same_run = F.col(f"l.{catalog}").eqNullSafe(F.col(f"r.{catalog}")) & (F.col("l.__task") == F.col("r.__task"))
    numbered = l.join(r, same_run).select(
        F.col(f"l.{catalog}").alias("catalog"),
        F.floor(position / F.lit(size)).alias("batch_no"),
        position.alias("__position"),
        F.struct(*(F.col(f"l.{c}").alias(c) for c in record)).alias("__record"),
    )
    collected = numbered.groupBy("catalog", "batch_no").agg(
        F.count("*").alias("n_records"),
        F.array_sort(F.collect_list(F.struct("__position", "__record"))).alias("__records"),
    )
    data = F.to_json(F.transform("__records", lambda x: x["__record"]), {"ignoreNullFields": "false"})
    return collected.select("catalog", "batch_no", "n_records", data.alias("data")).withColumn(
        "hash", F.sha2("data", 256)
    )


def as_messages(batches: DataFrame) -> DataFrame:
    """One JSON message per batch: ``{"catalog": …, "data": […], "hash": …}``."""
    opening = F.regexp_replace(F.to_json(F.struct("catalog")), r"\}$", "")
    message = F.concat(opening, F.lit(',"data":'), "data", F.lit(',"hash":"'), "hash", F.lit('"}'))
    return batches.select(message.alias("value"))
