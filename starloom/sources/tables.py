"""Catalogue tables: create, evolve and overwrite by partition.

Plain Parquet tables of the session catalogue. The write order is kept as a table property,
since only some table formats can declare one.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.shape import conform
from starloom.session import stage

_ORDER_PROPERTY = "starloom.write.order"
#: Partitions that one statement drops.
DROPPED_AT_ONCE = 1000
_INSERTING = threading.Lock()


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def sync_table(df: DataFrame, table: str, partition_cols: Sequence[str], sort_cols: Sequence[str] = ()) -> None:
    """Create ``table`` empty with the schema of ``df``, or add the columns it lacks.

    Names are compared without case. Columns that ``df`` no longer has, or has with another
    type, are left as they are; values that don't fit them are refused on writing.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.format("parquet").partitionBy(*partition_cols).saveAsTable(table)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_ORDER_PROPERTY}'='{','.join(sort_cols)}')")
        return
    known = {name.lower() for name in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def clustered(df: DataFrame, partition_cols: Sequence[str], sort_cols: Sequence[str]) -> DataFrame:
    """Rows of one partition together and sorted, for one well-sized file per partition.

    The rebalance hint lets AQE split a partition that holds much of the table over several
    tasks and merge small ones.
    """
    return df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *sort_cols)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns of any table of the catalogue."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def aligned(df: DataFrame, table: str, on_loss: str = "fail") -> DataFrame:
    """``df`` with the columns, order and types of ``table``; columns it lacks become null.

    Names are compared without case. A value that the table's type can't hold stops the
    job, or is marked as :func:`starloom.operators.shape.conform` does.
    """
    fields = df.sparkSession.table(table).schema.fields
    known = {f.name.lower(): f.name for f in fields}
    named = df.select(*(F.col(f"`{c}`").alias(known.get(c.lower(), c)) for c in df.columns))
    return conform(named, T.StructType(fields), on_loss)


def overwrite_partitions(df: DataFrame, table: str, purge_key: str | None = None) -> None:
    """Replace the partitions that occur in ``df`` and leave all others untouched.

    A value that doesn't fit its column stops the write. A row whose partition value has
    changed stays behind in its old partition. With ``purge_key`` such leftovers are removed
    too: old partitions that hold a key of ``df`` are rewritten without it. A purge is not
    atomic: emptied partitions are dropped after the new rows are in, so a crash in between
    leaves moved rows in both; running it again mends that. A table without partitions is
    replaced as a whole.
    """
    spark = df.sparkSession
    partition_cols = partition_columns(spark, table)
    sort_cols = [c for c in _properties(spark, table).get(_ORDER_PROPERTY, "").split(",") if c and c not in partition_cols]
    incoming = aligned(df, table)
    emptied: list = []
    if purge_key and partition_cols:
        incoming = stage(incoming, "overwrite")
        present = incoming.select(*partition_cols).distinct()
        keys = incoming.select(purge_key).distinct()
        current = spark.table(table)
        elsewhere = _without(current, present, partition_cols)
        touched = elsewhere.join(keys, purge_key, "left_semi").select(*partition_cols).distinct()
        survivors = stage(
            elsewhere.join(touched, _same(elsewhere, touched, partition_cols), "left_semi").join(keys, purge_key, "left_anti").select(*current.columns),
            "survivors",
        )
        # one entry per emptied partition, at most as many as the table has
        emptied = _without(touched, survivors.select(*partition_cols).distinct(), partition_cols).collect()
        incoming = incoming.unionByName(survivors)
    _insert_dynamic(clustered(incoming, partition_cols, sort_cols) if partition_cols else incoming, table)
    specs = [f"PARTITION ({', '.join(f'`{c}`={_literal(row[c])}' for c in partition_cols)})" for row in emptied]
    for i in range(0, len(specs), DROPPED_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[i : i + DROPPED_AT_ONCE])}")


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]):
    """Equal in all columns; nulls are equal."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & a[c].eqNullSafe(b[c])
    return condition


def _without(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    return a.join(b, _same(a, b, columns), "left_anti")


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def _insert_dynamic(df: DataFrame, table: str) -> None:
    """Insert with dynamic partition overwrite. The mode is a session setting, so writes of one process take turns."""
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    with _INSERTING:
        before = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            df.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(setting, before)


def publish_by_key(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Write ``df`` as a new table, bucketed and sorted by ``key``; an old one of the name is replaced.

    Two tables with equally many buckets join on ``key``, and one aggregates by it, without a shuffle or a
    sort. A bucket is read by one task, so ``buckets`` should keep it near a quarter of a GB. The rows are shuffled
    once, here, so that each bucket is one file.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
