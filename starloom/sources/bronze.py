"""Raw to bronze: a list of tables, each conformed and written by load date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.shape import conform, union_all_by_name
from starloom.operators.metrics import observed
from starloom.sources.files import read_csv_inferred, read_parquet_groups, read_parquet_tree

# The date tokens of a load configuration.
DATE_TOKENS = {"current_year": "%Y", "current_month": "%m", "current_day": "%d"}

CONFIG_SCHEMA = (
    "table_name string, source string, dest string, format string,"
    " partitions array<struct<partition_key: string, partition_value: string>>"
)


@dataclass(frozen=True)
class TableLoad:
    table_name: str
    source: str
    dest: str
    format: str
    partitions: Sequence[tuple[str, str]] = field(default_factory=tuple)


def read_load_config(spark: SparkSession, path: str) -> list[TableLoad]:
    """The JSON array of table entries; one entry per table, so it is small by nature."""
    rows = spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True).collect()
    return [
        TableLoad(
            r["table_name"],
            r["source"],
            r["dest"],
            r["format"],
            tuple((p["partition_key"], p["partition_value"]) for p in r["partitions"] or ()),
        )
        for r in rows
    ]


def resolve_tokens(load: TableLoad, load_date: dt.date) -> TableLoad:
    """Partition values with the date tokens replaced; padded to two digits."""
    done = tuple((k, load_date.strftime(DATE_TOKENS[v]) if v in DATE_TOKENS else v) for k, v in load.partitions)
    return TableLoad(load.table_name, load.source, load.dest, load.format, done)


def conform_files(spark: SparkSession, path: str, target: T.StructType, on_loss: str = "fail") -> DataFrame:
    """All Parquet files below ``path`` with the columns and types of ``target``, each group of files conformed by itself."""
    return union_all_by_name([conform(frame, target, on_loss) for frame in read_parquet_groups(spark, path)])


def load_table(
    spark: SparkSession,
    root: str,
    load: TableLoad,
    target: T.StructType | None = None,
    load_date: dt.date | None = None,
) -> str:
    """Append one source to ``root/dest/table_name/key=value/…`` as Snappy Parquet.

    Parquet sources are read at any depth; files are conformed to ``target`` before they
    are put together, so their types may differ. CSV keeps its inferred types. An unknown format is an error. Partition keys replace data columns of
    the same name. Returns the table's path.
    """
    load = resolve_tokens(load, load_date or dt.date.today())
    source = f"{root}/{load.source}"
    kind = load.format.lower()
    if kind == "csv":
        df = read_csv_inferred(spark, source)
    elif kind == "parquet":
        df = conform_files(spark, source, target) if target is not None else read_parquet_tree(spark, source)
    else:
        raise ValueError(f"table format {load.format} not supported")
    path = f"{root}/{load.dest}/{load.table_name}"
    write_by_date(df, path, dict(load.partitions))
    return path


def dated_schema(target: T.StructType, keys: Sequence[str]) -> T.StructType:
    """Schema of a loaded table: ``target`` with the date keys, which Spark reads as integers, in place of columns of those names."""
    return T.StructType([*(f for f in target.fields if f.name not in keys), *(T.StructField(k, T.IntegerType()) for k in keys)])


def write_by_date(df: DataFrame, path: str, partitions: Mapping[str, str], metrics: Mapping[str, Column] | None = None) -> dict[str, object]:
    """Append under the given constant partition values; returns the run's :func:`observed` metrics."""
    df = df.withColumns({k: F.lit(v) for k, v in partitions.items()})

    def write(rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", "snappy").partitionBy(*partitions).parquet(path)

    return observed(df, write, metrics)


def load_all(
    spark: SparkSession,
    root: str,
    loads: Sequence[TableLoad],
    targets: Mapping[str, T.StructType],
    load_date: dt.date | None = None,
) -> dict[str, str]:
    """Load every table of a configuration in turn; returns table name → path."""
    return {load.table_name: load_table(spark, root, load, targets.get(load.table_name), load_date) for load in loads}
