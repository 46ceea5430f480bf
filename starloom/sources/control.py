"""Control table: which job has run up to which date.

An append-only log; the latest entry per job is its current state. Appending needs no
in-place update, so plain Parquet will do.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.keys import target_date
from starloom.sources.catalogs import flat_schema

CONTROL_SCHEMA = flat_schema(
    "id string, pipeline string, genesis date, current date, layer string, updated_at timestamp"
)
_STATE = ("pipeline", "genesis", "current", "layer")


def create_control_table(spark: SparkSession, table: str, jobs: Iterable[tuple[str, dt.date | None, str]] = ()) -> None:
    """Create the log if it is absent; new tables are seeded with (job, first date, layer) rows."""
    if spark.catalog.tableExists(table):
        return
    now = dt.datetime.now(dt.timezone.utc)
    rows = [(str(uuid.uuid4()), name, genesis, None, layer, now) for name, genesis, layer in jobs]
    spark.createDataFrame(rows, CONTROL_SCHEMA).write.format("parquet").saveAsTable(table)


def current_state(log: DataFrame) -> DataFrame:
    """One row per id: its latest entry. Tasks reduce the log before it is shuffled."""
    latest = F.max_by(F.struct(*_STATE, "updated_at"), F.struct("updated_at", "current"))
    return log.groupBy("id").agg(latest.alias("s")).select("id", "s.*")


def find_job(state: DataFrame, layer: str | Column, job: str | Column) -> DataFrame:
    """The entry of one job in one layer, at most one row; of several ids the smallest."""
    return state.filter((F.col("layer") == layer) & (F.col("pipeline") == job)).orderBy("id").limit(1)


def read_job(spark: SparkSession, table: str, layer: str, job: str) -> dict[str, object]:
    """The job's state as a dict, empty when it is unknown. A table that can't be read is an error."""
    log = spark.table(table).filter((F.col("layer") == layer) & (F.col("pipeline") == job))
    row = find_job(current_state(log), layer, job).first()
    return row.asDict() if row else {}


def lookup(spark: SparkSession, table: str, layer: str, job: str) -> dict[str, object]:
    """:func:`read_job` for choosing a start date: a job runs from its default where the table can't be read."""
    try:
        return read_job(spark, table, layer, job)
    except Exception as error:
        print(f"control table not readable: {error}")
        return {}


def advanced(state: DataFrame, current: dt.date | Column, at: Column | None = None) -> DataFrame:
    """Log entries that move the given jobs to ``current``."""
    current = F.lit(current) if not isinstance(current, Column) else current
    return state.withColumns(
        {"current": current.cast("date"), "updated_at": F.current_timestamp() if at is None else at}
    ).select(*CONTROL_SCHEMA.names)


def advance(spark: SparkSession, table: str, layer: str, job: str, current: dt.date) -> None:
    """Append the new date of a job, entering the job if it is new. Nothing is written if the table can't be read."""
    found = read_job(spark, table, layer, job)
    row = (found.get("id") or str(uuid.uuid4()), job, found.get("genesis"), current, layer, dt.datetime.now(dt.timezone.utc))
    spark.createDataFrame([row], CONTROL_SCHEMA).write.mode("append").insertInto(table)


def with_target_date(state: DataFrame, out: str = "target_date") -> DataFrame:
    return state.withColumn(out, target_date("current", "genesis"))


def since(df: DataFrame, target: str, date: str = "fct_dt") -> DataFrame:
    """Rows whose date key is not before ``target`` (``yyyy-MM-dd``)."""
    return df.filter(F.col(date) >= target.replace("-", ""))
