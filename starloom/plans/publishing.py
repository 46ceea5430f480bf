"""Catalogue records to message files to landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.batches import BATCH_SIZE, as_messages, batch_records
from starloom.sources.catalogs import PLANETS, PLANETS_NAME, PLANETS_ORDER
from starloom.sources.jsonrecords import zeroed
from starloom.streaming.landing import land_messages, landed_records


def publish_catalog(
    records: DataFrame,
    path: str,
    name: str = PLANETS_NAME,
    schema: T.StructType = PLANETS,
    order: str = PLANETS_ORDER,
    size: int = BATCH_SIZE,
    zero_for_null: bool = True,
) -> None:
    """Write the catalogue to ``path`` as message files, ``size`` records to a message.

    Missing values are published, and hashed, as 0 or "" unless ``zero_for_null`` is false.
    """
    named = (zeroed(records, schema) if zero_for_null else records.select(*schema.names)).withColumn("__catalog", F.lit(name))
    as_messages(batch_records(named, "__catalog", [order], schema.names, size)).write.mode("append").text(path)


def land_catalog(
    spark: SparkSession, messages: str, root: str, schema: T.StructType = PLANETS, record_format: str = "parquet"
) -> DataFrame:
    """Land the waiting messages and return all landed records."""
    land_messages(spark, messages, root, schema, record_format=record_format)
    return landed_records(spark, root, schema, record_format)
