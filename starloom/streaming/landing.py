"""Landing of message batches, each message exactly once.

Messages are lines of JSON text, ``{"catalog": …, "data": […], "hash": …}``. The stream
reads message files ten at a time, or by bytes, until none are left. The checkpoint takes the
part of the queue's acknowledgements: a file counts as done when its rows are on disk. A
message is told by its catalogue and hash, as the hash covers the records alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the queue consumer.
MAX_FILES_PER_TRIGGER = 10

#: Ledger folders, one per micro-batch, that are put together before a run.
LEDGER_FOLDERS = 64
_MESSAGE = ("catalog", "hash")
_LEDGER = "catalog string, hash string, batch_id long"


def read_messages(
    spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_TRIGGER, max_bytes: int | None = None
) -> DataFrame:
    """Lines of the message files; a micro-batch takes ``max_files`` files or, if given, about ``max_bytes`` bytes."""
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return spark.readStream.option(*limit).text(path)


def parse_messages(lines: DataFrame, record: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``catalog``, ``data``, ``hash`` and ``malformed`` (the line itself when it is no message)."""
    schema = T.StructType(
        [
            T.StructField("catalog", T.StringType()),
            T.StructField("data", T.ArrayType(record)),
            T.StructField("hash", T.StringType()),
            T.StructField("_corrupt", T.StringType()),
        ]
    )
    message = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.withColumn("m", message)
    complete = F.col("m._corrupt").isNull()
    for part in ("catalog", "hash", "data"):
        complete = complete & F.col(f"m.{part}").isNotNull()
    malformed = F.when(~F.coalesce(complete, F.lit(False)), F.col("value")).alias("malformed")
    return parsed.select(*keep, "m.catalog", "m.data", "m.hash", malformed)


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Values of the ``name=value`` folders below ``path`` that were written to the end."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    done = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith(f"{name}=")]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().split("=")[1]) for p in done if fs.exists(marker(p, "_SUCCESS")))


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """(``catalog``, ``hash``, ``batch_id``) of all landed messages; none yet gives None."""
    packed, loose = _numbers(spark, f"{root}/ledger", "upto"), _numbers(spark, f"{root}/hashes", "batch_id")
    parts = [spark.read.schema(_LEDGER).parquet(f"{root}/ledger/upto={packed[-1]}")] if packed else []
    if loose:
        parts.append(spark.read.schema(_LEDGER).parquet(f"{root}/hashes"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def compact_ledger(spark: SparkSession, root: str, folders: int = LEDGER_FOLDERS) -> None:
    """Put the ledger into one folder once it has ``folders`` small ones, so that listing it stays cheap.

    The new folder counts when it is complete and the old ones go after that. A crash in
    between leaves entries twice, which changes nothing. Not to be run while a stream lands.
    """
    loose = _numbers(spark, f"{root}/hashes", "batch_id")
    if len(loose) < folders:
        return
    packed = _numbers(spark, f"{root}/ledger", "upto")
    new = f"{root}/ledger/upto={loose[-1]}"
    _ledger(spark, root).distinct().write.mode("overwrite").parquet(new)
    for old in (*(f"{root}/ledger/upto={n}" for n in packed if n != loose[-1]), *(f"{root}/hashes/batch_id={n}" for n in loose)):
        path, fs = _folder(spark, old)
        fs.delete(path, True)


def land_messages(
    spark: SparkSession,
    source: str,
    root: str,
    record: T.StructType,
    max_files: int = MAX_FILES_PER_TRIGGER,
    record_format: str = "parquet",
    max_bytes: int | None = None,
) -> None:
    """Land all waiting messages and return.

    Below ``root``: ``landed/`` (one row per record, by ``batch_id`` and ``catalog``),
    ``hashes/`` and ``ledger/`` (one row per message), ``dead/`` (malformed lines) and
    ``checkpoint/``. Ten files per micro-batch is the historic setting; give ``max_bytes``
    for large backlogs.

    A message that was landed before is passed over however late it comes back: new messages
    are compared with the ledger, which has one narrow row per thousand records. Every
    micro-batch writes to its own ``batch_id`` directory and overwrites it when it is run
    again after a failure, and it reads the ledger of earlier batches only, so a retry gives
    the same rows.
    """
    landed, hashes, dead = f"{root}/landed", f"{root}/hashes", f"{root}/dead"
    compact_ledger(spark, root)

    def land(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch, record).persist()
        try:
            good = parsed.filter(F.col("malformed").isNull())
            # copies of one message are equal; one of each survives, reduced before the shuffle
            fresh = good.groupBy(*_MESSAGE).agg(F.any_value("data").alias("data"))
            ledger = _ledger(spark, root)
            if ledger is not None:
                earlier = ledger.filter(F.col("batch_id") < batch_id).select(*_MESSAGE)
                # the semi join scans the ledger without shuffling it when the batch is small
                seen = earlier.join(fresh.select(*_MESSAGE), list(_MESSAGE), "left_semi")
                fresh = fresh.join(seen, list(_MESSAGE), "left_anti")
            fresh = fresh.select("catalog", "data", "hash").persist()
            try:
                rows = fresh.select("catalog", "hash", F.explode("data").alias("r")).select("catalog", "hash", "r.*")
                rows.write.mode("overwrite").partitionBy("catalog").format(record_format).save(
                    f"{landed}/batch_id={batch_id}"
                )
                parsed.filter(F.col("malformed").isNotNull()).select("malformed").write.mode("overwrite").parquet(
                    f"{dead}/batch_id={batch_id}"
                )
                # the ledger entry comes last: until it is there the batch counts as not landed
                fresh.select(*_MESSAGE).write.mode("overwrite").parquet(f"{hashes}/batch_id={batch_id}")
            finally:
                fresh.unpersist()
        finally:
            parsed.unpersist()

    query = (
        read_messages(spark, source, max_files, max_bytes)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_within_watermark(
    spark: SparkSession, source: str, root: str, record: T.StructType, delay: str = "1 hour", max_files: int = MAX_FILES_PER_TRIGGER
) -> None:
    """Like :func:`land_messages`, but with repeats found in stream state only.

    The state holds each catalogue and hash for ``delay`` after it was read and does not grow beyond that;
    a repeat that comes later is landed again. Malformed lines are not written here.
    """
    messages = (
        read_messages(spark, source, max_files)
        .withColumn("seen_at", F.current_timestamp())
        .withWatermark("seen_at", delay)
    )
    parsed = parse_messages(messages, record, ["seen_at"]).filter(F.col("malformed").isNull())
    rows = (
        parsed.dropDuplicatesWithinWatermark(list(_MESSAGE))
        .select("catalog", "hash", F.explode("data").alias("r"))
        .select("catalog", "hash", "r.*")
    )
    query = (
        rows.writeStream.format("parquet")
        .partitionBy("catalog")
        .option("path", f"{root}/landed")
        .option("checkpointLocation", f"{root}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_records(spark: SparkSession, root: str, record: T.StructType, record_format: str = "parquet") -> DataFrame:
    """All landed records."""
    schema = T.StructType(
        [T.StructField("hash", T.StringType()), *record.fields, T.StructField("batch_id", T.LongType()), T.StructField("catalog", T.StringType())]
    )
    return spark.read.schema(schema).format(record_format).load(f"{root}/landed").select("catalog", "hash", *record.names)


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """All malformed lines."""
    return spark.read.schema("malformed string, batch_id long").parquet(f"{root}/dead").select("malformed")
