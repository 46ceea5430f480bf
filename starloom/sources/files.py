"""File sources: Parquet, CSV and opaque files."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import stage
from starloom.sources.csvsplit import csv_records

NULL_TOKENS = ("NULL", "null", "")


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet dataset with Hive partitions and merged file schemas.

    No or an empty column list means all columns. Merging opens every file footer; pass
    ``schema`` where it is known to skip that.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


#: Endings of files below a raw prefix that are not Parquet and are passed over.
OTHER_FORMATS = (".json", ".csv", ".tsv", ".txt", ".xml", ".vot", ".avro", ".orc", ".gz", ".zip", ".md", ".log", ".crc")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> list[tuple[str, int]]:
    """Path and length of all files below ``path``, sorted; names that start with ``_`` or ``.`` are hidden.

    The driver lists files for every scan anyway; their contents are not read here.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return sorted((r["path"], r["length"]) for r in listed.select("path", "length").collect())


def _exact(paths: Sequence[str]) -> list[str]:
    """Paths with their pattern characters taken literally."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def parquet_files(spark: SparkSession, path: str, skip: Sequence[str] = OTHER_FORMATS) -> tuple[list[str], list[str]]:
    """(files to read as Parquet, files passed over) below ``path``.

    Every file that is not empty counts as Parquet unless its name ends like another format;
    one that then is no Parquet stops the read.
    """
    files = list_files(spark, path)
    taken = [f for f, size in files if size and not f.lower().endswith(tuple(skip))]
    return taken, sorted({f for f, _ in files} - set(taken))


def read_parquet_groups(spark: SparkSession, path: str, skip: Sequence[str] = OTHER_FORMATS) -> list[DataFrame]:
    """All Parquet files below ``path``, one frame for each set of files whose schemas can be merged.

    Spark reads the footers of a set in a job; where it finds two types for one column the set
    is halved, so files of k kinds cost about k * log(files) such jobs. Directory names are not
    read as partitions. Files passed over are printed. No file at all is an error.
    """
    taken, passed = parquet_files(spark, path, skip)
    if passed:
        print(f"not read as Parquet: {len(passed)} files, such as {passed[0]}")
    if not taken:
        raise ValueError(f"no Parquet files found in {path}")
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)

    def groups(files: list[str]) -> list[DataFrame]:
        try:
            return [reader.parquet(*_exact(files))]
        except Exception as error:
            if len(files) == 1 or "CANNOT_MERGE" not in str(error):
                raise
        half = len(files) // 2
        return groups(files[:half]) + groups(files[half:])

    frames: dict[str, list[DataFrame]] = {}
    for frame in groups(taken):
        frames.setdefault(frame.schema.json(), []).append(frame)
    return [reduce(DataFrame.unionByName, same) for same in frames.values()]


def read_parquet_tree(spark: SparkSession, path: str, schema: T.StructType | None = None, skip: Sequence[str] = OTHER_FORMATS) -> DataFrame:
    """All Parquet files below ``path`` at any depth as one frame, whatever their names end in.

    Files of other known formats under the same prefix are passed over. Use this for raw data
    only, as directory names are not read as partitions. Files whose types differ can't be
    one frame: that is an error, see :func:`read_parquet_groups`. A known ``schema`` saves
    reading the footers.
    """
    if schema is not None:
        taken, _ = parquet_files(spark, path, skip)
        return spark.read.option("recursiveFileLookup", True).schema(schema).parquet(*_exact(taken))
    frames = read_parquet_groups(spark, path, skip)
    if len(frames) > 1:
        raise ValueError(f"the files below {path} have {len(frames)} schemas that differ in type")
    return frames[0]


# Candidate types from the narrowest, each with its bit; the first one that every value of a
# column fits is taken.
_CSV_TYPES = {"boolean": 1, "bigint": 2, "double": 4, "date": 8, "timestamp": 16}


def _csv_fits(c: Column) -> Column:
    """Bits of the types that a text fits. Only texts of the right look are cast at all,
    because a failed cast costs far more than a pattern."""

    def fits(pattern: str, sql_type: str) -> Column:
        return F.when(c.rlike(pattern), c.try_cast(sql_type).isNotNull()).otherwise(False)

    return (
        F.when(fits(r"^\s*[+-]?\d{1,19}\s*$", "bigint"), 2 | 4)
        .when(fits(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^(?i)[+-]?(nan|inf|infinity)$", "double"), 4)
        .when(F.lower(c).isin("true", "false"), 1)
        .when(fits(r"^\d{4}-\d{2}-\d{2}$", "date"), 8 | 16)
        .when(fits(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}", "timestamp"), 16)
        .otherwise(0)
    )


def _by_header(spark: SparkSession, path: str, comment: str) -> list[list[str]]:
    """CSV files below ``path``, those with the same header line together."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    found = (
        lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .where((F.trim("value") != "") & ~F.startswith("value", F.lit(comment)))
        .withColumn("place", F.struct("block", F.monotonically_increasing_id()))
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    # one line per file
    groups: dict[str, list[str]] = {}
    for row in sorted(found.collect()):
        groups.setdefault(row["header"].rstrip("\r"), []).append(unquote(row["file"]))
    return list(groups.values())


def _header_names(header: str) -> list[str]:
    """Column names of a header record: empty ones are numbered, and so are repeated ones."""
    names = next(csv.reader(io.StringIO(header.rstrip("\r"))))
    again = {n.lower() for i, n in enumerate(names) if n.lower() in {m.lower() for m in names[:i]}}
    return [f"_c{i}" if not n else f"{n}{i}" if n.lower() in again else n for i, n in enumerate(names)]


def _split_texts(spark: SparkSession, path: str, comment: str) -> list[DataFrame]:
    """All columns as text, one frame per header, from records that are cut block by block and staged."""
    records = stage(csv_records(spark, [path], comment), "csv-records")
    first = records.where("number = 0").groupBy("file").agg(F.min_by(F.struct("block", "record"), "block").alias("f"))
    heads = stage(first.select("file", F.col("f.block").alias("head_block"), F.col("f.record").alias("header")), "csv-headers")
    frames = []
    for row in heads.select("header").distinct().orderBy("header").collect():
        names = _header_names(row["header"])
        rows = records.join(heads.where(F.col("header") == row["header"]), "file").where("block <> head_block OR number > 0")
        options = {"mode": "FAILFAST", "escape": '"', "multiLine": "true", "emptyValue": "", "nullValue": ""}
        fields = F.from_csv(F.rtrim("record", F.lit("\r")), ", ".join(f"c{i} STRING" for i in range(len(names))), options).alias("f")
        frames.append(rows.select(fields).select(*(F.col(f"f.c{i}").alias(n) for i, n in enumerate(names))))
    return frames


def _csv_texts(spark: SparkSession, path: str, comment: str, multi_line: bool) -> DataFrame:
    """All columns as text; files with their columns in another order are put together by name."""
    options = dict(header=True, comment=comment, escape='"', emptyValue="", nullValue="")
    frames = _split_texts(spark, path, comment) if multi_line else []
    for files in [] if multi_line else _by_header(spark, path, comment):
        names = spark.read.csv(_exact(files[:1]), inferSchema=False, **options).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frames.append(spark.read.schema(schema).csv(_exact(files), mode="FAILFAST", enforceSchema=True, **options))
    if not frames:
        raise ValueError(f"no records found in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_inferred(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = NULL_TOKENS, comment: str = "#", multi_line: bool = True
) -> DataFrame:
    """CSV with header, ``#`` comments and several null tokens, types inferred.

    The tokens are null in every column, text included. Types come from one aggregate pass
    over the file: boolean, long, double, date, timestamp, else string. Spark's own
    inference knows a single null token and would leave such numeric columns as text. A
    file without records is an error, and so is a row with too many or too few fields.

    Quotes inside quotes are doubled. ``multi_line`` allows line breaks inside quotes: two passes over the blocks of the
    files find the records (:mod:`starloom.sources.csvsplit`), which are staged. Without it lines are records, and
    nothing is staged. Files below ``path`` may have their columns in different orders.
    """
    text = _csv_texts(spark, path, comment, multi_line)
    text = text.select(
        *(F.when(~F.col(f"`{c}`").isin(*null_tokens), F.col(f"`{c}`")).alias(c) for c in text.columns)
    )
    fits = [
        F.bit_and(F.when(F.col(f"`{name}`").isNotNull(), _csv_fits(F.col(f"`{name}`")))).alias(f"fits{i}")
        for i, name in enumerate(text.columns)
    ]
    seen = text.agg(F.count("*").alias("n"), *fits).first()
    if not seen or seen["n"] == 0:
        raise ValueError(f"no records found in {path}")
    typed = []
    for i, name in enumerate(text.columns):
        c = F.col(f"`{name}`")
        common = [t for t, bit in _CSV_TYPES.items() if (seen[f"fits{i}"] or 0) & bit]
        typed.append((c.try_cast(common[0]) if common else c).alias(name))
    return text.select(*typed)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, length and SHA-256 of every file below ``path``, on any Hadoop file system.

    A file's bytes are one value here, so Spark stops with an error at files above 2 GiB
    (``spark.sql.sources.binaryFile.maxLength``); cut such files before they are landed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
