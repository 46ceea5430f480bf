"""Records and links held as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.sky import as_column

CORRUPT = "_corrupt_record"

_ZERO = {T.StringType: "", T.IntegerType: 0, T.LongType: 0, T.FloatType: 0.0, T.DoubleType: 0.0, T.BooleanType: False}


def zeroed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` with 0, "" or false in place of nulls."""
    return df.select(
        *(
            F.coalesce(f.name, F.lit(_ZERO[type(f.dataType)]).cast(f.dataType)).alias(f.name) if type(f.dataType) in _ZERO else F.col(f.name)
            for f in schema.fields
        )
    )


def parse_records(
    df: DataFrame, text: str, schema: T.StructType, zero_for_null: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per element of the JSON arrays in column ``text``.

    Missing and null fields become 0 or "" (``zero_for_null=False`` leaves them null). A
    text that is not an array of such records gives one row with the text in
    ``_corrupt_record`` and no values, so nothing is lost.
    """
    array = T.ArrayType(schema)
    parsed = F.from_json(F.col(text), array, {"mode": "PERMISSIVE"})
    # An ill-typed field becomes null without notice; a second reading that keeps every
    # field as text shows whether a null was there before.
    as_text = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    raw = F.from_json(F.col(text), as_text, {"mode": "PERMISSIVE"})

    def ill_typed(pair: Column) -> Column:
        checks = [pair["parsed"][f.name].isNull() & pair["raw"][f.name].isNotNull() for f in schema.fields]
        found = checks[0]
        for check in checks[1:]:
            found = found | check
        return found

    staged = df.select(*keep, F.col(text).alias("__text"), parsed.alias("parsed"), raw.alias("raw"))
    pairs = F.arrays_zip("parsed", "raw")
    bad = (
        F.col("parsed").isNull()
        | (F.size("parsed") != F.size("raw"))
        | F.exists(F.col("parsed"), lambda r: r.isNull())
        | F.exists(pairs, ill_typed)
    )
    marked = staged.withColumn(CORRUPT, F.when(F.coalesce(bad, F.lit(True)), F.col("__text")))
    rows = marked.select(
        *keep, CORRUPT, F.explode_outer(F.when(F.col(CORRUPT).isNull(), F.col("parsed"))).alias("record")
    )
    # an empty array has neither records nor an error
    rows = rows.filter(F.col("record").isNotNull() | F.col(CORRUPT).isNotNull())
    fields = []
    for f in schema.fields:
        value = F.col("record")[f.name]
        if zero_for_null and type(f.dataType) in _ZERO:
            value = F.when(F.col("record").isNotNull(), F.coalesce(value, F.lit(_ZERO[type(f.dataType)]).cast(f.dataType)))
        fields.append(value.alias(f.name))
    return rows.select(*keep, *fields, CORRUPT)


def reject_catalogs_with_errors(records: DataFrame, catalog: str) -> DataFrame:
    """Drop every catalogue that has a corrupt record, as an all-or-nothing load does."""
    broken = records.filter(F.col(CORRUPT).isNotNull()).select(catalog).distinct()
    return records.join(broken, catalog, "left_anti").drop(CORRUPT)


def first_link(body: Column | str) -> Column:
    """URL of the first ``strain`` entry of a link list; null if there is none."""
    return F.get_json_object(as_column(body), "$.strain[0].url")
