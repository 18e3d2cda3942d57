"""JSON text to columns and back: with a declared schema, an inferred one, or none."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_RECORD = "_corrupt_record"

# The start of an object type in the text of a shape, outside quoted field names.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")
_UNSURE = re.compile(r"DECIMAL\(\d+,0\)|VARIANT")


def parse_declared(df: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One column per schema field; malformed text gives nulls. ``keep`` columns pass through."""
    data = F.from_json(F.col(value).cast("string"), schema).alias("data")
    return df.select(*keep, data).select(*keep, "data.*")


def _column_type(seen: T.DataType) -> T.DataType | None:
    """The column type the JSON reader gives to values of a type; None if there were no values."""
    if isinstance(seen, T.StructType):
        typed = [T.StructField(field.name, kind) for field in seen if (kind := _column_type(field.dataType))]
        return T.StructType(sorted(typed, key=lambda field: field.name)) if typed else None
    if isinstance(seen, T.ArrayType):
        element = _column_type(seen.elementType)
        return T.ArrayType(element) if element else None
    if isinstance(seen, T.DecimalType):
        return T.DoubleType()
    return T.StringType() if isinstance(seen, T.NullType) else seen


def _merged_shape(df: DataFrame, value: str) -> T.DataType | None:
    """The shapes of all objects merged by one aggregate, if that says all the JSON reader would.

    It does not where some text is no object; where a decimal has no fraction digits, which is
    either a fraction like 2.0 or a whole number past the longs; and where types clash, which is
    no clash to the reader if one of them is an empty text.
    """
    is_object = _trimmed(value).startswith("{")
    # Parsed in a projection of its own, so that both aggregates share one parse per row.
    parsed = df.select(
        F.when(is_object, F.try_parse_json(F.col(value).cast("string"))).alias("parsed"),
        has_text(value).alias("filled"),
    )
    is_other = F.col("filled") & F.col("parsed").isNull()
    shape, other = parsed.agg(F.schema_of_variant_agg("parsed"), F.count_if(is_other)).first()
    if other or (shape and _UNSURE.search(shape)):
        return None
    if not shape or not shape.startswith("OBJECT<"):
        return T.StructType([])  # there is no text at all
    return T.DataType.fromDDL(_OBJECT.sub(lambda part: "STRUCT<" if part[0] == "OBJECT<" else part[0], shape))


def infer_json_schema(df: DataFrame, value: str = "value") -> T.StructType:
    """Schema of the JSON objects in a column, fields sorted by name, from every row.

    It is the schema the JSON reader infers. Tasks merge the shapes they see and only the merged
    one reaches the driver. A field seen with clashing types becomes a string. If some text is not
    a JSON object the schema also has a string column for the text itself.
    """
    shape = _merged_shape(df, value)
    if shape is not None:
        return _column_type(shape) or T.StructType([])
    # Lists and bare values do not parse into a row, so the reader is shown broken text for them.
    shown = F.when(_trimmed(value).startswith("{"), F.col(value).cast("string")).otherwise("{")
    # The reader takes a dataset of strings; Python's wrapper offers only an RDD of Python strings, so the JVM's
    # reader is called and no row passes through Python.
    spark, texts = df.sparkSession, df.where(has_text(value)).select(shown.alias("value"))
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read().option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    return T.StructType.fromJson(json.loads(reader.json(strings).schema().json()))


def merge_types(known: T.DataType, more: T.DataType) -> T.DataType:
    """The type that holds the values of both, as the JSON reader merges what it sees in one batch: objects field by field,
    whole numbers with fractions as fractions, all else that differs as text."""
    if known == more:
        return known
    if isinstance(known, T.StructType) and isinstance(more, T.StructType):
        fields = {field.name: field.dataType for field in known}
        for field in more:
            fields[field.name] = merge_types(fields[field.name], field.dataType) if field.name in fields else field.dataType
        return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])
    if isinstance(known, T.ArrayType) and isinstance(more, T.ArrayType):
        return T.ArrayType(merge_types(known.elementType, more.elementType))
    if {type(known), type(more)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def _trimmed(value: str) -> Column:
    return F.ltrim(F.col(value).cast("string"), F.lit(" \t\r\n"))


def has_text(value: str = "value") -> Column:
    """False for null and for blank text."""
    return F.coalesce(F.length(_trimmed(value)) > 0, F.lit(False))


def parse_inferred(
    df: DataFrame,
    value: str = "value",
    keep: tuple[str, ...] = (),
    schema: T.StructType | None = None,
    skip_blank: bool = True,
) -> DataFrame:
    """Parse with the schema of this very DataFrame, or with one inferred earlier and passed in.

    Blank text is no row to the JSON reader; ``skip_blank=False`` keeps it as a row of nulls.
    """
    schema = schema or infer_json_schema(df, value)
    rows = df.where(has_text(value)) if skip_blank else df
    if not schema.fields:
        return rows.select(*keep)
    options = {"columnNameOfCorruptRecord": CORRUPT_RECORD}
    data = F.from_json(F.col(value).cast("string"), schema, options).alias("data")
    return rows.select(*keep, data).select(*keep, "data.*")


def json_value(*columns: str) -> Column:
    """The given columns (all by default) as one JSON object."""
    return F.to_json(F.struct(*(columns or ("*",))))


def json_field(col: Column | str, path: str, kind: str = "string") -> Column:
    """A field of JSON text read without any schema; null when absent or when the text is broken."""
    return F.try_variant_get(F.try_parse_json(col), path, kind)
