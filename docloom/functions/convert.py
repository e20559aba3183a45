"""Row to document conversion as plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.mappers import mapper
from docloom.functions.scalars import base64_text
from docloom.model import is_epoch_field, mapping_type

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide are an error."""
    names = [column.lower() for column in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns collide once lower-cased: {', '.join(repeated)}")
    return df.toDF(*names)


def epoch_seconds(value: Column) -> Column:
    """Date or timestamp to whole seconds since 1970 in the session time zone."""
    return F.unix_seconds(value.cast("timestamp"))


def row_json(columns: list[Column]) -> Column:
    """JSON object of the columns; nulls are kept, binary becomes base64."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def binary_document(content: Column) -> Column:
    """``{"data": <base64>}`` of a binary value."""
    return F.to_json(F.struct(base64_text(content).alias("data")))


def apply_mappers(df: DataFrame, mappers: Mapping[str, str]) -> DataFrame:
    """Replace string columns by what their registered mapper makes of them.

    Column ids match ignoring case; columns of another type are left alone.
    """
    wanted = {column.lower(): name for column, name in mappers.items()}
    replaced = {
        field.name: mapper(wanted[field.name.lower()]).apply(F.col(field.name))
        for field in df.schema.fields
        if field.name.lower() in wanted and isinstance(field.dataType, T.StringType)
    }
    return df.withColumns(replaced) if replaced else df


def apply_epoch_fields(df: DataFrame, mapping: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Turn time columns declared as epoch seconds into bigint."""
    replaced = {
        field.name: epoch_seconds(F.col(field.name))
        for field in df.schema.fields
        if isinstance(field.dataType, TIME_TYPES)
        and field.name in mapping
        and is_epoch_field(mapping[field.name])
    }
    return df.withColumns(replaced) if replaced else df


def document_schema(
    mapping: Mapping[str, Mapping[str, str]], mappers: Mapping[str, str] | None = None
) -> T.StructType:
    """Typed columns a mapping declares; a mapped text takes its mapper's type.

    A type without declared fields still has its tenant: a struct cannot be empty.
    """
    mapping = mapping or {"tenant": {"type": "keyword"}}
    by_column = {column.lower(): name for column, name in (mappers or {}).items()}
    fields = []
    for name, spec in mapping.items():
        lowered = name.lower()
        dtype = mapper(by_column[lowered]).dtype if lowered in by_column else mapping_type(spec)
        fields.append(T.StructField(lowered, dtype))
    return T.StructType(fields)


def typed_fields(df: DataFrame, schema: T.StructType) -> list[Column]:
    """One column per declared field: cast when present, typed null when missing."""
    present = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        elif present[field.name].dataType == field.dataType:
            value = F.col(present[field.name].name)
        elif isinstance(present[field.name].dataType, T.BinaryType):
            value = base64_text(F.col(present[field.name].name))
        elif isinstance(present[field.name].dataType, TIME_TYPES) and isinstance(
            field.dataType, T.LongType
        ):
            value = epoch_seconds(F.col(present[field.name].name))
        else:
            value = F.col(present[field.name].name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return columns


def apply_mapping(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared fields and types."""
    return df.select(*typed_fields(df, schema))
