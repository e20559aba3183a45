"""Column mappers: text to nested values, by registered name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.scalars import last_index_of, try_long

ATTRIBUTE_LIST = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
)

# Leniency of the JSON reader.
LENIENT_JSON = {
    "allowSingleQuotes": "true",
    "allowUnquotedFieldNames": "true",
    "allowUnquotedControlChars": "true",
    "allowBackslashEscapingAnyCharacter": "true",
}

# How a complete attribute list ends, and how a cut one is closed.
COMPLETE_END = '"} ]'
CLOSE_AFTER_OBJECT = "}]"
CLOSE_INSIDE_VALUE = '"}]'


def long_array(value: Column) -> Column:
    """``"1,2,3"`` to ``[1, 2, 3]``.

    Trailing commas are dropped, blanks around a number are tolerated and an element
    that is no number becomes null in its place.
    """
    return F.transform(F.split(F.regexp_replace(value, ",+$", ""), ","), try_long)


def close_cut_list(value: Column) -> Column:
    """Close an attribute list that was cut off at the source's length limit."""
    last_brace = last_index_of(value, "}")
    kept = F.substring(value, F.lit(1), last_brace)
    return (
        F.when(value.endswith(COMPLETE_END), value)
        .when(last_brace > 0, F.concat(kept, F.lit(CLOSE_AFTER_OBJECT)))
        .otherwise(F.concat(value, F.lit(CLOSE_INSIDE_VALUE)))
    )


def custom_attributes(value: Column) -> Column:
    """JSON list of ``{name, value}``; unreadable text gives an empty list, null stays null."""
    closed = close_cut_list(value)
    parsed = F.when(
        F.ltrim(closed).startswith("["), F.from_json(closed, ATTRIBUTE_LIST, LENIENT_JSON)
    )
    empty = F.array().cast(ATTRIBUTE_LIST)
    return F.when(value.isNotNull(), F.coalesce(parsed, empty))


@dataclass(frozen=True)
class ColumnMapper:
    """A column function (built-in expressions or a pandas UDF) and its result type."""

    apply: Callable[[Column], Column]
    dtype: T.DataType


_REGISTRY: dict[str, ColumnMapper] = {
    "long_array": ColumnMapper(long_array, T.ArrayType(T.LongType())),
    "custom_attributes": ColumnMapper(custom_attributes, ATTRIBUTE_LIST),
}


def register_mapper(name: str, apply: Callable[[Column], Column], dtype: T.DataType | str) -> None:
    """Add a mapper; ``apply`` may be any function from Column to Column."""
    kind = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
    _REGISTRY[name] = ColumnMapper(apply, kind)


def mapper(name: str) -> ColumnMapper:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"no column mapper named {name!r}") from None
