"""Document, parent and state keys, and column lookup by configured name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _joined(tenant: Column, middle: Column, last: Column) -> Column:
    usable = (F.length(F.trim(tenant)) > 0) & last.isNotNull()
    return F.when(usable, F.concat_ws("_", tenant, middle, last.cast("string")))


def doc_id(tenant: Column, document_type: str | Column, key: Column) -> Column:
    """``<tenant>_<type>_<id>``; null when tenant or id is unusable, as an id with a fraction is."""
    kind = F.lit(document_type) if isinstance(document_type, str) else document_type
    return _joined(tenant, kind, whole_number(key))


def whole_number(key: Column) -> Column:
    """The 64-bit number of a key; null unless the key is one."""
    number = key.try_cast("bigint")
    return F.when(key.try_cast("double") == number.cast("double"), number)


def parent_key(tenant: Column, parent_type: str, key: Column) -> Column:
    """``<tenant>_<parent type>_<id>`` of the parent document."""
    return doc_id(tenant, parent_type, key)


def state_key(tenant: Column, document_type: Column) -> Column:
    """``<tenant>_<type>``."""
    return F.concat_ws("_", tenant, document_type)


def find_column(df: DataFrame, name: str) -> str | None:
    """Column with this name, ignoring case; a leading ``alias.`` is dropped if needed."""
    by_lower = {column.lower(): column for column in df.columns}
    wanted = name.strip().lower()
    if wanted in by_lower:
        return by_lower[wanted]
    return by_lower.get(wanted.rsplit(".", 1)[-1])
