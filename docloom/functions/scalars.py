"""Small scalar functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Supported digests.
DIGESTS = ("SHA1", "SHA224", "SHA256", "SHA384", "SHA512")


def equals_ignore_case(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def split_csv(value: Column, trim: bool = True) -> Column:
    """Comma list to array; elements are trimmed on request."""
    parts = F.split(value, ",")
    return F.transform(parts, lambda part: F.trim(part)) if trim else parts


def last_index_of(value: Column, needle: str) -> Column:
    """0-based position of the last occurrence of one character, -1 when absent."""
    from_end = F.locate(needle, F.reverse(value))
    return F.when(from_end == 0, F.lit(-1)).otherwise(F.length(value) - from_end)


def try_long(value: Column) -> Column:
    """Text to bigint; anything unreadable becomes null."""
    return F.trim(value).try_cast("bigint")


def base64_text(value: Column) -> Column:
    """Base64 in one line, whatever the session's line-length setting."""
    return F.translate(F.base64(value), "\r\n", "")


def fingerprint(value: Column, digest: str = "SHA256") -> Column:
    """Base64 of a message digest of the text."""
    name = digest.upper().replace("-", "")
    if name not in DIGESTS:
        raise ValueError(f"unsupported digest {digest!r}")
    hexed = F.sha1(value) if name == "SHA1" else F.sha2(value, int(name[3:]))
    return base64_text(F.unhex(hexed))


def blank_to_default(value: Column, default: Column) -> Column:
    """The trimmed text, or the default when null or blank."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), default)


def json_get(value: Column, name: str, dtype: str) -> Column:
    """One typed top-level field of a JSON text."""
    return F.from_json(value, f"`{name}` {dtype}")[name]


def in_type_list(document_type: Column, type_list: str | None) -> Column:
    """Case-insensitive membership of a comma list; no list means every type."""
    if type_list is None:
        return F.lit(True)
    wanted = sorted({part.strip().lower() for part in type_list.split(",")})
    return F.lower(document_type).isin(wanted)
