"""Deterministic keys: name-based UUIDs, hash differences and hash keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The X.500 name space of RFC 4122 as hex, and the variant digit for each hex digit.
X500_NAMESPACE = "6ba7b8149dad11d180b400c04fd430c8"
HEX_DIGITS = "0123456789abcdef"
VARIANT_DIGITS = "89ab89ab89ab89ab"

SEPARATOR = "\u001f"
NULL_MARK = "\u0000"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def joined_text(*cols: str | Column, sep: str = "") -> Column:
    """Text of the columns one after another; NULL if any of them is NULL."""
    parts: list[Column] = []
    for c in cols:
        if parts and sep:
            parts.append(F.lit(sep))
        parts.append(as_column(c).cast("string"))
    return F.concat(*parts)


def _uuid3_digest(cols: tuple[str | Column, ...], namespace: str, sep: str) -> Column:
    return F.md5(F.concat(F.unhex(F.lit(namespace)), F.encode(joined_text(*cols, sep=sep), "UTF-8")))


def _uuid3_text(digest: Column) -> Column:
    # Parts are cut from the bytes: a text is searched for its characters from the start, once for each part.
    digits = digest.cast("binary")

    def part(start: int, length: int) -> Column:
        return F.substring(digits, start, length)

    def mark(text: str) -> Column:
        return F.lit(text.encode())

    variant = F.translate(part(17, 1).cast("string"), HEX_DIGITS, VARIANT_DIGITS).cast("binary")
    pieces = [part(1, 8), mark("-"), part(9, 4), mark("-3"), part(14, 3), mark("-"), variant, part(18, 3), mark("-"), part(21, 12)]
    return F.concat(*pieces).cast("string")


def uuid3_key(*cols: str | Column, namespace: str = X500_NAMESPACE, sep: str = "") -> Column:
    """Version-3 UUID of the joined text, equal to ``uuid.uuid3`` for the same name space."""
    return _uuid3_text(_uuid3_digest(cols, namespace, sep))


def with_uuid3(df: DataFrame, keys: Mapping[str, Sequence[str | Column]]) -> DataFrame:
    """Adds ``uuid3_key`` of the given columns under each name.

    Spark merges a key into an aggregate below it, and there computes its digest once for every part of the key. Digests
    that are columns first are computed once.
    """
    digests = {f"_digest_{name}": _uuid3_digest(tuple(cols), X500_NAMESPACE, "") for name, cols in keys.items()}
    texts = {name: _uuid3_text(F.col(f"_digest_{name}")) for name in keys}
    return df.withColumns(digests).withColumns(texts).drop(*digests)


def hash_diff(*cols: str | Column, sep: str = "") -> Column:
    """Change key of a satellite row: UUID of its attributes.

    The default joins without a separator, which keeps keys equal to those already loaded by
    other systems; give ``sep`` where ('ab','c') and ('a','bc') must differ.
    """
    return uuid3_key(*cols, sep=sep)


def _guarded_text(cols: tuple[str | Column, ...]) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(as_column(c).cast("string"), F.lit(NULL_MARK)) for c in cols])


def hash_key(*cols: str | Column) -> Column:
    """64-bit hash key.

    ``xxhash64`` alone skips NULL inputs, so (NULL, 1) and (1, NULL) would share a key; the
    columns are joined as text with a marker for NULL instead. 64 bits start to collide at
    some billions of keys: use ``md5_key`` beyond that.
    """
    return F.xxhash64(_guarded_text(cols))


def md5_key(*cols: str | Column) -> Column:
    """128-bit hash key as hex text over the same joined text."""
    return F.md5(F.encode(_guarded_text(cols), "UTF-8"))
