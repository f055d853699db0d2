"""Hash keys for the vault and for surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Separators and placeholders that stored hashes depend on.
KEY_SEPARATOR = "||"
NESTED_SEPARATOR = "|"
DIFF_NULL = "NULL"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _digest(text: Column) -> Column:
    """SHA-256 of a text that is never null.

    Stating that the result is never null keeps the optimizer from adding a null filter to
    joins on the hash, which would compute it twice per row.
    """
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def folded(column: str | Column) -> Column:
    """Text of a business key part as it is hashed."""
    return F.upper(F.trim(_text(column)))


def key_text(parts: Sequence[Column]) -> Column:
    """What a business key's hash is taken of: two keys share a hash if they share this text, which is far shorter to shuffle."""
    return F.concat_ws(KEY_SEPARATOR, *parts)


def text_hash(text: Column) -> Column:
    """Business hash of a key whose text has been made."""
    return _digest(F.concat_ws(KEY_SEPARATOR, text))


def business_hash(columns: Sequence[str | Column], null_token: str | None = None) -> Column:
    """SHA-256 of the trimmed, upper-cased business key parts.

    Nulls are skipped, as in stored keys; pass ``null_token`` to keep their position so that
    ``(a, null)`` and ``(null, a)`` differ.
    """
    parts = [folded(c) for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return _digest(key_text(parts))


#: Bytes before a text that is no SHA-256, so that its packed form is never as long as that of one.
_PLAIN = "00" * 33


def packed(column: str | Column) -> Column:
    """A hash as its 32 bytes, half of its text, for shuffles; any other text keeps its bytes behind a mark."""
    text = F.col(column) if isinstance(column, str) else column
    plain = F.concat(F.unhex(F.lit(_PLAIN)), text.cast("binary"))
    return F.when(text.rlike("^[0-9a-f]{64}$"), F.unhex(text)).otherwise(plain)


def unpacked(column: str | Column) -> Column:
    """The text that was packed."""
    value = F.col(column) if isinstance(column, str) else column
    plain = F.substring(value, F.lit(len(_PLAIN) // 2 + 1), F.length(value)).cast("string")
    return F.when(F.length(value) == 32, F.lower(F.hex(value))).otherwise(plain)


def pack_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: packed(n) for n in names})


def unpack_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: unpacked(n) for n in names})


def diff_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over tracked attributes, nulls marked, case kept."""
    parts = [F.coalesce(_text(c), F.lit(DIFF_NULL)) for c in columns]
    return _digest(F.concat_ws(KEY_SEPARATOR, *parts))


def plain_hash(column: str | Column) -> Column:
    """SHA-256 of one value's text, without folding: the hub key form of the SQL models."""
    return F.sha2(_text(column), 256)


def nested_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of the joined hub hashes: the link key form of the SQL models."""
    return _digest(F.concat_ws(NESTED_SEPARATOR, *[plain_hash(c) for c in columns]))


def surrogate_key(columns: Sequence[str | Column], null_token: str = SURROGATE_NULL) -> Column:
    """MD5 of the values' text joined by a dash, nulls replaced by a placeholder."""
    parts = [F.coalesce(_text(c), F.lit(null_token)) for c in columns]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))
