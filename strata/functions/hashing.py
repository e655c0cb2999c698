"""Hash expressions over columns, all built from JVM-side functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stored hashes only stay comparable while these do not change.
SEPARATOR = "||"
NULL_TOKEN = "NULL"
HASH_BITS = 256
_HASH_BYTES = HASH_BITS // 8
_HASH = f"^[0-9a-f]{{{2 * _HASH_BYTES}}}$"


def hash_expr(columns: Iterable[str | Column], *, safe: bool = False) -> Column:
    """SHA-256 hex digest of the columns' text, in the order given.

    With ``safe=False`` a NULL reads as the word ``NULL`` and values are joined as they
    are, so ``("a||b", "c")`` and ``("a", "b||c")`` share a digest. ``safe=True`` escapes
    backslashes and pipes in the values and writes NULL as ``\\N``, which no escaped value
    can equal.
    """
    return F.sha2(hash_text(columns, safe=safe), HASH_BITS)


def hash_text(columns: Iterable[str | Column], *, safe: bool = False) -> Column:
    """The text behind ``hash_expr``, never NULL; equal where the hashes are."""
    texts = [_text(c, safe) for c in columns]
    if not texts:
        raise ValueError("no columns to hash")
    return F.concat_ws(SEPARATOR, *texts)


def packed(column: str | Column) -> Column:
    """A hash as its bytes, half as many as its digits, for shuffles. Other texts are followed by more zeros than a
    hash has bytes, so that none equals one. Texts of either kind keep their order.
    """
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    other = F.concat(text.cast("binary"), F.lit(bytes(_HASH_BYTES + 1)))
    return F.when(text.rlike(_HASH), F.unhex(text)).otherwise(other)


def unpacked(column: str | Column) -> Column:
    """The text of a ``packed`` one."""
    held = F.col(column) if isinstance(column, str) else column
    other = F.substring(held, F.lit(1), F.length(held) - _HASH_BYTES - 1).cast("string")
    return F.when(F.length(held) == _HASH_BYTES, F.lower(F.hex(held))).otherwise(other)


def hash_order(column: str | Column) -> list[Column]:
    """Narrow columns that order hashes as their texts do: two numbers of 15 digits each. Other texts order themselves."""
    text = F.col(column) if isinstance(column, str) else column
    is_hash = text.rlike(_HASH)
    digits = [F.conv(F.substring(text, start, 15), 16, 10).cast("long") for start in (1, 16)]
    return [*[F.when(is_hash, number) for number in digits], F.when(~is_hash, text)]


def _text(column: str | Column, safe: bool) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    if not safe:
        return F.coalesce(value, F.lit(NULL_TOKEN))
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit("\\N"))
