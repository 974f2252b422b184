"""SHA-256 building blocks: pseudonyms, row digests and order-independent group digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "~"


def pseudonymise(column: Column, salt: str) -> Column:
    """Upper-case hex SHA-256 of salt and value; null stays null."""
    return F.upper(F.sha2(F.concat(F.lit(salt), column), 256))


def _framed(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(columns: Sequence[Column], encoding: str = "joined") -> Column:
    """Hex SHA-256 over the values of one row.

    ``joined`` skips nulls and does not escape, so (a, null, b) and (a, b, null) hash alike. ``framed`` prefixes each
    value with its length and marks nulls, so every edit changes the hash; changing the encoding of a stored snapshot
    makes every record look changed once.
    """
    if encoding == "framed":
        columns = [_framed(c) for c in columns]
    elif encoding != "joined":
        raise ValueError(f"unknown encoding {encoding!r}; known: framed, joined")
    return F.sha2(F.concat_ws(SEPARATOR, *columns), 256)


def group_digest(hashes: Column) -> Column:
    """Aggregate: hex SHA-256 of a group's row hashes (hex, as :func:`row_hash` gives them), whatever their order, counting duplicates.

    The hashes' first 240 bits, as four numbers of 60 bits, are summed over the group, and the sums and the number of rows are hashed. Sums
    combine before a shuffle and take the same few bytes for a group of any size. They are exact: decimals of 30 digits hold those of
    10^12 rows.
    """
    words = [F.conv(F.substring(hashes, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)") for k in range(4)]
    return F.sha2(F.concat_ws(SEPARATOR, *[F.sum(w).cast("string") for w in words], F.count(F.lit(1)).cast("string")), 256)
