"""Deterministic identifiers and canonical text for hashing.

Random UUIDs and wall-clock values are not stable when Spark recomputes a
lost partition, so every id here is a hash of business values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_column

# Fixed value: marker standing for a NULL field inside canonical text.
NULL_MARKER = "-"


def field_text(c: Column | str) -> Column:
    """One field as ``<length>:<text>``, or the NULL marker.

    Length prefixes keep values from running together (``a|b,c`` vs
    ``a,b|c``) and the marker keeps NULL distinct from the empty string.
    """
    text = as_column(c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARKER))


def canonical_text(cols: Sequence[Column | str]) -> Column:
    """Fields in the given order as one unambiguous string."""
    return F.concat_ws("|", *[field_text(c) for c in cols])


def uuid_layout(hex_digest: Column) -> Column:
    """First 32 hex characters of a digest laid out as 8-4-4-4-12."""
    return F.concat_ws(
        "-",
        F.substring(hex_digest, 1, 8),
        F.substring(hex_digest, 9, 4),
        F.substring(hex_digest, 13, 4),
        F.substring(hex_digest, 17, 4),
        F.substring(hex_digest, 21, 12),
    )


def hash_id(cols: Sequence[Column | str]) -> Column:
    """Deterministic UUID-shaped id from the canonical text of ``cols``."""
    return uuid_layout(F.sha2(canonical_text(cols), 256))
