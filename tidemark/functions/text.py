"""Scalar column helpers: trimming, blank tests and guarded parsing.

All helpers return native Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen. Parsing is guarded by patterns because
``try_cast`` alone is more lenient than the reference's rules (it accepts
``1d``, ``2026-09`` or ``10:00:00``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Acceptance patterns for text fields.
# numeric text: optional sign, decimal digits with optional fraction and
# exponent, or inf / infinity / nan; surrounding ASCII whitespace allowed.
NUMERIC_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
# calendar date text YYYY-MM-DD, month and day may be unpadded.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
# timestamp text: a full date, then maybe a padded time, a fraction and a numeric offset or Z.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
# Whitespace trimmed from text ends: every character Python's ``str.isspace``
# accepts (the rule the reference's ``strip()`` applies), built by rule.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_trim(c: Column | str) -> Column:
    """Trim all Unicode whitespace from both ends (plain ``trim`` strips spaces only).

    ``btrim`` with an explicit character set is a plain string scan, far
    cheaper than a Unicode-aware regex on every text column.
    """
    return F.btrim(as_column(c).cast("string"), F.lit(WHITESPACE))


def clean_text(c: Column | str) -> Column:
    """Trimmed text with NULL read as blank (``''``)."""
    return F.coalesce(ws_trim(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """NULL, or empty after trimming. Never NULL itself."""
    col = as_column(c)
    return col.isNull() | (ws_trim(col) == "")


def numeric_text_ok(c: Column | str) -> Column:
    """True when text reads as a number under the reference's float rules."""
    return F.coalesce(as_column(c).cast("string").rlike(NUMERIC_PATTERN), F.lit(False))


def try_double(c: Column | str) -> Column:
    """Text -> double, NULL unless the text passes the numeric pattern (never raises)."""
    text = ws_trim(c)
    return F.when(F.coalesce(text.rlike(NUMERIC_PATTERN), F.lit(False)), text.try_cast("double"))


def is_calendar_date(c: Column | str) -> Column:
    """Trimmed text is a real YYYY-MM-DD date (unpadded month/day accepted, year 0000 not)."""
    text = ws_trim(c)
    return F.coalesce(
        text.rlike(DATE_PATTERN)
        & ~text.startswith("0000")
        & text.try_cast("date").isNotNull(),
        F.lit(False),
    )


def try_timestamp(c: Column | str) -> Column:
    """ISO-8601 text -> timestamp; ``Z`` equals ``+00:00``; bad text -> NULL.

    The whole text must match: ``10:00:00`` cannot turn into today's date, and
    zone names or unpadded times are refused.
    """
    text = ws_trim(c)
    return F.when(
        F.coalesce(text.rlike(TIMESTAMP_PATTERN), F.lit(False)),
        text.try_cast("timestamp"),
    )


def parse_flag(c: Column | str) -> Column:
    """Text ``true`` (any case, trimmed) -> True; everything else, NULL included -> False."""
    col = as_column(c)
    return F.coalesce(F.lower(ws_trim(col)) == "true", F.lit(False))


def clock_column(clock) -> Column:
    """The run clock as a timestamp column: a Column is used as is, a
    ``datetime`` (naive = UTC) becomes a literal. Never ``current_timestamp``:
    recomputation of a lost partition must see the same value."""
    import datetime as dt

    if isinstance(clock, Column):
        return clock.cast("timestamp")
    if isinstance(clock, dt.datetime):
        if clock.tzinfo is not None:
            clock = clock.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(clock.isoformat(sep=" ")).cast("timestamp")
    return F.lit(clock).cast("timestamp")
