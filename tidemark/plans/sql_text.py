"""Helpers that write DuckDB SQL text for oracle queries.

They spell out, in SQL, the same canonical-text and hash rules the Spark
operators use, so ids computed by either engine can be compared.
"""

from __future__ import annotations

from collections.abc import Sequence


def field_text_sql(expr: str) -> str:
    text = f"CAST({expr} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"


def canonical_text_sql(exprs: Sequence[str]) -> str:
    return " || '|' || ".join(field_text_sql(e) for e in exprs)


def uuid_layout_sql(hex_expr: str) -> str:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({hex_expr}, {a}, {b})" for a, b in parts)


def hash_id_sql(exprs: Sequence[str]) -> str:
    return uuid_layout_sql(f"sha256({canonical_text_sql(exprs)})")


# The business fields of a version, spelled here for the oracles
# alone, so that a change of the operators' own list shows as a mismatch.
VERSION_FIELDS = (
    "account_name", "amount", "close_date", "country", "industry", "opportunity_id",
    "opportunity_name", "partner", "registration_required", "registration_status",
)


def fingerprint_sql(prefix: str = "") -> str:
    return f"sha256({canonical_text_sql([prefix + c for c in VERSION_FIELDS])})"
