"""Rule configuration and the request state relation.

A ``Policy`` is plain Python configuration; operators compile it into column
expressions at plan time, so the rules work for any table with the named
columns and never run Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

# The twelve request states.
NEW = "NEW"
ELIGIBLE = "ELIGIBLE"
VALIDATED = "VALIDATED"
READY_FOR_REVIEW = "READY_FOR_REVIEW"
APPROVED = "APPROVED"
SUBMITTED = "SUBMITTED"
REGISTERED = "REGISTERED"
NOT_ELIGIBLE = "NOT_ELIGIBLE"
VALIDATION_FAILED = "VALIDATION_FAILED"
REJECTED = "REJECTED"
SUBMISSION_FAILED = "SUBMISSION_FAILED"
SUBMISSION_UNKNOWN = "SUBMISSION_UNKNOWN"

STATES = (
    NEW, ELIGIBLE, VALIDATED, READY_FOR_REVIEW, APPROVED, SUBMITTED, REGISTERED,
    NOT_ELIGIBLE, VALIDATION_FAILED, REJECTED, SUBMISSION_FAILED, SUBMISSION_UNKNOWN,
)

# Legal transitions (from -> allowed targets); the six states
# not listed as a source are terminal.
REQUEST_TRANSITIONS: dict[str, tuple[str, ...]] = {
    NEW: (ELIGIBLE, NOT_ELIGIBLE),
    ELIGIBLE: (VALIDATED, VALIDATION_FAILED),
    VALIDATED: (READY_FOR_REVIEW, VALIDATION_FAILED),
    READY_FOR_REVIEW: (APPROVED, REJECTED),
    APPROVED: (SUBMITTED, SUBMISSION_FAILED, SUBMISSION_UNKNOWN),
    SUBMITTED: (REGISTERED, SUBMISSION_FAILED, SUBMISSION_UNKNOWN),
}

# Rule and outcome texts.
MSG_MISSING = "Missing: {field}"
MSG_NOT_POSITIVE = "Invalid value: {field} must be greater than 0"
MSG_NOT_NUMERIC = "Invalid format: {field} must be numeric"
MSG_BAD_DATE = "Invalid format: {field} must be YYYY-MM-DD"
MSG_NOT_ALLOWED = "Invalid value: {field} must be one of {allowed}"
MSG_PARTNER = "Partner is '{shown}', not {partner}"
MSG_NOT_REQUIRED = "Registration is not required for this deal"
MSG_ALREADY_REGISTERED = "Deal is already registered"
MSG_INVALID_TRANSITION = "Invalid registration transition: {src} -> {dst}"
REASON_NEEDS_APPROVAL = "registration_requires_approval"
REASON_UNCHANGED = "unchanged_source_version"
MSG_RETRYABLE = "Downstream registration is retryable"
MSG_REJECTED_HTTP = "Downstream registration rejected: HTTP {code}"
MSG_CONTRACT = "Draft contract requires customer_name and deal_name"
RETRYABLE_STATUS_CODES = (408, 429, 500, 502, 503, 504)
ERROR_SEPARATOR = "; "

# The business columns of a deal version (fingerprint input).
FINGERPRINT_COLUMNS = (
    "opportunity_id",
    "account_name",
    "opportunity_name",
    "country",
    "amount",
    "industry",
    "partner",
    "close_date",
    "registration_required",
    "registration_status",
)

# The columns validated for a deal.
VALIDATION_COLUMNS = (
    "account_name",
    "opportunity_name",
    "country",
    "amount",
    "industry",
    "partner",
    "close_date",
)


@dataclass(frozen=True)
class Policy:
    """Eligibility partner plus the four validation rule families."""

    partner: str = "Preferred"
    required_fields: tuple[str, ...] = VALIDATION_COLUMNS
    numeric_fields: tuple[str, ...] = ("amount",)
    date_fields: tuple[str, ...] = ("close_date",)
    allowed_values: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def with_partner_rule(self) -> "Policy":
        """The default rule set: partner must equal the policy partner."""
        allowed = dict(self.allowed_values)
        allowed["partner"] = (self.partner,)
        return Policy(self.partner, self.required_fields, self.numeric_fields,
                      self.date_fields, allowed)


def default_policy(partner: str = "Preferred") -> Policy:
    return Policy(partner=partner).with_partner_rule()


def relation_depth(relation: Mapping[str, tuple[str, ...]], start: str) -> int | None:
    """Longest path (in edges) from ``start``; ``None`` if a cycle is reachable."""
    memo: dict[str, int] = {}
    visiting: set[str] = set()

    def walk(node: str) -> int | None:
        if node in memo:
            return memo[node]
        if node in visiting:
            return None
        visiting.add(node)
        best = 0
        for nxt in relation.get(node, ()):
            d = walk(nxt)
            if d is None:
                return None
            best = max(best, d + 1)
        visiting.discard(node)
        memo[node] = best
        return best

    return walk(start)


def terminal_states(relation: Mapping[str, tuple[str, ...]]) -> tuple[str, ...]:
    targets = {t for ts in relation.values() for t in ts}
    return tuple(sorted(s for s in targets | set(relation) if not relation.get(s)))
