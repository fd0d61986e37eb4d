"""Suggestion rules.

Rules look at the analysed schema of any DataFrame instead of SQL text:
column names, ``StructField.nullable`` (a ``coalesce(x, literal)`` column is
reported non-nullable, so it gets no NOT NULL check), the nullable-side
metadata written by ``left_join_tagged``, and the outer joins of the analysed
query, so that SQL text is warned of like a DataFrame.  Everything here runs on
the driver over the schema and the plan only; no data is touched.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tessera.checks import model as m
from tessera.operators.joins import NULLABLE_SIDE_KEY, nullable_side_columns

# --- fixed values -----------------------------------------------------------
# Name patterns (applied to the lower-cased column name).
ID_PATTERN = r"(^|_)id$"
EMAIL_SUBSTRING = "email"
COUNTRY_PATTERN = r"country_?code$|^country$"
TIMESTAMP_PATTERN = r"_at$"
DATE_PATTERN = r"_date$"
MEASURE_PATTERN = r"^(total|num|count)_|_(count|orders|amount|spent|days|tenure|revenue|price)$"
# NOT NULL reasons, first matching rule wins ({c} is the column name).
NOT_NULL_REASONS = [
    (ID_PATTERN, "'{c}' is an identifier column — a NULL here means the row is unidentifiable"),
    (EMAIL_SUBSTRING, "'{c}' is an email field — usually required for user identification and communication"),
    (COUNTRY_PATTERN, "'{c}' is a categorical field — a missing country code usually signals bad or incomplete data"),
    (TIMESTAMP_PATTERN, "'{c}' is a timestamp — every record should have a populated event time"),
    (DATE_PATTERN, "'{c}' is a date field — NULL dates make time-based analysis unreliable"),
]
LEFT_JOIN_SUFFIX = " — comes from the nullable side of a LEFT JOIN, NULLs may be expected here"
# ---------------------------------------------------------------------------


def _matches(rule: str, lower: str) -> bool:
    if rule == EMAIL_SUBSTRING:
        return EMAIL_SUBSTRING in lower
    return re.search(rule, lower) is not None


def not_null_reason(name: str) -> str | None:
    """Reason of the first matching NOT NULL rule, or None."""
    lower = name.lower()
    for rule, text in NOT_NULL_REASONS:
        if _matches(rule, lower):
            return text.format(c=name)
    return None


def suggest_checks(df: DataFrame) -> list[m.Check]:
    """Table-level checks, then per output column in order.

    Per column the order is: not_null, unique, email_format,
    country_code_length, non_negative.  Duplicate output names are rejected,
    since their check names would collide.
    """
    names = [f.name for f in df.schema.fields]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"ambiguous output column names: {dupes}")
    from_join = nullable_side_columns(df)
    checks: list[m.Check] = [m.row_count_positive(), m.no_duplicate_rows()]
    for f in df.schema.fields:
        lower = f.name.lower()
        reason = not_null_reason(f.name)
        # A defaulted (non-nullable) column cannot be NULL -> no NOT NULL check.
        if reason is not None and f.nullable:
            if (f.metadata or {}).get(NULLABLE_SIDE_KEY) or f.name in from_join:  # D17
                reason += LEFT_JOIN_SUFFIX
            checks.append(m.not_null(f.name, reason))
        if re.search(ID_PATTERN, lower):
            checks.append(m.unique(f.name))
        if EMAIL_SUBSTRING in lower:
            checks.append(m.email_format(f.name))
        if re.search(COUNTRY_PATTERN, lower):
            checks.append(m.country_code_length(f.name))
        if re.search(MEASURE_PATTERN, lower):
            checks.append(m.non_negative(f.name))
    return checks


def select_checks(checks: list[m.Check], only: list[str] | None = None,
                  skip: list[str] | None = None) -> tuple[list[m.Check], str]:
    """Keep checks by name; returns (selected, "Running n of m tests (k skipped)").

    An empty selection is an explicit stop: ``ValueError``.
    """
    known = {c.name for c in checks}
    unknown = (set(only or []) | set(skip or [])) - known
    if unknown:
        raise ValueError(f"unknown check names: {sorted(unknown)}")
    chosen = [c for c in checks
              if (only is None or c.name in set(only)) and c.name not in set(skip or [])]
    if not chosen:
        raise ValueError("No tests selected. Nothing to run.")
    skipped = len(checks) - len(chosen)
    summary = f"Running {len(chosen)} of {len(checks)} tests" + (f"  ({skipped} skipped)" if skipped else "")
    return chosen, summary
