"""Predicate builders.

Every builder returns a plain ``Column`` so Catalyst can push it into the
parquet scan.  Ranges are always half-open ``[start, end)`` on the raw column:
never cast the column to a string or date to filter it (R1), since only the
typed comparison reaches ``PushedFilters`` / ``PartitionFilters``.
"""

from __future__ import annotations

import datetime as _dt
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Two upper-case letters: the valid-country-code rule (a string range 'A'..'Z'
# would lose 'ZA').
VALID_CODE_PATTERN = r"^[A-Z]{2}$"
# Package names of throw-away projects: prefixes test-, temp-, demo- and the suffix -test.
EXCLUDED_PROJECT_PREFIXES = ("test-", "temp-", "demo-")
EXCLUDED_PROJECT_SUFFIXES = ("-test",)
# ---------------------------------------------------------------------------
# The same rule as one pattern.
EXCLUDED_PROJECT_PATTERN = "|".join(["^" + p for p in EXCLUDED_PROJECT_PREFIXES] + [x + "$" for x in EXCLUDED_PROJECT_SUFFIXES])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _moment(value) -> _dt.datetime:
    """A date, datetime or ISO text as UTC wall-clock time."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    elif not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return value.astimezone(_dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def _ts_lit(value) -> Column:
    """Literal timestamp without time zone."""
    return value if isinstance(value, Column) else _ntz(_moment(value))


def _compare(col: Column, value, op) -> Column:
    """``op(col, bound)`` where the bound is UTC: an instant for a zoned column, else wall-clock time.

    ``typeof`` is a constant of the plan; the branch that is left compares the
    raw column with a literal, which the scan can use.
    """
    if isinstance(value, Column):
        return op(col, value)
    moment = _moment(value)
    zoned = op(col.cast("timestamp"), F.lit(moment.replace(tzinfo=_dt.timezone.utc)))
    return F.when(F.typeof(col) == "timestamp", zoned).otherwise(op(col, _ntz(moment)))


def _ntz(moment: _dt.datetime) -> Column:
    return F.to_timestamp_ntz(F.lit(moment.isoformat(sep=" ")))


def is_true(c) -> Column:
    """boolean equality with TRUE (NULL is not TRUE)."""
    return _col(c) == F.lit(True)


def equals(c, value) -> Column:
    """F2."""
    return _col(c) == F.lit(value)


def in_list(c, values, negate: bool = False) -> Column:
    """IN / NOT IN a literal list."""
    p = _col(c).isin(list(values))
    return ~p if negate else p


def time_range(c, start=None, end=None) -> Column:
    """``start <= c < end`` in UTC; either bound may be omitted."""
    col = _col(c)
    preds = []
    if start is not None:
        preds.append(_compare(col, start, operator.ge))
    if end is not None:
        preds.append(_compare(col, end, operator.lt))
    if not preds:
        return F.lit(True)
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def trailing_days(c, days: int, as_of=None, exclude_today: bool = False) -> Column:
    """rows of the last ``days`` x 24h before ``as_of``.

    ``as_of`` (UTC) defaults to now; pass a literal for reproducible reports.
    ``exclude_today`` adds ``c < date(as_of)`` so a partial current day is left
    out.
    """
    anchor = _moment(as_of) if as_of is not None else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    end = _dt.datetime(anchor.year, anchor.month, anchor.day) if exclude_today else None
    return time_range(c, anchor - _dt.timedelta(days=int(days)), end)


def month_range(c, month: str, partition_col: str | None = None) -> Column:
    """A sargable month filter instead of ``CAST(ts AS STRING) LIKE 'YYYY-MM-%'``.

    Gives ``[first day, first day of next month)`` on ``c``; if the table is
    partitioned by a derived date column, the same range is added on it so
    partition pruning happens as well.
    """
    year, mon = (int(x) for x in month.split("-"))
    start = _dt.date(year, mon, 1)
    end = _dt.date(year + (mon == 12), mon % 12 + 1, 1)
    pred = time_range(c, start, end)
    if partition_col is not None:
        pc = F.col(partition_col)
        pred = pred & (pc >= F.lit(start)) & (pc < F.lit(end))
    return pred


def regex_contains(c, pattern: str, negate: bool = False) -> Column:
    """Partial regex match (``REGEXP_CONTAINS``)."""
    p = _col(c).rlike(pattern)
    return ~p if negate else p


def like(c, pattern: str, negate: bool = False) -> Column:
    """F8."""
    p = _col(c).like(pattern)
    return ~p if negate else p


def valid_code(c) -> Column:
    """exactly two upper-case letters."""
    return _col(c).rlike(VALID_CODE_PATTERN)


def not_excluded_project(c, use_regex: bool = False) -> Column:
    """the four NOT LIKE conditions as one rule.

    By default the rule is built from ``startswith`` / ``endswith``, which
    Spark evaluates without a regex engine per row (and can hand to the
    parquet reader as string-prefix filters); ``use_regex=True`` gives the
    single-regex form.  Both treat NULL alike (the row is dropped).
    """
    col = _col(c)
    if use_regex:
        return ~col.rlike(EXCLUDED_PROJECT_PATTERN)
    hit = None
    for p in EXCLUDED_PROJECT_PREFIXES:
        hit = col.startswith(p) if hit is None else hit | col.startswith(p)
    for sfx in EXCLUDED_PROJECT_SUFFIXES:
        hit = hit | col.endswith(sfx)
    return ~hit


def all_of(*preds: Column) -> Column:
    """AND of a list of predicates."""
    out = F.lit(True)
    for p in preds:
        out = out & p
    return out
