"""Check model.

A check is a small immutable record.  Row-level checks carry a *violation
condition* as Spark SQL text: the same text is turned into a ``Column`` for
the fused distributed run and exported as re-runnable SQL.  Table-level and
uniqueness checks are grouped passes identified by ``kind``.
"""

from __future__ import annotations

import datetime as _dt
import decimal
from dataclasses import dataclass, field

from pyspark.sql.types import StructField, StructType, IntegerType, StringType, LongType, BooleanType

from tessera.functions.names import q

# --- fixed values -----------------------------------------------------------
# Check vocabulary.
TEST_TYPES = ("not_null", "unique", "format", "range", "table_level")
# Email shape and country-code length rules.
EMAIL_LIKE = "%@%.%"
COUNTRY_CODE_LENGTH = 2
# Reasons of the table-level checks.
REASON_ROW_COUNT = ("Result set should not be empty; zero rows usually means a broken "
                    "filter or missing upstream data")
REASON_DUPLICATES = ("Full-row duplicates indicate a join fanout or a missing deduplication "
                     "step upstream")
# Reasons of the column checks ({c} is the column name).
REASON_UNIQUE = "Column name ends in '_id' — expected to be a unique identifier per output row"
REASON_EMAIL_FORMAT = "'{c}' looks like an email column; values should contain '@' and a domain"
REASON_COUNTRY_LENGTH = "'{c}' looks like an ISO 3166 country code; valid values are exactly 2 characters"
REASON_NON_NEGATIVE = "'{c}' is a count/amount/duration and should never be negative"
# ---------------------------------------------------------------------------

ROW = "row"            # violation condition counted in the fused aggregate
EMPTY = "empty"        # 1 if the input has no rows
DUPLICATES = "duplicates"  # distinct full-row values that repeat
UNIQUE = "unique"      # COUNT(c) - COUNT(DISTINCT c)
REFERENCE = "reference"  # non-null values that a reference table lacks

RESULT_SCHEMA = StructType([
    StructField("position", IntegerType(), False),
    StructField("name", StringType(), False),
    StructField("column", StringType(), True),
    StructField("test_type", StringType(), False),
    StructField("reason", StringType(), True),
    StructField("failing_rows", LongType(), True),
    StructField("passed", BooleanType(), False),
    StructField("error", StringType(), True),
    StructField("status", StringType(), False),
])


@dataclass(frozen=True)
class Check:
    name: str
    column: str | None
    test_type: str
    reason: str
    kind: str = ROW
    condition: str | None = None       # Spark SQL boolean: TRUE = violating row
    needs_numeric: bool = False        # type gate applied before fusion
    columns: tuple[str, ...] = field(default_factory=tuple)  # columns the check reads
    reference: tuple[str, str] | None = None  # table or view, column

    def __post_init__(self):
        if self.test_type not in TEST_TYPES:
            raise ValueError(f"unknown test type {self.test_type!r}")
        if self.kind == ROW and not self.condition:
            raise ValueError("row-level checks need a condition")


# --- constructors -----------------------------------------------------------

def row_count_positive() -> Check:
    """1 when the input is empty, else 0."""
    return Check("table__row_count_positive", None, "table_level", REASON_ROW_COUNT, kind=EMPTY)


def no_duplicate_rows() -> Check:
    """Number of distinct full-row values occurring more than once."""
    return Check("table__no_duplicate_rows", None, "table_level", REASON_DUPLICATES, kind=DUPLICATES)


def not_null(column: str, reason: str | None = None) -> Check:
    """D3."""
    return Check(f"{column}__not_null", column, "not_null",
                 reason or f"'{column}' should never be NULL",
                 condition=f"{q(column)} IS NULL", columns=(column,))


def unique(column: str, reason: str | None = None) -> Check:
    """Excess copies, NULL ignored."""
    return Check(f"{column}__unique", column, "unique", reason or REASON_UNIQUE, kind=UNIQUE,
                 columns=(column,))


def email_format(column: str) -> Check:
    """Non-null values that do not look like ``x@y.z``."""
    return Check(f"{column}__email_format", column, "format", REASON_EMAIL_FORMAT.format(c=column),
                 condition=f"{q(column)} IS NOT NULL AND {q(column)} NOT LIKE '{EMAIL_LIKE}'",
                 columns=(column,))


def country_code_length(column: str) -> Check:
    """Non-null values whose length is not 2."""
    return Check(f"{column}__country_code_length", column, "format",
                 REASON_COUNTRY_LENGTH.format(c=column),
                 condition=f"{q(column)} IS NOT NULL AND length({q(column)}) <> {COUNTRY_CODE_LENGTH}",
                 columns=(column,))


def non_negative(column: str) -> Check:
    """Values below zero (NULL is not a failure)."""
    return Check(f"{column}__non_negative", column, "range", REASON_NON_NEGATIVE.format(c=column),
                 condition=f"{q(column)} < 0", needs_numeric=True, columns=(column,))


def column_pair(x: str, y: str) -> Check:
    """Cross-column rule ``x >= y``; rows where ``x < y`` fail."""
    return Check(f"{x}__gte__{y}", x, "range", f"'{x}' should be at least '{y}'",
                 condition=f"{q(x)} < {q(y)}", columns=(x, y))


def sql_literal(v) -> str:
    """A typed Spark SQL literal of a Python value."""
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v) if -2 ** 31 <= v < 2 ** 31 else f"{v}L" if -2 ** 63 <= v < 2 ** 63 else f"{v}BD"
    if isinstance(v, float):
        return f"double('{v!r}')"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}BD"
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'" if v.tzinfo else f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    raise TypeError(f"no SQL literal for {type(v).__name__}")


def accepted_values(column: str, values: list) -> Check:
    """Non-null values outside an accepted list (NULL never fails; an empty list accepts nothing else)."""
    known = [v for v in values if v is not None]
    lits = ", ".join(sql_literal(v) for v in known)
    outside = f" AND {q(column)} NOT IN ({lits})" if known else ""
    return Check(f"{column}__accepted_values", column, "format",
                 f"'{column}' should be one of {len(values)} accepted values",
                 condition=f"{q(column)} IS NOT NULL{outside}", columns=(column,))


def accepted_from(column: str, table: str, table_column: str | None = None) -> Check:
    """E4 with a reference table (a table or view of any size): non-null values that it lacks; NULLs in it accept nothing."""
    return Check(f"{column}__accepted_from__{table}", column, "format", f"'{column}' should be one of the values of '{table}'",
                 kind=REFERENCE, columns=(column,), reference=(table, table_column or column))


def integral(column: str) -> Check:
    """E5: a count column should hold integers.

    The remainder by one is taken in the column's own type, so decimals of any
    size are exact; text is read as a decimal, and text that is none fails.
    """
    c = q(column)
    return Check(f"{column}__integral", column, "format", f"'{column}' is a count and should hold integers",
                 condition=(f"{c} IS NOT NULL AND CASE WHEN typeof({c}) = 'string' "
                            f"THEN COALESCE(try_cast({c} AS DECIMAL(38,10)) % 1 <> 0, TRUE) ELSE {c} % 1 <> 0 END"),
                 columns=(column,))
