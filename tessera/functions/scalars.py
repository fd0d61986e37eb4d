"""Scalar helpers (S1-S19).  All are built-in expressions: no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Installer classification of the download report.
INSTALLER_STANDARD = "pip"
INSTALLER_MIRRORS = ("bandersnatch", "nexus", "artifactory")
INSTALLER_LABELS = {"standard": "Standard", "mirror": "Mirror/Proxy",
                    "unknown": "Unknown", "other": "Other-Tool"}
# Characters kept by the version cleaner, and the major.minor prefix pattern.
VERSION_STRIP_PATTERN = r"[^0-9.]"
MAJOR_MINOR_PATTERN = r"^([0-9]+\.[0-9]+)"
# Day-of-week numbers of Saturday and Sunday (1 = Sunday ... 7 = Saturday).
WEEKEND_DAYS = (1, 7)
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_DAY_MICROS = 86_400_000_000


def to_day(c) -> Column:
    """Calendar day of a timestamp, in UTC whatever the session's time zone.

    ``typeof`` is a constant of the plan, so only the branch of the column's own
    type is left after optimisation.
    """
    col = _col(c)
    utc_day = F.date_from_unix_date(F.floor(F.unix_micros(col.cast("timestamp")) / F.lit(_DAY_MICROS).cast("decimal(20,0)")).cast("int"))
    return F.when(F.typeof(col) == "timestamp", utc_day).otherwise(F.to_date(col))


def day_diff(end, start) -> Column:
    """Whole days ``end - start`` as an integer (never an interval)."""
    return F.datediff(_col(end), _col(start))


def regex_extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """First match group, NULL when nothing matches (Spark returns '')."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def clean_version(c) -> Column:
    """Keep digits and dots only (all matches replaced)."""
    return F.regexp_replace(_col(c), VERSION_STRIP_PATTERN, "")


def major_minor(c) -> Column:
    """S9 applied to a version string: ``3.11.4`` -> ``3.11``; NULL if absent."""
    return regex_extract_or_null(c, MAJOR_MINOR_PATTERN, 1)


def fingerprint(*parts, sep: str = "-") -> Column:
    """``CONCAT`` with separators; NULL as soon as one part is NULL."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_col(p))
    return F.concat(*cols)


def installer_type(c) -> Column:
    """Searched CASE with a NULL branch and a default."""
    col = _col(c)
    return (F.when(col == F.lit(INSTALLER_STANDARD), F.lit(INSTALLER_LABELS["standard"]))
            .when(col.isin(list(INSTALLER_MIRRORS)), F.lit(INSTALLER_LABELS["mirror"]))
            .when(col.isNull(), F.lit(INSTALLER_LABELS["unknown"]))
            .otherwise(F.lit(INSTALLER_LABELS["other"])))


def is_weekend(ts) -> Column:
    """Saturday or Sunday, in UTC."""
    return F.dayofweek(to_day(ts)).isin(list(WEEKEND_DAYS))


def pct_change(cur, prev, digits: int = 2) -> Column:
    """``round((cur - prev) * 100 / nullif(prev, 0), digits)`` as double."""
    cur_c, prev_c = _col(cur), _col(prev)
    return F.round((cur_c - prev_c).cast("double") * F.lit(100.0)
                   / F.nullif(prev_c, F.lit(0)).cast("double"), digits)


def change(cur, prev, signed: bool = True) -> Column:
    """Signed change (default) or its absolute value."""
    d = _col(cur) - _col(prev)
    return d if signed else F.abs(d)


def to_decimal(c, precision: int = 38, scale: int = 2) -> Column:
    """Cast to a high-precision decimal (Spark's maximum precision is 38)."""
    return _col(c).cast(f"decimal({precision},{scale})")


def default_zero(c, zero=0) -> Column:
    """``COALESCE(c, 0)``."""
    return F.coalesce(_col(c), F.lit(zero))
