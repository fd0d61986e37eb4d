"""Composite reports (C1-C6), one function per stage, ``DataFrame -> DataFrame``.

Plan notes for scale (checked with ``explain("formatted")``):

* C1 explodes after the time filter, which reaches the parquet scan; the
  group-by is partially aggregated, so a block with a huge array costs one
  partial row per task.
* C2 is planned as a partial ``WindowGroupLimit`` before the shuffle: at most
  ``n`` rows per day leave each map task.
* C3 aggregates per day first; the un-partitioned ``lag`` then sees one row per
  day (bounded by the calendar, not by the data).
* C4 scans the log twice with pushed filters (window and history), joins the
  per-package history (AQE broadcasts it only when its runtime size is small),
  ranks with the skew-safe histogram percent rank, and ends in a
  ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.functions import scalars as S
from tessera.operators import rollups as R
from tessera.operators import windows as W
from tessera.operators.joins import left_join_tagged
from tessera.sources.sinks import materialize

# --- fixed values -----------------------------------------------------------
# Operating system and distributions kept by the download report.
REPORT_SYSTEM = "Linux"
REPORT_DISTROS = ("Ubuntu", "Debian", "CentOS", "Fedora")
# Output columns of the download report, in order.
DOWNLOAD_REPORT_COLUMNS = [
    "package_name", "version_string", "historical_downloads", "growth_pct",
    "cleaned_version_num", "python_env_version", "regional_rank", "weekend_downloads",
    "weekday_downloads", "installer_type", "environment_fingerprint", "latest_download",
    "earliest_download_in_window", "unique_sys_releases"]
# ---------------------------------------------------------------------------


# C1 -------------------------------------------------------------------------
def withdrawal_rollup(blocks: DataFrame, days: int | None = 7, as_of=None, min_count: int = 5,
                      scale: int = 2) -> DataFrame:
    """Per block of the last ``days`` days: withdrawal count and decimal sum,
    blocks with at least ``min_count`` withdrawals.  ``days=None`` scans all."""
    scoped = blocks if days is None else blocks.filter(P.trailing_days("timestamp", days, as_of=as_of))
    return R.unnest_rollup(scoped, "number", "withdrawals", "amount", min_count=min_count, scale=scale)


# C2 -------------------------------------------------------------------------
def top_blocks_per_day(blocks: DataFrame, n: int = 3, days: int | None = None, as_of=None) -> DataFrame:
    """Top ``n`` blocks by gas used per calendar day (row_number: exactly n).

    ``days`` optionally bounds the scan to a trailing window (the reference's
    own production note); ``None`` ranks every day of the table.
    """
    scoped = blocks if days is None else blocks.filter(P.trailing_days("timestamp", days, as_of=as_of))
    pop = scoped.select(S.to_day("timestamp").alias("calendar_day"), "number", "gas_used")
    return W.topn_per_group(pop, ["calendar_day"], "gas_used", n=n, tie_breaker="number")


# C3 -------------------------------------------------------------------------
def daily_block_change(blocks: DataFrame, days: int = 7, last_n: int = 3, as_of=None,
                       exclude_today: bool = True, signed: bool = True) -> DataFrame:
    """Day-over-day change of block count and gas over the last available days."""
    metrics = {"total_blocks": F.count("number"), "total_gas_used": F.sum("gas_used")}
    return W.trailing_period_over_period(blocks, "timestamp", metrics, days=days, last_n=last_n,
                                         as_of=as_of, exclude_today=exclude_today, signed=signed)


# C4 -------------------------------------------------------------------------
def clean_downloads(downloads: DataFrame, start, end) -> DataFrame:
    """Stage 1: filtered, flattened and cleaned download rows of the window."""
    keep = P.all_of(
        P.time_range("timestamp", start, end),
        P.equals("details.system.name", REPORT_SYSTEM),
        P.in_list("details.distro.name", REPORT_DISTROS),
        P.not_excluded_project("file.project"),
        P.valid_code("country_code"))
    return downloads.filter(keep).select(
        F.col("file.project").alias("package_name"),
        F.col("file.version").alias("version_string"),
        F.col("country_code"),
        F.col("timestamp"),
        F.col("details.system.release").alias("sys_release"),
        S.clean_version("file.version").alias("cleaned_version_num"),
        S.major_minor("details.python").alias("python_env_version"),
        S.installer_type("details.installer.name").alias("installer_type"),
        S.fingerprint("country_code", "details.distro.name", "details.distro.version")
        .alias("environment_fingerprint"))


def download_history(downloads: DataFrame, before) -> DataFrame:
    """Stage 2: all earlier downloads per package (no other filter)."""
    return R.prior_period_counts(downloads.select(F.col("file.project").alias("package_name"), "timestamp"),
                                 "package_name", "timestamp", before)


def package_daily_counts(downloads: DataFrame, start=None, end=None) -> DataFrame:
    """Downloads per (package, day): the incremental form of the history.

    Carries a ``month`` column for the table layout: written with
    ``write_table(df.hint("rebalance", "month"), path, partition_by=["month"])``
    (dynamic overwrite), a daily job rewrites only the current month and each
    month is one file set, while the report's history becomes a scan of this
    small table instead of years of raw log.
    """
    return (downloads.filter(P.time_range("timestamp", start, end))
            .groupBy(F.col("file.project").alias("package_name"), S.to_day("timestamp").alias("day"))
            .agg(F.count(F.lit(1)).alias("downloads"))
            .withColumn("month", F.trunc("day", "MM")))


def history_from_daily(daily: DataFrame, before) -> DataFrame:
    """Stage 2 from the daily rollup: downloads per package before ``before``."""
    before_day = F.to_date(P._ts_lit(before))
    return (daily.filter(F.col("day") < before_day).groupBy("package_name")
            .agg(F.sum("downloads").cast("bigint").alias("historical_downloads")))


GROUP_KEYS = ["package_name", "version_string", "country_code", "cleaned_version_num",
              "python_env_version", "installer_type", "environment_fingerprint"]


def aggregate_downloads(cleaned: DataFrame, min_downloads: int = 1000, distinct: str = "approx") -> DataFrame:
    """Stage 3: per 7-column group, weekday/weekend split, HAVING."""
    release = (F.approx_count_distinct("sys_release") if distinct == "approx"
               else F.count_distinct("sys_release"))
    agg = cleaned.groupBy(*GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("total_downloads"),
        *R.weekday_weekend_counts("timestamp"),
        F.max("timestamp").alias("latest_download"),
        F.min("timestamp").alias("earliest_download_in_window"),
        release.alias("unique_sys_releases"))
    return agg.filter((F.col("total_downloads") > min_downloads)
                      & (F.col("weekday_downloads") > F.col("weekend_downloads")))


def download_growth_report(downloads: DataFrame, start, end, history_before=None,
                           min_downloads: int = 1000, distinct: str = "approx", limit: int | None = 1000,
                           rank_method: str = "histogram", materialize_groups: bool = True,
                           history: DataFrame | None = None) -> DataFrame:
    """C4 end to end.

    With ``materialize_groups`` (default) the post-HAVING groups are written
    once to the shared checkpoint folder: the skew-safe rank reads them twice
    (histogram and join back), and without the write Spark would recompute
    the scan, join and aggregate for each branch.  The write is also a lineage
    cut, so a lost executor does not send the report back to the raw log.
    ``history`` replaces the scan of all earlier raw rows with a prepared
    ``(package_name, historical_downloads)`` table, e.g.
    ``history_from_daily(package_daily_counts_table, start)``.
    """
    history_before = start if history_before is None else history_before
    aggregated = aggregate_downloads(clean_downloads(downloads, start, end), min_downloads, distinct)
    if history is None:
        history = download_history(downloads, history_before)
    agg_prev = (aggregated.join(history, "package_name", "left")
                .withColumn("growth_pct", S.pct_change("total_downloads", "historical_downloads"))
                .withColumn("historical_downloads", S.default_zero("historical_downloads")))
    if materialize_groups and rank_method in ("histogram", "split"):
        agg_prev = materialize(agg_prev, "download-groups")
    ranked = W.percent_rank_within(agg_prev, "country_code", "total_downloads", descending=True,
                                   name="regional_rank", method=rank_method)
    out = ranked.select(*DOWNLOAD_REPORT_COLUMNS)
    # Remaining output columns are appended so that the cut at ``limit`` is
    # deterministic among rows that tie on the three report keys.
    order = [F.col("regional_rank").asc_nulls_first(), F.col("growth_pct").desc_nulls_last(),
             F.col("package_name").asc_nulls_first()]
    order += [F.col(c).asc_nulls_first() for c in DOWNLOAD_REPORT_COLUMNS
              if c not in ("regional_rank", "growth_pct", "package_name")]
    return W.top_k(out, order, limit) if limit is not None else out.orderBy(*order)


# C5 -------------------------------------------------------------------------
def user_order_summary(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Active users left-joined to their order statistics."""
    active = users.filter(P.is_true("is_active")).select("user_id", "email", "country_code", "created_at")
    stats = orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("amount").alias("total_spent"),
        F.max("created_at").alias("last_order_date"),
        F.min("created_at").alias("first_order_date"))
    joined = left_join_tagged(active, stats, "user_id")
    return joined.select(
        "user_id", "email", "country_code",
        F.col("created_at").alias("user_created_at"),
        S.default_zero("total_orders", 0).alias("total_orders"),
        # an integer zero keeps the sum's own type (decimal stays decimal)
        S.default_zero("total_spent", 0).alias("total_spent"),
        "last_order_date", "first_order_date",
        S.day_diff("last_order_date", "first_order_date").alias("order_tenure_days"))


# C6 -------------------------------------------------------------------------
def session_stats(sessions: DataFrame, key: str = "country_code") -> DataFrame:
    """Per country: sessions, total/avg duration, distinct users, last start."""
    specs: dict[str, Column] = {
        "total_sessions": F.count("session_id"),
        "total_duration_seconds": F.sum("duration_seconds"),
        "avg_duration_seconds": F.avg("duration_seconds"),
        "unique_users": F.count_distinct("user_id"),
        "last_session_date": F.max("started_at"),
    }
    return R.grouped_stats(sessions, [key], specs)
