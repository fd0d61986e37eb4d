"""Registered queries: one per operator / composite of the survey inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
driver's test tables (or views Spark derives from them row by row).  The
matching DuckDB SQL lives in ``tessera.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.checks import model as M
from tessera.checks.report import append_results, export_checks, summarize, summary_by_run
from tessera.checks.rules import LEFT_JOIN_SUFFIX, suggest_checks
from tessera.checks.run import auto_check, run_checks
from tessera.checks.state import recheck
from tessera.functions import predicates as P
from tessera.functions import scalars as S
from tessera.operators import incremental as INC
from tessera.operators import profile as PR
from tessera.operators import rollups as R
from tessera.operators import snapshots as SN
from tessera.operators import windows as W
from tessera.operators.joins import left_join_with_default
from tessera.operators.wide_sum import wide_sum
from tessera.plans import reports as RP
from tessera.sources import derived as D
from tessera.sources.csv import scan_csv, write_csv
from tessera.sources.sinks import materialize, scratch_path, write_table
from tessera.sources.tables import register_views, scan_table

# --- fixed parameters of the registered queries ------------------------------
AS_OF_LINEITEM = "2001-11-05 00:00:00"   # day after the last ship date
AS_OF_EVENTS = "2024-01-30 12:00:00"     # inside the last event day (partial)
DL_START, DL_END, DL_MIN = "1996-01-01", "2002-01-01", 2
USER_ORDER_SQL = """
WITH active AS (SELECT user_id, email, country_code, created_at FROM lj_users WHERE is_active),
stats AS (SELECT user_id, COUNT(order_id) AS orders, SUM(amount) AS spent, MAX(created_at) AS newest, MIN(created_at) AS oldest
          FROM lj_orders GROUP BY user_id)
SELECT a.user_id, a.email, a.country_code, a.created_at AS user_created_at, COALESCE(s.orders, 0) AS total_orders,
       COALESCE(s.spent, 0) AS total_spent, s.newest AS last_order_date, s.oldest AS first_order_date,
       datediff(s.newest, s.oldest) AS order_tenure_days
FROM active a LEFT JOIN stats s ON a.user_id = s.user_id"""
RESULT_COLS = ["position", "name", "column", "test_type", "failing_rows", "passed", "status"]
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark, sf, name):
    return D.table(spark, sf, name)


def _results(df: DataFrame) -> DataFrame:
    return df.select(*RESULT_COLS)


# --- sources -----------------------------------------------------------------
def q_scan_table(spark, sf):
    return scan_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])


CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def q_scan_csv(spark, sf):
    path = write_csv(_t(spark, sf, "customer"), scratch_path(spark, "customer-csv"))
    return scan_csv(spark, path, schema=CUSTOMER_SCHEMA)


def q_register_views(spark, sf):
    register_views(spark, sf)
    return spark.sql("""
        SELECT r.r_name, COUNT(*) AS suppliers, CAST(SUM(s.s_acctbal) AS DECIMAL(18,2)) AS acctbal
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY r.r_name""")


def q_create_table_as_select(spark, sf):
    path = write_table(RP.session_stats(D.sessions_from_events(spark, sf)), scratch_path(spark, "session-stats"))
    return spark.read.parquet(path)


# --- projections / filters / scalars -------------------------------------------
def q_struct_projection(spark, sf):
    p = _t(spark, sf, "part")
    nested = p.select("p_partkey", F.struct(
        F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).alias("info"),
        F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")).alias("dims"),
    ).alias("details"))
    return nested.select("p_partkey", F.col("details.info.brand").alias("brand"),
                         F.col("details.dims.size").alias("size"))


def q_filter_bool(spark, sf):
    return D.users_from_customer(spark, sf).filter(P.is_true("is_active")).select("user_id", "email")


def q_filter_eq(spark, sf):
    return _t(spark, sf, "part").filter(P.equals("p_type", "PROMO")).select("p_partkey", "p_name")


def q_filter_in(spark, sf):
    return (_t(spark, sf, "part")
            .filter(P.in_list("p_type", ["SMALL", "LARGE"]) & P.in_list("p_size", [1, 7], negate=True))
            .select("p_partkey", "p_type", "p_size"))


def q_filter_time_range(spark, sf):
    return (_t(spark, sf, "lineitem").filter(P.month_range("l_shipdate", "1998-01"))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


def q_filter_trailing_days(spark, sf):
    return (_t(spark, sf, "events")
            .filter(P.trailing_days("ts", 7, as_of=AS_OF_EVENTS, exclude_today=True))
            .select("event_id", "ts"))


def q_filter_regex(spark, sf):
    d = D.downloads_from_lineitem(spark, sf).select(F.col("file.project").alias("package_name"))
    return (d.filter(P.not_excluded_project("package_name") & P.regex_contains("package_name", r"^(red|blue)-"))
            .groupBy("package_name").agg(F.count(F.lit(1)).alias("downloads")))


def q_filter_code(spark, sf):
    return D.users_from_customer(spark, sf).filter(P.valid_code("country_code")).select("user_id", "country_code")


def _flat_downloads(spark, sf):
    d = D.downloads_from_lineitem(spark, sf)
    return d.select(F.col("file.version").alias("version_string"), F.col("details.python").alias("python"),
                    F.col("details.installer.name").alias("installer"), "country_code",
                    F.col("details.distro.name").alias("distro_name"),
                    F.col("details.distro.version").alias("distro_version"))


def q_regex_clean(spark, sf):
    return (_flat_downloads(spark, sf).groupBy(S.clean_version("version_string").alias("cleaned_version_num"))
            .agg(F.count(F.lit(1)).alias("downloads")))


def q_regex_extract(spark, sf):
    return (_flat_downloads(spark, sf).groupBy(S.major_minor("python").alias("python_env_version"))
            .agg(F.count(F.lit(1)).alias("downloads")))


def q_fingerprint(spark, sf):
    fp = S.fingerprint("country_code", "distro_name", "distro_version")
    return _flat_downloads(spark, sf).groupBy(fp.alias("environment_fingerprint")).agg(
        F.count(F.lit(1)).alias("downloads"))


def q_case_bucket(spark, sf):
    return (_flat_downloads(spark, sf).groupBy(S.installer_type("installer").alias("installer_type"))
            .agg(F.count(F.lit(1)).alias("downloads")))


# --- aggregates ---------------------------------------------------------------
def q_session_stats(spark, sf):
    return RP.session_stats(D.sessions_from_events(spark, sf))


def q_approx_distinct(spark, sf):
    return R.approx_distinct_with_check(_t(spark, sf, "lineitem"), "l_returnflag", "l_partkey")


def q_weekday_weekend(spark, sf):
    ev = _t(spark, sf, "events")
    agg = ev.groupBy("event_type").agg(*R.weekday_weekend_counts("ts"))
    return agg.filter(F.col("weekday_downloads") > F.col("weekend_downloads"))


def q_prior_period_growth(spark, sf):
    d = D.downloads_from_lineitem(spark, sf)
    window = (d.filter(P.time_range("timestamp", DL_START, DL_END))
              .groupBy(F.col("file.project").alias("package_name"))
              .agg(F.count(F.lit(1)).alias("total_downloads")))
    hist = RP.download_history(d, DL_START)
    j = left_join_with_default(window, hist, "package_name", {"historical_downloads": 0})
    return j.select("package_name", "total_downloads", "historical_downloads",
                    S.pct_change("total_downloads", "_raw_historical_downloads").alias("growth_pct"))


# --- composites ---------------------------------------------------------------
def q_unnest_rollup(spark, sf):
    return RP.withdrawal_rollup(D.blocks_from_lineitem(spark, sf), days=7, as_of=AS_OF_LINEITEM)


def q_unnest_rollup_all(spark, sf):
    return RP.withdrawal_rollup(D.blocks_from_lineitem(spark, sf), days=None)


def q_topn_per_group(spark, sf):
    return RP.top_blocks_per_day(D.blocks_from_events(spark, sf), n=3)


def q_period_over_period(spark, sf):
    return RP.daily_block_change(D.blocks_from_events(spark, sf), days=7, last_n=3, as_of=AS_OF_EVENTS)


def q_period_over_period_abs(spark, sf):
    return RP.daily_block_change(D.blocks_from_events(spark, sf), days=7, last_n=3, as_of=AS_OF_EVENTS,
                                 signed=False)


def q_period_over_period_all(spark, sf):
    """Whole event table per day (no trailing window), last 3 days shown."""
    blocks = D.blocks_from_events(spark, sf)
    daily = W.daily_rollup(blocks, "timestamp", {"total_blocks": F.count("number"),
                                                 "total_gas_used": F.sum("gas_used")})
    return W.period_over_period(daily, ["total_blocks", "total_gas_used"], last_n=3)


def _user_totals(spark, sf):
    return (_t(spark, sf, "events").groupBy("event_type", "user_id")
            .agg(F.count(F.lit(1)).alias("events")))


def q_percent_rank_group(spark, sf):
    totals = materialize(_user_totals(spark, sf), "user-totals")
    return W.percent_rank_within(totals, "event_type", "events", name="pct_rank", method="histogram")


def q_percent_rank_group_split(spark, sf):
    totals = materialize(_user_totals(spark, sf), "user-totals")
    return W.percent_rank_within(totals, "event_type", "events", name="pct_rank", method="split", rows_per_split=200)


def q_percent_rank_group_window(spark, sf):
    return W.percent_rank_within(_user_totals(spark, sf), "event_type", "events", name="pct_rank",
                                 method="window")


def q_top_k(spark, sf):
    o = _t(spark, sf, "orders")
    return W.top_k(o.select("o_orderkey", "o_totalprice"),
                   [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 100)


def q_download_growth_report(spark, sf):
    return RP.download_growth_report(D.downloads_from_lineitem(spark, sf), DL_START, DL_END,
                                     min_downloads=DL_MIN, distinct="exact", limit=1000)


def q_download_growth_report_daily_history(spark, sf):
    """C4 with the history read from a per-(package, day) rollup table.

    The rollup is written partitioned by month under the shared folder (a
    daily job would only rewrite its month), then summed for the days before
    the window."""
    d = D.downloads_from_lineitem(spark, sf)
    daily = RP.package_daily_counts(d).hint("rebalance", "month")
    path = write_table(daily, scratch_path(spark, "package-daily"), partition_by=["month"])
    history = RP.history_from_daily(spark.read.parquet(path), DL_START)
    return RP.download_growth_report(d, DL_START, DL_END, min_downloads=DL_MIN, distinct="exact", limit=1000,
                                     history=history)


def q_user_order_summary(spark, sf):
    return RP.user_order_summary(D.users_from_customer(spark, sf), D.orders_view(spark, sf))


# --- checks -----------------------------------------------------------------
def _sessions(spark, sf):
    return D.sessions_from_events(spark, sf)


def q_check_row_count_positive(spark, sf):
    empty = _t(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("1990-01-01").cast("timestamp_ntz"))
    return _results(run_checks(empty, [M.row_count_positive()]))


def q_check_no_duplicate_rows(spark, sf):
    return _results(run_checks(_t(spark, sf, "lineitem"), [M.no_duplicate_rows()], duplicates="hashed"))


def q_check_duplicate_rows_found(spark, sf):
    """Duplicates that exist, under column names that the check might use itself."""
    rows = _t(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 500).alias("count"), F.col("l_linenumber").alias("_h1"), F.col("l_returnflag").alias("a.b"))
    return _results(run_checks(rows, [M.no_duplicate_rows()]))


def q_check_no_duplicate_keys(spark, sf):
    keys = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return _results(run_checks(keys, [M.no_duplicate_rows()], duplicates="direct"))


def q_check_not_null(spark, sf):
    return _results(run_checks(_sessions(spark, sf), [M.not_null("country_code")]))


def q_check_unique(spark, sf):
    return _results(run_checks(_t(spark, sf, "lineitem"), [M.unique("l_orderkey")]))


def q_check_email_format(spark, sf):
    return _results(run_checks(D.users_from_customer(spark, sf), [M.email_format("email")]))


def q_check_country_code(spark, sf):
    return _results(run_checks(D.users_from_customer(spark, sf), [M.country_code_length("country_code")]))


def q_check_non_negative(spark, sf):
    return _results(run_checks(_sessions(spark, sf), [M.non_negative("duration_seconds")]))


def q_check_left_join_nulls(spark, sf):
    uos = q_user_order_summary(spark, sf)
    checks = [c for c in suggest_checks(uos) if c.name in ("last_order_date__not_null", "first_order_date__not_null")]
    res = run_checks(uos, checks)
    return res.select(*RESULT_COLS, F.col("reason").endswith(LEFT_JOIN_SUFFIX).alias("left_join_warning"))


def q_check_defaulted_skip(spark, sf):
    uos = q_user_order_summary(spark, sf)
    return _results(auto_check(uos)).filter(F.col("column").isin("total_orders", "total_spent"))


def q_run_checks(spark, sf):
    ev = _t(spark, sf, "events")
    checks = [M.row_count_positive(), M.not_null("event_id"), M.non_negative("value"),
              M.accepted_values("event_type", ["click", "view", "purchase", "signup"]),
              M.unique("user_id"), M.non_negative("event_type"), M.not_null("no_such_column")]
    return _results(run_checks(ev, checks))


def q_auto_check(spark, sf):
    return _results(auto_check(q_user_order_summary(spark, sf), persist=True))


def q_dq_user_order_summary(spark, sf):
    return _results(auto_check(q_user_order_summary(spark, sf), skip=["first_order_date__not_null"],
                               persist=True))


def q_dq_session_stats(spark, sf):
    return _results(auto_check(q_session_stats(spark, sf), persist=True))


def q_check_summary(spark, sf):
    return summarize(auto_check(q_user_order_summary(spark, sf), persist=True))


def q_export_checks(spark, sf):
    uos = q_user_order_summary(spark, sf)
    checks = suggest_checks(uos)
    return export_checks(spark, checks, run_checks(uos, checks, persist=True), "user_order_summary", uos)


def q_check_column_pair(spark, sf):
    return _results(run_checks(_t(spark, sf, "lineitem"), [M.column_pair("l_quantity", "l_linenumber")]))


def q_check_accepted_values(spark, sf):
    return _results(run_checks(_t(spark, sf, "events"),
                               [M.accepted_values("event_type", ["click", "view", "purchase", "signup"])]))


def q_check_accepted_values_typed(spark, sf):
    """Dates, decimals, an empty list, NULL in the list, quotes and backslashes."""
    rows = _t(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus",
        F.concat_ws("\\", "o_orderstatus", F.lit("it's")).alias("note"))
    days = [dt.date(1996, 1, 2), dt.date(1997, 7, 7)]
    return _results(run_checks(rows, [
        M.accepted_values("day", days), M.accepted_values("price", [decimal.Decimal("100.50"), decimal.Decimal("99999999999.25")]),
        M.accepted_values("o_orderstatus", []), M.accepted_values("o_orderstatus", ["F", None]),
        M.accepted_values("note", ["F\\it's", "O\\it's"])]))


def q_check_integral(spark, sf):
    return _results(run_checks(_t(spark, sf, "lineitem"), [M.integral("l_quantity"), M.integral("l_tax")]))


# --- extensions -----------------------------------------------------------------
def q_profile_table(spark, sf):
    return PR.profile_table(_t(spark, sf, "orders")).select(
        "position", "column_name", "data_type", "row_count", "null_count", "min_value", "max_value")


def q_grain_candidates(spark, sf):
    return PR.grain_candidates(_t(spark, sf, "lineitem"), [
        ["l_orderkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]])


def q_guess_grain(spark, sf):
    """All columns of lineitem."""
    return PR.guess_grain(_t(spark, sf, "lineitem"), max_width=3).select("candidate", "distinct_keys")


def q_profile_samples(spark, sf):
    return PR.profile_with_samples(_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")).select(
        "column_name", "sample_values")


def q_check_left_join_nulls_sql(spark, sf):
    """C5 as SQL text: which NOT NULL checks carry the left-join warning."""
    D.users_from_customer(spark, sf).createOrReplaceTempView("lj_users")
    D.orders_view(spark, sf).createOrReplaceTempView("lj_orders")
    uos = spark.sql(USER_ORDER_SQL)
    checks = [c for c in suggest_checks(uos) if c.test_type == "not_null"]
    warned = [(c.name, c.reason.endswith(LEFT_JOIN_SUFFIX)) for c in checks]
    told = spark.createDataFrame(warned, "check_name string, left_join_warning boolean")
    res = run_checks(uos, checks)
    return res.join(told, res.name == told.check_name).select("name", "failing_rows", "status", "left_join_warning")


def q_unnest_rollup_wide(spark, sf):
    """C1's sum over amounts of up to 70 digits, both signs, as exact text."""
    li = _t(spark, sf, "lineitem")
    digits = F.concat(F.col("l_partkey").cast("string"), F.lpad(F.col("l_orderkey").cast("string"), 30, "7"),
                      F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("."), F.lpad(F.col("l_suppkey").cast("string"), 35, "3"))).otherwise(F.lit("")))
    amounts = li.select("l_returnflag", F.col("l_linenumber").alias("number"),
                        F.concat(F.when(F.col("l_orderkey") % 3 == 0, "-").otherwise(F.lit("")), digits).alias("amount"))
    return wide_sum(amounts, ["l_returnflag", "number"], "amount", name="w_amounts", extra=[F.count(F.lit(1)).alias("w_records")])


def q_check_unique_many(spark, sf):
    """All uniqueness checks of a table in one pass; none or some repeat."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag",
                                          F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
                                          F.when(F.col("l_linenumber") > 1, F.lit(None)).otherwise(F.col("l_orderkey")).alias("first_id"))
    return _results(run_checks(li, [M.unique(c) for c in li.columns]))


def q_check_few_duplicate_rows(spark, sf):
    """One row in a hundred is there twice."""
    li = _t(spark, sf, "lineitem")
    return _results(run_checks(li.unionByName(li.filter(F.col("l_orderkey") % 100 == 0)), [M.no_duplicate_rows()]))


def q_approx_distinct_rollup(spark, sf):
    """Distinct parts of a window from stored daily sketches, with a tolerance flag."""
    li = _t(spark, sf, "lineitem")
    path = write_table(R.distinct_sketches(li, ["l_returnflag"], "l_shipdate", "l_partkey"), scratch_path(spark, "sketches"))
    est = R.distinct_in_window(spark.read.parquet(path), ["l_returnflag"], DL_START, DL_END)
    exact = li.filter(P.time_range("l_shipdate", DL_START, DL_END)).groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count_distinct("l_partkey").alias("exact_distinct"))
    return est.join(exact, F.col("l_returnflag") == F.col("flag")).select(
        "l_returnflag", "row_count", "exact_distinct", (F.abs(F.col("approx_distinct") - F.col("exact_distinct")) <= 0.1 * F.col("exact_distinct")).alias("within_tolerance"))


def q_download_growth_report_default(spark, sf):
    """C4 as written: approximate distinct releases, groups of over 1000 downloads (packages are part types here)."""
    log = D.downloads_by_type(spark, sf)
    report = RP.download_growth_report(log, DL_START, DL_END)
    near = F.col("unique_sys_releases").between(9, 11)
    return report.withColumn("releases_within_tolerance", near).drop("unique_sys_releases")


def q_check_accepted_from_table(spark, sf):
    """Accepted values from another table: parts that exist, customers of a segment, none at all."""
    _t(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").createOrReplaceTempView("accepted_customers")
    _t(spark, sf, "part").filter("p_partkey % 10 <> 0").createOrReplaceTempView("accepted_parts")
    li = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_partkey", F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"), "l_returnflag")
    return _results(run_checks(li, [M.accepted_from("l_partkey", "accepted_parts", "p_partkey"), M.accepted_from("o_custkey", "accepted_customers", "c_custkey"),
                                    M.accepted_from("l_returnflag", "accepted_customers", "c_mktsegment"), M.accepted_from("l_partkey", "no_such_table")]))


def q_check_changed_partitions(spark, sf):
    """A table checked with kept state, then again: one partition was replaced and one is new, the third is not read again."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    path, state = scratch_path(spark, "checked-table"), scratch_path(spark, "check-state")
    _t(spark, sf, "customer").filter("c_custkey % 7 <> 0").createOrReplaceTempView("accepted_order_customers")
    checks = [M.row_count_positive(), M.no_duplicate_rows(), M.unique("o_orderkey"), M.unique("o_custkey"), M.not_null("o_orderpriority"),
              M.non_negative("o_totalprice"), M.accepted_from("o_custkey", "accepted_order_customers", "c_custkey"), M.non_negative("o_orderpriority")]
    write_table(o.filter("o_orderstatus <> 'P'"), path, partition_by=["o_orderstatus"])
    recheck(spark, path, checks, state)
    bad = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    new = o.filter("o_orderstatus = 'P'").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")))
    write_table(bad.unionByName(bad.filter("o_orderkey % 25 = 0")).unionByName(new), path, partition_by=["o_orderstatus"])
    return _results(recheck(spark, path, checks, state))


def q_summary_by_run(spark, sf):
    """Two runs in one history table, the second of which is repeated."""
    path = scratch_path(spark, "history")
    uos = materialize(q_user_order_summary(spark, sf), "summary")
    for run, source in (("run1", uos), ("run2", uos.filter("email LIKE '%@%.%'")), ("run2", uos.filter("email LIKE '%@%.%'"))):
        append_results(auto_check(source), path, run, "user_order_summary")
    return summary_by_run(spark.read.parquet(path))


def q_incremental_snapshots(spark, sf):
    """Two merges into a versioned table: keys that change their partition, late rows, a repeated delta."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    start = F.lit("1998-01-01").cast("timestamp_ntz")
    path = scratch_path(spark, "snapshots")
    SN.create(o.filter(F.col("o_orderdate") < start), path, ["o_orderkey"], "o_orderdate", "o_orderpriority", slices=16)
    moved = o.filter((F.col("o_orderdate") < start) & (F.col("o_orderkey") % 50 == 0)).select(
        "o_orderkey", F.lit("MOVED").alias("o_orderpriority"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"), "o_totalprice")
    late = o.filter(F.col("o_orderkey") % 70 == 0).withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 9000 DAYS"))
    SN.merge(o.filter(F.col("o_orderdate") >= start).unionByName(moved), path)
    SN.merge(moved.unionByName(late), path)
    return SN.read(spark, path)


def q_percent_rank_text(spark, sf):
    """Percent rank over a text column, range-split."""
    parts = _t(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    return W.percent_rank_within(parts, "p_type", "p_name", descending=False, name="pct_rank", rows_per_split=50)


def _orders_versions(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    target = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    reopened = (o.filter(F.col("o_orderstatus") == "O")
                .select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"), "o_totalprice",
                        (F.col("o_orderdate") + F.expr("INTERVAL 2000 DAYS")).alias("o_orderdate")))
    source = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).unionByName(reopened)
    return target, source


def q_incremental_merge(spark, sf):
    target, source = _orders_versions(spark, sf)
    return INC.incremental_merge(target, source, ["o_orderkey"], "o_orderdate")


def q_incremental_merge_partitions(spark, sf):
    """Rows of two of 16 key buckets: ties, late rows of new keys, outdated versions; the delta lacks a column."""
    o = _t(spark, sf, "orders").withColumn("bucket", (F.col("o_orderkey") % 16).cast("int"))
    start = F.lit("1998-01-01").cast("timestamp_ntz")
    old = F.col("o_orderdate") < start
    path = write_table(o.filter(old).select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "bucket"),
                       scratch_path(spark, "merge-target"), partition_by=["bucket"])
    tie = F.col("o_orderstatus") == "O"
    delta = o.filter(F.col("bucket").isin(3, 7)).select(
        "o_orderkey",
        F.when(~old, F.lit("N")).when(tie, F.lit("T")).otherwise(F.lit("X")).alias("o_orderstatus"),
        F.when(~old, F.col("o_orderdate") - F.expr("INTERVAL 2000 DAYS")).when(tie, F.col("o_orderdate"))
         .otherwise(F.col("o_orderdate") - F.expr("INTERVAL 10 DAYS")).alias("o_orderdate"), "bucket")
    INC.merge_into_partitions(path, delta, ["o_orderkey"], "o_orderdate", "bucket", fill_missing=True)
    return spark.read.parquet(path)


def q_download_growth_report_nested(spark, sf):
    """C4 over a log stored with nested columns, of which the report reads a part."""
    path = write_table(D.downloads_from_lineitem(spark, sf), scratch_path(spark, "downloads"))
    return RP.download_growth_report(spark.read.parquet(path), DL_START, DL_END, min_downloads=DL_MIN,
                                     distinct="exact", limit=1000)


def catalog() -> dict[str, Query]:
    return {
        "scan_table": q_scan_table,
        "scan_csv": q_scan_csv,
        "register_views": q_register_views,
        "create_table_as_select": q_create_table_as_select,
        "struct_projection": q_struct_projection,
        "filter_bool": q_filter_bool,
        "filter_eq": q_filter_eq,
        "filter_in": q_filter_in,
        "filter_time_range": q_filter_time_range,
        "filter_trailing_days": q_filter_trailing_days,
        "filter_regex": q_filter_regex,
        "filter_code": q_filter_code,
        "regex_clean": q_regex_clean,
        "regex_extract": q_regex_extract,
        "fingerprint": q_fingerprint,
        "case_bucket": q_case_bucket,
        "session_stats": q_session_stats,
        "approx_distinct": q_approx_distinct,
        "weekday_weekend": q_weekday_weekend,
        "prior_period_growth": q_prior_period_growth,
        "unnest_rollup": q_unnest_rollup,
        "unnest_rollup_all": q_unnest_rollup_all,
        "topn_per_group": q_topn_per_group,
        "period_over_period": q_period_over_period,
        "period_over_period_abs": q_period_over_period_abs,
        "period_over_period_all": q_period_over_period_all,
        "percent_rank_group": q_percent_rank_group,
        "percent_rank_group_window": q_percent_rank_group_window,
        "percent_rank_group_split": q_percent_rank_group_split,
        "top_k": q_top_k,
        "download_growth_report": q_download_growth_report,
        "download_growth_report_daily_history": q_download_growth_report_daily_history,
        "user_order_summary": q_user_order_summary,
        "check_row_count_positive": q_check_row_count_positive,
        "check_no_duplicate_rows": q_check_no_duplicate_rows,
        "check_duplicate_rows_found": q_check_duplicate_rows_found,
        "check_no_duplicate_keys": q_check_no_duplicate_keys,
        "check_not_null": q_check_not_null,
        "check_unique": q_check_unique,
        "check_email_format": q_check_email_format,
        "check_country_code": q_check_country_code,
        "check_non_negative": q_check_non_negative,
        "check_left_join_nulls": q_check_left_join_nulls,
        "check_defaulted_skip": q_check_defaulted_skip,
        "run_checks": q_run_checks,
        "auto_check": q_auto_check,
        "dq_user_order_summary": q_dq_user_order_summary,
        "dq_session_stats": q_dq_session_stats,
        "check_summary": q_check_summary,
        "export_checks": q_export_checks,
        "check_column_pair": q_check_column_pair,
        "check_accepted_values": q_check_accepted_values,
        "check_accepted_values_typed": q_check_accepted_values_typed,
        "check_integral": q_check_integral,
        "profile_table": q_profile_table,
        "grain_candidates": q_grain_candidates,
        "guess_grain": q_guess_grain,
        "profile_samples": q_profile_samples,
        "incremental_merge": q_incremental_merge,
        "incremental_merge_partitions": q_incremental_merge_partitions,
        "download_growth_report_nested": q_download_growth_report_nested,
        "check_left_join_nulls_sql": q_check_left_join_nulls_sql,
        "unnest_rollup_wide": q_unnest_rollup_wide,
        "check_unique_many": q_check_unique_many,
        "check_few_duplicate_rows": q_check_few_duplicate_rows,
        "approx_distinct_rollup": q_approx_distinct_rollup,
        "download_growth_report_default": q_download_growth_report_default,
        "check_accepted_from_table": q_check_accepted_from_table,
        "check_changed_partitions": q_check_changed_partitions,
        "summary_by_run": q_summary_by_run,
        "incremental_snapshots": q_incremental_snapshots,
        "percent_rank_text": q_percent_rank_text,
    }
