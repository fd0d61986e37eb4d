"""Plan assertions: pushdown, pruning, top-k shapes, one scan for fused checks."""

from pyspark.sql import functions as F

from tessera.checks import model as M
from tessera.checks.run import fused_aggregate
from tessera.functions import predicates as P
from tessera.plans import catalog as C
from tessera.plans import reports as RP
from tessera.sources import derived as D

from conftest import SF_MID, SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_range_pushes_both_bounds(spark):
    df = D.table(spark, SF_MID, "lineitem").filter(P.month_range("l_shipdate", "1998-01")).select("l_orderkey")
    p = plan(df)
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_cast_like_is_not_pushed(spark):
    # The flawed form keeps the LIKE as a residual filter on every row.
    df = D.table(spark, SF_MID, "lineitem").filter(F.col("l_shipdate").cast("string").like("1998-01-%"))
    assert "GreaterThanOrEqual(l_shipdate" not in plan(df)


def test_topn_uses_partial_window_group_limit(spark):
    p = plan(C.q_topn_per_group(spark, SF_MID))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(C.q_top_k(spark, SF_MID))
    assert "TakeOrderedAndProject" in plan(C.q_download_growth_report(spark, SF_MID))


def test_fused_checks_scan_once(spark):
    df = D.table(spark, SF_MID, "events")
    checks = [M.not_null("event_id"), M.non_negative("value"), M.not_null("user_id"),
              M.accepted_values("event_type", ["click"]), M.row_count_positive()]
    p = plan(fused_aggregate(df, list(enumerate(checks))))
    assert p.count("FileScan") == 1 or p.count("Scan parquet") == 1


def test_unique_pass_reads_one_column(spark):
    from tessera.operators.rollups import excess_copies

    p = plan(excess_copies(D.table(spark, SF_MID, "lineitem"), "l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in p
    assert "partial_count" in p or "HashAggregate" in p


def test_unnest_rollup_partial_aggregate_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "blocks")
    D.blocks_from_lineitem(spark, "/root/testdata/sf0.001").write.parquet(path)
    df = RP.withdrawal_rollup(spark.read.parquet(path), days=7, as_of=C.AS_OF_LINEITEM)
    p = plan(df)
    assert "partial_count" in p
    assert "GreaterThanOrEqual(timestamp" in p
    # nested schema pruning: only the amount leaf of the array is read
    assert "withdrawals:array<struct<amount:string>>" in p


def test_period_over_period_window_after_aggregate(spark):
    p = plan(C.q_period_over_period(spark, SF_MID))
    # the un-partitioned window sits above the per-day aggregate
    assert p.index("Window") < p.index("HashAggregate")


def test_report_prunes_and_filters_nested_columns(spark, tmp_path):
    """C4 over nested parquet: the history reads one leaf, the window's nested filter reaches the scan."""
    from tessera.plans.reports import clean_downloads, download_history
    from tessera.sources.derived import downloads_from_lineitem

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "downloads")
    downloads_from_lineitem(spark, SF_SMALL).write.parquet(path)
    downloads = spark.read.parquet(path)
    history = download_history(downloads, "1996-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<timestamp:timestamp_ntz,file:struct<project:string>>" in history
    window = clean_downloads(downloads, "1996-01-01", "2002-01-01")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(details.system.name,Linux)" in window and "GreaterThanOrEqual(timestamp," in window


def test_every_filter_of_the_report_removes_rows(spark):
    from pyspark.sql import functions as F

    from tessera.functions import predicates as P
    from tessera.plans.reports import REPORT_DISTROS, aggregate_downloads, clean_downloads
    from tessera.sources.derived import downloads_from_lineitem

    d = downloads_from_lineitem(spark, SF_SMALL)
    n = d.count()
    for keep in (P.not_excluded_project("file.project"), P.valid_code("country_code"), F.col("details.distro.name").isin(list(REPORT_DISTROS)),
                 F.col("details.system.name") == "Linux"):
        assert 0 < d.filter(keep).count() < n
    cleaned = clean_downloads(d, "1996-01-01", "2002-01-01")
    groups = cleaned.select(*[c for c in cleaned.columns if c not in ("timestamp", "sys_release")]).distinct().count()
    assert 0 < aggregate_downloads(cleaned, min_downloads=0).count() < groups
