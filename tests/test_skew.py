"""One key holding a third of all rows: results stay exact and whole, and the
plans combine map-side before any shuffle of the hot key."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.checks import model as M
from tessera.checks.run import count_duplicate_rows, run_checks
from tessera.operators.incremental import merge_latest
from tessera.operators.rollups import excess_copies, unnest_rollup
from tessera.operators.windows import percent_rank_within, topn_per_group

N = 3000


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("id"),
        (F.col("id") % 7).alias("v"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 3 + 1).cast("int"),
                             F.lit(0), F.lit(0), F.lit(0)).alias("ts"))
    return df.repartition(6)


def test_unique_on_hot_key(spark, skewed):
    rows = skewed.select("k").collect()
    ks = [r[0] for r in rows]
    assert excess_copies(skewed, "k").first()[0] == len(ks) - len(set(ks))
    p = plan(excess_copies(skewed, "k"))
    assert p.index("partial_count") > p.index("Exchange hashpartitioning")  # partial sits below the shuffle


def test_duplicates_with_hot_copy(spark, skewed):
    hot = skewed.select("k").withColumn("c", F.lit("x"))   # one value repeated N/3 times
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        rows = [tuple(r) for r in hot.collect()]
        expected = sum(1 for r in set(rows) if rows.count(r) > 1)
        assert count_duplicate_rows(hot, "hashed") == expected == count_duplicate_rows(hot, "direct")
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_rollup_hot_block(spark, skewed):
    arr = skewed.select("k", F.array(F.struct(F.col("v").cast("string").alias("amount")),
                                     F.struct(F.lit("1").alias("amount"))).alias("w"))
    out = {r["k"]: (r["w_records"], r["w_amounts"]) for r in unnest_rollup(arr, "k", "w", "amount", 1).collect()}
    hot_rows = [r for r in skewed.collect() if r["k"] == 0]
    assert out[0][0] == 2 * len(hot_rows)
    assert int(out[0][1]) == sum(r["v"] for r in hot_rows) + len(hot_rows)
    assert "partial_count" in plan(unnest_rollup(arr, "k", "w", "amount", 1))


def test_topn_hot_group_limited_before_shuffle(spark, skewed):
    day = skewed.select(F.to_date("ts").alias("d"), "id", "v")
    out = topn_per_group(day, ["d"], "v", n=3, tie_breaker="id")
    assert out.count() == 9
    p = plan(out)
    assert "Partial" in p and p.index("Partial") > p.index("Exchange")


def test_percent_rank_hot_partition(spark, skewed):
    a = sorted((tuple(r) for r in percent_rank_within(skewed.select("k", "v"), "k", "v", name="r").collect()),
               key=repr)
    b = sorted((tuple(r) for r in percent_rank_within(skewed.select("k", "v"), "k", "v", name="r",
                                                      method="window").collect()), key=repr)
    assert a == b and len(a) == N


def test_merge_latest_hot_key(spark, skewed):
    target = skewed.select("k", "ts", F.col("id").alias("payload"))
    delta = target.filter(F.col("k") == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    out = merge_latest(target, delta, ["k"], "ts")
    assert out.count() == skewed.select("k").distinct().count()
    hot = out.filter("k = 0").first()
    assert hot["ts"] == dt.datetime(2024, 1, 2)  # hot rows sit on Jan 1; the delta moved them a day
    p = plan(out)
    assert "partial_max_by" in p or "max_by" in p


def test_fused_checks_on_skew(spark, skewed):
    res = {r["name"]: r["failing_rows"] for r in run_checks(
        skewed, [M.non_negative("v"), M.unique("k"), M.not_null("k")]).collect()}
    assert res["k__not_null"] == 0 and res["v__non_negative"] == 0
    assert res["k__unique"] == N - skewed.select("k").distinct().count()


def test_percent_rank_split_hot_partition_many_values(spark, skewed):
    df = skewed.select("k", F.col("id").alias("v"))          # hot key 0 has N/3 distinct values
    a = sorted((tuple(r) for r in percent_rank_within(df, "k", "v", name="r", method="split").collect()), key=repr)
    b = sorted((tuple(r) for r in percent_rank_within(df, "k", "v", name="r", method="window").collect()), key=repr)
    assert a == b
    p = plan(percent_rank_within(df, "k", "v", name="r", method="split"))
    assert "percentile_approx" in p


def test_percent_rank_window_sorts_no_whole_partition(spark, skewed):
    df = skewed.selectExpr("k", "if(id % 11 = 0, null, id % 997) AS v", "cast(id % 53 AS string) AS s")
    for order, kind in (("v", "percentile_approx"), ("s", "sum(_c")):
        for descending in (True, False):
            by = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
            want = df.withColumn("r", F.percent_rank().over(Window.partitionBy("k").orderBy(by)))
            got = percent_rank_within(df, "k", order, descending, name="r", method="window")
            assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert "percent_rank(" not in plan(got) and kind in plan(got)
