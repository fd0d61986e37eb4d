"""Randomised properties: skew-safe operators equal their plain forms."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.checks import model as M
from tessera.checks.run import count_duplicate_rows, run_checks
from tessera.operators.incremental import merge_latest
from tessera.operators.rollups import excess_copies
from tessera.operators.windows import percent_rank_within, topn_per_group

SETTINGS = settings(max_examples=8, deadline=None)
keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
vals = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@SETTINGS
@given(st.lists(st.tuples(keys, vals), min_size=1, max_size=40))
def test_percent_rank_histogram_equals_window(spark, rows):
    df = spark.createDataFrame(rows, "p string, v int")
    a = sorted((tuple(r) for r in percent_rank_within(df, "p", "v", name="r").collect()), key=repr)
    b = sorted((tuple(r) for r in percent_rank_within(df, "p", "v", name="r", method="window").collect()), key=repr)
    assert a == b


@SETTINGS
@given(st.lists(vals, min_size=0, max_size=40))
def test_excess_copies_is_count_minus_distinct(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    nn = [v for v in values if v is not None]
    assert excess_copies(df, "x").first()["failing_rows"] == len(nn) - len(set(nn))


@SETTINGS
@given(st.lists(st.tuples(keys, vals, vals), min_size=0, max_size=30))
def test_duplicate_strategies(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int, c int")
    expected = sum(1 for r in set(rows) if rows.count(r) > 1)
    assert count_duplicate_rows(df, "direct") == expected == count_duplicate_rows(df, "hashed")


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 3)), min_size=1, max_size=30))
def test_topn_brute_force(spark, rows):
    data = [(g, i, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, id int, v int")
    got = sorted((r["g"], r["id"]) for r in topn_per_group(df, ["g"], "v", n=2, tie_breaker="id").collect())
    exp = []
    for g in {d[0] for d in data}:
        members = sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1]))[:2]
        exp += [(g, d[1]) for d in members]
    assert got == sorted(exp)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.booleans()), min_size=1, max_size=30))
def test_merge_latest_brute_force(spark, rows):
    target = [(k, ts, "t") for k, ts, in_target in rows if in_target]
    delta = [(k, ts, "d") for k, ts, in_target in rows if not in_target]
    schema = "k int, ts int, src string"
    out = merge_latest(spark.createDataFrame(target, schema), spark.createDataFrame(delta, schema), ["k"], "ts")
    got = {r["k"]: (r["ts"], r["src"]) for r in out.collect()}
    exp = {}
    for k, ts, src in target + delta:
        cand = (ts, src == "d")
        if k not in exp or cand > (exp[k][0], exp[k][1] == "d"):
            exp[k] = (ts, src)
    assert got == exp


@SETTINGS
@given(st.lists(st.tuples(vals, st.one_of(st.none(), st.sampled_from(["x@y.z", "bad", "q@r"]))),
                min_size=0, max_size=30))
def test_fused_counts_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "total_count int, email string")
    res = {r["name"]: r["failing_rows"] for r in run_checks(
        df, [M.row_count_positive(), M.not_null("email"), M.email_format("email"),
             M.non_negative("total_count")]).collect()}
    assert res["table__row_count_positive"] == (1 if not rows else 0)
    assert res["email__not_null"] == sum(e is None for _, e in rows)
    assert res["email__email_format"] == sum(e in ("bad", "q@r") for _, e in rows)
    assert res["total_count__non_negative"] == 0


@SETTINGS
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(min_value=-50, max_value=50))),
                min_size=1, max_size=60), st.booleans())
def test_percent_rank_split_equals_window(spark, rows, descending):
    df = spark.createDataFrame(rows, "p string, v int")
    a = sorted((tuple(r) for r in percent_rank_within(df, "p", "v", descending=descending, name="r",
                                                      method="split").collect()), key=repr)
    b = sorted((tuple(r) for r in percent_rank_within(df, "p", "v", descending=descending, name="r",
                                                      method="window").collect()), key=repr)
    assert a == b


def test_merge_into_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.operators.incremental import merge_into_partitions

    path = str(tmp_path / "orders_by_bucket")
    base = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 4).alias("bucket"),
                                  F.lit(1).alias("ts"), F.lit("old").alias("v"))
    base.write.partitionBy("bucket").parquet(path)
    delta = spark.createDataFrame([(1, 1, 2, "new"), (5, 1, 0, "stale"), (41, 1, 3, "insert")],
                                  "k long, bucket long, ts int, v string")
    touched = merge_into_partitions(path, delta, ["k"], "ts", "bucket")
    assert [tuple(r) for r in touched.collect()] == [(1,)]
    out = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(out) == 41 and out[1] == "new" and out[5] == "old" and out[41] == "insert"
    assert out[2] == "old" and out[0] == "old"          # untouched partitions keep their rows


def test_merge_loses_no_row_and_no_column(spark, tmp_path):
    """Ties, late rows and unseen keys arrive; columns of the target stay; a NULL partition value is one too."""
    from tessera.operators.incremental import incremental_merge, merge_into_partitions

    target = spark.createDataFrame([(1, 5, "a", "x"), (9, 4, None, "y")], "k int, ts int, p string, x string")
    source = spark.createDataFrame([(2, 5, "a"), (3, 4, "a"), (4, 6, "a"), (1, 5, "a"), (9, 7, None)], "k int, ts int, p string")
    want = [(1, 5, "a", None), (2, 5, "a", None), (3, 4, "a", None), (4, 6, "a", None), (9, 7, None, None)]
    got = incremental_merge(target, source, ["k"], "ts", fill_missing=True)
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(r.k for r in incremental_merge(target, source, ["k"], "ts", since=5, fill_missing=True).collect()) == [1, 2, 4, 9]
    with pytest.raises(ValueError, match="columns differ"):
        incremental_merge(target, source, ["k"], "ts")
    path = str(tmp_path / "t")
    target.write.partitionBy("p").parquet(path)
    merge_into_partitions(path, source.filter("p = 'a'"), ["k"], "ts", "p", fill_missing=True)
    assert sorted((r.k, r.ts, r.p, r.x) for r in spark.read.parquet(path).collect()) == [*want[:4], (9, 4, None, "y")]
    merge_into_partitions(path, source.filter("p is null"), ["k"], "ts", "p", fill_missing=True)
    assert sorted((r.k, r.ts, r.p, r.x) for r in spark.read.parquet(path).collect()) == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 23), st.integers(0, 5)), min_size=1, max_size=40),
       st.integers(1, 4))
def test_period_over_period_brute_force(spark, rows, last_n):
    import datetime as dt

    from tessera.operators.windows import daily_rollup, period_over_period
    from pyspark.sql import functions as F

    base = dt.datetime(2024, 3, 1)
    data = [(i, base + dt.timedelta(days=d, hours=h), g) for i, (d, h, g) in enumerate(rows)]
    df = spark.createDataFrame(data, "number long, timestamp timestamp_ntz, gas_used long")
    daily = daily_rollup(df, "timestamp", {"total_blocks": F.count("number"), "total_gas_used": F.sum("gas_used")})
    got = {r["calendar_day"]: tuple(r) for r in
           period_over_period(daily, ["total_blocks", "total_gas_used"], last_n=last_n).collect()}
    per_day = {}
    for _, ts, g in data:
        c, s = per_day.get(ts.date(), (0, 0))
        per_day[ts.date()] = (c + 1, s + g)
    days = sorted(per_day)

    def pct(cur, prev):
        from decimal import ROUND_HALF_UP, Decimal

        if prev in (None, 0):
            return None
        x = (cur - prev) * 100.0 / prev   # Spark rounds the double's decimal text HALF_UP
        return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))

    exp = {}
    for i, d in enumerate(days):
        if d <= days[-1] - dt.timedelta(days=last_n):
            continue
        (c, s), prev = per_day[d], (per_day[days[i - 1]] if i else (None, None))
        exp[d] = (d, c, s, None if prev[0] is None else c - prev[0], None if prev[1] is None else s - prev[1],
                  pct(c, prev[0]), pct(s, prev[1]))
    assert got == exp
