"""Suspects only, stacked uniqueness, reference values, sketches, sample splitters, SQL left joins."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.checks import model as M
from tessera.checks.report import check_sql, export_checks, rerun_exported
from tessera.checks.rules import LEFT_JOIN_SUFFIX, suggest_checks
from tessera.checks.run import count_duplicate_rows, run_checks
from tessera.operators import duplicates as DU
from tessera.operators import rollups as R
from tessera.operators import windows as W
from tessera.operators.joins import nullable_side_columns


def test_only_suspects_travel(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(50_000).selectExpr("id % 49500 AS id", "'some text' AS t", "CAST(id % 49500 AS double) AS d")
        assert DU.suspect_rows(rows).count() < 1500  # 1000 of them repeat
        assert count_duplicate_rows(rows) == 500
        assert DU.suspect_rows(rows.filter("id >= 500")) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clashing_hashes_are_told_apart(spark, monkeypatch):
    """A filter that lets everything through changes no count."""
    monkeypatch.setattr(DU, "BUCKETS", 1)
    monkeypatch.setattr(DU, "BITS", 8)
    df = spark.createDataFrame([(i, i // 2, None if i % 5 else i) for i in range(60)], "a int, b int, c int")
    assert DU.excess_copies_of(df, ["a", "b", "c"]) == {"a": 0, "b": 30, "c": 0}
    assert count_duplicate_rows(df.unionByName(df.filter("a < 7"))) == 7


def test_all_types_of_values(spark):
    rows = [(0.0, b"a", dt.datetime(2024, 1, 1), decimal.Decimal("1.50"), True, ""), (-0.0, b"a", dt.datetime(2024, 1, 1), decimal.Decimal("1.5"), None, None),
            (float("nan"), None, None, None, None, ""), (float("nan"), b"", dt.datetime(2024, 1, 2), None, False, " ")]
    df = spark.createDataFrame(rows, "d double, b binary, t timestamp, m decimal(9,2), f boolean, s string")
    assert DU.excess_copies_of(df, df.columns) == {"d": 2, "b": 1, "t": 1, "m": 1, "f": 0, "s": 1}
    got = {r.name: r.failing_rows for r in run_checks(df, [M.unique(c) for c in df.columns] + [M.unique("nowhere")]).collect()}
    assert got == {"d__unique": 2, "b__unique": 1, "t__unique": 1, "m__unique": 1, "f__unique": 0, "s__unique": 1, "nowhere__unique": None}
    assert DU.excess_copies_of(df.limit(0), df.columns) == dict.fromkeys(df.columns, 0)


def test_narrow_columns_are_settled_by_their_hashes(spark, monkeypatch):
    """every value whose hash repeats went through a second pass as text."""
    df = spark.range(3000).selectExpr("id % 700 AS i", "CAST(id % 11 AS double) / 3 AS d", "timestamp_micros(id % 900) AS t", "CAST(id % 13 AS decimal(9,2)) AS m",
                                      "CAST(id % 17 AS decimal(30,2)) AS wide", "id % 2 = 0 AS f", "concat('s', id % 2500) AS s", "concat('u', id) AS u", "if(id % 3 = 0, id, NULL) AS n")
    want = {c: r for c, r in df.agg(*[(F.count(c) - F.count_distinct(c)).alias(c) for c in df.columns]).first().asDict().items()}
    again = []
    real = DU.stacked_values
    monkeypatch.setattr(DU, "stacked_values", lambda d, c: again.append(list(c)) or real(d, c))
    assert DU.excess_copies_of(df, df.columns) == want
    assert again == [["wide", "s"]]
    monkeypatch.setattr(DU, "BUCKETS", 1)
    monkeypatch.setattr(DU, "BITS", 8)
    assert DU.excess_copies_of(df, df.columns) == want  # no filter: too many repeat


def test_ten_columns_one_scan(spark):
    path_rows = spark.range(1000).selectExpr(*[f"id + {i} AS c{i}" for i in range(10)])
    stacked = DU.stacked_values(path_rows, path_rows.columns)
    plan = stacked.select(F.xxhash64("c", "t").alias("h")).groupBy("h").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1


def test_accepted_from_a_large_table_and_a_hot_value(spark):
    spark.range(1_000_000).selectExpr("id * 2 AS known").createOrReplaceTempView("known_ids")
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 7, id * 2) AS v", "CAST(NULL AS bigint) AS w").unionAll(spark.sql("SELECT 2000001, NULL"))
    df.createOrReplaceTempView("with_ids")
    checks = [M.accepted_from("v", "known_ids", "known"), M.accepted_from("w", "known_ids", "known")]
    got = run_checks(df, checks).collect()
    assert [(r.failing_rows, r.status) for r in got] == [(30_001, "FAIL"), (0, "PASS")]
    exported = export_checks(spark, checks, None, "with_ids", df)
    assert [r.failing_rows for r in rerun_exported(spark, exported).orderBy("position").collect()] == [30_001, 0]
    assert "ANTI JOIN" in check_sql(checks[0], "with_ids")


@pytest.mark.parametrize("descending", [True, False])
def test_percent_rank_of_any_type(spark, descending):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else rng.choice("abc"), rng.choice((None, "", f"v{rng.randrange(700)}")), rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "p string, v string, n int")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.select("p", "v", F.percent_rank().over(Window.partitionBy("p").orderBy(order)).alias("r"))
    for method in ("split", "window"):
        got = W.percent_rank_within(df.select("p", "v"), "p", "v", descending, name="r", method=method, rows_per_split=20)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sketches_of_days_merge(spark):
    df = spark.range(20_000).selectExpr("id % 2 AS k", "timestampadd(HOUR, CAST(id % 240 AS int), timestamp_ntz'2024-01-01') AS ts", "if(id % 11 = 0, NULL, id % 3000) AS v")
    rollup = R.distinct_sketches(df, ["k"], "ts", "v")
    assert rollup.count() == 20
    for start, end in ((None, None), ("2024-01-03", "2024-01-05")):
        scoped = df if start is None else df.filter(f"ts >= '{start}' AND ts < '{end}'")
        exact = {r.k: (r.n, r.d) for r in scoped.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d")).collect()}
        for r in R.distinct_in_window(rollup, ["k"], start, end).collect():
            assert r.row_count == exact[r.k][0] and abs(r.approx_distinct - exact[r.k][1]) <= 0.06 * exact[r.k][1]


def test_left_joins_of_sql_text(spark):
    spark.sql("SELECT id AS user_id, 'a@b.c' AS email, current_date() AS start_date FROM range(3)").createOrReplaceTempView("u")
    spark.sql("SELECT id AS user_id, current_date() AS order_date FROM range(2)").createOrReplaceTempView("o")
    cases = {
        "SELECT u.email, o.order_date FROM u LEFT JOIN o ON u.user_id = o.user_id": {"order_date"},
        "SELECT u.email, o.order_date FROM o RIGHT JOIN u USING (user_id) WHERE u.email > ''": {"order_date"},
        "SELECT u.email, o.order_date FROM o FULL JOIN u ON o.user_id = u.user_id": {"email", "order_date"},
        "SELECT u.email, o.order_date FROM u JOIN o USING (user_id)": set(),
        "SELECT max(order_date) AS last_date FROM o GROUP BY user_id": set(),
        "SELECT coalesce(o.order_date, u.start_date) AS order_date, o.order_date AS raw_date FROM u LEFT JOIN o USING (user_id)": {"raw_date"},
        "WITH s AS (SELECT user_id, max(order_date) AS d FROM o GROUP BY user_id), j AS (SELECT u.email, s.d AS last_date FROM u LEFT JOIN s USING (user_id)) "
        "SELECT a.email, a.last_date AS x_date, b.last_date AS y_date FROM j a JOIN j b ON a.email = b.email ORDER BY 1 LIMIT 5": {"x_date", "y_date"},
        "SELECT order_date FROM (SELECT o.order_date FROM u LEFT JOIN o USING (user_id)) UNION ALL SELECT order_date FROM o": {"order_date"},
        "SELECT o.order_date, count(*) AS n FROM u LEFT JOIN o USING (user_id) GROUP BY o.order_date": {"order_date"},
    }
    for sql, want in cases.items():
        assert nullable_side_columns(spark.sql(sql)) == want, sql
    checks = suggest_checks(spark.sql("SELECT u.user_id, u.start_date, o.order_date FROM u LEFT JOIN o USING (user_id)"))
    warned = {c.name for c in checks if c.reason.endswith(LEFT_JOIN_SUFFIX)}
    assert warned == {"order_date__not_null"}
    frame = spark.table("u").join(spark.table("o"), "user_id", "left")
    assert nullable_side_columns(frame) == {"order_date"}


def test_row_number_and_previous_columns_do_not_replace_the_users(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "g int, v int, rn string")
    got = W.topn_per_group(df, ["g"], "v", n=1)
    assert got.columns == ["g", "v", "rn", "rn1"] and {r.rn for r in got.collect()} == {"b", "c"}
