"""Edge rows of the check semantics (FIXTURES.md section 3) and fusion properties."""

import hashlib
import random

import pytest

from tessera.checks import model as M
from tessera.checks.report import check_sql, export_checks, rerun_exported
from tessera.checks.run import auto_check, count_duplicate_rows, run_checks


def _counts(results):
    return {r["name"]: (r["failing_rows"], r["status"]) for r in results.collect()}


def test_copies_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (2, None)],
        "item_id bigint, label string")
    res = _counts(run_checks(df, [M.no_duplicate_rows(), M.unique("item_id"), M.not_null("item_id")]))
    # three copies of (1,'a') count once; (NULL,'b') and (2,NULL) repeat as well
    assert res["table__no_duplicate_rows"] == (3, "FAIL")
    # COUNT(c) - COUNT(DISTINCT c): 5 non-null values, 2 distinct -> 3; NULLs ignored
    assert res["item_id__unique"] == (3, "FAIL")
    assert res["item_id__not_null"] == (2, "FAIL")


def test_three_copies_duplicates_one_unique_two(spark):
    df = spark.createDataFrame([(7, "x")] * 3 + [(8, "y")], "user_id bigint, v string")
    res = _counts(run_checks(df, [M.no_duplicate_rows(), M.unique("user_id")]))
    assert res["table__no_duplicate_rows"][0] == 1
    assert res["user_id__unique"][0] == 2


def test_two_null_ids(spark):
    df = spark.createDataFrame([(None,), (None,), (3,)], "user_id bigint")
    res = _counts(run_checks(df, [M.unique("user_id"), M.not_null("user_id")]))
    assert res["user_id__unique"][0] == 0
    assert res["user_id__not_null"][0] == 2


def test_format_and_range_ignore_null(spark):
    df = spark.createDataFrame([(None, None, None), ("a@b", "USA", -1.0), ("x@y.z", "US", 0.0)],
                               "email string, country_code string, total_amount double")
    res = _counts(run_checks(df, [M.email_format("email"), M.country_code_length("country_code"),
                                  M.non_negative("total_amount")]))
    assert res["email__email_format"][0] == 1
    assert res["country_code__country_code_length"][0] == 1
    assert res["total_amount__non_negative"][0] == 1


def test_empty_input(spark):
    df = spark.createDataFrame([], "user_id bigint, email string, total_count bigint")
    res = _counts(auto_check(df))
    assert res.pop("table__row_count_positive") == (1, "FAIL")
    assert all(v == (0, "PASS") for v in res.values()), res


def test_error_isolated(spark):
    df = spark.createDataFrame([("a", 1), ("b", -2)], "total_label string, total_count bigint")
    res = _counts(auto_check(df))
    assert res["total_label__non_negative"][1] == "ERROR"
    assert res["total_label__non_negative"][0] is None
    assert res["total_count__non_negative"] == (1, "FAIL")
    assert res["table__row_count_positive"] == (0, "PASS")


def test_unknown_column_is_error(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    res = run_checks(df, [M.not_null("missing"), M.not_null("a")]).orderBy("position").collect()
    assert res[0]["status"] == "ERROR" and "missing" in res[0]["error"]
    assert res[1]["status"] == "PASS"


def test_runtime_failure_isolated(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    df = spark.createDataFrame([("1",), ("x",)], "code string")
    bad = M.Check("code__as_int", "code", "range", "cast", condition="CAST(code AS INT) < 0", columns=("code",))
    res = run_checks(df, [bad, M.not_null("code")]).orderBy("position").collect()
    assert res[0]["status"] == "ERROR"
    assert res[1]["status"] == "PASS"


def test_extension_checks(spark):
    df = spark.createDataFrame([(5, 3, "US", 2.0), (1, 3, "ZZ", 2.5), (None, 1, None, None)],
                               "hi int, lo int, country string, num_items double")
    res = _counts(run_checks(df, [M.column_pair("hi", "lo"), M.accepted_values("country", ["US", "GB"]),
                                  M.integral("num_items")]))
    assert res["hi__gte__lo"][0] == 1
    assert res["country__accepted_values"][0] == 1
    assert res["num_items__integral"][0] == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fused_equals_single(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a@b.c", "bad", ""]), rnd.choice([None, -1, 0, 4]))
            for _ in range(60)]
    df = spark.createDataFrame(rows, "user_id int, email string, total_count int")
    checks = [M.row_count_positive(), M.no_duplicate_rows(), M.not_null("user_id"), M.unique("user_id"),
              M.email_format("email"), M.non_negative("total_count")]
    fused = _counts(run_checks(df, checks))
    for c in checks:
        assert _counts(run_checks(df, [c]))[c.name] == fused[c.name]
    # brute force
    assert fused["user_id__not_null"][0] == sum(r[0] is None for r in rows)
    nn = [r[0] for r in rows if r[0] is not None]
    assert fused["user_id__unique"][0] == len(nn) - len(set(nn))
    assert fused["email__email_format"][0] == sum(
        1 for r in rows if r[1] is not None and not ("@" in r[1] and "." in r[1].split("@", 1)[1]))
    assert fused["table__no_duplicate_rows"][0] == sum(1 for v in set(rows) if rows.count(v) > 1)


def test_duplicate_strategies_agree(spark):
    rows = [(i % 5, None if i % 3 else "x", i % 2, 1.5, "k") for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b string, c int, d double, e string")
    expected = sum(1 for v in set(rows) if rows.count(v) > 1)
    assert count_duplicate_rows(df, "direct") == expected
    assert count_duplicate_rows(df, "hashed") == expected


def test_export_and_rerun(spark, users, orders):
    from tessera.plans.reports import user_order_summary

    uos = user_order_summary(users, orders)
    uos.createOrReplaceTempView("uos_view")
    from tessera.checks.rules import suggest_checks

    checks = suggest_checks(uos)
    results = run_checks(uos, checks)
    exported = export_checks(spark, checks, results, "uos_view", uos)
    rows = exported.orderBy("position").collect()
    assert rows[1]["last_run"] == "FAIL — 1 failing row(s)"
    assert rows[0]["last_run"] == "PASS"
    again = {r["name"]: r["failing_rows"] for r in rerun_exported(spark, exported).collect()}
    first = {r["name"]: r["failing_rows"] for r in results.collect()}
    assert again == first
    assert "GROUP BY" in check_sql(M.no_duplicate_rows(), "t", ["a", "b"])


def test_history_and_sql_text(spark, tmp_path, users, orders):
    from tessera.checks.report import append_results, checks_sql_text, summary_by_run, write_checks_sql
    from tessera.checks.rules import suggest_checks
    from tessera.plans.reports import user_order_summary

    uos = user_order_summary(users, orders)
    checks = suggest_checks(uos)
    res = run_checks(uos, checks)
    path = str(tmp_path / "history")
    append_results(res, path, "r1", "uos")
    append_results(res, path, "r2", "uos")
    append_results(res, path, "r2", "uos")  # a retry replaces its own rows
    summ = {(r["run_id"], r["status"]): r["checks"] for r in summary_by_run(spark.read.parquet(path)).collect()}
    assert summ[("r1", "PASS")] == 9 and summ[("r2", "FAIL")] == 5
    exported = export_checks(spark, checks, res, "uos_view", uos)
    text = [r[0] for r in checks_sql_text(exported).collect()]
    assert text[0].startswith("-- [ 1] table__row_count_positive") and text[0].rstrip().endswith(";")
    out = write_checks_sql(exported, str(tmp_path / "sql"), "uos_view")
    assert spark.read.text(out).count() > len(checks)


def test_profile_and_grain(spark):
    from tessera.operators.profile import guess_grain, profile_with_samples

    df = spark.createDataFrame([(i, i % 3, f"n{i % 5}", None) for i in range(30)],
                               "id bigint, g int, name string, empty string")
    prof = {r["column_name"]: r for r in profile_with_samples(df).collect()}
    assert prof["id"]["row_count"] == 30 and prof["empty"]["null_count"] == 30
    assert prof["g"]["min_value"] == "0" and prof["g"]["max_value"] == "2"
    by_digest = sorted({f"n{i}" for i in range(5)}, key=lambda v: hashlib.md5(v.encode()).hexdigest()[:15])
    assert prof["name"]["sample_values"] == ", ".join(by_digest[:3])
    assert prof["empty"]["sample_values"] == "" and len(prof["id"]["sample_values"].split(", ")) == 3
    assert [(r["candidate"], r["is_unique"]) for r in guess_grain(df).collect()] == [("id", True)]
    # a key of three columns, none of which helps alone
    rows = [(a, b, c, a + b + c) for a in range(6) for b in range(6) for c in range(6)]
    wide = spark.createDataFrame(rows, "a int, `b.x` int, count int, s int")
    found = {frozenset(r["candidate"].split(",")) for r in guess_grain(wide).collect()}
    assert found == {frozenset(k) for k in (("a", "b.x", "count"), ("a", "b.x", "s"), ("a", "count", "s"), ("b.x", "count", "s"))}


def test_samples_are_the_least_digests_of_all_rows(spark):
    from tessera.operators.profile import sample_values

    df = spark.range(20_000).selectExpr("id", "id % 7 AS small", "CAST(NULL AS STRING) AS none")
    for name, values in (("id", range(20_000)), ("small", range(7))):
        want = sorted(map(str, values), key=lambda v: hashlib.md5(v.encode()).hexdigest()[:15])[:3]
        assert sample_values(df)[name] == want
    assert sample_values(df)["none"] == []


def test_wide_table_validation(spark):
    from tessera.checks.run import validate_checks

    cols = [f"total_c{i}" for i in range(60)]
    df = spark.createDataFrame([tuple(range(60))], ", ".join(f"{c} int" for c in cols))
    checks = [M.non_negative(c) for c in cols] + [M.not_null("nope"),
              M.Check("bad__expr", None, "range", "x", condition="no_such_fn(total_c0) < 0", columns=())]
    errors = validate_checks(df, checks)
    assert set(errors) == {60, 61}
    res = run_checks(df, checks).orderBy("position").collect()
    assert [r["status"] for r in res[:60]] == ["PASS"] * 60 and res[61]["status"] == "ERROR"


def test_duplicates_float_normalisation_and_maps(spark):
    rows = [(0.0, "a", 1, 1, 1), (-0.0, "a", 1, 1, 1), (float("nan"), "b", 1, 1, 1), (float("nan"), "b", 1, 1, 1),
            (1.5, "c", 1, 1, 1)]
    df = spark.createDataFrame(rows, "x double, s string, a int, b int, c int")
    assert count_duplicate_rows(df, "direct") == 2
    assert count_duplicate_rows(df, "hashed") == 2
    maps = spark.sql("SELECT map('k', id % 2) AS m, id % 2 AS a, 1 AS b, 1 AS c, 1 AS d, 1 AS e FROM range(6)")
    assert count_duplicate_rows(maps, "direct") == 2
    assert count_duplicate_rows(maps, "hashed") == 2


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 2, "x")], "`a.b` int, `weird``id` int, `total amount` string")
    df = df.toDF("a.b", "weird`id", "user.id")
    res = _counts(run_checks(df, [M.not_null("a.b"), M.unique("a.b"), M.not_null("weird`id"),
                                  M.no_duplicate_rows(), M.unique("user.id")]))
    assert res["a.b__not_null"] == (0, "PASS") and res["a.b__unique"] == (1, "FAIL")
    assert res["weird`id__not_null"] == (1, "FAIL")
    assert res["table__no_duplicate_rows"] == (0, "PASS")
    assert res["user.id__unique"] == (1, "FAIL")


def test_streaming_input_rejected(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "s"))
    with pytest.raises(ValueError):
        run_checks(stream, [M.not_null("id")])


def test_persist_and_materialize_agree(spark, users, orders):
    from tessera.checks.rules import suggest_checks
    from tessera.plans.reports import user_order_summary

    uos = user_order_summary(users, orders)
    checks = suggest_checks(uos)
    plain = _counts(run_checks(uos, checks))
    assert _counts(run_checks(uos, checks, persist=True)) == plain
    assert _counts(run_checks(uos, checks, materialize=True)) == plain
    assert not uos.is_cached


AWKWARD = "`count` int, _h1 int, `_p` int, `_v` int, h1 int, n int, `a.b` int, `c``d` int"


def test_computed_names_never_meet_the_inputs(spark):
    """Duplicates, uniqueness, grain, ranks and merges over columns that carry the names the code uses itself."""
    from tessera.operators.incremental import merge_latest
    from tessera.operators.profile import grain_candidates
    from tessera.operators.windows import percent_rank_within

    rows = [(i % 2, 1, 1, i % 4, 1, 1, 1, 1) for i in range(12)]
    df = spark.createDataFrame(rows, AWKWARD)
    assert count_duplicate_rows(df, "direct") == count_duplicate_rows(df, "hashed") == 4
    got = _counts(run_checks(df, [M.no_duplicate_rows(), M.unique("count"), M.unique("a.b"), M.not_null("c`d")]))
    assert got == {"table__no_duplicate_rows": (4, "FAIL"), "count__unique": (10, "FAIL"), "a.b__unique": (11, "FAIL"), "c`d__not_null": (0, "PASS")}
    assert grain_candidates(df, [["count", "a.b"]]).first()["distinct_keys"] == 2
    for method in ("window", "histogram", "split"):
        ranked = percent_rank_within(df, "count", "_v", method=method)
        assert ranked.columns == [*df.columns, "percent_rank"] and ranked.count() == 12
    merged = merge_latest(df.selectExpr("_v AS _src", "h1 AS _latest", "n").distinct(),
                          spark.createDataFrame([(0, 9, 2), (8, 1, 1)], "_src int, _latest int, n int"), ["_src"], "n")
    assert sorted(map(tuple, merged.collect())) == [(0, 9, 2), (1, 1, 1), (2, 1, 1), (3, 1, 1), (8, 1, 1)]


def test_one_percent_duplicates_without_broadcast(spark):
    rows = spark.range(2000).selectExpr("id % 1980 AS a", "cast(id % 1980 AS string) AS b", "1 AS c", "2 AS d", "3 AS e")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert count_duplicate_rows(rows, "hashed") == count_duplicate_rows(rows, "direct") == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_accepted_values_and_integral_literals(spark):
    import datetime as dt
    import decimal

    D = decimal.Decimal
    df = spark.createDataFrame(
        [("a\\b", "it's", dt.date(2020, 1, 1), D("9007199254740992.25"), "7", 1.0, dt.datetime(2020, 1, 1, 5)),
         ("other", 'q"', dt.date(2020, 1, 2), D("9007199254740993.00"), "7.5", float("nan"), dt.datetime(2020, 1, 2)),
         (None, None, None, None, "x", 1e300, None)],
        "s string, t string, d date, m decimal(30,2), w string, f double, z timestamp_ntz")
    got = run_checks(df, [M.accepted_values("s", ["a\\b"]), M.accepted_values("t", ["it's", 'q"']),
                          M.accepted_values("d", [dt.date(2020, 1, 1)]), M.accepted_values("s", []),
                          M.accepted_values("s", [None, "other"]), M.accepted_values("m", [D("9007199254740993.00")]),
                          M.accepted_values("z", [dt.datetime(2020, 1, 1, 5)]),
                          M.integral("m"), M.integral("w"), M.integral("f")])
    assert [(r["failing_rows"], r["error"]) for r in got.orderBy("position").collect()] == [
        (1, None), (0, None), (1, None), (2, None), (1, None), (1, None), (1, None), (1, None), (2, None), (1, None)]


def test_a_callers_cache_stays(spark):
    df = spark.range(10).selectExpr("id AS user_id").persist()
    df.count()
    run_checks(df, [M.not_null("user_id"), M.unique("user_id")], persist=True)
    assert df.storageLevel.useMemory
    df.unpersist()


def test_days_and_ranges_are_utc_in_any_session_zone(spark):
    from tessera.functions.predicates import time_range, trailing_days
    from tessera.functions.scalars import is_weekend, to_day

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT timestamp_seconds(1704592800) AS z, TIMESTAMP_NTZ '2024-01-07 02:00:00' AS n")  # a Sunday, 02:00 UTC
            for c in ("z", "n"):
                assert str(df.select(to_day(c)).first()[0]) == "2024-01-07" and df.select(is_weekend(c)).first()[0]
                assert df.filter(time_range(c, "2024-01-07", "2024-01-08")).count() == 1
                assert df.filter(time_range(c, "2024-01-06", "2024-01-07")).count() == 0
                assert df.filter(trailing_days(c, 1, as_of="2024-01-08 01:00:00", exclude_today=True)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
