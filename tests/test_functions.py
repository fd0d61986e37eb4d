"""Predicate and scalar builders, edge by edge."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.functions import scalars as S

T = dt.datetime


def _one(spark, expr, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_regex_extract_null_on_no_match(spark):
    assert _one(spark, S.major_minor("x"), row=("3.11.4",)) == "3.11"
    assert _one(spark, S.major_minor("x"), row=("cpython",)) is None
    assert _one(spark, S.major_minor("x"), row=(None,)) is None


def test_clean_version_replaces_all(spark):
    assert _one(spark, S.clean_version("x"), row=("v1.2.3-rc1",)) == "1.2.31"


def test_fingerprint_null_if_any_part_null(spark):
    df = spark.createDataFrame([("ZA", "Ubuntu", None), ("ZA", "Ubuntu", "22.04")], "a string, b string, c string")
    assert [r[0] for r in df.select(S.fingerprint("a", "b", "c")).collect()] == [None, "ZA-Ubuntu-22.04"]


def test_installer_type_branches(spark):
    df = spark.createDataFrame([("pip",), ("nexus",), ("bandersnatch",), ("artifactory",), (None,), ("uv",)], "x string")
    assert [r[0] for r in df.select(S.installer_type("x")).collect()] == [
        "Standard", "Mirror/Proxy", "Mirror/Proxy", "Mirror/Proxy", "Unknown", "Other-Tool"]


def test_pct_change_guards_zero(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (6, 4), (1, 3)], "c bigint, p bigint")
    assert [r[0] for r in df.select(S.pct_change("c", "p")).collect()] == [None, None, 50.0, -66.67]
    assert [r[0] for r in df.select(S.change("c", "p", signed=False)).collect()] == [5, None, 2, 2]


def test_weekend_numbering(spark):
    days = [T(2023, 1, d) for d in range(1, 8)]  # Sunday .. Saturday
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    assert [r[0] for r in df.select(S.is_weekend("ts")).collect()] == [True, False, False, False, False, False, True]


def test_day_diff_is_integer(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 1), dt.date(2023, 6, 15))], "a date, b date")
    r = df.select(S.day_diff("b", "a").alias("d"))
    assert r.schema["d"].dataType.simpleString() == "int" and r.first()["d"] == 106


def test_time_range_half_open(spark):
    df = spark.createDataFrame([(T(2023, 1, 1),), (T(2023, 1, 31, 23, 59),), (T(2023, 2, 1),)], "ts timestamp_ntz")
    assert df.filter(P.time_range("ts", "2023-01-01", "2023-02-01")).count() == 2
    assert df.filter(P.time_range("ts", end="2023-01-02")).count() == 1
    assert df.filter(P.month_range("ts", "2023-01")).count() == 2
    dec = spark.createDataFrame([(T(2023, 12, 31),), (T(2024, 1, 1),)], "ts timestamp_ntz")
    assert dec.filter(P.month_range("ts", "2023-12")).count() == 1


def test_trailing_days_excludes_today(spark):
    as_of = T(2024, 3, 10, 12)
    rows = [(T(2024, 3, 3, 11),), (T(2024, 3, 3, 12),), (T(2024, 3, 9, 23),), (T(2024, 3, 10, 1),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert df.filter(P.trailing_days("ts", 7, as_of=as_of)).count() == 3
    assert df.filter(P.trailing_days("ts", 7, as_of=as_of, exclude_today=True)).count() == 2


def test_code_and_project_rules(spark):
    codes = spark.createDataFrame([("ZA",), ("za",), ("USA",), ("U1",), (None,)], "c string")
    assert [r[0] for r in codes.filter(P.valid_code("c")).collect()] == ["ZA"]
    names = ["test-x", "x-test", "temp-x", "demo-x", "contest", "testing", "my-tests", "attest-x"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    kept = sorted(r[0] for r in df.filter(P.not_excluded_project("p")).collect())
    assert kept == sorted(["contest", "testing", "my-tests", "attest-x"])
    assert kept == sorted(r[0] for r in df.filter(P.not_excluded_project("p", use_regex=True)).collect())
    with_null = spark.createDataFrame([(None,), ("a-test",), ("b",)], "p string")
    assert [r[0] for r in with_null.filter(P.not_excluded_project("p")).collect()] == ["b"]


def test_in_list_and_like(spark):
    df = spark.createDataFrame([(1, "a@b.c"), (7, "nope"), (3, None)], "k int, e string")
    assert df.filter(P.in_list("k", [1, 7], negate=True)).count() == 1
    assert df.filter(P.like("e", "%@%.%", negate=True)).count() == 1
    assert df.filter(P.is_true(F.col("k") > 2)).count() == 2
