"""Sums beyond 38 digits against Python's decimals."""

import decimal
import random

import pytest

from tessera.operators.wide_sum import wide_sum


def plain(x):
    text = format(x, "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text == "-0" else text


def test_equal_to_decimals(spark):
    rng = random.Random(1)
    rows = []
    for k in range(400):
        whole, rest = rng.choice((0, 1, 5, 12, 38, 42)), rng.choice((0, 1, 6, 7, 38, 42))
        digits = "".join(rng.choice("0123456789") for _ in range(whole)) or ("" if rest else "0")
        rows.append((k % 7, rng.choice(("", "-", "+")) + digits + ("." + "".join(rng.choice("0123456789") for _ in range(rest)) if rest else "")))
    rows += [(8, None), (9, "-0.5"), (9, "0.5"), (10, "-0.000001"), *[(11, "9" * 38)] * 7, *[(12, "-" + "9" * 42)] * 3, (13, " 007. "), (13, None)]
    got = {r.k: (r.total, r.n) for r in wide_sum(spark.createDataFrame(rows, "k int, v string").repartition(6), ["k"], "v", extra=[__import__("pyspark").sql.functions.count("v").alias("n")]).collect()}
    with decimal.localcontext() as c:
        c.prec = 200
        for k in {k for k, _ in rows}:
            values = [decimal.Decimal(v.strip()) for i, v in rows if i == k and v is not None]
            assert got[k] == (plain(sum(values)) if values else None, len(values))


def test_spark_decimals_that_overflow_together(spark):
    df = spark.createDataFrame([(1, decimal.Decimal("9" * 38))] * 6, "k int, v decimal(38,0)")
    assert wide_sum(df, ["k"], "v").first().total == str(6 * int("9" * 38))


@pytest.mark.parametrize("text", ["1e5", "abc", "", "1.2.3", "9" * 43, "--1"])
def test_what_is_no_decimal_is_an_error(spark, text):
    with pytest.raises(Exception, match="not a decimal"):
        wide_sum(spark.createDataFrame([(1, text)], "k int, v string"), ["k"], "v").collect()


def test_a_text_is_taken_apart_once(spark, capsys):
    """the plan matched six regular expressions a limb, so a row took a quarter of a millisecond."""
    df = spark.range(10).selectExpr("id % 2 AS k", "concat('-00', id, '.', id, '0') AS v", "'mine' AS _body")
    summed = wide_sum(df, ["k"], "v")
    summed.explain()
    plan = capsys.readouterr().out
    assert plan.count("RLIKE") == 1 and "regexp_extract" not in plan
    assert {r.k: r.total for r in summed.collect()} == {0: "-22", 1: "-27.5"}


def test_zeros_beyond_the_digits_and_blanks(spark):
    rows = [(1, "0" * 50 + "7." + "0" * 60), (1, "\t-.5\n"), (1, "3."), (2, "+" + "0" * 60), (3, "\r" + "9" * 42 + "." + "9" * 42 + "000")]
    got = {r.k: r.total for r in wide_sum(spark.createDataFrame(rows, "k int, v string"), ["k"], "v").collect()}
    assert got == {1: "9.5", 2: "0", 3: "9" * 42 + "." + "9" * 42}
