"""Minimal keys against brute force."""

import random
from itertools import combinations

import pytest

from tessera.operators import grain
from tessera.operators.profile import guess_grain


def brute(rows, names, width):
    keys = []
    for w in range(1, width + 1):
        for c in combinations(range(len(names)), w):
            if not any(set(k) <= set(c) for k in keys) and len({tuple(r[i] for i in c) for r in rows}) == len(rows):
                keys.append(c)
    return sorted([names[i] for i in k] for k in keys)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_minimal_keys(spark, seed):
    rng = random.Random(seed)
    rows = list({(i // 4, i % 4, rng.randrange(30), rng.choice("ab"), i if seed == 1 else i // 2, rng.choice((None, "", "x")), float(rng.randrange(90))) for i in range(240)})
    names = ["order", "line", "part", "flag", "id", "note", "price"]
    df = spark.createDataFrame(rows, "order long, line int, part int, flag string, id long, note string, price double")
    assert sorted(grain.minimal_keys(df)) == brute(rows, names, 3)
    assert sorted(r.candidate.split(",") for r in guess_grain(df).collect()) == brute(rows, names, 3)


def test_few_sets_are_counted(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i // 5, i % 5, *[rng.randrange(4) for _ in range(30)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "a long, b long, " + ", ".join(f"c{i} int" for i in range(30)))
    counted = []
    real = grain._counterexample
    monkeypatch.setattr(grain, "_counterexample", lambda r, c: counted.append(c) or real(r, c))
    assert grain.minimal_keys(df, 2) == [["a", "b"]]
    assert len(counted) < 40  # of 528 sets


def test_no_key_empty_and_single_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b")], "x int, y string")
    assert grain.minimal_keys(df) == [] and grain.minimal_keys(df.limit(0)) == []
    assert grain.minimal_keys(df.limit(1)) == [["x"], ["y"]]
    assert guess_grain(df).count() == 0
    nulls = spark.createDataFrame([(None, 0.0), (None, -0.0), ("", 1.0)], "x string, y double")
    assert grain.minimal_keys(nulls) == []


def test_a_hot_value_is_not_collected(spark):
    """A third of all rows share one value of a wide column."""
    df = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, -1, id) AS hot", "id % 7 AS low")
    assert len(grain._chosen_rows(df.selectExpr("string(id) AS c0", "string(hot) AS c1", "string(low) AS c2"), 30_000)) <= 5 * grain.WHOLE_ROWS
    assert grain.minimal_keys(df) == [["id"]]


def test_types_and_nulls_of_keys(spark, monkeypatch):
    """all values were turned into text for each set, and the keys that were found grouped once more as a whole."""
    import datetime as dt
    import decimal
    rows = [(0.0, None, b"a", dt.datetime(2024, 1, 1), decimal.Decimal("1.5"), 1), (-0.0, 0, b"b", dt.datetime(2024, 1, 1), decimal.Decimal("1.50"), 2),
            (float("nan"), 1, None, None, None, 3), (float("nan"), 2, b"", dt.datetime(2024, 1, 2), None, 4)]
    df = spark.createDataFrame(rows, "d double, i int, b binary, t timestamp, m decimal(30,4), id long")
    hashed = []
    real = grain._counterexample
    monkeypatch.setattr(grain, "_counterexample", lambda r, c: hashed.append(dict(r.dtypes)) or real(r, c))
    assert sorted(grain.minimal_keys(df)) == [["b"], ["i"], ["id"]]
    assert {(r.candidate, r.distinct_keys, r.max_rows_per_key, r.is_unique) for r in guess_grain(df).collect()} == {(k, 4, 1, True) for k in ("b", "i", "id")}
    assert hashed[0] == {"c0": "double", "c1": "int", "c2": "string", "c3": "timestamp", "c4": "string", "c5": "bigint"}
