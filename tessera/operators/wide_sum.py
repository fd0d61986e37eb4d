"""Exact sums of decimals that are wider than Spark's 38 digits.

A number stays text.  Its digits are cut into limbs of ``LIMB`` digits, counted
from the decimal point, with the number's sign on each; every limb is summed as
an ordinary ``bigint`` (partial aggregates, so a hot group costs a row a task),
and the carries are settled once a group, in the result.  Up to ``WHOLE`` digits
before the point and as many after it are exact, and 9 * 10^12 rows a group.

Text that is no plain decimal, or has more digits, raises an error that names
it, as a cast would.  NULL is left out; a group of NULLs only sums to NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import q, unused

LIMB, LIMBS = 6, 7
#: Digits on each side of the decimal point.
WHOLE = LIMB * LIMBS
_BASE = 10 ** LIMB


#: What ``\s`` matches.
_BLANK = " \t\n\x0b\f\r"


def with_limbs(df: DataFrame, value: Column, names: list[str]) -> DataFrame:
    """``df`` with the signed limbs of decimal text as ``names``, the highest first: ``LIMBS`` before the point, ``LIMBS`` after it.

    Each step is a projection of its own that reads the columns of the one before, so
    that a text is taken apart once, not once a limb.
    """
    text, body, digits, sign = (unused(c, [*df.columns, *names]) for c in ("_text", "_body", "_digits", "_sign"))
    trimmed = F.btrim(F.col(text), F.lit(_BLANK))
    signed = F.substring(trimmed, 1, 1).isin("+", "-")
    made = df.withColumn(text, value.cast("string")).withColumns({
        body: F.when(signed, F.substring(trimmed, 2, 1 << 30)).otherwise(trimmed),
        sign: F.when(F.substring(trimmed, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))})
    point = F.instr(F.col(body), ".")
    whole = F.substring_index(F.col(body), ".", 1)
    rest = F.when(point > 0, F.substring(F.col(body), point + 1, F.lit(1 << 30))).otherwise("")
    wide = [unused(c, made.columns) for c in ("_whole", "_rest")]
    # zeros count for nothing; few texts have so many digits that they must go
    made = made.withColumns({wide[0]: whole, wide[1]: rest}).withColumns({
        wide[0]: F.when(F.length(wide[0]) > WHOLE, F.ltrim(F.col(wide[0]), F.lit("0"))).otherwise(F.col(wide[0])),
        wide[1]: F.when(F.length(wide[1]) > WHOLE, F.rtrim(F.col(wide[1]), F.lit("0"))).otherwise(F.col(wide[1]))})
    valid = F.col(body).rlike(r"^(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)\z") & (F.length(wide[0]) <= WHOLE) & (F.length(wide[1]) <= WHOLE)
    error = F.raise_error(F.concat(F.lit("not a decimal of at most 42 + 42 digits: "), F.col(text))).cast("string")
    filled = F.concat(F.lpad(wide[0], WHOLE, "0"), F.rpad(wide[1], WHOLE, "0"))
    made = made.withColumn(digits, F.when(F.col(text).isNull(), None).when(valid, filled).otherwise(error))
    limbs = {name: F.substring(F.col(digits), i * LIMB + 1, LIMB).cast("bigint") * F.col(sign) for i, name in enumerate(names)}
    return made.withColumns(limbs).drop(text, body, digits, sign, *wide)


def _carried(limbs: list[Column]) -> Column:
    """struct(carry, text): limbs brought into 0 .. base - 1 from the lowest up; what is left over stays in ``carry``."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))

    def step(acc: Column, limb: Column) -> Column:
        total = acc["carry"] + limb
        digit = F.pmod(total, F.lit(_BASE))
        carry = ((total - digit) / _BASE).cast("decimal(38,0)").cast("bigint")
        return F.struct(carry.alias("carry"), F.concat(F.lpad(digit.cast("string"), LIMB, "0"), acc["text"]).alias("text"))

    return F.aggregate(F.array(*reversed(limbs)), start, step)


def wide_text(sums: list[Column]) -> Column:
    """Decimal text of summed limbs (highest first): no leading or trailing zeros, no exponent; NULL if a sum is."""
    up, down = _carried(sums), _carried([-s for s in sums])
    negative = up["carry"] < 0
    made = F.when(negative, down).otherwise(up)
    digits = F.concat(made["carry"].cast("string"), made["text"])
    point = F.length(digits) - LIMB * LIMBS
    whole = F.regexp_replace(F.substring(digits, F.lit(1), point), "^0+(?=[0-9])", "")
    rest = F.regexp_replace(F.substring(digits, point + 1, F.lit(LIMB * LIMBS)), "0+$", "")
    return F.when(sums[0].isNull(), None).otherwise(
        F.concat(F.when(negative, "-").otherwise(""), whole, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise("")))


def wide_sum(df: DataFrame, keys: list[str], value: str | Column, name: str = "total", extra: list[Column] | None = None) -> DataFrame:
    """``keys``, ``name`` (exact sum as text) and the further aggregates ``extra`` of every group."""
    value = F.col(q(value)) if isinstance(value, str) else value
    names: list[str] = []
    for i in range(2 * LIMBS):
        names.append(unused(f"_limb{i}", [*df.columns, *names]))
    made = with_limbs(df, value, names)
    sums = [F.sum(name).alias(f"_sum{i}") for i, name in enumerate(names)]
    extra = extra or []
    grouped = made.groupBy(*[F.col(q(k)) for k in keys]).agg(*sums, *extra)
    kept = [c for c in grouped.columns if not c.startswith("_sum")]
    total = wide_text([F.col(f"_sum{i}") for i in range(2 * LIMBS)])
    return grouped.select(*[F.col(q(c)) for c in kept[:len(keys)]], total.alias(name), *[F.col(q(c)) for c in kept[len(keys):]])
