"""Table profiler and grain guess.

One aggregate pass gives, per column, the non-null count, min, max and an
HLL distinct estimate; the result is reshaped on the driver (one row per
column - bounded by the schema, not the data).  Grain candidates are tested
with one partially aggregated ``groupBy(candidate).count()`` pass each.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from tessera.functions.names import q
from tessera.operators.duplicates import normalised
from tessera.operators.grain import minimal_keys


def _orderable(dt) -> bool:
    return not isinstance(dt, (MapType, ArrayType, StructType))


def profile_table(df: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Per column: position, type, rows, NULLs, min, max (as text), distinct estimate."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(q(f.name))
        aggs.append(F.count(c).alias(f"_n{i}"))
        if _orderable(f.dataType):
            aggs += [F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}"),
                     F.approx_count_distinct(c, rsd).alias(f"_d{i}")]
    row = df.agg(*aggs).first()
    total = int(row["_rows"])
    out = []
    for i, f in enumerate(fields):
        ok = _orderable(f.dataType)
        out.append((i + 1, f.name, f.dataType.simpleString(), total, total - int(row[f"_n{i}"]),
                    row[f"_lo{i}"] if ok else None, row[f"_hi{i}"] if ok else None,
                    int(row[f"_d{i}"]) if ok else None))
    return df.sparkSession.createDataFrame(
        out, "position int, column_name string, data_type string, row_count bigint, null_count bigint, "
             "min_value string, max_value string, approx_distinct bigint")


def grain_candidates(df: DataFrame, candidates: list[list[str]], max_parallel: int = 4, likely_unique: bool = False) -> DataFrame:
    """For each candidate key: number of distinct keys, largest group, unique?

    With ``likely_unique`` 64-bit hashes of the keys are grouped first; if none
    repeats, no key does, else the keys themselves are grouped as without it.
    """
    if not candidates:
        return df.sparkSession.createDataFrame(
            [], "candidate string, distinct_keys bigint, max_rows_per_key bigint, is_unique boolean")

    def one(cols: list[str]):
        keys = df.select(*[F.col(q(c)).alias(f"k{i}") for i, c in enumerate(cols)])
        if likely_unique:
            parts = [x for f in keys.schema.fields for x in (normalised(F.col(f.name), f.dataType), F.col(f.name).isNull())]
            hashes = keys.select(F.xxhash64(*parts).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
            r = hashes.agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("mx")).first()
            if r["mx"] == 1:
                return (",".join(cols), int(r["k"]), 1, True)
        g = keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("n"))
        r = g.agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("mx")).first()
        keys, mx = int(r["k"]), (int(r["mx"]) if r["mx"] is not None else 0)
        return (",".join(cols), keys, mx, mx <= 1)

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(candidates)))) as pool:
        rows = list(pool.map(one, candidates))
    return df.sparkSession.createDataFrame(
        rows, "candidate string, distinct_keys bigint, max_rows_per_key bigint, is_unique boolean")


#: Distinct values expected below the first hash threshold of a column's sample.
_EXPECTED = 32


def _digest(text):
    """The first 60 bits of a value's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def sample_values(df: DataFrame, k: int = 3, rsd: float = 0.05) -> dict[str, list[str]]:
    """Up to ``k`` distinct non-null values of each column, as text: those with the least MD5 over all rows.

    One aggregate finds the distinct estimates, a second one collects, for all
    columns at once, the distinct values whose digest is below a threshold that
    about ``_EXPECTED`` values pass; a column that gets fewer than ``k`` is read
    again with a higher threshold.  Every row counts, and a few values per
    column reach the driver.
    """
    fields = [f for f in df.schema.fields if _orderable(f.dataType)]
    text = {f.name: F.col(q(f.name)).cast("string") for f in fields}
    if not text:
        return {f.name: [] for f in df.schema.fields}
    row = df.agg(*[F.approx_count_distinct(c, rsd).alias(f"d{i}") for i, c in enumerate(text.values())]).first()
    full = 1 << 60
    limit = {name: full if row[i] <= _EXPECTED else full * (_EXPECTED + k) // row[i] for i, name in enumerate(text)}
    out: dict[str, list[str]] = {f.name: [] for f in df.schema.fields}
    open_ = list(text)
    while open_:
        found = df.agg(*[F.slice(F.array_sort(F.collect_set(F.when(_digest(text[n]) < limit[n], F.struct(_digest(text[n]).alias("h"), text[n].alias("v"))))), 1, k)
                         .alias(f"s{i}") for i, n in enumerate(open_)]).first()
        for i, n in enumerate(open_):
            out[n] = [x["v"] for x in found[i]]
        open_ = [n for n in open_ if len(out[n]) < k and limit[n] < full]
        limit.update({n: min(full, limit[n] * 16) for n in open_})
    return out


def profile_with_samples(df: DataFrame, k: int = 3, rsd: float = 0.05) -> DataFrame:
    """``profile_table`` plus a ``sample_values`` column (comma separated)."""
    prof = profile_table(df, rsd)
    samples = sample_values(df, k, rsd)
    spark = df.sparkSession
    s = spark.createDataFrame([(c, ", ".join(v)) for c, v in samples.items()],
                              "column_name string, sample_values string")
    return prof.join(s, "column_name", "left").orderBy("position")


def guess_grain(df: DataFrame, max_width: int = 3) -> DataFrame:
    """All minimal keys of up to ``max_width`` columns, one row each (column ``candidate``, as ``grain_candidates``).

    Exact and complete up to that width (:mod:`tessera.operators.grain`).
    """
    return grain_candidates(df, minimal_keys(df, max_width), likely_unique=True)
