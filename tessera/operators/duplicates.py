"""Repeated rows and values without moving what does not repeat.

Only hashes are grouped first: 8 bytes a row.  Those that repeat set bits in a
filter of fixed size, ``BUCKETS`` bitmaps of ``BITS`` bits (8 MB, so it may be
broadcast at any input size), and only rows whose bit is set travel on to the
exact grouping.  Equal rows have equal hashes, so none is missed; a row that is
let through by chance is told apart by the grouping itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.names import q, unused
from tessera.sources.sinks import materialize

#: Bits of a bitmap (fixed by Spark's bitmap functions) and the number of bitmaps.
BITS, BUCKETS = 1 << 15, 1 << 11


def normalised(c: Column, kind: T.DataType) -> Column:
    """Grouping treats -0.0 as 0.0 and every NaN as equal; a hash only does after this."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).when(c == F.lit(0.0), F.lit(0.0).cast(kind)).otherwise(c)
    return c


def repeated_filter(hashed: DataFrame, column: str) -> DataFrame | None:
    """``bucket``, ``bits``: the places of all values of the hash ``column`` that occur more than once; None if none does."""
    place = F.pmod(F.col(column), F.lit(BITS * BUCKETS))
    again = hashed.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.floor(place / BITS).cast("int").alias("bucket"), (place % BITS).alias("bit"))
    found = materialize(again.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "repeated-hashes")
    return None if found.isEmpty() else found


def suspects(rows: DataFrame, hashed: Column, repeated: DataFrame) -> DataFrame:
    """``rows`` whose hash may repeat, by the filter of :func:`repeated_filter`."""
    h, bucket, bits = unused("_h", rows.columns), unused("_bucket", rows.columns), unused("_bits", rows.columns)
    place = F.pmod(F.col(h), F.lit(BITS * BUCKETS))
    filters = F.broadcast(repeated.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits)))  # 8 MB at most
    at = (place % BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn(h, hashed).join(filters, F.floor(place / BITS).cast("int") == F.col(bucket))
    return met.filter(F.bit_get(byte, at % 8) == 1).drop(h, bucket, bits)


def suspect_rows(rows: DataFrame) -> DataFrame | None:
    """The rows that may be repeated, of columns without nested types; None if none is."""
    hashed = F.xxhash64(*[normalised(F.col(q(f.name)), f.dataType) for f in rows.schema.fields])
    repeated = repeated_filter(rows.select(hashed.alias("h")), "h")
    return None if repeated is None else suspects(rows, hashed, repeated)


def as_text(c: Column, kind: T.DataType) -> Column:
    """Text that is equal exactly where values are."""
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")  # local times may repeat
    return normalised(c, kind).cast("string")


def stackable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def stacked_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``c`` (position in ``columns``), ``t`` (value as text): a row for each value that is not NULL, from one scan."""
    made = [F.struct(F.lit(i).alias("c"), as_text(F.col(q(name)), df.select(q(name)).schema[0].dataType).alias("t")) for i, name in enumerate(columns)]
    return df.select(F.inline(F.array(*made))).filter("t IS NOT NULL")


#: Types of at most 64 bits: ``xxhash64`` of one such value is a bijection, so equal hashes are equal values.
_NARROW = (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def narrow(kind: T.DataType) -> bool:
    return isinstance(kind, _NARROW) or (isinstance(kind, T.DecimalType) and kind.precision <= 18)


def _hashed_values(df: DataFrame, columns: list[str], kinds: list[T.DataType]) -> DataFrame:
    """``c`` (position in ``columns``), ``h`` (hash of the value): a row for each value that is not NULL, from one scan."""
    made = []
    for i, (name, kind) in enumerate(zip(columns, kinds, strict=True)):
        value = F.col(q(name))
        h = F.xxhash64(normalised(value, kind) if narrow(kind) else as_text(value, kind))
        made.append(F.struct(F.lit(i).alias("c"), F.when(value.isNotNull(), h).alias("h")))
    return df.select(F.inline(F.array(*made))).filter("h IS NOT NULL")


def excess_copies_of(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """A14 for many columns: ``COUNT(c) - COUNT(DISTINCT c)`` of each.

    One pass over the hashes of all columns settles those of at most 64 bits, and
    every column without a repeated hash.  In the others hashes may clash, so the
    values themselves are grouped: those that the filter lets through, or all if
    so many hashes repeat that it would keep few back.
    """
    kinds = [df.select(q(name)).schema[0].dataType for name in columns]
    groups = _hashed_values(df, columns, kinds).groupBy("c", "h").agg(F.count(F.lit(1)).alias("n"))
    found = {r["c"]: r for r in groups.groupBy("c").agg(F.sum(F.col("n") - 1).alias("excess"), F.count_if(F.col("n") > 1).alias("again")).collect()}
    out = {name: int(found[i]["excess"]) if i in found else 0 for i, name in enumerate(columns)}
    open_ = [name for name, kind in zip(columns, kinds, strict=True) if out[name] and not narrow(kind)]
    if not open_:
        return out
    values = stacked_values(df, open_)
    if sum(found[columns.index(name)]["again"] for name in open_) * 8 < BITS * BUCKETS:
        hashed = F.xxhash64("c", "t")
        repeated = repeated_filter(values.select(hashed.alias("h")), "h")
        values = values.limit(0) if repeated is None else suspects(values, hashed, repeated)
    again = values.groupBy("c", "t").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    out.update(dict.fromkeys(open_, 0))
    for row in again.groupBy("c").agg(F.sum(F.col("n") - 1).alias("excess")).collect():
        out[open_[row["c"]]] = int(row["excess"])
    return out
