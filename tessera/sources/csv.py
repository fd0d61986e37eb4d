"""CSV scan with a header (IO2).

An explicit schema is preferred: inference costs an extra pass over the files
and yields ``int`` where a ``bigint`` is meant.  Empty fields read as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write ``df`` as header CSV files under ``path`` (overwrite)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
