"""Views over the driver's TPC-H-like test tables that stand in for the
reference's warehouse tables (``blocks``, ``file_downloads``, ``users``,
``orders``, ``sessions``).

Every view is a row-by-row projection (or a join with a dimension) of a given
table, so its size grows with the input and no key is ever collected into one
row.  The same definitions are written as DuckDB SQL in
``tessera.plans.oracle`` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (test mapping) --------------------------------------------
# Distro name by line number 1..7 of a lineitem row (5 is outside the report's
# accepted list).
DISTRO_BY_LINE = ["Ubuntu", "Debian", "CentOS", "Fedora", "Arch", "Ubuntu", "Debian"]
# A line has its number less one withdrawals, counted modulo this.
WITHDRAWALS = 7
# Installer name by part type; STANDARD has no installer (NULL).
INSTALLER_BY_TYPE = {"ECONOMY": "pip", "PROMO": "nexus", "MEDIUM": "artifactory",
                     "SMALL": "conda", "LARGE": "poetry"}
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def blocks_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blocks`` with an array-of-struct ``withdrawals`` column.

    number = order key, timestamp = ship date; each line carries
    ``(linenumber - 1) modulo 7`` withdrawals (line 1 has an empty array) and
    lines with return flag R and status O carry a NULL array.  Amounts are
    integer strings (``partkey * (index + 1)``), as in the real table, so the
    report must cast them.  Built from fixed-size ``array`` + ``slice`` rather
    than a lambda so the whole projection is code-generated.
    """
    li = table(spark, sf_dir, "lineitem")
    full = F.array(*[F.struct(F.lit(i).alias("index"),
                              (F.col("l_partkey") * (i + 1)).cast("string").alias("amount"))
                     for i in range(WITHDRAWALS - 1)])
    n = (F.col("l_linenumber") - 1) % WITHDRAWALS
    withdrawals = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
                         F.lit(None)).otherwise(F.slice(full, 1, n))
    return li.select(F.col("l_orderkey").alias("number"),
                     F.col("l_shipdate").alias("timestamp"),
                     withdrawals.alias("withdrawals"))


def blocks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blocks`` for the per-day reports: one block per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("number"),
                     F.col("ts").alias("timestamp"),
                     F.round(F.col("value") * 100).cast("bigint").alias("gas_used"))


def downloads_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_downloads`` with two-level nested structs, from lineitem x part.

    project = part name with '-' for blanks, with the prefix of a throw-away
    project for every 13th part; lower-case country code for every 17th part;
    version = line number (+ 'rc1'
    for returned lines), country = return flag + line status, python = '3.x.1'
    (a non-version text for flag N), installer by part type, distro by line
    number, system Linux unless the discount is above 8%.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    installer = F.lit(None).cast("string")
    for ptype, name in reversed(list(INSTALLER_BY_TYPE.items())):
        installer = F.when(F.col("p_type") == ptype, F.lit(name)).otherwise(installer)
    distro_names = F.array(*[F.lit(x) for x in DISTRO_BY_LINE])
    line = F.col("l_linenumber")
    return j.select(
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("p_partkey") % 17 == 0, F.lower(F.concat("l_returnflag", "l_linestatus")))
         .otherwise(F.concat("l_returnflag", "l_linestatus")).alias("country_code"),
        F.struct(F.when(F.col("p_partkey") % 13 == 0, F.concat(F.lit("test-"), F.translate(F.col("p_name"), " ", "-")))
                  .otherwise(F.translate(F.col("p_name"), " ", "-")).alias("project"),
                 F.concat(line.cast("string"), F.lit(".0"),
                          F.when(F.col("l_returnflag") == "R", F.lit("rc1")).otherwise(F.lit("")))
                 .alias("version")).alias("file"),
        F.struct(
            F.when(F.col("l_returnflag") == "N", F.lit("pypy"))
             .otherwise(F.concat(F.lit("3."), (line + 5).cast("string"), F.lit(".1"))).alias("python"),
            F.struct(installer.alias("name")).alias("installer"),
            F.struct(F.element_at(distro_names, (line - 1) % len(DISTRO_BY_LINE) + 1).alias("name"),
                     F.when(line <= 2, F.lit("22.04")).when(line == 3, F.lit(None).cast("string"))
                      .otherwise(F.lit("9")).alias("version")).alias("distro"),
            F.struct(F.when(F.col("l_discount") > 0.08, F.lit("Darwin")).otherwise(F.lit("Linux")).alias("name"),
                     F.concat(F.lit("5."), F.round(F.col("l_tax") * 100).cast("int").cast("string"))
                     .alias("release")).alias("system"),
        ).alias("details"))


def downloads_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_downloads`` of few, large groups: the part's type as package, one version and environment a country.

    The release is the day of the month's last digit, so that a large group has all ten.
    """
    log = downloads_from_lineitem(spark, sf_dir)
    part = F.coalesce(F.col("details.installer.name"), F.lit("none"))
    return log.select(
        "timestamp", F.upper("country_code").alias("country_code"),
        F.struct(F.concat(F.lit("pkg-"), part).alias("project"), F.lit("1.0").alias("version")).alias("file"),
        F.struct(F.lit("3.9.1").alias("python"), F.struct(F.lit("pip").alias("name")).alias("installer"),
                 F.struct(F.lit("Ubuntu").alias("name"), F.lit("22.04").alias("version")).alias("distro"),
                 F.struct(F.lit("Linux").alias("name"), (F.dayofmonth("timestamp") % 10).cast("string").alias("release")).alias("system")).alias("details"))


def users_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users``: email NULL for HOUSEHOLD, malformed for MACHINERY; country
    code from the market segment (three letters for AUTOMOBILE); inactive when
    the account balance is negative."""
    c = table(spark, sf_dir, "customer")
    base = F.lower(F.translate(F.col("c_name"), "#", "."))
    email = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
             .when(F.col("c_mktsegment") == "MACHINERY", F.concat(base, F.lit("@example")))
             .otherwise(F.concat(base, F.lit("@example.com"))))
    return c.select(F.col("c_custkey").alias("user_id"), email.alias("email"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("AUT"))
                    .otherwise(F.substring(F.col("c_mktsegment"), 1, 2)).alias("country_code"),
                    (F.col("c_acctbal") >= 0).alias("is_active"),
                    F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
                    .alias("created_at"))


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders``: amounts as decimal(18,2) so sums do not depend on addition order."""
    o = table(spark, sf_dir, "orders")
    return (o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.to_date("o_orderdate").alias("created_at")))


def sessions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sessions``: country = first two letters of the event type (NULL for
    errors); purchases carry a negative duration."""
    ev = table(spark, sf_dir, "events")
    secs = F.round(F.col("value")).cast("bigint")
    return ev.select(
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("session_id"),
        F.col("user_id"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.upper(F.substring("event_type", 1, 2))).alias("country_code"),
        F.when(F.col("event_type") == "purchase", -secs).otherwise(secs).alias("duration_seconds"),
        F.col("ts").alias("started_at"))
