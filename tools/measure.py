"""

Usage: python tools/measure.py [sf_dir] [repeat]
Prints one JSON object; each value is the median of ``repeat`` warm runs (sec).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.checks import model as M  # noqa: E402
from tessera.checks.run import count_duplicate_rows, run_checks  # noqa: E402
from tessera.functions import predicates as P  # noqa: E402
from tessera.plans import catalog as C  # noqa: E402
from tessera.plans import reports as RP  # noqa: E402
from tessera.session import get_spark  # noqa: E402
from tessera.sources import derived as D  # noqa: E402


def timed(fn, repeat):
    fn()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 4)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = get_spark(shuffle_partitions=16)
    li = D.table(spark, sf, "lineitem")
    row_checks = [M.not_null("l_orderkey"), M.non_negative("l_quantity"), M.non_negative("l_discount"),
                  M.accepted_values("l_returnflag", ["A", "N", "R"]), M.column_pair("l_quantity", "l_linenumber"),
                  M.not_null("l_shipdate")]
    out = {"sf_dir": sf, "spark": spark.version, "cores": spark.sparkContext.defaultParallelism,
           "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")), "repeat": repeat}

    out["checks_fused_6"] = timed(lambda: run_checks(li, row_checks).collect(), repeat)
    out["checks_one_job_each_6"] = timed(
        lambda: [li.filter(F.expr(c.condition)).count() for c in row_checks], repeat)

    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    out["unique_3_grouped_passes"] = timed(lambda: run_checks(li, [M.unique(k) for k in keys]).collect(), repeat)
    out["unique_3_multi_distinct_expand"] = timed(
        lambda: li.agg(*[(F.count(k) - F.count_distinct(k)).alias(k) for k in keys]).collect(), repeat)

    out["duplicates_direct"] = timed(lambda: count_duplicate_rows(li, "direct"), repeat)
    out["duplicates_hashed"] = timed(lambda: count_duplicate_rows(li, "hashed"), repeat)

    out["month_typed_range"] = timed(
        lambda: li.filter(P.month_range("l_shipdate", "1998-01")).agg(F.count(F.lit(1))).collect(), repeat)
    out["month_cast_like"] = timed(
        lambda: li.filter(F.col("l_shipdate").cast("string").like("1998-01-%")).agg(F.count(F.lit(1))).collect(),
        repeat)

    names = D.table(spark, sf, "lineitem").join(D.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    names = names.select(F.concat(F.col("p_name"), F.lit("-"), F.col("l_returnflag")).alias("project"))
    out["project_rule_prefix_suffix"] = timed(
        lambda: names.filter(P.not_excluded_project("project")).agg(F.count(F.lit(1))).collect(), repeat)
    out["project_rule_regex"] = timed(
        lambda: names.filter(P.not_excluded_project("project", use_regex=True)).agg(F.count(F.lit(1))).collect(),
        repeat)

    dl = lambda: D.downloads_from_lineitem(spark, sf)
    args = dict(min_downloads=C.DL_MIN, distinct="exact")
    out["report_histogram_materialized"] = timed(
        lambda: noop(RP.download_growth_report(dl(), C.DL_START, C.DL_END, **args)), repeat)
    out["report_histogram_recomputed"] = timed(
        lambda: noop(RP.download_growth_report(dl(), C.DL_START, C.DL_END, materialize_groups=False, **args)),
        repeat)
    out["report_window_rank"] = timed(
        lambda: noop(RP.download_growth_report(dl(), C.DL_START, C.DL_END, rank_method="window", **args)), repeat)
    out["report_approx_distinct"] = timed(
        lambda: noop(RP.download_growth_report(dl(), C.DL_START, C.DL_END, min_downloads=C.DL_MIN)), repeat)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
