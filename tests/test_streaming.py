"""Micro-batch and windowed checks on a file stream built from the events table."""

from pyspark.sql import functions as F

from tessera.checks import model as M
from tessera.checks.run import run_checks
from tessera.streaming.checks import check_each_batch, windowed_violation_counts

from conftest import SF_SMALL

CHECKS = [M.row_count_positive(), M.not_null("user_id"), M.non_negative("value"),
          M.accepted_values("event_type", ["click", "view", "purchase", "signup"]), M.unique("event_id")]


def _stream_dir(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = str(tmp_path / "events_in")
    ev.repartition(2).write.parquet(src)
    return ev, spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_check_each_batch_matches_batch_run(spark, tmp_path):
    ev, stream = _stream_dir(spark, tmp_path)
    out = str(tmp_path / "results")
    q = check_each_batch(stream, CHECKS, out, checkpoint_location=str(tmp_path / "ckpt"),
                         trigger={"availableNow": True})
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert res.select("batch_id").distinct().count() == 2
    per_check = {r["name"]: r["s"] for r in res.groupBy("name").agg(F.sum("failing_rows").alias("s")).collect()}
    whole = {r["name"]: r["failing_rows"] for r in run_checks(ev, CHECKS).collect()}
    # row-level counts add up over batches; uniqueness holds per batch and overall here
    for name in ("user_id__not_null", "value__non_negative", "event_type__accepted_values"):
        assert per_check[name] == whole[name]


def test_windowed_violation_counts(spark, tmp_path):
    ev, stream = _stream_dir(spark, tmp_path)
    row_checks = [c for c in CHECKS if c.kind == M.ROW]
    agg = windowed_violation_counts(stream, row_checks, "ts", "1 day", "1 day")
    q = (agg.writeStream.outputMode("update").format("memory").queryName("dq_windows")
         .option("checkpointLocation", str(tmp_path / "ckpt2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.sql("SELECT window, max(rows) AS rows, max(`event_type__accepted_values`) AS bad "
                    "FROM dq_windows GROUP BY window")
    total_rows = got.agg(F.sum("rows")).first()[0]
    total_bad = got.agg(F.sum("bad")).first()[0]
    assert total_rows == ev.count()
    assert total_bad == ev.filter("event_type NOT IN ('click','view','purchase','signup')").count()


def test_replayed_batch_is_idempotent(spark, tmp_path):
    from tessera.streaming.checks import write_batch_results

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = str(tmp_path / "res")
    write_batch_results(ev, 0, CHECKS, out)
    write_batch_results(ev.limit(10), 1, CHECKS, out)
    write_batch_results(ev, 0, CHECKS, out)                 # batch 0 replayed after a failure
    res = spark.read.parquet(out)
    assert res.filter("batch_id = 0").count() == len(CHECKS)
    assert res.filter("batch_id = 1").count() == len(CHECKS)


def test_a_restart_keeps_the_results_of_earlier_batches(spark, tmp_path):
    ev, stream = _stream_dir(spark, tmp_path)
    out, ckpt = str(tmp_path / "results"), str(tmp_path / "ckpt")
    check_each_batch(stream, CHECKS, out, checkpoint_location=ckpt, trigger={"availableNow": True}).awaitTermination(120)
    ev.limit(20).coalesce(1).write.mode("append").parquet(str(tmp_path / "events_in"))
    check_each_batch(stream, CHECKS, out, checkpoint_location=ckpt, trigger={"availableNow": True}).awaitTermination(120)
    res = spark.read.parquet(out)
    assert sorted(r[0] for r in res.select("batch_id").distinct().collect()) == [0, 1, 2]
    assert res.count() == 3 * len(CHECKS)


def test_a_bad_check_does_not_stop_the_windowed_counts(spark, tmp_path):
    _, stream = _stream_dir(spark, tmp_path)
    agg = windowed_violation_counts(stream, [M.not_null("user_id"), M.not_null("no_such_column")], "ts", "1 day", "1 day")
    q = (agg.writeStream.outputMode("update").format("memory").queryName("dq_bad")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.sql("SELECT * FROM dq_bad").collect()
    assert rows and all(r["user_id__not_null"] == 0 and r["no_such_column__not_null"] is None for r in rows)
