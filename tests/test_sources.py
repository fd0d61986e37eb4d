"""Sources and sinks: pruning, CSV schemas, CTAS writes, lineage cuts."""

import pytest

from tessera.sources.csv import scan_csv, write_csv
from tessera.sources.sinks import materialize, scratch_path, write_table
from tessera.sources.tables import scan_table

from conftest import SF_SMALL


def test_scan_table_prunes_columns(spark):
    df = scan_table(spark, f"{SF_SMALL}/lineitem.parquet", ["l_orderkey", "l_quantity"])
    assert df.columns == ["l_orderkey", "l_quantity"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_csv_explicit_schema_vs_inference(spark, tmp_path):
    path = write_csv(spark.createDataFrame([(1, None, 2.5)], "a bigint, b string, c double"), str(tmp_path / "t"))
    typed = scan_csv(spark, path, schema="a bigint, b string, c double")
    assert typed.schema.simpleString() == "struct<a:bigint,b:string,c:double>"
    assert typed.first()["b"] is None                        # empty field reads as NULL
    inferred = scan_csv(spark, path)
    assert inferred.schema["a"].dataType.simpleString() == "int"   # why an explicit schema is preferred


def test_write_table_dynamic_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "by_month")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string"), path, partition_by=["m"])
    write_table(spark.createDataFrame([(2, "c")], "m int, v string"), path, partition_by=["m"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("m", "v").collect())
    assert got == [(1, "a"), (2, "c")]                        # only month 2 was replaced


def test_materialize_under_checkpoint_dir(spark):
    from tessera.session import checkpoint_dir

    df = spark.range(5)
    m = materialize(df, "unit")
    assert m.count() == 5
    assert all(f.startswith("file:" + checkpoint_dir(spark)) or checkpoint_dir(spark) in f for f in m.inputFiles())
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))


def test_checkpoint_dir_required_on_cluster_masters():
    from tessera.session import ensure_checkpoint_dir

    class _Conf:
        def get(self, key, default=None):
            return None

        def set(self, key, value):
            raise AssertionError("must not set a local folder on a cluster")

    class _Ctx:
        master = "yarn"

    class _Session:
        conf = _Conf()
        sparkContext = _Ctx()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session())


def test_scratch_is_dropped_on_request(spark):
    from tessera.sources.sinks import drop_path, drop_scratch, materialize

    drop_scratch(spark)
    df = materialize(spark.range(5).toDF("id"), "dropped")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 5 and drop_scratch(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError, match="checkpoint"):
        drop_path(spark, "/elsewhere/table")
