"""Where shared frames are written, and the sinks."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from riskloom.sources import store as S


def session(setting, checkpoint_dir, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: setting or default), sparkContext=context)


def test_the_named_folder_comes_first():
    assert S.shared_root(session("hdfs://shared/ck", "/other", "spark://host:7077")) == "hdfs://shared/ck"
    assert S.shared_root(session(None, "hdfs://set/earlier", "spark://host:7077")) == "hdfs://set/earlier"


def test_a_cluster_never_uses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_root(session(None, None, "spark://host:7077"))


def test_materialised_frames_are_read_back(spark):
    df = spark.range(100).select("id", (F.col("id") * 2.0).alias("x"))
    stored = S.materialise(df)
    assert stored.dtypes == df.dtypes and {tuple(r) for r in stored.collect()} == {tuple(r) for r in df.collect()}
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_append_creates_then_extends(spark):
    path = S.scratch_path(spark, "answers")
    for _ in range(2):
        S.append_results(spark.range(3), path)
    assert spark.read.parquet(path).count() == 6
    assert S.path_exists(spark, path) and not S.path_exists(spark, path + "-absent")


def test_a_scope_removes_what_was_written_inside(spark):
    with S.scratch_scope(spark):
        S.materialise(spark.range(5)).count()
        inside = S.scratch_path(spark, "left")
        S.append_results(spark.range(1), inside)
    outside = S.scratch_path(spark, "kept")
    S.append_results(spark.range(1), outside)
    assert not S.path_exists(spark, inside) and S.path_exists(spark, outside)


def test_a_local_session_without_a_setting_writes_into_its_warehouse():
    local = session(None, None, "local[4]")
    local.conf.get = lambda key, default=None: "file:/w/house/" if key == "spark.sql.warehouse.dir" else default
    assert S.shared_root(local) == "file:/w/house/_riskloom_scratch"
