from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from salescast import session
from salescast.session import discard, materialize, release, scratch_path, shared_folder


made = []


def stub(master, named=None):
    """As much of a session as ``shared_folder`` looks at."""
    context = SimpleNamespace(master=master, folder=None, applicationId=f"app-{master}-{named}-{len(made)}")
    made.append(context)
    context.getCheckpointDir = lambda: context.folder and f"{context.folder}/a-folder-of-spark"
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    return SimpleNamespace(conf={} if named is None else {"spark.checkpoint.dir": named}, sparkContext=context)


def test_shared_folder_is_the_named_one():
    session = stub("spark://cluster", "hdfs://shared/folder")
    assert shared_folder(session) == "hdfs://shared/folder" == session.sparkContext.folder


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(stub("spark://cluster"))


def test_local_session_gets_its_own_folder_once():
    session = stub("local[2]")
    folder = shared_folder(session)
    assert Path(folder).exists() and shared_folder(session) == folder


def test_materialized_tables_are_released(spark):
    table = materialize(spark.range(10), "numbers")
    assert table.count() == 10
    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    assert folder.exists()
    release(spark)
    assert not folder.exists()


def test_one_folder_for_all_tables(spark):
    """Spark's own answer for the checkpoint folder changes once it is set; ours does not."""
    first = scratch_path(spark, "a")
    spark.range(1).write.parquet(first)
    second = scratch_path(spark, "b")
    assert Path(first).parent == Path(second).parent and shared_folder(spark) == shared_folder(spark)
    release(spark)
    assert not Path(first.removeprefix("file:")).exists()


def test_empty_table_keeps_its_schema(spark):
    table = materialize(spark.range(10).where("id > 100").selectExpr("id", "'a' as name"), "nothing")
    assert table.count() == 0 and table.columns == ["id", "name"]


def test_discarded_tables_leave_those_made_from_them(spark):
    first = materialize(spark.range(10), "first")
    second = materialize(first.where("id > 6"), "second")
    folder = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    here = len(list(folder.glob("first-*")))
    discard(first, second.where("id > 8"))  # the second is not a written table and stays
    assert len(list(folder.glob("first-*"))) == here - 1 and second.count() == 3
    discard(first)


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), session.shuffles_deleted(spark):
        assert spark.conf.get(name) == "true"
        assert session.materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "few").count() == 7
        raise ZeroDivisionError
    assert spark.conf.get(name) == before
