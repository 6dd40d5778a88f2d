"""Session settings and the folder for intermediate tables."""

import os
from types import SimpleNamespace

import pytest

from conftest import records
from mostrador.session import SHUFFLE_CLEANUP, intermediate, prepare, settle, shared_folder


def fake(master="local[2]", chosen=None, **conf):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: chosen)
    context.setCheckpointDir = lambda folder: setattr(context, "getCheckpointDir", lambda: folder)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_shared_folder_is_the_one_the_context_was_given():
    assert shared_folder(fake(chosen="hdfs://a/b")) == "hdfs://a/b"
    assert shared_folder(fake(chosen="hdfs://a/b", **{"spark.checkpoint.dir": "s3a://c"})) == "s3a://c"


def test_shared_folder_without_a_setting():
    for master in ("local[2]", "spark://host:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(fake(master))


def test_only_local_runs_are_prepared():
    local = prepare(fake())
    assert shared_folder(local) == shared_folder(prepare(local))
    with pytest.raises(RuntimeError):
        shared_folder(prepare(fake("yarn")))


def test_intermediate_tables_are_deleted(spark, frame):
    df = frame("a INT", (1,), (2,))
    kept = settle(df, "kept")
    with intermediate(spark) as paths:
        assert settle(settle(df, "one"), "two").count() == 2
        assert len(paths) == 2 and all(os.path.isdir(p) for p in paths)
    assert not any(os.path.exists(p) for p in paths) and kept.count() == 2


def test_settle_restores_the_setting(spark, frame):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    settle(frame("a INT", (1,)), "x")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_settle_keeps_rows_and_schema(spark, frame):
    df = frame("a INT, b DECIMAL(22,6), c DATE", (1, None, None), (2, None, None)).repartition(2)
    again = settle(df, "test")
    assert again.schema == df.schema and sorted(records(again, "a")) == [1, 2]
    assert shared_folder(spark) in again.inputFiles()[0]
    assert settle(df.where("a > 5"), "test").count() == 0


def test_utc_and_ansi(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
