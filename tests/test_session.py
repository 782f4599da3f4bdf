from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from fieldlens import session


def test_a_cluster_without_a_shared_folder_is_an_error():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: "hdfs:///shared/"), sparkContext=context)
    assert session.shared_dir(named) == "hdfs:///shared"


def test_a_scope_leaves_nothing_staged(spark):
    outside = session.stage(spark.range(3), "outside")
    with session.staging(spark):
        path = session.fresh_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
        assert session.stage(spark.range(5), "inside").count() == 5
        assert os.listdir(path)
    assert not os.path.exists(path) and outside.count() == 3


def test_a_kept_scope_goes_when_it_is_dropped(spark):
    with session.Scope(spark) as first, session.Scope(spark) as second:
        rows = session.stage(spark.range(4), "x")
    assert rows.count() == 4 and second.where.startswith(first.where)
    first.drop()
    assert not os.path.exists(first.where.removeprefix("file:"))
