from types import SimpleNamespace

import pytest

from weftline.llm import common


def session(master, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        common.shared_dir(session("spark://host:7077"))
    assert common.shared_dir(session("spark://host:7077", "hdfs:/work/")) == "hdfs:/work"


def test_prefixes_that_no_column_starts_with():
    assert common.fresh(["a", "_MIX_size", "__mix"], "_mix") == "___mix"
    assert common.fresh([], "_mix") == "_mix"


def test_components_pass_over_nulls_loops_and_repeats(spark):
    edges = spark.createDataFrame([(3, 1), (1, 3), (3, 3), (None, 4), (5, None), (7, 3), (9, 8), (9, 8)], "a long, b long")
    assert sorted(map(tuple, common.connected_components(edges).collect())) == [(1, 1), (3, 1), (7, 1), (8, 8), (9, 8)]
    assert common.connected_components(edges.limit(0)).collect() == []


def test_stored_tables_go_when_dropped(spark):
    import os

    held = common.Stored(spark.range(3))
    path = held.path.removeprefix("file:")
    assert os.path.exists(path)
    held.drop()
    assert not os.path.exists(path)
