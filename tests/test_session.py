"""Where staged tables go with and without a checkpoint folder."""

from types import SimpleNamespace

import pytest

from helioframe.session import checkpoint_root


def pretended(master: str, settings: dict[str, str]) -> SimpleNamespace:
    chosen = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: chosen[-1] if chosen else None, setCheckpointDir=chosen.append
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, *other: settings.get(key, *other)))


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(pretended("spark://host:7077", {"spark.sql.warehouse.dir": "file:/here"}))
    named = pretended("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert checkpoint_root(named) == "hdfs:///shared"


def test_local_mode_stages_below_the_warehouse():
    assert checkpoint_root(pretended("local[2]", {"spark.sql.warehouse.dir": "file:/here/"})) == "file:/here/_scratch"
