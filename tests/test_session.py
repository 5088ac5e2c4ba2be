import os
from types import SimpleNamespace

import pytest

from conftest import rows
from quayside import session
from quayside.errors import QuaysideError


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def unnamed(master):
    conf = SimpleNamespace(get=lambda key, default: default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master))


def test_the_clusters_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    one, two = session.new_dir(spark, "x"), session.new_dir(spark, "x")
    assert one.startswith(f"{named}/x-") and one != two


def test_only_a_local_session_may_use_a_folder_of_its_own():
    local = unnamed("local[2]")
    assert os.path.isdir(session.shared_dir(local))
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(QuaysideError, match="spark.checkpoint.dir"):
        session.shared_dir(unnamed("yarn"))


def test_small_frames_are_local_relations(spark):
    df = session.small_frame(spark, [("a", None, 2**40)], "s string, b boolean, n bigint")
    assert rows(df) == [("a", None, 2**40)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert session.small_frame(spark, [], "s string").count() == 0


def test_json_lines_add_up(spark, tmp_path):
    folder = str(tmp_path / "notes")
    session.write_json_lines(spark, folder, [{"n": 1, "t": "a\nb"}, {"n": 2, "t": None}])
    session.write_json_lines(spark, folder, [{"n": 3, "t": "é"}])
    got = spark.read.schema("n int, t string").json(folder)
    assert rows(got) == [(1, "a\nb"), (2, None), (3, "é")]
    assert all(n.endswith(".json") for n in session.child_names(spark, folder))


def test_paths(spark, tmp_path):
    assert not session.path_exists(spark, str(tmp_path / "none"))
    assert session.child_names(spark, str(tmp_path / "none")) == []
    spark.range(1).write.parquet(str(tmp_path / "d"))
    assert session.delete_path(spark, str(tmp_path / "d"))
    assert not session.path_exists(spark, str(tmp_path / "d"))
