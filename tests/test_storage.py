"""Where stage tables go."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from ledgerlark import catalog, storage
from ledgerlark.storage import read_kept, shared_folder, write_kept, write_once


class _Context:
    applicationId = "app-1"

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def _session(master, named=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default: named or default)
    return SimpleNamespace(conf=conf, sparkContext=_Context(master, folder))


def test_folder_named_by_the_session_wins():
    assert shared_folder(_session("spark://x", "hdfs:///c/", "/other")) == "hdfs:///c/ledgerlark/app-1"


def test_checkpoint_folder_of_the_context_is_used():
    assert shared_folder(_session("spark://x", None, "s3a://b/c")) == "s3a://b/c/ledgerlark/app-1"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("spark://x"))


def test_temporary_folder_in_local_mode():
    session = _session("local[2]")
    assert shared_folder(session).startswith(session.sparkContext.folder)


def test_kept_tables(spark):
    path = f"{shared_folder(spark)}/test-kept"
    assert read_kept(spark, path + "-missing", "a") is None
    assert write_kept(spark.range(100).repartition(4), path, "a").count() == 100
    kept = read_kept(spark, path, "a")
    assert kept.count() == 100 and kept.columns == ["id"]
    assert read_kept(spark, path, "b") is None


def test_unfinished_tables_do_not_count(spark):
    path = f"{shared_folder(spark)}/test-unfinished"
    write_once(spark.range(100), path)
    assert read_kept(spark, path, "a") is None  # the manifest comes last
    write_kept(spark.range(100).repartition(4), path, "a")
    folder = Path(path.removeprefix("file:"))
    next(folder.glob("part-*.parquet")).unlink()
    (folder / "_SUCCESS").unlink()
    assert read_kept(spark, path, "a") is None


def test_stages_read_little_per_task_and_the_session_keeps_its_sizes(spark, monkeypatch):
    keys, seen = list(storage.TASK_BYTES), []
    before = [spark.conf.get(key) for key in keys]

    def result(w):
        seen.append([spark.conf.get(key) for key in keys])
        return w.raw

    monkeypatch.setitem(catalog.RESULTS, "trial", result)
    catalog.run("trial", spark, "/root/testdata/sf0.001")
    assert seen == [["33554432b", "16777216b"]] and [spark.conf.get(key) for key in keys] == before
    with pytest.raises(ZeroDivisionError), storage.small_tasks(spark):
        1 / 0
    assert [spark.conf.get(key) for key in keys] == before
    assert [storage._bytes(size) for size in ("7", "5b", "64MB", "2k", "1 g")] == [7, 5, 64 << 20, 2048, 1 << 30]
