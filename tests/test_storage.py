"""Intermediate tables go to the shared folder that the session names."""

from types import SimpleNamespace

import pytest

from remitscope.storage import shared_folder, written


def test_written_table_lies_in_the_shared_folder(spark):
    df = spark.range(3).selectExpr("id", "id % 2 = 0 AS even")
    again = written(df, "numbers")
    [path, *_] = again.inputFiles()
    assert spark.conf.get("spark.checkpoint.dir") in path
    assert again.dtypes == df.dtypes and sorted(again.collect()) == sorted(df.collect())


class Conf:
    def get(self, name, default=None):
        return default


def test_cluster_must_name_a_shared_folder():
    context = SimpleNamespace(master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=Conf(), sparkContext=context))


def test_local_session_gets_a_folder_of_its_own():
    context = SimpleNamespace(master="local[2]")
    assert "remitscope-" in shared_folder(SimpleNamespace(conf=Conf(), sparkContext=context))
