"""The shared working folder."""

from types import SimpleNamespace

import pytest

from eventmart.sources import scratch
from eventmart.sources.tables import path_exists


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_the_configured_folder_wins(spark):
    assert scratch.shared_folder(fake("spark://host", "s3a://bucket/tmp/")) == "s3a://bucket/tmp"
    assert scratch.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError):
        scratch.shared_folder(fake("yarn"))


def test_a_local_session_gets_one_of_its_own():
    assert scratch.shared_folder(fake("local[2]")) == scratch.shared_folder(fake("local[4]"))


def test_staged_tables_are_dropped(spark):
    with scratch.staged(spark.range(3).selectExpr("id", "CAST(NULL AS STRING) AS s"), "t") as table:
        (file,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        assert table.count() == 3 and table.columns == ["id", "s"]
    assert not path_exists(spark, file)
