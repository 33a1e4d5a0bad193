from __future__ import annotations

from types import SimpleNamespace

import pytest

from cargolens import workspace


def session(master: str, configured: str | None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: configured or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_configured_folder_wins():
    assert workspace.shared_root(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_only_local_mode_may_use_a_temporary_folder():
    local = session("local[2]", None)
    assert workspace.shared_root(local) == workspace.shared_root(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(session("yarn", None))


def test_written_tables_keep_schema_and_can_be_discarded(spark, workspace_root):
    df = spark.sql("select cast(1 as decimal(12,2)) as m, timestamp_ntz'2018-01-31 22:56:00' as t, cast(null as string) as s")
    kept = workspace_root.materialize(df, "one")
    assert [f.dataType for f in kept.schema] == [f.dataType for f in df.schema]
    assert kept.collect() == df.collect()
    workspace_root.discard()
    with pytest.raises(Exception):
        workspace_root.spark.read.parquet(f"{workspace_root.root}/staging")


@pytest.fixture
def workspace_root(spark, tmp_path):
    return workspace.Workspace(spark, str(tmp_path / "w"))
