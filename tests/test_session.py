"""Where durable intermediate data goes."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallymark import session


class FakeSession:
    """Just what ``shared_folder`` asks a session for."""

    def __init__(self, master, configured=None):
        self.folders = []
        self.conf = SimpleNamespace(get=lambda name, default=None: configured or default)
        self.sparkContext = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: self.folders[-1] if self.folders else None,
            setCheckpointDir=self.folders.append,
        )


def test_configured_folder_is_used():
    fake = FakeSession("spark://cluster:7077", "hdfs://cluster/checkpoints/")
    assert session.shared_folder(fake) == "hdfs://cluster/checkpoints"
    assert fake.folders == ["hdfs://cluster/checkpoints/"]


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("spark://cluster:7077"))


def test_local_session_may_use_a_temporary_folder():
    fake = FakeSession("local[2]")
    assert session.shared_folder(fake) == session.shared_folder(fake) == fake.folders[0]


def test_paths_are_never_shared_between_runs():
    fake = FakeSession("local[2]", "/shared")
    paths = {session.new_table_path(fake, "x") for _ in range(10)}
    assert len(paths) == 10 and all(path.startswith("/shared/tallymark/x-") for path in paths)


def test_intermediate_tables_can_be_discarded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_given", [])
    monkeypatch.setattr(session, "shared_folder", lambda _: f"file://{tmp_path}")
    kept = tmp_path / "tallymark" / "other"
    kept.mkdir(parents=True)
    frames = [session.frozen(spark.range(3), "a"), session.frozen(spark.range(4), "b")]
    session.new_table_path(spark, "never written")
    assert [f.count() for f in frames] == [3, 4]
    assert session.discard_tables(spark) == 2 and session.discard_tables(spark) == 0
    assert list((tmp_path / "tallymark").iterdir()) == [kept]


def test_settings_reach_the_session(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
