"""Session helpers: shared checkpoint folder, shuffle sizing, UTC."""
from __future__ import annotations

from bankroll import session as S


def test_checkpoint_dir_comes_from_the_session(spark):
    conf = spark.conf.get("spark.checkpoint.dir", None)
    root = S.checkpoint_dir(spark)
    if conf:
        assert root == conf
    a, b = S.scratch_dir(spark, "x"), S.scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/bankroll/x-")


def test_shuffle_partitions_for():
    gib = 1024 ** 3
    assert S.shuffle_partitions_for(10 * gib, 8) == 40
    assert S.shuffle_partitions_for(1, 8) == 16
    assert S.shuffle_partitions_for(100 * 1024 * gib, 8000) == 409_600  # no cap: 256 MB each
    assert S.shuffle_partitions_for(0, 0) == 1


def test_checkpoint_dir_must_be_named_on_a_cluster(spark):
    from types import SimpleNamespace

    import pytest

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.checkpoint_dir(cluster)


def test_use_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    S.use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
