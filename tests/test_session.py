import pytest

from tierline import files, session


def test_shuffle_count_is_raised_for_a_while(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tmp_path.joinpath("x").write_bytes(b"0" * 1000)
    assert session.wanted_shuffles(spark, str(tmp_path)) == int(before)
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", 100)
    with session.sized_shuffles(spark, str(tmp_path)) as count:
        assert count == 30 and spark.conf.get("spark.sql.shuffle.partitions") == "30"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", 0.03)
    assert session.wanted_shuffles(spark, str(tmp_path)) == 100_000


def test_scratch_paths_are_fresh_and_shared(spark):
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith(session.shared_dir(spark))


def test_files_appear_once(spark, tmp_path):
    path = f"{tmp_path}/a/b.json"
    files.publish_text(spark, path, "é")
    assert files.read_text(spark, path) == "é"
    with pytest.raises(FileExistsError):
        files.publish_text(spark, path, "other")
