"""Cluster sizing helpers."""

from ledgerline.session import (PARTITION_BYTES, input_bytes,
                                shuffle_partitions_for, size_for_input)

TB = 1024 ** 4


def test_shuffle_width_follows_input_size():
    assert shuffle_partitions_for(10 * 1024 ** 2, parallelism=8) == 16  # floor: two tasks per core
    mid = shuffle_partitions_for(TB, parallelism=8000)
    assert mid == 16000  # floor of 2 per core dominates 12,288 ~256 MB partitions
    assert shuffle_partitions_for(10 * TB, parallelism=800) == -(-int(10 * TB * 3.0) // PARTITION_BYTES)
    assert shuffle_partitions_for(100 * TB, parallelism=8000) == -(-int(100 * TB * 3.0) // PARTITION_BYTES)


def test_input_bytes_is_the_size_on_storage(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"y" * 234)
    assert input_bytes(spark, [str(tmp_path)]) == 1234


def test_size_for_input_leaves_local_sessions_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_for_input(spark, ["/root/testdata/sf0.001"]) == {}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_path_exists_goes_through_the_file_system(spark, tmp_path):
    from ledgerline.session import path_exists
    assert path_exists(spark, str(tmp_path))
    assert path_exists(spark, f"file:{tmp_path}")
    assert not path_exists(spark, str(tmp_path / "missing"))
