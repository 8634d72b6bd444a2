from mastline.session import parts_of, shared_split


def test_splits_grow_with_the_files(spark):
    assert shared_split(spark, []) == shared_split(spark, [20_000] * 30) == 4096
    for total in (1 << 29, 1 << 32):
        size = shared_split(spark, [total // 30] * 30)
        assert total / size <= 300 and size <= total // 60  # few tasks, yet several a file
    assert shared_split(spark, [1 << 40] * 30) == 256 << 20  # never more than the session's own


def test_many_small_files_are_still_shared(spark):
    assert shared_split(spark, [200_000] * 2000) == 100_000


def test_parts_follow_the_bytes(spark):
    assert parts_of(spark, 0) == 0
    assert parts_of(spark, 64 << 20) == 1 and parts_of(spark, (64 << 20) + 1) == 2
