from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from tidemark.workspace import Folder, fresh_folder, passing_folders, written


def test_folders_of_a_block_are_removed_and_no_others(spark):
    with ThreadPoolExecutor(1) as other:
        before = written(spark.range(1), fresh_folder(spark, "before"))
        with passing_folders(spark):
            theirs = other.submit(fresh_folder, spark, "theirs").result()
            table = written(spark.range(2), theirs)
            mine = fresh_folder(spark, "mine")
            with passing_folders(spark):
                inner = fresh_folder(spark, "inner")
                written(spark.range(3), inner)
            assert not Folder(spark, inner).has()
            assert written(spark.range(4), mine).count() == 4
        assert not Folder(spark, mine).has()
    assert table.count() == 2 and before.count() == 1
