import os

import pytest

from candlewick.workspace import clean_up, new_folder, temporary_tables, written


def test_the_shared_folder_of_the_session_is_used(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or new_folder(spark, "x").startswith(before)
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_written_tables_keep_rows_and_types(spark):
    df = spark.range(10).selectExpr("id", "cast(id as decimal(18,4)) d", "timestamp_ntz'2024-01-01 00:00:00' t")
    back = written(df, "test")
    assert back.dtypes == df.dtypes and back.count() == 10
    assert "FileScan parquet" in back._jdf.queryExecution().executedPlan().toString()


def test_temporary_tables_go_on_success_and_stay_on_failure(spark):
    with temporary_tables(spark, "test") as kept_as:
        done = kept_as(spark.range(3), "a").inputFiles()[0].removeprefix("file:")
        assert os.path.exists(done)
    assert not os.path.exists(done)
    with pytest.raises(ZeroDivisionError), temporary_tables(spark, "test") as kept_as:
        left = kept_as(spark.range(3), "a").inputFiles()[0].removeprefix("file:")
        1 / 0
    assert os.path.exists(left)


def test_clean_up_removes_only_what_was_made_here(spark, tmp_path):
    made = written(spark.range(3), "test").inputFiles()[0].removeprefix("file:")
    other = tmp_path / "other"
    spark.range(3).write.parquet(str(other))
    kept = os.path.dirname(os.path.dirname(os.path.dirname(made)))
    clean_up(spark)
    assert not os.path.exists(made) and os.path.exists(kept) and other.exists()
