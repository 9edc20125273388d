import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.maintenance import compact, storage_report, table_bytes
from tallyframe.session import scratch_path, scratch_root
from tallyframe.sources.tables import (
    Tables,
    append_rows,
    create_table,
    inline_rows,
    numbers,
    publish_view,
    tagged_numbers,
)
from tests.conftest import bag, rows


def test_tables_by_name(spark):
    tables = Tables(spark, "/root/testdata/sf0.001/", ["region", "nation"])
    assert len(tables) == 2 and list(tables) == ["region", "nation"]
    assert tables["region"].columns == ["r_regionkey", "r_name"]
    with pytest.raises(KeyError):
        tables["orders"]


def test_inline_rows_have_declared_types_and_known_size(spark):
    df = inline_rows(spark, [(1, None, dt.date(2020, 1, 1)), (2, "x", None)], "a int, b string, d date")
    assert df.dtypes == [("a", "int"), ("b", "string"), ("d", "date")]
    assert rows(df) == [(1, None, dt.date(2020, 1, 1)), (2, "x", None)]
    assert int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1_000


def test_generated_rows(spark):
    assert rows(numbers(spark, 1, 3)) == [(1,), (2,), (3,)]
    assert rows(tagged_numbers(numbers(spark, 9, 10), "x", "t")) == [("t9",), ("t10",)]


def test_create_fails_on_an_existing_table_and_append_casts(spark):
    path = scratch_path(spark, "create")
    table = create_table(inline_rows(spark, [(1, "a")], "n int, s string"), path)
    assert rows(table) == [(1, "a")]
    with pytest.raises(Exception, match="already exists"):
        create_table(table, path)
    more = append_rows(inline_rows(spark, [("b", 2)], "s string, n bigint"), path)
    assert bag(more) == [(1, "a"), (2, "b")] and more.dtypes[0] == ("n", "int")


def test_view(spark):
    publish_view(numbers(spark, 1, 4), "four_numbers")
    assert rows(spark.sql("SELECT count(*) FROM four_numbers")) == [(4,)]


def test_storage_report_and_compaction(spark):
    path, smaller = scratch_path(spark, "big"), scratch_path(spark, "small")
    create_table(tagged_numbers(numbers(spark, 1, 20_000), "x", "tag").repartition(6), path)
    before = storage_report(spark, {"made": path, "also": path}, like="%ad%").collect()
    assert [(r.table_name, r.files, r.row_count) for r in before] == [("made", 6, 20_000)]
    assert before[0].total_bytes == table_bytes(spark, path) > 0
    done = compact(spark, path, smaller)
    after = storage_report(spark, {"made": smaller}).first()
    assert (after.files, after.row_count) == (1, 20_000)
    assert done.exceptAll(spark.read.parquet(path)).count() == 0
    parted = scratch_path(spark, "parted")
    compact(spark, path, parted, file_bytes=before[0].total_bytes // 2)
    assert storage_report(spark, {"made": parted}).first().files <= 3


def test_scratch_folder_is_the_session_s_own(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (named or spark.sparkContext.getCheckpointDir() or scratch_root(spark))
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_empty_table_storage(spark):
    path = scratch_path(spark, "none")
    create_table(numbers(spark, 1, 5).filter(F.col("x") > 9), path)
    assert storage_report(spark, {"none": path}).first().row_count == 0
