"""Tables by month, deletes along foreign keys, and reports kept up by change sets."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.cascade import delete_cascade, parents_first
from tallyframe.operators.upkeep import Kept
from tallyframe.sources import partitions
from tallyframe.sources.definitions import ForeignKey, TableDef, social_tables
from tests.conftest import bag


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_month_is_replaced_and_the_others_keep_their_files(frame, spark, tmp_path):
    path = str(tmp_path / "payments")
    rows = frame("id int, day date, amount int", (1, dt.date(2017, 1, 5), 10), (2, dt.date(2017, 2, 1), 20), (3, dt.date(2017, 2, 28), 30), (4, None, 40))
    partitions.create_by_month(rows, path, "day")
    before = _files(path)
    batch = frame("id long, day date, amount int", (2, dt.date(2017, 2, 1), 21))
    for _ in range(2):
        found = partitions.reload_months(batch, path, "day")
        assert bag(found, "id", "amount") == [(1, 10), (2, 21), (4, 40)]
    after = _files(path)
    others = {f: t for f, t in before.items() if "2017-02" not in f}
    assert len(others) == 2 and others.items() <= after.items()
    assert partitions.reload_months(batch.limit(0), path, "day").count() == 3


def test_a_period_reads_only_its_months(frame, spark, tmp_path):
    path = str(tmp_path / "payments")
    rows = frame("id int, day date", *[(m, dt.date(2017, m, 15)) for m in range(1, 13)])
    table = partitions.create_by_month(rows, path, "day")
    quarter = table.filter(partitions.within("day", dt.date(2017, 4, 1), dt.date(2017, 7, 1)))
    assert bag(quarter, "id") == [(4,), (5,), (6,)]
    plan = quarter._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert len(quarter.select(F.input_file_name()).distinct().collect()) == 3
    assert table.filter(partitions.within("day", None, None)).count() == 0


def test_removed_users_empty_their_grandchildren(frame):
    definitions = [
        TableDef("post", (), ("post_id",), foreign_keys=(ForeignKey(("user_id",), "user", ("user_id",)),)),
        TableDef("like", (), ("like_id",), foreign_keys=(ForeignKey(("post_id",), "post", ("post_id",)), ForeignKey(("user_id",), "user", ("user_id",)))),
        TableDef("follow", (), ("a", "b"), foreign_keys=(ForeignKey(("a",), "user", ("user_id",)), ForeignKey(("b",), "user", ("user_id",)))),
        TableDef("user", (), ("user_id",)),
        TableDef("other", (), ("id",)),
    ]
    tables = {
        "user": frame("user_id int", (1,), (2,), (3,)),
        "post": frame("post_id int, user_id int", (10, 1), (20, 2), (30, None)),
        "like": frame("like_id int, post_id int, user_id int", (1, 10, 2), (2, 20, 1), (3, 20, 3), (4, 30, None)),
        "follow": frame("a int, b int", (1, 2), (2, 1), (2, 3)),
        "other": frame("id int", (1,)),
    }
    changed = delete_cascade(tables, definitions, "user", frame("user_id int", (1,), (9,), (1,)))
    assert "other" not in changed and list(changed)[-1] == "user"
    assert bag(changed["user"].table) == [(2,), (3,)]
    assert bag(changed["post"].table, "post_id") == [(20,), (30,)]
    assert bag(changed["like"].table, "like_id") == [(3,), (4,)]
    assert bag(changed["like"].rows, "like_id") == [(1,), (2,)]
    assert bag(changed["follow"].table) == [(2, 3)]


def test_rows_below_a_removed_row_of_the_same_table_go(frame):
    definition = TableDef("staff", (), ("id",), foreign_keys=(ForeignKey(("boss",), "staff", ("id",)),))
    staff = frame("id int, boss int", (1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 7), (7, 6))
    changed = delete_cascade({"staff": staff}, [definition], "staff", frame("id int", (2,), (6,)))
    assert bag(changed["staff"].table, "id") == [(1,), (5,)]
    assert bag(changed["staff"].rows, "id") == [(2,), (3,), (4,), (6,), (7,)]


def test_the_schema_has_an_order_and_a_cycle_has_none():
    names = [d.name for d in parents_first(list(reversed(social_tables().values())))]
    for d in social_tables().values():
        assert all(names.index(k.parent) < names.index(d.name) for k in d.foreign_keys if k.parent != d.name)
    one = TableDef("a", (), foreign_keys=(ForeignKey(("x",), "b", ("x",)),))
    two = TableDef("b", (), foreign_keys=(ForeignKey(("x",), "a", ("x",)),))
    with pytest.raises(ValueError, match="cycle"):
        parents_first([one, two])


def test_a_state_brought_forward_equals_the_full_report(frame):
    schema = "g string, v int, day int"
    before = [("a", 1, 5), ("a", 2, 9), ("b", 3, 1), (None, 4, 2), (None, 5, 8), ("c", None, 3)]
    removed = [("a", 2, 9), ("b", 3, 1), (None, 5, 8)]
    inserted = [("a", 7, 6), ("d", 8, 1), ("c", None, 1)]
    after = [r for r in before if r not in removed] + inserted
    report = Kept(("g",), sums=("v",), largest=("day",))
    state = report.state(frame(schema, *before))
    found = report.apply(state, frame(schema, *inserted), frame(schema, *removed), frame(schema, *after))
    assert found.columns == state.columns and found.dtypes == state.dtypes
    assert bag(found) == bag(report.state(frame(schema, *after)))
    empty = frame(schema)
    assert bag(report.apply(state, empty, empty, frame(schema, *before))) == bag(state)
    with pytest.raises(ValueError):
        report.apply(state, empty, empty)


def test_sums_are_brought_forward_without_the_table(frame, spark, tmp_path):
    path = str(tmp_path / "base")
    frame("g int, v int", (1, 10), (2, 20)).write.parquet(path)
    base = spark.read.parquet(path)
    report = Kept(("g",), sums=("v",))
    report.state(base).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    found = report.apply(state, frame("g int, v int", (1, 5)), frame("g int, v int", (2, 20)))
    assert bag(found) == [(1, 2, 15, 2)]
    assert path not in found._jdf.queryExecution().executedPlan().toString()
