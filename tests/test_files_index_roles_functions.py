"""Changes by file, loads by key index, all roles in one pass, and SQL table functions."""

import os

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import policy
from tallyframe.operators.key_index import KeyIndex
from tallyframe.operators.trigram_index import TrigramIndex, literal_runs
from tallyframe.plans import film_rental as fr
from tallyframe.sources.file_tables import FileTable
from tests.conftest import bag, rows
from tests.films import film_tables


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def clustered(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v"), F.when(F.col("id") % 10 > 0, "x").alias("s"))
    return FileTable.create(df.repartitionByRange(10, "id"), str(tmp_path / "a table"))


def test_an_update_rewrites_only_the_files_it_touches(clustered, spark):
    before = _files(clustered.path)
    change = clustered.update_where({"v": F.col("v") + 100}, where=F.col("id").between(300, 309), unless=F.col("v") >= 100)
    gone, new = set(clustered.files) - set(change.table.files), set(change.table.files) - set(clustered.files)
    assert len(clustered.files) == 10 and 1 <= len(gone) <= 2 and new
    after = _files(clustered.path)
    assert before.items() <= after.items()
    assert bag(change.rows, "id", "v") == [(k, k % 7 + 100) for k in range(300, 310)]
    assert bag(change.before, "id", "v") == [(k, k % 7) for k in range(300, 310)]
    assert bag(change.table.read()) == sorted(((k, k % 7 + 100 * (300 <= k < 310), "x" if k % 10 else None) for k in range(1000)), key=str)
    # Every version stays, and a second run finds nothing to do.
    again = change.table.update_where({"v": F.col("v") + 100}, where=F.col("id").between(300, 309), unless=F.col("v") >= 100)
    assert again.table is change.table and again.rows.count() == 0
    assert FileTable.open(spark, clustered.path).version == 1
    assert FileTable.open(spark, clustered.path, 0).read().agg(F.max("v")).first()[0] == 6
    with pytest.raises(ValueError, match="no version"):
        FileTable.open(spark, clustered.path, 9)


def test_a_delete_by_keys_and_by_condition(clustered, frame):
    keys = frame("k long", (5,), (5,), (None,), (2000,), (999,))
    change = clustered.delete_where(keys=keys, on=[("id", "k")])
    assert len(set(clustered.files) - set(change.table.files)) == 2
    assert bag(change.rows, "id") == bag(change.before, "id") == [(5,), (999,)]
    assert change.table.read().count() == 998
    # An unknown condition keeps the row; a file without rows left goes.
    rest = change.table.delete_where(where=F.col("s") == "x").table
    assert bag(rest.read().select("s").distinct()) == [(None,)] and rest.read().count() == 100
    empty = rest.delete_where(where=F.col("s").isNull()).table
    assert empty.files == {} and empty.read().columns == ["id", "v", "s"] and empty.read().count() == 0
    with pytest.raises(ValueError, match="either"):
        clustered.delete_where()


def test_two_writers_from_one_version(clustered, frame):
    rows_ = frame("id long, other string", (1000, "z"))
    first = clustered.append(rows_)
    assert bag(first.read().filter("id >= 1000")) == [(1000, None, None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        clustered.append(rows_)


def test_a_new_column_rewrites_no_file(clustered, frame, spark):
    files = _files(f"{clustered.path}/data")
    wider = clustered.add_column("day", "date", "2020-01-02").add_column("n", "int")
    assert _files(f"{clustered.path}/data") == files
    assert rows(wider.read().groupBy("day", "n").count().selectExpr("string(day)", "n", "count")) == [("2020-01-02", None, 1000)]
    more = wider.append(frame("id long, day date, n int", (1000, None, 3)))
    opened = FileTable.open(spark, more.path)
    assert bag(opened.read().groupBy("day", "n").count().selectExpr("string(day)", "n", "count")) == [("2020-01-02", None, 1000), (None, 3, 1)]
    # Rows of an old file that is rewritten keep the default they had.
    changed = opened.update_where({"n": F.lit(1)}, where=F.col("id") == 7)
    assert bag(changed.rows.selectExpr("id", "string(day)", "n")) == [(7, "2020-01-02", 1)]
    assert changed.table.read().where("day = date'2020-01-02'").count() == 1000
    with pytest.raises(ValueError, match="exists"):
        opened.add_column("n", "int")


def test_loads_meet_the_index_where_it_lies(spark, frame, tmp_path):
    target = frame("a string, b int", ("X", 1), ("x", 1), ("y", None), ("z", 3))
    index = KeyIndex.create(target, ["a", "b"], "test_keys", str(tmp_path / "keys"), 4, fold=[("a", "lower")])
    try:
        assert index.count() == 2
        batch = frame("a string, b int, c int", ("X", 1, 1), ("x", 2, 2), ("Y", None, 3), ("y", None, 4), ("Z", 3, 5), ("n", 9, 6), ("n", 9, 7))
        fresh = index.new_rows(batch)
        assert bag(fresh, "c") == [(2,), (3,), (4,), (6,), (7,)]
        index.add(fresh)
        assert index.count() == 4
        index.add(fresh)
        assert index.count() == 4
        assert bag(index.new_rows(batch), "c") == [(3,), (4,)]
        assert index.new_rows(batch.limit(0)).count() == 0
    finally:
        index.drop()


def test_the_index_is_not_shuffled(spark, tmp_path, no_broadcast):
    index = KeyIndex.create(spark.range(1000), ["id"], "test_long_keys", str(tmp_path / "keys"), 4)
    try:
        batch = spark.range(900, 1100)
        plan = index.new_rows(batch)._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "test_long_keys" in line)
        lines = plan.splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        above, at = [], depth(scan)
        for line in reversed(lines[: lines.index(scan)]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
            if "SortMergeJoin" in line and above and above[-1] == line:
                break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above)
        assert bag(index.new_rows(batch)) == [(k,) for k in range(1000, 1100)]
    finally:
        index.drop()


def test_roles_of_all_rows_equal_role_by_role(frame):
    table = frame("id int, k int", (1, 1), (2, 1), (3, 2), (4, 3), (5, None))
    policies = frame("role string, k int", ("a", 1), ("a", 1), ("b", 1), ("b", 2), (None, 3), ("c", None), ("d", 9))
    tagged = policy.with_roles(table, policies, "k")
    assert bag(tagged.select("id", F.concat_ws(",", "roles"))) == [(1, "a,b"), (2, "a,b"), (3, "b"), (4, ""), (5, "")]
    for role in "abcdz":
        assert bag(tagged.filter(F.array_contains("roles", role)), "id") == bag(policy.visible_rows(table, policies, role, "k"), "id")
    assert bag(policy.with_roles(table, policies.limit(0), "k").filter(F.size("roles") > 0)) == []


def test_rows_by_role_counts_from_one_scan(frame):
    first, second = frame("id int, k int", (1, 1), (2, 1), (3, 2), (5, None)), frame("name string", ("1",), ("2",), ("2",))
    policies = frame("table_name string, role string, key int", ("first", "a", 1), ("first", "a", 1), ("first", "b", 2), ("second", "b", 2), ("second", None, 1), ("third", "q", 1))
    found = policy.rows_by_role({"first": (first, "k"), "second": (second, "name")}, policies, frame("role string", ("z",), ("a",), (None,)))
    want = {("first", "a"): 2, ("first", "b"): 1, ("second", "b"): 2}
    assert bag(found) == sorted(((t, r, want.get((t, r), 0)) for t in ("first", "second") for r in "abqz"), key=str)


def test_popular_function_from_sql(spark):
    t = film_tables(spark)
    fr.publish_popular_function(t)
    listed = ["Brazil", "Peru", "Chile", None, "brazil"]
    found = bag(spark.sql("SELECT * FROM tallyframe_most_popular(array('Brazil', 'Peru', 'Chile', NULL, 'brazil', 'Peru'))"))
    assert found == bag(fr.most_popular_films(t, listed)) and len(found) == 3
    spark.createDataFrame([(1, ["Peru"]), (2, ["Peru", "Brazil"]), (3, ["Atlantis"])], "id int, l array<string>").createOrReplaceTempView("test_lists")
    lateral = spark.sql("SELECT id, film FROM test_lists, LATERAL tallyframe_most_popular(l)")
    assert bag(lateral) == [(1, "All Out LOVE"), (1, "Gamma"), (2, "All Out LOVE"), (2, "Alpha Love"), (2, "Gamma")]
    for empty in ("NULL", "CAST(array() AS ARRAY<STRING>)"):
        with pytest.raises(Exception, match="Country list cannot be NULL or empty"):
            spark.sql(f"SELECT * FROM tallyframe_most_popular({empty})").collect()


def test_stock_function_from_sql(spark):
    t = film_tables(spark)
    fr.publish_stock_function(t)
    for pattern in ("%love%", "b_ta%", "%nowhere%", "%"):
        found = bag(spark.sql(f"SELECT * FROM tallyframe_in_stock('{pattern}')"))
        with pytest.warns(UserWarning) if pattern == "%nowhere%" else __import__("contextlib").nullcontext():
            assert found == bag(fr.films_in_stock(t, pattern).drop("row_num"))
    assert rows(spark.sql("SELECT * FROM tallyframe_in_stock(NULL)")) == []


def test_stock_pattern_reaches_every_scan_of_the_films(spark, no_broadcast, tmp_path):
    t = film_tables(spark)
    t["film"].write.parquet(str(tmp_path / "film"))
    fr.publish_stock_function(t | {"film": spark.read.parquet(str(tmp_path / "film"))})
    found = spark.sql("SELECT * FROM tallyframe_in_stock('%love%')")
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    films = [k for k, line in enumerate(plan) if "Relation [film_id#" in line]
    assert films and all("Contains(lower(title#" in plan[k - 1] for k in films)
    assert len(rows(found)) == 3


def test_stock_of_films_that_share_a_key_and_of_copies_without_one(spark, frame):
    t = film_tables(spark)
    twice = t["film"].filter("film_id = 1").withColumn("title", F.lit("Twin Love"))
    lost = t["inventory"].filter("inventory_id = 60").withColumn("inventory_id", F.lit(None).cast(dict(t["inventory"].dtypes)["inventory_id"]))
    one = bag(fr.films_in_stock(t, "%love%").drop("row_num"))
    both = bag(fr.films_in_stock(t | {"film": t["film"].union(twice)}, "%love%").drop("row_num"))
    own = bag(fr.films_in_stock(t | {"film": twice}, "%love%").drop("row_num"))
    assert own and both == sorted(one + own, key=str)
    film = t["film"].filter("film_id = 6").first().title
    assert [r.film_title for r in fr.films_in_stock(t | {"inventory": t["inventory"].union(lost)}, "%").collect()].count(film) == 1
    assert film not in [r.film_title for r in fr.films_in_stock(t, "%").collect()]


def test_pattern_search_equals_a_scan(frame, tmp_path):
    titles = ["Alpha Love", "all out LOVE", "100% sure_thing", "100 sure thing", "a\\b slash", "Straße İstanbul", "ab", "", None, "Alpha Love", "xlovex love", "ΟΔΟΣ ΜΟΥ", "K2 kelvin \u212a2"]
    table = frame("id int, title string", *enumerate(titles))
    index = TrigramIndex.create(table, "title", str(tmp_path / "index"))
    patterns = ["%love%", "%LOVE", "Alpha%", "a%", "%ab%", "", "%", "__", "%100\\%%", "%sure\\_t%", "%sure_t%", "%a\\\\b%", "%nowhere%", "%STRASSE%", "%straße%", "%İST%", "%οδοσ%", "%ΟΔΟΣ%", "%l_ve%out%", "%k2 k%", "love%love"]
    for pattern in patterns:
        assert bag(index.ilike(pattern)) == bag(table.filter(F.col("title").ilike(pattern))), pattern
    assert literal_runs("a\\%b%c_\\\\d") == ["a%b", "c", "\\d"]


def test_pattern_search_reads_the_files_of_candidates(spark, tmp_path):
    table = spark.range(0, 4000, 1, 8).select("id", F.concat(F.lit("title "), F.when(F.col("id") == 3210, "quixotic").otherwise("plain"), F.lit(" one")).alias("title"))
    index = TrigramIndex.create(table, "title", str(tmp_path / "index"))
    found = index.ilike("%QUIXOTIC%")
    assert bag(found.select("id")) == [(3210,)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("file_path") and plan.count(".parquet") == 1
    assert index.ilike("%plain one").count() == 3999
