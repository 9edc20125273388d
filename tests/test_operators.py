import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.labels import label
from tallyframe.functions.ordering import sort_keys
from tallyframe.functions.periods import in_quarter_of, quarter_bounds, within, year_bounds
from tallyframe.functions.text import is_blank, joined_label, mail_domain, readable_size, tag_number, tagged
from tallyframe.operators import joins
from tallyframe.operators.numbering import number_rows
from tallyframe.operators.policy import visible_rows
from tallyframe.operators.rollup import Hop, Measure, roll_up
from tests.conftest import bag, rows


def test_quarter_bounds():
    assert quarter_bounds(dt.date(2017, 2, 9)) == (dt.date(2017, 1, 1), dt.date(2017, 4, 1))
    assert quarter_bounds(dt.date(2017, 12, 31)) == (dt.date(2017, 10, 1), dt.date(2018, 1, 1))
    assert quarter_bounds(None) is None


def test_periods_hold_their_first_instant_and_not_their_last(frame):
    df = frame(
        "t timestamp_ntz",
        (dt.datetime(2016, 12, 31, 23, 59, 59),),
        (dt.datetime(2017, 1, 1),),
        (dt.datetime(2017, 3, 31, 23, 59, 59),),
        (dt.datetime(2017, 4, 1),),
        (None,),
    )
    assert df.filter(in_quarter_of(F.col("t"), dt.date(2017, 2, 2))).count() == 2
    assert df.filter(within(F.col("t"), year_bounds(2017))).count() == 3
    assert df.filter(in_quarter_of(F.col("t"), None)).count() == 0


def test_text_functions(frame):
    df = frame("a string, b string", ("x", None), ("x", "y"), (None, "y"), (" ", "z"))
    assert rows(df.select(joined_label(F.col("a"), F.col("b")))) == [("x  ",), ("x y",), (None,), ("  z",)]
    assert rows(df.select(is_blank(F.col("a")))) == [(False,), (False,), (True,), (True,)]
    mail = frame("m string", ("a@b.c",), ("none",))
    assert rows(mail.select(mail_domain(F.col("m")))) == [("b.c",), ("",)]


def test_tagged_numbers_read_back(frame):
    df = frame("n bigint", (3,), (70,)).select(tagged("tag", F.col("n")).alias("t"))
    assert rows(df.select(tag_number(F.col("t"), "tag"))) == [(3,), (70,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(tag_number(F.col("t"), "other")).collect()


def test_readable_size(spark):
    sizes = [8192, 10239, 10240, 10485247, 10485248, 602611712, 602456064, 5 * 1024**4, 20 * 1024**4]
    made = spark.createDataFrame([(s,) for s in sizes], "s bigint").select(readable_size(F.col("s")))
    assert [text for (text,) in rows(made)] == ["8192 bytes", "10239 bytes", "10 kB", "10239 kB", "10 MB", "575 MB", "575 MB", "5120 GB", "20 TB"]


def test_label_without_code_is_null(frame):
    assert rows(frame("c string", ("a",), ("z",), (None,)).select(label(F.col("c"), {"a": "A", "b": "B"}))) == [
        ("A",),
        (None,),
        (None,),
    ]


def test_sort_keys_put_null_high(frame):
    df = frame("n int", (1,), (None,), (2,))
    assert rows(df.orderBy(*sort_keys("n"))) == [(1,), (2,), (None,)]
    assert rows(df.orderBy(*sort_keys("-n"))) == [(None,), (2,), (1,)]


# --- joins ----------------------------------------------------------------


@pytest.fixture
def left(frame):
    return frame("k int, v string", (1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"))


def test_semi_and_anti(left, frame):
    right = frame("k bigint, w string", (1, "x"), (1, "y"), (4, "z"), (None, "n"))
    assert bag(joins.exists_in(left, right, ["k"])) == [(1, "a"), (1, "b")]
    assert bag(joins.absent_from(left, right, ["k"]), "v") == [("c",), ("d",), ("e",)]


def test_anti_join_over_alternatives(frame):
    left = frame("a int, b int", (1, 9), (9, 2), (9, 9), (None, 2), (None, None))
    right = frame("x int, y int", (1, 1), (5, 2))
    kept = joins.absent_from_any(left, right, [[("a", "x")], [("b", "y")]])
    assert bag(kept) == [(9, 9), (None, None)]


@pytest.mark.parametrize(
    "right, kept",
    [
        ([(1,), (7,)], ["c", "d"]),
        ([(1,), (None,)], []),
        ([], ["a", "b", "c", "d", "e"]),
    ],
)
def test_not_in_follows_null_rules(spark, left, right, kept):
    other = spark.createDataFrame(right, "r int")
    assert [v for (v,) in bag(joins.not_in(left, "k", other, "r"), "v")] == kept


def test_nested_semi_joins(left, frame):
    middle = frame("m int, n int", (1, 10), (2, 20), (3, 30))
    outer = frame("o int", (10,), (30,))
    found = joins.exists_along(left, [(middle, [("k", "m")]), (outer, [("n", "o")])])
    assert bag(found, "v") == [("a",), ("b",), ("d",)]


def test_pair_with_one(left, frame):
    one = frame("s int", (5,))
    assert set(rows(joins.pair_with_one(left, one, {"store": "s"}), "store")) == {(5,)}
    assert rows(joins.pair_with_one(left, one.limit(0), {"store": "s"})) == []
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        joins.pair_with_one(left, one.unionByName(one), {"store": "s"}).collect()


def test_holders_of_max_keep_ties(frame):
    df = frame("g string, n int, v string", ("x", 2, "a"), ("x", 2, "b"), ("x", 1, "c"), ("y", None, "d"))
    assert bag(joins.holders_of_max(df, ["g"], "n"), "g", "v") == [("x", "a"), ("x", "b")]
    assert bag(joins.holders_of_max(df, ["g"], "n", max_groups=2), "v") == [("a",), ("b",)]


# --- hot keys -------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, a third have none, the rest differ."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 2, F.col("id") + 1000)
    return spark.range(30_000).select(key.alias("k"), F.col("id").alias("v")).repartition(6)


def test_hot_keys_hold_all_heavy_ones_and_few_others(skewed, spark):
    hot = joins.hot_keys(skewed, ["k"]).first()["hot"]
    expected = spark.sql("SELECT xxhash64(7L), xxhash64(CAST(NULL AS BIGINT))").first()
    assert set(expected) <= set(hot) and len(hot) <= 200
    assert joins.hot_keys(spark.range(0), ["id"]).first()["hot"] == []


def _parent(spark):
    many = spark.range(5_000, 20_000).selectExpr("CAST(id AS INT) AS p")
    return many.unionByName(spark.createDataFrame([(7,), (7,)], "p int"))


def test_split_semi_and_anti_joins_are_whole(skewed, spark, no_broadcast):
    parent = _parent(spark)
    semi, anti = joins.exists_in(skewed, parent, [("k", "p")]), joins.absent_from(skewed, parent, [("k", "p")])
    assert "_salt" in semi._jdf.queryExecution().optimizedPlan().toString()
    plain = skewed.join(parent.distinct(), skewed.k == parent.p, "left_semi")
    assert semi.count() == plain.count()
    assert semi.exceptAll(plain).count() == 0
    assert semi.count() + anti.count() == skewed.count()
    assert anti.filter("k IS NULL").count() == 10_000


def test_split_lookup_join_is_whole(skewed, spark, no_broadcast):
    parent = _parent(spark).distinct().withColumn("name", F.concat(F.lit("n"), "p"))
    found = joins.lookup_join(skewed, parent, [("k", "p")], "left")
    plain = skewed.join(parent, skewed.k == parent.p, "left").select("k", "v", "name")
    assert found.count() == 30_000
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_chained_lookups_read_the_left_side_once_each(spark, skewed, no_broadcast, tmp_path):
    """One read for the rows and one of the key columns for the hot keys of each lookup; no job while building."""
    skewed.write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    parent = _parent(spark).distinct()
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    found = joins.absent_from_any(batch, parent, [[("k", "p")], [("v", "p")], [("k", "p"), ("v", "p")]])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [k") <= 7  # both sides of a join name the same scalar, which Spark runs once
    assert found.count() == skewed.join(parent, skewed.k == parent.p, "left_anti").join(parent, skewed.v == parent.p, "left_anti").count()


def test_joined_columns_of_one_name_are_an_error(frame):
    with pytest.raises(ValueError, match="columns on both sides: n"):
        joins.join_on(frame("k int, n int", (1, 2)), frame("k int, n int", (1, 2)), ["k"])



def test_few_rows_behind_a_selective_filter_give_no_hint(skewed, spark, no_broadcast):
    few = _parent(spark).filter(F.col("p") < 5_010)
    found = joins.absent_from(skewed, few, [("k", "p")])
    assert "broadcast" not in found._jdf.queryExecution().analyzed().toString()
    # Ten thousand rows of the hot key and those of ten others that occur go.
    gone = skewed.filter("k = 7 OR k BETWEEN 5000 AND 5009").count()
    assert found.count() == 30_000 - gone


# --- roll-up and numbering ------------------------------------------------


@pytest.mark.parametrize("eager", [True, False, None])
def test_roll_up_is_the_same_with_and_without_early_aggregation(skewed, frame, spark, eager):
    steps = spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("g"))
    groups = frame("g bigint, name string", *[(i, f"g{i % 4}") for i in range(10)], (1, "again"))
    measures = [Measure(kind, kind, "v") for kind in ("count", "sum", "max", "min")]
    found = roll_up(skewed, [Hop(steps, ["k"], ["g"]), Hop(groups, ["g"], ["name"])], ["name"], measures, eager)
    plain = (
        skewed.join(steps, "k").join(groups, "g").groupBy("name").agg(F.count("v"), F.sum("v"), F.max("v"), F.min("v"))
    )
    assert bag(found) == bag(plain)


def test_roll_up_aggregates_before_a_shuffled_hop(skewed, spark, no_broadcast):
    steps = spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("g"))
    plan = roll_up(skewed, [Hop(steps, ["k"], ["g"])], ["g"], [Measure("n", "count", "v")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(k") == 2 and text.count("HashAggregate") == 4


def test_number_rows_is_dense_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("v")).repartition(5)
        numbered = number_rows(df, "n", [F.col("v").desc()], start=11)
        assert numbered.select(F.spark_partition_id()).distinct().count() > 1
        assert numbered.filter(F.col("n") != 5_010 - F.col("v")).count() == 0
        unordered = number_rows(df, "n")
        assert bag(unordered.agg(F.min("n"), F.max("n"), F.countDistinct("n"))) == [(1, 5_000, 5_000)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_number_rows_of_nothing(spark):
    assert rows(number_rows(spark.range(0), "n", [F.col("id")])) == []


def test_row_policy(frame):
    table = frame("customer_id int, v string", (1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"))
    policies = frame("role string, customer_id int", ("one", 1), ("two", 2), ("two", 3))
    assert bag(visible_rows(table, policies, "two", "customer_id"), "v") == [("b",), ("c",), ("d",)]
    assert rows(visible_rows(table, policies, "one", "customer_id").filter("customer_id <> 1")) == []
    assert rows(visible_rows(table, policies, "nobody", "customer_id")) == []
