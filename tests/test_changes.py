import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import changes, quality
from tallyframe.plans import loads, reports
from tallyframe.sources.definitions import TableDef, ColumnDef, after, social_tables
from tallyframe.session import scratch_path
from tallyframe.sources.tables import create_table, numbers, tagged_numbers
from tests.conftest import bag, rows
from tests.films import film_tables
from pyspark.sql.types import IntegerType, StringType

T = dt.datetime


@pytest.fixture
def people(frame):
    return frame("id int, name string, mail string", (1, "Ann", "a@x"), (2, "BOB", "b@x"), (3, None, "c@x"))


@pytest.mark.parametrize("large", [False, True])
def test_insert_if_absent(people, frame, spark, large):
    if large:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = frame("name string, mail string", ("ANN", "n1"), ("bob", "n2"), ("Cy", "n3"), ("Cy", "n4"), (None, "n5"))
        done = changes.insert_if_absent(people, batch, ["name"], fold="lower")
        # Duplicates inside the batch all enter; a NULL key never matches.
        assert bag(done.rows, "name", "mail") == [("Cy", "n3"), ("Cy", "n4"), (None, "n5")]
        assert bag(quality.duplicate_keys(done.table, ["name"])) == [("Cy", 2)]
        assert done.table.count() == 6 and done.table.columns == people.columns
        exact = changes.insert_if_absent(people, batch, ["name"])
        assert exact.rows.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_insert_if_absent_twice_adds_nothing(people, frame):
    batch = frame("name string, mail string", ("Dee", "d@x"), ("ann", "z@x"))
    first = changes.insert_if_absent(people, batch, ["name"], fold="upper")
    assert rows(changes.insert_if_absent(first.table, batch, ["name"], fold="upper").rows) == []


def test_insert_if_absent_by_either_key(people, frame):
    batch = frame("name string, mail string", ("ann", "new"), ("new", "A@X"), ("both", "new"))
    done = changes.insert_if_absent(people, batch, ["name"], "lower", alternatives=[["mail"]])
    assert rows(done.rows, "name") == [("both",)]


def test_folding_one_side_only(people, frame):
    batch = frame("name string", ("ANN",), ("ann",))
    done = changes.insert_if_absent(people, batch, ["name"], "upper", fold_batch=False)
    assert rows(done.rows, "name") == [("ann",)]


def test_composite_key_folds_only_the_named_column(frame):
    posts = frame("user_id int, text string", (1, "Hello"))
    batch = frame("user_id int, text string", (1, "HELLO"), (2, "hello"), (1, None))
    done = changes.insert_if_absent(posts, batch, ["user_id", "text"], {"text": "lower"})
    assert bag(done.rows) == [(1, None), (2, "hello")]


def test_resolve_keys(people, frame):
    batch = frame("who string, n int", ("ANN", 1), ("nobody", 2), (None, 3))
    lookup = changes.Lookup(people, {"who": "name"}, "id", "person_id")
    assert bag(changes.resolve_keys(batch, [lookup])) == [(1, 1), (2, None), (3, None)]
    assert rows(changes.resolve_keys(batch, [lookup], "inner")) == [(1, 1)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_resolve_keys_rejects_a_used_ambiguous_key(people, frame, spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        twice = people.unionByName(people.filter("id = 1").withColumn("id", F.lit(9)))
        lookup = changes.Lookup(twice, {"who": "name"}, "id", "person_id")
        assert rows(changes.resolve_keys(frame("who string", ("bob",)), [lookup])) == [(2,)]
        with pytest.raises(Exception, match="more than one person_id"):
            changes.resolve_keys(frame("who string", ("ann",), ("bob",)), [lookup]).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_update_where(people, frame):
    done = changes.update_where(people, {"mail": F.concat("mail", F.lit("!"))}, where=F.col("name") == "Ann")
    assert rows(done.rows) == [(1, "Ann", "a@x!")]
    assert bag(done.table, "mail") == [("a@x!",), ("b@x",), ("c@x",)]
    keyed = changes.update_where(people, {"name": F.lit("N")}, keys=frame("k int", (2,), (2,), (3,), (8,)), on=[("id", "k")])
    assert bag(keyed.rows) == [(2, "N", "b@x"), (3, "N", "c@x")]
    assert keyed.table.count() == 3


def test_update_guard_makes_the_second_run_do_nothing(people):
    done = changes.update_where(people, {"name": F.lit("Zed")}, where=F.col("id") < 3, unless=F.col("name") == "Zed")
    assert done.rows.count() == 2
    again = changes.update_where(done.table, {"name": F.lit("Zed")}, where=F.col("id") < 3, unless=F.col("name") == "Zed")
    assert rows(again.rows) == []


@pytest.mark.parametrize("by", ["condition", "keys"])
def test_old_rows_are_kept_or_deleted(people, frame, by):
    if by == "condition":
        done = changes.delete_where(people, where=F.col("name") == "BOB")
    else:
        done = changes.delete_where(people, keys=frame("k int", (2,), (None,)), on=[("id", "k")])
    assert rows(done.rows, "id") == [(2,)]
    assert bag(done.table.unionByName(done.rows)) == bag(people)
    with pytest.raises(ValueError):
        changes.delete_where(people)


def test_assign_keys_continue_densely(people, frame):
    batch = frame("name string", ("c",), ("a",), ("b",))
    assert rows(changes.assign_keys(batch, people, "id", [F.col("name")])) == [("a", 4), ("b", 5), ("c", 6)]
    assert sorted(r[1] for r in rows(changes.assign_keys(batch, people.limit(0), "id"))) == [1, 2, 3]


def test_get_or_create(people, frame):
    names = frame("name string", ("ann",), ("Eve",), ("EVE",), (None,), ("Abe",))
    done = changes.get_or_create(people.drop("mail"), names, "name", "id")
    assert rows(done.rows) == [(4, "Abe"), (5, "EVE")]
    assert done.table.count() == 5


def test_defaults_fill_only_absent_columns(frame):
    batch = frame("a int, b string", (1, None))
    filled = changes.fill_defaults(batch, {"b": F.lit("x"), "c": F.lit("y")})
    assert rows(filled) == [(1, None, "y")]


def test_add_column_is_complete(people):
    added = changes.add_column(people, "record_ts", F.current_date())
    assert rows(changes.completeness(added, "record_ts")) == [(3, 3)]
    assert rows(changes.completeness(people, "name")) == [(3, 2)]
    with pytest.raises(ValueError):
        changes.add_column(people, "name", F.lit(1))


def test_thin_rows_deletes_every_third(spark):
    made = tagged_numbers(numbers(spark, 1, 3_000), "x", "tag")
    done = reports.thin_rows(made, "col", "tag")
    assert (done.table.count(), done.rows.count()) == (2_000, 1_000)


# --- rules ----------------------------------------------------------------


def test_rules_on_the_social_tables(frame):
    follow = social_tables()["follow"]
    users = frame("user_id bigint", (1,), (2,))
    when = T(2026, 3, 1)
    df = frame(
        "follower_user_id bigint, following_user_id bigint, follow_time timestamp_ntz, removal_time timestamp_ntz",
        (1, 2, when, None),
        (1, 2, when, T(2026, 4, 1)),
        (1, 1, when, when),
        (2, 9, T(1999, 1, 1), None),
        (None, 2, None, None),
    )
    found = {rule: n for _, rule, n in rows(quality.rule_report(df, follow, {"user": users}))}
    assert found == {
        "not null follower_user_id": 1,
        "not null following_user_id": 0,
        "not null follow_time": 1,
        "check follower_user_id differs from following_user_id": 1,
        "check follow_time after the first day": 1,
        "check removal_time after follow_time": 1,
        "primary key follower_user_id, following_user_id": 1,
        "foreign key follower_user_id": 0,
        "foreign key following_user_id": 1,
    }
    with pytest.raises(ValueError, match="differs from"):
        quality.require_rules(df, follow, {"user": users})


def test_unique_skips_null_and_length_counts_characters(frame):
    user = social_tables()["user"]
    when = T(2026, 3, 1)
    schema = (
        "user_id bigint, user_name string, email_info string, phone_number string, password string, "
        "creation_time timestamp_ntz"
    )
    df = frame(
        schema,
        (1, "a", "a@x", None, "p", when),
        (2, "b", "b@x", None, "p", None),
        (3, "n" * 51, "b@x", "1" * 21, "p", when),
    )
    found = {rule: n for _, rule, n in rows(quality.rule_report(df, user, {})) if n}
    assert found == {"length user_name": 1, "length phone_number": 1, "unique email_info": 1}
    assert user.schema().names[0] == "user_id"


def test_single_rule_operators(frame):
    df = frame("a int, b int, s string", (1, 2, "ok"), (None, 2, "long text"), (3, None, None))
    assert rows(quality.null_violations(df, ["a", "b"]), "s") == [("long text",), (None,)]
    assert rows(quality.too_long(df, "s", 4), "s") == [("long text",)]
    assert rows(quality.check_violations(df, F.col("a") > F.col("b")), "a") == [(1,)]
    assert rows(quality.check_violations(df, after("a", "b")), "a") == [(1,)]
    parent = frame("p int", (1,))
    assert rows(quality.orphans(df, ["a"], parent, ["p"]), "a") == [(3,)]
    two = frame("x int, y int", (1, 1), (1, 1), (None, 1), (None, 1))
    assert rows(quality.duplicate_keys(two, ["x", "y"])) == [(1, 1, 2)]
    assert len(rows(quality.duplicate_keys(two, ["x", "y"], nulls_count=True))) == 2


# --- load flows -----------------------------------------------------------


def _written(change, spark):
    """The change after its table was written, as a caller does between two loads."""
    return changes.Change(create_table(change.table, scratch_path(spark, "load")), change.rows)


def test_load_of_the_social_tables(spark, frame):
    defs = social_tables()
    empty = {name: spark.createDataFrame([], d.schema()) for name, d in defs.items()}
    users = frame(
        "user_name string, email_info string, phone_number string, password string, creation_time timestamp_ntz",
        ("nia_p", "nia@mail.test", "+10", "secret-1", T(2026, 3, 1)),
        ("oto_r", "oto@mail.test", None, "secret-2", T(2026, 3, 2)),
    )
    user_load = dict(keys=["user_name"], alternatives=[["email_info"]], order=["user_name"])
    user = _written(loads.load_table(defs["user"], empty["user"], users, **user_load), spark)
    assert bag(user.rows, "user_id", "user_name") == [(1, "nia_p"), (2, "oto_r")]
    assert rows(loads.load_table(defs["user"], user.table, users, **user_load).rows) == []

    public = frame("visibility_type string", ("public",))
    seen = loads.load_table(defs["visibility_setting"], empty["visibility_setting"], public, ["visibility_type"])
    seen = _written(seen, spark)
    posts = frame("who string, seen string, creation_time timestamp_ntz, description string", ("NIA_P", "Public", T(2026, 3, 3), "A walk"))
    post = loads.load_table(
        defs["post"],
        empty["post"],
        posts,
        ["user_id", "description"],
        lookups=[
            changes.Lookup(user.table, {"who": "user_name"}, "user_id", "user_id"),
            changes.Lookup(seen.table, {"seen": "visibility_type"}, "visibility_setting_id", "visibility_setting_id"),
        ],
        parents={"user": user.table, "visibility_setting": seen.table},
    )
    post = _written(post, spark)
    assert rows(post.table, "post_id", "user_id", "deleted_at") == [(1, 1, None)]

    # A post is named by its author and time: a two-column natural key over a join.
    authored = post.table.join(user.table.select("user_id", "user_name"), "user_id")
    likes = frame("author string, made timestamp_ntz, who string", ("nia_p", T(2026, 3, 3), "oto_r"))
    like_lookups = [
        changes.Lookup(authored, {"author": "user_name", "made": "creation_time"}, "post_id", "post_id"),
        changes.Lookup(user.table, {"who": "user_name"}, "user_id", "user_id"),
    ]
    parents = {"post": post.table, "user": user.table}
    like = loads.load_table(
        defs["like"], empty["like"], likes, ["post_id", "user_id"], lookups=like_lookups, parents=parents
    )
    like = _written(like, spark)
    done = rows(like.table, "like_id", "post_id", "user_id", "unliked_at", "liked_at")
    assert done[0][:4] == (1, 1, 2, None) and done[0][4] is not None

    # An unknown user leaves a NULL key, which the rules refuse.
    lost = frame("author string, made timestamp_ntz, who string", ("nia_p", T(2026, 3, 3), "nobody"))
    with pytest.raises(ValueError, match="not null user_id"):
        loads.load_table(defs["like"], like.table, lost, ["post_id", "user_id"], lookups=like_lookups, parents=parents)

    with pytest.raises(ValueError, match="unique hashtag_name"):
        loads.load_table(defs["hashtag"], empty["hashtag"], frame("hashtag_name string", ("hill",), ("hill",)), ["hashtag_name"])


def test_rent_and_pay_flow(spark):
    t = film_tables(spark)
    now = F.lit(T(2026, 1, 1)).cast("timestamp_ntz")
    stocked = loads.stock_films(
        films=t["film"],
        stores=t["store"],
        addresses=t["address"],
        copies=t["inventory"],
        titles=["gamma", "No Copies Love", "alpha love"],
        address="1 ELM",
        now=now,
    )
    # Film 1 has a copy in store 1; films 3 and 5 get the next keys.
    assert rows(stocked.rows, "inventory_id", "film_id", "store_id") == [(81, 3, 1), (82, 5, 1)]

    renamed = loads.take_over_customer(
        customers=t["customer"],
        rentals=t["rental"],
        payments=t["payment"],
        addresses=t["address"],
        first="NEW",
        last="NAME",
        least=3,
        now=now,
    )
    # East comes first by district, address 2 by key.
    assert rows(renamed.rows, "customer_id", "first_name", "email", "address_id") == [(1, "NEW", "new.name@mail.test", 2)]
    again = loads.take_over_customer(
        customers=renamed.table,
        rentals=t["rental"],
        payments=t["payment"],
        addresses=t["address"],
        first="New",
        last="Name",
        least=3,
        now=now,
    )
    assert rows(again.rows) == []

    gone = loads.forget_customer(
        customers=renamed.table, rentals=t["rental"], payments=t["payment"], first="new", last="name"
    )
    assert list(gone) == ["payment", "rental"]
    assert (gone["payment"].rows.count(), gone["rental"].rows.count()) == (3, 3)

    me = loads.named(renamed.table, "new", "name")
    wanted = F.upper("title").isin("GAMMA", "NO COPIES LOVE")
    rent = dict(
        copies=stocked.table, films=t["film"], customer=me, staff=t["staff"], wanted=wanted, moment=T(2017, 1, 15), now=now
    )
    rented = loads.derive_rentals(rentals=gone["rental"].table, **rent)
    assert rows(rented.rows, "rental_id", "inventory_id", "customer_id", "return_date", "staff_id") == [
        (108, 30, 1, T(2017, 1, 18), 3),
        (109, 81, 1, T(2017, 1, 18), 3),
        (110, 82, 1, T(2017, 1, 18), 3),
    ]
    assert rows(loads.derive_rentals(rentals=rented.table, **rent).rows) == []
    pay = dict(
        rentals=rented.table, copies=stocked.table, films=t["film"], customer=me, wanted=wanted, moment=T(2017, 1, 15)
    )
    paid = loads.derive_payments(payments=gone["payment"].table, **pay)
    assert rows(paid.rows, "payment_id", "rental_id", "amount") == [
        (910, 108, D("4.99")),
        (911, 109, D("4.99")),
        (912, 110, D("2.99")),
    ]
    assert rows(loads.derive_payments(payments=paid.table, **pay).rows) == []


def test_categories_and_links_load(spark, frame):
    t = film_tables(spark)
    names = frame("name string", ("Romance",), ("TRAVEL",)).withColumn("category_id", F.lit(7))
    done = changes.insert_if_absent(t["category"], names, ["name"], "upper")
    assert rows(done.rows, "name") == [("Romance",)]
    pairs = frame("title string, category string", ("ALPHA LOVE", "ROMANCE"), ("ALPHA LOVE", "TRAVEL"), ("NONE", "TRAVEL"))
    linked = changes.resolve_keys(
        pairs,
        [
            changes.Lookup(t["film"], {"title": "title"}, "film_id", "film_id", "upper"),
            changes.Lookup(done.table, {"category": "name"}, "category_id", "category_id", "upper"),
        ],
        "inner",
    )
    links = changes.insert_if_absent(t["film_category"], linked, ["film_id", "category_id"])
    assert rows(links.rows, "film_id", "category_id") == [(1, 7)]


def test_table_definition_defaults():
    table = TableDef("t", (ColumnDef("a", IntegerType(), True), ColumnDef("b", StringType(), default=F.lit("x"))), ("a",))
    assert table.required() == ["a"] and list(table.defaults()) == ["b"]


def test_forgetting_a_name_that_two_bear_is_an_error(frame):
    customers = frame("customer_id int, first_name string, last_name string", (1, "Ann", "Lee"), (2, "ann", "lee"), (3, "Bo", "Lee"))
    facts = frame("customer_id int, rental_id int", (1, 1), (2, 2), (3, 3))
    forget = lambda first: loads.forget_customer(customers=customers, rentals=facts, payments=facts, first=first, last="lee")
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        forget("ANN")["rental"].table.collect()
    assert bag(forget("bo")["rental"].table, "rental_id") == [(1,), (2,)]
    assert forget("zed")["payment"].table.count() == 3


def test_new_rows_are_checked_without_reading_the_table_whole(spark, frame):
    definition = TableDef("t", (ColumnDef("k", IntegerType(), required=True), ColumnDef("v", StringType())), ("k",), (("v",),))
    target = frame("k int, v string", (1, "a"), (2, "b"))
    assert quality.require_new_rows(frame("k int, v string", (3, "c"), (4, None), (5, None)), target, definition, {}).count() == 3
    for rows_, rule in (([(2, "z")], "primary key k of the table"), ([(3, "a")], "unique v of the table"), ([(3, "c"), (3, "d")], "primary key k"), ([(None, "c")], "not null k")):
        with pytest.raises(ValueError, match=rule):
            quality.require_new_rows(frame("k int, v string", *rows_), target, definition, {})
