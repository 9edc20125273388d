import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.joins import join_on
from tallyframe.plans import film_rental as fr
from tallyframe.plans import reports
from tests.conftest import bag, rows
from tests.films import film_tables

T = dt.datetime


@pytest.fixture(scope="module")
def t(spark):
    return film_tables(spark)


@pytest.mark.parametrize("form", ["join", "semi"])
def test_family_films(t, form):
    assert rows(fr.family_films(t, form=form)) == [("Alpha Love", 2017, D("2.99")), ("No Copies Love", 2019, D("2.99"))]


def test_family_films_join_form_repeats_and_semi_form_does_not(t, frame):
    twice = t | {"film_category": t["film_category"].unionByName(t["film_category"])}
    assert len(rows(fr.family_films(twice))) == 4
    assert len(rows(fr.family_films(twice, form="semi"))) == 2


def test_family_films_semi_form_rejects_two_categories_of_one_name(t, frame):
    extra = frame("category_id int, name string, last_update timestamp_ntz", (9, "ANIMATION", None))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        fr.family_films(t | {"category": t["category"].unionByName(extra)}, form="semi").collect()


def test_store_revenue_forms(t):
    # Since April 2017: store 1 took 4 + 1 + 8, store 2 took 5 + 7, stores 3 and 4 nothing.
    first, second = "1 Elm Flat 2", "2 Oak  "
    assert rows(fr.store_revenue(t, form="label")) == [(first, D("13.00")), (second, D("12.00"))]
    assert rows(fr.store_revenue(t, form="store")) == [(2, second, D("12.00")), (1, first, D("13.00"))]
    assert rows(fr.store_revenue(t, form="keep_empty")) == [
        (2, second, D("12.00")),
        (1, first, D("13.00")),
        (3, second, None),
        (4, second, None),
    ]


def test_store_revenue_label_form_merges_equal_labels(t):
    merged = dict(rows(fr.store_revenue(t, dt.date(2017, 1, 1), form="label")))
    # Stores 2 and 3 share a label: 3 + 5 + 7 and 6.
    assert merged == {"1 Elm Flat 2": D("15.00"), "2 Oak  ": D("21.00")}


def test_busiest_actors(t):
    assert rows(fr.busiest_actors(t)) == [
        (1, "ANN", "BELL", 4),
        (4, "ANN", "BELL", 2),
        (2, "CARL", "DUNN", 1),
        (3, "EVE", "FORD", 1),
    ]
    assert rows(fr.busiest_actors(t, keep_empty=True))[-1] == (5, "NO", "FILMS", 0)
    assert len(rows(fr.busiest_actors(t, k=2))) == 2


def test_films_per_year_keeps_years_without_the_genres(t):
    assert rows(fr.films_per_year(t)) == [
        (2019, 0, 0, 0),
        (2018, 0, 0, 0),
        (2017, 0, 1, 0),
        (2016, 0, 0, 0),
        (2015, 2, 0, 0),
        (2012, 0, 0, 0),
    ]


def test_last_store_revenue_goes_by_payment_key(t):
    # Staff 1: last key 907 is in store 3, where 6 was taken. Staff 2: 906 in store 1: 4 + 0 + 1.
    # Staff 3: the only payment has no rental, hence no store.
    assert rows(fr.last_store_revenue(t)) == [("Wes Noon", 3, D("6.00")), ("Xia Park", 1, D("5.00"))]


def test_top_films_label_and_unknown_rating(t, frame):
    assert rows(fr.top_films(t, k=2)) == [
        ("Alpha Love", 3, "Parental Guidance Suggested"),
        ("Beta Lovely", 1, "All ages admitted"),
    ]
    rental = t["rental"].unionByName(t["rental"].limit(1).withColumn("inventory_id", F.lit(70)))
    assert ("Never Rented Love", 1, None) in rows(fr.top_films(t | {"rental": rental}, k=8))


def test_inactivity(t):
    day = dt.date(2026, 5, 1)
    assert rows(fr.inactivity(t, day)) == [
        (4, "ANN BELL", 10),
        (1, "ANN BELL", 8),
        (2, "CARL DUNN", 7),
        (3, "EVE FORD", 7),
    ]
    assert rows(fr.inactivity(t, day, keep_empty=True))[0] == (5, "NO FILMS", None)


def test_gap_years_use_distinct_years_and_drop_single_ones(t):
    assert rows(fr.gap_years(t)) == [(3, "EVE FORD", 7), (1, "ANN BELL", 3), (4, "ANN BELL", 1)]


def test_gaps_add_up_to_the_total(t):
    gaps = fr.film_gaps(t)
    assert bag(gaps) == [(1, 2015, 2017), (1, 2017, 2018), (3, 2012, 2019), (4, 2015, 2016)]
    total = gaps.groupBy("actor_id").agg(F.sum(F.col("next_year") - F.col("current_year")).alias("n"))
    assert bag(total) == bag(fr.gap_years(t), "actor_id", "total_inactivity_years")


def test_category_revenue_of_a_known_quarter(t):
    # First quarter: film 1 took 2 + 3 in two categories, film 2 took nothing, film 8 took 6.
    assert bag(fr.category_revenue(t, dt.date(2017, 1, 1))) == [
        ("Animation", D("5.00")),
        ("Travel", D("5.00")),
        ("drama", D("6.00")),
    ]
    assert dict(rows(fr.category_revenue(t, dt.date(2017, 11, 5)))) == {"drama": D("7.00")}


def test_category_revenue_without_a_day_or_sales_is_empty(t):
    assert rows(fr.category_revenue(t, None)) == []
    assert rows(fr.category_revenue(t, dt.date(2030, 1, 1))) == []


def test_current_quarter_view(t, spark, frame):
    today = spark.sql("SELECT current_date()").first()[0]
    paid = t["payment"].filter("payment_id = 900").withColumns(
        {"amount": F.lit(D("2.50")).cast("decimal(5,2)"), "payment_date": F.lit(today).cast("timestamp_ntz")}
    )
    fr.publish_current_quarter(t | {"payment": t["payment"].unionByName(paid)})
    assert bag(spark.table(fr.CURRENT_QUARTER_VIEW)) == [("Animation", D("2.50")), ("Travel", D("2.50"))]


def test_quarter_function_from_sql(t, spark):
    fr.publish_quarter_function(t)
    call = f"SELECT * FROM {fr.QUARTER_FUNCTION}" + "({})"
    first = spark.sql(call.format("DATE '2017-01-01'"))
    assert bag(first) == bag(fr.category_revenue(t, dt.date(2017, 1, 1)))
    assert rows(spark.sql(call.format("CAST(NULL AS DATE)"))) == []
    assert rows(spark.sql(call.format("DATE '2030-01-01'"))) == []


def test_categories_without_sales_are_not_in_the_revenue(t):
    day = dt.date(2017, 1, 1)
    without = {name for (name,) in rows(fr.categories_without_sales(t, day))}
    assert without == {"Documentary", "Horror"}
    assert without.isdisjoint({name for name, _ in rows(fr.category_revenue(t, day))})


def test_most_popular_films(t):
    # Brazil: film 1 three times. Peru: films 3 and 6 once each, tied. Chile rents nothing.
    found = bag(fr.most_popular_films(t, ["Brazil", "Peru", "Chile", None, "brazil"]))
    assert found == [
        ("Brazil", "Alpha Love", "PG", "English", 90, 2017),
        ("Peru", "All Out LOVE", "NC-17", "English", 90, 2016),
        ("Peru", "Gamma", "R", "English", 90, 2019),
    ]


def test_most_popular_films_merges_equal_films(t):
    # Without film 1 the two films called Delta count as one and win with two rentals.
    fewer = t | {"film": t["film"].filter("film_id <> 1")}
    assert rows(fr.most_popular_films(fewer, ["Brazil"])) == [("Brazil", "Delta", "PG-13", "English", 90, 2015)]


@pytest.mark.parametrize("listed", [None, []])
def test_most_popular_films_needs_countries(t, listed):
    with pytest.raises(ValueError, match="cannot be NULL or empty"):
        fr.most_popular_films(t, listed)


def test_long_lists_become_a_relation(spark, frame):
    df = frame("v string", ("n5",), ("n5000",), (None,), ("x",))
    assert bag(reports.in_list(df, "v", [f"n{i}" for i in range(5001)])) == [("n5",), ("n5000",)]


def test_films_in_stock_numbers_tied_latest_rentals(t):
    # Film 1 has a free copy and two rentals at its latest time. Film 6 is out, 5 has no copy, 7 no rental.
    assert rows(fr.films_in_stock(t, "%love%")) == [
        (1, "Alpha Love", "English", "TOM KING", T(2017, 2, 1)),
        (2, "Alpha Love", "English", "SAM HILL", T(2017, 2, 1)),
        (3, "Beta Lovely", "English", "SAM HILL", T(2017, 3, 1)),
    ]


def test_films_in_stock_says_when_nothing_matches(t):
    with pytest.warns(UserWarning, match="No films found"):
        assert rows(fr.films_in_stock(t, "%nowhere%")) == []


def _register(t, frame, *requests, schema="seq int, title string, language string, release_year int"):
    return fr.register_films(t, frame(schema, *requests), dt.date(2026, 1, 1))


def test_register_films(t, frame):
    done = _register(
        t,
        frame,
        (1, "New One", "ENGLISH", 2020),
        (2, "new one", "English", 2020),
        (3, "  ", "English", 2020),
        (4, None, "English", 2020),
        (5, "gamma", "English", 2020),
        (6, "New Two", "Georgian", 2021),
        (7, "New Three", "georgian", None),
        (8, "New Four", None, 2021),
        (9, "NEW one", None, 2021),
    )
    assert bag(done.films.rows, "film_id", "title", "language_id", "release_year") == [
        (10, "New Two", 3, 2021),
        (11, "New Three", 3, None),
        (9, "New One", 1, 2020),
    ]
    terms = set(rows(done.films.rows, "rental_duration", "rental_rate", "replacement_cost"))
    assert terms == {(3, D("4.99"), D("19.99"))}
    assert rows(done.languages.rows) == [(3, "Georgian")]
    assert done.films.table.count() == 11
    assert bag(done.rejected, "seq", "reason") == [
        (2, reports.REASON_EXISTS),
        (3, reports.REASON_BLANK),
        (4, reports.REASON_BLANK),
        (5, reports.REASON_EXISTS),
        (8, reports.REASON_LANGUAGE),
        (9, reports.REASON_EXISTS),
    ]


def test_register_films_defaults_and_repeat(t, frame):
    done = _register(t, frame, (1, "My Film"), schema="seq int, title string")
    assert rows(done.languages.rows) == [(3, "Klingon")]
    assert rows(done.films.rows, "title", "release_year", "language_id") == [("My Film", 2026, 3)]
    again = t | {"film": done.films.table, "language": done.languages.table}
    second = _register(again, frame, (1, "My Film"), schema="seq int, title string")
    assert rows(second.films.rows) == [] and rows(second.languages.rows) == []
    assert rows(second.rejected, "reason") == [(reports.REASON_EXISTS,)]


def test_first_eligible(t):
    assert rows(fr.first_eligible(t, 3)) == [(1,)]
    assert rows(fr.first_eligible(t, 43)) == []


def test_any_with_both(t):
    assert rows(fr.any_with_both(t)) == [(1, "SAM", "HILL")]


def test_reports_agree_when_nothing_is_broadcast(t, no_broadcast):
    assert len(rows(fr.films_in_stock(t, "%love%"))) == 3
    assert rows(fr.last_store_revenue(t)) == [("Wes Noon", 3, D("6.00")), ("Xia Park", 1, D("5.00"))]
    assert dict(rows(fr.category_revenue(t, dt.date(2017, 11, 5)))) == {"drama": D("7.00")}
    assert len(rows(fr.most_popular_films(t, ["Brazil", "Peru"]))) == 3
    assert len(rows(fr.films_per_year(t))) == 6


def test_join_keeps_left_columns_only_once(frame):
    joined = join_on(frame("a int, x string", (1, "l")), frame("b int, y string", (1, "r")), [("a", "b")])
    assert joined.columns == ["a", "x", "y"] and rows(joined) == [(1, "l", "r")]
