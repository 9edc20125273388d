"""The reports and table changes on the order tables region .. lineitem.

Every query reads whole tables. Relations are renamed to the column names the
reports use; the projections cost nothing in the plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from tallyframe.functions.ordering import sort_keys
from tallyframe.functions.periods import in_quarter_of, plus_days, since
from tallyframe.functions.text import joined_label, mail_domain, readable_size, tagged
from tallyframe.operators import cascade, changes, joins, maintenance, policy, quality, upkeep
from tallyframe.operators.key_index import KeyIndex
from tallyframe.operators.numbering import number_rows
from tallyframe.operators.trigram_index import TrigramIndex
from tallyframe.operators.rollup import Hop, Measure, roll_up
from tallyframe.plans import film_rental, loads, reports
from tallyframe.session import scratch_path
from tallyframe.sources import partitions
from tallyframe.sources.file_tables import FileTable
from tallyframe.sources.definitions import ColumnDef, ForeignKey, TableDef, after, after_day, differ, one_of
from tallyframe.sources.tables import Tables, append_rows, create_table, publish_view, tagged_numbers

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TAG = "row number "

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a plan over the tables under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(Tables(spark, folder, NAMES))
    return function


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def total(name: str) -> Column:
    return F.col(name).cast("decimal(38,2)").alias(name)


def shaped(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Project to new names: ``new="old"`` or an expression."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def as_year(name: str) -> Column:
    return F.year(name)


# --- films and categories -------------------------------------------------


@query
def category_filter(t: Tables) -> DataFrame:
    """Customers of two segments with money, in one region."""
    found = reports.films_of_category(
        films=shaped(
            t["customer"],
            film_id="c_nationkey",
            title="c_name",
            release_year="c_custkey",
            rental_rate="c_acctbal",
            rating="c_mktsegment",
        ),
        links=shaped(t["nation"], film_id="n_nationkey", category_id="n_regionkey"),
        categories=shaped(t["region"], category_id="r_regionkey", name="r_name"),
        category="asia",
        wanted=(F.col("rental_rate") > 1) & F.col("rating").isin("BUILDING", "MACHINERY"),
    )
    return shaped(found, c_name="title", c_custkey="release_year", c_acctbal="rental_rate")


def _supplied(t: Tables, form: str) -> DataFrame:
    found = reports.films_of_category(
        films=shaped(
            t["part"],
            film_id="p_partkey",
            title="p_name",
            release_year="p_size",
            rental_rate="p_retailprice",
            rating="p_brand",
        ),
        links=shaped(t["lineitem"], film_id="l_partkey", category_id="l_suppkey"),
        categories=shaped(t["supplier"], category_id="s_suppkey", name="s_name"),
        category="supplier#000000007",
        wanted=F.col("release_year").between(5, 45)
        & (F.col("rental_rate") > 1)
        & F.col("rating").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"),
        form=form,
    )
    return shaped(found, p_name="title", p_size="release_year", p_retailprice="rental_rate")


@query
def supplied_parts(t: Tables) -> DataFrame:
    """One row per line on which a supplier delivered a part that fits."""
    return _supplied(t, "join")


@query
def supplied_parts_semi(t: Tables) -> DataFrame:
    """One row per part that fits and that a supplier delivered."""
    return _supplied(t, "semi")


@query
def nested_semi(t: Tables) -> DataFrame:
    return reports.films_in_nested_category(
        films=t["customer"],
        steps=[
            (t["nation"], [("c_nationkey", "n_nationkey")]),
            (t["region"].filter(F.upper("r_name") == "ASIA"), [("n_regionkey", "r_regionkey")]),
        ],
        wanted=F.col("c_acctbal") > 1,
    ).select("c_custkey", "c_name")


@query
def pivot_by_year(t: Tables) -> DataFrame:
    """Lines per order year, one column for each of three part types."""
    return reports.films_per_year(
        films=shaped(t["orders"], film_id="o_orderkey", release_year=as_year("o_orderdate")),
        links=shaped(t["lineitem"], film_id="l_orderkey", category_id="l_partkey"),
        categories=shaped(t["part"], category_id="p_partkey", name="p_type"),
        columns={"n_promo": "promo", "n_small": "Small", "n_economy": "ECONOMY"},
    ).withColumnRenamed("release_year", "order_year")


@query
def pivot_priorities(t: Tables) -> DataFrame:
    """Orders per year, one column each for two priorities."""
    urgent = F.count(F.when(F.upper("o_orderpriority") == "1-URGENT", 1))
    low = F.count(F.when(F.upper("o_orderpriority") == "5-LOW", 1))
    by_year = t["orders"].groupBy(as_year("o_orderdate").alias("order_year"))
    return by_year.agg(urgent.alias("n_urgent"), low.alias("n_low")).orderBy(*sort_keys("-order_year"))


PART_LABELS = {
    "ECONOMY": "Budget line",
    "SMALL": "Compact line",
    "MEDIUM": "Middle line",
    "LARGE": "Bulk line",
    "PROMO": "On offer",
}


@query
def top_labelled(t: Tables) -> DataFrame:
    top = reports.top_films(
        films=shaped(t["part"], film_id="p_partkey", title="p_name", rating="p_type"),
        copies=shaped(t["part"], inventory_id="p_partkey", film_id="p_partkey"),
        rentals=shaped(t["lineitem"], rental_id="l_orderkey", inventory_id="l_partkey"),
        labels=PART_LABELS,
    )
    return shaped(top, p_name="title", n_lines="rental_count", part_label="expected_audience")


# --- revenue --------------------------------------------------------------


def _line_payments(t: Tables) -> DataFrame:
    return shaped(
        t["lineitem"],
        payment_id="l_orderkey",
        rental_id="l_orderkey",
        amount=money("l_extendedprice"),
        payment_date="l_shipdate",
    )


def _order_rentals(t: Tables) -> DataFrame:
    return shaped(t["orders"], rental_id="o_orderkey", inventory_id="o_custkey")


def _address_labels(t: Tables) -> DataFrame:
    """Nations as addresses: region name, then nation name, which one region's addresses lack."""
    regions = shaped(t["region"], n_regionkey="r_regionkey", address="r_name")
    joined = joins.join_on(t["nation"], regions, ["n_regionkey"])
    second = F.when(F.col("address") != "ASIA", F.col("n_name"))
    return shaped(joined, address_id="n_nationkey", address="address", address2=second)


def _store_revenue(t: Tables, form: str) -> DataFrame:
    return reports.store_revenue(
        payments=_line_payments(t),
        rentals=_order_rentals(t),
        copies=shaped(t["customer"], inventory_id="c_custkey", store_id="c_custkey"),
        stores=shaped(t["customer"], store_id="c_custkey", address_id="c_nationkey"),
        addresses=_address_labels(t),
        day=dt.date(2001, 8, 1),
        form=form,
    )


@query
def revenue_by_label(t: Tables) -> DataFrame:
    return _store_revenue(t, "label").select("full_address", total("revenue"))


@query
def revenue_by_holder(t: Tables) -> DataFrame:
    found = _store_revenue(t, "store")
    return found.select(F.col("store_id").alias("c_custkey"), "full_address", total("revenue"))


@query
def revenue_keep_empty(t: Tables) -> DataFrame:
    found = _store_revenue(t, "keep_empty")
    return found.select(F.col("store_id").alias("c_custkey"), "full_address", total("revenue"))


@query
def last_location_revenue(t: Tables) -> DataFrame:
    """What customers spent in 1997 where the supplier sits in the nation of their last order's supplier."""
    sources = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_suppkey").alias("l_suppkey"))
    top = reports.last_store_revenue(
        payments=shaped(
            t["orders"],
            payment_id="o_orderkey",
            staff_id="o_custkey",
            rental_id="o_orderkey",
            amount=money("o_totalprice"),
            payment_date="o_orderdate",
        ),
        rentals=shaped(sources, rental_id="l_orderkey", inventory_id="l_suppkey"),
        copies=shaped(t["supplier"], inventory_id="s_suppkey", store_id="s_nationkey"),
        staff=shaped(t["customer"], staff_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
        year=1997,
    )
    return top.select("full_name", F.col("store_id").alias("s_nationkey"), total("revenue_contributed"))


def _region_sales(t: Tables) -> dict[str, DataFrame]:
    return {
        "categories": shaped(t["region"], category_id="r_regionkey", name="r_name"),
        "links": shaped(t["nation"], film_id="n_nationkey", category_id="n_regionkey"),
        "copies": shaped(t["customer"], inventory_id="c_custkey", film_id="c_nationkey"),
        "rentals": _order_rentals(t),
        "payments": _line_payments(t),
    }


IN_QUARTER_DAY = dt.date(1997, 2, 1)
LAST_SHIPPED = dt.date(2001, 9, 1)


@query
def period_revenue(t: Tables) -> DataFrame:
    """Revenue per region in one quarter, over five tables."""
    in_period = in_quarter_of(F.col("payment_date"), IN_QUARTER_DAY)
    found = reports.category_revenue(**_region_sales(t), in_period=in_period)
    return found.select("category_name", total("total_revenue"))


@query
def period_revenue_by_type(t: Tables) -> DataFrame:
    lines = shaped(
        t["lineitem"].filter(in_quarter_of(F.col("l_shipdate"), IN_QUARTER_DAY)),
        p_partkey="l_partkey",
        price=money("l_extendedprice"),
    )
    revenue = roll_up(
        lines, [Hop(t["part"], ["p_partkey"], ["p_type"])], ["p_type"], [Measure("total_revenue", "sum", "price")]
    )
    return revenue.filter(F.col("total_revenue") > 0).select("p_type", total("total_revenue"))


@query
def period_revenue_unknown(t: Tables) -> DataFrame:
    """A missing date holds no sales."""
    found = reports.category_revenue(**_region_sales(t), in_period=in_quarter_of(F.col("payment_date"), None))
    return found.select("category_name", total("total_revenue"))


@query
def period_revenue_function(t: Tables) -> DataFrame:
    """The quarter report called from SQL."""
    sales = _region_sales(t)
    film_rental.publish_quarter_function(
        {
            "payment": sales["payments"],
            "rental": sales["rentals"],
            "inventory": sales["copies"],
            "film_category": sales["links"],
            "category": sales["categories"],
        }
    )
    return t.spark.sql(f"SELECT * FROM {film_rental.QUARTER_FUNCTION}(DATE '1997-02-01')")


@query
def published_view(t: Tables) -> DataFrame:
    """The region report read through a named view."""
    publish_view(period_revenue(t), "tallyframe_sales_by_region")
    return t.spark.sql("SELECT category_name, total_revenue FROM tallyframe_sales_by_region WHERE total_revenue > 0")


@query
def current_quarter_revenue(t: Tables) -> DataFrame:
    """Revenue per region in the quarter of today, all ship dates moved so that the tables reach until today."""
    sales = _region_sales(t)
    moved = F.date_add(F.to_date("payment_date"), F.datediff(F.current_date(), F.lit(LAST_SHIPPED)))
    film_rental.publish_current_quarter(
        {
            "payment": sales["payments"].withColumn("payment_date", moved),
            "rental": sales["rentals"],
            "inventory": sales["copies"],
            "film_category": sales["links"],
            "category": sales["categories"],
        }
    )
    return t.spark.table(film_rental.CURRENT_QUARTER_VIEW).select("category_name", total("total_revenue"))


@query
def no_sales(t: Tables) -> DataFrame:
    """Parts without a line shipped in the quarter, by NOT IN."""
    sold = t["lineitem"].filter(in_quarter_of(F.col("l_shipdate"), IN_QUARTER_DAY))
    return joins.not_in(t["part"], "p_partkey", sold, "l_partkey").select("p_partkey", "p_name")


@query
def categories_without_sales(t: Tables) -> DataFrame:
    """Customers without a line shipped in the quarter."""
    customers = t["customer"]
    return shaped(
        reports.categories_without_sales(
            categories=shaped(customers, category_id="c_custkey", name="c_name"),
            links=shaped(customers, film_id="c_custkey", category_id="c_custkey"),
            copies=shaped(customers, inventory_id="c_custkey", film_id="c_custkey"),
            rentals=_order_rentals(t),
            payments=_line_payments(t),
            in_period=in_quarter_of(F.col("payment_date"), IN_QUARTER_DAY),
        ),
        c_name="name",
    )


# --- activity -------------------------------------------------------------


def _shipments(t: Tables, keep_empty: bool, k: int | None) -> DataFrame:
    found = reports.busiest_actors(
        actors=shaped(t["customer"], actor_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
        links=shaped(t["orders"], actor_id="o_custkey", film_id="o_orderkey"),
        films=shaped(t["lineitem"], film_id="l_orderkey", shipped="l_shipdate"),
        wanted=since(F.col("shipped"), dt.date(2001, 4, 1)),
        k=k,
        keep_empty=keep_empty,
    )
    return shaped(
        found, c_custkey="actor_id", c_name="first_name", c_mktsegment="last_name", n_lines="number_of_movies"
    )


@query
def top_count(t: Tables) -> DataFrame:
    """The five suppliers on the most lines of orders since a day."""
    found = reports.busiest_actors(
        actors=shaped(t["supplier"], actor_id="s_suppkey", first_name="s_name", last_name="s_name"),
        links=shaped(t["lineitem"], actor_id="l_suppkey", film_id="l_orderkey"),
        films=shaped(t["orders"], film_id="o_orderkey", ordered="o_orderdate"),
        wanted=since(F.col("ordered"), dt.date(1999, 1, 1)),
    )
    return shaped(found, s_suppkey="actor_id", s_name="first_name", n_lines="number_of_movies")


@query
def top_count_keep_zero(t: Tables) -> DataFrame:
    return _shipments(t, keep_empty=True, k=5)


@query
def count_keep_zero(t: Tables) -> DataFrame:
    return _shipments(t, keep_empty=True, k=None)


def _customer_years(t: Tables, lines: DataFrame) -> dict[str, DataFrame]:
    return {
        "actors": shaped(t["customer"], actor_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
        "links": shaped(t["orders"], actor_id="o_custkey", film_id="o_orderkey"),
        "films": shaped(lines, film_id="l_orderkey", release_year=as_year("l_shipdate")),
    }


def _inactivity(t: Tables, lines: DataFrame, keep_empty: bool) -> DataFrame:
    found = reports.inactivity(**_customer_years(t, lines), as_of=dt.date(2026, 1, 1), keep_empty=keep_empty)
    return shaped(found, c_custkey="actor_id", full_name="full_name", inactivity_years="inactivity_years")


@query
def inactivity_today(t: Tables) -> DataFrame:
    """Years without a line until the day the query runs."""
    found = reports.inactivity(**_customer_years(t, t["lineitem"]), as_of=None, keep_empty=False)
    return shaped(found, c_custkey="actor_id", full_name="full_name", inactivity_years="inactivity_years")


@query
def inactivity(t: Tables) -> DataFrame:
    return _inactivity(t, t["lineitem"], keep_empty=False)


@query
def inactivity_keep_empty(t: Tables) -> DataFrame:
    """Years since each customer's last return in the first two years; most have none."""
    early = t["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") < F.lit(dt.date(1996, 7, 1))))
    return _inactivity(t, early, keep_empty=True)


@query
def gap_years(t: Tables) -> DataFrame:
    """Years between the orders each customer placed at a supplier-returned line; single years are absent."""
    returned = t["lineitem"].filter(F.col("l_returnflag") == "R")
    found = reports.gap_years(**_customer_years(t, returned))
    return shaped(found, c_custkey="actor_id", full_name="full_name", total_inactivity_years="total_inactivity_years")


@query
def gap_list(t: Tables) -> DataFrame:
    frames = _customer_years(t, t["lineitem"].filter(F.col("l_returnflag") == "R"))
    found = reports.film_gaps(links=frames["links"], films=frames["films"])
    return shaped(found, c_custkey="actor_id", current_year="current_year", next_year="next_year")


# --- countries and stock --------------------------------------------------


@query
def most_popular(t: Tables) -> DataFrame:
    """The parts ordered most often from three nations, ties kept."""
    return _most_popular(t, ["NATION_1", "NATION_5", "NATION_13", None, "Atlantis"])


@query
def most_popular_long_list(t: Tables) -> DataFrame:
    """The same over a list too long for a condition."""
    return _most_popular(t, [f"NATION_{k}" for k in range(1, 1400, 2)] + [f"Region {k}" for k in range(700)])


def _most_popular(t: Tables, listed: list[str | None]) -> DataFrame:
    """Orders meet the customers of the listed nations before the lines join."""
    nation = t["nation"]
    theirs = reports.in_list(nation, "n_name", listed).select(F.col("n_nationkey").alias("c_nationkey"))
    buyers = joins.join_on(t["customer"].select("c_custkey", "c_nationkey"), theirs, ["c_nationkey"])
    orders = joins.join_on(shaped(t["orders"], l_orderkey="o_orderkey", customer_id="o_custkey"), shaped(buyers, customer_id="c_custkey"), ["customer_id"])
    lines = joins.join_on(t["lineitem"].select("l_orderkey", "l_partkey"), orders, ["l_orderkey"])
    return shaped(reports.most_popular_films(**_orders_as_rentals(t, lines), listed=listed), **_POPULAR_NAMES)


_POPULAR_NAMES = {"n_name": "country", "p_name": "film", "p_brand": "rating", "type_name": "language", "p_size": "length", "release_year": "release_year"}


def _orders_as_rentals(t: Tables, lines: DataFrame) -> dict[str, DataFrame]:
    """Nations as countries, parts as films, order lines (with their ``customer_id``) as rentals."""
    nation = t["nation"]
    return {
        "countries": shaped(nation, country_id="n_nationkey", country="n_name"),
        "cities": shaped(nation, city_id="n_nationkey", country_id="n_nationkey"),
        "addresses": shaped(nation, address_id="n_nationkey", city_id="n_nationkey"),
        "customers": shaped(t["customer"], customer_id="c_custkey", address_id="c_nationkey"),
        "rentals": shaped(lines, rental_id="l_orderkey", customer_id="customer_id", inventory_id="l_partkey"),
        "copies": shaped(t["part"], inventory_id="p_partkey", film_id="p_partkey"),
        "films": shaped(
            t["part"],
            film_id="p_partkey",
            title="p_name",
            rating="p_brand",
            language_id="p_type",
            length="p_size",
            release_year=F.lit(2000),
        ),
        "languages": shaped(t["part"].select("p_type").distinct(), language_id="p_type", name=F.lower("p_type")),
    }


_TABLE_OF = {"countries": "country", "cities": "city", "addresses": "address", "customers": "customer", "rentals": "rental", "copies": "inventory", "films": "film", "languages": "language"}


@query
def most_popular_lateral(t: Tables) -> DataFrame:
    """The parts ordered most often in each nation of each region: a SQL function called with a list of nations a row."""
    orders = shaped(t["orders"], l_orderkey="o_orderkey", customer_id="o_custkey")
    lines = joins.join_on(t["lineitem"].select("l_orderkey", "l_partkey"), orders, ["l_orderkey"])
    film_rental.publish_popular_function({_TABLE_OF[name]: df for name, df in _orders_as_rentals(t, lines).items()})
    nations = joins.join_on(shaped(t["nation"], r_regionkey="n_regionkey", n_name="n_name"), t["region"].select("r_regionkey", "r_name"), ["r_regionkey"])
    publish_view(nations.groupBy("r_name").agg(F.collect_list("n_name").alias("nations")), "tallyframe_lists")
    found = t.spark.sql(f"SELECT r_name, p.* FROM tallyframe_lists, LATERAL {film_rental.POPULAR_FUNCTION}(nations) AS p")
    return shaped(found, r_name="r_name", **_POPULAR_NAMES)


@query
def most_popular_literal(t: Tables) -> DataFrame:
    """The same function called with a literal list, a name twice, a NULL and an unknown name in it."""
    most_popular_lateral(t)
    found = t.spark.sql(f"SELECT * FROM {film_rental.POPULAR_FUNCTION}(array('NATION_1', 'NATION_5', NULL, 'NATION_13', 'Atlantis', 'NATION_1'))")
    return shaped(found, **_POPULAR_NAMES)


@query
def in_stock(t: Tables) -> DataFrame:
    """Parts named like a pattern with a line whose order is closed, with their latest order, numbered."""
    found = reports.films_in_stock(**_parts_as_stock(t), pattern="%RED%")
    return shaped(
        found,
        row_num="row_num",
        p_name="film_title",
        brand="language",
        customer_name="customer_name",
        o_orderdate="rental_date",
    )


def _parts_as_stock(t: Tables) -> dict[str, DataFrame]:
    return {
        "films": shaped(t["part"], film_id="p_partkey", title="p_name", language_id="p_brand"),
        "languages": shaped(t["part"].select("p_brand").distinct(), language_id="p_brand", name=F.lower("p_brand")),
        "copies": shaped(t["lineitem"], inventory_id="l_orderkey", film_id="l_partkey"),
        "rentals": shaped(
            t["orders"],
            rental_id="o_orderkey",
            inventory_id="o_orderkey",
            customer_id="o_custkey",
            rental_date="o_orderdate",
            return_date=F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")),
        ),
        "customers": shaped(t["customer"], customer_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
    }


@query
def in_stock_function(t: Tables) -> DataFrame:
    """The same search called from SQL, without numbers."""
    film_rental.publish_stock_function({_TABLE_OF[name]: df for name, df in _parts_as_stock(t).items()})
    found = t.spark.sql(f"SELECT * FROM {film_rental.STOCK_FUNCTION}('%RED%')")
    return shaped(found, p_name="film_title", brand="language", customer_name="customer_name", o_orderdate="rental_date")


# --- registering ----------------------------------------------------------


def _customer_name() -> Column:
    """The name of an order's customer, in lower case."""
    return tagged("customer#", F.lpad(F.col("o_custkey").cast("string"), 9, "0"))


def _requests(t: Tables) -> DataFrame:
    """Requests made of the orders: blank, known and new titles; known, new and missing languages."""
    title = (
        F.when(F.col("o_orderpriority") == "5-LOW", "  ")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", _customer_name())
        .otherwise(tagged("New item ", F.col("o_custkey")))
    )
    language = (
        F.when(F.col("o_orderkey") % 7 == 3, None)
        .when(F.col("o_orderstatus") == "F", "nation_7")
        .when(F.col("o_orderstatus") == "O", reports.NEW_FILM_LANGUAGE)
        .otherwise(F.concat(F.lit("Lang "), F.col("o_orderpriority")))
    )
    return shaped(t["orders"], seq="o_orderkey", title=title, language=language)


def _registration(t: Tables) -> reports.Registration:
    films = shaped(
        t["customer"],
        film_id="c_custkey",
        title="c_name",
        release_year=F.lit(1990),
        language_id="c_nationkey",
        rental_duration=F.lit(1),
        rental_rate=F.lit("1.00").cast("decimal(4,2)"),
        replacement_cost=F.lit("1.00").cast("decimal(5,2)"),
    )
    languages = shaped(t["nation"], language_id="n_nationkey", name="n_name")
    return reports.register_films(batch=_requests(t), films=films, languages=languages, as_of=dt.date(2026, 1, 1))


@query
def register_items(t: Tables) -> DataFrame:
    """The accepted requests with their new keys."""
    return _registration(t).films.rows


@query
def register_languages(t: Tables) -> DataFrame:
    """The language table after registering."""
    return _registration(t).languages.table


@query
def register_rejected(t: Tables) -> DataFrame:
    return _registration(t).rejected


# --- picking and thinning -------------------------------------------------


def _customer_lines(t: Tables) -> DataFrame:
    orders = shaped(t["orders"], l_orderkey="o_orderkey", customer_id="o_custkey")
    return joins.join_on(t["lineitem"].select("l_orderkey", "l_partkey"), orders, ["l_orderkey"])


@query
def eligible_first(t: Tables) -> DataFrame:
    """The first customer with at least 15 orders and 60 distinct parts."""
    found = reports.first_eligible(
        customers=shaped(t["customer"], customer_id="c_custkey"),
        rentals=shaped(t["orders"], customer_id="o_custkey", rental_id="o_orderkey"),
        payments=shaped(_customer_lines(t), customer_id="customer_id", payment_id="l_partkey"),
        least_rentals=15,
        least_payments=60,
    )
    return shaped(found, c_custkey="customer_id")


@query
def any_with_both(t: Tables) -> DataFrame:
    found = reports.any_with_both(
        customers=shaped(t["customer"], customer_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
        rentals=shaped(t["orders"], customer_id="o_custkey"),
        payments=shaped(_customer_lines(t), customer_id="customer_id"),
    )
    return shaped(found, c_custkey="customer_id", c_name="first_name", c_mktsegment="last_name")


@query
def thin_generated(t: Tables) -> DataFrame:
    """Tagged text made of every order key, written, then thinned by the number in it."""
    spark = t.spark
    rows = create_table(tagged_numbers(t["orders"], "o_orderkey", TAG), scratch_path(spark, "thin"))
    return reports.thin_rows(rows, "col", TAG).table


# --- table changes --------------------------------------------------------


def _companies(t: Tables) -> DataFrame:
    """Suppliers beside customers whose names are in other letter case."""
    suppliers = shaped(t["supplier"], c_custkey="s_suppkey", c_name="s_name", c_acctbal="s_acctbal")
    customers = shaped(t["customer"], c_custkey="c_custkey", c_name=F.lower("c_name"), c_acctbal="c_acctbal")
    return suppliers.unionByName(customers)


@query
def insert_absent(t: Tables) -> DataFrame:
    """The rows added to customers: those of the batch whose name is new in any letter case."""
    return changes.insert_if_absent(t["customer"], _companies(t), ["c_name"], fold="upper").rows


@query
def insert_absent_table(t: Tables) -> DataFrame:
    """The whole table after the load."""
    return changes.insert_if_absent(t["customer"], _companies(t), ["c_name"], fold="lower").table


@query
def insert_absent_composite(t: Tables) -> DataFrame:
    """Lines without a line of the same order and number in the returned ones; two keys."""
    lines = t["lineitem"]
    returned = lines.filter(F.col("l_returnflag") == "R")
    return changes.new_rows(returned, lines, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"
    )


@query
def anti_or(t: Tables) -> DataFrame:
    """Customers that match no supplier by key and none by balance."""
    return joins.absent_from_any(
        t["customer"], t["supplier"], [[("c_custkey", "s_suppkey")], [("c_acctbal", "s_acctbal")]]
    ).select("c_custkey", "c_name")


def _order_batch(t: Tables) -> DataFrame:
    """Orders that name their customer and region as text."""
    status = F.col("o_orderstatus")
    region = F.when(status == "F", "asia").when(status == "O", "Europe").otherwise("Atlantis")
    return shaped(t["orders"], o_orderkey="o_orderkey", customer_name=_customer_name(), region_name=region)


def _resolved(t: Tables, how: str) -> DataFrame:
    return changes.resolve_keys(
        _order_batch(t),
        [
            changes.Lookup(t["customer"], {"customer_name": "c_name"}, "c_custkey", "customer_id"),
            changes.Lookup(t["region"], {"region_name": "r_name"}, "r_regionkey", "region_id"),
        ],
        how,
    )


@query
def resolve_keys(t: Tables) -> DataFrame:
    """Names resolved to keys; the unknown region becomes NULL."""
    return _resolved(t, "left")


@query
def resolve_keys_join(t: Tables) -> DataFrame:
    """Names resolved to keys; orders of the unknown region go."""
    return _resolved(t, "inner")


def _vip_change(t: Tables) -> changes.Change:
    busy = t["orders"].groupBy("o_custkey").agg(F.count("*").alias("n")).filter(F.col("n") >= 15)
    return changes.update_where(
        t["customer"],
        {"c_mktsegment": F.lit("VIP"), "c_acctbal": F.col("c_acctbal") + 1},
        keys=busy,
        on=[("c_custkey", "o_custkey")],
        unless=F.col("c_mktsegment") == "BUILDING",
    )


@query
def update_where(t: Tables) -> DataFrame:
    """Customers after busy ones, but for one segment, were renamed."""
    return _vip_change(t).table


@query
def update_where_rows(t: Tables) -> DataFrame:
    return _vip_change(t).rows


@query
def delete_where(t: Tables) -> DataFrame:
    """Orders left after closed ones with a key divisible by three are deleted."""
    change = changes.delete_where(t["orders"], where=(F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0))
    return change.table.select("o_orderkey", "o_orderstatus")


@query
def delete_where_rows(t: Tables) -> DataFrame:
    """The deleted orders themselves."""
    change = changes.delete_where(t["orders"], where=(F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0))
    return change.rows.select("o_orderkey", "o_orderstatus")


def _forget(t: Tables) -> dict[str, changes.Change]:
    """Lines, then orders, of the customers in debt."""
    debtors = shaped(t["customer"].filter(F.col("c_acctbal") < 0), o_custkey="c_custkey")
    theirs = shaped(joins.exists_in(t["orders"], debtors, ["o_custkey"]), order_id="o_orderkey")
    return changes.delete_children_first(
        [
            ("lineitem", t["lineitem"], [("l_orderkey", "order_id")]),
            ("orders", t["orders"], [("o_orderkey", "order_id")]),
        ],
        theirs,
    )


@query
def delete_children(t: Tables) -> DataFrame:
    return _forget(t)["lineitem"].table.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query
def delete_parents(t: Tables) -> DataFrame:
    return _forget(t)["orders"].table.select("o_orderkey", "o_custkey")


@query
def forget_customer(t: Tables) -> DataFrame:
    """Orders left after one customer, found by name, is forgotten."""
    left = loads.forget_customer(
        customers=shaped(t["customer"], customer_id="c_custkey", first_name="c_name", last_name="c_mktsegment"),
        rentals=shaped(t["orders"], customer_id="o_custkey", o_orderkey="o_orderkey"),
        payments=shaped(t["orders"], customer_id="o_custkey"),
        first="customer#000000042",
        last=t["customer"].filter("c_custkey = 42").select(F.lower("c_mktsegment")).scalar(),
    )
    return left["rental"].table.select("o_orderkey", F.col("customer_id").alias("o_custkey"))


def _load(t: Tables) -> changes.Change:
    """Suppliers made of customers in credit, loaded into the supplier table: nations resolved by name, known names dropped, keys given."""
    supplier = TableDef(
        name="supplier",
        columns=(
            ColumnDef("s_suppkey", LongType(), required=True),
            ColumnDef("s_name", StringType(), required=True, max_length=40),
            ColumnDef("s_nationkey", LongType(), required=True),
            ColumnDef("s_acctbal", DoubleType(), default=F.lit(0.0)),
        ),
        primary_key=("s_suppkey",),
        unique=(("s_name",),),
        foreign_keys=(ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),),
        checks={"named": F.col("s_name") != ""},
        generated="s_suppkey",
    )
    nations = shaped(t["nation"], c_nationkey="n_nationkey", nation="n_name")
    batch = joins.join_on(t["customer"].filter("c_acctbal > 9000").select("c_custkey", "c_nationkey"), nations, ["c_nationkey"])
    name = tagged("SUPPLIER#", F.lpad((F.col("c_custkey") * 3).cast("string"), 9, "0"))
    return loads.load_table(
        supplier,
        t["supplier"],
        shaped(batch, s_name=name, nation=F.lower("nation")),
        keys=["s_name"],
        lookups=[changes.Lookup(t["nation"], {"nation": "n_name"}, "n_nationkey", "s_nationkey")],
        parents={"nation": t["nation"]},
        order=["s_name"],
    )


@query
def load_rows(t: Tables) -> DataFrame:
    """The rows that a checked load adds."""
    return _load(t).rows


@query
def load_table(t: Tables) -> DataFrame:
    """The table after a checked load."""
    return _load(t).table


RENTED_ON = dt.datetime(2021, 5, 4)


def _renting(t: Tables) -> dict[str, DataFrame | Column | dt.datetime]:
    """The richest customer rents every part of three names."""
    richest = t["customer"].orderBy(*sort_keys("-c_acctbal", "c_custkey")).limit(1)
    return {
        "films": shaped(
            t["part"],
            film_id="p_partkey",
            title="p_name",
            rental_duration="p_size",
            rental_rate=money("p_retailprice"),
        ),
        "copies": shaped(t["part"], inventory_id="p_partkey", film_id="p_partkey"),
        "customer": shaped(richest, customer_id="c_custkey"),
        "wanted": F.upper("title").isin("RED WIDGET", "HOT RING", "SMALL WIDGET"),
        "moment": RENTED_ON,
    }


def _rented(t: Tables) -> changes.Change:
    no_time = F.lit(None).cast("timestamp_ntz")
    rentals = shaped(
        _customer_lines(t),
        rental_id="l_orderkey",
        rental_date=no_time,
        inventory_id="l_partkey",
        customer_id="customer_id",
        return_date=no_time,
        staff_id=F.lit(None).cast("bigint"),
        last_update=no_time,
    )
    return loads.derive_rentals(
        **_renting(t),
        staff=shaped(t["supplier"], staff_id="s_suppkey"),
        rentals=rentals,
        now=F.lit(RENTED_ON).cast("timestamp_ntz"),
    )


@query
def derive_rentals(t: Tables) -> DataFrame:
    """Rentals of every copy of three parts by the richest customer, but for those it had."""
    columns = ["rental_id", "rental_date", "inventory_id", "customer_id", "return_date", "staff_id"]
    return _rented(t).rows.select(*columns)


@query
def derive_payments(t: Tables) -> DataFrame:
    """Payments for that customer's rentals of the parts, the new ones among them."""
    payments = shaped(
        t["orders"],
        payment_id="o_orderkey",
        customer_id="o_custkey",
        staff_id=F.lit(None).cast("bigint"),
        rental_id="o_orderkey",
        amount=money("o_totalprice"),
        payment_date="o_orderdate",
    )
    paid = loads.derive_payments(**_renting(t), rentals=_rented(t).table, payments=payments)
    return paid.rows.select("payment_id", "customer_id", "staff_id", "rental_id", "amount", "payment_date")


@query
def create_missing(t: Tables) -> DataFrame:
    """Nations after every order priority and, in other case, every nation was asked for by name."""
    asked = shaped(t["orders"], n_name="o_orderpriority").unionByName(shaped(t["nation"], n_name=F.lower("n_name")))
    return changes.get_or_create(t["nation"], asked, "n_name", "n_nationkey").table


@query
def assign_keys(t: Tables) -> DataFrame:
    """Suppliers numbered on from the largest customer key, by name."""
    rows = shaped(t["supplier"], c_name="s_name")
    return changes.assign_keys(rows, t["customer"], "c_custkey", sort_keys("c_name"))


@query
def number_lines(t: Tables) -> DataFrame:
    """Every order numbered by date and key."""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    return number_rows(orders, "row_num", sort_keys("o_orderdate", "o_orderkey"))


@query
def fill_defaults(t: Tables) -> DataFrame:
    """A column the batch lacks gets its default; a NULL it states stays."""
    note = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    batch = shaped(t["orders"], o_orderkey="o_orderkey", note=note)
    filled = changes.fill_defaults(batch, {"note": F.lit("none"), "record_ts": F.lit(dt.date(2026, 1, 1))})
    return filled.select("o_orderkey", "note", "record_ts")


@query
def add_column(t: Tables) -> DataFrame:
    added = changes.add_column(t["orders"], "record_ts", F.lit(dt.date(2026, 1, 1)))
    return added.select("o_orderkey", "record_ts")


@query
def column_completeness(t: Tables) -> DataFrame:
    return changes.completeness(changes.add_column(t["lineitem"], "record_ts", F.lit(dt.date(2026, 1, 1))), "record_ts")


# --- rules, policies, storage ---------------------------------------------


@query
def duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"], nulls_count=True)


@query
def null_violations(t: Tables) -> DataFrame:
    """Orders that miss a required note after it was blanked for one status."""
    noted = t["orders"].withColumn("note", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")))
    return quality.null_violations(noted, ["o_orderkey", "note"]).select("o_orderkey", "o_orderstatus")


@query
def fk_orphans(t: Tables) -> DataFrame:
    small = t["part"].filter(F.col("p_size") <= 25)
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return quality.orphans(lines, ["l_partkey"], small, ["p_partkey"])


@query
def check_set(t: Tables) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_orderstatus")
    return quality.check_violations(orders, one_of("o_orderstatus", "F", "O"))


@query
def check_interval(t: Tables) -> DataFrame:
    """Lines shipped no later than their order date."""
    orders = shaped(t["orders"], l_orderkey="o_orderkey", o_orderdate="o_orderdate")
    lines = joins.join_on(t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate"), orders, ["l_orderkey"])
    return quality.check_violations(lines, after("l_shipdate", "o_orderdate"))


@query
def length_rule(t: Tables) -> DataFrame:
    return quality.too_long(t["part"], "p_name", 9).select("p_partkey", "p_name")


def _line_rules() -> TableDef:
    return TableDef(
        "lineitem",
        (
            ColumnDef("l_orderkey", LongType(), required=True),
            ColumnDef("l_partkey", LongType(), required=True),
            ColumnDef("l_suppkey", LongType(), required=True),
            ColumnDef("l_linenumber", IntegerType(), required=True),
            ColumnDef("l_returnflag", StringType(), max_length=1),
            ColumnDef("l_shipdate", TimestampNTZType()),
        ),
        primary_key=("l_orderkey", "l_linenumber"),
        unique=(("l_orderkey", "l_partkey"),),
        foreign_keys=(
            ForeignKey(("l_partkey",), "part", ("p_partkey",)),
            ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
        ),
        checks={
            "flag": one_of("l_returnflag", "A", "N"),
            "shipped": after_day("l_shipdate", dt.date(1996, 1, 1)),
            "keys differ": differ("l_partkey", "l_suppkey"),
        },
    )


@query
def rule_report(t: Tables) -> DataFrame:
    """Every rule of the line table with the number of rows that break it."""
    parents = {
        "part": t["part"].filter(F.col("p_size") <= 25),
        "orders": t["orders"].filter(F.col("o_orderstatus") != "P"),
    }
    return quality.rule_report(t["lineitem"], _line_rules(), parents)


def _policies(t: Tables) -> DataFrame:
    return shaped(t["customer"], role=F.concat(F.lit("agent_"), F.lower("c_mktsegment")), customer_id="c_custkey")


def _role_orders(t: Tables, role: str) -> DataFrame:
    orders = shaped(t["orders"], o_orderkey="o_orderkey", customer_id="o_custkey")
    return policy.visible_rows(orders, _policies(t), role, "customer_id")


@query
def row_policy(t: Tables) -> DataFrame:
    """Orders an agent sees: those of its segment's customers."""
    return _role_orders(t, "agent_building")


@query
def row_policy_unknown(t: Tables) -> DataFrame:
    """A role without a policy sees nothing."""
    return _role_orders(t, "agent_nobody")


@query
def rows_by_role(t: Tables) -> DataFrame:
    """How many customers and orders each role sees: an agent for each segment (both tables) and each nation (customers alone), and a role without a policy."""
    customer = t["customer"]
    segments = customer.select(F.concat(F.lit("agent_"), F.lower("c_mktsegment")).alias("role"), F.col("c_custkey").alias("key"))
    nations = customer.select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("role"), F.col("c_custkey").alias("key"))
    policies = segments.select(F.lit("orders").alias("table_name"), "role", "key").union(
        segments.union(nations).select(F.lit("customer").alias("table_name"), "role", "key")
    )
    nobody = t["region"].select(F.lit("agent_nobody").alias("role"))
    return policy.rows_by_role({"orders": (t["orders"], "o_custkey"), "customer": (customer, "c_custkey")}, policies, nobody)


@query
def role_tags(t: Tables) -> DataFrame:
    """Orders by the list of roles that see them: agents of a segment, and an auditor of all customers with money."""
    policies = _policies(t).union(t["customer"].filter(F.col("c_acctbal") > 0).select(F.lit("auditor"), "c_custkey"))
    tagged = policy.with_roles(shaped(t["orders"], o_orderkey="o_orderkey", customer_id="o_custkey"), policies, "customer_id")
    return tagged.select("o_orderkey", F.concat_ws(",", "roles").alias("roles"))


@query
def storage_report(t: Tables) -> DataFrame:
    return maintenance.storage_report(t.spark, {name: t.path(name) for name in NAMES})


@query
def storage_rows(t: Tables) -> DataFrame:
    """Tables named like a pattern, with their rows counted from file metadata."""
    report = maintenance.storage_report(t.spark, {name: t.path(name) for name in NAMES}, like="%e%")
    return report.select("table_name", "row_count")


@query
def readable_sizes(t: Tables) -> DataFrame:
    """Order prices, scaled up to storage sizes, as readable text."""
    size = F.floor(F.col("o_totalprice") * F.col("o_custkey") * F.col("o_custkey")).cast("bigint")
    return t["orders"].select("o_orderkey", size.alias("size"), readable_size(size).alias("readable"))


@query
def compact(t: Tables) -> DataFrame:
    """Lines written, thinned, appended to and compacted; summed to show that every row came through."""
    spark = t.spark
    kept = changes.delete_where(t["lineitem"], where=F.col("l_returnflag") == "R")
    path = scratch_path(spark, "lines")
    create_table(kept.table, path)
    append_rows(kept.rows.filter(F.col("l_linestatus") == "F"), path)
    rows = maintenance.compact(spark, path, scratch_path(spark, "lines-compact"))
    return (
        rows.groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n"), F.sum(money("l_extendedprice")).alias("price"))
        .select("l_returnflag", "l_linestatus", "n", total("price"))
    )


# --- expressions ----------------------------------------------------------


@query
def text_expressions(t: Tables) -> DataFrame:
    """Concatenation, folding, splitting and casts on every customer."""
    name = F.concat(F.lower(F.trim(F.col("c_name"))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    second = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return t["customer"].select(
        "c_custkey",
        mail_domain(name).alias("mail_domain"),
        joined_label(F.col("c_name"), second).alias("full_address"),
        F.replace("c_name", F.lit("Customer#"), F.lit("")).cast("int").alias("number_part"),
        (F.replace("c_name", F.lit("Customer#"), F.lit("")).cast("int") % 3).alias("remainder"),
        F.pow(F.lit(2), F.col("c_nationkey")).cast("bigint").alias("power"),
    )


@query
def date_expressions(t: Tables) -> DataFrame:
    """Year, quarter and day arithmetic on every order."""
    return t["orders"].select(
        "o_orderkey",
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        F.quarter("o_orderdate").cast("bigint").alias("order_quarter"),
        plus_days(F.col("o_orderdate"), F.lit(7)).alias("due"),
        F.col("o_orderdate").cast("date").alias("order_day"),
    )


# --- partitioned payments, deletes along foreign keys, reports kept up by changes ---


@query
def monthly_payments(t: Tables) -> DataFrame:
    """Revenue per month of a quarter from a table by month, after one month was loaded again, twice, with the prices less their discounts."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate", money("l_extendedprice").alias("amount"), money("l_discount").alias("discount"))
    path = scratch_path(t.spark, "payments")
    partitions.create_by_month(lines, path, "l_shipdate")
    first, second = dt.date(1997, 2, 1), dt.date(1997, 3, 1)
    batch = lines.filter((F.col("l_shipdate") >= F.lit(first)) & (F.col("l_shipdate") < F.lit(second)))
    batch = batch.withColumn("amount", (F.col("amount") * (1 - F.col("discount"))).cast("decimal(18,2)"))
    for _ in range(2):
        partitions.reload_months(batch, path, "l_shipdate")
    paid = partitions.read_by_month(t.spark, path).filter(partitions.within("l_shipdate", dt.date(1997, 1, 1), dt.date(1997, 4, 1)))
    return paid.groupBy(F.date_format("month", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("revenue"))


def _order_graph() -> list[TableDef]:
    """The keys of the order tables; lines hang on orders and on suppliers."""
    long = lambda *names: tuple(ColumnDef(name, LongType()) for name in names)
    return [
        TableDef("lineitem", long("l_orderkey", "l_suppkey"), foreign_keys=(ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)), ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)))),
        TableDef("orders", long("o_orderkey", "o_custkey"), ("o_orderkey",), foreign_keys=(ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
        TableDef("customer", long("c_custkey", "c_nationkey"), ("c_custkey",), foreign_keys=(ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),)),
        TableDef("supplier", long("s_suppkey", "s_nationkey"), ("s_suppkey",), foreign_keys=(ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),)),
        TableDef("nation", long("n_nationkey"), ("n_nationkey",)),
    ]


@query
def delete_cascade(t: Tables) -> DataFrame:
    """What is kept and removed of each table when one nation goes, with its customers, suppliers, their orders and lines."""
    keys = t["nation"].filter(F.col("n_name") == "NATION_5").select("n_nationkey")
    changed = cascade.delete_cascade(t, _order_graph(), "nation", keys)
    out = None
    for name, change in changed.items():
        for state, rows in (("kept", change.table), ("gone", change.rows)):
            part = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit(state).alias("state"), "n")
            out = part if out is None else out.union(part)
    return out


@query
def kept_up_orders(t: Tables) -> DataFrame:
    """Count, sum and latest date of orders per customer, brought from a state before three changes to the one after them."""
    orders = t["orders"].select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"), F.col("o_orderdate").alias("day"), "o_orderstatus")
    late = F.col("o_orderkey") % 10 == 0
    before = orders.filter(~late)
    gone = before.filter(F.col("o_orderstatus") == "F")
    old = before.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0))
    new = old.withColumn("price", F.col("price") * 2)
    new = new.withColumn("price", F.col("price").cast("decimal(18,2)"))
    # The table after the changes; only customers that lost their latest order are looked up in it.
    after = before.filter((F.col("o_orderstatus") != "F")).union(orders.filter(late))
    report = upkeep.Kept(("o_custkey",), sums=("price",), largest=("day",))
    path = scratch_path(t.spark, "state")
    state = create_table(report.state(before), path)
    kept = report.apply(state, orders.filter(late).union(new), gone.union(old), after)
    return kept.select("o_custkey", "n_rows", total("sum_price"), "max_day")


@query
def changed_files(t: Tables) -> DataFrame:
    """Lines per flag after a price change of a run of orders and the removal of one supplier's lines, with a column added between the two."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", money("l_extendedprice").alias("price"))
    # Range-dealt, so that a run of orders lies in few files.
    table = FileTable.create(lines.repartitionByRange(16, "l_orderkey"), scratch_path(t.spark, "lines"))
    table = table.update_where({"price": F.col("price") + 1}, where=F.col("l_orderkey").between(100, 400)).table
    table = table.add_column("source", "string", "old")
    named = t["orders"].filter(F.col("o_orderkey") < 200).select("o_orderkey")
    table = table.update_where({"source": F.lit("new")}, keys=named, on=[("l_orderkey", "o_orderkey")]).table
    table = table.delete_where(where=F.col("l_suppkey") == 3).table
    return table.read().groupBy("l_returnflag", "source").agg(F.count("*").alias("n"), F.sum("price").cast("decimal(38,2)").alias("price"))


@query
def load_by_index(t: Tables) -> DataFrame:
    """What two loads of all orders add to the finished ones, met by an index of their keys."""
    orders = t["orders"].select("o_orderkey", "o_orderstatus", money("o_totalprice").alias("price"))
    target = orders.filter(F.col("o_orderstatus") == "F")
    path = scratch_path(t.spark, "index")
    index = KeyIndex.create(target, ["o_orderkey"], f"keys_{path.rsplit('-', 1)[1]}", path, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        loads = []
        for number in (1, 2):
            rows = create_table(index.new_rows(orders).withColumn("load", F.lit(number)), scratch_path(t.spark, "load"))
            index.add(rows)
            loads.append(rows)
    finally:
        index.drop()
    loaded = loads[0].union(loads[1])
    return loaded.groupBy("load", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("price").cast("decimal(38,2)").alias("price"))


@query
def title_search(t: Tables) -> DataFrame:
    """Parts by patterns, looked up in an index of the trigrams of their names; the last pattern is too short for it."""
    index = TrigramIndex.create(t["part"].select("p_partkey", "p_name"), "p_name", scratch_path(t.spark, "titles"))
    out = None
    for pattern in ("%RED%", "%lue%1_", "%Part%\\_%", "%zzz%", "%9"):
        found = index.ilike(pattern).select(F.lit(pattern).alias("pattern"), "p_partkey", "p_name")
        out = found if out is None else out.union(found)
    return out
