"""The reports.

Each takes its relations as keyword arguments with the film-rental column names,
so other star schemas can run the same plan by renaming columns.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions.labels import AUDIENCE, label
from tallyframe.functions.ordering import sort_keys
from tallyframe.functions.periods import since, within, year_bounds, years_until
from tallyframe.functions.text import full_name, is_blank, joined_label, same_text, tag_number
from tallyframe.operators.changes import Change, assign_keys, delete_where, fill_defaults, get_or_create, new_rows
from tallyframe.operators.joins import (
    absent_from,
    exists_along,
    exists_in,
    holders_of_max,
    join_on,
    join_path,
    lookup_join,
    not_in,
)
from tallyframe.operators.numbering import number_rows
from tallyframe.operators.rollup import Hop, Measure, count_by_value, roll_up
from tallyframe.sources.tables import inline_rows

_LIST_LIMIT = 1_000


def in_list(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is in the list; NULL list entries match nothing. Long lists become a relation."""
    values = list(dict.fromkeys(v for v in values if v is not None))
    if len(values) <= _LIST_LIMIT:
        return df.filter(F.col(name).isin(values))
    listed = inline_rows(df.sparkSession, [(v,) for v in values], f"{name} string")
    return exists_in(df, listed, [name])


# --- films ----------------------------------------------------------------


def films_of_category(
    *,
    films: DataFrame,
    links: DataFrame,
    categories: DataFrame,
    category: str,
    wanted: Column,
    form: str = "join",
) -> DataFrame:
    """Films that meet ``wanted`` and belong to a category named in any letter case.

    ``join`` lists a film once per matching link; ``semi`` lists it once and
    fails if two categories bear the name.
    """
    named = categories.filter(same_text(F.col("name"), category))
    chosen = films.filter(wanted)
    if form == "join":
        # The one category meets its links first, so that films join only those.
        chosen = join_on(chosen, join_on(links, named.select("category_id"), ["category_id"]).select("film_id"), ["film_id"])
    else:
        one = named.select("category_id").scalar()
        chosen = exists_in(chosen, links.filter(F.col("category_id") == one), ["film_id"])
    # The key breaks ties, so that films of one title need not be sorted by one task.
    return chosen.orderBy(*sort_keys("title", "film_id")).select("title", "release_year", "rental_rate")


def films_in_nested_category(
    *, films: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[str | tuple[str, str]]]], wanted: Column
) -> DataFrame:
    """Films that meet ``wanted`` and reach a row along nested semi-joins."""
    return exists_along(films.filter(wanted), steps)


def films_per_year(
    *, films: DataFrame, links: DataFrame, categories: DataFrame, columns: Mapping[str, str]
) -> DataFrame:
    """Films per release year with one count column per listed category, newest year first."""
    counts = roll_up(
        links,
        [Hop(categories, ["category_id"], ["name"]), Hop(films, ["film_id"], ["release_year"])],
        ["release_year", "name"],
        [Measure("n", "count", "film_id")],
    )
    return count_by_value(counts, "release_year", "name", dict(columns)).orderBy(*sort_keys("-release_year"))


def top_films(
    *, films: DataFrame, copies: DataFrame, rentals: DataFrame, k: int = 5, labels: Mapping[str, str] = AUDIENCE
) -> DataFrame:
    """The most rented films with the audience of their rating; equal counts by film key."""
    counts = roll_up(
        rentals,
        [Hop(copies, ["inventory_id"], ["film_id"])],
        ["film_id"],
        [Measure("rental_count", "count", "rental_id")],
    )
    rated = join_on(counts, films.select("film_id", "title", "rating"), ["film_id"])
    return (
        rated.orderBy(*sort_keys("-rental_count", "film_id"))
        .limit(k)
        .select("title", "rental_count", label(F.col("rating"), labels).alias("expected_audience"))
    )


# --- revenue --------------------------------------------------------------


def _payment_hops(rentals: DataFrame, copies: DataFrame, take: str) -> list[Hop]:
    return [Hop(rentals, ["rental_id"], ["inventory_id"]), Hop(copies, ["inventory_id"], [take])]


def store_revenue(
    *,
    payments: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    stores: DataFrame,
    addresses: DataFrame,
    day: dt.date,
    form: str = "store",
) -> DataFrame:
    """Revenue since a day with the store's address label.

    ``label`` merges stores that share a label, largest first. ``store`` keeps one
    row per store with revenue, smallest first. ``keep_empty`` adds the stores
    without revenue as NULL, which sorts last.
    """
    address = joined_label(F.col("address"), F.col("address2")).alias("full_address")
    places = join_on(stores.select("store_id", "address_id"), addresses.select("address_id", address), ["address_id"])
    revenue = roll_up(
        payments.filter(since(F.col("payment_date"), day)),
        _payment_hops(rentals, copies, "store_id"),
        ["store_id"],
        [Measure("revenue", "sum", "amount")],
    )
    if form == "label":
        merged = join_on(revenue, places, ["store_id"]).groupBy("full_address").agg(F.sum("revenue").alias("revenue"))
        return merged.orderBy(*sort_keys("-revenue", "full_address"))
    joined = join_on(places, revenue, ["store_id"], "left" if form == "keep_empty" else "inner")
    return joined.select("store_id", "full_address", "revenue").orderBy(*sort_keys("revenue", "store_id"))


def last_store_revenue(
    *, payments: DataFrame, rentals: DataFrame, copies: DataFrame, staff: DataFrame, year: int, k: int = 3
) -> DataFrame:
    """Top staff by what they took in a year in the store of their last payment.

    The last payment is the one with the largest key. It is found on payments
    alone, so if its rental or copy is missing that member of staff has no store.
    """
    in_year = payments.filter(within(F.col("payment_date"), year_bounds(year)))
    last = in_year.groupBy("staff_id").agg(F.max_by("rental_id", "payment_id").alias("rental_id"))
    last_store = join_path(
        last,
        [
            (rentals.select("rental_id", "inventory_id"), ["rental_id"]),
            (copies.select("inventory_id", "store_id"), ["inventory_id"]),
        ],
    ).select("staff_id", "store_id")
    takings = roll_up(
        in_year,
        _payment_hops(rentals, copies, "store_id"),
        ["staff_id", "store_id"],
        [Measure("revenue_contributed", "sum", "amount")],
    )
    names = staff.select("staff_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))
    named = join_path(takings, [(last_store, ["staff_id", "store_id"]), (names, ["staff_id"])])
    return (
        named.orderBy(*sort_keys("-revenue_contributed", "staff_id"))
        .limit(k)
        .select("full_name", "store_id", "revenue_contributed")
    )


def _category_hops(categories: DataFrame, links: DataFrame, copies: DataFrame, rentals: DataFrame) -> list[Hop]:
    return [
        *_payment_hops(rentals, copies, "film_id"),
        Hop(links, ["film_id"], ["category_id"]),
        Hop(categories, ["category_id"], ["name"]),
    ]


def category_revenue(
    *,
    categories: DataFrame,
    links: DataFrame,
    copies: DataFrame,
    rentals: DataFrame,
    payments: DataFrame,
    in_period: Column,
) -> DataFrame:
    """Revenue per category name over the payments in a period.

    Sums that are not positive are left out. A film in two categories counts in both.
    """
    revenue = roll_up(
        payments.filter(in_period),
        _category_hops(categories, links, copies, rentals),
        ["name"],
        [Measure("total_revenue", "sum", "amount")],
    )
    return revenue.filter(F.col("total_revenue") > 0).withColumnRenamed("name", "category_name")


def categories_without_sales(
    *,
    categories: DataFrame,
    links: DataFrame,
    copies: DataFrame,
    rentals: DataFrame,
    payments: DataFrame,
    in_period: Column,
) -> DataFrame:
    """Names of the categories without a payment in a period."""
    sold = roll_up(
        payments.filter(in_period),
        _category_hops(categories, links, copies, rentals)[:-1],
        ["category_id"],
        [Measure("n", "count", "payment_id")],
    )
    return not_in(categories, "category_id", sold, "category_id").select("name")


# --- actors ---------------------------------------------------------------


def busiest_actors(
    *,
    actors: DataFrame,
    links: DataFrame,
    films: DataFrame,
    wanted: Column,
    k: int | None = 5,
    keep_empty: bool = False,
) -> DataFrame:
    """Actors with the most films that meet ``wanted``; ``keep_empty`` counts actors without one as 0.

    Without ``k`` all of them are listed.
    """
    counts = roll_up(
        links,
        [Hop(films.filter(wanted), ["film_id"])],
        ["actor_id"],
        [Measure("number_of_movies", "count", "film_id")],
    )
    named = join_on(actors, counts, ["actor_id"], "left" if keep_empty else "inner")
    ranked = (
        named.withColumn("number_of_movies", F.coalesce("number_of_movies", F.lit(0)))
        .orderBy(*sort_keys("-number_of_movies", "actor_id"))
        .select("actor_id", "first_name", "last_name", "number_of_movies")
    )
    return ranked if k is None else ranked.limit(k)


def inactivity(
    *, actors: DataFrame, links: DataFrame, films: DataFrame, as_of: dt.date | None = None, keep_empty: bool = False
) -> DataFrame:
    """Years since each actor's latest film, longest first; ``keep_empty`` adds actors without films as NULL."""
    latest = roll_up(
        links, [Hop(films, ["film_id"], ["release_year"])], ["actor_id"], [Measure("latest", "max", "release_year")]
    )
    named = join_on(actors, latest, ["actor_id"], "left" if keep_empty else "inner")
    return named.select(
        "actor_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        years_until(F.col("latest"), as_of).alias("inactivity_years"),
    ).orderBy(*sort_keys("-inactivity_years", "actor_id"))


def film_gaps(*, links: DataFrame, films: DataFrame) -> DataFrame:
    """Each year an actor released a film beside that actor's next such year.

    The window sorts distinct years, of which an actor has at most one per calendar year.
    """
    years = roll_up(links, [Hop(films, ["film_id"], ["release_year"])], ["actor_id", "release_year"], [])
    by_year = Window.partitionBy("actor_id").orderBy("release_year")
    paired = years.filter(F.col("release_year").isNotNull()).select(
        "actor_id", F.col("release_year").alias("current_year"), F.lead("release_year").over(by_year).alias("next_year")
    )
    return paired.filter(F.col("next_year").isNotNull())


def gap_years(*, actors: DataFrame, links: DataFrame, films: DataFrame) -> DataFrame:
    """Total years between an actor's films, longest first; actors with a single year are absent.

    Gaps between consecutive years add up to the last year minus the first, so one
    mergeable aggregation replaces pairing the years.
    """
    span = roll_up(
        links,
        [Hop(films, ["film_id"], ["release_year"])],
        ["actor_id"],
        [Measure("first_year", "min", "release_year"), Measure("last_year", "max", "release_year")],
    ).filter(F.col("last_year") > F.col("first_year"))
    return (
        join_on(actors, span, ["actor_id"])
        .select(
            "actor_id",
            full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
            (F.col("last_year") - F.col("first_year")).cast("bigint").alias("total_inactivity_years"),
        )
        .orderBy(*sort_keys("-total_inactivity_years", "actor_id"))
    )


# --- countries and stock --------------------------------------------------


def most_popular_films(
    *,
    countries: DataFrame,
    cities: DataFrame,
    addresses: DataFrame,
    customers: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    films: DataFrame,
    languages: DataFrame,
    listed: Sequence[str] | None,
) -> DataFrame:
    """The most rented film of each listed country, ties kept."""
    if not listed:
        raise ValueError(EMPTY_LIST)
    return best_films(
        countries=in_list(countries, "country", listed),
        cities=cities,
        addresses=addresses,
        customers=customers,
        rentals=rentals,
        copies=copies,
        films=films,
        languages=languages,
        max_countries=len(listed),
    )


def best_films(
    *,
    countries: DataFrame,
    cities: DataFrame,
    addresses: DataFrame,
    customers: DataFrame,
    rentals: DataFrame,
    copies: DataFrame,
    films: DataFrame,
    languages: DataFrame,
    max_countries: int | None = None,
) -> DataFrame:
    """The most rented film of each country, ties kept; ``max_countries`` is a proven bound, if there is one.

    Films equal in title, rating, language, length and year count as one.
    """
    located = join_path(
        customers.select("customer_id", "address_id"),
        [
            (addresses.select("address_id", "city_id"), ["address_id"]),
            (cities.select("city_id", "country_id"), ["city_id"]),
            (countries.select("country_id", "country"), ["country_id"]),
        ],
    )
    described = join_on(
        films.select("film_id", F.col("title").alias("film"), "rating", "language_id", "length", "release_year"),
        languages.select("language_id", F.col("name").alias("language")),
        ["language_id"],
    )
    shown = ["country", "film", "rating", "language", "length", "release_year"]
    counts = roll_up(
        rentals,
        [
            Hop(located, ["customer_id"], ["country"]),
            Hop(copies, ["inventory_id"], ["film_id"]),
            Hop(described, ["film_id"], shown[1:]),
        ],
        shown,
        [Measure("rental_count", "count", "rental_id")],
    )
    return holders_of_max(counts, ["country"], "rental_count", max_groups=max_countries).select(*shown)


def films_in_stock(
    *,
    films: DataFrame,
    languages: DataFrame,
    copies: DataFrame,
    rentals: DataFrame,
    customers: DataFrame,
    pattern: str,
) -> DataFrame:
    """Films whose title matches a pattern and that have a copy not out, with their latest rental, numbered."""
    rows = stock_rows(
        films=films.filter(F.col("title").ilike(pattern)), languages=languages, copies=copies, rentals=rentals, customers=customers
    )
    order = sort_keys("film_title", "film_id", "rental_date", "rental_id", "customer_id")
    return number_rows(rows, "row_num", order).select(
        "row_num", "film_title", "language", "customer_name", "rental_date"
    )


def stock_rows(
    *, films: DataFrame, languages: DataFrame, copies: DataFrame, rentals: DataFrame, customers: DataFrame
) -> DataFrame:
    """Titled films that have a copy not out, with their latest rental.

    Rentals tied for the latest time each get a row. Films never rented are absent. Each step carries the title beside
    the film's key, so that a filter on the titles of the result reaches every step and only their copies are joined and counted.
    """
    film = ["film_id", "film_title"]
    matching = films.select("film_id", F.col("title").alias("film_title"), "language_id")
    their_copies = lookup_join(copies.select("inventory_id", "film_id"), matching.select(*film).distinct(), ["film_id"])
    # One join of two plain tables, which adaptive execution splits at hot keys; state and latest time both follow from it.
    rented = join_on(
        rentals.select("rental_id", "customer_id", "rental_date", "return_date", "inventory_id"), their_copies, ["inventory_id"]
    )
    # A copy is out while one of its rentals is open; a film is in stock while fewer copies are out than it has.
    is_out, rental_date = F.col("return_date").isNull().cast("int"), F.col("rental_date")
    never = F.lit(0).alias("out"), F.lit(None).cast(dict(rentals.dtypes)["rental_date"]).alias("rental_date")
    states = rented.select(*film, "inventory_id", is_out.alias("out"), rental_date)
    states = states.unionByName(their_copies.select(*film, "inventory_id", *never))
    per_film = (
        states.groupBy(*film, "inventory_id")
        .agg(F.max("out").alias("out"), F.max("rental_date").alias("rental_date"))
        .groupBy(*film)
        .agg(F.count("*").alias("n_copies"), F.sum("out").alias("n_out"), F.max("rental_date").alias("rental_date"))
    )
    in_stock = per_film.filter("n_out < n_copies").select(*film, "rental_date")
    # Joined on (film, time), so a film with very many rentals does not meet in one task.
    latest = join_on(rented.drop("return_date"), in_stock, [*film, "rental_date"])
    return join_path(
        latest,
        [
            (matching, film),
            (languages.select("language_id", F.col("name").alias("language")), ["language_id"]),
            (
                customers.select(
                    "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("customer_name")
                ),
                ["customer_id"],
            ),
        ],
    )


def warn_if_empty(rows: DataFrame) -> DataFrame:
    """Say so when nothing was found, as the stock search does; looks at one row."""
    if rows.isEmpty():
        warnings.warn(EMPTY_STOCK, stacklevel=2)
    return rows


# --- registering ----------------------------------------------------------


class Registration(NamedTuple):
    films: Change
    languages: Change
    rejected: DataFrame


# What a new film gets when the caller says nothing.
NEW_FILM_LANGUAGE = "Klingon"
NEW_FILM_DURATION = 3
NEW_FILM_RATE = "4.99"
NEW_FILM_COST = "19.99"

# The messages that callers of the reports see.
EMPTY_LIST = "Country list cannot be NULL or empty"
EMPTY_STOCK = "No films found or no available copies in stock"
REASON_BLANK = "Movie title cannot be NULL or empty"
REASON_EXISTS = "Movie with this title already exists"
REASON_LANGUAGE = "Language cannot be NULL"


def register_films(
    *, batch: DataFrame, films: DataFrame, languages: DataFrame, as_of: dt.date | None = None
) -> Registration:
    """Add films by title, creating missing languages, and report the rows refused.

    ``batch`` has a unique ``seq`` giving the order of the requests, a ``title``,
    and optionally ``language`` and ``release_year``. Rows are judged as if they
    came one after another: of equal titles (any case) the first may enter.
    """
    year = F.year(F.current_date()) if as_of is None else F.lit(as_of.year)
    asked = fill_defaults(batch, {"language": F.lit(NEW_FILM_LANGUAGE), "release_year": year.cast("int")})
    titled = asked.filter(~is_blank(F.col("title")))
    absent = new_rows(films, titled, ["title"], "upper")
    usable = absent.filter(F.col("language").isNotNull()).withColumn("_title", F.upper("title"))
    # The first request per title, joined back on (title, seq) so a much repeated title stays spread out.
    first = usable.groupBy("_title").agg(F.min("seq").alias("seq"))
    accepted = join_on(usable, first, ["_title", "seq"], "left_semi").drop("_title")
    # Numbering checkpoints the accepted rows; everything below reads those instead of judging again.
    accepted = assign_keys(accepted, films, "film_id", sort_keys("seq"))
    known = get_or_create(languages, accepted.withColumnRenamed("language", "name"), "name", "language_id", order="seq")
    # The smallest key stands for languages that share a folded name.
    folded = known.table.groupBy(F.upper("name").alias("_language")).agg(F.min("language_id").alias("language_id"))
    rows = lookup_join(accepted.withColumn("_language", F.upper("language")), folded, ["_language"])
    values = {
        "film_id": F.col("film_id"),
        "title": F.col("title"),
        "release_year": F.col("release_year"),
        "language_id": F.col("language_id"),
        "rental_duration": F.lit(NEW_FILM_DURATION),
        "rental_rate": F.lit(NEW_FILM_RATE),
        "replacement_cost": F.lit(NEW_FILM_COST),
    }
    added = rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in films.schema])
    refused = absent_from(asked, accepted, ["seq"])
    reason = F.when(is_blank(F.col("title")), REASON_BLANK)
    # A request without a language is told so unless an accepted one before it already holds the title.
    nameless = absent.filter(F.col("language").isNull()).select("seq", F.upper("title").alias("_title"))
    lacking = lookup_join(nameless, first.withColumnRenamed("seq", "_first"), ["_title"], "left")
    lacking = lacking.filter(F.col("_first").isNull() | (F.col("_first") > F.col("seq"))).select("seq")
    refused = join_on(refused, lacking.withColumn("_no_language", F.lit(True)), ["seq"], "left")
    reason = reason.when(F.col("_no_language"), REASON_LANGUAGE).otherwise(REASON_EXISTS)
    return Registration(
        Change(films.unionByName(added), added), known, refused.select("seq", "title", reason.alias("reason"))
    )


# --- picking and thinning -------------------------------------------------


def first_eligible(
    *, customers: DataFrame, rentals: DataFrame, payments: DataFrame, least_rentals: int, least_payments: int
) -> DataFrame:
    """The smallest customer key with enough rentals and payments, or no row.

    Each fact is counted by itself; joining them first would multiply their rows.
    """
    rented = rentals.groupBy("customer_id").agg(F.countDistinct("rental_id").alias("n"))
    paid = payments.groupBy("customer_id").agg(F.countDistinct("payment_id").alias("n"))
    rented = rented.filter(F.col("n") >= least_rentals).select("customer_id")
    paid = paid.filter(F.col("n") >= least_payments).select("customer_id")
    both = join_on(join_on(customers.select("customer_id"), rented, ["customer_id"]), paid, ["customer_id"])
    return both.agg(F.min("customer_id").alias("customer_id")).filter(F.col("customer_id").isNotNull())


def any_with_both(*, customers: DataFrame, rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """The customer with the smallest key among those with a rental and a payment."""
    both = exists_in(exists_in(customers, rentals, ["customer_id"]), payments, ["customer_id"])
    return both.orderBy(*sort_keys("customer_id")).limit(1).select("customer_id", "first_name", "last_name")


def thin_rows(tagged_rows: DataFrame, name: str, prefix: str, divisor: int = 3) -> Change:
    """Delete the rows whose number, read back from their text, is divisible by ``divisor``."""
    return delete_where(tagged_rows, where=tag_number(F.col(name), prefix) % divisor == 0)


