"""The reports on the film-rental tables.

``tables`` maps the table names film, category, film_category, actor, film_actor,
language, inventory, store, address, city, country, customer, staff, rental and
payment to DataFrames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.periods import in_current_quarter, in_quarter_of
from tallyframe.plans import reports
from tallyframe.sources.tables import publish_view

Tables = Mapping[str, DataFrame]

# The genre columns of the yearly report.
GENRE_COLUMNS = {
    "number_of_drama_movies": "Drama",
    "number_of_travel_movies": "Travel",
    "number_of_documentary_movies": "Documentary",
}
FAMILY_RATINGS = ("G", "PG", "PG-13")


def family_films(
    tables: Tables,
    category: str = "Animation",
    years: tuple[int, int] = (2017, 2019),
    above: float = 1,
    ratings: Sequence[str] = FAMILY_RATINGS,
    form: str = "join",
) -> DataFrame:
    wanted = F.col("release_year").between(*years) & (F.col("rental_rate") > above) & F.col("rating").isin(*ratings)
    return reports.films_of_category(
        films=tables["film"],
        links=tables["film_category"],
        categories=tables["category"],
        category=category,
        wanted=wanted,
        form=form,
    )


def store_revenue(tables: Tables, day: dt.date = dt.date(2017, 4, 1), form: str = "store") -> DataFrame:
    return reports.store_revenue(
        payments=tables["payment"],
        rentals=tables["rental"],
        copies=tables["inventory"],
        stores=tables["store"],
        addresses=tables["address"],
        day=day,
        form=form,
    )


def busiest_actors(tables: Tables, year: int = 2015, k: int | None = 5, keep_empty: bool = False) -> DataFrame:
    return reports.busiest_actors(
        actors=tables["actor"],
        links=tables["film_actor"],
        films=tables["film"],
        wanted=F.col("release_year") >= year,
        k=k,
        keep_empty=keep_empty,
    )


def films_per_year(tables: Tables) -> DataFrame:
    return reports.films_per_year(
        films=tables["film"], links=tables["film_category"], categories=tables["category"], columns=GENRE_COLUMNS
    )


def last_store_revenue(tables: Tables, year: int = 2017, k: int = 3) -> DataFrame:
    return reports.last_store_revenue(
        payments=tables["payment"],
        rentals=tables["rental"],
        copies=tables["inventory"],
        staff=tables["staff"],
        year=year,
        k=k,
    )


def top_films(tables: Tables, k: int = 5) -> DataFrame:
    return reports.top_films(films=tables["film"], copies=tables["inventory"], rentals=tables["rental"], k=k)


def inactivity(tables: Tables, as_of: dt.date | None = None, keep_empty: bool = False) -> DataFrame:
    return reports.inactivity(
        actors=tables["actor"], links=tables["film_actor"], films=tables["film"], as_of=as_of, keep_empty=keep_empty
    )


def gap_years(tables: Tables) -> DataFrame:
    return reports.gap_years(actors=tables["actor"], links=tables["film_actor"], films=tables["film"])


def film_gaps(tables: Tables) -> DataFrame:
    return reports.film_gaps(links=tables["film_actor"], films=tables["film"])


def _sales(tables: Tables) -> dict[str, DataFrame]:
    return {
        "categories": tables["category"],
        "links": tables["film_category"],
        "copies": tables["inventory"],
        "rentals": tables["rental"],
        "payments": tables["payment"],
    }


def category_revenue(tables: Tables, day: dt.date | None) -> DataFrame:
    """Revenue per category in the quarter of a day; no day, no rows."""
    return reports.category_revenue(**_sales(tables), in_period=in_quarter_of(F.col("payment_date"), day))


#: Session objects carry the package's name, so that they replace nothing of the caller's.
CURRENT_QUARTER_VIEW = "tallyframe_current_quarter_revenue"


def publish_current_quarter(tables: Tables) -> None:
    """Publish the view of revenue per category in the quarter of the day it is read."""
    revenue = reports.category_revenue(**_sales(tables), in_period=in_current_quarter(F.col("payment_date")))
    publish_view(revenue, CURRENT_QUARTER_VIEW)


QUARTER_FUNCTION = "tallyframe_quarter_revenue"

# The bounds become constants when the function is called with a literal, and reach the scan.
_QUARTER_FUNCTION_SQL = f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {QUARTER_FUNCTION}(day DATE)
    RETURNS TABLE (category_name STRING, total_revenue DECIMAL(38,2))
    RETURN
        SELECT category.name, CAST(sum(payment.amount) AS DECIMAL(38,2))
        FROM tallyframe_payment AS payment
        JOIN tallyframe_rental USING (rental_id)
        JOIN tallyframe_inventory USING (inventory_id)
        JOIN tallyframe_film_category USING (film_id)
        JOIN tallyframe_category AS category USING (category_id)
        WHERE payment.payment_date >= trunc(day, 'QUARTER')
          AND payment.payment_date < add_months(trunc(day, 'QUARTER'), 3)
        GROUP BY category.name
        HAVING sum(payment.amount) > 0
"""


def publish_quarter_function(tables: Tables) -> None:
    """Publish the sales tables as views and the quarter report as a SQL table function over them."""
    for name in ("payment", "rental", "inventory", "film_category", "category"):
        publish_view(tables[name], f"tallyframe_{name}")
    tables["payment"].sparkSession.sql(_QUARTER_FUNCTION_SQL)


POPULAR_FUNCTION = "tallyframe_most_popular"
STOCK_FUNCTION = "tallyframe_in_stock"


def _publish_table_function(view: str, rows: DataFrame, function: str, parameter: str, source: str, shown: Sequence[str]) -> None:
    """A SQL table function over a report's own plan: ``source`` selects from the view, which has the report for every argument."""
    publish_view(rows, view)
    columns = ", ".join(f"{name} {kind}" for name, kind in rows.select(*shown).dtypes)
    names = ", ".join(f"{view}.{name}" for name in shown)
    rows.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({parameter}) RETURNS TABLE ({columns}) RETURN SELECT {names} FROM {source}")


def publish_popular_function(tables: Tables) -> None:
    """Publish ``tallyframe_most_popular(ARRAY<STRING>)``: the most rented film of each listed country.

    A literal list and a column of lists (LATERAL) both become an equi-join by country. A country listed twice counts once, a NULL in the list finds nothing, and a
    NULL or empty list is an error.
    """
    best = reports.best_films(
        countries=tables["country"],
        cities=tables["city"],
        addresses=tables["address"],
        customers=tables["customer"],
        rentals=tables["rental"],
        copies=tables["inventory"],
        films=tables["film"],
        languages=tables["language"],
    )
    view = f"{POPULAR_FUNCTION}_rows"
    asked = f"CASE WHEN coalesce(cardinality(listed), 0) = 0 THEN raise_error('{reports.EMPTY_LIST}') ELSE array_distinct(listed) END"
    source = f"(SELECT explode({asked}) AS asked) JOIN {view} ON {view}.country = asked"
    _publish_table_function(view, best, POPULAR_FUNCTION, "listed ARRAY<STRING>", source, best.columns)


def publish_stock_function(tables: Tables) -> None:
    """Publish ``tallyframe_in_stock(STRING)``: the films whose title matches a pattern and that have a copy not out, with their latest rental.

    Rows have no numbers: numbering needs a written table (``films_in_stock``). The pattern is a constant; it reaches the scan of the films.
    """
    stock = reports.stock_rows(
        films=tables["film"], languages=tables["language"], copies=tables["inventory"], rentals=tables["rental"], customers=tables["customer"]
    )
    view = f"{STOCK_FUNCTION}_rows"
    shown = ["film_title", "language", "customer_name", "rental_date"]
    _publish_table_function(view, stock, STOCK_FUNCTION, "pattern STRING", f"{view} WHERE {view}.film_title ILIKE pattern", shown)


def categories_without_sales(tables: Tables, day: dt.date | None) -> DataFrame:
    in_period = in_quarter_of(F.col("payment_date"), day)
    return reports.categories_without_sales(**_sales(tables), in_period=in_period)


def most_popular_films(tables: Tables, countries: Sequence[str] | None) -> DataFrame:
    return reports.most_popular_films(
        countries=tables["country"],
        cities=tables["city"],
        addresses=tables["address"],
        customers=tables["customer"],
        rentals=tables["rental"],
        copies=tables["inventory"],
        films=tables["film"],
        languages=tables["language"],
        listed=countries,
    )


def films_in_stock(tables: Tables, pattern: str) -> DataFrame:
    found = reports.films_in_stock(
        films=tables["film"],
        languages=tables["language"],
        copies=tables["inventory"],
        rentals=tables["rental"],
        customers=tables["customer"],
        pattern=pattern,
    )
    return reports.warn_if_empty(found)


def register_films(tables: Tables, batch: DataFrame, as_of: dt.date | None = None) -> reports.Registration:
    return reports.register_films(batch=batch, films=tables["film"], languages=tables["language"], as_of=as_of)


def first_eligible(tables: Tables, least: int = 43) -> DataFrame:
    return reports.first_eligible(
        customers=tables["customer"],
        rentals=tables["rental"],
        payments=tables["payment"],
        least_rentals=least,
        least_payments=least,
    )


def any_with_both(tables: Tables) -> DataFrame:
    return reports.any_with_both(
        customers=tables["customer"], rentals=tables["rental"], payments=tables["payment"]
    )
