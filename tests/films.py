"""A small film-rental database with the awkward cases: ties, gaps, orphans and NULLs."""

import datetime as dt
from decimal import Decimal

from tallyframe.sources.tables import inline_rows

D = Decimal
T = dt.datetime

SCHEMAS = {
    "language": "language_id int, name string",
    "film": (
        "film_id int, title string, description string, release_year int, language_id int, rental_duration int, "
        "rental_rate decimal(4,2), replacement_cost decimal(5,2), length int, rating string, last_update timestamp_ntz"
    ),
    "category": "category_id int, name string, last_update timestamp_ntz",
    "film_category": "film_id int, category_id int, last_update timestamp_ntz",
    "actor": "actor_id int, first_name string, last_name string, last_update timestamp_ntz",
    "film_actor": "actor_id int, film_id int, last_update timestamp_ntz",
    "inventory": "inventory_id int, film_id int, store_id int, last_update timestamp_ntz",
    "store": "store_id int, address_id int",
    "address": "address_id int, address string, address2 string, district string, city_id int",
    "city": "city_id int, country_id int",
    "country": "country_id int, country string",
    "customer": (
        "customer_id int, store_id int, first_name string, last_name string, email string, address_id int, "
        "active int, last_update timestamp_ntz"
    ),
    "staff": "staff_id int, first_name string, last_name string",
    "rental": (
        "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, return_date timestamp_ntz, "
        "staff_id int, last_update timestamp_ntz"
    ),
    "payment": (
        "payment_id int, customer_id int, staff_id int, rental_id int, amount decimal(5,2), payment_date timestamp_ntz"
    ),
}


def _film(n, title, year, rate, rating, length=90, language=1):
    return (n, title, None, year, language, 3, D(rate), D("19.99"), length, rating, None)


ROWS = {
    "language": [(1, "English"), (2, "Italian")],
    "film": [
        _film(1, "Alpha Love", 2017, "2.99", "PG"),
        _film(2, "Beta Lovely", 2018, "0.99", "G"),
        _film(3, "Gamma", 2019, "4.99", "R"),
        _film(4, "Delta", 2015, "4.99", "PG-13"),
        _film(5, "No Copies Love", 2019, "2.99", "G"),
        _film(6, "All Out LOVE", 2016, "2.99", "NC-17"),
        _film(7, "Never Rented Love", 2012, "2.99", "XX"),
        _film(8, "Delta", 2015, "4.99", "PG-13"),
    ],
    "category": [
        (1, "Animation", None),
        (2, "drama", None),
        (3, "Travel", None),
        (4, "Documentary", None),
        (5, "Horror", None),
        (6, "Free", None),
    ],
    "film_category": [
        (1, 1, None),
        (2, 1, None),
        (3, 1, None),
        (5, 1, None),
        (4, 2, None),
        (8, 2, None),
        (1, 3, None),
        (6, 5, None),
        (7, 5, None),
        (2, 6, None),
    ],
    "actor": [
        (1, "ANN", "BELL", None),
        (2, "CARL", "DUNN", None),
        (3, "EVE", "FORD", None),
        (4, "ANN", "BELL", None),
        (5, "NO", "FILMS", None),
    ],
    "film_actor": [
        (1, 1, None),
        (1, 2, None),
        (1, 4, None),
        (1, 8, None),
        (2, 3, None),
        (3, 7, None),
        (3, 3, None),
        (4, 6, None),
        (4, 4, None),
    ],
    "inventory": [
        (10, 1, 1, None),
        (11, 1, 2, None),
        (20, 2, 1, None),
        (30, 3, 2, None),
        (40, 4, 2, None),
        (60, 6, 1, None),
        (70, 7, 3, None),
        (80, 8, 3, None),
    ],
    "store": [(1, 1), (2, 2), (3, 3), (4, 2)],
    "address": [
        (1, "1 Elm", "Flat 2", "North", 1),
        (2, "2 Oak", None, "East", 1),
        (3, "2 Oak", None, "East", 2),
        (4, "9 Far", None, None, 3),
    ],
    "city": [(1, 1), (2, 2), (3, 3)],
    "country": [(1, "Brazil"), (2, "Peru"), (3, "Chile")],
    "customer": [
        (1, 1, "SAM", "HILL", "sam@mail.test", 1, 1, None),
        (2, 1, "TOM", "KING", "tom@post.test", 2, 1, None),
        (3, 2, "UNA", "LANE", "una@mail.test", 3, 1, None),
        (4, 2, "VIC", "MOSS", "vic@mail.test", 4, 1, None),
    ],
    "staff": [(1, "Wes", "Noon"), (2, "Xia", "Park"), (3, "Yan", "Reed")],
    "rental": [
        (100, T(2017, 1, 1), 10, 1, T(2017, 1, 3), 1, None),
        (101, T(2017, 2, 1), 11, 2, T(2017, 2, 3), 1, None),
        (102, T(2017, 2, 1), 10, 1, None, 2, None),
        (103, T(2017, 3, 1), 20, 1, T(2017, 3, 2), 2, None),
        (104, T(2017, 3, 31), 30, 3, T(2017, 4, 2), 1, None),
        (105, T(2017, 4, 1), 40, 2, T(2017, 4, 9), 1, None),
        (106, T(2017, 5, 1), 60, 3, None, 2, None),
        (107, T(2017, 6, 1), 80, 2, T(2017, 6, 9), 1, None),
    ],
    "payment": [
        (900, 1, 1, 100, D("2.00"), T(2017, 1, 1)),
        (901, 2, 1, 101, D("3.00"), T(2017, 3, 31, 23, 59, 59)),
        (902, 1, 2, 102, D("4.00"), T(2017, 4, 1)),
        (903, 1, 2, 103, D("0.00"), T(2017, 2, 1)),
        (904, 3, 1, 104, D("5.00"), T(2017, 4, 2)),
        (905, 2, 1, 105, D("7.00"), T(2017, 12, 31, 23, 0)),
        (906, 3, 2, 106, D("1.00"), T(2017, 5, 1)),
        # The larger key carries the earlier date: the key decides.
        (907, 2, 1, 107, D("6.00"), T(2017, 1, 2)),
        # A payment whose rental is gone.
        (908, 4, 3, 999, D("9.00"), T(2017, 7, 1)),
        (909, 3, 2, 106, D("8.00"), T(2018, 1, 1)),
    ],
}


def film_tables(spark):
    return {name: inline_rows(spark, ROWS[name], schema) for name, schema in SCHEMAS.items()}
