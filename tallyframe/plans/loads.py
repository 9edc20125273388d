"""Table-change flows: each reads tables, applies change operators and returns their next states."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.ordering import sort_keys
from tallyframe.functions.periods import plus_days
from tallyframe.functions.text import mail_domain, same_text
from tallyframe.operators.changes import (
    Change,
    Fold,
    Lookup,
    append,
    assign_keys,
    delete_where,
    fill_defaults,
    new_rows,
    resolve_keys,
    update_where,
)
from tallyframe.operators.joins import absent_from, join_on, join_path, pair_with_one
from tallyframe.operators.quality import require_new_rows
from tallyframe.plans.reports import first_eligible
from tallyframe.sources.definitions import TableDef


def named(table: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """People with this first and last name in any letter case."""
    return table.filter(same_text(F.col("first_name"), first) & same_text(F.col("last_name"), last))


def load_table(
    definition: TableDef,
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    fold: Fold = "lower",
    lookups: Sequence[Lookup] = (),
    alternatives: Sequence[Sequence[str]] = (),
    parents: Mapping[str, DataFrame] | None = None,
    order: Sequence[str] = (),
) -> Change:
    """One idempotent load: resolve keys, drop rows already present, fill defaults, number, check, append.

    The checks read the new rows, and of the target the rows that share a key with
    them, so duplicates and rows without a parent raise before anything is written.
    """
    resolved = resolve_keys(batch, lookups)
    absent = resolved
    for key in [keys, *alternatives]:
        absent = new_rows(target, absent, key, fold)
    filled = fill_defaults(absent, definition.defaults())
    if definition.generated:
        filled = assign_keys(filled, target, definition.generated, sort_keys(*order))
    change = append(target, filled)
    require_new_rows(change.rows, target, definition, parents or {})
    return change


def stock_films(
    *,
    films: DataFrame,
    stores: DataFrame,
    addresses: DataFrame,
    copies: DataFrame,
    titles: Sequence[str],
    address: str,
    now: Column,
) -> Change:
    """Put one copy of each listed film into the store at an address, unless it has one.

    Of several addresses with that text the smallest key is taken.
    """
    wanted = films.filter(F.upper("title").isin([title.upper() for title in titles])).select("film_id")
    place = addresses.filter(same_text(F.col("address"), address)).agg(F.min("address_id").alias("address_id"))
    here = stores.filter(F.col("address_id") == place.scalar())
    rows = pair_with_one(wanted, here, {"store_id": "store_id"})
    rows = absent_from(rows, copies, ["film_id", "store_id"]).withColumn("last_update", now)
    return append(copies, assign_keys(rows, copies, "inventory_id", sort_keys("film_id")))


def take_over_customer(
    *,
    customers: DataFrame,
    rentals: DataFrame,
    payments: DataFrame,
    addresses: DataFrame,
    first: str,
    last: str,
    least: int,
    now: Column,
) -> Change:
    """Give the first customer with enough rentals and payments a new name, mail and address.

    A customer who already bears the name is left alone. The mail domain is that
    of the smallest customer key, the address the first by district and key.
    """
    chosen = first_eligible(
        customers=customers, rentals=rentals, payments=payments, least_rentals=least, least_payments=least
    )
    domain = customers.agg(F.min_by(mail_domain(F.col("email")), "customer_id").alias("domain")).scalar()
    by_district = F.struct(F.col("district").isNull(), F.col("district"), F.col("address_id"))
    home = addresses.agg(F.min_by("address_id", by_district).alias("address_id")).scalar()
    renamed = same_text(F.col("first_name"), first) & same_text(F.col("last_name"), last)
    return update_where(
        customers,
        {
            "first_name": F.lit(first),
            "last_name": F.lit(last),
            "email": F.concat(F.lit(f"{first}.{last}".lower() + "@"), domain),
            "address_id": home,
            "last_update": now,
        },
        keys=chosen,
        on=["customer_id"],
        unless=renamed,
    )


def forget_customer(
    *, customers: DataFrame, rentals: DataFrame, payments: DataFrame, first: Column | str, last: Column | str
) -> dict[str, Change]:
    """Remove a customer's payments, then rentals; two customers of the name are an error, none removes nothing."""
    theirs = F.col("customer_id") == named(customers, first, last).select("customer_id").scalar()
    return {name: delete_where(table, where=theirs) for name, table in (("payment", payments), ("rental", rentals))}


def derive_rentals(
    *,
    copies: DataFrame,
    films: DataFrame,
    customer: DataFrame,
    staff: DataFrame,
    rentals: DataFrame,
    wanted: Column,
    moment: dt.datetime,
    now: Column,
) -> Change:
    """Rent every copy of the wanted films to one customer, unless that customer had the copy before.

    The return date follows from the film's rental duration; the staff member is
    the one with the largest key.
    """
    durations = films.filter(wanted).select("film_id", "rental_duration")
    chosen = join_on(copies.select("inventory_id", "film_id"), durations, ["film_id"])
    rows = pair_with_one(chosen, customer, {"customer_id": "customer_id"})
    # Only this customer's rentals can be in the way.
    theirs = rentals.filter(F.col("customer_id") == customer.select("customer_id").scalar()).select("inventory_id")
    rows = absent_from(rows, theirs, ["inventory_id"])
    start = F.lit(moment).cast("timestamp_ntz")
    rows = rows.select(
        start.alias("rental_date"),
        "inventory_id",
        "customer_id",
        plus_days(start, F.col("rental_duration")).alias("return_date"),
        staff.agg(F.max("staff_id").alias("staff_id")).scalar().alias("staff_id"),
        now.alias("last_update"),
    )
    return append(rentals, assign_keys(rows, rentals, "rental_id", sort_keys("inventory_id")))


def derive_payments(
    *,
    rentals: DataFrame,
    copies: DataFrame,
    films: DataFrame,
    customer: DataFrame,
    payments: DataFrame,
    wanted: Column,
    moment: dt.datetime,
) -> Change:
    """Pay one customer's rentals of the wanted films at the film's rate, unless already paid.

    ``rentals`` is the table after renting, so the new rentals are seen.
    """
    theirs = rentals.filter(F.col("customer_id") == customer.select("customer_id").scalar())
    rented = join_path(
        theirs.select("rental_id", "customer_id", "staff_id", "inventory_id"),
        [
            (copies.select("inventory_id", "film_id"), ["inventory_id"]),
            (films.filter(wanted).select("film_id", "rental_rate"), ["film_id"]),
        ],
    )
    unpaid = new_rows(payments, rented, ["rental_id"])
    rows = unpaid.select(
        "customer_id",
        "staff_id",
        "rental_id",
        F.col("rental_rate").alias("amount"),
        F.lit(moment).cast("timestamp_ntz").alias("payment_date"),
    )
    return append(payments, assign_keys(rows, payments, "payment_id", sort_keys("rental_id")))
