"""Which dataset a file belongs to, from its name."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import contains_ignoring_case

# Name tokens in the order they are tried, and the spec each one selects.
ROUTES = (
    ("BalanceSheet", "balance_sheet"),
    ("TPSClaims", "trizetto_claims"),
    ("TPSPayments", "trizetto_payments"),
    ("profitAndLoss", "p_and_l"),
    ("Invoices", "invoice"),
    ("Paymnt", "payments"),
    ("Supplier", "supplier"),
    ("transaction", "transactions"),
    ("Codat_bills", "codat_bills"),
    ("Codat_billPayments", "codat_billPayments"),
)


def route_token(name: str) -> str | None:
    """The first token found in one file name, or None."""
    return next((token for token, _ in ROUTES if token.lower() in name.lower()), None)


def spec_name(token: str | None) -> str | None:
    return dict(ROUTES).get(token)


def route_column(name: Column) -> Column:
    """The first token found in a name column; null where none is."""
    def add(chain, route):
        return (F if chain is None else chain).when(contains_ignoring_case(name, route[0]), route[0])

    return reduce(add, ROUTES, None)


def spec_column(token: Column) -> Column:
    """The spec of a token; null for no token."""
    specs = F.create_map(*[F.lit(text) for route in ROUTES for text in route])
    return F.try_element_at(specs, token)


def add_route(df: DataFrame, name_column: str) -> DataFrame:
    routed = df.withColumn("dataset", route_column(F.col(name_column)))
    return routed.withColumn("spec", spec_column(F.col("dataset")))


def token_glob(folder: str, token: str) -> str:
    """A path pattern for the files and subfolders of a folder that have a token in their name, in any case."""
    letters = (f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in token)
    return f"{folder.rstrip('/')}/*{''.join(letters)}*"


def key_below(folder: str, path: Column) -> Column:
    """The part of a file path below a folder, which is what routing looks at."""
    place = re.sub(r"^[a-z0-9]+:/+", "/", folder.rstrip("/")).replace("%", "%25").replace(" ", "%20")
    return F.regexp_extract(path, re.escape(place) + "/(.*)$", 1)


def routed_to(token: str, folder: str, path: Column) -> Column:
    """Whether a file below ``folder`` belongs to the dataset of ``token`` (its first matching token)."""
    return route_column(key_below(folder, path)) == token
