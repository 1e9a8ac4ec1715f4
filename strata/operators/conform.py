"""Conformed layer: typed, normalised, deduplicated tables.

Each table transform is one ``withColumns`` (a single Project), so a
table is conformed in one pass after the dedup shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from strata import fixed
from strata.functions import columns as C
from strata.operators.tables import dedup_by_key, move_to_end


@dataclass(frozen=True)
class ConformOptions:
    """``blank_as_missing``: ``''``/whitespace-only text also gets the default.
    ``all_whitespace``: normalised text also loses tabs/newlines at the ends."""

    blank_as_missing: bool = False
    all_whitespace: bool = False


DEFAULT = ConformOptions()


def _ids(*names: str) -> dict:
    return {n: C.strip_prefix(n, fixed.ID_PREFIXES[n]) for n in names}


def conform_payments(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """IDs stripped, payment type normalised, value as money."""
    return df.withColumns({
        **_ids("payment_id", "order_id"),
        "payment_type": C.trim_lower("payment_type", o.all_whitespace),
        "payment_value": C.to_money("payment_value", fixed.MONEY),
    })


def conform_customers(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """ID stripped, e-mail and state defaulted, signup date parsed."""
    return df.withColumns({
        **_ids("customer_id"),
        "email": C.fill_default("email", fixed.NOT_INFORMED, o.blank_as_missing),
        "state": C.fill_default("state", fixed.UNKNOWN, o.blank_as_missing),
        "signup_date": C.to_date("signup_date"),
    })


def conform_orders(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """IDs stripped (missing customer -> sentinel), date parsed, status normalised, amount as money."""
    return df.withColumns({
        **_ids("order_id"),
        "customer_id": C.strip_or_sentinel(
            "customer_id", fixed.ID_PREFIXES["customer_id"], fixed.UNKNOWN, o.blank_as_missing
        ),
        "order_date": C.to_date("order_date"),
        "status": C.trim_lower("status", o.all_whitespace),
        "total_amount": C.to_money("total_amount", fixed.MONEY),
    })


def conform_order_items(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """IDs stripped, quantity as int, unit price as money."""
    return df.withColumns({
        **_ids("order_id", "item_id", "product_id"),
        "quantity": C.to_int("quantity"),
        "unit_price": C.to_money("unit_price", fixed.MONEY),
    })


def conform_products(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """ID stripped, name defaulted, price as money, stock as int."""
    return df.withColumns({
        **_ids("product_id"),
        "product_name": C.fill_default("product_name", fixed.UNNAMED_PRODUCT, o.blank_as_missing),
        "price": C.to_money("price", fixed.MONEY),
        "stock": C.to_int("stock"),
    })


def conform_reviews(df: DataFrame, o: ConformOptions = DEFAULT) -> DataFrame:
    """IDs stripped, rating as int, comment defaulted, review date parsed."""
    return df.withColumns({
        **_ids("review_id", "order_id", "customer_id"),
        "rating": C.to_int("rating"),
        "comment": C.fill_default("comment", fixed.NO_COMMENT, o.blank_as_missing),
        "review_date": C.to_date("review_date"),
    })


TRANSFORMS: dict[str, Callable[[DataFrame, ConformOptions], DataFrame]] = {
    "payments": conform_payments,
    "customers": conform_customers,
    "orders": conform_orders,
    "order_items": conform_order_items,
    "products": conform_products,
    "reviews": conform_reviews,
}


def shift_audit_zone(df: DataFrame, zone: str = fixed.LOCAL_ZONE, column: str = fixed.AUDIT_COLUMN) -> DataFrame:
    """Render the UTC audit stamp as ``zone`` wall-clock time."""
    return df.withColumn(column, C.utc_to_zone(column, zone))


def conform_table(
    df: DataFrame,
    table: str,
    keys: tuple | list | None = None,
    options: ConformOptions = DEFAULT,
    zone: str | None = fixed.LOCAL_ZONE,
    normalize_first: bool = False,
    dedup: Callable[[DataFrame, list], DataFrame] = dedup_by_key,
) -> DataFrame:
    """dedup by natural key -> typed transform -> audit zone -> audit last.

    By default duplicates are removed on the raw key text, so ``O1`` and
    ``O000001`` both survive (and the uniqueness check reports them);
    ``normalize_first`` deduplicates on the normalised key instead. For a
    frame read from files ``dedup`` may be ``dedup_repeated``.
    """
    keys = list(keys or fixed.NATURAL_KEYS[table])
    transform = TRANSFORMS[table]
    if normalize_first:
        out = dedup(transform(df, options), keys)
    else:
        out = transform(dedup(df, keys), options)
    if fixed.AUDIT_COLUMN in out.columns:
        if zone:
            out = shift_audit_zone(out, zone)
        out = move_to_end(out, fixed.AUDIT_COLUMN)
    return out
