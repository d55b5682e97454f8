"""Billing inputs: the usage fact and the price books."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.params import OPEN_END, AsOf, as_of_date


def scan_usage(
    usage: DataFrame,
    as_of: AsOf,
    lookback_days: int,
    product: str | None = None,
    sku_not_ilike: str | None = None,
    id_col: str = "cluster_id",
    sku_photon_like: str = "%PHOTON%",
) -> DataFrame:
    """Usage rows of ``[as_of - lookback, as_of)`` that name an asset.

    Filters sit on stored columns, so dates prune partitions and only the one
    nested id field is read.
    """
    day = as_of_date(as_of)
    rows = usage.filter((F.col("usage_date") >= F.date_sub(day, lookback_days)) & (F.col("usage_date") < day))
    if product is not None:
        rows = rows.filter(F.col("billing_origin_product") == product)
    if sku_not_ilike is not None:
        rows = rows.filter(~F.col("sku_name").ilike(sku_not_ilike))
    ident = F.col(f"usage_metadata.{id_col}")
    return rows.filter(ident.isNotNull()).select(
        "workspace_id",
        "usage_date",
        "usage_start_time",
        ident.alias(id_col),
        "sku_name",
        F.col("sku_name").ilike(sku_photon_like).alias("photon"),
        F.col("usage_quantity").alias("dbus"),
    )


def scan_price_book(
    book: DataFrame, keys: Sequence[str] = ("sku_name",), price: str | Column = "pricing.default"
) -> DataFrame:
    """Price rows with a closed end: ``keys``, ``price_start_time``, ``price_end_time``, ``unit_price``."""
    amount = F.col(price) if isinstance(price, str) else price
    end = F.coalesce("price_end_time", F.lit(OPEN_END).cast("timestamp"))
    return book.select(
        *keys, "price_start_time", end.alias("price_end_time"), amount.alias("unit_price"), "currency_code"
    )


def list_price() -> Column:
    """The list book's price: the effective list price when there is one."""
    return F.coalesce("pricing.effective_list.default", "pricing.default")
