"""Effective-dated pricing, node rates and exclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyline.functions.exprs import matches_rules
from tallyline.functions.scale import local_frame
from tallyline.params import AsOf, ExclusionRules, as_of_date, as_of_ts
from tallyline.sources.pricing_docs import ACCELERATED_WORKLOAD
from tallyline.sources.usage import scan_usage

# --- price books ------------------------------------------------------------


def _tagged(book: DataFrame, prefix: str) -> DataFrame:
    return book.select(*[F.col(c).alias(f"{prefix}{c}") for c in book.columns])


def _in_force(keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, and the usage starts within the half-open price interval."""
    on = (F.col("usage_start_time") >= F.col(f"{prefix}price_start_time")) & (
        F.col("usage_start_time") < F.col(f"{prefix}price_end_time")
    )
    for key in keys:
        on = on & (F.col(key) == F.col(f"{prefix}{key}"))
    return on


def _amount(joined: DataFrame, quantity: str, price: Column, price_type: T.DataType) -> Column:
    """Quantity times price.

    Two wide decimals multiply to few decimal places (38 digits is the limit),
    so the parts before and after the point are multiplied apart and added.
    The products keep 17 places each.
    """
    units, unit_type = F.col(quantity), joined.schema[quantity].dataType
    decimals = isinstance(unit_type, T.DecimalType) and isinstance(price_type, T.DecimalType)
    if decimals and unit_type.precision + price_type.precision + 1 > T.DecimalType(38).precision:
        whole_units, whole_price = F.floor(units).cast("decimal(19,0)"), F.floor(price).cast("decimal(19,0)")
        part_units = (units - whole_units).cast("decimal(18,18)")
        part_price = (price - whole_price).cast("decimal(18,18)")
        products = (whole_units * whole_price, whole_units * part_price, part_units * whole_price, part_units * part_price)
        return sum((p.cast("decimal(34,17)") for p in products[1:]), products[0].cast("decimal(34,17)")).cast("decimal(38,17)")
    return units * price


def price_usage(
    usage: DataFrame, book: DataFrame, keys: Sequence[str] = ("sku_name",), unpriced: str = "drop"
) -> DataFrame:
    """Attach the price in force when each usage row started.

    ``unpriced="drop"`` loses rows without a price, ``"zero"`` keeps them at 0
    dollars.  The book is broadcast when Spark finds it below its size limit;
    otherwise the join shuffles on ``keys`` and AQE splits hot SKUs.
    """
    if unpriced not in ("drop", "zero"):
        raise ValueError(f"unpriced must be 'drop' or 'zero', not {unpriced!r}")
    how = "inner" if unpriced == "drop" else "left"
    joined = usage.join(_tagged(book, "_b_"), _in_force(keys, "_b_"), how)
    price = F.col("_b_unit_price")
    kind = book.schema["unit_price"].dataType
    rate = price if unpriced == "drop" else F.coalesce(price, F.lit(0).cast(kind))
    return joined.select(
        *usage.columns, price.alias("dollars_per_dbu"), _amount(joined, "dbus", rate, kind).alias("dollars")
    )


#: Places of one key that are looked up together.
BLOCK = 64


def overlay_pieces(contract: DataFrame, list_: DataFrame, keys: Sequence[str] = ("account_id", "cloud", "sku_name")) -> DataFrame:
    """The disjoint intervals of both books per key, each once, with all prices in force: ``_c`` of the contract, ``_l`` of the list.

    A sweep over the borders of both books numbers the places of a key.  Prices
    are dealt out to blocks of places, not to every place that they cover, and
    picked for each place inside their block; so what is moved grows with the
    books and not with the pairs of prices.  Empty intervals and places without
    a price have no row.
    """
    start, end = "price_start_time", "price_end_time"

    def side(book: DataFrame, contract_side: bool) -> DataFrame:
        return book.filter(F.col(start) < F.col(end)).select(
            *keys, F.lit(contract_side).alias("_contract"), F.array(start, end).alias("_ends"), F.struct("unit_price", "currency_code").alias("_price")
        )

    rows = side(contract, True).unionByName(side(list_, False)).withColumn("_row", F.monotonically_increasing_id())
    by_time = Window.partitionBy(*keys).orderBy("_at")
    borders = rows.select(*keys, "_row", "_contract", "_price", F.explode("_ends").alias("_at")).withColumn("_place", F.dense_rank().over(by_time))
    spans = borders.groupBy(*keys, "_row", "_contract", "_price").agg(F.min("_place").alias("_low"), F.max("_place").alias("_high"))

    def block(place: Column) -> Column:
        return F.floor(place / BLOCK)

    dealt = spans.select(*keys, "_contract", F.struct("_low", "_high", "_price").alias("_span"), F.explode(F.sequence(block(F.col("_low")), block(F.col("_high") - 1))).alias("_block"))
    places = borders.groupBy(*keys, "_place").agg(F.first("_at").alias("_at"))
    places = places.withColumn("_until", F.lead("_at").over(Window.partitionBy(*keys).orderBy("_place")))
    places = places.select(*keys, block(F.col("_place")).alias("_block"), F.struct("_place", "_at", "_until").alias("_here"))
    # the blocks of a key are met by many tasks: the sweep has all places of a key in one
    met = dealt.unionByName(places, allowMissingColumns=True).repartition(*keys, "_block").groupBy(*keys, "_block").agg(
        F.collect_list(F.when(F.col("_contract"), F.col("_span"))).alias("_c"),
        F.collect_list(F.when(~F.col("_contract"), F.col("_span"))).alias("_l"),
        F.collect_list("_here").alias("_places"),
    )
    met = met.select(*keys, "_c", "_l", F.explode("_places").alias("_here"))

    def holds(span: Column) -> Column:
        return (span["_low"] <= F.col("_here._place")) & (F.col("_here._place") < span["_high"])

    # places without a price fall out at sight, so that the prices of the others are picked once and not for the filter too
    met = met.filter(F.exists("_c", holds) | F.exists("_l", holds))
    picked = (F.filter(spans, holds).getField("_price").alias(spans) for spans in ("_c", "_l"))
    return met.select(*keys, F.col("_here._at").alias(start), F.col("_here._until").alias(end), *picked)


def each_price(pieces: DataFrame, prefix: str = "") -> DataFrame:
    """``overlay_pieces``, or rows joined with them, with one row for every pair of prices in force, in place of ``_c`` and ``_l``.

    Rows without a price in either book fall out.  The pairs are made in place, nothing is moved.
    """
    kept = [c for c in pieces.columns if c not in (f"{prefix}_c", f"{prefix}_l")]
    rows = pieces.withColumn("_own", F.size(f"{prefix}_c") > 0).withColumn("_cp", F.explode_outer(f"{prefix}_c")).withColumn("_lp", F.explode_outer(f"{prefix}_l"))
    return rows.select(
        *kept,
        F.coalesce("_cp.unit_price", "_lp.unit_price").alias(f"{prefix}unit_price"),
        F.coalesce("_cp.currency_code", "_lp.currency_code").alias(f"{prefix}currency_code"),
        F.when(F.col("_own"), "ACCOUNT_PRICE").otherwise("LIST_PRICE").alias(f"{prefix}pricing_source"),
    ).filter(F.col(f"{prefix}unit_price").isNotNull())


def overlay_books(contract: DataFrame, list_: DataFrame, keys: Sequence[str] = ("account_id", "cloud", "sku_name")) -> DataFrame:
    """Both books as one: disjoint intervals per key, each with the contract price, else the list price.

    Where a book itself overlaps, a piece has one row for every pair of prices
    in force.  Empty intervals and pieces without a price in either book have no row.
    """
    return each_price(overlay_pieces(contract, list_, keys))


def price_with_fallback(
    usage: DataFrame,
    contract: DataFrame,
    list_: DataFrame,
    keys: Sequence[str] = ("account_id", "cloud", "sku_name"),
    days: tuple[AsOf, AsOf] | None = None,
) -> DataFrame:
    """Contract price, else list price; rows with neither are dropped; the source is labelled.

    One join with the intervals of both books, each of which comes once with all
    its prices; the pairs of overlapping prices are made after the join.  Spark
    broadcasts the intervals when they are few; otherwise the join shuffles on
    ``keys``, and AQE splits a hot SKU.  For books with many prices per SKU give
    ``days``, a first and a last day: intervals are then dealt out to the days
    that they touch, and the join is on keys and day, so that a row meets only
    the prices of its own day.  Usage before the first or after the last day
    counts to that day's rows.
    """
    book = overlay_pieces(contract, list_, keys)
    if days is not None:
        first, last = (as_of_date(d) for d in days)

        def clipped(day: Column) -> Column:
            return F.greatest(F.least(day, last), first)

        final = F.to_date(F.col("price_end_time") - F.expr("INTERVAL 1 MICROSECOND"))
        book = book.withColumn("price_day", F.explode(F.sequence(clipped(F.to_date("price_start_time")), clipped(final))))
        usage = usage.withColumn("_b_day", clipped(F.to_date("usage_start_time")))
    # A partitioning of its own: otherwise the join would use the sweep's, and Spark splits a hot key only between two plain exchanges.
    joined = _tagged(book if days is not None else book.hint("rebalance"), "_b_")
    match = _in_force(keys, "_b_")
    joined = usage.join(joined, match if days is None else match & (F.col("_b_day") == F.col("_b_price_day")))
    names = [c for c in usage.columns if c != "_b_day"]
    joined = each_price(joined.select(*names, "_b__c", "_b__l"), "_b_")
    return joined.select(
        *names,
        _amount(joined, "usage_quantity", F.col("_b_unit_price"), joined.schema["_b_unit_price"].dataType).alias("actual_dollars"),
        F.col("_b_currency_code").alias("currency_code"),
        F.col("_b_pricing_source").alias("pricing_source"),
    )


# --- exclusions -------------------------------------------------------------


def resolve_exclusions(usage: DataFrame, scd: DataFrame, rules: ExclusionRules) -> DataFrame:
    """``(workspace_id, cluster_id)`` to leave out, of the clusters that have usage in ``usage``.

    A listed id is left out in every workspace, a name or creator rule only in
    the workspace of the row that matches it in any version.
    """
    active = usage.select("workspace_id", "cluster_id").distinct()
    matched = (
        scd.filter(matches_rules(rules, F.col("cluster_name"), F.col("owned_by")))
        .select("workspace_id", "cluster_id")
        .join(active, ["workspace_id", "cluster_id"], "left_semi")
    )
    ids = local_frame(usage.sparkSession, [(i,) for i in rules.ids], "cluster_id string")
    listed = active.join(ids, "cluster_id", "left_semi").select("workspace_id", "cluster_id")
    return matched.unionByName(listed).distinct()


def apply_exclusions(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop the listed clusters of each workspace.  Works on raw usage or, much cheaper, on cluster-days."""
    return df.join(ids, ["workspace_id", "cluster_id"], "left_anti")


def priced_usage(
    usage: DataFrame,
    book: DataFrame,
    excluded: DataFrame | None,
    as_of: AsOf,
    lookback_days: int,
    product: str | None = "ALL_PURPOSE",
    sku_not_ilike: str | None = "%SERVERLESS%",
    unpriced: str = "drop",
) -> DataFrame:
    """Scanned, non-excluded, priced usage; ``book`` comes from ``scan_price_book``."""
    rows = scan_usage(usage, as_of, lookback_days, product, sku_not_ilike)
    if excluded is not None:
        rows = apply_exclusions(rows, excluded)
    return price_usage(rows, book, unpriced=unpriced)


# --- node rates -------------------------------------------------------------


def expand_fleet_aliases(rates: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add one row ``<fleet>.<size>`` for every ``<base>.<size>`` of an aliased family."""
    dotted = rates.filter(F.col("instance").contains(".")).withColumn(
        "base_family", F.substring_index("instance", ".", 1)
    )
    size = F.regexp_replace("instance", r"^[^.]*\.", "")
    clones = dotted.join(aliases, "base_family").withColumn("instance", F.concat_ws(".", "fleet_family", size))
    return rates.unionByName(clones.select(*rates.columns))


def customer_rates(priced: DataFrame) -> DataFrame:
    """The SKU and price each workspace pays with and without acceleration.

    The most recent usage decides, then the SKU name, so the answer is stable
    when several SKUs or a price change fall in the window.
    """
    seen = priced.groupBy("workspace_id", "photon", "sku_name", "dollars_per_dbu").agg(
        F.max("usage_start_time").alias("last_used")
    )
    newest = F.max_by(
        F.struct("sku_name", "dollars_per_dbu"), F.struct("last_used", "sku_name", "dollars_per_dbu")
    )
    return seen.groupBy("workspace_id", "photon").agg(newest.alias("r")).select("workspace_id", "photon", "r.*")


def pricing_rates(doc: DataFrame, aliases: DataFrame, customer: DataFrame, cloud: str, refreshed_at: AsOf | None = None) -> DataFrame:
    """Dollars per hour of every node type; rows whose flag the workspace never used are dropped.

    With ``refreshed_at`` every row carries the time of the refresh.
    """
    stamp = [] if refreshed_at is None else [as_of_ts(refreshed_at).alias("refreshed_at")]
    nodes = expand_fleet_aliases(doc, aliases).select(
        F.lit(cloud).alias("cloud"),
        F.col("instance").alias("node_type"),
        F.col("compute").alias("workload"),
        F.col("compute").endswith(ACCELERATED_WORKLOAD).alias("photon"),
        F.col("dburate").cast("double").alias("dbu_per_hour"),
    )
    return nodes.join(customer, "photon").select(
        "workspace_id",
        "cloud",
        "node_type",
        "workload",
        "photon",
        "sku_name",
        "dbu_per_hour",
        "dollars_per_dbu",
        (F.col("dbu_per_hour") * F.col("dollars_per_dbu")).alias("dollars_per_hour"),
        *stamp,
    )
