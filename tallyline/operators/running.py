"""Running totals by month: what an asset had cost before a month began.

An opening row says, per workspace, product, asset type and asset, how much was
spent before the first day of a month, on which days first and last, and in
which currencies.  Openings merge by sum, minimum, maximum and union, so a
month's openings are those of an earlier month and the daily rows between.

Spend windows then need the daily rows of the last months alone: the total is
an opening and the days since, the year so far the difference of two openings.
A refresh that corrects the last days rewrites the openings of the months after
its window's start and leaves earlier months as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.costs import WINDOWS, window_sums
from tallyline.operators.versions import Change, VersionedTables
from tallyline.params import AsOf, as_of_date

KEYS = ("workspace_id", "product", "asset_type", "asset_id")
OPENINGS = (
    "month date, workspace_id string, product string, asset_type string, asset_id string, opening_dollars decimal(38,12), "
    "first_cost_date date, last_cost_date date, currency_codes array<string>"
)
#: The longest window that is not a calendar period, in days.
LONGEST = 90


def openings_table(spark: SparkSession, folder: str, double: bool = False) -> VersionedTables:
    ddl = OPENINGS.replace("decimal(38,12)", "double") if double else OPENINGS
    return VersionedTables(spark, folder, {"asset_cost_opening": (ddl, ["month"])})


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("opening_dollars").alias("opening_dollars"),
        F.min("first_cost_date").alias("first_cost_date"),
        F.max("last_cost_date").alias("last_cost_date"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("currency_codes")))).alias("currency_codes"),
    )


def _by_month(cost: DataFrame) -> DataFrame:
    """Daily rows summed to what they add to later openings, per month of their own."""
    return cost.groupBy(*KEYS, F.trunc("usage_date", "month").alias("own")).agg(
        F.sum("actual_daily_dollars").alias("opening_dollars"),
        F.min("usage_date").alias("first_cost_date"),
        F.max("usage_date").alias("last_cost_date"),
        F.collect_set("currency_code").alias("currency_codes"),
    )


def month_openings(cost: DataFrame, last: Column, base: DataFrame | None = None, since: Column | None = None) -> DataFrame:
    """Openings of the months after ``since`` up to that of ``last``.

    ``base`` are the openings of the month of ``since``; without it the history
    starts with the first row of ``cost``.  Only days from ``since`` on are read.
    """
    end = F.trunc(last, "month")
    if base is not None:
        start = F.trunc(since, "month")
        cost = cost.filter(F.col("usage_date") >= start)
    rows = _by_month(cost.filter(F.col("usage_date") < end))
    later = rows.select(*KEYS, "opening_dollars", "first_cost_date", "last_cost_date", "currency_codes", F.explode(F.sequence(F.add_months("own", 1), end, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    if base is not None:
        months = F.when(start < end, F.sequence(F.add_months(start, 1), end, F.expr("INTERVAL 1 MONTH")))
        carried = base.filter(F.col("month") == start).drop("month").withColumn("month", F.explode(months))
        later = later.unionByName(carried)
    return _merged(later, [*KEYS, "month"])


def refresh_openings(change: Change, cost: DataFrame, as_of: AsOf, lookback_days: int | None) -> None:
    """Openings after a refresh that rebuilt the last ``lookback_days`` days (None: all of them).

    Months up to the start of the window keep their files; where the openings
    of that month are not there yet, all are built.
    """
    name, day = "asset_cost_opening", as_of_date(as_of)
    live = change.live(name)
    known = None
    if lookback_days is not None:
        start = F.date_sub(day, lookback_days)
        known = live.filter(F.col("month") == F.trunc(start, "month"))
        if known.isEmpty():
            known = None
    if known is None:
        change.retire(name, live)
        change.add(name, month_openings(cost, day))
        return
    base = change.tables.read(name, change.base)
    change.retire(name, live.filter(F.col("month") > F.trunc(start, "month")))
    change.add(name, month_openings(cost, day, base, start))


def trailing_from_openings(openings: DataFrame, cost: DataFrame, as_of: AsOf) -> DataFrame:
    """``costs.trailing_cost`` from openings and the days since the month in which the longest window starts.

    Reads two months of openings and no day before the first of them; the
    openings up to that of ``as_of`` must be there.
    """
    today = as_of_date(as_of)
    month, year = F.trunc(F.date_sub(today, LONGEST), "month"), F.trunc(today, "year")
    recent = cost.filter(F.col("usage_date") >= month)
    sums = window_sums(cost, as_of)
    days = recent.groupBy(*KEYS).agg(
        *[s.alias(c) for c, s in sums.items()],
        F.min("usage_date").alias("first_cost_date"),
        F.max("usage_date").alias("last_cost_date"),
        F.collect_set("currency_code").alias("currency_codes"),
    )
    zero = F.lit(0).cast(cost.schema["actual_daily_dollars"].dataType)
    opened = openings.filter(F.col("month").isin(month, year))
    is_base, before_year = F.col("month") == month, (F.col("month") == year) & (year < month)
    # the year so far, where it began before the days that are read: what was spent between the two openings
    since_year = F.when(is_base & (year < month), F.col("opening_dollars")).when(before_year, -F.col("opening_dollars")).otherwise(zero)
    carried = opened.filter(is_base | before_year).select(
        *KEYS,
        *[(since_year if c == "year_to_date_dollars" else F.when(is_base, F.col("opening_dollars")).otherwise(zero) if c == "total_observed_dollars" else zero).alias(c) for c in WINDOWS],
        *[F.when(is_base, F.col(c)).alias(c) for c in ("first_cost_date", "last_cost_date", "currency_codes")],
    )
    return days.unionByName(carried).groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in WINDOWS],
        F.min("first_cost_date").alias("first_cost_date"),
        F.max("last_cost_date").alias("last_cost_date"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("currency_codes")))).alias("currency_codes"),
    ).filter("first_cost_date IS NOT NULL")
