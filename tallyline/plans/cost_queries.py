"""Registered queries: sources, pricing, baselines, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.exprs import glob_to_regex, weekday_only
from tallyline.functions.scale import latest_per_key, local_frame
from tallyline.operators import baseline as B
from tallyline.operators import pricing as P
from tallyline.operators import replay as R
from tallyline.operators.state import overwrite_table
from tallyline.params import Thresholds, as_of_date
from tallyline.plans import bindings as b
from tallyline.plans.bindings import AS_OF, LOOKBACK, r6, text_time, with_sql
from tallyline.plans.registry import query
from tallyline.sources.config import fleet_aliases
from tallyline.sources.pricing_docs import load_pricing_document
from tallyline.sources.usage import scan_usage

PRODUCT, NO_SERVERLESS = "ALL_PURPOSE", "%SERVERLESS%"
PRICED = (b.USAGE_SQL, b.BOOK_SQL, b.SCAN_SQL, b.PRICED_SQL)
HOURLY = (b.USAGE_SQL, b.BOOK_SQL, b.LEFT_PRICED_SQL, b.HOURLY_SQL)


def scanned(spark: SparkSession, sf: str) -> DataFrame:
    return scan_usage(b.usage(spark, sf), AS_OF, LOOKBACK, PRODUCT, NO_SERVERLESS)


def priced(spark: SparkSession, sf: str) -> DataFrame:
    return P.priced_usage(b.usage(spark, sf), b.price_book(spark), None, AS_OF, LOOKBACK)


def baseline(spark: SparkSession, sf: str) -> DataFrame:
    return B.workspace_baseline(stored_days(spark, priced(spark, sf)), AS_OF, LOOKBACK)


def stored_days(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Weekday cluster-days as a written table, for statistics that read them more than once."""
    return overwrite_table(B.cluster_day_cost(rows), b.scratch(spark, "days"))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """All products, unpriced usage at zero dollars."""
    rows = P.priced_usage(
        b.usage(spark, sf), b.price_book(spark), None, AS_OF, LOOKBACK, product=None, sku_not_ilike=None, unpriced="zero"
    )
    return B.hourly_spend(rows)


def stored_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly table written once: a replay reads it for the baseline and again for the hours.

    Left lazy, the baseline's weekday filter would sink into its own copy of the
    usage scan and the whole fact would be read, priced and shuffled twice.
    """
    return overwrite_table(hourly(spark, sf), b.scratch(spark, "hourly"))


def rolling(hours: DataFrame) -> DataFrame:
    return B.rolling_baseline(B.cluster_day_cost(hours), b.ROLLING_DAYS)


# --- scans and filters ------------------------------------------------------


@query(
    "scan_usage",
    with_sql(b.USAGE_SQL, b.SCAN_SQL)
    + """ SELECT workspace_id, usage_date, strftime(usage_start_time, '%Y-%m-%d %H:%M:%S') AS started, cluster_id, sku_name,
      contains(sku_name, 'PHOTON') AS photon, qty AS dbus FROM scanned""",
)
def q_scan_usage(spark, sf):
    return scanned(spark, sf).select(
        "workspace_id", "usage_date", text_time("usage_start_time").alias("started"), "cluster_id", "sku_name", "photon", "dbus"
    )


@query(
    "scan_price_book",
    with_sql(b.USAGE_SQL, b.BOOK_SQL)
    + """ SELECT b.sku AS sku_name, strftime(b.s, '%Y-%m-%d %H:%M:%S') AS starts,
      strftime(b.e, '%Y-%m-%d %H:%M:%S') AS ends, round(b.p, 6) AS unit_price,
      count(u.event_id) AS usage_rows
      FROM book b LEFT JOIN usage u ON u.sku_name = b.sku AND u.usage_start_time >= b.s AND u.usage_start_time < b.e
      GROUP BY ALL""",
)
def q_scan_price_book(spark, sf):
    """The book, with how much usage each price applied to."""
    book = b.price_book(spark)
    used = P.price_usage(scan_usage(b.usage(spark, sf), AS_OF, LOOKBACK), book)
    counts = used.groupBy("sku_name", F.col("dollars_per_dbu").alias("unit_price")).agg(F.count("*").alias("n"))
    rows = book.join(counts, ["sku_name", "unit_price"], "left")
    return rows.select(
        "sku_name",
        text_time("price_start_time").alias("starts"),
        text_time("price_end_time").alias("ends"),
        r6("unit_price"),
        F.coalesce("n", F.lit(0)).alias("usage_rows"),
    )


@query(
    "filter_ilike",
    with_sql(b.USAGE_SQL)
    + """ SELECT product, sku_name ILIKE '%photon%' AS photon, count(*) AS n, round(sum(qty), 6) AS qty FROM usage
      WHERE sku_name NOT ILIKE '%serverless%' GROUP BY ALL""",
)
def q_filter_ilike(spark, sf):
    u = b.usage(spark, sf).filter(~F.col("sku_name").ilike("%serverless%"))
    return u.groupBy(
        F.col("billing_origin_product").alias("product"), F.col("sku_name").ilike("%photon%").alias("photon")
    ).agg(F.count("*").alias("n"), r6("qty", F.sum("usage_quantity")))


@query(
    "filter_date_window",
    """WITH l AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice * (1 - l_discount) AS dollars FROM lineitem)
      SELECT l_suppkey, sum(CASE WHEN d >= DATE '2000-01-31' - 30 AND d < DATE '2000-01-31' THEN 1 ELSE 0 END)::BIGINT AS half_open,
      sum(CASE WHEN d BETWEEN DATE '2000-01-31' - 7 AND DATE '2000-01-31' - 1 THEN 1 ELSE 0 END)::BIGINT AS trailing_7,
      round(sum(dollars), 2) AS dollars
      FROM l WHERE d >= DATE '2000-01-31' - 365 AND d < DATE '2000-01-31' GROUP BY 1""",
)
def q_filter_date_window(spark, sf):
    day = as_of_date("2000-01-31")
    d = F.to_date("l_shipdate")
    line = b.table(spark, sf, "lineitem").filter(
        (F.col("l_shipdate") >= F.date_sub(day, 365)) & (F.col("l_shipdate") < day)
    )
    dollars = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return line.groupBy("l_suppkey").agg(
        F.count_if((d >= F.date_sub(day, 30)) & (d < day)).alias("half_open"),
        F.count_if(d.between(F.date_sub(day, 7), F.date_sub(day, 1))).alias("trailing_7"),
        F.round(F.sum(dollars), 2).alias("dollars"),
    )


@query(
    "filter_weekday",
    """SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS dollars FROM lineitem
      WHERE isodow(l_shipdate) - 1 < 5 GROUP BY 1""",
)
def q_filter_weekday(spark, sf):
    line = b.table(spark, sf, "lineitem").filter(weekday_only(F.to_date("l_shipdate")))
    return line.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("dollars")
    )


# --- node-rate documents ----------------------------------------------------

WORKLOADS = ("All-Purpose Compute", "All-Purpose Compute Photon")
DOC_SQL = """
doc AS (
  SELECT CASE p_partkey % 4 WHEN 0 THEN 'All-Purpose Compute' WHEN 1 THEN 'All-Purpose Compute Photon' ELSE 'Jobs Compute' END AS compute,
    CASE WHEN p_partkey % 5 < 3 THEN 'Premium' ELSE 'Standard' END AS plan,
    ['r5d', 'm5', 'c5', 'zz'][p_partkey % 4 + 1] || CASE WHEN p_partkey % 6 <> 5 THEN '.' || p_partkey || 'xlarge' ELSE '' END AS instance,
    p_size / 10.0 AS dburate
  FROM part)"""
ALIAS_SQL = """
alias AS (SELECT * FROM (VALUES ('rd-fleet','r5d'),('r-fleet','r5'),('md-fleet','m5d'),('m-fleet','m5'),('c-fleet','c5'),
  ('cd-fleet','c5d'),('i-fleet','i3')) t(fleet, base))"""
KEPT_SQL = """
kept AS (SELECT * FROM doc WHERE compute IN ('All-Purpose Compute', 'All-Purpose Compute Photon') AND plan = 'Premium')"""
EXPANDED_SQL = """
expanded AS (SELECT compute, instance, dburate FROM kept UNION ALL
  SELECT k.compute, a.fleet || substr(k.instance, length(a.base) + 1), k.dburate FROM kept k
  JOIN alias a ON starts_with(k.instance, a.base || '.'))"""


def document(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as node-rate records; accelerated rows carry the suffix in their name."""
    k = F.col("p_partkey")
    family = F.element_at(F.array(*map(F.lit, ("r5d", "m5", "c5", "zz"))), (k % 4 + 1).cast("int"))
    size = F.when(k % 6 != 5, F.concat(F.lit("."), k, F.lit("xlarge"))).otherwise("")
    return b.table(spark, sf, "part").select(
        F.when(k % 4 == 0, WORKLOADS[0]).when(k % 4 == 1, WORKLOADS[1]).otherwise("Jobs Compute").alias("compute"),
        F.when(k % 5 < 3, "Premium").otherwise("Standard").alias("plan"),
        F.concat(family, size, F.when(k % 4 == 1, " (Photon)").otherwise("")).alias("instance"),
        (F.col("p_size") / 10.0).cast("string").alias("dburate"),
    )


def rates_doc(spark, sf):
    return load_pricing_document(document(spark, sf), WORKLOADS, "Premium")


def _doc_columns(df):
    return df.select("compute", "instance", r6("dburate"))


@query(
    "load_pricing_document",
    with_sql(DOC_SQL, KEPT_SQL) + " SELECT compute, instance, round(dburate, 6) AS dburate FROM kept",
)
def q_load_pricing_document(spark, sf):
    return _doc_columns(rates_doc(spark, sf))


@query(
    "expand_fleet_aliases",
    with_sql(DOC_SQL, KEPT_SQL, ALIAS_SQL, EXPANDED_SQL)
    + " SELECT compute, instance, round(dburate, 6) AS dburate FROM expanded",
)
def q_expand_fleet_aliases(spark, sf):
    return _doc_columns(P.expand_fleet_aliases(rates_doc(spark, sf), fleet_aliases(spark)))


CUSTOMER_SQL = """
customer_rates AS (
  SELECT workspace_id, photon, sku_name, dollars_per_dbu FROM (
    SELECT *, row_number() OVER (PARTITION BY workspace_id, photon ORDER BY usage_start_time DESC, sku_name DESC) AS rn
    FROM priced) WHERE rn = 1)"""


@query(
    "customer_rates",
    with_sql(*PRICED, CUSTOMER_SQL)
    + " SELECT workspace_id, photon, sku_name, round(dollars_per_dbu, 6) AS dollars_per_dbu FROM customer_rates",
)
def q_customer_rates(spark, sf):
    return P.customer_rates(priced(spark, sf)).select("workspace_id", "photon", "sku_name", r6("dollars_per_dbu"))


@query(
    "pricing_rates",
    with_sql(*PRICED, CUSTOMER_SQL, DOC_SQL, KEPT_SQL, ALIAS_SQL, EXPANDED_SQL)
    + """ SELECT workspace_id, 'cloud-1' AS cloud, instance AS node_type, compute AS workload, photon, sku_name,
      round(dburate, 6) AS dbu_per_hour, round(dollars_per_dbu, 6) AS dollars_per_dbu,
      round(dburate * dollars_per_dbu, 6) AS dollars_per_hour
      FROM expanded JOIN customer_rates ON photon = (compute LIKE '%Photon')""",
)
def q_pricing_rates(spark, sf):
    rates = P.pricing_rates(rates_doc(spark, sf), fleet_aliases(spark), P.customer_rates(priced(spark, sf)), "cloud-1")
    return rates.select(
        "workspace_id", "cloud", "node_type", "workload", "photon", "sku_name", r6("dbu_per_hour"),
        r6("dollars_per_dbu"), r6("dollars_per_hour"),
    )


# --- pricing ----------------------------------------------------------------


@query(
    "price_usage_inner",
    with_sql(b.USAGE_SQL, b.BOOK_SQL)
    + """ SELECT u.workspace_id, u.cluster_id, u.sku_name, u.usage_date, round(u.qty, 6) AS dbus,
      round(b.p, 6) AS dollars_per_dbu, round(u.qty * b.p, 6) AS dollars
      FROM usage u JOIN book b ON b.sku = u.sku_name AND u.usage_start_time >= b.s AND u.usage_start_time < b.e""",
)
def q_price_usage_inner(spark, sf):
    rows = P.price_usage(scan_usage(b.usage(spark, sf), AS_OF, LOOKBACK), b.price_book(spark))
    return rows.select(
        "workspace_id", "cluster_id", "sku_name", "usage_date", r6("dbus"), r6("dollars_per_dbu"), r6("dollars")
    )


@query(
    "price_usage_left",
    with_sql(b.USAGE_SQL, b.BOOK_SQL, b.LEFT_PRICED_SQL)
    + """ SELECT workspace_id, cluster_id, sku_name, usage_date, round(qty, 6) AS dbus, round(dollars, 6) AS dollars
      FROM lpriced""",
)
def q_price_usage_left(spark, sf):
    rows = P.price_usage(scan_usage(b.usage(spark, sf), AS_OF, LOOKBACK), b.price_book(spark), unpriced="zero")
    return rows.select("workspace_id", "cluster_id", "sku_name", "usage_date", r6("dbus"), r6("dollars"))


@query(
    "price_with_fallback",
    with_sql(b.USAGE_SQL, b.CONTRACT_SQL, b.LIST_SQL, b.FALLBACK_SQL)
    + """ SELECT workspace_id, cluster_id, sku_name, usage_date, round(actual_dollars, 6) AS actual_dollars, currency_code,
      pricing_source FROM fpriced""",
)
def q_price_with_fallback(spark, sf):
    rows = P.price_with_fallback(b.usage(spark, sf), b.account_prices(spark), b.list_prices(spark))
    return rows.select(
        "workspace_id", F.col("usage_metadata.cluster_id").alias("cluster_id"), "sku_name", "usage_date",
        r6("actual_dollars"), "currency_code", "pricing_source",
    )


# Shipments as usage, orders as a contract book with many short, overlapping prices, customers as the list book.
MANY_BOOKS_SQL = """
shipped AS (SELECT l_orderkey, l_linenumber, l_partkey % 150 AS sku, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber AS BIGINT)) AS at,
  l_quantity AS qty FROM lineitem),
deals AS (SELECT o_custkey % 150 AS sku, CAST(o_orderdate AS TIMESTAMP) AS s, CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 9 AS INTEGER)) AS e,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS p FROM orders),
tariff AS (SELECT c_custkey % 150 AS sku, TIMESTAMP '1992-01-01' + to_days(CAST(c_custkey * 7 % 2500 AS INTEGER)) AS s,
  CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '9999-01-01' ELSE TIMESTAMP '1992-01-01' + to_days(CAST(c_custkey * 7 % 2500 + 200 AS INTEGER)) END AS e,
  c_acctbal AS p FROM customer)"""


def many_books(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Usage and two books of a thousand prices and more, which overlap, have empty intervals and lack some prices."""
    hours, days = F.make_interval(hours=F.col("l_linenumber").cast("int")), lambda n: F.make_interval(days=n.cast("int"))
    shipped = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 150).alias("sku_name"), (F.col("l_shipdate").cast("timestamp") + hours).alias("usage_start_time"),
        F.col("l_quantity").alias("usage_quantity"),
    )
    start = F.col("o_orderdate").cast("timestamp")
    deals = b.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 150).alias("sku_name"), start.alias("price_start_time"), (start + days(F.col("o_orderkey") % 9)).alias("price_end_time"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("unit_price"), F.lit("USD").alias("currency_code"),
    )
    k, first = F.col("c_custkey"), F.lit("1992-01-01").cast("timestamp")
    begins = first + days(k * 7 % 2500)
    tariff = b.table(spark, sf, "customer").select(
        (k % 150).alias("sku_name"), begins.alias("price_start_time"),
        F.when(k % 10 == 0, F.lit("9999-01-01").cast("timestamp")).otherwise(first + days(k * 7 % 2500 + 200)).alias("price_end_time"),
        F.col("c_acctbal").alias("unit_price"), F.lit("EUR").alias("currency_code"),
    )
    return shipped, deals, tariff


@query(
    "price_with_many_prices",
    with_sql(MANY_BOOKS_SQL)
    + """ SELECT l_orderkey, l_linenumber, round(qty * coalesce(d.p, t.p), 4) AS actual_dollars,
      CASE WHEN d.sku IS NOT NULL THEN 'USD' ELSE 'EUR' END AS currency_code,
      CASE WHEN d.sku IS NOT NULL THEN 'ACCOUNT_PRICE' ELSE 'LIST_PRICE' END AS pricing_source
      FROM shipped u LEFT JOIN deals d ON d.sku = u.sku AND u.at >= d.s AND u.at < d.e
      LEFT JOIN tariff t ON t.sku = u.sku AND u.at >= t.s AND u.at < t.e WHERE coalesce(d.p, t.p) IS NOT NULL""",
)
def q_price_with_many_prices(spark, sf):
    """Books with many prices per SKU: intervals are dealt out to days before the join."""
    shipped, deals, tariff = many_books(spark, sf)
    rows = P.price_with_fallback(shipped, deals, tariff, ("sku_name",), days=("1995-06-01", "2001-06-01"))
    return rows.select("l_orderkey", "l_linenumber", F.round("actual_dollars", 4).alias("actual_dollars"), "currency_code", "pricing_source")


@query(
    "overlay_books",
    with_sql(MANY_BOOKS_SQL)
    + """, edges AS (SELECT sku, s AS t FROM deals WHERE s < e UNION SELECT sku, e FROM deals WHERE s < e
        UNION SELECT sku, s FROM tariff UNION SELECT sku, e FROM tariff),
      cut AS (SELECT sku, t AS s, lead(t) OVER (PARTITION BY sku ORDER BY t) AS e FROM edges)
      SELECT c.sku AS sku_name, strftime(c.s, '%Y-%m-%d %H:%M:%S') AS starts, strftime(c.e, '%Y-%m-%d %H:%M:%S') AS ends,
        coalesce(d.p, t.p) AS unit_price, CASE WHEN d.sku IS NOT NULL THEN 'ACCOUNT_PRICE' ELSE 'LIST_PRICE' END AS pricing_source
      FROM cut c LEFT JOIN deals d ON d.sku = c.sku AND d.s <= c.s AND d.e >= c.e AND d.s < d.e
      LEFT JOIN tariff t ON t.sku = c.sku AND t.s <= c.s AND t.e >= c.e
      WHERE c.e IS NOT NULL AND coalesce(d.p, t.p) IS NOT NULL""",
)
def q_overlay_books(spark, sf):
    """The disjoint intervals of both books."""
    _, deals, tariff = many_books(spark, sf)
    # the times of an interval are made text once, not for every pair of its prices
    pieces = P.overlay_pieces(deals, tariff, ("sku_name",)).withColumns({"starts": text_time("price_start_time"), "ends": text_time("price_end_time")})
    return P.each_price(pieces).select("sku_name", "starts", "ends", "unit_price", "pricing_source")


# --- exclusions -------------------------------------------------------------

EXCLUDED_SQL = f"""
excluded AS (
  SELECT DISTINCT s.workspace_id, s.cluster_id FROM scd s
  WHERE (s.cluster_name GLOB '{b.RULES.name_patterns[0]}' OR s.cluster_name GLOB '{b.RULES.name_patterns[1]}'
      OR s.owned_by = '{b.RULES.creators[0]}')
    AND EXISTS (SELECT 1 FROM scanned u WHERE u.cluster_id = s.cluster_id AND u.workspace_id = s.workspace_id)
  UNION SELECT workspace_id, cluster_id FROM scanned WHERE cluster_id IN ('7', '11'))"""


def excluded(spark, sf):
    return P.resolve_exclusions(scanned(spark, sf), b.clusters_scd(spark, sf), b.RULES)


@query(
    "resolve_exclusions",
    with_sql(b.USAGE_SQL, b.SCAN_SQL, b.CLUSTERS_SQL, EXCLUDED_SQL) + " SELECT workspace_id, cluster_id FROM excluded",
)
def q_resolve_exclusions(spark, sf):
    return excluded(spark, sf)


@query(
    "apply_exclusions",
    with_sql(*PRICED, b.BASELINE_SQL, b.CLUSTERS_SQL, EXCLUDED_SQL)
    + """ SELECT workspace_id, usage_date, cluster_id, round(daily_dollars, 6) AS daily_dollars FROM cday t
      WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.workspace_id = t.workspace_id AND e.cluster_id = t.cluster_id)""",
)
def q_apply_exclusions(spark, sf):
    """Exclusions applied to cluster-days, after the usage fact has been reduced."""
    days = P.apply_exclusions(B.cluster_day_cost(priced(spark, sf)), excluded(spark, sf))
    return days.select("workspace_id", "usage_date", "cluster_id", r6("daily_dollars"))


@query(
    "priced_usage",
    with_sql(*PRICED, b.CLUSTERS_SQL, EXCLUDED_SQL)
    + """ SELECT workspace_id, usage_date, cluster_id, sku_name, photon, round(qty, 6) AS dbus,
      round(dollars_per_dbu, 6) AS dollars_per_dbu, round(dollars, 6) AS dollars FROM priced t
      WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.workspace_id = t.workspace_id AND e.cluster_id = t.cluster_id)""",
)
def q_priced_usage(spark, sf):
    rows = P.priced_usage(b.usage(spark, sf), b.price_book(spark), excluded(spark, sf), AS_OF, LOOKBACK)
    return rows.select(
        "workspace_id", "usage_date", "cluster_id", "sku_name", "photon", r6("dbus"), r6("dollars_per_dbu"), r6("dollars")
    )


# --- baselines --------------------------------------------------------------

STATS = (
    "mean_daily_dollars", "stddev_daily_dollars", "p50_daily_dollars", "p90_daily_dollars", "p95_daily_dollars",
    "p99_daily_dollars", "max_daily_dollars", "mean_log_daily_dollars", "stddev_log_daily_dollars",
)
ROLLING = ("baseline_mean", "baseline_stddev", "baseline_mean_log", "baseline_stddev_log")


def _rounded_sql(names) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _places(name: str) -> int:
    """Percentiles of amounts are exact decimals of up to six places; means and deviations are not."""
    return 4 if name.startswith(("mean", "stddev")) else 6


@query(
    "cluster_day_cost",
    with_sql(*PRICED, b.BASELINE_SQL)
    + " SELECT workspace_id, usage_date, cluster_id, round(daily_dollars, 6) AS daily_dollars FROM cday",
)
def q_cluster_day_cost(spark, sf):
    return B.cluster_day_cost(priced(spark, sf)).select("workspace_id", "usage_date", "cluster_id", r6("daily_dollars"))


@query(
    "hourly_spend",
    with_sql(*HOURLY)
    + """ SELECT workspace_id, usage_date, strftime(hour_ts, '%Y-%m-%d %H:%M:%S') AS hour_ts, hour_of_day, cluster_id,
      round(dbus, 6) AS dbus, round(dollars, 6) AS dollars FROM hourly""",
)
def q_hourly_spend(spark, sf):
    return hourly(spark, sf).select(
        "workspace_id", "usage_date", text_time("hour_ts").alias("hour_ts"), "hour_of_day", "cluster_id", r6("dbus"), r6("dollars")
    )


@query(
    "workspace_baseline",
    with_sql(*PRICED, b.BASELINE_SQL)
    + f""" SELECT workspace_id, '2024-01-31 00:00:00' AS computed_at, {LOOKBACK} AS lookback_days, n_cluster_days,
      {_rounded_sql(STATS)} FROM baseline""",
)
def q_workspace_baseline(spark, sf):
    return baseline(spark, sf).select(
        "workspace_id", text_time("computed_at").alias("computed_at"), "lookback_days", "n_cluster_days", *[r6(c) for c in STATS]
    )


@query(
    "workspace_baseline_large",
    f"""WITH cday AS (SELECT l_suppkey % 3 AS workspace_id, l_suppkey, CAST(l_shipdate AS DATE) AS d,
        sum(l_extendedprice * (1 - l_discount)) AS daily_dollars FROM lineitem WHERE isodow(l_shipdate) <= 5 GROUP BY ALL)
      SELECT workspace_id, count(*) AS n_cluster_days, {", ".join(
        f"round({expr}, {_places(name)}) AS {name}" for name, expr in zip(STATS, (
            "avg(daily_dollars)", "stddev_pop(daily_dollars)", "quantile_cont(daily_dollars, 0.5)",
            "quantile_cont(daily_dollars, 0.9)", "quantile_cont(daily_dollars, 0.95)",
            "quantile_cont(daily_dollars, 0.99)", "max(daily_dollars)", "avg(ln(daily_dollars))",
            "stddev_pop(ln(daily_dollars))")))}
      FROM cday WHERE daily_dollars > 0 GROUP BY workspace_id""",
)
def q_workspace_baseline_large(spark, sf):
    """The same statistics over line items: the largest table as already priced usage."""
    line = b.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 3).alias("workspace_id"),
        F.to_date("l_shipdate").alias("usage_date"),
        F.col("l_suppkey").alias("cluster_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("dollars"),
    )
    stats = B.workspace_baseline(stored_days(spark, line), AS_OF, LOOKBACK)
    return stats.select("workspace_id", "n_cluster_days", *[F.round(c, _places(c)).alias(c) for c in STATS])


@query(
    "rolling_baseline",
    with_sql(*HOURLY, b.ROLLING_SQL)
    + f" SELECT workspace_id, as_of_date, {_rounded_sql(ROLLING)}, baseline_n FROM rolling",
)
def q_rolling_baseline(spark, sf):
    return rolling(hourly(spark, sf)).select("workspace_id", "as_of_date", *[r6(c) for c in ROLLING], "baseline_n")


@query(
    "rolling_baseline_moments",
    """WITH l AS (SELECT l_suppkey % 3 AS workspace_id, CAST(l_shipdate AS DATE) AS d, l_suppkey,
        sum(l_extendedprice * (1 - l_discount)) AS x FROM lineitem GROUP BY ALL),
      daily AS (SELECT workspace_id, d, count(*) FILTER (isodow(d) <= 5 AND x > 0) AS n,
        coalesce(sum(ln(x)) FILTER (isodow(d) <= 5 AND x > 0), 0) AS s,
        coalesce(sum(ln(x) * ln(x)) FILTER (isodow(d) <= 5 AND x > 0), 0) AS ss FROM l GROUP BY ALL),
      framed AS (SELECT workspace_id, d AS as_of_date, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(ss) OVER w AS ss FROM daily
        WINDOW w AS (PARTITION BY workspace_id ORDER BY d RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING))
      SELECT workspace_id, as_of_date, CAST(n AS BIGINT) AS baseline_n, round(s / n, 6) AS baseline_mean_log,
        round(sqrt(greatest(ss / n - (s / n) * (s / n), 0)), 5) AS baseline_stddev_log FROM framed WHERE n > 1""",
)
def q_rolling_baseline_moments(spark, sf):
    """Every date of the line items, weekends included, against the 30 days before it."""
    line = b.table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 3).alias("workspace_id"),
        F.to_date("l_shipdate").alias("usage_date"),
        F.col("l_suppkey").alias("cluster_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("dollars"),
    )
    out = B.rolling_baseline(B.cluster_day_cost(line, weekdays_only=False), 30, as_of_dates="all")
    return out.filter("baseline_n > 1").select(
        "workspace_id", "as_of_date", "baseline_n", r6("baseline_mean_log"),
        F.round("baseline_stddev_log", 5).alias("baseline_stddev_log"),
    )


# --- replay -----------------------------------------------------------------

# The SQL keeps a cluster-day as lists and turns the limits into dollars: the z-score passes a limit where the daily pace
# passes exp(mean + limit * deviation).
RUNNING_SQL = """
lists AS (
  SELECT workspace_id, usage_date, cluster_id, list(hour_of_day ORDER BY hour_of_day) AS h,
    list(dollars ORDER BY hour_of_day) AS spent, list(dbus ORDER BY hour_of_day) AS used
  FROM hourly GROUP BY ALL),
traces AS (
  SELECT workspace_id, usage_date, cluster_id, h, list_transform(range(1, len(h) + 1), lambda i: list_sum(spent[1:i])) AS upto,
    list_transform(range(1, len(h) + 1), lambda i: list_sum(used[1:i])) AS dbus_upto
  FROM lists)"""


def fires_sql(name: str, limits: Thresholds) -> str:
    def first(condition: str) -> str:
        return f"h[list_filter(range(1, len(h) + 1), lambda i: {condition})[1]]"

    pace = "upto[i] * 24.0 / i"
    edge = "CASE WHEN r.baseline_stddev_log > 0 THEN exp(r.baseline_mean_log + r.baseline_stddev_log * {}) END"
    return f"""
{name} AS (
  SELECT workspace_id, usage_date, cluster_id,
    CASE WHEN deviation > 0 AND top > 0 THEN (ln(top) - centre) / deviation END AS z_score,
    {first(f"{pace} > warn_pace")} AS first_alert_hour, {first(f"{pace} > critical_pace")} AS first_critical_hour,
    {first(f"upto[i] > {limits.budget}")} AS budget_crossed_hour, h[-1] AS last_active_hour
  FROM (
    SELECT t.*, r.baseline_mean_log AS centre, r.baseline_stddev_log AS deviation,
      list_max(list_transform(range(1, len(h) + 1), lambda i: {pace})) AS top,
      least({limits.budget}::DOUBLE, {edge.format(min(limits.z_warning, limits.z_critical))}) AS warn_pace,
      least({limits.budget}::DOUBLE, {edge.format(limits.z_critical)}) AS critical_pace
    FROM traces t LEFT JOIN rolling r ON r.workspace_id = t.workspace_id AND r.as_of_date = t.usage_date))"""


LEAD_SQL = "budget_crossed_hour - first_alert_hour"
OUTCOME_SQL = f"""if(first_alert_hour IS NULL, 'MISS', coalesce(
  ['CAUGHT_LATE', 'CAUGHT_AT_CROSSING', 'CAUGHT_EARLY'][2 + sign({LEAD_SQL})], 'CAUGHT_EARLY')) AS outcome, {LEAD_SQL} AS lead_hours"""
BAD_SQL = f"""
bad AS (SELECT workspace_id, usage_date, cluster_id, sum(dollars) AS actual_daily_dollars FROM hourly GROUP BY ALL
  HAVING sum(dollars) > {b.LIMITS.budget})"""
REPLAY = (*HOURLY, b.ROLLING_SQL, RUNNING_SQL, fires_sql("fires", b.LIMITS), BAD_SQL)
RESULT_SQL = f"""
result AS (SELECT b.*, f.z_score, f.first_alert_hour, f.first_critical_hour, f.budget_crossed_hour, f.last_active_hour,
  {OUTCOME_SQL} FROM bad b LEFT JOIN fires f USING (workspace_id, usage_date, cluster_id))"""
DAY = ("workspace_id", "usage_date", "cluster_id")
FIRES = ("first_alert_hour", "first_critical_hour", "budget_crossed_hour", "last_active_hour")


@query(
    "running_spend",
    with_sql(*HOURLY, b.ROLLING_SQL, RUNNING_SQL)
    + """ SELECT workspace_id, usage_date, cluster_id, unnest(h) AS hour_of_day,
      unnest(list_transform(upto, lambda x: round(x, 6))) AS cumulative_dollars,
      unnest(list_transform(dbus_upto, lambda x: round(x, 6))) AS cumulative_dbus,
      unnest(list_transform(range(1, len(h) + 1), lambda i: CAST(i AS INTEGER))) AS hours_observed FROM traces""",
)
def q_running_spend(spark, sf):
    return R.running_spend(hourly(spark, sf)).select(
        *DAY, "hour_of_day", r6("cumulative_dollars"), r6("cumulative_dbus"), "hours_observed"
    )


@query(
    "bad_cluster_days",
    with_sql(*HOURLY, BAD_SQL)
    + " SELECT workspace_id, usage_date, cluster_id, round(actual_daily_dollars, 6) AS actual_daily_dollars FROM bad",
)
def q_bad_cluster_days(spark, sf):
    return R.bad_cluster_days(hourly(spark, sf), b.LIMITS.budget).select(*DAY, r6("actual_daily_dollars"))


@query(
    "first_fire",
    with_sql(*REPLAY) + f" SELECT workspace_id, usage_date, cluster_id, round(z_score, 6) AS z_score, {', '.join(FIRES)} FROM fires",
)
def q_first_fire(spark, sf):
    hours = stored_hourly(spark, sf)
    fires = R.first_fire(R.simulate(R.running_spend(hours), rolling(hours)), b.LIMITS)
    return fires.select(*DAY, r6("z_score"), *FIRES)


META_SQL = """
meta AS (SELECT workspace_id, cluster_id, cluster_name, owned_by AS creator FROM (
  SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id ORDER BY change_time DESC, cluster_name DESC, owned_by DESC) AS rn
  FROM scd) WHERE rn = 1)"""


def _meta(spark, sf):
    return b.clusters_scd(spark, sf).withColumnRenamed("owned_by", "creator")


@query(
    "enrich_latest_meta",
    with_sql(*HOURLY, BAD_SQL, b.CLUSTERS_SQL, META_SQL)
    + """ SELECT workspace_id, usage_date, cluster_id, cluster_name, creator, round(actual_daily_dollars, 6) AS actual_daily_dollars
      FROM bad LEFT JOIN meta USING (workspace_id, cluster_id)""",
)
def q_enrich_latest_meta(spark, sf):
    bad = R.bad_cluster_days(hourly(spark, sf), b.LIMITS.budget)
    named = R.enrich_latest_meta(bad, _meta(spark, sf), ["workspace_id", "cluster_id"], ["cluster_name", "creator"])
    return named.select(*DAY, "cluster_name", "creator", r6("actual_daily_dollars"))


@query(
    "backtest",
    with_sql(*REPLAY, RESULT_SQL, b.CLUSTERS_SQL, META_SQL)
    + f""" SELECT workspace_id, usage_date, cluster_id, cluster_name, creator,
      round(actual_daily_dollars, 6) AS actual_daily_dollars, round(z_score, 6) AS z_score, {", ".join(FIRES)}, outcome, lead_hours
      FROM result LEFT JOIN meta USING (workspace_id, cluster_id)""",
)
def q_backtest(spark, sf):
    hours = stored_hourly(spark, sf)
    return R.backtest(hours, rolling(hours), b.LIMITS, _meta(spark, sf)).select(
        *DAY, "cluster_name", "creator", r6("actual_daily_dollars"), r6("z_score"), *FIRES, "outcome", "lead_hours"
    )


GRID = (Thresholds(60.0, 1.0, 2.0), Thresholds(100.0, 2.0, 3.0), Thresholds(200.0, 0.5, 1.5))


@query(
    "backtest_sweep",
    with_sql(*HOURLY, b.ROLLING_SQL, RUNNING_SQL, *[fires_sql(f"f{i}", g) for i, g in enumerate(GRID)])
    + " UNION ALL ".join(
        f""" SELECT workspace_id, usage_date, cluster_id, {g.budget}::DOUBLE AS budget, {g.z_warning}::DOUBLE AS z_warning,
        {g.z_critical}::DOUBLE AS z_critical, round(t.d, 6) AS actual_daily_dollars, first_alert_hour, first_critical_hour,
        budget_crossed_hour, {OUTCOME_SQL}
        FROM f{i} JOIN (SELECT workspace_id, usage_date, cluster_id, sum(dollars) AS d FROM hourly GROUP BY ALL) t
        USING (workspace_id, usage_date, cluster_id) WHERE t.d > {g.budget}"""
        for i, g in enumerate(GRID)
    ),
)
def q_backtest_sweep(spark, sf):
    hours = stored_hourly(spark, sf)
    return R.backtest_sweep(hours, rolling(hours), GRID).select(
        *DAY, "budget", "z_warning", "z_critical", r6("actual_daily_dollars"), *FIRES[:3], "outcome", "lead_hours"
    )


@query(
    "backtest_summary",
    with_sql(*REPLAY, RESULT_SQL)
    + """ SELECT outcome, count(*) AS cluster_days, round(sum(actual_daily_dollars), 4) AS dollars,
      round(avg(lead_hours), 6) AS mean_lead_hours, quantile_cont(lead_hours, 0.5)::DOUBLE AS p50_lead_hours,
      round(quantile_cont(lead_hours, 0.9), 6)::DOUBLE AS p90_lead_hours, max(lead_hours) AS max_lead_hours
      FROM result GROUP BY outcome""",
)
def q_backtest_summary(spark, sf):
    hours = stored_hourly(spark, sf)
    summary = R.backtest_summary(R.backtest(hours, rolling(hours), b.LIMITS))
    return summary.select(
        "outcome", "cluster_days", F.round("dollars", 4).alias("dollars"), r6("mean_lead_hours"), r6("p50_lead_hours"),
        r6("p90_lead_hours"), "max_lead_hours",
    )


# --- windows and functions --------------------------------------------------


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def q_latest_per_key(spark, sf):
    newest = latest_per_key(b.table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "latest_baseline",
    """WITH t AS (SELECT l_suppkey % 7 AS workspace_id, CAST(l_shipdate AS DATE) AS d, count(*) AS n_cluster_days,
        avg(l_extendedprice) AS m FROM lineitem GROUP BY ALL)
      SELECT workspace_id, d AS computed_on, n_cluster_days, round(m, 4) AS mean_daily_dollars FROM (SELECT *, row_number()
        OVER (PARTITION BY workspace_id ORDER BY d DESC) AS rn FROM t) WHERE rn = 1""",
)
def q_latest_baseline(spark, sf):
    from tallyline.operators.alerts import latest_baseline

    daily = b.table(spark, sf, "lineitem").groupBy(
        (F.col("l_suppkey") % 7).alias("workspace_id"), F.to_date("l_shipdate").alias("computed_at")
    ).agg(F.count("*").alias("n_cluster_days"), F.avg("l_extendedprice").alias("mean_daily_dollars"))
    return latest_baseline(daily).select(
        "workspace_id", F.col("computed_at").alias("computed_on"), "n_cluster_days",
        F.round("mean_daily_dollars", 4).alias("mean_daily_dollars"),
    )


@query(
    "fn_string",
    """SELECT c_custkey, lower(c_mktsegment) AS lowered, upper(c_name) AS uppered, trim('  ' || c_mktsegment || ' ') AS trimmed,
      regexp_replace(c_name || CASE WHEN c_custkey % 2 = 0 THEN '  (Photon) ' ELSE '' END, '\\s*\\(Photon\\)\\s*$', '') AS stripped,
      starts_with(c_name, 'Customer#0000001') AS prefixed, split_part(c_name || '.a.b', '.', 1) AS head,
      c_name LIKE '%7' AS ends_7, c_name ILIKE 'customer%9' AS ends_9, c_name GLOB '*#[0-9]*[!1-8]' AS globbed FROM customer""",
)
def q_fn_string(spark, sf):
    name = F.col("c_name")
    marked = F.concat(name, F.when(F.col("c_custkey") % 2 == 0, "  (Photon) ").otherwise(""))
    return b.table(spark, sf, "customer").select(
        "c_custkey",
        F.lower("c_mktsegment").alias("lowered"),
        F.upper(name).alias("uppered"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.regexp_replace(marked, r"\s*\(Photon\)\s*$", "").alias("stripped"),
        name.startswith("Customer#0000001").alias("prefixed"),
        F.substring_index(F.concat(name, F.lit(".a.b")), ".", 1).alias("head"),
        name.like("%7").alias("ends_7"),
        name.ilike("customer%9").alias("ends_9"),
        name.rlike(glob_to_regex("*#[0-9]*[!1-8]")).alias("globbed"),
    )


@query(
    "fn_date",
    """SELECT event_id, CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h, CAST(isodow(ts) - 1 AS INTEGER) AS wd,
      strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, CAST(date_trunc('month', ts) AS DATE) AS month_start,
      CAST(date_trunc('year', ts) AS DATE) AS year_start, CAST(ts AS DATE) - 30 AS thirty_before,
      strftime(ts - INTERVAL 30 MINUTES, '%Y-%m-%d %H:%M:%S') AS half_hour_before FROM events""",
)
def q_fn_date(spark, sf):
    ts = F.col("ts")
    return b.table(spark, sf, "events").select(
        "event_id",
        F.to_date(ts).alias("d"),
        F.hour(ts).alias("h"),
        F.weekday(ts).alias("wd"),
        text_time(F.date_trunc("hour", ts)).alias("hour_start"),
        F.trunc(F.to_date(ts), "month").alias("month_start"),
        F.trunc(F.to_date(ts), "year").alias("year_start"),
        F.date_sub(F.to_date(ts), 30).alias("thirty_before"),
        text_time(ts - F.expr("interval 30 minutes")).alias("half_hour_before"),
    )


@query(
    "fn_math",
    """SELECT event_id, CASE WHEN value > 0 THEN round(ln(value), 6) END AS log_value, round(value * 0.55, 6) AS product,
      round(value / nullif(event_id % 5, 0), 6) AS ratio, value > 50.0 AS over, least(value, 50.0) AS capped FROM events""",
)
def q_fn_math(spark, sf):
    v = F.col("value")
    return b.table(spark, sf, "events").select(
        "event_id",
        r6("log_value", F.when(v > 0, F.ln(v))),
        r6("product", v * 0.55),
        r6("ratio", F.try_divide(v, F.col("event_id") % 5)),
        (v > 50.0).alias("over"),
        F.least(v, F.lit(50.0)).alias("capped"),
    )


@query(
    "fn_hash",
    "SELECT event_id, sha256(concat_ws('|', user_id, event_type, event_id)) AS record_id, sha256(props) AS props_hash FROM events",
)
def q_fn_hash(spark, sf):
    from tallyline.functions.exprs import sha_hex

    return b.table(spark, sf, "events").select(
        "event_id",
        sha_hex(F.col("user_id"), F.col("event_type"), F.col("event_id")).alias("record_id"),
        F.sha2("props", 256).alias("props_hash"),
    )


__all__ = ["baseline", "hourly", "local_frame", "priced", "rolling", "scanned"]
