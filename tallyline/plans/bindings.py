"""Logical input tables bound to the driver tables, in Spark and in SQL.

The driver tables hold no billing data, so their columns play its roles:
events are usage, orders are change rows, customers are inventory, suppliers
are running clusters, parts are node-rate records.  Price books, node rates,
runs and rules are short configuration lists, written once and used for both
sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.scale import configure, local_frame, shared_dir
from tallyline.params import ExclusionRules, Thresholds
from tallyline.sources.usage import list_price, scan_price_book

AS_OF = "2024-01-31 00:00:00"
MART_AS_OF = "2024-01-30 00:00:00"
LOOKBACK = 30
LIMITS = Thresholds(budget=100.0)
SCORE_LIMITS = Thresholds(budget=1000.0)
TS = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with zone-less times read as UTC."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint location."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def text_time(c: Column | str) -> Column:
    return F.date_format(c, TS)


def r6(name: str, c: Column | str | None = None) -> Column:
    return F.round((F.col(name) if c is None else F.col(c) if isinstance(c, str) else c).cast("double"), 6).alias(name)


def tag_text(c: Column | str) -> Column:
    """A map as sorted ``key=value`` pairs."""
    return F.array_join(
        F.sort_array(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ","
    )


def policy_text(c: Column | str) -> Column:
    """Policy attachments as ``TYPE:id:name`` items in stored order."""
    return F.array_join(
        F.transform(
            c,
            lambda p: F.concat_ws(":", p["policy_type"], p["policy_id"], F.coalesce(p["policy_name"], F.lit("-"))),
        ),
        ",",
    )


def when_mod(c: str, n: int, yes: Column, no: Column | None = None) -> Column:
    out = F.when(F.col(c) % n == 0, yes)
    return out if no is None else out.otherwise(no)


def values_sql(rows) -> str:
    """Rows as the body of a SQL VALUES clause."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        if isinstance(v, int):
            return repr(v)
        if isinstance(v, list):
            return "CAST([" + ", ".join(lit(x) for x in v) + "] AS VARCHAR[])"
        return "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


# --- usage ------------------------------------------------------------------

PRODUCTS = {"click": "ALL_PURPOSE", "purchase": "ALL_PURPOSE", "view": "SQL", "signup": "MODEL_SERVING", "error": "JOBS"}


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    product = F.lit(None).cast("string")
    for kind, name in PRODUCTS.items():
        product = F.when(F.col("event_type") == kind, name).otherwise(product)
    text = lambda c: c.cast("string")
    tags = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type"))
    return e.select(
        "event_id",
        F.lit("acct").alias("account_id"),
        (F.col("user_id") % 3).alias("workspace_id"),
        F.lit("cloud-1").alias("cloud"),
        F.to_date("ts").alias("usage_date"),
        F.col("ts").alias("usage_start_time"),
        F.concat(
            F.upper("event_type"),
            when_mod("event_id", 3, F.lit("_PHOTON"), F.lit("")),
            when_mod("event_id", 11, F.lit("_SERVERLESS"), F.lit("")),
        ).alias("sku_name"),
        product.alias("billing_origin_product"),
        F.col("value").alias("usage_quantity"),
        F.lit("DBU").alias("usage_unit"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None))
        .when(F.col("event_id") % 13 == 0, F.expr("cast(map() as map<string,string>)"))
        .otherwise(tags)
        .alias("custom_tags"),
        F.struct(
            text(F.col("user_id")).alias("cluster_id"),
            when_mod("event_id", 4, text(F.col("event_id") % 50)).alias("job_id"),
            F.concat(F.lit("ep-"), F.col("user_id") % 20).alias("endpoint_name"),
            F.concat(F.lit("wh-"), F.col("user_id") % 10).alias("warehouse_id"),
        ).alias("usage_metadata"),
    )


USAGE_SQL = f"""
usage AS (
  SELECT event_id, user_id % 3 AS workspace_id, CAST(ts AS DATE) AS usage_date, ts AS usage_start_time,
    upper(event_type) || CASE WHEN event_id % 3 = 0 THEN '_PHOTON' ELSE '' END
      || CASE WHEN event_id % 11 = 0 THEN '_SERVERLESS' ELSE '' END AS sku_name,
    CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRODUCTS.items())} END AS product,
    value AS qty, event_type,
    CASE WHEN event_id % 7 <> 0 AND event_id % 13 <> 0 THEN json_extract_string(props, '$.k') END AS tag_k,
    event_id % 7 <> 0 AND event_id % 13 <> 0 AS tagged,
    CAST(user_id AS VARCHAR) AS cluster_id,
    CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 50 AS VARCHAR) END AS job_id,
    'ep-' || (user_id % 20) AS endpoint_name, 'wh-' || (user_id % 10) AS warehouse_id
  FROM events)"""

# --- price books ------------------------------------------------------------

_START = "2023-01-01 00:00:00"


def _price_rows(base) -> list[tuple]:
    """Base prices plus their accelerated SKUs at twice the price."""
    return [
        (sku + suffix, start, end, price * factor)
        for sku, start, end, price in base
        for suffix, factor in (("", 1.0), ("_PHOTON", 2.0))
    ]


CONTRACT = _price_rows(
    [
        ("VIEW", _START, "2024-01-16 00:00:00", 0.40),
        ("VIEW", "2024-01-16 00:00:00", None, 0.50),
        ("CLICK", _START, None, 0.55),
        ("SIGNUP", _START, None, 0.76),
        ("PURCHASE", _START, "2024-01-11 00:00:00", 0.65),
        ("PURCHASE", "2024-01-11 00:00:00", None, 0.70),
    ]
)
# In the two-book case the contract lacks two products and the list book fills in.
PARTIAL_CONTRACT = [row for row in CONTRACT if not row[0].startswith(("SIGNUP", "CLICK"))]
LIST = [
    ("VIEW", _START, None, 0.60, None),
    ("VIEW_PHOTON", _START, None, 1.20, None),
    ("CLICK", _START, None, 0.60, None),
    ("CLICK_PHOTON", _START, None, 1.20, None),
    ("SIGNUP", _START, None, 0.80, 0.76),
    ("SIGNUP_PHOTON", _START, None, 1.60, 1.52),
    ("VIEW_SERVERLESS", _START, None, 0.90, None),
]


def _book(spark: SparkSession, rows, extra: str = "") -> DataFrame:
    fields = "sku_name string, start string, end string, price double" + extra
    raw = local_frame(spark, rows, fields)
    effective = F.col("effective") if "effective" in raw.columns else F.lit(None).cast("double")
    return raw.select(
        F.lit("acct").alias("account_id"),
        F.lit("cloud-1").alias("cloud"),
        "sku_name",
        F.to_timestamp("start").alias("price_start_time"),
        F.to_timestamp("end").alias("price_end_time"),
        F.lit("USD").alias("currency_code"),
        F.struct(
            F.col("price").alias("default"), F.struct(effective.alias("default")).alias("effective_list")
        ).alias("pricing"),
    )


def price_book(spark: SparkSession) -> DataFrame:
    return scan_price_book(_book(spark, CONTRACT))


def account_prices(spark: SparkSession) -> DataFrame:
    return scan_price_book(_book(spark, PARTIAL_CONTRACT), ("account_id", "cloud", "sku_name"))


def list_prices(spark: SparkSession) -> DataFrame:
    return scan_price_book(
        _book(spark, LIST, ", effective double"), ("account_id", "cloud", "sku_name"), price=list_price()
    )


def _book_sql(name: str, rows, extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT sku, CAST(s AS TIMESTAMP) AS s, coalesce(CAST(e AS TIMESTAMP), TIMESTAMP '9999-01-01') AS e, p{extra}
  FROM (VALUES {values_sql(rows)}) t(sku, s, e, p{extra}))"""


BOOK_SQL = _book_sql("book", CONTRACT)
CONTRACT_SQL = _book_sql("contract", PARTIAL_CONTRACT)
LIST_SQL = _book_sql("listed", LIST, ", eff")

# Priced all-purpose usage, as the baseline sees it.
SCAN_SQL = f"""
scanned AS (
  SELECT * FROM usage
  WHERE product = 'ALL_PURPOSE' AND NOT contains(sku_name, 'SERVERLESS')
    AND usage_date >= DATE '2024-01-31' - {LOOKBACK} AND usage_date < DATE '2024-01-31')"""
PRICED_SQL = """
priced AS (
  SELECT u.*, contains(u.sku_name, 'PHOTON') AS photon, b.p AS dollars_per_dbu, u.qty * b.p AS dollars
  FROM scanned u JOIN book b ON b.sku = u.sku_name AND u.usage_start_time >= b.s AND u.usage_start_time < b.e)"""
# All products, unpriced usage at zero dollars, as the replay sees it here.
LEFT_PRICED_SQL = """
lpriced AS (
  SELECT u.*, b.p AS dollars_per_dbu, u.qty * coalesce(b.p, 0) AS dollars
  FROM usage u LEFT JOIN book b ON b.sku = u.sku_name AND u.usage_start_time >= b.s AND u.usage_start_time < b.e)"""
HOURLY_SQL = """
hourly AS (
  SELECT workspace_id, usage_date, date_trunc('hour', usage_start_time) AS hour_ts,
    CAST(hour(usage_start_time) AS INTEGER) AS hour_of_day, cluster_id, sum(qty) AS dbus, sum(dollars) AS dollars
  FROM lpriced GROUP BY ALL)"""
BASELINE_SQL = """
cday AS (
  SELECT workspace_id, usage_date, cluster_id, sum(dollars) AS daily_dollars
  FROM priced WHERE isodow(usage_date) <= 5 GROUP BY ALL),
baseline AS (
  SELECT workspace_id, count(*) AS n_cluster_days, avg(daily_dollars) AS mean_daily_dollars,
    stddev_pop(daily_dollars) AS stddev_daily_dollars, quantile_cont(daily_dollars, 0.5) AS p50_daily_dollars,
    quantile_cont(daily_dollars, 0.9) AS p90_daily_dollars, quantile_cont(daily_dollars, 0.95) AS p95_daily_dollars,
    quantile_cont(daily_dollars, 0.99) AS p99_daily_dollars, max(daily_dollars) AS max_daily_dollars,
    avg(ln(daily_dollars)) AS mean_log_daily_dollars, stddev_pop(ln(daily_dollars)) AS stddev_log_daily_dollars
  FROM cday WHERE daily_dollars > 0 GROUP BY workspace_id)"""
ROLLING_DAYS = 7
ROLLING_SQL = f"""
totals AS (
  SELECT workspace_id, usage_date, cluster_id, sum(dollars) AS daily_dollars FROM hourly
  WHERE isodow(usage_date) <= 5 GROUP BY ALL),
rolling AS (
  SELECT d.workspace_id, d.usage_date AS as_of_date, avg(t.daily_dollars) AS baseline_mean,
    stddev_pop(t.daily_dollars) AS baseline_stddev, avg(ln(t.daily_dollars)) AS baseline_mean_log,
    stddev_pop(ln(t.daily_dollars)) AS baseline_stddev_log, count(*) AS baseline_n
  FROM (SELECT DISTINCT workspace_id, usage_date FROM totals) d
  JOIN totals t ON t.workspace_id = d.workspace_id
    AND t.usage_date BETWEEN d.usage_date - {ROLLING_DAYS} AND d.usage_date - 1
  WHERE t.daily_dollars > 0 GROUP BY d.workspace_id, d.usage_date)"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",".join(parts)


# --- change rows ------------------------------------------------------------


def clusters_scd(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    deleted = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return o.select(
        (F.col("o_custkey") % 3).alias("workspace_id"),
        F.col("o_custkey").cast("string").alias("cluster_id"),
        F.concat_ws("/", "o_orderpriority", "o_custkey").alias("cluster_name"),
        F.concat(F.lit("owner"), F.col("o_custkey") % 25, F.lit("@example.com")).alias("owned_by"),
        F.create_map(F.lit("prio"), F.col("o_orderpriority"), F.lit(" st "), F.col("o_orderstatus")).alias("tags"),
        F.element_at(F.array(*map(F.lit, ("JOB", "UI", "API", "ui"))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias(
            "cluster_source"
        ),
        when_mod("o_orderkey", 5, F.concat(F.lit("pol-"), F.col("o_orderkey") % 20)).alias("policy_id"),
        F.lit(None).cast("timestamp").alias("create_time"),
        deleted.alias("delete_time"),
        F.col("o_orderdate").alias("change_time"),
        F.col("o_orderkey").alias("change_id"),
    )


CLUSTERS_SQL = """
scd AS (
  SELECT o_custkey % 3 AS workspace_id, CAST(o_custkey AS VARCHAR) AS cluster_id,
    o_orderpriority || '/' || o_custkey AS cluster_name, 'owner' || (o_custkey % 25) || '@example.com' AS owned_by,
    o_orderpriority AS prio, o_orderstatus AS st, ['JOB', 'UI', 'API', 'ui'][o_orderkey % 4 + 1] AS cluster_source,
    CASE WHEN o_orderkey % 5 = 0 THEN 'pol-' || (o_orderkey % 20) END AS policy_id,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS delete_time, o_orderdate AS change_time,
    o_orderkey AS change_id
  FROM orders)"""

RULES = ExclusionRules(
    ids=("7", "11"), name_patterns=("1-URGENT/1*", "?-LOW/[23]*"), creators=("owner3@example.com",)
)
LIVE_RULES = ExclusionRules(
    ids=("5", "11"), name_patterns=("Supplier#00000001*", "*#0000000?2"), creators=("NATION_3",)
)

# --- running clusters and node rates ----------------------------------------


def live_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    node = lambda n: F.concat(F.lit("n"), n % 8)
    executors = F.transform(F.sequence(F.lit(1), F.greatest(k % 5, F.lit(1))), lambda i: F.struct(i.cast("string").alias("node_id")))
    payload = F.struct(
        k.cast("string").alias("cluster_id"),
        F.col("s_name").alias("cluster_name"),
        F.col("n_name").alias("creator_user_name"),
        F.lit("UI").alias("cluster_source"),
        when_mod("s_suppkey", 3, F.lit("PHOTON"), F.lit("STANDARD")).alias("runtime_engine"),
        when_mod("s_suppkey", 5, F.lit("15.4.x-Photon-scala2.12"), F.lit("15.4.x-scala2.12")).alias("spark_version"),
        node(k).alias("node_type_id"),
        when_mod("s_suppkey", 2, node(k + 1)).alias("driver_node_type_id"),
        F.when(k % 3 != 0, k * 7 % 20).alias("num_workers"),
        F.when((k % 4 == 0) & (k % 5 > 0), executors).alias("executors"),
        when_mod("s_suppkey", 2, F.struct((k % 6).alias("min_workers"), F.lit(10).alias("max_workers"))).alias("autoscale"),
    )
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select((k % 3).alias("workspace_id"), F.to_json(payload).alias("payload"))


LIVE_SQL = """
live AS (
  SELECT s_suppkey % 3 AS workspace_id, CAST(s_suppkey AS VARCHAR) AS cluster_id, s_name AS cluster_name,
    n_name AS creator, 'UI' AS cluster_source, 'n' || (s_suppkey % 8) AS node_type,
    CASE WHEN s_suppkey % 2 = 0 THEN 'n' || ((s_suppkey + 1) % 8) ELSE 'n' || (s_suppkey % 8) END AS driver_node_type,
    CAST(CASE WHEN s_suppkey % 4 = 0 AND s_suppkey % 5 > 0 THEN s_suppkey % 5
      WHEN s_suppkey % 3 <> 0 THEN s_suppkey * 7 % 20 WHEN s_suppkey % 2 = 0 THEN s_suppkey % 6 ELSE 0 END AS INTEGER)
      AS num_workers,
    s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 AS photon
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

# Seven node types, doubling in price; one lacks its accelerated rate and one its plain rate.
RATES = [
    (w, f"n{i}", photon, 0.05 * 2**i * (2 if photon else 1) / 0.5, 0.05 * 2**i * (2 if photon else 1),
     "SKU_FAST" if photon else "SKU_PLAIN")
    for w in range(3) for i in range(7) for photon in (False, True)
    if (i, photon) not in ((5, True), (6, False))
]


def node_rates(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark,
        RATES,
        "workspace_id bigint, node_type string, photon boolean, dbu_per_hour double, dollars_per_hour double, "
        "sku_name string",
    )


RATES_SQL = f"""
rates AS (SELECT * FROM (VALUES {values_sql(RATES)}) t(workspace_id, node_type, photon, dbu, dph, sku_name))"""

# --- score history and send log ---------------------------------------------


def score_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    v, u = F.col("value"), F.col("user_id")
    ts = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 900) * 900)
    signal = F.when(v > 120, "CRITICAL").when(v > 60, "WARNING").otherwise("OK")
    creator = F.when(u % 5 == 0, "nobody").when(u % 5 == 1, "").otherwise(
        F.concat(F.lit(" user"), u, F.lit("@example.com "))
    )
    return e.select(
        F.when(F.col("event_id") % 17 != 0, F.concat(F.lit("r"), F.col("event_id"))).alias("record_id"),
        (u % 3).alias("workspace_id"),
        ts.alias("snapshot_ts"),
        F.to_date(ts).alias("snapshot_date"),
        u.cast("string").alias("cluster_id"),
        F.concat(F.lit("c"), u).alias("cluster_name"),
        creator.alias("creator"),
        F.lit("n1").alias("node_type"),
        (u % 20).cast("int").alias("num_workers"),
        (u % 2 == 0).alias("photon"),
        F.lit("SKU").alias("sku_name"),
        (v / 48).alias("dbu_per_hour"),
        (v / 24).alias("dollars_per_hour"),
        (v * 10).alias("projected_daily_dollars"),
        F.when(v > 0, F.ln(v)).alias("z_score"),
        signal.alias("signal"),
        F.lit("from events").alias("reason"),
    )


SCORES_SQL = """
scores AS (
  SELECT CASE WHEN event_id % 17 <> 0 THEN 'r' || event_id END AS record_id, user_id % 3 AS workspace_id,
    time_bucket(INTERVAL 15 MINUTE, ts) AS snapshot_ts, CAST(user_id AS VARCHAR) AS cluster_id,
    'c' || user_id AS cluster_name,
    CASE user_id % 5 WHEN 0 THEN 'nobody' WHEN 1 THEN '' ELSE ' user' || user_id || '@example.com ' END AS creator,
    value / 24 AS dollars_per_hour, value * 10 AS projected, CASE WHEN value > 0 THEN ln(value) END AS z_score,
    CASE WHEN value > 120 THEN 'CRITICAL' WHEN value > 60 THEN 'WARNING' ELSE 'OK' END AS signal
  FROM events)"""


def send_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the send log; some rows break the contract."""
    e = table(spark, sf_dir, "events")
    v, i = F.col("value"), F.col("event_id")
    s = lambda text: F.lit(text)
    return e.select(
        F.col("ts").alias("event_ts"),
        F.when(i % 19 == 0, s("unheard_of")).when(i % 23 == 0, s("message_failed")).otherwise(s("message_sent")).alias("event_type"),
        F.when(i % 29 == 0, s("other")).otherwise(s("cluster_cost")).alias("detector_name"),
        (F.col("user_id") % 3).alias("workspace_id"),
        F.when(i % 31 != 0, F.concat(s("r"), i)).alias("record_id"),
        s("cluster").alias("asset_type"),
        F.col("user_id").cast("string").alias("asset_id"),
        F.concat(s("c"), F.col("user_id")).alias("asset_name"),
        F.when(v > 40, "CRITICAL").otherwise("WARNING").alias("severity"),
        s("#ops").alias("recipient"),
        s("channel_only").alias("routing"),
        F.when(i % 7 != 0, i.cast("string")).alias("message_ts"),
        s("text").alias("plain"),
        s("[]").alias("blocks"),
        F.when(i % 37 != 0, s("{}")).alias("details_json"),
    )


LOG_SQL = """
log AS (
  SELECT ts AS event_ts, CASE WHEN event_id % 19 = 0 THEN 'unheard_of' WHEN event_id % 23 = 0 THEN 'message_failed'
      ELSE 'message_sent' END AS event_type,
    CASE WHEN event_id % 29 = 0 THEN 'other' ELSE 'cluster_cost' END AS detector_name, user_id % 3 AS workspace_id,
    CASE WHEN event_id % 31 <> 0 THEN 'r' || event_id END AS record_id, CAST(user_id AS VARCHAR) AS asset_id,
    CASE WHEN value > 40 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
    event_id % 7 <> 0 AS has_ts, event_id % 37 <> 0 AS has_details, event_id
  FROM events)"""


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user"), k, F.lit("@example.com")).alias("email"),
        when_mod("c_custkey", 2, F.concat(F.lit("U"), F.lpad(k.cast("string"), 8, "0"))).alias("user_id"),
    )


DIRECTORY_SQL = """
people AS (
  SELECT 'user' || c_custkey || '@example.com' AS email,
    CASE WHEN c_custkey % 2 = 0 THEN 'U' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS user_id
  FROM customer)"""

# --- runs, rules, inventory -------------------------------------------------

RUNS = [("r1", "2024-01-28 06:00:00"), ("r2", "2024-01-29 06:00:00"), ("r3", "2024-01-30 06:00:00")]
TYPES = ("cluster", "job", "serving_endpoint", "warehouse")
RUN_ROWS = [
    (str(w), run, at, kind, "FAILED" if (run, kind) == ("r3", "job") else "SUCCESS")
    for w in range(3) for run, at in RUNS for kind in TYPES
]
REQUIREMENT_ROWS = [
    (str(w), run, at, kind, ["cost_center", "owner"] if run == "r1" else ["cost_center", "owner", "segment", "team"],
     {"cluster": ["COMPUTE_POLICY"], "job": ["BUDGET_POLICY", "COMPUTE_POLICY"],
      "serving_endpoint": ["BUDGET_POLICY"], "warehouse": []}[kind],
     "h1" if run == "r1" else "h2")
    for w in range(3) for run, at in RUNS for kind in TYPES
]


def _stamped(df: DataFrame) -> DataFrame:
    stamp = F.to_timestamp("at")
    return df.withColumns({"snapshot_ts": stamp, "snapshot_date": F.to_date(stamp)}).drop("at")


def runs(spark: SparkSession) -> DataFrame:
    return _stamped(
        local_frame(
            spark, RUN_ROWS, "workspace_id string, collection_run_id string, at string, asset_type string, status string"
        )
    )


def requirements(spark: SparkSession) -> DataFrame:
    return _stamped(
        local_frame(
            spark,
            REQUIREMENT_ROWS,
            "workspace_id string, collection_run_id string, at string, asset_type string, "
            "required_tags array<string>, required_policies array<string>, config_hash string",
        )
    )


RUNS_SQL = f"""
runs AS (
  SELECT workspace_id, run, CAST(seen AS TIMESTAMP) AS snapshot_ts, asset_type, status
  FROM (VALUES {values_sql(RUN_ROWS)}) t(workspace_id, run, seen, asset_type, status)),
latest AS (
  SELECT workspace_id, asset_type, run FROM (
    SELECT *, row_number() OVER (PARTITION BY workspace_id, asset_type ORDER BY snapshot_ts DESC) AS rn
    FROM runs WHERE status = 'SUCCESS') WHERE rn = 1)"""
REQUIREMENTS_SQL = f"""
reqs AS (
  SELECT workspace_id, run, CAST(seen AS TIMESTAMP) AS snapshot_ts, asset_type, required_tags, required_policies, config_hash
  FROM (VALUES {values_sql(REQUIREMENT_ROWS)})
    t(workspace_id, run, seen, asset_type, required_tags, required_policies, config_hash))"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as an asset in each of three runs; tags change between runs."""
    c = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    k = F.col("c_custkey")
    stamped = c.withColumn(
        "run", F.explode(F.array(*[F.struct(F.lit(r).alias("id"), F.lit(at).alias("at")) for r, at in RUNS]))
    ).withColumn("at", F.col("run.at"))
    kind = F.when(k % 4 == 1, "job").when(k % 4 == 3, "warehouse").otherwise("cluster")
    ident = F.concat(F.when(k % 4 == 3, "wh-").otherwise(""), k)
    owner = F.when((F.col("c_acctbal") <= 0) & (F.col("run.id") == "r1"), "").when(
        F.col("c_acctbal") <= -500, " "
    ).otherwise(F.col("c_name"))
    text = lambda v: F.lit(v).cast("string")
    attach = lambda t, i: F.struct(F.lit(t).alias("policy_type"), i.alias("policy_id"), text(None).alias("policy_name"))
    none = F.array().cast("array<struct<policy_type:string,policy_id:string,policy_name:string>>")
    policies = (
        F.when(k % 3 == 0, F.array(attach("COMPUTE_POLICY", F.concat(F.lit("p"), k % 5))))
        .when(k % 3 == 1, F.array(attach("BUDGET_POLICY", F.concat(F.lit("b"), k % 4))))
        .otherwise(none)
    )
    rows = _stamped(stamped).select(
        (k % 3).cast("string").alias("workspace_id"),
        F.col("run.id").alias("collection_run_id"),
        "snapshot_ts",
        "snapshot_date",
        F.when(k % 4 == 1, "WORKFLOWS").when(k % 4 == 3, "SQL").otherwise("COMPUTE").alias("product"),
        kind.alias("asset_type"),
        ident.alias("asset_id"),
        F.col("c_name").alias("asset_name"),
        F.col("n_name").alias("owner"),
        F.lit("ACTIVE").alias("lifecycle_state"),
        F.create_map(
            F.lit("segment"), F.col("c_mktsegment"), F.lit("Cost_Center"), F.col("n_name"), F.lit("owner"), owner
        ).alias("tags"),
        policies.alias("policies"),
        F.lit("SYSTEM_TABLE").alias("discovery_source"),
        F.lit(False).alias("api_enriched"),
        (k % 10 != 0).alias("tag_observation_complete"),
        F.when(k % 12 != 1, k % 6 != 1).alias("policy_observation_complete"),
        F.lit(None).cast("string").alias("raw_payload"),
    )
    return rows


INVENTORY_SQL = f"""
inventory AS (
  SELECT CAST(c_custkey % 3 AS VARCHAR) AS workspace_id, run, CAST(seen AS TIMESTAMP) AS snapshot_ts,
    CASE c_custkey % 4 WHEN 1 THEN 'WORKFLOWS' WHEN 3 THEN 'SQL' ELSE 'COMPUTE' END AS product,
    CASE c_custkey % 4 WHEN 1 THEN 'job' WHEN 3 THEN 'warehouse' ELSE 'cluster' END AS asset_type,
    CASE WHEN c_custkey % 4 = 3 THEN 'wh-' ELSE '' END || c_custkey AS asset_id, c_name AS asset_name,
    c_mktsegment AS segment, n_name AS cost_center,
    CASE WHEN c_acctbal <= 0 AND run = 'r1' THEN '' WHEN c_acctbal <= -500 THEN ' ' ELSE c_name END AS owner_tag,
    CASE c_custkey % 3 WHEN 0 THEN 'COMPUTE_POLICY' WHEN 1 THEN 'BUDGET_POLICY' END AS policy_type,
    CASE c_custkey % 3 WHEN 0 THEN 'p' || (c_custkey % 5) WHEN 1 THEN 'b' || (c_custkey % 4) END AS policy_id,
    c_custkey % 10 <> 0 AS tags_seen,
    CASE WHEN c_custkey % 12 <> 1 THEN c_custkey % 6 <> 1 END AS policies_seen
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  CROSS JOIN (VALUES {values_sql(RUNS)}) r(run, seen))"""

HISTORY_SQL = """
judged AS (
  SELECT i.*, r.required_tags, r.required_policies, r.config_hash,
    list_filter(r.required_tags, lambda t: NOT list_contains(
      ['segment', 'cost_center'] || CASE WHEN trim(i.owner_tag) <> '' THEN ['owner'] ELSE CAST([] AS VARCHAR[]) END, t)) AS mt,
    list_filter(r.required_policies, lambda t: coalesce(t <> i.policy_type, TRUE)) AS mp
  FROM inventory i JOIN reqs r USING (workspace_id, run, asset_type)),
history AS (
  SELECT *, CASE WHEN tags_seen THEN mt END AS missing_tags, CASE WHEN coalesce(policies_seen, FALSE) THEN mp END AS missing_policies,
    CASE WHEN len(required_tags) = 0 THEN 'NOT_CONFIGURED' WHEN NOT tags_seen THEN 'UNKNOWN' WHEN len(mt) = 0 THEN 'APPLIED'
      WHEN len(mt) < len(required_tags) THEN 'PARTIAL' ELSE 'NOT_APPLIED' END AS tag_status,
    CASE WHEN len(required_policies) = 0 THEN 'NOT_CONFIGURED' WHEN NOT coalesce(policies_seen, FALSE) THEN 'UNKNOWN'
      WHEN len(mp) = 0 THEN 'APPLIED' WHEN len(mp) < len(required_policies) THEN 'PARTIAL' ELSE 'NOT_APPLIED' END AS policy_status
  FROM judged)"""

# --- lenses and costs -------------------------------------------------------

LOOKBACKS = {"cluster": 35, "job": 10, "serving_endpoint": 365, "warehouse": 20}
LOOKBACK_ROWS = [(w, kind, days) for w in range(3) for kind, days in LOOKBACKS.items()]


def lookbacks(spark: SparkSession) -> DataFrame:
    return local_frame(spark, LOOKBACK_ROWS, "workspace_id bigint, asset_type string, lookback_days int")


FALLBACK_SQL = """
fpriced AS (
  SELECT u.*, u.qty * coalesce(c.p, l.eff, l.p) AS actual_dollars, 'USD' AS currency_code,
    CASE WHEN c.sku IS NOT NULL THEN 'ACCOUNT_PRICE' ELSE 'LIST_PRICE' END AS pricing_source
  FROM usage u
  LEFT JOIN contract c ON c.sku = u.sku_name AND u.usage_start_time >= c.s AND u.usage_start_time < c.e
  LEFT JOIN listed l ON l.sku = u.sku_name AND u.usage_start_time >= l.s AND u.usage_start_time < l.e
  WHERE coalesce(c.p, l.eff, l.p) IS NOT NULL)"""


def lensed_sql(as_of: str, days: dict[str, int]) -> str:
    lens = {
        "cluster": ("COMPUTE", "cluster_id", "product = 'ALL_PURPOSE'"),
        "job": ("WORKFLOWS", "job_id", "TRUE"),
        "serving_endpoint": ("MODEL_SERVING", "endpoint_name", "product = 'MODEL_SERVING'"),
        "warehouse": ("SQL", "warehouse_id", "product = 'SQL'"),
    }
    parts = [
        f"SELECT * EXCLUDE (product), '{kind}' AS asset_type, '{product}' AS product, {ident} AS asset_id FROM fpriced "
        f"WHERE {test} AND {ident} IS NOT NULL AND usage_date >= DATE '{as_of[:10]}' - {days[kind]}"
        for kind, (product, ident, test) in lens.items()
    ]
    return "\nlensed AS (" + "\nUNION ALL ".join(parts) + ")"


COST_SQL = """
cost AS (
  SELECT CAST(workspace_id AS VARCHAR) AS workspace_id, usage_date, product, asset_type, asset_id, 'DBU' AS usage_unit,
    currency_code, pricing_source, sum(qty) AS qty, sum(actual_dollars) AS dollars,
    sum(CASE WHEN tagged THEN actual_dollars ELSE 0 END) AS tagged_dollars,
    sum(CASE WHEN tagged THEN 0 ELSE actual_dollars END) AS untagged_dollars
  FROM lensed GROUP BY ALL)"""
MART_COST_SQL = (
    USAGE_SQL, CONTRACT_SQL, LIST_SQL, FALLBACK_SQL, lensed_sql(MART_AS_OF, LOOKBACKS), COST_SQL,
)
