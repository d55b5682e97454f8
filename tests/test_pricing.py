"""Intervals, missing prices, overlaps, exclusions, node rates, decimals."""

import datetime as dt
import fnmatch
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.functions.exprs import glob_to_regex
from tallyline.operators import pricing as P
from tallyline.operators.quality import check_price_overlap
from tallyline.params import ExclusionRules
from tallyline.sources.config import fleet_aliases
from tallyline.sources.pricing_docs import load_pricing_document, read_pricing_document
from tallyline.sources.usage import scan_price_book, scan_usage

BOOK = "sku_name string, price_start_time timestamp, price_end_time timestamp, unit_price double, currency_code string"
ROWS = [
    ("S", "2024-01-01 00:00:00", "2024-02-01 00:00:00", 1.0, "USD"),
    ("S", "2024-02-01 00:00:00", None, 2.0, "USD"),
    ("T", "2024-01-15 00:00:00", None, 5.0, "USD"),
]


def book(make, rows=ROWS):
    raw = make(rows, BOOK)
    return scan_price_book(raw, price="unit_price")


def use(make, rows):
    return make(rows, "workspace_id bigint, cluster_id string, sku_name string, usage_start_time timestamp, dbus double")


USE = [
    (1, "a", "S", "2024-01-31 23:59:59", 10.0), (1, "a", "S", "2024-02-01 00:00:00", 10.0), (1, "b", "S", "2099-01-01 00:00:00", 1.0),
    (1, "c", "T", "2024-01-14 00:00:00", 3.0), (1, "d", "X", "2024-01-20 00:00:00", 7.0),
]


def test_half_open_interval_and_open_end(make):
    out = P.price_usage(use(make, USE), book(make))
    assert sorted((r.cluster_id, r.dollars) for r in out.collect()) == [("a", 10.0), ("a", 20.0), ("b", 2.0)]


def test_zero_keeps_unpriced_rows(make):
    out = {(r.cluster_id, r.dollars_per_dbu, r.dollars) for r in P.price_usage(use(make, USE), book(make), unpriced="zero").collect()}
    assert ("c", None, 0.0) in out and ("d", None, 0.0) in out and len(out) == 5


def test_bad_mode(make):
    with pytest.raises(ValueError):
        P.price_usage(use(make, USE), book(make), unpriced="guess")


def test_same_result_without_broadcast(spark, make):
    """Beyond the broadcast limit the join shuffles on the SKU."""
    small = P.price_usage(use(make, USE * 50), book(make), unpriced="zero")
    want = sorted(map(tuple, small.collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        large = P.price_usage(use(make, USE * 50), book(make), unpriced="zero")
        assert sorted(map(tuple, large.collect()), key=str) == want
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_overlap_fans_out_and_is_reported(make):
    overlapping = [*ROWS, ("S", "2024-01-20 00:00:00", "2024-01-25 00:00:00", 9.0, "USD")]
    out = P.price_usage(use(make, [(1, "a", "S", "2024-01-22 00:00:00", 1.0)]), book(make, overlapping))
    assert sorted(r.dollars for r in out.collect()) == [1.0, 9.0]
    found = check_price_overlap(book(make, overlapping)).collect()
    assert [(r.sku_name, r.price_start_time.day) for r in found] == [("S", 20)]
    assert check_price_overlap(book(make)).count() == 0


def test_overlap_sees_past_the_previous_row(make):
    rows = [("S", "2024-01-01", "2024-12-01", 1.0, "U"), ("S", "2024-02-01", "2024-03-01", 1.0, "U"), ("S", "2024-06-01", "2024-07-01", 1.0, "U")]
    assert check_price_overlap(book(make, rows)).count() == 2


FULL = "account_id string, cloud string, " + BOOK


def test_two_books(make):
    usage = make(
        [("k", "c", s, "2024-01-10 00:00:00", q) for s, q in (("A", 2.0), ("B", 3.0), ("C", 4.0), ("N", 5.0))],
        "account_id string, cloud string, sku_name string, usage_start_time timestamp, usage_quantity double",
    )
    keys = ("account_id", "cloud", "sku_name")
    row = lambda s, p, acct="k": (acct, "c", s, "2024-01-01", None, p, "EUR" if acct == "k" else "USD")
    contract = scan_price_book(make([row("A", 10.0), row("N", None), row("B", 99.0, "other")], FULL), keys, "unit_price")
    listed = scan_price_book(make([row("A", 1.0), row("B", 2.0), row("N", 7.0)], FULL), keys, "unit_price")
    out = {r.sku_name: (r.actual_dollars, r.pricing_source) for r in P.price_with_fallback(usage, contract, listed).collect()}
    # A contract row without a price still names the contract as the source.
    assert out == {"A": (20.0, "ACCOUNT_PRICE"), "B": (6.0, "LIST_PRICE"), "N": (35.0, "ACCOUNT_PRICE")}


def test_decimal_money_keeps_its_scale(make):
    """Two DECIMAL(38,18) would multiply to six places; the stored dollars have twelve."""
    raw = make([(1, "a", "S", "2024-01-10 00:00:00", 0.0)], "workspace_id bigint, cluster_id string, sku_name string, usage_start_time timestamp, dbus double")
    usage = raw.withColumn("dbus", F.lit("1234567.123456").cast("decimal(38,18)"))
    prices = book(make).withColumn("unit_price", F.lit("0.12345678").cast("decimal(38,18)"))
    for mode in ("drop", "zero"):
        out = P.price_usage(usage, prices, unpriced=mode)
        assert out.first().dollars == Decimal("1234567.123456") * Decimal("0.12345678")


def usage_table(make, rows):
    """(workspace, cluster, day, sku, product)"""
    flat = make([(w, c, d, s, p, 1.0) for w, c, d, s, p in rows], "workspace_id bigint, c string, usage_date date, sku_name string, billing_origin_product string, usage_quantity double")
    return flat.select("*", F.struct(F.col("c").alias("cluster_id")).alias("usage_metadata"), F.to_timestamp("usage_date").alias("usage_start_time"))


def test_scan_window_and_filters(make):
    rows = [
        (1, "in-first", "2024-01-01", "STD", "AP"), (1, "in-last", "2024-01-30", "STD_photon", "AP"), (1, "out-early", "2023-12-31", "STD", "AP"),
        (1, "out-today", "2024-01-31", "STD", "AP"), (1, None, "2024-01-10", "STD", "AP"), (1, "out-sku", "2024-01-10", "x_Serverless_y", "AP"),
        (1, "out-product", "2024-01-10", "STD", "JOBS"),
    ]
    out = scan_usage(usage_table(make, rows), dt.date(2024, 1, 31), 30, "AP", "%SERVERLESS%")
    assert {r.cluster_id: r.photon for r in out.collect()} == {"in-first": False, "in-last": True}


def test_exclusions_match_any_version_and_only_active_clusters(make):
    usage = scan_usage(usage_table(make, [(1, c, "2024-01-10", "S", "AP") for c in ("old-name", "owner", "keep")]), "2024-01-31", 30)
    scd = make(
        [(1, "old-name", "prod-etl-x", "a"), (1, "old-name", "renamed", "a"), (1, "owner", "n", "bot"), (1, "keep", "n", None),
         (1, "idle", "prod-etl-y", "a"), (2, "keep", "prod-etl-z", "a")],
        "workspace_id bigint, cluster_id string, cluster_name string, owned_by string",
    )
    ids = P.resolve_exclusions(usage, scd, ExclusionRules(["listed"], ["prod-etl-*"], ["bot"]))
    assert sorted(r.cluster_id for r in ids.collect()) == ["old-name", "owner"]
    assert [r.cluster_id for r in P.apply_exclusions(usage, ids).collect()] == ["keep"]
    assert P.apply_exclusions(usage, P.resolve_exclusions(usage, scd, ExclusionRules())).count() == 3


def test_exclusions_stay_in_their_workspace(make):
    usage = scan_usage(usage_table(make, [(w, c, "2024-01-10", "S", "AP") for w in (1, 2) for c in ("c", "listed")]), "2024-01-31", 30)
    scd = make([(1, "c", "dev-x", "a"), (2, "c", "prod", "a")], "workspace_id bigint, cluster_id string, cluster_name string, owned_by string")
    ids = P.resolve_exclusions(usage, scd, ExclusionRules(["listed"], ["dev-*"], []))
    assert [(r.workspace_id, r.cluster_id) for r in P.apply_exclusions(usage, ids).collect()] == [(2, "c")]


def test_tiny_prices_keep_their_places(make):
    raw = scan_usage(usage_table(make, [(1, "c", "2024-01-10", "S", "AP")]), "2024-01-31", 30)
    for units, price, dollars in (("1000000000", "0.0000000714", "71.4"), ("10000000000000", "0.5", "5000000000000"), ("0.000000001", "10000000", "0.01")):
        usage = raw.withColumn("dbus", F.lit(units).cast("decimal(38,18)"))
        prices = book(make).filter("sku_name = 'S'").withColumn("unit_price", F.lit(price).cast("decimal(38,18)")).limit(1)
        prices = prices.withColumn("price_start_time", F.lit("2000-01-01").cast("timestamp")).withColumn("price_end_time", F.lit("2100-01-01").cast("timestamp"))
        assert P.price_usage(usage, prices).first().dollars == Decimal(dollars)


@pytest.mark.parametrize("pattern", ["[!]x", "[z-a]", "[!z-a]", "[]]", "[!]]", "[a", "a]", "[a-c]x", "[^a]", "[!a]?", "x[", "[-a]", "[a-]", "*[0-9]", "a.b", "[&&a]", "[[a]"])
def test_globs_mean_what_the_shell_means(spark, pattern):
    names = ["a", "b", "x", "]", "[", "!", "^", "-", "&", "ax", "[!]x", "[a", "x[", "a]", "bx", "q7", "a.b", "aab", "!x", "[z-a]"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").filter(F.col("n").rlike(glob_to_regex(pattern)))
    assert sorted(r.n for r in rows.collect()) == sorted(n for n in names if fnmatch.fnmatchcase(n, pattern))


def test_node_rates(spark, make, tmp_path):
    doc = tmp_path / "rates.json"
    doc.write_text(
        """[{"compute": "All-Purpose Compute", "plan": "Premium", "instance": "r5d.large", "dburate": "2"},
        {"compute": "All-Purpose Compute Photon", "plan": "Premium", "instance": "r5d.large (Photon)", "dburate": "4"},
        {"compute": "All-Purpose Compute", "plan": "Basic", "instance": "r5d.large", "dburate": "9"},
        {"compute": "Jobs", "plan": "Premium", "instance": "r5d.large", "dburate": "9"},
        {"compute": "All-Purpose Compute", "plan": "Premium", "instance": "r5dn.large", "dburate": "3"}]"""
    )
    kept = load_pricing_document(read_pricing_document(spark, str(doc)), ["All-Purpose Compute", "All-Purpose Compute Photon"], "Premium")
    customer = make([(1, False, "PLAIN", 0.5), (2, False, "P2", 1.0), (2, True, "F2", 2.0)], "workspace_id bigint, photon boolean, sku_name string, dollars_per_dbu double")
    out = {(r.workspace_id, r.node_type, r.photon): r.dollars_per_hour for r in P.pricing_rates(kept, fleet_aliases(spark), customer, "x").collect()}
    assert out == {
        (1, "r5d.large", False): 1.0, (1, "rd-fleet.large", False): 1.0, (1, "r5dn.large", False): 1.5, (2, "r5d.large", False): 2.0,
        (2, "rd-fleet.large", False): 2.0, (2, "r5dn.large", False): 3.0, (2, "r5d.large", True): 8.0, (2, "rd-fleet.large", True): 8.0,
    }


def test_customer_rate_is_the_latest(make):
    priced = make(
        [(1, False, "A", 1.0, "2024-01-01"), (1, False, "A", 2.0, "2024-01-05"), (1, False, "B", 3.0, "2024-01-05"), (1, True, "F", 4.0, "2024-01-02")],
        "workspace_id bigint, photon boolean, sku_name string, dollars_per_dbu double, usage_start_time timestamp",
    )
    assert {r.photon: (r.sku_name, r.dollars_per_dbu) for r in P.customer_rates(priced).collect()} == {False: ("B", 3.0), True: ("F", 4.0)}
