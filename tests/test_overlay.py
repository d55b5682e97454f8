"""Two price books as one: the overlay against two separate joins, and the shape of its plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyline.operators import pricing as P
from tallyline.plans import bindings as b

SF = "/root/testdata/sf0.001"
BOOK = "sku_name string, price_start_time timestamp, price_end_time timestamp, unit_price decimal(20,6), currency_code string"


def two_joins(usage, contract, listed):
    """The plain form: each book joined by key and time."""
    c, l = P._tagged(contract, "_c_"), P._tagged(listed, "_l_")
    both = usage.join(c, P._in_force(["sku_name"], "_c_"), "left").join(l, P._in_force(["sku_name"], "_l_"), "left")
    price = F.coalesce("_c_unit_price", "_l_unit_price")
    return both.filter(price.isNotNull()).select(
        *usage.columns, (F.col("usage_quantity") * price).cast("decimal(38,12)").alias("actual_dollars"), F.coalesce("_c_currency_code", "_l_currency_code").alias("currency_code"),
        F.when(F.col("_c_sku_name").isNotNull(), "ACCOUNT_PRICE").otherwise("LIST_PRICE").alias("pricing_source"),
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("days", [None, ("2024-01-05", "2024-01-20"), ("2024-01-10", "2024-01-10")])
def test_same_as_two_joins(spark, make, seed, days):
    rng = random.Random(seed)

    def when(day):
        return f"2024-01-{day:02d} {rng.choice(('00:00:00', '07:30:00'))}"

    def book(currency, n):
        rows = []
        for _ in range(n):
            start = rng.randint(1, 27)
            end = rng.choice(["9999-01-01 00:00:00", when(min(28, start + rng.randint(0, 6)))])
            rows.append((rng.choice("ABC"), rng.choice([when(start), "2023-01-01 00:00:00"]), end, rng.choice([None, rng.randint(1, 900)]), currency))
        return make([(k, s, e, None if p is None else p, c) for k, s, e, p, c in rows], BOOK.replace("decimal(20,6)", "bigint")).withColumn("unit_price", (F.col("unit_price") / 100).cast("decimal(20,6)"))

    usage = make([(i, rng.choice("ABCD"), when(rng.randint(1, 28)), rng.randint(1, 99)) for i in range(80)], "id bigint, sku_name string, usage_start_time timestamp, n bigint")
    usage = usage.withColumn("usage_quantity", (F.col("n") / 7).cast("decimal(20,6)"))
    contract, listed = book("USD", 6), book("EUR", 8)
    got = P.price_with_fallback(usage, contract, listed, ("sku_name",), days=days).withColumn("actual_dollars", F.col("actual_dollars").cast("decimal(38,12)"))
    want = two_joins(usage, contract, listed)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_intervals_are_disjoint(spark, make):
    contract = make([("A", "2024-01-05 00:00:00", "2024-01-10 00:00:00", 2, "USD"), ("A", "2024-01-10 00:00:00", "2024-01-10 00:00:00", 9, "USD")], BOOK.replace("decimal(20,6)", "bigint"))
    listed = make([("A", "2024-01-01 00:00:00", "2024-01-20 00:00:00", 5, "EUR"), ("B", "2024-01-01 00:00:00", "9999-01-01 00:00:00", 7, "EUR")], BOOK.replace("decimal(20,6)", "bigint"))
    got = [(r.sku_name, r.price_start_time.day, r.price_end_time.day, r.unit_price, r.pricing_source) for r in P.overlay_books(contract, listed, ("sku_name",)).collect()]
    assert sorted(got) == [("A", 1, 5, 5, "LIST_PRICE"), ("A", 5, 10, 2, "ACCOUNT_PRICE"), ("A", 10, 20, 5, "LIST_PRICE"), ("B", 1, 1, 7, "LIST_PRICE")]
    assert P.overlay_books(contract.limit(0), listed.limit(0), ("sku_name",)).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_overlay_is_broadcast_and_usage_does_not_move(spark):
    rows = P.price_with_fallback(b.usage(spark, SF), b.account_prices(spark), b.list_prices(spark))
    rows.collect()
    text = plan(rows)
    text = text[: text.index("== Initial Plan ==")]
    assert len(re.findall(r"(?:Hash|Merge|Loop)Join", text)) == 1 and "BroadcastHashJoin" in text
    usage_side = text[text.index("BroadcastHashJoin") :]
    assert "Exchange" not in usage_side[: usage_side.index("BroadcastQueryStage")].replace("BroadcastExchange", "")


def test_a_hot_sku_is_split(spark):
    """Without broadcasts there is one shuffled join, and AQE splits the SKU that holds most rows."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        usage = spark.range(300_000).repartition(8).select(
            F.when(n % 3 != 0, "HOT").otherwise(F.concat(F.lit("S"), n % 50)).alias("sku_name"),
            (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=(n % 700).cast("int"))).alias("usage_start_time"), (n % 13).cast("double").alias("usage_quantity"), n,
        )
        skus = spark.range(51).select(F.when(n == 50, "HOT").otherwise(F.concat(F.lit("S"), n)).alias("sku_name"), n)
        book = skus.select("sku_name", F.lit("2024-01-01").cast("timestamp").alias("price_start_time"), F.lit("9999-01-01").cast("timestamp").alias("price_end_time"), (n + 1.0).alias("unit_price"), F.lit("USD").alias("currency_code"))
        out = P.price_with_fallback(usage, book.filter("unit_price > 20"), book, ("sku_name",))
        assert out.count() == 300_000
        rows = out.agg(F.sum("actual_dollars"))
        rows.collect()
        text = plan(rows)
        text = text[: text.index("== Initial Plan ==")]
        assert "skew=true" in text and len(re.findall(r"(?:Hash|Merge|Loop)Join", text)) == 1
    finally:
        for key in wanted:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_places_of_many_blocks(spark, make):
    """Prices over hundreds of places, some short and some from end to end, against two joins."""
    rng = random.Random(1)

    def book(currency, n):
        rows = spark.range(n).select(
            F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int")).alias("sku_name"),
            (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=(F.col("id") * 7 % n).cast("int"))).alias("price_start_time"),
            F.col("id"),
        )
        long = F.make_interval(hours=F.when(F.col("id") % 50 == 0, F.lit(n)).otherwise(F.lit(5)).cast("int"))
        price = F.when(F.col("id") % 11 != 0, (F.col("id") + 1).cast("decimal(20,6)"))
        return rows.select("sku_name", "price_start_time", (F.col("price_start_time") + long).alias("price_end_time"), price.alias("unit_price"), F.lit(currency).alias("currency_code"))

    contract, listed = book("USD", 300), book("EUR", 400)
    usage = make([(i, rng.choice("AB"), f"2024-01-{rng.randint(1, 20):02d} {rng.randint(0, 23):02d}:30:00", 2) for i in range(150)], "id bigint, sku_name string, usage_start_time timestamp, n bigint")
    usage = usage.withColumn("usage_quantity", F.col("n").cast("decimal(20,6)"))
    want = sorted(map(str, two_joins(usage, contract, listed).collect()))
    for days in (None, ("2024-01-03", "2024-01-15")):
        got = P.price_with_fallback(usage, contract, listed, ("sku_name",), days=days)
        assert sorted(map(str, got.withColumn("actual_dollars", F.col("actual_dollars").cast("decimal(38,12)")).collect())) == want


@pytest.mark.parametrize("days", [None, ("2024-01-01", "2024-01-09")])
def test_pairs_of_prices_are_made_after_the_join(spark, days):
    """Nothing below the join makes pairs, so what is moved does not grow with them."""
    usage = spark.range(9).select(F.lit("A").alias("sku_name"), F.lit("2024-01-05").cast("timestamp").alias("usage_start_time"), F.lit(1.0).alias("usage_quantity"))
    book = spark.range(9).select(F.lit("A").alias("sku_name"), F.lit("2024-01-01").cast("timestamp").alias("price_start_time"), F.lit("2024-01-09").cast("timestamp").alias("price_end_time"), (F.col("id") + 1.0).alias("unit_price"), F.lit("USD").alias("currency_code"))
    rows = P.price_with_fallback(usage, book, book, ("sku_name",), days=days)
    text = plan(rows)
    assert rows.count() == 9 * 9 * 9
    below = text[re.search(r"(?:Hash|Merge|Loop)Join", text).start() :]
    assert not re.search(r"Generate explode\(_[cl]#", below)


def test_blocks_of_one_sku_are_met_by_many_tasks(spark):
    """The pairs of a SKU are made in as many tasks as its blocks go to, and prices are picked once for each place."""
    n = F.col("id")
    begins = F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=n.cast("int"))
    book = spark.range(2000).select(F.lit("A").alias("sku_name"), begins.alias("price_start_time"), (begins + F.make_interval(hours=F.lit(3))).alias("price_end_time"), (n + 1.0).alias("unit_price"), F.lit("USD").alias("currency_code"))
    wanted = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        pieces = P.overlay_pieces(book, book, ("sku_name",))
        rows = pieces.select(F.spark_partition_id().alias("task"), F.size("_c").alias("c"), F.size("_l").alias("l")).collect()
        assert len(rows) == 2002 and len({r.task for r in rows}) > 4
        assert sorted(r.c for r in rows) == sorted(r.l for r in rows) == [1, 1, 2, 2, *[3] * 1998]
        assert len(re.findall(r"\bfilter\(", P.overlay_books(book, book, ("sku_name",))._jdf.queryExecution().optimizedPlan().toString())) == 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
