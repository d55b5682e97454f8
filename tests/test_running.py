"""Openings by month: the same windows as a scan of everything, old days unread, old months unwritten."""

import datetime as dt
import os
import random

import pytest

from tallyline.operators import costs as C
from tallyline.operators import running as R
from tallyline.operators import versions as V
from tallyline.plans.job_queries import _DAILY

FIELDS = [f.split()[0] for f in _DAILY.split(", ")]


def rows(spark, seed, first, last, n=300):
    rng, days = random.Random(seed), (last - first).days
    out = []
    for _ in range(n):
        day = first + dt.timedelta(days=rng.randint(0, days))
        values = {"workspace_id": rng.choice("01"), "product": rng.choice(["P", "Q"]), "asset_type": "cluster", "asset_id": f"a{rng.randint(0, 12)}", "usage_unit": "DBU",
                  "currency_code": rng.choice(["USD", "EUR"]), "pricing_source": "LIST_PRICE", "usage_date": day, "actual_daily_dollars": float(rng.randint(1, 99))}
        out.append(tuple(values.get(f, 1.0 if f.endswith(("dollars", "quantity")) else None) for f in FIELDS))
    return spark.createDataFrame(out, _DAILY)


def canonical(df):
    return sorted(str([r[c] for c in sorted(df.columns)]) for r in df.collect())


@pytest.mark.parametrize("as_of", ["2024-01-31", "2024-03-01", "2024-05-15", "2024-12-31"])
def test_same_windows_as_a_whole_scan(spark, as_of):
    day = dt.date.fromisoformat(as_of)
    cost = rows(spark, as_of, day - dt.timedelta(days=500), day + dt.timedelta(days=2))
    openings = R.month_openings(cost, R.as_of_date(as_of))
    assert canonical(R.trailing_from_openings(openings, cost, as_of)) == canonical(C.trailing_cost(cost, as_of))
    assert R.trailing_from_openings(openings.limit(0), cost.limit(0), as_of).count() == 0


def test_a_refresh_touches_its_window_only(spark, tmp_path):
    first, day = dt.date(2023, 1, 1), dt.date(2024, 5, 15)
    cost = rows(spark, 1, first, day, 500)
    tables = V.VersionedTables(spark, f"{tmp_path}/cost", {"asset_cost_daily": (_DAILY, ["usage_date"])})
    change = tables.change("a")
    change.add("asset_cost_daily", cost)
    change.commit()
    openings = R.openings_table(spark, f"{tmp_path}/openings", double=True)
    change = openings.change("a")
    R.refresh_openings(change, cost.filter("usage_date < '2024-05-01'"), "2024-05-01", 35)  # nothing there yet: all months
    change.commit()

    def files():
        return {os.path.join(p, f): os.path.getmtime(os.path.join(p, f)) for p, _, names in os.walk(f"{tmp_path}/openings/asset_cost_opening") for f in names if f.endswith(".parquet")}

    before = files()
    daily = tables.read("asset_cost_daily")
    corrected = daily.filter("NOT (usage_date >= '2024-04-20' AND asset_id = 'a3')")
    change = openings.change("b")
    R.refresh_openings(change, corrected, "2024-05-15", 25)
    change.commit()
    now = openings.read("asset_cost_opening")
    assert canonical(now) == canonical(R.month_openings(corrected, R.as_of_date("2024-05-15")).select(*now.columns))
    after = files()
    assert all(after[f] == t for f, t in before.items())
    assert {f.split("month=")[1][:10] for f in after if f not in before} == {"2024-05-01"}
    spend = R.trailing_from_openings(now, daily.filter("NOT (usage_date >= '2024-04-20' AND asset_id = 'a3')"), "2024-05-15")
    assert canonical(spend) == canonical(C.trailing_cost(corrected, "2024-05-15"))
    text = spend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage_date" in text and "usage_date#" in text.split("PartitionFilters")[1][:120]
