"""Activity bitmaps and mergeable sketches against plain counting."""

import random
from datetime import date, timedelta

import pytest
from helpers import frame

from pulseledger.operators import bitmaps, sketches

START = date(2024, 1, 1)
WINDOWS = {"one": 1, "week": 7, "month": 30, "all": 60}
KEYS = ["account_id", "user_id"]


def random_days(rng, n):
    return [(rng.choice("ab"), rng.choice([f"u{i}" for i in range(12)]), START + timedelta(days=rng.randrange(100))) for _ in range(n)]


def counted(rows, as_of):
    out = {}
    for account in {a for a, _, _ in rows}:
        for name, days in WINDOWS.items():
            users = {u for a, u, d in rows if a == account and as_of - timedelta(days=days) < d <= as_of}
            out[account, name] = len(users)
    return {k: v for k, v in out.items() if out[k[0], "all"]}


def found(masks):
    return {(r.account_id, n): r[n] for r in bitmaps.masked_actives(masks, ["account_id"], WINDOWS).collect() for n in WINDOWS}


@pytest.mark.parametrize("seed", [1, 2])
def test_masks_equal_counting_with_late_days(spark, seed):
    rng = random.Random(seed)
    rows = random_days(rng, 300)
    schema = "account_id string, user_id string, day date"
    seen = [r for r in rows if r[2] <= START + timedelta(days=50) and rng.random() < 0.8]
    before = START + timedelta(days=50)
    masks = bitmaps.activity_masks(spark.createDataFrame(seen, schema), KEYS, "day", before)
    assert found(masks) == counted(seen, before)
    for step in (1, 0, 5, 30, 70):
        as_of = before + timedelta(days=step)
        new = [r for r in rows if r not in seen and r[2] <= as_of and rng.random() < 0.7]
        seen += new
        masks = bitmaps.advance_masks(masks, spark.createDataFrame(new, schema), KEYS, "day", before, as_of)
        assert found(masks) == counted(seen, as_of)
        before = as_of


def test_mask_limits(spark):
    masks = bitmaps.activity_masks(spark.createDataFrame([], "account_id string, user_id string, day date"), KEYS, "day", START)
    assert bitmaps.masked_actives(masks, ["account_id"], WINDOWS).count() == 0
    with pytest.raises(ValueError, match="too few"):
        bitmaps.masked_actives(masks, ["account_id"], {"long": 61})
    with pytest.raises(ValueError, match="back in time"):
        bitmaps.advance_masks(masks, masks, KEYS, "day", START, START - timedelta(days=1))


def test_sketches_unite(spark):
    rows = [("a" if i % 3 else "b", f"u{i % 5000}", f"2024-01-{1 + i % 20:02d}", f"e{i % 7}") for i in range(30_000)]
    daily = frame(spark, "account_id string, user_id string, at timestamp, event_name string", [(a, u, f"{d} 00:00", e) for a, u, d, e in rows])
    daily = daily.selectExpr("account_id", "user_id", "event_name", "to_date(at) AS activity_date")
    stored = sketches.daily_sketches(daily)
    first, last = date(2024, 1, 5), date(2024, 1, 15)
    span = [r for r in rows if first.isoformat() <= r[2] <= last.isoformat()]
    for keys in (["account_id"], []):
        for r in sketches.united_estimates(stored, keys, first, last).collect():
            own = [x for x in span if not keys or x[0] == r.account_id]
            exact = len({x[1] for x in own})
            assert abs(r.approx_users - exact) <= 5 * sketches.STANDARD_ERROR * exact
            assert r.approx_features == len({x[3] for x in own})
