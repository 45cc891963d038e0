"""Attribution: credits against brute force, sums to the cent, defined cases."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from campaignlake.operators import attribution_by_campaign, attribution_credits, touch_paths

SCHEMA = (
    "event_id string, event_type string, event_timestamp timestamp, user_id_hashed string,"
    " campaign_id string, revenue double, attribution_model string"
)
START = dt.datetime(2024, 3, 1)
DAY = dt.timedelta(days=1)


def _events(seed=3, n=900):
    """Random events; user ``hot`` has more than a third of them."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        user = rng.choice(["hot", "hot", "a", "b", "c", None])
        at = START + dt.timedelta(seconds=rng.randrange(0, 20 * 86400, 1800)) if rng.random() < 0.98 else None
        kind = rng.choice(["click"] * 5 + ["conversion", "impression"])
        money = rng.choice([0.01, 10.0, 99.99, 0.05, 1234.56, -7.03, 0.0, None, float("nan"), 1e20])
        model = rng.choice(["last_click", "linear", "time_decay", "other", None])
        conv = kind == "conversion"
        rows.append((f"e{k:04}", kind, at, user, f"camp{k % 4}", money if conv else None, model if conv else None))
    return rows


def _brute(rows, days=7, most=20):
    out = {}
    clicks = [r for r in rows if r[1] == "click" and r[2] and r[3]]
    for cid, kind, at, user, _, money, model in rows:
        if kind != "conversion":
            continue
        cents = None if money is None or money != money or abs(money) >= 1e16 else round(money * 100)
        path = sorted((c[2], c[0], c[4]) for c in clicks if at and c[3] == user and at - days * DAY <= c[2] <= at)
        path = path[::-1][:most]
        if not path:
            out[cid, None] = (None, cents)
            continue
        model = model if model in ("linear", "time_decay") else "last_click"
        weights = [
            int(k == 0) if model == "last_click" else 1 if model == "linear" else 2 ** (days - (at - t) // DAY)
            for k, (t, _, _) in enumerate(path)
        ]
        shares = [Fraction(abs(cents or 0) * w, sum(weights)) for w in weights]
        parts = [int(s) for s in shares]
        order = sorted(range(len(path)), key=lambda k: (-(shares[k] - parts[k]), k))
        for k in order[: abs(cents or 0) - sum(parts)]:
            parts[k] += 1
        for (_, click, campaign), part in zip(path, parts, strict=True):
            out[cid, click] = (campaign, None if cents is None else part if cents >= 0 else -part)
    return out


@pytest.mark.parametrize(("days", "most"), [(7, 20), (2, 3), (31, 1)])
def test_credits_against_brute_force(spark, days, most):
    rows = _events()
    typed = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = attribution_credits(typed, lookback_days=days, max_touches=most).collect()
    assert {(r["event_id"], r["click_id"]): (r["campaign_id"], r["credit_cents"]) for r in got} == _brute(rows, days, most)
    assert len(got) == len(_brute(rows, days, most))


@pytest.mark.parametrize("hot", [0, 100, 1000])
def test_hot_and_other_users_get_the_same_credits(spark, hot):
    rows = _events(5)
    got = attribution_credits(spark.createDataFrame(rows, SCHEMA).repartition(5), hot_events=hot).collect()
    assert {(r["event_id"], r["click_id"]): (r["campaign_id"], r["credit_cents"]) for r in got} == _brute(rows)
    assert len(got) == len(_brute(rows))


def test_paths_are_not_shuffled(spark):
    """Of most users, events are shuffled once: what follows, up to the sums, stays in its task."""
    from campaignlake.operators.attribution import _credit_parts

    typed = spark.createDataFrame(_events(6), SCHEMA)
    most = _credit_parts(typed, 7, 20, 1_000_000)[0]
    plan = most._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 2  # and the count of hot users


def test_credits_of_a_conversion_are_its_revenue(spark):
    rows = _events(8)
    got = attribution_credits(spark.createDataFrame(rows, SCHEMA)).collect()
    sums = defaultdict(int)
    for r in got:
        sums[r["event_id"]] += r["credit_cents"] or 0
    for cid, kind, _, _, _, money, _ in rows:
        if kind == "conversion" and money is not None and abs(money) < 1e16:
            assert sums[cid] == round(money * 100)


def test_by_campaign_adds_up(spark):
    rows = _events(4)
    typed = spark.createDataFrame(rows, SCHEMA)
    credits = _brute(rows)
    got = {(r["attribution_model"], r["campaign_id"]): r for r in attribution_by_campaign(typed).collect()}
    assert sum(r["credit_cents"] for r in got.values()) == sum(c or 0 for _, c in credits.values())
    assert sum(r["touches"] for r in got.values()) == sum(click is not None for _, click in credits)
    assert {m for m, _ in got} <= {"last_click", "linear", "time_decay"}


def test_a_hot_user_is_no_single_task(spark):
    """The path join is keyed by (user, number), so one user's clicks reach many partitions."""
    rows = [(f"k{k:05}", "click", START + dt.timedelta(minutes=k), "hot", "c", None, None) for k in range(3000)]
    rows += [(f"v{k}", "conversion", START + dt.timedelta(minutes=30 * k), "hot", "c", 1.0, "linear") for k in range(90)]
    typed = spark.createDataFrame(rows, SCHEMA)
    paths = touch_paths(typed)
    assert paths.count() == sum(min(20, 30 * k + 1) for k in range(90))
    plan = paths._jdf.queryExecution().toString()
    assert "hashpartitioning(user" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert attribution_by_campaign(empty).count() == 0
    with pytest.raises(ValueError):
        attribution_credits(empty, lookback_days=90)


def test_money_sums_that_overflow_fall_back_to_doubles(spark):
    from campaignlake.functions.kpi import exact_money_sum

    frame = spark.createDataFrame([("a", 9e27), ("a", 9e27), ("b", 0.1), ("b", 0.2), ("c", None)], "g string, v double")
    got = {r["g"]: r["s"] for r in frame.groupBy("g").agg(exact_money_sum("v").alias("s")).collect()}
    assert got == {"a": 1.8e28, "b": 0.3, "c": None}
