"""Links by stream-stream joins against a plain loop over the events."""

from __future__ import annotations

import datetime as dt
import random

from campaignlake.schemas import TYPED_COLUMNS, TYPED_SCHEMA
from campaignlake.sources.tables import read_table
from campaignlake.streaming.layers import LayerPaths, await_query
from campaignlake.streaming.links import LINK_SCHEMA, dropped_rows, linkage, links_path, start_links

START = dt.datetime(2024, 1, 1)
PARENT = {"click": ("impression_id", "impression"), "conversion": ("click_id", "click")}


def _row(event_id, kind, at, campaign="c1", **refs):
    return {"event_id": event_id, "event_type": kind, "campaign_id": campaign, "event_timestamp": at, **refs}


def _events(seed, n=300):
    rng, out = random.Random(seed), []
    for k in range(n):
        kind = rng.choice(["impression", "click", "click", "conversion"])
        at = START + dt.timedelta(minutes=rng.randrange(6 * 24 * 60)) if rng.random() < 0.97 else None
        refs = {}
        if kind != "impression":
            near = rng.choice(["e0", "hot", "none", None, *(r["event_id"] for r in out[-20:])])
            refs[PARENT[kind][0]] = near
        out.append(_row(f"e{k}", kind, at, rng.choice(["c1", "c2", None]), **refs))
    return [_row("hot", "impression", START), *out]


def _expected(events):
    times = {(r["event_id"], r["event_type"]): r["event_timestamp"] for r in events}
    found = {}
    for r in events:
        if r["event_type"] in PARENT:
            ref, kind = PARENT[r["event_type"]]
            parent, at = times.get((r.get(ref), kind)), r["event_timestamp"]
            linked = parent is not None and at is not None and dt.timedelta(0) <= at - parent <= dt.timedelta(days=1)
            line = found.setdefault(r["campaign_id"], [0, 0, 0, 0])
            place = 0 if r["event_type"] == "click" else 2
            line[place] += 1
            line[place + 1] += linked
    return found


def _drain(spark, paths, events, **options):
    rows = [tuple(r.get(c) for c in TYPED_COLUMNS) for r in events]
    schema = [next(f for f in TYPED_SCHEMA.fields if f.name == c) for c in TYPED_COLUMNS]
    frame = spark.createDataFrame(rows, type(TYPED_SCHEMA)(schema))
    frame.coalesce(1).write.mode("append").partitionBy("event_type").parquet(paths.typed)
    return await_query(start_links(spark, paths, state_partitions=2, **options), 300)


def _report(spark, paths):
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    out = linkage(typed, read_table(spark, links_path(paths), schema=LINK_SCHEMA)).collect()
    return {r["campaign_id"]: list(r[1:]) for r in out}


def test_report_equals_a_loop_after_each_drain(spark, scratch):
    paths, events = LayerPaths.under(scratch), _events(3)
    order = random.Random(4).sample(events, len(events))  # many rows come later than the watermark
    for start, end in ((0, 100), (100, len(order))):
        progress = _drain(spark, paths, order[start:end])
        assert _report(spark, paths) == _expected(order[:end])
    assert dropped_rows(progress) > 0
    links = read_table(spark, links_path(paths), schema=LINK_SCHEMA)
    assert links.count() == links.select("event_id").distinct().count()  # no child twice


def test_only_hot_parents_are_stored_more_than_once(spark, scratch):
    events = [_row(f"i{k}", "impression", START + dt.timedelta(minutes=k)) for k in range(60)]
    events += [
        _row(f"c{k}", "click", START + dt.timedelta(minutes=60 + k), impression_id=f"i{k % 60 if k < 60 else 7}")
        for k in range(80)
    ]
    stored = {}
    for hot in (10, 1000, 0):  # i7 is hot, none is, all are
        paths = LayerPaths.under(f"{scratch}/{hot}")
        progress = _drain(spark, paths, events, hot_children=hot)
        assert _report(spark, paths) == _expected(events)
        stored[hot] = max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress)
    assert stored[1000] < stored[10] < stored[0]


def test_references_that_become_hot_between_drains(spark, scratch):
    paths, events = LayerPaths.under(scratch), _events(5)
    for start, end in ((0, 120), (120, len(events))):
        _drain(spark, paths, events[start:end], hot_children=12)
        assert _report(spark, paths) == _expected(events[:end])


def test_links_at_the_edges_of_the_range(spark, scratch):
    paths, day, second = LayerPaths.under(scratch), dt.timedelta(days=1), dt.timedelta(seconds=1)
    noon = START + day / 2
    events = [
        _row("i", "impression", noon),
        _row("same", "click", noon, impression_id="i"),
        _row("last", "click", noon + day, impression_id="i"),
        _row("after", "click", noon + day + second, impression_id="i"),
        _row("before", "click", noon - second, impression_id="i"),
        _row("other type", "conversion", noon, click_id="i"),
        _row("buys", "conversion", noon + day, click_id="same"),
        _row("no time", "click", None, impression_id="i"),
        _row("no reference", "click", noon),
    ]
    _drain(spark, paths, events)
    assert _report(spark, paths) == {"c1": [6, 2, 2, 1]}
    streamed = read_table(spark, links_path(paths), schema=LINK_SCHEMA).where("linked").collect()
    assert {r["event_id"] for r in streamed} == {"same", "last", "buys"}
    # what no parent can follow comes out as unlinked once the watermark has passed it
    _drain(spark, paths, [_row("z", kind, noon + 9 * day) for kind in ("impression", "click", "conversion")]
           + [_row(f"y{k}", k, noon + 9 * day, impression_id="q", click_id="q") for k in ("click", "conversion")])
    later = read_table(spark, links_path(paths), schema=LINK_SCHEMA).where("NOT linked").collect()
    assert {"after", "before", "other type", "no time", "no reference"} <= {r["event_id"] for r in later}


def test_empty_tables_give_an_empty_report(spark):
    typed = spark.createDataFrame([], TYPED_SCHEMA)
    assert linkage(typed, spark.createDataFrame([], LINK_SCHEMA)).count() == 0
