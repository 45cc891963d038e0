"""Independent SQL (DuckDB dialect) for every registered query.

Every statement starts from the ``events`` view and rebuilds the chain in
plain SQL: the fixture mapping, the JSON wire form, the raw extracts, the
typed parse, dedup and the KPIs.  Spark's ``round`` on a double rounds the
shortest decimal form of the value HALF_UP; :func:`sround` spells that out so
ties break the same way on both engines.
"""

from __future__ import annotations


def sround(expr: str, digits: int) -> str:
    """Spark ``round(double, n)``: HALF_UP on the value's decimal text."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def dround(expr: str, digits: int) -> str:
    """Exact form: through ``decimal(28,10)``, then HALF_UP."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


# Money sums: exact in decimal, returned as double.
MONEY_SUM = "CAST(sum(CAST(({}) AS DECIMAL(38,10))) AS DOUBLE)"


_CONVERSION_CENTS = (
    "SELECT event_id, user_id_hashed AS u, event_timestamp AS ts, CAST(CAST(revenue AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents, "
    "CASE WHEN attribution_model IN ('last_click', 'linear', 'time_decay') THEN attribution_model ELSE 'last_click' END AS m "
    "FROM typed WHERE event_type = 'conversion'"
)


def _js(field: str, src: str = "raw_payload") -> str:
    return f"json_extract_string({src}, '$.{field}')"


_COMMON = [
    "event_id", "event_type", "event_timestamp", "campaign_id", "ad_id",
    "advertiser_id", "publisher_id", "user_id_hashed", "session_id",
]
_WIRE = {
    "impression": _COMMON + ["device_type", "channel", "placement", "viewable", "viewable_seconds"],
    "click": _COMMON + ["device_type", "channel", "placement", "impression_id"],
    "conversion": _COMMON + ["click_id", "impression_id", "order_id", "product_id", "product_category",
                             "revenue", "quantity", "attribution_model"],
}
_FOREIGN = _COMMON + ["device_type", "channel"]


def _json_object(fields: list[str]) -> str:
    return "json_object(" + ", ".join(f"'{f}', {f}" for f in fields) + ")"


_PAYLOAD = (
    "CASE event_type "
    + " ".join(f"WHEN '{t}' THEN {_json_object(f)}" for t, f in _WIRE.items())
    + f" ELSE {_json_object(_FOREIGN)} END"
)

# The typed columns (23 minus the ingest clock) in table order.
TYPED_OUT = [
    "event_id", "event_type", "event_timestamp", "campaign_id", "ad_id", "advertiser_id",
    "publisher_id", "user_id_hashed", "session_id", "device_type", "channel",
    "placement", "viewable", "viewable_seconds", "impression_id",
    "click_id", "order_id", "product_id", "product_category", "revenue", "quantity", "attribution_model",
]
TYPE_COLUMNS = {
    "impression": TYPED_OUT[:14],
    "click": TYPED_OUT[:12] + ["impression_id"],
    "conversion": TYPED_OUT[:11] + ["click_id", "impression_id", "order_id", "product_id",
                                     "product_category", "revenue", "quantity", "attribution_model"],
}
RAW_OUT = [
    "raw_payload", "eh_topic", "eh_partition", "eh_offset", "eh_enqueued_time",
    "event_type", "event_timestamp", "campaign_id", "event_date",
]
METRICS_OUT = [
    "event_date", "campaign_id", "advertiser_id", "impressions", "viewable_impressions", "clicks",
    "conversions", "revenue", "items_sold", "ctr", "cvr", "spend", "roas",
]

_OWNED = {
    "placement": ("impression", "click"),
    "viewable": ("impression",),
    "viewable_seconds": ("impression",),
    "impression_id": ("click", "conversion"),
    "click_id": ("conversion",),
    "order_id": ("conversion",),
    "product_id": ("conversion",),
    "product_category": ("conversion",),
    "revenue": ("conversion",),
    "quantity": ("conversion",),
    "attribution_model": ("conversion",),
}
_CASTS = {
    "event_timestamp": "timezone('UTC', try_cast({} AS TIMESTAMPTZ))",
    "viewable": "try_cast({} AS BOOLEAN)",
    "viewable_seconds": "try_cast({} AS DOUBLE)",
    "revenue": "try_cast({} AS DOUBLE)",
    "quantity": "try_cast({} AS INTEGER)",
}


def _parsed_column(name: str) -> str:
    expr = _CASTS.get(name, "{}").format(_js(name))
    owners = _OWNED.get(name)
    if owners:
        types = ", ".join(f"'{t}'" for t in owners)
        expr = f"CASE WHEN r.event_type IN ({types}) THEN {expr} END"
    return f"{expr} AS {name}"


def _metrics_cte(name: str, typed: str, exact: bool) -> str:
    rnd = dround if exact else sround
    spend = (
        "CAST(round(CAST(clicks AS DECIMAL(20,0)) * CAST(0.5 AS DECIMAL(10,4)), 2) AS DOUBLE)"
        if exact
        else sround("clicks * CAST(0.5 AS DOUBLE)", 2)
    )
    return f"""
{name}_imp AS (
  SELECT campaign_id, advertiser_id, CAST(event_timestamp AS DATE) AS event_date,
         count(*) AS impressions,
         CAST(sum(CASE WHEN viewable THEN 1 ELSE 0 END) AS BIGINT) AS viewable_impressions
  FROM {typed} WHERE event_type = 'impression' GROUP BY 1, 2, 3),
{name}_clk AS (
  SELECT campaign_id, CAST(event_timestamp AS DATE) AS event_date, count(*) AS clicks
  FROM {typed} WHERE event_type = 'click' GROUP BY 1, 2),
{name}_conv AS (
  SELECT campaign_id, CAST(event_timestamp AS DATE) AS event_date, count(*) AS conversions,
         {MONEY_SUM.format("revenue")} AS revenue, CAST(sum(quantity) AS BIGINT) AS items_sold
  FROM {typed} WHERE event_type = 'conversion' GROUP BY 1, 2),
{name}_base AS (
  SELECT i.event_date, i.campaign_id, i.advertiser_id, i.impressions, i.viewable_impressions,
         coalesce(c.clicks, 0) AS clicks, coalesce(v.conversions, 0) AS conversions,
         coalesce(v.revenue, 0) AS revenue, coalesce(v.items_sold, 0) AS items_sold
  FROM {name}_imp i
  LEFT JOIN {name}_clk c ON i.campaign_id = c.campaign_id AND i.event_date = c.event_date
  LEFT JOIN {name}_conv v ON i.campaign_id = v.campaign_id AND i.event_date = v.event_date),
{name}_kpi AS (
  SELECT *,
         {rnd("clicks / impressions", 4)} AS ctr,
         {rnd("conversions / CASE WHEN clicks > 0 THEN clicks ELSE 1 END", 4)} AS cvr,
         {spend} AS spend
  FROM {name}_base),
{name} AS (
  SELECT {", ".join(METRICS_OUT[:-1])},
         {rnd("revenue / CASE WHEN spend > 0 THEN spend ELSE 1 END", 2)} AS roas
  FROM {name}_kpi)"""


CHAIN = f"""
WITH
ev AS (
  SELECT event_id AS eid, user_id AS uid, ts, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion'
              ELSE event_type END AS event_type
  FROM events),
linked AS (
  SELECT *,
    last_value(CASE WHEN event_type = 'impression' THEN 'e_' || eid END IGNORE NULLS) OVER w AS impression_id,
    last_value(CASE WHEN event_type = 'click' THEN 'e_' || eid END IGNORE NULLS) OVER w AS click_id
  FROM ev
  WINDOW w AS (PARTITION BY uid ORDER BY ts, eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
mapped AS (
  SELECT eid, uid, ts,
    'e_' || eid AS event_id,
    event_type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_timestamp,
    'camp_' || k AS campaign_id,
    'ad_' || (eid % 50) AS ad_id,
    'adv_' || (k % 20) AS advertiser_id,
    'pub_' || (uid % 3) AS publisher_id,
    sha256(CAST(uid AS VARCHAR)) AS user_id_hashed,
    's_' || uid || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
    CASE uid % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CASE uid % 2 WHEN 0 THEN 'app' ELSE 'web' END AS channel,
    'place_' || (eid % 5) AS placement,
    value / 10 AS viewable_seconds,
    value / 10 >= 1.0 AS viewable,
    impression_id,
    click_id,
    'ord_' || eid AS order_id,
    'prod_' || (k % 24) AS product_id,
    'cat_' || (k % 8) AS product_category,
    value AS revenue,
    CAST(1 + k % 5 AS INTEGER) AS quantity,
    CASE k % 3 WHEN 0 THEN 'last_click' WHEN 1 THEN 'linear' ELSE 'time_decay' END AS attribution_model
  FROM linked),
records AS (
  SELECT event_id AS event_key,
    CAST({_PAYLOAD} AS VARCHAR) AS payload,
    'ad-events' AS topic,
    CAST(eid % 4 AS INTEGER) AS "partition",
    CAST(eid * 2 + c.copy AS BIGINT) AS "offset",
    ts AS "timestamp",
    CAST(0 AS INTEGER) AS timestampType
  FROM mapped CROSS JOIN (VALUES (0), (1)) AS c(copy)
  WHERE c.copy = 0 OR eid % 100 = 0),
raw AS (
  SELECT payload AS raw_payload, topic AS eh_topic, "partition" AS eh_partition,
    "offset" AS eh_offset, "timestamp" AS eh_enqueued_time,
    {_js("event_type", "payload")} AS event_type,
    {_js("event_timestamp", "payload")} AS event_timestamp,
    {_js("campaign_id", "payload")} AS campaign_id,
    try_cast({_js("event_timestamp", "payload")} AS DATE) AS event_date
  FROM records),
parsed AS (
  SELECT r.event_type AS routed_type,
    {", ".join(_parsed_column(c) for c in TYPED_OUT)},
    r.eh_partition, r.eh_offset
  FROM raw r WHERE r.event_type IN ('impression', 'click', 'conversion')),
typed AS (
  SELECT {", ".join(TYPED_OUT)} FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY eh_partition, eh_offset) AS rn
    FROM parsed WHERE event_id IS NOT NULL)
  WHERE rn = 1),
quarantined AS (
  SELECT {", ".join(RAW_OUT)}, reason FROM (
    SELECT *,
      CASE WHEN event_type IS NULL OR event_type NOT IN ('impression', 'click', 'conversion')
             THEN 'unknown_event_type'
           WHEN {_js("event_id")} IS NULL THEN 'missing_event_id' END AS reason
    FROM raw)
  WHERE reason IS NOT NULL),
{_metrics_cte("metrics", "typed", exact=False)},
{_metrics_cte("metrics_exact", "typed", exact=True)},
activity AS (
  SELECT campaign_id, CAST(event_timestamp AS DATE) AS event_date,
    count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'conversion') AS conversions,
    CAST(sum(CAST(revenue AS DECIMAL(38,10))) FILTER (WHERE event_type = 'conversion') AS DOUBLE) AS revenue
  FROM typed WHERE event_type IN ('click', 'conversion') GROUP BY 1, 2),
imp_ids AS (
  SELECT DISTINCT event_id FROM typed WHERE event_type = 'impression' AND event_id IS NOT NULL),
click_ids AS (
  SELECT DISTINCT event_id FROM typed WHERE event_type = 'click' AND event_id IS NOT NULL),
funnel_parts AS (
  SELECT campaign_id, count(*) AS impressions, NULL::BIGINT AS clicks, NULL::BIGINT AS linked_clicks,
         NULL::BIGINT AS conversions, NULL::BIGINT AS linked_conversions, NULL::DECIMAL(38,10) AS linked_revenue
  FROM typed WHERE event_type = 'impression' GROUP BY 1
  UNION ALL
  SELECT c.campaign_id, NULL, c.n, CASE WHEN i.event_id IS NOT NULL THEN c.n ELSE 0 END, NULL, NULL, NULL
  FROM (SELECT campaign_id, impression_id, count(*) AS n FROM typed WHERE event_type = 'click' GROUP BY 1, 2) c
  LEFT JOIN imp_ids i ON c.impression_id = i.event_id
  UNION ALL
  SELECT v.campaign_id, NULL, NULL, NULL, v.n, CASE WHEN k.event_id IS NOT NULL THEN v.n ELSE 0 END,
         CASE WHEN k.event_id IS NOT NULL THEN v.rev END
  FROM (SELECT campaign_id, click_id, count(*) AS n, sum(CAST(revenue AS DECIMAL(38,10))) AS rev
        FROM typed WHERE event_type = 'conversion' GROUP BY 1, 2) v
  LEFT JOIN click_ids k ON v.click_id = k.event_id)
"""


def _q(body: str) -> str:
    return CHAIN + body


def _cols(cols: list[str]) -> str:
    return ", ".join(cols)


def _typed_type(event_type: str) -> str:
    return _q(f"SELECT {_cols(TYPE_COLUMNS[event_type])} FROM parsed WHERE routed_type = '{event_type}'")


_METRICS_SELECT = f"SELECT {_cols(METRICS_OUT)} FROM metrics"
_RANKING = " ORDER BY roas DESC NULLS LAST, event_date, campaign_id, advertiser_id"

ORACLE_SQL: dict[str, str] = {
    "encoded_events": _q(
        'SELECT event_key, payload, topic, "partition", "offset", "timestamp", timestampType FROM records'
    ),
    "raw_projection": _q(f"SELECT {_cols(RAW_OUT)} FROM raw"),
    "stream_progress": _q(
        "SELECT 'raw' AS layer, CAST(count(*) AS BIGINT) AS num_input_rows FROM records "
        "UNION ALL SELECT 'typed', CAST(count(*) AS BIGINT) FROM raw "
        "WHERE event_type IN ('impression', 'click', 'conversion')"  # the others are pruned
    ),
    "raw_profile": _q('SELECT event_type, event_date, count(*) AS "count" FROM raw GROUP BY 1, 2 ORDER BY 2, 1'),
    "raw_sample": _q(f"SELECT {_cols(RAW_OUT)} FROM raw ORDER BY eh_partition, eh_offset LIMIT 20"),
    "typed_impressions": _typed_type("impression"),
    "typed_clicks": _typed_type("click"),
    "typed_conversions": _typed_type("conversion"),
    "typed_union": _q(f"SELECT {_cols(TYPED_OUT)} FROM parsed"),
    "typed_union_single_pass": _q(f"SELECT {_cols(TYPED_OUT)} FROM parsed"),
    "typed_dedup": _q(f"SELECT {_cols(TYPED_OUT)} FROM typed"),
    "typed_dedup_single_pass": _q(f"SELECT {_cols(TYPED_OUT)} FROM typed"),
    "typed_profile": _q(
        "SELECT event_type, count(*) AS total, count(DISTINCT event_id) AS distinct_events, "
        "count(DISTINCT campaign_id) AS campaigns, count(DISTINCT user_id_hashed) AS users "
        "FROM typed GROUP BY 1"
    ),
    "typed_conversion_sample": _q(
        f"SELECT {_cols(TYPED_OUT)} FROM typed WHERE event_type = 'conversion' ORDER BY event_id LIMIT 10"
    ),
    "type_counts": _q("SELECT event_type, count(*) AS events FROM typed GROUP BY 1"),
    "quarantine": _q(f"SELECT {_cols(RAW_OUT)}, reason FROM quarantined"),
    "layer_counts": _q(
        "SELECT 'raw' AS layer, count(*) AS \"rows\" FROM raw "
        "UNION ALL SELECT 'typed', count(*) FROM typed "
        "UNION ALL SELECT 'quarantine', count(*) FROM quarantined "
        "UNION ALL SELECT 'duplicates', CAST(count(event_id) - count(DISTINCT event_id) AS BIGINT) FROM parsed"
    ),
    "impressions_by_campaign": _q("SELECT * FROM metrics_imp"),
    "clicks_by_campaign": _q("SELECT * FROM metrics_clk"),
    "conversions_by_campaign": _q("SELECT * FROM metrics_conv"),
    "campaign_metrics": _q(_METRICS_SELECT + " ORDER BY event_date, campaign_id"),
    "campaign_metrics_exact": _q(f"SELECT {_cols(METRICS_OUT)} FROM metrics_exact"),
    "campaign_metrics_single_pass": _q(_METRICS_SELECT),
    "campaign_roas_ranking": _q(_METRICS_SELECT + _RANKING),
    "campaign_roas_top10": _q(_METRICS_SELECT + _RANKING + " LIMIT 10"),
    "unmatched_activity": _q(
        "SELECT a.event_date, a.campaign_id, a.clicks, a.conversions, a.revenue FROM activity a "
        "WHERE NOT EXISTS (SELECT 1 FROM metrics_imp i "
        "WHERE i.campaign_id = a.campaign_id AND i.event_date = a.event_date)"
    ),
    "pseudonymized_users": _q(
        "SELECT user_id, sha256(CAST(user_id AS VARCHAR)) AS user_id_hashed, count(*) AS events "
        "FROM events GROUP BY user_id"
    ),
    "user_activity": _q(
        "SELECT user_id_hashed, count(*) FILTER (WHERE event_type = 'impression') AS impressions, "
        "count(*) FILTER (WHERE event_type = 'click') AS clicks, "
        "count(*) FILTER (WHERE event_type = 'conversion') AS conversions FROM typed GROUP BY 1"
    ),
    "viewability_check": _q(
        "SELECT campaign_id, count(*) AS impressions, count(*) FILTER (WHERE viewable) AS viewable_flagged, "
        "count(*) FILTER (WHERE viewable_seconds >= 1.0) AS viewable_by_seconds, "
        "count(*) FILTER (WHERE viewable IS DISTINCT FROM (viewable_seconds >= 1.0)) AS mismatches "
        "FROM typed WHERE event_type = 'impression' GROUP BY 1"
    ),
    "line_revenue": _q(
        "SELECT event_id, campaign_id, product_id, quantity, revenue, unit_price, line_revenue, "
        "line_revenue = revenue_2 AS revenue_matches FROM ("
        "SELECT *, " + sround("unit_price * quantity", 2) + " AS line_revenue FROM ("
        "SELECT event_id, campaign_id, product_id, quantity, revenue, "
        + sround("revenue / quantity", 2) + " AS unit_price, "
        + sround("revenue", 2) + " AS revenue_2 FROM typed WHERE event_type = 'conversion'))"
    ),
    "attribution_credit": _q(
        "SELECT m AS attribution_model, campaign_id, CAST(count(DISTINCT event_id) AS BIGINT) AS conversions, "
        "CAST(count(tid) AS BIGINT) AS touches, CAST(coalesce(sum(credit), 0) AS BIGINT) AS credit_cents FROM ("
        "SELECT c.event_id, c.m, p.campaign_id, p.tid, CASE WHEN p.tid IS NULL THEN c.cents ELSE "
        "whole + CASE WHEN place <= c.cents - sum(whole) OVER (PARTITION BY c.event_id) THEN 1 ELSE 0 END END AS credit "
        "FROM (" + _CONVERSION_CENTS + ") c LEFT JOIN ("
        "SELECT *, cents * w // sum(w) OVER g AS whole, "
        "row_number() OVER (PARTITION BY event_id ORDER BY cents * w % total DESC, back) AS place FROM ("
        "SELECT *, sum(w) OVER (PARTITION BY event_id) AS total FROM ("
        "SELECT *, CASE m WHEN 'last_click' THEN CAST(back = 1 AS BIGINT) WHEN 'linear' THEN 1 "
        "ELSE CAST(1 AS BIGINT) << (7 - CAST(floor(epoch(ts - tts) / 86400) AS INTEGER)) END AS w FROM ("
        "SELECT c.*, t.event_id AS tid, t.campaign_id, t.event_timestamp AS tts, "
        "row_number() OVER (PARTITION BY c.event_id ORDER BY t.event_timestamp DESC, t.event_id DESC) AS back "
        "FROM (" + _CONVERSION_CENTS + ") c JOIN typed t ON t.event_type = 'click' AND t.user_id_hashed = c.u "
        "AND t.event_timestamp <= c.ts AND t.event_timestamp >= c.ts - INTERVAL 7 DAY) WHERE back <= 20)) "
        "WINDOW g AS (PARTITION BY event_id)) p ON p.event_id = c.event_id) GROUP BY 1, 2"
    ),
    "funnel_linkage": _q(
        "SELECT campaign_id, CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions, "
        "CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks, "
        "CAST(coalesce(sum(linked_clicks), 0) AS BIGINT) AS linked_clicks, "
        "CAST(coalesce(sum(conversions), 0) AS BIGINT) AS conversions, "
        "CAST(coalesce(sum(linked_conversions), 0) AS BIGINT) AS linked_conversions, "
        "coalesce(CAST(sum(linked_revenue) AS DOUBLE), 0.0::DOUBLE) AS linked_revenue FROM funnel_parts GROUP BY 1"
    ),
    "stream_linkage": _q(
        "SELECT campaign_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, "
        "count(*) FILTER (WHERE event_type = 'click' AND linked) AS linked_clicks, "
        "count(*) FILTER (WHERE event_type = 'conversion') AS conversions, "
        "count(*) FILTER (WHERE event_type = 'conversion' AND linked) AS linked_conversions FROM ("
        "SELECT c.campaign_id, c.event_type, EXISTS (SELECT 1 FROM typed p "
        "WHERE p.event_id = CASE c.event_type WHEN 'click' THEN c.impression_id ELSE c.click_id END "
        "AND p.event_type = CASE c.event_type WHEN 'click' THEN 'impression' ELSE 'click' END "
        "AND c.event_timestamp >= p.event_timestamp "
        "AND c.event_timestamp <= p.event_timestamp + INTERVAL 1 DAY) AS linked "
        "FROM typed c WHERE c.event_type IN ('click', 'conversion')) GROUP BY 1"
    ),
    "funnel_orphans": _q(
        "SELECT event_id, event_type, campaign_id, 'impression' AS ref_type, impression_id AS ref_id, "
        "CASE WHEN impression_id IS NULL THEN 'missing_ref' ELSE 'dangling_ref' END AS reason "
        "FROM typed t WHERE event_type = 'click' "
        "AND NOT EXISTS (SELECT 1 FROM imp_ids i WHERE i.event_id = t.impression_id) "
        "UNION ALL "
        "SELECT event_id, event_type, campaign_id, 'click', click_id, "
        "CASE WHEN click_id IS NULL THEN 'missing_ref' ELSE 'dangling_ref' END "
        "FROM typed t WHERE event_type = 'conversion' "
        "AND NOT EXISTS (SELECT 1 FROM click_ids k WHERE k.event_id = t.click_id)"
    ),
    "funnel_rates": _q(
        "SELECT campaign_id, impressions, clicks, conversions, "
        + sround("CASE WHEN impressions = 0 THEN NULL ELSE clicks / impressions END", 4) + " AS ctr, "
        + sround("CASE WHEN clicks = 0 THEN NULL ELSE conversions / clicks END", 4) + " AS cvr, "
        "CAST(0.02 AS DOUBLE) AS expected_ctr, CAST(0.05 AS DOUBLE) AS expected_cvr FROM ("
        "SELECT campaign_id, count(*) FILTER (WHERE event_type = 'impression') AS impressions, "
        "count(*) FILTER (WHERE event_type = 'click') AS clicks, "
        "count(*) FILTER (WHERE event_type = 'conversion') AS conversions FROM typed GROUP BY 1)"
    ),
    "campaign_lookup": _q(
        "SELECT campaign_id, min(advertiser_id) AS advertiser_id, count(DISTINCT advertiser_id) AS advertisers, "
        "min(CAST(event_timestamp AS DATE)) AS first_day, max(CAST(event_timestamp AS DATE)) AS last_day, "
        "count(*) AS events FROM typed GROUP BY 1"
    ),
    "campaign_metrics_enriched": _q(
        f"SELECT {_cols(['m.' + c for c in METRICS_OUT])}, d.campaign_advertisers, d.campaign_first_day, "
        "d.campaign_last_day FROM metrics m LEFT JOIN ("
        "SELECT campaign_id, count(DISTINCT advertiser_id) AS campaign_advertisers, "
        "min(CAST(event_timestamp AS DATE)) AS campaign_first_day, "
        "max(CAST(event_timestamp AS DATE)) AS campaign_last_day FROM typed GROUP BY 1) d "
        "ON m.campaign_id = d.campaign_id"
    ),
    "advertiser_conflicts": _q(
        "SELECT campaign_id, CAST(event_timestamp AS DATE) AS event_date, "
        "count(DISTINCT advertiser_id) AS advertisers, count(*) AS impressions "
        "FROM typed WHERE event_type = 'impression' GROUP BY 1, 2 HAVING count(DISTINCT advertiser_id) > 1"
    ),
    "freshness": _q(
        "SELECT event_type, records, last_enqueued, " + sround("staleness", 3) + " AS staleness_minutes, "
        "staleness <= 30 AS within_sla FROM ("
        "SELECT event_type, count(*) AS records, max(eh_enqueued_time) AS last_enqueued, "
        "(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(eh_enqueued_time))) / 60000000 AS staleness "
        "FROM raw GROUP BY 1)"
    ),
    "layer_freshness": _q(
        'SELECT layer, "rows", newest_event, ' + sround("staleness", 3) + " AS staleness_minutes, "
        "staleness <= 30 AS within_sla FROM (SELECT *, "
        "(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(newest_event)) / 60000000 AS staleness FROM ("
        "SELECT 'raw' AS layer, count(*) AS \"rows\", "
        "max(timezone('UTC', try_cast(event_timestamp AS TIMESTAMPTZ))) AS newest_event FROM raw "
        "UNION ALL SELECT 'typed', count(*), max(event_timestamp) FROM typed "
        "UNION ALL SELECT 'metrics', count(*), max(CAST(event_date AS TIMESTAMP)) FROM metrics))"
    ),
}
ORACLE_SQL["stream_raw"] = ORACLE_SQL["raw_projection"]
ORACLE_SQL["stream_typed"] = ORACLE_SQL["typed_dedup"]
ORACLE_SQL["stream_typed_replays"] = ORACLE_SQL["typed_dedup"]
ORACLE_SQL["stream_metrics"] = ORACLE_SQL["campaign_metrics"]
ORACLE_SQL["stream_metrics_incremental"] = ORACLE_SQL["campaign_metrics"]
ORACLE_SQL["stream_metrics_two_drains"] = ORACLE_SQL["campaign_metrics"]
ORACLE_SQL["stream_metrics_deltas"] = ORACLE_SQL["campaign_metrics"]
