"""Revenue credit of the clicks on the way to a conversion.

A conversion's path is its user's newest ``MAX_TOUCHES`` clicks up to the conversion
and not older than ``LOOKBACK_DAYS``. The conversion's own ``attribution_model`` splits
its revenue over the path: ``last_click`` gives all to the newest, ``linear`` equal
parts, ``time_decay`` parts that halve with each whole day of age. Parts are whole
cents by largest remainder (ties to the newer click), so the credits of a conversion
add up to its revenue exactly. A conversion without a path credits no campaign (NULL).

Scale: events are shuffled once, by a 128-bit digest of their user, with all that a
conversion needs; clicks are numbered per user, and a conversion asks for the numbers of
its path in the same task, so at most ``MAX_TOUCHES`` rows a conversion arise and none of
them is shuffled before the last sum. The few users with more than ``HOT_EVENTS`` events
are no single task: their clicks are numbered from the counts of hours and the place
within an hour, and rows meet by (user, number), spread over all tasks.

Defined results: an unknown or missing model counts as ``last_click``; a revenue that
is missing, not finite or of 1e16 or more has no cents, and its credits are NULL; an
event without a user or time is on no path; a negative revenue is split by its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The models that conversions name.
MODELS = ("last_click", "linear", "time_decay")
LOOKBACK_DAYS = 7
MAX_TOUCHES = 20
HOT_EVENTS = 1_000_000
_DAY = 86400


def _cents(revenue: Column) -> Column:
    return (revenue.try_cast("decimal(18,2)") * 100).cast("long")


def _weight(model: Column, newest: Column, lookback_days: int) -> Column:
    halved = F.expr(f"shiftleft(1L, {lookback_days} - age_days)")
    return F.when(model == "last_click", newest.cast("long")).when(model == "linear", 1).otherwise(halved)


def _events(typed: DataFrame) -> DataFrame:
    """Clicks and conversions on or with a possible path, as narrow rows."""
    of, named = F.col("event_type"), F.col("attribution_model")
    user = F.unhex(F.substring(F.sha2("user_id_hashed", 256), 1, 32))
    placed = F.col("user_id_hashed").isNotNull() & F.col("event_timestamp").isNotNull()
    return typed.where(of.isin("click", "conversion")).select(
        F.when(placed, user).alias("user"),
        F.col("event_timestamp").alias("at"),
        (of == "conversion").cast("int").alias("late"),  # after a click of the same time
        "event_id",
        "campaign_id",
        F.when(of == "conversion", F.when(named.isin(*MODELS), named).otherwise("last_click")).alias("model"),
        F.when(of == "conversion", _cents(F.col("revenue"))).alias("cents"),
    )


def _numbered(events: DataFrame) -> DataFrame:
    """Events with ``no``: the user's clicks up to the event; a user is in one task."""
    up_to = (
        Window.partitionBy("user")
        .orderBy("at", "late", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return events.withColumn("no", F.sum(1 - F.col("late")).over(up_to))


def _numbered_hot(events: DataFrame) -> DataFrame:
    """The same from the counts of hours, without a task that holds a user."""
    events = events.withColumn("hour", F.date_trunc("hour", "at"))
    click = 1 - F.col("late")
    hours = events.groupBy("user", "hour").agg(F.sum(click).alias("clicks"))
    earlier = Window.partitionBy("user").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select("user", "hour", F.coalesce(F.sum("clicks").over(earlier), F.lit(0)).alias("before"))
    within = (
        Window.partitionBy("user", "hour")
        .orderBy("at", "late", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = events.withColumn("within", F.sum(click).over(within)).join(hours, ["user", "hour"])
    return placed.withColumn("no", F.col("before") + F.col("within")).drop("hour", "before", "within")


def _touches(numbered: DataFrame, lookback_days: int, max_touches: int) -> DataFrame:
    """Per conversion its path, or one row without a click: user, event_id, model, cents,
    no, click_id, campaign_id, age_days."""
    no, late = F.col("no"), F.col("late") == 1
    asked = F.sequence(F.greatest(F.lit(1).cast("long"), no - max_touches + 1), no)
    alone = F.array(-F.pmod(F.xxhash64("event_id"), F.lit(1024)))  # no click has these numbers
    wanted = F.when(~late, F.array(no)).when(no > 0, asked).otherwise(alone)
    click = F.when(~late, F.struct(F.col("at").alias("clicked"), F.col("event_id").alias("id"), "campaign_id"))
    rows = numbered.select("user", "event_id", "at", "late", "model", "cents", click.alias("own"), F.explode(wanted).alias("no"))
    rows = rows.withColumn("click", F.max("own").over(Window.partitionBy("user", "no"))).where(late)
    age = F.unix_micros("at") - F.unix_micros("click.clicked")
    day = _DAY * 1_000_000
    rows = rows.withColumn("age", F.when(age <= lookback_days * day, age))
    path = Window.partitionBy("user", "event_id")
    # the newest row stays where no click is young enough
    rows = rows.withColumns({"young": F.count("age").over(path), "newest": F.max("no").over(path)})
    rows = rows.where((F.col("age").isNotNull()) | ((F.col("young") == 0) & (F.col("no") == F.col("newest"))))
    here = F.col("age").isNotNull()
    return rows.select(
        "user", "event_id", "model", "cents", "no",
        F.when(here, F.col("click.id")).alias("click_id"),
        F.when(here, F.col("click.campaign_id")).alias("campaign_id"),
        F.floor(F.col("age") / day).cast("int").alias("age_days"),
    )


def _parts(typed: DataFrame, lookback_days: int, max_touches: int, hot_events: int) -> list[DataFrame]:
    """The rows of :func:`_touches`: of most users, of hot ones, and of conversions without user or time."""
    events = _events(typed)
    known = events.where("user IS NOT NULL")
    lot = F.xxhash64("user")  # two users with one lot are both hot, which changes no result
    many = known.groupBy(lot.alias("lot")).count().where(F.col("count") > hot_events).select("lot")
    most = known.join(F.broadcast(many), lot == F.col("lot"), "left_anti")
    hot = known.join(F.broadcast(many), lot == F.col("lot"), "left_semi")
    null = F.lit(None)
    lost = events.where("user IS NULL AND late = 1").select(
        "user", "event_id", "model", "cents", null.cast("long").alias("no"), null.cast("string").alias("click_id"),
        null.cast("string").alias("campaign_id"), null.cast("int").alias("age_days"),
    )
    found = [_touches(rows, lookback_days, max_touches) for rows in (_numbered(most), _numbered_hot(hot))]
    return [*found, lost]


def touch_paths(
    typed: DataFrame,
    lookback_days: int = LOOKBACK_DAYS,
    max_touches: int = MAX_TOUCHES,
    hot_events: int = HOT_EVENTS,
) -> DataFrame:
    """event_id of a conversion, and click_id, campaign_id, no, age_days of each click of its path."""
    most, hot, _ = _parts(typed, lookback_days, max_touches, hot_events)
    paths = most.unionByName(hot).where("click_id IS NOT NULL")
    return paths.select("event_id", "click_id", "campaign_id", "no", "age_days")


def _credits(rows: DataFrame, lookback_days: int) -> DataFrame:
    """The touches with their ``credit_cents``."""
    path = Window.partitionBy("user", "event_id")
    newest = F.col("no") == F.max("no").over(path)
    rows = rows.withColumn("weight", _weight(F.col("model"), newest, lookback_days))
    size = F.abs("cents").cast("decimal(20,0)") * F.col("weight").cast("decimal(11,0)")
    rows = rows.withColumn("share", size).withColumn("all", F.sum("weight").over(path).cast("decimal(18,0)"))
    rows = rows.withColumns(
        {"whole": F.expr("share div all"), "rest": F.col("share") % F.col("all")}
    )
    place = F.row_number().over(path.orderBy(F.desc("rest"), F.desc("no")))
    left = F.abs("cents") - F.sum("whole").over(path)
    part = F.col("whole") + (place <= left).cast("long")
    credit = F.when(F.col("click_id").isNull(), F.col("cents")).otherwise(F.signum("cents").cast("long") * part)
    return rows.withColumn("credit_cents", credit)


def _credit_parts(
    typed: DataFrame, lookback_days: int, max_touches: int, hot_events: int
) -> list[DataFrame]:
    if not 0 < lookback_days <= 31:
        raise ValueError("lookback_days is 1 to 31: weights double with each day")
    most, hot, lost = _parts(typed, lookback_days, max_touches, hot_events)
    names = ["user", "event_id", F.col("model").alias("attribution_model"), "click_id", "campaign_id", "credit_cents"]
    found = [_credits(most, lookback_days), _credits(hot, lookback_days), lost.withColumn("credit_cents", F.col("cents"))]
    return [rows.select(*names) for rows in found]


def attribution_credits(
    typed: DataFrame,
    lookback_days: int = LOOKBACK_DAYS,
    max_touches: int = MAX_TOUCHES,
    hot_events: int = HOT_EVENTS,
) -> DataFrame:
    """A row per conversion and click of its path (or one without): event_id,
    attribution_model, click_id, campaign_id, credit_cents."""
    parts = _credit_parts(typed, lookback_days, max_touches, hot_events)
    return reduce(DataFrame.unionByName, parts).drop("user")


def attribution_by_campaign(
    typed: DataFrame,
    lookback_days: int = LOOKBACK_DAYS,
    max_touches: int = MAX_TOUCHES,
    hot_events: int = HOT_EVENTS,
) -> DataFrame:
    """Per model and campaign: conversions, touches and credited cents."""
    key = ["attribution_model", "campaign_id"]
    each = []
    for rows in _credit_parts(typed, lookback_days, max_touches, hot_events):
        # a conversion's rows are in one task by now
        one = rows.groupBy("user", "event_id", *key).agg(
            F.count("click_id").alias("touches"), F.sum("credit_cents").alias("cents")
        )
        each.append(one.select(*key, "touches", "cents"))
    return reduce(DataFrame.unionByName, each).groupBy(*key).agg(
        F.count("*").alias("conversions"),
        F.sum("touches").alias("touches"),
        F.coalesce(F.sum("cents"), F.lit(0)).cast("long").alias("credit_cents"),
    )
