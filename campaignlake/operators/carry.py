"""Carry the last earlier non-null value forward within a key, skew-safely.

The plain form is one window per key::

    last(v, ignorenulls) OVER (PARTITION BY key ORDER BY ts, tb
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)

which puts every row of a key in one task: a key holding a third of the data
becomes a third of the job in a single sort.  Here the key is split into time
buckets instead:

1. inside each (key, bucket) the window above runs on a small slice;
2. each (key, bucket) is summarised by its last non-null value: a partial
   aggregate over a second read of the input (only the key, order and value
   columns), combined map-side before the shuffle;
3. those summaries, at most one row per (key, bucket), are scanned per key to
   get the value carried into each bucket;
4. rows take the in-bucket value, else the carried one.

Step 4 joins on (key, bucket), the same hash partitioning step 1 already
produced, so the large side is shuffled once.  With ``hot_rows`` only keys of more
rows than that (and the NULL key) go this way: they are few, so a broadcast list
tells them apart, and all other rows are shuffled once, by key, for the plain window.  The bucket must not decrease
as the order increases (e.g. ``date_trunc`` of the leading timestamp).
Rows whose key is NULL only see earlier rows of their own bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_prior_values(
    df: DataFrame,
    key: str,
    order: list[str],
    values: dict[str, Column],
    bucket: Column,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add one column per ``values`` entry: the entry's last non-null value
    over the earlier rows (strictly before, by ``order``) of the same key."""
    if hot_rows:
        many = F.broadcast(df.groupBy(key).count().where(F.col("count") > hot_rows).select(key))
        hot = df.join(many, key, "left_semi").unionByName(df.where(F.col(key).isNull()))
        earlier = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        plain = df.where(F.col(key).isNotNull()).join(many, key, "left_anti").repartition(key)
        plain = plain.withColumns({n: F.last(v, ignorenulls=True).over(earlier) for n, v in values.items()})
        out = plain.unionByName(last_prior_values(hot, key, order, values, bucket))
        return out.select(*[c for c in df.columns if c not in values], *values)
    b = "__carry_bucket"
    names = list(values)
    staged = df.withColumn(b, bucket).withColumns({f"__v_{n}": values[n] for n in names})

    in_bucket = Window.partitionBy(key, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.withColumns(
        {f"__l_{n}": F.last(f"__v_{n}", ignorenulls=True).over(in_bucket) for n in names}
    )

    summary = staged.groupBy(key, b).agg(
        *[
            F.max(F.when(F.col(f"__v_{n}").isNotNull(), F.struct(*order, F.col(f"__v_{n}").alias("v"))))
            .getField("v")
            .alias(f"__m_{n}")
            for n in names
        ]
    )
    across = Window.partitionBy(key).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        key, b, *[F.last(f"__m_{n}", ignorenulls=True).over(across).alias(f"__c_{n}") for n in names]
    )

    joined = local.join(carried, [key, b], "left")
    out = joined.withColumns({n: F.coalesce(F.col(f"__l_{n}"), F.col(f"__c_{n}")) for n in names})
    return out.select(*[c for c in df.columns if c not in names], *names)
