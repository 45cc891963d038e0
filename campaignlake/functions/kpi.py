"""Campaign KPI formulas.

Formulas of the metrics layer: ``round`` HALF_UP, spend from
the rounded product, ROAS over the rounded spend and over 1 when there was no
spend.

Money sums are taken as ``decimal(38,10)`` and returned as double: a double
sum depends on the order rows meet in, so two runs (or two partitionings) of
the same data could differ in the last bits; the decimal sum cannot.
``double_sums=True`` gives the literal double summation instead.

``exact`` additionally rounds every ratio via ``decimal(28,10)``, so ties
break the same way on any engine regardless of binary representation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: simulated cost per click used for spend and ROAS.
DEFAULT_CPC = 0.50

#: Wide enough for every cent and fraction of a cent below 1e28.
MONEY = "decimal(38,10)"
RATIO = "decimal(28,10)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nonzero_or_one(c: Column) -> Column:
    return F.when(c > 0, c).otherwise(F.lit(1))


def ctr(clicks="clicks", impressions="impressions", exact: bool = False) -> Column:
    ratio = _c(clicks) / _c(impressions)
    return _round(ratio, 4, exact)


def cvr(conversions="conversions", clicks="clicks", exact: bool = False) -> Column:
    ratio = _c(conversions) / _nonzero_or_one(_c(clicks))
    return _round(ratio, 4, exact)


def spend(clicks="clicks", cpc: float = DEFAULT_CPC, exact: bool = False) -> Column:
    if exact:
        value = _c(clicks).cast("decimal(20,0)") * F.lit(cpc).cast("decimal(10,4)")
        return F.round(value, 2).cast("double")
    return F.round(_c(clicks) * F.lit(cpc), 2)


def roas(revenue="revenue", spend_col="spend", exact: bool = False) -> Column:
    ratio = _c(revenue) / _nonzero_or_one(_c(spend_col))
    return _round(ratio, 2, exact)


def exact_money_sum(c: str | Column) -> Column:
    """Sum in ``MONEY``; the sum of the doubles where a value has no such form.

    NaN, infinities and values of 1e28 or more can't be summed in decimal; a
    group with one of them, or whose sum doesn't fit, gets its double sum, so no value
    is left out and none fails the job.
    """
    value = _c(c)
    form = value.try_cast(MONEY)
    odd = F.count_if(value.isNotNull() & form.isNull())
    exact = F.try_sum(form)
    unfit = (odd > 0) | (exact.isNull() & (F.count(form) > 0))
    return F.when(unfit, F.sum(value)).otherwise(exact.cast("double"))


def money_sum(c: str | Column, double_sums: bool = False) -> Column:
    """Sum of a money column as double: of its exact values, which doesn't depend on
    the order of rows, or with ``double_sums`` of the doubles as they come."""
    return F.sum(_c(c)) if double_sums else exact_money_sum(c)


def _round(ratio: Column, digits: int, exact: bool) -> Column:
    rounded = F.round(ratio, digits)
    if exact:  # a ratio that the decimal can't hold keeps its double form
        return F.coalesce(F.round(ratio.cast("double").try_cast(RATIO), digits).cast("double"), rounded)
    return rounded


def kpi_columns(cpc: float = DEFAULT_CPC, exact: bool = False) -> dict[str, Column]:
    """The derived metric columns, in the order they must be computed."""
    return {
        "ctr": ctr(exact=exact),
        "cvr": cvr(exact=exact),
        "spend": spend(cpc=cpc, exact=exact),
    }


def with_kpis(df, cpc: float = DEFAULT_CPC, exact: bool = False):
    """Add ctr, cvr, spend, roas (roas reads the rounded spend)."""
    return df.withColumns(kpi_columns(cpc, exact)).withColumn("roas", roas(exact=exact))
