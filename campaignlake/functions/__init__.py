"""Column-level functions (JVM built-ins only; no Python UDF on the data path)."""

from campaignlake.functions.kpi import DEFAULT_CPC, ctr, cvr, money_sum, roas, spend, with_kpis
from campaignlake.functions.payload import event_day, payload_string, safe_date
from campaignlake.functions.privacy import pseudonymize

__all__ = [
    "DEFAULT_CPC",
    "ctr",
    "cvr",
    "event_day",
    "money_sum",
    "payload_string",
    "pseudonymize",
    "roas",
    "safe_date",
    "spend",
    "with_kpis",
]
