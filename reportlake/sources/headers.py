"""What the headers of a report mean. Headers are few: this runs on the driver and shapes one select."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

# Header -> destination column.
KNOWN = {
    "Date": "date",
    "Country": "country",
    "Agency/PMD (af_prt)": "agency",
    "Media Source (pid)": "media_source",
    "Campaign (c)": "campaign",
    "Impressions": "impressions",
    "Clicks": "clicks",
    "CTR": "ctr",
    "Installs": "installs",
    "Conversion Rate": "conversion_rate",
    "Sessions": "sessions",
    "Loyal Users": "loyal_users",
    "Loyal Users/Installs": "loyal_users_rate",
    "Total Revenue": "total_revenue",
    "Total Cost": "total_cost",
    "ROI": "roi",
    "ARPU": "arpu",
    "Average eCPI": "average_ecpi",
    "Campaign Name": "campaign_name",
    "Campaign Id": "campaign_id",
    "Adset Name": "adset",
    "Adset Id": "adset_id",
    "Adgroup Name": "adgroup",
    "Adgroup Id": "adgroup_id",
}
#: Columns that cells are read into.
CELLS = tuple(dict.fromkeys(KNOWN.values()))
# The legs of an event's triple of columns.
USERS, COUNTER, SALES = "event_unique_users", "event_counter", "event_sales"
LEGS = (("Unique users", USERS), ("Event counter", COUNTER), ("Sales in ([A-Z]{3})", SALES))


class Header(NamedTuple):
    kind: str  # "column", "event" or "unknown"
    column: str | None = None
    event: str | None = None
    currency: str | None = None
    exact: bool = True


def read_header(text: str) -> Header:
    """Exact spelling first, then without case; the event's name is everything up to the last leg."""
    name = text.strip()
    folded = {k.casefold(): v for k, v in KNOWN.items()}
    for exact, flags in ((True, 0), (False, re.IGNORECASE)):
        column = KNOWN.get(name) if exact else folded.get(name.casefold())
        if column:
            return Header("column", column, exact=exact)
        for leg, target in LEGS:
            if m := re.fullmatch(rf"(.+) \({leg}\)", name, flags):
                return Header("event", target, m[1], m[2].upper() if target == SALES else None, exact)
    return Header("unknown")


def report_format(headers: Sequence[str]) -> str:
    """``facebook`` if an ad set id is there, in any case, else ``standard``."""
    return "facebook" if any(read_header(h).column == "adset_id" for h in headers) else "standard"


def report_currency(headers: Sequence[Header], hint: str | None) -> tuple[str, list[str]]:
    """The currency of all rows, and warnings: what the sales headers agree on, else the hint, else blank."""
    found = sorted({h.currency for h in headers if h.currency})
    notes = []
    if len(found) > 1:
        notes.append("several sales currencies: " + ", ".join(found))
    only = found[0] if len(found) == 1 else None
    if only and hint and only != hint:
        notes.append(f"the app's currency is {hint}, the headers say {only}")
    return only or hint or "", notes
