"""All registered queries. Importing a query module registers its queries."""

from __future__ import annotations

from candlewick.plans import (  # noqa: F401
    queries_bars,
    queries_files,
    queries_indicators,
    queries_quotes,
    queries_reports,
    queries_watchlist,
)
from candlewick.plans.catalog import ENTRIES

__all__ = ["ENTRIES"]
