"""Publication-time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_published(text: Column, iso: bool = False) -> Column:
    """Timestamp of a feed date such as ``Mon, 31 Aug 2026 09:45:00 GMT``.

    The weekday is required but not interpreted, zone names and numeric offsets
    are both read, anything else is null. With ``iso`` a
    ``2026-08-31T09:45:00Z`` form is read as well.
    """
    rest = F.regexp_extract(text, r"^[A-Za-z]{3}, (.*)$", 1)
    candidates = [
        F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss xx")),
    ]
    if iso:
        candidates.append(
            F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        )
    return F.coalesce(*candidates)
