"""Column expressions: JVM built-ins only, so they stay inside whole-stage codegen."""

from .calendar import as_of_date, as_of_timestamp, day_name, time_parts, utc_date, utc_floor, utc_hour
from .measures import bucket, distinct_hours, percent, ratio
from .text import contributor_type, is_bot, repo_owner, repo_slug

__all__ = [
    "as_of_date",
    "as_of_timestamp",
    "bucket",
    "contributor_type",
    "day_name",
    "distinct_hours",
    "is_bot",
    "percent",
    "ratio",
    "repo_owner",
    "repo_slug",
    "time_parts",
    "utc_date",
    "utc_floor",
    "utc_hour",
]
