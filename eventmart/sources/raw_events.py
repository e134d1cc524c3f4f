"""The raw table, and the adapter that derives it from the generic ``events`` parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW, RAW_COLUMNS
from .tables import finish_replacement


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the stored raw table; filters on event_date prune its folders."""
    finish_replacement(spark, path)
    return spark.read.schema(RAW).parquet(path).select(*RAW_COLUMNS)


#: The instant of ``ts`` read as UTC; a cast would read it in the session's zone.
_INSTANT = """timestamp_micros(unix_date(date(ts)) * 86400000000L + hour(ts) * 3600000000L
    + minute(ts) * 60000000L + bigint(extract(SECOND FROM ts) * 1000000))"""

#: Raw column -> expression over the generic event, its number ``k`` and its ``repo`` (or NULL).
_RAW_FROM_EVENTS = {
    "event_id": "string(event_id)",
    "event_type": """
        CASE event_type
          WHEN 'click' THEN 'PushEvent'
          WHEN 'view' THEN 'WatchEvent'
          WHEN 'error' THEN 'IssuesEvent'
          WHEN 'purchase' THEN 'PullRequestEvent'
          ELSE element_at(
            array('ForkEvent', 'CreateEvent', 'IssueCommentEvent', 'DeleteEvent', 'ReleaseEvent'),
            int(k % 5) + 1)
        END""",
    "created_at": _INSTANT,
    "event_date": "date(ts)",
    "actor_id": "string(user_id)",
    "actor_login": """
        CASE
          WHEN event_id % 997 = 0 THEN NULL
          WHEN user_id % 15 = 0 THEN 'app' || user_id || '[bot]'
          WHEN user_id % 15 = 1 THEN 'Dependabot-' || user_id
          ELSE 'dev' || user_id
        END""",
    "repo_id": "string(repo)",
    "repo_name": "'owner' || repo % 40 || '/repo' || repo",
    "org_id": "CASE WHEN repo % 40 < 15 THEN string(1000 + repo % 40) END",
    "org_login": "CASE WHEN repo % 40 < 15 THEN 'owner' || repo % 40 END",
    "is_public": "k % 7 <> 0",
    "payload": "props",
    "source_file": "string(date(ts)) || '-' || hour(ts) || '.json.gz'",
    "ingested_at": f"{_INSTANT} + INTERVAL 2 HOURS",
    "updated_at": f"{_INSTANT} + INTERVAL 2 HOURS",
}


def raw_from_events(events: DataFrame) -> DataFrame:
    """Map (event_id, ts, user_id, event_type, value, props) onto the raw schema, row by row.

    Projections only: date filters above them reach the parquet scan as filters on ``ts``.
    """
    return (
        events.selectExpr("*", "try_cast(regexp_extract(props, '[0-9]+', 0) AS bigint) AS k")
        .selectExpr("*", "CASE WHEN event_id % 101 <> 0 THEN (user_id * 7 + k) % 400 END AS repo")
        .selectExpr(*[f"{expression} AS {name}" for name, expression in _RAW_FROM_EVENTS.items()])
    )
