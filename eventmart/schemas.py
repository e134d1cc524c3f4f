"""Declared schemas and fixed business values; nothing in the package infers a schema."""

from pyspark.sql import types as T

_REF = T.StructType([T.StructField("id", T.StringType()), T.StructField("login", T.StringType())])

#: One line of an hourly event file.  Ids arrive as JSON numbers or strings; both parse as strings.
EVENT_JSON = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", _REF),
        T.StructField(
            "repo",
            T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]),
        ),
        T.StructField("org", _REF),
        T.StructField("payload", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

#: A line as the first of two elements of a list; the second one tells where the line has ended.
EVENT_LINE = T.StructType(
    [
        T.StructField("__line", T.ArrayType(T.StructType([*EVENT_JSON, T.StructField("__end", T.StringType())]))),
        T.StructField("__corrupt", T.StringType()),
    ]
)

#: The flat raw table.  Key: (event_id, event_date).  Stored partitioned by event_date.
RAW = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("event_date", T.DateType(), False),
        T.StructField("actor_id", T.StringType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("repo_id", T.StringType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("org_id", T.StringType()),
        T.StructField("org_login", T.StringType()),
        T.StructField("is_public", T.BooleanType(), False),
        T.StructField("payload", T.StringType()),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
RAW_COLUMNS = RAW.fieldNames()
#: What a file line carries; the two load timestamps are stamped by the upsert.
FLAT_COLUMNS = RAW_COLUMNS[:13]
RAW_KEY = ["event_id", "event_date"]
RAW_REQUIRED = [f.name for f in RAW if not f.nullable]

#: The generic event stream the adapter maps onto the raw table.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

SEED = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("is_code_change", T.BooleanType()),
    ]
)

# They must be exactly these for results to agree.
BOT_PATTERNS = ["[bot]", "dependabot", "github-actions", "renovate", "greenkeeper"]
EXCLUDED_EVENT_TYPES = ["DeleteEvent"]
ACCEPTED_EVENT_TYPES = [
    "PushEvent",
    "CreateEvent",
    "IssuesEvent",
    "IssueCommentEvent",
    "PullRequestEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "WatchEvent",
    "ForkEvent",
    "DeleteEvent",
    "ReleaseEvent",
    "PublicEvent",
    "MemberEvent",
    "CommitCommentEvent",
    "GollumEvent",
    "DiscussionEvent",
]
QUALITY_COLUMNS = ["event_id", "event_type", "created_at", "actor_id", "actor_login"]
INCREMENTAL_FLOOR = "2026-04-12"
ACTIVITY_LEVELS = [(10_000, "very_high"), (1_000, "high"), (100, "medium")]
POPULARITY_TIERS = [(100_000, "viral"), (10_000, "high"), (1_000, "medium")]
REPO_COUNT_BUCKETS = [(100, "100+"), (50, "50-99"), (20, "20-49"), (10, "10-19")]
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Daily mart column -> the event type it counts.
REPOSITORY_TYPE_COLUMNS = {
    "push_events": "PushEvent",
    "pull_request_events": "PullRequestEvent",
    "issue_events": "IssuesEvent",
    "issue_comment_events": "IssueCommentEvent",
    "watch_events": "WatchEvent",
    "fork_events": "ForkEvent",
}
ACTOR_TYPE_COLUMNS = {k: v for k, v in REPOSITORY_TYPE_COLUMNS.items() if k != "fork_events"}
TREND_EVENT_TYPES = [
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "ForkEvent",
    "CreateEvent",
]
HOURLY_EVENT_TYPES = ["PushEvent", "PullRequestEvent", "IssuesEvent"]
