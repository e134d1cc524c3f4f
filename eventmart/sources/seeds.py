"""The event-category lookup: fifteen fixed rows, so it is always safe to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SEED

# The lookup as loaded by every deployment.
EVENT_CATEGORIES = [
    ("PushEvent", "code", "Push commits to a branch", True),
    ("PullRequestEvent", "collaboration", "Pull request opened/closed/merged", True),
    ("IssuesEvent", "collaboration", "Issue opened/closed/commented", False),
    ("IssueCommentEvent", "collaboration", "Comment on an issue", False),
    ("PullRequestReviewEvent", "collaboration", "Review submitted on PR", False),
    ("PullRequestReviewCommentEvent", "collaboration", "Comment on PR review", False),
    ("CreateEvent", "repository", "Branch or tag created", False),
    ("DeleteEvent", "repository", "Branch or tag deleted", False),
    ("ForkEvent", "repository", "Repository forked", False),
    ("WatchEvent", "engagement", "Repository starred", False),
    ("ReleaseEvent", "repository", "Release published", False),
    ("PublicEvent", "repository", "Repository made public", False),
    ("MemberEvent", "collaboration", "Collaborator added", False),
    ("CommitCommentEvent", "collaboration", "Comment on a commit", False),
    ("GollumEvent", "documentation", "Wiki page created or updated", False),
]


def event_categories(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The built-in lookup, or one read from a CSV file with the same four columns."""
    if csv_path is None:
        return spark.createDataFrame(EVENT_CATEGORIES, SEED)
    return spark.read.schema(SEED).csv(csv_path, header=True)
