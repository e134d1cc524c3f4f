"""The older nested event table: actor, repo, org and payload as semi-structured columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .event_files import event_struct


def nested_events(raw: DataFrame) -> DataFrame:
    """Raw rows in the nested layout: one VARIANT per JSON object, plus the whole event."""
    part = lambda name: F.try_parse_json(F.to_json(F.col(f"e.{name}"))).alias(name)
    return raw.select(event_struct().alias("e"), "created_at", "ingested_at").select(
        "e.id",
        "e.type",
        part("actor"),
        part("repo"),
        F.col("e.payload"),
        "e.public",
        "created_at",
        part("org"),
        F.try_parse_json(F.to_json("e")).alias("raw_data"),
        "ingested_at",
    )


def read_paths(nested: DataFrame) -> DataFrame:
    """JSON-path read of login and repository name; absent paths give NULL."""
    return nested.select(
        "id",
        "type",
        F.try_variant_get("actor", "$.login", "string").alias("actor_login"),
        F.try_variant_get("repo", "$.name", "string").alias("repo_name"),
        "created_at",
    )


def count_by_type(nested: DataFrame) -> DataFrame:
    return nested.groupBy("type").agg(F.count("*").alias("events"))
