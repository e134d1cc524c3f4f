"""String rules: bot logins, repository names, contributor kinds."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BOT_PATTERNS


def is_bot(login: str = "actor_login", patterns: list[str] = BOT_PATTERNS) -> Column:
    """True if the login contains any pattern, ignoring case; never NULL."""
    lowered = F.lower(F.col(login))
    return F.coalesce(reduce(or_, [lowered.contains(p) for p in patterns]), F.lit(False))


def repo_owner(full_name: str | Column) -> Column:
    return F.split_part(_text(full_name), F.lit("/"), F.lit(1))


def repo_slug(full_name: str | Column) -> Column:
    """Second part of ``owner/slug``; the empty string when there is no slash."""
    return F.split_part(_text(full_name), F.lit("/"), F.lit(2))


def contributor_type(org_id: str = "org_id") -> Column:
    return F.when(F.col(org_id).isNotNull(), "Organization").otherwise("Individual")


def _text(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
