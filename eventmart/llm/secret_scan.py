"""Secrets in text: patterns that stand alone, and credentials in parts that only count together.

Three patterns are secrets by themselves.  Beside them, long mixed strings are weak candidates for a
secret and upper-case ids weak candidates for its identifier.  Parts are linked by an interval join: a text
is cut into scopes of ``SCOPE`` characters, parts are reduced to the first and last start per scope and
kind, and each weak candidate looks up its own scope and the two beside it.  A weak secret is reported if
an access identifier starts within ``SCOPE`` characters of it, or an identifier and an endpoint do; a weak
identifier if a weak secret and an endpoint do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

SCOPE = 200

# The patterns of the base kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

WEAK_SECRET = r"[A-Za-z0-9+/]{32,}"
WEAK_IDENTIFIER = r"\b[A-Z][A-Z0-9]{15,31}\b"
ENDPOINT = r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9.:/_-]+"

_SPAN = "struct<start:int,end:int>"
_KINDS = ("assign", "access", "hex", "identifier", "secret")


def _spans(text: Column, pattern: str, possible: Column, group: int = 0, least: int = 0) -> Column:
    """Places of the matches, with at least ``least`` characters in the group; empty where not ``possible``.

    What stands between the matches tells where they are: split and extract go through the same matches.
    """
    found, own = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("all"), own.alias("own"))
    none = F.array().cast(f"array<{_SPAN}>")

    def add(state: Column, part: Column) -> Column:
        start = state.at + F.length(part["gap"])
        end = start + F.length(part["all"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        kept = F.when(F.length(part["own"]) >= least, F.concat(state.out, span)).otherwise(state.out)
        return F.struct(end.alias("at"), kept.alias("out"))

    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    placed = F.aggregate(parts, start, add, lambda s: s.out)
    return F.when(possible, placed).otherwise(none)


def _parts(text: Column) -> dict[str, Column]:
    low = F.lower(text)
    assigned = F.lit(False)
    for word in _ASSIGN_WORDS:
        assigned = assigned | F.contains(low, F.lit(word))
    long = F.rlike(text, F.lit(WEAK_SECRET))
    return {
        "assign": _spans(text, ASSIGN, assigned, 2, 6),
        "access": _spans(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": _spans(text, HEX, F.rlike(text, F.lit(HEX))),
        "secret": _spans(text, WEAK_SECRET, long),
        "identifier": _spans(text, WEAK_IDENTIFIER, long),
        "endpoint": _spans(text, ENDPOINT, long & F.contains(text, F.lit("://"))),
    }


def _mixed(text: Column, span: Column) -> Column:
    """A weak secret has small and capital letters and digits."""
    own = F.substring(text, span.start + 1, span.end - span.start)
    return F.rlike(own, F.lit("[a-z]")) & F.rlike(own, F.lit("[A-Z]")) & F.rlike(own, F.lit("[0-9]"))


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o.start < span.end) & (span.start < o.end))


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end")))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s.kind == kind)


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """row and the weak candidates (kind, start, end) that have what they need within the scope."""
    rows = parts.filter(F.size("secret") > 0).dropDuplicates(["row"])
    each = F.array(*[_named(kind) for kind in ("access", "identifier", "endpoint", "secret")])
    single = rows.select("row", F.explode(F.flatten(each)).alias("p")).select("row", "p.*")
    single = stage(single.withColumn("scope", F.floor(F.col("start") / scope)), "parts")
    known = single.groupBy("row", "scope", F.col("kind").alias("other")).agg(F.min("start").alias("first"), F.max("start").alias("last"))
    weak = single.filter(F.col("kind").isin("identifier", "secret")).withColumn("own", F.col("scope"))
    probes = weak.withColumn("scope", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    near = (
        (F.col("scope") == F.col("own"))
        | ((F.col("scope") < F.col("own")) & (F.col("last") >= F.col("start") - scope))
        | ((F.col("scope") > F.col("own")) & (F.col("first") <= F.col("start") + scope))
    )
    met = probes.join(known, ["row", "scope"]).filter(near).groupBy("row", "kind", "start", "end")
    has = met.agg(*[F.max(F.col("other") == k).alias(f"has_{k}") for k in ("access", "identifier", "endpoint", "secret")])
    secret = (F.col("kind") == "secret") & (F.col("has_access") | (F.col("has_identifier") & F.col("has_endpoint")))
    identifier = (F.col("kind") == "identifier") & F.col("has_secret") & F.col("has_endpoint")
    span = F.struct("kind", "start", "end")
    return has.filter(secret | identifier).groupBy("row").agg(F.collect_list(span).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """For every row: doc_id, base, spans: arrays of (start, rank, kind, end) by start, then kind; base is
    those of the three patterns.

    Places are code points, the end is exclusive.  A null text has no secrets.  Rows alike in doc_id and text
    have the same ones.  Weak candidates that overlap a base span are none.  Other columns are not looked at;
    an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), text.alias("text"))
    parts = parts.select("doc_id", "row", "text", *[c.alias(k) for k, c in _parts(F.col("text")).items()])
    base = F.concat("assign", "access", "hex")
    weak = {
        "secret": F.filter("secret", lambda s: _mixed(F.col("text"), s) & _apart(s, base)),
        "identifier": F.filter("identifier", lambda s: _apart(s, base)),
    }
    parts = stage(parts.withColumns(weak).drop("text"), "secrets")
    found = parts.join(_linked(parts, scope), "row", "left")

    def ranked(kind: str, spans: Column) -> Column:
        rank = _KINDS.index(kind)
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s.end.alias("end")))

    linked = F.coalesce("linked", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    added = [ranked(k, of_kind(linked, k)) for k in _KINDS[3:]]
    found = found.withColumn("base", F.array_sort(F.concat(*[ranked(k, F.col(k)) for k in _KINDS[:3]])))
    return found.withColumn("spans", F.array_sort(F.concat("base", *added))).select("doc_id", "base", "spans")


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))
