"""Batch analytics over a public code-hosting event log, as PySpark DataFrame operators.

Layers: ``sources`` (files, raw table, sinks) -> ``operators`` (filters, joins, aggregates, upserts,
checks, load planning) -> ``plans`` (staging, marts, dashboard cards, pipeline).  Operators take and
return DataFrames, so they chain with ``DataFrame.transform`` and Catalyst plans the whole query.
"""
