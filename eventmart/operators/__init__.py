"""Relational operators: each is ``f(df, ..., **params) -> DataFrame``."""
