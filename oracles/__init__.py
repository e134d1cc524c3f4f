"""DuckDB SQL that states, independently of the Spark code, what every registered query returns."""

from . import cards, loads, models, quality, rows

ORACLES: dict[str, str] = {}
for _part in (rows, models, cards, quality, loads):
    _clash = ORACLES.keys() & _part.SQL.keys()
    if _clash:
        raise ValueError(f"oracle given twice: {_clash}")
    ORACLES.update(_part.SQL)
