"""Rounds of the connected components."""

from eventmart.llm import components


def test_stars_need_no_round(spark, monkeypatch):
    """Links that are stars already are seen as settled: only the links themselves are written."""
    written, stage = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, label: written.append(label) or stage(df, label))
    stars = [(1, 2), (1, 3), (4, 5), (7, 6), (6, 8), (9, 9), (None, 1)]
    found = components.connected_components(spark.createDataFrame(stars, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (8, 6)]
    assert len(written) == 1
    chain = [(1, 2), (2, 3), (3, 4), (4, 5)]
    found = components.connected_components(spark.createDataFrame(chain, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(n, 1) for n in range(1, 6)]
