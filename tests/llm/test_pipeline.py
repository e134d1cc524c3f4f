"""The corpus pipeline against what each stage promises on its own input."""

from itertools import combinations

import corpus_pipeline
from tests.conftest import SMALL

from eventmart.llm import decontamination, mixing, pii


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _one_of_each_group(rows):
    """Least ids of the groups that links of a five-word similarity of 0.8 make, by comparing all pairs."""
    sets, root = {r["doc_id"]: _shingles(r["text"]) for r in rows}, {r["doc_id"]: r["doc_id"] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted(i for i in root if root[i] == i)


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        seen[name] = corpus_pipeline.stage(function(spark, docs, SMALL), name)
        assert seen[name].columns[: len(docs.columns)] == docs.columns
        docs = seen[name]
    ids = {name: sorted(r["doc_id"] for r in df.select("doc_id").collect()) for name, df in seen.items()}
    assert ids["simhash"] == _one_of_each_group(seen["language_id"].collect())
    assert not decontamination.contamination(seen["decontamination"], bench).filter("contaminated").count()
    assert ids["pii"] == ids["decontamination"]
    assert all(pii.base_spans(r["text"] or "") == [] for r in seen["pii"].collect())
    counts = {r["doc_id"]: r["copies"] for r in mixing.mix(seen["pii"]).collect() if r["copies"]}
    assert ids["mixing"] == sorted(i for i, n in counts.items() for _ in range(n))
