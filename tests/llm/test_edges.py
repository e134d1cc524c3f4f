"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from eventmart.llm import (
    decontamination,
    language_id,
    mixing,
    pii,
    secret_scan,
    simhash,
    substrings,
    token_count,
    url_filter,
    vector_search,
)

LONG = " ".join(f"word{i}" for i in range(30_000))
ROWS = [
    (1, None, None, None, 0),
    (2, "", "en", "a", 0),
    (3, "one two three", "en", "a", 13),
    (3, "one two three", "en", "a", 13),
    (4, LONG, "en", "b", len(LONG)),
    (5, LONG + " end", "de", None, len(LONG) + 4),
    (6, "12 34 !", "de", "b", 7),
    (None, "no id here", None, "b", 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["fp", "row", "key", "words", "root", "size", "n", "own", "text_2", "spans", "copies"]
VOCABULARY = token_count.Vocabulary({"▁": -1.0, "o": -2.0, "n": -2.0, "e": -2.0, "▁one": -3.0, "on": -4.0, "ne": -4.0})
TAGGER = pii.Tagger.fresh(pii.np.random.default_rng(0))


def _items(spark):
    return spark.createDataFrame([(1, "one two three"), (1, "one two three"), (None, "x y"), (2, None), (3, "")], "item_id long, text string")


OPERATORS = {
    "language": lambda d: language_id.identify(d, language_id.train(d, buckets=1 << 10)),
    "simhash": simhash.near_duplicates,
    "pii": lambda d: pii.find_pii(d, TAGGER),
    "substrings": substrings.remove_repeats,
    "secrets": secret_scan.find_secrets,
    "mixing": mixing.mix,
    "decontamination": lambda d: decontamination.contamination(d, _items(d.sparkSession)),
    "tokens": lambda d: token_count.count_tokens(d, VOCABULARY),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows(spark, docs, name):
    plain = OPERATORS[name](docs)
    clashing = docs.withColumns({c: F.lit("clash") for c in CLASHING})
    found = sorted(map(str, plain.collect()))
    assert len(found) == len(ROWS)
    assert sorted(map(str, OPERATORS[name](clashing).collect())) == found
    assert OPERATORS[name](docs.limit(0)).collect() == []


def test_values_of_hard_rows(docs):
    def by_id(df):
        return {r["doc_id"]: r for r in df.collect()}

    found = by_id(OPERATORS["language"](docs))
    assert [found[i]["lang_pred"] for i in (1, 2, 6)] == ["und"] * 3 and found[1]["score"] == 0
    found = by_id(OPERATORS["simhash"](docs))
    assert found[1]["fingerprint"] == found[2]["fingerprint"] == "0" * 16
    assert found[2]["component_id"] == 1 and found[5]["component_id"] == 4 and found[None]["component_id"] is None
    found = by_id(OPERATORS["substrings"](docs))
    assert (found[4]["n_removed"], found[5]["n_removed"]) == (0, 30_000) and found[1]["n_words"] == 0
    found = by_id(OPERATORS["decontamination"](docs))
    assert (found[3]["n_hit"], found[3]["n_items"], found[1]["n_words"], found[6]["n_hit"]) == (3, 1, 0, 0)
    found = by_id(OPERATORS["mixing"](docs))
    assert found[1]["size"] == 0 and all(r["taken"] <= 2 * r["size"] for r in found.values())
    assert by_id(OPERATORS["tokens"](docs))[1]["n_tokens"] == 0


def test_stages_keep_columns_and_rows(docs):
    extra = docs.withColumn("fp", F.lit(1)).withColumn("row", F.lit(2))
    items = _items(docs.sparkSession)
    model = language_id.train(docs, buckets=1 << 10)
    for df in (
        language_id.keep_identified(extra, model),
        simhash.keep_one(extra),
        decontamination.remove_benchmark(extra, items),
        pii.mask(extra, TAGGER),
    ):
        assert df.columns == extra.columns
        assert df.limit(0).collect() == []
    assert sorted(r["doc_id"] or 0 for r in simhash.keep_one(extra).collect()) == [0, 1, 3, 4, 6]
    left = decontamination.remove_benchmark(extra, items).collect()
    assert 3 not in {r["doc_id"] for r in left} and len(left) == len(ROWS) - 2
    assert mixing.mixture(extra).columns == [*extra.columns, "copy"]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, None)]
    rows += [(7, [1.0, 0.0, 0.0]), (None, [5.0, 5.0]), (1, [1.0, 0.0]), (8, []), (9, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("x"))
    found = vector_search.top_k(df, F.col("vec_id").isin(0, 3, 6, 7, 8), k=2)
    assert [tuple(r) for r in found.orderBy("query", "rank").collect()] == [(0, 1, 1, 1 << 20), (0, 2, 1, 1 << 20)]  # the row that repeats vector 1 is a candidate of its own
    assert vector_search.top_k(df.limit(0), F.lit(True)).collect() == []


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://Sub.EXAMPLE.com/de/x?y://z", "x://net", "x://a.net/", "x://example.net/en/a#b"]
    urls += ["x://badexample.com/de/", "x://a.org/fr/q", "x://org/fr", "x://a.net/", "x://" + "a." * 2000 + "net/" + "p" * 5000]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("key", F.lit(1))
    found = {r["page_id"]: r for r in url_filter.judge(df, {"block": ["net/", "example.com/de/"], "allow": ["example.net/en/", "org/fr/"]}).collect()}
    assert [found[i]["rule"] for i in range(len(urls))] == [
        None, None, None, "example.com/de/", None, "net/", "example.net/en/", None, "org/fr/", None, "net/", "net/",
    ]
    assert found[0]["host"] == found[2]["path"] == "" and found[3]["host"] == "sub.example.com"
    assert found[5]["verdict"] == "block" and found[6]["verdict"] == found[4]["verdict"] == "allow"
    assert url_filter.judge(df.limit(0), {"block": ["net/"]}).collect() == []
    assert {r["verdict"] for r in url_filter.judge(df, {}).collect()} == {"allow"}
