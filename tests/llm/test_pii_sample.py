"""The training sample of the tagger does not depend on copies or on the place in a text."""

from eventmart.llm import pii


def test_copies_do_not_fill_the_training_sample(spark, monkeypatch):
    texts = [f"call {i}00 or write to me{i}@host{i}.org" for i in range(40)]
    hashes = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text) h")
    first = hashes.orderBy("h").first()["text"]
    docs = spark.createDataFrame([(t,) for t in [*texts, *[first] * 60]], "text string")
    seen, windows_of = [], pii.windows_of
    monkeypatch.setattr(pii, "windows_of", lambda text, *a: seen.append(text) or windows_of(text, *a))
    pii.train(docs, windows=40, steps=1)
    assert len(set(seen)) == 20


def test_windows_of_a_text_come_from_all_of_it(spark, monkeypatch):
    text = "\n".join(f"line {i} has number {i * 7919}" for i in range(400))
    docs, taken, varied = spark.createDataFrame([(text,)], "text string"), [], pii._varied
    monkeypatch.setattr(pii, "_varied", lambda t, *a: taken.append(text.find(t)) or varied(t, *a))
    pii.train(docs, windows=40, steps=1)
    assert len(taken) >= 40 and max(taken) > len(text) / 2
