"""Held-out accuracy, rejection and edge cases of language identification."""

import numpy as np
from llm_helpers import documents, given
from pyspark.sql import functions as F

from millrace.llm import language_id as li


def test_held_out_accuracy(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01").select("doc_id", "text", "lang")
    model = li.learn(docs.filter(~li.held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "id"))
    rows = docs.filter(li.held_out(F.col("doc_id"))).withColumn("f", li.identify(docs, model)).collect()
    assert sum(r.f.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert not any(r.f.rejected for r in rows)
    assert all(0 <= r.f.score <= 1 for r in rows)


def test_rejection_and_texts_without_letters(spark):
    docs = given(spark, "documents").select("doc_id", "text", "lang")
    model = li.learn(docs.withColumnRenamed("doc_id", "id"))
    langs, scores, rejected = li.judge([None, "", "12 !? \n", "длинный русский текст о погоде и о море " * 20], model)
    assert langs[:3] == ["und"] * 3 and scores[:3] == [0.0] * 3
    assert rejected == [True] * 4
    assert langs[3] in model.languages


def test_pieces_change_nothing(monkeypatch):
    text = "Größe, 12 mal — und\n noch ÄÖÜ  x" * 50
    whole = li.gram_counts(text)
    monkeypatch.setattr(li, "PIECE_CHARS", 13)
    assert np.array_equal(whole, li.gram_counts(text))


def test_nothing_to_learn_from_and_kept_columns(spark):
    docs = documents(spark, ["some words", None]).withColumn("score", F.lit(1))
    none = docs.filter("doc_id < 0").withColumn("id", F.col("doc_id"))
    model = li.learn(none)
    assert [r.f.lang_pred for r in docs.withColumn("f", li.identify(docs, model)).collect()] == ["und", "und"]
    kept = li.known_language(docs, docs.withColumn("lang", F.lit("en")).withColumn("id", F.col("doc_id")))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]
    assert li.known_language(none.drop("id"), none).count() == 0


def test_rows_without_ids_and_with_repeated_texts_teach_alike(spark):
    """Texts are drawn by content: neither a missing nor one repeated id decides, copies count once."""
    de, en = "der hund und die katze gehen nach hause nummer {}", "the dog and the cat are going home number {}"
    rows = [(None, de.format(i), "de") for i in range(3000)] + [(7, en.format(i), "en") for i in range(3000)]
    rows += [(i, "le chat et le chien vont au marche", "fr") for i in range(3000)]
    train = spark.createDataFrame(rows, "id long, text string, lang string")
    settings = li.Settings(fit_rows=300)
    sizes = {r[0]: r[1] for r in li._sample(train, settings).groupBy("lang").count().collect()}
    assert 200 < sizes["de"] < 400 and 200 < sizes["en"] < 400 and sizes["fr"] == 1
    model = li.learn(train, settings)
    assert li.judge([de.format("x"), en.format("x"), "le chien et le chat"], model)[0] == ["de", "en", "fr"]


def test_more_languages_than_the_model_holds(spark):
    """The most frequent ones are learned, of equally frequent ones the first by name."""
    rows = [(i, f"wort {'abcdefgh'[i % 8] * 4} noch {i}", f"l{i % 8}") for i in range(80)] + [(99, "extra wort", "l5")]
    train = spark.createDataFrame(rows, "id long, text string, lang string")
    assert set(li.learn(train, li.Settings(max_languages=3)).languages) == {"l0", "l1", "l5"}


def test_predictions_are_the_nearest_centroids(spark):
    """Against cosines taken one by one from gram counts and centroids."""
    docs = given(spark, "documents").select("doc_id", "text", "lang")
    model = li.learn(docs.withColumnRenamed("doc_id", "id"))
    for r in docs.withColumn("f", li.identify(docs, model)).limit(60).collect():
        counts = li.gram_counts(r.text)
        tfidf = [np.log1p(c) * w for c, w in zip(counts.tolist(), model.idf.tolist())]
        length = sum(x * x for x in tfidf) ** 0.5
        cosines = [sum(x * float(y) for x, y in zip(tfidf, centre) if x) / length for centre in model.centroids.tolist()]
        assert model.languages[int(np.argmax(cosines))] == r.f.lang_pred and abs(max(cosines) - r.f.score) < 1e-4
