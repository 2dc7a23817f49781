"""Statistics against brute force; what the learned list accepts and spares."""

import re
from collections import Counter

from llm_helpers import ODD_TEXTS, documents, given, random_texts
from pyspark.sql import functions as F

from millrace.llm import quality_rules as qr


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


REPEATS = [
    "a b c d e f g h " * 2,
    "a b c d e f g h i j\n" * 3 + "k l m n o p q r",
    "x " * 30,
    "one two three four five six seven eight nine one two three four five six seven eight ten",
    "# * $\n# * $\nplain\n\n \n \n",
]


def test_counts_equal_brute_force(spark):
    texts = ODD_TEXTS + REPEATS + random_texts(200)
    texts += [r.text for r in given(spark, "documents").collect()]
    df = documents(spark, texts).select("doc_id", qr.verdict(F.col("text"), []).alias("v")).select("doc_id", "v.*")
    for r in df.collect():
        n, chars, symbols, dup, repeat = want = brute(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert r.kept == (not r.base_failed)


def test_rules_separate_the_given_labels(spark):
    docs, labels = given(spark, "documents", "/root/testdata/sf0.01"), given(spark, "labels", "/root/testdata/sf0.01")
    rows = qr.judge(docs, labels).join(labels, "doc_id").filter("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) == len(good)
    assert sum(bad) <= 0.2 * len(bad)


def test_no_labels_keep_what_passes_the_base_rule(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [text, None, "short"]).withColumn("n_words", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.kept for r in qr.judge(docs, labels).orderBy("doc_id").collect()] == [True, False, False]
    kept = qr.good_documents(docs, labels)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]
    nothing = docs.filter("doc_id < 0")
    assert qr.judge(nothing, spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")).count() == 0


def test_main_path_is_native(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    plan = qr.judge(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_the_sample_is_bounded_and_never_empty(spark):
    """Of a repeated id one text counts, and a small share of very many labels is not rounded to none."""
    docs = spark.range(4000).selectExpr("IF(id < 2000, 1, id) AS doc_id", "concat('some words of text ', id) AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    assert qr.labelled(docs, labels, qr.Settings(fit_rows=10**6)).count() == 2001
    few = qr.labelled(docs, labels, qr.Settings(fit_rows=400)).count()
    assert 100 < few < 400
