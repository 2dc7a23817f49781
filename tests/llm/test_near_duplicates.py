"""MinHash and multi-index links against brute force over all pairs."""

import math
import random
import re

import numpy as np
import pytest
from llm_helpers import ODD_TEXTS, documents, given
from pyspark.sql import functions as F

from millrace.llm import minhash, multi_index
from millrace.llm.components import components


def groups(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def shingles(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    edges = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    edges.append((j, i))
    return [len(s) for s in sets], groups(len(texts), edges)


def near_copies(n, words, changes, seed):
    """Texts around one original, each with a few words changed: links of every strength."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(10_000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(pick.randrange(changes + 1)):
            copy[pick.randrange(words)] = f"n{pick.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def check(spark, texts, settings):
    sizes, roots = brute(texts, settings.shingle, settings.percent)
    rows = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, texts), settings).collect()}
    assert len(rows) == len(texts)
    for i in range(len(texts)):
        assert (rows[i].n_shingles, rows[i].component_id, rows[i].kept) == (sizes[i], roots[i], roots[i] == i)


@pytest.mark.parametrize("shingle, percent", [(3, 85), (5, 80)])
def test_links_of_all_strengths(spark, shingle, percent):
    texts = ODD_TEXTS + near_copies(150, 120, 6, 1) + near_copies(40, 60, 3, 2) + near_copies(15, 9, 1, 3)
    texts += [f"{p} {' '.join(f'u{i}x{j}' for j in range(60))}" for i, p in enumerate([texts[-1]] * 40)]
    texts += [t.upper() for t in texts[-5:]] + [texts[20]] * 60
    check(spark, texts, minhash.Settings(shingle=shingle, percent=percent, trees=32))


def test_large_regions_lose_no_link(spark):
    """Regions above ``region_size`` are deepened, and what neighbours miss is still found."""
    check(spark, near_copies(120, 100, 8, 4), minhash.Settings(region_size=4, neighbours=1))


def test_given_documents(spark):
    texts = [r.text for r in given(spark, "documents").orderBy("doc_id").collect()]
    check(spark, texts, minhash.Settings())


def test_one_of_each(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + ["x y z", None]).withColumn("kept", F.lit("clash"))
    kept = minhash.one_of_each(docs, minhash.Settings(shingle=5, percent=80))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]
    assert minhash.near_duplicates(docs.filter("doc_id < 0")).count() == 0


def test_missing_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "p q r s t"), (7, "p q r s t"), (None, "alone here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(minhash.near_duplicates(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_shingles))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [
        (5, 5, True), (5, 5, True), (7, 5, False), (None, None, True), (None, 5, False),
    ]


def test_one_of_each_with_missing_and_repeated_ids(spark):
    rows = [
        (None, "a b c d"), (5, "a b c d"), (5, "p q r s t"), (7, "p q r s t"), (None, "alone here now"),
        (3, "u v w x y"), (3, "u v w x y"), (None, "k l m n o"), (None, "K l m n o"), (9, "once"), (9, "a b c d"),
        (None, None), (None, None), (4, ""), (4, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("clash"))
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text and r.text.lower()) for r in kept.collect()]
    assert sorted(found, key=str) == sorted([
        (5, "a b c d"), (5, "p q r s t"), (None, "alone here now"), (3, "u v w x y"), (None, "k l m n o"), (9, "once"),
        (None, None), (None, None), (4, ""), (4, ""),
    ], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(i, i + 1) for i in range(300) if i % 50 != 49] + [(1000, 1000 + i) for i in range(200)]
    edges += [(pick.randrange(2000, 2400), pick.randrange(2000, 2400)) for _ in range(220)]
    edges = [(a, b) if pick.random() < 0.5 else (b, a) for a, b in edges]
    pick.shuffle(edges)
    roots = groups(2400, edges)
    df = spark.createDataFrame(edges + [(None, 3), (5, 5)], "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: roots[n] for n in {x for a, b in edges if a != b for x in (a, b)}}


def brute_vectors(rows, threshold):
    links, edges = [0] * len(rows), []
    units = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        scaled = np.array(v) / np.abs(v).max() if ok else None  # squares of the large row overflow
        units.append(scaled / np.linalg.norm(scaled) if ok else None)
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                edges.append((j, i))
    return links, groups(len(rows), edges)


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.normal(size=16)
        for k in range(int(rng.integers(1, 4)) if i else 80):
            rows.append((len(rows), (v + rng.normal(size=16) * 0.05).tolist(), int(i % 3)))
    rows += [(len(rows) + k, rows[3][1], rows[3][2]) for k in range(30)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(len(rows) + k, v, 0) for k, v in enumerate(odd)]
    rows.append((len(rows), rows[0][1], None))
    rows.append((len(rows), [x * 1e200 for x in rows[0][1]], 0))
    return rows


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(multi_index, "BLOCK_VISITORS", 32)
    rows = vectors(150, 1)
    links, roots = brute_vectors(rows, 0.93)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("clash"))
    got = {r.vec_id: r for r in multi_index.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in range(len(rows)))
    assert found >= 0.99 * sum(links) and all(got[i].n_links <= links[i] for i in range(len(rows)))
    right = [got[i].component_id == roots[i] and got[i].kept == (roots[i] == i) for i in range(len(rows))]
    assert sum(right) >= 0.99 * len(rows)


def test_recall_on_given_vectors(spark):
    df = given(spark, "embeddings", "/root/testdata/sf0.1")
    rows = df.orderBy("vec_id").collect()
    units = np.array([r.embedding for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    labels = np.array([r.label for r in rows])
    want = (((units @ units.T) >= 0.93) & (labels[:, None] == labels[None, :])).sum() - len(rows)
    assert df.count() and multi_index.near_duplicates(df).agg(F.sum("n_links")).first()[0] >= 0.99 * want


def pairs_beside_a_group(pairs, group, dim=64):
    """Far-apart pairs with a cosine a little above the threshold, and a tight group of near copies."""
    rng = np.random.default_rng(8)
    one = rng.normal(size=(pairs, dim))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    off = rng.normal(size=(pairs, dim))
    off -= (off * one).sum(1, keepdims=True) * one
    two = 0.935 * one + math.sqrt(1 - 0.935**2) * off / np.linalg.norm(off, axis=1, keepdims=True)
    return np.concatenate([one, two, rng.normal(size=dim) + rng.normal(size=(group, dim)) * 0.01])


def test_no_link_is_lost_beside_a_group_of_near_copies(spark):
    pairs, group = 500, 1500
    rows = [(i, v.tolist(), 0) for i, v in enumerate(pairs_beside_a_group(pairs, group))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    settings = multi_index.Settings(cell_rows=16)  # many cells
    got = {r.vec_id: r for r in multi_index.near_duplicates(df, settings).collect()}
    assert all((got[i].n_links, got[i].component_id) == (1, i % pairs) for i in range(2 * pairs))
    assert all(got[i].n_links == group - 1 for i in range(2 * pairs, len(rows)))


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(2)
    rows = multi_index._unit(list(rng.normal(size=(300, 8))), 8)
    books = [rows[:9, :4], rows[:9, 4:]]
    index = multi_index.Index(books, [np.arange(9) // 3] * 2)
    (a, one), (b, two) = index.halves(rows)
    apart = 2 - 2 * rows @ rows.T
    bound = one[:, a] + two[:, b]
    assert (bound <= apart + 1e-6).all() and (bound > 0.3).any()


def test_no_usable_vector(spark):
    df = spark.createDataFrame([(1, None, 0), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in multi_index.near_duplicates(df).orderBy("vec_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]
    assert multi_index.near_duplicates(df.filter("vec_id < 0")).count() == 0


def test_traversal_is_in_order_of_cost():
    rng = np.random.default_rng(0)
    one, two = rng.random(7), rng.random(5)
    cells = multi_index.traversal(one, two, 35)
    costs = [one[c // 5] + two[c % 5] for c in cells]
    assert sorted(cells) == list(range(35)) and costs == sorted(costs)


def test_small_labels_have_a_grid_too(spark):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(pairs_beside_a_group(20, 30))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    classes = df.selectExpr("vec_id AS node", "embedding AS vector")
    index = multi_index.build(classes, len(rows), 24, 64, multi_index.Settings())
    assert all(len(np.unique(own)) > 1 for own in index.groups)
    links, roots = brute_vectors(rows, 0.93)
    got = {r.vec_id: r for r in multi_index.near_duplicates(df).collect()}
    assert sum(links) > 0 and all((got[i].n_links, got[i].component_id) == (links[i], roots[i]) for i in range(len(rows)))


def test_very_many_rows_without_an_id(spark):
    """Rows without an id, or with one id for all, are not joined with one another."""
    text = "concat('word', id, ' and more of number ', id * 7, ' in text ', id % 13)"
    for name in ("CAST(NULL AS LONG)", "CAST(5 AS LONG)"):
        docs = spark.range(20_000).selectExpr(f"{name} AS doc_id", f"{text} AS text")
        docs = docs.unionByName(docs.limit(50))
        settings = minhash.Settings()
        features = minhash._features(docs, settings)
        classes = features.groupBy("class").agg(F.min(F.struct("doc_id", "digest")).alias("place"))
        assert minhash._representatives(docs, classes, settings).count() == 20_000
        out = minhash.near_duplicates(docs, settings)
        assert out.count() == 20_050 and out.filter("kept").count() == 20_050


def test_components_of_few_edges_have_few_parts(spark):
    keys = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        found = components(spark.range(60).selectExpr("id AS a", "id + if(id % 3 = 2, 0, 1) AS b"))
        assert found.rdd.getNumPartitions() <= 16
        assert {r.node: r.component for r in found.collect()} == {i: i - i % 3 for i in range(60)}
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
