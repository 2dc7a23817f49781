"""Budgets against a plain computation, prefixes, shards, bins."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm_helpers import documents, given
from pyspark.sql import functions as F

from millrace.llm import mixing, sharding


def plain_deal(budget, caps, weights):
    """Water-filling by rounds: whoever is full leaves, the rest share again by weight."""
    shares, open_ = {}, dict(caps)
    while open_:
        left = budget - sum(shares.values())
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if Fraction(left * weights[k], total) >= open_[k]]
        if not full:
            exact = {k: Fraction(left * weights[k], total) for k in open_}
            shares |= {k: int(v) for k, v in exact.items()}
            spare = budget - sum(shares.values())
            for k in sorted(open_, key=lambda k: (-(left * weights[k] % total), k))[:spare]:
                shares[k] += 1
            return shares
        for k in full:
            shares[k] = open_.pop(k)
    return shares


@pytest.mark.parametrize("seed", range(4))
def test_dealing(spark, seed):
    pick = random.Random(seed)
    rows, want = [], {}
    for parent in "pqr":
        caps = {f"k{i}": pick.randrange(0, 500) for i in range(6)}
        weights = {k: pick.randrange(1, 9) for k in caps}
        budget = pick.randrange(0, sum(caps.values()) + 1)
        want |= {(parent, k): v for k, v in plain_deal(budget, caps, weights).items()}
        rows += [(parent, k, caps[k], weights[k], budget) for k in caps]
    nodes = spark.createDataFrame(rows, "p string, k string, cap long, weight long, budget long")
    nodes = nodes.select("p", "k", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("cap", "weight", "budget")])
    assert {(r.p, r.k): int(r.budget) for r in mixing.deal(nodes, ["p"], "k").collect()} == want


def mixed(spark, rows, spec):
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, n_tokens long, copies string")
    return mixing.mix(docs, spec).collect()


def test_shortages_go_to_siblings_before_ancestors(spark):
    rows = [(i, "a", "x", 10, "c") for i in range(2)] + [(10 + i, "a", "y", 10, "c") for i in range(30)]
    rows += [(100 + i, "b", None, 10, "c") for i in range(30)]
    spec = mixing.Mix(("domain", "lang"), budget_percent=50, max_epochs=1)
    out = mixed(spark, rows, spec)
    by = Counter((r.domain, r.lang) for r in out)
    # 620 tokens, 310 to deal: 155 to each domain; x has 20, so y takes the rest of a's.
    assert by == {("a", "x"): 2, ("a", "y"): 13, ("b", None): 15}
    assert all(r.copies == 1 for r in out)


def test_epochs_and_prefix(spark):
    rows = [(i, "a", "x", i % 7 + 1, "c") for i in range(50)] + [(None, "a", "x", None, "c"), (99, "a", "x", 0, "c")]
    supply = sum(r[3] or 0 for r in rows)
    spec = mixing.Mix(("domain", "lang"), budget_percent=150, max_epochs=3, seed=4)
    out = {r.doc_id: r for r in mixed(spark, rows, spec)}
    rest, taken = supply * 150 // 100 - supply, 0

    def place(doc_id):
        return int(hashlib.md5(f"4|1|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)

    inside = set()
    for r in sorted(rows, key=lambda r: place(r[0])):
        if taken + (r[3] or 0) > rest:
            break
        taken += r[3] or 0
        inside.add(r[0])
    assert {k for k, r in out.items() if r.copies == 2} == inside
    assert len(out) == len(rows)


def test_repeated_rows_stand_together_and_nothing_to_mix(spark):
    rows = [(1, "a", "x", 10, "c")] * 5 + [(2, "a", "x", 10, "c")] * 5
    spec = mixing.Mix(("domain", "lang"), budget_percent=70, max_epochs=1)
    assert [r.doc_id for r in mixed(spark, rows, spec)] in ([1] * 5, [2] * 5)
    assert mixed(spark, [], spec) == []
    assert mixed(spark, rows, mixing.Mix(("domain", "lang"), budget_percent=0)) == []
    with pytest.raises(ValueError):
        mixing.Mix(("domain",), {("a",): 0})


def test_mixing_is_native(spark):
    docs = given(spark, "documents").withColumn("n_tokens", F.lit(3).cast("long"))
    plan = mixing.mix(docs, mixing.Mix(("lang", "source")))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def plain_best_fit(sizes, capacity):
    bins, out = [], []
    for size in sizes:
        fits = [(left, i) for i, left in enumerate(bins) if left >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append(max(capacity, size))
        bins[i] -= size
        out.append(i)
    return out, len(bins)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_in_a_tree_equals_a_plain_search(seed):
    pick = random.Random(seed)
    sizes = sorted((pick.randrange(1, 120) for _ in range(400)), reverse=True)
    assert sharding.best_fit_decreasing(sizes, 100) == plain_best_fit(sizes, 100)


def check_shards(rows, texts):
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return groups


def test_shards_of_given_documents(spark):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shards(docs, n_shards=8).collect()
    groups = check_shards(rows, texts)
    assert all(len(g) == 1 for g in groups.values())
    sizes = Counter()
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8
        sizes[r.shard] += r.size
    assert len(sizes) == 8 and max(sizes.values()) <= 1.03 * min(sizes.values())


def test_levels_of_packing_and_a_group_above_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ITEMS", 40)
    monkeypatch.setattr(sharding, "LAST_ITEMS", 60)
    monkeypatch.setattr(sharding, "PARCELS", 10)
    texts = ["the same text for very many rows"] * 300 + [f"{'x' * (i % 37)} {i}" for i in range(500)] + [None, None, ""]
    rows = sharding.shards(documents(spark, texts).withColumn("shard", F.lit("clash")), n_shards=5).collect()
    groups = check_shards(rows, dict(enumerate(texts)))
    assert [t for t, g in groups.items() if len(g) > 1] == [texts[0]]
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= 1.2 * min(sizes.values())


@pytest.mark.parametrize("given_number", [True, False])
def test_more_shards_than_one_task_packs(spark, monkeypatch, given_number):
    monkeypatch.setattr(sharding, "CELL_ITEMS", 400)
    monkeypatch.setattr(sharding, "LAST_ITEMS", 600)
    monkeypatch.setattr(sharding, "PARCELS", 10)
    texts = [f"{'x' * (20 + i % 37)} {i}" for i in range(6000)]
    whole = sum(len(t) + 8 for t in texts)
    capacity = -(-whole // 210)
    rows = sharding.shards(documents(spark, texts), **({"n_shards": 210} if given_number else {"capacity": capacity})).collect()
    check_shards(rows, dict(enumerate(texts)))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert sorted(sizes) == list(range(len(sizes)))
    if given_number:
        assert len(sizes) == 210 and max(sizes.values()) <= 1.5 * min(sizes.values())
    else:
        assert len(sizes) <= 1.15 * 210 and max(sizes.values()) <= capacity


def test_fixed_capacity_and_edge_cases(spark):
    docs = documents(spark, ["a" * 92] * 2 + ["b" * 42] * 4 + ["c" * 300])
    rows = sharding.shards(docs, capacity=200).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.shard].add(r.size)
    assert len(by) == 3 and {308} in by.values()
    assert sharding.shards(docs.filter("doc_id < 0"), n_shards=3).count() == 0
    assert sorted(r.text_crc32 for r in sharding.shards(documents(spark, [None, ""]), n_shards=2).collect()) == [0, 0]
    with pytest.raises(ValueError):
        sharding.shards(docs)
