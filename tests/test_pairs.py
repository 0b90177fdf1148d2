"""Exact pair operators against brute force, with hot items, hot owners and copies."""

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from sparkkit.operators import pairs as pair_join
from sparkkit.operators.copurchase import pair_counts
from sparkkit.operators.similarity import Jaccard, similar_pairs


def frame(spark, pairs):
    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "owner long, item long").repartition(4)


def brute_jaccard(pairs, k, least):
    sets = {}
    for owner, item in pairs:
        sets.setdefault(int(owner), set()).add(int(item))
    sets = {o: s for o, s in sets.items() if len(s) >= least}
    scored = [
        (len(sets[a] & sets[b]) / len(sets[a] | sets[b]), a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] & sets[b]
    ]
    return [(a, b, j) for j, a, b in sorted(scored, key=lambda t: (-t[0], t[1], t[2]))[:k]]


def brute_counts(pairs, k, distinct=False):
    held = {}
    for owner, item in pairs:
        held.setdefault(int(owner), Counter())[int(item)] += 1
    total = Counter()
    for items in held.values():
        for a, b in combinations(sorted(items), 2):
            total[a, b] += 1 if distinct else items[a] * items[b]
    return [(a, b, n) for (a, b), n in sorted(total.items(), key=lambda t: (-t[1], t[0]))[:k]]


def baskets(kind, seed):
    rng = np.random.default_rng(seed)
    pairs = []
    for owner in range(120):
        size = rng.integers(3, 30)
        pairs += [(owner, item) for item in rng.integers(0, 150, size)]
    if kind == "hot item":
        pairs += [(owner, 1000 + i) for owner in range(0, 120, 2) for i in range(5)]
    if kind == "copies":
        pairs += [(500 + c, item) for c in range(60) for item in range(200, 215)]
    if kind == "large owner":
        pairs += [(900, item) for item in rng.integers(0, 150, 1500)]
        pairs += [(901, item) for item in range(150)]
    if kind == "few":
        pairs = [(o, i) for o, i in pairs if o < 3]
    if kind == "nested":
        pairs += [(700 + c, 300 + i) for c in range(12) for i in range(10 + c)]

    if kind == "level owner":
        pairs += [(910, item) for item in range(140) for _ in range(3)]
        pairs += [(911, item) for item in range(0, 150, 7) for _ in range(2)]
    return pairs


KINDS = ["plain", "hot item", "copies", "large owner", "few", "nested", "level owner"]


@pytest.mark.parametrize("kind, step", [(kind, 4) for kind in KINDS] + [("hot item", 1), ("nested", 1)])
def test_similar_pairs_are_exact(spark, kind, step, monkeypatch):
    monkeypatch.setattr(pair_join, "STEP", step)
    pairs = baskets(kind, KINDS.index(kind))
    got = [(r.a, r.b, r.jaccard) for r in similar_pairs(frame(spark, pairs), "owner", "item", 10, 10).collect()]
    want = brute_jaccard(pairs, 10, 10)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def counting(monkeypatch):
    """How many rows all calls of ``formed_pairs`` make."""
    formed, whole = [], pair_join.formed_pairs

    def counted(*more):
        found = whole(*more)
        formed.append(found.count())
        return found

    monkeypatch.setattr(pair_join, "formed_pairs", counted)
    return formed


def with_hot_items(owners):
    """Every owner holds two hot items and ten of its own; every ninth shares six with the next."""
    rows = [(o, i) for o in range(owners) for i in (-1, -2)]
    rows += [(o, 100 * o + i) for o in range(owners) for i in range(10)]
    return rows + [(o + 1, 100 * o + i) for o in range(0, owners - 1, 9) for i in range(6)]


@pytest.mark.parametrize("owners", [400, 800])
def test_a_hot_item_forms_no_square(spark, owners, monkeypatch):
    formed = counting(monkeypatch)
    rows = with_hot_items(owners)
    got = [(r.a, r.b, r.jaccard) for r in similar_pairs(frame(spark, rows), "owner", "item", 10, 10).collect()]
    assert [g[:2] for g in got] == [w[:2] for w in brute_jaccard(rows, 10, 10)]
    assert sum(formed) < 3 * owners  # the square would be half of owners squared, twice


@pytest.mark.parametrize("items", [300, 600])
def test_large_overlapping_owners_form_no_square(spark, items, monkeypatch):
    """Two owners hold all items three times; small ones hold a few items together more often."""
    formed = counting(monkeypatch)
    rows = [(o, i) for o in (900, 901) for i in range(items) for _ in range(3)]
    rows += [(o, i) for o in range(60) for i in (o % 20, o % 20 + 20) for _ in range(4)]
    got = pair_counts(frame(spark, rows), "owner", "item", 10).collect()
    assert [tuple(r) for r in got] == brute_counts(rows, 10)
    assert sum(formed) < 60 * items


@pytest.mark.parametrize("items", [300, 600])
def test_a_level_owner_forms_no_square(spark, items, monkeypatch):
    """All pairs tie: only those that start with an early item are formed."""
    formed = counting(monkeypatch)
    rows = [(900, i) for i in range(items) for _ in range(3)] + [(901, i) for i in range(0, items, 50)]
    got = pair_counts(frame(spark, rows), "owner", "item", 5).collect()
    assert [tuple(r) for r in got] == brute_counts(rows, 5)
    assert sum(formed) < 20 * items


def test_least_size_counts_distinct_items(spark):
    pairs = [(1, i) for i in range(9)] * 3 + [(2, i) for i in range(10)] + [(3, i) for i in range(10)]
    got = similar_pairs(frame(spark, pairs), "owner", "item", 5, 10).collect()
    assert [tuple(r) for r in got] == [(2, 3, 1.0)]


@pytest.mark.parametrize(
    "kind, distinct, step", [(kind, False, 4) for kind in KINDS] + [("large owner", True, 4), ("level owner", True, 1), ("large owner", False, 1)]
)
def test_pair_counts_are_exact(spark, kind, distinct, step, monkeypatch):
    monkeypatch.setattr(pair_join, "STEP", step)
    pairs = baskets(kind, KINDS.index(kind))
    got = pair_counts(frame(spark, pairs), "owner", "item", 10, distinct).collect()
    assert [tuple(r) for r in got] == brute_counts(pairs, 10, distinct)


def test_no_shared_key_gives_no_pairs(spark):
    rows = [(o, 20 * o + i) for o in range(5) for i in range(12)]
    assert similar_pairs(frame(spark, rows), "owner", "item").collect() == []
    assert pair_counts(frame(spark, [(1, 1), (2, 2)]), "owner", "item").collect() == []
    names = spark.createDataFrame([(f"o{o}", f"i{i}") for o in range(4) for i in range(10 + o)], "owner string, item string")
    assert similar_pairs(names, "owner", "item", 2).first()["a"] == "o2"


def test_repeat_purchases_multiply(spark):
    pairs = [(1, 5), (1, 5), (1, 6), (1, 6), (1, 6)]
    assert [tuple(r) for r in pair_counts(frame(spark, pairs), "owner", "item").collect()] == [(5, 6, 6)]
    assert [tuple(r) for r in pair_counts(frame(spark, pairs), "owner", "item", distinct=True).collect()] == [(5, 6, 1)]


@pytest.mark.parametrize("chunks", [1, 3])
def test_no_row_per_pair_is_shuffled(spark, chunks):
    """Lists of partners are; the sums of a pair need no further exchange, and earlier pairs are added to them."""
    rows = [(f"k{k}", x, 1, 3, 3, 0) for k in range(3) for x in range(20) if x % 4 != k]
    entries = spark.createDataFrame(rows, "key string, x long, w long, n long, rest long, later long")
    known = spark.createDataFrame([(0, 3, 7, 3, 3, 0, 0)], "a long, b long, shared long, na long, nb long, la long, lb long")
    sums = pair_join._summed(pair_join.formed_pairs(entries, Jaccard(1), pair_join.Bar(), 3.0, chunks, 4, known))
    exchanges = re.findall(r"hashpartitioning\((.*?)\)", sums._jdf.queryExecution().executedPlan().toString())
    assert exchanges and not any(re.search(r"\bb#", keys) for keys in exchanges)
    found = {(r.a, r.b): r.shared for r in sums.collect()}
    held = {x: {k for k in range(3) if x % 4 != k} for x in range(20)}
    want = {(a, b): len(held[a] & held[b]) for a, b in combinations(range(20), 2)}
    want[0, 3] += 7
    assert found == want
