"""Exact and near duplicates against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, connect

from sparkkit.llm import exact, near
from sparkkit.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for ids in groups.values():
        order = sorted(ids, key=lambda i: (i is not None, i or 0))
        out += [(i, order[0], len(ids)) for i in ids]
    return sorted(out, key=repr)


def check_exact(df):
    found = exact.groups(df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == plain_exact([(r.doc_id, r.text) for r in df.collect()])
    kept = Counter(r.keep_id for r in found if r.kept)
    heads = {(r.keep_id, r.group_size) for r in found}
    assert sum(kept.values()) == sum(1 / r.group_size for r in found) or abs(sum(kept.values()) - sum(1 / r.group_size for r in found)) < 1e-6
    assert all(r.doc_id == r.keep_id for r in found if r.kept) and len(heads) <= sum(kept.values())


def test_exact_on_odd_texts(odd_docs):
    check_exact(odd_docs)


def test_exact_at_every_length(spark):
    """Texts that part at, before and after each round's borders, with equal ones of each."""
    base = "".join(chr(97 + k * k % 23) for k in range(6000))
    rows = []
    for n in [*range(60, 70), 318, 319, 320, 321, 322, 1343, 1344, 1345, 5439, 5440, 5441, 6000]:
        rows += [base[:n], base[:n] + "é", base[: n - 1] + "é", base[:n]]
    check_exact(spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string").repartition(4))


def test_exact_on_no_rows(no_docs):
    assert exact.groups(no_docs).collect() == []


def test_exact_dedup_keeps_columns(spark):
    df = spark.createDataFrame([(3, "a  b", 1), (1, "a\tb", 2), (2, "c", 3), (1, "a b", 2)], "doc_id long, text string, size int")
    assert sorted(tuple(r)[::2] for r in exact.dedup(df, ["doc_id", "text", "size"]).collect()) == [(1, 2), (2, 3)]


def test_exact_query(spark, small):
    assert compare(QUERIES["op6_exact_dedup"](spark, SMALL), ORACLE["op6_exact_dedup"], connect(SMALL)).startswith("same (")


def plain_sets(rows, words):
    out = []
    for _, text in rows:
        part = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        size = min(words, len(part))
        out.append(frozenset(tuple(part[k : k + size]) for k in range(len(part) - size + 1)) if part else frozenset())
    return out


def plain_near(rows, words, percent=80):
    sets = plain_sets(rows, words)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is not None, doc_id or 0)
        least[root(i)] = min(least.get(root(i), (key, doc_id)), (key, doc_id), key=lambda x: x[0])
    return sorted(((doc_id, len(sets[i]), least[root(i)][1]) for i, (doc_id, _) in enumerate(rows)), key=repr)


def check_near(df, words, **more):
    found = near.link(df, words, **more).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == plain_near([(r.doc_id, r.text) for r in df.collect()], words)
    assert all(r.doc_id == r.component_id for r in found if r.kept)
    return found


@pytest.mark.parametrize("words", [2, 5])
def test_near_on_small_table(small, words):
    check_near(small, words)


def test_near_on_odd_texts(odd_docs):
    check_near(odd_docs, 2)


def test_near_on_no_rows(no_docs):
    assert near.link(no_docs).collect() == []


def near_copies(spark, n, changed):
    """A base text, copies of it that each differ elsewhere (alike to the base, less to each other), and chains."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 300)]
    rows = [(0, " ".join(base))]
    for k in range(1, n):
        copy = list(base)
        for at in rng.choice(300, changed, replace=False):
            copy[at] = f"x{k}n{at}"
        rows.append((k, " ".join(copy)))
    chain = list(base[:150])
    for k in range(n, n + 20):
        chain[(k * 7) % 150] = f"c{k}"
        chain[(k * 11) % 150] = f"d{k}"
        rows.append((k, " ".join(chain)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("changed", [8, 15, 16, 30])
def test_near_on_stars_and_chains(spark, changed):
    check_near(near_copies(spark, 60, changed), 2, block=8)


def test_near_dedup_keeps_columns(spark):
    text = " ".join(f"w{k}" for k in range(100))
    df = spark.createDataFrame([(7, text, "a", 1), (5, text + " more", "b", 2), (9, None, "c", 3), (9, None, "c", 3)], "doc_id long, text string, kept string, row int")
    found = sorted(((r.doc_id, r.text, r.kept, r.row) for r in near.dedup(df, ("doc_id", "text", "kept", "row")).collect()), key=repr)
    assert found == sorted([(5, text + " more", "b", 2), (9, None, "c", 3), (9, None, "c", 3)], key=repr)


def test_signatures_agree_as_sets_do():
    """Also where sets are far smaller than the signature, so that most slots borrow."""
    rng = np.random.default_rng(11)
    for size in (5, 40, 400, 4000):
        agreed = []
        for _ in range(60):
            union = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
            a, b = union[: int(size * 0.9)], union[int(size * 0.1) :]
            agreed.append((near.signature(np.unique(a)) == near.signature(np.unique(b))).mean())
        assert abs(np.mean(agreed) - len(set(a) & set(b)) / size) < 0.05


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(500, 400), (400, 450)], "a long, b long")
    found = {r.node: r.component for r in near.components(edges).collect()}
    assert found == {k: 0 for k in range(101)} | {400: 400, 450: 400, 500: 400}


def test_candidates_stay_few(spark):
    """A group of n near copies makes far fewer candidate pairs than n squared."""
    n = 400
    rows = near.stored(near_copies(spark, n, 2).selectExpr("doc_id as row", "doc_id", "text"), "rows")
    keys = near.describe(rows, 2).selectExpr("row", "explode(keys) as key")
    assert keys.groupBy("key").count().filter("count > 1").selectExpr("sum(count - 1)").first()[0] <= 40 * (n + 20)


def test_digest_of_normalised_text(spark):
    df = spark.createDataFrame([(1, " a \n b ")], "doc_id long, text string")
    (row,) = df.select(exact.normalised("text").alias("x")).collect()
    assert hashlib.sha256(row.x.encode()).hexdigest() == hashlib.sha256(b" a b ").hexdigest()
