"""Queries that run their fits at the operators' defaults, on a small table, against brute force."""

import hashlib
import math

import numpy as np
import pytest

from sparkkit import registry
from sparkkit.operators import logistic, vocabulary


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rng = np.random.default_rng(5)
    words = [f"{a}{b}q" for a in "abcde" for b in "vwxyz"]
    rows = [(k, " ".join(rng.choice(words[:15] if k % 2 else words[8:], 12)), "en" if k % 2 else "de", "s") for k in range(24)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k,) for k in range(0, 24, 3)] + [(k,) for k in range(1, 24, 3)], "doc_id long").write.parquet(f"{path}/labels.parquet")
    return str(path)


def descent(x, y):
    """The published descent: rate 0.1, 400 rounds, or a step under 1e-4 from the second round on."""
    w, rate, last, trace = np.full(x.shape[1], 0.01), 0.1, None, []
    for number in range(1, 401):
        z = x @ w
        loss = np.sum(np.logaddexp(0, z) - y * z) + np.sqrt(np.sum(w * w))
        step = rate * (x.T @ (1 / (1 + np.exp(-z)) - y))
        w = w - step
        if last is not None:
            rate *= 1.05 if loss < last else 0.5
        last = loss
        trace.append((number, loss, rate, np.linalg.norm(step)))
        if number > 1 and trace[-1][3] < 1e-4:
            break
    return w, trace


def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    labelled = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    return [(r.doc_id, r.text.split(), float(r.lang == "en"), r.doc_id in labelled) for r in rows]


def dense(spark, folder):
    """Dictionary and TF-IDF in plain numpy."""
    data = texts(spark, folder)
    every = [w for _, ws, _, _ in data for w in ws]
    order = sorted(set(every), key=lambda w: (-every.count(w), w))
    counts = np.array([[ws.count(w) for w in order] for _, ws, _, _ in data], dtype=float)
    tfidf = counts / counts.sum(1, keepdims=True) * np.log(len(data) / (counts > 0).sum(0))
    x = np.zeros((len(data), vocabulary.DICTIONARY_SIZE))
    x[:, : len(order)] = tfidf
    return order, x, np.array([y for _, _, y, _ in data]), np.array([known for *_, known in data]), counts


def test_logistic_queries_run_to_the_end(spark, folder, monkeypatch):
    """Trace, coefficients and strongest words of the whole fit; the three queries share one run of it here."""
    order, x, y, _, _ = dense(spark, folder)
    w, expected = descent(x, y)
    fitted = registry._fit(spark, folder)
    monkeypatch.setattr(registry, "_fit", lambda *_, **options: fitted if not options else pytest.fail("not the defaults"))
    found = registry.FULL_FITS["logit_full_trace"](spark, folder).orderBy("round").collect()
    assert len(found) == len(expected) > 8
    assert np.allclose([(r["round"], r.loss, r.rate, r.step) for r in found], expected, rtol=1e-5, atol=2e-6)
    coefficients = {r.word: r.coefficient for r in registry.FULL_FITS["logit_full_coefficients"](spark, folder).collect()}
    assert coefficients == {word: pytest.approx(w[k], abs=1e-6) for k, word in enumerate(order)}
    top = registry.FULL_FITS["logit_full_top_words"](spark, folder).collect()
    assert {(r.word, round(r.coefficient, 4)) for r in top} == {(order[k], round(w[k], 4)) for k in np.argsort(-w[: len(order)])[:5]}


def test_logistic_split_runs_to_the_end(spark, folder):
    _, x, y, known, _ = dense(spark, folder)
    w, _ = descent(x[known], y[known])
    guess, truth = x[~known] @ w >= 0, y[~known] == 1
    row = registry.FULL_FITS["logit_full_split_eval"](spark, folder).first()
    want = [int(np.sum(a)) for a in (truth & guess, ~truth & ~guess, ~truth & guess, truth & ~guess)]
    assert [row.tp, row.tn, row.fp, row.fn] == want and len(truth) == 8
    assert row.f1 == pytest.approx(2 * want[0] / (2 * want[0] + want[2] + want[3]))


def plain_draw(seed, number, cluster, places, shapes):
    """A Dirichlet draw, number by number: gamma draws by rejection, from one digest for every proposal."""
    logs = []
    for place, shape in zip(places, shapes):
        d = shape + 2 / 3
        for attempt in range(16):
            digest = hashlib.md5(f"{seed}:{number}:{cluster(place)}:{place if place >= 0 else -1}:{attempt}".encode()).hexdigest()
            u = [(int(digest[8 * i : 8 * i + 8], 16) + 0.5) / 2**32 for i in range(4)]
            x = math.sqrt(-2 * math.log(u[0])) * math.cos(2 * math.pi * u[1])
            v = (1 + x / math.sqrt(9 * d)) ** 3
            if v > 0 and math.log(u[2]) < 0.5 * x * x + d - d * v + d * math.log(v):
                logs.append(math.log(d * v) + math.log(u[3]) / shape)
                break
    parts = np.exp(np.array(logs) - max(logs))
    return parts / parts.sum()


def plain_gibbs(names, counts, clusters=20, rounds=200, alpha=0.1, beta=0.1, seed=7):
    """The whole chain over dense counts: draws of the weights by address, a uniform number per document and round by md5."""
    size = counts.shape[1]
    of_classes = lambda number, a: plain_draw(seed, number, lambda j: -j - 1, [-j - 1 for j in range(clusters)], a)
    of_words = lambda number, j, a: plain_draw(seed, number, lambda _: j, range(size), a)
    pi, mu = of_classes(0, np.full(clusters, alpha)), np.stack([of_words(0, j, np.full(size, beta)) for j in range(clusters)])
    least = np.finfo(float).tiny
    for number in range(1, rounds + 1):
        logs = np.log(np.maximum(pi, least)) + counts @ np.log(np.maximum(mu, least)).T
        chosen = []
        for name, row in zip(names, logs):
            u = int(hashlib.md5(f"{seed}:{number}:{name}".encode()).hexdigest()[:13], 16) / 2**52
            p = np.exp(row - row.max())
            chosen.append(int(np.sum(u >= np.cumsum(p / p.sum())[:-1])))
        sizes, words = np.zeros(clusters), np.zeros((clusters, size))
        for j, row in zip(chosen, counts):
            sizes[j] += 1
            words[j] += row
        pi = of_classes(number, alpha + sizes)
        mu = np.stack([of_words(number, j, beta + words[j]) for j in range(clusters)])
    return dict(zip(names, chosen)), mu


def test_mixture_queries_run_the_whole_chain(spark, folder, monkeypatch):
    """20 clusters and 200 rounds against the plain chain; the three queries share one run of it here."""
    order, _, y, _, counts = dense(spark, folder)
    names = [f"corpus/{'en' if label else 'de'}/{k}" for k, label in enumerate(y)]
    chosen, mu = plain_gibbs(names, counts)
    run = registry._clusters(spark, folder)
    monkeypatch.setattr(registry, "_clusters", lambda *_: run)
    assert {r.doc_id: r.cluster for r in registry.QUERIES["mixture_clusters"](spark, folder).collect()} == chosen
    assert run[2].round == 200 and run[2].mu.shape == (20, len(order))
    heaviest = registry.QUERIES["cluster_words"](spark, folder).collect()
    for j in range(20):
        got = [(r["rank"], r.word, r.weight) for r in heaviest if r.cluster == j]
        ranked = sorted(((-mu[j, k], word) for k, word in enumerate(order)))[:50]
        assert [(n, w) for n, w, _ in sorted(got)] == [(n, w) for n, (_, w) in enumerate(ranked, 1)]
        assert [x for *_, x in sorted(got)] == [pytest.approx(-x) for x, _ in ranked]
    shares = registry.QUERIES["cluster_categories"](spark, folder).collect()
    for j in set(chosen.values()):
        own = [name.split("/")[1] for name, c in chosen.items() if c == j]
        want = sorted(((-own.count(c) / len(own), c) for c in set(own)))[:3]
        assert [(r.category, r.share) for r in sorted((r for r in shares if r.cluster == j), key=lambda r: r["rank"])] == [(c, pytest.approx(-s)) for s, c in want]


def test_sparse_rows_leave_out_documents_without_words(spark, folder):
    corpus = registry.docs(spark, folder).unionByName(spark.createDataFrame([(99, "1 2", "en", "s", 1)], "doc_id long, text string, lang string, source string, label int"))
    rows = vocabulary.tfidf_rows(corpus, vocabulary.dictionary(corpus), corpus.count(), keep=["label"])
    assert rows.count() == 25 and logistic.sparse_rows(rows, "label").count() == 24
