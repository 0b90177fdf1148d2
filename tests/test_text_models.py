import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkkit.functions import tokens
from sparkkit.operators import logistic, mixture, neighbors, vocabulary
from sparkkit.plans import documents, posts

WORDS = ["court", "law", "judge", "cell", "gene", "protein", "and", "the"]


def corpus(seed=0, n=24):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        law = i % 2 == 0
        weights = np.array([5, 4, 3, 1, 1, 1, 4, 6] if law else [1, 1, 1, 4, 5, 3, 4, 6], dtype=float)
        words = rng.choice(WORDS, size=20, p=weights / weights.sum())
        out.append((f"AU{i}" if law else f"W{i}", " ".join(words)))
    return out + [("W99", "123 456")]


@pytest.fixture(scope="module")
def docs(spark):
    return documents.with_class(spark.createDataFrame(corpus(), "doc_id string, text string")).repartition(3).cache()


@pytest.fixture(scope="module")
def words(docs):
    return vocabulary.dictionary(docs, size=6).cache()


@pytest.fixture(scope="module")
def vectors(docs, words):
    return vocabulary.tfidf(docs, words, docs.count(), keep=["label"]).cache()


@pytest.fixture(scope="module")
def packed(docs, words):
    return vocabulary.tfidf_rows(docs, words, docs.count(), keep=["label"]).cache()


def dense():
    """TF-IDF by plain numpy: ids, labels, matrix, idf, words by position."""
    data = [(d, t.split()) for d, t in corpus()]
    total = Counter(w for _, ws in data for w in ws if w.isalpha())
    order = sorted(total, key=lambda w: (-total[w], w))[:6]
    counts = np.array([[ws.count(w) for w in order] for _, ws in data], dtype=float)
    keep = counts.sum(axis=1) > 0
    idf = np.log(len(data) / (counts > 0).sum(axis=0))
    tf = counts[keep] / counts[keep].sum(axis=1, keepdims=True)
    ids = [d for (d, _), k in zip(data, keep) if k]
    return ids, np.array([d.startswith("AU") for d in ids], dtype=float), tf, tf * idf, idf, order


def test_dictionary_order_and_size(docs, words):
    _, _, _, _, _, order = dense()
    assert [r.word for r in words.orderBy("pos").collect()] == order
    assert vocabulary.dictionary(docs, size=20000).count() == len(WORDS)


def test_vectors_match_dense(vectors, docs, words):
    ids, labels, tf, weights, idf, _ = dense()
    rows = vocabulary.tfidf_rows(docs, words, docs.count()).collect()
    assert len(rows) == docs.count() and {(r.doc_id, p): pytest.approx(v) for r in rows for p, v in zip(r.idx, r.val)} == {
        (r.doc_id, r.pos): r.tfidf for r in vectors.collect()
    }
    got = {(r.doc_id, r.pos): (r.tf, r.tfidf) for r in vectors.collect()}
    want = {(d, p): (tf[i, p], weights[i, p]) for i, d in enumerate(ids) for p in range(6) if tf[i, p] > 0}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value)
    sums = vectors.groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in sums) and len(sums) == len(ids)
    one, other = vocabulary.document_frequency(docs, words), vocabulary.frequency_from_counts(vectors)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_texts_are_not_shuffled(docs, words, spark):
    for df in (vocabulary.tfidf(docs, words, 9), vocabulary.term_counts(docs, words)):
        assert "hashpartitioning(doc_id" not in df._jdf.queryExecution().executedPlan().toString()


def test_counts_in_any_batches_and_without_hints(docs, words, spark):
    """A document's terms are its own row's: neither batches nor the order of rows nor join plans can change them."""
    changed = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "3", "spark.sql.optimizer.disableHints": "true",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    frames = lambda: [
        sorted(map(tuple, vocabulary.counted_terms(docs.coalesce(1), words).collect())),
        sorted((r.doc_id, r.pos, round(r.tfidf, 12)) for r in vocabulary.tfidf(docs, words, docs.count()).collect()),
        sorted((r.label, r.word, round(r.avg_tf, 12)) for r in vocabulary.average_frequency(docs, words, ["court", "gene"], "label").collect()),
    ]
    whole, before = frames(), {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        assert frames() == whole
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_term_rows_of_odd_texts(words, spark):
    texts = [None, "", "12 34", "court", "Court, COURT gene\u212a the thé", "law\x00law", "a" * 3000, "the " * 4000 + "law"]
    df = spark.createDataFrame([(k, t, [k]) for k, t in enumerate(texts)] + [(3, "law law", [9])], "doc_id int, text string, idx array<int>")
    place = {r.word: r.pos for r in words.collect()}
    found = vocabulary.term_rows(df.repartition(3), words).collect()
    got = sorted((r.doc_id, tuple(zip(r.idx, r.cnt)), r.total) for r in found)
    want = []
    for k, t in [*enumerate(texts), (3, "law law")]:
        held = Counter(place[w.lower()] for w in re.findall("[A-Za-z]+", t or "") if w.lower() in place)
        want.append((k, tuple(sorted(held.items())), sum(held.values())))
    assert got == sorted(want)
    assert vocabulary.term_rows(df.where("false"), words).collect() == []
    assert {r.doc_id for r in vocabulary.long_form(vocabulary.term_rows(df, words)).collect()} == {w[0] for w in want if w[2]}


@pytest.mark.parametrize("tokeniser", [tokens.explode_letters, tokens.explode_trimmed, tokens.explode_strict])
def test_words_as_rows_arrays_and_splits(spark, tokeniser):
    texts = [None, "", " ", "Dog; it's 3 birds", "é\u212a\u0130x Ab-cd  (ef) gh\n\tij", "ΣΑΣ don't ...x... <b>y</b> __z1 a b", "one  two\u2003three\x1cfour"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    per = {k: sorted(r.word for r in tokeniser(df).collect() if r.k == k) for k in range(len(texts))}
    arrays = {r.k: sorted(r.w or []) for r in df.select("k", tokeniser.words("text").alias("w")).collect()}
    assert arrays == per
    if tokeniser.split:
        whole = pa.array(["skipped", *texts])
        for column in (pa.array(texts), whole.slice(1), whole.slice(1).cast(pa.large_string())):
            assert [sorted(w for w in ws if w) for ws in tokeniser.split(column).to_pylist()] == list(per.values())
    counted = {r.word: r.cnt for r in vocabulary.word_count(df, tokeniser=tokeniser).collect()}
    assert counted == Counter(w for ws in per.values() for w in ws)


def test_too_large_a_dictionary_is_told(docs, words, monkeypatch):
    monkeypatch.setattr(vocabulary, "LARGEST_DICTIONARY", 5)
    with pytest.raises(ValueError, match="at most 5 words"):
        vocabulary.term_rows(docs, words)


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_votes_of_many_queries_match_votes_of_one(docs, spark, metric):
    asked = [(1, "Court, gene GENE; nothing"), (2, "court"), (3, "zzz"), (4, "gene and the court")]
    links = docs.select("doc_id", F.explode(F.array(F.lit("all"), F.substring("doc_id", 1, 1))).alias("category"))
    found = documents.vote_all(docs, links, spark.createDataFrame(asked, "query int, text string"), 4, metric, size=6).collect()
    for query, text in asked:
        one = {r.category: r.num for r in documents.vote(docs, links, text, 4, metric, size=6).collect()}
        many = {r.category: r.num for r in found if r.query == query}
        assert many == one or (query == 3 and not many)


def test_nearest_in_blocks_of_queries(docs, packed, spark, monkeypatch):
    weights = spark.createDataFrame([(q, q % 6, 1.0 + q) for q in range(7)] + [(2, 5, 0.5)], "query int, pos int, weight double")
    whole = sorted(map(tuple, neighbors.nearest(packed, weights, 3).collect()))
    for limits in ({"queries": 2}, {"words": 3}):
        assert sorted(map(tuple, neighbors.nearest(packed, weights, 3, **limits).collect())) == whole
    monkeypatch.setattr(neighbors, "_CELLS", 20)
    assert sorted(map(tuple, neighbors.nearest(packed, weights, 3).collect())) == whole
    assert len({r[0] for r in whole}) == 7
    vectors = {r.doc_id: dict(zip(r.idx, r.val)) for r in packed.collect() if r.idx}
    for q in range(7):
        asked = {r.pos: r.weight for r in weights.collect() if r["query"] == q}
        scores = sorted((-round(sum(w * v.get(p, 0) for p, w in asked.items()), 9), d) for d, v in vectors.items())[:3]
        assert [(r[1], pytest.approx(r[2])) for r in sorted(whole, key=lambda r: (r[0], -r[2], r[1])) if r[0] == q] == [(d, -s) for s, d in scores]
    assert neighbors.nearest(packed, weights.where("false"), 3).collect() == []


def test_votes_read_texts_twice_for_any_number_of_queries(docs, spark, monkeypatch):
    """Once for the dictionary, once for the terms; three blocks of queries go through stored rows."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    counted = docs.select("doc_id", "text").mapInArrow(seen, "doc_id string, text string")
    queries = spark.createDataFrame([(q, f"court gene {WORDS[q]}") for q in range(6)], "query int, text string")
    links = docs.select("doc_id", F.lit("all").alias("category"))
    blocks = []
    whole = neighbors._search
    monkeypatch.setattr(neighbors, "_search", lambda *more: blocks.append(1) or whole(*more))
    monkeypatch.setattr(neighbors.nearest, "__defaults__", ("doc_id", "dot", 2, 10**6))
    assert documents.vote_all(counted, links, queries, 4, size=6).count() == 6
    assert len(blocks) >= 2 and read.value == 2 * docs.count()


def test_average_frequency_per_class(docs, words):
    ids, labels, tf, _, _, order = dense()
    got = {(r.label, r.word): r.avg_tf for r in vocabulary.average_frequency(docs, words, ["court", "gene", "zebra"], "label").collect()}
    assert got[(0, "zebra")] == got[(1, "zebra")] == 0
    for word in ("court", "gene"):
        for label in (0, 1):
            column = tf[labels == label][:, order.index(word)] if word in order else np.zeros(1)
            assert got[(label, word)] == pytest.approx(column.mean())
    assert len(got) == 6
    assert documents.court_averages(docs, words).count() == 10


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_scores_match_dense(docs, words, vectors, metric):
    ids, _, _, weights, idf, order = dense()
    query = Counter(w for w in ["court", "gene", "gene", "nothing"] if w in order)
    q = np.array([query[w] / sum(query.values()) for w in order]) * idf
    want = weights @ q
    if metric == "cosine":
        want = want / (np.linalg.norm(weights, axis=1) * np.linalg.norm(q))
    frequency = vocabulary.document_frequency(docs, words)
    spec = neighbors.query_weights("Court, gene GENE; nothing", words, vocabulary.inverse_frequency(frequency, docs.count()))
    got = {r.doc_id: r.score for r in neighbors.score(vectors, spec, metric=metric).collect()}
    assert got.keys() == set(ids)
    assert [got[d] for d in ids] == pytest.approx(want)
    links = docs.select("doc_id", F.explode(F.array(F.lit("all"), F.substring("doc_id", 1, 1))).alias("category"))
    votes = neighbors.category_vote(neighbors.score(vectors, spec, metric=metric), links, 10).collect()
    assert sum(r.num for r in votes) == 10
    ranked = sorted(((-got[d], d, c) for d in ids for c in ("all", d[0])))[:10]
    assert {r.category: r.num for r in votes} == Counter(c for _, _, c in ranked)


def test_query_without_known_word_scores_zero(docs, words, vectors):
    idf = vocabulary.inverse_frequency(vocabulary.document_frequency(docs, words), docs.count())
    got = neighbors.score(vectors, neighbors.query_weights("zzz", words, idf), metric="cosine").collect()
    assert {r.score for r in got} == {0.0}


def plain_descent(x, y, rounds, tolerance, size, rate=0.1):
    w, before, losses = np.full(size, 0.01), None, []
    for i in range(rounds):
        z = x @ w
        loss = np.sum(np.log1p(np.exp(z)) - y * z) + np.sqrt(np.sum(w**2))
        step = rate * (x.T @ (1 / (1 + np.exp(-z)) - y))
        w = w - step
        losses.append(loss)
        if before is not None:
            rate *= 1.05 if loss < before else 0.5
        before = loss
        if i and np.linalg.norm(step) < tolerance:
            break
    return w, losses


@pytest.mark.parametrize("rounds, tolerance", [(25, 1e-4), (60, 0.05)])
def test_fit_matches_numpy(packed, rounds, tolerance, spark):
    _, labels, _, weights, _, _ = dense()
    model = logistic.fit(logistic.sparse_rows(packed, "label").repartition(3), 6, rounds=rounds, tolerance=tolerance)
    w, losses = plain_descent(weights, labels, rounds, tolerance, 6)
    assert len(model.trace) == len(losses)
    assert [t[1] for t in model.trace] == pytest.approx(losses, rel=1e-9)
    assert model.coefficients == pytest.approx(w, rel=1e-8)
    assert model.trace_frame(spark).count() == len(losses)


def test_fit_approaches_library_loss(packed, spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    _, labels, _, weights, _, _ = dense()
    rows = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(weights, labels)], ["label", "features"])
    best = LogisticRegression(regParam=1e-3, fitIntercept=False, standardization=False, maxIter=200).fit(rows)
    model = logistic.fit(
        logistic.sparse_rows(packed, "label"), 6, rate=5.0, rounds=200, tolerance=1e-6, l2=1e-3 * len(labels)
    )
    assert np.sign(model.coefficients).tolist() == np.sign(best.coefficients.toArray()).tolist()


def test_evaluation(spark, rows):
    scores = spark.createDataFrame([("a", 1, 2.0), ("b", 1, -1.0), ("c", 0, 0.0), ("d", 0, -3.0)], "doc_id string, label int, z double")
    predicted = logistic.predict(scores)
    counts = logistic.f1(logistic.confusion(predicted, "label")).first()
    assert (counts.tp, counts.tn, counts.fp, counts.fn) == (1, 1, 1, 1) and counts.f1 == 0.5
    pages = spark.createDataFrame([("c", "http://c"), ("d", "http://d")], "doc_id string, url string")
    assert rows(logistic.false_positives(predicted, pages, "label")) == [("c", "http://c")]
    loss = logistic.log_loss(scores, "label").first().loss
    assert loss == pytest.approx(sum(math.log1p(math.exp(z)) - y * z for y, z in ((1, 2), (1, -1), (0, 0), (0, -3))))
    none = logistic.predict(scores.where("z < -2"))
    assert logistic.f1(logistic.confusion(none, "label")).first().f1 is None


def test_classify_and_strongest_words(docs):
    train, test = docs.where("doc_id < 'AU2' or doc_id like 'W1%'"), docs.where("not (doc_id < 'AU2' or doc_id like 'W1%')")
    model, predicted = documents.classify(train, test, size=6, rounds=60, rate=1.0)
    counts = logistic.confusion(predicted, "label").first()
    assert sum(counts) == test.count(), "the document without words takes part"
    words = vocabulary.dictionary(docs, size=6)
    top = documents.strongest_words(model, words, 2).collect()
    assert top[0].coefficient >= top[1].coefficient == sorted(model.coefficients)[-2]


# --- mixture ---------------------------------------------------------------


def two_topics():
    rng = np.random.default_rng(5)
    lines = []
    for i in range(40):
        alphabet = ["aaa", "bbb", "ccc", "ddd", "eee"] if i % 2 else ["vvv", "www", "xxx", "yyy", "zzz"]
        text = " ".join(rng.choice(alphabet, size=30))
        lines.append(f'<doc id="20_newsgroups/topic{i % 2}/{i}" url="u" title="t">{text}</doc>')
    return lines + ['<doc id="20_newsgroups/topic0/empty" url="u" title="t">1 2 3</doc>']


@pytest.fixture(scope="module")
def post_frames(spark):
    lines = posts.posts(spark.createDataFrame([(x,) for x in two_topics()], "value string"))
    return lines.cache(), posts.post_dictionary(lines).cache()


def test_clusters_find_topics_for_any_partitioning(spark, post_frames):
    lines, words = post_frames
    seen = []
    for parts in (1, 4, 16):
        state, assigned = posts.cluster(lines.repartition(parts), words, 2, rounds=15, seed=3, size=words.count())
        seen.append({r.doc_id: r.cluster for r in assigned.collect()})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 41
    groups = {(d.split("/")[1], c) for d, c in seen[0].items() if "empty" not in d}
    assert len(groups) == 2
    state.check()
    tops = posts.cluster_words(state, words, 5).collect()
    assert len(tops) == 10
    assert {frozenset(r.word[0] for r in tops if r.cluster == j) for j in (0, 1)} == {frozenset("abcde"), frozenset("vwxyz")}
    shares = posts.cluster_categories(assigned, lines).collect()
    assert all(r.share > 0.9 for r in shares if r["rank"] == 1)


def test_posterior_matches_numpy(spark, post_frames):
    lines, words = post_frames
    size = words.count()
    state = mixture.initial_state(spark, 3, size, seed=1)
    log_pi, log_mu = state.logs()
    counts = vocabulary.long_form(posts.post_counts(lines, words)).select("doc_id", "pos", "cnt")
    weights = spark.createDataFrame([(j, p, float(log_mu[j, p])) for j in range(3) for p in range(size)], "cluster int, pos int, log_mu double")
    priors = spark.createDataFrame([(j, float(log_pi[j])) for j in range(3)], "cluster int, log_pi double")
    got = mixture.posterior(counts, weights, priors).collect()
    dense_counts = {}
    for r in counts.collect():
        dense_counts.setdefault(r.doc_id, np.zeros(size))[r.pos] = r.cnt
    for r in got:
        logs = log_mu @ dense_counts[r.doc_id] + log_pi
        p = np.exp(logs - logs.max())
        assert r.p == pytest.approx((p / p.sum())[r.cluster], abs=1e-12)


def test_empty_cluster_draws_from_the_prior(spark, post_frames):
    lines, words = post_frames
    state, _ = posts.cluster(lines, words, 30, rounds=2, seed=1, size=words.count())
    state.check()
    assert state.mu.shape == (30, words.count())
    bad = mixture.MixtureState(np.array([0.5, 0.6]), np.ones((2, 3)) / 3, 0)
    with pytest.raises(ValueError):
        bad.check()
    assert np.isfinite(mixture.MixtureState(np.array([1.0]), np.array([[1.0, 0.0]]), 0).logs()[1]).all()


@pytest.mark.parametrize("shape", [0.1, 1.0, 7.5])
def test_log_gammas_have_mean_and_variance_of_the_shape(shape):
    size = 20000
    drawn = np.exp(mixture.log_gammas(np.full(size, shape), np.zeros(size, int), np.arange(size), 3, 1))
    assert abs(drawn.mean() - shape) < 5 * np.sqrt(shape / size) and drawn.var() == pytest.approx(shape, rel=0.1)


def test_weights_do_not_depend_on_blocks(spark, monkeypatch):
    counted = spark.createDataFrame([(0, -1, 3), (1, 4, 2), (1, 4, 5), (2, 0, 1)], "cluster int, pos int, n bigint")
    states = []
    for block in (1 << 15, 4):
        monkeypatch.setattr(mixture, "BLOCK", block)
        states.append(mixture._state_of(mixture.draw_weights(spark, counted, 3, 5, 0.1, 0.1, 9, 2), 3, 5, 9, 2))
    assert np.array_equal(states[0].pi, states[1].pi) and np.array_equal(states[0].mu, states[1].mu)
    states[0].check()
    assert states[0].mu[1].argmax() == 4 and states[0].pi.argmax() == 0


def test_weights_of_no_words_and_of_too_many(spark):
    assert mixture.initial_state(spark, 3, 0).mu.shape == (3, 0)
    with pytest.raises(ValueError, match="at most"):
        mixture.initial_state(spark, 1000, 1_000_000)


def test_uniform_is_spread_and_fixed(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"))
    values = [r.u for r in df.select(mixture.uniform(1, 2).alias("u")).collect()]
    assert min(values) >= 0 and max(values) < 1 and abs(np.mean(values) - 0.5) < 0.03
    assert values != [r.u for r in df.select(mixture.uniform(1, 3).alias("u")).collect()]


def test_post_map(spark, post_frames):
    lines, words = post_frames
    row = posts.post_map(lines, words, "20_newsgroups/topic1/1").first()
    assert sum(row.counts.values()) == 30
    assert posts.post_map(lines, words, "20_newsgroups/topic0/empty").first().counts == {}
    assert set(posts.post_map(lines, words, "20_newsgroups/topic1/1", below=3).first().counts) <= {0, 1, 2}
