"""Quality, toxicity, language and language-model scores against plain versions and held-out rows."""

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkkit.llm import language, lm, quality, toxicity
from sparkkit.llm.common import fold
from sparkkit.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def middle(spark):
    from pathlib import Path

    if not Path(MIDDLE).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


def crc(doc_id, folds=5):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % folds


def test_folds(spark):
    df = spark.createDataFrame([(k,) for k in (0, 7, 123456789, -4, None)], "doc_id long")
    assert [r.f for r in df.select(fold("doc_id").alias("f")).collect()] == [crc(k) for k in (0, 7, 123456789, -4, None)]


# --- quality -----------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    places = defaultdict(list)
    for k in range(len(words) - 2):
        places[tuple(words[k : k + 3])].append(k)
    repeated = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
        "n_exclamations": text.count("!"), "n_stops": len(re.findall(r"[.!?]", text)),
    }


@pytest.mark.parametrize("name", ["odd_docs", "middle"])
def test_measures(request, name):
    docs = request.getfixturevalue(name)
    expected = sorted((repr(r.doc_id), sorted(plain_measures(r.text).items())) for r in docs.collect())
    names = sorted(plain_measures(""))
    found = sorted((repr(r.doc_id), [(n, r[n]) for n in names]) for r in quality.measured(docs).collect())
    assert found == expected


def plain_em(votes):
    """Dawid-Skene with abstentions on rows of votes; the posterior of each row."""
    prior, good, bad = 0.7, np.full(votes.shape[1], 0.999), np.full(votes.shape[1], 0.3)
    for _ in range(41):
        z = math.log(prior / (1 - prior)) + np.where(votes == 1, np.log(good / (1 - bad)), np.where(votes == -1, np.log((1 - good) / bad), 0)).sum(1)
        p = 1 / (1 + np.exp(-z))
        before = np.concatenate([[prior], good, bad])
        prior = (p.sum() + 1) / (len(p) + 2)
        right = [np.minimum(((w[:, None] * (votes == s)).sum(0) + 1) / ((w[:, None] * (votes != 0)).sum(0) + 2), 0.999) for w, s in ((p, 1), (1 - p, -1))]
        good, bad = right
        if abs(before - np.concatenate([[prior], good, bad])).max() < 1e-4:
            break
    return lambda v: 1 / (1 + np.exp(-(math.log(prior / (1 - prior)) + np.where(v == 1, np.log(good / (1 - bad)), np.where(v == -1, np.log((1 - good) / bad), 0)).sum(1))))


def test_posteriors(middle):
    rows = quality.assess(middle).collect()
    names = [f"vote_{r.name}" for r in quality.RULES]
    votes = np.array([[r[n] for n in names] for r in rows])
    failed = np.array([r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words for r in rows])
    assert failed.tolist() == [r.base_failed for r in rows]
    posterior = plain_em(votes[~failed])(votes)
    assert np.allclose(posterior, [r.posterior for r in rows], atol=1e-6)
    assert [r.kept for r in rows] == (~failed & (posterior >= 0.5)).tolist()


def test_clean_documents_stay_and_junk_goes(spark, middle):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    found = quality.assess(middle).join(labels, "doc_id").filter("NOT base_failed").collect()
    good = [r.kept for r in found if r.quality == 1]
    bad = [r.kept for r in found if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_of_odd_and_no_texts(odd_docs, no_docs):
    rows = quality.assess(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality.assess(no_docs).collect() == []


def test_quality_runs_no_python(middle, capsys):
    quality.measured(middle).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- toxicity ----------------------------------------------------------------


def test_folding():
    assert toxicity.fold_text("1d10t, іdіоt​!") == "  idiot  idiot  ".replace("  idiot  idiot  ", " idiot  idiot  ")


def test_all_distinct_entries_are_found(spark):
    words = [f" {a}{b}{c} " for a in "abcdef" for b in "mnoprs" for c in "tuvwx"]
    docs = spark.createDataFrame([(1, " ".join(w.strip() for w in words))], "doc_id long, text string")
    row = toxicity.score(docs, toxicity.Lexicon(dict.fromkeys(words, 1.0))).first()
    assert len(words) > 100 and row.found == sorted(words)


def test_matches_and_exceptions():
    lexicon = toxicity.Lexicon({" scum ": 3.0, " lowe": 2.0}, (" pond scum ",))
    automaton, covers = lexicon.automaton(), frozenset(lexicon.exceptions)

    def found(text):
        return [(e, w) for _, _, w, e in toxicity.matches(toxicity.fold_text(text), automaton, covers)]

    assert found("You 5CUM.") == [(" scum ", 3.0)]
    assert found("pond scum") == []
    assert found("pond scum and scum") == [(" scum ", 3.0)]
    assert found("Loweihr scums") == [(" lowe", 2.0)]
    assert toxicity.matches(" a ", toxicity.Lexicon().automaton(), frozenset()) == []


def test_automaton_finds_what_search_finds(spark, middle):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").filter(fold("doc_id") != 0)
    lexicon = toxicity.fit(toxicity.sample_labelled(middle, labels))
    assert lexicon.weights
    automaton, covers = lexicon.automaton(), frozenset(lexicon.exceptions)
    for r in middle.limit(200).collect():
        folded = toxicity.fold_text(r.text)
        spans = [(m.start(), m.start() + len(e) - 1) for e in covers for m in re.finditer(f"(?={re.escape(e)})", folded)]
        best = {}
        for e, w in lexicon.weights.items():
            if e not in covers:
                for m in re.finditer(f"(?={re.escape(e)})", folded):
                    best[m.start()] = max(best.get(m.start(), (0, 0)), (w, m.start() + len(e) - 1))
        expected = sorted(at for at, (_, end) in best.items() if not any(a <= at and end <= b for a, b in spans))
        assert sorted(m[0] for m in toxicity.matches(folded, automaton, covers)) == expected


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = QUERIES["op4_toxicity"](spark, MIDDLE).join(labels, "doc_id").filter("held_out").collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)


def test_toxicity_of_odd_and_no_texts(spark, odd_docs, no_docs):
    lexicon = toxicity.Lexicon({" word ": 3.0})
    rows = toxicity.score(odd_docs, lexicon, more=("text", "ids")).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert Counter(r.text for r in rows) == Counter(r.text for r in odd_docs.collect())
    assert toxicity.score(no_docs, lexicon).collect() == []
    nothing = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert toxicity.fit(nothing).weights == {}


# --- language ----------------------------------------------------------------


def plain_language(text, model):
    sums, n = [0.0] * len(model.languages), 0
    for chunk in re.findall(WORD, text or ""):
        letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in chunk.lower())
        for word in letters.split():
            n += 1
            sums = [a + b for a, b in zip(sums, language.word_score(word, model))]
    if not n:
        return "und", 0.0
    best = max(range(len(sums)), key=lambda k: (sums[k], -k))
    return model.languages[best], 1 / sum(math.exp(s - sums[best]) for s in sums)


def test_languages(middle, odd_docs, no_docs):
    model = language.fit(middle.filter(fold("doc_id") != 0))
    found = sorted(((repr(r.doc_id), r.lang_pred, round(r.score, 9)) for r in language.identify(middle, model).collect()))
    expected = sorted((repr(r.doc_id), *(lambda p: (p[0], round(p[1], 9)))(plain_language(r.text, model))) for r in middle.collect())
    assert [x[:2] for x in found] == [x[:2] for x in expected]
    assert all(abs(a[2] - b[2]) < 1e-6 for a, b in zip(found, expected))
    lang = {repr(r.doc_id): r.lang for r in middle.collect()}
    held = [(lang[i], p) for i, p, _ in found if crc(int(i)) == 0]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert {r.lang_pred for r in language.identify(odd_docs.filter("text is null or text in ('', ' ', '\n')"), model).collect()} == {"und"}
    assert language.identify(no_docs, model).collect() == []
    empty = language.fit(no_docs)
    assert {(r.lang_pred, r.score) for r in language.identify(odd_docs, empty).collect()} == {("und", 0.0)}


def test_numbers_are_no_letters(spark):
    texts = ["½", "² ①", "Ⅷ ⅔", "12 ½ _ ٣", "ªb", "ʰ", "x²"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    model = language.Model(["a"], {}, [{}] * 5, (-1.0,))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    assert [found[k] for k in range(4)] == [("und", 0.0)] * 4 and {found[k][0] for k in (4, 5, 6)} == {"a"}


def test_a_rare_language_is_learned(spark):
    """One row in two thousand, far below the sample's share of the others."""
    rows = [(k, "the house and the garden are green", "en") for k in range(4000)] + [(9000 + k, "zxo qui zxa mumu zxi", "rare") for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(df, docs_per_language=50, words_per_language=4, grams_per_language=6)
    assert model.languages == ["en", "rare"] and {"zxa", "mumu", "the", "and"} <= set(model.words) and len(model.words) == 8
    asked = spark.createDataFrame([(1, "mumu zxa"), (2, "green garden")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language.identify(asked, model).collect()} == {1: "rare", 2: "en"}


def test_scorer_drops_the_older_half():
    model = language.Model(["a", "b"], {f"w{'x' * k}": (-1.0 * k, -2.0) for k in range(40)}, [{}] * 5, (-9.0, -9.0))
    small, large = language.Scorer(model, most=10), language.Scorer(model)
    for k in range(0, 40, 3):
        texts = pa.array([" ".join(f"w{'x' * x}" for x in range(k, k + 4)), None, "w"])
        assert (small.sums(texts) == large.sums(texts)).all() and len(small.place) <= 10


def test_backoff_goes_to_shorter_grams():
    model = language.Model(["a", "b"], {"known": (-1.0, -2.0)}, [{"x": (-3.0, -4.0)}, {"xy": (-5.0, -6.0)}, {}, {}, {}], (-9.0, -9.0))
    assert language.word_score("known", model) == (-1.0, -2.0)
    assert language.word_score("xyx", model) == tuple(np.add.reduce([(-9.0, -9.0), (-5.0, -6.0), (-9.0, -9.0), (-3.0, -4.0), (-9.0, -9.0)]) / 5)


# --- language model ----------------------------------------------------------


def tokens_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def test_lm_learns_from_context_and_is_better_than_the_base(middle):
    held_out = fold("doc_id") == 1
    model = lm.fit_words(middle.filter(~held_out), fold("doc_id", 25) < 5)
    row = lm.score_words(middle.filter(held_out), model).agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert row.score > row.base


def expected_scores(rows, train, weights):
    """Brute force over true word pairs."""
    kept = [r for r in rows if train(r)]
    words = Counter(w for r in kept for w in tokens_of(r.text))
    pairs = Counter(p for r in kept for p in zip([None, *tokens_of(r.text)], tokens_of(r.text)))
    total = sum(words.values())
    floor = total + 0.5 * (len(words) + 1)
    out = []
    for r in rows:
        toks, base, score = tokens_of(r.text), 0.0, 0.0
        for v, w in zip([None, *toks], toks):
            l2, l1, l0 = weights[int(math.log2(words[v] + 1))]
            base += math.log10((words[w] + 0.5) / floor)
            score += math.log10(l2 * pairs[v, w] / max(1, words[v]) + l1 * words[w] / total + l0 * (words[w] + 0.5) / floor)
        out.append((repr(r.doc_id), len(toks), sum(words[w] > 0 for w in toks), total, base, score))
    return sorted(out)


def expected_weights(rows, deleted, rounds=60):
    kept, left = [r for r in rows if not deleted(r)], [r for r in rows if deleted(r)]
    words = Counter(w for r in kept for w in tokens_of(r.text))
    pairs = Counter(p for r in kept for p in zip([None, *tokens_of(r.text)], tokens_of(r.text)))
    total = sum(words.values())
    models = {}
    for (v, w), n in Counter(p for r in left for p in zip([None, *tokens_of(r.text)], tokens_of(r.text))).items():
        p = (pairs[v, w] / max(1, words[v]), words[w] / total, (words[w] + 0.5) / (total + 0.5 * (len(words) + 1)))
        models.setdefault(int(math.log2(words[v] + 1)), []).append((n, p))
    out = {}
    for b, met in models.items():
        n, p = np.array([m[0] for m in met]), np.array([m[1] for m in met]).T
        prior = np.array([0.1 * (b > 0), 0.1, 0.1])
        weights = np.where(prior > 0, 1, 0) / np.count_nonzero(prior)
        for _ in range(rounds):
            shares = weights[:, None] * p
            gathered = (n * shares / shares.sum(0)).sum(1) + prior
            weights = gathered / gathered.sum()
        weights = np.where(prior > 0, np.maximum(weights, 1e-4), 0)
        out[b] = weights / weights.sum()
    return out


@pytest.mark.parametrize("head_words", [131_072, 50])
def test_true_word_pairs(middle, odd_docs, head_words):
    docs = middle.select("doc_id", "text").limit(300).unionByName(odd_docs.select((F.col("doc_id") + 10**6).alias("doc_id"), "text")).cache()
    held_out = fold("doc_id") == 1
    model = lm.fit_words(docs.filter(~held_out), fold("doc_id", 25) < 5, head_words)
    rows = docs.collect()
    told = {r.doc_id: r.out for r in docs.select("doc_id", (fold("doc_id", 25) < 5).alias("out")).collect()}
    weights = expected_weights([r for r in rows if crc(r.doc_id) != 1], lambda r: told[r.doc_id])
    for b, w in weights.items():
        assert np.allclose(model.weights[b], w, atol=1e-6)
    expected = expected_scores(rows, lambda r: crc(r.doc_id) != 1, model.weights)
    found = sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score_words(docs, model).collect())
    for a, b in zip(found, expected, strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * max(1, -b[4]) and abs(a[5] - b[5]) < 1e-6 * max(1, -b[5])


def test_rare_words_have_pairs_of_their_own(spark):
    """Two rare words of equal length, each always followed by its own word."""
    common = " ".join(f"w{k} w{k}" for k in range(600))
    texts = [common, common] + ["qqa zza", "qqb zzb"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000, "qqa zza"), (1001, "qqa zzb")], "doc_id long, text string")
    model = lm.fit_words(docs.filter("doc_id < 1000"), fold("doc_id", 25) < 5)
    rows = {r.doc_id: r.score for r in lm.score_words(docs, model).collect()}
    assert rows[1000] > rows[1001] + 0.5


def test_word_pairs_on_no_rows(no_docs, odd_docs):
    model = lm.fit_words(no_docs, F.lit(False))
    assert model.tokens == 0 and lm.score_words(no_docs, model).collect() == []
    assert all(math.isfinite(r.score) and r.n_known == 0 for r in lm.score_words(odd_docs, model).collect())


def test_no_row_per_pair_is_shuffled(middle):
    """Pairs reach an exchange packed, a row for each bucket that a unit of texts asks."""
    docs = middle.limit(100).cache()
    scores = lm.score_words(docs, lm.fit_words(docs, fold("doc_id") == 0))
    keys = set(re.findall(r"hashpartitioning\((\w+)#", scores._jdf.queryExecution().executedPlan().toString()))
    assert keys == {"bucket", "unit"} and scores.count() == 100


@pytest.mark.parametrize("head_words", [131_072, 50])
def test_units_and_buckets_change_no_score(middle, odd_docs, head_words):
    docs = middle.select("doc_id", "text").limit(60).unionByName(odd_docs.select("doc_id", "text")).repartition(2).cache()
    frames = []
    for gathered, size in ((lm.UNIT, lm.BUCKET_BYTES), (1000, 5000)):
        model = lm.fit_words(docs.filter(fold("doc_id") != 1), fold("doc_id", 25) < 5, head_words, gathered, size)
        assert (model.buckets > 5) == (size == 5000)
        frames.append((model.weights, sorted(map(tuple, lm.score_words(docs, model, gathered).collect()), key=repr)))
    (weights, rows), (other_weights, other_rows) = frames
    assert np.allclose(weights, other_weights, atol=1e-9)
    for a, b in zip(rows, other_rows, strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-9)


@pytest.mark.parametrize("size", [1, 2, 50, 1500])
def test_keys_tell_pairs_apart_and_fill_buckets(size):
    head = lm.Head(np.arange(size, dtype=np.uint64), np.zeros(size, np.int64), np.zeros(size, np.int64))
    v, w = (x.ravel() for x in np.meshgrid(np.arange(size), np.arange(size)))
    keys = np.sort(head.keys(v, w))
    assert len(np.unique(keys)) == size * size and keys[-1] < lm._PAIR
    buckets = head.buckets(keys, 7)
    assert (np.diff(buckets) >= 0).all() and buckets[-1] < 7
    if size == 1500:
        assert np.bincount(buckets).max() < 2 * size * size / 7
    assert (lm.unpack_keys(lm.pack_keys(keys)) == keys).all()
    hashed = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64) | lm._PAIR)
    counts = [np.bincount(head.buckets(hashed[hashed >> np.uint64(62) == top], 7), minlength=7) for top in (2, 3)]
    assert min(map(min, counts)) > 30 and (lm.unpack_keys(lm.pack_keys(hashed)) == hashed).all()
    assert lm.unpack(lm.pack(np.zeros(0, np.int64))).tolist() == [] and lm.unpack(lm.pack(np.array([-1, 2**40]))).tolist() == [-1, 2**40]


def test_language_looks_for_a_stretch_once():
    """The scores are those of a plain search at every position; n-grams of a stretch that was met before are not looked up again."""
    grams = [{x: (-1.0 - k, -2.0) for k, x in enumerate("abc|")}, {"ab": (-0.1, -0.3)}, {}, {"abca": (-0.7, -0.2)}, {}]
    model = language.Model(["x", "y"], {"abc": (-9.0, -8.0)}, grams, (-16.0, -16.0))
    scorer = language.Scorer(model)
    found = scorer.sums(pa.array(["abcabcabc zab", "abc abcabcabca", None]))
    met = dict(scorer.longest)
    again = scorer.sums(pa.array(["bcabcabc zab", "abcabcabcab"]))
    assert len(scorer.longest) - len(met) < 8 and len(met) < 20

    def plain(word):
        marked, total = f"|{word}|", np.zeros(2)
        for at in range(len(marked)):
            pieces = [marked[at : at + n] for n in range(5, 0, -1) if at + n <= len(marked)]
            total += next((g[p] for p in pieces for g in [grams[len(p) - 1]] if p in g), model.floor)
        return total / len(marked)

    want = [plain("abcabcabc") + plain("zab"), np.array([-9.0, -8.0]) + plain("abcabcabca"), np.zeros(2)]
    assert np.allclose(found[:, :-1], want) and np.allclose(again[:, :-1], [plain("bcabcabc") + plain("zab"), plain("abcabcabcab")])
    small = language.Longest(model, most=2)
    words = ["abcabcabc", "abc", "zab", ""]
    scores = language.word_scores(words, model, small)
    assert np.allclose(scores, [language.word_score(w, model) for w in words]) and np.allclose(scores[0], plain("abcabcabc")) and len(small) <= 2
    assert language.Scorer(language.Model([], {}, [{}] * 5, ())).sums(pa.array(["ab c1d", "1"])).tolist() == [[3.0], [0.0]]
