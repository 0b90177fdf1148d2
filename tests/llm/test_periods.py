"""Runs of words against a plain version that compares every word with those at every distance."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sparkkit.llm import periods
from sparkkit.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_runs(words, min_length=6, min_exponent=4):
    out, n = [], len(words)
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            size = j + p - i
            if j > i and size >= max(min_length, min_exponent * p):
                if not any(all(words[x] == words[x + q] for x in range(i, i + size - q)) for q in range(1, p)):
                    out.append((i, size, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(text, *limits):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words, *limits)
    gone = {i for start, size, p in runs for i in range(start + p, start + size)}
    return words, runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(seed, n, longest=60):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        size, letters = draw.randint(0, longest), draw.randint(1, 3)
        words = [draw.randrange(letters) for _ in range(size)]
        if size and draw.random() < 0.6:
            a = draw.randrange(size)
            p = 1 + (size - a) // draw.randint(3, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        out.append(words)
    return out


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 3), (1, 5)])
def test_runs_of_many_texts_at_once(limits):
    draw = random.Random(sum(limits))
    texts = some_texts(limits[0], 2000)
    while texts:
        block, texts = texts[: (m := draw.randint(1, 9))], texts[m:]
        offsets = np.cumsum([0, *map(len, block)])
        found = [[] for _ in block]
        for t, *run in zip(*periods.runs_of(np.array([x for t in block for x in t], np.int64), offsets, *limits)):
            found[t].append(tuple(run))
        assert found == [plain_runs(t, *limits) for t in block], block


def test_fibonacci_and_equal_words():
    """Texts with runs within runs, and one where every border holds one suffix."""
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    for words in (b, b * 3, [5] * 700, [5] * 9 + [6] + [5] * 9, ([1] * 8 + [2]) * 6):
        got = periods.runs_of(np.array(words, np.int64), np.array([0, len(words)]), 2, 2)
        assert list(zip(*(x.tolist() for x in got[1:]))) == plain_runs(words, 2, 2)


def test_look_ups_in_parts(monkeypatch):
    monkeypatch.setattr(periods, "LOOK_UPS", 7)
    for words in some_texts(8, 60, 200):
        got = periods.runs_of(np.array(words, np.int64), np.array([0, len(words)]))
        assert list(zip(*(x.tolist() for x in got[1:]))) == plain_runs(words)


def test_ranks_tell_shared_words():
    words = np.array([0, 1, 0, 1, 0, 2, 0, 1, 0])
    ranks = periods.suffix_ranks(words, np.full(9, 9), 9)
    share = lambda a, b: int(periods.common_words(ranks, np.array([a]), np.array([b]), np.array([9]), np.array([9]))[0])
    before = lambda a, b: int(periods.words_before(ranks, np.array([a]), np.array([b]), np.array([0]))[0])
    for a in range(9):
        for b in range(a + 1, 9):
            want = next((k for k in range(9 - b) if words[a + k] != words[b + k]), 9 - b)
            assert share(a, b) == want
            assert before(a, b) == next((k for k in range(a) if words[a - 1 - k] != words[b - 1 - k]), a)


def check(df, *limits):
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.collapse(df, *limits).collect()), key=repr)
    want = []
    for r in df.collect():
        words, runs, text = plain_collapse(r.text, *limits)
        want.append((r.doc_id, len(words), runs, text))
    assert found == sorted(want, key=repr)


def test_odd_texts(odd_docs):
    check(odd_docs.where("length(text) < 6000 OR text IS NULL"))


def test_a_long_text_with_a_long_period(spark):
    """40,000 words, two in turn; and a passage of 700 words six times over: brute force in closed form."""
    passage = " ".join(f"w{k * k % 701}x{k}" for k in range(700))
    df = spark.createDataFrame([(1, "la le " * 20_000), (2, "start " + (passage + "\n") * 6 + "end"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in periods.collapse(df).collect()}
    assert [tuple(r) for r in found[1].runs] == [(0, 40_000, 2)] and found[1].collapsed == "la le"
    assert [tuple(r) for r in found[2].runs] == [(1, 4200, 700)] and found[2].collapsed == f"start {passage} end"
    assert found[3].runs == [] and found[3].collapsed == "" and found[3].n_words == 0


def test_no_rows(no_docs):
    assert periods.collapse(no_docs).collect() == []


def test_min_exponent_of_one_is_told(no_docs):
    with pytest.raises(ValueError):
        periods.collapse(no_docs, 6, 1)


def plain_query(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    _, runs, text = plain_collapse(" ".join(words))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_query_as_in_plain_python(spark, tmp_path):
    """The registered query over short whole texts, with planted stretches among them."""
    draw = random.Random(4)
    rows = [(k, " ".join(f"w{x}" for x in words) if words else draw.choice([None, "", " \n"])) for k, words in enumerate(some_texts(9, 400, 120))]
    rows += [(12, rows[12][1]), (399, "extra row")]
    spark.createDataFrame([(i, t, 5, "z") for i, t in rows], "doc_id long, text string, runs int, best string").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op12_runs"](spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = [tuple(r) for r in df.collect()]
    assert sorted(found, key=repr) == sorted((plain_query(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in found) > 50


def test_query_on_test_table(spark, small):
    """The planted stretches of real texts, those short enough for the plain version."""
    want = {r.doc_id: plain_query(r.doc_id, r.text) for r in small.collect() if len(r.text or "") < 3000}
    found = {r.doc_id: tuple(r) for r in QUERIES["op12_runs"](spark, SMALL).collect()}
    assert len(found) == small.count() and {k: found[k] for k in want} == want
