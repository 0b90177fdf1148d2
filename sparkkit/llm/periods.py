"""Runs (maximal repetitions) of words, found by an enhanced suffix array and the branching tandem test.

A square of two equal halves of p words is branching at its place i if the words after both halves differ, so that the
suffixes at i and i + p have exactly p words in common. They then lie on both sides of a border of an LCP interval of depth
p, and every run of period p ends in exactly one such square. For every border the suffixes of the smaller side are
looked up at i + p and i - p through the inverse suffix array; what lies on the other side gives a branching square. Rotating
it to the left as far as the period holds gives its run. No tree is built.

All texts of a block are handled in one array: words of different texts never compare equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sparkkit.llm.common import slices, split_words, texts_of

#: Suffixes looked up at once.
LOOK_UPS = 1 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _dense(sorted_keys: np.ndarray) -> np.ndarray:
    """For sorted keys the place where each one's group begins."""
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_ranks(words: np.ndarray, ends: np.ndarray, depth: int) -> list[np.ndarray]:
    """``ranks[l][i]``: the place of the first 2^l words of the suffix at i among those of all suffixes, equal for equal words.

    ``ends[i]`` is where the text of word i ends. Only suffixes that still share their words with another are sorted again,
    and none beyond twice ``depth`` words.
    """
    order = np.argsort(words, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = _dense(words[order])
    ranks, length = [rank], 1
    size = np.bincount(rank, minlength=len(words))
    open_ = order[size[rank[order]] > 1]
    while len(open_) and length <= depth:
        second = open_ + length
        inside = second < ends[open_]
        follow = np.where(inside, rank[np.minimum(second, len(words) - 1)] + 1, 0)
        key = rank[open_] * (len(words) + 1) + follow
        at = np.argsort(key, kind="stable")
        open_, key = open_[at], key[at]
        group, first = _dense(rank[open_]), _dense(key)
        rank = rank.copy()
        rank[open_] += first - group
        ranks.append(rank)
        length *= 2
        last = np.concatenate([key[1:] != key[:-1], [True]])
        alone = last & np.concatenate([[True], last[:-1]])
        open_ = open_[~alone]
    return ranks


def common_words(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` share, as far as the ranks tell."""
    shared = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y, step = a + shared, b + shared, 1 << level
        fits = (x + step <= ends_a) & (y + step <= ends_b)
        at = np.flatnonzero(fits)
        same = at[ranks[level][x[at]] == ranks[level][y[at]]]
        shared[same] += step
    return shared


def words_before(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many words before ``a`` equal those before ``b`` > ``a``, within the text that begins at ``begins``."""
    shared = np.zeros(len(a), np.int64)
    pending = np.arange(len(a))
    top = len(ranks) - 1
    while len(pending):  # the highest level again, as long as it holds for any
        at = pending[a[pending] - shared[pending] - (1 << top) >= begins[pending]]
        back = shared[at] + (1 << top)
        pending = at[ranks[top][a[at] - back] == ranks[top][b[at] - back]]
        shared[pending] += 1 << top
    for level in range(top - 1, -1, -1):
        at = np.flatnonzero(a - shared - (1 << level) >= begins)
        back = shared[at] + (1 << level)
        same = at[ranks[level][a[at] - back] == ranks[level][b[at] - back]]
        shared[same] += 1 << level
    return shared


def _sides(lcp: np.ndarray, borders: np.ndarray, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each border k between suffixes k - 1 and k: the first suffix of the left side, which reaches as far as values stay at least
    ``lcp[k]``, and the end of the right side, which reaches as far as they stay above it."""
    least = [lcp]
    while (1 << len(least)) <= widest:
        half, before = 1 << (len(least) - 1), least[-1]
        if len(before) <= half:
            break
        least.append(np.minimum(before[:-half], before[half:]))
    value = lcp[borders]
    left, right = borders.copy(), borders + 1
    for level in range(len(least) - 1, -1, -1):
        step, row = 1 << level, least[level]
        to = left - step
        left = np.where((to >= 0) & (row[np.maximum(to, 0)] >= value), to, left)
        fits = right + step <= len(lcp)
        right = np.where(fits & (row[np.minimum(right, len(row) - 1)] > value), right + step, right)
    return left - 1, right


def branching_squares(ranks: list[np.ndarray], begins: np.ndarray, ends: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and half lengths of all branching squares whose text is at least ``exponent`` halves long."""
    place = np.argsort(ranks[-1], kind="stable")  # the suffix array; suffixes equal beyond the depth stand in any order
    inverse = np.empty(len(place), np.int64)
    inverse[place] = np.arange(len(place))
    lcp = np.zeros(len(place), np.int64)
    near = 1 + np.flatnonzero(ranks[0][place[1:]] == ranks[0][place[:-1]])
    if not len(near):
        return near, near
    a, b = place[near - 1], place[near]
    lcp[near] = common_words(ranks, a, b, ends[a], ends[b])
    borders = near[lcp[near] * exponent <= (ends - begins)[place[near]]]
    left, right = _sides(lcp, borders, int((ends - begins).max()))
    small_left = borders - left <= right - borders
    first, last = np.where(small_left, left, borders), np.where(small_left, borders, right)
    from_, to = np.where(small_left, borders, left), np.where(small_left, right, borders)
    squares, halves = [], []
    cuts = np.concatenate([[0], np.cumsum(last - first)])
    k = 0
    while k < len(borders):
        stop = max(k + 1, int(np.searchsorted(cuts, cuts[k] + LOOK_UPS, "right")) - 1)
        width = (last - first)[k:stop]
        of = np.repeat(np.arange(k, stop), width)
        i = place[np.repeat(first[k:stop] - (cuts[k:stop] - cuts[k]), width) + np.arange(cuts[stop] - cuts[k])]
        depth = lcp[borders[of]]
        for partner, begin in ((i + depth, i), (i - depth, i - depth)):
            ok = (partner >= begins[i]) & (partner < ends[i])
            at = inverse[np.where(ok, partner, 0)]
            ok &= (at >= from_[of]) & (at < to[of])
            squares.append(begin[ok])
            halves.append(depth[ok])
        k = stop
    return np.concatenate(squares), np.concatenate(halves)


def runs_of(words: np.ndarray, offsets: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, length, period`` of all runs with ``length >= max(min_length, min_exponent * period)``, by text, start and period.

    ``words`` are the codes of the words of all texts, text t those from ``offsets[t]`` to ``offsets[t + 1]``. ``min_exponent`` is 2 or more.
    """
    lengths = np.diff(offsets)
    none = np.zeros(0, np.int64)
    longest = int(lengths.max(initial=0))
    if longest < max(min_length, min_exponent):
        return none, none, none, none
    text = np.repeat(np.arange(len(lengths)), lengths)
    begins, ends = offsets[:-1][text], offsets[1:][text]
    ranks = suffix_ranks(text * (int(words.max()) + 1) + words, ends, longest // min_exponent)
    square, period = branching_squares(ranks, begins, ends, min_exponent)
    # a run of enough halves goes on to the left of its last square: drop the others before measuring
    able = (square - (min_exponent - 2) * period >= begins[square]) if len(square) else np.zeros(0, bool)
    square, period = square[able], period[able]
    start = square - words_before(ranks, square, square + period, begins[square])
    end = square + 2 * period
    long_enough = end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[long_enough], end[long_enough], period[long_enough]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # a run is also found with multiples of its period, at the same place: the smallest stays
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[fresh], end[fresh], period[fresh]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return text[start], start - begins[start], end - start, period


def _find(min_length: int, min_exponent: int):
    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, table, offsets = split_words(batch.column("text"))
        offsets = np.asarray(offsets, np.int64)
        codes = np.asarray(codes, np.int64)
        of, start, length, period = runs_of(codes, offsets, min_length, min_exponent)
        begin = np.searchsorted(of, np.arange(len(batch) + 1))
        runs = pa.ListArray.from_arrays(
            pa.array(begin, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(_RUN))
        )
        inside = np.zeros(len(codes) + 1, np.int64)
        np.add.at(inside, offsets[of] + start + period, 1)
        np.add.at(inside, offsets[of] + start + length, -1)
        kept = np.cumsum(inside)[:-1] == 0
        ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
        words = pa.array(table, pa.string()).take(pa.array(codes[kept])) if len(codes) else pa.array([], pa.string())
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), " ")
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            yield block(piece)

    return run


def collapse(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    ``runs``: ``start`` (number of the first word), ``length`` and ``period`` in words of every stretch with smallest period p of at
    least ``max(min_length, min_exponent * p)`` words that no neighbouring word extends, by start, then period. ``collapsed``: the words that
    no run holds after its first p words, joined by one space.

    Words are what stands between white space. Null, empty and blank texts have no words, no runs (an empty list) and an empty ``collapsed``; a
    null doc_id stays null; repeated rows come out as often as they came in; other columns are left out. Texts are handled
    whole, about two megabytes of them at once in a task (or one text if it is longer), and nothing is shuffled.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    schema = "doc_id bigint, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string"
    return texts_of(docs).mapInArrow(_find(min_length, min_exponent), schema)
