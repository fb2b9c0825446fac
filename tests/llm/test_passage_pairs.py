"""Shared passages of a pair of documents: several of them, in and out of order, and under repeated phrases."""

from __future__ import annotations

import itertools
import random

import pytest
from areascore.llm import passage_chain


def covered(found, pair, side):
    """Word positions of one document that lie in passages of the pair."""
    start, end = ("start", "end") if side == 0 else ("other_start", "other_end")
    return {k for r in found if (r.doc_id, r.other_id) == pair for k in range(r[start], r[end])}


@pytest.fixture
def fresh():
    number = itertools.count()
    return lambda k: [f"w{next(number)}" for _ in range(k)]


def test_two_passages_at_several_distances(spark, fresh):
    rows, want = [], []
    for n, (size, gap) in enumerate([(60, 10), (60, 60), (60, 100), (100, 100), (200, 250), (60, 400)]):
        a, b = fresh(size), fresh(size)
        rows += [(2 * n, " ".join(fresh(9) + a + fresh(gap) + b + fresh(7))), (2 * n + 1, " ".join(a + fresh(gap) + b))]
        want.append(((2 * n + 1, 2 * n), size, gap))
    found = passage_chain.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for pair, size, gap in want:
        assert {*range(size), *range(size + gap, 2 * size + gap)} <= covered(found, pair, 0), (size, gap)
        assert {*range(9, 9 + size), *range(9 + size + gap, 9 + 2 * size + gap)} <= covered(found, pair, 1), (size, gap)
    for r in found:
        assert min(r.end - r.start, r.other_end - r.other_start) >= 50
        assert r.matched_words >= 0.8 * max(r.end - r.start, r.other_end - r.other_start)


def test_pieces_against_every_choice(fresh):
    """Matched words of the stretches chosen, against all choices of stretches between places that differ."""
    rnd = random.Random(6)
    for _ in range(150):
        shared = [fresh(rnd.choice([8, 20, 30, 45, 60])) for _ in range(rnd.randrange(2, 6))]
        one, two, chain, runs = [], [], [], []
        for part in shared:
            gap = rnd.choice([2, 5, 10, 25, 60])
            one, two = one + fresh(gap), two + fresh(gap + rnd.choice([0, 3]))
            runs.append((len(one), len(two), len(part)))
            chain += [(len(one) + k, len(two) + k) for k in [*range(0, len(part) - 5, 4), len(part) - 5]]
            one, two = one + part, two + part
        good = {}
        for i, j in itertools.combinations_with_replacement(range(len(runs)), 2):
            sizes = [runs[j][s] + runs[j][2] - runs[i][s] for s in (0, 1)]
            matched = sum(r[2] for r in runs[i : j + 1])
            if min(sizes) >= 50 and matched >= 0.8 * max(sizes):
                good[i, j] = matched
        best = [0] * (len(runs) + 1)
        for j in range(len(runs)):
            best[j + 1] = max([best[j], *(best[i] + m for (i, k), m in good.items() if k == j)])
        found = passage_chain.pieces(chain, one, two)
        assert sum(p[4] for p, _ in found) == best[-1]
        for (a, b, c, d, matched), _ in found:
            assert min(b - a, d - c) >= 50 and matched == passage_chain.common_words(one[a:b], two[c:d]) >= 0.8 * max(b - a, d - c)


def test_repeated_phrase_does_not_end_a_pair(spark, fresh):
    """A phrase of the long passage that occurs again makes chains of one match before the passage out of order."""
    rows, want = [], []
    for n in range(8):
        long, phrase, other = fresh(300), fresh(12), fresh(60)
        rows.append((2 * n, " ".join(other + fresh(300) + long + phrase + fresh(20) + phrase)))
        rows.append((2 * n + 1, " ".join(long + phrase + fresh(400) + other)))
        want.append((2 * n + 1, 2 * n))
    found = passage_chain.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for pair in want:
        assert {*range(312), *range(712, 772)} <= covered(found, pair, 0)
        assert {*range(60), *range(360, 672)} <= covered(found, pair, 1)


def test_words_of_many_texts_as_places():
    from areascore.llm import decontaminate

    many = ["", "One, two;THREE", "  ", "é étéİ x", "a" * 3000, "...", "one two one"]
    cut = decontaminate.Cut(many)
    want = [decontaminate.words_of(t) for t in many]
    assert cut.sizes.tolist() == [len(w) for w in want]
    assert [cut.words(a, b) for a, b in zip(cut.begins, cut.ends)] == want
    flat = [w for words in want for w in words]
    assert len(set(cut.hashes.tolist())) == len(set(flat)) and len(set(zip(cut.hashes.tolist(), flat))) == len(set(flat))
    assert decontaminate.Cut([]).ends.tolist() == decontaminate.Cut([]).columns.tolist() == []
