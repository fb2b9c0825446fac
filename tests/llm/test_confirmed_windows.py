"""Confirming candidates of the decontamination: what all windows together lack, no window has."""

from __future__ import annotations

import numpy as np

from areascore.llm import decontaminate as dec

ITEM = dec.item_of(7, "alpha beta gamma delta epsilon zeta eta theta iota kappa")


def _confirmed(monkeypatch, text):
    read = []
    plain = dec.Cut.words
    monkeypatch.setattr(dec.Cut, "words", lambda self, low, high: read.append((low, high)) or plain(self, low, high))
    search = dec.Search([ITEM], np.ones(dec.FEATURES), np.random.default_rng(1).standard_normal((dec.FEATURES, 4)))
    cut = dec.Cut([text])
    return search._confirmed(cut, 0, 0, [(0.9 - k / 100, 5 * k, 10) for k in range(8)]), read


def test_windows_without_the_words_are_read_once(monkeypatch):
    leak, read = _confirmed(monkeypatch, "alpha beta " + "other " * 80)
    assert leak is None and len(read) == 1


def test_leak_in_one_window(monkeypatch):
    leak, _ = _confirmed(monkeypatch, "other " * 20 + " ".join(w.decode() for w in ITEM.words) + " other" * 40)
    assert leak["item_id"] == 7 and leak["common"] == 10 and leak["start"] <= 20 and leak["end"] >= 30


def test_document_frequency_counts_a_word_once_a_text(spark):
    texts = ["a a b", "a c", None, "", "b b b a"] * 30
    seen, n = dec.document_frequency(spark.createDataFrame([(t,) for t in texts], "text string"))
    column = {w: int(dec.Cut([w]).columns[0]) for w in "abc"}
    assert n == 150 and [int(seen[column[w]]) for w in "abc"] == [90, 60, 30] and seen.sum() == 180
