"""What the encoder leaves in a worker process goes when the set join's tasks get that process."""

from __future__ import annotations

import weakref

import public_tokenizers
import pyarrow as pa
from areascore.llm import bpe, set_join


def test_sets_do_not_stand_beside_an_encoder():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    encoder = bpe.shared_encoder(definition)
    want = encoder.coded(["some words", "and others"])
    assert bpe.shared_encoder(definition) is encoder
    left = weakref.ref(encoder)
    del encoder
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two three four five"])], names=["id", "text"])
    assert [len(s) for _, sets in set_join._sets(iter([batch]), 4) for s in sets] == [2]
    assert left() is None
    assert bpe.shared_encoder(definition).coded(["some words", "and others"]) == want
