"""Pieces of words in the encoder: each is encoded once while it is kept."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

from areascore.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_of_new_words_are_looked_up(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        coder = bpe.TextEncoder(file.read())
    asked, plain = [], coder.words.encode_words
    monkeypatch.setattr(coder.words, "encode_words", lambda words: plain(asked.append(set(words)) or asked[-1]))
    texts = ["harbour lights", "Harbour, lights!", "(harbour) lights, lights!", "élan \x01 \x7fharbour 'll Ünder日本 12³"]
    library = Tokenizer.from_file(PATH)
    for text in texts:
        ((ids, decoded),) = coder.coded([text])
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == b"".join(i.to_bytes(4, "little") for i in expected)
        assert decoded == library.decode(expected, skip_special_tokens=False)
    assert asked[:3] == [{"harbour", "lights"}, {",", "!"}, {"(", ")"}]
    assert "harbour" not in asked[3]
