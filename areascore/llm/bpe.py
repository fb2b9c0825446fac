"""BPE encoding by a walk over the trie of distinct words, and decoding.

The distinct words of a batch, in sorted order, are their trie in depth-first order: a word shares the states
of the prefix it has in common with the word before it. The state of a prefix is the last token of its
encoding. A token can end a prefix when it encodes to itself and either starts the word or follows the last
token of the prefix before it; two tokens can follow one another when their joined symbols encode to just
these two. Merges never cross a boundary that both sides keep, so exactly one token qualifies per prefix,
and following the states back gives the encoding of the word.

Normalising and splitting a text with characters beyond U+017F is left to the tokenizer file's own rules.
Tokenizers with a normaliser of NFC, white space and lower case, this split pattern and a word-end suffix are
supported. Defined results: a null or empty text has no ids; rows are independent.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from areascore.llm.batches import chunks, texts, worker_store

#: Distinct words, and distinct pieces of them, whose ids and decoded text a worker process keeps; beyond it the older half goes.
KEPT_WORDS = 150_000
#: Bytes of text encoded in one walk.
WALK_BYTES = 1 << 19
LONG_WORD = 200
END = "</w>"
NEVER = 1 << 60
#: First character of a word that is already split; a private character, so such texts take that way themselves.
MARK = "\ue000"

# Letters, numbers and white space up to U+017F, and the contractions of the split pattern.
LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}{SPACES}]+")
# Texts that need no more than lower-casing; a blank and a control that count as space elsewhere are left out.
SIMPLE = re.compile("[\u0000-\u001b\u0020-įı-ſ]*")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(free)
            free += 1
    return [letters[b] for b in range(256)]


class WordEncoder:
    """Ids of words from vocabulary and merges."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        self.vocab, self.letters = vocab, byte_letters()
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.names = {i: t for t, i in vocab.items()}
        self.open, self.closed = {}, {}  # every end of a token's name without and with a word end: the token, or None
        for name, token in vocab.items():
            if name != END:
                body = name.removesuffix(END)
                tails = self.open if body == name else self.closed
                for k in range(1, len(body)):
                    tails.setdefault(body[k:], None)
                tails[body] = token
        self._joins: dict[tuple[int, int], bool] = {}
        self._ends: dict[int, tuple[list, list] | None] = {}

    def symbols(self, token: int) -> list[int]:
        name = self.names[token]
        body = name.removesuffix(END) if name != END else name
        ids = [self.vocab[c] for c in body]
        if len(body) < len(name):
            ids[-1] = self.vocab[body[-1] + END]
        return ids

    def merged(self, ids: list[int]) -> tuple[list[int], list[tuple[int, int]], list[tuple[int, int]]]:
        """Plain merging, best rank first; what stood at the left and right end, each with the rank that took it."""
        left, right = [], []
        while len(ids) > 1:
            rank, new, at = min(self.rank.get(p, (NEVER, 0)) + (k,) for k, p in enumerate(zip(ids, ids[1:])))
            if rank == NEVER:
                break
            if at == 0:
                left.append((ids[0], rank))
            if at == len(ids) - 2:
                right.append((ids[-1], rank))
            ids = [*ids[:at], new, *ids[at + 2 :]]
        return ids, [*left, (ids[0], NEVER)], [*right, (ids[-1], NEVER)]

    def ends(self, token: int) -> tuple[list, list] | None:
        """How the two ends of a token's symbols are merged; None if they do not encode to the token."""
        if token not in self._ends:
            ids, left, right = self.merged(self.symbols(token))
            self._ends[token] = (left, right) if ids == [token] else None
        return self._ends[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge joins the two while both sides grow; of equal pairs the left one goes first."""
        known = self._joins.get((left, right))
        if known is None:
            known, rank = True, self.rank
            for y, y_gone in self.ends(right)[0]:
                for x, x_gone in self.ends(left)[1]:
                    pair = rank.get((x, y))
                    if pair and pair[0] < x_gone and pair[0] <= y_gone:
                        known = False
            self._joins[left, right] = known
        return known

    def _last(self, word: str, depth: int, states: list[tuple[int, int]], tails: dict[str, int | None]) -> tuple[int, int]:
        """The token that ends ``word[:depth]``, and where it starts; ``tails`` are those of tokens that may stand there."""
        joins, ends, found = self._joins, self._ends, []
        for start in range(depth - 1, -1, -1):
            token = tails.get(word[start:depth], NEVER)
            if token == NEVER:  # no token is as long
                break
            if token is not None:
                found.append((token, start))
        for token, start in reversed(found):
            if (ends[token] if token in ends else self.ends(token)) is None:
                continue
            if start == 0:
                return token, start
            before = states[start - 1]
            if before is None:
                before = states[start - 1] = self._last(word, start, states, self.open)
            pair = before[0], token
            if joins[pair] if pair in joins else self.may_follow(*pair):
                return token, start
        raise ValueError(f"no token ends {word[:depth]!r}")

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each distinct word; words are letters that stand for bytes.

        The state of a prefix is found when a word first asks for it, and kept for the words that share it.
        """
        before, out = "", {}
        states: list[tuple[int, int] | None] = []
        for word in sorted(words):
            body = word[:-1]
            shared, least = 0, min(len(before), len(body))
            while shared < least and before[shared] == body[shared]:
                shared += 1
            del states[shared:]
            states += [None] * (len(body) - shared)
            if len(body) > LONG_WORD:  # from the front, so that no question goes deep
                for depth in range(1, len(word)):
                    states[depth - 1] = states[depth - 1] or self._last(word, depth, states, self.open)
            before = body
            token, start = self._last(word, len(word), states, self.closed)
            ids = [token]
            while start:
                state = states[start - 1]
                if state is None:
                    state = states[start - 1] = self._last(word, start, states, self.open)
                token, start = state
                ids.append(token)
            ids.reverse()
            out[word] = ids
        return out


class TextEncoder:
    """Ids of whole texts and texts of ids, for a tokenizer file's content."""

    def __init__(self, definition: str) -> None:
        parts = json.loads(definition)
        model = parts["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or parts["decoder"]:
            raise ValueError("not a BPE model with word ends")
        self.words = WordEncoder(model["vocab"], model["merges"])
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.names = self.words.names | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.definition, self.library = definition, None
        self.known: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.pieces: dict[str, tuple[bytes, str]] = {}
        self.packed = {i: i.to_bytes(4, "little") for i in self.words.names}

    def _words(self, text: str) -> list[str]:
        """Runs without white space; the words of a text of another script carry a mark and stand for bytes."""
        if SIMPLE.fullmatch(text):
            return text.lower().split()
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.definition)
        plain = self.library.normalizer.normalize_str(text)
        return [MARK + p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def _pieces(self, word: str) -> list[str]:
        """The words of the model in a run, as letters that stand for bytes."""
        if word[0] == MARK:
            return [word[1:]]
        if word.isascii() and word.isprintable():  # such letters stand for themselves
            return [word] if word.isalpha() else PIECE.findall(word)
        letters = self.words.letters
        return ["".join([letters[b] for b in piece.encode()]) for piece in PIECE.findall(word)]

    def encode(self, many: list[str]) -> list[bytes]:
        return [ids for ids, _ in self.coded(many)]

    def coded(self, many: list[str]) -> list[tuple[bytes, str]]:
        """Little-endian 32-bit ids of each text, and these decoded. New words of all texts are encoded in one walk."""
        known, shown, coded = self.known, self.shown, self.pieces
        if len(known) > KEPT_WORDS:  # the older half goes
            for word in list(islice(known, len(known) // 2)):
                del known[word], shown[word]
        if len(coded) > KEPT_WORDS:
            for piece in list(islice(coded, len(coded) // 2)):
                del coded[piece]
        split, seen = [], set()
        for text in many:
            parts = []
            for run in self.cut.split(text) if self.cut and "<|" in text else [text]:
                if run in self.special:
                    parts.append(([], run))
                elif run:
                    words = self._words(run)
                    seen.update(words)
                    parts.append((words, None))
            split.append(parts)
        pieces = {w: self._pieces(w) for w in seen.difference(known)}
        names, packed = self.names, self.packed
        for piece, ids in self.words.encode_words({p for each in pieces.values() for p in each if p not in coded}).items():
            coded[piece] = b"".join([packed[i] for i in ids]), " ".join([names[i] for i in ids])
        for word, each in pieces.items():
            if len(each) == 1:
                known[word], shown[word] = coded[each[0]]
            else:
                known[word] = b"".join([coded[p][0] for p in each])
                shown[word] = " ".join([coded[p][1] for p in each])
        out = []
        for parts in split:
            ids = [b"".join(map(known.__getitem__, words)) if run is None else np.array([self.special[run]], "<u4").tobytes() for words, run in parts]
            # A word without ids is nowhere in the decoded text.
            text = [" ".join(filter(None, map(shown.__getitem__, words))) if run is None else run for words, run in parts]
            out.append((b"".join(ids), " ".join(filter(None, text))))
        return out

    def decode(self, packed: bytes) -> str:
        """Tokens joined by a blank: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def shared_encoder(definition: str) -> TextEncoder:
    """One encoder per worker process: tasks that follow one another keep its states, until another operator's tasks come."""
    store = worker_store("bpe")
    if store.get("definition") != definition:
        store.update(definition=definition, encoder=TextEncoder(definition))
    return store["encoder"]


def encode_texts(df: DataFrame, path: str, text: str = "text", decode: bool = True) -> DataFrame:
    """Add ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``.

    ``path`` is read once on the driver; the tasks get its content. Columns of these names are replaced.
    """
    with open(path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    added = {"n_tokens": T.LongType(), "ids": T.BinaryType()} | ({"decoded": T.StringType()} if decode else {})
    df = df.drop(*(c for c in added if c != text))
    schema = T.StructType(df.schema.fields + [T.StructField(n, k) for n, k in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_encoder(shared.value)
        for batch in chunks(batches, text, WALK_BYTES):
            coded = coder.coded(texts(batch, text))
            ids = pa.array([ids for ids, _ in coded], pa.binary())
            columns = [*batch.columns, pa.array([len(ids) // 4 for ids, _ in coded], pa.int64()), ids]
            if decode:
                columns.append(pa.array([decoded for _, decoded in coded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        # The process stays for other tasks, and while stages without Python run.
        del coder
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
