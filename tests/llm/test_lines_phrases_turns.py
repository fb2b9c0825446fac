"""Line removal, collocations and conversation repair against brute force: nulls, empty and long texts, ties, repeated
rows, empty tables, clashing columns; their data structures on their own."""

from __future__ import annotations

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from areascore.llm import collocations, conversation_repair, line_dedup, perfect_hash
from areascore.llm.hat_trie import HatTrie, summed
from areascore.llm.queries import QUERIES, _damaged


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- lines ---------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, n_lines string, kept string, block string, lang string, gone string"


@pytest.fixture(scope="module")
def lined():
    rnd = random.Random(5)
    lines = ["Common line", "  common LINE\t", "É only", "é only", "ß", "x", "", "   ", "rare", *(f"own {k}" for k in range(40))]
    texts = ["\n".join(rnd.choice(lines) for _ in range(rnd.randrange(1, 9))) for _ in range(80)]
    texts += [None, "", "\n", "\r\n\x0b\x0c", "very long " * 20_000, "\n".join(["x"] * 5000), "end\n", "a\x00b"]
    rows = [(k, t, "n", "k", "b", "en", "g") for k, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (3, "Common line\nother", None, None, None, None, None), (None, "x\ny", *5 * [None]), (None, "rare", *5 * [None])]


def kept_lines(rows, least, shortest):
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    key = lambda line: lowered(line.strip(strip))
    found = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    gone = {k for k, n in found.items() if n >= least and len(k) >= shortest}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        left = [x for x in lines if key(x) not in gone]
        out.append((r[0], len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "shortest"), [(10, 1), (2, 1), (5, 3), (3, 0)])
def test_shared_lines_go(spark, lined, least, shortest):
    docs = spark.createDataFrame(lined, DOCS).repartition(3)
    cut = line_dedup.drop_shared_lines(docs, least, shortest)
    assert cut.columns == ["doc_id", "text", "block", "lang", "gone", "n_lines", "n_dropped", "kept"]
    got = [tuple(r) for r in cut.select("doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=repr) == kept_lines(lined, least, shortest)


def test_no_rows_no_lines(spark):
    assert line_dedup.drop_shared_lines(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="two documents"):
        line_dedup.drop_shared_lines(spark.createDataFrame([], DOCS), least=1)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    rnd = np.random.default_rng(n)
    keys, prints = rnd.integers(0, 1 << 63, (2, n + 1000)).astype(np.uint64)
    keys[: n // 2] = keys[0] if n else 0  # equal keys are told apart by their fingerprints
    counts = np.arange(2, n + 2)
    shard = perfect_hash.Shard(*perfect_hash.build(keys[:n], prints[:n], counts))
    assert (shard.counts_of(keys[:n], prints[:n]) == counts).all()
    assert len(shard.prints) == n and not shard.counts_of(keys[n:], prints[n:]).any()


# --- phrases -------------------------------------------------------------------------------------


def phrases_by_hand(rows, least, top):
    total, found = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                found.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {g: n for g, n in found.items() if n >= least}
    inside = collections.Counter()
    for (lang, p), n in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], n)
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) > 1 and 100 * inside[lang, p] < 80 * a:
            cuts = ((2_000_000 * a // (found[lang, p[:k]] + found[lang, p[k:]]), k) for k in range(1, len(p)))
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), found[lang, p[:k]], found[lang, p[k:]]))
    rows = []
    for lang, each in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(each)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


@pytest.fixture(scope="module")
def spoken():
    rnd = random.Random(6)
    bag = ["the", "The", "of", "été", "Été", "x\x00y", "stone", "age", "*", " ", "ice"]
    rows = [(" ".join(rnd.choice(bag) + rnd.choice(["", "", "", ".", "\n", "\t", "\r"]) for _ in range(rnd.randrange(60))), lang) for lang in ("en", "fr", None, "und", "") for _ in range(30)]
    rows += [("One two three four five " * 40, "en"), ("same same same same " * 2000, "fr"), (None, "en"), ("", None), ("a b" * 3, None)]
    return rows + rows[:9] + [rows[2]] * 20


@pytest.mark.parametrize(("least", "top"), [(30, 2000), (5, 7), (2, None)])
def test_collocations(spark, spoken, least, top):
    docs = spark.createDataFrame(spoken, "text string, lang string").withColumns({"w1": F.lit("w"), "n": F.lit("n"), "rank": F.lit(1)}).repartition(4)
    got = collocations.mine(docs, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(spoken, least, top)


def test_no_rows_no_phrases(spark):
    assert collocations.mine(spark.createDataFrame([], "text string, lang string")).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_trie_bursts_spills_and_keeps_counts(width):
    rnd = np.random.default_rng(width)
    words = rnd.integers(2, 1 << 63, 300).astype(np.uint64)
    keys = words[np.minimum(rnd.geometric(0.02, (40_000, width)), 299)]
    keys[: 20_000, 0] = words[0]  # one word begins half of all phrases
    trie, runs = HatTrie(width, burst=8, budget=3000), []
    for part in np.array_split(keys, 20):
        runs += trie.add(part)
    spilled = len(runs)
    assert any(isinstance(node, dict) for node in trie.root.values())
    runs += trie.rest()
    assert 0 < spilled < len(runs) and all((np.diff(path.astype(object)) >= 0).all() for path, _, _ in runs)
    got = summed(np.concatenate([k for _, k, _ in runs]), np.concatenate([c for _, _, c in runs]))
    want = summed(keys, np.ones(len(keys), np.int64))
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


# --- conversations -------------------------------------------------------------------------------


def cheapest(turns):
    """Least (cost, audit) of a conversation's (role, text, fault), and its repaired lines, by trying every edit."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @functools.lru_cache(None)
    def best(i, last, inserts):
        options = [(0, "", ())] if i == len(turns) and last in ("", "a") else []
        if inserts < 3:
            new = "a" if last == "u" else "u"
            cost, audit, lines = best(i, new, inserts + 1)
            options.append((cost + 2, "I" + audit, (names[new] + ":", *lines)))
        if i < len(turns):
            role, text, fault = turns[i]
            cost, audit, lines = best(i + 1, last, 0)
            options.append((cost + 3, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[0] in follows[last]:
                    cost, audit, lines = best(i + 1, role[0], 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                new = "a" if last == "u" else "u"
                cost, audit, lines = best(i + 1, new, 0)
                options.append((cost + 2 + more, "R" + audit, (f"{names[new]}:{text}", *lines)))
        return min(options) if options else (10**9, "", ())

    for i in range(len(turns), -1, -1):  # from the back, so that no call goes deep
        for last in follows:
            best(i, last, 0)
    return best(0, "", 0)


def repaired_by_hand(rows, damage=True):
    known = collections.OrderedDict()
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        mine = known.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, mine in known.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, turns = set(), []
        for _, role, text in mine:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        first = [r[:1] for r, _, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit, lines = cheapest(tuple(turns))
        faults = collections.Counter(f for _, _, f in turns)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "", "User"]
    texts = ["Yes.", "No!", "cut off", " ", "", "\x0b\x0c", "fine?\n", "é. ", "x"]
    rows = []
    for conv in range(150):
        for turn in range(rnd.randrange(1, 9)):
            role = rnd.choices(roles, [8, 8, 3, 1, 1, 1])[0]
            rows.append((conv, turn + 3 * (rnd.random() < 0.1), role, rnd.choice(texts) if rnd.random() < 0.5 else f"Say {rnd.random()}."))
    # One text a number, so that the order is given: the turn, then the role.
    rows = list({r[:3]: r for r in rows}.values())
    rows += [(200, None, "user", "Hi."), (200, 4, None, None), (200, 1, "assistant", None), (None, 0, "user", "Null."), (None, None, "assistant", "Id.")]
    rows += [(201, 0, "user", "Twice."), (201, 0, "user", "Twice."), (201, 0, "user", "Twice."), (202, None, None, None)]
    return rows + [(203, k, "assistant" if k % 3 else "user", "Same." if k % 2 else "w" * 50_000) for k in range(40)]


TURNS = "conv_id long, turn long, role string, text string"


def test_conversation_repair(spark, talks, tmp_path):
    spark.createDataFrame(talks, TURNS).withColumns({"conv": F.lit(1), "audit": F.lit("a"), "times": F.lit(0)}).repartition(4).write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    got = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == repaired_by_hand(talks)


def test_repaired_turns_are_what_the_digest_is_of(spark, talks):
    rows, times = _damaged(spark.createDataFrame(talks, TURNS))
    lines = collections.defaultdict(list)
    for r in sorted(conversation_repair.repaired_turns(rows, times=times).collect(), key=lambda r: r["place"]):
        lines[r["conv"]].append(f"{r['role']}:{r['text']}")
    for conv, want in repaired_by_hand(talks).items():
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == want[-1]


def test_a_conversation_of_many_ranges_and_long_runs(spark):
    rows = [(1, k, "user" if k < 900 or k % 2 else "assistant", f"Text {k // 2}." if k % 5 else "same") for k in range(1200)] + [(2, 0, "user", "Hi.")]
    shuffled = spark.createDataFrame(rows, TURNS).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(shuffled).collect()}
    assert got == repaired_by_hand(rows, damage=False)


def test_powers_of_runs_are_repeated_steps():
    solver = conversation_repair.Repair()
    for symbol in range(16):
        after = conversation_repair.END
        for count in range(1, 40):
            after = solver.before(symbol, 1, after)
            assert solver.before(symbol, count, conversation_repair.END) == after
    assert solver.solve([(4, 10**5)])[0] > 0 and solver.before(4, 10**12, conversation_repair.END)[0] == 10**12


def test_no_rows_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_repair.repair(empty).count() == 0 and conversation_repair.repaired_turns(empty).count() == 0
    gone = conversation_repair.repair(spark.createDataFrame([(1, 0, "user", "Hi.")], TURNS), times=F.lit(0)).first()
    assert tuple(gone) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
