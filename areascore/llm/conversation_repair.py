"""Cheapest repair of the role structure of conversations, with an audit of the edits.

Every turn becomes a symbol of role initial and fault; equal symbols in a row become one run. A run of k symbols
acts on the four states of the grammar ``(s?(ua)+)?`` as the k-th min-plus power of its symbol's transition,
which is put together from cached powers of two. Costs to the end are known at every run boundary after one walk
from the back; one walk from the front then unrolls the choices, run by run, taking the least letter that
keeps the cost.

What moves: symbols are built from texts by column functions; equal turns are counted before any shuffle; turns are
sorted by ranges of (conversation, turn), so that a conversation with a third of all rows is spread over tasks, and
leave them as runs of eight bytes. The runs of a conversation meet in one task: they are no more than the letters of
its audit, which is one cell. Texts meet their audit sorted and are streamed row by row, so that a task holds one
batch and one audit; the digest of a whole conversation can only be taken in its order.

Defined results: null roles and texts are one space; null conversation ids are one conversation. Turns are taken by
number, nulls first, equal numbers by role and then by a hash of the text; of equal rows one is the first, the
others are duplicates. A conversation whose rows all have ``times`` 0, like an empty one, has zeros, an empty
audit and the digest of the empty string. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areascore.sources.storage import stage

INITIALS = "sua"  # any other initial has the number 3
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
#: Where an inserted or reroled turn leads, and where a kept one does by its initial.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
LEGAL = {(0, 1), (1, 2), (2, 1)}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Vector = tuple[int, int, int, int]


def _edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """What may be done with a turn in a state, in the order of the letters: letter, cost, state after it."""
    initial, fault = divmod(symbol, 4)
    yield "D", DELETE_COST, state
    if fault < BLANK:
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if KEPT[state][initial] is not None:
            yield "K", KEEP_COST + more, KEPT[state][initial]
        yield "R", ROLE_COST + more, NEXT[state]


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(3):
        costs = [min(c, INSERT_COST + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


END: Vector = _with_inserts([0, FAR, FAR, 0])


def _product(left: list[Vector], right: list[Vector]) -> list[Vector]:
    return [tuple(min(row[k] + right[k][p] for k in range(4)) for p in range(4)) for row in left]


def _applied(matrix: list[Vector], costs: Vector) -> Vector:
    return tuple(min(m + c for m, c in zip(row, costs)) for row in matrix)


class Repair:
    """Costs and audits of runs of symbols; transitions, their powers and choices are kept between calls."""

    def __init__(self) -> None:
        self.powers: dict[tuple[int, int], list[Vector]] = {}
        self.steps: dict[tuple[int, Vector], tuple[Vector, Vector]] = {}
        self.choices: dict[tuple[int, Vector, int], tuple[str, int]] = {}

    def power(self, symbol: int, exponent: int) -> list[Vector]:
        """The transition of 2 to the ``exponent`` turns of one symbol: cost from state to state."""
        known = self.powers.get((symbol, exponent))
        if known is None:
            if exponent:
                half = self.power(symbol, exponent - 1)
                known = _product(half, half)
            else:
                columns = []
                for target in range(4):
                    goal = [0 if q == target else FAR for q in range(4)]
                    columns.append(_with_inserts([min(c + goal[q] for _, c, q in _edits(symbol, s)) for s in range(4)]))
                known = [tuple(min(col[s], FAR) for col in columns) for s in range(4)]
            self.powers[symbol, exponent] = known
        return known

    def before(self, symbol: int, count: int, after: Vector) -> Vector:
        """Costs to the end before a run, from those after it."""
        exponent = 0
        while count:
            if count & 1:
                after = _applied(self.power(symbol, exponent), after)
            count >>= 1
            exponent += 1
        return after

    def _unrolled(self, symbol: int, count: int, after: Vector, state: int, out: list[str]) -> int:
        """The letters of a run, appended; the state behind it. Vectors are kept as differences, so they recur."""
        behind, steps = [tuple(c - after[0] for c in after)], self.steps
        for _ in range(count):
            key = symbol, behind[-1]
            if key not in steps:
                costs = self.before(symbol, 1, behind[-1])
                steps[key] = costs, tuple(c - costs[0] for c in costs)
            behind.append(steps[key][1])
        for at in range(count - 1, -1, -1):
            key = symbol, behind[at], state
            if key not in self.choices:
                self.choices[key] = self._choice(*key)
            letters, state = self.choices[key]
            out.append(letters)
        return state

    def _choice(self, symbol: int, after: Vector, state: int) -> tuple[str, int]:
        here, letters = self.before(symbol, 1, after), ""
        while True:
            fits = [(letter, q) for letter, cost, q in _edits(symbol, state) if cost + after[q] == here[state]]
            insert = INSERT_COST + here[NEXT[state]] == here[state]
            if insert and not (fits and fits[0][0] < "I"):
                letters, state = letters + "I", NEXT[state]
            else:
                return letters + fits[0][0], fits[0][1]

    def solve(self, runs: list[tuple[int, int]]) -> tuple[int, str]:
        """Least cost and the least audit of that cost, for runs of (symbol, count)."""
        after = [END]
        for symbol, count in reversed(runs):
            after.append(self.before(symbol, count, after[-1]))
        total, out, state = after.pop()[START], [], START
        for symbol, count in runs:
            state = self._unrolled(symbol, count, after.pop(), state, out)
        while END[state]:
            out.append("I")
            state = NEXT[state]
        return total, "".join(out)


def _ordered(names: Iterable[str] = ("turn", "role", "d1", "d2")) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, times: Column | None) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"),
        (F.lit(1) if times is None else times).cast("long").alias("times"),
    )
    return rows.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per distinct turn with how often it occurs, its initial and its fault, duplicates found."""
    last = F.regexp_extract("text", r"([^ \t-\r])[ \t-\r]*\z", 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), OK).otherwise(TRUNCATED)
    initial = reduce(lambda c, k: c.when(F.substring("role", 1, 1) == INITIALS[k], k), range(3), F.when(F.lit(False), 0)).otherwise(3)
    marked = rows.select("conv", "turn", "role", "d1", "d2", "times", fault.alias("fault"), initial.alias("initial"))
    counted = stage(
        marked.groupBy("conv", "turn", "role", "d1", "d2", "fault", "initial").agg(F.sum("times").alias("times")), "turns"
    )
    # Within one role and text, turns differ by number only.
    same = ("conv", "role", "d1", "d2")
    firsts = counted.where(f"times > 0 AND fault <> {BLANK}").groupBy(*same).agg(
        F.bool_or(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first"), F.count(F.lit(1)).alias("n")
    )
    repeated = stage(firsts.where("n > 1").drop("n").withColumnRenamed("conv", "_conv"), "repeated")
    joined = counted.join(repeated, [F.col("conv").eqNullSafe(F.col("_conv")), *(counted[c] == repeated[c] for c in same[1:])], "left")
    later = F.col("turn").isNotNull() & (F.col("null_first") | (F.col("turn") > F.col("first")))
    fault = F.when((F.col("fault") != BLANK) & F.coalesce(later, F.lit(False)), DUPLICATE).otherwise(F.col("fault"))
    return joined.select("conv", "turn", counted.role, counted.d1, counted.d2, (F.col("initial") * 4 + fault).alias("symbol"), "times")


def _boundaries(column: pa.Array) -> np.ndarray:
    """Where another value begins, the first place included; nulls are equal."""
    if len(column) < 2:
        return np.arange(len(column))
    now, before = column[1:], column[:-1]
    differ = pc.fill_null(pc.not_equal(now, before), False)
    odd = pc.not_equal(pc.is_null(now), pc.is_null(before))
    return np.r_[0, np.flatnonzero(pc.or_(differ, odd).to_numpy(zero_copy_only=False)) + 1]


def _runs(symbol: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Runs as ``count * 16 + symbol``; what a turn repeats is a duplicate, of blanks a blank."""
    rest = np.where(symbol % 4 == BLANK, symbol, symbol // 4 * 4 + DUPLICATE)
    flat = np.stack([symbol, rest], axis=1).ravel()
    count = np.stack([np.minimum(times, 1), np.maximum(times - 1, 0)], axis=1).ravel()
    flat, count = flat[count > 0], count[count > 0]
    if not len(flat):
        return flat
    start = np.flatnonzero(np.diff(flat, prepend=-1))
    return np.add.reduceat(count, start) * 16 + flat[start]


def _segments(symbols: DataFrame, kind: T.DataType) -> DataFrame:
    """Runs of each conversation within each range of turns, and the numbers of these turns."""
    schema = T.StructType([T.StructField("conv", kind), T.StructField("segment", T.LongType()), T.StructField("runs", T.BinaryType())])
    for name in ("low", "high", "numbers"):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            symbol, times = (batch.column(c).to_numpy().astype(np.int64) for c in ("symbol", "times"))
            turn = batch.column("turn")
            there = pc.is_valid(turn).to_numpy(zero_copy_only=False) & (times > 0)
            number = pc.fill_null(turn, 0).to_numpy()
            begins = _boundaries(batch.column("conv"))
            out = {n: [] for n in ("segment", "runs", "low", "high", "numbers")}
            for start, stop in zip(begins, [*begins[1:], batch.num_rows]):
                mine = number[start:stop][there[start:stop]]
                out["segment"].append(segment)
                out["runs"].append(_runs(symbol[start:stop], times[start:stop]).tobytes())
                out["low"].append(int(mine[0]) if len(mine) else None)
                out["high"].append(int(mine[-1]) if len(mine) else None)
                out["numbers"].append(int(np.count_nonzero(np.diff(mine))) + 1 if len(mine) else 0)
                segment += 1
            columns = [batch.column("conv").take(pa.array(begins))]
            columns += [pa.array(v, pa.binary() if n == "runs" else pa.int64()) for n, v in out.items()]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    order = [F.col("conv").asc_nulls_first(), *_ordered()]
    dealt = symbols.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv", "turn", "symbol", "times").mapInArrow(run, schema)


def _summed(runs: list[tuple[int, int]]) -> tuple[list[int], int]:
    """Turns by fault, and adjacent turns whose roles may not follow one another."""
    faults, illegal, last = [0, 0, 0, 0], 0, None
    for symbol, count in runs:
        initial, fault = divmod(symbol, 4)
        faults[fault] += count
        illegal += count - 1 + (last is not None and (last, initial) not in LEGAL)
        last = initial
    return faults, illegal


def _solved(parts: list[tuple], solver: Repair) -> tuple:
    """Statistics, cost and audit of a conversation from its segments in order."""
    packed = np.frombuffer(b"".join(p[0] for p in parts), np.int64).tolist()
    runs: list[tuple[int, int]] = []
    for each in packed:
        count, symbol = divmod(each, 16)
        if runs and runs[-1][0] == symbol:
            count += runs.pop()[1]
        runs.append((symbol, count))
    numbers, low, high = 0, None, None
    for _, first, last, n in parts:
        if n:
            numbers += n - (high == first)
            low, high = (first if low is None else low), last
    gaps = high - low + 1 - numbers if numbers else 0
    faults, illegal = _summed(runs)
    return gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, *solver.solve(runs)


def plan(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: Column | None = None) -> DataFrame:
    """``conv``, ``gaps``, counts of faults, ``illegal``, ``cost`` and ``audit`` of every conversation.

    ``times`` says how often a row stands there; conversations with none left are kept.
    """
    return _plan(_turns(turns, conv, turn, role, text, times))


def _plan(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *(T.StructField(n, T.LongType()) for n in STATS)]).add("audit", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, open_, held = Repair(), None, []

        def closed(ids: list[pa.Array], found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.concat_arrays(ids), *(pa.array(c, pa.int64()) for c in list(zip(*found))[:-1])]
            return pa.RecordBatch.from_arrays([*columns, pa.array([f[-1] for f in found], pa.string())], schema.names)

        for batch in batches:
            ids, found, column = [], [], batch.column("conv")
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("runs", "low", "high", "numbers"))))
            begins = _boundaries(column)
            for start, stop in zip(begins, [*begins[1:], batch.num_rows]):
                mine = column.slice(start, 1)
                if open_ is not None and not mine.equals(open_):
                    ids.append(open_)
                    found.append(_solved(held, solver))
                    held = []
                open_ = mine
                held += rows[start:stop]
            if ids:
                yield closed(ids, found)
        if open_ is not None:
            yield closed([open_], [_solved(held, solver)])

    segments = _segments(_symbols(rows), kind).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "segment")
    return segments.mapInArrow(run, schema)


class Walk:
    """Applies an audit to the turns of a conversation, in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield ROLE_OF[self.state], "", "I"

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What is left of a turn, after what is inserted before it: role, text, letter."""
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = NEXT[self.state]
            yield ROLE_OF[self.state], text, letter
        elif letter == "K":
            self.state = KEPT[self.state][INITIALS.find(role[:1]) if role else 3]
            yield role, text, letter


def _met(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, followed by its turns in order, in one task."""
    heads = plans.withColumns({"head": F.lit(True), **{n: F.lit(None).cast(rows.schema[n].dataType) for n in ("turn", "role", "text", "times", "d1", "d2")}})
    tails = rows.where("times > 0").withColumns({"head": F.lit(False), **{n: F.lit(None).cast(plans.schema[n].dataType) for n in (*STATS, "audit")}})
    both = heads.unionByName(tails).repartition("conv")
    return both.sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("head").desc(), *_ordered())


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv``, ``place`` from 0, ``role``, ``text``, ``edit`` (K, R or I) and the old ``turn``."""
    rows = _turns(turns, conv, turn, role, text, times)
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType)]).add("place", "long").add("role", "string")
    schema = schema.add("text", "string").add("edit", "string").add("turn", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, mine, place = Walk(""), None, 0
        for batch in batches:
            ids, out = [], []

            def put(each: Iterator[tuple[str, str, str]], number: int | None) -> None:
                nonlocal place
                for r, t, letter in each:
                    ids.append(mine)
                    out.append((place, r, t, letter, None if letter == "I" else number))
                    place += 1

            column = batch.column("conv")
            for k, row in enumerate(batch.select(["head", "audit", "turn", "role", "text", "times"]).to_pylist()):
                if row["head"]:
                    put(walk.inserted(), None)
                    walk, mine, place = Walk(row["audit"]), column.slice(k, 1), 0
                else:
                    for _ in range(row["times"]):
                        put(walk.turn(row["role"], row["text"]), row["turn"])
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *columns], schema.names)
        rest = list(walk.inserted())
        if rest:
            columns = [pa.array([place + k for k in range(len(rest))]), *(pa.array(c) for c in zip(*rest)), pa.nulls(len(rest), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([mine] * len(rest)), *columns], schema.names)

    return _met(rows, _plan(rows)).mapInArrow(run, schema)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: Column | None = None) -> DataFrame:
    """The plan of every conversation and ``repaired_sha256``, over its repaired ``role:text`` lines joined by \\n."""
    rows = _turns(turns, conv, turn, role, text, times)
    plans = _plan(rows)
    planned = plans.columns
    schema = T.StructType(plans.schema.fields).add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, mine, digest, lines = Walk(""), None, hashlib.sha256(), 0

        def put(each: Iterator[tuple[str, str, str]]) -> None:
            nonlocal lines
            for r, t, _ in each:
                digest.update(f"{chr(10) if lines else ''}{r}:{t}".encode("utf-8", "surrogatepass"))
                lines += 1

        for batch in batches:
            done, sums = [], []
            heads = np.flatnonzero(batch.column("head").to_numpy(zero_copy_only=False)).tolist()
            audits = dict(zip(heads, batch.column("audit").take(pa.array(heads, pa.int64())).to_pylist()))
            columns = (batch.column(c).to_pylist() for c in ("role", "text", "times"))
            for k, (role_, text_, n) in enumerate(zip(*columns)):
                if k in audits:
                    if mine is not None:
                        put(walk.inserted())
                        done.append(mine)
                        sums.append(digest.hexdigest())
                    walk, mine, digest, lines = Walk(audits[k]), batch.slice(k, 1).select(planned), hashlib.sha256(), 0
                else:
                    for _ in range(n):
                        put(walk.turn(role_, text_))
            if done:
                table = pa.Table.from_batches(done).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays([*table.columns, pa.array(sums)], schema.names)
        if mine is not None:
            put(walk.inserted())
            yield pa.RecordBatch.from_arrays([*mine.columns, pa.array([digest.hexdigest()])], schema.names)

    return _met(rows, plans).mapInArrow(run, schema).withColumnRenamed("conv", conv)
