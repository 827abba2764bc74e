"""Repair of conversations by the cheapest edits, with Four-Russians block tables.

A conversation should read as an optional system turn and then pairs of user and assistant, or be empty. Keeping a turn is free, giving it
another role costs 2, deleting it 3 (a must for blank turns and repeats), inserting an empty turn 2, and each truncated turn that
stays 1. Of the cheapest edits the one whose letters (D, I, K, R) come first in ASCII order is taken.

Four states are enough: nothing yet, after system, after user, after assistant. What is left to pay from each state is a vector of four
costs; less its least entry it takes few values, since from any state another one is a few edits away. All of them are found by
closure from the end, numbered, and the vector in front of every block of BLOCK symbols is tabled for each vector behind it. A
conversation is then run from its end block by block with one lookup each. The edits are read from front to back: each block
is expanded backward from the vector behind it, and in the state reached the least letter that keeps to the optimum is taken.

Turns are range partitioned on conversation and turn and pass through a task in order. A conversation that lies inside one
task's rows is finished there. The first and last of each task, and those of more than `most` turns, may go on elsewhere: they leave as
slices, whose block tables are composed to one map from vector to vector and state to state. A scan over these maps, one row
a slice, gives each slice its vector behind and its state in front, and the slices are expanded on their own. So a conversation
with a third of all rows is worked on by many tasks.

Null conversation, turn, role and text count as one blank in what is hashed and written; turns are in ascending order, nulls first, and equal
turns in the order of role and MD5 of the text. A role without a first letter can't be kept. A conversation that loses all its turns has a
row of zeros. Very long texts are held one at a time. Equal rows are turns of their own. Without rows the result is empty. Extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanbill.operators.stage import settle

#: Symbols in a block, and turns and characters after which a conversation is cut into slices.
BLOCK, SLICE_TURNS, SLICE_CHARS = 4, 50_000, 8 << 20

#: The costs of edits, and the roles' initials.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SYSTEM, USER, ASSISTANT = "s", "u", "a"
ROLES = {USER: "user", ASSISTANT: "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"

START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The role wanted next in each state, by insertion or a change of role, and the state then reached.
WANTED, REACHED = [USER, USER, ASSISTANT, USER], [AFTER_U, AFTER_U, AFTER_A, AFTER_U]
#: Symbols: an initial (other: none of the three), truncated or not, and a turn that has to go.
INITIALS = [SYSTEM, USER, ASSISTANT, ""]
GONE = 2 * len(INITIALS)
SYMBOLS = GONE + 1


def _kept(state: int, symbol: int) -> int | None:
    """State after a turn is kept."""
    initial = INITIALS[symbol >> 1] if symbol != GONE else ""
    if initial == SYSTEM:
        return AFTER_S if state == START else None
    return REACHED[state] if initial and initial == WANTED[state] else None


def _choices(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state) of each way to take a turn, letters in ASCII order; insertion takes none and is not listed."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        late = TRUNCATED * (symbol & 1)
        after = _kept(state, symbol)
        if after is not None:
            out.append(("K", KEEP + late, after))
        out.append(("R", REROLE + late, REACHED[state]))
    return out


def _with_insertions(costs: list[int]) -> tuple[int, ...]:
    out = list(costs)
    for _ in range(2):  # two insertions lead from any state to any that needs none
        out = [min(out[s], INSERT + out[REACHED[s]]) for s in range(4)]
    return tuple(out)


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """What is left to pay in front of a turn, from what is left behind it."""
    return _with_insertions([min(cost + costs[to] for _, cost, to in _choices(s, symbol)) for s in range(4)])


class Tables:
    """Vectors and their steps over one symbol, and over every block of symbols."""

    def __init__(self, block: int = BLOCK):
        far = 1 << 20
        self.block = block
        self.vectors = [_with_insertions([0, far, far, 0])]
        number, one = {self.vectors[0]: 0}, []
        for vector in self.vectors:  # grows until the closure is complete
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                normal = tuple(c - least for c in costs)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], least, self._exits(vector, costs, symbol)))
            one.append(row)
        #: Behind vector and symbol: vector in front, what the least entry grows by, and the state behind for each state in front.
        self.to = np.array([[r[0] for r in row] for row in one], np.int64)
        self.pay = np.array([[r[1] for r in row] for row in one], np.int64)
        self.exit = np.array([[[e[1] for e in r[2]] for r in row] for row in one], np.int64)
        #: The letters of one turn for each state in front: insertions before it, then its own.
        self.letters = [[[e[0] for e in r[2]] for r in row] for row in one]
        vectors, to, pay, out = len(self.vectors), self.to, self.pay, self.exit
        for _ in range(block - 1):  # one symbol more in front, in the highest place of the code
            codes = to.shape[1]
            at = np.arange(SYMBOLS)[None, :, None]
            first = self.exit[to[:, None, :], at]  # vector, symbol, code -> state behind the new symbol
            pay = (pay[:, None, :] + self.pay[to[:, None, :], at]).reshape(vectors, -1)
            out = np.take_along_axis(np.broadcast_to(out[:, None], (vectors, SYMBOLS, codes, 4)), first, 3).reshape(vectors, -1, 4)
            to = self.to[to[:, None, :], at].reshape(vectors, -1)
        self.block_to, self.block_pay, self.block_exit = to, pay, out

    @staticmethod
    def _exits(behind: tuple[int, ...], front: tuple[int, ...], symbol: int) -> list[tuple[str, int]]:
        """For each state the ASCII-least letters up to and with a turn, and the state behind it."""
        out = []
        for state in range(4):
            letters = ""
            while True:
                ways = _choices(state, symbol)
                ways.insert(1, ("I", INSERT, REACHED[state]))  # D < I < K < R
                letter, _, state = next(w for w in ways if w[1] + (front if w[0] == "I" else behind)[w[2]] == front[state])
                letters += letter
                if letter != "I":
                    break
            out.append((letters, state))
        return out

    def codes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the whole blocks, counted from the end, and the symbols in front of them."""
        rest = len(symbols) % self.block
        weights = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        return symbols[rest:].reshape(-1, self.block) @ weights, symbols[:rest]

    def whole(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The map of a slice: for every vector behind it the vector in front and the cost, and for every state in front the one behind."""
        n = len(self.vectors)
        to, pay, out = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
        codes, rest = self.codes(symbols)
        steps = [(c, self.block_to, self.block_pay, self.block_exit) for c in codes[::-1].tolist()]
        steps += [(s, self.to, self.pay, self.exit) for s in rest[::-1].tolist()]
        for code, a, b, c in steps:
            pay, out, to = pay + b[to, code], np.take_along_axis(out, c[to, code], 1), a[to, code]
        return to, pay, out

    def trace(self, symbols: np.ndarray, behind: int, state: int) -> tuple[str, int, int, int]:
        """Letters, state behind, vector in front and what its least entry grew by, from the vector behind and the state in front."""
        codes, rest = self.codes(symbols)
        vectors, pay = [behind], 0
        for code in codes[::-1].tolist():
            pay += int(self.block_pay[vectors[-1], code])
            vectors.append(int(self.block_to[vectors[-1], code]))
        front, letters = vectors.pop(), []
        chain = [front]
        for symbol in rest[::-1].tolist():
            pay += int(self.pay[chain[-1], symbol])
            chain.append(int(self.to[chain[-1], symbol]))
        front = chain.pop()

        def take(symbols: list[int], behind: list[int], state: int) -> int:
            for symbol, vector in zip(symbols, reversed(behind), strict=True):
                letters.append(self.letters[vector][symbol][state])
                state = int(self.exit[vector, symbol, state])
            return state

        state = take(rest.tolist(), chain, state)
        for at in range(len(rest), len(symbols), self.block):
            some, chain = symbols[at : at + self.block].tolist(), [vectors.pop()]
            for symbol in some[:0:-1]:  # the block expanded backward
                chain.append(int(self.to[chain[-1], symbol]))
            state = take(some, chain, state)
        return "".join(letters), state, front, pay


def ending(state: int) -> str:
    """Insertions after the last turn."""
    letters = ""
    while state not in (START, AFTER_A):
        letters, state = letters + "I", REACHED[state]
    return letters


@lru_cache(4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def initial_of(role: str) -> str:
    return role[:1]


def repaired(roles: list[str], texts: list[str], letters: str, state: int) -> list[str]:
    """role:text of each turn that is left, from the edits and the state in front."""
    out, at = [], 0
    for letter in letters:
        if letter == "I":
            out.append(f"{ROLES[WANTED[state]]}:")
        elif letter != "D":
            out.append(f"{roles[at] if letter == 'K' else ROLES[WANTED[state]]}:{texts[at]}")
        if letter == "K" and initial_of(roles[at]) == SYSTEM:
            state = AFTER_S
        elif letter != "D":
            state = REACHED[state]
        at += letter != "I"
    return out


class Slice:
    """Turns of one conversation in order, with their faults."""

    def __init__(self, conv_id):
        self.conv_id, self.roles, self.texts, self.turns, self.faults, self.chars = conv_id, [], [], [], [], 0
        self.seen, self.first = set(), []

    def add(self, turn: int | None, role: str, text: str) -> None:
        """Fault of a turn: 1 blank, 2 repeat (of a turn in this slice), 3 truncated. first: turns that the slice has not had yet."""
        stripped = text.strip(BLANKS)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = 1 if not stripped else 2 if key in self.seen else 3 if stripped[-1] not in STOPS else 0
        if stripped and key not in self.seen:
            self.seen.add(key)
            self.first.append((len(self.roles), key))
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.faults.append(fault)
        self.chars += len(text) + len(role)


def symbols_of(roles: list[str], faults: list[int]) -> np.ndarray:
    place = {x: i for i, x in enumerate(INITIALS) if x}
    return np.array([GONE if f in (1, 2) else 2 * place.get(initial_of(r), len(INITIALS) - 1) + (f == 3) for r, f in zip(roles, faults, strict=True)], np.int64)


def illegal_pairs(roles: list[str]) -> int:
    initials = [initial_of(r) for r in roles]
    return sum(a + b not in (SYSTEM + USER, USER + ASSISTANT, ASSISTANT + USER) for a, b in zip(initials, initials[1:], strict=False))


def _turn_facts(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


_LINES = "lines array<string>"
_DONE = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, " + _LINES
_OPEN = "part bigint, number bigint, roles array<string>, texts array<string>, faults array<int>, first_at array<int>, first_key array<binary>, low bigint, high bigint, n_turns bigint"


def _done(s: Slice) -> tuple:
    table = tables()
    letters, state, front, pay = table.trace(symbols_of(s.roles, s.faults), 0, START)
    letters += ending(state)
    low, high, distinct = _turn_facts(s.turns)
    gaps = 0 if low is None else high - low + 1 - distinct
    cost = pay + table.vectors[front][START]
    return (gaps, *(s.faults.count(k) for k in (1, 2, 3)), illegal_pairs(s.roles), cost, letters, repaired(s.roles, s.texts, letters, START))


def _open(s: Slice, part: int, number: int) -> tuple:
    return part, number, s.roles, s.texts, s.faults, [a for a, _ in s.first], [k for _, k in s.first], *_turn_facts(s.turns)


def cut(turns: DataFrame, most: int = SLICE_TURNS, most_chars: int = SLICE_CHARS) -> DataFrame:
    """One row for each conversation that lies in one task, or for each slice of one that may not; written as a stage.

    turns has conv_id, turn, role, text and gone (the row only tells that the conversation exists).
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    n_done, n_open = len(_DONE.split(", ")), len(_OPEN.split(", "))
    tie = F.md5("text")
    rows = turns.select("conv_id", "turn", "role", "text", "gone", tie.alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = [F.col(c) for c in ("conv_id", "turn", "role", "tie", "place")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "gone")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, schema = TaskContext.get().partitionId(), 0, None
        now, here, done, waiting = None, 0, [], 0  # here: conversations met so far

        def row(s: Slice, whole: bool) -> tuple:
            return (s.conv_id, whole, *(_done(s) if whole else (None,) * n_done), *((None,) * n_open if whole else _open(s, part, number)))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        cut_before = False
        for batch in batches:
            schema = schema or _arrow_schema(batch.schema.field("conv_id").type)
            for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        whole = here > 1 and not cut_before
                        done.append(row(now, whole))
                        number, waiting = number + (not whole), waiting + now.chars
                    now, here, cut_before = Slice(conv), here + 1, False
                elif len(now.roles) >= most or now.chars >= most_chars:
                    done.append(row(now, False))
                    number, waiting, now, cut_before = number + 1, waiting + now.chars, Slice(conv), True
                if not gone:
                    now.add(turn, role, text)
                if len(done) >= 2_000 or waiting >= most_chars:
                    if done:
                        yield batch_of(done)
                    done, waiting = [], 0
        if now is not None:
            done.append(row(now, False))
        if done:
            yield batch_of(done)

    return settle(rows.mapInArrow(walk, f"conv_id {id_type}, whole boolean, {_DONE}, {_OPEN}"))


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary())}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in f"{_DONE}, {_OPEN}".split(", "))]
    return pa.schema([("conv_id", id_type), ("whole", pa.bool_()), *fields])


def _repeats_of_other_slices(slices: DataFrame) -> DataFrame:
    """part, number, and the turns of a slice that an earlier slice of the conversation has had."""
    firsts = slices.select("conv_id", "part", "number", F.explode(F.arrays_zip("first_at", "first_key")).alias("f"))
    firsts = firsts.select("conv_id", "part", "number", F.col("f.first_at").alias("at"), F.col("f.first_key").alias("key"))
    # at most one row a slice and key, so no key has more rows than its conversation has slices
    earlier = Window.partitionBy("conv_id", "key").orderBy("part", "number")
    late = firsts.withColumn("nth", F.row_number().over(earlier)).where("nth > 1")
    return late.groupBy("part", "number").agg(F.collect_list("at").alias("again"))


def _scan(conv_type: str):
    """Slices' maps, conversation by conversation and from the front, to the vector behind and the state in front of each slice."""

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, schema = [], None

        def solved() -> pa.RecordBatch:
            table, vector, cost, behind = tables(), 0, 0, []
            for r in reversed(held):
                behind.append(vector)
                cost, vector = cost + r["pay"][vector], r["to"][vector]
            cost, state, rows, last, turn, gaps, illegal = cost + table.vectors[vector][START], START, [], None, None, 0, 0
            low = next((r["low"] for r in held if r["low"] is not None), None)
            high = next((r["high"] for r in reversed(held) if r["high"] is not None), None)
            distinct = 0
            for r, v in zip(held, reversed(behind), strict=True):
                rows.append((r["part"], r["number"], v, state))
                state = r["exit"][4 * v + state]
                if r["n_turns"]:
                    distinct, turn = distinct + r["n_turns"] - (turn == r["low"]), r["high"]
                if r["edges"] is not None:
                    illegal += r["illegal"] + (last is not None and illegal_pairs([last, r["edges"][0]]))
                    last = r["edges"][1]
            gaps = 0 if low is None else high - low + 1 - distinct
            facts = [(held[0]["conv_id"], *x, i == len(rows) - 1, cost, gaps, illegal) for i, x in enumerate(rows)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*facts, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            names = ["part", "number", "behind", "state", "last", "cost", "gaps", "illegal"]
            schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), *((n, pa.bool_() if n == "last" else pa.int64()) for n in names)])
            for r in batch.to_pylist():
                if held and held[0]["conv_id"] != r["conv_id"]:
                    yield solved()
                    held = []
                held.append(r)
        if held:
            yield solved()

    return states, f"conv_id {conv_type}, part bigint, number bigint, behind bigint, state bigint, last boolean, cost bigint, gaps bigint, illegal bigint"


_MAP = "part bigint, number bigint, low bigint, high bigint, n_turns bigint, illegal bigint, edges array<string>, to array<bigint>, pay array<bigint>, exit array<bigint>"


def _maps(conv_type: str):
    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                to, pay, out = tables().whole(symbols_of(r["roles"], r["faults"]))
                edges = [initial_of(r["roles"][0]), initial_of(r["roles"][-1])] if r["roles"] else None
                row = [r["conv_id"], r["part"], r["number"], r["low"], r["high"], r["n_turns"], illegal_pairs(r["roles"]), edges, to, pay, out.ravel()]
                kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3]
                names = ["conv_id", *(x.split()[0] for x in _MAP.split(", "))]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    return shrink, f"conv_id {conv_type}, {_MAP}"


def _expand(conv_type: str):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                letters, state, _, _ = tables().trace(symbols_of(r["roles"], r["faults"]), r["behind"], r["state"])
                letters += ending(state) if r["last"] else ""
                lines = repaired(r["roles"], r["texts"], letters, r["state"])
                counts = [r["faults"].count(k) for k in (1, 2, 3)]
                row = [r["conv_id"], r["part"], r["number"], r["gaps"], *counts, r["illegal"], r["cost"], letters, lines]
                kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 8, pa.string(), pa.list_(pa.string())]
                names = ["conv_id", "part", "number", *(x.split()[0] for x in _DONE.split(", "))]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    return expand, f"conv_id {conv_type}, part bigint, number bigint, {_DONE}"


def repair(turns: DataFrame, most: int = SLICE_TURNS) -> DataFrame:
    """conv_id, part, number, gaps, blank, duplicate, truncated, illegal, cost, audit, lines: one row for each conversation or slice of one.

    gaps, illegal and cost are those of the conversation, faults, audit and lines (role:text of the repaired turns) those of the slice; part
    and number, null where a conversation is whole, order the slices.
    """
    conv_type = turns.schema["conv_id"].dataType.simpleString()
    rows = cut(turns, most)
    names = ["conv_id", "part", "number", *(x.split()[0] for x in _DONE.split(", "))]
    whole = rows.where("whole").select(*names)
    slices = rows.where("NOT whole").select("conv_id", *(x.split()[0] for x in _OPEN.split(", ")))
    again = slices.join(_repeats_of_other_slices(slices), ["part", "number"], "left")
    faults = F.expr("transform(faults, (f, i) -> IF(f IN (0, 3) AND array_contains(again, i), 2, f))")
    known = settle(again.withColumn("faults", F.when(F.col("again").isNull(), F.col("faults")).otherwise(faults)).drop("again", "first_at", "first_key"))
    shrink, map_type = _maps(conv_type)
    maps = known.mapInArrow(shrink, map_type)
    maps = maps.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    states, state_type = _scan(conv_type)
    told = maps.mapInArrow(states, state_type).drop("conv_id")
    expand, out_type = _expand(conv_type)
    parts = known.join(told, ["part", "number"]).mapInArrow(expand, out_type)
    return whole.unionByName(parts.select(*names))


def damage(rows: DataFrame) -> DataFrame:
    """The contract's faults, put in by a checksum of conversation and turn; gone marks rows that were dropped."""
    blank = F.lit(" ")
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text)
    role = F.when(kind == 4, ROLES[USER]).otherwise(role)
    twice = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    gone = kind == 0
    faulty = rows.select("conv_id", "turn", F.when(gone, "").otherwise(role).alias("role"), F.when(gone, "").otherwise(text).alias("text"), gone.alias("gone"), twice.alias("copy"))
    return faulty.drop("copy")


def report(rows: DataFrame, most: int = SLICE_TURNS) -> DataFrame:
    """One row for each conversation: the faults after damage, the cheapest repair, and a digest of what it leaves."""
    made = settle(repair(damage(rows), most))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    alone = made.where("number IS NULL").select("conv_id", *counts, "audit", F.sha2(F.array_join("lines", "\n"), 256).alias("repaired_sha256"))
    sliced = made.where("number IS NOT NULL")
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "part", "number"]
    sums = sliced.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_join_slices, f"conv_id {conv_type}, {', '.join(c + ' bigint' for c in counts)}, audit string, repaired_sha256 string")
    return alone.unionByName(sums)


def _join_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices in order, one at a time: only the running digest and the letters of a conversation are held."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    now, schema = None, None

    def finished() -> pa.RecordBatch:
        row = [now["conv_id"], now["gaps"], *now["faults"], now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    for batch in batches:
        kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        schema = schema or pa.schema(list(zip(names, kinds, strict=True)))
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if now is None or now["conv_id"] != r["conv_id"]:
                if now is not None:
                    yield finished()
                now = {k: r[k] for k in ("conv_id", "gaps", "illegal", "cost")} | {"faults": [0, 0, 0], "audit": [], "sha": hashlib.sha256(), "some": False}
            now["faults"] = [a + r[k] for a, k in zip(now["faults"], ("blank", "duplicate", "truncated"), strict=True)]
            now["audit"].append(r["audit"])
            if r["lines"]:
                now["sha"].update((("\n" if now["some"] else "") + "\n".join(r["lines"])).encode())
                now["some"] = True
    if now is not None:
        yield finished()
