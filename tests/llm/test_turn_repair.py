"""Cheapest repairs against a plain search over all edits, whole and in slices."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from spanbill.llm import turn_repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def talks(n: int, seed: int = 1) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", "unknown", None])
            text = rng.choice(["Yes.", "No?", "so", "  ", "", None, "long " * 200, "a.\n", f"{turn}!", "é。"])
            rows.append((conv if conv != 3 else None, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 1, 30]), role, text))
    rng.shuffle(rows)
    return rows


def report(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x", True) for r in rows], f"{SCHEMA}, part int, audit string, whole boolean")
    return Counter(tuple(r) for r in turn_repair.report(frame.repartition(5), **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("most", [50_000, 3, 1])
def test_report(spark, most):
    rows = talks(150)
    assert report(spark, rows, most=most) == brute.turn_repairs(rows)


@pytest.mark.parametrize("most", [50_000, 20])
def test_one_conversation_of_many_turns(spark, most):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", "again.", "open", ""])) for t in range(900)] + [(2, 0, "user", "Hi.")] + talks(5)
    assert report(spark, rows, most=most) == brute.turn_repairs(rows)
    slices = turn_repair.repair(turn_repair.damage(spark.createDataFrame(rows, SCHEMA)), most).where("conv_id = 1")
    assert slices.count() >= (45 if most == 20 else 1)


def test_long_text_and_nothing(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y " * 2_000_000), (5, None, None, None)]
    assert report(spark, rows) == brute.turn_repairs(rows)
    assert turn_repair.report(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(k for k in range(1000) if not brute.damaged([(k, 0, "user", "a.")]))
    assert report(spark, [(gone, 0, "user", "a.")]) == Counter({(gone, 0, 0, 0, 0, 0, 0, "", brute.sha("")): 1})


@pytest.mark.parametrize("block", [1, 2, 4])
def test_blocks(block):
    table, rng = turn_repair.tables(block), random.Random(block)
    for _ in range(2_000):
        rows = [(rng.choice("suax"), rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randrange(0, 15))]
        symbols = np.array([turn_repair.GONE if g else 2 * ("sua".find(i) % 4) + late for i, g, late in rows], np.int64)
        letters, state, front, pay = table.trace(symbols, 0, turn_repair.START)
        want = brute.cheapest(rows)
        assert (pay + table.vectors[front][turn_repair.START], letters + turn_repair.ending(state)) == want
        at = rng.randrange(len(rows) + 1)
        to, cost, out = table.whole(symbols[at:])
        first, middle, front, pay = table.trace(symbols[:at], int(to[0]), turn_repair.START)
        second, last, _, _ = table.trace(symbols[at:], 0, middle)
        assert first + second + turn_repair.ending(last) == want[1] and out[0][middle] == last
        assert pay + int(cost[0]) + table.vectors[front][turn_repair.START] == want[0]


def test_few_vectors():
    assert len(turn_repair.tables().vectors) < 100
