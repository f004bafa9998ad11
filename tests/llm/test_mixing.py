"""Targets against repeated sharing out, and what the sampling takes."""

import random
from collections import defaultdict

import brute
import pytest

from formline.llm import mixing


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long")


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice(["b", "é", "Z", "a"]) + str(i): rng.choice([0, 1, 10, 10**rng.randrange(1, 7)]) for i in range(rng.randrange(1, 12))}
    sizes[None] = 17
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = brute.targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)


def test_taken(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot"] * 5 + ["b", "c", None]), rng.choice([0, 1, 5, 50, 200])) for i in range(3000)]
    plan = mixing.mix_plan(sized(spark, rows), ["doc_id"]).collect()
    assert len(plan) == len(rows) and all(r.copies in (0, 1, 2) for r in plan)
    taken, target = defaultdict(int), {}
    for r in plan:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 400
    again = mixing.mix_plan(sized(spark, rows[::-1]), ["doc_id"]).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in plan}
