"""Log ratios of expressions against a loop over dictionaries."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from formline.llm import toxicity
from formline.llm.wordruns import distinct_estimate, words_of
from formline.llm.words import hash_runs


def runs(text):
    w = text.lower().split()
    return {tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)}


def brute(texts):
    counts = {y: Counter(r for t, label in texts if label == y for r in runs(t)) for y in (0, 1)}
    tox, plain = counts[1], counts[0]
    discount = lambda a, b: min(0.95, max(0.1, a / max(1, a + 2 * b)))
    m = {}
    for k in (1, 2, 3):
        t, o = ([n for r, n in c.items() if len(r) == k] for c in (tox, plain))
        both = sum(len(r) == k and r in plain for r in tox)
        shared = len(t) + len(o)
        m[k] = (sum(t), sum(o), len(t), len(o), discount(t.count(1), t.count(2)), shared, shared - both, discount(shared - 2 * both, both))

    def base(r, t, o, below):
        _, _, _, _, _, shared, kinds, d0 = m[len(r)]
        return max(0, (t > 0) + (o > 0) - d0) / shared + d0 * kinds / shared * below

    def below(r):
        if len(r) == 1:
            return 1 / m[1][6]
        return base(r[:-1], tox[r[:-1]], plain[r[:-1]], below(r[:-1])) * base(r[-1:], tox[r[-1:]], plain[r[-1:]], 1 / m[1][6])

    def ratio(r, t, o):
        nt, no, kt, ko, d, *_ = m[len(r)]
        s = base(r, t, o, below(r))
        return math.log((max(0, t - d) / nt + d * kt / nt * s) / (max(0, o - d) / no + d * ko / no * s)) if t else 0

    return {r: (ratio(r, n, plain[r]), ratio(r, n, max(0, plain[r] - 1)), ratio(r, n - 1, plain[r])) for r, n in tox.items()}


def test_ratios_of_expressions(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(30)]
    texts = [(" ".join(rng.choices(plain + ["bad", "worse"] * (2 if y else 0), k=20)), y) for y in (1, 0, 0, 0) for _ in range(12)] + [("", 1), ("", 0)]
    table = spark.createDataFrame([(t, y) for t, y in texts] + [(None, 1)], "text string, __y int")
    got = {r.run: (r.s, r.s0, r.s1) for r in toxicity.telling_runs(table, least=1.0).collect()}
    want = {}
    for r, s in brute(texts).items():
        hashed = hash_runs(words_of(pa.array([" ".join(r)]))[0], len(r)) & ~np.uint64(3) | np.uint64(len(r))
        want[int(hashed.view(np.int64)[0])] = s
    assert len(got) > 100
    for run, s in want.items():  # what only ordinary texts have is counted by a sketch
        assert run in got or s[1] < 1.05
        assert run not in got or np.allclose(got[run], s, atol=0.05)
    assert set(got) <= set(want)


def test_sketch_of_distinct_values():
    from formline.llm.wordruns import REGISTERS, _registers

    rng = np.random.default_rng(1)
    for n in (0, 3, 1000, 300_000):
        ranks = np.zeros(REGISTERS, int)
        place, rank = _registers(rng.integers(0, 2**64, n, dtype=np.uint64))
        np.maximum.at(ranks, place, rank)
        assert abs(distinct_estimate(ranks) - n) <= 0.06 * n
