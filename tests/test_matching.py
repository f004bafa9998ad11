"""Interval, tolerance and nearest-date matching against brute force."""

import random
import struct
from datetime import date, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import matching, schedule, vectors
from formline.operators.lastknown import last_known_fill
from formline.operators.ordered import HOT_ROWS_CONF
from formline.sources.incremental import snapshot_diff, upsert_keeping


@pytest.fixture(params=["plain", "hot"])
def both(request, spark):
    if request.param == "hot":
        spark.conf.set(HOT_ROWS_CONF, "25")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


def _line(spark):
    rng = random.Random(2)
    events = [(i, "g" if i % 3 else f"g{i % 4}", rng.randint(0, 200)) for i in range(150)]
    spans = []
    for i in range(60):
        start = rng.randint(0, 200)
        spans.append(("g" if i % 3 else f"g{i % 4}", f"p{i % 5}", start, start + rng.randint(-3, 25)))
    return events, spans


def test_inside_any_interval(spark, both):
    events, spans = _line(spark)
    got = matching.inside_any_interval(
        spark.createDataFrame(events, "i int, g string, t int"), spark.createDataFrame(spans, "g string, p string, a int, b int"), ["g"], "t", "a", "b"
    )
    want = sorted((i, int(any(g == h and a <= t <= b for h, _, a, b in spans))) for i, g, t in events)
    assert sorted(map(tuple, got.select("i", "inside").collect())) == want


def test_totals_inside(spark, both):
    events, spans = _line(spark)
    got = matching.totals_inside(
        spark.createDataFrame(events, "i int, g string, t int").withColumn("n", F.lit(1)),
        spark.createDataFrame(spans, "g string, p string, a int, b int"), ["g"], ["p"], "t", "a", "b", ["n"],
    )
    owners = {(h, p) for h, p, a, b in spans if a <= b}
    want = sorted((h, p, sum(any(g == h and q == p and h2 == h and a <= t <= b for h2, q, a, b in spans) for _, g, t in events)) for h, p in owners)
    assert sorted(map(tuple, got.collect())) == want


def test_touching_intervals_merge(spark):
    df = spark.createDataFrame([("k", 1, 3), ("k", 3, 5), ("k", 7, 9), ("k", 2, 2), ("k", 8, 4)], "k string, a int, b int")
    assert rows_of(matching.merge_intervals(df, ["k"], "a", "b"), "a", "b") == [(1, 5), (7, 9)]


@pytest.mark.parametrize("tolerance", [1, 5])
def test_first_within_tolerance(spark, tolerance):
    events, _ = _line(spark)
    points = [(100 + i, "g" if i % 2 else "g1", i * 3) for i in range(70)]
    got = matching.first_within_tolerance(
        spark.createDataFrame(points, "i int, g string, t int"),
        spark.createDataFrame([(e[0], e[1], e[2], f"v{e[0]}") for e in events], "o int, g string, t int, v string"),
        ["g"], "t", "o", "v", tolerance, "hit", "none", span=2,
    )

    def first(g, t):
        near = [o for o, h, u in events if h == g and abs(u - t) < tolerance]
        return f"v{min(near)}" if near else "none"

    assert sorted(map(tuple, got.select("i", "hit").collect())) == sorted((i, first(g, t)) for i, g, t in points)


def test_nearest_date(spark):
    rng = random.Random(4)
    base = date(2024, 1, 1)
    wanted = [(i, f"k{i % 3}", base + timedelta(days=rng.randint(0, 60))) for i in range(80)] + [(99, "none", base)]
    offered = [(f"k{i % 3}", base + timedelta(days=rng.randint(0, 60))) for i in range(20)]
    got = matching.nearest_date(
        spark.createDataFrame(wanted, "i int, k string, d date"), spark.createDataFrame(offered, "k string, c date"), ["k"], "d", "c"
    )
    for row in got.collect():
        dates = sorted(c for k, c in offered if k == row.k)
        assert row.nearest_date == (min(dates, key=lambda c: abs((c - row.d).days)) if dates else None)
    tie = matching.nearest_date(
        spark.createDataFrame([("p", "2024-01-10")], "k string, d string"),
        spark.createDataFrame([("p", "2024-01-08"), ("p", "2024-01-12")], "k string, c string"), ["k"], "d", "c",
    )
    assert str(tie.first().nearest_date) == "2024-01-08"


def test_last_known_fill_levels(spark):
    history = spark.createDataFrame([("A", "B", 1, 10), ("A", "C", 2, 20), ("D", "B", 3, 30)], "t string, o string, d int, v int")
    rows = spark.createDataFrame([("A", "B", None), ("A", "Z", None), ("Y", "B", None), ("A", "B", 7)], "t string, o string, v int")
    filled = last_known_fill(rows, history, [(["t", "o"], ["v"]), (["t"], ["v"]), (["o"], ["v"])], ["d"])
    assert rows_of(filled) == [("A", "B", 10), ("A", "B", 7), ("A", "Z", 20), ("Y", "B", 30)]


def test_slate_keeps_first_game_of_both(spark):
    games = spark.createDataFrame([(1, "A", "B"), (2, "B", "C"), (3, "C", "D"), (4, "E", "F")], "n int, h string, a string")
    assert rows_of(schedule.first_games_of_slate(games, "h", "a", ["n"]), "n") == [(1,), (3,), (4,)]


def test_slate_breaks_ties_by_teams(spark):
    games = spark.createDataFrame([(1, "A", "B"), (1, "A", "C"), (1, "A", "C"), (1, "C", "D"), (1, "D", "A"), (2, "B", "E"), (1, None, "F")], "n int, h string, a string")
    assert rows_of(schedule.first_games_of_slate(games, "h", "a", ["n"]), "h", "a") == [("A", "B"), ("C", "D")]
    assert rows_of(schedule.first_games_of_slate(games.limit(0), "h", "a", ["n"])) == []


@pytest.mark.parametrize("block", [10**6, 3000, 700])
def test_slate_of_a_long_chain(spark, block):
    """10,000 games, each sharing a team with the next, and some between: as a loop takes them, in a few blocks."""
    rng = random.Random(2)
    games = [(i, f"t{i}", f"t{i + 1}") for i in range(10_000)] + [(rng.randrange(10_000), f"t{rng.randrange(12_000)}", f"u{rng.randrange(300)}") for _ in range(500)]
    rows = spark.createDataFrame(games, "n int, h string, a string")
    busy, want = set(), []
    for n, h, a in sorted(set(games)):
        if h not in busy and a not in busy:
            busy |= {h, a}
            want.append((n, h, a))
    assert sorted(tuple(r) for r in schedule.first_games_of_slate(rows, "h", "a", ["n"], block=block).collect()) == want


def test_rows_without_key_go_round_the_join(spark):
    planned = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "id int, p string")
    facts = spark.createDataFrame([(1, 5), (None, 6), (3, 7)], "id int, v int")
    assert rows_of(schedule.join_schedule(planned, facts, ["id"])) == [
        (1, "x", 5), (2, "z", None), (3, None, 7), (None, "y", None), (None, None, 6),
    ]
    assert rows_of(schedule.join_schedule(planned, facts, ["id"], "left")) == [(1, "x", 5), (2, "z", None), (None, "y", None)]


def test_upsert_and_diff_with_null_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 9)], "k int, s string, v int")
    new = spark.createDataFrame([(1, None, 5), (3, "c", 3), (None, "n", 9)], "k int, s string, v int")
    assert rows_of(upsert_keeping(old, new, ["k"])) == [(1, "a", 5), (2, "b", 2), (3, "c", 3), (None, "n", 9)]
    assert rows_of(snapshot_diff(old, new, ["k"])) == [(1, "update"), (2, "delete"), (3, "insert")]


def test_vector_top_k_brute_force(spark):
    rng = random.Random(8)
    items = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(50)]
    asked = [("q0", items[3][1]), ("q1", [1.0] * 6)]
    got = vectors.vector_top_k(
        spark.createDataFrame(items, "id int, v array<double>"), spark.createDataFrame(asked, "q string, w array<double>"), "q", "w", "id", "v", 4
    )

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        return dot / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)

    for q, w in asked:
        want = sorted(items, key=lambda it: (-cosine(it[1], w), it[0]))[:4]
        assert [r.id for r in got.filter(F.col("q") == q).orderBy("rank").collect()] == [i for i, _ in want]


def test_reconcile_verdicts(spark):
    stored = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 1.0), (5, None)], "k int, v double")
    again = spark.createDataFrame([(1, 1.001), (2, 9.0), (3, 1.0), (5, None)], "k int, v double")
    got = dict((r.k, r.verdict) for r in matching.reconcile(stored, again, ["k"], "v").collect())
    assert got == {1: "MATCH", 2: "DIFFERENT", 3: "MISSING_STORED", 4: "MISSING_SOURCE", 5: "BOTH_NULL"}


def test_waiting_vectors_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HELD_BYTES", 400)
    rows = [(i, i % 7, None if i == 3 else [1.0, None] if i == 4 else [float(i), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, _cell int, v array<double>").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "14")
    try:
        blocks = vectors._packed(df, "id", "v", 200, ["_cell"], "i").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(i for b in blocks for i in b.i_ids) == list(range(300))
    assert max(len(b.i_vectors) for b in blocks) <= 400 + 2 * 16 and len(blocks) > 9
    packed = {i: (b._cell, b.i_width, bytes(b.i_vectors)[16 * n : 16 * n + 16]) for b in blocks for n, i in enumerate(b.i_ids) if b.i_width}
    assert packed == {i: (c, 2, struct.pack("<2d", *v)) for i, c, v in rows if v and None not in v}


def test_scores_by_a_few_queries_at_a_time(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i % 9), 1.0, float(i % 4)]) for i in range(90)], "id int, v array<double>")
    queries = df.select(F.col("id").alias("q"), F.col("v").alias("w"))
    found = []
    for some in (7, 500):
        monkeypatch.setattr(vectors, "SCORED_ROWS", some)
        found.append(rows_of(vectors.vector_top_k(df, queries, "q", "w", "id", "v", 4, digits=6)))
    assert found[0] == found[1] and len(found[0]) == 360
