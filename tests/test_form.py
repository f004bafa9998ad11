"""Rolling form, ranks, streaks and hit rates against hand-computed values,
and the hot-group way against the plain way."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import ranking, rolling, streaks
from formline.operators.ordered import HOT_ROWS_CONF, hot_groups, split_hot

SHOTS = [3, 1, 4, 1, 5]


@pytest.fixture
def season(spark):
    rows = [("p", f"2024-01-{d:02d}", d, s) for d, s in enumerate(SHOTS, 1)] + [("p", "2024-01-09", None, None)]
    return spark.createDataFrame(rows, "player string, d string, game int, sog int").withColumn("d", F.to_date("d"))


def _column(df, name):
    return [r[0] for r in df.orderBy("d").select(name).collect()]


def test_rolling_example(season):
    order, played = ["d"], F.col("game").isNotNull()
    free = rolling.rolling_form(season, ["player"], order, ["sog"])
    assert _column(free, "previous_sog") == [None, 3.0, 1.0, 4.0, 1.0, 5.0]
    assert _column(free, "average_sog_last_3_games") == [None, 3.0, 2.0, 2.67, 2.0, 3.33]
    parity = rolling.rolling_form(season, ["player"], order, ["sog"], played=played, include_current="played")
    assert _column(parity, "average_sog_last_3_games") == [3.0, 2.0, 2.67, 2.0, 3.33, 3.33]
    with pytest.raises(ValueError):
        rolling.rolling_form(season, ["player"], order, ["sog"], include_current="played")


def test_zero_fill_spares_ranks(season):
    ranked = season.withColumnRenamed("sog", "sogRank")
    filled = rolling.rolling_form(ranked, ["player"], ["d"], ["sogRank"], zero_fill=rolling.keep_rank_nulls)
    assert _column(filled, "previous_sogRank")[0] is None
    assert _column(filled, "average_sogRank_last_3_games")[0] == 0.0


def test_season_hit_rate(season):
    counted = rolling.games_played(season.filter("game is not null"), ["player"], ["d"], "game", "n")
    rated = rolling.season_hit_rate(counted, ["player"], "d", "sog", "n", thresholds=[2])
    assert _column(rated, "hit_rate_2plus") == [None, 0.5, 0.6667, 0.5, 0.6]
    month = rolling.hit_rate_last_days(season, ["player"], "d", "sog", days=2, thresholds=[2])
    assert _column(month, "last2_hit_rate_2plus") == [1.0, 0.5, 0.6667, 0.3333, 0.6667, None]


def test_previous_known_against_lag(spark):
    rows = [(1, 1.0), (2, None), (3, 3.0), (4, 10.0)]
    df = spark.createDataFrame([("e", *r) for r in rows], "e string, d int, v double")
    known = rolling.rolling_form(df, ["e"], ["d"], ["v"], windows=[])
    assert _column(known, "previous_v") == [None, 1.0, 1.0, 3.0]
    assert _column(rolling.previous_row(df, ["e"], ["d"], ["v"]), "lag_v") == [None, 1.0, None, 3.0]


def test_ranks(spark):
    df = spark.createDataFrame([("l", n, v, v) for n, v in zip("abcd", (10, 8, 8, 5))], "l string, n string, goals int, goalsAgainst int")
    ranked = ranking.rank_form(df, ["l"], ["goals", "goalsAgainst"])
    assert rows_of(ranked, "n", "rank_goals", "perc_rank_goals", "rank_goalsAgainst") == [
        ("a", 1, 1.0, 4),
        ("b", 2, 0.67, 2),
        ("c", 2, 0.67, 2),
        ("d", 4, 0.0, 1),
    ]
    alone = df.filter("n = 'a'")
    assert rows_of(ranking.ordinal_percentile(alone, ["n"], "pct"), "pct") == [(0.5,)]
    placed = ranking.ordinal_percentile(df, [F.desc("goals"), F.col("n")], "pct")
    assert rows_of(placed, "n", "pct") == [("a", 1.0), ("b", 0.6667), ("c", 0.3333), ("d", 0.0)]


def test_streaks(season):
    played = season.filter("game is not null")
    found = streaks.current_streak(played, ["player"], ["d"], {"two": F.col("sog") >= 2, "one": F.col("sog") >= 1, "ten": F.col("sog") >= 10})
    assert rows_of(found) == [("p", 1, 5, 0)]
    assert rows_of(streaks.win_loss_streak(played, ["player"], ["d"], F.col("sog") < 4)) == [("p", "L1")]
    rates = streaks.hit_rates_last_n(played, ["player"], [F.desc("d")], {"hit": F.col("sog") >= 2}, {"sum": F.col("sog")}, [2, 4], {"run": F.col("sog") != 4})
    assert rates.select("hit_last_2", "sum_last_2", "hit_last_4", "sum_last_4", "n_last_4", "run").first() == (1, 6, 2, 11, 4, 2)


def _league(spark):
    rng = random.Random(11)
    rows = []
    for g in range(400):
        team = "T0" if g % 3 == 0 else f"T{g % 7}"
        value = None if rng.random() < 0.2 else float(rng.randint(0, 12))
        rows.append((g, g // 4, team, f"T{(g * 5) % 6}", value))
    return spark.createDataFrame(rows, "game int, d int, team string, opponent string, v double")


def _both_ways(spark, build):
    plain = rows_of(build())
    spark.conf.set(HOT_ROWS_CONF, "25")
    try:
        split = rows_of(build())
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert plain and plain == split


def test_hot_teams_have_the_same_form(spark):
    df = _league(spark)
    counted = rolling.games_played(df, ["team"], ["d", "game"], "game", "n")
    counted = rolling.games_played(counted, ["team", "opponent"], ["d", "game"], "game", "m")
    _both_ways(spark, lambda: rolling.team_form(counted, "team", "opponent", ["d", "game"], ["v"], "n", "m"))


def test_hot_groups_have_the_same_median(spark):
    df = _league(spark)
    _both_ways(spark, lambda: rolling.group_median(df, ["team"], {"v": "mid"}))
    _both_ways(spark, lambda: rolling.group_median(df, [], {"v": "mid"}))


def test_hot_leagues_have_the_same_ranks(spark):
    df = _league(spark)
    _both_ways(spark, lambda: ranking.rank_form(df, ["team"], ["v"]))
    _both_ways(spark, lambda: ranking.rank_form(df, [], ["v"]))
    _both_ways(spark, lambda: ranking.ordinal_percentile(df, [F.desc_nulls_last("v"), F.col("game")], "pct"))
    _both_ways(spark, lambda: ranking.newest_first_counter(df, ["team"], [F.desc("d"), F.desc("game")], "c", "again"))
    _both_ways(spark, lambda: ranking.latest_flag(df, ["team"], ["d", "game"], "last"))


def test_newest_rows_are_limited_before_the_shuffle(spark):
    limited = streaks.newest_rows(_league(spark), ["team"], [F.desc("d"), F.desc("game")], 5)
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_form_windows_share_one_shuffle(spark, season):
    formed = rolling.rolling_form(season, ["player"], ["d"], ["sog", "game"])
    plan = formed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 1


def test_crowded_groups_are_found_without_a_shuffle(spark, tiny_groups):
    df = _league(spark)
    _, hot = split_hot(df, ["team"], hot_groups(df, ["team"]))
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_medians_outside_their_edges_are_counted_whole(spark, monkeypatch):
    df = _league(spark)
    want = rows_of(rolling.group_median(df, ["team"], {"v": "mid"}))

    def apart(rows, keys, measures):
        edges = F.array(F.lit(100.0), F.lit(101.0))
        return rows.select(*keys).distinct().select("*", *[edges.alias(f"_edges{i}") for i in range(len(measures))])

    monkeypatch.setattr(rolling, "_median_edges", apart)
    spark.conf.set(HOT_ROWS_CONF, "25")
    try:
        assert rows_of(rolling.group_median(df, ["team"], {"v": "mid"})) == want
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
