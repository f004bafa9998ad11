"""End to end on a small hand-made league."""

import random

import pytest
from pyspark.sql import functions as F

from formline.operators.quality import QualityError
from formline.plans import medallion as m

TEAMS = ["BOS", "TOR", "NYR", "MTL"]
TEAM_STATS = ["goals", "shotsOnGoal", "shotAttempts", "penalties"]


def _league(spark):
    rng = random.Random(5)
    team_rows, player_rows, schedule = [], [], []
    game = 2023020000
    for day in range(1, 11):
        date = 20231000 + day
        order = TEAMS[:]
        rng.shuffle(order)
        for home, away in (order[:2], order[2:]):
            game += 1
            schedule.append((game, f"2023-10-{day:02d}", home, away))
            stats = {t: {s: rng.randint(1, 9) for s in TEAM_STATS} for t in (home, away)}
            for team, other, side in ((home, away, "HOME"), (away, home, "AWAY")):
                for situation, share in (("all", 3), ("5on4", 1), ("4on5", 1), ("5on5", 1)):
                    values = []
                    for s in TEAM_STATS:
                        values += [stats[team][s] * share, stats[other][s] * share]
                    team_rows.append((game, date, 20232024, team, other, side, situation, *values))
                    for p in range(3):
                        shots = rng.randint(0, 5) if situation == "all" else 1
                        player_rows.append(
                            (f"{team}{p}", f"{team} {p}", "C", team, other, side, game, date, 20232024, situation, 600.0 + 10 * p, shots, shots)
                        )
    for home, away, day in (("BOS", "TOR", 20), ("NYR", "MTL", 20), ("BOS", "MTL", 22)):
        game += 1
        schedule.append((game, f"2023-10-{day}", home, away))
    sides = ", ".join(f"{s}For int, {s}Against int" for s in TEAM_STATS)
    teams = spark.createDataFrame(
        team_rows,
        f"gameId int, gameDate int, season int, team string, opposingTeam string, home_or_away string, situation string, {sides}",
    )
    players = spark.createDataFrame(
        player_rows,
        "playerId string, name string, position string, playerTeam string, opposingTeam string, home_or_away string, gameId int, "
        "gameDate int, season int, situation string, icetime double, I_F_shotsOnGoal int, I_F_goals int",
    )
    return teams, players, spark.createDataFrame(schedule, "GAME_ID int, DATE string, HOME string, AWAY string")


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    tmp_path = tmp_path_factory.mktemp("league")
    teams, facts, schedule = _league(spark)

    def written(df, name):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    games = written(m.silver_games(teams, schedule, "2023-10-15"), "games")
    ranks = written(m.silver_team_ranks(games), "ranks")
    players = written(m.silver_players(facts), "players")
    measures = ["player_Total_shotsOnGoal", "player_Total_icetime", "player_Total_iceTimeRank"]
    form = written(m.gold_player_form(players, games, m.roster_of(players), measures), "form")
    stats = [c for c in ranks.columns if c.startswith("perc_rank_rolling_game_Total") or c == "game_Total_shotsOnGoalFor"]
    return games, ranks, players, written(m.gold_model(form, m.gold_game_form(ranks, stats)), "model")


def test_league_end_to_end(gold):
    games, ranks, players, model = gold
    assert games.filter("gameId is not null").count() == 40
    assert games.filter("gameId is null").count() == 6
    assert games.filter("season <> 20232024").count() == 0
    assert ranks.count() == 40
    assert ranks.filter("rank_rolling_game_Total_goalsFor not between 1 and 40").count() == 0
    assert players.count() == 120
    assert players.filter("player_Total_iceTimeRank not between 1 and 3").count() == 0
    upcoming = model.filter("gameId is null")
    assert upcoming.count() == 12
    # BOS plays on the 20th and the 22nd; only the next game is kept.
    assert [r[0].isoformat() for r in upcoming.select("gameDate").distinct().collect()] == ["2023-10-20"]
    assert upcoming.filter("previous_perc_rank_rolling_game_Total_goalsFor is null").count() == 0
    m.check_gold(model, "2023-10-15")
    with pytest.raises(QualityError):
        m.check_gold(model, "2023-11-15")
    with pytest.raises(QualityError):
        m.check_gold(model.unionByName(model.limit(1)), "2023-10-15")


def test_form_is_leak_free(gold):
    _, _, players, model = gold
    order = ["gameDate", "gameId"]
    sog = [r[0] for r in players.filter("playerId = 'BOS1'").orderBy(*order).select("player_Total_shotsOnGoal").collect()]
    seen = [
        r[0]
        for r in model.filter("playerId = 'BOS1'")
        .orderBy("gameDate", F.asc_nulls_last("gameId"))
        .select("average_player_Total_shotsOnGoal_last_3_games")
        .collect()
    ]
    want = [0.0] + [round(sum(sog[max(0, i - 3) : i]) / len(sog[max(0, i - 3) : i]) + 1e-9, 2) for i in range(1, len(sog) + 1)]
    assert seen == pytest.approx(want, abs=0.006)
