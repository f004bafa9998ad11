"""Feeds and play statistics on hand-made games."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from formline.operators import events as ev
from formline.sources import feeds


def _play(kind, clock, owner, code="1551", period=1, **details):
    return {
        "typeDescKey": kind,
        "timeInPeriod": clock,
        "situationCode": code,
        "periodDescriptor": {"number": period},
        "details": {"eventOwnerTeamId": owner, **details},
    }


GAME = {
    "game_id": "1",
    "season": 20232024,
    "game_date": 20231010,
    "home": {"id": 7, "abbrev": "BOS", "forwards": [{"playerId": 11}], "defense": [{"playerId": 12}]},
    "away": {"id": 1, "abbrev": "TOR", "forwards": [{"playerId": 21}], "defense": []},
    "plays": [
        _play("shot-on-goal", "05:00", 7, shootingPlayerId=11, xCoord=79.0, yCoord=0.0, zoneCode="O"),
        _play("goal", "05:03", 7, scoringPlayerId=11, assist1PlayerId=12, xCoord=60.0, yCoord=10.0, zoneCode="O"),
        _play("shot-on-goal", "05:07", 7, shootingPlayerId=12, zoneCode="D"),
        _play("blocked-shot", "06:00", 7, shootingPlayerId=12),
        _play("missed-shot", "07:00", 1, "1541", shootingPlayerId=21),
        _play("hit", "08:00", 1, hittingPlayerId=21),
        _play("takeaway", "09:00", 7, playerId=12),
    ],
    "rosterSpots": [
        {"playerId": 11, "firstName": {"default": "Al"}, "lastName": {"default": "One"}},
        {"playerId": 12, "name": "Bo Two"},
        {"playerId": 21, "firstName": {"default": "Cy"}, "lastName": {"default": "Three"}},
    ],
}
OTHER_SHAPE = {
    "game_id": "2",
    "season": 20232024,
    "game_date": 20231011,
    "home": {"id": 7, "abbrev": "BOS"},
    "away": {"id": 1, "abbrev": "TOR"},
    "data": {
        "game": {
            "plays": {
                "play": [
                    {"type": "Shot", "pid": 11, "teamid": 7, "xcoord": 80.0, "ycoord": 1.0, "period": 2, "time": "01:00", "strength": 701},
                    {"type": "Goal", "pid1": 21, "pid2": 22, "teamid": 1, "period": 2, "time": "02:00", "strength": 702},
                    {"type": "Missed Shot", "pid": 11, "teamid": 7, "period": 2, "time": "03:00"},
                    {"type": "Hit", "pid1": 12, "teamid": 7, "period": 2, "time": "04:00"},
                ]
            }
        }
    },
}


@pytest.fixture
def games(spark, tmp_path):
    path = tmp_path / "games.json"
    path.write_text("\n".join(json.dumps(g) for g in (GAME, OTHER_SHAPE)))
    return feeds.read_games(spark, str(path))


def test_events_of_both_shapes(games):
    flat = feeds.events_of(games)
    assert rows_of(flat.filter("game_id = '2'"), "event_index", "type", "shooter_id", "scorer_id", "assist1_id", "hitter_id", "owner_id", "code", "period", "clock") == [
        (0, "shot-on-goal", "11", None, None, None, "7", "1551", 2, "01:00"),
        (1, "goal", "21", "21", "22", None, "1", "1541", 2, "02:00"),
        (2, "missed-shot", "11", None, None, None, "7", "1551", 2, "03:00"),
        (3, "hit", "12", None, None, "12", "7", "1551", 2, "04:00"),
    ]
    assert flat.filter("game_id = '1'").count() == 7


def test_rosters(games):
    named = feeds.rosters_of(games)
    assert rows_of(named, "player_id", "is_home", "team", "opponent", "name") == [
        ("11", True, "BOS", "TOR", "Al One"), ("12", True, "BOS", "TOR", "Bo Two"), ("21", False, "TOR", "BOS", "Cy Three"),
    ]


def test_team_stats(games):
    stats = ev.team_stats(feeds.events_of(games.filter("game_id = '1'"))).cache()
    assert stats.count() == 8
    home = stats.filter("team_id = '7' and situation = 'all'").first()
    assert (home.shotsOnGoalFor, home.goalsFor, home.blockedShotAttemptsFor, home.missedShotsAgainst) == (3, 1, 1, 1)
    assert (home.shotAttemptsFor, home.unblockedShotAttemptsFor, home.savedShotsOnGoalFor) == (4, 3, 2)
    assert (home.highDangerShotsFor, home.mediumDangerGoalsFor, home.takeawaysFor, home.hitsAgainst) == (1, 1, 1, 1)
    # 05:00 to 05:03 is a rebound and a goal; 05:07 is four seconds later.
    assert (home.reboundsFor, home.reboundGoalsFor) == (1, 1)
    assert (home.playContinuedInZoneFor, home.playContinuedOutsideZoneFor) == (1, 1)
    assert (home.corsiPercentage, home.fenwickPercentage) == (80.0, 75.0)
    away = stats.filter("team_id = '1' and situation = 'all'").first()
    assert (away.reboundsAgainst, away.reboundGoalsAgainst, away.corsiPercentage) == (1, 1, 20.0)
    idle = stats.filter("team_id = '7' and situation = '5on4'").first()
    assert (idle.shotsOnGoalFor, idle.corsiPercentage) == (0, 50.0)
    short = stats.filter("team_id = '7' and situation = '4on5'").first()
    assert (short.missedShotsAgainst, short.corsiPercentage) == (1, 0.0)


def test_possession_without_attempts_and_with_block(spark):
    rows = [("g", "A", "B", "A", "1551", t) for t in ("shot-on-goal", "missed-shot", "blocked-shot")] + [("g", "A", "B", "B", "1551", "shot-on-goal")]
    df = spark.createDataFrame(rows, "game_id string, home_id string, away_id string, owner_id string, code string, type string")
    row = ev.possession(df).filter("team_id = 'A' and situation = 'all'").first()
    assert (row.corsiPercentage, row.fenwickPercentage) == (75.0, 66.67)


def test_player_stats(spark, games):
    events = feeds.events_of(games)
    shifts = spark.createDataFrame(
        [
            ("1", "11", 1, "04:58", "05:03", "00:05"),
            ("1", "11", 1, "05:03", "05:30", "00:27"),
            ("1", "21", 1, "06:58", "07:00", "00:02"),
            ("1", "12", 2, "00:00", "20:00", "20:00"),
        ],
        "game_id string, player_id string, period int, startTime string, endTime string, duration string",
    )
    # Game 2 has no shifts: its on-ice values are unknown, not "everything".
    players = feeds.rosters_of(games).select("game_id", "player_id", "is_home").union(spark.createDataFrame([("2", "11", True)], "g string, p string, h boolean"))
    stats = ev.player_stats(events, shifts, players).cache()
    assert stats.count() == 16
    al = stats.filter("game_id = '1' and player_id = '11' and situation = 'all'").first()
    assert (al.I_F_goals, al.I_F_shotsOnGoal, al.I_F_points, al.I_F_highDangerShots, al.I_F_mediumDangerGoals) == (1, 2, 1, 1, 1)
    # The event at 05:03 touches both shifts and counts once.
    assert (al.OnIce_F_shotsOnGoal, al.OnIce_A_shotsOnGoal, al.OnIce_F_goals, al.onIce_corsiPercentage) == (3, 0, 1, 100.0)
    assert (al.OffIce_F_shotAttempts, al.OffIce_A_shotAttempts, al.offIce_corsiPercentage) == (1, 1, 50.0)
    assert (al.icetime, al.shifts) == (32.0, 2)
    bo = stats.filter("game_id = '1' and player_id = '12' and situation = 'all'").first()
    assert (bo.I_F_primaryAssists, bo.I_F_takeaways, bo.OnIce_F_shotAttempts, bo.OffIce_F_shotAttempts) == (1, 1, 0, 4)
    cy = stats.filter("game_id = '1' and player_id = '21'")
    # The only shift starts two seconds before a play with the visitors up a skater.
    assert rows_of(cy.filter("shifts > 0"), "situation", "icetime", "OnIce_F_missedShots") == [("5on4", 2.0, 1), ("all", 2.0, 1)]
    lost = stats.filter("game_id = '2' and situation = 'all'").first()
    assert (lost.has_shifts, lost.I_F_shotsOnGoal, lost.OnIce_F_shotsOnGoal, lost.corsiPercentage) == (False, 1, None, None)


def test_player_stats_of_a_bounded_number_of_players_a_task(spark, games, monkeypatch):
    """The game's totals are not dealt to the players before the sums, and partitions follow the players; a player listed twice counts twice."""
    events = feeds.events_of(games)
    shifts = spark.createDataFrame([("1", "11", 1, "04:58", "05:30", "00:32"), ("1", "21", 1, "06:58", "07:00", "00:02")], "game_id string, player_id string, period int, startTime string, endTime string, duration string")
    players = feeds.rosters_of(games).select("game_id", "player_id", "is_home").distinct()
    want = ev.player_stats(events, shifts, players)
    monkeypatch.setattr(ev, "TASK_PLAYERS", 1)
    many = ev.player_stats(events, shifts, players)
    assert rows_of(many) == rows_of(want)
    assert "REPARTITION_BY_NUM, [plan_id" in (plan := many._jdf.queryExecution().executedPlan().toString()) and f", {players.count()}), REPARTITION_BY_NUM" in plan
    twice = ev.player_stats(events, shifts, players.union(players))
    kept = ["game_id", "player_id", "situation"]
    counts = [c for c in want.columns if c.startswith(("I_F_", "OnIce_", "OffIce_"))]
    doubled = want.select(*kept, *[(F.col(c) * 2).alias(c) for c in counts])
    assert rows_of(twice, *kept, *counts) == rows_of(doubled.union(doubled), *kept, *counts)


def test_schedule_feed(spark, tmp_path):
    rows = [
        {"id": 1, "season": 20232024, "gameType": 1, "gameDate": "2023-09-30", "homeTeam": {"abbrev": "BOS"}, "awayTeam": {"abbrev": "TOR"}},
        {"id": 2, "season": 20232024, "gameType": 2, "gameDate": "2023-10-10", "gameState": "OFF", "homeTeam": {"abbrev": "BOS", "score": 2}, "awayTeam": {"abbrev": "TOR", "score": 1}},
        {"id": 3, "season": 20232024, "gameType": 3, "gameDate": "2024-05-10", "gameState": "FUT", "homeTeam": {"abbrev": "BOS"}, "awayTeam": {"abbrev": "TOR"}},
    ]
    path = tmp_path / "schedule.json"
    path.write_text("\n".join(map(json.dumps, rows)))
    assert rows_of(feeds.read_schedule(spark, str(path)).select("GAME_ID", F.col("DATE").cast("string"))) == [("2", "2023-10-10"), ("3", "2024-05-10")]
    assert rows_of(feeds.read_schedule(spark, str(path), True), "GAME_ID", "home_score") == [("2", 2)]
