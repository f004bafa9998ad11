"""Nested JSON game feeds to flat events, rosters and schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions.play import EVEN_STRENGTH_CODE
from formline.functions.text import clean_id, collapse_spaces, lookup_code
from formline.operators.schedule import keep_game_types

DETAILS = """struct<eventOwnerTeamId: string, shootingPlayerId: string, scoringPlayerId: string,
  assist1PlayerId: string, assist2PlayerId: string, assist1Id: string, assist2Id: string,
  hittingPlayerId: string, playerId: string, xCoord: double, yCoord: double, zoneCode: string>"""
PLAY = f"""struct<typeDescKey: string, type: string, timeInPeriod: string, time: string,
  situationCode: string, strength: string, period: int, periodDescriptor: struct<number: int>,
  pid: string, pid1: string, pid2: string, pid3: string, teamid: string,
  xcoord: double, ycoord: double, zonecode: string, details: {DETAILS}>"""
SPOT = "struct<playerId: string, firstName: struct<default: string>, lastName: struct<default: string>, name: string>"
TEAM = "struct<id: string, abbrev: string, forwards: array<struct<playerId: string>>, defense: array<struct<playerId: string>>>"
GAME_SCHEMA = f"""game_id string, season int, game_date int, home {TEAM}, away {TEAM},
  plays array<{PLAY}>, data struct<game: struct<plays: struct<play: array<{PLAY}>>>>, rosterSpots array<{SPOT}>"""
SCHEDULE_SCHEMA = """id string, season int, gameType int, gameDate string, startTimeUTC string, gameState string,
  homeTeam struct<abbrev: string, score: int>, awayTeam struct<abbrev: string, score: int>"""

# Spellings of event types, and strength codes of the older feed.
EVENT_NAMES = {"shot": "shot-on-goal", "missedshot": "missed-shot", "blockedshot": "blocked-shot"}
POWER_PLAY_STRENGTHS = ("702", "703")
POWER_PLAY_CODE = "1541"


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """Game documents with a fixed schema (one JSON document per line)."""
    return spark.read.schema(T.StructType.fromDDL(GAME_SCHEMA)).json(path)


def event_type(*spellings: Column) -> Column:
    raw = F.regexp_replace(F.lower(F.trim(F.coalesce(*spellings))), " ", "-")
    return F.coalesce(lookup_code(raw, EVENT_NAMES, default=None), raw)


def events_of(games: DataFrame) -> DataFrame:
    """Flat, normalized events in feed order, from either document shape and
    either field spelling."""
    plays = F.coalesce(F.col("plays"), F.col("data.game.plays.play"))
    rows = games.select(
        "game_id",
        "season",
        "game_date",
        clean_id("home.id").alias("home_id"),
        clean_id("away.id").alias("away_id"),
        F.posexplode(plays).alias("event_index", "e"),
    )

    def e(name: str) -> Column:
        return F.col(f"e.{name}")

    def d(name: str) -> Column:
        return F.col(f"e.details.{name}")

    kind = event_type(F.nullif(e("typeDescKey"), F.lit("")), e("type"))
    is_goal, is_hit = kind == "goal", kind == "hit"
    strength = F.when(e("strength").isin(*POWER_PLAY_STRENGTHS), POWER_PLAY_CODE)
    shooter = F.coalesce(d("shootingPlayerId"), e("pid"), e("pid1"))
    ids = {
        "owner_id": F.coalesce(d("eventOwnerTeamId"), e("teamid")),
        "shooter_id": shooter,
        "scorer_id": F.coalesce(d("scoringPlayerId"), F.when(is_goal, e("pid1"))),
        "assist1_id": F.coalesce(d("assist1PlayerId"), d("assist1Id"), e("pid2")),
        "assist2_id": F.coalesce(d("assist2PlayerId"), d("assist2Id"), e("pid3")),
        "hitter_id": F.coalesce(d("hittingPlayerId"), F.when(is_hit, F.coalesce(e("pid1"), e("pid")))),
        "actor_id": F.coalesce(d("playerId"), e("pid1"), e("pid")),
    }
    return rows.select(
        "game_id",
        "season",
        "game_date",
        "home_id",
        "away_id",
        "event_index",
        kind.alias("type"),
        F.coalesce(e("periodDescriptor.number"), e("period"), F.lit(0)).alias("period"),
        F.coalesce(F.nullif(e("timeInPeriod"), F.lit("")), e("time"), F.lit("00:00")).alias("clock"),
        F.coalesce(F.nullif(e("situationCode"), F.lit("")), strength, F.lit(EVEN_STRENGTH_CODE)).alias("code"),
        *[clean_id(c).alias(n) for n, c in ids.items()],
        F.coalesce(d("xCoord"), e("xcoord")).alias("x"),
        F.coalesce(d("yCoord"), e("ycoord")).alias("y"),
        F.coalesce(d("zoneCode"), e("zonecode")).alias("zone"),
    )


def rosters_of(games: DataFrame) -> DataFrame:
    """(game_id, player_id, is_home, team, opponent, name): forwards and
    defense of both sides, named from the roster spots."""
    def side(mine: str, theirs: str, home: bool) -> DataFrame:
        members = F.concat(
            F.coalesce(f"{mine}.forwards", F.expr("array()")), F.coalesce(f"{mine}.defense", F.expr("array()"))
        )
        return games.select(
            "game_id",
            F.explode(members).alias("_m"),
            F.lit(home).alias("is_home"),
            F.col(f"{mine}.abbrev").alias("team"),
            F.col(f"{theirs}.abbrev").alias("opponent"),
        ).select("game_id", clean_id("_m.playerId").alias("player_id"), "is_home", "team", "opponent")

    members = side("home", "away", True).unionByName(side("away", "home", False)).distinct()
    spots = games.select("game_id", F.explode("rosterSpots").alias("_s"))
    full = collapse_spaces(F.concat_ws(" ", "_s.firstName.default", "_s.lastName.default"))
    names = spots.select(
        "game_id", clean_id("_s.playerId").alias("player_id"), F.coalesce(F.nullif(full, F.lit("")), "_s.name").alias("name")
    )
    named = names.groupBy("game_id", "player_id").agg(F.min("name").alias("name"))
    return members.join(named, ["game_id", "player_id"], "left")


def read_schedule(spark: SparkSession, path: str, finished_only: bool = False) -> DataFrame:
    """Schedule feed rows of counting game types; ``finished_only`` keeps games
    that are over and have both scores."""
    rows = keep_game_types(spark.read.schema(T.StructType.fromDDL(SCHEDULE_SCHEMA)).json(path))
    if finished_only:
        over = F.col("gameState").isin("OFF", "FINAL")
        rows = rows.filter(over & F.col("homeTeam.score").isNotNull() & F.col("awayTeam.score").isNotNull())
    return rows.select(
        clean_id("id").alias("GAME_ID"),
        "season",
        "gameType",
        F.try_to_date(F.col("gameDate"), "yyyy-MM-dd").alias("DATE"),
        F.col("homeTeam.abbrev").alias("HOME"),
        F.col("awayTeam.abbrev").alias("AWAY"),
        F.col("homeTeam.score").alias("home_score"),
        F.col("awayTeam.score").alias("away_score"),
    )
