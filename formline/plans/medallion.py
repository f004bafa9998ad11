"""The game tables end to end: facts per situation, schedule, ranks, form,
upcoming rows, gates. Plain functions from DataFrames to DataFrames; write the
result of each layer as a table and pass the read-back table to the next.

Team facts: gameId, gameDate, season, team, opposingTeam, home_or_away,
situation and ``<stat>For``/``<stat>Against``. Player facts: playerId, name,
position, playerTeam, opposingTeam, gameId, gameDate, season, situation,
icetime, iceTimeRank and ``I_F_<stat>``. Schedule: GAME_ID, DATE, HOME, AWAY.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions.dates import parse_date, season_code
from formline.functions.numbers import ratio, zero_if_null
from formline.operators.joins import join_apart_from_nulls, null_safe_join
from formline.operators.lastknown import last_known_fill
from formline.operators.ordered import Running, hot_groups, over_ordered
from formline.operators.quality import assert_unique, distinct_keys, expect_or_fail
from formline.operators.ranking import latest_date_flag, rank_form, usage_rank
from formline.operators.rolling import games_played, player_form, running_totals, team_form
from formline.operators.schedule import (
    expand_schedule,
    home_and_away,
    next_game_per_member,
    null_id_after,
)
from formline.operators.shape import pick_columns, pivot_situation, union_all, zero_fill_counts

# Situations and the labels their columns carry.
SITUATION_LABELS = {"all": "Total", "5on4": "PP", "4on5": "PK", "5on5": "EV"}
PER_GAME = ("goals", "shotsOnGoal", "shotAttempts", "penalties")
TEAM_BASE = ("PP_goalsFor", "PK_goalsAgainst", "PP_shotsOnGoalFor", "PK_shotsOnGoalAgainst", "PP_shotAttemptsFor", "PK_shotAttemptsAgainst")
# Ratio name -> (running numerator, running number of chances).
TEAM_RATIOS = {
    "game_PP_goalsForPerPenalty": ("game_PP_goalsFor", "game_Total_penaltiesAgainst"),
    "game_PK_goalsAgainstPerPenalty": ("game_PK_goalsAgainst", "game_Total_penaltiesFor"),
    "game_PP_SOGForPerPenalty": ("game_PP_shotsOnGoalFor", "game_Total_penaltiesAgainst"),
    "game_PK_SOGAgainstPerPenalty": ("game_PK_shotsOnGoalAgainst", "game_Total_penaltiesFor"),
    "game_PP_SOGAttemptsForPerPenalty": ("game_PP_shotAttemptsFor", "game_Total_penaltiesAgainst"),
    "game_PK_SOGAttemptsAgainstPerPenalty": ("game_PK_shotAttemptsAgainst", "game_Total_penaltiesFor"),
}
KEY_METRICS = (
    "previous_perc_rank_rolling_game_Total_goalsFor",
    "previous_perc_rank_rolling_game_Total_shotsOnGoalFor",
    "opponent_previous_perc_rank_rolling_game_Total_goalsAgainst",
    "opponent_previous_perc_rank_rolling_game_Total_shotsOnGoalAgainst",
    "previous_player_Total_iceTimeRank",
)


def silver_schedule(schedule: DataFrame) -> DataFrame:
    """Two rows per scheduled game, one per team."""
    dated = schedule.withColumn("DATE", parse_date("DATE", ("yyyy-MM-dd", "M/d/yyyy")))
    return expand_schedule(dated, "HOME", "AWAY", "playerTeam", "opposingTeam", "home_or_away")


def silver_games(team_facts: DataFrame, schedule: DataFrame, cutoff) -> DataFrame:
    """One row per (game, team): all situations side by side, joined with the
    schedule; games after the cutoff are upcoming and have a null id."""
    keys = ["gameId", "gameDate", "season", "team", "opposingTeam", "home_or_away"]
    stats = [c for c in team_facts.columns if c.endswith(("For", "Against", "Percentage"))]
    facts = team_facts.withColumn("gameDate", parse_date("gameDate"))
    wide = pivot_situation(facts, keys, "situation", SITUATION_LABELS, stats, "game_", base="all")
    wide = zero_fill_counts(wide, ["game_"]).withColumnRenamed("team", "playerTeam")
    planned = silver_schedule(schedule).select(
        F.col("DATE").alias("gameDate"), "playerTeam", "opposingTeam", "home_or_away"
    )
    on = ["gameDate", "playerTeam", "opposingTeam", "home_or_away"]
    joined = join_apart_from_nulls(wide, planned.distinct(), on, "full_outer")
    home, away = home_and_away("playerTeam", "opposingTeam", "home_or_away")
    out = null_id_after(joined, "gameId", "gameDate", cutoff).select(
        *joined.columns, home.alias("HOME"), away.alias("AWAY")
    )
    # A season is taken from the filled date, never from a missing one.
    return out.withColumn("season", F.coalesce("season", season_code("gameDate")))


def silver_team_ranks(games: DataFrame) -> DataFrame:
    """Played games with running sums, per-game rates, per-penalty ratios and
    their direction-aware ranks: among teams with as many games, and for a
    team's latest date among the latest rows of all teams."""
    played = games.filter(F.col("gameId").isNotNull())
    order = ["gameDate", "gameId"]
    # Measured on the input; finer groups are only crowded where coarser ones are.
    hot = hot_groups(played, ["playerTeam", "season"])
    matchup = ["playerTeam", "opposingTeam", "season"]
    hot_matchup = None if hot is None else hot_groups(played, matchup)
    counted = games_played(played, ["playerTeam", "season"], order, "gameId", "teamGamesPlayedRolling", hot=hot)
    counted = games_played(counted, matchup, order, "gameId", "teamMatchupPlayedRolling", hot=hot_matchup)
    per_game = [f"game_Total_{m}{side}" for m in PER_GAME for side in ("For", "Against")]
    base = [f"game_{c}" for c in TEAM_BASE]
    rolled = running_totals(counted, ["playerTeam", "season"], order, [*per_game, *base], hot=hot)
    n = "teamGamesPlayedRolling"
    rolled = rolled.select(
        "*",
        *[ratio(f"rolling_{c}", n).alias(f"rolling_per_{c}") for c in per_game],
        *[ratio(f"rolling_{a}", f"rolling_{b}").alias(f"rolling_{name}") for name, (a, b) in TEAM_RATIOS.items()],
    )
    ranked_by = {f"rolling_per_{c}": c for c in per_game} | {f"rolling_{r}": r for r in TEAM_RATIOS}
    return _ranked_with_latest(rolled, ranked_by, n)


def _ranked_with_latest(rolled: DataFrame, ranked_by: dict[str, str], games: str) -> DataFrame:
    flagged = latest_date_flag(rolled, ["playerTeam"], "gameDate", "is_last_played_game_team")
    among_equals = rank_form(flagged, [games, "season"], list(ranked_by))
    latest = flagged.filter("is_last_played_game_team = 1")
    among_latest = rank_form(latest.select("gameId", "playerTeam", "season", *ranked_by), ["season"], list(ranked_by))
    names = {f"{kind}_{by}": f"{kind}_rolling_{c}" for by, c in ranked_by.items() for kind in ("rank", "perc_rank")}
    marks = among_latest.select("gameId", "playerTeam", *[F.col(c).alias(f"_l_{c}") for c in names])
    both = null_safe_join(among_equals, marks, ["gameId", "playerTeam"], "left")
    return both.select(
        *flagged.columns, *[F.coalesce(F.col(f"_l_{c}"), F.col(c)).alias(name) for c, name in names.items()]
    )


def silver_players(player_facts: DataFrame) -> DataFrame:
    """One row per (game, player) with all situations, usage ranks inside the
    team and game, and zero-filled counts."""
    keys = ["gameId", "gameDate", "season", "playerId", "name", "position", "playerTeam", "opposingTeam", "home_or_away"]
    stats = ["icetime", *[c for c in player_facts.columns if c.startswith("I_F_")]]
    facts = player_facts.withColumn("gameDate", parse_date("gameDate"))
    wide = pivot_situation(facts, keys, "situation", SITUATION_LABELS, stats, "player_", base="all")
    wide = zero_fill_counts(wide.withColumnsRenamed({c: c.replace("I_F_", "") for c in wide.columns}), ["player_"])
    for label in ("Total", "PP"):
        wide = usage_rank(wide, ["gameId", "playerTeam"], f"player_{label}_icetime", f"player_{label}_iceTimeRank")
    return wide.withColumnRenamed("name", "shooterName")


def silver_player_ranks(players: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Running per-game rates of players and their ranks inside the team among
    players with as many games."""
    order = ["gameDate", "gameId"]
    entity = ["playerId", "playerTeam", "season"]
    hot = hot_groups(players, entity)
    counted = games_played(players, entity, order, "gameId", "_games", hot=hot)
    rolled = running_totals(counted, entity, order, measures, games="_games", hot=hot)
    rates = [f"rolling_per_game_{m}" for m in measures]
    ranked = rank_form(rolled, ["_games", "playerTeam", "season"], rates)
    names = {f"{k}_rolling_per_game_{m}": f"{k}_rolling_{m}" for m in measures for k in ("rank", "perc_rank")}
    return ranked.withColumnsRenamed(names).drop("_games")


def roster_of(players: DataFrame) -> DataFrame:
    """(playerTeam, season, playerId, shooterName, position) seen in facts; the
    team belongs to the key, so a traded player appears with both teams."""
    return players.select("playerTeam", "season", "playerId", "shooterName", "position").distinct()


def gold_player_form(
    players: DataFrame, games: DataFrame, roster: DataFrame, measures: Sequence[str], include_current: str = "never"
) -> DataFrame:
    """Played rows and each roster member's next game, with form per player
    and per matchup, and running counts."""
    upcoming = games.filter(F.col("gameId").isNull()).select(
        "gameDate", "season", "playerTeam", "opposingTeam", "home_or_away"
    )
    player = ["playerId", "shooterName"]
    following = next_game_per_member(upcoming, roster, ["playerTeam", "season"], player, ["gameDate", "playerTeam"])
    rows = union_all(players, following)
    order = ["gameDate", F.col("gameId").asc_nulls_last(), "playerTeam"]
    entity, matchup = ["playerId", "playerTeam", "season"], ["playerId", "playerTeam", "opposingTeam", "season"]
    hot = hot_groups(rows, entity)
    rows = games_played(rows, entity, order, "gameId", "playerGamesPlayedRolling", hot=hot)
    rows = games_played(
        rows, matchup, order, "gameId", "playerMatchupPlayedRolling", hot=None if hot is None else hot_groups(rows, matchup)
    )
    shares = [
        ratio(f"player_{s}_shotsOnGoal", "player_Total_shotsOnGoal").alias(f"player_SOG%_{s}") for s in ("PP", "EV")
    ]
    rows = rows.select("*", *shares)
    faced = Running("previous_opposingTeam", F.col("opposingTeam"), "last", strict=True)
    return player_form(
        rows,
        player,
        ["playerId", "playerTeam", "shooterName", "opposingTeam"],
        order,
        [*measures, "player_SOG%_PP", "player_SOG%_EV"],
        F.col("gameId").isNotNull(),
        include_current,
        extra=[faced],
    )


def gold_game_form(ranks: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Form of team, faced opponent and matchup over the ranked games."""
    return team_form(
        ranks,
        "playerTeam",
        "opposingTeam",
        ["gameDate", "gameId"],
        measures,
        "teamGamesPlayedRolling",
        "teamMatchupPlayedRolling",
    )


def gold_model(player_rows: DataFrame, game_form: DataFrame) -> DataFrame:
    """Player rows with the form of their team's game; upcoming rows take the
    last known form of the matchup, else of the team (or opponent)."""
    own = set(player_rows.columns)
    keys = ["gameId", "gameDate", "playerTeam", "opposingTeam", "season", "home_or_away"]
    stats = [c for c in game_form.columns if c not in own and c not in keys]
    merged = null_safe_join(player_rows, game_form.select(*keys, *stats), keys, "left")
    against = [c for c in stats if c.startswith(("opponent_", "matchup_"))]
    team = [c for c in stats if c not in against]
    filled = last_known_fill(
        merged,
        game_form,
        [(["playerTeam", "opposingTeam"], stats), (["playerTeam"], team), (["opposingTeam"], against)],
        ["gameDate", "gameId"],
    )
    filled = filled.withColumn("isHome", (F.col("home_or_away") == "HOME").cast("int"))
    total = Running("rolling_playerTotalTimeOnIceInGame", zero_if_null("player_Total_icetime"), "sum")
    timed = over_ordered(filled, ["playerId"], ["gameDate", F.col("gameId").asc_nulls_last(), "playerTeam"], [total])
    keep = [
        "gameDate", "gameId", "season", "position", "home_or_away", "isHome", "playerTeam", "opposingTeam", "playerId",
        "shooterName", "playerGamesPlayedRolling", "playerMatchupPlayedRolling", "teamGamesPlayedRolling",
        "teamMatchupPlayedRolling", "player_Total_shotsOnGoal", "rolling_playerTotalTimeOnIceInGame",
    ]
    return pick_columns(timed, keep, ["previous", "average", "matchup", "opponent"])


def check_gold(model: DataFrame, as_of, key_metrics: Sequence[str] = KEY_METRICS, share: float = 0.70) -> None:
    """Raise unless every player has at most one upcoming row, (game, player)
    is unique, an upcoming date exists, the worst key metric is filled in
    enough upcoming rows, and percentiles lie in [0, 1]."""
    upcoming = F.col("gameId").isNull()
    per_player = model.filter(upcoming).groupBy("playerId").agg(F.count(F.lit(1)).alias("n"))
    expect_or_fail(per_player.agg(F.max("n").alias("n")), {"one upcoming row per player": "coalesce(n, 0) <= 1"})
    assert_unique(model, ["gameId", "playerId"])
    metrics = [c for c in key_metrics if c in model.columns]
    percentiles = [c for c in model.columns if "perc_rank" in c]
    outside = F.lit(False)
    for c in percentiles:
        outside = outside | F.coalesce(~F.col(c).between(0, 1), F.lit(False))
    filled = [F.count_if(upcoming & F.col(c).isNotNull()) for c in metrics]
    checks = model.agg(
        F.max(F.to_date("gameDate")).alias("last_date"),
        F.count_if(upcoming).alias("n"),
        (F.least(*filled) if len(filled) > 1 else filled[0] if filled else F.lit(0)).alias("worst"),
        F.count_if(outside).alias("outside"),
        distinct_keys(["playerId"]).alias("players"),
    )
    expect_or_fail(
        checks,
        {
            "upcoming dates": f"last_date >= date'{as_of}'",
            "key metrics": f"n = 0 or worst >= cast(n * {share} as bigint)",
            "percentiles in range": "outside = 0",
        },
    )
