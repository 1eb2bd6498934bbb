"""Shared blocks of the queries: who dressed, what every player did in a game, how every team fared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.functions.columns import distance, is_position, result, strength
from rinkline.operators.measures import ROLE_MEASURES, TEAM_MEASURES
from rinkline.sources.derived import League

#: Role of a player in a play, by the column that names the player.
ROLES = {
    "scoring_player_id": "scorer",
    "assist1_player_id": "assist1",
    "assist2_player_id": "assist2",
    "shooting_player_id": "shooter",
    "blocking_player_id": "blocker",
    "hitting_player_id": "hitter",
    "hittee_player_id": "hittee",
    "winning_player_id": "winner",
    "losing_player_id": "loser",
    "committed_by_player_id": "committed",
    "drawn_by_player_id": "drawn",
    "player_id": "player",
}


def plays_with_strength(t: League, shootout: bool = False) -> DataFrame:
    """Plays with their game's teams, owner_is_home, strength and distance_ft; shootout plays only on demand."""
    plays = t.plays if shootout else t.plays.where(~F.col("period_type").eqNullSafe("SO"))
    sides = t.games.select("game_id", "home_team_id", "away_team_id")
    at_home = F.col("event_owner_team_id") == F.col("home_team_id")
    return plays.join(sides, "game_id").withColumns({"owner_is_home": at_home, "strength": strength(F.col("situation_code"), at_home), "distance_ft": distance(F.col("x_coord"), F.col("y_coord"))})


def narrowed(t: League, team: str | None = None, season: int | None = None, game_type: int | None = None, opponent: str | None = None, final_only: bool = False, game_id: int | None = None, **_) -> League:
    """The league with only the games that the filters leave; the plays of others go where blocks join plays with games, before they are exploded."""
    games = t.games.where("is_final") if final_only else t.games
    for name, value in (("season", season), ("game_type", game_type), ("game_id", game_id)):
        if value is not None:
            games = games.where(F.col(name) == value)
    for abbrev in (team, opponent):
        if abbrev is not None:
            chosen = F.broadcast(t.teams.where(F.col("abbrev") == abbrev).select("team_id"))
            games = games.join(chosen, F.col("team_id").isin(F.col("home_team_id"), F.col("away_team_id")), "left_semi")
    t = t.of_season(season)
    return League(games, t.rosters, t.plays, t.teams)


def player_games(
    t: League, team: str | None = None, season: int | None = None, game_type: int | None = 2, player: str | None = None, position: str | None = None, goalies: bool | None = False
) -> DataFrame:
    """One row per player and game dressed. goalies: only these, none, or (None) everyone."""
    t = t.of_season(season)
    games = t.games
    if season is not None:
        games = games.where(F.col("season") == season)
    if game_type is not None:
        games = games.where(F.col("game_type") == game_type)
    spots = t.rosters
    if goalies is not None:
        spots = spots.where((F.col("position_code") == "G") == F.lit(goalies))
    if position is not None:
        spots = spots.where(is_position(F.col("position_code"), position))
    home = F.col("team_id") == F.col("home_team_id")
    own, other = F.when(home, F.col("home_final_score")).otherwise(F.col("away_final_score")), F.when(home, F.col("away_final_score")).otherwise(F.col("home_final_score"))
    rows = spots.join(games, "game_id").select(
        "game_id", "player_id", "team_id", "position_code", "sweater_number", "season", "game_type", "game_date", "is_final", "last_period_type",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"), home.alias("is_home"), F.when(home, "Home").otherwise("Away").alias("venue"),
        F.when(home, F.col("away_team_id")).otherwise(F.col("home_team_id")).alias("opponent_id"), result(own, other, F.col("game_type"), F.col("last_period_type")).alias("result"),
    )
    rows = rows.join(t.teams.select("team_id", F.col("abbrev").alias("team")), "team_id").join(t.teams.select(F.col("team_id").alias("opponent_id"), F.col("abbrev").alias("opponent")), "opponent_id")
    if team is not None:
        rows = rows.where(F.col("team") == team)
    if player is not None:
        rows = rows.where(F.lower("full_name") == player.lower())
    return rows


def player_stats(t: League, shootout: bool = False) -> DataFrame:
    """One row per game and player with an event: every measure of the catalogue.

    Every play is exploded once into its (player, role) pairs, without nulls;
    one aggregation by (game, player) takes all measures.
    """
    plays = plays_with_strength(t, shootout)
    pairs = F.array(*(F.struct(F.col(c).alias("pid"), F.lit(r).alias("role")) for c, r in ROLES.items()))
    kept = ["game_id", "type_desc_key", "period_number", "period_type", "time_in_period", "strength", "penalty_desc_key", "penalty_duration"]
    rows = plays.select(*kept, F.explode(F.filter(pairs, lambda x: x.pid.isNotNull())).alias("r")).select(*kept, F.col("r.pid").alias("player_id"), F.col("r.role").alias("role"))
    measures = []
    for name, (kind, role, more) in ROLE_MEASURES.items():
        which = "role in ('assist1', 'assist2')" if role == "assist" else f"role = '{role}'"
        measures.append(F.expr(f"count_if(type_desc_key = '{kind}' and {which}{' and ' + more if more else ''})").alias(name))
    pim = F.sum(F.when((F.col("type_desc_key") == "penalty") & (F.col("role") == "committed"), F.coalesce("penalty_duration", F.lit(0))).otherwise(0)).cast("long").alias("pim")
    return rows.groupBy("game_id", "player_id").agg(*measures, pim)


def with_stats(people: DataFrame, stats: DataFrame) -> DataFrame:
    """player_games with every measure; 0 for those who dressed without an event."""
    names = [*ROLE_MEASURES, "pim"]
    return people.join(stats, ["game_id", "player_id"], "left").fillna(0, names)


def goalie_shots(t: League, **filters) -> DataFrame:
    """Every goal and shot on goal that a dressed goalie faced."""
    shots = plays_with_strength(narrowed(t, **({"game_type": 2} | filters))).where(F.col("type_desc_key").isin("goal", "shot-on-goal"))
    keep = ["game_id", F.col("goalie_in_net_id").alias("player_id"), (F.col("type_desc_key") == "goal").alias("is_goal"), "distance_ft", "strength", "zone_code", "shot_type", "period_number", "period_type"]
    return shots.where("goalie_in_net_id is not null").select(*keep).join(player_games(t, goalies=True, **filters), ["game_id", "player_id"])


def player_shots(t: League, **filters) -> DataFrame:
    """Every shot attempt of a dressed skater."""
    shots = plays_with_strength(narrowed(t, **({"game_type": 2} | filters))).where(F.col("type_desc_key").isin("goal", "shot-on-goal", "missed-shot", "blocked-shot"))
    kind = F.col("type_desc_key")
    keep = ["game_id", F.coalesce("scoring_player_id", "shooting_player_id").alias("player_id"), (kind == "goal").alias("is_goal"), kind.isin("goal", "shot-on-goal").alias("on_net"), (kind == "blocked-shot").alias("blocked"), "distance_ft", "strength", "zone_code", "shot_type", "period_number", "period_type", "goalie_in_net_id"]
    return shots.select(*keep).where("player_id is not null").join(player_games(t, **filters), ["game_id", "player_id"])


def team_games(t: League, team: str | None = None, season: int | None = None, game_type: int | None = 2, opponent: str | None = None, final_only: bool = True) -> DataFrame:
    """Two rows per game, one for each team."""
    games = t.games
    if final_only:
        games = games.where("is_final")
    if season is not None:
        games = games.where(F.col("season") == season)
    if game_type is not None:
        games = games.where(F.col("game_type") == game_type)
    side = lambda own, other, home: F.struct(F.col(f"{own}_team_id").alias("team_id"), F.col(f"{other}_team_id").alias("opponent_id"), F.col(f"{own}_final_score").alias("score_for"), F.col(f"{other}_final_score").alias("score_against"), F.lit(home).alias("is_home"))
    rows = games.select("game_id", "season", "game_type", "game_date", "is_final", F.col("last_period_type").alias("decided_in"), F.inline(F.array(side("home", "away", True), side("away", "home", False))))
    rows = rows.withColumns({
        "result": F.when(~F.col("is_final"), "In progress").otherwise(result(F.col("score_for"), F.col("score_against"), F.col("game_type"), F.col("decided_in"))),
        "venue": F.when(F.col("is_home"), "Home").otherwise("Away"),
    })
    rows = rows.join(t.teams.select("team_id", F.col("abbrev").alias("team")), "team_id").join(t.teams.select(F.col("team_id").alias("opponent_id"), F.col("abbrev").alias("opponent")), "opponent_id")
    if team is not None:
        rows = rows.where(F.col("team") == team)
    if opponent is not None:
        rows = rows.where(F.col("opponent") == opponent)
    return rows


def team_events(t: League) -> DataFrame:
    """Every play as each of the two teams sees it: side, strength, the blocker's team. The shooter's team owns a blocked shot."""
    plays = plays_with_strength(t)
    blockers = t.rosters.select("game_id", F.col("player_id").alias("blocking_player_id"), F.col("team_id").alias("blocker_team_id"))
    blocked = plays.where("blocking_player_id is not null").join(blockers, ["game_id", "blocking_player_id"], "left")
    rest = plays.where("blocking_player_id is null").withColumn("blocker_team_id", F.lit(None).cast("int"))
    both = blocked.unionByName(rest).withColumn("team_id", F.explode(F.array("home_team_id", "away_team_id")))
    return both.withColumn("side", F.when(F.col("event_owner_team_id") == F.col("team_id"), "for").otherwise("against"))


def team_stats(t: League) -> DataFrame:
    """One row per game and team: every team measure."""
    pim = lambda side: F.sum(F.when((F.col("type_desc_key") == "penalty") & (F.col("side") == side), F.coalesce("penalty_duration", F.lit(0))).otherwise(0)).cast("long")
    measures = [F.expr(f"count_if({condition})").alias(name) for name, condition in TEAM_MEASURES.items()]
    return team_events(t).groupBy("game_id", "team_id").agg(*measures, pim("for").alias("pim"), pim("against").alias("opp_pim"))


def team_game_stats(t: League, **filters) -> DataFrame:
    names = [*TEAM_MEASURES, "pim", "opp_pim"]
    return team_games(t, **filters).join(team_stats(narrowed(t, **({"game_type": 2, "final_only": True} | filters))), ["game_id", "team_id"], "left").fillna(0, names)
