"""Queries that need more than the shared tables: game sheets, streaks, comebacks, pairs, rankings.

Game queries take game_id; None means every game, with game_id as a column.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinkline.functions.columns import SHOT_TYPES, distance_bucket, period_label
from rinkline.operators import blocks, gold
from rinkline.operators.measures import DERIVED, TEAM_DERIVED, ratio, share
from rinkline.queries.run import TOP_N, _cols, _records, _summed, leaderboard, skaters, team_rows
from rinkline.sources.derived import League


#: How a shot log calls the outcome of an attempt.
OUTCOMES = {"goal": "Goal", "shot-on-goal": "Saved", "missed-shot": "Missed", "blocked-shot": "Blocked"}


def _goal() -> Column:
    return F.col("type_desc_key") == "goal"


def _plays(t: League, game_id: int | None, shootout: bool = True) -> DataFrame:
    rows = blocks.plays_with_strength(blocks.narrowed(t, game_id=game_id), shootout)
    teams = t.teams.select(F.col("team_id").alias("event_owner_team_id"), F.col("abbrev").alias("team"))
    return rows.join(teams, "event_owner_team_id", "left").withColumn("period", period_label(F.col("period_number"), F.col("period_type")))


def _names(t: League) -> DataFrame:
    return t.rosters.select("game_id", "player_id", F.concat_ws(" ", "first_name", "last_name").alias("name"))


def named(rows: DataFrame, t: League, **roles: str) -> DataFrame:
    """rows with the name of each role's player, by one join: a map of the game's roster, of some forty players."""
    book = _names(t).groupBy("game_id").agg(F.map_from_entries(F.collect_list(F.struct("player_id", "name"))).alias("book"))
    return rows.join(book, "game_id", "left").withColumns({n: F.try_element_at("book", F.col(c)) for n, c in roles.items()}).drop("book")


def game_box_score(t: League, game_id: int | None = None) -> DataFrame:
    rows = blocks.team_game_stats(blocks.narrowed(t, game_id=game_id), game_type=None, final_only=False)
    return rows.select("game_id", "team", "venue", F.col("score_for").alias("score"), "result", "decided_in", F.col("sf").alias("shots"), F.col("cf").alias("attempts"), *_cols("attempt_share_pct shooting_pct pp_goals minors_drawn shorthanded_goals_for pim hits blocks takeaways giveaways faceoff_wins faceoff_pct", TEAM_DERIVED))


def _of_team(rows: DataFrame, team: str | None) -> DataFrame:
    return rows if team is None else rows.where(F.col("team") == team)


def game_faceoffs(t: League, game_id: int | None = None, team: str | None = None) -> DataFrame:
    """Zones are seen from the player's side: the winner's side as recorded, the loser's flipped."""
    rows = _plays(t, game_id).where("type_desc_key = 'faceoff'")
    flipped = F.when(F.col("zone_code") == "O", "D").when(F.col("zone_code") == "D", "O").otherwise(F.col("zone_code"))
    pairs = F.array(F.struct(F.col("winning_player_id").alias("p"), F.lit(True).alias("won"), F.col("zone_code").alias("z")), F.struct(F.col("losing_player_id").alias("p"), F.lit(False).alias("won"), flipped.alias("z")))
    each = rows.select("game_id", F.inline(pairs)).where("p is not null")
    people = t.rosters.select("game_id", F.col("player_id").alias("p"), "team_id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"))
    split = lambda zone: F.concat_ws("-", F.count_if((F.col("z") == zone) & F.col("won")), F.count_if((F.col("z") == zone) & ~F.col("won")))
    sums = each.join(people, ["game_id", "p"]).groupBy("game_id", "team_id", "full_name", "p").agg(
        F.count_if("won").alias("wins"), F.count_if(~F.col("won")).alias("losses"), split("O").alias("offensive_zone"), split("N").alias("neutral_zone"), split("D").alias("defensive_zone")
    )
    rows = _of_team(sums.join(t.teams.select("team_id", F.col("abbrev").alias("team")), "team_id"), team)
    pct = F.expr(share("wins", "wins + losses")).alias("faceoff_pct")
    return rows.select("game_id", "team", "full_name", "wins", "losses", pct, "offensive_zone", "neutral_zone", "defensive_zone")


def game_finder(t: League, opponent: str | None = None, game_type: int | None = None, game_date: str | None = None, **filters) -> DataFrame:
    t = blocks.narrowed(t, opponent=opponent, game_type=game_type, **filters)
    side = lambda s: t.teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("abbrev").alias(s))
    rows = t.games.join(side("away"), "away_team_id").join(side("home"), "home_team_id")
    if game_date is not None:
        rows = rows.where(F.col("game_date") == F.lit(game_date).cast("date"))
    return rows.select("game_id", "game_date", "away", F.col("away_final_score").alias("away_score"), "home", F.col("home_final_score").alias("home_score"), F.col("last_period_type").alias("decided_in"), "game_state", "venue")


def game_goalies(t: League, game_id: int | None = None) -> DataFrame:
    rows = blocks.goalie_shots(blocks.narrowed(t, game_id=game_id), game_type=None)
    of = lambda s, goals: F.count_if(F.col("strength").isin(*s) & (F.col("is_goal") if goals else F.lit(True)))
    sums = rows.groupBy("game_id", "team", "full_name").agg(
        F.count(F.lit(1)).alias("shots_faced"), F.count_if("is_goal").alias("goals_against"), of(["EV"], False).alias("ev_shots"), of(["EV"], True).alias("ev_goals"),
        of(["PP"], False).alias("pk_shots"), of(["PP"], True).alias("pk_goals"), of(["SH"], False).alias("sh_shots"), of(["SH"], True).alias("sh_goals"),
    )
    return sums.withColumns({"saves": F.col("shots_faced") - F.col("goals_against"), "save_pct": F.expr(ratio("shots_faced - goals_against", "shots_faced", 1, 3))})


def game_periods(t: League, game_id: int | None = None) -> DataFrame:
    rows = _plays(t, game_id, shootout=False).where("event_owner_team_id is not null")
    kind = F.col("type_desc_key")
    return rows.groupBy("game_id", "period", "team").agg(
        F.count_if(_goal()).alias("goals"), F.count_if(kind.isin("goal", "shot-on-goal")).alias("shots"), F.count_if(kind.isin(*SHOT_TYPES)).alias("attempts"),
        F.count_if(kind == "hit").alias("hits"), F.count_if(kind == "faceoff").alias("faceoff_wins"),
    )


def game_penalties(t: League, game_id: int | None = None) -> DataFrame:
    rows = _plays(t, game_id).where("type_desc_key = 'penalty'")
    rows = named(rows, t, committed_by="committed_by_player_id", drawn_by="drawn_by_player_id", served_by="served_by_player_id")
    return rows.select("game_id", "event_id", "period", F.col("time_in_period").alias("time"), "team", "committed_by", F.col("penalty_desc_key").alias("penalty"), F.col("penalty_type_code").alias("penalty_type"), F.col("penalty_duration").alias("minutes"), "drawn_by", "served_by")


def game_play_by_play(t: League, game_id: int | None = None, event: str | None = None) -> DataFrame:
    """Every play with one line of text; shootout included."""
    rows = _plays(t, game_id)
    rows = rows if event is None else rows.where(F.col("type_desc_key") == event)
    roles = {
        "scorer": "scoring_player_id", "a1": "assist1_player_id", "a2": "assist2_player_id", "shooter": "shooting_player_id", "goalie": "goalie_in_net_id", "blocker": "blocking_player_id",
        "hitter": "hitting_player_id", "hittee": "hittee_player_id", "winner": "winning_player_id", "loser": "losing_player_id", "committed": "committed_by_player_id",
        "drawn": "drawn_by_player_id", "actor": "player_id",
    }
    rows, kind = named(rows, t, **roles), F.col("type_desc_key")
    helped = F.when(F.col("a1").isNotNull() | F.col("a2").isNotNull(), F.concat(F.lit("("), F.concat_ws(", ", "a1", "a2"), F.lit(")")))
    lines = {
        "goal": ("scorer", helped, "shot_type"),
        "shot-on-goal": ("shooter", "shot_type", F.lit("saved by"), "goalie"),
        "missed-shot": ("shooter", "shot_type", F.lit("missed")),
        "blocked-shot": ("shooter", F.lit("blocked by"), "blocker"),
        "hit": ("hitter", F.lit("hit"), "hittee"),
        "faceoff": ("winner", F.lit("won vs"), "loser"),
        "penalty": ("committed", "penalty_desc_key", F.concat(F.col("penalty_duration").cast("string"), F.lit(" min")), F.lit("drawn by"), "drawn"),
    }
    text = F.when(kind.isin("takeaway", "giveaway"), F.col("actor"))
    for name, parts in lines.items():
        text = text.when(kind == name, F.concat_ws(" ", *parts))
    return rows.select(
        "game_id", "event_id", "period", F.col("time_in_period").alias("time"), kind.alias("event"), "team", text.otherwise(F.col("stoppage_reason")).alias("description"),
        "strength", F.col("zone_code").alias("zone"), "away_score", "home_score", "away_sog", "home_sog",
    )


def game_scoring(t: League, game_id: int | None = None) -> DataFrame:
    """Goals but for the shootout's, with the score after each and the scorer's goals of the season."""
    rows = _plays(t, game_id, shootout=False).where(_goal())
    rows = named(rows, t, scorer="scoring_player_id", assist_1="assist1_player_id", assist_2="assist2_player_id", goalie="goalie_in_net_id")
    return rows.select("game_id", "event_id", "period", F.col("time_in_period").alias("time"), "team", "scorer", F.col("scoring_player_total").alias("scorer_goal_total"), "assist_1", "assist_2", "strength", "shot_type", F.floor(F.col("distance_ft") + 0.5).alias("distance_ft"), "goalie", "away_score", "home_score")


def game_shot_log(t: League, game_id: int | None = None, team: str | None = None) -> DataFrame:
    """Attempts but for the shootout's, with places turned so that the shooting team attacks towards x = +89."""
    rows = _plays(t, game_id, shootout=False).where(F.col("type_desc_key").isin(*SHOT_TYPES)).withColumn("by", F.coalesce("scoring_player_id", "shooting_player_id"))
    right = F.coalesce(F.col("owner_is_home") == (F.col("home_team_defending_side") == "left"), F.col("x_coord") >= 0)
    rows = named(rows, t, shooter="by", goalie="goalie_in_net_id", blocked_by="blocking_player_id")
    return _of_team(rows, team).select("game_id", "event_id", "period", F.col("time_in_period").alias("time"), "team", "shooter", F.element_at(F.create_map(*(F.lit(x) for pair in OUTCOMES.items() for x in pair)), F.col("type_desc_key")).alias("result"), "shot_type", "strength", F.floor(F.col("distance_ft") + 0.5).alias("distance_ft"), F.when(right, F.col("x_coord")).otherwise(-F.col("x_coord")).alias("x_ft"), F.when(right, F.col("y_coord")).otherwise(-F.col("y_coord")).alias("y_ft"), "goalie", "blocked_by")


def game_shots_by_strength(t: League, game_id: int | None = None) -> DataFrame:
    kind = F.col("type_desc_key")
    rows = _plays(t, game_id, shootout=False).where(kind.isin(*SHOT_TYPES))
    return rows.groupBy("game_id", "team", "strength").agg(F.count_if(_goal()).alias("goals"), F.count_if(kind.isin("goal", "shot-on-goal")).alias("shots"), F.count(F.lit(1)).alias("attempts"))


def game_skaters(t: League, game_id: int | None = None, team: str | None = None) -> DataFrame:
    rows = skaters(blocks.narrowed(t, game_id=game_id), game_type=None, team=team)
    return rows.select("game_id", "team", "sweater_number", "full_name", F.col("position_code").alias("position"), *(F.expr(e).alias(n) for n, e in {"goals": "goals", "assists": "primary_assists + secondary_assists", "points": "goals + primary_assists + secondary_assists", "shots": "goals + shots_saved", "hits": "hits", "blocked_shots": "blocked_shots", "takeaways": "takeaways", "giveaways": "giveaways", "pim": "pim", "faceoff_wins": "faceoff_wins", "faceoff_losses": "faceoff_losses"}.items()))


def goalie_save_percentage(t: League, min_shots_faced: int = 200, top_n: int = TOP_N, **filters) -> DataFrame:
    sums = blocks.goalie_shots(t, **filters).groupBy("full_name", "player_id").agg(F.countDistinct("game_id").alias("games_in_net"), F.count(F.lit(1)).alias("shots_faced"), F.count_if("is_goal").alias("goals_against"))
    sums = sums.where(F.col("shots_faced") >= min_shots_faced).withColumns({"saves": F.col("shots_faced") - F.col("goals_against"), "save_pct": F.expr(ratio("shots_faced - goals_against", "shots_faced", 1, 3)), "shots_per_game": F.expr(ratio("shots_faced", "games_in_net", 1, 1)), "exact": F.expr("1e0 * (shots_faced - goals_against) / shots_faced")})
    return leaderboard(sums, [F.desc("exact"), F.col("player_id")], top_n).drop("exact")


def goalie_strong_games(t: League, min_goalie_shots: int = 10, **filters) -> DataFrame:
    games = blocks.goalie_shots(t, **filters).groupBy("player_id", "full_name", "game_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_goal").alias("g")).where(F.col("n") >= min_goalie_shots)
    sums = games.groupBy("player_id", "full_name").agg(F.count(F.lit(1)).alias("games"), F.count_if(F.expr("1000 * (n - g) >= 900 * n")).alias("games_900_plus"), F.count_if(F.expr("1000 * (n - g) >= 920 * n")).alias("games_920_plus"))
    return sums.withColumn("pct_games_900_plus", F.expr(share("games_900_plus", "games")))


def _of_games(t: League, filters: dict) -> DataFrame:
    """Plays of the games that the filters leave, those of the team only where one is given."""
    plays = blocks.plays_with_strength(blocks.narrowed(t, **({"game_type": 2} | filters)))
    if filters.get("team") is None:
        return plays
    return plays.join(F.broadcast(t.teams.where(F.col("abbrev") == filters["team"]).select(F.col("team_id").alias("event_owner_team_id"))), "event_owner_team_id", "left_semi")


def league_goals_by_period(t: League, **filters) -> DataFrame:
    goals = _of_games(t, filters).where(_goal())
    sums = goals.groupBy(period_label(F.col("period_number"), F.col("period_type")).alias("period")).agg(F.count(F.lit(1)).alias("goals"))
    return sums.withColumn("total", F.sum("goals").over(Window.partitionBy())).select("period", "goals", F.expr(share("goals", "total")).alias("share_pct"))


def league_highest_scoring(t: League, top_n: int = TOP_N, team: str | None = None, **filters) -> DataFrame:
    rows = blocks.team_games(blocks.narrowed(t, team=team), **filters).where("is_home").withColumn("total_goals", F.col("score_for") + F.col("score_against"))
    rows = rows.select("game_id", "game_date", "team", F.col("score_for").alias("team_score"), "opponent", F.col("score_against").alias("opponent_score"), "total_goals", "decided_in")
    return leaderboard(rows, [F.desc("total_goals"), F.col("game_date"), F.col("game_id")], top_n)


def league_home_ice(t: League, **filters) -> DataFrame:
    won = lambda home: F.count_if((F.col("result") == "W") & (F.col("is_home") == home))
    edge = "floor((100e0 * hw / nullif(home_games, 0) - 100e0 * aw / nullif(away_games, 0)) * 10 + 0.5e0) / 10e0"
    sums = blocks.team_games(t, **filters).groupBy("team").agg(F.count_if("is_home").alias("home_games"), won(True).alias("hw"), F.count_if(~F.col("is_home")).alias("away_games"), won(False).alias("aw"))
    return sums.select("team", "home_games", F.expr(share("hw", "home_games")).alias("home_win_pct"), "away_games", F.expr(share("aw", "away_games")).alias("away_win_pct"), F.expr(edge).alias("home_edge"))


def league_most_traveled(t: League, min_teams: int = 2, top_n: int = TOP_N) -> DataFrame:
    spots = gold.roster_spots(t)
    sums = gold.dim_player_team(spots).groupBy("player_id").agg(F.count(F.lit(1)).alias("stints"), F.countDistinct("team_id").alias("distinct_teams")).where(F.col("distinct_teams") >= min_teams)
    rows = sums.join(gold.dim_player(spots).select("player_id", "full_name", F.col("first_seen_date").alias("first_seen"), F.col("last_seen_date").alias("last_seen")), "player_id")
    return leaderboard(rows, [F.desc("distinct_teams"), F.desc("stints"), F.col("player_id")], top_n)


def shot_type_conversion(t: League) -> DataFrame:
    """All game types, the shootout too."""
    return _conversion(t.plays)


def league_shot_type_conversion(t: League, **filters) -> DataFrame:
    return _conversion(_of_games(t, filters))


def _conversion(plays: DataFrame) -> DataFrame:
    shots = plays.where(F.col("type_desc_key").isin("goal", "shot-on-goal") & F.col("shot_type").isNotNull())
    sums = shots.groupBy("shot_type").agg(F.count(F.lit(1)).alias("shots"), F.count_if(_goal()).alias("goals"))
    return sums.withColumn("conversion_pct", F.expr(share("goals", "shots")))


def league_weekend_scoring(t: League, team: str | None = None, **filters) -> DataFrame:
    rows = blocks.team_games(blocks.narrowed(t, team=team), **filters).where("is_home").withColumns({"is_weekend": F.dayofweek("game_date").isin(1, 7), "day_name": F.date_format("game_date", "EEEE"), "total": F.col("score_for") + F.col("score_against")})
    return rows.groupBy("is_weekend", "day_name").agg(F.count(F.lit(1)).alias("games"), F.sum("total").alias("goals")).select("is_weekend", "day_name", "games", F.expr(ratio("goals", "games")).alias("avg_total_goals"))


def player_shot_distance(t: League, min_shots: int = 50, top_n: int = TOP_N, **filters) -> DataFrame:
    """Average distances in hundredths of feet are summed as whole numbers, so that the order of rows does not matter."""
    feet = F.floor(F.col("distance_ft") * 100 + 0.5)
    rows = blocks.player_shots(t, **filters).where("zone_code = 'O'").groupBy("full_name", "player_id").agg(
        F.count_if("on_net").alias("shots"), F.count_if("is_goal").alias("goals"), F.sum(F.when(F.col("on_net"), feet)).alias("s"), F.count(F.when(F.col("on_net"), feet)).alias("n"),
        F.sum(F.when(F.col("is_goal"), feet)).alias("gs"), F.count(F.when(F.col("is_goal"), feet)).alias("gn"),
    ).where(F.col("shots") >= min_shots)
    rows = rows.select("full_name", "player_id", "shots", "goals", F.expr(share("goals", "shots")).alias("shooting_pct"), F.expr(ratio("s / 100e0", "n", 1, 1)).alias("avg_shot_distance_ft"), F.expr(ratio("gs / 100e0", "gn", 1, 1)).alias("avg_goal_distance_ft"))
    return leaderboard(rows, [F.col("avg_shot_distance_ft").asc_nulls_last(), F.col("player_id")], top_n)


def player_close_range(t: League, top_n: int = TOP_N, **filters) -> DataFrame:
    near = F.col("on_net") & (F.col("distance_ft") < 20)
    rows = blocks.player_shots(t, **filters).where("zone_code = 'O'").groupBy("full_name", "player_id").agg(F.count_if(near).alias("close_shots"), F.count_if(near & F.col("is_goal")).alias("close_goals"), F.count_if("on_net").alias("shots"))
    rows = rows.select("full_name", "player_id", "close_shots", "close_goals", F.expr(share("close_goals", "close_shots")).alias("close_shooting_pct"), F.expr(share("close_shots", "shots")).alias("share_of_shots_close_pct"))
    return leaderboard(rows, [F.desc("close_goals"), F.desc("close_shots"), F.col("player_id")], top_n)


def _goals(t: League, filters: dict) -> DataFrame:
    return blocks.plays_with_strength(blocks.narrowed(t, **({"game_type": 2} | filters))).where(_goal())


def player_first_goals(t: League, top_n: int = TOP_N, **filters) -> DataFrame:
    first = _goals(t, filters).groupBy("game_id").agg(F.min_by("scoring_player_id", F.struct("period_number", "sort_order")).alias("player_id"))
    rows = first.join(blocks.player_games(t, **filters).select("game_id", "player_id", "full_name"), ["game_id", "player_id"]).groupBy("full_name", "player_id").agg(F.count(F.lit(1)).alias("first_goals"))
    return leaderboard(rows, [F.desc("first_goals"), F.col("player_id")], top_n)


def player_game_winning_goals(t: League, top_n: int = TOP_N, **filters) -> DataFrame:
    """The goal that puts the winner one above the loser's final score; none where a shootout decided."""
    order = Window.partitionBy("game_id", "event_owner_team_id").orderBy("sort_order").rowsBetween(Window.unboundedPreceding, 0)
    numbered = _goals(t, filters).withColumn("own", F.count(F.lit(1)).over(order)).select("game_id", "event_owner_team_id", "scoring_player_id", "own")
    home = F.col("event_owner_team_id") == F.col("home_team_id")
    done = numbered.join(t.games.where("is_final and last_period_type <> 'SO'"), "game_id").where((home == (F.col("home_final_score") > F.col("away_final_score"))) & (F.col("own") == F.least("home_final_score", "away_final_score") + 1))
    rows = done.select("game_id", F.col("scoring_player_id").alias("player_id")).join(blocks.player_games(t, **filters).select("game_id", "player_id", "full_name"), ["game_id", "player_id"])
    return leaderboard(rows.groupBy("full_name", "player_id").agg(F.countDistinct("game_id").alias("game_winning_goals")), [F.desc("game_winning_goals"), F.col("player_id")], top_n)


def player_vs_goalies(t: League, **filters) -> DataFrame:
    goalies = t.rosters.select("game_id", F.col("player_id").alias("goalie_in_net_id"), F.concat_ws(" ", "first_name", "last_name").alias("goalie"))
    rows = blocks.player_shots(t, **filters).where("on_net").join(goalies, ["game_id", "goalie_in_net_id"])
    sums = rows.groupBy("player_id", "goalie").agg(F.count(F.lit(1)).alias("shots"), F.count_if("is_goal").alias("goals"))
    return sums.withColumn("shooting_pct", F.expr(share("goals", "shots")))


def player_big_games(t: League, goals: int = 3, points: int = 4, **filters) -> DataFrame:
    rows = skaters(t, **filters).withColumns({"assists": F.expr("primary_assists + secondary_assists"), "points": F.expr("goals + primary_assists + secondary_assists")})
    return rows.where((F.col("goals") >= goals) | (F.col("points") >= points)).select("game_id", "game_date", "player_id", "full_name", "opponent", "result", "goals", "assists", "points")


def player_streaks(t: League, what: str = "goals", top_n: int = TOP_N, **filters) -> DataFrame:
    """Runs of a player's games in which what (goals or points) is not 0: the gap between two row numbers tells the runs apart."""
    rows = skaters(t, **filters).withColumns({"assists": F.expr("primary_assists + secondary_assists"), "points": F.expr("goals + primary_assists + secondary_assists")})
    rows = rows.select("player_id", "full_name", "game_id", "game_date", "goals", "assists", "points", (F.col(what) > 0).alias("hit"))
    every, same = Window.partitionBy("player_id").orderBy("game_date", "game_id"), Window.partitionBy("player_id", "hit").orderBy("game_date", "game_id")
    runs = rows.withColumn("run", F.row_number().over(every) - F.row_number().over(same)).where("hit")
    sums = runs.groupBy("player_id", "full_name", "run").agg(F.count(F.lit(1)).alias("games"), F.sum("goals").alias("goals"), F.sum("assists").alias("assists"), F.sum("points").alias("points"), F.min("game_date").alias("streak_start"), F.max("game_date").alias("streak_end")).drop("run")
    return leaderboard(sums, [F.desc("games"), F.desc(what), F.col("streak_start"), F.col("player_id")], top_n)


def player_multi_point(t: League, min_games: int = 10, top_n: int = TOP_N, **filters) -> DataFrame:
    points = F.expr("goals + primary_assists + secondary_assists")
    sums = skaters(t, **filters).groupBy("full_name", "player_id").agg(F.count(F.lit(1)).alias("games_played"), *(F.count_if(points >= k).alias(n) for k, n in ((1, "games_with_a_point"), (2, "multi_point_games"), (3, "three_point_games")))).where(F.col("games_played") >= min_games)
    sums = sums.withColumn("pct_games_with_a_point", F.expr(share("games_with_a_point", "games_played")))
    return leaderboard(sums, [F.desc("multi_point_games"), F.desc("games_with_a_point"), F.col("player_id")], top_n)


def player_penalty_types(t: League, **filters) -> DataFrame:
    rows = blocks.plays_with_strength(blocks.narrowed(t, **({"game_type": 2} | filters))).where("type_desc_key = 'penalty'").select("game_id", F.col("committed_by_player_id").alias("player_id"), "penalty_desc_key", "penalty_duration").join(blocks.player_games(t, **filters), ["game_id", "player_id"])
    return rows.groupBy(F.col("penalty_desc_key").alias("penalty")).agg(F.count(F.lit(1)).alias("times_taken"), F.sum("penalty_duration").cast("long").alias("pim"), F.countDistinct("player_id").alias("players"))


def player_roster_usage(t: League, **filters) -> DataFrame:
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "/")
    return blocks.player_games(t, **filters).groupBy("full_name", "player_id").agg(F.count(F.lit(1)).alias("games_dressed"), joined("position_code").alias("positions"), joined("sweater_number").alias("numbers"), F.min("game_date").alias("first_game"), F.max("game_date").alias("last_game"))


def player_combinations(t: League, top_n: int = TOP_N, **filters) -> DataFrame:
    """Pairs of players with a point on the same goal: three pairs of one goal from one scan."""
    goals = _of_games(t, filters).where(_goal())
    pair = lambda a, b: F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("both"))
    three = F.array(pair("scoring_player_id", "assist1_player_id"), pair("scoring_player_id", "assist2_player_id"), pair("assist1_player_id", "assist2_player_id"))
    sums = goals.select(F.inline(three)).where("both").groupBy(F.col("x").alias("player_1"), F.col("y").alias("player_2")).agg(F.count(F.lit(1)).alias("goals_together"))
    return leaderboard(sums, [F.desc("goals_together"), F.col("player_1"), F.col("player_2")], top_n)


def player_share_of_team_goals(t: League, min_games: int = 10, top_n: int = TOP_N, **filters) -> DataFrame:
    team_goals = _goals(t, filters).groupBy("game_id", F.col("event_owner_team_id").alias("team_id")).agg(F.count(F.lit(1)).alias("tg"))
    rows = skaters(t, **filters).join(team_goals, ["game_id", "team_id"], "left")
    sums = rows.groupBy("full_name", "player_id").agg(F.count(F.lit(1)).alias("games_played"), F.sum(F.expr("goals + primary_assists + secondary_assists")).alias("points"), F.sum(F.coalesce("tg", F.lit(0))).alias("team_goals_while_dressed")).where(F.col("games_played") >= min_games)
    sums = sums.withColumn("share_of_team_goals_pct", F.expr(share("points", "team_goals_while_dressed")))
    return leaderboard(sums, [F.col("share_of_team_goals_pct").desc_nulls_last(), F.col("player_id")], top_n)


def player_helpers(t: League, **filters) -> DataFrame:
    """For every scorer the teammates who assisted."""
    goals = _of_games(t, filters).where(_goal())
    each = goals.select(F.col("scoring_player_id").alias("player_id"), F.inline(F.array(F.struct(F.col("assist1_player_id").alias("assisted_by"), F.lit(True).alias("first")), F.struct(F.col("assist2_player_id").alias("assisted_by"), F.lit(False).alias("first"))))).where("assisted_by is not null")
    sums = each.groupBy("player_id", "assisted_by").agg(F.count(F.lit(1)).alias("assists"), F.count_if("first").alias("primary_assists"), F.count_if(~F.col("first")).alias("secondary_assists"))
    total = goals.groupBy(F.col("scoring_player_id").alias("player_id")).agg(F.count(F.lit(1)).alias("all_goals"))
    return sums.join(total, "player_id").select("player_id", "assisted_by", "assists", "primary_assists", "secondary_assists", F.expr(share("assists", "all_goals")).alias("pct_of_goals"))


def position_rank(t: League, min_games: int = 10, top_n: int = 500, **filters) -> DataFrame:
    """The first top_n players, each with the place among those of the same position."""
    sums = _summed(skaters(t, **filters), ["full_name", "player_id"]).where(F.col("games_played") >= min_games)
    names = "goals assists points points_per_game shots shooting_pct"
    rows = sums.select("full_name", "position", "games_played", *_cols(names, DERIVED), F.rank().over(Window.partitionBy("position").orderBy(F.expr(DERIVED["points"]).desc())).alias("position_rank"), "player_id")
    return rows.orderBy("position_rank", "position", "player_id").limit(top_n)


def position_share(t: League, **filters) -> DataFrame:
    sums = _summed(skaters(t, **filters), ["position_group"]).withColumns({"assists": F.expr("primary_assists + secondary_assists"), "points": F.expr("goals + primary_assists + secondary_assists")})
    whole = Window.partitionBy()
    sums = sums.withColumns({"g": F.sum("goals").over(whole), "p": F.sum("points").over(whole)})
    return sums.select("position_group", "players", "games_played", "goals", "assists", "points", F.expr(share("goals", "g")).alias("share_of_goals_pct"), F.expr(share("points", "p")).alias("share_of_points_pct"))


def _events(t: League, filters: dict) -> DataFrame:
    return blocks.team_events(blocks.narrowed(t, **({"game_type": 2, "final_only": True} | filters)))


def _team_goal_events(t: League, filters: dict) -> DataFrame:
    keys = blocks.team_games(t, **filters).select("game_id", "team_id", "team", "result")
    return _events(t, filters).where(_goal()).select("game_id", "team_id", "side", "sort_order").join(keys, ["game_id", "team_id"])


def team_comebacks(t: League, **filters) -> DataFrame:
    order = Window.partitionBy("game_id", "team_id").orderBy("sort_order").rowsBetween(Window.unboundedPreceding, 0)
    margin = _team_goal_events(t, filters).withColumn("m", F.sum(F.when(F.col("side") == "for", 1).otherwise(-1)).over(order))
    games = margin.groupBy("game_id", "team_id", "team", "result").agg(F.min("m").alias("low"), F.max("m").alias("high"))
    labels = F.array_compact(F.array(F.when(F.col("low") <= -1, "1) Trailed"), F.when(F.col("low") <= -2, "2) Trailed by 2+"), F.when(F.col("high") >= 1, "3) Led"), F.when(F.col("high") >= 2, "4) Led by 2+")))
    rows = games.select("team", "result", F.explode(labels).alias("situation"))
    won = lambda r: F.count_if(F.col("result") == r)
    sums = rows.groupBy("team", "situation").agg(F.count(F.lit(1)).alias("games"), won("W").alias("wins"), won("L").alias("losses"), won("OTL").alias("ot_losses"))
    return sums.withColumn("win_pct", F.expr(share("wins", "games")))


def _sided(t: League, key, condition: str, filters: dict) -> DataFrame:
    kind, own = F.col("type_desc_key"), F.col("side") == "for"
    rows = _events(t, filters).where(condition).withColumn("key", key).join(blocks.team_games(t, **filters).select("game_id", "team_id", "team"), ["game_id", "team_id"])
    on = kind.isin("goal", "shot-on-goal")
    return rows.groupBy("team", "key").agg(F.count_if(_goal() & own).alias("goals_for"), F.count_if(_goal() & ~own).alias("goals_against"), F.count_if(on & own).alias("shots_for"), F.count_if(on & ~own).alias("shots_against"))


def team_by_period(t: League, **filters) -> DataFrame:
    return _sided(t, period_label(F.col("period_number"), F.col("period_type")), "true", filters).withColumnRenamed("key", "period")


def team_by_game_time(t: League, **filters) -> DataFrame:
    minute = F.expr("cast(substr(time_in_period, 1, 2) as int) div 5 * 5")
    label = F.when(F.col("period_type") == "OT", "OT").otherwise(F.concat(F.lit("P"), F.col("period_number").cast("string"), F.lit(" "), F.lpad(minute.cast("string"), 2, "0"), F.lit("-"), F.lpad((minute + 5).cast("string"), 2, "0")))
    return _sided(t, label, "type_desc_key = 'goal'", filters).select("team", F.col("key").alias("game_time"), "goals_for", "goals_against", (F.col("goals_for") - F.col("goals_against")).alias("diff"))


def team_by_shot_type(t: League, **filters) -> DataFrame:
    rows = _sided(t, F.col("shot_type"), "shot_type is not null and type_desc_key in ('goal', 'shot-on-goal')", filters).withColumnRenamed("key", "shot_type")
    return rows.withColumns({"shooting_pct": F.expr(share("goals_for", "shots_for")), "save_pct": F.expr(ratio("shots_against - goals_against", "shots_against", 1, 3))})


def team_by_distance(t: League, **filters) -> DataFrame:
    rows = _sided(t, distance_bucket(F.col("distance_ft")), "zone_code = 'O' and type_desc_key in ('goal', 'shot-on-goal')", filters).withColumnRenamed("key", "distance")
    return rows.withColumns({"shooting_pct_for": F.expr(share("goals_for", "shots_for")), "shooting_pct_against": F.expr(share("goals_against", "shots_against"))})


def team_rankings(t: League, selected: str = "T05", **filters) -> DataFrame:
    """Every team, the selected one marked, with its place in six lists; places follow the unrounded ratios. The window spans one row per team."""
    sums = _records(team_rows(t, **filters), ["team"]).withColumn("points", F.expr("2 * wins + ot_losses"))
    orders = {"points_rank": "points", "gf_rank": "1e0 * gf / games", "ga_rank": "-1e0 * ga / games", "attempt_share_rank": "1e0 * cf / nullif(cf + ca, 0)", "shooting_rank": "1e0 * gf / nullif(sf, 0)", "save_rank": "1e0 * (sa - ga) / nullif(sa, 0)"}
    ranked = sums.withColumns({n: F.rank().over(Window.orderBy(F.expr(e).desc_nulls_last())) for n, e in orders.items()})
    return ranked.select("team", (F.col("team") == selected).alias("selected"), "games", "points", *_cols("goals_for_per_game goals_against_per_game attempt_share_pct shooting_pct save_pct", TEAM_DERIVED), *orders)


def team_opposing_scorers(t: League, top_n: int = TOP_N, **filters) -> DataFrame:
    """Opposing shooters of all teams, by player."""
    keys = blocks.team_games(t, **filters).select("game_id", "team_id", "team")
    rows = _events(t, filters).where("side = 'against' and type_desc_key in ('goal', 'shot-on-goal')").join(keys, ["game_id", "team_id"]).withColumn("by", F.when(_goal(), F.col("scoring_player_id")).otherwise(F.col("shooting_player_id")))
    sums = rows.groupBy("team", F.col("by").alias("player_id")).agg(F.count_if(_goal()).alias("goals"), F.count(F.lit(1)).alias("shots_on_goal"), F.countDistinct("game_id").alias("games"))
    first = leaderboard(sums, [F.desc("goals"), F.desc("shots_on_goal"), F.col("team"), F.col("player_id")], top_n)
    return first.join(_people(t), "player_id", "left")


def team_scoring_depth(t: League, **filters) -> DataFrame:
    games = blocks.team_games(t, **filters).join(_events(t, filters).where(_goal() & (F.col("side") == "for")).groupBy("game_id", "team_id").agg(F.countDistinct("scoring_player_id").alias("s")), ["game_id", "team_id"], "left")
    sums = games.groupBy("team", F.coalesce("s", F.lit(0)).alias("scorers")).agg(F.count(F.lit(1)).alias("games"), F.count_if(F.col("result") == "W").alias("wins"))
    return sums.withColumn("win_pct", F.expr(share("wins", "games")))


def team_scoring_first(t: League, **filters) -> DataFrame:
    first = _team_goal_events(t, filters).groupBy("game_id", "team_id").agg(F.min_by("side", "sort_order").alias("side"))
    rows = blocks.team_games(t, **filters).join(first, ["game_id", "team_id"], "left").withColumn("first_goal", F.when(F.col("side") == "for", "1) Scored first").when(F.col("side") == "against", "2) Opponent first").otherwise("3) No goals"))
    won = lambda r: F.count_if(F.col("result") == r)
    sums = rows.groupBy("team", "first_goal").agg(F.count(F.lit(1)).alias("games"), won("W").alias("wins"), won("L").alias("losses"), won("OTL").alias("ot_losses"))
    return sums.withColumn("win_pct", F.expr(share("wins", "games")))


def _people(t: League) -> DataFrame:
    return gold.dim_player(gold.roster_spots(t)).select("player_id", "full_name")


def all_time_goals(t: League, top_n: int = TOP_N) -> DataFrame:
    """All game types and shootout goals; by player, with the newest team."""
    sums = t.plays.where(_goal()).groupBy(F.col("scoring_player_id").alias("player_id")).agg(F.count(F.lit(1)).alias("goals"))
    people = gold.dim_player(gold.roster_spots(t)).select("player_id", "full_name", "team_id").join(t.teams.select("team_id", F.col("abbrev").alias("current_team")), "team_id", "left")
    return leaderboard(sums.join(people, "player_id").select("player_id", "full_name", "current_team", "goals"), [F.desc("goals"), F.col("player_id")], top_n)


def top_play_makers(t: League, top_n: int = TOP_N) -> DataFrame:
    """All three assist slots, from one scan."""
    each = t.plays.where(_goal()).select(F.explode(F.array("assist1_player_id", "assist2_player_id", "assist3_player_id")).alias("player_id")).where("player_id is not null")
    first = leaderboard(each.groupBy("player_id").agg(F.count(F.lit(1)).alias("assists")), [F.desc("assists"), F.col("player_id")], top_n)
    return first.join(_people(t), "player_id", "left")


def all_time_goalies(t: League, min_shots: int = 1000, top_n: int = TOP_N) -> DataFrame:
    """Goalies by the share of shots saved over all plays, the shootout's too; places follow the unrounded share."""
    faced = t.plays.where(F.col("type_desc_key").isin("goal", "shot-on-goal") & F.col("goalie_in_net_id").isNotNull())
    sums = faced.groupBy(F.col("goalie_in_net_id").alias("player_id")).agg(F.count(F.lit(1)).alias("shots_faced"), F.count_if(_goal()).alias("goals_allowed")).where(F.col("shots_faced") >= min_shots)
    sums = sums.withColumns({"save_pct": F.expr(ratio("shots_faced - goals_allowed", "shots_faced", 100, 2)), "exact": F.expr("1e0 * (shots_faced - goals_allowed) / shots_faced")})
    return leaderboard(sums, [F.desc("exact"), F.col("player_id")], top_n).drop("exact").join(_people(t), "player_id", "left")


def all_home_ice(t: League, game_type: int | None = 2) -> DataFrame:
    """Shares of games won at home and away, by team, whether the games are over or not."""
    won = F.col("score_for") > F.col("score_against")
    rows = blocks.team_games(t, game_type=game_type, final_only=False).groupBy("team").agg(
        F.count_if("is_home").alias("h"), F.count_if(F.col("is_home") & won).alias("hw"), F.count_if(~F.col("is_home")).alias("a"), F.count_if(~F.col("is_home") & won).alias("aw")
    )
    return rows.select("team", F.expr(share("hw", "h")).alias("home_win_pct"), F.expr(share("aw", "a")).alias("away_win_pct"))


def all_highest_scoring(t: League, top_n: int = 20) -> DataFrame:
    side = lambda s: t.teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("abbrev").alias(s))
    rows = t.games.join(side("home"), "home_team_id").join(side("away"), "away_team_id").withColumn("total_goals", F.col("home_final_score") + F.col("away_final_score"))
    rows = rows.select("game_id", "game_date", "home", "home_final_score", "away", "away_final_score", "total_goals", "last_period_type")
    return leaderboard(rows, [F.desc("total_goals"), F.col("game_date"), F.col("game_id")], top_n)


def all_weekend_scoring(t: League) -> DataFrame:
    rows = t.games.groupBy(F.dayofweek("game_date").isin(1, 7).alias("is_weekend"), F.date_format("game_date", "EEEE").alias("day_name"))
    sums = rows.agg(F.count(F.lit(1)).alias("games"), F.sum(F.col("home_final_score") + F.col("away_final_score")).alias("goals"))
    return sums.select("is_weekend", "day_name", "games", F.expr(ratio("goals", "games")).alias("avg_total_goals"))


QUERIES = {
    "q001_game_box_score": game_box_score, "q002_game_faceoffs_by_player": game_faceoffs, "q003_game_find_game_id": game_finder, "q004_game_goalie_stats": game_goalies,
    "q005_game_goals_and_shots_by_period": game_periods, "q006_game_penalty_summary": game_penalties, "q007_game_play_by_play": game_play_by_play, "q008_game_scoring_summary": game_scoring,
    "q009_game_shot_log": game_shot_log, "q010_game_shots_by_strength": game_shots_by_strength, "q011_game_skater_stats": game_skaters,
    "q018_goalie_save_percentage": partial(goalie_save_percentage, min_shots_faced=5), "q018_goalie_save_percentage_usual": goalie_save_percentage,
    "q019_goalie_strong_games": partial(goalie_strong_games, min_goalie_shots=3), "q019_goalie_strong_games_usual": goalie_strong_games,
    "q023_league_goalie_save_percentage": partial(goalie_save_percentage, min_shots_faced=20),
    "q024_league_goals_by_period": league_goals_by_period, "q025_league_highest_scoring_games": league_highest_scoring, "q027_league_home_ice_advantage": league_home_ice,
    "q028_league_most_traveled_players": league_most_traveled, "q032_league_shot_type_conversion": league_shot_type_conversion, "q033_league_weekend_scoring": league_weekend_scoring,
    "q035_player_average_shot_distance": partial(player_shot_distance, min_shots=2), "q037_player_close_range_shooting": player_close_range, "q043_player_first_goal": player_first_goals,
    "q046_player_game_winning_goals": player_game_winning_goals, "q048_player_goals_against_each_goalie": player_vs_goalies, "q051_player_big_games": player_big_games, "q051_player_big_games_2_3": partial(player_big_games, goals=2, points=3),
    "q058_player_longest_goal_streaks": player_streaks, "q059_player_longest_point_streaks": partial(player_streaks, what="points"), "q061_player_multi_point_games": partial(player_multi_point, min_games=1),
    "q064_player_penalties_by_type": player_penalty_types, "q070_player_roster_usage": player_roster_usage, "q071_player_scoring_combinations": player_combinations,
    "q074_player_share_of_team_goals": partial(player_share_of_team_goals, min_games=1), "q092_player_teammates_who_assist": player_helpers, "q107_position_rank_within_position": partial(position_rank, min_games=1),
    "q109_position_share_of_team_scoring": position_share, "q114_team_comebacks_and_blown_leads": team_comebacks, "q118_team_goals_and_shots_by_period": team_by_period,
    "q119_team_goals_by_game_time": team_by_game_time, "q120_team_goals_by_shot_type": team_by_shot_type, "q124_team_league_rankings": team_rankings,
    "q125_team_opposing_scorers": team_opposing_scorers, "q137_team_scoring_depth": team_scoring_depth, "q138_team_scoring_first": team_scoring_first, "q142_team_shot_distance": team_by_distance,
    "n01_all_time_goals_scored": all_time_goals, "n02_top_play_makers": top_play_makers, "n04_shot_type_conversion": shot_type_conversion,
    "n09_most_traveled_players": league_most_traveled, "n10_goalies_under_fire": partial(all_time_goalies, min_shots=5), "n10_goalies_under_fire_usual": all_time_goalies,
    "n11_home_ice_advantage": all_home_ice, "n12_highest_scoring_games": all_highest_scoring, "n14_weekend_scoring": all_weekend_scoring,
    "q145_all_time_goals_scored": all_time_goals, "q146_top_play_makers": top_play_makers,
}
