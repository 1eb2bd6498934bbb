"""Rankings of everyone, running totals and runs over whole seasons: orders that no one task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.operators.ordering import islands, ranks, running
from rinkline.queries.run import by_name, skaters
from rinkline.sources.derived import League


def every_scorer(t: League) -> DataFrame:
    """The scoring leaders without a cut."""
    return by_name()["q072_player_scoring_leaders"](t, min_games=1, top_n=None)


def points_rank(t: League) -> DataFrame:
    """Every skater's points with the rank that ties share."""
    points = F.sum(F.expr("goals + primary_assists + secondary_assists")).alias("points")
    sums = skaters(t).groupBy("player_id").agg(points)
    return ranks(sums, ["points"], [F.col("points").desc(), F.col("player_id")])


def _of_seasons(t: League) -> DataFrame:
    plays = t.plays.join(t.games.select("game_id", "season"), "game_id")
    return plays.select("season", "game_id", "sort_order", F.col("event_owner_team_id").alias("team_id"), F.col("type_desc_key").isin("goal").cast("long").alias("goal"))


def running_goals(t: League) -> DataFrame:
    """The season's goals so far after each play, in the order of games and plays."""
    order = [F.col("game_id"), F.col("sort_order")]
    return running(_of_seasons(t), ["season"], order, {"goals": ("sum", F.col("goal"))}).select("season", "game_id", "sort_order", "goals")


def runs_of_plays(t: League) -> DataFrame:
    """For each season and team (null: no one's plays) the number and the longest of its runs of plays in a row."""
    marked = islands(_of_seasons(t), ["season"], "team_id", [F.col("game_id"), F.col("sort_order")])
    runs = marked.groupBy("season", "team_id", "island").agg(F.count(F.lit(1)).alias("plays"))
    return runs.groupBy("season", "team_id").agg(F.count(F.lit(1)).alias("runs"), F.max("plays").alias("longest"))


QUERIES = {"r29_every_scorer": every_scorer, "r31_points_rank": points_rank, "r33_running_goals": running_goals, "r35_runs_of_plays": runs_of_plays}
