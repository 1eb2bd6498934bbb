"""The star schema: dimensions, the fact view, stints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rinkline.sources.derived import League


def roster_spots(t: League) -> DataFrame:
    """Roster rows with their game's date; rows without a player are left out."""
    return t.rosters.where("player_id is not null").join(t.games.select("game_id", "game_date"), "game_id")


def dim_player(spots: DataFrame) -> DataFrame:
    """One row per player: the newest attributes, first and last date. One aggregation, no window."""
    newest = F.max_by(F.struct("first_name", "last_name", "position_code", "sweater_number", "team_id"), F.struct("game_date", "game_id"))
    rows = spots.groupBy("player_id").agg(newest.alias("n"), F.min("game_date").alias("first_seen_date"), F.max("game_date").alias("last_seen_date"))
    return rows.select("player_id", F.concat_ws(" ", "n.first_name", "n.last_name").alias("full_name"), "n.*", "first_seen_date", "last_seen_date")


def player_days(spots: DataFrame) -> DataFrame:
    """A player's game days with the team; spots without a team or date are left out, of several teams on one day the smallest counts."""
    return spots.where("team_id is not null and game_date is not null").groupBy("player_id", "game_date").agg(F.min("team_id").alias("team_id"))


def merged_stints(pieces: DataFrame) -> DataFrame:
    """Pieces of stints (player_id, team_id, valid_from, valid_to, games_in_stint) that don't overlap, joined where one follows another of the same team.

    A day is a piece, and so is a stint that was stored before.  The window is per player, whose pieces are few.
    """
    order = Window.partitionBy("player_id").orderBy("valid_from")
    marked = pieces.withColumn("new", (~F.col("team_id").eqNullSafe(F.lag("team_id").over(order))).cast("int"))
    numbered = marked.withColumn("stint", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stints = numbered.groupBy("player_id", "stint").agg(
        F.first("team_id").alias("team_id"), F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"), F.sum("games_in_stint").alias("games_in_stint")
    )
    last = F.col("stint") == F.max("stint").over(Window.partitionBy("player_id"))
    return stints.select("player_id", "team_id", "valid_from", "valid_to", "games_in_stint", last.alias("is_current"))


def as_pieces(days: DataFrame) -> DataFrame:
    return days.select("player_id", "team_id", F.col("game_date").alias("valid_from"), F.col("game_date").alias("valid_to"), F.lit(1).cast("long").alias("games_in_stint"))


def dim_player_team(spots: DataFrame) -> DataFrame:
    """Stints: runs of a player's game days for one team. A return to a former team is a stint of its own; valid_to is the last day of each, the last stint is current."""
    return merged_stints(as_pieces(player_days(spots)))


def team_sides(games: DataFrame) -> DataFrame:
    """Each team of each game with its attributes there."""
    names = {"abbrev": "abbrev", "team_name": "name", "place_name": "place_name", "logo_url": "logo", "dark_logo_url": "dark_logo"}
    side = lambda s: F.struct(F.col(f"{s}_team_id").alias("team_id"), F.struct(*(F.col(f"{s}_team_{c}").alias(n) for n, c in names.items())).alias("at"))
    return games.select("game_date", "game_id", F.inline(F.array(side("home"), side("away")))).where("team_id is not null")


def dim_team(games: DataFrame) -> DataFrame:
    """One row per team of the parsed games: its newest attributes, home or away."""
    seen = team_sides(games)
    newest = F.max_by("at", F.struct(F.col("game_date").isNotNull(), "game_date", "game_id"))
    return seen.groupBy("team_id").agg(newest.alias("n")).select("team_id", "n.*")


def dim_game(t: League) -> DataFrame:
    return t.games.withColumn("date_key", F.date_format("game_date", "yyyyMMdd").cast("int"))


def dim_date(spark: SparkSession, first: str = "1917-01-01", last: str | None = None) -> DataFrame:
    """A row per day from first to last (by default the end of next year)."""
    end = F.lit(last).cast("date") if last else F.make_date(F.year(F.current_date()) + 1, F.lit(12), F.lit(31))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), end)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day"), F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_event_type(plays: DataFrame) -> DataFrame:
    """One description per type code: the first in order."""
    return plays.where("type_code is not null").groupBy("type_code").agg(F.min("type_desc_key").alias("type_desc_key"))


#: The columns of the fact view but for its date, source and times.
FACT = (
    "type_code event_owner_team_id scoring_player_id assist1_player_id assist2_player_id assist3_player_id shooting_player_id goalie_in_net_id hitting_player_id hittee_player_id "
    "blocking_player_id winning_player_id losing_player_id committed_by_player_id drawn_by_player_id served_by_player_id player_id event_id sort_order type_desc_key period_number period_type "
    "time_in_period time_remaining situation_code home_team_defending_side x_coord y_coord zone_code shot_type scoring_player_total assist1_player_total assist2_player_total assist3_player_total "
    "away_score home_score away_sog home_sog penalty_type_code penalty_desc_key penalty_duration stoppage_reason secondary_stoppage_reason"
)


def fact_event(games: DataFrame, plays: DataFrame) -> DataFrame:
    """Plays (parsed) with their game's keys and lineage; plays without an event id or a game are left out."""
    keys = games.select("game_id", F.date_format("game_date", "yyyyMMdd").cast("int").alias("date_key"), "is_final", "fetched_at")
    return plays.where("event_id is not null").join(keys, "game_id").select("game_id", "date_key", *FACT.split(), "source", "is_final", "fetched_at", "ingestion_timestamp")


def register_views(games: DataFrame, plays: DataFrame, name: str = "fact_event") -> None:
    """The fact table as a view of the session, in place of any of that name."""
    fact_event(games, plays).createOrReplaceTempView(name)
