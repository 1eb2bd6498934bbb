"""Games, rosters, plays and teams derived from the `events` and `nation` tables.

The rules are integer arithmetic on event_id, user_id, props.k and value, so
that SQL engines agree on them; RULES holds them as text for both sides.  `//`
stands for integer division.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rinkline.sources.storage import new_path

#: What each rule says (g: game number, i: play number, u: user, k: props.k, v: value in hundredths).
RULES = {
    "home_team_id": "cast(1 + g % 25 as int)",
    "away_team_id": "cast(1 + (g % 25 + 1 + (g // 25) % 24) % 25 as int)",
    "season": "cast((2021 + g // 200) * 10000 + 2022 + g // 200 as int)",
    "game_type": "case when g % 20 = 0 then 1 when g % 20 = 19 then 3 else 2 end",
    "game_state": "case when g % 33 = 32 then 'LIVE' else 'OFF' end",
    "type_desc_key": "case when k < 8 then 'goal' when k < 28 then 'shot-on-goal' when k < 40 then 'missed-shot' when k < 52 then 'blocked-shot' "
    "when k < 66 then 'hit' when k < 80 then 'faceoff' when k < 86 then 'penalty' when k < 92 then 'takeaway' when k < 98 then 'giveaway' else 'stoppage' end",
    "type_code": "case when k < 8 then 505 when k < 28 then 506 when k < 40 then 507 when k < 52 then 508 when k < 66 then 503 when k < 80 then 502 when k < 86 then 509 "
    "when k < 92 then 525 when k < 98 then 504 else 516 end",
    "stoppage_reason": "case when k >= 98 then case v % 3 when 0 then 'icing' when 1 then 'offside' else 'puck-frozen' end end",
    "period_number": "cast(case when i < 96 then 1 + i // 32 when g % 4 = 0 then 4 when g % 4 = 1 then 5 else 3 end as int)",
    "period_type": "case when i < 96 then 'REG' when g % 4 = 0 then 'OT' when g % 4 = 1 then 'SO' else 'REG' end",
    "seconds": "(i % 32) * 37",
    "a": "(u + k) % 18",
    "b": "((u + k) % 18 + 1 + v % 17) % 18",
    "c": "((u + k) % 18 + 1 + (v + 1) % 17) % 18",
    "o": "(u * 3 + v) % 18",
    "situation_code": "case v % 8 when 3 then '1451' when 4 then '1541' when 5 then '0651' when 6 then '1560' when 7 then null else '1551' end",
    "x_coord": "case when v % 50 = 0 then null else cast(v % 199 - 99 as int) end",
    "y_coord": "case when v % 50 = 0 then null else cast((u * 7) % 85 - 42 as int) end",
    "zone_code": "case when v % 10 < 6 then 'O' when v % 10 < 8 then 'N' else 'D' end",
    "shot_type": "case u % 5 when 0 then 'wrist' when 1 then 'snap' when 2 then 'slap' when 3 then 'tip-in' end",
    "penalty_type_code": "case v % 5 when 0 then 'MIN' when 1 then 'MIN' when 2 then 'BEN' when 3 then 'MAJ' else 'MIS' end",
    "penalty_desc_key": "case v % 5 when 0 then 'tripping' when 1 then 'hooking' when 2 then 'too-many-men' when 3 then 'fighting' else 'misconduct' end",
    "penalty_duration": "case v % 5 when 3 then 5 when 4 then 10 else 2 end",
}


def rule(name: str) -> Column:
    return F.expr(RULES[name].replace("//", "div"))


def player_at(team: Column, slot: Column, g: Column) -> Column:
    """The id of the player in a slot; slot 0 moves to the next team and back."""
    index = F.when(slot == 0, (team - 1 + F.floor(g / 25) % 2) % 25).otherwise(team - 1)
    return (8470000 + index * 20 + slot).cast("long")


def teams(nation: DataFrame) -> DataFrame:
    return nation.select((F.col("n_nationkey") + 1).cast("int").alias("team_id"), F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("abbrev"))


def plays(events: DataFrame) -> DataFrame:
    """One row per play, with the players in their roles."""
    base = events.select(
        F.expr("event_id div 100").alias("g"),
        F.expr("event_id % 100").alias("i"),
        F.col("user_id").alias("u"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.round(F.col("value") * 100).cast("long").alias("v"),
    ).repartition("g")  # what follows is dear and needs games whole; the input may be one file of one task
    base = base.withColumns({n: rule(n) for n in RULES if n not in ("season", "game_type", "game_state")})
    home, away, kind, g = F.col("home_team_id"), F.col("away_team_id"), F.col("type_desc_key"), F.col("g")
    at_home = F.col("u") % 2 == 0
    base = base.withColumns({
        "event_owner_team_id": F.when(kind != "stoppage", F.when(at_home, home).otherwise(away)),
        "own": F.when(at_home, home).otherwise(away),
        "other": F.when(at_home, away).otherwise(home),
    })
    who = lambda team, slot: player_at(F.col(team), F.col(slot), g)
    goalie_slot = F.when((F.col("period_number") >= 3) & (g % 5 == 0), 19).otherwise(18)
    net = F.when(at_home, F.substring("situation_code", 1, 1)).otherwise(F.substring("situation_code", 4, 1))
    shot = kind.isin("shot-on-goal", "missed-shot", "blocked-shot")
    penalty = kind == "penalty"
    seconds = F.col("seconds")
    clock = lambda c: F.concat(F.lpad((c / 60).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((c % 60).cast("string"), 2, "0"))
    so_far = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    counts = F.col("period_type") != "SO"
    number = lambda which, when: F.when(when, F.count_if(which).over(so_far)).cast("int")
    goal, saved = (kind == "goal") & counts, (kind == "shot-on-goal") & counts
    scored = Window.partitionBy(rule("season"), who("own", "a")).orderBy("g", "i").rowsBetween(Window.unboundedPreceding, 0)
    return base.select(
        (2024020000 + g).alias("game_id"), F.col("i").cast("int").alias("event_id"), F.col("i").cast("int").alias("sort_order"),
        "type_desc_key", "event_owner_team_id", "period_number", "period_type",
        clock(seconds).alias("time_in_period"), clock(1200 - seconds).alias("time_remaining"), F.col("type_code").cast("int").alias("type_code"), "stoppage_reason",
        "situation_code", "x_coord", "y_coord", "zone_code",
        F.when(g % 7 == 0, None).when((F.col("period_number") + g) % 2 == 0, "left").otherwise("right").alias("home_team_defending_side"),
        F.when(shot | (kind == "goal"), F.col("shot_type")).alias("shot_type"),
        F.when(kind == "goal", who("own", "a")).alias("scoring_player_id"),
        F.when((kind == "goal") & (F.col("v") % 10 != 0), who("own", "b")).alias("assist1_player_id"),
        F.when((kind == "goal") & (F.col("v") % 10 >= 4), who("own", "c")).alias("assist2_player_id"),
        F.lit(None).cast("long").alias("assist3_player_id"),
        F.when(shot, who("own", "a")).alias("shooting_player_id"),
        F.when(kind.isin("goal", "shot-on-goal", "missed-shot") & ~net.eqNullSafe("0"), player_at(F.col("other"), goalie_slot, g)).alias("goalie_in_net_id"),
        F.when(kind == "blocked-shot", who("other", "o")).alias("blocking_player_id"),
        F.when(kind == "hit", who("own", "a")).alias("hitting_player_id"),
        F.when(kind == "hit", who("other", "o")).alias("hittee_player_id"),
        F.when(kind == "faceoff", who("own", "a")).alias("winning_player_id"),
        F.when(kind == "faceoff", who("other", "o")).alias("losing_player_id"),
        F.when(penalty, who("own", "a")).alias("committed_by_player_id"),
        F.when(penalty & (F.col("v") % 5 != 2), who("other", "o")).alias("drawn_by_player_id"),
        F.lit(None).cast("long").alias("served_by_player_id"),
        F.when(kind.isin("takeaway", "giveaway"), who("own", "a")).alias("player_id"),
        F.when(penalty, F.col("penalty_type_code")).alias("penalty_type_code"),
        F.when(penalty, F.col("penalty_desc_key")).alias("penalty_desc_key"),
        F.when(penalty, F.col("penalty_duration")).alias("penalty_duration"),
        number(goal & ~at_home, goal).alias("away_score"), number(goal & at_home, goal).alias("home_score"),
        number((goal | saved) & ~at_home, saved).alias("away_sog"), number((goal | saved) & at_home, saved).alias("home_sog"),
        F.when(goal, F.count_if(goal).over(scored)).cast("int").alias("scoring_player_total"),
    )


def games(plays: DataFrame) -> DataFrame:
    """One row per game, with the final score, from its plays."""
    counted = (F.col("type_desc_key") == "goal") & (F.col("period_type") != "SO")
    by_home = F.col("event_owner_team_id") == 1 + (F.col("game_id") - 2024020000) % 25
    numbers = plays.groupBy("game_id").agg(F.count_if(counted & by_home).alias("h"), F.count_if(counted & ~by_home).alias("a"))
    numbers = numbers.withColumn("g", F.col("game_id") - 2024020000)
    tied, even = F.col("h") == F.col("a"), F.col("g") % 2 == 0
    return numbers.withColumns({n: rule(n) for n in ("home_team_id", "away_team_id", "season", "game_type", "game_state")}).select(
        "game_id", "season", F.col("game_type").cast("int").alias("game_type"),
        F.date_add(F.make_date(F.expr("cast(2021 + g div 200 as int)"), F.lit(10), F.lit(1)), (F.col("g") % 200).cast("int")).alias("game_date"),
        "home_team_id", "away_team_id", "game_state", (F.col("game_state") == "OFF").alias("is_final"),
        (F.col("h") + F.when(tied & even, 1).otherwise(0)).cast("int").alias("home_final_score"),
        (F.col("a") + F.when(tied & ~even, 1).otherwise(0)).cast("int").alias("away_final_score"),
        F.when(tied, "SO").when(F.col("g") % 4 == 0, "OT").otherwise("REG").alias("last_period_type"), F.concat(F.lit("Arena "), F.col("home_team_id").cast("string")).alias("venue"),
    )


def rosters(games: DataFrame) -> DataFrame:
    """Twenty players for each side of each game."""
    g = F.col("game_id") - 2024020000
    sides = games.select("game_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    slots = sides.select("game_id", "team_id", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("slot"))
    s = F.col("slot")
    position = F.when((s < 4) | ((s == 4) & (g % 2 == 0)), "C").when(s < 9, "L").when(s < 13, "R").when(s < 18, "D").otherwise("G")
    player = player_at(F.col("team_id"), s, g)
    return slots.select("game_id", player.alias("player_id"), "team_id", position.alias("position_code"), (s + 1).cast("int").alias("sweater_number")).withColumns({
        "first_name": F.concat(F.lit("P"), F.col("player_id").cast("string")),
        "last_name": F.concat(F.lit("L"), (F.col("player_id") % 97).cast("string")),
    })


class League:
    """The typed tables that the blocks and queries read; from the derived tables, or any others of the same columns.

    by_season: gives rosters and plays of one season, where these are stored by season.
    """

    def __init__(self, games: DataFrame, rosters: DataFrame, plays: DataFrame, teams: DataFrame, by_season: Callable[[int], tuple[DataFrame, DataFrame]] | None = None) -> None:
        self.games, self.rosters, self.plays, self.teams, self.by_season = games, rosters, plays, teams, by_season

    def of_season(self, season: int | None) -> League:
        """The league with no more rosters and plays than a season's games need; the games stay as they are."""
        if season is None or self.by_season is None:
            return self
        return League(self.games, *self.by_season(season), self.teams)


#: Plays of a bucket on average, which bound a task's memory (whole games with their plays), and the fewest buckets; the most folders, so that the number of files grows with the plays and not with plays times seasons.
BUCKET_PLAYS, LEAST_BUCKETS, MOST_FOLDERS = 250_000, 8, 16


class Folders:
    """Seasons in blocks of equal width, which share a folder named for the block's first season; up to MOST_FOLDERS seasons have a folder each."""

    def __init__(self, first_game: int, last_game: int) -> None:
        self.first = first_game // 200
        self.width = -(-(last_game // 200 - self.first + 1) // MOST_FOLDERS)

    def column(self) -> Column:
        years = F.expr("season div 10000 - 2021") - self.first
        return (F.col("season") - F.pmod(years, F.lit(self.width)) * 10001).cast("int")

    def of(self, season: int) -> int:
        return season - (season // 10000 - 2021 - self.first) % self.width * 10001


def _store(df: DataFrame, root: str, name: str, buckets: int, blocks: Folders) -> str:
    """Writes a table in folders by season or block of seasons and buckets by game, so that tables join and plays are summed by game without a shuffle; returns its name in the catalog."""
    table = f"rinkline_{name}_{uuid.uuid4().hex}"
    rows = df.withColumn("season_from", blocks.column()).repartition(buckets, "game_id")  # the hash of the buckets: a task writes one bucket
    rows.write.format("parquet").option("path", f"{root}/{name}").partitionBy("season_from").bucketBy(buckets, "game_id").sortBy("game_id").saveAsTable(table)
    return table


def league(spark: SparkSession, sf_dir: str) -> League:
    """The typed tables of a folder, written once for each session and read by all queries after."""
    known = getattr(spark.sparkContext, "_rinkline_leagues", None)
    if known is None:
        known = spark.sparkContext._rinkline_leagues = {}
    names, blocks = known.get(sf_dir, (None, None))
    if names is None or not all(spark.catalog.tableExists(n) for n in names.values()):
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        game = F.expr("event_id div 100")
        rows, first, last = events.agg(F.count(F.lit(1)), F.min(game), F.max(game)).first()
        buckets, blocks = max(LEAST_BUCKETS, -(-rows // BUCKET_PLAYS)), Folders(first or 0, last or 0)
        root, names = new_path(spark, "league"), {}
        seasons = lambda df: df.withColumn("season", F.expr(RULES["season"].replace("//", "div").replace("g ", "(game_id - 2024020000) ")))
        names["plays"] = _store(seasons(plays(events)), root, "plays", buckets, blocks)
        names["games"] = _store(games(spark.table(names["plays"])), root, "games", buckets, blocks)
        names["rosters"] = _store(seasons(rosters(spark.table(names["games"]))), root, "rosters", buckets, blocks)
        known[sf_dir] = names, blocks
    rows = {name: spark.table(table) for name, table in names.items()}
    chosen = lambda season: (F.col("season_from") == blocks.of(season)) & (F.col("season") == season)
    of = lambda season: tuple(rows[name].where(chosen(season)).drop("season", "season_from") for name in ("rosters", "plays"))
    clubs = teams(spark.read.parquet(f"{sf_dir}/nation.parquet"))
    return League(rows["games"].drop("season_from"), rows["rosters"].drop("season", "season_from"), rows["plays"].drop("season", "season_from"), clubs, of)
