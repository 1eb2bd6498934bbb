"""Dimensions that are kept up to date from each night's games, without reading the others again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkline.operators import gold
from rinkline.sources.silver import read_version, swap_parts, write_version
from rinkline.sources.storage import delete, folders

DAYS = "player_id long, game_date date, team_id int"
STINTS = "player_id long, team_id int, valid_from date, valid_to date, games_in_stint long, is_current boolean"


class Stints:
    """Players' stints under a root folder, in partitions by a hash of the player, beside the days that they come from, which only grow."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 16) -> None:
        self.spark, self.root, self.parts = spark, root, parts

    def _table(self, name: str, schema: str, parts: list[int] | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        if not any(x.startswith("part=") for x in folders(self.spark, path)):
            return self.spark.createDataFrame([], f"{schema}, part int")
        rows = self.spark.read.schema(f"{schema}, part int").parquet(path)
        return rows if parts is None else rows.where(F.col("part").isin(parts))

    def read(self) -> DataFrame:
        return self._table("stints", STINTS).drop("part")

    def update(self, spots: DataFrame) -> None:
        """Adds roster spots (player_id, game_date, team_id) of more games, in any order of days; a repeated call changes nothing.

        Players whose new days all lie after their last stint only have that
        stint's ends joined with the new days.  The others' stints are made again
        from their own days.  Null players, teams and dates are left out.

        Spark: the new days are written once; of the stored tables only the
        partitions of these players are read, of days only where a player's days
        come late, and of stints only these are rewritten.
        """
        beside = f"{self.root}/_aside/{uuid.uuid4().hex}"
        part = F.pmod(F.xxhash64("player_id"), F.lit(self.parts)).cast("int").alias("part")
        gold.player_days(spots.where("player_id is not null")).select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in DAYS.split(", ")), part).write.parquet(f"{beside}/days")
        new = self.spark.read.parquet(f"{beside}/days")
        parts = sorted(r.part for r in new.select("part").distinct().collect())
        if parts:
            # first the days: if the run is lost after this, its repetition finds them late and starts from them
            new.repartition("part").write.mode("append").partitionBy("part").parquet(f"{self.root}/days")
            stints = self._table("stints", STINTS, parts)
            last = stints.where("is_current").drop("is_current", "part")
            first = new.groupBy("player_id").agg(F.min("game_date").alias("first"))
            state = first.join(last.select("player_id", "valid_to"), "player_id", "left").select("player_id", F.coalesce(F.col("first") <= F.col("valid_to"), F.lit(False)).alias("late"))
            state.write.parquet(f"{beside}/state")
            state = self.spark.read.parquet(f"{beside}/state")
            late, timely = (state.where(c).select("player_id") for c in ("late", "not late"))
            again = gold.player_days(self._table("days", DAYS, parts).join(late, "player_id", "left_semi"))
            pieces = gold.as_pieces(new.join(timely, "player_id", "left_semi").unionByName(again, allowMissingColumns=True))
            merged = gold.merged_stints(pieces.unionByName(last.join(timely, "player_id", "left_semi")))
            kept = stints.join(state.select("player_id", "late"), "player_id", "left").where("late is null or not (late or is_current)").drop("late", "part")
            swap_parts(kept.unionByName(merged).select("*", part), f"{self.root}/stints", parts, f"{beside}/stints")
        delete(self.spark, beside)


class Newest:
    """The newest attributes of each key and the first and last day it was seen, as a state that merges with more rows.

    key: the column that names a row; order: what tells newer rows, game_date
    and game_id; attributes: the columns kept.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, order: list[Column], attributes: list[str]) -> None:
        self.spark, self.root, self.name, self.key, self.order, self.attributes = spark, root, name, key, order, attributes

    def _loads(self) -> int:
        found = folders(self.spark, f"{self.root}/{self.name}")
        return int(found[-1][2:]) if found else 0

    def update(self, rows: DataFrame) -> DataFrame:
        """Merges more rows into the state and returns it; of rows with equal order those of the later call count, so a corrected game counts and a repeated call changes nothing.

        Spark: two small aggregations, of the new rows and of the state with them; the state has a row per key.
        """
        loads = self._loads()
        at = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(self.order)), F.lit(loads + 1).alias("load"))
        fresh = rows.where(F.col(self.key).isNotNull()).select(self.key, at.alias("at"), F.struct(*self.attributes).alias("a"), F.col("game_date").alias("first_seen"), F.col("game_date").alias("last_seen"))
        state = fresh if not loads else fresh.unionByName(read_version(self.spark, self.root, self.name))
        merged = state.groupBy(self.key).agg(F.max("at").alias("at"), F.max_by("a", "at").alias("a"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        return write_version(merged, self.root, self.name)


def players(spark: SparkSession, root: str) -> Newest:
    """The state of dim_player, from roster spots with their game's date."""
    return Newest(spark, root, "players", "player_id", [F.col("game_date"), F.col("game_id")], ["first_name", "last_name", "position_code", "sweater_number", "team_id"])


def dim_player(state: DataFrame) -> DataFrame:
    name = F.concat_ws(" ", "a.first_name", "a.last_name").alias("full_name")
    return state.select("player_id", name, "a.*", F.col("first_seen").alias("first_seen_date"), F.col("last_seen").alias("last_seen_date"))


def teams(spark: SparkSession, root: str) -> Newest:
    """The state of dim_team, from gold.team_sides."""
    return Newest(spark, root, "teams", "team_id", [F.col("game_date").isNotNull(), F.col("game_date"), F.col("game_id")], ["at"])


def dim_team(state: DataFrame) -> DataFrame:
    return state.select("team_id", "a.at.*")
