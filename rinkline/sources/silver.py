"""The stored typed tables: games, rosters, plays and the ledger of documents that were handled.

The three tables are partitioned by a hash of the game, and replacing games
rewrites only the partitions that hold them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rinkline.operators import ingest
from rinkline.sources.storage import delete, empty, exists, folders, move, write_documents

#: In the order of writing: a game's row says that its rosters and plays are in place.
TABLES = ("rosters", "plays", "games")
QUARANTINE = "event_id long, game_id long, ingestion_timestamp timestamp, malformed boolean, problems array<struct<problem: string, level: string, field: string>>, raw_json string"
_QUARANTINE_COLUMNS = ["event_id", "game_id", "ingestion_timestamp", "malformed", "problems", "raw_json"]
LEDGER = "bronze_event_id long, game_id long, play_count long, processed_at timestamp"


class ContractBreach(ValueError):
    """Documents lack required fields."""


def write_version(df: DataFrame, root: str, name: str) -> DataFrame:
    """Overwrites a table: written as a new version, which readers take once it is whole; older ones go. Returns the table."""
    spark = df.sparkSession
    old = folders(spark, f"{root}/{name}")
    path = f"{root}/{name}/v={int(old[-1][2:]) + 1 if old else 1:010d}"
    df.write.parquet(path)
    for version in old:
        delete(spark, f"{root}/{name}/{version}")
    return read_version(spark, root, name)


def read_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    whole = [v for v in folders(spark, f"{root}/{name}") if exists(spark, f"{root}/{name}/{v}/_SUCCESS")]
    return spark.read.parquet(f"{root}/{name}/{whole[-1]}")


def swap_parts(rows: DataFrame, path: str, parts: list[int], aside: str) -> None:
    """Replaces partitions of a table (folders part=<n>) by rows, which may be read from it: they are written aside first, so a lost task never meets a half-replaced table, and whole folders then take the places of the old ones.

    Rows are brought together by partition, large ones in several tasks, so that files grow with the rows and not with tasks times partitions.
    """
    spark = rows.sparkSession
    rows.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(aside)
    filled = [int(x.removeprefix("part=")) for x in folders(spark, aside) if x.startswith("part=")]
    for part in filled:
        move(spark, f"{aside}/part={part}", f"{path}/part={part}")
    for part in set(parts) - set(filled):
        delete(spark, f"{path}/part={part}")
    delete(spark, aside)


class Silver:
    """Typed tables under a root folder. parts: partitions of each table, fixed when it is made."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 64) -> None:
        self.spark, self.root, self.parts = spark, root, parts

    def _empty(self, name: str) -> DataFrame:
        none = empty(self.spark, "event_id long, source string, ingestion_timestamp timestamp, raw_json string")
        good, _ = ingest.parsed(none)
        return {"games": ingest.parse_games, "rosters": ingest.parse_rosters, "plays": ingest.parse_plays}[name](good)

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("game_id"), F.lit(self.parts)).cast("int")

    def read(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """A table, or only some of its partitions; empty if nothing was written yet."""
        path = f"{self.root}/{name}"
        if not any(x.startswith("part=") for x in folders(self.spark, path)):
            return self._empty(name)
        rows = self.spark.read.parquet(path)
        rows = (rows if parts is None else rows.where(F.col("part").isin(parts))).drop("part")
        return ingest.check_layout(rows, self._empty(name).columns)

    def replace(self, ids: DataFrame, games: DataFrame, rosters: DataFrame, plays: DataFrame) -> None:
        """Swaps every row of the games in ids for those given, table by table, games last. Repeating it changes nothing."""
        new = dict(zip(TABLES, (rosters, plays, games)))
        ids = ids.select("game_id").distinct()
        parts = [r[0] for r in ids.select(self._part().alias("part")).distinct().collect()]
        if not parts:
            return
        beside = f"{self.root}/_aside/{uuid.uuid4().hex}"  # runs at the same time must not meet here
        for name in TABLES:
            kept = self.read(name, parts).join(ids, "game_id", "left_anti")
            swap_parts(kept.unionByName(new[name]).withColumn("part", self._part()), f"{self.root}/{name}", parts, f"{beside}/{name}")
        delete(self.spark, beside)

    def ledger(self) -> DataFrame:
        path = f"{self.root}/ledger"
        return self.spark.read.schema(LEDGER).parquet(path) if exists(self.spark, path) else empty(self.spark, LEDGER)

    def guard(self) -> None:
        """If the tables hold no game, the ledger is void: otherwise every document would be skipped for ever."""
        if self.read("games").isEmpty():
            delete(self.spark, f"{self.root}/ledger")

    def quarantine(self) -> DataFrame:
        """Documents that were not loaded: malformed ones, and with `quarantine` those that breach the field contract, with their problems."""
        path = f"{self.root}/quarantine"
        return self.spark.read.schema(QUARANTINE).parquet(path) if exists(self.spark, path) else empty(self.spark, QUARANTINE)

    def load(self, bronze: DataFrame, on_breach: str = "fail") -> dict[str, int]:
        """One batch run over documents (event_id, source, ingestion_timestamp, raw_json): those not in the ledger are parsed and replace their games.

        Of a game's documents the newest counts, and only if it is not older than
        what is stored of the game.  The others, kinds of games that are not kept
        and texts that are no documents go into the ledger without a number of
        plays.  A document that lacks a required field stops the run before
        anything is stored (on_breach="fail", ContractBreach), or goes to the
        quarantine and the ledger while the others are loaded ("quarantine").
        The ledger is appended to last; a run that is repeated changes nothing.

        Returns the counts that were observed while the documents were parsed:
        documents, loaded, late, breaches, malformed, and unknown_fields, the
        documents with fields that no one knows.

        Spark: documents are parsed and checked in one pass, which is stored and
        observed; rosters, plays and games are taken from it.
        """
        if on_breach not in ("fail", "quarantine"):
            raise ValueError(f"on_breach is fail or quarantine, not {on_breach}")
        self.guard()
        pending = ingest.newest_documents(ingest.unprocessed(bronze, self.ledger()))
        stored_at = self.read("games").groupBy("game_id").agg(F.max("fetched_at").alias("stored_at"))
        rows = pending.join(stored_at, "game_id", "left").withColumn("late", F.coalesce(F.col("ingestion_timestamp") < F.col("stored_at"), F.lit(False)))
        kept = F.coalesce(F.get_json_object("raw_json", "$.gameType").try_cast("int").isin(*ingest.GAME_TYPES), F.lit(False))
        rows = rows.withColumn("d", F.from_json("raw_json", ingest.SCHEMA)).withColumn("malformed", F.col("d.id").isNull())
        chosen = F.col("newest") & kept & ~F.col("malformed") & ~F.col("late")
        rows = rows.withColumn("chosen", F.coalesce(chosen, F.lit(False))).withColumn("problems", F.when(F.col("chosen"), ingest.breaches(F.col("raw_json"))))
        rows = rows.withColumn("broken", F.coalesce(F.exists("problems", lambda p: p["problem"] == "missing"), F.lit(False)))
        seen = Observation()
        watched = rows.observe(
            seen, F.count(F.lit(1)).alias("documents"), F.count_if(F.col("chosen") & ~F.col("broken")).alias("loaded"), F.count_if("late").alias("late"), F.count_if("broken").alias("breaches"),
            F.count_if("malformed").alias("malformed"), F.count_if(F.exists("problems", lambda p: p["problem"] == "unknown")).alias("unknown_fields"),
        )
        path = f"{self.root}/_pending/{uuid.uuid4().hex}"
        keep = F.when(F.col("broken") | F.col("malformed"), F.col("raw_json")).alias("raw_json")
        write_documents(watched.select("event_id", "game_id", "ingestion_timestamp", "malformed", "chosen", "broken", "problems", F.when(F.col("chosen"), F.col("d")).alias("d"), keep), path)
        checked, counts = self.spark.read.parquet(path), seen.get
        try:
            if counts["breaches"] and on_breach == "fail":
                first = checked.where("broken").orderBy("event_id").limit(5).collect()
                told = "; ".join(f"document {r.event_id} lacks " + ", ".join(f"{p.level}.{p.field}" for p in r.problems if p.problem == "missing") for r in first)
                raise ContractBreach(f"{counts['breaches']} documents lack required fields: {told}")
            good = checked.where("chosen and not broken").withColumn("source", F.lit("batch"))
            self.replace(good.select(F.col("d.id").alias("game_id")), ingest.parse_games(good), ingest.parse_rosters(good), ingest.parse_plays(good))
            bad = checked.where("broken or malformed").join(self.quarantine().select("event_id").distinct(), "event_id", "left_anti")
            if counts["breaches"] or counts["malformed"]:
                bad.select(*_QUARANTINE_COLUMNS).write.mode("append").parquet(f"{self.root}/quarantine")
            plays = F.when(F.col("chosen") & ~F.col("broken"), F.coalesce(F.size("d.plays"), F.lit(0)).cast("long"))
            handled = checked.select(F.col("event_id").alias("bronze_event_id"), "game_id", plays.alias("play_count"), F.current_timestamp().alias("processed_at"))
            handled.write.mode("append").parquet(f"{self.root}/ledger")
        finally:
            delete(self.spark, path)
        return counts
