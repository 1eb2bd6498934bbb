"""The live path: landed snapshots as a stream, replaced into typed tables micro-batch by micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rinkline.operators import ingest
from rinkline.sources.silver import Silver
from rinkline.sources.storage import delete, write_documents


def changed_snapshots(snapshots: DataFrame) -> DataFrame:
    """A stream's snapshots (game_id, fetched_at, raw_json) whose state, plays or scores differ from the game's one before, as the batch form tells them.

    The state of a game is the time and print of its last snapshot, whatever the
    number of snapshots; it survives restarts with the query's checkpoint.  A
    snapshot that is not newer than the last one seen is left out: what was
    emitted can't be taken back.  Prints are made before rows go to Python.
    """
    rows = snapshots.where("game_id is not null and fetched_at is not null").select("game_id", "fetched_at", "raw_json", ingest.snapshot_print().alias("print"))

    def changed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, before = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(["fetched_at", "print"])
        if last is not None:
            rows = rows[rows["fetched_at"] > pd.Timestamp(last)]
        rows = rows.drop_duplicates("fetched_at")
        if len(rows):
            kept = rows[rows["print"] != rows["print"].shift(fill_value=before if before is not None else "")]
            state.update((rows["fetched_at"].iloc[-1].to_pydatetime(), rows["print"].iloc[-1]))
            yield kept[["game_id", "fetched_at", "raw_json"]]

    return rows.groupBy("game_id").applyInPandasWithState(changed, "game_id long, fetched_at timestamp, raw_json string", "last timestamp, print string", "append", GroupStateTimeout.NoTimeout)


def append_to(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends a stream's rows to a table of Parquet files."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)


def play_versions(snapshots: DataFrame) -> DataFrame:
    """Every play of every snapshot, as text beside its keys: append-only, stateless."""
    plays = F.from_json(F.get_json_object("raw_json", "$.plays"), "array<string>")
    rows = snapshots.select("game_id", "game_state", "fetched_at", F.explode(plays).alias("play_json"))
    field = lambda name: F.get_json_object("play_json", f"$.{name}")
    return rows.select("game_id", field("eventId").cast("int").alias("event_id"), field("sortOrder").cast("int").alias("sort_order"), field("typeDescKey").alias("type_desc_key"), "game_state", "fetched_at", "play_json")


def newest_snapshots(batch: DataFrame) -> DataFrame:
    """The newest snapshot of each game in a micro-batch."""
    rest = [c for c in batch.columns if c not in ("game_id", "fetched_at")]
    rows = batch.groupBy("game_id").agg(F.max("fetched_at").alias("fetched_at"), F.max_by(F.struct(*rest), "fetched_at").alias("s"))
    return rows.select("game_id", "fetched_at", "s.*")


def allowed_snapshots(snapshots: DataFrame, games: DataFrame) -> DataFrame:
    """Snapshots of games that the batch path does not own and that are not older than what is stored; equal times are applied, so a repeated batch does no harm."""
    stored = games.select("game_id", F.col("source").alias("owner"), F.col("fetched_at").alias("stored_at"))
    rows = snapshots.join(stored, "game_id", "left").where("not (owner <=> 'batch') and (stored_at is null or fetched_at >= stored_at)")
    return rows.drop("owner", "stored_at")


def accepted_snapshots(batch: DataFrame, games: DataFrame) -> DataFrame:
    """The snapshots of a micro-batch that are accepted, given the stored games, with the parsed object `d`."""
    accepted = allowed_snapshots(newest_snapshots(batch), games)
    rows = accepted.select(F.lit("live").alias("source"), F.col("fetched_at").alias("ingestion_timestamp"), "raw_json")
    return ingest.parsed(rows)[0]


def parsed_snapshots(batch: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Games, rosters and plays of the snapshots of a micro-batch that are accepted, given the stored games."""
    good = accepted_snapshots(batch, games)
    return ingest.parse_games(good), ingest.parse_rosters(good), ingest.parse_plays(good)


def apply_snapshots(batch: DataFrame, games: DataFrame, rosters: DataFrame, plays: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables after a micro-batch: every accepted game is swapped whole, which adds, corrects and deletes plays."""
    new = parsed_snapshots(batch, games)
    emptied = lambda old, fresh: old.join(new[0].select("game_id"), "game_id", "left_anti").unionByName(fresh)  # noqa: E731  also games that have no plays any more
    return tuple(emptied(old, fresh) for old, fresh in zip((games, rosters, plays), new))


def start_into(snapshots: DataFrame, store: Silver, checkpoint: str, **trigger) -> StreamingQuery:
    """Runs the stream into stored tables: a micro-batch reads and rewrites only the partitions of its games.

    The batch is read once and its accepted snapshots are parsed once; they are stored, and the tables taken from them.
    """

    def batch(df: DataFrame, number: int) -> None:
        path = f"{store.root}/_pending/{uuid.uuid4().hex}"
        try:
            write_documents(accepted_snapshots(df, store.read("games")).drop("raw_json"), path)
            good = store.spark.read.parquet(path)
            store.replace(good.select(F.col("d.id").alias("game_id")), ingest.parse_games(good), ingest.parse_rosters(good), ingest.parse_plays(good))
        finally:
            delete(store.spark, path)

    return snapshots.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def append_versions(snapshots: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends every play of every snapshot to a table of Parquet files."""
    return append_to(play_versions(snapshots), path, checkpoint, **trigger)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A table that a stream appends to, read as a stream: streams are chained through it."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def start(snapshots: DataFrame, read: Callable[[], tuple[DataFrame, DataFrame, DataFrame]], write: Callable[[int, tuple[DataFrame, DataFrame, DataFrame]], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Runs the stream: read gives the tables as they are, write stores rosters, plays and then games, the commit mark."""

    def batch(df: DataFrame, number: int) -> None:
        write(number, apply_snapshots(df, *read()))

    return snapshots.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
