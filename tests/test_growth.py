"""Files and memory of the stored tables: both must follow the rows, not tasks times partitions or how many documents a file holds."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rinkline.operators import ingest
from rinkline.sources import silver
from rinkline.sources.documents import land_polls, stream_polls
from rinkline.streaming import live

DOCUMENT = "concat('{\"id\":', id, ',\"season\":20242025,\"gameType\":2,\"gameDate\":\"2024-12-10\",\"gameState\":\"LIVE\",\"awayTeam\":{\"id\":1,\"abbrev\":\"T1\",\"score\":1,\"commonName\":\"x\"},\"homeTeam\":{\"id\":2,\"abbrev\":\"T2\",\"score\":1,\"commonName\":\"x\"},\"plays\":[{\"eventId\":1,\"typeCode\":506,\"typeDescKey\":\"hit\",\"sortOrder\":1}]}')"


def _documents(spark, games, tasks):
    return spark.range(0, games, 1, tasks).selectExpr("id AS event_id", "timestamp_seconds(id) AS ingestion_timestamp", "'x' AS source", f"{DOCUMENT} AS raw_json")


def test_replaced_partitions_have_few_files(spark, tmp_path, monkeypatch):
    """16 tasks that each hold rows of all four partitions wrote 64 files a table, each with a checksum and processes that set permissions."""
    written = []
    kept = silver.move
    monkeypatch.setattr(silver, "move", lambda session, path, to: written.append((to, len(list((tmp_path / path.split(str(tmp_path))[1].strip("/")).glob("*.parquet"))))) or kept(session, path, to))
    store = silver.Silver(spark, f"file://{tmp_path}/silver", parts=4)
    good, _ = ingest.parsed(_documents(spark, 400, 16))
    games = ingest.parse_games(good)
    store.replace(games, games, ingest.parse_rosters(good), ingest.parse_plays(good))
    assert store.read("games").count() == store.read("plays").count() == 400
    assert len(written) == 8 and max(n for _, n in written) <= 4


def test_documents_lie_in_small_row_groups(spark, tmp_path):
    """Spark's reader holds up to 4,096 rows of a row group at once, 100 MB and more for a task if a file of 40 MB has but one."""
    rows = spark.range(0, 1000, 1, 1).select("id", F.lit(None).cast("timestamp").alias("fetched_at"), F.expr("concat('{\"gameState\":\"LIVE\",\"x\":\"', array_join(transform(sequence(1, 600), i -> sha2(cast(id * 1000 + i AS string), 256)), ''), '\"}')").alias("raw_json"))
    land_polls(rows.withColumnRenamed("id", "game_id"), str(tmp_path / "polls"))
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in (tmp_path / "polls").glob("*.parquet") for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 1000
    assert max(g.total_byte_size for g in groups) < 16 << 20


def test_a_micro_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    """Tables and ids come from stored snapshots; each parsed the accepted ones again."""
    seen, kept = [], silver.Silver.replace

    def replace(self, ids, *tables):
        seen.extend("from_json" in t._jdf.queryExecution().optimizedPlan().toString() for t in (ids, *tables))
        return kept(self, ids, *tables)

    monkeypatch.setattr(silver.Silver, "replace", replace)
    store = silver.Silver(spark, f"file://{tmp_path}/silver", parts=4)
    folder = str(tmp_path / "polls")
    land_polls(_documents(spark, 40, 4).selectExpr("event_id AS game_id", "ingestion_timestamp AS fetched_at", "raw_json"), folder)
    live.start_into(stream_polls(spark, folder), store, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.read("games").count() == store.read("plays").count() == 40
    assert seen and not any(seen)
    assert not list((tmp_path / "silver" / "_pending").iterdir())
