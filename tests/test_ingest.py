"""Documents and their odd cases, and the live scenario."""

import json

import pytest
from pyspark.sql import functions as F

from rinkline.operators import gold, ingest
from rinkline.sources import bronze, silver
from rinkline.sources.documents import land, land_polls, stream_files, stream_polls, whole_files
from rinkline.streaming import live


def _game(plays, game_id=2024020500, state="LIVE", **more):
    side = lambda i: {"id": i, "abbrev": f"T{i}", "score": 1, "commonName": {"default": "x"}}
    return {"id": game_id, "season": 20242025, "gameType": 2, "gameDate": "2024-12-10", "gameState": state, "awayTeam": side(1), "homeTeam": side(2), "plays": plays} | more


def _play(i, **more):
    return {"eventId": i, "typeCode": 506, "typeDescKey": "shot-on-goal", "sortOrder": i, "details": {"shootingPlayerId": 8470000 + i, "shotType": "wrist"}} | more


def _docs(spark, *documents):
    rows = [(i, "batch", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "event_id long, source string, raw_json string").selectExpr("event_id", "current_timestamp() AS ingestion_timestamp", "source", "raw_json")


def test_parsers(spark):
    spots = [{"playerId": 1, "teamId": 1, "firstName": "A"}, {"playerId": 1, "teamId": 2, "firstName": {"default": "B"}}, {"playerId": 0}, {"playerId": None}]
    docs = _docs(spark, _game([_play(1), _play(2, details=None)], rosterSpots=spots), _game([], game_id=7, gameType=4), "{not json", _game([], game_id=8))
    good, bad = ingest.parsed(docs)
    assert bad.count() == 1
    assert [(r.player_id, r.team_id, r.first_name) for r in ingest.parse_rosters(good).collect()] == [(1, 2, "B")]
    assert ingest.parse_plays(good).count() == 2 and ingest.parse_games(good).count() == 3
    assert ingest.kept_games(docs).count() == 2


def test_contract(spark):
    broken = _game([_play(1, odd=1)])
    del broken["season"]
    found = {(r.level, r.field, r.problem) for r in ingest.field_contract(_docs(spark, broken)).collect()}
    assert found == {("game", "season", "missing"), ("play", "odd", "unknown")}


def test_increment_and_replacement(spark):
    docs = _docs(spark, _game([_play(1)]), _game([_play(1), _play(2)]))
    assert {(r.event_id, r.newest) for r in ingest.newest_documents(docs).collect()} == {(0, False), (1, True)}
    assert ingest.new_documents(docs, docs).isEmpty()
    old = spark.createDataFrame([(1, "a"), (2, "b")], "game_id long, x string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "game_id long, x string")
    assert {tuple(r) for r in ingest.replaced(old, new).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    with pytest.raises(ValueError):
        ingest.check_layout(old, ["game_id", "season"])
    assert [r.year for r in ingest.missing_years(spark, docs, 2023, 2025, (2025,)).collect()] == [2023]


def test_live_scenario(spark, tmp_path):
    root, plays = tmp_path / "landing", [_play(i) for i in range(1, 31)]

    def land(time, game):
        folder = root / str(game["id"])
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{time}.json").write_text(json.dumps(game))

    owned = ingest.parse_games(ingest.parsed(_docs(spark, _game([], game_id=1)))[0])
    empty = ingest.parsed(_docs(spark, _game([], game_id=1)))[0]
    store = {"v": 0}
    (tmp_path / "t").mkdir()

    def save(number, tables):
        for name, df in zip(("games", "rosters", "plays"), tables):
            df.write.mode("overwrite").parquet(str(tmp_path / "t" / f"{name}-{store['v'] + 1}"))
        store["v"] += 1

    def read():
        return tuple(spark.read.parquet(str(tmp_path / "t" / f"{n}-{store['v']}")) for n in ("games", "rosters", "plays"))

    save(0, (owned, ingest.parse_rosters(empty), ingest.parse_plays(empty)))
    run = lambda: live.start(stream_files(spark, str(root)), read, save, str(tmp_path / "checkpoint")).awaitTermination()
    of = lambda game: read()[2].where(f"game_id = {game}")
    land("20241210T000000Z", _game(plays[:10]))
    run()
    assert of(2024020500).count() == 10
    changed = [dict(p, details={"shotType": "slap"}) if p["eventId"] == 5 else p for p in plays[:20] if p["eventId"] != 3]
    land("20241210T000100Z", _game(changed))
    run()
    assert of(2024020500).count() == 19 and of(2024020500).where("event_id = 5").first().shot_type == "slap"
    land("20241209T000000Z", _game(plays[:2]))  # older than what is stored
    land("20241210T000130Z", _game(plays[:3], game_id=1))  # owned by the batch path
    run()
    assert of(2024020500).count() == 19 and of(1).count() == 0
    land("20241210T000200Z", _game(plays, state="OFF"))
    run()
    assert of(2024020500).count() == 30 and read()[0].where("game_id = 2024020500").first().is_final
    files = whole_files(spark, str(root))
    assert live.play_versions(files).count() == 10 + 19 + 2 + 3 + 30
    assert ingest.changed_snapshots(files).count() == 5


def test_stored_tables(spark, tmp_path):
    """Batch runs with a ledger: newest document of a game, kinds that are not kept, a second run that changes nothing, the guard."""
    store = silver.Silver(spark, f"file://{tmp_path}/silver", parts=4)
    docs = _docs(spark, _game([_play(1)]), _game([_play(1), _play(2)]), _game([], game_id=7, gameType=4), _game([_play(3)], game_id=8), "{not json")
    store.load(docs.where("event_id <> 3"))
    assert {r.game_id: r.n for r in store.read("plays").groupBy("game_id").count().withColumnRenamed("count", "n").collect()} == {2024020500: 2}
    assert sorted(((r.bronze_event_id, r.play_count) for r in store.ledger().collect()), key=repr) == [(0, None), (1, 2), (2, None), (4, None)]
    store.load(docs)
    assert sorted(r.game_id for r in store.read("games").collect()) == [8, 2024020500]
    assert store.ledger().count() == 5 and ingest.unprocessed(docs, store.ledger()).isEmpty()
    games = store.read("games")
    store.replace(games.select("game_id"), games.limit(0), store.read("rosters").limit(0), store.read("plays").limit(0))
    assert store.read("games").isEmpty() and store.read("plays").isEmpty()
    store.guard()
    assert store.ledger().isEmpty()
    assert len(store.read("games").columns) == 35 and len(store.read("rosters").columns) == 10 and len(store.read("plays").columns) == 53


def test_live_into_stored_tables(spark, tmp_path):
    """The stream writes by the library's own writer; plays of all snapshots are chained through a table."""
    root, store = tmp_path / "landing", silver.Silver(spark, f"file://{tmp_path}/silver", parts=4)

    def land(time, game):
        folder = root / str(game["id"])
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{time}.json").write_text(json.dumps(game))

    run = lambda: live.start_into(stream_files(spark, str(root)), store, str(tmp_path / "c1")).awaitTermination()
    store.load(_docs(spark, _game([_play(1)], game_id=1)))
    plays = [_play(i) for i in range(1, 31)]
    land("20241210T000000Z", _game(plays[:10]))
    land("20241210T000000Z", _game(plays[:9], game_id=1))  # owned by the batch path
    run()
    assert store.read("plays").where("game_id = 2024020500").count() == 10 and store.read("plays").where("game_id = 1").count() == 1
    land("20241210T000100Z", _game([p for p in plays[:20] if p["eventId"] != 3]))
    land("20241209T000000Z", _game(plays[:2]))  # older than what is stored
    run()
    assert store.read("plays").where("game_id = 2024020500").count() == 19
    assert {r.source for r in store.read("plays").where("game_id = 2024020500").collect()} == {"live"}
    path = f"file://{tmp_path}/versions"
    live.append_versions(stream_files(spark, str(root)), path, str(tmp_path / "c2")).awaitTermination()
    counted = live.stream_table(spark, path).groupBy("game_id").count().writeStream.format("memory").queryName("versions").outputMode("complete").trigger(availableNow=True)
    counted.option("checkpointLocation", str(tmp_path / "c3")).start().awaitTermination()
    assert {(r.game_id, r["count"]) for r in spark.table("versions").collect()} == {(1, 9), (2024020500, 10 + 19 + 2)}


def test_versions_and_stints(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    one, two = spark.range(3), spark.range(5)
    silver.write_version(one, root, "t")
    assert silver.write_version(two, root, "t").count() == 5 and silver.read_version(spark, root, "t").count() == 5
    rows = [(1, 5, "2024-01-01"), (1, 4, "2024-01-01"), (1, None, "2024-01-02"), (1, 4, "2024-01-03"), (1, 6, "2024-01-04"), (1, 4, "2024-01-05"), (1, 4, None)]
    spots = spark.createDataFrame(rows, "player_id long, team_id int, d string").selectExpr("player_id", "team_id", "cast(d AS date) AS game_date")
    got = sorted((str(r.valid_from), str(r.valid_to), r.team_id, r.games_in_stint, r.is_current) for r in gold.dim_player_team(spots).collect())
    assert got == [("2024-01-01", "2024-01-03", 4, 2, False), ("2024-01-04", "2024-01-04", 6, 1, False), ("2024-01-05", "2024-01-05", 4, 1, True)]


def _stamped(spark, *rows):
    """(event_id, time, document) as bronze rows."""
    rows = [(i, f"url/{i}", time, d if isinstance(d, str) else json.dumps(d)) for i, time, d in rows]
    return spark.createDataFrame(rows, "event_id long, source string, time string, raw_json string").selectExpr("event_id", "cast(time AS timestamp) AS ingestion_timestamp", "source", "raw_json")


def test_older_document_never_wins(spark, tmp_path):
    """In one run and in two, whatever the keys say."""
    for split in (False, True):
        store = silver.Silver(spark, f"file://{tmp_path}/late{split}", parts=2)
        new, old = (5, "2024-12-11", _game([_play(1), _play(2)], state="OFF")), (9, "2024-12-01", _game([_play(1)], state="PRE"))
        if split:
            store.load(_stamped(spark, new))
            assert store.load(_stamped(spark, old))["late"] == 1
        else:
            store.load(_stamped(spark, new, old))
        assert [(r.game_state, r.is_final) for r in store.read("games").collect()] == [("OFF", True)]
        assert store.read("plays").count() == 2
        assert {(r.bronze_event_id, r.play_count) for r in store.ledger().collect()} == {(5, 2), (9, None)}
    same = (11, "2024-12-11", _game([_play(3)], state="OFF"))  # as new as what is stored
    store.load(_stamped(spark, same))
    assert [r.event_id for r in store.read("plays").collect()] == [3]


def test_contract_is_enforced(spark, tmp_path):
    broken, odd = _game([_play(1), {"eventId": 2}], game_id=3), _game([_play(1, strange=1)], game_id=4)
    del broken["season"]
    docs = _stamped(spark, (1, "2024-12-01", broken), (2, "2024-12-01", odd), (3, "2024-12-01", "{no"), (4, "2024-12-01", _game([], game_id=5) | {"homeTeam": None}), (5, "2024-12-01", _game([], game_id=6, gameType=4)))
    store = silver.Silver(spark, f"file://{tmp_path}/contract", parts=2)
    with pytest.raises(silver.ContractBreach, match="game.season"):
        store.load(docs)
    assert store.read("games").isEmpty() and store.ledger().isEmpty() and store.quarantine().isEmpty()
    counts = store.load(docs, on_breach="quarantine")
    assert counts == {"documents": 5, "loaded": 1, "late": 0, "breaches": 2, "malformed": 1, "unknown_fields": 1}
    assert [r.game_id for r in store.read("games").collect()] == [4] and store.ledger().count() == 5
    held = {r.event_id: r for r in store.quarantine().collect()}
    missing = lambda i: {(p.level, p.field) for p in held[i].problems if p.problem == "missing"}
    assert sorted(held) == [1, 3, 4] and held[3].malformed and held[3].raw_json == "{no"
    assert missing(1) == {("game", "season"), ("play", "sortOrder"), ("play", "typeCode"), ("play", "typeDescKey")}
    assert missing(4) == {("team", f) for f in ("id", "abbrev", "score", "commonName")}
    assert store.load(docs, on_breach="quarantine")["documents"] == 0 and store.quarantine().count() == 3


def test_old_layout_is_refused(spark, tmp_path):
    store = silver.Silver(spark, f"file://{tmp_path}/layout", parts=2)
    store.load(_stamped(spark, (1, "2024-12-01", _game([_play(1)]))))
    plays = spark.createDataFrame(store.read("plays").collect(), store.read("plays").schema)
    plays.selectExpr("*", "20242025 AS season", "0 AS part").write.mode("overwrite").partitionBy("part").parquet(f"{store.root}/plays")
    with pytest.raises(ValueError, match="season"):
        store.read("plays")


def test_appends_are_not_doubled(spark, tmp_path):
    table = bronze.Bronze(spark, f"file://{tmp_path}/bronze")
    docs = _stamped(spark, *((i, f"2024-12-{30 - i:02d}", _game([], game_id=i)) for i in range(1, 8)))
    assert table.read().isEmpty() and table.append(docs.where("event_id < 5"), "night-1") == 4
    assert table.append(docs.where("event_id < 5"), "night-1") == 0  # a repeated run
    first = {r.source: r.event_id for r in table.read().collect()}
    assert first == {"url/4": 1, "url/3": 2, "url/2": 3, "url/1": 4}  # in the order of time
    # a run that reserved its keys and was lost: another takes its turn, then it is repeated
    assert table.reserve("night-2", 3) == 5 and table.reserve("night-3", 0) == 8
    assert table.append(docs.where("event_id = 7"), "night-4") == 1 and table.append(docs.where("event_id = 7"), "night-5") == 0
    (tmp_path / "bronze" / "documents" / "run=night-2").mkdir()
    (tmp_path / "bronze" / "documents" / "run=night-2" / "part-0.parquet").write_bytes(b"half a file")
    assert table.read().count() == 5 and table.append(docs, "night-2") == 2
    rows = table.read().collect()
    assert len(rows) == 7 == len({r.event_id for r in rows}) == len({r.source for r in rows})
    assert next(r.event_id for r in rows if r.source == "url/7") == 8 and min(r.event_id for r in rows if r.source in ("url/5", "url/6")) > 8
    with pytest.raises(ValueError):
        table.append(docs, "../elsewhere")


def test_changed_snapshots_as_a_stream(spark, tmp_path):
    """The stream gives the batch form's rows across restarts; what comes late is left out."""
    folder, path, checkpoint = (f"file://{tmp_path}/{n}" for n in ("landing", "changes", "checkpoint"))

    def night(*rows):
        rows = [(g, f"2024-12-10 00:0{m}:00", json.dumps(d)) for g, m, d in rows]
        land(spark.createDataFrame(rows, "game_id long, time string, raw_json string").selectExpr("game_id", "cast(time AS timestamp) AS fetched_at", "raw_json"), folder)
        live.append_to(live.changed_snapshots(stream_files(spark, folder)), path, checkpoint).awaitTermination()

    a, b = _game([_play(1)], game_id=1), _game([_play(1), _play(2)], game_id=1)
    night((1, 0, a), (1, 1, a), (2, 1, _game([], game_id=2)))
    night((1, 2, a), (1, 3, b), (2, 2, _game([], game_id=2)))
    night((1, 5, b), (1, 6, a))
    key = lambda df: sorted((r.game_id, r.fetched_at.minute) for r in df.collect())
    assert key(spark.read.parquet(path)) == key(ingest.changed_snapshots(whole_files(spark, folder))) == [(1, 0), (1, 3), (1, 6), (2, 1)]
    night((1, 4, a))
    assert len(key(spark.read.parquet(path))) == 4


def test_polls_land_in_few_files(spark, tmp_path):
    """Snapshots of many games and times share files; streams of them and of files of their own give the same snapshots."""
    rows = [(g, f"2024-12-10 00:0{m}:00", json.dumps(_game([_play(1)], game_id=g))) for g in range(1, 11) for m in range(2)]
    snapshots = spark.createDataFrame(rows, "game_id long, time string, raw_json string").selectExpr("game_id", "cast(time AS timestamp) AS fetched_at", "raw_json")
    own, polls, out = (str(tmp_path / n) for n in ("own", "polls", "out"))
    land(snapshots, own)
    land_polls(snapshots.coalesce(2), polls)
    assert len(list((tmp_path / "polls").rglob("*.parquet"))) <= 2
    live.append_to(stream_polls(spark, polls), out, str(tmp_path / "c")).awaitTermination()
    key = lambda df: sorted((r.game_id, r.game_state, str(r.fetched_at), r.raw_json.strip()) for r in df.collect())
    assert key(spark.read.parquet(out)) == key(whole_files(spark, own)) and len(key(snapshots.withColumn("game_state", F.lit("LIVE")))) == 20


def test_casts_after_2099(spark, tmp_path):
    """Dates of any century are no dates once they are spoilt."""
    from rinkline.queries.pipeline import casts
    from rinkline.sources.derived import league

    sf = "/root/testdata/sf0.001"
    spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id + 2000000 AS event_id", "user_id", "value", "props").write.parquet(str(tmp_path / "events.parquet"))
    spark.read.parquet(f"{sf}/nation.parquet").write.parquet(str(tmp_path / "nation.parquet"))
    rows = casts(league(spark, str(tmp_path))).collect()
    assert rows and all(r.game_date is None if r.game_id % 2 == 0 else r.game_date.year == 2121 for r in rows)


def test_contract_counts_every_object_in_one_pass(spark):
    """Objects of all levels are counted, those that are no objects are not, and the documents are read once."""
    broken = _game([_play(1, odd=1), _play(2, odd=1, details=None), {"eventId": 3, "details": {"strange": 1}}, _play(4, details={"strange": 2})])
    del broken["season"], broken["homeTeam"]["id"]
    nothing = _game([])
    del nothing["awayTeam"], nothing["plays"]
    df = ingest.field_contract(_docs(spark, broken, nothing, "{not json"))
    assert {(r.level, r.field, r.problem): r.objects for r in df.collect()} == {
        ("game", "season", "missing"): 1, ("game", "awayTeam", "missing"): 1, ("game", "plays", "missing"): 1, ("team", "id", "missing"): 1, ("play", "odd", "unknown"): 2,
        ("play", "typeCode", "missing"): 1, ("play", "typeDescKey", "missing"): 1, ("play", "sortOrder", "missing"): 1, ("details", "strange", "unknown"): 2,
    }
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 0


def test_documents_are_built_once(spark, monkeypatch):
    """Queries that read the documents of all games several times, in one run and the next, build each once."""
    from rinkline.queries import pipeline
    from rinkline.sources.derived import league

    built, real = spark.sparkContext.accumulator(0), pipeline.documents.game_documents

    def counted(t):
        seen = F.udf(lambda text: built.add(1) or text, "string").asNondeterministic()
        return real(t).withColumn("raw_json", seen("raw_json"))

    monkeypatch.setattr(pipeline.documents, "game_documents", counted)
    t = league(spark, "/root/testdata/sf0.001")
    games = t.games.count()
    for query in (pipeline.replaced_games, pipeline.late, pipeline.quarantined, pipeline.viewed):
        before = built.value
        assert query(t).count() > 0
        assert built.value - before == games, query.__name__


def test_breaches_parse_plays_once(spark):
    """Problems of a document are those found object by object, and its plays are parsed once for all of them."""
    full = _game([_play(1), _play(2, odd=1, details={"strange": 1, "reason": "x"}), {"eventId": 3, "odd": 2}, _play(4, details="text"), _play(5, details=None)], extra=1)
    bare, other = _game([]), _game("no plays", awayTeam=None, homeTeam={"id": 1, "abbrev": "T", "score": 2, "commonName": "x", "nick": "y"})
    del bare["season"], bare["plays"]

    def told(document):
        found = set()
        plays = document.get("plays") if isinstance(document.get("plays"), list) else []
        objects = [("game", document)] + [("team", document.get(f"{s}Team") or {}) for s in ("away", "home")] + [("play", p) for p in plays]
        objects += [("details", p["details"] if isinstance(p["details"], dict) else {}) for p in plays if p.get("details") is not None]
        for level, o in objects:
            need, known = ingest.REQUIRED[level].split(), f"{ingest.REQUIRED[level]} {ingest.OPTIONAL[level]}".split()
            found |= {("missing", level, f) for f in need if f not in o} | {("unknown", level, f) for f in o if f not in known}
        return sorted(found)

    df = _docs(spark, full, bare, other).select("event_id", ingest.breaches(F.col("raw_json")).alias("p"))
    assert [[tuple(x) for x in r.p] for r in df.orderBy("event_id").collect()] == [told(d) for d in (full, bare, other)]
    assert df._jdf.queryExecution().analyzed().toString().count("$.plays") == 1


def test_whole_files_of_polls(spark, tmp_path):
    """Landed files hold many games of a poll and are read whole; rows are those of files of their own, and files don't grow with games times polls."""
    from rinkline.sources.documents import land_files, poll_files

    rows = [(g, f"2024-12-10 00:0{m}:00", json.dumps(_game([_play(1)], game_id=g, venue={"default": "a\\nb"}), indent=1 if g == 1 else None)) for g in range(1, 101) for m in range(2)]
    snapshots = spark.createDataFrame(rows, "game_id long, time string, raw_json string").selectExpr("game_id", "cast(time AS timestamp) AS fetched_at", "raw_json")
    own, polls = (str(tmp_path / n) for n in ("own", "polls"))
    land(snapshots, own)
    land_files(snapshots.coalesce(1), polls)
    land_files(snapshots.where("game_id = 7 and fetched_at < timestamp'2024-12-10 00:01:00'"), polls)
    key = lambda df: sorted((r.game_id, r.game_state, str(r.fetched_at), json.dumps(json.loads(r.raw_json))) for r in df.collect())
    got = key(poll_files(spark, polls))
    assert len(got) == 201 and sorted(set(got)) == key(whole_files(spark, own))
    assert len([f for f in (tmp_path / "polls").rglob("part-*")]) == 5  # 64 and 36 games of two polls, and one again


def test_buckets_bound_a_task(spark):
    """A task that gathers whole games takes up to a bucket of plays, some 1.5 kB each, whatever the tables' size."""
    from rinkline.sources import derived

    assert derived.BUCKET_PLAYS * 1536 < 1 << 29
