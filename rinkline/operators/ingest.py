"""From raw game documents to typed tables: incremental choice, field contract, parsing, replacement of games."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Game types that are kept, and states of a finished game.
GAME_TYPES, FINAL_STATES = (1, 2, 3), ("OFF", "FINAL")
#: The field contract, required and optional fields by level.
REQUIRED = {
    "game": "id season gameType gameDate gameState awayTeam homeTeam plays",
    "team": "id abbrev score commonName",
    "play": "eventId typeCode typeDescKey sortOrder",
    "details": "",
}
OPTIONAL = {
    "game": "limitedScoring startTimeUTC easternUTCOffset venueUTCOffset gameScheduleState regPeriods venue venueLocation gameOutcome periodDescriptor tvBroadcasts shootoutInUse otInUse clock displayPeriod maxPeriods rosterSpots summary specialEvent",
    "team": "sog logo darkLogo placeName placeNameWithPreposition radioLink",
    "play": "periodDescriptor timeInPeriod timeRemaining details situationCode homeTeamDefendingSide pptReplayUrl",
    "details": "xCoord yCoord zoneCode eventOwnerTeamId shotType shootingPlayerId goalieInNetId scoringPlayerId scoringPlayerTotal assist1PlayerId assist1PlayerTotal assist2PlayerId assist2PlayerTotal assist3PlayerId assist3PlayerTotal awayScore homeScore awaySOG homeSOG hittingPlayerId hitteePlayerId blockingPlayerId winningPlayerId losingPlayerId playerId typeCode descKey duration committedByPlayerId drawnByPlayerId servedByPlayerId reason secondaryReason highlightClip highlightClipFr highlightClipSharingUrl highlightClipSharingUrlFr discreteClip discreteClipFr",
}
#: Names of the game types.
TYPE_NAMES = {
    1: "Preseason", 2: "Regular season", 3: "Playoffs", 4: "All-Star", 6: "World Cup group stage", 7: "World Cup knockout stage", 8: "World Cup pre-tournament", 9: "Olympics",
    10: "Young Stars", 12: "All-Stars exhibition", 13: "2004 labor dispute lost games", 14: "Canada Cup", 18: "Overseas exhibition", 19: "Four Nations Face-Off",
}
#: Fields of a play's details, by the columns that hold them, and the columns' types.
DETAILS = {
    "int": "x_coord:xCoord y_coord:yCoord event_owner_team_id:eventOwnerTeamId scoring_player_total:scoringPlayerTotal assist1_player_total:assist1PlayerTotal assist2_player_total:assist2PlayerTotal "
    "assist3_player_total:assist3PlayerTotal away_score:awayScore home_score:homeScore away_sog:awaySOG home_sog:homeSOG penalty_duration:duration",
    "string": "zone_code:zoneCode shot_type:shotType penalty_type_code:typeCode penalty_desc_key:descKey stoppage_reason:reason secondary_stoppage_reason:secondaryReason "
    "highlight_clip_sharing_url:highlightClipSharingUrl highlight_clip_sharing_url_fr:highlightClipSharingUrlFr",
    "bigint": "shooting_player_id:shootingPlayerId goalie_in_net_id:goalieInNetId scoring_player_id:scoringPlayerId assist1_player_id:assist1PlayerId assist2_player_id:assist2PlayerId "
    "assist3_player_id:assist3PlayerId hitting_player_id:hittingPlayerId hittee_player_id:hitteePlayerId blocking_player_id:blockingPlayerId winning_player_id:winningPlayerId "
    "losing_player_id:losingPlayerId committed_by_player_id:committedByPlayerId drawn_by_player_id:drawnByPlayerId served_by_player_id:servedByPlayerId player_id:playerId "
    "highlight_clip:highlightClip highlight_clip_fr:highlightClipFr discrete_clip:discreteClip discrete_clip_fr:discreteClipFr",
}
_DETAIL_OF = {pair.split(":")[0]: pair.split(":")[1] for text in DETAILS.values() for pair in text.split()}
_PLAY = (
    "eventId: int, sortOrder: int, typeCode: int, typeDescKey: string, periodDescriptor: struct<number: int, periodType: string>, timeInPeriod: string, timeRemaining: string, situationCode: string, "
    "homeTeamDefendingSide: string, pptReplayUrl: string, details: struct<"
    + ", ".join(f"{pair.split(':')[1]}: {kind}" for kind, text in DETAILS.items() for pair in text.split())
    + ">"
)
_TEAM = "struct<id: int, abbrev: string, score: int, sog: int, commonName: string, placeName: string, logo: string, darkLogo: string>"
SCHEMA = (
    "id bigint, season int, gameType int, limitedScoring boolean, gameDate string, gameState string, gameScheduleState string, startTimeUTC string, easternUTCOffset string, venueUTCOffset string, "
    f"venue string, venueLocation string, regPeriods int, specialEvent string, awayTeam {_TEAM}, homeTeam {_TEAM}, gameOutcome struct<lastPeriodType: string>, "
    f"rosterSpots array<struct<playerId: bigint, teamId: int, firstName: string, lastName: string, positionCode: string, sweaterNumber: int, headshot: string>>, plays array<struct<{_PLAY}>>"
)


def localised(c: Column) -> Column:
    """A text that is either plain or an object with a default."""
    return F.coalesce(F.get_json_object(c, "$.default"), c)


def new_documents(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose source is not stored yet; null sources are new."""
    return documents.join(stored.select("source").distinct(), "source", "left_anti")


def unprocessed(bronze: DataFrame, ledger: DataFrame) -> DataFrame:
    return bronze.join(ledger.select(F.col("bronze_event_id").alias("event_id")).distinct(), "event_id", "left_anti")


def newest_documents(documents: DataFrame) -> DataFrame:
    """With `newest`: whether the row is its game's last by (ingestion_timestamp, event_id). A game's maximum combines before the shuffle, so no window gathers its rows; documents are dealt evenly by game, whichever way Spark then joins."""
    rows = documents.withColumn("game_id", F.get_json_object("raw_json", "$.id").try_cast("long"))
    last = rows.groupBy("game_id").agg(F.max(F.struct("ingestion_timestamp", "event_id")).alias("last"))
    return rows.repartition("game_id").join(last, "game_id", "left").withColumn("newest", F.col("event_id") == F.col("last.event_id")).drop("last")


def final_documents(documents: DataFrame) -> DataFrame:
    return documents.where(F.get_json_object("raw_json", "$.gameState").isin(*FINAL_STATES))


def kept_games(documents: DataFrame) -> DataFrame:
    return documents.where(F.get_json_object("raw_json", "$.gameType").try_cast("int").isin(*GAME_TYPES))


def snapshot_print() -> Column:
    """Digest of a snapshot's state, plays and scores."""
    parts = [F.coalesce(F.get_json_object("raw_json", p), F.lit("")) for p in ("$.gameState", "$.plays", "$.awayTeam.score", "$.homeTeam.score", "$.awayTeam.sog", "$.homeTeam.sog")]
    return F.sha1(F.concat_ws("\u0001", *parts))


def changed_snapshots(snapshots: DataFrame) -> DataFrame:
    """Snapshots (game_id, fetched_at, raw_json) whose state, plays or scores differ from the one before."""
    order = Window.partitionBy("game_id").orderBy("fetched_at")
    marked = snapshots.withColumn("print", snapshot_print()).withColumn("before", F.lag("print").over(order))
    return marked.where(~F.col("print").eqNullSafe(F.col("before"))).drop("before")


def field_contract(documents: DataFrame) -> DataFrame:
    """(level, field, problem): required fields that a document lacks (`missing`), fields that no one knows (`unknown`), with the number of objects."""
    rows = documents.select("raw_json", F.from_json(F.get_json_object("raw_json", "$.plays"), "array<string>").alias("plays"))
    object_of = lambda level, o: F.struct(F.lit(level).alias("level"), o.alias("o"))
    whole = [object_of("game", F.col("raw_json"))] + [object_of("team", F.get_json_object("raw_json", f"$.{s}Team")) for s in ("away", "home")]
    rows = rows.select(F.explode(F.concat(F.array(*whole), F.coalesce(F.transform("plays", lambda p: object_of("play", p)), F.array().cast("array<struct<level: string, o: string>>")))).alias("x"))
    details = F.when(F.col("x.level") == "play", object_of("details", F.get_json_object("x.o", "$.details")))
    keys = rows.select(F.explode(F.array(F.col("x"), details)).alias("x")).select("x.level", F.json_object_keys("x.o").alias("k"))
    fields = {level: (REQUIRED[level].split(), (REQUIRED[level] + " " + OPTIONAL[level]).split()) for level in REQUIRED}
    names = lambda some: F.array(*map(F.lit, some)).cast("array<string>")
    told = lambda problem, each: F.transform(each, lambda f: F.struct(f.alias("field"), F.lit(problem).alias("problem")))
    found = None
    for level, (need, known) in fields.items():
        both = F.concat(told("missing", F.array_except(names(need), "k")), told("unknown", F.array_except("k", names(known))))
        found = F.when(F.col("level") == level, both) if found is None else found.when(F.col("level") == level, both)
    out = keys.where("k is not null").select("level", F.inline(found))
    return out.groupBy("level", "field", "problem").agg(F.count(F.lit(1)).alias("objects"))


def breaches(raw: Column) -> Column:
    """What a document lacks or has beyond the field contract: an array of (problem, level, field), each once.

    Absent teams lack all their fields; plays and their details are looked at in the document's own row.
    The text is parsed once for its plays and each object once for its keys, which both kinds of problems are
    told from: a variable of a lambda over an array of one stands for what would be parsed anew wherever it is named.
    """
    names = lambda text: F.array(*map(F.lit, text.split())) if text else F.array().cast("array<string>")
    keys = lambda o: F.coalesce(F.json_object_keys(o), F.array().cast("array<string>"))
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)
    told = lambda problem, level: lambda f: F.struct(F.lit(problem).alias("problem"), F.lit(level).alias("level"), f.alias("field"))

    def of(level: str):
        need, known = names(REQUIRED[level]), names(f"{REQUIRED[level]} {OPTIONAL[level]}")

        def found(each: Column) -> Column:
            missing = F.filter(need, lambda f: F.exists(each, lambda k: ~F.array_contains(k, f)))
            unknown = F.array_except(F.flatten(each), known)
            return F.concat(F.transform(missing, told("missing", level)), F.transform(unknown, told("unknown", level)))

        return found

    plays = F.coalesce(F.from_json(F.get_json_object(raw, "$.plays"), "array<string>"), F.array().cast("array<string>"))
    details = lambda p: F.filter(F.transform(p, lambda x: F.get_json_object(x, "$.details")), lambda x: x.isNotNull())
    found = [
        once(F.array(keys(raw)), of("game")),
        once(F.array(keys(F.get_json_object(raw, "$.awayTeam")), keys(F.get_json_object(raw, "$.homeTeam"))), of("team")),
        once(plays, lambda p: F.concat(once(F.transform(p, keys), of("play")), once(F.transform(details(p), keys), of("details")))),
    ]
    return F.array_sort(F.concat(*found))


def parsed(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with the parsed object `d`, and the quarantine: rows whose text is no such object."""
    rows = documents.withColumn("d", F.from_json("raw_json", SCHEMA))
    good = F.col("d.id").isNotNull()
    return rows.where(good), rows.where(F.coalesce(~good, F.lit(True))).drop("d")


def parse_games(rows: DataFrame) -> DataFrame:
    """One row per document, of 35 columns. Rows: source, ingestion_timestamp (when the document was fetched) and d."""
    d = lambda c: F.col(f"d.{c}")
    side = lambda name: [
        d(f"{name}Team.id").alias(f"{name}_team_id"), d(f"{name}Team.abbrev").alias(f"{name}_team_abbrev"), localised(d(f"{name}Team.commonName")).alias(f"{name}_team_name"),
        localised(d(f"{name}Team.placeName")).alias(f"{name}_team_place_name"), d(f"{name}Team.logo").alias(f"{name}_team_logo"), d(f"{name}Team.darkLogo").alias(f"{name}_team_dark_logo"),
        d(f"{name}Team.score").alias(f"{name}_final_score"), d(f"{name}Team.sog").alias(f"{name}_final_sog"),
    ]
    return rows.select(
        d("id").alias("game_id"), d("season").alias("season"), d("gameType").alias("game_type"), d("limitedScoring").alias("limited_scoring"),
        F.substring(d("gameDate"), 1, 10).try_cast("date").alias("game_date"), localised(d("venue")).alias("venue"), localised(d("venueLocation")).alias("venue_location"),
        F.try_to_timestamp(d("startTimeUTC")).alias("start_time_utc"), d("easternUTCOffset").alias("eastern_utc_offset"), d("venueUTCOffset").alias("venue_utc_offset"),
        d("gameState").alias("game_state"), d("gameScheduleState").alias("game_schedule_state"), *side("away"), *side("home"), d("gameOutcome.lastPeriodType").alias("last_period_type"),
        d("regPeriods").alias("reg_periods"), localised(d("specialEvent")).alias("special_event"), F.col("source"), d("gameState").isin(*FINAL_STATES).alias("is_final"),
        F.col("ingestion_timestamp").alias("fetched_at"), F.current_timestamp().alias("ingestion_timestamp"),
    )


def parse_rosters(rows: DataFrame) -> DataFrame:
    """One row per game and player, of 10 columns; spots without a player go, of repeated ones the last stays."""
    spots = rows.select(F.col("d.id").alias("game_id"), "source", F.posexplode("d.rosterSpots").alias("pos", "s")).where("s.playerId is not null and s.playerId <> 0")
    last = spots.groupBy("game_id", F.col("s.playerId").alias("player_id")).agg(F.max_by(F.struct("s", "source"), "pos").alias("x"))
    return last.select(
        "game_id", "player_id", F.col("x.s.teamId").alias("team_id"), localised(F.col("x.s.firstName")).alias("first_name"), localised(F.col("x.s.lastName")).alias("last_name"),
        F.col("x.s.positionCode").alias("position_code"), F.col("x.s.sweaterNumber").alias("sweater_number"), F.col("x.s.headshot").alias("headshot_url"), "x.source",
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def parse_plays(rows: DataFrame) -> DataFrame:
    """One row per play, of 53 columns."""
    p = lambda c: F.col(f"p.{c}")
    return rows.select(F.col("d.id").alias("game_id"), "source", F.explode("d.plays").alias("p")).select(
        "game_id", p("eventId").alias("event_id"), p("periodDescriptor.number").alias("period_number"), p("periodDescriptor.periodType").alias("period_type"),
        p("timeInPeriod").alias("time_in_period"), p("timeRemaining").alias("time_remaining"), p("typeCode").alias("type_code"), p("typeDescKey").alias("type_desc_key"),
        p("sortOrder").alias("sort_order"), p("homeTeamDefendingSide").alias("home_team_defending_side"), p("situationCode").alias("situation_code"),
        *(F.col(f"p.details.{field}").alias(name) for name, field in _DETAIL_OF.items()), p("pptReplayUrl").alias("ppt_replay_url"), "source", F.current_timestamp().alias("ingestion_timestamp"),
    )


def replaced(old: DataFrame, new: DataFrame, key: str = "game_id") -> DataFrame:
    """old with every row of the games in new swapped for theirs."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def check_layout(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, if it has these columns and no others; else an error that names what lacks or is too much."""
    lacking, strange = [c for c in columns if c not in df.columns], [c for c in df.columns if c not in columns]
    if lacking or strange:
        raise ValueError(f"the stored table has another layout: it lacks {', '.join(lacking) or 'nothing'} and has {', '.join(strange) or 'nothing'} too much; rebuild it from the documents")
    return df


def schedule_games(schedules: DataFrame) -> DataFrame:
    """Finished games in weekly schedule documents (seq, raw_json): game_id and the smallest seq it is seen in, each game once."""
    week = F.from_json("raw_json", "gameWeek array<struct<games: array<struct<id: bigint, gameState: string>>>>")
    games = schedules.select("seq", F.explode(week["gameWeek"]).alias("w")).select("seq", F.inline("w.games"))
    return games.where(F.col("gameState").isin(*FINAL_STATES)).groupBy(F.col("id").alias("game_id")).agg(F.min("seq").alias("first_seen"))


def open_games(schedule: DataFrame, now: Column, teams: list[str] | None = None) -> DataFrame:
    """Schedule rows (game_state, schedule_state, start_ts, home, away) that are live or begin between 30 minutes ago and in 35 minutes, of the teams only if given."""
    wait = F.col("start_ts").cast("long") - now.cast("long")
    rows = schedule.where(F.col("game_state").isin("PRE", "LIVE", "CRIT") | ((F.col("game_state") == "FUT") & (F.col("schedule_state") == "OK") & wait.between(-1800, 2100)))
    return rows if teams is None else rows.where(F.col("home").isin(*teams) | F.col("away").isin(*teams))


def census(documents: DataFrame) -> DataFrame:
    """Count, first and last date, and a matchup (the first in order) of each game type, with its name."""
    of = lambda p: F.get_json_object("raw_json", p)
    kind, date = of("$.gameType").try_cast("int"), of("$.gameDate")
    rows = documents.groupBy(kind.alias("game_type")).agg(
        F.count(F.lit(1)).alias("games"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.min(F.concat_ws(" @ ", of("$.awayTeam.abbrev"), of("$.homeTeam.abbrev"))).alias("sample_matchup")
    )
    names = F.create_map(*(F.lit(x) for pair in TYPE_NAMES.items() for x in pair))
    return rows.withColumn("type_name", F.coalesce(F.try_element_at(names, F.col("game_type")), F.lit("Unknown")))


def missing_years(spark: SparkSession, documents: DataFrame, first: int, last: int, gaps: tuple[int, ...] = ()) -> DataFrame:
    """Years without a game but for known gaps: one pass over the documents."""
    found = documents.select(F.substring(F.get_json_object("raw_json", "$.gameDate"), 1, 4).try_cast("int").alias("year")).distinct()
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year")).where(~F.col("year").isin(*gaps) if gaps else F.lit(True))
    return years.join(found, "year", "left_anti")
