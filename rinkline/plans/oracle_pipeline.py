"""DuckDB SQL for the queries of rinkline.queries.pipeline."""

from __future__ import annotations

from rinkline.plans import oracle
from rinkline.plans.oracle import BASE, STATS

_ALL = BASE.replace("WHERE game_type = 2)", ")")
_DATE = "cast(strftime(game_date, '%Y%m%d') AS integer) AS date_key"
#: The columns of a parsed play that the documents fill.
_PLAYS = (
    "game_id, event_id, sort_order, type_code, type_desc_key, owner AS event_owner_team_id, period_number, period_type, time_in_period, "
    "lpad(cast((1200 - (60 * cast(substr(time_in_period, 1, 2) AS int) + cast(substr(time_in_period, 4, 2) AS int))) // 60 AS varchar), 2, '0') || ':' || "
    "lpad(cast((1200 - cast(substr(time_in_period, 4, 2) AS int)) % 60 AS varchar), 2, '0') AS time_remaining, situation_code, home_side AS home_team_defending_side, x_coord, y_coord, zone_code, shot_type, "
    "scorer AS scoring_player_id, assist1 AS assist1_player_id, assist2 AS assist2_player_id, NULL AS assist3_player_id, shooter AS shooting_player_id, goalie AS goalie_in_net_id, hitter AS hitting_player_id, "
    "hittee AS hittee_player_id, blocker AS blocking_player_id, winner AS winning_player_id, loser AS losing_player_id, committed AS committed_by_player_id, drawn AS drawn_by_player_id, "
    "NULL AS served_by_player_id, player AS player_id, scorer_total AS scoring_player_total, away_score, home_score, away_sog, home_sog, penalty_type_code, penalty_desc_key, penalty_duration, stoppage_reason"
)
_MEDIA = (
    "secondary_stoppage_reason assist1_player_total assist2_player_total assist3_player_total highlight_clip highlight_clip_fr highlight_clip_sharing_url highlight_clip_sharing_url_fr "
    "discrete_clip discrete_clip_fr ppt_replay_url"
).split()


def build() -> dict[str, str]:
    out = _queries()
    season = "season, game_id, sort_order, owner AS team_id, type_desc_key FROM plays JOIN games USING (game_id)"
    out["r29_every_scorer"] = oracle.build()["q072_player_scoring_leaders"].replace(" QUALIFY rank <= 25", "")
    out["r31_points_rank"] = f"""{BASE}{STATS}, sums AS (SELECT player_id, cast(sum(goals + primary_assists + secondary_assists) AS bigint) AS points FROM skaters GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY points DESC) AS rank FROM sums"""
    out["r33_running_goals"] = f"""{BASE} SELECT season, game_id, sort_order, cast(sum(CASE WHEN type_desc_key = 'goal' THEN 1 ELSE 0 END) OVER (PARTITION BY season ORDER BY game_id, sort_order) AS bigint) AS goals FROM (SELECT {season})"""
    out["r35_runs_of_plays"] = f"""{BASE}, p AS (SELECT {season}), n AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY game_id, sort_order) - row_number() OVER (PARTITION BY season, team_id ORDER BY game_id, sort_order) AS k FROM p),
r AS (SELECT season, team_id, k, count(*) AS plays FROM n GROUP BY ALL) SELECT season, team_id, count(*) AS runs, max(plays) AS longest FROM r GROUP BY ALL"""
    return out | {f"{n}_increments": out[n] for n in ("p24_dim_player", "p25_dim_player_team", "p26_dim_team")}


def _queries() -> dict[str, str]:
    return {
        "p04_final_documents": f"{BASE} SELECT game_id AS event_id, 'game/' || game_id AS source FROM games WHERE game_state = 'OFF'",
        "p04_schedule_games": f"{BASE} SELECT game_id FROM games WHERE game_state = 'OFF'",
        "p05_first_seen": f"{BASE}, k AS (SELECT *, date_diff('day', DATE '2021-01-01', game_date) AS day FROM games) SELECT game_id, least(day // 7, (day - 1) // 7) AS first_seen FROM k WHERE game_state = 'OFF'",
        "p08_open_games": f"""{BASE}, s AS (SELECT game_id, CASE WHEN game_id % 3 = 0 THEN 'FUT' ELSE game_state END AS game_state, h.abbrev AS home, a.abbrev AS away,
    cast(game_date AS timestamp) + to_minutes(60 * (game_id % 24) + game_id % 60) AS start_ts FROM games JOIN teams h ON h.team_id = home_team_id JOIN teams a ON a.team_id = away_team_id)
SELECT game_id, game_state, home, away FROM s WHERE (game_state IN ('PRE', 'LIVE', 'CRIT') OR (game_state = 'FUT' AND game_id % 5 <> 0 AND start_ts BETWEEN TIMESTAMP '2021-10-10 11:30:00' AND TIMESTAMP '2021-10-10 12:35:00'))
    AND (home BETWEEN 'T03' AND 'T11' OR away BETWEEN 'T03' AND 'T11')""",
        "p09_changed_snapshots": f"{BASE} SELECT game_id, unnest([0, 60, 180]) AS second FROM games",
        "p10_unprocessed": f"{BASE} SELECT game_id AS event_id FROM games WHERE game_id % 4 = 0",
        "p17_casts": f"{BASE} SELECT game_id, CASE WHEN game_id % 2 = 1 THEN game_date END AS game_date, venue_name AS venue, 'Team' AS home_team_name, NULL AS start_time_utc FROM games",
        "p18_replace_plays": f"{BASE} SELECT game_id, count(*) AS plays FROM plays GROUP BY ALL",
        "p19_ledger": f"""{BASE}, n AS (SELECT game_id, count(*) AS play_count FROM plays GROUP BY ALL)
SELECT game_id AS bronze_event_id, game_id, play_count FROM n UNION ALL SELECT game_id - 1000000, game_id, NULL FROM games WHERE game_id % 10 = 0
UNION ALL SELECT game_id + 1000000, game_id + 75000000, NULL FROM games WHERE game_id % 25 = 1""",
        "p20_guard": f"{BASE} SELECT game_id AS event_id FROM games",
        "p31_overwrite_table": f"{BASE} SELECT game_id, {_DATE} FROM games",
        "r45_view": f"{BASE} SELECT type_desc_key, count(*) AS plays FROM plays GROUP BY ALL",
        "p01_append": f"""{BASE}, e AS (SELECT game_id, 'game/' || game_id AS source, game_date, game_id % 2 AS odd FROM games)
SELECT row_number() OVER (ORDER BY odd, game_date, source) AS event_id, source FROM e""",
        "p02_generated_keys": f"""{BASE}, n AS (SELECT count(*) FILTER (WHERE game_id % 2 = 0) AS even, count(*) FILTER (WHERE game_id % 2 = 1) AS odd FROM games)
SELECT 'even' AS run, 1 AS first, even AS rows FROM n UNION ALL SELECT 'all', 1 + even, odd FROM n""",
        "p11_late_documents": f"{BASE} SELECT game_id, game_state, game_date AS fetched FROM games",
        "p13_quarantine": f"""{BASE} SELECT game_id AS event_id, game_id % 20 = 4 AS malformed, CASE game_id % 20 WHEN 1 THEN 'game' WHEN 2 THEN 'team' WHEN 3 THEN 'play' END AS level,
    CASE game_id % 20 WHEN 1 THEN 'season' WHEN 2 THEN 'id' WHEN 3 THEN 'typeCode' END AS field FROM games WHERE game_id % 20 IN (1, 2, 4) OR (game_id % 20 = 3 AND game_id IN (SELECT game_id FROM plays WHERE type_code < 510))""",
        "p13_loaded_games": f"{BASE} SELECT game_id, season FROM games WHERE game_id % 20 NOT IN (1, 2, 4) AND NOT (game_id % 20 = 3 AND game_id IN (SELECT game_id FROM plays WHERE type_code < 510))",
        "p03_whole_files": f"{BASE} SELECT game_id, CASE s WHEN 0 THEN 'PRE' WHEN 180 THEN game_state ELSE 'CRIT' END AS game_state, s AS second FROM games, range(0, 240, 60) AS r(s)",
        "p09_changed_snapshots_streamed": f"{BASE} SELECT game_id, unnest([0, 60, 180]) AS second FROM games",
        "t07_live_tables": f"{BASE}, n AS (SELECT game_id, count(*) AS plays FROM plays GROUP BY ALL) SELECT game_id, game_state, CASE WHEN game_id % 5 = 0 THEN 'batch' ELSE 'live' END AS source, plays FROM games LEFT JOIN n USING (game_id)",
        "t03_chained_versions": f"""{BASE}, n AS (SELECT game_id, count(*) AS plays FROM plays GROUP BY ALL)
SELECT game_id, state AS game_state, sum(times * plays) AS versions FROM (SELECT game_id, plays, unnest(['PRE', 'CRIT', game_state]) AS state, unnest([1, 2, 1]) AS times FROM games JOIN n USING (game_id)) GROUP BY ALL""",
        "p33_missing_years": f"{BASE} SELECT y AS year FROM range(2018, 2026) AS r(y) WHERE y <> 2019 AND y NOT IN (SELECT year(game_date) FROM games)",
        "p06_new_documents": f"{BASE} SELECT game_id AS event_id, 'game/' || game_id AS source FROM games WHERE game_id % 3 <> 0",
        "p11_newest_documents": f"{BASE} SELECT game_id AS event_id, game_id, true AS newest FROM games UNION ALL SELECT game_id - 1000000, game_id, false FROM games",
        "p12_kept_games": f"{BASE} SELECT game_id AS event_id FROM games WHERE game_id % 7 <> 0",
        "p13_field_contract": f"{BASE} SELECT 'play' AS level, 'timeOfPeriod' AS field, 'unknown' AS problem, count(*) AS objects FROM plays HAVING count(*) > 0",
        "p14_parse_games": f"""{BASE} SELECT game_id, season, game_type, NULL AS limited_scoring, game_date, venue_name AS venue, NULL AS venue_location, NULL AS start_time_utc, NULL AS eastern_utc_offset, NULL AS venue_utc_offset,
    game_state, NULL AS game_schedule_state, decided_in AS last_period_type, 3 AS reg_periods, NULL AS special_event, 'game/' || game_id AS source, game_state = 'OFF' AS is_final,
    {', '.join(f"{s}_team_id, 'T' || lpad(cast({s}_team_id - 1 AS varchar), 2, '0') AS {s}_team_abbrev, 'Team' AS {s}_team_name, 'Place ' || {s}_team_id AS {s}_team_place_name, 'logo/' || year(game_date) AS {s}_team_logo, NULL AS {s}_team_dark_logo, {score} AS {s}_final_score, NULL AS {s}_final_sog" for s, score in (('home', 'hs'), ('away', 'as_')))} FROM games""",
        "p15_parse_rosters": f"{_ALL} SELECT game_id, player_id, team_id, position_code, sweater_number, 'P' || player_id AS first_name, 'L' || player_id % 97 AS last_name, NULL AS headshot_url, 'game/' || game_id AS source FROM people",
        "p16_parse_plays": f"{BASE} SELECT {_PLAYS}, {', '.join(f'NULL AS {c}' for c in _MEDIA)}, 'game/' || game_id AS source FROM plays",
        "p18_replace_games": f"{BASE} SELECT game_id, game_state, 'batch' AS source FROM games",
        "p24_dim_player": f"{_ALL} SELECT player_id, full_name, 'P' || player_id AS first_name, 'L' || player_id % 97 AS last_name, arg_max(position_code, (game_date, game_id)) AS position_code, arg_max(sweater_number, (game_date, game_id)) AS sweater_number, arg_max(team_id, (game_date, game_id)) AS team_id, min(game_date) AS first_seen_date, max(game_date) AS last_seen_date FROM people GROUP BY player_id, full_name",
        "p25_dim_player_team": f"""{_ALL}, o AS (SELECT player_id, game_date, min(team_id) AS team_id FROM people GROUP BY ALL),
m AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date) - row_number() OVER (PARTITION BY player_id, team_id ORDER BY game_date) AS k FROM o),
s AS (SELECT player_id, team_id, min(game_date) AS valid_from, max(game_date) AS valid_to, count(*) AS games_in_stint FROM m GROUP BY player_id, team_id, k)
SELECT *, valid_from = max(valid_from) OVER (PARTITION BY player_id) AS is_current FROM s""",
        "p26_dim_team": f"{BASE}, s AS (SELECT team_id, max(game_date) AS d FROM sides GROUP BY ALL) SELECT team_id, 'T' || lpad(cast(team_id - 1 AS varchar), 2, '0') AS abbrev, 'Team' AS team_name, 'Place ' || team_id AS place_name, 'logo/' || year(d) AS logo_url, NULL AS dark_logo_url FROM s",
        "p27_dim_game": f"{BASE} SELECT game_id, {_DATE}, season, game_type FROM games",
        "p28_dim_date": f"""{BASE}, d AS (SELECT cast(unnest(generate_series((SELECT min(game_date) FROM games), (SELECT max(game_date) FROM games), INTERVAL 1 DAY)) AS date) AS full_date)
SELECT cast(strftime(full_date, '%Y%m%d') AS integer) AS date_key, full_date, year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month, strftime(full_date, '%B') AS month_name,
weekofyear(full_date) AS week_of_year, day(full_date) AS day, dayofweek(full_date) + 1 AS day_of_week, strftime(full_date, '%A') AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend FROM d""",
        "p29_fact_event": f"{BASE} SELECT {_PLAYS}, {_DATE}, game_state = 'OFF' AS is_final, 'game/' || game_id AS source, NULL AS secondary_stoppage_reason, NULL AS assist1_player_total, NULL AS assist2_player_total, NULL AS assist3_player_total FROM plays JOIN games g USING (game_id)",
        "p30_dim_event_type": f"{BASE} SELECT DISTINCT type_code, type_desc_key FROM plays",
        "p32_census": f"{BASE}, m AS (SELECT *, 'T' || lpad(cast(away_team_id - 1 AS varchar), 2, '0') || ' @ T' || lpad(cast(home_team_id - 1 AS varchar), 2, '0') AS m FROM games) SELECT game_type, ['Preseason', 'Regular season', 'Playoffs'][game_type] AS type_name, count(*) AS games, cast(min(game_date) AS varchar) AS first_date, cast(max(game_date) AS varchar) AS last_date, min(m) AS sample_matchup FROM m GROUP BY ALL",
    }
