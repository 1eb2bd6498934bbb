"""DuckDB SQL for the registered queries.

Measures, ratios, lists and minimums come from rinkline.plans.definitions; of
the library only the rules are used by which plays are made from the tables.
"""

from __future__ import annotations

from rinkline.plans import definitions as d
from rinkline.sources.derived import RULES

_PLAYER = "cast(8470000 + (case when {s} = 0 then ({team} - 1 + (g // 25) % 2) % 25 else {team} - 1 end) * 20 + {s} as bigint)"


def _who(team: str, slot: str) -> str:
    return _PLAYER.format(team=team, s=slot)


_SHOT = "('goal', 'shot-on-goal', 'missed-shot')"
_STRENGTH = """case when substr(code, 1, 1) = '0' then 'EN' when substr(code, 3, 1) > substr(code, 2, 1) and substr(code, 4, 1) = '1' then 'PP'
    when substr(code, 3, 1) < substr(code, 2, 1) then 'SH' else 'EV' end"""

BASE = f"""
WITH raw AS (SELECT event_id // 100 AS g, event_id % 100 AS i, user_id AS u, cast(json_extract_string(props, '$.k') AS bigint) AS k,
        cast(round(value * 100) AS bigint) AS v FROM events),
teams AS (SELECT n_nationkey + 1 AS team_id, 'T' || lpad(cast(n_nationkey AS varchar), 2, '0') AS abbrev FROM nation),
ruled AS (SELECT *, {', '.join(f'{sql} AS {n}' for n, sql in RULES.items())} FROM raw),
sided AS (SELECT *, u % 2 = 0 AS at_home, CASE WHEN u % 2 = 0 THEN home_team_id ELSE away_team_id END AS own,
        CASE WHEN u % 2 = 0 THEN away_team_id ELSE home_team_id END AS oth,
        CASE WHEN u % 2 = 0 THEN substr(situation_code, 1, 1) ELSE substr(situation_code, 4, 1) END AS net FROM ruled),
plays AS (
    SELECT 2024020000 + g AS game_id, i AS event_id, i AS sort_order, type_desc_key, period_number, period_type, zone_code, situation_code, home_team_id, away_team_id, x_coord, y_coord,
        lpad(cast(seconds // 60 AS varchar), 2, '0') || ':' || lpad(cast(seconds % 60 AS varchar), 2, '0') AS time_in_period,
        CASE WHEN type_desc_key <> 'stoppage' THEN own END AS owner, type_desc_key <> 'stoppage' AND at_home AS owner_is_home,
        CASE WHEN type_desc_key <> 'stoppage' AND at_home THEN situation_code ELSE reverse(situation_code) END AS code,
        sqrt((89 - abs(x_coord)) * (89 - abs(x_coord)) + y_coord * y_coord) AS feet,
        CASE WHEN type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot') THEN shot_type END AS shot_type,
        CASE WHEN type_desc_key = 'goal' THEN {_who('own', 'a')} END AS scorer,
        CASE WHEN type_desc_key = 'goal' AND v % 10 <> 0 THEN {_who('own', 'b')} END AS assist1,
        CASE WHEN type_desc_key = 'goal' AND v % 10 >= 4 THEN {_who('own', 'c')} END AS assist2,
        CASE WHEN type_desc_key IN ('shot-on-goal', 'missed-shot', 'blocked-shot') THEN {_who('own', 'a')} END AS shooter,
        CASE WHEN type_desc_key IN {_SHOT} AND net IS DISTINCT FROM '0' THEN
            {_who('oth', '(CASE WHEN period_number >= 3 AND g % 5 = 0 THEN 19 ELSE 18 END)')} END AS goalie,
        CASE WHEN type_desc_key = 'blocked-shot' THEN {_who('oth', 'o')} END AS blocker,
        CASE WHEN type_desc_key = 'blocked-shot' THEN oth END AS blocker_team_id,
        CASE WHEN type_desc_key = 'hit' THEN {_who('own', 'a')} END AS hitter, CASE WHEN type_desc_key = 'hit' THEN {_who('oth', 'o')} END AS hittee,
        CASE WHEN type_desc_key = 'faceoff' THEN {_who('own', 'a')} END AS winner, CASE WHEN type_desc_key = 'faceoff' THEN {_who('oth', 'o')} END AS loser,
        CASE WHEN type_desc_key = 'penalty' THEN {_who('own', 'a')} END AS committed,
        CASE WHEN type_desc_key = 'penalty' AND v % 5 <> 2 THEN {_who('oth', 'o')} END AS drawn,
        CASE WHEN type_desc_key IN ('takeaway', 'giveaway') THEN {_who('own', 'a')} END AS player,
        CASE WHEN type_desc_key = 'penalty' THEN penalty_type_code END AS penalty_type_code,
        CASE WHEN type_desc_key = 'penalty' THEN penalty_desc_key END AS penalty_desc_key,
        CASE WHEN type_desc_key = 'penalty' THEN penalty_duration END AS penalty_duration, cast(type_code AS integer) AS type_code, stoppage_reason,
        CASE WHEN g % 7 = 0 THEN NULL WHEN (period_number + g) % 2 = 0 THEN 'left' ELSE 'right' END AS home_side,
        CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' THEN cast(sum(CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' AND NOT at_home THEN 1 ELSE 0 END) OVER game AS integer) END AS away_score,
        CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' THEN cast(sum(CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' AND at_home THEN 1 ELSE 0 END) OVER game AS integer) END AS home_score,
        CASE WHEN type_desc_key = 'shot-on-goal' AND period_type <> 'SO' THEN cast(sum(CASE WHEN type_desc_key IN ('goal', 'shot-on-goal') AND period_type <> 'SO' AND NOT at_home THEN 1 ELSE 0 END) OVER game AS integer) END AS away_sog,
        CASE WHEN type_desc_key = 'shot-on-goal' AND period_type <> 'SO' THEN cast(sum(CASE WHEN type_desc_key IN ('goal', 'shot-on-goal') AND period_type <> 'SO' AND at_home THEN 1 ELSE 0 END) OVER game AS integer) END AS home_sog,
        CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' THEN cast(sum(CASE WHEN type_desc_key = 'goal' AND period_type <> 'SO' THEN 1 ELSE 0 END)
            OVER (PARTITION BY season, {_who('own', 'a')} ORDER BY g, i) AS integer) END AS scorer_total
    FROM sided WINDOW game AS (PARTITION BY g ORDER BY i)),
strong AS (SELECT *, {_STRENGTH} AS strength FROM plays WHERE period_type <> 'SO'),
scores AS (SELECT g, count(*) FILTER (WHERE type_desc_key = 'goal' AND period_type <> 'SO' AND at_home) AS h,
        count(*) FILTER (WHERE type_desc_key = 'goal' AND period_type <> 'SO' AND NOT at_home) AS a FROM sided GROUP BY g),
games AS (SELECT 2024020000 + g AS game_id, g, {RULES['season']} AS season, {RULES['game_type']} AS game_type, {RULES['game_state']} AS game_state,
        {RULES['home_team_id']} AS home_team_id, {RULES['away_team_id']} AS away_team_id,
        cast(make_date(2021 + g // 200, 10, 1) + cast(g % 200 AS integer) AS date) AS game_date,
        h + CASE WHEN h = a AND g % 2 = 0 THEN 1 ELSE 0 END AS hs, a + CASE WHEN h = a AND g % 2 = 1 THEN 1 ELSE 0 END AS as_,
        CASE WHEN h = a THEN 'SO' WHEN g % 4 = 0 THEN 'OT' ELSE 'REG' END AS decided_in, 'Arena ' || {RULES['home_team_id']} AS venue_name FROM scores),
sides AS (SELECT *, home_team_id AS team_id, away_team_id AS opponent_id, true AS is_home, hs AS score_for, as_ AS score_against FROM games
    UNION ALL SELECT *, away_team_id, home_team_id, false, as_, hs FROM games),
played AS (SELECT s.*, t.abbrev AS team, o.abbrev AS opponent, CASE WHEN is_home THEN 'Home' ELSE 'Away' END AS venue,
        CASE WHEN score_for > score_against THEN 'W' WHEN game_type = 2 AND decided_in IN ('OT', 'SO') THEN 'OTL' ELSE 'L' END AS result,
        dayofweek(game_date) + 1 AS day_num, strftime(game_date, '%A') AS day_name, strftime(game_date, '%Y-%m') AS month
    FROM sides s JOIN teams t USING (team_id) JOIN teams o ON o.team_id = s.opponent_id WHERE game_type = 2),
dressed AS (SELECT p.*, {_who('team_id', 's')} AS player_id, s + 1 AS sweater_number,
        CASE WHEN s < 4 OR (s = 4 AND g % 2 = 0) THEN 'C' WHEN s < 9 THEN 'L' WHEN s < 13 THEN 'R' WHEN s < 18 THEN 'D' ELSE 'G' END AS position_code
    FROM played p, range(20) AS r(s)),
people AS (SELECT *, 'P' || player_id || ' L' || player_id % 97 AS full_name,
        CASE position_code WHEN 'C' THEN 'Centers' WHEN 'L' THEN 'Left wings' WHEN 'R' THEN 'Right wings' ELSE 'Defense' END AS position_group,
        CASE WHEN position_code = 'D' THEN 'Defense' ELSE 'Forwards' END AS forward_or_defense,
        CASE WHEN team = 'T05' THEN 'Team' ELSE 'Rest of league' END AS scope FROM dressed)"""

_ROLES = ("scorer", "assist1", "assist2", "shooter", "blocker", "hitter", "hittee", "winner", "loser", "committed", "drawn", "player")


_KEPT = "game_id, type_desc_key, period_number, period_type, time_in_period, strength, penalty_desc_key, penalty_duration"
STATS = f""",
acts AS ({' UNION ALL '.join(f"SELECT {_KEPT}, {r} AS player_id, '{r}' AS role FROM strong WHERE {r} IS NOT NULL" for r in _ROLES)}),
stats AS (SELECT game_id, player_id, {', '.join(f'count(*) FILTER (WHERE {c}) AS {n}' for n, c in d.PARTS.items())},
        coalesce(sum(penalty_duration) FILTER (WHERE type_desc_key = 'penalty' AND role = 'committed'), 0) AS pim FROM acts GROUP BY ALL),
skaters AS (SELECT p.*, {', '.join(f'coalesce({n}, 0) AS {n}' for n in [*d.PARTS, 'pim'])} FROM people p LEFT JOIN stats USING (game_id, player_id) WHERE position_code <> 'G')"""

TEAM = f""",
seen AS (SELECT s.*, unnest([home_team_id, away_team_id]) AS team_id FROM strong s),
faced AS (SELECT *, CASE WHEN owner = team_id THEN 'for' ELSE 'against' END AS side FROM seen),
team_stats AS (SELECT game_id, team_id, {', '.join(f'count(*) FILTER (WHERE {c}) AS {n}' for n, c in d.SEEN.items())},
        coalesce(sum(penalty_duration) FILTER (WHERE side = 'for'), 0) AS pim, coalesce(sum(penalty_duration) FILTER (WHERE side = 'against'), 0) AS opp_pim
    FROM faced GROUP BY ALL),
team_rows AS (SELECT p.*, t.* EXCLUDE (game_id, team_id), CASE WHEN team = 'T05' THEN 'Team' ELSE 'Rest of league' END AS scope,
        CASE abs(score_for - score_against) WHEN 1 THEN '1) One goal' WHEN 2 THEN '2) Two goals' ELSE '3) Three or more' END AS margin,
        CASE WHEN sf > sa THEN '1) More shots' WHEN sf = sa THEN '2) Equal shots' ELSE '3) Fewer shots' END AS shots_vs_opponent,
        CASE WHEN hits_for > hits_against THEN '1) More hits' WHEN hits_for = hits_against THEN '2) Equal hits' ELSE '3) Fewer hits' END AS hits_vs_opponent,
        CASE WHEN cf > ca THEN '1) More attempts' WHEN cf = ca THEN '2) Equal attempts' ELSE '3) Fewer attempts' END AS attempts_vs_opponent
    FROM played p JOIN team_stats t USING (game_id, team_id) WHERE game_state = 'OFF')"""

_BUCKET = "CASE WHEN feet < 15 THEN '1) 0-14 ft' WHEN feet < 30 THEN '2) 15-29 ft' WHEN feet < 45 THEN '3) 30-44 ft' ELSE '4) 45+ ft' END"
_PERIOD = "CASE WHEN period_type IN ('OT', 'SO') THEN period_type ELSE cast(period_number AS varchar) END"


def _cols(names: str, derived: dict[str, str]) -> str:
    return ", ".join(f"{derived.get(n, n)} AS {n}" for n in names.split())


#: BASE with the games of all types and with the shootout's plays.
EVERY = BASE.replace("WHERE game_type = 2)", ")").replace("FROM plays WHERE period_type <> 'SO')", "FROM plays)")
NAME = "'P' || player_id || ' L' || player_id % 97 AS full_name"


def _sums(keys: str, positions: str = "") -> str:
    where = f"WHERE position_code IN ({positions})" if positions else ""
    return f""",
sums AS (SELECT {keys}, count(*) AS games_played, count(DISTINCT player_id) AS players, arg_max(position_code, (game_date, game_id)) AS position,
        {', '.join(f'cast(sum({n}) AS bigint) AS {n}' for n in [*d.PARTS, 'pim'])} FROM skaters {where} GROUP BY {keys})"""


def _cut(least: list[str]) -> str:
    """Conditions from names and values in turn."""
    return " AND ".join(["true", *(f"{d.PLAYER.get(n, n)} >= {v}" for n, v in zip(least[::2], least[1::2]))])


def _falling(order: str) -> str:
    return ", ".join([*(f"{d.PLAYER.get(n, n)} DESC NULLS LAST" for n in order.split()), "player_id"])


def _board(columns: str, order: str, cut: str, positions: str) -> str:
    return f"""{BASE}{STATS}{_sums('full_name, player_id', positions)}
SELECT full_name, position, games_played, player_id, {_cols(columns, d.PLAYER)}, row_number() OVER (ORDER BY {_falling(order)}) AS rank FROM sums WHERE {cut} QUALIFY rank <= 25"""


def _all_time(columns: str, order: str, cut: str) -> str:
    return f"""{EVERY}{STATS}, sums AS (SELECT player_id, {', '.join(f'cast(sum({m}) AS bigint) AS {m}' for m in [*d.PARTS, 'pim'])} FROM stats GROUP BY player_id),
newest AS (SELECT player_id, full_name, arg_max(position_code, (game_date, game_id)) AS position FROM people GROUP BY ALL),
ranked AS (SELECT player_id, {_cols(columns, d.PLAYER)}, row_number() OVER (ORDER BY {_falling(order)}) AS rank FROM sums WHERE {cut} QUALIFY rank <= 25)
SELECT ranked.*, full_name, position FROM ranked LEFT JOIN newest USING (player_id)"""


def _parts(line: str) -> list[str]:
    return [x.strip() for x in line.split("/")]


#: The filtered questions: team, season, kind of game, opponent, player, positions; `-` is any.
FILTERED = """
q044_player_full_stat_line T03 20212022 2 - - C,L,R / q072_player_scoring_leaders - 20212022 3 - - - / q047_player_goal_leaders T07 - 2 - - - / q052_player_head_to_head_comparison - 20212022 2 - - -
q045_player_game_log - - 2 - P8470041_L1 - / q056_player_home_and_away_splits T03 - 2 - P8470061_L21 - / q089_player_stats_vs_each_opponent T04 20212022 2 - - - / q122_team_head_to_head T03 - 2 T04 - -
q012_goalie_game_log T03 - 2 - - - / q017_goalie_save_pct_vs_opponent T05 20212022 2 - - - / q076_player_shooting_pct_by_distance T03 20212022 2 - - - / q050_player_goals_by_shot_type - - 2 - P8470041_L1 -
"""


def _filtered(sql: str, line: str) -> str:
    """A question's SQL over the games of a team, season, kind and opponent, and over a player or positions."""
    _, team, season, kind, opponent, player, positions = line.split()
    games = [f"game_type = {kind}", *(f"{c} = '{v}'" for c, v in (("team", team), ("season", season), ("opponent", opponent)) if v != "-")]
    people = [*([f"full_name = '{player.replace('_', ' ')}'"] if player != "-" else []), *([f"position_code IN ('{positions.replace(',', chr(39) + ', ' + chr(39))}')"] if positions != "-" else [])]
    sql = sql.replace("WHERE game_type = 2)", f"WHERE {' AND '.join(games)})")
    return sql.replace("AS scope FROM dressed)", f"AS scope FROM dressed WHERE {' AND '.join(people) or 'true'})")


def build() -> dict[str, str]:
    out = _questions()
    given = {line.split()[0]: line for line in FILTERED.replace("\n", " / ").split(" / ") if line.strip()}
    for n in [*d.GROUPS, *d.TEAMS, *given]:
        if "scope" in (d.GROUPS | d.TEAMS).get(n, "/").split("/")[0].split():
            sql = out[n].replace("WHEN team = 'T05'", "WHEN team = 'T03'").replace("WHERE game_type = 2)", "WHERE game_type = 2 AND season = 20212022)")
        else:
            sql = _filtered(out[n], given.get(n, f"{n} T03 20212022 2 - - -"))
        out[f"{n}_filtered"] = sql
    return out


def _questions() -> dict[str, str]:
    out = {}
    for n, line in d.BOARDS.items():
        columns, order, least, positions = _parts(line)
        out[n] = _board(columns, order, _cut(["games_played", "1", *least.split()]), positions)
        if n in d.USUAL:
            games, *usual = d.USUAL[n].split()
            out[f"{n}_usual"] = _board(columns, order, _cut(["games_played", games, *usual]), positions)
    each = d.BOARDS["q044_player_full_stat_line"].split("/")[0].replace("points_per_game", "points_per_game pp_points")
    out["q052_player_head_to_head_comparison"] = (
        f"{BASE}{STATS}{_sums('full_name, player_id')} SELECT full_name, position, games_played, player_id, {_cols(each, d.PLAYER)} FROM sums WHERE full_name IN ('P8470041 L1', 'P8470043 L3')"
    )
    for n, line in d.ALL_TIME.items():
        columns, order, least = _parts(line)
        name, *values = least.split() or [""]
        for value, end in zip(values or [""], ("", "_usual")):
            out[n + end] = _all_time(columns, order, _cut([name, value] if name else []))
    out["n13_goals_by_period_and_type"] = f"{BASE} SELECT period_number, period_type, count(*) AS goals FROM plays WHERE type_desc_key = 'goal' GROUP BY ALL"
    for n, line in d.SPLITS.items():
        keys, columns = _parts(line)
        keys = ", ".join(["full_name", "player_id", *keys.split()])
        out[n] = f"{BASE}{STATS}{_sums(keys)} SELECT {keys}, games_played, {_cols(columns, d.PLAYER)} FROM sums"
    for n, line in d.GROUPS.items():
        keys, columns = _parts(line)
        keys = ", ".join(keys.split())
        out[n] = f"{BASE}{STATS}{_sums(keys)} SELECT {keys}, players, games_played, {_cols(columns, d.PLAYER)} FROM sums"
    for n, line in d.TEAMS.items():
        keys, columns = _parts(line)
        keys = ", ".join(keys.split())
        out[n] = f"""{BASE}{TEAM},
sums AS (SELECT {keys}, count(*) AS games, count(*) FILTER (WHERE result = 'W') AS wins, count(*) FILTER (WHERE result = 'L') AS losses, count(*) FILTER (WHERE result = 'OTL') AS ot_losses,
        {', '.join(f'cast(sum({m}) AS bigint) AS {m}' for m in [*d.SEEN, 'pim', 'opp_pim'])} FROM team_rows GROUP BY {keys})
SELECT {keys}, {_cols(columns, d.TEAM)} FROM sums"""
    for n, line in d.SHOTS.items():
        what, keys, condition = _parts(line)
        keys = ", ".join(keys.split())
        shots = f"""{BASE},
shots AS (SELECT game_id, type_desc_key = 'goal' AS is_goal, type_desc_key IN ('goal', 'shot-on-goal') AS on_net, type_desc_key = 'blocked-shot' AS blocked, {_BUCKET} AS distance, {_PERIOD} AS period,
        strength, zone_code, shot_type, CASE strength WHEN 'PP' THEN 'Penalty kill' WHEN 'SH' THEN 'Team on power play' ELSE 'Even strength' END AS situation,
        {'goalie' if what == 'goalie' else 'coalesce(scorer, shooter)'} AS player_id FROM strong WHERE type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot')),
rows AS (SELECT s.*, full_name, game_date, opponent, result FROM shots s JOIN people USING (game_id, player_id)
    WHERE position_code {'=' if what == 'goalie' else '<>'} 'G' AND {'on_net' if what == 'goalie' else 'true'} AND {condition}),"""
        counts = f"SELECT {keys}, count(*) AS shot_attempts, count(*) FILTER (WHERE on_net) AS shots, count(*) FILTER (WHERE is_goal) AS goals FROM rows GROUP BY {keys}"
        if what == "goalie":
            out[n] = f"""{shots}
sums AS (SELECT {keys}, count(DISTINCT game_id) AS games, count(*) AS shots_faced, count(*) FILTER (WHERE is_goal) AS goals_against FROM rows GROUP BY {keys})
SELECT *, shots_faced - goals_against AS saves, {d.per('shots_faced - goals_against', 'shots_faced', 3)} AS save_pct FROM sums"""
        elif what == "accuracy":
            out[n] = f"{shots} sums AS ({counts}) SELECT {keys}, shot_attempts AS unblocked_attempts, shots AS shots_on_net, {d.pct('shots', 'shot_attempts')} AS on_net_pct, goals FROM sums"
        else:
            part = "PARTITION BY player_id" if "player_id" in keys else ""
            out[n] = f"""{shots}
sums AS ({counts}),
wide AS (SELECT *, cast(sum(goals) OVER ({part}) AS bigint) AS all_goals, cast(sum(shots) OVER ({part}) AS bigint) AS all_shots FROM sums)
SELECT {keys}, shot_attempts, shots, goals, {d.pct('goals', 'shots')} AS shooting_pct, {d.pct('shots', 'shot_attempts')} AS shots_on_net_pct,
    {d.pct('goals', 'all_goals')} AS share_of_goals_pct, {d.pct('shots', 'all_shots')} AS share_of_shots_pct FROM wide"""
    return out
