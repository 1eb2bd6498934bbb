"""DuckDB SQL for the queries of rinkline.queries.special."""

from __future__ import annotations

from rinkline.plans import definitions as d
from rinkline.plans.definitions import pct as share
from rinkline.plans.definitions import per
from rinkline.plans.oracle import _BUCKET, _PERIOD, BASE, EVERY, NAME, STATS, TEAM, _cols, _sums

_W = "count(*) FILTER (WHERE result = '{}') AS {}"
_WLO = ", ".join(_W.format(r, n) for r, n in (("W", "wins"), ("L", "losses"), ("OTL", "ot_losses")))
_ON = "type_desc_key IN ('goal', 'shot-on-goal')"
_ANY = "type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot')"

#: Names of everyone in a game, all game types; the queries over whole seasons use `people`.
_ALL = (
    BASE.replace("WHERE game_type = 2)", ")")
    + f""",
names AS (SELECT game_id, player_id, full_name AS nm, team AS tm FROM people),
owned AS (SELECT p.*, t.abbrev AS team, {_PERIOD} AS period, CASE WHEN substr(code, 1, 1) = '0' THEN 'EN' WHEN substr(code, 3, 1) > substr(code, 2, 1) AND substr(code, 4, 1) = '1' THEN 'PP'
    WHEN substr(code, 3, 1) < substr(code, 2, 1) THEN 'SH' ELSE 'EV' END AS strength FROM plays p LEFT JOIN teams t ON t.team_id = p.owner)"""
)
_FINAL = ", final AS (SELECT * FROM played WHERE game_state = 'OFF')"
_TG = BASE + _FINAL + f""",
seen AS (SELECT s.*, unnest([home_team_id, away_team_id]) AS team_id FROM strong s),
faced AS (SELECT s.*, CASE WHEN owner = s.team_id THEN 'for' ELSE 'against' END AS side, {_BUCKET} AS distance, {_PERIOD} AS period, f.team, f.result FROM seen s JOIN final f USING (game_id, team_id))"""
_SIDED = ", ".join(f"count(*) FILTER (WHERE {c} AND side = '{s}') AS {n}_{s}" for n, c in (("goals", "type_desc_key = 'goal'"), ("shots", _ON)) for s in ("for", "against"))
_SKATER = BASE + STATS + ", per AS (SELECT *, primary_assists + secondary_assists AS assists, goals + primary_assists + secondary_assists AS points FROM skaters)"
_TOP = "QUALIFY rank <= 25"


def _rank(by: str) -> str:
    return f"row_number() OVER (ORDER BY {by}) AS rank"


def _goalies(least: int) -> str:
    return f"""{BASE}, rows AS (SELECT s.game_id, goalie AS player_id, type_desc_key = 'goal' AS is_goal, full_name FROM strong s JOIN people p ON p.game_id = s.game_id AND p.player_id = s.goalie WHERE {_ON}),
sums AS (SELECT full_name, player_id, count(DISTINCT game_id) AS games_in_net, count(*) AS shots_faced, count(*) FILTER (WHERE is_goal) AS goals_against FROM rows GROUP BY ALL HAVING count(*) >= {least})
SELECT *, shots_faced - goals_against AS saves, {per('shots_faced - goals_against', 'shots_faced', 3)} AS save_pct, {per('shots_faced', 'games_in_net', 1)} AS shots_per_game,
{_rank('1e0 * (shots_faced - goals_against) / shots_faced DESC, player_id')} FROM sums {_TOP}"""


def _strong_games(least: int) -> str:
    return f"""{BASE}, g AS (SELECT p.player_id, full_name, s.game_id, count(*) AS n, count(*) FILTER (WHERE type_desc_key = 'goal') AS g FROM strong s JOIN people p ON p.game_id = s.game_id AND p.player_id = s.goalie WHERE {_ON} GROUP BY ALL HAVING count(*) >= {least}),
s AS (SELECT player_id, full_name, count(*) AS games, count(*) FILTER (WHERE 1000 * (n - g) >= 900 * n) AS games_900_plus, count(*) FILTER (WHERE 1000 * (n - g) >= 920 * n) AS games_920_plus FROM g GROUP BY ALL)
SELECT *, {share('games_900_plus', 'games')} AS pct_games_900_plus FROM s"""


def _fire(least: int) -> str:
    return f"""{EVERY}, s AS (SELECT goalie AS player_id, count(*) AS shots_faced, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals_allowed FROM plays WHERE {_ON} AND goalie IS NOT NULL GROUP BY ALL HAVING count(*) >= {least})
SELECT *, floor(100e0 * (shots_faced - goals_allowed) * 100 / nullif(shots_faced, 0) + 0.5) / 100e0 AS save_pct, {NAME}, {_rank('1e0 * (shots_faced - goals_allowed) / shots_faced DESC, player_id')} FROM s {_TOP}"""


def _distance() -> str:
    """Shots from the offensive zone of skaters, with the distance in hundredths of feet."""
    return f"""{BASE}, shots AS (SELECT full_name, p.player_id, type_desc_key = 'goal' AS is_goal, {_ON} AS on_net, feet, floor(feet * 100 + 0.5) AS hundredths
    FROM strong s JOIN people p ON p.game_id = s.game_id AND p.player_id = coalesce(s.scorer, s.shooter) WHERE {_ANY} AND position_code <> 'G' AND zone_code = 'O')"""


def _streak(what: str) -> str:
    return f"""{_SKATER}, runs AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date, game_id) - row_number() OVER (PARTITION BY player_id, {what} > 0 ORDER BY game_date, game_id) AS run FROM per),
sums AS (SELECT player_id, full_name, count(*) AS games, cast(sum(goals) AS bigint) AS goals, cast(sum(assists) AS bigint) AS assists, cast(sum(points) AS bigint) AS points, min(game_date) AS streak_start, max(game_date) AS streak_end
    FROM runs WHERE {what} > 0 GROUP BY player_id, full_name, run)
SELECT *, {_rank(f'games DESC, {what} DESC, streak_start, player_id')} FROM sums {_TOP}"""


def _lookup(roles: dict[str, str]) -> tuple[str, str]:
    joins = " ".join(f"LEFT JOIN names n{i} ON n{i}.game_id = o.game_id AND n{i}.player_id = o.{c}" for i, c in enumerate(roles.values()))
    return joins, ", ".join(f"n{i}.nm AS {n}" for i, n in enumerate(roles))


def build() -> dict[str, str]:
    pen, pen_cols = _lookup({"committed_by": "committed", "drawn_by": "drawn"})
    goal, goal_cols = _lookup({"scorer": "scorer", "assist_1": "assist1", "assist_2": "assist2", "goalie": "goalie"})
    shot, shot_cols = _lookup({"shooter": "by", "goalie": "goalie", "blocked_by": "blocker"})
    play, _ = _lookup({k: k for k in ("scorer", "assist1", "assist2", "shooter", "goalie", "blocker", "hitter", "hittee", "winner", "loser", "committed", "drawn", "player")})
    open_rows = TEAM.replace("USING (game_id, team_id) WHERE game_state = 'OFF')", "USING (game_id, team_id))")
    out = {
        "q001_game_box_score": f"{_ALL}{open_rows} SELECT game_id, team, venue, score_for AS score, CASE WHEN game_state <> 'OFF' THEN 'In progress' ELSE result END AS result, decided_in, sf AS shots, cf AS attempts, {_cols('attempt_share_pct shooting_pct pp_goals minors_drawn shorthanded_goals_for pim hits blocks takeaways giveaways faceoff_wins faceoff_pct', d.TEAM)} FROM team_rows",
        "q004_game_goalie_stats": f"""{_ALL}, s AS (SELECT s.game_id, p.team, full_name, count(*) AS shots_faced, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals_against,
    {', '.join(f"count(*) FILTER (WHERE strength = '{x}') AS {n}_shots, count(*) FILTER (WHERE strength = '{x}' AND type_desc_key = 'goal') AS {n}_goals" for x, n in (('EV', 'ev'), ('PP', 'pk'), ('SH', 'sh')))}
    FROM strong s JOIN people p ON p.game_id = s.game_id AND p.player_id = s.goalie WHERE {_ON} AND position_code = 'G' GROUP BY s.game_id, p.team, full_name)
SELECT *, shots_faced - goals_against AS saves, {per('shots_faced - goals_against', 'shots_faced', 3)} AS save_pct FROM s""",
        "q007_game_play_by_play": f"""{_ALL} SELECT o.game_id, event_id, period, time_in_period AS time, type_desc_key AS event, team, CASE type_desc_key
    WHEN 'goal' THEN concat_ws(' ', n0.nm, '(' || nullif(concat_ws(', ', n1.nm, n2.nm), '') || ')', shot_type)
    WHEN 'shot-on-goal' THEN concat_ws(' ', n3.nm, shot_type, 'saved by', n4.nm) WHEN 'missed-shot' THEN concat_ws(' ', n3.nm, shot_type, 'missed')
    WHEN 'blocked-shot' THEN concat_ws(' ', n3.nm, 'blocked by', n5.nm) WHEN 'hit' THEN concat_ws(' ', n6.nm, 'hit', n7.nm) WHEN 'faceoff' THEN concat_ws(' ', n8.nm, 'won vs', n9.nm)
    WHEN 'penalty' THEN concat_ws(' ', n10.nm, penalty_desc_key, penalty_duration || ' min', 'drawn by', n11.nm) WHEN 'takeaway' THEN n12.nm WHEN 'giveaway' THEN n12.nm ELSE stoppage_reason END AS description,
    strength, zone_code AS zone, away_score, home_score, away_sog, home_sog FROM owned o {play}""",
        "q009_game_shot_log": f"""{_ALL}, w AS (SELECT *, coalesce(scorer, shooter) AS by, coalesce(owner_is_home = (home_side = 'left'), x_coord >= 0) AS rightward FROM owned WHERE {_ANY} AND period_type <> 'SO')
SELECT o.game_id, event_id, period, time_in_period AS time, team, {shot_cols}, CASE type_desc_key WHEN 'goal' THEN 'Goal' WHEN 'shot-on-goal' THEN 'Saved' WHEN 'missed-shot' THEN 'Missed' ELSE 'Blocked' END AS result,
    shot_type, strength, floor(feet + 0.5) AS distance_ft, CASE WHEN rightward THEN x_coord ELSE -x_coord END AS x_ft, CASE WHEN rightward THEN y_coord ELSE -y_coord END AS y_ft FROM w o {shot}""",
        "q011_game_skater_stats": f"{_ALL}{STATS} SELECT game_id, team, sweater_number, full_name, position_code AS position, {_cols('goals assists points shots hits blocked_shots takeaways giveaways pim faceoff_wins faceoff_losses', d.PLAYER)} FROM skaters",
        "q035_player_average_shot_distance": f"""{_distance()}, s AS (SELECT full_name, player_id, count(*) FILTER (WHERE on_net) AS shots, count(*) FILTER (WHERE is_goal) AS goals, sum(hundredths) FILTER (WHERE on_net) AS s, count(hundredths) FILTER (WHERE on_net) AS n,
    sum(hundredths) FILTER (WHERE is_goal) AS gs, count(hundredths) FILTER (WHERE is_goal) AS gn FROM shots GROUP BY ALL HAVING count(*) FILTER (WHERE on_net) >= 2),
r AS (SELECT full_name, player_id, shots, goals, {share('goals', 'shots')} AS shooting_pct, {per('s / 100e0', 'n', 1)} AS avg_shot_distance_ft, {per('gs / 100e0', 'gn', 1)} AS avg_goal_distance_ft FROM s)
SELECT *, {_rank('avg_shot_distance_ft NULLS LAST, player_id')} FROM r {_TOP}""",
        "q037_player_close_range_shooting": f"""{_distance()}, s AS (SELECT full_name, player_id, count(*) FILTER (WHERE on_net AND feet < 20) AS close_shots, count(*) FILTER (WHERE is_goal AND feet < 20) AS close_goals, count(*) FILTER (WHERE on_net) AS shots FROM shots GROUP BY ALL)
SELECT full_name, player_id, close_shots, close_goals, {share('close_goals', 'close_shots')} AS close_shooting_pct, {share('close_shots', 'shots')} AS share_of_shots_close_pct, {_rank('close_goals DESC, close_shots DESC, player_id')} FROM s {_TOP}""",
        "q048_player_goals_against_each_goalie": f"""{BASE}, s AS (SELECT p.player_id, k.full_name AS goalie, count(*) AS shots, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals FROM strong s
    JOIN people p ON p.game_id = s.game_id AND p.player_id = coalesce(s.scorer, s.shooter) JOIN people k ON k.game_id = s.game_id AND k.player_id = s.goalie WHERE {_ON} AND p.position_code <> 'G' GROUP BY ALL)
SELECT *, {share('goals', 'shots')} AS shooting_pct FROM s""",
        "n04_shot_type_conversion": f"{BASE}, s AS (SELECT shot_type, count(*) AS shots, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals FROM plays WHERE {_ON} AND shot_type IS NOT NULL GROUP BY ALL) SELECT *, {share('goals', 'shots')} AS conversion_pct FROM s",
        "n10_goalies_under_fire": _fire(5),
        "n10_goalies_under_fire_usual": _fire(1000),
        "n11_home_ice_advantage": f"{BASE}, s AS (SELECT team, count(*) FILTER (WHERE is_home) AS h, count(*) FILTER (WHERE is_home AND score_for > score_against) AS hw, count(*) FILTER (WHERE NOT is_home) AS a, count(*) FILTER (WHERE NOT is_home AND score_for > score_against) AS aw FROM played GROUP BY team) SELECT team, {share('hw', 'h')} AS home_win_pct, {share('aw', 'a')} AS away_win_pct FROM s",
        "n12_highest_scoring_games": f"{BASE} SELECT game_id, game_date, h.abbrev AS home, hs AS home_final_score, a.abbrev AS away, as_ AS away_final_score, hs + as_ AS total_goals, decided_in AS last_period_type, {_rank('hs + as_ DESC, game_date, game_id')} FROM games JOIN teams h ON h.team_id = home_team_id JOIN teams a ON a.team_id = away_team_id QUALIFY rank <= 20",
        "n14_weekend_scoring": f"{BASE}, s AS (SELECT dayofweek(game_date) IN (0, 6) AS is_weekend, strftime(game_date, '%A') AS day_name, count(*) AS games, sum(hs + as_) AS goals FROM games GROUP BY ALL) SELECT is_weekend, day_name, games, {per('goals', 'games')} AS avg_total_goals FROM s",
        "q002_game_faceoffs_by_player": f"""{_ALL}, f AS (SELECT game_id, winner AS p, true AS won, zone_code AS z FROM owned WHERE type_desc_key = 'faceoff'
    UNION ALL SELECT game_id, loser, false, CASE zone_code WHEN 'O' THEN 'D' WHEN 'D' THEN 'O' ELSE zone_code END FROM owned WHERE type_desc_key = 'faceoff'),
s AS (SELECT f.game_id, tm AS team, nm AS full_name, p, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses,
    {', '.join(f"count(*) FILTER (WHERE z = '{z}' AND won) || '-' || count(*) FILTER (WHERE z = '{z}' AND NOT won) AS {n}" for z, n in (('O', 'offensive_zone'), ('N', 'neutral_zone'), ('D', 'defensive_zone')))}
    FROM f JOIN names n ON n.game_id = f.game_id AND n.player_id = f.p GROUP BY ALL)
SELECT * EXCLUDE (p), {share('wins', 'wins + losses')} AS faceoff_pct FROM s""",
        "q003_game_find_game_id": f"{BASE} SELECT game_id, game_date, a.abbrev AS away, as_ AS away_score, h.abbrev AS home, hs AS home_score, decided_in, game_state, venue_name AS venue FROM games g JOIN teams a ON a.team_id = away_team_id JOIN teams h ON h.team_id = home_team_id",
        "q005_game_goals_and_shots_by_period": f"{_ALL} SELECT game_id, period, team, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals, count(*) FILTER (WHERE {_ON}) AS shots, count(*) FILTER (WHERE {_ANY}) AS attempts, count(*) FILTER (WHERE type_desc_key = 'hit') AS hits, count(*) FILTER (WHERE type_desc_key = 'faceoff') AS faceoff_wins FROM owned WHERE owner IS NOT NULL AND period_type <> 'SO' GROUP BY ALL",
        "q006_game_penalty_summary": f"{_ALL} SELECT o.game_id, event_id, period, time_in_period AS time, team, {pen_cols}, penalty_desc_key AS penalty, penalty_type_code AS penalty_type, penalty_duration AS minutes, NULL AS served_by FROM owned o {pen} WHERE type_desc_key = 'penalty'",
        "q008_game_scoring_summary": f"{_ALL} SELECT o.game_id, event_id, period, time_in_period AS time, team, {goal_cols}, scorer_total AS scorer_goal_total, strength, shot_type, floor(feet + 0.5) AS distance_ft, away_score, home_score FROM owned o {goal} WHERE type_desc_key = 'goal' AND period_type <> 'SO'",
        "q010_game_shots_by_strength": f"{_ALL} SELECT game_id, team, strength, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals, count(*) FILTER (WHERE {_ON}) AS shots, count(*) AS attempts FROM owned WHERE {_ANY} AND period_type <> 'SO' GROUP BY ALL",
        "q018_goalie_save_percentage": _goalies(5),
        "q018_goalie_save_percentage_usual": _goalies(200),
        "q023_league_goalie_save_percentage": _goalies(20),
        "q019_goalie_strong_games": _strong_games(3),
        "q019_goalie_strong_games_usual": _strong_games(10),
        "q024_league_goals_by_period": f"{BASE}, s AS (SELECT {_PERIOD} AS period, count(*) AS goals FROM strong JOIN games USING (game_id) WHERE type_desc_key = 'goal' AND game_type = 2 GROUP BY ALL), t AS (SELECT *, cast(sum(goals) OVER () AS bigint) AS total FROM s) SELECT period, goals, {share('goals', 'total')} AS share_pct FROM t",
        "q025_league_highest_scoring_games": f"{BASE}{_FINAL} SELECT game_id, game_date, team, score_for AS team_score, opponent, score_against AS opponent_score, score_for + score_against AS total_goals, decided_in, {_rank('score_for + score_against DESC, game_date, game_id')} FROM final WHERE is_home {_TOP}",
        "q027_league_home_ice_advantage": f"{BASE}{_FINAL}, s AS (SELECT team, count(*) FILTER (WHERE is_home) AS home_games, count(*) FILTER (WHERE is_home AND result = 'W') AS hw, count(*) FILTER (WHERE NOT is_home) AS away_games, count(*) FILTER (WHERE NOT is_home AND result = 'W') AS aw FROM final GROUP BY team) SELECT team, home_games, {share('hw', 'home_games')} AS home_win_pct, away_games, {share('aw', 'away_games')} AS away_win_pct, floor((100e0 * hw / nullif(home_games, 0) - 100e0 * aw / nullif(away_games, 0)) * 10 + 0.5) / 10e0 AS home_edge FROM s",
        "q028_league_most_traveled_players": f"""{_ALL}, r AS (SELECT player_id, full_name, game_date, team_id, lag(team_id) OVER (PARTITION BY player_id ORDER BY game_date, game_id) AS before FROM people),
s AS (SELECT player_id, full_name, count(*) FILTER (WHERE before IS DISTINCT FROM team_id) AS stints, count(DISTINCT team_id) AS distinct_teams, min(game_date) AS first_seen, max(game_date) AS last_seen FROM r GROUP BY ALL HAVING count(DISTINCT team_id) >= 2)
SELECT *, {_rank('distinct_teams DESC, stints DESC, player_id')} FROM s {_TOP}""",
        "q032_league_shot_type_conversion": f"{BASE}, s AS (SELECT shot_type, count(*) AS shots, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals FROM strong JOIN games USING (game_id) WHERE {_ON} AND shot_type IS NOT NULL AND game_type = 2 GROUP BY ALL) SELECT *, {share('goals', 'shots')} AS conversion_pct FROM s",
        "q033_league_weekend_scoring": f"{BASE}{_FINAL}, s AS (SELECT day_num IN (1, 7) AS is_weekend, day_name, count(*) AS games, sum(score_for + score_against) AS goals FROM final WHERE is_home GROUP BY ALL) SELECT is_weekend, day_name, games, {per('goals', 'games')} AS avg_total_goals FROM s",
        "q043_player_first_goal": f"{BASE}, f AS (SELECT game_id, arg_min(scorer, (period_number, sort_order)) AS player_id FROM strong WHERE type_desc_key = 'goal' GROUP BY game_id), s AS (SELECT full_name, player_id, count(*) AS first_goals FROM f JOIN people USING (game_id, player_id) WHERE position_code <> 'G' GROUP BY ALL) SELECT *, {_rank('first_goals DESC, player_id')} FROM s {_TOP}",
        "q046_player_game_winning_goals": f"""{BASE}, n AS (SELECT game_id, owner, scorer, row_number() OVER (PARTITION BY game_id, owner ORDER BY sort_order) AS own FROM strong WHERE type_desc_key = 'goal'),
w AS (SELECT n.game_id, scorer AS player_id FROM n JOIN games g USING (game_id) WHERE game_state = 'OFF' AND decided_in <> 'SO' AND owner = CASE WHEN hs > as_ THEN home_team_id ELSE away_team_id END AND own = least(hs, as_) + 1),
s AS (SELECT full_name, player_id, count(DISTINCT game_id) AS game_winning_goals FROM w JOIN people USING (game_id, player_id) WHERE position_code <> 'G' GROUP BY ALL) SELECT *, {_rank('game_winning_goals DESC, player_id')} FROM s {_TOP}""",
        "q051_player_big_games": f"{_SKATER} SELECT game_id, game_date, player_id, full_name, opponent, result, goals, assists, points FROM per WHERE goals >= 3 OR points >= 4",
        "q051_player_big_games_2_3": f"{_SKATER} SELECT game_id, game_date, player_id, full_name, opponent, result, goals, assists, points FROM per WHERE goals >= 2 OR points >= 3",
        "q058_player_longest_goal_streaks": _streak("goals"),
        "q059_player_longest_point_streaks": _streak("points"),
        "q061_player_multi_point_games": f"{_SKATER}, s AS (SELECT full_name, player_id, count(*) AS games_played, count(*) FILTER (WHERE points >= 1) AS games_with_a_point, count(*) FILTER (WHERE points >= 2) AS multi_point_games, count(*) FILTER (WHERE points >= 3) AS three_point_games FROM per GROUP BY ALL) SELECT *, {share('games_with_a_point', 'games_played')} AS pct_games_with_a_point, {_rank('multi_point_games DESC, games_with_a_point DESC, player_id')} FROM s {_TOP}",
        "q064_player_penalties_by_type": f"{BASE} SELECT penalty_desc_key AS penalty, count(*) AS times_taken, cast(sum(penalty_duration) AS bigint) AS pim, count(DISTINCT committed) AS players FROM strong s JOIN people p ON p.game_id = s.game_id AND p.player_id = s.committed WHERE type_desc_key = 'penalty' AND position_code <> 'G' GROUP BY ALL",
        "q070_player_roster_usage": f"{BASE} SELECT full_name, player_id, count(*) AS games_dressed, array_to_string(list_sort(list(DISTINCT position_code)), '/') AS positions, array_to_string(list_sort(list(DISTINCT cast(sweater_number AS varchar))), '/') AS numbers, min(game_date) AS first_game, max(game_date) AS last_game FROM people WHERE position_code <> 'G' GROUP BY ALL",
        "q071_player_scoring_combinations": f"""{BASE}, g AS (SELECT s.* FROM strong s JOIN games USING (game_id) WHERE type_desc_key = 'goal' AND game_type = 2),
p AS (SELECT scorer AS a, assist1 AS b FROM g UNION ALL SELECT scorer, assist2 FROM g UNION ALL SELECT assist1, assist2 FROM g),
s AS (SELECT least(a, b) AS player_1, greatest(a, b) AS player_2, count(*) AS goals_together FROM p WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL) SELECT *, {_rank('goals_together DESC, player_1, player_2')} FROM s {_TOP}""",
        "q074_player_share_of_team_goals": f"{_SKATER}, tg AS (SELECT game_id, owner AS team_id, count(*) AS tg FROM strong WHERE type_desc_key = 'goal' GROUP BY ALL), s AS (SELECT full_name, player_id, count(*) AS games_played, cast(sum(points) AS bigint) AS points, cast(sum(coalesce(tg, 0)) AS bigint) AS team_goals_while_dressed FROM per LEFT JOIN tg USING (game_id, team_id) GROUP BY ALL), r AS (SELECT *, {share('points', 'team_goals_while_dressed')} AS share_of_team_goals_pct FROM s) SELECT *, {_rank('share_of_team_goals_pct DESC NULLS LAST, player_id')} FROM r {_TOP}",
        "q092_player_teammates_who_assist": f"""{BASE}, g AS (SELECT s.* FROM strong s JOIN games USING (game_id) WHERE type_desc_key = 'goal' AND game_type = 2),
a AS (SELECT scorer AS player_id, assist1 AS assisted_by, true AS f FROM g UNION ALL SELECT scorer, assist2, false FROM g),
s AS (SELECT player_id, assisted_by, count(*) AS assists, count(*) FILTER (WHERE f) AS primary_assists, count(*) FILTER (WHERE NOT f) AS secondary_assists FROM a WHERE assisted_by IS NOT NULL GROUP BY ALL),
t AS (SELECT scorer AS player_id, count(*) AS all_goals FROM g GROUP BY ALL) SELECT s.*, {share('assists', 'all_goals')} AS pct_of_goals FROM s JOIN t USING (player_id)""",
        "q107_position_rank_within_position": f"{BASE}{STATS}{_sums('full_name, player_id')}, r AS (SELECT full_name, position, games_played, {_cols('goals assists points points_per_game shots shooting_pct', d.PLAYER)}, rank() OVER (PARTITION BY position ORDER BY {d.PLAYER['points']} DESC) AS position_rank, player_id FROM sums) SELECT * FROM r ORDER BY position_rank, position, player_id LIMIT 500",
        "q109_position_share_of_team_scoring": f"{BASE}{STATS}{_sums('position_group')}, r AS (SELECT *, primary_assists + secondary_assists AS assists, goals + primary_assists + secondary_assists AS points FROM sums), w AS (SELECT *, cast(sum(goals) OVER () AS bigint) AS g, cast(sum(points) OVER () AS bigint) AS p FROM r) SELECT position_group, players, games_played, goals, assists, points, {share('goals', 'g')} AS share_of_goals_pct, {share('points', 'p')} AS share_of_points_pct FROM w",
        "q114_team_comebacks_and_blown_leads": f"""{_TG}, m AS (SELECT *, sum(CASE WHEN side = 'for' THEN 1 ELSE -1 END) OVER (PARTITION BY game_id, team_id ORDER BY sort_order) AS m FROM faced WHERE type_desc_key = 'goal'),
g AS (SELECT game_id, team, result, min(m) AS low, max(m) AS high FROM m GROUP BY ALL),
c AS (SELECT '1) Trailed' AS situation, * FROM g WHERE low <= -1 UNION ALL SELECT '2) Trailed by 2+', * FROM g WHERE low <= -2 UNION ALL SELECT '3) Led', * FROM g WHERE high >= 1 UNION ALL SELECT '4) Led by 2+', * FROM g WHERE high >= 2),
s AS (SELECT team, situation, count(*) AS games, {_WLO} FROM c GROUP BY ALL) SELECT *, {share('wins', 'games')} AS win_pct FROM s""",
        "q118_team_goals_and_shots_by_period": f"{_TG} SELECT team, period, {_SIDED} FROM faced GROUP BY ALL",
        "q119_team_goals_by_game_time": f"{_TG}, k AS (SELECT *, CASE WHEN period_type = 'OT' THEN 'OT' ELSE 'P' || period_number || ' ' || lpad(cast(cast(substr(time_in_period, 1, 2) AS int) // 5 * 5 AS varchar), 2, '0') || '-' || lpad(cast(cast(substr(time_in_period, 1, 2) AS int) // 5 * 5 + 5 AS varchar), 2, '0') END AS game_time FROM faced WHERE type_desc_key = 'goal'), s AS (SELECT team, game_time, {_SIDED} FROM k GROUP BY ALL) SELECT team, game_time, goals_for, goals_against, goals_for - goals_against AS diff FROM s",
        "q120_team_goals_by_shot_type": f"{_TG}, s AS (SELECT team, shot_type, {_SIDED} FROM faced WHERE shot_type IS NOT NULL AND {_ON} GROUP BY ALL) SELECT *, {share('goals_for', 'shots_for')} AS shooting_pct, {per('shots_against - goals_against', 'shots_against', 3)} AS save_pct FROM s",
        "q142_team_shot_distance": f"{_TG}, s AS (SELECT team, distance, {_SIDED} FROM faced WHERE zone_code = 'O' AND {_ON} GROUP BY ALL) SELECT *, {share('goals_for', 'shots_for')} AS shooting_pct_for, {share('goals_against', 'shots_against')} AS shooting_pct_against FROM s",
        "q124_team_league_rankings": f"""{BASE}{TEAM}, s AS (SELECT team, count(*) AS games, {_WLO}, sum(gf) AS gf, sum(ga) AS ga, sum(sf) AS sf, sum(sa) AS sa, sum(cf) AS cf, sum(ca) AS ca FROM team_rows GROUP BY team), p AS (SELECT *, 2 * wins + ot_losses AS points FROM s)
SELECT team, team = 'T05' AS selected, games, points, {_cols('goals_for_per_game goals_against_per_game attempt_share_pct shooting_pct save_pct', d.TEAM)}, {', '.join(f'rank() OVER (ORDER BY {e} DESC NULLS LAST) AS {n}' for n, e in {'points_rank': 'points', 'gf_rank': '1e0 * gf / games', 'ga_rank': '-1e0 * ga / games', 'attempt_share_rank': '1e0 * cf / nullif(cf + ca, 0)', 'shooting_rank': '1e0 * gf / nullif(sf, 0)', 'save_rank': '1e0 * (sa - ga) / nullif(sa, 0)'}.items())} FROM p""",
        "q125_team_opposing_scorers": f"{_TG}, s AS (SELECT team, coalesce(scorer, shooter) AS player_id, count(*) FILTER (WHERE type_desc_key = 'goal') AS goals, count(*) AS shots_on_goal, count(DISTINCT game_id) AS games FROM faced WHERE side = 'against' AND {_ON} GROUP BY ALL) SELECT *, {NAME}, {_rank('goals DESC, shots_on_goal DESC, team, player_id')} FROM s {_TOP}",
        "q137_team_scoring_depth": f"{_TG}, d AS (SELECT game_id, team_id, count(DISTINCT scorer) AS n FROM faced WHERE type_desc_key = 'goal' AND side = 'for' GROUP BY ALL), s AS (SELECT team, coalesce(n, 0) AS scorers, count(*) AS games, count(*) FILTER (WHERE result = 'W') AS wins FROM final LEFT JOIN d USING (game_id, team_id) GROUP BY ALL) SELECT *, {share('wins', 'games')} AS win_pct FROM s",
        "q138_team_scoring_first": f"{_TG}, d AS (SELECT game_id, team_id, arg_min(side, sort_order) AS side FROM faced WHERE type_desc_key = 'goal' GROUP BY ALL), s AS (SELECT team, CASE side WHEN 'for' THEN '1) Scored first' WHEN 'against' THEN '2) Opponent first' ELSE '3) No goals' END AS first_goal, count(*) AS games, {_WLO} FROM final LEFT JOIN d USING (game_id, team_id) GROUP BY ALL) SELECT *, {share('wins', 'games')} AS win_pct FROM s",
        "q145_all_time_goals_scored": f"{_ALL}, s AS (SELECT scorer AS player_id, count(*) AS goals FROM plays WHERE type_desc_key = 'goal' GROUP BY ALL), n AS (SELECT player_id, full_name, arg_max(team, (game_date, game_id)) AS current_team FROM people GROUP BY ALL) SELECT player_id, full_name, current_team, goals, {_rank('goals DESC, player_id')} FROM s JOIN n USING (player_id) {_TOP}",
        "q146_top_play_makers": f"{BASE}, a AS (SELECT unnest([assist1, assist2]) AS player_id FROM plays WHERE type_desc_key = 'goal'), s AS (SELECT player_id, count(*) AS assists FROM a WHERE player_id IS NOT NULL GROUP BY ALL) SELECT *, {NAME}, {_rank('assists DESC, player_id')} FROM s {_TOP}",
    }
    for name, same in (("n01_all_time_goals_scored", "q145_all_time_goals_scored"), ("n02_top_play_makers", "q146_top_play_makers"), ("n09_most_traveled_players", "q028_league_most_traveled_players")):
        out[name] = out[same]
    return out
