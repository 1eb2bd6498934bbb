"""What the parameterised queries compute: names of measures, keys and orders. See rinkline.queries.run for how."""

from __future__ import annotations

_BASE = "goals assists points points_per_game shots shooting_pct shots_on_net_pct hits blocked_shots takeaways giveaways pim"
_LINE = "goals assists points points_per_game shots shooting_pct shot_attempts shots_on_net_pct hits blocked_shots takeaways giveaways pim faceoff_pct"
_DEFENSE = "blocked_shots blocks_per_game hits hits_per_game hits_taken takeaways giveaways takeaway_giveaway_diff pim penalties_drawn"

#: Leaderboards over skaters: columns, order (all descending unless marked), least values, position.
LEADERBOARDS: dict[str, tuple[str, str, dict[str, int], str | None]] = {
    "q020_league_assist_leaders": ("assists primary_assists secondary_assists points", "assists", {}, None),
    "q021_league_faceoff_leaders": ("faceoffs faceoff_wins faceoff_pct", "faceoff_pct", {"faceoffs": 300}, None),
    "q022_league_goal_leaders": ("goals goals_per_game shots shooting_pct", "goals", {}, None),
    "q026_league_hits_thrown_and_taken": ("hits hits_taken hit_diff", "hits", {}, None),
    "q029_league_penalty_minutes_vs_drawn": ("pim penalties_taken penalties_drawn penalty_diff", "pim", {}, None),
    "q030_league_shooting_percentage_leaders": ("goals shots shooting_pct", "shooting_pct goals", {"shots": 100}, None),
    "q031_league_shot_blocking_leaders": ("blocked_shots blocks_per_game", "blocked_shots", {}, None),
    "q034_player_assist_leaders": ("assists primary_assists secondary_assists assists_per_game", "assists primary_assists", {}, None),
    "q036_player_blocked_shots": ("blocked_shots blocks_per_game", "blocked_shots", {}, None),
    "q039_player_defensive_stats": (_DEFENSE, "blocked_shots", {}, None),
    "q040_player_empty_net_goals": ("en_goals goals", "en_goals", {}, None),
    "q041_player_even_strength_scoring": ("ev_goals ev_assists ev_points points", "ev_points", {}, None),
    "q042_player_faceoff_win_percentage": ("faceoff_wins faceoff_losses faceoffs faceoff_pct", "faceoff_pct", {"faceoffs": 100}, None),
    "q044_player_full_stat_line": (_LINE, "points goals", {}, None),
    "q047_player_goal_leaders": ("goals goals_per_game shots shooting_pct ev_goals pp_goals sh_goals", "goals shooting_pct", {}, None),
    "q049_player_goals_by_period": ("p1_goals p2_goals p3_goals ot_goals goals", "goals", {}, None),
    "q053_player_hit_differential": ("hits hits_taken hit_diff", "hit_diff", {}, None),
    "q054_player_hits_taken": ("hits_taken hits_taken_per_game", "hits_taken", {}, None),
    "q055_player_hits": ("hits hits_per_game", "hits", {}, None),
    "q057_player_late_game_scoring": ("late_goals late_assists late_points", "late_points late_goals", {}, None),
    "q060_player_missed_shots": ("missed_shots missed_shots_per_game shot_attempts missed_pct", "missed_pct", {"shot_attempts": 75}, None),
    "q062_player_overtime_goals": ("ot_goals goals", "ot_goals goals", {}, None),
    "q063_player_penalties_drawn_vs_taken": ("penalties_drawn penalties_taken net_penalties", "net_penalties", {}, None),
    "q065_player_penalty_minutes": ("pim pim_per_game penalties_taken fights", "pim", {}, None),
    "q066_player_physical_play": ("hits hits_taken blocked_shots fights pim", "physical", {}, None),
    "q067_player_points_per_game": ("points_per_game goals_per_game assists_per_game points", "points_per_game points", {}, None),
    "q068_player_power_play_scoring": ("pp_goals pp_assists pp_points points pp_share_of_points_pct", "pp_points", {}, None),
    "q069_player_primary_points": ("goals primary_assists primary_points points", "primary_points goals", {}, None),
    "q072_player_scoring_leaders": ("goals assists points points_per_game primary_points pp_points", "points goals", {}, None),
    "q075_player_shooting_efficiency": ("goals shots shot_attempts shooting_pct shots_on_net_pct goals_per_attempt_pct", "goals_per_attempt_pct goals", {"shot_attempts": 75}, None),
    "q077_player_shooting_percentage": ("goals shots shooting_pct shots_per_game", "shooting_pct goals", {"shots": 50}, None),
    "q080_player_shorthanded_scoring": ("sh_goals sh_assists sh_points", "sh_points sh_goals", {}, None),
    "q082_player_shot_attempts": ("shot_attempts shot_attempts_per_game shots missed_shots own_shots_blocked shots_on_net_pct", "shot_attempts", {}, None),
    "q084_player_shots_blocked_by_opponents": ("own_shots_blocked shot_attempts blocked_by_opp_pct", "blocked_by_opp_pct", {"shot_attempts": 75}, None),
    "q085_player_shots_per_game": ("shots shots_per_game shot_attempts_per_game goals", "shots_per_game", {}, None),
    "q086_player_shots_on_net_percentage": ("shots missed_shots own_shots_blocked shot_attempts shots_on_net_pct", "shots_on_net_pct shots", {"shot_attempts": 75}, None),
    "q090_player_takeaway_to_giveaway_ratio": ("takeaways giveaways takeaway_giveaway_ratio", "takeaway_giveaway_ratio", {}, None),
    "q091_player_takeaways_and_giveaways": ("takeaways giveaways takeaway_giveaway_diff takeaways_per_game giveaways_per_game", "takeaway_giveaway_diff", {}, None),
    "q094_position_centers_comparison": ("goals assists points points_per_game faceoffs faceoff_pct shots shooting_pct takeaways giveaways", "points", {}, "C"),
    "q095_position_defensemen_comparison": (_BASE, "points", {}, "D"),
    "q096_position_defensemen_defensive_stats": (_DEFENSE, "blocked_shots", {}, "D"),
    "q097_position_defensemen_offense": ("goals assists points points_per_game pp_points shots shot_attempts shooting_pct shots_on_net_pct", "points", {}, "D"),
    "q099_position_forwards_comparison": (_BASE, "points", {}, "F"),
    "q100_position_forwards_defensive_stats": ("blocked_shots blocks_per_game hits hits_per_game takeaways giveaways takeaway_giveaway_diff", "takeaway_giveaway_diff", {}, "F"),
    "q113_position_wingers_comparison": (_BASE, "points", {}, "W"),
}

#: All-time lists over every game type: columns, order, least values.
ALL_TIME: dict[str, tuple[str, str, dict[str, int]]] = {
    "n03_best_shooting_percentage": ("goals shots shooting_pct", "shooting_pct goals", {"shots": 200}),
    "n05_hits_thrown_and_taken": ("hits hits_taken hit_diff", "hits", {}),
    "n06_faceoff_win_percentage": ("faceoffs faceoff_wins faceoff_pct", "faceoff_pct", {"faceoffs": 500}),
    "n07_penalty_minutes_vs_drawn": ("pim penalties_taken penalties_drawn", "pim", {}),
    "n08_shot_blockers": ("blocked_shots", "blocked_shots", {}),
}

#: Minimums at which the registered queries run besides the usual ones, since the small tables hold few games a player.
SMALL: dict[str, dict[str, int]] = {
    "q021_league_faceoff_leaders": {"min_faceoffs": 5}, "q030_league_shooting_percentage_leaders": {"min_shots": 3}, "q042_player_faceoff_win_percentage": {"min_faceoffs": 3},
    "q060_player_missed_shots": {"min_shot_attempts": 3}, "q075_player_shooting_efficiency": {"min_shot_attempts": 3}, "q077_player_shooting_percentage": {"min_shots": 2},
    "q084_player_shots_blocked_by_opponents": {"min_shot_attempts": 3}, "q086_player_shots_on_net_percentage": {"min_shot_attempts": 3},
    "n03_best_shooting_percentage": {"min_shots": 4}, "n06_faceoff_win_percentage": {"min_faceoffs": 4},
}

#: Two players side by side.
HEAD_TO_HEAD = ("q052_player_head_to_head_comparison", ("P8470041 L1", "P8470043 L3"), _LINE.replace("points_per_game", "points_per_game pp_points"))

#: Splits of every skater by a key: keys as (name, column of player_games).
SPLITS: dict[str, tuple[str, str]] = {
    "q038_player_day_of_week_splits": ("day_num day_name", _BASE),
    "q045_player_game_log": ("game_id game_date opponent venue result", "goals assists points shots shot_attempts hits blocked_shots takeaways giveaways pim faceoff_wins faceoff_losses"),
    "q056_player_home_and_away_splits": ("venue", _BASE),
    "q073_player_season_by_season": ("season", _BASE),
    "q087_player_stats_by_month": ("month", _BASE),
    "q088_player_stats_by_position_played": ("position_code", _BASE),
    "q089_player_stats_vs_each_opponent": ("opponent", _BASE),
    "q093_player_wins_vs_losses": ("result", _BASE),
}

_RATES = "goals_per_game assists_per_game points_per_game shots_per_game shooting_pct shots_on_net_pct hits_per_game blocks_per_game takeaways_per_game giveaways_per_game pim_per_game"
#: Position groups: keys beside the group, columns.
GROUPS: dict[str, tuple[str, str]] = {
    "q098_position_faceoffs": ("position_group", "faceoff_wins faceoff_losses faceoffs faceoff_pct"),
    "q101_position_forwards_vs_defense": ("forward_or_defense", _RATES),
    "q102_position_group_comparison": ("position_group", _RATES),
    "q103_position_groups_by_season": ("season position_group", "points_per_game goals_per_game shooting_pct shots_on_net_pct hits_per_game blocks_per_game"),
    "q104_position_penalties": ("position_group", "pim pim_per_game penalties_taken penalties_drawn penalty_diff fights"),
    "q105_position_physical_play": ("position_group", "hits hits_per_game hits_taken_per_game blocked_shots blocks_per_game fights"),
    "q106_position_puck_management": ("position_group", "takeaways giveaways takeaways_per_game giveaways_per_game takeaway_giveaway_ratio"),
    "q108_position_scoring": ("position_group", "goals assists points goals_per_game assists_per_game points_per_game ev_points pp_points"),
    "q110_position_shooting": ("position_group", "shots shot_attempts shots_per_game shooting_pct shots_on_net_pct missed_pct blocked_by_opp_pct"),
    "q111_position_special_teams": ("position_group", "ev_points pp_points sh_points points pp_share_of_points_pct"),
    "q112_position_team_vs_rest": ("position_group scope", _RATES),
}

_RECORD = "games wins losses ot_losses points win_pct"
_GOALS = " goals_for goals_against goal_diff"
#: Teams: keys, columns.
TEAMS: dict[str, tuple[str, str]] = {
    "q115_team_compared_to_rest": ("scope", "team_games goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game shooting_pct save_pct attempt_share_pct faceoff_pct hits_per_game blocks_per_game pim_per_game"),
    "q116_team_faceoffs": ("team season", "faceoff_wins faceoff_losses faceoff_pct"),
    "q117_team_game_results": ("team game_id game_date opponent venue score_for score_against result decided_in", "shots_for shots_against attempts_for attempts_against attempt_share_pct hits blocks"),
    "q121_team_goals_by_strength": ("team season", "ev_for ev_against pp_for pp_against sh_for sh_against en_for en_against"),
    "q122_team_head_to_head": ("team season opponent", _RECORD + _GOALS + " shots_for shots_against"),
    "q123_team_home_vs_away": ("team venue", _RECORD + _GOALS + " goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game"),
    "q126_team_overtime_and_shootout_record": ("team decided_in", _RECORD),
    "q127_team_penalties": ("team season", "penalties_taken penalties_drawn pim opp_pim pim_per_game opp_pim_per_game"),
    "q128_team_physical_play": ("team season", "hits hits_taken hits_per_game hits_taken_per_game blocks shots_blocked_by_opponents blocks_per_game"),
    "q129_team_puck_management": ("team season", "takeaways giveaways diff opp_takeaways opp_giveaways"),
    "q130_team_record_by_day_of_week": ("team day_num day_name", _RECORD + _GOALS),
    "q131_team_record_by_goal_margin": ("team margin", _RECORD),
    "q132_team_record_by_month": ("team month", _RECORD + _GOALS),
    "q133_team_record_vs_each_opponent": ("team opponent", _RECORD + _GOALS),
    "q134_team_results_when_outshooting": ("team shots_vs_opponent", _RECORD),
    "q135_team_results_by_hits": ("team hits_vs_opponent", _RECORD),
    "q136_team_results_by_attempt_share": ("team attempts_vs_opponent", _RECORD),
    "q139_team_season_record": ("team season", _RECORD + _GOALS),
    "q140_team_shooting_and_save_percentage": ("team season", "goals_for shots_for shooting_pct goals_against shots_against save_pct pdo"),
    "q141_team_shot_attempt_share": ("team season", "attempts_for attempts_against attempt_share_pct unblocked_for unblocked_against unblocked_share_pct attempts_for_per_game attempts_against_per_game"),
    "q143_team_shots_and_goals_per_game": ("team season", "goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game shot_diff_per_game"),
    "q144_team_special_teams": ("team season", "pp_goals minors_drawn pp_goals_per_minor_pct pp_goals_against minors_taken pk_success_approx_pct shorthanded_goals_for shorthanded_goals_against"),
}

#: Shots by a key. what: player shots or goalie shots; keys; condition on the shot.
SHOTS: dict[str, tuple[str, str, str]] = {
    "q012_goalie_game_log": ("goalie", "player_id full_name game_id game_date opponent result", "true"),
    "q013_goalie_save_pct_by_distance": ("goalie", "player_id full_name distance", "zone_code = 'O'"),
    "q014_goalie_save_pct_by_period": ("goalie", "player_id full_name period", "true"),
    "q015_goalie_save_pct_by_shot_type": ("goalie", "player_id full_name shot_type", "shot_type is not null"),
    "q016_goalie_save_pct_by_situation": ("goalie", "player_id full_name situation", "true"),
    "q017_goalie_save_pct_vs_opponent": ("goalie", "player_id full_name opponent", "true"),
    "q050_player_goals_by_shot_type": ("player", "shot_type", "on_net and shot_type is not null"),
    "q076_player_shooting_pct_by_distance": ("player", "distance", "on_net and zone_code = 'O'"),
    "q078_player_shooting_by_period": ("player", "period", "true"),
    "q079_player_shooting_by_strength": ("player", "strength", "true"),
    "q081_player_shot_accuracy_by_shot_type": ("accuracy", "shot_type", "not blocked and shot_type is not null"),
    "q083_player_shot_type_mix": ("player", "player_id full_name shot_type", "on_net and shot_type is not null"),
}

_TEAM = {"team": "T03", "season": 20212022}
#: Filters with which questions are registered once more, as <name>_filtered.
FILTERED: dict[str, dict] = {n: _TEAM for n in [*GROUPS, *TEAMS]} | {
    "q044_player_full_stat_line": {"team": "T03", "season": 20212022, "position": "F"},
    "q072_player_scoring_leaders": {"season": 20212022, "game_type": 3},
    "q047_player_goal_leaders": {"team": "T07", "game_type": 2},
    "q052_player_head_to_head_comparison": {"season": 20212022},
    "q045_player_game_log": {"player": "p8470041 l1"},
    "q056_player_home_and_away_splits": {"team": "T03", "player": "P8470061 L21"},
    "q089_player_stats_vs_each_opponent": {"team": "T04", "season": 20212022},
    "q122_team_head_to_head": {"team": "T03", "opponent": "T04"},
    "q012_goalie_game_log": {"team": "T03"},
    "q017_goalie_save_pct_vs_opponent": {"season": 20212022, "team": "T05"},
    "q076_player_shooting_pct_by_distance": {"team": "T03", "season": 20212022},
    "q050_player_goals_by_shot_type": {"player": "P8470041 L1"},
}
