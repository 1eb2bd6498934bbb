"""The definitions on the SQL side: measures, ratios, lists and minimums, stated again and apart from the library.

Nothing here is imported from the DataFrame code, so a wrong measure, order or
minimum there shows as a difference.
"""

from __future__ import annotations


def _table(text: str) -> dict[str, str]:
    """Lines `name: rest` as a dict."""
    return {k.strip(): v.strip() for k, v in (line.split(":", 1) for line in text.strip().splitlines())}


def per(over: str, under: str, places: int = 2) -> str:
    return f"floor(1e0 * ({over}) * {10**places} / nullif({under}, 0) + 0.5) / {10**places}e0"


def pct(over: str, under: str) -> str:
    return f"floor(100e0 * ({over}) * 10 / nullif({under}, 0) + 0.5) / 10e0"


#: A player's measures: which of their parts in plays count.
PARTS = _table("""
goals: role = 'scorer'
primary_assists: role = 'assist1'
secondary_assists: role = 'assist2'
shots_saved: role = 'shooter' AND type_desc_key = 'shot-on-goal'
missed_shots: role = 'shooter' AND type_desc_key = 'missed-shot'
own_shots_blocked: role = 'shooter' AND type_desc_key = 'blocked-shot'
blocked_shots: role = 'blocker'
hits: role = 'hitter'
hits_taken: role = 'hittee'
faceoff_wins: role = 'winner'
faceoff_losses: role = 'loser'
penalties_taken: role = 'committed'
penalties_drawn: role = 'drawn'
fights: role = 'committed' AND penalty_desc_key = 'fighting'
takeaways: role = 'player' AND type_desc_key = 'takeaway'
giveaways: role = 'player' AND type_desc_key = 'giveaway'
p1_goals: role = 'scorer' AND period_number = 1
p2_goals: role = 'scorer' AND period_number = 2
p3_goals: role = 'scorer' AND period_number = 3 AND period_type = 'REG'
ot_goals: role = 'scorer' AND period_type = 'OT'
late_goals: role = 'scorer' AND period_number = 3 AND period_type = 'REG' AND time_in_period >= '15:00'
late_assists: role IN ('assist1', 'assist2') AND period_number = 3 AND period_type = 'REG' AND time_in_period >= '15:00'
ev_goals: role = 'scorer' AND strength = 'EV'
pp_goals: role = 'scorer' AND strength = 'PP'
sh_goals: role = 'scorer' AND strength = 'SH'
en_goals: role = 'scorer' AND strength = 'EN'
ev_assists: role IN ('assist1', 'assist2') AND strength = 'EV'
pp_assists: role IN ('assist1', 'assist2') AND strength = 'PP'
sh_assists: role IN ('assist1', 'assist2') AND strength = 'SH'
""")

#: A team's measures over plays as it sees them (side 'for' or 'against').
SEEN = _table("""
gf: side = 'for' AND type_desc_key = 'goal'
ga: side = 'against' AND type_desc_key = 'goal'
sf: side = 'for' AND type_desc_key IN ('goal', 'shot-on-goal')
sa: side = 'against' AND type_desc_key IN ('goal', 'shot-on-goal')
cf: side = 'for' AND type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot')
ca: side = 'against' AND type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot', 'blocked-shot')
ff: side = 'for' AND type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot')
fa: side = 'against' AND type_desc_key IN ('goal', 'shot-on-goal', 'missed-shot')
hits_for: side = 'for' AND type_desc_key = 'hit'
hits_against: side = 'against' AND type_desc_key = 'hit'
fo_wins: side = 'for' AND type_desc_key = 'faceoff'
fo_losses: side = 'against' AND type_desc_key = 'faceoff'
penalties: side = 'for' AND type_desc_key = 'penalty'
opp_penalties: side = 'against' AND type_desc_key = 'penalty'
takeaways: side = 'for' AND type_desc_key = 'takeaway'
opp_takeaways: side = 'against' AND type_desc_key = 'takeaway'
giveaways: side = 'for' AND type_desc_key = 'giveaway'
opp_giveaways: side = 'against' AND type_desc_key = 'giveaway'
minors_taken: side = 'for' AND type_desc_key = 'penalty' AND penalty_type_code IN ('MIN', 'BEN')
minors_drawn: side = 'against' AND type_desc_key = 'penalty' AND penalty_type_code IN ('MIN', 'BEN')
ev_gf: side = 'for' AND type_desc_key = 'goal' AND strength = 'EV'
ev_ga: side = 'against' AND type_desc_key = 'goal' AND strength = 'EV'
pp_gf: side = 'for' AND type_desc_key = 'goal' AND strength = 'PP'
pp_ga: side = 'against' AND type_desc_key = 'goal' AND strength = 'PP'
sh_gf: side = 'for' AND type_desc_key = 'goal' AND strength = 'SH'
sh_ga: side = 'against' AND type_desc_key = 'goal' AND strength = 'SH'
en_gf: side = 'for' AND type_desc_key = 'goal' AND strength = 'EN'
en_ga: side = 'against' AND type_desc_key = 'goal' AND strength = 'EN'
blocks_for: type_desc_key = 'blocked-shot' AND blocker_team_id = team_id
blocks_against: type_desc_key = 'blocked-shot' AND blocker_team_id <> team_id
""")

#: What is computed from a player's sums.
PLAYER = {
    **_table("""
assists: primary_assists + secondary_assists
points: goals + primary_assists + secondary_assists
primary_points: goals + primary_assists
shots: goals + shots_saved
shot_attempts: goals + shots_saved + missed_shots + own_shots_blocked
ev_points: ev_goals + ev_assists
pp_points: pp_goals + pp_assists
sh_points: sh_goals + sh_assists
late_points: late_goals + late_assists
hit_diff: hits - hits_taken
penalty_diff: penalties_taken - penalties_drawn
net_penalties: penalties_drawn - penalties_taken
faceoffs: faceoff_wins + faceoff_losses
takeaway_giveaway_diff: takeaways - giveaways
physical: hits + blocked_shots
"""),
    "points_per_game": per("goals + primary_assists + secondary_assists", "games_played"),
    "goals_per_game": per("goals", "games_played"),
    "assists_per_game": per("primary_assists + secondary_assists", "games_played"),
    "shots_per_game": per("goals + shots_saved", "games_played"),
    "shot_attempts_per_game": per("goals + shots_saved + missed_shots + own_shots_blocked", "games_played"),
    "hits_per_game": per("hits", "games_played"),
    "hits_taken_per_game": per("hits_taken", "games_played"),
    "blocks_per_game": per("blocked_shots", "games_played"),
    "takeaways_per_game": per("takeaways", "games_played"),
    "giveaways_per_game": per("giveaways", "games_played"),
    "pim_per_game": per("pim", "games_played"),
    "missed_shots_per_game": per("missed_shots", "games_played"),
    "shooting_pct": pct("goals", "(goals + shots_saved)"),
    "shots_on_net_pct": pct("goals + shots_saved", "(goals + shots_saved + missed_shots + own_shots_blocked)"),
    "goals_per_attempt_pct": pct("goals", "(goals + shots_saved + missed_shots + own_shots_blocked)"),
    "missed_pct": pct("missed_shots", "(goals + shots_saved + missed_shots + own_shots_blocked)"),
    "blocked_by_opp_pct": pct("own_shots_blocked", "(goals + shots_saved + missed_shots + own_shots_blocked)"),
    "faceoff_pct": pct("faceoff_wins", "(faceoff_wins + faceoff_losses)"),
    "pp_share_of_points_pct": pct("pp_goals + pp_assists", "(goals + primary_assists + secondary_assists)"),
    "takeaway_giveaway_ratio": per("takeaways", "giveaways"),
}

#: What is computed from a team's sums.
TEAM = {
    **_table("""
points: 2 * wins + ot_losses
goal_diff: gf - ga
goals_for: gf
goals_against: ga
shots_for: sf
shots_against: sa
attempts_for: cf
attempts_against: ca
unblocked_for: ff
unblocked_against: fa
faceoff_wins: fo_wins
faceoff_losses: fo_losses
hits: hits_for
hits_taken: hits_against
blocks: blocks_for
shots_blocked_by_opponents: blocks_against
penalties_taken: penalties
penalties_drawn: opp_penalties
diff: takeaways - giveaways
team_games: games
ev_for: ev_gf
ev_against: ev_ga
pp_for: pp_gf
pp_against: pp_ga
sh_for: sh_gf
sh_against: sh_ga
en_for: en_gf
en_against: en_ga
pp_goals: pp_gf
pp_goals_against: pp_ga
shorthanded_goals_for: sh_gf
shorthanded_goals_against: sh_ga
"""),
    "win_pct": pct("wins", "games"),
    "goals_for_per_game": per("gf", "games"),
    "goals_against_per_game": per("ga", "games"),
    "shots_for_per_game": per("sf", "games"),
    "shots_against_per_game": per("sa", "games"),
    "shot_diff_per_game": per("sf - sa", "games"),
    "attempts_for_per_game": per("cf", "games"),
    "attempts_against_per_game": per("ca", "games"),
    "hits_per_game": per("hits_for", "games"),
    "hits_taken_per_game": per("hits_against", "games"),
    "blocks_per_game": per("blocks_for", "games"),
    "pim_per_game": per("pim", "games"),
    "opp_pim_per_game": per("opp_pim", "games"),
    "shooting_pct": pct("gf", "sf"),
    "save_pct": per("sa - ga", "sa", 3),
    "pdo": "floor(100e0 * (1e0 * gf / nullif(sf, 0) + 1e0 * (sa - ga) / nullif(sa, 0)) * 10 + 0.5) / 10e0",
    "attempt_share_pct": pct("cf", "(cf + ca)"),
    "unblocked_share_pct": pct("ff", "(ff + fa)"),
    "faceoff_pct": pct("fo_wins", "(fo_wins + fo_losses)"),
    "pp_goals_per_minor_pct": pct("pp_gf", "minors_drawn"),
    "pk_success_approx_pct": pct("minors_taken - pp_ga", "minors_taken"),
}

#: Leaderboards: columns / what they fall by / least values / positions.
BOARDS = _table("""
q020_league_assist_leaders: assists primary_assists secondary_assists points / assists / /
q021_league_faceoff_leaders: faceoffs faceoff_wins faceoff_pct / faceoff_pct / faceoffs 5 /
q022_league_goal_leaders: goals goals_per_game shots shooting_pct / goals / /
q026_league_hits_thrown_and_taken: hits hits_taken hit_diff / hits / /
q029_league_penalty_minutes_vs_drawn: pim penalties_taken penalties_drawn penalty_diff / pim / /
q030_league_shooting_percentage_leaders: goals shots shooting_pct / shooting_pct goals / shots 3 /
q031_league_shot_blocking_leaders: blocked_shots blocks_per_game / blocked_shots / /
q034_player_assist_leaders: assists primary_assists secondary_assists assists_per_game / assists primary_assists / /
q036_player_blocked_shots: blocked_shots blocks_per_game / blocked_shots / /
q039_player_defensive_stats: blocked_shots blocks_per_game hits hits_per_game hits_taken takeaways giveaways takeaway_giveaway_diff pim penalties_drawn / blocked_shots / /
q040_player_empty_net_goals: en_goals goals / en_goals / /
q041_player_even_strength_scoring: ev_goals ev_assists ev_points points / ev_points / /
q042_player_faceoff_win_percentage: faceoff_wins faceoff_losses faceoffs faceoff_pct / faceoff_pct / faceoffs 3 /
q044_player_full_stat_line: goals assists points points_per_game shots shooting_pct shot_attempts shots_on_net_pct hits blocked_shots takeaways giveaways pim faceoff_pct / points goals / /
q047_player_goal_leaders: goals goals_per_game shots shooting_pct ev_goals pp_goals sh_goals / goals shooting_pct / /
q049_player_goals_by_period: p1_goals p2_goals p3_goals ot_goals goals / goals / /
q053_player_hit_differential: hits hits_taken hit_diff / hit_diff / /
q054_player_hits_taken: hits_taken hits_taken_per_game / hits_taken / /
q055_player_hits: hits hits_per_game / hits / /
q057_player_late_game_scoring: late_goals late_assists late_points / late_points late_goals / /
q060_player_missed_shots: missed_shots missed_shots_per_game shot_attempts missed_pct / missed_pct / shot_attempts 3 /
q062_player_overtime_goals: ot_goals goals / ot_goals goals / /
q063_player_penalties_drawn_vs_taken: penalties_drawn penalties_taken net_penalties / net_penalties / /
q065_player_penalty_minutes: pim pim_per_game penalties_taken fights / pim / /
q066_player_physical_play: hits hits_taken blocked_shots fights pim / physical / /
q067_player_points_per_game: points_per_game goals_per_game assists_per_game points / points_per_game points / /
q068_player_power_play_scoring: pp_goals pp_assists pp_points points pp_share_of_points_pct / pp_points / /
q069_player_primary_points: goals primary_assists primary_points points / primary_points goals / /
q072_player_scoring_leaders: goals assists points points_per_game primary_points pp_points / points goals / /
q075_player_shooting_efficiency: goals shots shot_attempts shooting_pct shots_on_net_pct goals_per_attempt_pct / goals_per_attempt_pct goals / shot_attempts 3 /
q077_player_shooting_percentage: goals shots shooting_pct shots_per_game / shooting_pct goals / shots 2 /
q080_player_shorthanded_scoring: sh_goals sh_assists sh_points / sh_points sh_goals / /
q082_player_shot_attempts: shot_attempts shot_attempts_per_game shots missed_shots own_shots_blocked shots_on_net_pct / shot_attempts / /
q084_player_shots_blocked_by_opponents: own_shots_blocked shot_attempts blocked_by_opp_pct / blocked_by_opp_pct / shot_attempts 3 /
q085_player_shots_per_game: shots shots_per_game shot_attempts_per_game goals / shots_per_game / /
q086_player_shots_on_net_percentage: shots missed_shots own_shots_blocked shot_attempts shots_on_net_pct / shots_on_net_pct shots / shot_attempts 3 /
q090_player_takeaway_to_giveaway_ratio: takeaways giveaways takeaway_giveaway_ratio / takeaway_giveaway_ratio / /
q091_player_takeaways_and_giveaways: takeaways giveaways takeaway_giveaway_diff takeaways_per_game giveaways_per_game / takeaway_giveaway_diff / /
q094_position_centers_comparison: goals assists points points_per_game faceoffs faceoff_pct shots shooting_pct takeaways giveaways / points / / 'C'
q095_position_defensemen_comparison: goals assists points points_per_game shots shooting_pct shots_on_net_pct hits blocked_shots takeaways giveaways pim / points / / 'D'
q096_position_defensemen_defensive_stats: blocked_shots blocks_per_game hits hits_per_game hits_taken takeaways giveaways takeaway_giveaway_diff pim penalties_drawn / blocked_shots / / 'D'
q097_position_defensemen_offense: goals assists points points_per_game pp_points shots shot_attempts shooting_pct shots_on_net_pct / points / / 'D'
q099_position_forwards_comparison: goals assists points points_per_game shots shooting_pct shots_on_net_pct hits blocked_shots takeaways giveaways pim / points / / 'C', 'L', 'R'
q100_position_forwards_defensive_stats: blocked_shots blocks_per_game hits hits_per_game takeaways giveaways takeaway_giveaway_diff / takeaway_giveaway_diff / / 'C', 'L', 'R'
q113_position_wingers_comparison: goals assists points points_per_game shots shooting_pct shots_on_net_pct hits blocked_shots takeaways giveaways pim / points / / 'L', 'R'
""")

#: The leaderboards that run again with the usual minimums: least games, measure and least value.
USUAL = _table("""
q021_league_faceoff_leaders: 1 faceoffs 300
q030_league_shooting_percentage_leaders: 1 shots 100
q042_player_faceoff_win_percentage: 10 faceoffs 100
q060_player_missed_shots: 10 shot_attempts 75
q075_player_shooting_efficiency: 10 shot_attempts 75
q077_player_shooting_percentage: 10 shots 50
q084_player_shots_blocked_by_opponents: 10 shot_attempts 75
q086_player_shots_on_net_percentage: 10 shot_attempts 75
""")

#: All plays of all time: columns / what they fall by / least values, small and usual.
ALL_TIME = _table("""
n03_best_shooting_percentage: goals shots shooting_pct / shooting_pct goals / shots 4 200
n05_hits_thrown_and_taken: hits hits_taken hit_diff / hits /
n06_faceoff_win_percentage: faceoffs faceoff_wins faceoff_pct / faceoff_pct / faceoffs 4 500
n07_penalty_minutes_vs_drawn: pim penalties_taken penalties_drawn / pim /
n08_shot_blockers: blocked_shots / blocked_shots /
""")

_EACH = "goals assists points points_per_game shots shooting_pct shots_on_net_pct hits blocked_shots takeaways giveaways pim"
_RATES = "goals_per_game assists_per_game points_per_game shots_per_game shooting_pct shots_on_net_pct hits_per_game blocks_per_game takeaways_per_game giveaways_per_game pim_per_game"
_RECORD = "games wins losses ot_losses points win_pct"

#: Splits of skaters: keys / columns.
SPLITS = _table(f"""
q038_player_day_of_week_splits: day_num day_name / {_EACH}
q045_player_game_log: game_id game_date opponent venue result / goals assists points shots shot_attempts hits blocked_shots takeaways giveaways pim faceoff_wins faceoff_losses
q056_player_home_and_away_splits: venue / {_EACH}
q073_player_season_by_season: season / {_EACH}
q087_player_stats_by_month: month / {_EACH}
q088_player_stats_by_position_played: position_code / {_EACH}
q089_player_stats_vs_each_opponent: opponent / {_EACH}
q093_player_wins_vs_losses: result / {_EACH}
""")

#: Groups of positions: keys / columns.
GROUPS = _table(f"""
q098_position_faceoffs: position_group / faceoff_wins faceoff_losses faceoffs faceoff_pct
q101_position_forwards_vs_defense: forward_or_defense / {_RATES}
q102_position_group_comparison: position_group / {_RATES}
q103_position_groups_by_season: season position_group / points_per_game goals_per_game shooting_pct shots_on_net_pct hits_per_game blocks_per_game
q104_position_penalties: position_group / pim pim_per_game penalties_taken penalties_drawn penalty_diff fights
q105_position_physical_play: position_group / hits hits_per_game hits_taken_per_game blocked_shots blocks_per_game fights
q106_position_puck_management: position_group / takeaways giveaways takeaways_per_game giveaways_per_game takeaway_giveaway_ratio
q108_position_scoring: position_group / goals assists points goals_per_game assists_per_game points_per_game ev_points pp_points
q110_position_shooting: position_group / shots shot_attempts shots_per_game shooting_pct shots_on_net_pct missed_pct blocked_by_opp_pct
q111_position_special_teams: position_group / ev_points pp_points sh_points points pp_share_of_points_pct
q112_position_team_vs_rest: position_group scope / {_RATES}
""")

#: Teams: keys / columns.
TEAMS = _table(f"""
q115_team_compared_to_rest: scope / team_games goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game shooting_pct save_pct attempt_share_pct faceoff_pct hits_per_game blocks_per_game pim_per_game
q116_team_faceoffs: team season / faceoff_wins faceoff_losses faceoff_pct
q117_team_game_results: team game_id game_date opponent venue score_for score_against result decided_in / shots_for shots_against attempts_for attempts_against attempt_share_pct hits blocks
q121_team_goals_by_strength: team season / ev_for ev_against pp_for pp_against sh_for sh_against en_for en_against
q122_team_head_to_head: team season opponent / {_RECORD} goals_for goals_against goal_diff shots_for shots_against
q123_team_home_vs_away: team venue / {_RECORD} goals_for goals_against goal_diff goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game
q126_team_overtime_and_shootout_record: team decided_in / {_RECORD}
q127_team_penalties: team season / penalties_taken penalties_drawn pim opp_pim pim_per_game opp_pim_per_game
q128_team_physical_play: team season / hits hits_taken hits_per_game hits_taken_per_game blocks shots_blocked_by_opponents blocks_per_game
q129_team_puck_management: team season / takeaways giveaways diff opp_takeaways opp_giveaways
q130_team_record_by_day_of_week: team day_num day_name / {_RECORD} goals_for goals_against goal_diff
q131_team_record_by_goal_margin: team margin / {_RECORD}
q132_team_record_by_month: team month / {_RECORD} goals_for goals_against goal_diff
q133_team_record_vs_each_opponent: team opponent / {_RECORD} goals_for goals_against goal_diff
q134_team_results_when_outshooting: team shots_vs_opponent / {_RECORD}
q135_team_results_by_hits: team hits_vs_opponent / {_RECORD}
q136_team_results_by_attempt_share: team attempts_vs_opponent / {_RECORD}
q139_team_season_record: team season / {_RECORD} goals_for goals_against goal_diff
q140_team_shooting_and_save_percentage: team season / goals_for shots_for shooting_pct goals_against shots_against save_pct pdo
q141_team_shot_attempt_share: team season / attempts_for attempts_against attempt_share_pct unblocked_for unblocked_against unblocked_share_pct attempts_for_per_game attempts_against_per_game
q143_team_shots_and_goals_per_game: team season / goals_for_per_game goals_against_per_game shots_for_per_game shots_against_per_game shot_diff_per_game
q144_team_special_teams: team season / pp_goals minors_drawn pp_goals_per_minor_pct pp_goals_against minors_taken pk_success_approx_pct shorthanded_goals_for shorthanded_goals_against
""")

#: Shots: who / keys / which.
SHOTS = _table("""
q012_goalie_game_log: goalie / player_id full_name game_id game_date opponent result / true
q013_goalie_save_pct_by_distance: goalie / player_id full_name distance / zone_code = 'O'
q014_goalie_save_pct_by_period: goalie / player_id full_name period / true
q015_goalie_save_pct_by_shot_type: goalie / player_id full_name shot_type / shot_type IS NOT NULL
q016_goalie_save_pct_by_situation: goalie / player_id full_name situation / true
q017_goalie_save_pct_vs_opponent: goalie / player_id full_name opponent / true
q050_player_goals_by_shot_type: player / shot_type / on_net AND shot_type IS NOT NULL
q076_player_shooting_pct_by_distance: player / distance / on_net AND zone_code = 'O'
q078_player_shooting_by_period: player / period / true
q079_player_shooting_by_strength: player / strength / true
q081_player_shot_accuracy_by_shot_type: accuracy / shot_type / NOT blocked AND shot_type IS NOT NULL
q083_player_shot_type_mix: player / player_id full_name shot_type / on_net AND shot_type IS NOT NULL
""")
