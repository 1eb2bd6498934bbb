"""The measure catalogue: what is counted, and what is computed from the counts.

Every measure is text that Spark SQL and other engines read alike; ratios are
doubles, rounded half up by the same arithmetic everywhere, and null where the
divisor is zero.
"""

from __future__ import annotations

#: A player's measures: play type, role of the player, further condition.
ROLE_MEASURES = {
    "goals": ("goal", "scorer", ""),
    "primary_assists": ("goal", "assist1", ""),
    "secondary_assists": ("goal", "assist2", ""),
    "shots_saved": ("shot-on-goal", "shooter", ""),
    "missed_shots": ("missed-shot", "shooter", ""),
    "own_shots_blocked": ("blocked-shot", "shooter", ""),
    "blocked_shots": ("blocked-shot", "blocker", ""),
    "hits": ("hit", "hitter", ""),
    "hits_taken": ("hit", "hittee", ""),
    "faceoff_wins": ("faceoff", "winner", ""),
    "faceoff_losses": ("faceoff", "loser", ""),
    "penalties_taken": ("penalty", "committed", ""),
    "penalties_drawn": ("penalty", "drawn", ""),
    "fights": ("penalty", "committed", "penalty_desc_key = 'fighting'"),
    "takeaways": ("takeaway", "player", ""),
    "giveaways": ("giveaway", "player", ""),
    "p1_goals": ("goal", "scorer", "period_number = 1"),
    "p2_goals": ("goal", "scorer", "period_number = 2"),
    "p3_goals": ("goal", "scorer", "period_number = 3 and period_type = 'REG'"),
    "ot_goals": ("goal", "scorer", "period_type = 'OT'"),
    "late_goals": ("goal", "scorer", "period_number = 3 and period_type = 'REG' and time_in_period >= '15:00'"),
    "late_assists": ("goal", "assist", "period_number = 3 and period_type = 'REG' and time_in_period >= '15:00'"),
    **{f"{s.lower()}_goals": ("goal", "scorer", f"strength = '{s}'") for s in ("EV", "PP", "SH", "EN")},
    **{f"{s.lower()}_assists": ("goal", "assist", f"strength = '{s}'") for s in ("EV", "PP", "SH")},
}

#: A team's measures: condition on a play as one team sees it (side is `for` or `against`).
_SHOTS, _UNBLOCKED, _ON = "'goal', 'shot-on-goal', 'missed-shot', 'blocked-shot'", "'goal', 'shot-on-goal', 'missed-shot'", "'goal', 'shot-on-goal'"


def _sides(own: str, other: str, condition: str) -> dict[str, str]:
    return {own: f"{condition} and side = 'for'", other: f"{condition} and side = 'against'"}


def _is(kind: str) -> str:
    return f"type_desc_key = '{kind}'"


TEAM_MEASURES = {
    **_sides("gf", "ga", _is("goal")),
    **_sides("sf", "sa", f"type_desc_key in ({_ON})"),
    **_sides("cf", "ca", f"type_desc_key in ({_SHOTS})"),
    **_sides("ff", "fa", f"type_desc_key in ({_UNBLOCKED})"),
    **_sides("hits_for", "hits_against", _is("hit")),
    **_sides("fo_wins", "fo_losses", _is("faceoff")),
    **_sides("penalties", "opp_penalties", _is("penalty")),
    **_sides("takeaways", "opp_takeaways", _is("takeaway")),
    **_sides("giveaways", "opp_giveaways", _is("giveaway")),
    **_sides("minors_taken", "minors_drawn", _is("penalty") + " and penalty_type_code in ('MIN', 'BEN')"),
    **{k: v for s in ("ev", "pp", "sh", "en") for k, v in _sides(f"{s}_gf", f"{s}_ga", _is("goal") + f" and strength = '{s.upper()}'").items()},
    "blocks_for": _is("blocked-shot") + " and blocker_team_id = team_id",
    "blocks_against": _is("blocked-shot") + " and blocker_team_id <> team_id",
}


def ratio(over: str, under: str, scale: int = 1, digits: int = 2) -> str:
    return f"floor({scale}e0 * ({over}) * {10**digits} / nullif({under}, 0) + 0.5e0) / {10**digits}e0"


def share(over: str, under: str) -> str:
    return ratio(over, under, 100, 1)


#: Sums and differences of measures.
SUMS = {
    "assists": "primary_assists + secondary_assists",
    "shots": "goals + shots_saved",
    "shot_attempts": "goals + shots_saved + missed_shots + own_shots_blocked",
    "points": "goals + primary_assists + secondary_assists",
    "primary_points": "goals + primary_assists",
    "ev_points": "ev_goals + ev_assists",
    "pp_points": "pp_goals + pp_assists",
    "sh_points": "sh_goals + sh_assists",
    "late_points": "late_goals + late_assists",
    "hit_diff": "hits - hits_taken",
    "penalty_diff": "penalties_taken - penalties_drawn",
    "net_penalties": "penalties_drawn - penalties_taken",
    "faceoffs": "faceoff_wins + faceoff_losses",
    "takeaway_giveaway_diff": "takeaways - giveaways",
    "physical": "hits + blocked_shots",
}
_PER_GAME = ("points", "goals", "assists", "shots", "shot_attempts", "hits", "hits_taken", "takeaways", "giveaways", "pim", "missed_shots")


def _of(name: str) -> str:
    return f"({SUMS[name]})" if name in SUMS else name


DERIVED = SUMS | {
    **{f"{n}_per_game": ratio(_of(n), "games_played") for n in _PER_GAME},
    "blocks_per_game": ratio("blocked_shots", "games_played"),
    "shooting_pct": share("goals", _of("shots")),
    "shots_on_net_pct": share(_of("shots"), _of("shot_attempts")),
    "goals_per_attempt_pct": share("goals", _of("shot_attempts")),
    "missed_pct": share("missed_shots", _of("shot_attempts")),
    "blocked_by_opp_pct": share("own_shots_blocked", _of("shot_attempts")),
    "faceoff_pct": share("faceoff_wins", _of("faceoffs")),
    "pp_share_of_points_pct": share(_of("pp_points"), _of("points")),
    "takeaway_giveaway_ratio": ratio("takeaways", "giveaways"),
}

TEAM_DERIVED = {
    "points": "2 * wins + ot_losses",
    "win_pct": share("wins", "games"),
    "goal_diff": "gf - ga",
    "goals_for": "gf", "goals_against": "ga", "shots_for": "sf", "shots_against": "sa", "attempts_for": "cf", "attempts_against": "ca",
    "unblocked_for": "ff", "unblocked_against": "fa", "faceoff_wins": "fo_wins", "faceoff_losses": "fo_losses",
    "goals_for_per_game": ratio("gf", "games"), "goals_against_per_game": ratio("ga", "games"),
    "shots_for_per_game": ratio("sf", "games"), "shots_against_per_game": ratio("sa", "games"), "shot_diff_per_game": ratio("sf - sa", "games"),
    "attempts_for_per_game": ratio("cf", "games"), "attempts_against_per_game": ratio("ca", "games"),
    "shooting_pct": share("gf", "sf"), "save_pct": ratio("sa - ga", "sa", 1, 3), "pdo": ratio("1e0 * gf / nullif(sf, 0) + 1e0 * (sa - ga) / nullif(sa, 0)", "1", 100, 1),
    "attempt_share_pct": share("cf", "cf + ca"), "unblocked_share_pct": share("ff", "ff + fa"), "faceoff_pct": share("fo_wins", "fo_wins + fo_losses"),
    "hits": "hits_for", "hits_taken": "hits_against", "hits_per_game": ratio("hits_for", "games"), "hits_taken_per_game": ratio("hits_against", "games"),
    "blocks": "blocks_for", "blocks_per_game": ratio("blocks_for", "games"), "shots_blocked_by_opponents": "blocks_against",
    "penalties_taken": "penalties", "penalties_drawn": "opp_penalties", "pim_per_game": ratio("pim", "games"), "opp_pim_per_game": ratio("opp_pim", "games"),
    "diff": "takeaways - giveaways", "team_games": "games",
    **{f"{s}_for": f"{s}_gf" for s in ("ev", "pp", "sh", "en")}, **{f"{s}_against": f"{s}_ga" for s in ("ev", "pp", "sh", "en")},
    "pp_goals": "pp_gf", "pp_goals_against": "pp_ga", "shorthanded_goals_for": "sh_gf", "shorthanded_goals_against": "sh_ga",
    "pp_goals_per_minor_pct": share("pp_gf", "minors_drawn"), "pk_success_approx_pct": share("minors_taken - pp_ga", "minors_taken"),
}
