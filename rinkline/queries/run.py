"""The parameterised queries as DataFrames.

Every function takes a League and keyword filters (team, season, game_type,
player); thresholds and top_n are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinkline.functions.columns import distance_bucket, period_label, position_group
from rinkline.operators import blocks, gold
from rinkline.operators.measures import DERIVED, ROLE_MEASURES, TEAM_DERIVED, TEAM_MEASURES, ratio, share
from rinkline.operators.ordering import row_numbers
from rinkline.queries import specs
from rinkline.sources.derived import League

TOP_N = 25
STATS = [*ROLE_MEASURES, "pim"]
TEAM_STATS = [*TEAM_MEASURES, "pim", "opp_pim"]


def leaderboard(df: DataFrame, order: list[Column], top_n: int | None = TOP_N) -> DataFrame:
    """Numbers the first top_n rows; the order must be total. Sorting and the cut happen before the one-task window; without a cut (None) all rows are numbered, by ranges."""
    if top_n is None:
        return row_numbers(df, order, "rank").withColumn("rank", F.col("rank").cast("int"))
    first = df.orderBy(*order).limit(top_n)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _cols(names: str, derived: dict[str, str]) -> list[Column]:
    return [F.expr(derived.get(n, n)).alias(n) for n in names.split()]


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of rows, of which there is one per player and game; the number of players only where it is no key."""
    players = [] if "player_id" in keys else [F.countDistinct("player_id").alias("players")]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("games_played"),
        *players,
        F.max_by("position_code", F.struct("game_date", "game_id")).alias("position"),
        *(F.sum(n).alias(n) for n in STATS),
    )


def skaters(t: League, **filters) -> DataFrame:
    rows = blocks.with_stats(blocks.player_games(t, **filters), blocks.player_stats(blocks.narrowed(t, **({"game_type": 2} | filters))))
    return rows.withColumns({
        "day_num": F.dayofweek("game_date"), "day_name": F.date_format("game_date", "EEEE"), "month": F.date_format("game_date", "yyyy-MM"),
        "position_group": position_group(F.col("position_code")), "forward_or_defense": position_group(F.col("position_code"), coarse=True),
    })


def minimums(filters: dict, least: dict[str, int]) -> tuple[dict[str, int], dict]:
    """The least values, with those of filters named min_<measure> in their stead, and the other filters."""
    given = {k.removeprefix("min_"): v for k, v in filters.items() if k.startswith("min_")}
    given = {"shot_attempts" if k == "attempts" else k: v for k, v in given.items()}
    return least | given, {k: v for k, v in filters.items() if not k.startswith("min_")}


def player_leaderboard(t: League, columns: str, order: str, least: dict[str, int], position: str | None = None, min_games: int = 10, top_n: int | None = TOP_N, **filters) -> DataFrame:
    """The first top_n players by order, or all (None). min_<measure> sets a least value."""
    least, filters = minimums(filters, least)
    sums = _summed(skaters(t, position=position, **filters), ["full_name", "player_id"]).where(F.col("games_played") >= min_games)
    for name, value in least.items():
        sums = sums.where(F.expr(DERIVED.get(name, name)) >= value)
    rows = sums.select("full_name", "position", "games_played", "player_id", *_cols(columns, DERIVED), *(F.expr(DERIVED.get(n, n)).alias(f"by_{n}") for n in order.split()))
    keys = [F.col(f"by_{n}").desc_nulls_last() for n in order.split()]
    return leaderboard(rows, [*keys, F.col("player_id")], top_n).drop(*(f"by_{n}" for n in order.split()))


def player_split(t: League, keys: str, columns: str, **filters) -> DataFrame:
    sums = _summed(skaters(t, **filters), ["full_name", "player_id", *keys.split()])
    return sums.select("full_name", "player_id", *keys.split(), "games_played", *_cols(columns, DERIVED))


def head_to_head(t: League, players: tuple[str, str], columns: str, player_a: str | None = None, player_b: str | None = None, **filters) -> DataFrame:
    """Two players side by side; player_a and player_b stand in for those of players."""
    names = [given or usual for given, usual in zip((player_a, player_b), players)]
    rows = skaters(t, **filters).where(F.lower("full_name").isin(*(p.lower() for p in names)))
    return _summed(rows, ["full_name", "player_id"]).select("full_name", "position", "games_played", "player_id", *_cols(columns, DERIVED))


def all_time(t: League, columns: str, order: str, least: dict[str, int], top_n: int = TOP_N, **filters) -> DataFrame:
    """A leaderboard over all plays, the shootout's too, without rosters; names and positions are the players' newest."""
    least, filters = minimums(filters, least)
    sums = blocks.player_stats(blocks.narrowed(t, **filters), shootout=True).groupBy("player_id").agg(*(F.sum(n).alias(n) for n in STATS))
    for name, value in least.items():
        sums = sums.where(F.expr(DERIVED.get(name, name)) >= value)
    by = {f"by_{n}": F.expr(DERIVED.get(n, n)) for n in order.split()}
    rows = sums.select("player_id", *_cols(columns, DERIVED), *(c.alias(n) for n, c in by.items()))
    first = leaderboard(rows, [*(F.col(n).desc_nulls_last() for n in by), F.col("player_id")], top_n).drop(*by)
    return first.join(gold.dim_player(gold.roster_spots(t)).select("player_id", "full_name", F.col("position_code").alias("position")), "player_id", "left")


def goals_by_period_and_type(t: League, **filters) -> DataFrame:
    plays = t.plays.join(blocks.narrowed(t, **filters).games.select("game_id"), "game_id", "left_semi") if filters else t.plays
    return plays.where("type_desc_key = 'goal'").groupBy("period_number", "period_type").agg(F.count(F.lit(1)).alias("goals"))


def position_groups(t: League, keys: str, columns: str, selected: str = "T05", **filters) -> DataFrame:
    """Skaters by position group. selected: the team that `scope`, where it is a key, sets against the rest of the league."""
    rows = skaters(t, **filters).withColumn("scope", F.when(F.col("team") == selected, "Team").otherwise("Rest of league"))
    return _summed(rows, keys.split()).select(*keys.split(), "players", "games_played", *_cols(columns, DERIVED))


def team_rows(t: League, selected: str = "T05", **filters) -> DataFrame:
    """One row per team and game, with what team tables group by. selected: as in position_groups."""
    rows = blocks.team_game_stats(t, **filters)
    gap = F.abs(F.col("score_for") - F.col("score_against"))
    versus = lambda a, b, what: F.when(F.col(a) > F.col(b), f"1) More {what}").when(F.col(a) == F.col(b), f"2) Equal {what}").otherwise(f"3) Fewer {what}")
    return rows.withColumns({
        "day_num": F.dayofweek("game_date"), "day_name": F.date_format("game_date", "EEEE"), "month": F.date_format("game_date", "yyyy-MM"),
        "margin": F.when(gap == 1, "1) One goal").when(gap == 2, "2) Two goals").otherwise("3) Three or more"),
        "shots_vs_opponent": versus("sf", "sa", "shots"), "hits_vs_opponent": versus("hits_for", "hits_against", "hits"), "attempts_vs_opponent": versus("cf", "ca", "attempts"),
        "scope": F.when(F.col("team") == selected, "Team").otherwise("Rest of league"),
    })


def _records(rows: DataFrame, keys: list[str]) -> DataFrame:
    won = lambda r: F.count_if(F.col("result") == r)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("games"), won("W").alias("wins"), won("L").alias("losses"), won("OTL").alias("ot_losses"), *(F.sum(n).alias(n) for n in TEAM_STATS))


def team_table(t: League, keys: str, columns: str, **filters) -> DataFrame:
    return _records(team_rows(t, **filters), keys.split()).select(*keys.split(), *_cols(columns, TEAM_DERIVED))


def shot_table(t: League, what: str, keys: str, condition: str, **filters) -> DataFrame:
    """Shots by keys (what: goalie, player, or accuracy for shares on net only). For goalies: shots faced, goals, saves, save percentage; for players: attempts, shots on net, goals, percentages, share of goals."""
    rows = blocks.goalie_shots(t, **filters) if what == "goalie" else blocks.player_shots(t, **filters)
    rows = rows.where(condition).withColumns({
        "distance": distance_bucket(F.col("distance_ft")), "period": period_label(F.col("period_number"), F.col("period_type")),
        "situation": F.when(F.col("strength") == "PP", "Penalty kill").when(F.col("strength") == "SH", "Team on power play").otherwise("Even strength"),
    })
    by = rows.groupBy(*keys.split())
    if what == "goalie":
        sums = by.agg(F.countDistinct("game_id").alias("games"), F.count(F.lit(1)).alias("shots_faced"), F.count_if("is_goal").alias("goals_against"))
        return sums.select(*keys.split(), "games", "shots_faced", "goals_against", F.expr("shots_faced - goals_against").alias("saves"), F.expr(ratio("shots_faced - goals_against", "shots_faced", 1, 3)).alias("save_pct"))
    sums = by.agg(F.count(F.lit(1)).alias("shot_attempts"), F.count_if("on_net").alias("shots"), F.count_if("is_goal").alias("goals"))
    whole = Window.partitionBy("player_id") if "player_id" in keys.split() else Window.partitionBy()
    sums = sums.withColumns({"all_goals": F.sum("goals").over(whole), "all_shots": F.sum("shots").over(whole)})
    if what == "accuracy":
        return sums.select(*keys.split(), F.col("shot_attempts").alias("unblocked_attempts"), F.col("shots").alias("shots_on_net"), F.expr(share("shots", "shot_attempts")).alias("on_net_pct"), "goals")
    return sums.select(*keys.split(), "shot_attempts", "shots", "goals", F.expr(share("goals", "shots")).alias("shooting_pct"), F.expr(share("shots", "shot_attempts")).alias("shots_on_net_pct"), F.expr(share("goals", "all_goals")).alias("share_of_goals_pct"), F.expr(share("shots", "all_shots")).alias("share_of_shots_pct"))


def _choosing(filters: dict, keys: str) -> dict:
    """Where a question compares one team with the rest, `team` names it and leaves out no one."""
    return {"selected" if k == "team" and "scope" in keys.split() else k: v for k, v in filters.items()}


def by_name() -> dict:
    """Every specified query: name to a function of a League and filters."""
    out = {}
    for n, (columns, order, least, position) in specs.LEADERBOARDS.items():
        games = 1 if "_league_" in n else 10
        out[n] = lambda t, c=columns, o=order, l=least, p=position, g=games, **f: player_leaderboard(t, c, o, l, **({"position": p, "min_games": g} | f))
    name, players, columns = specs.HEAD_TO_HEAD
    out[name] = lambda t, p=players, c=columns, **f: head_to_head(t, p, c, **f)
    for n, (columns, order, least) in specs.ALL_TIME.items():
        out[n] = lambda t, c=columns, o=order, l=least, **f: all_time(t, c, o, l, **f)
    out["n13_goals_by_period_and_type"] = goals_by_period_and_type
    for n, (keys, columns) in specs.SPLITS.items():
        out[n] = lambda t, k=keys, c=columns, **f: player_split(t, k, c, **f)
    for n, (keys, columns) in specs.GROUPS.items():
        out[n] = lambda t, k=keys, c=columns, **f: position_groups(t, k, c, **_choosing(f, k))
    for n, (keys, columns) in specs.TEAMS.items():
        out[n] = lambda t, k=keys, c=columns, **f: team_table(t, k, c, **_choosing(f, k))
    for n, (what, keys, condition) in specs.SHOTS.items():
        out[n] = lambda t, w=what, k=keys, c=condition, **f: shot_table(t, w, k, c, **f)
    return out


def registered() -> dict:
    """by_name() as it is registered: with minimums that the small tables reach, and again with the usual ones where they differ."""
    out = {}
    for name, query in by_name().items():
        small = ({"min_games": 1} if name in specs.LEADERBOARDS else {}) | specs.SMALL.get(name, {})
        out[name] = (lambda t, q=query, s=small, **f: q(t, **(s | f))) if small else query
        if name in specs.SMALL:
            out[f"{name}_usual"] = query
        if name in specs.FILTERED:
            out[f"{name}_filtered"] = lambda t, q=query, s=small | specs.FILTERED[name]: q(t, **s)
    return out
