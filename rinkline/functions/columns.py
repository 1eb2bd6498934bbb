"""Column functions of the hockey model: strength, results, distances, labels, standings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Position codes that a position filter stands for.
POSITIONS = {"F": ("C", "L", "R"), "W": ("L", "R")}
SHOT_TYPES = ("goal", "shot-on-goal", "missed-shot", "blocked-shot")


def strength(situation: Column, owner_is_home: Column) -> Column:
    """EN, PP, SH or EV, seen from the owner. The code's digits: away goalie, away skaters, home skaters, home goalie; no code is EV, no owner counts as away."""
    seen = F.when(F.coalesce(owner_is_home, F.lit(False)), situation).otherwise(F.reverse(situation))
    digit = lambda n: F.substring(seen, n, 1)
    return (
        F.when(digit(1) == "0", "EN")
        .when((digit(3) > digit(2)) & (digit(4) == "1"), "PP")
        .when(digit(3) < digit(2), "SH")
        .otherwise("EV")
    )


def result(own: Column, other: Column, game_type: Column, last_period: Column) -> Column:
    """W, OTL (regular season, decided after regulation) or L; ties and unfinished games are L."""
    return F.when(own > other, "W").when((game_type == 2) & last_period.isin("OT", "SO"), "OTL").otherwise("L")


def distance(x: Column, y: Column) -> Column:
    return F.sqrt((89 - F.abs(x)) * (89 - F.abs(x)) + y * y)


def distance_bucket(feet: Column) -> Column:
    """An unknown distance lies in the last bucket."""
    return F.when(feet < 15, "1) 0-14 ft").when(feet < 30, "2) 15-29 ft").when(feet < 45, "3) 30-44 ft").otherwise("4) 45+ ft")


def period_label(number: Column, kind: Column) -> Column:
    """OT and SO by name, others by number."""
    return F.when(kind.isin("OT", "SO"), kind).otherwise(number.cast("string"))


def position_group(code: Column, coarse: bool = False) -> Column:
    if coarse:
        return F.when(code == "D", "Defense").otherwise("Forwards")
    return F.when(code == "C", "Centers").when(code == "L", "Left wings").when(code == "R", "Right wings").otherwise("Defense")


def is_position(code: Column, wanted: str) -> Column:
    return code.isin(*POSITIONS.get(wanted, (wanted,)))


def seconds(clock: Column) -> Column:
    """Seconds of an MM:SS text."""
    return F.split_part(clock, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(clock, F.lit(":"), F.lit(2)).cast("int")
