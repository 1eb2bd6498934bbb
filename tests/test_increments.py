"""Dimensions kept by increments equal those made at once, in any split of the days."""

import random

import pytest
from pyspark.sql import functions as F

from rinkline.operators import gold
from rinkline.sources import increments

SPOTS = "player_id long, game_id long, game_date date, team_id int, first_name string, last_name string, position_code string, sweater_number int"


def _spots(seed):
    import datetime

    draw = random.Random(seed)
    rows = []
    for game in range(60):
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=game // 2)
        for player in (1, 2, 3, None):
            if draw.random() < 0.8:
                team = draw.choice([5, 5, 6, None])
                rows.append((player, game, day if draw.random() < 0.97 else None, team, f"F{game % 7}", f"L{player}", draw.choice("CLR"), draw.randint(1, 99)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_stints_in_any_split(spark, tmp_path, seed):
    rows, draw = _spots(seed), random.Random(seed)
    store = increments.Stints(spark, f"file://{tmp_path}/stints", parts=2)
    frame = lambda part: spark.createDataFrame(part, SPOTS)
    night = {r: draw.randrange(4) if seed else r[1] // 15 for r in rows}  # any split, or one in the order of days
    for k in range(4):
        store.update(frame([r for r in rows if night[r] == k]))
        if k == 1:
            store.update(frame([r for r in rows if night[r] == 1]))  # a repeated night
    store.update(frame([]))
    want = gold.dim_player_team(frame([r for r in rows if r[0] is not None]))
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, want.collect()))


def test_a_lost_update_is_made_good(spark, tmp_path):
    """Lost after the days were appended and before the stints were written; and lost between partitions."""
    rows = [r for r in _spots(5) if r[0] is not None]
    frame = lambda part: spark.createDataFrame(part, SPOTS)
    store = increments.Stints(spark, f"file://{tmp_path}/stints", parts=2)
    store.update(frame([r for r in rows if r[1] < 30]))
    late = frame([r for r in rows if r[1] >= 30])
    days = gold.player_days(late).withColumn("part", F.pmod(F.xxhash64("player_id"), F.lit(2)).cast("int"))
    days.write.mode("append").partitionBy("part").parquet(f"{store.root}/days")
    store.update(late.where("player_id = 1"))
    store.update(late)
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, gold.dim_player_team(frame(rows)).collect()))


def test_newest_attributes_in_any_split(spark, tmp_path):
    rows, draw = [r for r in _spots(3) if r[2] is not None], random.Random(1)
    frame = lambda part: spark.createDataFrame(part, SPOTS)
    state = increments.players(spark, f"file://{tmp_path}/players")
    night = {r: draw.randrange(3) for r in rows}
    for k in (0, 1, 1, 2):
        got = state.update(frame([r for r in rows if night[r] == k]))
    want = gold.dim_player(frame([r for r in rows if r[0] is not None]))
    assert sorted(map(tuple, increments.dim_player(got).collect())) == sorted(map(tuple, want.select(*increments.dim_player(got).columns).collect()))
    last = max((r for r in rows if r[0] == 1), key=lambda r: (r[2], r[1]))
    corrected = state.update(frame([(*last[:4], "Corrected", *last[5:])]))
    assert increments.dim_player(corrected).where("player_id = 1").first().first_name == "Corrected"
