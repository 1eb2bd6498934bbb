"""Every branch of the column functions."""

from pyspark.sql import functions as F

from rinkline.functions import columns as c


def test_strength(spark):
    rows = [("1551", True, "EV"), ("1451", True, "PP"), ("1541", True, "SH"), ("1451", False, "SH"), ("0651", True, "EN"), ("1560", False, "EN"), (None, True, "EV"), ("1541", None, "PP")]
    df = spark.createDataFrame(rows, "s string, h boolean, want string")
    assert [r.got for r in df.select(c.strength(F.col("s"), F.col("h")).alias("got")).collect()] == [r[2] for r in rows]


def test_result_and_labels(spark):
    rows = [(3, 2, 2, "REG", "W"), (2, 3, 2, "OT", "OTL"), (2, 3, 2, "REG", "L"), (2, 3, 3, "OT", "L"), (2, 2, 1, None, "L")]
    df = spark.createDataFrame(rows, "a int, b int, g int, p string, want string")
    assert [r.got for r in df.select(c.result(F.col("a"), F.col("b"), F.col("g"), F.col("p")).alias("got")).collect()] == [r[4] for r in rows]
    feet = spark.createDataFrame([(14.9,), (29.0,), (44.0,), (45.0,), (None,)], "f double")
    assert [r[0][0] for r in feet.select(c.distance_bucket(F.col("f"))).collect()] == list("12344")
    assert spark.range(1).select(c.seconds(F.lit("15:07"))).first()[0] == 907
    assert [r[0] for r in spark.createDataFrame([("C",), ("D",), ("L",)], "p string").select(c.is_position(F.col("p"), "F")).collect()] == [True, False, True]
