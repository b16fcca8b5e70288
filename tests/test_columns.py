import math
import random

from pyspark.sql import functions as F

from panelcast.functions.columns import cents, round_whole


def test_cents_are_those_of_round_without_its_decimal_text(spark):
    rng = random.Random(3)
    rows = [None, 0.0, -0.0, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5, 9007199254740993.0, 1.005, 2.675, -2.675]
    rows += [k + 0.5 for k in range(-300, 300)] + [math.nextafter(k + 0.5, d) for k in range(-300, 300) for d in (-1e9, 1e9)]
    rows += [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [rng.randint(-10**7, 10**7) / 1000 for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    off = df.where(~F.round("x").eqNullSafe(round_whole("x"))
                   | ~F.round(F.col("x") * 100).cast("decimal(30,0)").eqNullSafe(round_whole(F.col("x") * 100).cast("decimal(30,0)")))
    assert off.count() == 0
    plan = df.select(cents("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "rint(" in plan and "round(" not in plan
    odd = spark.createDataFrame([(float("nan"),), (math.inf,), (-math.inf,)], "x double").select(round_whole("x")).collect()
    assert math.isnan(odd[0][0]) and odd[1][0] == math.inf and odd[2][0] == -math.inf
