from pyspark.sql import functions as F

from dayloom.functions import weights as wt

# Expected table of the cumulative weight W(0..17).
W_TABLE = [0, 0.5, 0.75, 1, 1.25, 1.375, 1.5, 1.625, 1.6875, 1.75, 1.8125, 1.875,
           1.90625, 1.9375, 1.96875, 2, 2.03125, 2.0625]


def test_cumulative_table():
    assert list(wt.CUMULATIVE_WEIGHTS) == W_TABLE


def test_step_weights_python():
    expect = {16: .5, 15: .25, 13: .25, 12: .125, 10: .125, 9: 1 / 16, 6: 1 / 16, 5: 1 / 32, 1: 1 / 32}
    for d, w in expect.items():
        assert wt.step_weight_value(d) == w


def test_step_and_cumulative_columns(spark):
    df = spark.range(0, 18).select(F.col("id").cast("int").alias("d"))
    rows = df.select("d", wt.step_weight(F.col("d")).alias("sw"),
                     wt.cumulative_weight(F.col("d")).alias("cw")).collect()
    for r in rows:
        assert r.cw == W_TABLE[r.d]
        if r.d >= 1:
            assert r.sw == wt.step_weight_value(r.d)


def test_age_and_caps(spark):
    df = spark.createDataFrame([(1, 16), (16, 16), (5, 23), (23, 23)], "rd int, fe int")
    ages = [r.a for r in df.select(wt.registration_age(F.col("rd"), F.col("fe")).alias("a")).collect()]
    assert ages == [16, 1, 17, 1]
    r = spark.range(1).select(wt.age_cap(F.lit(5), 2).alias("c"),
                              wt.weight_cap(F.lit(2.0), 4).alias("wc"),
                              wt.rate(F.lit(1), F.lit(0)).alias("z")).first()
    assert (r.c, r.wc, r.z) == (2, 1.25, None)
