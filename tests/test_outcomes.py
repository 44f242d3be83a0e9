from pyspark.sql import functions as F

from tallyplane.functions import outcomes as O


def test_names_and_ranges(spark):
    df = spark.createDataFrame([("HR",), ("Heart rate (bpm)",), ("mean_arterial-pressure",), ("Mood",), ("n/a",), (None,)], "o string")
    assert [r[0] for r in df.select(O.canonical(F.col("o"))).collect()] == ["Heart rate", "Heart rate", "Mean arterial pressure", None, None, None]
    assert {r["o"]: (r["low"], r["high"]) for r in O.with_range(df, "o").collect()}["HR"] == (30.0, 220.0)
    own = spark.createDataFrame([("Mood", 0.0, 10.0)], "outcome string, low double, high double")
    assert {r["o"]: r["high"] for r in O.with_range(df, "o", own).collect()} == {"HR": None, "Heart rate (bpm)": None, "mean_arterial-pressure": None, "Mood": 10.0, "n/a": None, None: None}
    assert {(r["outcome"], r["n"]) for r in O.unranged(df, "o").collect()} == {("Mood", 1), ("n/a", 1), (None, 1)}


def test_group_labels(spark):
    df = spark.createDataFrame([("Responses in women and presyncopal men at baseline",)], "c string")
    assert df.select(O.without_group_labels(F.col("c"))).first()[0] == "Responses in and at"
