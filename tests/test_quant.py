"""Quantification: references, ratios, crosstabs (SURVEY H)."""

import math

import pytest
from pyspark.sql import functions as F

from ionframe.functions.expressions import reference_sql
from ionframe.operators import quant


def test_reference_sql_whitelist():
    assert "try_element_at(m, 'Ref_S1')" in reference_sql("Ref_S1", "m")
    assert reference_sql("mean(a, b)", "m").count("try_element_at") == 2
    with pytest.raises(ValueError):
        reference_sql("system('x')", "m")
    with pytest.raises(ValueError):
        reference_sql("a; drop", "m")


def test_eval_reference_and_ratio_crosstab(spark):
    long = spark.createDataFrame([("p1", "S1", "126", 4.0), ("p1", "S1", "127N", 8.0), ("p1", "S1", "127C", 2.0),
                                  ("p1", "S2", "126", 0.0), ("p1", "S2", "127N", 5.0)],
                                 "feature string, plex string, channel string, intensity double")
    refs = spark.createDataFrame([("S1", "mean(126, 127C)"), ("S2", "126")], "PlexID string, Reference string")
    # channel names starting with digits are map keys, not numbers: quote via a rename
    long = long.withColumn("channel", F.concat(F.lit("c"), "channel"))
    refs = refs.withColumn("Reference", F.regexp_replace("Reference", r"\b(\d{3}[NC]?)\b", "c$1"))
    r = quant.eval_reference(long, refs, ["feature"], "plex", "channel")
    got = {(x["plex"], x["channel"]): x["log2_ratio"] for x in r.collect()}
    assert got[("S1", "c127N")] == pytest.approx(math.log2(8 / 3))
    assert got[("S2", "c127N")] is None  # zero reference
    samples = spark.createDataFrame([("S1", "c127N", "A"), ("S1", "c127C", "B"), ("S1", "c126", None)],
                                    "PlexID string, ReporterName string, MeasurementName string")
    ct = quant.ratio_crosstab(r, samples, ["feature"], "plex", "channel", digits=6)
    assert ct.columns == ["feature", "A", "B"]
    row = ct.first()
    assert row["A"] == pytest.approx(round(math.log2(8 / 3), 6))


def test_crosstab_round_trip(spark):
    long = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("y", "a", 3.0)], "f string, s string, v double")
    ct = quant.crosstab(long, ["f"], "s", "v", ["a", "b"])
    back = ct.unpivot(["f"], ["a", "b"], "s", "v").where("v is not null")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_reference_division_by_zero_channel_is_null(spark):
    long = spark.createDataFrame([("p1", "S1", "a", 4.0), ("p1", "S1", "b", 0.0)],
                                 "feature string, plex string, channel string, intensity double")
    refs = spark.createDataFrame([("S1", "a / b"), ], "PlexID string, Reference string")
    r = quant.eval_reference(long, refs, ["feature"], "plex", "channel").collect()
    assert all(x["reference_intensity"] is None and x["log2_ratio"] is None for x in r)
    assert reference_sql("-a + 2 * (b - 1) / mean(c, d)", "m").count("try_divide") == 1


def test_repeated_and_missing_channels(spark):
    rows = [("f", "S1", "a", 4.0), ("f", "S1", "a", 4.0), ("f", "S1", "b", 2.0), ("f", "S1", None, 9.0), ("g", "S1", None, 1.0), ("g", "S1", "b", None)]
    long = spark.createDataFrame(rows, "feature string, plex string, channel string, intensity double")
    refs = spark.createDataFrame([("S1", "b")], "PlexID string, Reference string")
    got = quant.eval_reference(long, refs, ["feature"], "plex", "channel").collect()
    assert sorted((r.feature, r.channel, r.intensity, r.log2_ratio) for r in got) == [("f", "a", 8.0, 2.0), ("f", "b", 2.0, 0.0), ("g", "b", None, None)]
