"""Study-design operators."""

import pytest
from pyspark.sql import functions as F

from ionframe.functions.constants import TMT11_CHANNELS
from ionframe.functions.expressions import suffix_expression
from ionframe.operators import design


def test_find_channel_column_worked_examples():
    assert design.find_channel_column(["tmt_channel", "a", "b", "c"]) == "tmt_channel"
    with pytest.raises(ValueError, match="several channel columns"):
        design.find_channel_column(["tmt_channel", "tmt11_channel"])
    with pytest.raises(ValueError, match="no tmt_channel"):
        design.find_channel_column(["a", "b"])


def test_check_channels_reports_missing_extra_duplicates(spark):
    rows = [("S1", c, f"v{c}") for c in TMT11_CHANNELS]
    rows += [("S2", c, f"w{c}") for c in TMT11_CHANNELS if c != "131C"] + [("S2", "132N", "x"), ("S2", "126C", "y")]
    df = spark.createDataFrame(rows, "tmt_plex string, tmt11_channel string, vial_label string")
    out = {r["tmt_plex"]: r for r in design.check_channels(df, TMT11_CHANNELS).collect()}
    assert out["S1"]["ok"] and out["S1"]["missing"] == [] and out["S1"]["extra"] == []
    assert out["S2"]["missing"] == ["131C"] and out["S2"]["extra"] == ["132N"]
    assert out["S2"]["n_duplicates"] == 1 and not out["S2"]["ok"]


def test_make_unique_follows_r(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a.1"), (4, "b"), (5, "a")], "o long, v string")
    got = [r["v"] for r in design.make_unique(df, "v", ["o"]).orderBy("o").collect()]
    assert got == ["a", "a.2", "a.1", "b", "a.3"]


def test_stack_normalize_samples_references(spark):
    rows = [("f2", "126C", "Ref pool"), ("f2", "127N", "s 1"), ("f1", "126C", "reference"), ("f1", "127N", "s1"),
            ("f1", "127C", "s1")]
    df = spark.createDataFrame(rows, "path string, tmt11_channel string, vial_label string")
    v = design.normalize_labels(design.stack_vials(df, "path"))
    v = design.make_unique(v, "vial_label", ["tmt11_channel", "tmt_plex"], bounded=True)
    smp = design.build_samples(v, "tmt11_channel")
    got = sorted(tuple(r) for r in smp.collect())
    assert got == [("S1", 1, "126", "Ref_S1", None), ("S1", 1, "127C", "s1", "s1"),
                   ("S1", 1, "127N", "s1.1", "s1.1"), ("S2", 1, "126", "Ref_S2", None),
                   ("S2", 1, "127N", "s1.2", "s1.2")]
    refs = sorted(tuple(r) for r in design.build_references(smp).collect())
    assert refs == [("S1", 1, "Ref_S1"), ("S2", 1, "Ref_S2")]


def test_references_constant_once_per_plex(spark):
    smp = spark.createDataFrame([("S1", 1, "126", "a", "a"), ("S1", 1, "127N", "b", "b")],
                                "PlexID string, QuantBlock int, ReporterName string, ReporterAlias string, "
                                "MeasurementName string")
    assert [tuple(r) for r in design.build_references(smp).collect()] == [("S1", 1, "1")]


def test_fractions_strip_raw_anchored(spark):
    files = spark.createDataFrame([("/d/01/a.raw", "/d/01"), ("/d/01/b.RAW", "/d/01"), ("/d/02/xraw_c.raw", "/d/02")],
                                  "path string, folder string")
    got = sorted(tuple(r) for r in design.build_fractions(files, "path", "folder").collect())
    assert got == [("a", "S1"), ("b", "S1"), ("xraw_c", "S2")]


def test_suffix_expression(spark):
    df = spark.createDataFrame([("(Ref_S1 + Ref_S1.1)/2",), ("mean(a, b.2) * 1e5",), ("1",)], "e string")
    got = [r[0] for r in df.select(suffix_expression(F.col("e"), F.lit("1A"))).collect()]
    assert got == ["(Ref_S1_1A+Ref_S1.1_1A)/2", "mean(a_1A,b.2_1A)*1e5", "1"]


def test_combine_of_one_pass_is_suffix_only(spark):
    smp = spark.createDataFrame([("S1", "a", "a", 1), ("S1", "Ref_S1", None, 2)],
                                "PlexID string, ReporterAlias string, MeasurementName string, o long")
    out = design.combine_designs({"1A": smp}, ["o"]).orderBy("o")
    got = [(r["PlexID"], r["ReporterAlias"], r["MeasurementName"]) for r in out.collect()]
    assert got == [("S1_1A", "a_1A", "a_1A"), ("S1_1A", "Ref_S1_1A", None)]


def test_check_plex_ids(spark):
    a = spark.createDataFrame([("S1",), ("S2",)], "p string")
    b = spark.createDataFrame([("S1",)], "q string")
    got = {r["PlexID"]: r["ok"] for r in design.check_plex_ids({"a": (a, "p"), "b": (b, "q")}).collect()}
    assert got == {"S1": True, "S2": False}


def test_parse_batch_path(spark):
    df = spark.createDataFrame([("/x/PN/BATCH1_20200101/PROT_PH/raw/file.raw",)], "p string")
    r = df.select(design.parse_batch_path(F.col("p")).alias("x")).first()["x"]
    assert (r["batch"], r["assay"], r["site"], r["file_name"]) == ("BATCH1_20200101", "PH", "PN", "file.raw")
