"""Bucketed running aggregates equal plain window results, also with a hot key."""

import random

import pandas as pd
from pyspark.sql import functions as F

from ionframe.operators import ordered


def test_running_sum_and_row_number_with_hot_group(spark):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 6), rnd.randint(0, 50), i, rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, o int, tb int, v double")
    out = ordered.running_agg(df, "o", {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")),
                                        "rn": ("sum", F.lit(1))},
                              partition_by=["g"], tiebreak=["tb"]).toPandas()
    p = pd.DataFrame(rows, columns=["g", "o", "tb", "v"]).sort_values(["g", "o", "tb"])
    p["s"] = p.groupby("g")["v"].cumsum()
    p["mx"] = p.groupby("g")["v"].cummax()
    p["rn"] = p.groupby("g").cumcount() + 1
    m = out.merge(p, on=["g", "o", "tb"], suffixes=("", "_e"))
    assert len(m) == len(rows)
    assert (m["s"] - m["s_e"]).abs().max() < 1e-9
    assert (m["mx"] == m["mx_e"]).all() and (m["rn"] == m["rn_e"]).all()


def test_descending_global_order(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 3, 9, 1, 7]], "x double")
    out = sorted(tuple(r) for r in ordered.row_number(df, "x", descending=True).collect())
    assert out == [(1.0, 5), (3.0, 4), (5.0, 3), (7.0, 2), (9.0, 1)]


def test_exact_quantile_matches_pandas(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 3), rnd.uniform(-5, 5)) for _ in range(999)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["quantile"] for r in ordered.exact_quantile(df, ["g"], "v", 0.5).collect()}
    exp = pd.DataFrame(rows, columns=["g", "v"]).groupby("g")["v"].median().to_dict()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "g string, v double")
    got = sorted((r["g"] or "", r["rn"]) for r in ordered.row_number(df, "v", ["g"]).collect())
    assert got == [("", 1), ("", 2), ("a", 1)]


def test_equal_values_spread_over_ranges(spark):
    df = spark.range(20_000).select(F.lit(0.0).alias("x"), F.lit("hot").alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges so small would be put together
    try:
        b = ordered.bucketed(df, "x", ["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in b.groupBy(ordered.BUCKET).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000
    rn = [r["rn"] for r in ordered.row_number(df, "x", ["g"]).select("rn").collect()]
    assert sorted(rn) == list(range(1, 20_001))


def test_any_sortable_type_orders(spark):
    words = ["pear", "apple", "fig", None, "Apple", "zoo"]
    got = {r["w"]: r["rn"] for r in ordered.row_number(spark.createDataFrame([(w,) for w in words], "w string"), "w").collect()}
    assert got == {None: 1, "Apple": 2, "apple": 3, "fig": 4, "pear": 5, "zoo": 6}
    big = [2**53 + i for i in range(6)]
    got = {r["x"]: r["rn"] for r in ordered.row_number(spark.createDataFrame([(x,) for x in big], "x long"), "x", descending=True).collect()}
    assert got == {x: 6 - i for i, x in enumerate(big)}


def test_backwards_pass_reuses_the_ranges(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 3), rnd.randint(0, 40), i, rnd.random()) for i in range(2000)]
    b = ordered.bucketed(spark.createDataFrame(rows, "g int, o int, tb int, v double"), "o", ["g"], ["tb"], descending=True)
    out = ordered.plain(ordered.running(b, {"m": ("min", F.col("v"))}, ["g"], True, backwards=True)).toPandas()
    p = pd.DataFrame(rows, columns=["g", "o", "tb", "v"]).sort_values(["g", "o", "tb"], ascending=[True, True, False])
    p["m"] = p.groupby("g")["v"].cummin()
    m = out.merge(p, on=["g", "o", "tb"], suffixes=("", "_e"))
    assert len(m) == len(rows) and (m["m"] == m["m_e"]).all()
