import numpy as np

from ionframe.llm import ann, queries
from tests.llm import cases


def brute(ids, x, k=5):
    u = cases.unit(x)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = u @ u[i]
        other = np.flatnonzero(ids != ids[i])
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in other[np.lexsort((ids[other], -s[other]))][:k]]
    return out


def check(rows, want, recall):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for q, best in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        assert all(a[2] >= b[2] - 1e-12 for a, b in zip(mine, mine[1:]))
        hits += len({i for _, i, _ in mine} & {i for i, _ in best})
        total += len(best)
    assert set(got) == set(want) and hits >= recall * total


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    df = queries.QUERIES["op9_ann"](spark, sf)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    check(df.collect(), brute(t["vec_id"].to_numpy(), np.stack(t["embedding"])), 0.9)


def test_cells_chunks_blocks_and_copies(spark):
    r = np.random.default_rng(5)
    centres = r.normal(size=(20, 16))
    x = (centres[r.integers(0, 20, 3000)] + 0.3 * r.normal(size=(3000, 16))).astype(np.float32)
    x[500:1500] = x[500]
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id % 50 = 0"), cell_rows=150, fit_rows=500, query_rows=7).collect()
    want = brute(ids, x)
    check(got, {q: b for q, b in want.items()}, 0.9)
    mine = [g.vec_id for g in sorted((g for g in got if g.query_id == 1000), key=lambda g: g.rank)]
    assert mine == [500, 501, 502, 503, 504]


def test_copies_in_repeated_rows(spark):
    """Every row of a group of copies comes again and again; each id still takes one place."""
    rows = [(10 * i, [1.0, 2.0]) for i in range(1, 10) for _ in range(6)] + [(i, [2.0, 1.0 + i / 9]) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for table in (df, df.unionByName(df)):
        got = ann.nearest(table, table.where("vec_id in (10, 90)")).collect()
        assert {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (10, 90)} == {
            10: [20, 30, 40, 50, 60], 90: [10, 20, 30, 40, 50]}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (50, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [1.0, 1.0]), (None, [1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (8, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 6, 0.707107), (0, 3, 100, 0.0), (100, 1, 6, 0.707107), (100, 2, 0, 0.0), (100, 3, 1, 0.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0


def test_chi_square():
    assert abs(ann.chi2_cdf(15.507, 8) - 0.95) < 1e-3 and abs(ann.chi2_quantile(0.95, 8) - 15.507) < 1e-2
