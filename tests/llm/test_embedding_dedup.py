import numpy as np
import pytest

from ionframe.llm import embedding_dedup as ed
from ionframe.llm import queries
from tests.llm import cases


def brute(ids, labels, x, threshold=0.98):
    u = cases.unit(x)
    near = (u @ u.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    root = cases.roots(len(ids), zip(*map(np.ndarray.tolist, np.nonzero(near))))
    least = {}
    for r, i in zip(root, ids.tolist()):
        least[r] = min(i, least.get(r, i))
    return sorted((i, int(n), least[r], i == least[r]) for i, n, r in zip(ids.tolist(), near.sum(axis=1), root))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    df = queries.QUERIES["op10_embedding_dedup"](spark, sf)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, df.collect())) == brute(t["vec_id"].to_numpy(), t["label"].to_numpy(), np.stack(t["embedding"]))


@pytest.mark.parametrize("chunk", [4096, 40])
def test_dense_groups_and_copies(spark, chunk):
    r = np.random.default_rng(6)
    x = np.concatenate([r.normal(size=(1, 32)) + s * r.normal(size=(n, 32)) for n, s in ((200, .05), (150, .12), (60, .2), (300, 1.5))])
    x[700:] = x[650]
    ids, labels = r.permutation(len(x)), r.integers(0, 2, len(x))
    df = spark.createDataFrame([(int(i), v.tolist(), int(g)) for i, v, g in zip(ids, x, labels)], "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, ed.near_vectors(df, chunk=chunk, bucket=32).collect()))
    assert got == brute(ids, labels, x)
    assert sum(g[1] > 0 for g in got) > 100


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, [1.0, 0.0], None), (6, None, 0),
            (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [nan, 1.0], 0), (10, [inf, 0.0], 0), (11, [None, 1.0], 0), (12, [], 0),
            (13, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0], 0), (None, [1.0, 0.01], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = sorted(map(tuple, ed.near_vectors(df).collect()), key=str)
    want = [(i, 0, i, True) for i in range(3, 14)] + [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False)]
    assert got == sorted(want, key=str)
    assert ed.near_vectors(df.limit(0)).count() == 0


def test_planned_tables():
    for n in (100, 10**6, 10**10):
        bits, tables = ed.plan_tables(n, 0.98)
        assert (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** tables <= ed.MISS * 1.01
