import numpy as np
import pytest
import xxhash

from ionframe.llm import queries, simhash
from ionframe.operators.components import star_components
from tests.llm import cases


def slow_fingerprint(text):
    words = cases.WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    root = cases.roots(len(rows), zip(a.tolist(), b.tolist()))
    least = {}
    for r, (d, _) in zip(root, rows):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted([(d, f"{int(f):016x}", least.get(r)) for (d, _), f, r in zip(rows, fps, root)], key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op6_simhash"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_odd_rows(spark):
    got = simhash.simhash_components(cases.odd_docs(spark))
    assert sorted(map(tuple, got.collect()), key=str) == brute([(r[0], r[1]) for r in cases.odd_rows()])
    assert simhash.simhash_components(cases.odd_docs(spark, [])).count() == 0


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c') h").first().h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("group_rows", [100_000, 50])
def test_links_with_split_groups(spark, group_rows):
    r = np.random.default_rng(3)
    fps = set()
    for c in r.integers(0, 2**63, 60).tolist() + [2**64 - 1, 0]:
        for _ in range(int(r.integers(1, 40))):
            y = c
            for b in r.integers(0, 64, int(r.integers(0, 6))).tolist():
                y ^= 1 << b
            fps.add(y)
    fps = np.array(sorted(fps), dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    want = cases.roots(len(fps), zip(a.tolist(), b.tolist()))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = simhash.hamming_links(df, 3, group_rows, unit_rows=200).collect()
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    assert cases.roots(len(fps), [(at[e.a], at[e.b]) for e in got]) == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(2000)] + [(5000, 5000 + i) for i in range(1, 500)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in star_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(2001)} | {5000 + i: 5000 for i in range(500)}
    assert star_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_stays(spark):
    docs = cases.odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    by_id = {c[0]: c[2] for c in brute([(r[0], r[1]) for r in cases.odd_rows()])}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for d, c in by_id.items() if d is not None and d == c)


def test_one_of_each_group_stays_with_clashing_and_null_ids(spark):
    a, b, c, d = ("alpha beta gamma delta", "one two three four five", "red green blue black white", "north east south west")
    rows = [(5, a), (9, a), (5, b), (3, b), (5, c), (None, c), (None, a), (None, d), (None, d), (7, None), (7, ""), (5, a)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, place int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text or None) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(5, a), (3, b), (5, c), (None, d), (7, None)], key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_columns_with_the_names_of_helpers_stay(spark):
    df = spark.createDataFrame([(i, f"some text {i // 2}", i + 10, f"h{i}", i * 2, "x") for i in range(6)],
                               "doc_id long, text string, _keep_id long, _keep_hash string, `a.b` int, _keep_one string")
    got = sorted(map(tuple, simhash.keep_one(df).collect()))
    assert simhash.keep_one(df).columns == df.columns
    assert got == [r for r in sorted(map(tuple, df.collect())) if r[0] % 2 == 0]
