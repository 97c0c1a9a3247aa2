from collections import defaultdict

import numpy as np
import pytest

from ionframe.llm import queries, sharding
from tests.llm import cases


def test_differencing_is_a_tight_partition():
    sizes = np.random.default_rng(1).lognormal(6, 1.3, 3000).astype(np.int64)
    part = sharding.differencing(sizes, 24)
    sums = np.bincount(part, sizes, minlength=24)
    assert sums.max() - sums.min() <= 3
    assert sorted(np.bincount(sharding.differencing(np.array([9, 8, 7, 6, 5]), 2), [9, 8, 7, 6, 5])) == [16, 19]
    assert list(sharding.differencing(np.zeros(0, dtype=np.int64), 3)) == []


def _check(rows, docs, n_shards):
    want = sorted((d, len((t or "").encode()) + 8, cases.crc(t)) for d, t in docs if d is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == want
    assert len(rows) == len(docs)
    groups, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n_shards
        groups[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_on_the_test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").collect()]
    df = queries.QUERIES["op2_sharding"](spark, cases.SF)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    _check(df.collect(), docs, 24)


@pytest.mark.parametrize("cell_rows", [20_000, 40])
def test_levels_and_balance(spark, cell_rows):
    rows = [(i, "x" * int(s)) for i, s in enumerate(np.random.default_rng(2).integers(1, 300, 900))]
    rows += [(1000 + i, "giant " * 900) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_bytes(docs, 4, cell_rows=cell_rows, cell_parts=8, loose=30).collect()
    _check(got, rows, 4)
    sums = np.bincount([r.shard for r in got], [r.size for r in got], minlength=4)
    small = np.sort(sums)[:-1]  # the giant group alone is more than an even share
    assert small.max() - small.min() <= 0.02 * small.mean()


def test_odd_rows_and_empty(spark):
    rows = cases.odd_rows()
    _check(sharding.shard_by_bytes(cases.odd_docs(spark), 3).collect(), [(r[0], r[1]) for r in rows], 3)
    empty = sharding.shard_by_bytes(cases.odd_docs(spark, []), 3)
    assert empty.columns[:5] == ["doc_id", "size", "text_crc32", "shard", "slot"] and empty.count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    sharding.write_shards(docs, sharding.shard_by_bytes(docs, 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty()


@pytest.mark.parametrize("k", [2, 3, 7])
def test_differencing_equals_plain_karmarkar_karp(k):
    """Sets of items, joined two by two: those with the largest spread, the largest subset of one with the smallest of the other."""
    import random

    for seed in range(20):
        r = random.Random(seed)
        # distinct sums, so that every choice is forced
        sizes = [r.randrange(1, 1 << 40) for _ in range(r.randint(1, 30))]
        partial = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
        while len(partial) > 1:
            partial.sort(key=lambda p: -(max(p)[0] - min(p)[0]))
            a, b = (sorted(p, key=lambda x: -x[0]) for p in partial[:2])
            partial = partial[2:] + [[(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b))]]
        want = sorted(s for s, _ in partial[0])
        part = sharding.differencing(np.array(sizes), k)
        assert sorted(np.bincount(part, sizes, minlength=k).astype(int).tolist()) == want
        assert sorted(sorted(np.flatnonzero(part == j).tolist()) for j in range(k)) == sorted(sorted(x) for _, x in partial[0])
