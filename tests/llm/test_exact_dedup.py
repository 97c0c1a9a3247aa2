import hashlib
import re

import pytest

from ionframe.llm import exact_dedup, queries
from tests.llm import cases

SPACE = re.compile("[\x20\x09-\x0D]+")


def norm(text) -> str:
    return SPACE.sub(" ", text or "")


def brute(rows) -> list:
    groups: dict = {}
    for i, text in rows:
        groups.setdefault(norm(text), []).append(i)
    out = []
    for text, ids in groups.items():
        real = [i for i in ids if i is not None]
        least, sha = min(real, default=None), hashlib.sha256(text.encode()).hexdigest()
        taken = False
        for i in ids:
            out.append((i, least, len(ids), i == least and not taken, sha))
            taken |= i == least
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,parts", [(4, 1), (4, 17), (1, 9), (2, 40)])
def test_equals_brute_force(spark, bits, parts):
    docs = cases.odd_docs(spark).repartition(parts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact_dedup.text_classes(docs, bits=bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_rounds_cover_all_leaves():
    assert [exact_dedup._depth(n, 4) for n in (1, 16, 17, 256, 257)] == [1, 1, 2, 2, 3]


def test_equal_digests_of_different_texts_stay_apart(spark):
    rows = [(0, 7, 3, b"a", (False, 5, 0), 1), (1, 7, 3, b"b", (False, 4, 1), 1), (2, 7, 3, b"a", (False, 2, 2), 2), (3, 7, 4, b"a", (False, 1, 3), 1)]
    df = spark.createDataFrame(rows, "leaf int, digest long, bytes int, sha256 binary, keep struct<no_id: boolean, id: long, place: long>, n long")
    got = sorted((r.bytes, bytes(r.sha256), r.keep.id, r.n) for r in exact_dedup.merge_runs(df, 4, 1).collect())
    assert got == [(3, b"a", 2, 3), (3, b"b", 4, 1), (4, b"a", 1, 1)]


def test_kept_rows_have_all_columns(spark):
    docs = cases.odd_docs(spark).withColumnRenamed("score", "_norm").withColumnRenamed("size", "a.b").withColumnRenamed("shard", "place")
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({norm(r.text) for r in docs.collect()}) == len({norm(r.text) for r in rows})
    assert [r.doc_id for r in rows if r.text and r.text.startswith("hot")] == [20]


def test_odd_tables(spark):
    docs = cases.odd_docs(spark)
    assert exact_dedup.text_classes(docs.limit(0)).count() == 0
    none = spark.createDataFrame([(None, "x"), (None, "x"), (None, None)], "doc_id long, text string")
    got = [tuple(r)[:4] for r in exact_dedup.text_classes(none).collect()]
    assert sorted(got, key=str) == [(None, None, 1, True), (None, None, 2, False), (None, None, 2, True)]


def test_native_plan(spark):
    plan = queries.QUERIES["op13_exact_dedup"](spark, cases.SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions", plan)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{cases.SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.QUERIES["op13_exact_dedup"](spark, cases.SF).collect()), key=str) == brute(rows)
