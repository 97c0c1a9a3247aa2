import math

from ionframe.llm import mixing, queries
from tests.llm import cases


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Level by bisection."""
    order = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, lo, hi = sum(sizes.values()), 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(mid * w[s], cap * sizes[s]) for s in sizes) < total else (lo, mid)
    return {s: min(hi * w[s], cap * sizes[s]) for s in sizes}


def check(rows, docs):
    sizes, taken = {}, {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(cases.WORDS.findall(t or ""))
    want = targets(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        assert 0 <= r["mix_copies"] <= 3 and r["mix_source_size"] == sizes[r["source"]]
        assert math.isclose(r["mix_target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
        taken[r["source"]] = taken.get(r["source"], 0) + r["mix_copies"] * r["mix_size"]
    return taken, want


def test_targets_and_taken(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    taken, want = check([r.asDict() for r in mixed.collect()], [(r.doc_id, r.text, r.source) for r in docs.collect()])
    assert abs(sum(taken.values()) / sum(want.values()) - 1) < 0.02
    first = sorted(map(tuple, queries.QUERIES["op8_mixing"](spark, sf).collect()))
    assert first == sorted(map(tuple, queries.QUERIES["op8_mixing"](spark, sf).repartition(3).collect()))


def test_odd_rows_and_emission(spark):
    docs = cases.odd_docs(spark)
    mixed = mixing.mix(docs).cache()
    check([r.asDict() for r in mixed.collect()], [(r[0], r[1], r[3]) for r in cases.odd_rows()])
    out = mixing.emit(mixing.mix(docs.drop("mix_size")))
    assert out.columns == docs.drop("mix_size").columns
    assert out.count() == sum(r.mix_copies for r in mixed.select("mix_copies").collect())
    assert mixing.mix(cases.odd_docs(spark, [])).count() == 0


def test_one_boundary_each(spark):
    """Expected copies and copies never part by one along a source's order."""
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "ab"[i % 3 == 0]) for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        expected = sum(r.mix_target / r.mix_source_size for r in own)
        assert abs(sum(r.mix_copies for r in own) - expected) < 1 + 1e-6
        assert {r.mix_copies for r in own} <= {math.floor(expected / len(own)), math.ceil(expected / len(own))}


def test_input_columns_stay(spark):
    extra = ["mix_quality", "_key", "_class", "_bucket", "_u", "_start", "_r", "_rho", "_place", "_copy", "_mix_size", "_mix__u"]
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "ab"[i % 3 == 0], 99, *(f"{c}{i}" for c in extra)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size int, " + ", ".join(f"{c} string" for c in extra))
    plain = docs.select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    added = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    assert mixed.columns == ["doc_id", "text", "source", *extra, *added]
    assert sorted(tuple(r)[:3] + tuple(r)[-4:] for r in mixed.collect()) == sorted(map(tuple, mixing.mix(plain).collect()))
    assert sorted(tuple(r)[3:-4] for r in mixed.collect()) == sorted(r[4:] for r in rows)
    out = mixing.emit(mixed)
    assert out.columns == ["doc_id", "text", "source", *extra]
    assert out.count() == sum(r.mix_copies for r in mixed.collect())
