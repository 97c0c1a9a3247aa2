import numpy as np
import pyarrow as pa
import pytest

from ionframe.llm import ftrl, ngrams, quality, queries, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.1"


def auc(y, s):
    rank = np.argsort(np.argsort(s))
    one = y == 1
    return (rank[one].sum() - one.sum() * (one.sum() - 1) / 2) / (one.sum() * (~one).sum())


@pytest.mark.parametrize("name,label,threshold,accuracy", [("op1_quality", "quality", 0.3, 0.98), ("op7_toxicity", "toxic", 0.5, 0.97)])
def test_held_out_accuracy(spark, name, label, threshold, accuracy):
    df = queries.QUERIES[name](spark, SF)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    got = df.toPandas()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all() and ((got["score"] >= threshold) == (got["predicted"] == 1)).all()
    assert all((cases.crc(d) % 5 == 0) == h for d, h in zip(got["doc_id"], got["held_out"]))
    test = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    test = test[test["held_out"]]
    assert (test["predicted"] == test[label]).mean() >= accuracy
    assert auc(test[label].to_numpy(), test["score"].to_numpy()) >= 0.98


def slow_words(t):
    return cases.WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def test_words_and_grams_match_plain_python(monkeypatch):
    texts = [r[1] for r in cases.odd_rows()] + ["x" * 5000 + " a b", "tail", "lead trail  ", " a", "a"]
    for segment in (1 << 20, 64):
        monkeypatch.setattr(ngrams, "SEGMENT", segment)
        doc, found = ngrams.words(pa.array(texts, pa.string()).slice(0))
        names = {}
        want = [(i, w) for i, t in enumerate(texts) for w in slow_words(t)]
        assert doc.tolist() == [i for i, _ in want]
        for (_, w), h in zip(want, found["word"].tolist()):
            assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)
        for kind, offsets in ((("word", (1,)), (1,)), (("word", (2,)), (2,)), (("word", (1, 2)), (1, 2))):
            ((d, f),) = ngrams.grams(doc, found, (kind,), 1 << 30)
            tuples = [(i, (w, *(want[p + o][1] for o in offsets))) for p, (i, w) in enumerate(want)
                      if p + offsets[-1] < len(want) and want[p + offsets[-1]][0] == i]
            assert d.tolist() == [i for i, _ in tuples]
            seen = {}
            assert all(seen.setdefault(t, x) == x for (_, t), x in zip(tuples, f.tolist()))
            assert len(set(seen.values())) == len(seen)


def test_score_is_the_sparse_dot_product():
    texts = pa.array([r[1] for r in cases.odd_rows()], pa.string())
    for s in (toxicity.SETTINGS, quality.SETTINGS):
        r = np.random.default_rng(4)
        w = r.normal(size=s.dims).astype(np.float32)
        m = ftrl.Model(s, 0.25, np.arange(s.dims), w / 50)
        plain = [1 / (1 + np.exp(-(0.25 + float((w[f] / 50).astype(np.float32) @ (np.ones(len(f)) if v is None else v))))) for f, v in ftrl.examples(texts, s)]
        assert np.allclose(ftrl.score_texts(texts, m), plain, rtol=1e-4)
        assert np.allclose(ftrl.score_texts(texts.slice(3, 4), m), plain[3:7], rtol=1e-4)


def test_ftrl_is_sparse_and_learns():
    s = ftrl.Settings(kinds=(), presence=True, dims=64, l1=2.0, alpha=1.0)
    r = np.random.default_rng(0)
    data = []
    for _ in range(400):
        f = np.unique(r.integers(2, 64, 6))
        y = int(r.random() < 0.3)
        data.append((np.r_[[1], f] if y else f, np.ones(len(f) + y), y))
    m = ftrl.follow(data, s)
    assert 1 in m.features and len(m.features) < 40 and m.table()[1] == m.weights.max()


def test_labels_are_not_read_from_held_out_rows_and_odd_rows_score(spark):
    docs = cases.odd_docs(spark)
    rows = [(i, i % 2, i % 2) for i in range(60) if cases.crc(i) % 5 == 0] + [(None, 1, 1), (1, None, None)]
    none = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none).weights.size == 0
    m = toxicity.fit(docs, spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 1, 1), (7, 0, 0)], none.schema))
    got = toxicity.score_documents(docs, m)
    assert got.count() == docs.count() and set(got.columns) == set(docs.columns) | {"held_out", "score", "predicted"}
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[3] == by[4] == by[5] and by[1] == by[2]
    assert toxicity.keep_clean(docs, m).columns == docs.columns
    assert quality.score_documents(docs.limit(0), m).count() == 0


@pytest.mark.parametrize("presence", [True, False])
def test_ftrl_equals_a_plain_loop(presence):
    import math
    import random

    r = random.Random(3)
    s = ftrl.Settings(kinds=(), presence=presence, dims=64, l1=0.3, epochs=2)
    data = []
    for _ in range(120):
        f = sorted(r.sample(range(64), r.randint(0, 9)))
        v = None if presence else np.array([r.random() for _ in f])
        data.append((np.array(f, dtype=np.int32), v, int(5 in f or r.random() < 0.2)))
    z, n = [0.0] * 64, [0.0] * 64

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return (math.copysign(s.l1, z[i]) - z[i]) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    ones = sum(y for _, _, y in data)
    bias, bias_n = math.log((ones + 0.5) / (len(data) - ones + 0.5)), 0.0
    for _ in range(s.epochs):
        for f, v, y in data:
            xs = [1.0] * len(f) if v is None else v.tolist()
            ws = [weight(i) for i in f]
            p = 1 / (1 + math.exp(-(bias + sum(w * x for w, x in zip(ws, xs)))))
            for i, x, w in zip(f, xs, ws):
                g = (p - y) * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha
                z[i] += g - sigma * w
                n[i] += g * g
            bias_n += (p - y) ** 2
            bias -= s.alpha * (p - y) / (s.beta + math.sqrt(bias_n))
    m = ftrl.follow(data, s)
    want = {i: weight(i) for i in range(64) if weight(i)}
    assert dict(zip(m.features.tolist(), m.weights.tolist())) == pytest.approx(want, rel=1e-5) and m.bias == pytest.approx(bias)
    assert 0 < len(want) < 64
