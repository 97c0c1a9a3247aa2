import hashlib
import math

import numpy as np
import pytest

from ionframe.llm import part_codes as pc
from ionframe.llm import queries


def brute(rows, parts=16, entries=64, rounds=2):
    """Rows (vec_id, vector, label) by plain loops over all entries."""
    kept = [(i, [math.floor(256 * c) for c in v], g) for i, v, g in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: r[0])[:entries]
    books = [[tuple(v[p * w:(p + 1) * w]) for _, v, _ in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                x = v[p * w:(p + 1) * w]
                own.setdefault(nearest(x, books[p])[1], []).append(x)
            books[p] = [tuple(sum(c) // len(own[j]) for c in zip(*own[j])) if j in own else e for j, e in enumerate(books[p])]
    out, by_label = [], {}
    for i, v, g in kept:
        got = [nearest(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        err = sum(d for d, _ in got)
        by_label[g] = by_label.get(g, 0) + err
        out.append((i, "".join(f"{j:02x}" for _, j in got), err, g))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, c, e, by_label[g], sha) for i, c, e, g in out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label string, code string, n int")


def test_tree_balls_hold_their_points():
    r = np.random.default_rng(1)
    x = np.concatenate([r.integers(-40, 40, (700, 4)), r.integers(0, 3, (900, 4)), np.full((300, 4), 7)]).astype(np.int64)
    t = pc.Tree(x)
    assert sorted(t.order.tolist()) == list(range(len(x))) and (x[t.order] == t.points).all()
    for b in range(len(t.start)):
        p = t.points[t.start[b]:t.end[b]]
        assert (t.total[b] == p.sum(axis=0)).all() and np.sqrt(((p - t.pivot[b]) ** 2).sum(axis=1).max()) <= t.radius[b] + 1e-9
        if t.left[b] >= 0:
            kids = sorted([(t.start[k], t.end[k]) for k in (t.left[b], t.right[b])])
            assert kids[0][0] == t.start[b] and kids[0][1] == kids[1][0] and kids[1][1] == t.end[b]


@pytest.mark.parametrize("seed", range(4))
def test_owners_equal_all_distances_with_ties(seed):
    r = np.random.default_rng(seed)
    x = np.concatenate([r.integers(-9, 9, (800, 3)), r.integers(-200, 200, (800, 3)), np.full((400, 3), 4)]).astype(np.int64)
    book = np.concatenate([r.integers(-9, 9, (20, 3)), r.integers(-200, 200, (20, 3)), x[:10], x[:10]]).astype(np.int64)
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    code, far = pc.Tree(x).codes(book)
    assert (code == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()
    sums, counts = np.zeros_like(book), np.zeros(len(book), dtype=np.int64)
    pc.Tree(x).add_to(book, sums, counts)
    assert (counts == np.bincount(code, minlength=len(book))).all() and all((sums[j] == x[code == j].sum(axis=0)).all() for j in range(len(book)))


def test_balls_are_taken_whole():
    r = np.random.default_rng(3)
    centres = r.integers(-5000, 5000, (8, 4))
    x = np.concatenate([c + r.integers(-20, 20, (400, 4)) for c in centres]).astype(np.int64)
    balls, _, rows, _ = pc.Tree(x).owners(centres.astype(np.int64))
    assert not len(rows) and len(balls) < 100


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    t = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = queries.QUERIES["op12_vector_codes"](spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect())) == brute([(r.vec_id, r.embedding, r.label) for r in t])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(5)
    rows = [(int(i), (r.integers(-30, 30, 32) / 16).tolist(), None if i % 3 == 0 else f"g{i % 2}") for i in r.permutation(300)]
    rows += [(1000 + i, [0.25] * 32, None) for i in range(150)] + [(7, None, "g0"), (400, [nan] * 32, "g0"), (401, [inf] * 32, "g0"), (402, [None] * 32, "g0")]
    rows += [(403, [-0.0] * 32, "n"), rows[250]]
    got = sorted(map(tuple, pc.coded_with_errors(frame(spark, rows)).collect()))
    assert got == brute(rows)
    rows.append((404, [1.0] * 8, "g0"))  # of another length
    rows.append((405, [1e300] * 32, "g0"))
    assert sorted(map(tuple, pc.coded_with_errors(frame(spark, rows)).collect())) == got


def test_small_tables(spark):
    assert pc.coded_with_errors(frame(spark, [])).count() == 0
    assert pc.coded_with_errors(frame(spark, [(None, [1.0] * 16, "a")])).count() == 0
    few = [(3, [0.1 * i for i in range(16)], "a"), (1, [0.2 * i for i in range(16)], None), (2, [0.2 * i for i in range(16)], None)]
    assert sorted(map(tuple, pc.coded_with_errors(frame(spark, few)).collect())) == brute(few)
    with_null_id = pc.coded_with_errors(frame(spark, [*few, (None, few[0][1], "a")]))
    assert with_null_id.count() == 4
