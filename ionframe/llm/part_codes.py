"""Vector code compression: codebooks of vector parts, by metric trees of an anchors hierarchy."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, stored

#: Vectors whose parts one tree holds; a task builds a tree per part for each such block of what it reads.
BLOCK = 4096
#: Points of a ball that isn't divided further.
LEAF = 128
#: Scaled components reach so far at most; their squared distances and sums then fit 64 bits.
LIMIT = 2 ** 26


class Tree:
    """Balls over the rows of an integer matrix. Ball i has the points start[i] to end[i] of ``points`` (rows
    in tree order, ``order`` tells their places in the matrix) within ``radius`` of ``pivot``; ``total`` is
    their sum, and left and right are its two balls, or -1.

    Built middle-out: about the root of n anchors first, each owning the points nearer to it than to the others; an
    anchor's points get a tree of their own, and the balls of the anchors are joined two by two, the pair with
    the smallest common ball first.
    """

    def __init__(self, x: np.ndarray):
        self.x, self._balls = x, []
        root = self._build(np.arange(len(x)))
        at, lo, order = {}, [], []
        todo = [root]
        while todo:  # pre-order, so the points of a ball are consecutive
            i = todo.pop()
            at[i] = len(lo)
            lo.append(i)
            if self._balls[i][3] < 0:
                order.append(self._balls[i][0])
            else:
                todo += [self._balls[i][4], self._balls[i][3]]
        balls = [self._balls[i] for i in lo]
        size = np.array([len(b[0]) for b in balls])
        leaf = np.array([b[3] < 0 for b in balls])
        self.order = np.concatenate(order)
        self.start = np.cumsum(np.where(leaf, size, 0)) - np.where(leaf, size, 0)
        self.end = self.start + size
        self.pivot, self.radius = np.array([b[1] for b in balls]), np.array([b[2] for b in balls])
        self.left, self.right = (np.array([at[b[k]] if b[k] >= 0 else -1 for b in balls]) for k in (3, 4))
        self.points = x[self.order]
        run = np.vstack([np.zeros((1, x.shape[1]), dtype=np.int64), np.cumsum(self.points, axis=0)])
        self.total = run[self.end] - run[self.start]
        del self.x, self._balls

    def _ball(self, rows: np.ndarray, left: int = -1, right: int = -1) -> int:
        pts = self.x[rows]
        pivot = pts.sum(axis=0) // len(rows)
        far = int(_squares(pts - pivot).max())
        # a little wide, so that rounding never leaves a point outside
        self._balls.append((rows, pivot, np.sqrt(far) * (1 + 1e-12), left, right))
        return len(self._balls) - 1

    def _build(self, rows: np.ndarray) -> int:
        if len(rows) <= LEAF:
            return self._ball(rows)
        owner = self._anchors(rows)
        if not owner.any():
            return self._ball(rows)  # all points are equal
        groups = np.split(rows[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner))[:-1])
        return self._join([self._build(g) for g in groups if len(g)])

    def _anchors(self, rows: np.ndarray) -> np.ndarray:
        """Owning anchor per row. The next anchor is the point farthest from its own; it takes the points it is
        nearer to, and looks only at those farther from their anchor than half the way between the two anchors."""
        pts = self.x[rows]
        owner = np.zeros(len(rows), dtype=np.int64)
        own = _squares(pts - pts[0])
        anchors = [pts[0]]
        for k in range(1, int(np.sqrt(len(rows))) + 1):
            far = int(own.argmax())
            if not own[far]:
                break
            new = pts[far]
            way = _squares(np.array(anchors) - new)
            look = np.flatnonzero(4 * own > way[owner])
            d = _squares(pts[look] - new)
            taken = d < own[look]
            owner[look[taken]], own[look[taken]] = k, d[taken]
            anchors.append(new)
        return owner

    def _join(self, ids: list[int]) -> int:
        """One ball over all ``ids``, by joining the pair whose common ball is smallest."""
        c = np.array([self._balls[i][1] for i in ids], dtype=np.float64)
        r = np.array([self._balls[i][2] for i in ids])
        size = _common(c[:, None], r[:, None], c[None], r[None])
        np.fill_diagonal(size, np.inf)
        for _ in range(len(ids) - 1):
            a, b = divmod(int(size.argmin()), len(ids))
            a, b = min(a, b), max(a, b)
            ids[a] = self._ball(np.concatenate([self._balls[ids[a]][0], self._balls[ids[b]][0]]), ids[a], ids[b])
            c[a], r[a] = self._balls[ids[a]][1], self._balls[ids[a]][2]
            gone = np.isinf(size[a]) & (np.arange(len(ids)) != a)
            size[a] = _common(c[a], r[a], c, r)
            size[a, gone] = np.inf
            size[a, a] = np.inf
            size[:, a] = size[a]
            size[b] = size[:, b] = np.inf
        return ids[0]

    def owners(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of ``book`` for all points: (balls, their entries, points in no such ball, their entries).

        A ball inherits the entries that could own a point of the ball above. An entry goes when the one nearest to
        the pivot is nearer to every point of the ball; when one is left, the ball is wholly its own and is
        not entered. Points of an undivided ball are compared with the entries left. Distances are exact integers;
        an entry goes only if it's strictly farther, so ties go to the lower index.
        """
        gap = np.sqrt(_squares(book[:, None] - book[None]).astype(np.float64))
        balls, cand = np.zeros(1, dtype=np.int64), np.ones((1, len(book)), dtype=bool)
        whole, whole_to, single, single_to = [], [], [], []
        while len(balls):
            d = _distances(self.pivot[balls], book)
            best = np.where(cand, d, np.iinfo(np.int64).max).argmin(axis=1)
            behind = d - np.take_along_axis(d, best[:, None], 1)
            radius = self.radius[balls, None]
            cand &= (behind <= 2 * radius * gap[best] * (1 + 1e-9)) & ((radius > 0) | (np.arange(len(book)) == best[:, None]))
            one = cand.sum(axis=1) == 1
            whole.append(balls[one])
            whole_to.append(best[one])
            last = ~one & (self.left[balls] < 0)
            if last.any():
                n = (self.end - self.start)[balls[last]]
                rows = np.concatenate([np.arange(self.start[b], self.end[b]) for b in balls[last]])
                single.append(rows)
                away = _distances(self.points[rows], book)
                single_to.append(np.where(np.repeat(cand[last], n, axis=0), away, np.iinfo(np.int64).max).argmin(axis=1))
            down = ~one & ~last
            balls, cand = np.concatenate([self.left[balls[down]], self.right[balls[down]]]), np.concatenate([cand[down], cand[down]])
        return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (whole, whole_to, single, single_to))

    def add_to(self, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the points' sums and counts to those of their entries; a ball's own cached ones where it has one owner."""
        balls, to, rows, row_to = self.owners(book)
        np.add.at(sums, to, self.total[balls])
        np.add.at(counts, to, (self.end - self.start)[balls])
        np.add.at(sums, row_to, self.points[rows])
        np.add.at(counts, row_to, 1)

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) per row of the matrix."""
        balls, to, rows, row_to = self.owners(book)
        entry = np.zeros(len(self.points), dtype=np.int64)
        for b, e in zip(balls, to):
            entry[self.start[b]:self.end[b]] = e
        entry[rows] = row_to
        out, far = np.zeros_like(entry), np.zeros_like(entry)
        out[self.order], far[self.order] = entry, _squares(self.points - book[entry])
        return out, far


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return _squares(x)[:, None] - 2 * (x @ book.T) + _squares(book)


def _common(ca: np.ndarray, ra: np.ndarray, cb: np.ndarray, rb: np.ndarray) -> np.ndarray:
    """Radius of the smallest ball around two balls."""
    way = np.sqrt(((ca - cb) ** 2).sum(axis=-1))
    return np.maximum((way + ra + rb) / 2, np.maximum(ra, rb))


def _cuts(dim: int, parts: int) -> list[int]:
    return [dim * p // parts for p in range(parts + 1)]


def scaled(vectors: DataFrame, vec_id: str, vec: str, label: str, scale: int) -> DataFrame:
    """(vec_id, x, label) of the usable rows: x has floor(scale * component), label is text that tells null apart."""
    v = F.col(vec).cast("array<double>")
    ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < LIMIT))
    key = F.when(F.col(label).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(label).cast("string")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"), key.alias("label"))
            .where(F.col("v").isNotNull() & ok)
            .select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"), "label"))


def first_books(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """Codebooks of the parts of the vectors with the ``entries`` smallest ids; none of an empty table."""
    ids = rows.where(F.col("vec_id").isNotNull()).select("vec_id").distinct().orderBy("vec_id").limit(entries)
    ids = [r.vec_id for r in ids.collect()]
    if not ids:
        return []
    first = rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("x").alias("x")).orderBy("vec_id").collect()
    dim = len(first[0].x)
    x = np.array([r.x for r in first if len(r.x) == dim], dtype=np.int64).reshape(-1, dim)
    cut = _cuts(dim, parts)
    return [x[:, a:b].copy() for a, b in zip(cut, cut[1:])]


def _trees(batches: Iterator[pa.RecordBatch], cut: list[int]) -> Iterator[pa.RecordBatch]:
    """A row per block of vectors: ids, labels, and the parts' trees."""
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            b = batch.slice(at, BLOCK)
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), cut[-1])
            trees = [Tree(np.ascontiguousarray(x[:, s:e])) for s, e in zip(cut, cut[1:])]
            yield pa.record_batch({"ids": pa.array([b.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                                   "labels": pa.array([b.column("label").to_pylist()], pa.list_(pa.string())),
                                   "trees": pa.array([pickle.dumps([t.__dict__ for t in trees], 5)], pa.binary())})


def _load(blob: pa.Scalar) -> list[Tree]:
    out = []
    for fields in pickle.loads(blob.as_buffer()):
        t = Tree.__new__(Tree)
        t.__dict__.update(fields)
        out.append(t)
    return out


def _moved(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by floor(sum / count) of the parts that it owns; unused ones stay."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            for blob in batch.column("trees"):
                for t, b, s, n in zip(_load(blob), books, sums, counts):
                    t.add_to(b, s, n)
        for p, (s, n) in enumerate(zip(sums, counts)):
            e, c = np.nonzero(np.repeat(n[:, None] > 0, s.shape[1], axis=1))
            yield pa.record_batch({"part": np.full(len(e), p, dtype=np.int32), "entry": e.astype(np.int32), "place": c.astype(np.int32),
                                   "total": s[e, c], "n": n[e]})

    got = (trees.select("trees").mapInArrow(partial, "part int, entry int, place int, total long, n long")
           .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    new = [b.copy() for b in books]
    for r in got.collect():  # a number per component of the codebooks
        new[r.part][r.entry, r.place] = r.total // r.n
    return new


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()


def code_vectors(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = 16,
                 entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) per usable row, final codebooks as integer matrices by part).

    Components become floor(scale * x), vectors are cut into ``parts`` equal consecutive parts (by
    floor(dim * p / parts) if that isn't whole). A codebook starts as that part of the vectors with the ``entries``
    smallest ids; a round assigns all parts to their nearest entry (ties to the lower index) and replaces an
    entry by the componentwise floor of its parts' mean. code has two hex digits a part (at most 256 entries), error is
    the sum of the squared distances. label is the input's as text after "v", or "n" for null.

    Rows whose vector is null, holds null or non-finite components, or ones of 2^26 / scale and more, are
    dropped, and so are vectors of another length than the one of smallest id. Of several rows of one of the first ids the least vector starts
    the entry; a null id starts none (without any id there is no codebook and no result). All rows count in
    the rounds and get a code. Empty tables give empty results.

    Trees are built once per block of rows and stored; a round sends the codebooks to the tasks and
    gets a sum and a count per component of an entry back from each.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = scaled(vectors, vec_id, vec, label, scale)
    books = first_books(rows, parts, entries)
    schema = "vec_id long, label string, code string, error long"
    if not books:
        return vectors.sparkSession.createDataFrame([], schema), books
    cut = _cuts(sum(b.shape[1] for b in books), parts)
    trees = rows.where(F.size("x") == cut[-1]).mapInArrow(lambda it: _trees(it, cut), "ids array<long>, labels array<string>, trees binary")
    trees = stored(trees, "code-trees")
    for _ in range(rounds):
        books = _moved(trees, books)

    def final(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                both = [t.codes(b) for t, b in zip(_load(batch.column("trees")[i]), books)]
                text = np.stack([c for c, _ in both], axis=1).astype(np.uint8).tobytes().hex()
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                wide = 2 * len(books)
                yield pa.record_batch({"vec_id": ids, "label": labels, "code": pa.array([text[wide * j:wide * (j + 1)] for j in range(len(ids))], pa.string()),
                                       "error": sum(d for _, d in both)})

    return trees.mapInArrow(final, schema), books


def coded_with_errors(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): `code_vectors` with the error summed over the rows of
    equal label (nulls together). Labels with many rows are joined back by broadcast."""
    coded, books = code_vectors(vectors, **options)
    coded = stored(coded, "code-rows")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "code-labels")
    out = attach(coded, sums, "label", "n", coded.count())
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
