"""Packed token-id matrices: best-fit-decreasing with a segment tree over free capacities."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import share


#: Tokens that a task gathers before it packs them, and the share of them that poorly filled rows may hand on.
GATHERED = 4_000_000
HANDED_ON = 0.25

#: How the public byte-level vocabularies cut a text into words before merging (fixed value).
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = ("pack_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
          "doc_ids array<long>, doc_offsets array<long>")


class BytePairs:
    """Byte-level BPE from a public vocabulary file (a token in base 64 and its rank on each line). Any
    encoder with dtype, end (the id that closes a document) and encode_bytes can stand in its place."""

    dtype = np.dtype("<u2")

    def __init__(self, path: str, words: str = WORDS):
        self.words = words
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.end = max(self.ranks.values()) + 1
        if self.end >= 1 << 16:
            raise ValueError("the vocabulary has no room for an end id in 16 bits")
        self.encoding = None

    def __getstate__(self):
        return self.__dict__ | {"encoding": None}

    def open(self):
        if self.encoding is None:
            self.encoding = tiktoken.Encoding("packing", pat_str=self.words, mergeable_ranks=self.ranks, special_tokens={})
        return self.encoding

    def encode_bytes(self, text: str) -> bytes:
        return array("H", self.open().encode_ordinary(text)).tobytes()

    def decode(self, ids) -> str:
        return self.open().decode([i for i in ids if i != self.end])


class Capacities:
    """Segment tree over free capacities 0..most; a node counts the open rows below it."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of an open row of least capacity that is at least ``need``, taken out."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):  # up to a node with rows to its right
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:  # down to its leftmost row
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.size
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of at most ``length`` in all, as lists of item numbers: items from the largest (ties by
    number) go to the fullest row that still has room, else to a new one."""
    free, rows = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        got = free.take(sizes[i])
        capacity, row = got or (length, len(rows))
        if got is None:
            rows.append([])
        rows[row].append(i)
        if capacity > sizes[i]:
            free.add(capacity - sizes[i], row)
    return rows


def _matrix_row(pieces: list, length: int, pad: int, dtype: np.dtype) -> tuple:
    ids, places, ends = np.full(length, pad, dtype=dtype), np.zeros(length, dtype="<u4"), [0]
    for _, _, tokens in pieces:
        at = ends[-1]
        ids[at:at + len(tokens)] = tokens
        places[at:at + len(tokens)] = np.arange(len(tokens))
        ends.append(at + len(tokens))
    return ends[-1], ids.tobytes(), places.tobytes(), ends, [d for d, _, _ in pieces], [o for _, o, _ in pieces]


def pack(documents: Iterator[tuple[int, np.ndarray]], length: int, pad: int, gathered: int = GATHERED) -> Iterator[tuple]:
    """Rows of the packed matrix for (doc_id, ids). Documents of over ``length`` ids are cut into
    full rows and a rest; at most about ``gathered`` ids are held at a time."""
    held, size = [], 0

    def flush(last: bool) -> Iterator[tuple]:
        nonlocal held, size
        rows = best_fit_decreasing([len(p[2]) for p in held], length)
        rows.sort(key=lambda r: -sum(len(held[i][2]) for i in r))
        on, on_size = [], 0
        if not last:  # the emptiest rows are packed again with what follows
            while rows and (fill := sum(len(held[i][2]) for i in rows[-1])) < length - length // 64 and on_size + fill <= HANDED_ON * gathered:
                on += rows.pop()
                on_size += fill
        for r in rows:
            yield _matrix_row([held[i] for i in sorted(r)], length, pad, held[r[0]][2].dtype)
        held, size = [held[i] for i in sorted(on)], on_size

    for doc, ids in documents:
        for at in range(0, len(ids), length):
            piece = (doc, at, ids[at:at + length])
            if len(piece[2]) == length:
                yield _matrix_row([piece], length, pad, ids.dtype)
            else:
                held.append(piece)
                size += len(piece[2])
        if size >= gathered:
            yield from flush(False)
    yield from flush(True)


def pack_documents(docs: DataFrame, model, length: int = 2048, end: int | None = None, pad: int = 0, gathered: int = GATHERED,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of ``docs`` in rows of ``length``:

    pack_id (unique), n_tokens (without padding), input_ids (``length`` little-endian numbers of the model's
    dtype, then ``pad``), position_ids (``length`` 4-byte numbers that start again at each
    segment), cu_seqlens (0 and the segments' ends), and each segment's doc_id and
    offset in its document's ids.

    ``model`` encodes: `BytePairs`, or a compiled SentencePiece model with ``end`` given.
    Every document is encoded whole and closed by ``end``; one of over ``length`` ids is cut, losslessly, into
    segments. A task packs the rows it reads, in bounded lots, so nothing is
    shuffled and a partition leaves at most a few rows unfilled; a rerun of a task gives the same rows.
    Null texts have no segment, empty ones only ``end``. A null doc_id stays null; repeated rows are all packed.
    """
    end = model.end if end is None else end
    shared = share(docs.sparkSession, model)

    def run(batches):
        m = shared()

        def documents():
            for b in batches:
                for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                    if t.is_valid:
                        yield d, np.append(np.frombuffer(m.encode_bytes(t.as_py()), m.dtype), np.array([end], m.dtype))

        first, out, n = TaskContext.get().partitionId() << 33, [], 0
        for row in pack(documents(), length, pad, gathered):
            out.append((first + n, *row))
            n += 1
            if len(out) >= 512:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    from pyspark.sql import functions as F

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def unpack(rows, dtype: np.dtype) -> dict:
    """Ids of each document from collected rows of `pack_documents`, for checks."""
    parts: dict = {}
    for r in rows:
        ids = np.frombuffer(r["input_ids"], dtype)
        for i, (d, o) in enumerate(zip(r["doc_ids"], r["doc_offsets"])):
            parts.setdefault(d, []).append((o, ids[r["cu_seqlens"][i]:r["cu_seqlens"][i + 1]]))
    return {d: np.concatenate([x for _, x in sorted(p, key=lambda x: x[0])]) for d, p in parts.items()}
