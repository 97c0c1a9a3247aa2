"""SentencePiece encoding and decoding as a weighted finite-state transducer."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, share, unlike

SPACE = "▁"
#: Units whose paths a worker remembers.
REMEMBERED = 500_000

_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NOTHING = -1  # before the first piece, and after byte pieces: any piece may follow
_END = -2  # no arc


class _Paths(dict):
    """Best paths by unit, made when first asked for; emptied when full."""

    def __init__(self, make, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, unit):
        if len(self) >= self.most:
            self.clear()
        out = self[unit] = self.make(unit)
        return out


class Transducer:
    """A compiled model. Three transducers are composed with an input:

    the normaliser (space to the space mark, a mark before the text if the model says so, or
    single spaces), the pieces (a trie whose path from root to a
    piece's end reads it and writes its id), and byte fallback (a character that is no piece reads
    as itself and writes its UTF-8 byte pieces). The composition's states are
    (place, last piece), and the tropical semiring's least-cost path from start to end is the encoding.

    Weights: unigram models weigh a piece by its negative score, an unknown character by 10
    more than the worst piece. BPE models write what repeated merging of the
    best-scored neighbours leaves; that is the one sequence in which every two
    neighbours are such a result themselves. So an arc weighs 0 if its piece may follow the last one, and
    infinity if merging would have joined across the two; exactly one path to each place has a
    finite weight.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], bpe: bool, byte_fallback: bool, dummy_prefix: bool = True,
                 single_spaces: bool = False, unknown_surface: str = " ⁇ "):
        self.bpe, self.byte_fallback, self.dummy_prefix, self.single_spaces = bpe, byte_fallback, dummy_prefix, single_spaces
        self.unknown = next(i for i, p in enumerate(pieces) if p[2] == _UNKNOWN)
        self.bytes = {int(p[0][3:5], 16): i for i, p in enumerate(pieces) if p[2] == _BYTE}
        self.dtype = np.dtype("<u2") if len(pieces) <= 1 << 16 else np.dtype("<u4")
        self.surface = [b"" if kind == _CONTROL else unknown_surface.encode() if kind == _UNKNOWN
                        else bytes([int(p[3:5], 16)]) if kind == _BYTE else p.replace(SPACE, " ").encode() for p, _, kind in pieces]
        use = {p: (i, s) for i, (p, s, kind) in enumerate(pieces) if kind == _NORMAL}
        self.text = {i: p for p, (i, _) in use.items()}
        self.cost = {i: -s for i, s in use.values()}
        self.unknown_cost = max(self.cost.values(), default=0.0) + 10.0
        if bpe:
            self._merges(use)
        # the trie: every prefix of a piece, with the piece's id or -1
        self.trie: dict[str, int] = {}
        for i, p in self.text.items():
            for n in range(1, len(p)):
                self.trie.setdefault(p[:n], -1)
            self.trie[p] = i
        # arcs of one start, longest first: the next shorter piece that begins a piece, then fallback; the last entry is for _NOTHING
        self.size = [len(self.text.get(i, "")) for i in range(len(pieces))] + [1]
        self.shorter = [_END] * (len(pieces) + 1)
        for i, p in self.text.items():
            begins = (self.trie[p[:n]] for n in range(len(p) - 1, 0, -1))
            self.shorter[i] = next((b for b in begins if b >= 0), _NOTHING if len(p) > 1 else _END)
        self.code = [i.to_bytes(self.dtype.itemsize, "little") for i in range(len(pieces))]
        inside = {p[j:j + 2] for p in self.text.values() for j in range(len(p) - 1)}
        self.inside = inside
        cut_at_spaces = not any(x[1] == SPACE and x[0] != SPACE for x in inside)
        cut_at_lines = not any("\n" in p for p in self.text.values())
        letters, cut_at_letters = r"[^\W\d_]", False
        for _ in range(2):  # characters that pieces join with others don't count as letters
            letter = re.compile(letters).match
            joined = {c for x in inside if x[0] != SPACE and bool(letter(x[0])) != bool(letter(x[1])) for c in x if letter(c)}
            if cut_at_letters := not joined:
                break
            letters = rf"[^\W\d_{re.escape(''.join(sorted(joined)))}]"
        words = rf"{SPACE}*{letters}+|{SPACE}*(?:(?!{letters})[^{SPACE}\n])+" if cut_at_letters else rf"{SPACE}*[^{SPACE}\n]+"
        self.coarse = rf"{words}|\n+|{SPACE}+" if cut_at_spaces and cut_at_lines else r"(?s).+"
        self.plain_words = cut_at_spaces and cut_at_lines and cut_at_letters
        self._start()

    # -- compiled once

    def _merges(self, use: dict) -> None:
        """The two parts whose merge makes each piece, for pieces that merging can make."""
        level = {s: r for r, s in enumerate(sorted({s for _, s in use.values()}, reverse=True))}
        self.id_of = {p: i for p, (i, _) in use.items()}
        self.rank = {i: level[s] for i, s in use.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        leaf = {i for p, (i, _) in use.items() if len(p) == 1}
        self.leaf = set(leaf)
        for p, (i, _) in sorted(use.items(), key=lambda x: (self.rank[x[1][0]], len(x[0]))):
            for n in range(1, len(p)):
                a, b = self.id_of.get(p[:n]), self.id_of.get(p[n:])
                if a is None or b is None or not (a in leaf or a in self.parts) or not (b in leaf or b in self.parts):
                    continue
                if (a in leaf or self.rank[a] <= self.rank[i]) and (b in leaf or self.rank[b] <= self.rank[i]) \
                        and self._side_by_side(a, b, self.rank[i]):
                    self.parts[i] = (a, b)
                    break
        self.text = {i: p for i, p in self.text.items() if i in leaf or i in self.parts}

    def _side_by_side(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """Whether merging leaves pieces a and b beside each other: no merge over their border
        comes before one that made the piece at the border. Merges are taken back,
        the last one first; of equal ones the left came first."""
        rank, parts, text, id_of = self.rank, self.parts, self.text, self.id_of
        while True:
            joined = id_of.get(text[a] + text[b])
            if joined is not None and rank[joined] < limit:
                return False
            ra = rank[a] if a in parts else -1
            rb = rank[b] if b in parts else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                limit, b = rb + 1, parts[b][0]

    def _start(self) -> None:
        self.findall = re.compile(self.coarse).findall
        self.follows: dict[int, dict[int, bool]] = defaultdict(dict)
        self.n_follows = 0
        self.fine = _Paths(self._shortest_path)
        self.paths = _Paths(self._unit)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("findall", "follows", "n_follows", "fine", "paths")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    # -- composition with an input

    def normalise(self, text: str) -> str:
        if self.single_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        text = text.replace(" ", SPACE)
        return SPACE + text if self.dummy_prefix and text else text

    def _fallback(self, char: str) -> list[int]:
        if not self.byte_fallback:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def _unit(self, unit: str) -> bytes:
        """Path of a unit: cut where no piece reaches over, the parts' paths put together."""
        if self.plain_words and unit[-1].isalpha():
            return self._shortest_path(unit)
        inside, at, out = self.inside, 0, []
        for j in range(1, len(unit)):
            if unit[j - 1:j + 1] not in inside:
                out.append(self.fine[unit[at:j]])
                at = j
        out.append(self.fine[unit[at:]])
        return b"".join(out)

    def _shortest_path(self, unit: str) -> bytes:
        ids = self._finite_path(unit) if self.bpe else self._least_cost(unit)
        return b"".join([self.code[i] for i in ids])

    def _arcs(self, unit: str, i: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs that start at i, shortest first; a character that is no piece has its fallback arc."""
        get, out = self.trie.get, []
        for j in range(i + 1, len(unit) + 1):
            t = get(unit[i:j])
            if t is None:
                break
            if t >= 0:
                out.append((j, t))
        if not out or out[0][0] != i + 1:
            out.insert(0, (i + 1, _NOTHING))
        return out

    def _finite_path(self, unit: str) -> list[int]:
        """The path without infinite weights. The longest arc is tried first, then the shorter ones that begin it; a place
        reached before leads nowhere, as the last piece at a place is the same on every finite path to it."""
        n, get, shorter, size, follows = len(unit), self.trie.get, self.shorter, self.size, self.follows
        seen, path = bytearray(n + 1), []
        at, last = 0, _NOTHING
        while at < n:
            t, j = _NOTHING, at + 1
            while j <= n and (x := get(unit[at:j])) is not None:
                if x >= 0:
                    t = x
                j += 1
            while True:
                if t == _END:  # no arc from here is left: back over the last one, to its next shorter
                    t = path.pop()
                    at -= size[t]
                    last = path[-1] if path else _NOTHING
                elif not seen[at + size[t]]:
                    if t < 0 or last < 0:
                        break
                    ok = follows[last].get(t)
                    if ok is None:
                        ok = self._may_follow(last, t)
                    if ok:
                        break
                t = shorter[t]
            path.append(t)
            at += size[t]
            seen[at] = 1
            last = t
        if _NOTHING not in path:
            return path
        out, at = [], 0
        for t in path:
            out += [t] if t >= 0 else self._fallback(unit[at])
            at += size[t]
        return out

    def _may_follow(self, last: int, t: int) -> bool:
        if self.n_follows > 2 * REMEMBERED:
            self.follows.clear()
            self.n_follows = 0
        self.n_follows += 1
        out = self.follows[last][t] = self._side_by_side(last, t)
        return out

    def _least_cost(self, unit: str) -> list[int]:
        """The path of least summed weight; of equal ones the one with the earlier last arc."""
        n = len(unit)
        last, back, cost = [_NOTHING] * (n + 1), [0] * (n + 1), [float("inf")] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            for j, t in self._arcs(unit, i):
                c = cost[i] + (self.unknown_cost if t == _NOTHING else self.cost[t])
                if c < cost[j]:
                    last[j], back[j], cost[j] = t, i, c
        out: list[int] = []
        while n:
            i = back[n]
            out += [last[n]] if last[n] != _NOTHING else self._fallback(unit[i:n])[::-1]
            n = i
        return out[::-1]

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text, as little-endian numbers of ``dtype``."""
        return b"".join(map(self.paths.__getitem__, self.findall(self.normalise(text))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), self.dtype).tolist()

    def decode(self, ids) -> str:
        """Text of ids: pieces and bytes written one after another, without the mark before the
        text; control ids write nothing, bytes that are no UTF-8 the replacement character."""
        out = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.dummy_prefix and out.startswith(" ") else out


def load(path: str) -> Transducer:
    """Compile a model file. BPE and unigram models with the identity normaliser and without user
    symbols are known; others raise ValueError."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    return of_proto(m)


def of_proto(m) -> Transducer:
    kind = m.trainer_spec.model_type
    if kind not in (1, 2) or m.normalizer_spec.precompiled_charsmap or m.trainer_spec.treat_whitespace_as_suffix \
            or any(p.type == _USER for p in m.pieces):
        raise ValueError("only BPE and unigram models with the identity normaliser and no user symbols can be compiled")
    return Transducer([(p.piece, p.score, p.type) for p in m.pieces], kind == 2, m.trainer_spec.byte_fallback,
                      m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.trainer_spec.unk_surface)


def _lists(parts: list, dtype: np.dtype) -> pa.Array:
    sizes = np.array([0 if p is None else len(p) // dtype.itemsize for p in parts], dtype=np.int64)
    mask = np.array([p is None for p in parts] + [False])
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=mask)
    values = np.frombuffer(b"".join(p for p in parts if p is not None), dtype).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def encode_column(spark: SparkSession, model: Transducer, text: str) -> Column:
    """Ids (array of int) of each whole text; null for null, none for empty. The compiled model is broadcast."""
    shared = share(spark, model)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        m = shared()
        return _lists([m.encode_bytes(t.as_py()) if t.is_valid else None for t in texts], m.dtype)

    return ids(F.col(text))


def _text(model: Transducer, ids: np.ndarray) -> str:
    return model.decode(ids[(ids >= 0) & (ids < len(model.surface))].tolist())


def decode_column(spark: SparkSession, model: Transducer, ids: str) -> Column:
    """Text of each array of ids; null for null. Ids outside the model, and null ones, write nothing."""
    shared = share(spark, model)

    @F.arrow_udf(T.StringType())
    def text(arrays: pa.Array) -> pa.Array:
        m = shared()
        return pa.array([_text(m, a.values.drop_null().to_numpy(zero_copy_only=False)) if a.is_valid else None for a in arrays], pa.string())

    return text(F.col(ids))


def encode_documents(docs: DataFrame, model: Transducer, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts (replacing a column of that name). All rows stay, repeated ones too."""
    return docs.withColumn(out, encode_column(docs.sparkSession, model, text))


def decode_documents(rows: DataFrame, model: Transducer, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of its ids (replacing a column of that name)."""
    return rows.withColumn(out, decode_column(rows.sparkSession, model, ids))


def round_trip(docs: DataFrame, model: Transducer, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of its texts and the texts of these ids (replacing columns of these names), in one pass. Spark
    writes a column's expression out wherever the column is read, so `decode_documents` straight after `encode_documents`
    encodes every text twice; here both come from one call. Null texts have null ids and null decoded text. All rows stay."""
    shared = share(docs.sparkSession, model)
    both = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    @F.arrow_udf(both)
    def there_and_back(texts: pa.Array) -> pa.Array:
        m = shared()
        parts = [m.encode_bytes(t.as_py()) if t.is_valid else None for t in texts]
        back = [None if p is None else _text(m, np.frombuffer(p, m.dtype)) for p in parts]
        return pa.StructArray.from_arrays([_lists(parts, m.dtype), pa.array(back, pa.string())], ["ids", "decoded"])

    own = unlike(docs, "_pieces_") + "both"
    return (docs.withColumn(own, there_and_back(named(text)))
            .withColumns({ids: F.col(own)["ids"], decoded: F.col(own)["decoded"]}).drop(own))
