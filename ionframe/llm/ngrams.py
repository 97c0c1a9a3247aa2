"""Hashed word n-grams of whole texts, computed for an Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at a time; longer texts are cut at white space, their words put together again.
SEGMENT = 1 << 20
#: Texts are scored in runs of about so many bytes.
RUN = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint64) + np.uint64(1)
#: Classes of bytes that make up a word's form.
_FORM = np.full(256, 128, dtype=np.uint8)
for _c in range(256):
    _ch = chr(_c)
    _FORM[_c] = (1 if "a" <= _ch <= "z" or _c >= 128 else 2 if "A" <= _ch <= "Z" else 4 if "0" <= _ch <= "9"
                 else {".": 8, ",": 16, "!": 32, "?": 64}.get(_ch, 128))


#: What words are hashed by.
BASES = ("word", "form", "stem4", "stem5")


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class _Tables:
    """Powers of the base and of its inverse, made once where they are used."""

    up = down = None

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.up is None or len(cls.up) < n:
            size = max(n, SEGMENT + 1)
            cls.up, cls.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    return h * np.uint64(0x94D049BB133111EB) ^ (h >> np.uint64(32))


def _segment(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, dict]:
    """Starts, and hash, form and stems of the words of a piece of text; ``breaks``: where documents begin."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    at = breaks[breaks < len(data)]
    first[at] = word[at]
    start = np.flatnonzero(first)
    if not len(start):
        return start, {k: np.zeros(0, dtype=np.uint64) for k in BASES}
    up, down = _Tables.get(len(data))
    value = np.where(word, _LOWER[data], np.uint64(0)) * up[:len(data)]
    h = np.add.reduceat(value, start) * down[start]
    kinds = np.bitwise_or.reduceat(np.where(word, _FORM[data], np.uint8(0)), start).astype(np.uint64)
    size = np.add.reduceat(word.astype(np.int64), start)
    form = kinds | ((np.minimum(size, 30) // 3).astype(np.uint64) << np.uint64(8))
    stems, stem = {}, np.zeros(len(start), dtype=np.uint64)
    for i in range(5):
        byte = _LOWER[data[np.minimum(start + i, len(data) - 1)]]
        stem = stem * np.uint64(512) + np.where(size > i, byte, np.uint64(0))
        stems[f"stem{i + 1}"] = stem
    return start, {"word": mix(h), "form": form, "stem4": mix(stems["stem4"]), "stem5": mix(stems["stem5"])}


def words(texts: pa.Array) -> tuple[np.ndarray, dict]:
    """Document of every word of a string array, in order, and the words' BASES: hash of the
    word, its form (kinds of characters, length), hash of its first 4 and 5 bytes. Words are
    runs of anything but ASCII white space, in lower case (A-Z) but for the form; null texts have none."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    at, parts = 0, []
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[end - 4096 if end - 4096 > at else at:end]])
            if len(gaps):
                end = (end - 4096 if end - 4096 > at else at) + int(gaps[-1]) + 1
                break
            if end in (i := offsets[np.searchsorted(offsets, end):np.searchsorted(offsets, end) + 1]) and len(i):
                break
            end = min(end + 4096, len(data))
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        start, found = _segment(data[at:end], inside)
        parts.append((start + at, found))
        at = end
    if not parts:
        return np.zeros(0, dtype=np.int64), {k: np.zeros(0, dtype=np.uint64) for k in BASES}
    start = np.concatenate([p for p, _ in parts])
    return np.searchsorted(offsets, start, side="right") - 1, {k: np.concatenate([f[k] for _, f in parts]) for k in BASES}


def grams(doc: np.ndarray, found: dict, kinds: tuple, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) arrays of one kind after another. Kinds: ("word", offsets) takes the word and those
    at these distances after it, so ("word", (1, 2)) is a trigram and ("word", (2,)) a skip-gram;
    ("form", offsets) does so with forms, marked where a word is one of the three before, and "stem4" and
    "stem5" with stems."""
    h, form = found["word"], found["form"]
    again = np.zeros(len(h), dtype=np.uint64)
    for back in (1, 2, 3):
        again[back:] |= ((h[back:] == h[:-back]) & (doc[back:] == doc[:-back])).astype(np.uint64) << np.uint64(back - 1)
    forms = mix(form + np.uint64(1) | again << np.uint64(20))
    for number, (what, offsets) in enumerate(kinds):
        base = forms if what == "form" else found[what]
        far = max(offsets, default=0)
        n = len(base) - far
        if n <= 0:
            continue
        f = base[:n] + np.uint64(number + 1)
        ok = doc[:n] == doc[far:]
        for o in offsets:
            f = mix(f) + base[o:o + n]
        yield doc[:n][ok], (mix(f)[ok] & np.uint64(dims - 1)).astype(np.int64)


def runs(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(place of its first text, slice) of slices of about RUN bytes, a text at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    ends = np.cumsum(sizes)
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + RUN)))
        yield at, texts.slice(at, stop - at)
        at = stop
