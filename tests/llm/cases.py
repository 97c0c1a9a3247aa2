"""Small tables with the awkward cases, and brute-force helpers."""

import re
import zlib

import numpy as np

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, shard double, component_id string, mix_size string"


def odd_rows() -> list:
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    r = [(1, "one two three four five six", "en", "a", 27), (2, "one two three four five six", "en", "a", 27),
         (3, None, "en", "b", None), (4, "", None, None, 0), (5, " \t\n ", "en", "b", 4), (6, "Word", "de", "b", 4),
         (7, "two words", "de", "c", 9), (8, long, "en", "c", len(long)), (9, "ünï çødé \U0001f600 text here", "fr", "", 20),
         (None, "one two three four five six", "en", "a", 27), (10, None, None, "a", None), (2, "one two three four five six", "en", "a", 27)]
    r += [(20 + i, "hot group of copies " * 5, "en", "a", 100) for i in range(20)]
    return [(*x, 1, "x", 0.5, "y", "z") for x in r]


def odd_docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOC_SCHEMA)


def crc(x) -> int:
    return zlib.crc32(("" if x is None else str(x)).encode())


def roots(n: int, pairs) -> list:
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
