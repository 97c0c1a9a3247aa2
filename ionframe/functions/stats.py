"""Column functions for scores (native expressions, no Python per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_choose(n: Column, k: Column) -> Column:
    """ln C(n, k) as a sum of logs (k terms; exact up to float rounding)."""
    kk = F.least(k, n - k)
    return F.when(kk <= 0, F.lit(0.0)).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.greatest(kk, F.lit(1)).cast("int")), F.lit(0.0),
        lambda a, i: a + F.log(n - kk + i) - F.log(i)))


def binomial_tail_log10(n_trials: Column, n_success: Column, p: float | Column) -> Column:
    """log10 P(X >= k) for X ~ Binomial(n, p).

    The first term ln C(n,k) + k ln p + (n-k) ln(1-p) is formed in log space;
    the following terms are accumulated as ratios to it (each step multiplies
    by (n-j)/(j+1) * p/(1-p)), so nothing underflows for large n.
    """
    n = n_trials.cast("int")
    k = n_success.cast("int")
    if isinstance(p, Column):
        lp, lq, ratio = F.log(p), F.log1p(-p), p / (1 - p)
    else:
        lp, lq, ratio = F.lit(math.log(p)), F.lit(math.log1p(-p)), F.lit(p / (1 - p))
    first = log_choose(n, k) + k * lp + (n - k) * lq
    rel = F.aggregate(
        F.sequence(k, F.greatest(n - 1, k)),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("acc")),
        lambda s, j: F.when(j < n, F.struct(
            (s["term"] * (n - j) / (j + 1) * ratio).alias("term"),
            (s["acc"] + s["term"] * (n - j) / (j + 1) * ratio).alias("acc"))).otherwise(s),
        lambda s: s["acc"])
    return F.when(k <= 0, F.lit(0.0)).when(k > n, F.lit(None).cast("double")).otherwise(
        (first + F.log(rel)) / F.lit(math.log(10)))


def norm2(a: Column) -> Column:
    """Sum of the squares of a numeric array (double math)."""
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))


def cosine(a: Column, b: Column, squares: tuple[Column, Column] | None = None) -> Column:
    """Cosine similarity of two equal-length numeric arrays (double math). For many pairs, ``squares`` are the arrays' `norm2`, found once a row."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda s, v: s + v)
    na, nb = squares or (norm2(a), norm2(b))
    return F.when((na > 0) & (nb > 0), dot / (F.sqrt(na) * F.sqrt(nb)))


def epoch_micros(col: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ column (wall
    time read as UTC), independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col)


def decode_path(col: Column) -> Column:
    """Percent-decode a file URI / name (``_metadata`` and ``binaryFile`` give
    URI-encoded paths). A literal '+' is kept (form decoding would turn it
    into a blank)."""
    return F.url_decode(F.replace(col, F.lit("+"), F.lit("%2B")))
