"""Error probabilities by isotonic regression and target-decoy competition."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import ordered
from .common import is_number, join_on_keys
from .search import target_decoy_fdr


def isotonic(df: DataFrame, order: str, value: str, weight: str, by: Sequence[str] = (), descending: bool = False,
             name: str = "fit", chunk_rows: int = ordered.CHUNK_ROWS) -> DataFrame:
    """``df`` with ``name``: per ``by`` group, the non-decreasing sequence along ``order`` that is nearest to ``value`` / ``weight``
    in squares weighted by ``weight``. value holds sums (not means) and weight is above zero; several rows of one ``order`` count as one.

    Pools adjacent violators: neighbours whose means don't rise become one block. Which pairs are pooled first does not
    matter, so ranges of a long group are pooled on their own and the blocks that are left go into the next round
    (`ordered.contracted`). Integer sums are compared exactly, as products of integers. Null and NaN ``order`` have no place: null fit."""
    points = df.where(is_number(df, order)).groupBy(*by, order).agg(F.sum(value).alias("_y"), F.sum(weight).alias("_w"))

    def pool(pdf: pd.DataFrame) -> pd.DataFrame:
        first, ys, ws = [], [], []
        for i, (y, w) in enumerate(zip(pdf["_y"].tolist(), pdf["_w"].tolist())):
            first.append(i)
            ys.append(y)
            ws.append(w)
            while len(ys) > 1 and ys[-2] * ws[-1] >= ys[-1] * ws[-2]:
                y, w = ys.pop(), ws.pop()
                first.pop()
                ys[-1] += y
                ws[-1] += w
        return pdf.iloc[first].assign(_y=ys, _w=ws)

    blocks = ordered.contracted(points, order, by, pool, 2, descending, chunk_rows)
    # a block is known at its first point; means rise, so the running maximum carries them on
    marked = join_on_keys(points.select(*by, order), blocks.select(*by, order, (F.col("_y") / F.col("_w")).alias("_fit")), [*by, order], how="left")
    fit = ordered.running_agg(marked, order, {name: ("max", F.col("_fit"))}, by, descending=descending).select(*by, order, name)
    return join_on_keys(df, materialize(fit, "isotonic"), [*by, order], how="left")


def error_probability(psm: DataFrame, score: str, is_decoy: Column | str, by: Sequence[str] = (), higher_is_better: bool = True,
                      chunk_rows: int = ordered.CHUNK_ROWS) -> DataFrame:
    """G1, H3: per distinct score (and ``by`` group) the probability that a target match of this score is wrong: decoys /
    targets of its block in the isotonic regression of the decoy share, which never falls from better to worse scores; 1 at
    most. Columns: by, score, n_target, n_decoy, decoy_share, error_probability. Matches without a score (null, NaN) are left out,
    as are those that are neither target nor decoy (null)."""
    dec = F.col(is_decoy) if isinstance(is_decoy, str) else is_decoy
    s = psm.where(is_number(psm, score) & dec.isNotNull()).groupBy(*by, score).agg(
        F.count_if(~dec).alias("n_target"), F.count_if(dec).alias("n_decoy"))
    fit = isotonic(s.withColumn("_all", F.col("n_target") + F.col("n_decoy")), score, "n_decoy", "_all", by, higher_is_better, "decoy_share", chunk_rows)
    odds = F.when(F.col("decoy_share") < 0.5, F.col("decoy_share") / (1 - F.col("decoy_share"))).otherwise(1.0)
    return fit.select(*by, score, "n_target", "n_decoy", "decoy_share", odds.alias("error_probability"))


def compete(hits: DataFrame, accession: str, score: str, is_decoy: str, decoy_prefix: str = "XXX_", by: Sequence[str] = (),
            higher_is_better: bool = True) -> DataFrame:
    """H3 at protein level: a protein and its decoy (the same accession after ``decoy_prefix``) compete by their best match, and
    only the better of the two stays; equal scores stay as the decoy, so that ties never lower an error rate. One
    row per ``by`` and pair: the winner's accession, score, is_decoy. `search.target_decoy_fdr` and `error_probability` take
    these rows. Matches without a score, accession or decoy mark are left out."""
    known = hits.where(is_number(hits, score) & F.col(accession).isNotNull() & F.col(is_decoy).isNotNull())
    n = len(decoy_prefix)
    pair = F.when(F.col(is_decoy) & F.col(accession).startswith(decoy_prefix), F.expr(f"substring(`{accession}`, {n + 1})")).otherwise(F.col(accession))
    best = F.struct(F.col(score).alias("s"), F.col(is_decoy).alias("d"), F.col(accession).alias("a"))
    if not higher_is_better:  # the decoy is first among equals as the smaller of the two
        best = F.struct(F.col(score).alias("s"), (~F.col(is_decoy)).alias("d"), F.col(accession).alias("a"))
    won = known.groupBy(*by, pair.alias("_pair")).agg((F.max if higher_is_better else F.min)(best).alias("_best"))
    decoy = F.col("_best.d") if higher_is_better else ~F.col("_best.d")
    return won.select(*by, F.col("_best.a").alias(accession), F.col("_best.s").alias(score), decoy.alias(is_decoy))


def protein_confidence(hits: DataFrame, accession: str, score: str, is_decoy: str, decoy_prefix: str = "XXX_", higher_is_better: bool = True) -> DataFrame:
    """H3 at protein level: the rows of `compete` with q_value (`search.target_decoy_fdr`) and error_probability of their scores."""
    won = materialize(compete(hits, accession, score, is_decoy, decoy_prefix, (), higher_is_better), "winners")
    q = target_decoy_fdr(won, score, is_decoy, higher_is_better=higher_is_better).select(score, "q_value")
    p = error_probability(won, score, is_decoy, higher_is_better=higher_is_better).select(score, "error_probability")
    return join_on_keys(join_on_keys(won, q, [score]), p, [score])
