"""Protein inference and connected components (§4.5)."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_stored, materialize, materialize_at
from .components import star_components
from .ordered import row_number, running_agg
from .search import target_decoy_fdr


def filter_fdr(psm: DataFrame, score: str, is_decoy: str, max_fdr: float = 0.01,
               level_key: Sequence[str] = (), higher_is_better: bool = True) -> DataFrame:
    """H3: drop decoys and keep rows whose q-value <= ``max_fdr``. With
    ``level_key`` (peptide or protein) the best score per key is used."""
    base = psm
    if level_key:
        agg = F.max if higher_is_better else F.min
        base = psm.groupBy(*level_key).agg(agg(score).alias(score), F.max(F.col(is_decoy).cast("int")).alias(is_decoy))
        base = base.withColumn(is_decoy, F.col(is_decoy) == 1)
    q = target_decoy_fdr(base, score, is_decoy, higher_is_better=higher_is_better)
    ok = q.where(F.col("q_value") <= max_fdr).select(score, "q_value")
    keep = base.join(ok, on=score, how="inner").where(~F.col(is_decoy))
    if level_key:
        return psm.join(keep.select(*level_key, "q_value"), on=list(level_key), how="inner")
    return keep


def unique_only(edges: DataFrame, peptide: str = "peptide", protein: str = "protein") -> DataFrame:
    """H6: keep peptides that map to exactly one protein."""
    e = edges.select(peptide, protein).distinct()
    one = e.groupBy(peptide).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return e.join(one.select(peptide), on=peptide, how="left_semi")


#: Leading bits of a count that make its class, so counts of a class differ by an eighth at most.
CLASS_BITS = 4


def _round(e: DataFrame, share: float, n: int) -> DataFrame:
    """``e`` (pep, prot), uncovered edges with proteins numbered from 0 to ``n`` - 1 in tie order, after one round: owner is
    null for those still uncovered, and the other rows are the (pep, prot) that were assigned."""
    if share >= 1:
        key, of = "named_struct('a', -cnt, 'b', prot)", "{}.b"
    else:  # class and number in one integer
        key = f"({64 << CLASS_BITS} - (length(bin(cnt)) << {CLASS_BITS}) - cast(conv(substring(bin(cnt), 1, {CLASS_BITS}), 2, 10) AS long)) * {n}L + prot"
        of = f"{{}} % {n}L"
    return e.sparkSession.sql(f"""
        WITH c AS (SELECT prot, count(*) AS cnt FROM {{e}} GROUP BY prot),
        k AS (SELECT prot, cnt, {key} AS key FROM c),
        best AS (SELECT pep, min(key) AS key FROM {{e}} JOIN k USING (prot) GROUP BY pep),
        votes AS (SELECT {of.format("key")} AS prot, count(*) AS n FROM best GROUP BY 1),
        taken AS (SELECT prot, key FROM k JOIN votes USING (prot) WHERE n >= {float(share)}D * cnt),
        owners AS (SELECT pep, min(key) AS key FROM {{e}} JOIN taken USING (prot) GROUP BY pep)
        SELECT * FROM (SELECT pep, prot, {of.format("o.key")} AS owner FROM {{e}} LEFT JOIN owners o USING (pep)) WHERE owner IS NULL OR owner = prot""", e=e)


#: Edges that one task of the one-at-a-time greedy takes at once.
TASK_EDGES = 1 << 22


def _picks(rows: pd.DataFrame) -> pd.DataFrame:
    """(pep, prot) that the one-at-a-time greedy assigns on ``rows`` (pep, prot, stop_n, stop_no: whole sets of uncovered peptides) before
    its turn comes to the protein ``stop_no`` of ``stop_n`` peptides; 0 peptides stand for none."""
    pep, peps = pd.factorize(rows["pep"], use_na_sentinel=False)  # NaN is a value
    prot, prots = pd.factorize(rows["prot"], sort=True)
    stop = (-int(rows["stop_n"].iat[0]), int(rows["stop_no"].iat[0]))
    members, of = pep[np.argsort(prot, kind="stable")], prot[np.argsort(pep, kind="stable")]
    left, degree = np.bincount(prot), np.bincount(pep)
    first, at = np.r_[0, np.cumsum(left)], np.r_[0, np.cumsum(degree)]
    owner = np.full(len(peps), -1)
    heap = [(-n, i) for i, n in enumerate(left.tolist())]
    heapq.heapify(heap)
    while heap:
        n, i = heapq.heappop(heap)
        now = int(left[i])
        if -n != now:  # peptides have gone since
            if now:
                heapq.heappush(heap, (-now, i))
            continue
        if (n, int(prots[i])) > stop:
            break
        mine = members[first[i]:first[i + 1]]
        mine = mine[owner[mine] < 0]
        owner[mine] = i
        d = degree[mine]
        np.subtract.at(left, of[np.repeat(at[mine] - np.cumsum(d) + d, d) + np.arange(d.sum())], 1)
    done = owner >= 0
    return pd.DataFrame({"pep": peps[done], "prot": prots[owner[done]]})


def _in_components(e: DataFrame) -> DataFrame:
    """``e`` (pep, prot) with the component that its protein is in. Proteins are linked by the first one of each of their peptides."""
    links = e.join(e.groupBy("pep").agg(F.min("prot").alias("low")), on="pep").select("prot", "low").distinct()
    c = star_components(links, "prot", "low")
    return e.join(c.select(F.col("node").alias("prot"), "component"), on="prot", how="left").select(
        "pep", "prot", F.coalesce("component", "prot").alias("comp"))


def _dealt(e: DataFrame, sizes: DataFrame) -> DataFrame:
    """The edges (pep, prot, stop_n, stop_no) of tasks (task): whole components of ``e`` (pep, prot, comp) with at most TASK_EDGES edges by
    ``sizes`` (comp, m), small ones together; of a larger one the first proteins with as many edges, which the greedy may take up to the next one's turn."""
    parts = int(e.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = sizes.where(F.col("m") <= TASK_EDGES)
    some = max(parts, -(-(small.agg(F.sum("m")).first()[0] or 0) // TASK_EDGES))
    task = F.when(F.col("m") * 64 > TASK_EDGES, F.col("comp")).otherwise(-1 - F.pmod(F.xxhash64("comp"), F.lit(some)))
    none = F.lit(0).cast("long")
    whole = e.join(small.select("comp", task.alias("task")), on="comp").select("task", "pep", "prot", none.alias("stop_n"), none.alias("stop_no"))
    large = sizes.where(F.col("m") > TASK_EDGES).select("comp")
    if large.isEmpty():
        return whole
    count = e.join(large, on="comp", how="left_semi").groupBy("comp", "prot").agg(F.count(F.lit(1)).alias("cnt"))
    along = materialize(running_agg(count, "cnt", {"upto": ("sum", F.col("cnt"))}, ["comp"], ["prot"], descending=True), "cover-along")
    stop = along.where(F.col("upto") > TASK_EDGES).groupBy("comp").agg(F.min(F.struct((-F.col("cnt")).alias("n"), "prot")).alias("s"))
    first = along.where(F.col("upto") <= TASK_EDGES).select("comp", "prot").join(stop, on="comp")
    begun = e.join(first, on=["comp", "prot"]).select(F.col("comp").alias("task"), "pep", "prot", (-F.col("s.n")).alias("stop_n"), F.col("s.prot").alias("stop_no"))
    return whole.unionByName(begun)


def _one_at_a_time(e: DataFrame, n: int, rounds: list | None) -> list[DataFrame]:
    """Parts of the one-at-a-time greedy's (pep, prot) on ``e`` (pep, prot), proteins numbered from 0 to ``n`` - 1 in tie order."""
    spark, parts, split, at = e.sparkSession, [], None, None
    shape = T.StructType([e.schema["pep"], e.schema["prot"]])
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while edges := e.count():
        if rounds is not None:
            rounds.append(len(rounds))
        if edges <= TASK_EDGES:
            e = e.select("pep", "prot", F.lit(0).cast("long").alias("comp"))
        elif split is None or 2 * edges <= split:
            e, old, split = *materialize_at(_in_components(e.select("pep", "prot")), "cover-edges"), edges
            at = _replaced(spark, at, old)
        sizes = materialize(e.groupBy("comp").agg(F.count(F.lit(1)).alias("m")), "cover-sizes")
        tasks = _dealt(e, sizes).repartition(deal, "task")
        found = materialize(tasks.groupBy("task").applyInPandas(_picks, shape), "cover-picks")
        parts.append(found)
        large = sizes.where(F.col("m") > TASK_EDGES).select("comp")
        if large.isEmpty():
            break
        # in large components all local bests too
        rest = e.join(large, on="comp", how="left_semi")
        best = _round(rest.select("pep", "prot"), 1, n).where("owner is not null").select("pep", "prot")
        best = materialize(best.join(found, on="pep", how="left_anti"), "cover-round")
        parts.append(best)
        e, old = materialize_at(rest.join(found.unionByName(best).select("pep"), on="pep", how="left_anti"), "cover-edges")
        at = _replaced(spark, at, old)
    if at:
        drop_stored(spark, at)
    return parts


def _replaced(spark: SparkSession, old: str | None, new: str) -> str:
    if old:
        drop_stored(spark, old)
    return new


def greedy_cover(edges: DataFrame, peptide: str = "peptide", protein: str = "protein", share: float = 0.5,
                 rounds: list | None = None) -> DataFrame:
    """H5: few proteins that explain every peptide; one row per peptide with the protein it is assigned to. Edges with
    a null end are left out.

    Rounds over all edges that are left, each a handful of joins and aggregates on proteins or peptides, so no component of the graph,
    however dense, needs a task of its own. In a round every uncovered peptide votes for the protein first in
    priority among those that have it; a protein voted for by at least ``share`` of its uncovered peptides is taken and
    its peptides leave the graph. Priority is the number of uncovered peptides, by classes that differ by an eighth, then a
    hash of the accession, which breaks ties in a shuffled order so that chains of ties are short; a peptide of several taken proteins goes to
    the first of them. The first protein of all is always taken, so every round makes progress.

    A taken protein is at least as large, but for its class, as any protein that its voters have, and costs each of them 1 / (share x its
    size) at most, which bounds the number of proteins by 9/8 / share times the one-at-a-time greedy's own bound (H(n) times the least).

    With ``share`` 1 the result is that of the one-at-a-time greedy by (uncovered peptides, all peptides, smaller accession). Its picks are a
    long chain, so tasks follow it as far as TASK_EDGES edges show it: to the end in components of the graph that have no more, and in a larger one among its first
    proteins, until a protein outside could be next (counts only fall, so none of these comes earlier). There a round also takes all proteins that every one
    of their uncovered peptides votes for, wherever they are: nothing that shares a peptide with them comes first. What is left is cut into components
    again once half of it has gone. ``rounds`` collects a mark per round.
    """
    spark = edges.sparkSession
    e, at = materialize_at(edges.select(F.col(peptide).alias("pep"), F.col(protein).alias("prot"))
                           .where(F.col(peptide).isNotNull() & F.col(protein).isNotNull()).distinct(), "cover-edges")
    prots = e.groupBy("prot").agg(F.count(F.lit(1)).alias("total"))
    if share < 1:
        prots = prots.withColumn("rank", F.conv(F.substring(F.md5(F.col("prot").cast("string").cast("binary")), 1, 15), 16, 10).cast("long"))
    order = F.col("rank") if share < 1 else -F.col("total")
    prots = materialize(row_number(prots, order, tiebreak=["prot"], name="no").select("prot", (F.col("no") - 1).alias("no")), "cover-proteins")
    n = prots.count()
    e, first = materialize_at(e.join(prots, on="prot").select("pep", F.col("no").alias("prot")), "cover-edges")
    drop_stored(spark, at)
    parts = _one_at_a_time(e, n, rounds) if share >= 1 else []
    while share < 1 and not e.isEmpty():
        if rounds is not None:
            rounds.append(len(rounds))
        done = materialize(_round(e, share, n), "cover-round")
        parts.append(done.where("owner is not null").select("pep", "prot"))
        e = done.where("owner is null").drop("owner")
    drop_stored(spark, first)
    if not parts:
        return edges.select(peptide, protein).limit(0)
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    named = res.join(prots.withColumnRenamed("prot", "name"), on=res["prot"] == prots["no"])
    return named.select(F.col("pep").alias(peptide), F.col("name").alias(protein))


#: Bits of a set's signature, by words of 64; a set that has another one's peptides has its bits.
SIGNATURE_WORDS = 4


def protein_groups(edges: DataFrame, peptide: str = "peptide", protein: str = "protein", prefix: int = 1) -> DataFrame:
    """Per protein: group_id (the smallest accession with the same peptides), n_peptides, and contained_in: of the groups
    that have all of its peptides and more, the one with the most (then the smallest accession), or null. Edges with a null end are left out.

    Equal sets are found by their size and two order-free sums of peptide hashes, so no set is collected. For
    containment a set is looked up by its ``prefix`` rarest peptides: a larger set must have all of them, and the bits of
    all peptides in its signature, which the join checks pair by pair, so that hardly any other pair becomes a row. The few that are
    left are verified by counting shared peptides. A set of one peptide needs no pairs: the largest set that has the peptide holds it.
    """
    e = edges.select(F.col(peptide).alias("pep"), F.col(protein).alias("prot")) \
        .where(F.col(peptide).isNotNull() & F.col(protein).isNotNull()).distinct()
    e = materialize(e, "group-edges")
    text = F.col("pep").cast("string")
    bit = F.xxhash64(F.lit(2), text)
    words = [F.bit_or(F.when(F.shiftrightunsigned(bit, 40) % SIGNATURE_WORDS == i, F.expr("shiftleft(1L, cast(xxhash64(2, cast(pep AS string)) & 63 AS int))"))
                      .otherwise(F.lit(0).cast("long"))).alias(f"g{i}") for i in range(SIGNATURE_WORDS)]
    sets = e.groupBy("prot").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(text)).alias("x"),
                                 F.sum(F.xxhash64(F.lit(1), text).cast("decimal(38,0)")).alias("s"), *words)
    sets = materialize(sets, "group-sets")
    named = sets.groupBy("n", "x", "s").agg(F.min("prot").alias("group_id"))
    bits = [f"g{i}" for i in range(SIGNATURE_WORDS)]
    members = materialize(sets.join(named, on=["n", "x", "s"]).select("prot", "group_id", "n", *bits), "group-members")
    reps = members.where("prot = group_id").select("prot", "n", *bits)
    re = materialize(e.join(reps, on="prot"), "group-first")
    largest = re.groupBy("pep").agg(F.count(F.lit(1)).alias("f"), F.max("n").alias("most"))
    # of the sets with a peptide, the smallest accession among the largest, by fixed-width aggregates
    holder = re.join(largest.select("pep", "most"), on="pep").where("n = most").groupBy("pep", "most").agg(F.min("prot").alias("b"))
    single = re.where("n = 1").select("pep", F.col("prot").alias("a")).join(holder, on="pep").where("most > 1").select("a", F.col("b").alias("contained_in"))
    rare = re.where("n > 1").join(largest.select("pep", "f"), on="pep")
    place = F.row_number().over(Window.partitionBy("prot").orderBy("f", "pep"))
    head = rare.withColumn("_r", place).where(F.col("_r") <= prefix).select("pep", F.col("prot").alias("a"), F.col("n").alias("na"), *[F.col(g).alias(f"a{g}") for g in bits])
    other = re.select("pep", F.col("prot").alias("b"), F.col("n").alias("nb"), *bits)
    cand = head.join(other, on="pep").where("nb > na AND " + " AND ".join(f"a{g} & ~{g} = 0" for g in bits)).select("a", "na", "b", "nb")
    if prefix > 1:
        cand = cand.distinct()
    cand = materialize(cand, "group-candidates")
    shared = (cand.join(re.select(F.col("prot").alias("a"), "pep"), on="a").join(other.select("b", "pep"), on=["b", "pep"])
              .groupBy("a", "na", "b", "nb").agg(F.count(F.lit(1)).alias("c")).where("c = na").drop("c"))
    within = shared.groupBy("a").agg(F.min(F.struct((-F.col("nb")).alias("m"), F.col("b")))["b"].alias("contained_in"))
    out = members.join(within.unionByName(single), on=members["group_id"] == F.col("a"), how="left")
    return out.select(F.col("prot").alias(protein), "group_id", F.col("n").alias("n_peptides"), "contained_in")


def collapsed_cover(edges: DataFrame, peptide: str = "peptide", protein: str = "protein", share: float = 0.5,
                    members: str = "members") -> DataFrame:
    """H5 on groups: proteins with the same peptides are one, those whose peptides another one has too are left out, and
    the cover runs over the rest. One row per peptide with the group's accession and, in ``members``, how many proteins it stands for."""
    g = materialize(protein_groups(edges, peptide, protein), "cover-groups")
    kept = g.where(F.col("contained_in").isNull()).groupBy(F.col("group_id").alias(protein)).agg(F.count(F.lit(1)).alias(members))
    cover = greedy_cover(edges.join(kept.select(protein), on=protein, how="left_semi"), peptide, protein, share)
    return cover.join(kept, on=protein).select(peptide, protein, members)


def infer_parsimony(edges: DataFrame, peptide: str = "peptide", protein: str = "protein",
                    prior: DataFrame | None = None, prior_col: str | None = None,
                    refine_prior: bool = True, unique: bool = False, share: float = 0.5) -> DataFrame:
    """H5-H7. ``unique`` overrides the prior options. With a prior (a table of
    accessions): ``refine_prior`` runs the cover on prior proteins and, for
    the peptides no prior protein reaches, on the rest; without it those
    prior peptides keep all their prior proteins. ``share`` as of `greedy_cover`."""
    if unique:
        return unique_only(edges, peptide, protein)
    if prior is None:
        return greedy_cover(edges, peptide, protein, share)
    pr = prior.select(F.col(prior_col or protein).alias(protein)).distinct()
    e = edges.select(peptide, protein).distinct()
    pe = e.join(pr, on=protein, how="left_semi")
    rest = e.join(pe.select(peptide), on=peptide, how="left_anti").join(pr, on=protein, how="left_anti")
    first = greedy_cover(pe, peptide, protein, share) if refine_prior else pe
    return first.unionByName(greedy_cover(rest, peptide, protein, share))


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Component label (smallest node id) of every node with an edge to another one: (node, component)."""
    return star_components(edges, src, dst)
