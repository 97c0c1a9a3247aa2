"""Peptide-hit processing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rangejoin import Tol, range_join
from .scans import top_n


def synopsis(psm: DataFrame, pvalue_col: str = "spec_evalue", prob_col: str | None = None,
             pvalue: float = 0.02, prob: float = 0.05, mode: str = "or") -> DataFrame:
    """G1: keep matches with p-value <= ``pvalue`` (or/and prob <= ``prob``)."""
    c = F.col(pvalue_col) <= pvalue
    if prob_col:
        c2 = F.col(prob_col) <= prob
        c = (c | c2) if mode == "or" else (c & c2)
    return psm.where(c)


def first_hits(psm: DataFrame, keys: Sequence[str] = ("dataset", "scan", "charge"),
               score: str = "spec_evalue", lower_is_better: bool = True,
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Best match per (dataset, scan, charge)."""
    o = F.col(score).asc() if lower_is_better else F.col(score).desc()
    return top_n(psm, keys, [o, *[F.col(t).asc() for t in tiebreak]], 1).drop("rn")


def clean_sequence(col: Column) -> Column:
    """Strip flanking residues (``K.PEPTIDE.R``; any one character, such as - or _ at a protein's end) and modification symbols."""
    core = F.regexp_replace(col, r"^.?\.(.*)\..?$", "$1")
    return F.regexp_replace(core, r"[^A-Z]", "")


def seq_info(syn: DataFrame, peptide: str = "peptide") -> DataFrame:
    """Unique sequences with a stable id (xxhash64: no global numbering)."""
    return syn.select(peptide).distinct().withColumn("seq_id", F.xxhash64(peptide))


def result_to_seq(syn: DataFrame, result_id: str = "result_id", peptide: str = "peptide") -> DataFrame:
    """Result id -> sequence id."""
    return syn.select(result_id, F.xxhash64(peptide).alias("seq_id"))


def seq_to_protein(syn: DataFrame, peptide: str = "peptide", protein: str = "protein") -> DataFrame:
    """Sequence id -> protein, one row per pair (list-valued proteins split)."""
    p = F.explode(F.split(F.col(protein), ";"))
    return syn.select(F.xxhash64(peptide).alias("seq_id"), p.alias(protein)).distinct()


def map_peptides(peptides: DataFrame, digested: DataFrame, peptide: str = "peptide") -> DataFrame:
    """Peptide -> every protein (and start) containing it, by an equi-join
    with the digest output on the sequence."""
    return peptides.select(peptide).distinct().join(digested, on=peptide, how="inner")


#: Positions that one exploded row covers; characters are counted from its start.
RUN = 32


def _positions(proteins: DataFrame, accession: str, sequence: str, reach: int) -> DataFrame:
    """(accession, _at, _text, _i): a row per position _at + _i of the sequences, with the run's text and ``reach`` - 1 characters
    more. Runs are cut off by one regex pass, and the positions in them exploded from a range, in generated code."""
    d = proteins.where(F.col(sequence).isNotNull()).select(accession, F.regexp_extract_all(sequence, F.lit(f"(?s).{{1,{RUN}}}"), 0).alias("_blocks"))
    d = d.select(accession, "_blocks", F.posexplode("_blocks").alias("_k", "_block"))
    more = F.array_join(F.slice("_blocks", F.col("_k") + 2, F.lit(-(-reach // RUN))), "")
    d = d.select(accession, (F.col("_k") * RUN).alias("_at"), F.length("_block").alias("_n"),
                 F.concat("_block", F.substring(more, 1, reach)).alias("_text"))
    return d.select(accession, "_at", "_text", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i"))


def map_peptides_substring(peptides: DataFrame, proteins: DataFrame, peptide: str = "peptide",
                           accession: str = "accession", sequence: str = "sequence", k: int = 6) -> DataFrame:
    """G6 for peptides the digest does not produce (non-specific ends,
    missed cleavages beyond the limit): every protein containing the peptide,
    with its 1-based start (all occurrences; empty peptides have none).

    Positions whose first ``k`` characters begin no peptide are dropped first; what is left carries the text it can be
    compared with, meets the peptides in an equi-join on these characters and is verified. Texts are never joined back.
    Peptides shorter than ``k`` use their own length in its place."""
    pep = peptides.select(peptide).distinct().withColumn("_len", F.length(peptide)).where(F.col("_len") > 0)
    pep = pep.withColumn("_k", F.least(F.col("_len"), F.lit(k))).withColumn("_kmer", F.substring(peptide, 1, k))
    lens = pep.agg(F.max("_len").alias("longest"), F.collect_set("_k").alias("ks")).first()  # at most k lengths
    if lens["longest"] is None:
        return proteins.select(F.lit("").alias(peptide), accession, F.lit(0).alias("start")).limit(0)
    ks = sorted(lens["ks"])

    def head(n: int) -> Column:
        return F.substr("_text", F.col("_i") + 1, F.lit(n))

    # most positions go by their shortest head; only the rest are given all of them
    cand = _positions(proteins, accession, sequence, lens["longest"]).withColumn("_kmer", head(ks[0]))
    cand = cand.join(pep.select(F.substring("_kmer", 1, ks[0]).alias("_kmer")).distinct(), on="_kmer", how="left_semi")
    if len(ks) > 1:
        cand = cand.withColumn("_kmer", F.explode(F.array_distinct(F.array(*[head(n) for n in ks]))))
        cand = cand.join(pep.select("_kmer").distinct(), on="_kmer", how="left_semi")
    cand = cand.select("_kmer", accession, (F.col("_at") + F.col("_i") + 1).cast("int").alias("start"),
                       F.substr("_text", F.col("_i") + 1, F.lit(lens["longest"])).alias("_win"))
    hit = cand.join(pep.select(peptide, "_kmer"), on="_kmer").where(F.col("_win").startswith(F.col(peptide)))
    return hit.select(peptide, accession, "start")


def mod_details(df: DataFrame, key: Sequence[str], sequence: str, mod_defs: DataFrame,
                residue_pattern: str = "A-Z") -> DataFrame:
    """One row per modified residue. A residue is a letter of
    ``residue_pattern``; the characters after it (up to the next residue) are
    its symbols. ``mod_defs(symbol, residue, mod_name, mass)``: an empty
    symbol is a static modification (any occurrence of the residue), otherwise
    the symbol must follow the residue. Position = residue index (1-based)."""
    toks = F.regexp_extract_all(F.col(sequence), F.lit(f"([{residue_pattern}])([^{residue_pattern}]*)"), 0)
    e = df.select(*key, F.posexplode(toks).alias("_i", "_t"))
    e = e.select(*key, (F.col("_i") + 1).cast("int").alias("position"),
                 F.substring("_t", 1, 1).alias("residue"), F.expr("substring(_t, 2)").alias("_sym"))
    # a modification list, broadcast by name: without known bytes of it the planner would send the residues through the driver
    d = F.broadcast(mod_defs)
    cond = (e["residue"] == d["residue"]) & ((d["symbol"] == "") | (F.instr(e["_sym"], d["symbol"]) > 0))
    j = e.join(d, cond, "inner")
    return j.select(*[e[k] for k in key], e["position"], e["residue"], d["symbol"], d["mod_name"], d["mass"])


def mod_summary(details: DataFrame, key: Sequence[str]) -> DataFrame:
    """Count per modification."""
    return details.groupBy("mod_name", "residue", "mass").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(*key).alias("n_items"))


def protein_mods(details: DataFrame, mapping: DataFrame, peptide: str = "peptide",
                 start: str = "start") -> DataFrame:
    """Residue number inside the protein = start + position - 1."""
    j = details.join(mapping, on=peptide, how="inner")
    return j.withColumn("protein_position", F.col(start) + F.col("position") - 1)


def name_masses(mods: DataFrame, tags: DataFrame, key: Sequence[str], mass: str, tag_mass: str,
                tag_name: str, tol: float, tag_tiebreak: str | None = None) -> DataFrame:
    """The tag whose mass is closest (within ``tol``); ties by the smaller
    tie-break value. Of the tags of one mass only the first by tie-break can be the answer, so the range join takes one tag a
    mass; then one min over (distance, tie-break)."""
    tb = tag_tiebreak or tag_name
    first = F.min(F.struct(F.col(tb).alias("t"), F.col(tag_name).alias("n")))
    one = tags.groupBy(F.col(tag_mass).alias("_tag")).agg(first.alias("_first"))
    j = range_join(mods, one, [Tol(mass, "_tag", tol)])
    best = F.min(F.struct(F.abs(F.col(mass) - F.col("_tag")).alias("d"), F.col("_first.t").alias("t"), F.col("_first.n").alias("n")))
    g = j.groupBy(*key).agg(best.alias("_b"))
    return g.select(*key, F.col("_b")["n"].alias(tag_name), F.col("_b")["d"].alias("distance"))
