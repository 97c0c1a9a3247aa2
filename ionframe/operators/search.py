"""Peptide search as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import ELEMENT_MASS, ISOTOPE_SPACING, PROTON, WATER
from ..functions.presets import Preset
from ..session import materialize
from . import ordered
from .rangejoin import Tol, _bins, range_join
from .scans import top_n


def add_decoys(proteins: DataFrame, accession: str = "accession", sequence: str = "sequence",
               prefix: str = "XXX_", decoy_col: str = "is_decoy") -> DataFrame:
    """Forward rows plus reversed copies with a prefixed accession."""
    fwd = proteins.withColumn(decoy_col, F.lit(False))
    rev = proteins.withColumns({accession: F.concat(F.lit(prefix), F.col(accession)),
                                sequence: F.reverse(sequence), decoy_col: F.lit(True)})
    return fwd.unionByName(rev)


def _map_literal(d: Mapping[str, float]) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(float(v)))])


def composition_mass(col: Column, masses: Mapping[str, float] = ELEMENT_MASS) -> Column:
    """Mass of an elemental composition such as ``C2H3N1O1`` or
    ``H-1N-1O1`` (count defaults to 1), or of a plain number."""
    toks = F.regexp_extract_all(col, F.lit(r"([A-Z][a-z]?)(-?\d*)"), 0)
    m = _map_literal(masses)

    def add(acc, t):
        el = F.regexp_extract(t, r"^([A-Z][a-z]?)", 1)
        n = F.regexp_extract(t, r"(-?\d+)$", 1)
        cnt = F.when(n == "", F.lit(1)).otherwise(n.cast("int"))
        return acc + m[el] * cnt
    from_comp = F.aggregate(toks, F.lit(0.0), add)
    num = col.try_cast("double")
    return F.when(col.rlike(r"^\s*-?[0-9.]+\s*$"), num).otherwise(from_comp)


def cleave(col: Column, pattern: str) -> Column:
    """Pieces of a sequence cut at a zero-width ``pattern`` (trypsin:
    ``(?<=[KR])(?!P)``); empty pieces dropped."""
    return F.filter(F.split(col, pattern), lambda p: p != "")


#: Starts that one exploded row covers; it carries only the text and pieces that these can reach.
CHUNK = 64


def _chunks(proteins: DataFrame, key: Sequence[str], sequence: str, rule: str, max_len: int) -> DataFrame:
    """Runs of CHUNK residues: key, _at (residues before), _n (of the whole sequence), _text (what peptides that begin here can
    reach), _of (piece index per residue, one more than they reach), _before (piece of the residue before, or -1)."""
    seq = F.col(sequence)
    of = F.flatten(F.transform(cleave(seq, rule), lambda x, j: F.array_repeat(j, F.length(x))))
    p = proteins.select(*key, F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{CHUNK}}}"), 0).alias("_blocks"), of.alias("_all"))
    p = p.select(*key, F.col("_all"), F.size("_all").alias("_n"), F.posexplode("_blocks").alias("_k", "_block"), "_blocks")
    at = F.col("_k") * CHUNK
    # the blocks themselves are slices of the text, so a long one isn't counted through for every chunk
    more = F.array_join(F.slice("_blocks", F.col("_k") + 2, F.lit(-(-max_len // CHUNK))), "")
    return p.select(*key, at.alias("_at"), "_n", F.concat("_block", more).alias("_text"),
                    F.slice("_all", at + 1, F.lit(CHUNK + max_len + 1)).alias("_of"),
                    F.when(at == 0, F.lit(-1)).otherwise(F.get("_all", at - 1)).alias("_before"))


def digest(proteins: DataFrame, key: Sequence[str], sequence: str, rule: str = r"(?<=[KR])(?!P)",
           min_len: int = 6, max_len: int = 50, max_missed: int | None = None,
           drop_first_met: bool = False) -> DataFrame:
    """D3 (fully specific cleavage): peptides made of one or more
    consecutive pieces with length in [min_len, max_len]; at most ``max_missed``
    missed cleavages, without a limit if None. Output: key, start (1-based),
    missed_cleavages, peptide.

    ``drop_first_met``: of a sequence that starts with M, the first peptides are also
    given without it; start counts residues of the whole sequence.

    Starts and ends are where the piece index of the residues changes. Both are exploded from ranges of
    positions in generated code, a run of residues at a time, so nothing is shuffled, rows that share a key keep
    apart, and work is linear in the sequence.
    """
    p = _chunks(proteins, key, sequence, rule, max_len)
    # -1 stands for the first residue left out
    first = F.when((F.col("_at") == 0) & F.col("_text").startswith("M"), -1).otherwise(0) if drop_first_met else F.lit(0)
    p = p.withColumn("_c", F.explode(F.sequence(first, F.least(F.lit(CHUNK), F.col("_n") - F.col("_at")) - 1)))
    p = p.where("_c = -1 OR (CASE WHEN _c = 0 THEN _before ELSE get(_of, _c - 1) END) <> get(_of, _c)")
    p = p.withColumn("_s", F.when(F.col("_c") < 0, 1).otherwise(F.col("_c"))).where(F.col("_n") - F.col("_at") - F.col("_s") >= min_len)
    p = p.withColumn("_e", F.explode(F.sequence(F.col("_s") + min_len, F.least(F.col("_s") + max_len, F.col("_n") - F.col("_at")))))
    p = p.where("_at + _e = _n OR get(_of, _e) <> get(_of, _e - 1)")
    missed = F.get("_of", F.col("_e") - 1) - F.get("_of", F.greatest("_c", F.lit(0)))
    e = p.select(*key, (F.col("_at") + F.col("_s") + 1).alias("start"), missed.alias("missed_cleavages"),
                 F.expr("substring(_text, _s + 1, _e - _s)").alias("peptide"))
    return e if max_missed is None else e.where(F.col("missed_cleavages") <= max_missed)


def digest_nonspecific(proteins: DataFrame, key: Sequence[str], sequence: str, ntt: int = 1,
                       site_pattern: str = r"(?<=[KR])(?!P)", min_len: int = 6, max_len: int = 50,
                       max_missed: int | None = None, drop_first_met: bool = False) -> DataFrame:
    """D3 with ``ntt`` < 2 tolerable termini: every substring of allowed
    length whose number of enzymatic termini (protein ends count) is at least
    ``ntt``; missed cleavages = cleavage sites strictly inside. Output as
    ``digest``: key, start (1-based), missed_cleavages, ntt, peptide.

    ``drop_first_met``: of a sequence that starts with M, the residue after it is a terminus too, and not one
    more missed cleavage.

    A candidate's termini show in the piece indices at its ends, its missed cleavages in their difference; starts and
    ends are exploded from ranges of positions, as in `digest`."""
    p = _chunks(proteins, key, sequence, site_pattern, max_len).where(F.col("_n") >= min_len)
    p = p.withColumn("_met", (F.col("_at") == 0) & F.col("_text").startswith("M") if drop_first_met else F.lit(False))
    p = p.withColumn("_s", F.explode(F.sequence(F.lit(0), F.least(F.lit(CHUNK), F.col("_n") - F.col("_at")) - 1)))
    p = p.where(F.col("_n") - F.col("_at") - F.col("_s") >= min_len)
    p = p.withColumn("_open", F.expr("_met AND _s = 1 OR (CASE WHEN _s = 0 THEN _before ELSE get(_of, _s - 1) END) <> get(_of, _s)").cast("int"))
    p = p.withColumn("_e", F.explode(F.sequence(F.col("_s") + min_len, F.least(F.col("_s") + max_len, F.col("_n") - F.col("_at")))))
    p = p.withColumn("ntt", F.col("_open") + F.expr("_at + _e = _n OR get(_of, _e) <> get(_of, _e - 1)").cast("int")).where(F.col("ntt") >= ntt)
    missed = F.get("_of", F.col("_e") - 1) - F.get("_of", "_s")
    e = p.select(*key, (F.col("_at") + F.col("_s") + 1).alias("start"), missed.alias("missed_cleavages"), "ntt",
                 F.expr("substring(_text, _s + 1, _e - _s)").alias("peptide"))
    return e if max_missed is None else e.where(F.col("missed_cleavages") <= max_missed)


def peptide_mass(df: DataFrame, sequence: str, residue_mass: Mapping[str, float],
                 fixed: Mapping[str, float] | None = None, nterm: float = 0.0,
                 name: str = "mass") -> DataFrame:
    """Neutral mass = water + residues (+ fixed modifications, N-term); null for a
    sequence with a residue of unknown mass."""
    m = dict(residue_mass)
    for r, d in (fixed or {}).items():
        if r in m:
            m[r] += d
    mm = _map_literal(m)
    total = F.aggregate(F.split(F.col(sequence), ""), F.lit(0.0), lambda a, r: a + mm[r])
    return df.withColumn(name, total + F.lit(WATER + nterm))


def expand_mods(peptides: DataFrame, sequence: str, mods: str | Sequence[tuple[str, float]], delta: float | None = None,
                max_mods: int = 3, max_forms: int | None = None, mass: str = "mass") -> DataFrame:
    """Variable-modification forms: every choice of at most ``max_mods``
    eligible positions. ``mods``: (residues, delta) pairs, or one kind's residues
    with ``delta``; a position eligible for several kinds takes one of them. Adds sites
    (1-based, ascending) and site_deltas, and adds the deltas to ``mass``.

    Forms grow by one explode a site: each takes an eligible position behind the last one, or ends the form. A row
    holds one form and the eligible positions, however many forms there are. ``max_forms`` keeps, per input row, the first so
    many by (number of sites, sites, deltas), which needs the forms of a row together; by default all are kept.
    """
    kinds = [(mods, float(delta))] if isinstance(mods, str) else [(r, float(d)) for r, d in mods]
    letters = F.transform(F.split(F.col(sequence), ""), lambda c, i: F.struct(c.alias("c"), (i + 1).alias("i")))

    def of_kind(residues: str, d: float) -> Column:
        fit = F.filter(letters, lambda x: F.lit(residues).contains(x["c"]) & (x["c"] != ""))
        return F.transform(fit, lambda x: F.struct(x["i"].alias("s"), F.lit(d).alias("d")))

    eligible = F.flatten(F.array(*[of_kind(r, d) for r, d in kinds]))
    if max_forms is not None:
        return _first_forms(peptides.withColumn("_el", F.array_sort(eligible)), max_mods, max_forms, mass)
    none = F.array(F.lit(None).cast("struct<s: int, d: double>"))
    out = peptides.withColumns({"_el": eligible, "sites": F.array().cast("array<int>"), "site_deltas": F.array().cast("array<double>"),
                                "_open": F.lit(True), "_last": F.lit(0)})
    for _ in range(max_mods):
        out = out.withColumn("_o", F.explode(F.when(F.col("_open"), F.concat(none, F.filter("_el", lambda e: e["s"] > F.col("_last")))).otherwise(none)))
        more = F.col("_o").isNotNull()
        out = out.withColumns({"sites": F.when(more, F.concat("sites", F.array("_o.s"))).otherwise(F.col("sites")),
                               "site_deltas": F.when(more, F.concat("site_deltas", F.array("_o.d"))).otherwise(F.col("site_deltas")),
                               "_open": more, "_last": F.coalesce("_o.s", "_last")})
    total = F.aggregate("site_deltas", F.lit(0.0), lambda x, d: x + d)
    return out.withColumn(mass, F.col(mass) + total).drop("_el", "_open", "_last", *(["_o"] if max_mods else []))


def _first_forms(peptides: DataFrame, max_mods: int, max_forms: int, mass: str) -> DataFrame:
    """The first forms per row of ``peptides`` with eligible positions _el (s, d)."""
    none = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("sites"), F.array().cast("array<double>").alias("deltas"))

    def grow(acc, x):
        return F.concat(acc, F.transform(F.filter(acc, lambda f: (f["n"] < max_mods) & (F.coalesce(F.try_element_at(f["sites"], F.lit(-1)), F.lit(0)) < x["s"])), lambda f: F.struct(
            (f["n"] + 1).alias("n"), F.concat(f["sites"], F.array(x["s"])).alias("sites"), F.concat(f["deltas"], F.array(x["d"])).alias("deltas"))))

    forms = F.slice(F.array_sort(F.aggregate("_el", F.array(none), grow)), 1, max_forms)
    out = peptides.withColumn("_f", F.explode(forms))
    total = F.aggregate("_f.deltas", F.lit(0.0), lambda x, d: x + d)
    return out.withColumns({"sites": F.col("_f.sites"), "site_deltas": F.col("_f.deltas"), mass: F.col(mass) + total}).drop("_f", "_el")


def _observed(spectra: DataFrame, precursor_mz: str, charge: str, isotopes: Sequence[int], charges: Sequence[int]) -> DataFrame:
    """Per isotope offset _iso and charge _z (all ``charges`` where it isn't known) the neutral mass _obs_mass."""
    ch = F.when(F.col(charge).isNull() | (F.col(charge) <= 0),
                F.array(*[F.lit(c) for c in charges])).otherwise(F.array(F.col(charge)))
    s = spectra.withColumn("_z", F.explode(ch)).withColumn("_iso", F.explode(F.array(*[F.lit(i) for i in isotopes])))
    return s.withColumn("_obs_mass", (F.col(precursor_mz) - F.lit(PROTON)) * F.col("_z")
                        - F.col("_iso") * F.lit(ISOTOPE_SPACING))


def match_candidates(spectra: DataFrame, peptides: DataFrame, precursor_mz: str, charge: str,
                     pep_mass: str, tol: float | tuple[float, float] = 20.0, isotopes: Sequence[int] = (-1, 0, 1, 2),
                     charges: Sequence[int] = (2, 3, 4, 5), ppm: bool = True) -> DataFrame:
    """Candidate peptides per spectrum: for each isotope offset and (when
    the charge is unknown) each charge, the neutral mass within ``tol`` of the peptide's, in ppm or Da;
    a pair of tolerances bounds the observed mass below and above it.
    Range join on the explodes, bucketed (never a cartesian product)."""
    low, high = tol if isinstance(tol, tuple) else (tol, tol)
    s = _observed(spectra, precursor_mz, charge, isotopes, charges)
    if low == high:
        return range_join(s, peptides, [Tol("_obs_mass", pep_mass, low, ppm=ppm)])
    # centre of the lopsided interval, and half its width
    shift, half = (high - low) / 2, (low + high) / 2
    if ppm:
        p = peptides.withColumn("_centre", F.col(pep_mass) * F.lit(1 + shift * 1e-6))
        half /= 1 + shift * 1e-6
    else:
        p = peptides.withColumn("_centre", F.col(pep_mass) + F.lit(shift))
    return range_join(s, p, [Tol("_obs_mass", "_centre", half, ppm=ppm)]).drop("_centre")


def preset_peptides(proteins: DataFrame, preset: Preset, residue_mass: Mapping[str, float], key: Sequence[str] = ("accession",),
                    sequence: str = "sequence", max_missed: int | None = None, max_forms: int | None = None) -> DataFrame:
    """D3-D5 as a preset says: (key, start, missed_cleavages, peptide, mass, sites, site_deltas), the masses with
    fixed and variable modifications; peptides with residues of unknown mass are left out."""
    if preset.ntt >= 2:
        p = digest(proteins, key, sequence, min_len=preset.length[0], max_len=preset.length[1], max_missed=max_missed, drop_first_met=True)
    else:
        p = digest_nonspecific(proteins, key, sequence, preset.ntt, min_len=preset.length[0], max_len=preset.length[1],
                               max_missed=max_missed, drop_first_met=True).drop("ntt")
    fixed = {r: d for r, d in preset.fixed.items() if r != "<"}
    p = peptide_mass(p, "peptide", residue_mass, fixed, preset.fixed.get("<", 0.0)).where(F.col("mass").isNotNull())
    if not preset.variable or not preset.max_mods:
        none = F.array()
        return p.withColumns({"sites": none.cast("array<int>"), "site_deltas": none.cast("array<double>")})
    return expand_mods(p, "peptide", list(preset.variable), max_mods=preset.max_mods, max_forms=max_forms)


def preset_search(spectra: DataFrame, peptides: DataFrame, preset: Preset, precursor_mz: str = "precursor_mz", charge: str = "charge") -> DataFrame:
    """D6 as a preset says: candidates of `preset_peptides` for each spectrum."""
    return match_candidates(spectra, peptides, precursor_mz, charge, "mass", preset.tol_ppm, preset.isotopes, preset.charges)


def filter_min_peaks(spectra: DataFrame, n: int, mz: str = "mz") -> DataFrame:
    """Drop spectra with fewer than ``n`` peaks."""
    return spectra.where(F.size(mz) >= n)


def theoretical_fragments(df: DataFrame, sequence: str, residue_mass: Mapping[str, float],
                          key: Sequence[str], sites: str | None = None, deltas: str | float | None = None,
                          charges: Sequence[int] = (1,)) -> DataFrame:
    """B and y ion per cleavage position i = 1..n-1 and charge (a column ``charge`` if more than one is
    asked for). ``sites`` (1-based positions) with ``deltas`` (a column of as many, or one number) are
    modifications. Prefix sums inside the row: no shuffle. A sequence with a
    residue of unknown mass has no fragments."""
    d = _prefix_sums(df, sequence, residue_mass, key, sites, deltas)
    e = d.select(*key, "_tot", F.size("_m").alias("_n"), F.posexplode("_pref").alias("_i", "_p"))
    e = e.where(F.col("_i") < F.col("_n") - 1).withColumn("pos", (F.col("_i") + 1).cast("int"))
    if tuple(charges) == (1,):
        b, y = _ions(F.col("_p"), F.col("_tot"))
        return e.select(*key, "pos", b.alias("b_ion"), y.alias("y_ion"))
    e = e.withColumn("charge", F.explode(F.array(*[F.lit(int(c)) for c in charges])))
    b, y = _ions(F.col("_p"), F.col("_tot"), F.col("charge"))
    return e.select(*key, "pos", "charge", b.alias("b_ion"), y.alias("y_ion"))


def _prefix_sums(df: DataFrame, sequence: str, residue_mass: Mapping[str, float], key: Sequence[str],
                 sites: str | None, deltas: str | float | None) -> DataFrame:
    """key, _m (residue masses), _pref (their running sums) and _tot of sequences with known masses only."""
    mm = _map_literal(residue_mass)
    masses = F.transform(F.split(F.col(sequence), ""), lambda r: mm[r])
    if sites is not None:
        each = F.transform(F.col(sites), lambda x: F.lit(float(deltas))) if isinstance(deltas, (int, float)) else F.col(deltas)
        at = F.arrays_zip(F.col(sites).alias("s"), each.alias("d"))
        plain = masses
        own = F.col(sites)
        masses = F.transform(plain, lambda m, i: F.when(F.array_contains(own, (i + 1).cast(df.schema[sites].dataType.elementType)), m + F.aggregate(
            F.filter(at, lambda x: x["s"] == i + 1), F.lit(0.0), lambda a, x: a + x["d"])).otherwise(m))
    d = df.select(*key, masses.alias("_m"))
    d = d.where(~F.exists("_m", lambda m: m.isNull()))
    # one step a residue: the sums so far, and the next one behind them
    sums = F.aggregate("_m", F.array(F.lit(0.0)), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))
    d = d.withColumn("_sums", sums).withColumn("_tot", F.element_at("_sums", -1))
    return d.withColumn("_pref", F.slice("_sums", 2, F.size("_m")))


def _ions(p: Column, total: Column, charge: Column | None = None) -> tuple[Column, Column]:
    """b and y ion behind the residues of mass ``p``."""
    if charge is None:
        return p + F.lit(PROTON), total - p + F.lit(WATER + PROTON)
    return p / charge + F.lit(PROTON), (total - p + F.lit(WATER)) / charge + F.lit(PROTON)


def score_matches(peaks: DataFrame, fragments: DataFrame, keys: Sequence[str], peak_mz: str,
                  peak_int: str, frag_mz: str, tol_da: float) -> DataFrame:
    """Matched fragment count, summed matched intensity and hyperscore
    (log10 of n! * sum intensity) per (keys)."""
    fr = fragments.select(*[F.col(k).alias(f"_f_{k}") for k in keys], frag_mz)
    j = range_join(peaks, fr, [Tol(peak_mz, frag_mz, tol_da)], on=[(k, f"_f_{k}") for k in keys])
    g = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_matched"),
                             F.sum(peak_int).alias("matched_intensity"))
    return g.withColumn("hyperscore", _hyperscore())


def _hyperscore() -> Column:
    lfact = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n_matched").cast("int"), F.lit(1))),
                        F.lit(0.0), lambda a, i: a + F.log10(i))
    return lfact + F.log10(F.col("matched_intensity"))


def search_spectra(spectra: DataFrame, peaks: DataFrame, peptides: DataFrame, keys: Sequence[str], pep_keys: Sequence[str], sequence: str,
                   residue_mass: Mapping[str, float], n: int = 1, tol_ppm: float = 20.0, isotopes: Sequence[int] = (0,),
                   charges: Sequence[int] = (2, 3, 4, 5), frag_tol: float = 0.5, frag_charges: Sequence[int] = (1,), mass: str = "mass",
                   sites: str | None = None, deltas: str | None = None, precursor_mz: str = "precursor_mz", charge: str = "charge",
                   peak_mz: str = "mz", peak_int: str = "intensity") -> DataFrame:
    """D6 + D8 + D9 + D10: the ``n`` best peptides of each spectrum, from its peaks. Output: keys, charge, isotope, pep_keys,
    n_matched, matched_intensity, hyperscore, rn (1 is the best; ties by isotope, charge and pep_keys).

    The same matches as `match_candidates`, then `theoretical_fragments` and `score_matches` of every candidate and `top_n`, but
    candidates are never given their fragments spectrum by spectrum, and no pair of a spectrum and a peptide leaves its task unless it may be among
    the best. Spectra and peptides meet by mass bin, a spectrum in one bin with its peaks, a peptide with its fragments in those that its tolerance touches.
    A bin of many is cut into blocks of PEPTIDES and SPECTRA, all pairs of which meet. In a block the fragments are one inverted index by m/z; a
    spectrum adds up what its peaks find there, an array as long as the block, and keeps n peptides, with all that a rounding may decide about. What the
    blocks keep is counted together and ranked. A candidate without a matching peak has no row.
    """
    bad = [t for t in (tol_ppm, frag_tol) if not t > 0]
    if bad:
        raise ValueError(f"search_spectra needs positive tolerances: {bad}")
    keys, pep_keys = list(keys), [f"_p_{k}" for k in pep_keys]
    lbin, low, high, lok, rok = _bins(Tol("_obs_mass", "_p_mass", tol_ppm, ppm=True), F.col("_obs_mass"), F.col("_p_mass"))
    of_one = tuple(frag_charges) == (1,)
    sums = _prefix_sums(peptides, sequence, residue_mass, [*[k[3:] for k in pep_keys], mass], sites, deltas)
    index = sums.select(*[F.col(k[3:]).alias(k) for k in pep_keys], F.col(mass).cast("double").alias("_p_mass"), "_tot", F.slice("_pref", 1, F.size("_m") - 1).alias("_pref"))
    # the explode keeps the sums from being written out, and done again, in what uses them
    index = index.where(rok & (F.size("_pref") > 0)).withColumn("_bin", F.explode(F.sequence(low.cast("long"), high.cast("long"))))
    ions = F.transform("_pref", lambda p: F.flatten(F.array(*[F.array(*_ions(p, F.col("_tot"), None if of_one else F.lit(int(c)))) for c in frag_charges])))
    index = index.select(*pep_keys, "_p_mass", "_bin", F.flatten(ions).alias("_frags"))
    seen = _observed(spectra.select(*keys, precursor_mz, charge), precursor_mz, charge, isotopes, charges)
    for k in keys:
        seen = seen.where(F.col(k).isNotNull())
    # rows of one key, charge and isotope are counted together, wherever their masses meet peptides
    seen = seen.where(lok).groupBy(*keys, "_z", "_iso").agg(F.collect_list(F.col("_obs_mass").cast("double")).alias("_masses"))
    seen = seen.select(*keys, "_z", "_iso", (F.size("_masses") > 1).alias("_several"), F.explode("_masses").alias("_obs_mass")).withColumn("_bin", lbin.cast("long"))
    peak = F.col(peak_mz).cast("double")
    lists = peaks.where(peak.isNotNull() & ~F.isnan(peak)).groupBy(*keys).agg(F.collect_list(F.struct(
        peak.alias("mz"), F.coalesce(F.col(peak_int).cast("double"), F.lit(0.0)).alias("int"), F.col(peak_int).isNotNull().alias("known"))).alias("_peaks"))
    # shuffled, as in `range_join`: a guess of the bytes of what explodes give would send them through the driver
    probes = seen.hint("merge").join(lists, on=keys).select(*keys, "_z", "_iso", "_several", "_obs_mass", "_bin", F.col("_peaks.mz").alias("_mz"),
                                                            F.col("_peaks.int").alias("_int"), F.col("_peaks.known").alias("_known"))
    probes, index = materialize(probes, "search-spectra"), materialize(index, "search-index")
    sizes = probes.groupBy("_bin").agg(F.count(F.lit(1)).alias("_s")).hint("merge").join(index.groupBy("_bin").agg(F.count(F.lit(1)).alias("_p")), on="_bin")
    sizes = materialize(sizes.select("_bin", "_s", "_p", F.ceil(F.col("_s") / SPECTRA).alias("_sn"), F.ceil(F.col("_p") / PEPTIDES).alias("_pn")), "search-sizes")
    pairs = sizes.agg(F.sum(F.col("_s").cast("double") * F.col("_p"))).first()[0] or 0
    parts = max(int(spectra.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs // (SPECTRA * PEPTIDES // 4)))
    spot = F.pmod(F.xxhash64("_bin", "_sb", "_pb"), F.lit(4 * parts)).alias("_spot")

    def dealt(df: DataFrame, own: str, n: str, by: Sequence[str], other: str, m: str) -> DataFrame:
        d = df.hint("merge").join(sizes.select("_bin", "_sn", "_pn"), on="_bin").withColumn(own, F.pmod(F.xxhash64(*by), F.col(n)))
        return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(m) - 1))).select(spot, "_sb", "_pb", *df.columns).repartition(parts, "_spot")

    left = dealt(probes, "_sb", "_sn", [*keys, "_z", "_iso", "_obs_mass"], "_pb", "_pn")
    right = dealt(index, "_pb", "_pn", pep_keys, "_sb", "_sn")
    by = [*keys, "_z", "_iso", *pep_keys]
    shape = T.StructType([*[probes.schema[c] for c in [*keys, "_z", "_iso"]], *[index.schema[c] for c in pep_keys], T.StructField("_n", T.LongType()),
                          T.StructField("_sum", T.DoubleType())])
    found = left.groupBy("_spot").cogroup(right.groupBy("_spot")).applyInArrow(_best_in_blocks([*keys, "_z", "_iso"], pep_keys, n, tol_ppm, frag_tol), shape)
    kind = peaks.select(F.sum(peak_int).alias("s")).schema["s"].dataType
    g = found.groupBy(*by).agg(F.sum("_n").alias("n_matched"), F.sum("_sum").cast(kind).alias("matched_intensity")).withColumn("hyperscore", _hyperscore())
    best = top_n(g, keys, [F.col("hyperscore").desc(), F.abs("_iso"), "_iso", "_z", *pep_keys], n)
    return best.select(*keys, F.col("_z").alias("charge"), F.col("_iso").alias("isotope"), *[F.col(k).alias(k[3:]) for k in pep_keys],
                       "n_matched", "matched_intensity", "hyperscore", "rn")


#: Peptides and spectra of a mass bin that meet in one block.
PEPTIDES, SPECTRA = 1 << 14, 1 << 13


def _best_in_blocks(spectrum: Sequence[str], pep_keys: Sequence[str], n: int, tol_ppm: float, frag_tol: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a task of `search_spectra` does: per row of a spectrum the peptides of its block that may be among its n best."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"_n": pa.array([], pa.int64()), "_sum": pa.array([], pa.float64())})
        if not (left.num_rows and right.num_rows):
            none = [left[c].slice(0, 0) for c in spectrum] + [right[c].slice(0, 0) for c in pep_keys]
            return pa.table([*none, *empty.columns], names=[*spectrum, *pep_keys, "_n", "_sum"])
        places = [np.stack([t[c].to_numpy() for c in ("_bin", "_sb", "_pb")], axis=1) for t in (left, right)]
        _, place = np.unique(np.concatenate(places), axis=0, return_inverse=True)
        place = place.ravel()
        rank = np.zeros(right.num_rows, np.int64)
        for c in pep_keys:  # by key, nulls first
            more = pc.rank(right[c].combine_chunks(), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
            rank = np.unique(rank * (more.max() + 1) + more, return_inverse=True)[1]
        of_left, of_right = place[:left.num_rows], place[left.num_rows:]
        l_order, r_order = np.argsort(of_left, kind="stable"), np.lexsort((rank, of_right))
        left, right, of_left, of_right, rank = left.take(l_order), right.take(r_order), of_left[l_order], of_right[r_order], rank[r_order]
        frags, mzs = right["_frags"].combine_chunks(), left["_mz"].combine_chunks()
        frag, f_at = frags.flatten().to_numpy(), np.r_[0, np.cumsum(pc.list_value_length(frags).to_numpy())]
        mz, m_at = mzs.flatten().to_numpy(), np.r_[0, np.cumsum(pc.list_value_length(mzs).to_numpy())]
        height = left["_int"].combine_chunks().flatten().to_numpy()
        known = left["_known"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        obs, mass, several = left["_obs_mass"].to_numpy(), right["_p_mass"].to_numpy(), left["_several"].to_numpy(zero_copy_only=False)
        logs = np.cumsum(np.log10(np.arange(1, 2)))
        out = []
        for b in np.intersect1d(of_left, of_right):
            (l0, l1), (r0, r1) = (np.searchsorted(of, [b, b + 1]) for of in (of_left, of_right))
            value = frag[f_at[r0]:f_at[r1]]
            order = np.argsort(value, kind="stable")
            who = np.repeat(np.arange(r1 - r0), np.diff(f_at[r0:r1 + 1]))[order]
            distinct, start = np.unique(value[order], return_index=True)
            start = np.r_[start, len(order)]
            at = mz[m_at[l0]:m_at[l1]]
            lo, hi = _within(distinct, at, frag_tol)
            lo, hi = start[lo], start[hi]
            same = np.unique(rank[r0:r1], return_inverse=True)[1]  # rows of one key are one peptide
            firsts = np.searchsorted(same, np.arange(same[-1] + 1))
            near = mass[r0:r1] * (tol_ppm / 1e6)
            for i in range(l0, l1):
                p0, p1 = m_at[i] - m_at[l0], m_at[i + 1] - m_at[l0]
                size = hi[p0:p1] - lo[p0:p1]
                if not size.any():
                    continue
                hit = np.concatenate([who[x:y] for x, y in zip(lo[p0:p1], hi[p0:p1])])
                w, k = np.repeat(height[m_at[i]:m_at[i + 1]], size), known[m_at[i]:m_at[i + 1]]
                fit = np.abs(obs[i] - mass[r0:r1]) <= near
                if not fit.all():
                    good = fit[hit]
                    hit, w = hit[good], w[good]
                hit = hit if len(firsts) == r1 - r0 else same[hit]
                count = np.bincount(hit, minlength=len(firsts))
                peptide = np.flatnonzero(count)
                if not len(peptide):
                    continue
                total, count = np.bincount(hit, w, len(firsts))[peptide], count[peptide]
                if not k.all():
                    some = np.repeat(k, size)
                    missing = np.bincount(hit, some if fit.all() else some[good], len(firsts))[peptide] == 0
                else:
                    missing = None
                if not several[i] and len(peptide) > n:
                    if count.max() > len(logs):
                        logs = np.cumsum(np.log10(np.arange(1, count.max() + 1)))
                    keep = _may_be_best(count, total if missing is None else np.where(missing, 0.0, total), logs, n)
                    peptide, count, total, missing = peptide[keep], count[keep], total[keep], None if missing is None else missing[keep]
                out.append((i, r0 + firsts[peptide], count, total, missing))
        rows = np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)
        found, count, total = (np.concatenate([o[j] for o in out]) if out else np.zeros(0, t) for j, t in ((1, np.int64), (2, np.int64), (3, np.float64)))
        null = np.concatenate([np.zeros(len(o[1]), bool) if o[4] is None else o[4] for o in out]) if out else np.zeros(0, bool)
        return pa.table([*left.select(list(spectrum)).take(rows).columns, *right.select(list(pep_keys)).take(found).columns,
                         pa.array(count, pa.int64()), pa.array(total, pa.float64(), mask=null)], names=[*spectrum, *pep_keys, "_n", "_sum"])

    return run


def _within(values: np.ndarray, at: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds, per place, of the ascending ``values`` v with abs(place - v) <= tol, as the subtraction rounds."""
    wide = tol * (1 + 1e-9) + np.abs(at) * 1e-15
    lo, hi = np.searchsorted(values, at - wide), np.searchsorted(values, at + wide, side="right")
    last = len(values) - 1
    while (off := (lo < hi) & ~(np.abs(at - values[np.minimum(lo, last)]) <= tol)).any():
        lo = lo + off
    while (off := (lo < hi) & ~(np.abs(at - values[hi - 1]) <= tol)).any():
        hi = hi - off
    return lo, hi


def _may_be_best(count: np.ndarray, total: np.ndarray, logs: np.ndarray, n: int) -> np.ndarray:
    """Places, in order, of the candidates that may be the n first by hyperscore, then place. Scores are compared with a margin, since another
    machine's logarithms may round otherwise; of equal counts and totals the first n are enough."""
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(total > 0, logs[count - 1] + np.log10(total), -np.inf)
    score = np.where(np.isnan(total), np.inf, np.where(total == np.inf, 1e300, score))
    place = np.flatnonzero(score >= np.partition(score, -n)[-n] - 1e-9)
    if len(place) > n:
        usual = np.abs(score[place]) < 1e300
        a, b, c = np.where(usual, count[place], 0), np.where(usual, total[place], 0.0), np.where(usual, 0.0, score[place])
        order = np.lexsort((place, c, b, a))
        new = np.r_[True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0) | (c[order][1:] != c[order][:-1])]
        at = np.arange(len(order))
        place = np.sort(place[order[at - np.maximum.accumulate(np.where(new, at, 0)) < n]])
    return place


def target_decoy_fdr(psm: DataFrame, score: str, is_decoy: Column | str, by: Sequence[str] = (),
                     higher_is_better: bool = True) -> DataFrame:
    """Per distinct score (and ``by`` group): cumulative target / decoy
    counts from the best score down, FDR = decoys / max(targets, 1), q-value
    = the lowest FDR at this or any worse score. Equal scores share a value.
    No single-partition window: both passes run over the same range partitions (SURVEY §4.4)."""
    dec = F.col(is_decoy) if isinstance(is_decoy, str) else is_decoy
    s = psm.groupBy(*by, score).agg(F.sum(F.when(dec, 0).otherwise(1)).cast("long").alias("n_target"),
                                    F.sum(F.when(dec, 1).otherwise(0)).cast("long").alias("n_decoy"))
    b = ordered.bucketed(s, score, by, descending=higher_is_better)
    c = ordered.running(b, {"cum_target": ("sum", F.col("n_target")), "cum_decoy": ("sum", F.col("n_decoy"))},
                        by, higher_is_better)
    c = materialize(c.withColumn("fdr", F.col("cum_decoy").cast("double") / F.greatest(F.col("cum_target"), F.lit(1))), "fdr")
    return ordered.plain(ordered.running(c, {"q_value": ("min", F.col("fdr"))}, by, higher_is_better, backwards=True))
