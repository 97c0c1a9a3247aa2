"""Quantification: link identifications to reporter ions, attach the study
design, aggregate intensities, evaluate references, ratio and intensity
crosstabs, label-free intensities (SURVEY H1, H2, H4, H8-H14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import reference_value


def link_quant(psm: DataFrame, ri: DataFrame, keys: Sequence[str] = ("dataset", "scan")) -> DataFrame:
    """H1: identifications joined to reporter-ion rows on (dataset, scan)."""
    return psm.join(ri, on=list(keys), how="inner")


def attach_design(q: DataFrame, fractions: DataFrame, samples: DataFrame,
                  dataset_col: str = "Dataset", plex_col: str = "PlexID",
                  channel_col: str = "ReporterName", q_dataset: str = "dataset",
                  q_channel: str = "channel") -> DataFrame:
    """H2: plex by dataset, then sample by (plex, channel); both are design
    tables, which the planner broadcasts by their bytes."""
    fr = fractions.select(F.col(dataset_col).alias(q_dataset), plex_col)
    out = q.join(fr, on=q_dataset, how="inner")
    sm = samples.withColumnRenamed(channel_col, q_channel)
    return out.join(sm, on=[plex_col, q_channel], how="inner")


def filter_ascore(psm: DataFrame, ascore: DataFrame, min_score: float,
                  keys: Sequence[str] = ("dataset", "scan", "peptide"),
                  score_col: str = "ascore", keep_unscored: bool = False) -> DataFrame:
    """H4: attach the best site score per match, keep those >= ``min_score``."""
    best = ascore.groupBy(*keys).agg(F.max(score_col).alias(score_col))
    j = psm.join(best, on=list(keys), how="left")
    cond = F.col(score_col) >= F.lit(min_score)
    if keep_unscored:
        cond = cond | F.col(score_col).isNull()
    return j.where(cond)


def aggregate_intensity(q: DataFrame, feature: Sequence[str], plex: str, channel: str,
                        intensity: str, name: str = "intensity") -> DataFrame:
    """H8: summed intensity per feature x plex x channel (map-side combined)."""
    return q.groupBy(*feature, plex, channel).agg(F.sum(intensity).alias(name))


def eval_reference(long: DataFrame, references: DataFrame, feature: Sequence[str],
                   plex: str, channel: str, intensity: str = "intensity",
                   ref_plex: str = "PlexID", ref_col: str = "Reference",
                   block: str | None = None, ref_block: str = "QuantBlock") -> DataFrame:
    """H11 + ratio: per (feature, plex) the reference value and every channel's
    log2(intensity / reference) (null when either side is null or <= 0).

    Rows without a channel are left out; intensities of a channel that is repeated in a (feature, plex) are summed.
    A plex with several references takes the mean of those that have a value. ``block``: the column of
    ``long`` with the quantification block; references then hold within plex and block.
    The channels of one (feature, plex) form a map (bounded by the plex size);
    the reference expressions are evaluated on that map, and the map is exploded
    again, so the long table is shuffled once on (feature, plex).
    """
    on = [plex, *([block] if block else [])]
    refs = references.select(F.col(ref_plex).alias(plex), *([F.col(ref_block).alias(block)] if block else []),
                             F.col(ref_col).cast("string").alias("_ref")).distinct()
    exprs = sorted(r[0] for r in refs.select("_ref").where(F.col("_ref").isNotNull()).distinct().collect())
    # (a few expressions per plex: a design-sized list)
    entry = F.struct(F.col(channel).cast("string").alias("c"), F.col(intensity).alias("v"))
    grouped = long.where(F.col(channel).isNotNull()).groupBy(*feature, *on).agg(F.collect_list(entry).alias("_e"))
    names = F.array_distinct(F.col("_e.c"))
    kind = long.schema[intensity].dataType
    grouped = grouped.withColumn("_m", F.map_from_arrays(names, F.transform(names, lambda n: F.aggregate(
        F.filter("_e", lambda e: e["c"] == n), F.lit(None).cast(kind), lambda a, e: F.coalesce((a + e["v"]).cast(kind), a, e["v"]))))).drop("_e")
    own = refs.groupBy(*on).agg(F.array_sort(F.collect_list("_ref")).alias("_refs"))
    g = grouped.join(own, on=on, how="left").withColumn("_ref", F.explode_outer("_refs"))
    g = g.withColumn("_value", reference_value("_ref", "_m", exprs))
    g = g.groupBy(*feature, *on).agg(F.first("_m").alias("_m"), F.avg("_value").alias("reference_intensity"))
    e = g.select(*feature, *on, "reference_intensity", F.explode("_m").alias(channel, intensity))
    ok = (F.col(intensity) > 0) & (F.col("reference_intensity") > 0)
    return e.withColumn("log2_ratio", F.when(ok, F.log2(F.col(intensity) / F.col("reference_intensity"))))


def crosstab(long: DataFrame, feature: Sequence[str], column: str, value: str,
             columns: Sequence[str] | None = None) -> DataFrame:
    """H9/H10 sink shape: one row per feature, one column per ``column`` value.

    ``columns`` (the sample names of the design) fixes the pivot values so no
    extra job is needed to discover them.
    """
    g = long.groupBy(*feature)
    p = g.pivot(column, list(columns)) if columns is not None else g.pivot(column)
    return p.agg(F.first(value))


def ratio_crosstab(long_ratio: DataFrame, samples: DataFrame, feature: Sequence[str],
                   plex: str, channel: str, measurement: str = "MeasurementName",
                   samples_plex: str = "PlexID", samples_channel: str = "ReporterName",
                   value: str = "log2_ratio", digits: int | None = None) -> DataFrame:
    """log2 ratio per feature x sample; reference channels (null sample
    name) drop out."""
    sm = samples.select(F.col(samples_plex).alias(plex), F.col(samples_channel).alias(channel),
                        measurement).where(F.col(measurement).isNotNull())
    names = sorted(r[0] for r in sm.select(measurement).distinct().collect())  # design size
    j = long_ratio.join(sm, on=[plex, channel], how="inner")
    v = F.round(value, digits) if digits is not None else F.col(value)
    return crosstab(j.withColumn(value, v), feature, measurement, value, names)


def feature_key(kind: str, protein: str = "protein", peptide: str = "peptide",
                site: str = "site_id") -> "F.Column":
    """Protein for global (pr) runs, site or peptide for PTM runs."""
    if kind == "pr":
        return F.col(protein)
    return F.coalesce(F.col(site), F.col(peptide))


def annotate(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None,
             species: str | None = None) -> DataFrame:
    """Left join with an annotation table and a
    species column."""
    t = table if table_key is None else table.withColumnRenamed(table_key, key)
    out = df.join(t, on=key, how="left")
    if species is not None:
        out = out.withColumn("species", F.lit(species))
    return out


def label_free(psm: DataFrame, sic: DataFrame, link: Sequence[str], feature: Sequence[str],
               dataset: str, area: str = "area", name: str = "intensity") -> DataFrame:
    """Peptide intensity = summed chromatogram area of its best matches,
    per feature and dataset."""
    j = psm.join(sic, on=list(link), how="inner")
    return j.groupBy(*feature, dataset).agg(F.sum(area).alias(name),
                                             F.count(F.lit(1)).alias("n_scans"))
