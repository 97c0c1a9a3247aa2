"""Study design tables: vial metadata -> samples,
references, fractions; checks; combining passes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import suffix_expression
from ..session import reliable_checkpoint
from . import ordered

CHANNEL_COLUMN = re.compile(r"^tmt(\d{2})?_channel$")


def find_channel_column(columns: Sequence[str]) -> str:
    """The single column named ``tmt_channel`` / ``tmtNN_channel``."""
    hits = [c for c in columns if CHANNEL_COLUMN.match(c)]
    if len(hits) > 1:
        raise ValueError(f"several channel columns: {hits}")
    if not hits:
        raise ValueError(f"no tmt_channel or tmtNN_channel column among {list(columns)}")
    return hits[0]


def check_channels(vials: DataFrame, expected: Sequence[str], plex: str = "tmt_plex",
                   channel: str | None = None) -> DataFrame:
    """Per plex the shared / missing / extra channels against ``expected``
    (sorted arrays) and the number of duplicated channel rows; ``ok`` when the
    sorted lists are identical."""
    ch = channel or find_channel_column(vials.columns)
    exp = F.array_sort(F.array(*[F.lit(x) for x in expected]))
    d = vials.groupBy(plex, ch).agg(F.count(F.lit(1)).alias("_n"))  # distinct first: bounded sets
    g = d.groupBy(plex).agg(F.array_sort(F.collect_list(ch)).alias("seen"),
                            F.sum(F.col("_n") - 1).alias("n_duplicates"))
    out = g.select(plex,
                   F.array_sort(F.array_intersect(exp, "seen")).alias("shared"),
                   F.array_sort(F.array_except(exp, "seen")).alias("missing"),
                   F.array_sort(F.array_except("seen", exp)).alias("extra"),
                   F.col("n_duplicates").cast("long").alias("n_duplicates"))
    return out.withColumn("ok", (F.size("missing") == 0) & (F.size("extra") == 0) & (F.col("n_duplicates") == 0))


def plex_from_order(df: DataFrame, path: str, name: str = "tmt_plex") -> DataFrame:
    """Plex ``S<i>`` by the position of ``path`` in the sorted
    list of distinct paths (a dense rank over the small list of files)."""
    paths = df.select(path).distinct()
    # a list of files: small by nature, so one ordered window is fine here
    i = F.row_number().over(Window.orderBy(path))
    ranked = paths.select(path, F.concat(F.lit("S"), i.cast("string")).alias(name))
    return df.join(ranked, on=path)


def stack_vials(details: DataFrame, path: str, label: str = "vial_label",
                plex: str = "tmt_plex") -> DataFrame:
    """Stacked detail files: plex from sorted file order; labels containing
    ``Ref`` (case-sensitive) become ``Ref_<plex>``."""
    d = plex_from_order(details.drop(plex) if plex in details.columns else details, path, plex)
    return d.withColumn(label, F.when(F.col(label).contains("Ref"), F.concat(F.lit("Ref_"), F.col(plex)))
                        .otherwise(F.col(label)))


def normalize_labels(vials: DataFrame, label: str = "vial_label", plex: str = "tmt_plex") -> DataFrame:
    """C4: lower-case column names; labels starting with ``ref`` (any case)
    become ``Ref_<plex>``; blanks removed."""
    v = vials.toDF(*[c.lower() for c in vials.columns])
    lab = F.when(F.col(label).rlike("(?i)^ref"), F.concat(F.lit("Ref_"), F.col(plex))).otherwise(F.col(label))
    return v.withColumn(label, F.regexp_replace(lab, " ", ""))


def make_unique(df: DataFrame, col: str, order: Sequence[str], only: Column | None = None,
                name: str | None = None, bounded: bool = False) -> DataFrame:
    """The 2nd, 3rd... copy of a value gets ``.1``, ``.2``... in ``order``;
    suffixes already taken by another value (``a.1`` present) are skipped, as
    in R's make.unique. Rows outside ``only`` keep their value and take no
    part. Numbering is bucketed (a hot value does not sit in one task)."""
    out_col = name or col
    base = df if only is None else df.where(only)
    rest = None if only is None else df.where(~only | only.isNull())
    if bounded:  # design tables: plexes x channels rows, a plain window is enough
        r = base.withColumn("_k", F.row_number().over(Window.partitionBy(col).orderBy(*order)))
    else:
        r = ordered.row_number(base, order[0], [col], tiebreak=list(order[1:]), name="_k")
    r = r.withColumn("_k", F.col("_k") - 1)
    # suffix numbers taken by existing values of the form <value>.<n>
    taken = base.select(F.col(col).alias("_v")).distinct() \
        .select(F.regexp_extract("_v", r"^(.*)\.(\d+)$", 1).alias(col),
                F.regexp_extract("_v", r"^(.*)\.(\d+)$", 2).alias("_t")).where("_t <> ''")
    taken = taken.groupBy(col).agg(F.array_sort(F.collect_set(F.col("_t").cast("long"))).alias("_taken"))
    r = r.join(taken, on=col, how="left")
    num = F.aggregate(F.coalesce("_taken", F.array().cast("array<long>")), F.col("_k"),
                      lambda acc, t: F.when(t <= acc, acc + 1).otherwise(acc))
    val = F.when(F.col("_k") == 0, F.col(col)).otherwise(F.concat(F.col(col), F.lit("."), num.cast("string")))
    r = r.withColumn(out_col, val).drop("_k", "_taken")
    if out_col != col and rest is not None:
        rest = rest.withColumn(out_col, F.col(col))
    return r if rest is None else r.unionByName(rest)


def build_samples(vials: DataFrame, channel: str, label: str = "vial_label",
                  plex: str = "tmt_plex") -> DataFrame:
    """Samples table; channel ``126C`` is written ``126``; references
    (label starting with ref, any case) get no measurement name."""
    is_ref = F.col(label).rlike("(?i)^ref")
    return vials.select(F.col(plex).alias("PlexID"), F.lit(1).alias("QuantBlock"),
                        F.regexp_replace(F.col(channel), "126C", "126").alias("ReporterName"),
                        F.col(label).alias("ReporterAlias"),
                        F.when(is_ref, F.lit(None).cast("string")).otherwise(F.col(label)).alias("MeasurementName"))


def build_references(samples: DataFrame) -> DataFrame:
    """Reference channels per plex (alias starting with ``Ref``); plexes
    without one get the constant ``1`` (once per plex)."""
    refs = samples.where(F.col("ReporterAlias").startswith("Ref")) \
        .select("PlexID", "QuantBlock", F.col("ReporterAlias").alias("Reference"))
    none = samples.select("PlexID", "QuantBlock").distinct() \
        .join(refs.select("PlexID").distinct(), on="PlexID", how="left_anti") \
        .withColumn("Reference", F.lit("1"))
    return refs.unionByName(none)


def build_fractions(files: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Dataset = base name without ``.raw`` (anchored, any case); plex by
    sorted folder (or file) order."""
    key = folder or path
    d = plex_from_order(files, key, "PlexID")
    base = F.regexp_extract(F.col(path), r"([^/]+)$", 1)
    return d.select(F.regexp_replace(base, r"(?i)\.raw$", "").alias("Dataset"), "PlexID")


def check_plex_ids(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per PlexID with a presence flag per table and ``ok`` when
    present everywhere (full outer joins of the distinct ids)."""
    out = None
    for name, (df, col) in tables.items():
        d = df.select(F.col(col).cast("string").alias("PlexID")).distinct().withColumn(f"in_{name}", F.lit(True))
        out = d if out is None else out.join(d, on="PlexID", how="full")
    flags = [F.coalesce(F.col(f"in_{n}"), F.lit(False)) for n in tables]
    out = out.select("PlexID", *[f.alias(f"in_{n}") for f, n in zip(flags, tables)])
    ok = flags[0]
    for f in flags[1:]:
        ok = ok & f
    return out.withColumn("ok", ok)


def combine_designs(passes: Mapping[str, DataFrame], order: Sequence[str],
                    pass_col: str = "PASS") -> DataFrame:
    """C10-C12 (C11: uniqueness and pass suffixes) for one design table: stack the passes (missing columns become
    null), make non-reference aliases / measurement names unique over the
    stacked column (in ``order``), append ``_<pass>`` to non-null aliases,
    measurement names and PlexIDs, and to every symbol of a Reference
    expression."""
    out = None
    for name, df in passes.items():
        d = df.withColumn(pass_col, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    for c in ("ReporterAlias", "MeasurementName"):
        if c in out.columns:
            keep = F.col(c).isNull() | F.col(c).rlike("(?i)^ref")
            # each numbering reads its input three times: cut the lineage first
            out = make_unique(reliable_checkpoint(out, "design"), c, order, only=~keep)
    for c in ("ReporterAlias", "MeasurementName", "PlexID"):
        if c in out.columns:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.concat_ws("_", F.col(c), F.col(pass_col))))
    if "Reference" in out.columns:
        out = out.withColumn("Reference", suffix_expression(F.col("Reference").cast("string"), F.col(pass_col)))
    return out.drop(pass_col)


def parse_batch_path(col: Column) -> Column:
    """Batch folder, assay and site parts of a raw-data path."""
    batch = F.regexp_extract(col, r"(BATCH\d*_\d{8})", 1)
    assay = F.regexp_replace(F.regexp_extract(col, r"/(PROT_[A-Z]+)/", 1), "^PROT_", "")
    site = F.regexp_extract(col, r"/(PNBI|PN|BI)/", 1)
    return F.struct(batch.alias("batch"), assay.alias("assay"),
                    F.when(site != "", site).alias("site"),
                    F.regexp_extract(col, r"([^/]+)$", 1).alias("file_name"))
