"""Sources: headered TSV tables, per-dataset file sets,
FASTA, mzML spectra, identification tables, modification dimensions, file
listings, manifests, MaxQuant tables, prior protein lists, design folders.

Every reader returns a lazy DataFrame with an explicit schema where the
layout is known; per-file tables get a ``dataset`` column from the file name.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import decode_path
from pyspark.sql import types as T

from ..operators.common import require_columns


def file_name_col() -> "F.Column":
    """Base name of the row's source file (``_metadata.file_name`` is
    URL-encoded: spaces arrive as %20)."""
    return decode_path(F.col("_metadata.file_name"))


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_tsv(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType | None = None,
             required: Sequence[str] = (), lower: bool = False, na: str = "NA") -> DataFrame:
    """A1: tab-separated files with a header. ``NA`` (R's missing value) reads
    as null; ``lower`` lower-cases the column names; missing ``required``
    columns raise with their names. With ``schema``, its columns are taken from the files by the
    header's names, in the schema's order and types (a value that doesn't fit reads as null);
    names that the header lacks are null, unless required."""
    r = spark.read.option("sep", "\t").option("header", "true").option("nullValue", na).option("inferSchema", "false")
    df = r.csv(_paths(paths))
    if lower:
        df = df.toDF(*[c.lower() for c in df.columns])
    require_columns(df, required, "read_tsv")
    return df if schema is None else by_name(df, schema)


def by_name(df: DataFrame, schema: str | T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` out of a table of strings, by name; null where the table has none."""
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in st]
    return df.select(*cols, *keep)


def read_dataset_tables(spark: SparkSession, folders: str | Sequence[str], suffix: str,
                        schema: str | T.StructType | None = None, sep: str = "\t") -> DataFrame:
    """A2: one table from many ``<dataset><suffix>`` files in one or more
    folders; ``dataset`` = file name without the suffix."""
    r = spark.read.option("sep", sep).option("header", "true").option("pathGlobFilter", f"*{suffix}") \
        .option("recursiveFileLookup", "true")
    df = r.csv(_paths(folders))
    name = file_name_col()
    df = df.withColumn("dataset", F.regexp_replace(name, re.escape(suffix) + "$", ""))
    return df if schema is None else by_name(df, schema, ["dataset"])


def read_fasta(spark: SparkSession, paths: str | Sequence[str], id_style: str = "uniprot") -> DataFrame:
    """A3: FASTA records as ``(accession, description, sequence)``.

    Records are split on newline + '>' (a '>' inside a header stays); the
    first header keeps its '>' and is stripped. ``id_style``: ``uniprot``
    takes the middle field of ``sp|P12345|NAME``, ``refseq`` the first word.
    """
    t = spark.read.option("lineSep", "\n>").text(_paths(paths))
    rec = F.regexp_replace(F.col("value"), r"^>", "")
    parts = F.split(rec, "\n", 2)
    header = F.trim(parts[0])
    body = F.regexp_replace(F.coalesce(parts[1], F.lit("")), r"[\s\r\n]", "")
    first = F.regexp_extract(header, r"^(\S+)", 1)
    if id_style == "uniprot":
        acc = F.when(first.rlike(r"^(sp|tr)\|"), F.split(first, r"\|")[1]).otherwise(first)
    else:
        acc = first
    desc = F.trim(F.regexp_replace(header, r"^\S+\s*", ""))
    return t.where(F.trim("value") != "").select(acc.alias("accession"), desc.alias("description"),
                                                 body.alias("sequence"))


MZML_ARRAY = T.StructType([
    T.StructField("cvParam", T.ArrayType(T.StructType([
        T.StructField("_accession", T.StringType()), T.StructField("_name", T.StringType()),
        T.StructField("_value", T.StringType())]))),
    T.StructField("binary", T.StringType())])
MZML_SPECTRUM = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("_index", T.LongType()),
    T.StructField("cvParam", T.ArrayType(T.StructType([
        T.StructField("_accession", T.StringType()), T.StructField("_name", T.StringType()),
        T.StructField("_value", T.StringType())]))),
    T.StructField("scanList", T.StructType([T.StructField("scan", T.ArrayType(T.StructType([
        T.StructField("cvParam", T.ArrayType(T.StructType([
            T.StructField("_accession", T.StringType()), T.StructField("_name", T.StringType()),
            T.StructField("_value", T.StringType()), T.StructField("_unitName", T.StringType())])))])))])),
    T.StructField("precursorList", T.StructType([T.StructField("precursor", T.ArrayType(T.StructType([
        T.StructField("_spectrumRef", T.StringType()),
        T.StructField("activation", T.StructType([T.StructField("cvParam", T.ArrayType(T.StructType([
            T.StructField("_accession", T.StringType()), T.StructField("_name", T.StringType())])))])),
        T.StructField("selectedIonList", T.StructType([T.StructField("selectedIon", T.ArrayType(T.StructType([
            T.StructField("cvParam", T.ArrayType(T.StructType([
                T.StructField("_accession", T.StringType()), T.StructField("_name", T.StringType()),
                T.StructField("_value", T.StringType())])))])))]))])))])),
    T.StructField("binaryDataArrayList", T.StructType([
        T.StructField("binaryDataArray", T.ArrayType(MZML_ARRAY))])),
])

# PSI-MS controlled vocabulary accessions used below (fixed values).
CV_MS_LEVEL = "MS:1000511"
CV_RT = "MS:1000016"
CV_MZ_ARRAY = "MS:1000514"
CV_INT_ARRAY = "MS:1000515"
CV_64BIT = "MS:1000523"
CV_ZLIB = "MS:1000574"
CV_SELECTED_MZ = "MS:1000744"
CV_CHARGE = "MS:1000041"
CV_ACTIVATION = {"MS:1000133": "CID", "MS:1000422": "HCD", "MS:1000598": "ETD"}


def decode_binary(texts: pd.Series, is64: pd.Series, zipped: pd.Series) -> pd.Series:
    """base64 (+ zlib) little-endian float arrays -> list of doubles (per batch)."""
    out = []
    for t, b64, z in zip(texts, is64, zipped):
        if t is None:
            out.append(None)
            continue
        raw = base64.b64decode(t)
        if z:
            raw = zlib.decompress(raw)
        arr = np.frombuffer(raw, dtype="<f8" if b64 else "<f4").astype("float64")
        out.append(arr)
    return pd.Series(out)


def read_mzml(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A4: mzML spectra via the XML source (row tag ``spectrum``), one row per
    spectrum with decoded ``mz`` / ``intensity`` arrays (vectorized pandas
    UDF: Arrow batches, not rows). rt is in minutes (seconds are converted by their unit); activation is
    CID, HCD or ETD; parent_scan comes from the precursor's spectrum reference."""
    dec = F.pandas_udf(decode_binary, T.ArrayType(T.DoubleType()))
    x = spark.read.format("xml").option("rowTag", "spectrum").schema(MZML_SPECTRUM).load(_paths(paths))

    def cv(arr, acc):
        return F.get(F.filter(arr, lambda p: p["_accession"] == acc), F.lit(0))["_value"]

    def has(arr, acc):
        return F.exists(arr, lambda p: p["_accession"] == acc)

    arrays = F.col("binaryDataArrayList.binaryDataArray")

    def pick(acc):
        a = F.get(F.filter(arrays, lambda b: has(b["cvParam"], acc)), F.lit(0))
        return dec(a["binary"], has(a["cvParam"], CV_64BIT), has(a["cvParam"], CV_ZLIB))

    scan_cv = F.get("scanList.scan", F.lit(0))["cvParam"]
    ion_cv = F.get(F.get("precursorList.precursor", F.lit(0))["selectedIonList"]["selectedIon"], F.lit(0))["cvParam"]
    scan_no = F.regexp_extract(F.col("_id"), r"scan=(\d+)", 1)
    first = F.get("precursorList.precursor", F.lit(0))
    time = F.get(F.filter(scan_cv, lambda p: p["_accession"] == CV_RT), F.lit(0))
    rt = time["_value"].cast("double") / F.when(F.lower(time["_unitName"]).startswith("second"), F.lit(60.0)).otherwise(F.lit(1.0))
    activation = F.lit(None).cast("string")
    for acc, name in CV_ACTIVATION.items():
        activation = F.when(F.exists(first["activation"]["cvParam"], lambda p: p["_accession"] == acc), F.lit(name)).otherwise(activation)
    parent = F.regexp_extract(first["_spectrumRef"], r"scan=(\d+)", 1)
    return x.select(
        F.regexp_replace(file_name_col(), r"(?i)\.mzml(\.gz)?$", "").alias("dataset"),
        F.when(scan_no != "", scan_no.cast("long")).otherwise(F.col("_index") + 1).alias("scan"),
        cv(F.col("cvParam"), CV_MS_LEVEL).cast("int").alias("ms_level"),
        rt.alias("rt"),
        cv(ion_cv, CV_SELECTED_MZ).cast("double").alias("precursor_mz"),
        cv(ion_cv, CV_CHARGE).cast("int").alias("charge"),
        F.when(parent != "", parent.cast("long")).alias("parent_scan"), activation.alias("activation"),
        pick(CV_MZ_ARRAY).alias("mz"), pick(CV_INT_ARRAY).alias("intensity"))


def spectra_to_peaks(spectra: DataFrame) -> DataFrame:
    """Long peak rows (dataset, scan, ms_level, rt, mz, intensity)."""
    z = F.arrays_zip(F.col("mz").alias("mz"), F.col("intensity").alias("intensity"))
    return spectra.select("dataset", "scan", "ms_level", "rt", F.explode(z).alias("p")) \
                  .select("dataset", "scan", "ms_level", "rt", "p.mz", "p.intensity")


PSM_COLUMNS = {"dataset": "dataset", "scan": "ScanNum", "charge": "Charge", "peptide": "Peptide",
               "protein": "Protein", "precursor_mz": "PrecursorMZ", "score": "MSGFScore",
               "spec_evalue": "SpecEValue"}


def read_psms(spark: SparkSession, folders: str | Sequence[str], suffix: str = ".tsv",
              column_map: dict[str, str] | None = None, decoy_prefix: str = "XXX_") -> DataFrame:
    """A5: identification tables (one per dataset) -> one PSM row per match
    and protein; decoys kept and flagged. ``column_map``: ours -> file's."""
    cm = dict(PSM_COLUMNS, **(column_map or {}))
    df = read_dataset_tables(spark, folders, suffix)
    sel = [F.col("dataset")] + [F.col(f"`{v}`").alias(k) for k, v in cm.items() if k != "dataset"]
    p = df.select(*sel).withColumn("protein", F.explode(F.split("protein", ";")))
    p = p.withColumns({"scan": F.col("scan").cast("long"), "charge": F.col("charge").cast("int"),
                       "precursor_mz": F.col("precursor_mz").cast("double"),
                       "score": F.col("score").cast("double"), "spec_evalue": F.col("spec_evalue").cast("double")})
    p = p.withColumn("protein", F.regexp_replace("protein", r"\(pre=.*$", ""))
    return p.withColumn("is_decoy", F.col("protein").startswith(decoy_prefix))


def read_mod_defs(spark: SparkSession, path: str) -> DataFrame:
    """Modification definitions: symbol, mass, residues, type, tag
    (tab separated, no header; trailing blanks trimmed; '#' comments)."""
    df = spark.read.option("sep", "\t").option("comment", "#").schema(
        "symbol string, mass double, residue string, mod_type string, tag string").csv(path)
    return df.select(*[F.rtrim(c).alias(c) if c != "mass" else F.col(c) for c in df.columns])


def read_mass_tags(spark: SparkSession, path: str) -> DataFrame:
    """Mass correction tags: tag, mass, element (tab separated)."""
    df = spark.read.option("sep", "\t").option("comment", "#").schema(
        "tag string, mass double, element string").csv(path)
    return df.select(F.rtrim("tag").alias("tag"), "mass", F.rtrim("element").alias("element")) \
             .where(F.col("mass").isNotNull())


def list_files(spark: SparkSession, root: str, suffix: str | None = None,
               ignore_case: bool = True) -> DataFrame:
    """Files under ``root`` as (path, name, folder, length,
    modificationTime); content is never read. No file is an error."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root) \
        .select("path", "length", "modificationTime")
    if suffix:
        pat = ("(?i)" if ignore_case else "") + re.escape(suffix) + "$"
        df = df.where(F.col("path").rlike(pat))
    df = df.withColumns({"name": F.regexp_extract("path", r"([^/]+)$", 1),
                         "folder": F.regexp_extract("path", r"^(.*)/[^/]+$", 1)})
    if df.limit(1).count() == 0:
        raise ValueError(f"no files{' ending in ' + suffix if suffix else ''} under {root}")
    return df


def read_manifests(spark: SparkSession, root: str, pattern: str = "(?i)(metadata_file\\.txt|raw_metadata_file)") -> DataFrame:
    """Per-plex manifests: ``file_name`` as Dataset, plex ``S<i>`` by the
    sorted order of the manifest files."""
    files = list_files(spark, root).where(F.col("name").rlike(pattern))
    paths = [r[0] for r in files.select("path").orderBy("path").collect()]  # a handful of manifests
    df = spark.read.option("sep", "\t").option("header", "true").csv(paths)
    df = df.withColumn("_path", decode_path(F.col("_metadata.file_path")))
    i = F.row_number().over(Window.orderBy("_path"))
    order = df.select("_path").distinct().select("_path", F.concat(F.lit("S"), i.cast("string")).alias("PlexID"))
    return df.join(order, on="_path").select(F.col("file_name").alias("Dataset"), "PlexID")


# MaxQuant result tables under combined/txt (fixed values; runningTimes lives
# in combined/proc as "#runningTimes.txt"), plus every *Sites.txt table.
MAXQUANT_TABLES = ["allPeptides", "evidence", "libraryMatch", "matchedFeatures", "modificationSpecificPeptides",
                   "ms3Scans", "msms", "msmsScans", "mzRange", "parameters", "peptides", "proteinGroups",
                   "summary", "runningTimes"]


def read_maxquant(spark: SparkSession, txt_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A10: one MaxQuant result table by name, or every ``*Sites.txt`` table
    (name ``sites``) with its ``source_file``. With ``schema`` its columns are taken by name; without one all
    columns come, their types found by a pass over the values."""
    base = txt_dir.rstrip("/")
    if name == "sites":
        df = spark.read.options(sep="\t", header="true", inferSchema=str(schema is None).lower(), pathGlobFilter="*Sites.txt").csv(base)
        df = df.withColumn("source_file", file_name_col())
        return df if schema is None else by_name(df, schema, ["source_file"])
    if name not in MAXQUANT_TABLES:
        raise ValueError(f"unknown MaxQuant table {name!r}")
    path = f"{base}/../proc/#runningTimes.txt" if name == "runningTimes" else f"{base}/{name}.txt"
    df = spark.read.options(sep="\t", header="true", inferSchema=str(schema is None).lower()).csv(path)
    return df if schema is None else by_name(df, schema)


def read_prior(spark: SparkSession, path: str | None, accession: str = "protein_id") -> DataFrame | None:
    """Accessions of an earlier ratio table; ``no-prior`` or None -> None."""
    if path is None or path == "no-prior":
        return None
    df = read_tsv(spark, path)
    col = accession if accession in df.columns else df.columns[0]
    return df.select(F.col(col).alias("accession")).where(F.col("accession").isNotNull()).distinct()


SAMPLES_SCHEMA = "PlexID string, QuantBlock int, ReporterName string, ReporterAlias string, MeasurementName string"
REFERENCES_SCHEMA = "PlexID string, QuantBlock int, Reference string"
FRACTIONS_SCHEMA = "Dataset string, PlexID string"


def read_design(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """``samples``, ``references`` and ``fractions`` of a design folder."""
    f = folder.rstrip("/")
    return {
        "samples": read_tsv(spark, f"{f}/samples.txt", SAMPLES_SCHEMA),
        "references": read_tsv(spark, f"{f}/references.txt", REFERENCES_SCHEMA),
        "fractions": read_tsv(spark, f"{f}/fractions.txt", FRACTIONS_SCHEMA),
    }
