"""File and run bookkeeping as tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import decode_path

ATTEMPT = ("struct<executionStatus:string,stdout:string,commandLine:string,shardIndex:int,attempt:int,"
           "inputs:map<string,string>,outputs:map<string,string>>")
RUN_METADATA_SCHEMA = (f"id string, start timestamp, end timestamp, status string, inputs map<string,string>, "
                       f"calls map<string,array<{ATTEMPT}>>, "
                       "failures array<struct<message:string,causedBy:array<struct<message:string>>>>")


def _md5_by_path(batches):
    """mapInPandas helper: md5 of each file read in 64 MiB chunks, so that no file is ever one
    value. Paths are URIs from the file listing."""
    import hashlib

    import pandas as pd
    from pyarrow import fs as pafs

    for b in batches:
        out = []
        for uri in b["path"]:
            u = uri if "://" in uri else uri.replace("file:", "file://", 1)
            filesystem, path = pafs.FileSystem.from_uri(u)
            h = hashlib.md5()
            with filesystem.open_input_stream(path) as f:
                while True:
                    chunk = f.read(64 << 20)
                    if not chunk:
                        break
                    h.update(chunk)
            out.append(h.hexdigest())
        yield pd.DataFrame({"path": b["path"], "md5": out})


def file_manifest(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Relative name and md5 of every file under ``root`` (recursive);
    names containing ``file_manifest`` are skipped; no file is an error.
    The files are spread over tasks by path and hashed in chunks, whatever their size."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(root).select("path")
    prefix = root.rstrip("/") + "/"
    rel = F.regexp_replace(decode_path(F.regexp_replace(F.col("path"), r"^file:", "")), "^" + _re_escape(prefix), "")
    out = files.repartition(F.col("path")).mapInPandas(_md5_by_path, "path string, md5 string")
    out = out.select(rel.alias("file_name"), "md5").where(~F.col("file_name").contains("file_manifest"))
    if files.isEmpty():
        raise ValueError(f"no files found under {root}")
    return out


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def read_run_metadata(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Workflow metadata JSON files (one object per file), explicit schema,
    with the source file name."""
    df = spark.read.schema(RUN_METADATA_SCHEMA).option("multiLine", "true").json(paths)
    return df.withColumn("source_file", decode_path(F.col("_metadata.file_path")))


def run_durations(meta: DataFrame, id_col: str = "id") -> DataFrame:
    """Duration of each run (seconds and interval)."""
    return meta.select(id_col, "start", "end", (F.col("end") - F.col("start")).alias("duration"),
                       ((F.unix_micros(F.col("end").cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 1e6).alias("duration_s"))


def run_failures(meta: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per failure cause, with the failure count of the run."""
    f = meta.select(id_col, F.size(F.coalesce("failures", F.array())).alias("n_failures"),
                    F.posexplode_outer("failures").alias("failure_no", "failure"))
    return f.select(id_col, "n_failures", "failure_no", F.col("failure.message").alias("failure_message"),
                    F.posexplode_outer("failure.causedBy").alias("cause_no", "cause")) \
            .select(id_col, "n_failures", "failure_no", "failure_message", "cause_no",
                    F.col("cause.message").alias("cause_message"))


def call_attempts(meta: DataFrame, id_col: str = "id", workflow_prefix: str | None = None) -> DataFrame:
    """One row per (task, attempt) with status, command and maps."""
    c = meta.select(id_col, F.explode("calls").alias("call", "attempts"))
    task = F.col("call") if workflow_prefix is None else F.regexp_replace("call", "^" + _re_escape(workflow_prefix), "")
    a = c.select(id_col, task.alias("task"), F.posexplode("attempts").alias("attempt_no", "a"))
    return a.select(id_col, "task", "attempt_no", F.col("a.executionStatus").alias("status"),
                    F.col("a.stdout").alias("stdout"), F.col("a.commandLine").alias("command"),
                    F.col("a.inputs").alias("inputs"), F.col("a.outputs").alias("outputs"))


def output_catalog(attempts: DataFrame, wanted: DataFrame, id_col: str = "id") -> DataFrame:
    """For each wanted (task, key) the files of ``Done`` attempts; list
    values (JSON text starting with '[') are expanded to one row per file."""
    done = attempts.where(F.col("status") == "Done")
    kv = done.select(id_col, "task", "attempt_no", F.explode("outputs").alias("key", "value"))
    files = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")) \
             .otherwise(F.array("value"))
    kv = kv.join(wanted.select("task", "key"), on=["task", "key"], how="inner")
    return kv.select(id_col, "task", "attempt_no", "key", F.explode(files).alias("file"))


def missing_outputs(attempts: DataFrame, wanted: DataFrame, id_col: str = "id", runs: DataFrame | None = None) -> DataFrame:
    """For every run, the wanted (task, key) pairs without a ``Done`` attempt's output, and why. ``runs``
    lists the runs (``id_col``); by default those with an attempt. Runs and wanted pairs are small lists."""
    kv = attempts.select(id_col, "task", "status", F.explode_outer("outputs").alias("key", "value"))
    ok = kv.where((F.col("status") == "Done") & F.col("value").isNotNull()).select(id_col, "task", "key").distinct()
    ran = attempts.select(id_col, "task").distinct().withColumn("_ran", F.lit(True))
    all_runs = (runs if runs is not None else attempts).select(id_col).distinct()
    pairs = wanted.select("task", "key").distinct().agg(F.collect_list(F.struct("task", "key")).alias("_w"))
    want = all_runs.withColumn("_one", F.lit(1)).join(pairs.withColumn("_one", F.lit(1)), on="_one")
    want = want.select(id_col, F.explode("_w").alias("_w")).select(id_col, "_w.task", "_w.key")
    miss = want.join(ok, on=[id_col, "task", "key"], how="left_anti").join(ran, on=[id_col, "task"], how="left")
    return miss.withColumn("reason", F.when(F.col("_ran").isNull(), F.lit("task not run"))
                           .otherwise(F.lit("no Done attempt with this output"))).drop("_ran")


def plan_paths(catalog: DataFrame, dest_folder: str, flat: bool = False, new_name: Column | None = None) -> DataFrame:
    """Destination of each file: ``<folder>/<task>_outputs/<base name>``
    (or a flat folder, or a given new name)."""
    base = F.regexp_extract("file", r"([^/]+)$", 1)
    name = new_name if new_name is not None else base
    folder = F.lit(dest_folder.rstrip("/")) if flat else F.concat_ws(
        "/", F.lit(dest_folder.rstrip("/")), F.concat(F.col("task"), F.lit("_outputs")))
    return catalog.withColumn("destination", F.concat_ws("/", folder, name))


def wanted_outputs(spark: SparkSession, rows: Iterable[tuple[str, str, str]], mode: str) -> DataFrame:
    """The (mode, task, key) selection table, filtered to one mode."""
    df = spark.createDataFrame(list(rows), "mode string, task string, key string")
    return df.where(F.col("mode") == mode).select("task", "key")


def parse_bucket_path(col: Column, schemes: Sequence[str] = ("gs", "s3")) -> Column:
    """Scheme, bucket and key of an object-store path, plus an error text
    (null when valid) instead of raising per row."""
    scheme = F.regexp_extract(col, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    rest = F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bucket = F.regexp_extract(rest, r"^([^/]*)", 1)
    key = F.regexp_extract(rest, r"^[^/]*/?(.*)$", 1)
    err = (F.when(~scheme.isin(*schemes), F.lit("path must start with one of: " + ", ".join(s + "://" for s in schemes)))
           .when(bucket == "", F.lit("empty bucket name"))
           .when(F.trim(bucket) == "", F.lit("invalid bucket name")))
    return F.struct(scheme.alias("scheme"), bucket.alias("bucket"), key.alias("key"), err.alias("error"))


def command_files(attempts: DataFrame, id_col: str = "id") -> DataFrame:
    """Command text, stdout and the names of the command and log file per attempt."""
    name = F.concat(F.col("task"), F.lit("_"), F.col("attempt_no").cast("string"))
    return attempts.select(id_col, "task", "attempt_no", "command", "stdout", F.concat(name, F.lit(".command.txt")).alias("command_file"),
                           F.concat(name, F.lit(".log")).alias("log_file"))


# FIXED VALUES: which task outputs each copy mode selects (mode, task, output
# keys). "full" also takes the ascore outputs when the run has that task.
# The sequence task's two keys are listed apart (see README deviations).
SELECTION = {
    "full": {
        "ascore": ["syn_plus_ascore", "syn_ascore", "syn_ascore_proteinmap", "output_ascore_logfile"],
        "msconvert_mzrefiner": ["mzml_fixed"],
        "ppm_errorcharter": ["ppm_masserror_png", "ppm_histogram_png"],
        "masic": ["ReporterIons_output_file", "PeakAreaHistogram_output_file",
                  "RepIonObsRateHighAbundance_output_file", "RepIonObsRate_output_txt_file",
                  "MSMS_scans_output_file", "SICs_output_file", "MS_scans_output_file", "SICstats_output_file",
                  "ScanStatsConstant_output_file", "RepIonStatsHighAbundance_output_file",
                  "ScanStatsEx_output_file", "ScanStats_output_file", "PeakWidthHistogram_output_file",
                  "RepIonStats_output_file", "DatasetInfo_output_file", "RepIonObsRate_output_png_file"],
        "msconvert": ["mzml"],
        "msgf_identification": ["rename_mzmlfixed", "mzid_final"],
        "msgf_sequences": ["revcat_fasta", "sequencedb_files"],
        "msgf_tryptic": ["mzid"],
        "phrp": ["syn_ResultToSeqMap", "fht", "PepToProtMapMTS", "syn_ProteinMods", "syn_SeqToProteinMap",
                 "syn", "syn_ModSummary", "syn_SeqInfo", "syn_ModDetails"],
        "mzidtotsvconverter": ["tsv"],
        "wrapper_pp": ["results_ratio", "results_rii", "final_output_masic_tar", "final_output_phrp_tar",
                       "final_output_ascore"],
    },
    "ppinputs": {
        "wrapper_pp": ["results_ratio", "results_rii", "final_output_masic_tar", "final_output_phrp_tar",
                       "final_output_ascore"],
    },
    "results": {
        "wrapper_pp": ["results_ratio", "results_rii"],
    },
}
# workflow inputs copied with the ppinputs mode: (input key, destination subfolder)
SELECTION_INPUTS = {"ppinputs": [("fasta_sequence_db", ""), ("sd_samples", "study_design"),
                                 ("sd_fractions", "study_design"), ("sd_references", "study_design")]}
FLAT_MODES = {"ppinputs", "results"}


def selection_table(spark: SparkSession, mode: str) -> DataFrame:
    """(task, key, flat) wanted for a copy mode; ``flat`` means the files
    go straight into the destination folder instead of ``<task>_outputs``."""
    if mode not in SELECTION:
        raise ValueError(f"mode must be one of {sorted(SELECTION)}")
    rows = [(t, k, mode in FLAT_MODES) for t, keys in SELECTION[mode].items() for k in keys]
    return spark.createDataFrame(rows, "task string, key string, flat boolean")


def input_catalog(meta: DataFrame, mode: str, id_col: str = "id", workflow_prefix: str = "") -> DataFrame:
    """J5 (inputs part): requested workflow inputs with their destination
    subfolder, one row per run."""
    wanted = SELECTION_INPUTS.get(mode, [])
    if not wanted:
        return meta.select(id_col).limit(0).withColumns(
            {"key": F.lit(None).cast("string"), "file": F.lit(None).cast("string"), "folder": F.lit(None).cast("string")})
    m = meta.select(id_col, F.explode("inputs").alias("key", "file"))
    m = m.withColumn("key", F.regexp_replace("key", "^" + _re_escape(workflow_prefix), ""))
    w = m.sparkSession.createDataFrame(wanted, "key string, folder string")
    return m.join(w, on="key").select(id_col, "key", "file", "folder")
