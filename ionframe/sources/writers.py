"""Sinks."""

from __future__ import annotations

import base64
import datetime as _dt
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """B1: unquoted tab-separated text with a header, ``NA`` for null.
    ``single_file`` coalesces to one part (only for small result tables)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("sep", "\t").option("header", "true").option("quote", "") \
        .option("escape", "").option("nullValue", "NA").option("emptyValue", "").csv(path)


def result_prefix(kind: str, prefix: str | None = None, prior: bool = False,
                  now: _dt.datetime | None = None) -> str:
    """``<prefix or MSGFPLUS_<KIND>>-<yyyymmdd_HHMMSS>`` plus ``-ip`` when a
    prior is used."""
    stamp = (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    base = prefix if prefix else f"MSGFPLUS_{kind.upper()}"
    return f"{base}-{stamp}" + ("-ip" if prior else "")


def write_crosstabs(rii: DataFrame, ratio: DataFrame, folder: str, prefix: str,
                    long: DataFrame | None = None, partition_col: str = "PlexID") -> dict[str, str]:
    """The two crosstabs as TSV (``<prefix>-RII-peptide.txt``,
    ``<prefix>-ratio.txt`` folders) and the canonical long table as Parquet
    partitioned by plex."""
    f = folder.rstrip("/")
    paths = {"rii": f"{f}/{prefix}-RII-peptide.txt", "ratio": f"{f}/{prefix}-ratio.txt"}
    write_tsv(rii, paths["rii"])
    write_tsv(ratio, paths["ratio"])
    if long is not None:
        paths["long"] = f"{f}/{prefix}-long.parquet"
        long.write.mode("overwrite").partitionBy(partition_col).parquet(paths["long"])
    return paths


def write_manifest(manifest: DataFrame, path: str) -> None:
    """``file_name,md5`` CSV with a header."""
    manifest.select("file_name", "md5").write.mode("overwrite").option("header", "true").csv(path)


def write_mzml(spectra: DataFrame, path: str, precision: int = 64, compress: bool = True) -> None:
    """Spectra (scan, ms_level, rt in minutes, precursor_mz, charge, mz, intensity) as mzML files, a spectrum a line, for
    `read_mzml`. Peak arrays are little-endian floats of ``precision`` bits, zlib-compressed if asked for, in base64 (encoded by Arrow batches)."""
    kind = f"<f{precision // 8}"

    @F.pandas_udf("string")
    def encoded(arrays: pd.Series) -> pd.Series:
        raw = arrays.map(lambda a: np.asarray(a, dtype=kind).tobytes())
        return raw.map(lambda b: base64.b64encode(zlib.compress(b) if compress else b).decode())

    def cv(accession: str, name: str, value="") -> list:
        return [F.lit(f'<cvParam accession="{accession}" name="{name}" value="'), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit('"/>')]

    how = cv("MS:1000523" if precision == 64 else "MS:1000521", f"{precision}-bit float") + (cv("MS:1000574", "zlib compression") if compress else cv("MS:1000576", "no compression"))

    def array(accession: str, name: str, column: str) -> list:
        return [F.lit("<binaryDataArray>"), *how, *cv(accession, name), F.lit("<binary>"), encoded(column), F.lit("</binary></binaryDataArray>")]

    ion = F.concat(F.lit("<precursorList><precursor><selectedIonList><selectedIon>"), *cv("MS:1000744", "selected ion m/z", F.col("precursor_mz")),
                   F.coalesce(F.concat(*cv("MS:1000041", "charge state", F.col("charge"))), F.lit("")), F.lit("</selectedIon></selectedIonList></precursor></precursorList>"))
    line = F.concat(F.lit('<spectrum id="scan='), F.col("scan").cast("string"), F.lit('">'), *cv("MS:1000511", "ms level", F.col("ms_level")),
                    F.lit("<scanList><scan>"), *cv("MS:1000016", "scan start time", F.col("rt")), F.lit("</scan></scanList>"), F.coalesce(ion, F.lit("")),
                    F.lit("<binaryDataArrayList>"), *array("MS:1000514", "m/z array", "mz"), *array("MS:1000515", "intensity array", "intensity"),
                    F.lit("</binaryDataArrayList></spectrum>"))

    def framed(batches):  # every file is a document of its own
        yield pd.DataFrame({"value": ['<?xml version="1.0"?><mzML><run><spectrumList>']})
        yield from batches
        yield pd.DataFrame({"value": ["</spectrumList></run></mzML>"]})

    spectra.select(line.alias("value")).mapInPandas(framed, "value string").write.mode("overwrite").text(path)
