"""Run bookkeeping (SURVEY J) and readers / writers (A, B) on small files."""

import base64
import json
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionframe.operators import runs
from ionframe.sources import readers, writers

META = {
    "id": "run1", "start": "2024-01-01T00:00:00.000Z", "end": "2024-01-01T02:30:00.000Z", "status": "Succeeded",
    "inputs": {"wf.fasta": "gs://b/db.fasta"},
    "calls": {
        "wf.masic": [
            {"executionStatus": "Failed", "stdout": "gs://b/0/stdout", "commandLine": "masic x",
             "outputs": {}},
            {"executionStatus": "Done", "stdout": "gs://b/1/stdout", "commandLine": "masic x",
             "outputs": {"ReporterIons_output_file": "gs://b/1/a_ReporterIons.txt",
                         "SICstats_output_file": "[\"gs://b/1/a_SICstats.txt\", \"gs://b/1/b_SICstats.txt\"]"}}],
        "wf.msgf": [{"executionStatus": "Done", "stdout": "gs://b/2/stdout", "commandLine": "java -jar",
                     "outputs": {"mzid": "gs://b/2/a.mzid"}}]},
}
META2 = {"id": "run2", "start": "2024-01-02T00:00:00.000Z", "end": "2024-01-02T00:00:10.000Z",
         "failures": [{"message": "Workflow failed", "causedBy": [{"message": "disk full"}, {"message": "oom"}]}],
         "calls": {}}


@pytest.fixture()
def meta(spark, tmpdir_path):
    for i, m in enumerate([META, META2]):
        with open(os.path.join(tmpdir_path, f"r{i}.metadata.json"), "w") as f:
            json.dump(m, f, indent=1)
    return runs.read_run_metadata(spark, tmpdir_path)


def test_durations_failures(meta):
    d = {r["id"]: r["duration_s"] for r in runs.run_durations(meta).collect()}
    assert d == {"run1": 9000.0, "run2": 10.0}
    f = runs.run_failures(meta).where("id = 'run2'").orderBy("cause_no").collect()
    assert [r["cause_message"] for r in f] == ["disk full", "oom"] and f[0]["n_failures"] == 1
    assert runs.run_failures(meta).where("id = 'run1'").first()["n_failures"] == 0


def test_attempts_catalog_missing(spark, meta):
    att = runs.call_attempts(meta, workflow_prefix="wf.")
    assert att.count() == 3
    wanted = runs.wanted_outputs(spark, [("full", "masic", "ReporterIons_output_file"),
                                         ("full", "masic", "SICstats_output_file"),
                                         ("full", "masic", "not_there"), ("full", "ascore", "x"),
                                         ("results", "msgf", "mzid")], "full")
    cat = runs.output_catalog(att, wanted)
    assert sorted(r["file"] for r in cat.collect()) == ["gs://b/1/a_ReporterIons.txt", "gs://b/1/a_SICstats.txt",
                                                          "gs://b/1/b_SICstats.txt"]
    miss = sorted((r["task"], r["key"]) for r in runs.missing_outputs(att, wanted).collect())
    assert miss == [("ascore", "x"), ("masic", "not_there")]
    paths = runs.plan_paths(cat, "gs://dest/out").collect()
    assert all(r["destination"].startswith("gs://dest/out/masic_outputs/") for r in paths)


def test_parse_bucket_path(spark):
    df = spark.createDataFrame([("gs://bucket/a/b.txt",), ("s3://b2",), ("http://x/y",), ("gs:///k",)], "p string")
    got = [tuple(r) for r in df.select(runs.parse_bucket_path(F.col("p")).alias("x")).select("x.*").collect()]
    assert got[0] == ("gs", "bucket", "a/b.txt", None)
    assert got[1] == ("s3", "b2", "", None)
    assert got[2][3] is not None and got[3][3] == "empty bucket name"


def test_file_manifest(spark, tmpdir_path):
    for name, body in [("a.txt", b"hello"), ("sub/b.txt", b"world"), ("old_file_manifest.csv", b"x")]:
        os.makedirs(os.path.dirname(os.path.join(tmpdir_path, name)), exist_ok=True)
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(body)
    got = sorted(tuple(r) for r in runs.file_manifest(spark, tmpdir_path).collect())
    assert got == [("a.txt", "5d41402abc4b2a76b9719d911017c592"), ("sub/b.txt", "7d793037a0760186574b0282f2f435e7")]
    with pytest.raises(ValueError):
        runs.file_manifest(spark, os.path.join(tmpdir_path, "sub"), glob="*.none")


def test_tsv_round_trip_and_required(spark, tmpdir_path):
    df = spark.createDataFrame([("S1", 1, None), ("S2", 2, "x")], "PlexID string, QuantBlock int, Ref string")
    out = os.path.join(tmpdir_path, "t")
    writers.write_tsv(df, out, single_file=True)
    text = open([os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")][0]).read()
    assert text.splitlines()[0] == "PlexID\tQuantBlock\tRef" and "S1\t1\tNA" in text
    back = readers.read_tsv(spark, out, "PlexID string, QuantBlock int, Ref string", required=["PlexID"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    with pytest.raises(ValueError, match="missing required"):
        readers.read_tsv(spark, out, required=["nope"])


def test_read_fasta(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "db.fasta")
    with open(p, "w") as f:
        f.write(">sp|P12345|ABC_HUMAN Protein a>b\nMKR\nPEP\n>NP_000001.1 other\nAAAK\n")
    got = sorted(tuple(r) for r in readers.read_fasta(spark, p).collect())
    assert got == [("NP_000001.1", "other", "AAAK"), ("P12345", "Protein a>b", "MKRPEP")]


def test_read_mzml(spark, tmpdir_path):
    mz = np.array([100.5, 200.25], dtype="<f8")
    it = np.array([10.0, 20.0], dtype="<f4")
    b_mz = base64.b64encode(zlib.compress(mz.tobytes())).decode()
    b_it = base64.b64encode(it.tobytes()).decode()
    xml = f"""<?xml version="1.0"?><mzML><run><spectrumList count="1">
<spectrum index="0" id="controllerType=0 controllerNumber=1 scan=7" defaultArrayLength="2">
<cvParam accession="MS:1000511" name="ms level" value="2"/>
<scanList><scan><cvParam accession="MS:1000016" name="scan start time" value="12.5"/></scan></scanList>
<precursorList><precursor><selectedIonList><selectedIon>
<cvParam accession="MS:1000744" name="selected ion m/z" value="500.25"/>
<cvParam accession="MS:1000041" name="charge state" value="2"/></selectedIon></selectedIonList></precursor></precursorList>
<binaryDataArrayList count="2">
<binaryDataArray><cvParam accession="MS:1000523" name="64-bit float" value=""/>
<cvParam accession="MS:1000574" name="zlib compression" value=""/>
<cvParam accession="MS:1000514" name="m/z array" value=""/><binary>{b_mz}</binary></binaryDataArray>
<binaryDataArray><cvParam accession="MS:1000521" name="32-bit float" value=""/>
<cvParam accession="MS:1000515" name="intensity array" value=""/><binary>{b_it}</binary></binaryDataArray>
</binaryDataArrayList></spectrum></spectrumList></run></mzML>"""
    p = os.path.join(tmpdir_path, "ds1.mzML")
    with open(p, "w") as f:
        f.write(xml)
    r = readers.read_mzml(spark, p).first()
    assert (r["dataset"], r["scan"], r["ms_level"], r["rt"], r["precursor_mz"], r["charge"]) == \
        ("ds1", 7, 2, 12.5, 500.25, 2)
    assert list(r["mz"]) == [100.5, 200.25] and list(r["intensity"]) == [10.0, 20.0]
    assert readers.spectra_to_peaks(readers.read_mzml(spark, p)).count() == 2


def test_read_psms_and_dataset_tables(spark, tmpdir_path):
    hdr = "ScanNum\tCharge\tPeptide\tProtein\tPrecursorMZ\tMSGFScore\tSpecEValue\n"
    for ds in ["a", "b"]:
        with open(os.path.join(tmpdir_path, f"{ds}.tsv"), "w") as f:
            f.write(hdr + "1\t2\tK.PEPTIDE.R\tP1;XXX_P2\t500.1\t100\t1e-12\n")
    p = readers.read_psms(spark, tmpdir_path)
    got = sorted((r["dataset"], r["protein"], r["is_decoy"]) for r in p.collect())
    assert got == [("a", "P1", False), ("a", "XXX_P2", True), ("b", "P1", False), ("b", "XXX_P2", True)]


def test_mod_defs_and_tags(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "mods.txt")
    with open(p, "w") as f:
        f.write("*\t79.966331\tSTY\tD\tPhosph   \n")
    r = readers.read_mod_defs(spark, p).first()
    assert r["tag"] == "Phosph" and r["mass"] == 79.966331


def test_result_prefix():
    import datetime as dt
    now = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert writers.result_prefix("ph", now=now) == "MSGFPLUS_PH-20240506_070809"
    assert writers.result_prefix("pr", "X", True, now) == "X-20240506_070809-ip"


def test_map_peptides_substring(spark):
    from ionframe.operators import hits
    prot = spark.createDataFrame([("P1", "MKAAAPEPTIDEKR"), ("P2", "PEPTIDEXX"), ("P3", "QQQ")],
                                 "accession string, sequence string")
    peps = spark.createDataFrame([("PEPTIDE",), ("AAAPEP",), ("KR",), ("ZZZZZZZ",)], "peptide string")
    got = sorted(tuple(r) for r in hits.map_peptides_substring(peps, prot, k=4).collect())
    assert got == [("AAAPEP", "P1", 3), ("KR", "P1", 13), ("PEPTIDE", "P1", 6), ("PEPTIDE", "P2", 1)]


def test_selection_table(spark):
    from ionframe.operators import runs as R
    full = R.selection_table(spark, "full")
    assert full.where("task = 'masic'").count() == 16 and not full.first()["flat"]
    assert R.selection_table(spark, "results").count() == 2
    with pytest.raises(ValueError):
        R.selection_table(spark, "nope")


def test_kmers_with_supplementary_characters(spark):
    from ionframe.operators import hits
    prot = spark.createDataFrame([("P1", "ab\U0001F600cdab"), ("P2", "xxabyy")], "accession string, sequence string")
    peps = spark.createDataFrame([("ab",), ("\U0001F600c",), ("cdab",)], "peptide string")
    got = sorted(tuple(r) for r in hits.map_peptides_substring(peps, prot, k=2).collect())
    assert got == [("ab", "P1", 1), ("ab", "P1", 6), ("ab", "P2", 3), ("cdab", "P1", 4), ("\U0001F600c", "P1", 3)]


def test_file_manifest_hashes_in_chunks(spark, tmpdir_path):
    import hashlib
    body = os.urandom(3000)
    for name in ["big.bin", "small.txt"]:
        with open(os.path.join(tmpdir_path, name), "wb") as f:
            f.write(body if name == "big.bin" else b"hello")
    got = dict(tuple(r) for r in runs.file_manifest(spark, tmpdir_path).collect())
    assert got == {"big.bin": hashlib.md5(body).hexdigest(), "small.txt": hashlib.md5(b"hello").hexdigest()}
