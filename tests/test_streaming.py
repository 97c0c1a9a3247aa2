"""Streaming gather of per-dataset tables with availableNow triggers."""

import os

from ionframe.streaming import gather

SCHEMA = "scan long, channel string, intensity double"


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write("scan\tchannel\tintensity\n" + "".join(f"{a}\t{b}\t{c}\n" for a, b, c in rows))


def test_gather_and_totals(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write(src, "ds1_ReporterIons.txt", [(1, "126", 5.0), (1, "127N", 3.0)])
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    q = gather.gather_to_parquet(gather.stream_dataset_tables(spark, src, "_ReporterIons.txt", SCHEMA), out, ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    # a second dataset lands later: only the new file is processed
    _write(src, "ds2_ReporterIons.txt", [(4, "126", 1.0)])
    q = gather.gather_to_parquet(gather.stream_dataset_tables(spark, src, "_ReporterIons.txt", SCHEMA), out, ck)
    q.awaitTermination()
    got = sorted((r["dataset"], r["scan"]) for r in spark.read.parquet(out).collect())
    assert got == [("ds1", 1), ("ds1", 1), ("ds2", 4)]

    tot, tck = os.path.join(tmpdir_path, "tot"), os.path.join(tmpdir_path, "tck")
    s = gather.reporter_totals(gather.stream_dataset_tables(spark, src, "_ReporterIons.txt", SCHEMA), ["dataset"])
    gather.upsert_totals(s, tot, tck).awaitTermination()
    t = {(r["dataset"], r["channel"]): r["intensity"] for r in spark.read.parquet(tot).collect()}
    assert t == {("ds1", "126"): 5.0, ("ds1", "127N"): 3.0, ("ds2", "126"): 1.0}
