"""More registered queries: operators that `queries` doesn't call, on the driver's tables, with their SQL.

Every query calls the operator's own function; ORACLE has the DuckDB SQL for the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import design, hits, inference, quant, recalibrate, runs, scans, search, sites
from ..session import scratch_path as _folder
from ..sources import readers, writers
from .queries import CHAR_MASS, _mod_defs, _unit_prices
from .tables import spread, table

ORACLE: dict[str, str] = {}


def q63_attach_design(spark, sf):
    """H2: return flag as dataset (plex S_<flag>), line status as channel; summed per sample."""
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.col("l_linestatus").alias("channel"), "l_quantity")
    fractions = li.select(F.col("dataset").alias("Dataset"), F.concat(F.lit("S_"), "dataset").alias("PlexID")).distinct()
    samples = li.select(F.concat(F.lit("S_"), "dataset").alias("PlexID"), F.col("channel").alias("ReporterName")).distinct() \
        .where("ReporterName = 'F'").withColumn("MeasurementName", F.concat_ws("_", "PlexID", "ReporterName"))
    q = quant.attach_design(li, fractions, samples)
    return q.groupBy("MeasurementName").agg(F.round(F.sum("l_quantity"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


ORACLE["q63_attach_design"] = """
SELECT 'S_' || l_returnflag || '_' || l_linestatus AS MeasurementName, ROUND(SUM(l_quantity), 2) AS total, COUNT(*) AS n
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1
"""


def q64_filter_ascore(spark, sf):
    """H4: orders as matches, their lines' discounts (x 100) as site scores: kept at 9 or more, or unscored."""
    psm = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    score = table(spark, sf, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_discount") * 100).alias("ascore"))
    kept = quant.filter_ascore(psm, score, 8.5, ["o_orderkey"], keep_unscored=True)
    return kept.select("o_orderkey", "o_orderstatus", F.round("ascore", 6).alias("ascore"))


ORACLE["q64_filter_ascore"] = """
WITH b AS (SELECT l_orderkey, MAX(l_discount * 100) AS s FROM lineitem WHERE l_quantity > 10 GROUP BY 1)
SELECT o_orderkey, o_orderstatus, ROUND(s, 6) AS ascore FROM orders LEFT JOIN b ON l_orderkey = o_orderkey
WHERE s >= 8.5::DOUBLE OR s IS NULL
"""


def q66_feature_key(spark, sf):
    """Features of a PTM run: the site (brand) where there is one, else the peptide (name); of a global run the protein (type)."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("peptide"), F.col("p_type").alias("protein"),
                                        F.when(F.col("p_size") > 25, F.col("p_brand")).alias("site_id"))
    return p.select("p_partkey", quant.feature_key("ph").alias("ph"), quant.feature_key("pr").alias("pr"))


ORACLE["q66_feature_key"] = "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE p_name END AS ph, p_type AS pr FROM part"

_NO_G = {k: v for k, v in CHAR_MASS.items() if k != "g"}


def q67_peptide_mass(spark, sf):
    """Masses of part names by character code, 57 more on every 'a' and 10 at the start; null with a 'g', which has no mass."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return search.peptide_mass(p, "p_name", _NO_G, {"a": 57.0}, 10.0).select("p_partkey", F.round("mass", 4).alias("mass"))


ORACLE["q67_peptide_mass"] = """
SELECT p_partkey, CASE WHEN NOT contains(p_name, 'g') THEN ROUND(18.010564684::DOUBLE + 10
  + list_sum(list_transform(string_split(p_name, ''), lambda c: ascii(c)::DOUBLE + CASE WHEN c = 'a' THEN 57 ELSE 0 END)), 4) END AS mass
FROM part
"""


def q68_score_matches(spark, sf):
    """Per nation, supplier balances as peaks (intensity: key + 1) against customer balances as fragments, within 5."""
    pk = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), "s_acctbal", (F.col("s_suppkey") + 1).cast("double").alias("i"))
    fr = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), "c_acctbal")
    m = search.score_matches(pk, fr, ["nation"], "s_acctbal", "i", "c_acctbal", 5.0)
    return m.select("nation", "n_matched", F.round("matched_intensity", 4).alias("matched_intensity"), F.round("hyperscore", 6).alias("hyperscore"))


ORACLE["q68_score_matches"] = """
WITH m AS (SELECT s_nationkey AS nation, COUNT(*) AS n, SUM(s_suppkey + 1)::DOUBLE AS t
  FROM supplier JOIN customer ON s_nationkey = c_nationkey AND ABS(s_acctbal - c_acctbal) <= 5.0::DOUBLE GROUP BY 1)
SELECT nation, n AS n_matched, ROUND(t, 4) AS matched_intensity,
  ROUND(list_sum(list_transform(range(1, n + 1), lambda i: log10(i))) + log10(t), 6) AS hyperscore FROM m
"""


def q69_mass_error(spark, sf):
    """Line unit prices as precursor m/z (charge 1 or 2) against the part's price as mass."""
    u = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"),
                                            F.try_divide("l_extendedprice", "l_quantity").alias("precursor_mz"), (F.col("l_linenumber") % 2 + 1).alias("charge"))
    m = recalibrate.mass_error_ppm(u.join(table(spark, sf, "part").select("p_partkey", "p_retailprice"), on="p_partkey"), peptide_mass="p_retailprice")
    return m.select("l_orderkey", "l_linenumber", "isotope", F.round("ppm_error", 3).alias("ppm_error"))


ORACLE["q69_mass_error"] = """
WITH d AS (SELECT l_orderkey, l_linenumber, p_retailprice AS m,
    (l_extendedprice / l_quantity - 1.007276466812::DOUBLE) * (l_linenumber % 2 + 1) - p_retailprice AS diff
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, ROUND(diff / 1.00335483::DOUBLE)::INTEGER AS isotope,
  ROUND((diff - ROUND(diff / 1.00335483::DOUBLE) * 1.00335483::DOUBLE) / m * 1e6::DOUBLE, 3) AS ppm_error FROM d
"""

CHANNELS = [("c1", 950.0), ("c2", 1000.0), ("c3", 1100.0), ("c4", 1115.0)]


def q70_reporter_ions(spark, sf):
    """per supplier the largest line (quantity as intensity) whose unit price is within 15 of a channel."""
    pk = table(spark, sf, "lineitem").select("l_suppkey", F.try_divide("l_extendedprice", "l_quantity").alias("mz"), F.col("l_quantity").alias("intensity"))
    ch = spark.createDataFrame(CHANNELS, "channel string, channel_mz double")
    r = scans.reporter_ions(pk, ch, ["l_suppkey"], tol_da=15.0)
    return r.select("l_suppkey", "channel", "intensity", F.round("observed_mz", 6).alias("observed_mz"))


ORACLE["q70_reporter_ions"] = """
WITH u AS (SELECT l_suppkey, l_extendedprice / l_quantity AS mz, l_quantity AS i FROM lineitem),
c AS (SELECT * FROM (VALUES ('c1', 950.0::DOUBLE), ('c2', 1000.0::DOUBLE), ('c3', 1100.0::DOUBLE), ('c4', 1115.0::DOUBLE)) v(channel, cmz)),
j AS (SELECT l_suppkey, channel, i, mz, ROW_NUMBER() OVER (PARTITION BY l_suppkey, channel ORDER BY i DESC, ABS(mz - cmz), mz) AS rn
      FROM u JOIN c ON ABS(mz - cmz) <= 15.0::DOUBLE)
SELECT l_suppkey, channel, i AS intensity, ROUND(mz, 6) AS observed_mz FROM j WHERE rn = 1
"""


def q71_promote_ms3(spark, sf):
    """orders as scans (status F: MS3 with the order before as parent, none for the first); lines moved and counted per scan."""
    sc = table(spark, sf, "orders").select(F.col("o_orderkey").alias("scan"), F.when(F.col("o_orderkey") > 0, F.col("o_orderkey") - 1).alias("parent_scan"),
                                           F.when(F.col("o_orderstatus") == "F", 3).otherwise(2).alias("ms_level"))
    ri = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("scan"), "l_quantity")
    p = scans.promote_ms3(ri, sc, ["scan"])
    return p.groupBy("scan").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))


ORACLE["q71_promote_ms3"] = """
SELECT CASE WHEN o_orderstatus = 'F' AND o_orderkey > 0 THEN l_orderkey - 1 ELSE l_orderkey END AS scan, COUNT(*) AS n, SUM(l_quantity) AS total
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
"""


def q72_filter_noise(spark, sf):
    """per supplier, lines with a price of twice the mean of the lower half or more."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    k = scans.filter_noise(li, ["l_suppkey"], "l_extendedprice", "l_orderkey", 0.5, 2.0)
    return k.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.first("noise"), 4).alias("noise"))


ORACLE["q72_filter_noise"] = """
WITH r AS (SELECT l_suppkey, l_extendedprice AS x, PERCENT_RANK() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS pr FROM lineitem),
n AS (SELECT l_suppkey, AVG(x) AS noise FROM r WHERE pr <= 0.5::DOUBLE GROUP BY 1)
SELECT r.l_suppkey, COUNT(*) AS n, ROUND(n.noise, 4) AS noise FROM r JOIN n ON r.l_suppkey = n.l_suppkey WHERE x / noise >= 2 GROUP BY r.l_suppkey, n.noise
"""


def q73_scan_stats(spark, sf):
    """orders as spectra (line prices as m/z, quantities as intensity)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("k"), F.col("l_extendedprice").alias("m"), F.col("l_quantity").alias("i"))))
    sp = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(pairs.alias("p"))
    sp = sp.select("l_orderkey", F.col("p.m").alias("mz"), F.col("p.i").alias("intensity"))
    return scans.scan_stats(sp).select("l_orderkey", F.round("tic", 4).alias("tic"), "base_peak_intensity", "base_peak_mz", "n_peaks")


ORACLE["q73_scan_stats"] = """
SELECT l_orderkey, ROUND(SUM(l_quantity), 4) AS tic, MAX(l_quantity) AS base_peak_intensity,
  MAX({'i': l_quantity, 'm': l_extendedprice}).m AS base_peak_mz, COUNT(*)::INTEGER AS n_peaks FROM lineitem GROUP BY 1
"""


def q74_dataset_info(spark, sf):
    """per order status the number of orders and the range of their prices."""
    return scans.dataset_info(table(spark, sf, "orders"), "o_orderstatus", "o_orderkey", "o_totalprice")


ORACLE["q74_dataset_info"] = """
SELECT o_orderstatus, COUNT(o_orderkey) AS n_scans, MIN(o_totalprice) AS rt_min, MAX(o_totalprice) AS rt_max FROM orders GROUP BY 1
"""


def q75_restrict_range(spark, sf):
    """parts with a price from 950 on, sizes up to 30."""
    p = scans.restrict_range(table(spark, sf, "part"), "p_retailprice", 950.0)
    return scans.restrict_range(p, "p_size", 0, 30).select("p_partkey", "p_size", "p_retailprice")


ORACLE["q75_restrict_range"] = "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_retailprice >= 950 AND p_size <= 30"


def q76_sequence_maps(spark, sf):
    """Parts as results (name as peptide, brand and type as its proteins): per result and protein, over the sequence ids."""
    syn = table(spark, sf, "part").select(F.col("p_partkey").alias("result_id"), F.col("p_name").alias("peptide"),
                                          F.concat_ws(";", "p_brand", "p_type").alias("protein"))
    ids = hits.result_to_seq(syn).join(hits.seq_info(syn), on="seq_id").join(hits.seq_to_protein(syn), on="seq_id")
    return ids.select("result_id", "peptide", "protein")


ORACLE["q76_sequence_maps"] = """
WITH m AS (SELECT DISTINCT p_name, p_brand AS protein FROM part UNION SELECT DISTINCT p_name, p_type FROM part)
SELECT p_partkey AS result_id, part.p_name AS peptide, protein FROM part JOIN m ON m.p_name = part.p_name
"""


def q77_protein_mods(spark, sf):
    """G7 + G9: modified residues of part names, numbered inside the parts (start: size)."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("peptide")).distinct()
    det = hits.mod_details(names, ["peptide"], "peptide", _mod_defs(spark), "a-z")
    where = table(spark, sf, "part").select(F.col("p_name").alias("peptide"), "p_partkey", F.col("p_size").alias("start"))
    return hits.protein_mods(det, where).select("p_partkey", "mod_name", "position", "protein_position")


ORACLE["q77_protein_mods"] = """
WITH c AS (SELECT p_partkey, p_size, p_name, unnest(range(1, length(p_name) + 1)) AS i FROM part),
l AS (SELECT *, substr(p_name, i, 1) AS ch, length(regexp_replace(substr(p_name, 1, i), '[^a-z]', '', 'g')) AS pos,
             regexp_extract(substr(p_name, i + 1), '^[^a-z]*') AS sym FROM c),
m AS (SELECT p_partkey, p_size, pos, 'Dimethyl' AS mod_name FROM l WHERE ch = 'r'
      UNION ALL SELECT p_partkey, p_size, pos, 'Oxidation' FROM l WHERE ch = 'e'
      UNION ALL SELECT p_partkey, p_size, pos, 'Phospho' FROM l WHERE ch = 'l' AND contains(sym, ' '))
SELECT p_partkey, mod_name, pos::INTEGER AS position, (p_size + pos - 1)::INTEGER AS protein_position FROM m
"""


def q78_clean_sequence(spark, sf):
    """Flanked, marked part names cleaned."""
    raw = F.concat(F.lit("K."), F.regexp_replace(F.upper("p_name"), " ", "*"), F.lit(".R"))
    return table(spark, sf, "part").select("p_partkey", hits.clean_sequence(raw).alias("clean"))


ORACLE["q78_clean_sequence"] = "SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') AS clean FROM part"


def q79_prefilter_and_sites(spark, sf):
    """Lines with a discount of 0.02 at most as matches, the tax as their site score (two sites: line number and
    the next), numbered inside the part (start: size)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")
    kept = sites.prefilter(li.drop("l_tax"), "l_discount", 0.02)
    score = li.where("l_tax > 0.04").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("ascore"),
                                            F.array("l_linenumber", F.col("l_linenumber") + 1).alias("sites"))
    both = sites.add_ascore(kept, score, ["l_orderkey", "l_linenumber"])
    where = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("start"))
    m = sites.site_protein_map(both.where("sites is not null"), where, "l_partkey")
    return m.select("l_orderkey", "l_linenumber", "l_partkey", "ascore", "position", "protein_position")


ORACLE["q79_prefilter_and_sites"] = """
SELECT k.l_orderkey, k.l_linenumber, k.l_partkey, s.l_tax AS ascore, (k.l_linenumber + i)::INTEGER AS position, (p_size + k.l_linenumber + i - 1)::INTEGER AS protein_position
FROM lineitem k JOIN lineitem s ON s.l_orderkey = k.l_orderkey AND s.l_linenumber = k.l_linenumber JOIN part ON p_partkey = k.l_partkey
CROSS JOIN (VALUES (0), (1)) v(i) WHERE k.l_discount <= 0.02::DOUBLE AND s.l_tax > 0.04::DOUBLE
"""


def _runs(spark, sf):
    """Users as workflow runs, event types as tasks, events as attempts (a value above 100: Done, with an output)."""
    ev = table(spark, sf, "events")
    done = F.col("value") > 100
    attempt = F.struct(F.col("event_id").alias("_k"), F.when(done, "Done").otherwise("Failed").alias("executionStatus"),
                       F.concat(F.lit("gs://b/log/"), F.col("event_id").cast("string")).alias("stdout"),
                       F.concat(F.lit("run "), F.col("event_id").cast("string")).alias("commandLine"),
                       F.create_map(F.lit("value"), F.col("value").cast("string")).alias("inputs"),
                       F.create_map(F.lit("out"), F.when(done, F.concat(F.lit('["gs://b/x/a'), F.col("event_id").cast("string"), F.lit('","gs://b/x/b"]')))).alias("outputs"))
    per = ev.groupBy("user_id", "event_type").agg(F.array_sort(F.collect_list(attempt), lambda x, y: F.signum(x["_k"] - y["_k"]).cast("int")).alias("a"), F.min("ts").alias("s"), F.max("ts").alias("e"))
    return per.groupBy(F.col("user_id").alias("id")).agg(
        F.min("s").alias("start"), F.max("e").alias("end"), F.map_from_entries(F.collect_list(F.struct("event_type", "a"))).alias("calls"),
        F.array(F.struct(F.lit("first").alias("message"), F.array(F.struct(F.lit("x").alias("message")), F.struct(F.lit("y").alias("message"))).alias("causedBy"))).alias("failures"))


def q80_run_durations(spark, sf):
    """Seconds between a user's first and last event."""
    return runs.run_durations(_runs(spark, sf)).select("id", F.round("duration_s", 6).alias("duration_s"))


ORACLE["q80_run_durations"] = "SELECT user_id AS id, ROUND((MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 1e6::DOUBLE, 6) AS duration_s FROM events GROUP BY 1"


def q81_run_failures(spark, sf):
    """A failure with two causes for each run."""
    f = runs.run_failures(_runs(spark, sf))
    return f.select("id", "n_failures", "failure_no", "failure_message", "cause_no", "cause_message")


ORACLE["q81_run_failures"] = """
SELECT DISTINCT user_id AS id, 1 AS n_failures, 0 AS failure_no, 'first' AS failure_message, k AS cause_no, m AS cause_message
FROM events, (VALUES (0, 'x'), (1, 'y')) v(k, m)
"""


def q82_call_attempts(spark, sf):
    """J4 + J10: attempts in order with their command and log file names."""
    a = runs.command_files(runs.call_attempts(_runs(spark, sf)))
    return a.select("id", "task", "attempt_no", "command", "command_file", "log_file")


ORACLE["q82_call_attempts"] = """
WITH a AS (SELECT user_id AS id, event_type AS task, event_id, (ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1)::INTEGER AS n FROM events)
SELECT id, task, n AS attempt_no, 'run ' || event_id AS command, task || '_' || n || '.command.txt' AS command_file, task || '_' || n || '.log' AS log_file FROM a
"""


def q83_output_catalog(spark, sf):
    """J5 + J7 + J8: files of successful attempts of the wanted tasks and where they go."""
    wanted = runs.wanted_outputs(spark, [("full", "click", "out"), ("full", "view", "out"), ("short", "view", "out"), ("full", "view", "none")], "full")
    cat = runs.output_catalog(runs.call_attempts(_runs(spark, sf)), wanted)
    return runs.plan_paths(cat, "gs://dest/").select("id", "task", "attempt_no", "file", "destination")


ORACLE["q83_output_catalog"] = """
WITH a AS (SELECT user_id AS id, event_type AS task, event_id, value, (ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1)::INTEGER AS attempt_no FROM events)
SELECT id, task, attempt_no, 'gs://b/x/' || f AS file, 'gs://dest/' || task || '_outputs/' || f AS destination
FROM (SELECT *, unnest(['a' || event_id, 'b']) AS f FROM a WHERE value > 100 AND task IN ('click', 'view'))
"""


def q84_missing_outputs(spark, sf):
    """Users without a successful click, purchase or nap, and why."""
    wanted = spark.createDataFrame([("click", "out"), ("purchase", "out"), ("nap", "out")], "task string, key string")
    return runs.missing_outputs(runs.call_attempts(_runs(spark, sf)), wanted).select("id", "task", "key", "reason")


ORACLE["q84_missing_outputs"] = """
WITH w AS (SELECT DISTINCT user_id AS id, task FROM events, (VALUES ('click'), ('purchase'), ('nap')) v(task))
SELECT id, task, 'out' AS key, CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id = id AND event_type = task)
  THEN 'no Done attempt with this output' ELSE 'task not run' END AS reason
FROM w WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = id AND event_type = task AND value > 100)
"""


def q85_build_fractions(spark, sf):
    """Documents as raw files in a folder a source."""
    files = table(spark, sf, "documents").select("source", F.concat(F.lit("/raw/"), "source", F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".RAW")).alias("path"))
    return design.build_fractions(files, "path", "source").select("Dataset", "PlexID")


ORACLE["q85_build_fractions"] = "SELECT 'd' || doc_id AS Dataset, 'S' || DENSE_RANK() OVER (ORDER BY source) AS PlexID FROM documents"


def q86_batch_path(spark, sf):
    """Batch, assay, site and name of paths made from orders."""
    o = table(spark, sf, "orders")
    path = F.concat(F.lit("/d/BATCH"), (F.col("o_orderkey") % 7).cast("string"), F.lit("_20240"), F.lit("101"), F.lit("/PROT_"),
                    F.when(F.col("o_orderstatus") == "F", "PH").otherwise("PR"), F.when(F.col("o_orderkey") % 2 == 0, "/PNBI/").otherwise("/else/"),
                    F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".raw"))
    return o.select("o_orderkey", design.parse_batch_path(path).alias("x")).select("o_orderkey", "x.*")


ORACLE["q86_batch_path"] = """
SELECT o_orderkey, 'BATCH' || (o_orderkey % 7) || '_20240101' AS batch, CASE WHEN o_orderstatus = 'F' THEN 'PH' ELSE 'PR' END AS assay,
  CASE WHEN o_orderkey % 2 = 0 THEN 'PNBI' END AS site, 'f' || o_orderkey || '.raw' AS file_name FROM orders
"""


def q87_tsv_round_trip(spark, sf):
    """B1 + A1 + A2: orders written as tab-separated text, one folder a status, and read back by name as one table."""
    at = _folder(spark, "tsv")
    o = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority")).alias("o_orderpriority"), "o_totalprice")
    writers.write_tsv(o, at)
    back = readers.read_tsv(spark, at, "o_totalprice double, o_orderkey long, o_orderpriority string, o_none int", ["o_orderkey", "o_totalprice"])
    same = readers.read_dataset_tables(spark, at, ".csv", "o_orderkey long").groupBy("o_orderkey").agg(F.count_distinct("dataset").alias("n_files"))
    return back.join(same, on="o_orderkey").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_none", "n_files")


ORACLE["q87_tsv_round_trip"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS o_orderpriority, o_totalprice, NULL::INTEGER AS o_none, 1::BIGINT AS n_files FROM orders
"""


def q88_fasta_round_trip(spark, sf):
    """A3: part names as sequences in a FASTA file, read back."""
    at = _folder(spark, "fasta")
    p = table(spark, sf, "part").select(F.concat(F.lit(">sp|P"), F.col("p_partkey").cast("string"), F.lit("|X "), "p_type", F.lit("\n"),
                                                 F.substring("p_name", 1, 5), F.lit("\n"), F.expr("substring(p_name, 6)")).alias("value"))
    p.write.text(at)
    return readers.read_fasta(spark, at)


ORACLE["q88_fasta_round_trip"] = """
SELECT 'P' || p_partkey AS accession, p_type AS description, regexp_replace(p_name, '\\s', '', 'g') AS sequence FROM part
"""


def q90_file_manifest(spark, sf):
    """A8 + J1: part names as files; listed, and hashed by content."""
    at = _folder(spark, "files")
    p = table(spark, sf, "part").select("p_size", F.col("p_name").alias("value"))
    p.repartitionByRange(4, "p_size").write.partitionBy("p_size").text(at)
    man = runs.file_manifest(spark, at, "part-*")
    files = readers.list_files(spark, at, ".txt").select(F.regexp_extract("path", r"p_size=([0-9]+)", 1).cast("int").alias("p_size"), "length")
    n = man.select(F.regexp_extract("file_name", r"p_size=([0-9]+)", 1).cast("int").alias("p_size"), "md5").groupBy("p_size").agg(
        F.max(F.length("md5")).alias("digest_length"))
    return files.groupBy("p_size").agg(F.sum("length").alias("bytes")).join(n, on="p_size")


ORACLE["q90_file_manifest"] = """
SELECT p_size, SUM(strlen(p_name) + 1)::BIGINT AS bytes, 32 AS digest_length FROM part GROUP BY 1
"""


def q92_uneven_tolerance(spark, sf):
    """Unit prices as precursor m/z of charge 1 from 0.5 below to 2.0 above part prices as masses. Equal m/z are one
    spectrum with their number and equal masses one candidate, whose sums go to all its parts."""
    s = _unit_prices(spark, sf).groupBy(F.col("unit_price").alias("precursor_mz"), F.lit(1).alias("charge")).agg(F.count(F.lit(1)).alias("n"))
    peps = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("pmass"))
    m = search.match_candidates(s, peps.select("pmass").distinct(), "precursor_mz", "charge", "pmass", (0.5, 2.0), isotopes=(0,), ppm=False)
    return peps.join(m.groupBy("pmass").agg(F.sum("n").alias("n")), on="pmass").groupBy("p_partkey").agg(F.sum("n").alias("n"))


ORACLE["q92_uneven_tolerance"] = """
SELECT p_partkey, COUNT(*) AS n FROM lineitem JOIN part
  ON ABS(l_extendedprice / l_quantity - 1.007276466812::DOUBLE - (p_retailprice + 0.75)) <= 1.25::DOUBLE GROUP BY 1
"""


def q93_confident_subset(spark, sf):
    """Lines that pass their supplier's first discount threshold with at least 165 lines, summed per supplier."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_discount", "l_quantity")
    k = recalibrate.confident_subset(li, ["l_suppkey"], "l_discount", 0.01, 2.0, 3, 165)
    return k.groupBy("l_suppkey", "threshold").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))


ORACLE["q93_confident_subset"] = """
WITH c AS (SELECT l_suppkey AS s, COUNT(*) FILTER (l_discount <= 0.01::DOUBLE) AS n0, COUNT(*) FILTER (l_discount <= 0.02::DOUBLE) AS n1,
  COUNT(*) FILTER (l_discount <= 0.04::DOUBLE) AS n2 FROM lineitem GROUP BY 1),
t AS (SELECT s, CASE WHEN n0 >= 165 THEN 0.01::DOUBLE WHEN n1 >= 165 THEN 0.02::DOUBLE WHEN n2 >= 165 THEN 0.04::DOUBLE ELSE 0.08::DOUBLE END AS threshold FROM c)
SELECT l_suppkey, threshold, COUNT(*) AS n, SUM(l_quantity) AS total FROM lineitem JOIN t ON s = l_suppkey WHERE l_discount <= threshold GROUP BY 1, 2
"""


def q94_error_trend(spark, sf):
    """E5: median balance of customers along their key, in bins of 100 keys."""
    t = recalibrate.error_trend(table(spark, sf, "customer"), "c_acctbal", "c_custkey", 100.0)
    return t.select("bin", "x_lo", F.round("median_error", 6).alias("median_error"), "n")


ORACLE["q94_error_trend"] = """
SELECT FLOOR(c_custkey / 100.0::DOUBLE)::BIGINT AS bin, FLOOR(c_custkey / 100.0::DOUBLE) * 100.0::DOUBLE AS x_lo,
  ROUND(MEDIAN(c_acctbal), 6) AS median_error, COUNT(*) AS n FROM customer GROUP BY 1, 2
"""


def q95_split_tables(spark, sf):
    """of the lines with their order's status and price, the table of what is constant in every order."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice")
    j = table(spark, sf, "lineitem").select("l_orderkey", "l_tax", "l_quantity").join(o, on="l_orderkey")
    return scans.split_tables(j, ["l_orderkey"], ["l_tax", "o_orderstatus", "o_totalprice"])[0]


ORACLE["q95_split_tables"] = """
SELECT DISTINCT l_orderkey, o_orderstatus, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def q96_scan_list(spark, sf):
    """orders as scans, those of status F being level 1."""
    o = table(spark, sf, "orders").withColumn("ms_level", F.when(F.col("o_orderstatus") == "F", 1).otherwise(2))
    return scans.scan_list(o, 1, ["o_orderkey", "o_totalprice"])


ORACLE["q96_scan_list"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'"


def q97_spectra_shift(spark, sf):
    """E4 on spectra: prices of an order's lines as peaks, shifted by the order status' key in ppm (none for O)."""
    pairs = F.array_sort(F.collect_list("l_extendedprice"))
    sp = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(pairs.alias("mz"))
    sp = sp.join(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("precursor_mz")), on="o_orderkey")
    fit = sp.select("o_orderstatus").distinct().where("o_orderstatus <> 'O'").withColumn("shift", F.ascii("o_orderstatus").cast("double"))
    out = recalibrate.apply_shift_to_spectra(sp, fit, ["o_orderstatus"])
    return out.select("o_orderkey", F.round("precursor_mz", 4).alias("precursor_mz"),
                      F.round(F.aggregate("mz", F.lit(0.0), lambda a, x: a + x), 3).alias("sum_mz"))


ORACLE["q97_spectra_shift"] = """
SELECT o_orderkey, ROUND(o_totalprice * (1 - f), 4) AS precursor_mz, ROUND(SUM(l_extendedprice * (1 - f)), 3) AS sum_mz
FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN 0.0::DOUBLE ELSE ascii(o_orderstatus) * 1e-6::DOUBLE END AS f FROM orders)
JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice, f
"""


def q98_sparse_prior_cover(spark, sf):
    """H7: parts explained by suppliers, those of the nations 0 and 1 being the prior set: parts they reach keep all their prior suppliers; the greedy
    covers the rest (438 of 2,000 parts at sf0.01, 1,832 of 20,000 at sf0.1) with the others."""
    e = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    prior = table(spark, sf, "supplier").where("s_nationkey < 2").select(F.col("s_suppkey").alias("accession"))
    return inference.infer_parsimony(e, "l_partkey", "l_suppkey", prior, "accession", refine_prior=False, share=1)


ORACLE["q98_sparse_prior_cover"] = """
WITH RECURSIVE a AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
pr AS (SELECT a.* FROM a JOIN supplier ON s_suppkey = s WHERE s_nationkey < 2),
e AS (SELECT a.* FROM a WHERE p NOT IN (SELECT p FROM pr)),
tot AS (SELECT s, COUNT(*) AS n FROM e GROUP BY s),
g(step, chosen) AS (
  SELECT 0, []::BIGINT[]
  UNION ALL
  SELECT step + 1, list_append(chosen, pick) FROM (
    SELECT g.step, g.chosen,
      (SELECT c.s FROM (SELECT e.s, COUNT(*) AS left_over FROM e
                        WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.p = e.p AND list_contains(g.chosen, x.s))
                        GROUP BY e.s) c JOIN tot USING (s)
       ORDER BY c.left_over DESC, tot.n DESC, c.s LIMIT 1) AS pick
    FROM g) q WHERE pick IS NOT NULL),
o AS (SELECT unnest(chosen) AS s, unnest(range(1, len(chosen) + 1)) AS i FROM (SELECT chosen FROM g ORDER BY step DESC LIMIT 1))
SELECT p AS l_partkey, s AS l_suppkey FROM pr
UNION ALL SELECT e.p, arg_min(o.s, o.i) FROM e JOIN o ON o.s = e.s GROUP BY e.p
"""


def q99_psm_round_trip_all(spark, sf):
    """A5: all lines as identification tables, read back with a row a protein and decoys flagged."""
    at = _folder(spark, "psm")
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ScanNum"), F.col("l_linenumber").alias("Charge"), F.concat(F.lit("P"), "l_returnflag").alias("Peptide"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string"), F.lit("(pre=K,post=R);XXX_A"), F.col("l_partkey").cast("string")).alias("Protein"),
        F.col("l_extendedprice").alias("PrecursorMZ"), F.col("l_quantity").alias("MSGFScore"), F.col("l_discount").alias("SpecEValue"))
    writers.write_tsv(li, at)
    return readers.read_psms(spark, at, ".csv").select("scan", "charge", "peptide", "protein", "precursor_mz", "score", "spec_evalue", "is_decoy")


ORACLE["q99_psm_round_trip_all"] = """
SELECT l_orderkey AS scan, l_linenumber AS charge, 'P' || l_returnflag AS peptide, p AS protein, l_extendedprice AS precursor_mz,
  l_quantity AS score, l_discount AS spec_evalue, starts_with(p, 'XXX_') AS is_decoy
FROM (SELECT *, unnest(['A' || l_suppkey, 'XXX_A' || l_partkey]) AS p FROM lineitem)
"""


def q100_modified_fragments_all(spark, sf):
    """D5 + D8: b and y ions at charge 1 and 2, summed per form, of the names of all parts with up to three 'a' (16) or 'e' (1) modified."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name")).withColumn("mass", F.lit(0.0))
    f = search.expand_mods(p, "p_name", [("a", 16.0), ("e", 1.0)]).withColumn("form", F.array_join("sites", ","))
    x = search.theoretical_fragments(f, "p_name", CHAR_MASS, ["p_partkey", "form"], "sites", "site_deltas", (1, 2))
    return x.groupBy("p_partkey", "form", "charge").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("b_ion"), 3).alias("b"), F.round(F.sum("y_ion"), 3).alias("y"))


ORACLE["q100_modified_fragments_all"] = """
WITH p AS (SELECT p_partkey, p_name, length(p_name) AS n FROM part),
e AS (SELECT p_partkey, i, CASE WHEN substr(p_name, i, 1) = 'a' THEN 16.0::DOUBLE ELSE 1.0::DOUBLE END AS d
      FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM p) WHERE substr(p_name, i, 1) IN ('a', 'e')),
f AS (SELECT *, []::BIGINT[] AS sites, []::DOUBLE[] AS ds FROM p
      UNION ALL SELECT p.*, [a.i], [a.d] FROM p JOIN e a USING (p_partkey)
      UNION ALL SELECT p.*, [a.i, b.i], [a.d, b.d] FROM p JOIN e a USING (p_partkey) JOIN e b USING (p_partkey) WHERE a.i < b.i
      UNION ALL SELECT p.*, [a.i, b.i, c.i], [a.d, b.d, c.d] FROM p JOIN e a USING (p_partkey) JOIN e b USING (p_partkey)
        JOIN e c USING (p_partkey) WHERE a.i < b.i AND b.i < c.i),
x AS (SELECT *, unnest(range(1, n)) AS pos FROM f),
m AS (SELECT *, list_sum(list_transform(string_split(substr(p_name, 1, pos), ''), lambda c: ascii(c)::DOUBLE))
               + COALESCE(list_sum(ds[1:len(list_filter(sites, lambda i: i <= pos))]), 0) AS pre,
             list_sum(list_transform(string_split(p_name, ''), lambda c: ascii(c)::DOUBLE)) + COALESCE(list_sum(ds), 0) AS tot FROM x)
SELECT p_partkey, array_to_string(sites, ',') AS form, z AS charge, COUNT(*) AS n,
  ROUND(SUM(pre / z + 1.007276466812::DOUBLE), 3) AS b, ROUND(SUM((tot - pre + 18.010564684::DOUBLE) / z + 1.007276466812::DOUBLE), 3) AS y
FROM m, (VALUES (1), (2)) v(z) GROUP BY ALL
"""


QUERIES = {k: v for k, v in sorted(globals().items()) if k[:1] == "q" and k[1:3].isdigit() and callable(v)}
