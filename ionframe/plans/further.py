"""Registered queries of whole jobs and of operators that files feed, on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats
from ..functions.constants import PROTON, WATER
from ..operators import confidence, hits, inference, recalibrate, runs, scans, search
from ..session import scratch_path as _folder
from ..sources import readers, writers
from .oracle import cover_sql
from .queries import CHAR_MASS, DIGEST_RULE
from .tables import spread, table

ORACLE: dict[str, str] = {}


def q101_protein_groups(spark, sf):
    """H5, §4.5 first collapse: orders as proteins, their parts as peptides; orders of the same parts are one group, and
    orders whose parts another order has too are contained in it."""
    e = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    return inference.protein_groups(e, "l_partkey", "l_orderkey")


_GROUPS = """e AS (SELECT DISTINCT l_partkey AS p, l_orderkey AS s FROM lineitem),
sets AS (SELECT s, list(p ORDER BY p) AS ps, COUNT(*) AS n FROM e GROUP BY s),
g AS (SELECT ps, MIN(s) AS group_id, any_value(n) AS n, COUNT(*) AS members FROM sets GROUP BY ps),
re AS (SELECT e.p, g.group_id AS s, g.n FROM g JOIN e ON e.s = g.group_id),
c AS (SELECT a.s, b.s AS b, b.n FROM re a JOIN re b ON a.p = b.p AND b.n > a.n GROUP BY a.s, a.n, b.s, b.n HAVING COUNT(*) = a.n),
w AS (SELECT s, MIN({'m': -n, 'b': b}).b AS contained_in FROM c GROUP BY s)"""

ORACLE["q101_protein_groups"] = f"""
WITH {_GROUPS}
SELECT sets.s AS l_orderkey, g.group_id, sets.n AS n_peptides, w.contained_in
FROM sets JOIN g USING (ps) LEFT JOIN w ON w.s = g.group_id
"""


def q102_collapsed_cover(spark, sf):
    """H5 on groups: parts explained by orders, after equal orders are one and contained ones left out."""
    e = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    return inference.collapsed_cover(e, "l_partkey", "l_orderkey")


ORACLE["q102_collapsed_cover"] = f"""
WITH RECURSIVE {_GROUPS},
kept AS (SELECT re.p, re.s FROM re WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.s = re.s)),{cover_sql("kept")}
SELECT cover.p AS l_partkey, cover.s AS l_orderkey, g.members FROM cover JOIN g ON g.group_id = cover.s
"""


def q103_refined_prior(spark, sf):
    """H7 with refine_prior: parts explained by suppliers; those of the nations 0 and 1 cover the parts that they reach, the others the rest."""
    e = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    prior = table(spark, sf, "supplier").where("s_nationkey < 2").select(F.col("s_suppkey").alias("accession"))
    return inference.infer_parsimony(e, "l_partkey", "l_suppkey", prior, "accession")


def _named_cover(edges: str, name: str) -> str:
    return cover_sql(edges).replace("rounds(", f"{name}_rounds(").replace("FROM rounds", f"FROM {name}_rounds").replace("cover AS", f"{name} AS")


ORACLE["q103_refined_prior"] = f"""
WITH RECURSIVE a AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
pr AS (SELECT a.* FROM a JOIN supplier ON s_suppkey = s WHERE s_nationkey < 2),
rest AS (SELECT a.* FROM a WHERE p NOT IN (SELECT p FROM pr)),{_named_cover("pr", "first")},{_named_cover("rest", "second")}
SELECT p AS l_partkey, s AS l_suppkey FROM first UNION ALL SELECT p, s FROM second
"""


def q104_search_spectra(spark, sf):
    """D6 + D8 + D9 + D10: every part's name and key is a peptide (masses: character codes). Its spectrum has the b ions, a little off
    by key, brighter from ion to ion, and its own mass at charge 2 as precursor; the three best peptides of each, from the peaks."""
    seq = F.concat(F.col("p_name"), F.col("p_partkey").cast("string"))
    pep = search.peptide_mass(spread(table(spark, sf, "part").select("p_partkey", seq.alias("peptide"))), "peptide", CHAR_MASS)
    spectra = pep.select(F.col("p_partkey").alias("scan"), (F.col("mass") / 2 + PROTON).alias("precursor_mz"), F.lit(2).alias("charge"))
    ions = search.theoretical_fragments(pep, "peptide", CHAR_MASS, ["p_partkey"])
    peaks = ions.select(F.col("p_partkey").alias("scan"), (F.col("b_ion") + (F.col("p_partkey") % 7) * 0.001).alias("mz"), (F.col("pos") * 10.0).alias("intensity"))
    got = search.search_spectra(spectra, peaks, pep, ["scan"], ["p_partkey"], "peptide", CHAR_MASS, 3, frag_tol=0.02)
    return got.select("scan", "p_partkey", "n_matched", F.round("matched_intensity", 3).alias("matched_intensity"), F.round("hyperscore", 6).alias("hyperscore"), "rn")


ORACLE["q104_search_spectra"] = f"""
WITH pep AS (SELECT p_partkey, string_split(p_name || p_partkey, '') AS cs FROM part),
c AS (SELECT p_partkey, unnest(range(1, len(cs) + 1)) AS pos, ascii(unnest(cs))::DOUBLE AS m FROM pep),
l AS (SELECT p_partkey, pos, SUM(m) OVER (PARTITION BY p_partkey ORDER BY pos) AS pre, SUM(m) OVER (PARTITION BY p_partkey) AS tot FROM c),
f AS (SELECT p_partkey, pos, tot, pre + {PROTON!r}::DOUBLE AS b, tot - pre + {WATER + PROTON!r}::DOUBLE AS y FROM l WHERE pre < tot),
frag AS (SELECT p_partkey, tot, b AS mz FROM f UNION ALL SELECT p_partkey, tot, y FROM f),
mass AS (SELECT DISTINCT p_partkey, tot + {WATER!r}::DOUBLE AS mass FROM f),
pairs AS (SELECT s.p_partkey AS scan, x.p_partkey FROM mass s JOIN mass x ON abs(s.mass - x.mass) <= x.mass * 20 / 1e6::DOUBLE),
h AS (SELECT scan, pairs.p_partkey, COUNT(*) AS n_matched, SUM(k.pos * 10.0::DOUBLE) AS mi
      FROM pairs JOIN f k ON k.p_partkey = pairs.scan JOIN frag ON frag.p_partkey = pairs.p_partkey
        AND abs(k.b + (scan % 7) * 0.001::DOUBLE - frag.mz) <= 0.02::DOUBLE GROUP BY 1, 2),
r AS (SELECT *, list_sum(list_transform(range(1, n_matched + 1), lambda i: log10(i))) + log10(mi) AS hs FROM h)
SELECT scan, p_partkey, n_matched, ROUND(mi, 3) AS matched_intensity, ROUND(hs, 6) AS hyperscore,
       row_number() OVER (PARTITION BY scan ORDER BY hs DESC, p_partkey) AS rn FROM r
QUALIFY rn <= 3
"""


def q105_mzml_round_trip(spark, sf):
    """A4: every user's events as a spectrum (event id as m/z, value as intensity), written as mzML with 64-bit compressed arrays and
    with 32-bit plain ones, and read back: peaks, intensities and the range of m/z."""
    ev = table(spark, sf, "events").where("value is not null")
    peaks = F.array_sort(F.collect_list(F.struct(F.col("event_id").cast("double").alias("x"), F.col("value").cast("double").alias("y"))))
    s = ev.groupBy(F.col("user_id").alias("scan")).agg(peaks.alias("p")).select(
        "scan", (F.col("scan") % 2 + 1).alias("ms_level"), (F.col("scan") / 8).alias("rt"), F.when(F.col("scan") % 2 == 1, F.col("scan") + 0.5).alias("precursor_mz"),
        F.when(F.col("scan") % 3 == 0, F.lit(2)).alias("charge"), F.col("p.x").alias("mz"), F.col("p.y").alias("intensity"))
    out = None
    for bits, zipped in ((64, True), (32, False)):
        at = _folder(spark, "mzml")
        writers.write_mzml(s, at, bits, zipped)
        back = readers.read_mzml(spark, at)
        total = F.aggregate("intensity", F.lit(0.0), lambda a, v: a + v)
        r = back.select(F.lit(bits).alias("bits"), "scan", "ms_level", "rt", "precursor_mz", "charge", F.size("mz").cast("long").alias("n"),
                        F.round(total, 3).alias("total"), F.array_min("mz").alias("low"), F.array_max("mz").alias("high"))
        out = r if out is None else out.unionByName(r)
    return out


ORACLE["q105_mzml_round_trip"] = """
SELECT bits, user_id AS scan, (user_id % 2 + 1)::INTEGER AS ms_level, user_id / 8.0::DOUBLE AS rt, CASE WHEN user_id % 2 = 1 THEN user_id + 0.5::DOUBLE END AS precursor_mz,
       CASE WHEN user_id % 2 = 1 AND user_id % 3 = 0 THEN 2 END AS charge, COUNT(*) AS n,
       ROUND(SUM(CASE bits WHEN 64 THEN value::DOUBLE ELSE value::FLOAT::DOUBLE END), 3) AS total, MIN(CASE bits WHEN 64 THEN event_id::DOUBLE ELSE event_id::FLOAT::DOUBLE END) AS low,
       MAX(CASE bits WHEN 64 THEN event_id::DOUBLE ELSE event_id::FLOAT::DOUBLE END) AS high
FROM events, (VALUES (64), (32)) v(bits) WHERE value IS NOT NULL GROUP BY bits, user_id
"""


def q106_result_files(spark, sf):
    """B3 + A1 + A11: quantities by part and line status and their ratio as the two result files and the long table,
    read back; the ratio file's parts are the prior of a later run."""
    li = table(spark, sf, "lineitem")
    long = li.groupBy(F.col("l_partkey").alias("protein_id"), F.col("l_linestatus").alias("PlexID")).agg(F.sum("l_quantity").cast("double").alias("q"))
    rii = long.groupBy("protein_id").pivot("PlexID", ["F", "O"]).agg(F.first("q"))
    ratio = rii.select("protein_id", F.round(F.col("F") / F.col("O"), 6).alias("ratio")).where("ratio > 1")
    paths = writers.write_crosstabs(rii, ratio, _folder(spark, "results"), writers.result_prefix("ph", "run"), long)
    a = readers.read_tsv(spark, paths["rii"], "protein_id long, F double, O double", ["protein_id"])
    b = readers.read_tsv(spark, paths["ratio"], "protein_id long, ratio double")
    prior = readers.read_prior(spark, paths["ratio"]).select(F.col("accession").cast("long").alias("protein_id"), F.lit(True).alias("in_prior"))
    n = spark.read.parquet(paths["long"]).groupBy("protein_id").agg(F.count_distinct("PlexID").alias("n"))
    return (a.join(b, on="protein_id", how="left").join(prior, on="protein_id", how="left").join(n, on="protein_id")
            .withColumn("in_prior", F.coalesce("in_prior", F.lit(False))))


ORACLE["q106_result_files"] = """
WITH a AS (SELECT l_partkey AS protein_id, SUM(l_quantity) FILTER (l_linestatus = 'F')::DOUBLE AS F, SUM(l_quantity) FILTER (l_linestatus = 'O')::DOUBLE AS O,
                  COUNT(DISTINCT l_linestatus) AS n FROM lineitem GROUP BY 1)
SELECT protein_id, F, O, CASE WHEN ROUND(F / O, 6) > 1 THEN ROUND(F / O, 6) END AS ratio, n, COALESCE(ROUND(F / O, 6) > 1, false) AS in_prior FROM a
"""


def q107_design_files(spark, sf):
    """A12 + A9: suppliers as samples of their nation's plex, the nations' references and the parts' fractions, written as a
    design folder and as manifests, and read back."""
    at = _folder(spark, "design")
    sup = table(spark, sf, "supplier")
    plex = F.concat(F.lit("S"), F.col("s_nationkey").cast("string"))
    writers.write_tsv(sup.select(plex.alias("PlexID"), F.lit(1).alias("QuantBlock"), F.col("s_suppkey").cast("string").alias("ReporterName"),
                                 F.col("s_name").alias("ReporterAlias"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("MeasurementName")), f"{at}/samples.txt")
    writers.write_tsv(sup.select(plex.alias("PlexID")).distinct().select("PlexID", F.lit(1).alias("QuantBlock"), F.concat("PlexID", F.lit("_ref")).alias("Reference")), f"{at}/references.txt")
    part = table(spark, sf, "part")
    writers.write_tsv(part.select(F.col("p_partkey").cast("string").alias("Dataset"), F.concat(F.lit("S"), (F.col("p_partkey") % 25).cast("string")).alias("PlexID")), f"{at}/fractions.txt")
    d = readers.read_design(spark, at)
    n = d["fractions"].groupBy("PlexID").agg(F.count_distinct("Dataset").alias("n_fractions"))
    part.select(F.col("p_partkey").alias("file_name")).coalesce(1).write.option("header", "true").option("sep", "\t").csv(f"{at}/m/raw_metadata_file")
    listed = readers.read_manifests(spark, f"{at}/m", "part-.*csv").groupBy("PlexID").agg(F.count(F.lit(1)).alias("n")).first()
    return (d["samples"].join(d["references"], on=["PlexID", "QuantBlock"]).join(n, on="PlexID", how="left")
            .withColumn("first_manifest", F.lit(f"{listed['PlexID']}:{listed['n']}")))


ORACLE["q107_design_files"] = """
WITH f AS (SELECT 'S' || (p_partkey % 25) AS PlexID, COUNT(*) AS n_fractions FROM part GROUP BY 1)
SELECT 'S' || s_nationkey AS PlexID, 1::INTEGER AS QuantBlock, s_suppkey::VARCHAR AS ReporterName, s_name AS ReporterAlias, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS MeasurementName,
       'S' || s_nationkey || '_ref' AS Reference, n_fractions, 'S1:' || (SELECT COUNT(*) FROM part) AS first_manifest
FROM supplier LEFT JOIN f ON f.PlexID = 'S' || s_nationkey
"""


def q108_modification_files(spark, sf):
    """A6 + A10: parts as modification definitions, as mass tags and as a MaxQuant table, written and read back."""
    p = table(spark, sf, "part")
    at = _folder(spark, "mods")
    plain = {"sep": "\t", "header": "false"}
    p.select(F.substring("p_name", 1, 1), F.col("p_retailprice").cast("double"), "p_brand", "p_type", F.concat(F.col("p_partkey").cast("string"), F.lit("  "))).write.options(**plain).csv(f"{at}/defs")
    p.select(F.col("p_partkey").cast("string"), F.when(F.col("p_size") > 5, F.col("p_retailprice").cast("double")), "p_brand").write.options(**plain).csv(f"{at}/tags")
    writers.write_tsv(p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("Gene names"), F.col("p_retailprice").cast("double").alias("Intensity")), f"{at}/txt/proteinGroups.txt")
    defs = readers.read_mod_defs(spark, f"{at}/defs").select(F.col("tag").cast("long").alias("p_partkey"), "symbol", F.col("mass").alias("def_mass"), "residue", "mod_type")
    tags = readers.read_mass_tags(spark, f"{at}/tags").select(F.col("tag").cast("long").alias("p_partkey"), F.col("mass").alias("tag_mass"), "element")
    mq = readers.read_maxquant(spark, f"{at}/txt", "proteinGroups")
    kinds = ",".join(t for _, t in mq.dtypes)
    mq = mq.select(F.col("id").cast("long").alias("p_partkey"), F.col("Gene names").alias("genes"), F.col("Intensity").alias("lfq"), F.lit(kinds).alias("kinds"))
    return defs.join(tags, on="p_partkey", how="left").join(mq, on="p_partkey")


ORACLE["q108_modification_files"] = """
SELECT p_partkey, substr(p_name, 1, 1) AS symbol, p_retailprice::DOUBLE AS def_mass, p_brand AS residue, p_type AS mod_type,
       CASE WHEN p_size > 5 THEN p_retailprice::DOUBLE END AS tag_mass, CASE WHEN p_size > 5 THEN p_brand END AS element,
       p_name AS genes, p_retailprice::DOUBLE AS lfq, 'int,string,double' AS kinds FROM part
"""


def q109_run_metadata(spark, sf):
    """A7 + J2: suppliers as workflow runs, one JSON file each; read back with their durations."""
    at = _folder(spark, "runs")
    start = F.timestamp_seconds(F.col("s_suppkey") * 3600)
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("id"), start.alias("start"),
                                            (start + F.make_dt_interval(mins=F.col("s_nationkey").cast("int"))).alias("end"), F.when(F.col("s_suppkey") % 4 > 0, F.lit("Succeeded")).alias("status"))
    # a record of text a file: a folder a run costs far more than its file
    text = F.concat_ws("\n", F.collect_list(F.to_json(F.struct("id", "start", "end", "status"))))
    spread(s, "k").groupBy("k").agg(text.alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(at)
    meta = runs.read_run_metadata(spark, at)
    files = meta.groupBy("id").agg(F.count_distinct("source_file").alias("n_files"), F.max("status").alias("status"))
    return runs.run_durations(meta).select("id", "duration_s").join(files, on="id")


ORACLE["q109_run_metadata"] = """
SELECT s_name AS id, s_nationkey * 60.0::DOUBLE AS duration_s, 1::BIGINT AS n_files, CASE WHEN s_suppkey % 4 > 0 THEN 'Succeeded' END AS status FROM supplier
"""


def q110_manifest_file(spark, sf):
    """J1 + B4: part names as one file a size; their MD5 written as a manifest and read back."""
    at = _folder(spark, "hashed")
    p = table(spark, sf, "part").select("p_size", "p_partkey", F.col("p_name").alias("value"))
    p.repartition("p_size").sortWithinPartitions("p_size", "p_partkey").drop("p_partkey").write.partitionBy("p_size").text(at)
    m = runs.file_manifest(spark, at, "part-*")
    writers.write_manifest(m, f"{at}-manifest")
    back = spark.read.option("header", "true").csv(f"{at}-manifest")
    return back.select(F.regexp_extract("file_name", "p_size=([0-9]+)", 1).cast("int").alias("p_size"), "md5")


ORACLE["q110_manifest_file"] = "SELECT p_size::INTEGER AS p_size, md5(string_agg(p_name || chr(10), '' ORDER BY p_partkey)) AS md5 FROM part GROUP BY p_size"


def q111_filtered_peaks(spark, sf):
    """D7 + F18: users with 5 events at least as spectra, and of these the 3 highest values of 100 and more (equal ones by event)."""
    ev = table(spark, sf, "events").where("value is not null")
    spectra = ev.groupBy("user_id").agg(F.collect_list("event_id").alias("mz"))
    kept = search.filter_min_peaks(spectra, 5).select("user_id", F.size("mz").cast("long").alias("n_peaks"))
    peaks = ev.select("user_id", F.col("event_id").alias("mz"), F.col("value").alias("intensity"), (F.col("value") / 100).alias("sn"))
    return scans.top_ions(peaks, ["user_id"], "intensity", n=3).join(kept, on="user_id").select("user_id", "mz", "intensity", "n_peaks", "rn")


ORACLE["q111_filtered_peaks"] = """
WITH n AS (SELECT user_id, COUNT(*) AS n_peaks FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5),
r AS (SELECT user_id, event_id AS mz, value AS intensity, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events WHERE value / 100 >= 1)
SELECT user_id, mz, intensity, n_peaks, rn FROM r JOIN n USING (user_id) WHERE rn <= 3
"""


def q112_map_peptides(spark, sf):
    """The pieces of benchmark passages (cut after 'e' or 'o' unless a blank follows, 4 to 12 long) among those of all documents, by an equi-join."""
    pieces = search.digest(table(spark, sf, "benchmark").select("item_id", "text"), ["item_id"], "text", DIGEST_RULE, 4, 12, 1)
    docs = search.digest(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"], "text", DIGEST_RULE, 4, 12, 1)
    return hits.map_peptides(pieces, docs).select("peptide", "doc_id", "start", "missed_cleavages")


def _pieces(table_name: str, key: str, text: str) -> str:
    cut = "regexp_replace(regexp_replace({t}, '([eo])([^ \\x01])', '\\1' || chr(1) || '\\2', 'g'), '([eo])([^ \\x01])', '\\1' || chr(1) || '\\2', 'g')".format(t=text)
    return f"""(SELECT k, start, j AS missed_cleavages, CASE j WHEN 0 THEN a ELSE a || b END AS peptide FROM (
  SELECT k, a, b, (SUM(length(a)) OVER (PARTITION BY k ORDER BY i) - length(a) + 1)::INTEGER AS start, unnest(CASE WHEN b IS NULL THEN [0] ELSE [0, 1] END) AS j FROM (
    SELECT k, i, a, lead(a) OVER (PARTITION BY k ORDER BY i) AS b FROM (
      SELECT k, unnest(p) AS a, unnest(range(len(p))) AS i FROM (SELECT {key} AS k, list_filter(string_split({cut}, chr(1)), lambda x: x <> '') AS p FROM {table_name}))))
  WHERE length(CASE j WHEN 0 THEN a ELSE a || b END) BETWEEN 4 AND 12)"""


ORACLE["q112_map_peptides"] = f"""
SELECT d.peptide, d.k AS doc_id, d.start, d.missed_cleavages::INTEGER AS missed_cleavages FROM {_pieces("documents", "doc_id", "text")} d
WHERE d.peptide IN (SELECT peptide FROM {_pieces("benchmark", "item_id", "text")})
"""


def q113_shift_along(spark, sf):
    """E3 + E4 along an axis: customer keys as errors, along the balance, per nation; knots from the BUILDING customers' bins of 250
    that have 2 or more, the nation's median from 20 rows on. All customers are shifted."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").cast("double").alias("bal"), "c_mktsegment",
                                            (F.col("c_custkey") % 1000).cast("double").alias("err"))
    fit = recalibrate.fit_trend(c.where("c_mktsegment = 'BUILDING'"), ["c_nationkey"], "err", "bal", 250.0, 2, 20)
    out = recalibrate.apply_trend(c, fit, ["c_nationkey"], "bal", "err", 250.0, "corrected")
    return out.select("c_custkey", F.round("shift", 6).alias("shift"), "shift_level", F.round("corrected", 6).alias("corrected"))


ORACLE["q113_shift_along"] = """
WITH c AS (SELECT c_custkey, c_nationkey AS g, c_acctbal::DOUBLE AS x, c_mktsegment AS m, (c_custkey % 1000)::DOUBLE AS err FROM customer),
k AS (SELECT g, (floor(x / 250.0::DOUBLE) + 0.5::DOUBLE) * 250.0::DOUBLE AS kx, MEDIAN(err) AS y FROM c WHERE m = 'BUILDING' GROUP BY 1, 2 HAVING COUNT(*) >= 2),
w AS (SELECT g, MEDIAN(err) AS y FROM c WHERE m = 'BUILDING' GROUP BY 1 HAVING COUNT(*) >= 20),
n AS (SELECT c.c_custkey, c.g, c.x, c.err, MAX(CASE WHEN k.kx <= c.x THEN {'x': k.kx, 'y': k.y} END) AS a, MIN(CASE WHEN k.kx > c.x THEN {'x': k.kx, 'y': k.y} END) AS b
      FROM c LEFT JOIN k ON k.g = c.g GROUP BY ALL),
s AS (SELECT n.*, CASE WHEN a IS NULL THEN b.y WHEN b IS NULL THEN a.y ELSE a.y + (b.y - a.y) * (x - a.x) / (b.x - a.x) END AS own, w.y AS whole FROM n LEFT JOIN w ON w.g = n.g)
SELECT c_custkey, ROUND(COALESCE(own, whole), 6) AS shift, CASE WHEN own IS NOT NULL THEN 'bin' WHEN whole IS NOT NULL THEN 'group' ELSE 'none' END AS shift_level,
       ROUND(err - COALESCE(own, whole, 0), 6) AS corrected FROM s
"""


def q114_error_probability(spark, sf):
    """G1, H3: lines as matches, the ship day (from 1992) as score, decoys by key and more often on early days, per return flag: the
    probability that a match of a day is wrong, from the isotonic regression of the decoy share."""
    psm = table(spark, sf, "lineitem").select("l_returnflag", F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("day"),
                                              ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 2600).alias("at"))
    p = confidence.error_probability(psm, "day", F.col("at") > F.col("day"), ["l_returnflag"])
    return p.select("l_returnflag", "day", "n_target", "n_decoy", F.round("decoy_share", 9).alias("decoy_share"), F.round("error_probability", 9).alias("error_probability"))


def _isotonic(name: str, rows: str, group: str, best_first: str) -> str:
    """CTEs of the fit as the largest over the starts up to a point of the smallest mean over the ends from it on; ``rows`` has y (sum) and w (weight)."""
    return f"""{name}_c AS (SELECT *, row_number() OVER v AS i, SUM(y) OVER v AS cy, SUM(w) OVER v AS cw FROM {rows} WINDOW v AS (PARTITION BY {group} ORDER BY {best_first})),
{name}_g AS (SELECT a.{group}, b.i, MIN((b.cy - a.cy + a.y)::DOUBLE / (b.cw - a.cw + a.w)::DOUBLE) OVER (PARTITION BY a.{group}, a.i ORDER BY b.i DESC ROWS UNBOUNDED PRECEDING) AS m
  FROM {name}_c a JOIN {name}_c b ON a.{group} = b.{group} AND b.i >= a.i),
{name}_f AS (SELECT {group}, i, MAX(m) AS share FROM {name}_g GROUP BY 1, 2),
{name} AS (SELECT c.*, share, CASE WHEN share < 0.5 THEN share / (1 - share) ELSE 1.0 END::DOUBLE AS pep FROM {name}_c c JOIN {name}_f f ON f.{group} = c.{group} AND f.i = c.i)"""


ORACLE["q114_error_probability"] = f"""
WITH m AS (SELECT l_returnflag, datediff('day', DATE '1992-01-01', l_shipdate::DATE) AS day, (l_orderkey * 7 + l_linenumber * 13) % 2600 AS place FROM lineitem),
s AS (SELECT l_returnflag, day::INTEGER AS day, COUNT(*) FILTER (WHERE place <= day) AS n_target, COUNT(*) FILTER (WHERE place > day) AS y, COUNT(*) AS w FROM m GROUP BY ALL),
{_isotonic("fit", "s", "l_returnflag", "day DESC")}
SELECT l_returnflag, day, n_target, y AS n_decoy, ROUND(share, 9) AS decoy_share, ROUND(pep, 9) AS error_probability FROM fit
"""


def q115_protein_competition(spark, sf):
    """H3 at protein level: parts as proteins, returned lines as matches of their decoys, the price as score; of a part and its
    decoy the better stays, with q-value and error probability."""
    decoy = F.col("l_returnflag") == "R"
    hits_ = table(spark, sf, "lineitem").select(F.concat(F.when(decoy, "XXX_").otherwise(""), F.lit("P"), F.col("l_partkey")).alias("accession"),
                                                F.col("l_extendedprice").cast("double").alias("score"), decoy.alias("is_decoy"))
    p = confidence.protein_confidence(hits_, "accession", "score", "is_decoy")
    return p.select("accession", "score", "is_decoy", F.round("q_value", 9).alias("q_value"), F.round("error_probability", 9).alias("error_probability"))


ORACLE["q115_protein_competition"] = f"""
WITH b AS (SELECT l_partkey, MAX({{'s': l_extendedprice::DOUBLE, 'd': l_returnflag = 'R'}}) AS best FROM lineitem GROUP BY 1),
p AS (SELECT CASE WHEN best.d THEN 'XXX_P' ELSE 'P' END || l_partkey AS accession, best.s AS score, best.d AS is_decoy FROM b),
s AS (SELECT 1 AS one, score, COUNT(*) FILTER (WHERE NOT is_decoy) AS nt, COUNT(*) FILTER (WHERE is_decoy) AS y, COUNT(*) AS w FROM p GROUP BY score),
r AS (SELECT score, SUM(y) OVER v::DOUBLE / GREATEST(SUM(nt) OVER v, 1)::DOUBLE AS fdr FROM s WINDOW v AS (ORDER BY score DESC)),
q AS (SELECT score, MIN(fdr) OVER (ORDER BY score) AS q_value FROM r),
{_isotonic("fit", "s", "one", "score DESC")}
SELECT accession, p.score, is_decoy, ROUND(q_value, 9) AS q_value, ROUND(pep, 9) AS error_probability FROM p JOIN q USING (score) JOIN fit ON fit.score = p.score
"""


def q116_find_peaks(spark, sf):
    """all peaks of every user's trace of values over time, told apart by valleys below half the lower apex, with area and signal to noise."""
    ev = table(spark, sf, "events").select("user_id", (stats.epoch_micros(F.col("ts")) / 1e6).alias("t"), "value")
    p = scans.find_peaks(ev, ["user_id"], "t", "value")
    return p.select("user_id", "peak", *[F.round(c, 3).alias(c) for c in ("apex_x", "left_x", "right_x")], F.col("apex_y"), F.round("area", 1).alias("area"), "n_points",
                    F.round("sn", 6).alias("sn"))


ORACLE["q116_find_peaks"] = """
WITH e AS (SELECT user_id AS u, epoch_us(ts) / 1e6::DOUBLE AS t, MAX(GREATEST(value, 0.0))::DOUBLE AS y FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
h AS (SELECT a.u, a.t, a.y, MIN(CASE WHEN b.t > a.t AND b.y >= a.y THEN b.t END) AS r, MAX(CASE WHEN b.t < a.t AND b.y > a.y THEN b.t END) AS l FROM e a JOIN e b USING (u) GROUP BY 1, 2, 3),
d AS (SELECT h.u, h.t, h.y, h.r, h.l, MIN(CASE WHEN b.t BETWEEN h.t AND h.r THEN b.y END) AS rm, MIN(CASE WHEN b.t BETWEEN h.l AND h.t THEN b.y END) AS lm
      FROM h JOIN e b USING (u) GROUP BY ALL),
k AS (SELECT u, t, y, row_number() OVER v AS peak, lead(t) OVER v AS nt FROM d WHERE y > 0 AND (r IS NULL OR rm < 0.5 * y) AND (l IS NULL OR lm < 0.5 * y) WINDOW v AS (PARTITION BY u ORDER BY t)),
w AS (SELECT k.u, k.peak, MIN({'y': e.y, 't': e.t}).t AS v FROM k JOIN e ON e.u = k.u AND e.t BETWEEN k.t AND k.nt GROUP BY 1, 2),
x AS (SELECT u, MIN(t) AS lo, MAX(t) AS hi FROM e GROUP BY 1),
b AS (SELECT k.*, COALESCE(p.v, x.lo) AS left_x, COALESCE(n.v, x.hi) AS right_x FROM k JOIN x USING (u) LEFT JOIN w p ON p.u = k.u AND p.peak = k.peak - 1 LEFT JOIN w n ON n.u = k.u AND n.peak = k.peak),
s AS (SELECT u, t, y, LAG(t) OVER v AS pt, LAG(y) OVER v AS py, percent_rank() OVER (PARTITION BY u ORDER BY y) AS pr FROM e WINDOW v AS (PARTITION BY u ORDER BY t)),
z AS (SELECT u, AVG(y) AS noise FROM s WHERE pr <= 0.75 GROUP BY 1)
SELECT b.u AS user_id, b.peak, ROUND(b.t, 3) AS apex_x, ROUND(left_x, 3) AS left_x, ROUND(right_x, 3) AS right_x, b.y AS apex_y,
  ROUND(COALESCE(SUM((s.t - s.pt) * (s.y + s.py) / 2) FILTER (WHERE s.pt >= left_x), 0.0), 1) AS area, COUNT(*) AS n_points, ROUND(CASE WHEN noise > 0 THEN b.y / noise END, 6) AS sn
FROM b JOIN s ON s.u = b.u AND s.t BETWEEN left_x AND right_x JOIN z ON z.u = b.u GROUP BY b.u, b.peak, b.t, left_x, right_x, b.y, noise
"""


QUERIES = {k: v for k, v in sorted(globals().items()) if k[:1] == "q" and k[1:3].isdigit() and callable(v)}
