"""The registered queries: each library operator exercised on the driver's
tables through its column-name parameters (SURVEY §7.4). Every query reads
whole tables; nothing is sampled or capped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quant
from .tables import spread, table


def q01_ratio_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    """H8 + H11 + H10: feature = supplier, plex = return flag, channel = line
    status, intensity = quantity; the reference channel of every plex is 'F'."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    design = li.select(F.col("l_returnflag").alias("PlexID"),
                       F.col("l_linestatus").alias("ReporterName")).distinct()
    samples = design.withColumn("MeasurementName", F.when(
        F.col("ReporterName") != "F", F.concat_ws("_", "PlexID", "ReporterName")))
    references = design.select("PlexID").distinct().withColumn("Reference", F.lit("F"))
    long = quant.aggregate_intensity(li, ["l_suppkey"], "l_returnflag", "l_linestatus", "l_quantity")
    ratios = quant.eval_reference(long, references, ["l_suppkey"], "l_returnflag", "l_linestatus")
    return quant.ratio_crosstab(ratios, samples, ["l_suppkey"], "l_returnflag", "l_linestatus", digits=6)


QUERIES = {
    "q01_ratio_crosstab": q01_ratio_crosstab,
}


# ---------------------------------------------------------------- H9, H1/H2, H11
from ..operators import design, hits, inference, recalibrate, scans, search, sites  # noqa: E402
from ..operators import ordered  # noqa: E402
from ..operators.rangejoin import Tol, range_join  # noqa: E402
from ..functions import stats  # noqa: E402


def q02_intensity_crosstab(spark, sf):
    """H9: user x event type crosstab of summed values."""
    ev = table(spark, sf, "events")
    long = ev.groupBy("user_id", "event_type").agg(F.round(F.sum("value"), 4).alias("intensity"))
    return quant.crosstab(long, ["user_id"], "event_type", "intensity")  # a column per type in the table


def q03_link_and_design(spark, sf):
    """H1 + H2: matches (orders) linked to quant rows (lineitem) by key, the
    design (customer -> nation) attached; summed per nation and segment."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    od = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    linked = quant.link_quant(od, li, ["l_orderkey"])
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nat = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    d = linked.join(cust, on="o_custkey").join(nat, on="c_nationkey")
    return d.groupBy("n_name", "c_mktsegment").agg(F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
                                                  F.count(F.lit(1)).alias("n_lines"))


def _li_long(spark, sf, plex, channel):
    li = table(spark, sf, "lineitem").select("l_suppkey", plex, channel, "l_quantity")
    return li, quant.aggregate_intensity(li, ["l_suppkey"], plex, channel, "l_quantity")


def q04_reference_constant(spark, sf):
    """H11 with the constant reference 1: log2(intensity / 1)."""
    li, long = _li_long(spark, sf, "l_returnflag", "l_linestatus")
    refs = li.select(F.col("l_returnflag").alias("PlexID")).distinct().withColumn("Reference", F.lit("1"))
    r = quant.eval_reference(long, refs, ["l_suppkey"], "l_returnflag", "l_linestatus")
    return r.select("l_suppkey", "l_returnflag", "l_linestatus", F.round("log2_ratio", 6).alias("log2_ratio"))


def q05_reference_expression(spark, sf):
    """H11 with two references per plex, the expression (A + N) / 2 over return-flag channels
    and the channel R; the mean of those with a value holds."""
    li, long = _li_long(spark, sf, "l_linestatus", "l_returnflag")
    refs = li.select(F.col("l_linestatus").alias("PlexID")).distinct().withColumn("Reference", F.lit("(A + N)/2"))
    two = refs.unionByName(refs.withColumn("Reference", F.lit("R")))
    r = quant.eval_reference(long, two, ["l_suppkey"], "l_linestatus", "l_returnflag")
    return r.select("l_suppkey", "l_linestatus", "l_returnflag",
                    F.round("reference_intensity", 6).alias("reference_intensity"),
                    F.round("log2_ratio", 6).alias("log2_ratio"))


# ---------------------------------------------------------------- range joins
def _unit_prices(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"))


def q06_range_abs(spark, sf):
    """§4.3 (a join in Da): unit prices within 0.003 of a part's retail price."""
    j = range_join(_unit_prices(spark, sf), table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                   [Tol("unit_price", "p_retailprice", 0.003)])
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "p_partkey", "p_retailprice")


def q07_range_ppm(spark, sf):
    """§4.3 (a join in ppm): unit prices within 10 ppm of a part's retail price."""
    j = range_join(_unit_prices(spark, sf), table(spark, sf, "part").select("p_partkey", "p_retailprice"),
                   [Tol("unit_price", "p_retailprice", 10.0, ppm=True)])
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "p_partkey", "p_retailprice")


def q08_interval_2d(spark, sf):
    """events as parent ions vs events as peaks of the same user (the dataset): value within 40 and
    time within 5 days; points per parent (itself included) and their summed value."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "value", (stats.epoch_micros(F.col("ts")) / 1e6).alias("t"))
    peaks = ev.select(F.col("event_id").alias("peak_id"), F.col("user_id").alias("pu"), F.col("value").alias("pv"), F.col("t").alias("pt"))
    parents = ev.select(F.col("event_id").alias("parent_id"), F.col("user_id").alias("qu"), F.col("value").alias("qv"), F.col("t").alias("qt"))
    j = scans.extract_sic(peaks, parents, "pv", "pt", "qv", "qt", ppm=None, da=40.0, rt_window=432000.0, on=[("pu", "qu")])
    return j.groupBy(F.col("parent_id").alias("event_id")).agg(F.count(F.lit(1)).alias("n_points"), F.round(F.sum("pv"), 4).alias("total"))


def q09_top_n(spark, sf):
    """Best two lines per order by price, ties by line number."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return scans.top_n(li, ["l_orderkey"], [F.col("l_extendedprice").desc(), F.col("l_linenumber").asc()], 2)


def q10_target_decoy(spark, sf):
    """Q-values, score = extended price, decoy = return flag R."""
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_returnflag")
    q = search.target_decoy_fdr(li, "l_extendedprice", F.col("l_returnflag") == "R")
    return q.select(F.col("l_extendedprice").alias("score"), "n_target", "n_decoy", "cum_target", "cum_decoy",
                    F.round("fdr", 6).alias("fdr"), F.round("q_value", 6).alias("q_value"))


def q11_by_group(spark, sf):
    """D11 / H3 per group (line status)."""
    li = table(spark, sf, "lineitem").select("l_linestatus", "l_extendedprice", "l_returnflag")
    q = search.target_decoy_fdr(li, "l_extendedprice", F.col("l_returnflag") == "R", by=["l_linestatus"])
    return q.select("l_linestatus", F.col("l_extendedprice").alias("score"), "cum_target", "cum_decoy",
                    F.round("q_value", 6).alias("q_value"))


# ---------------------------------------------------------------- design
def q12_make_unique(spark, sf):
    """Part names made unique in part-key order."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return design.make_unique(p, "p_name", ["p_partkey"], name="unique_name").select("p_partkey", "unique_name")


EXPECTED_TYPES = ["click", "purchase", "refund", "signup", "view"]


def q13_channel_check(spark, sf):
    """Expected event types vs the types seen per user."""
    ev = table(spark, sf, "events").select("user_id", "event_type")
    c = design.check_channels(ev, EXPECTED_TYPES, plex="user_id", channel="event_type")
    return c.select("user_id", F.array_join("shared", ",").alias("shared"),
                    F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


def q14_set_agreement(spark, sf):
    """Nation keys of nation, customer and supplier agree?"""
    return design.check_plex_ids({
        "nation": (table(spark, sf, "nation"), "n_nationkey"),
        "customer": (table(spark, sf, "customer"), "c_nationkey"),
        "supplier": (table(spark, sf, "supplier"), "s_nationkey")})


def _vials(spark, sf):
    """Nations as vials, regions as plexes (sorted region name order), channel
    = nation key; the first nation of each region is labelled 'ref channel'."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    v = n.join(r, on="n_regionkey")
    first = v.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("_first"))
    v = v.join(first, on="n_regionkey")
    label = F.when(F.col("n_nationkey") == F.col("_first"), F.lit("ref channel")).otherwise(
        F.concat(F.col("n_name"), F.lit(" x")))
    return v.select(F.col("r_name").alias("path"), F.col("n_nationkey").cast("string").alias("tmt_channel"),
                    label.alias("vial_label"), "n_nationkey")


def q15_build_design(spark, sf):
    """Stack, normalize labels, unique, samples, references."""
    v = design.stack_vials(_vials(spark, sf), "path")
    v = design.normalize_labels(v)
    v = design.make_unique(v, "vial_label", ["n_nationkey"], bounded=True)
    smp = design.build_samples(v, "tmt_channel")
    refs = design.build_references(smp)
    return smp.join(refs, on=["PlexID", "QuantBlock"], how="left")


def q16_combine(spark, sf):
    """Customer and supplier designs stacked as passes 1A / 1C."""
    def d(t, key, nk):
        x = table(spark, sf, t).join(table(spark, sf, "nation").select(
            F.col("n_nationkey").alias(nk), "n_name"), on=nk)
        return x.select(F.concat(F.lit("S"), F.col(nk).cast("string")).alias("PlexID"),
                        F.col("n_name").alias("ReporterAlias"), F.col("n_name").alias("MeasurementName"),
                        F.concat(F.lit("(Ref_S"), F.col(nk).cast("string"), F.lit(" + "), F.col("n_name"),
                                 F.lit(")/2")).alias("Reference"),
                        F.col(key).alias("_key"))
    a = d("customer", "c_custkey", "c_nationkey").withColumn("_pass_no", F.lit(0))
    c = d("supplier", "s_suppkey", "s_nationkey").withColumn("_pass_no", F.lit(1))
    a = a.withColumn("_ord", F.col("_pass_no") * F.lit(10**12) + F.col("_key"))
    c = c.withColumn("_ord", F.col("_pass_no") * F.lit(10**12) + F.col("_key"))
    out = design.combine_designs({"1A": a, "1C": c}, ["_ord"])
    return out.select(F.col("_ord").alias("row_order"), "PlexID", "ReporterAlias", "MeasurementName", "Reference")


# ---------------------------------------------------------------- inference
def q17_unique_only(spark, sf):
    """H6: order -> part edges; orders whose lines name one part only."""
    e = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return inference.unique_only(e, "l_orderkey", "l_partkey")


def q18_parsimony(spark, sf):
    """H5: greedy set cover of parts (peptides) by suppliers (proteins), one supplier at a time."""
    e = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    return inference.greedy_cover(e, "l_partkey", "l_suppkey", share=1)


SUPPLIER_NODE_OFFSET = 10**12


def q19_components(spark, sf):
    """§4.5: connected components of the part-supplier graph; label = the
    smallest part key of the component."""
    e = table(spark, sf, "lineitem").select(
        "l_partkey", (F.col("l_suppkey") + F.lit(SUPPLIER_NODE_OFFSET)).alias("snode"))
    cc = inference.connected_components(e, "l_partkey", "snode")
    return cc.where(F.col("node") < SUPPLIER_NODE_OFFSET).select(
        F.col("node").alias("l_partkey"), F.col("component").alias("component_id"))


# ---------------------------------------------------------------- scans / stats
def q20_histogram(spark, sf):
    """E5 / F16: 40-bin histogram of extended prices."""
    h = scans.histogram(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice", 40)
    return h.select("bin", "n", F.round("bin_lo", 4).alias("bin_lo"))


def q21_observation_rate(spark, sf):
    """share of events with value > 100 per type, overall and in the top
    80 % of events by value."""
    ev = table(spark, sf, "events").select("event_id", "event_type", F.col("value").alias("abundance"),
                                             (F.col("value") - 100).alias("signal"))
    r = scans.observation_rate(ev, "event_type", "signal", "abundance", 0.8, order_tiebreak=["event_id"])
    return r.select("event_type", F.round("observation_rate", 6).alias("observation_rate"),
                    F.round("observation_rate_top", 6).alias("observation_rate_top"), "n")


def q22_stats(spark, sf):
    """per event type count, mean, min, max, stddev."""
    return scans.reporter_stats(table(spark, sf, "events"), "event_type", "value")


def q23_noise_filter(spark, sf):
    """Per user, noise = mean of the lowest 75 % of values; keep
    events with value >= 2 x noise."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    out = scans.sic_noise(ev, ["user_id"], "event_id", "value", 0.75, 0.0)
    out = out.withColumn("noise", F.round("noise", 9)).where(F.col("value") >= 2 * F.col("noise"))
    return out.select("event_id", "user_id", "value", F.round("noise", 6).alias("noise"))


def q24_smooth(spark, sf):
    """F8: centred moving mean of 5 events per user in time order."""
    ev = table(spark, sf, "events").select("event_id", "user_id", (stats.epoch_micros(F.col("ts"))).alias("t"), "value")
    s = scans.smooth(ev, ["user_id"], "t", "value", 2, key=["event_id"])
    return s.select("event_id", F.round("smoothed", 6).alias("smoothed"))


def q25_trapezoid(spark, sf):
    """area of value over time (seconds) per user, trapezoid rule."""
    ev = table(spark, sf, "events").select("event_id", "user_id", (stats.epoch_micros(F.col("ts")) / 1e6).alias("t"), "value")
    a = scans.trapezoid_area(ev, ["user_id"], "t", "value", tiebreak=["event_id"])
    return a.select("user_id", F.round("area", 3).alias("area"), "n_points", "apex")


def q26_bins(spark, sf):
    """unit prices binned by 100 between 0 and 20000, summed quantity."""
    u = _unit_prices(spark, sf)
    b = scans.bin_spectra(u, [], "unit_price", "l_quantity", 0.0, 20000.0, 100.0)
    return b.select("bin", F.round("total", 4).alias("total"), "n")


def q27_cluster_gaps(spark, sf):
    """customer balances as peaks (weight 1); a gap > 10 between
    neighbouring distinct values starts a new cluster."""
    c = table(spark, sf, "customer").select("c_acctbal", F.lit(1.0).alias("w"))
    g = scans.compress_peaks(c, [], "c_acctbal", "w", 10.0)
    return g.select(F.col("cluster_id").cast("long").alias("cluster_id"), F.round("center", 6).alias("center"),
                    F.round("total", 4).alias("total"), "n_peaks", "mz_min", "mz_max")


def q28_median_shift(spark, sf):
    """Median account balance per nation (exact)."""
    c = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    m = recalibrate.fit_shift(c, ["c_nationkey"], "c_acctbal")
    return m.select("c_nationkey", F.round("shift", 6).alias("shift"), "n")


def q29_apply(spark, sf):
    """Balances minus the nation's median over BUILDING customers, when
    the nation has at least 20 of them; unchanged otherwise."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    fit = recalibrate.fit_shift(c.where(F.col("c_mktsegment") == "BUILDING"), ["c_nationkey"], "c_acctbal",
                                min_rows=20)
    out = recalibrate.apply_shift(c, fit, ["c_nationkey"], "c_acctbal", name="corrected")
    return out.select("c_custkey", F.round("corrected", 6).alias("corrected"))


def q30_relaxed_threshold(spark, sf):
    """Per supplier the first discount threshold (0.01, 0.02, 0.04, 0.08) that
    keeps at least 165 lines."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_discount")
    return recalibrate.confident_psms(li, ["l_suppkey"], "l_discount", 0.01, 2.0, 3, 165)


# ---------------------------------------------------------------- search
DIGEST_RULE = r"(?<=[eo])(?! )"


def q31_digest(spark, sf):
    """D3: documents cut after 'e' or 'o' unless a blank follows; pieces of
    length 6..50 with any number of missed cuts, counted by length."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    d = search.digest(docs, ["doc_id"], "text", DIGEST_RULE, 6, 50)
    return d.groupBy(F.length("peptide").cast("long").alias("piece_len"), "missed_cleavages").agg(
        F.count(F.lit(1)).alias("n_pieces"))


def q32_decoy(spark, sf):
    """Part names plus reversed decoys."""
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("accession"),
                                        F.col("p_name").alias("sequence"))
    return search.add_decoys(p)


# residue masses for text: the character code (a rule, 95 printable characters)
CHAR_MASS = {chr(c): float(c) for c in range(32, 127)}


def q33_prefix_sum(spark, sf):
    """B / y ladders of part names with character-code masses."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    f = search.theoretical_fragments(p, "p_name", CHAR_MASS, ["p_partkey"])
    return f.select("p_partkey", "pos", F.round("b_ion", 6).alias("b_ion"), F.round("y_ion", 6).alias("y_ion"))


def q34_composition(spark, sf):
    """Mass of a composition built from each part's size."""
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    comp = F.concat(F.lit("C"), F.col("p_size").cast("string"), F.lit("H"),
                    (F.col("p_size") * 2 - 5).cast("string"), F.lit("NO2"))
    d = p.select("p_partkey", comp.alias("composition"))
    return d.withColumn("mass", F.round(search.composition_mass(F.col("composition")), 6))


MOD_DEFS = [("", "r", "Dimethyl", 28.0313), ("", "e", "Oxidation", 15.994915), (" ", "l", "Phospho", 79.966331)]


def _mod_defs(spark):
    return spark.createDataFrame(MOD_DEFS, "symbol string, residue string, mod_name string, mass double")


def q35_mod_details(spark, sf):
    """Modified residues of part names (static r, e; blank after l)."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name"))
    return hits.mod_details(p, ["p_partkey"], "p_name", _mod_defs(spark), "a-z")


def q36_summary(spark, sf):
    """Count per modification."""
    return hits.mod_summary(q35_mod_details(spark, sf), ["p_partkey"])


def q37_nearest_tag(spark, sf):
    """Nearest part price (within 0.05) per distinct line unit price."""
    u = _unit_prices(spark, sf).select("unit_price").distinct()
    tags = table(spark, sf, "part").select(F.col("p_partkey"), "p_retailprice")
    n = hits.name_masses(u, tags, ["unit_price"], "unit_price", "p_retailprice", "p_partkey", 0.05)
    return n.select("unit_price", "p_partkey", F.round("distance", 9).alias("distance"))


def q38_semi_anti(spark, sf):
    """Semi and anti joins: customers with orders and without (semi / anti joins)."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    w = c.join(o, on="c_custkey", how="left_semi").withColumn("status", F.lit("with_orders"))
    wo = c.join(o, on="c_custkey", how="left_anti").withColumn("status", F.lit("without_orders"))
    return w.unionByName(wo)


def q39_fill_null(spark, sf):
    """error events count as zero; zeros take the user's smallest
    positive value."""
    ev = table(spark, sf, "events").select("event_id", "user_id", F.when(
        F.col("event_type") == "error", F.lit(0.0)).otherwise(F.col("value")).alias("value"))
    r = scans.replace_zeroes(ev, ["user_id"], "value")
    return r.select("event_id", F.col("value").alias("filled"))


def q40_constant_columns(spark, sf):
    """per lineitem column, in how many orders it is constant."""
    li = table(spark, sf, "lineitem")
    return scans.split_constant_columns(li, ["l_orderkey"], ["l_suppkey", "l_discount", "l_tax", "l_returnflag",
                                                             "l_linestatus", "l_shipdate"])


def q41_peak_depth(spark, sf):
    """Rank of each event's value inside its user and 100-second window."""
    ev = table(spark, sf, "events").select("event_id", "user_id", (stats.epoch_micros(F.col("ts")) / 1e6).alias("t"), "value")
    d = sites.peak_depth(ev, ["user_id"], "t", "value", 100.0, tiebreak=["event_id"])
    return d.select("event_id", "depth")


def q42_binomial_score(spark, sf):
    """-10 log10 P(X >= n_high) with X ~ Bin(n_events, 0.25) per user,
    n_high = events with value above 100."""
    ev = table(spark, sf, "events").select("user_id", "value")
    g = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_trials"),
                                  F.sum((F.col("value") > 100).cast("long")).alias("n_success"))
    s = sites.peptide_score(g, "n_trials", "n_success", 0.25)
    return s.select("user_id", "n_trials", "n_success", F.round("score", 4).alias("score"))


def q43_md5_table(spark, sf):
    """Hashes as of J1, of texts in a table: name and md5 of the text."""
    d = table(spark, sf, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file_name"),
                                             F.md5("text").alias("md5"))
    return d.where(~F.col("file_name").contains("file_manifest"))


def q44_json_explode(spark, sf):
    """JSON properties exploded into key / value rows."""
    ev = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return ev.select("event_id", F.explode("m").alias("key", "value"))


def q45_durations(spark, sf):
    """Durations as of J2, from events: last minus first event per user, seconds."""
    ev = table(spark, sf, "events")
    g = ev.groupBy("user_id").agg((F.max(stats.epoch_micros(F.col("ts"))) - F.min(stats.epoch_micros(F.col("ts")))).alias("_us"))
    return g.select("user_id", F.round(F.col("_us") / 1e6, 6).alias("duration_s"))


def q46_path_parts(spark, sf):
    """URL split into scheme, host and key, with a check."""
    from ..operators.runs import parse_bucket_path
    p = table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", parse_bucket_path(F.col("url"), ("https",)).alias("x")).select("page_id", "x.*")


def q47_pivot_long_round_trip(spark, sf):
    """H9: crosstab then unpivot gives back the long table."""
    ct = q02_intensity_crosstab(spark, sf)
    types = [c for c in ct.columns if c != "user_id"]
    long = ct.unpivot(["user_id"], types, "event_type", "intensity")
    return long.where(F.col("intensity").isNotNull())


def q48_annotate(spark, sf):
    """Nations annotated with their region and a species."""
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    a = quant.annotate(n, table(spark, sf, "region"), "r_regionkey", species="Homo sapiens")
    return a.select("n_nationkey", "n_name", "r_name", "species")


def q49_label_free(spark, sf):
    """Best line per (supplier, order) -> order total as the area,
    summed per part and supplier."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber",
                                             "l_extendedprice")
    best = hits.first_hits(li, ["l_suppkey", "l_orderkey"], "l_extendedprice", lower_is_better=False,
                           tiebreak=["l_linenumber", "l_partkey"])
    area = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.col("o_totalprice").alias("area"))
    lf = quant.label_free(best, area, ["l_orderkey"], ["l_partkey"], "l_suppkey")
    return lf.select("l_partkey", "l_suppkey", F.round("intensity", 2).alias("intensity"), "n_scans")


def q50_cosine(spark, sf):
    """§4.3: pairs with the same label whose first two components are within 0.05 and
    whose cosine is at least 0 (two-dimensional range join, never all pairs of a label)."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", "label", F.col("embedding")[0].cast("double").alias("x"),
                                              F.col("embedding")[1].cast("double").alias("y"), stats.norm2(F.col("embedding")).alias("s"))
    a = e.select(*[F.col(c).alias(f"{c}_a") for c in e.columns])
    b = e.select(*[F.col(c).alias(f"{c}_b") for c in e.columns])
    j = range_join(a, b, [Tol("x_a", "x_b", 0.05), Tol("y_a", "y_b", 0.05)], on=[("label_a", "label_b")])
    cosine = stats.cosine(F.col("embedding_a"), F.col("embedding_b"), (F.col("s_a"), F.col("s_b")))
    # exploded: a column that the filter and the result both use would be computed twice
    j = j.where(F.col("vec_id_a") < F.col("vec_id_b")).withColumn("cosine", F.explode(F.array(cosine)))
    return j.where(F.col("cosine") >= 0).select(F.col("vec_id_a").alias("vec_a"), F.col("vec_id_b").alias("vec_b"), F.round("cosine", 6).alias("cosine"))


# ---------------------------------------------------------------- more operators
MOD_RESIDUES = "aeo"


def q51_expand_mods(spark, sf):
    """Variable-modification forms of part names ('a', 'e', 'o'
    modifiable, at most 3 per name), counted per part with their summed mass shift."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.lit(0.0).alias("mass"))
    f = search.expand_mods(p, "p_name", MOD_RESIDUES, 16.0, 3)
    return f.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_forms"), F.sum("mass").alias("shift"))


def q52_match_candidates(spark, sf):
    """Line unit prices as precursor m/z of unknown charge (2-5, isotope
    offsets -1..2) matched to part prices as neutral masses within 20 ppm."""
    s = _unit_prices(spark, sf).select("l_orderkey", "l_linenumber", F.col("unit_price").alias("precursor_mz"),
                                       F.lit(None).cast("int").alias("charge"))
    peps = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("pmass"))
    m = search.match_candidates(s, peps, "precursor_mz", "charge", "pmass", 20.0)
    return m.select("l_orderkey", "l_linenumber", F.col("_z").alias("charge"), F.col("_iso").alias("isotope"),
                    "p_partkey")


def q53_impurity(spark, sf):
    """per user and type summed values corrected with an inverted impurity matrix over the table's
    types but the last: 1.02 on the diagonal, -0.01 to neighbouring types. The last type keeps its value."""
    ri = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("intensity"))
    types = sorted(r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect())[:-1]  # a dimension
    rows = [(a, b, 1.02 if i == j else -0.01) for i, a in enumerate(types) for j, b in enumerate(types) if abs(i - j) <= 1]
    m = spark.createDataFrame(rows, "channel string, source_channel string, weight double")
    c = scans.correct_impurity(ri, m, ["user_id"], channel="event_type")
    return c.select("user_id", "event_type", F.round("intensity", 4).alias("intensity"),
                    F.round("corrected_intensity", 4).alias("corrected"))


def q54_synopsis_first_hits(spark, sf):
    """G1 + G2: discount as p-value (<= 0.02) or tax as probability (<=
    0.05); best line per (supplier, order, line status) by discount."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linestatus", "l_linenumber",
                                             "l_partkey", "l_discount", "l_tax")
    syn = hits.synopsis(li, "l_discount", "l_tax", 0.02, 0.05, "or")
    fh = hits.first_hits(syn, ["l_suppkey", "l_orderkey", "l_linestatus"], "l_discount",
                         tiebreak=["l_linenumber", "l_partkey"])
    return fh.select("l_suppkey", "l_orderkey", "l_linestatus", "l_linenumber", "l_partkey", "l_discount")


def q55_filter_fdr(spark, sf):
    """H3: lines kept at q-value <= 0.49 (score = price, decoy = flag R)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                             (F.col("l_returnflag") == "R").alias("is_decoy"))
    k = inference.filter_fdr(li, "l_extendedprice", "is_decoy", 0.49)
    return k.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("q_value", 6).alias("q_value"))


def q56_site_permutations(spark, sf):
    """Placements of two modifications on the 'a', 'e', 'o' of part names."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.lit(2).alias("n_mods"))
    s = sites.site_permutations(p, "p_name", MOD_RESIDUES, "n_mods")
    return s.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_placements"))


def q57_semi_digest(spark, sf):
    """D3 with one tolerable non-specific terminus on part names (cut after
    'e' / 'o' unless a blank follows), length 6-50."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return search.digest_nonspecific(p, ["p_partkey"], "p_name", 1, DIGEST_RULE, 6, 50)


def q58_map_substring(spark, sf):
    """Every occurrence of each part name's first word in the documents
    (k-mer equi-join, k = 4, verified by substring)."""
    words = table(spark, sf, "part").select(F.split("p_name", " ")[0].alias("peptide")).distinct()
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("accession"), F.col("text").alias("sequence"))
    return hits.map_peptides_substring(words, docs, k=4)


def q59_match_fragments(spark, sf):
    """I4: unit prices as fragment peaks, activation HCD for return flag A
    (0.05) else CID (0.5), matched to part prices."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("mz"),
        F.when(F.col("l_returnflag") == "A", F.lit("HCD")).otherwise(F.lit("CID")).alias("activation"))
    fr = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("fmz"))
    m = sites.match_fragments(li, fr, [], "mz", "fmz")
    return m.select("l_orderkey", "l_linenumber", "p_partkey", "tolerance")


def q60_peak_bounds(spark, sf):
    """per user the apex (time of the largest value) and the bounded peak around it: interpolated
    half-height crossings, width and area."""
    ev = table(spark, sf, "events").select("user_id", (stats.epoch_micros(F.col("ts")) / 1e6).alias("t"), "value")
    b = scans.peak_bounds(ev, ["user_id"], "t", "value")
    return b.select("user_id", F.round("apex_x", 3).alias("apex_t"), F.col("apex_y").alias("apex_value"),
                    F.round("fwhm", 2).alias("fwhm"), F.round("area", 1).alias("area"))


MRM_TRANSITIONS = [("t900", 900.0), ("t950", 950.0), ("t999", 999.9)]


def q61_mrm_crosstab(spark, sf):
    """per order (scan) the quantity at three transition m/z values
    (unit prices within 20)."""
    u = _unit_prices(spark, sf).select("l_orderkey", "unit_price", "l_quantity")
    tr = spark.createDataFrame(MRM_TRANSITIONS, "transition string, transition_mz double")
    return scans.mrm_crosstab(u, tr, ["l_orderkey"], "unit_price", "l_quantity", 20.0)


def q62_group_parent_ions(spark, sf):
    """orders as parent ions of their status (the dataset; total price as m/z, order day as retention
    time), their lines as binned spectra (bin = supplier mod 4, height = quantity); ions of one status within
    2,000 and 60 days whose spectra have cosine >= 0.9 are linked, groups are the components."""
    o = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast("double").alias("mz"),
                                          F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("rt"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", F.col("l_quantity").cast("double").alias("q"))
    binned = li.join(o.select("o_orderkey", "o_orderstatus"), on="o_orderkey").groupBy(
        "o_orderstatus", "o_orderkey", (F.col("l_suppkey") % 4).alias("bin")).agg(F.sum("q").alias("total"))
    return scans.group_parent_ions(o, binned, "o_orderkey", "mz", "rt", 2000.0, 60.0, 0.9, keys=["o_orderstatus"])


QUERIES.update({k: v for k, v in sorted(globals().items()) if k[:1] == "q" and k[1:3].isdigit() and callable(v)})
