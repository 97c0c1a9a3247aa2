"""DuckDB SQL giving the same rows as each registered query (driver oracle)."""

ORACLE = {}

ORACLE["q01_ratio_crosstab"] = """
WITH agg AS (
  SELECT l_suppkey, l_returnflag, l_linestatus, SUM(l_quantity) AS inten
  FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus),
ref AS (SELECT l_suppkey, l_returnflag, inten AS ref FROM agg WHERE l_linestatus = 'F'),
r AS (
  SELECT a.l_suppkey, a.l_returnflag || '_' || a.l_linestatus AS m,
         CASE WHEN a.inten > 0 AND ref.ref > 0 THEN ROUND(LOG2(a.inten / ref.ref), 6) END AS ratio
  FROM agg a LEFT JOIN ref ON a.l_suppkey = ref.l_suppkey AND a.l_returnflag = ref.l_returnflag
  WHERE a.l_linestatus <> 'F')
SELECT l_suppkey,
  MAX(CASE WHEN m = 'A_O' THEN ratio END) AS A_O,
  MAX(CASE WHEN m = 'N_O' THEN ratio END) AS N_O,
  MAX(CASE WHEN m = 'R_O' THEN ratio END) AS R_O
FROM r GROUP BY l_suppkey
"""

from ..functions.constants import ELEMENT_MASS, PROTON, WATER  # noqa: E402

ORACLE["q02_intensity_crosstab"] = """
WITH l AS (SELECT user_id, event_type, ROUND(SUM(value), 4) AS v FROM events GROUP BY user_id, event_type)
SELECT user_id,
  MAX(CASE WHEN event_type = 'click' THEN v END) AS click,
  MAX(CASE WHEN event_type = 'error' THEN v END) AS error,
  MAX(CASE WHEN event_type = 'purchase' THEN v END) AS purchase,
  MAX(CASE WHEN event_type = 'signup' THEN v END) AS signup,
  MAX(CASE WHEN event_type = 'view' THEN v END) AS view
FROM l GROUP BY user_id
"""

ORACLE["q03_link_and_design"] = """
SELECT n.n_name, c.c_mktsegment, ROUND(SUM(l.l_extendedprice), 2) AS sum_price, COUNT(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, c.c_mktsegment
"""

ORACLE["q04_reference_constant"] = """
SELECT l_suppkey, l_returnflag, l_linestatus,
  CASE WHEN s > 0 THEN ROUND(LOG2(s / 1.0::DOUBLE), 6) END AS log2_ratio
FROM (SELECT l_suppkey, l_returnflag, l_linestatus, SUM(l_quantity) AS s FROM lineitem GROUP BY ALL)
"""

ORACLE["q05_reference_expression"] = """
WITH a AS (SELECT l_suppkey, l_linestatus, l_returnflag, SUM(l_quantity) AS s FROM lineitem GROUP BY ALL),
r AS (SELECT l_suppkey, l_linestatus,
        (MAX(CASE WHEN l_returnflag = 'A' THEN s END) + MAX(CASE WHEN l_returnflag = 'N' THEN s END)) / 2.0::DOUBLE AS r1,
        MAX(CASE WHEN l_returnflag = 'R' THEN s END)::DOUBLE AS r2,
        (COALESCE(r1, 0.0) + COALESCE(r2, 0.0)) / NULLIF((r1 IS NOT NULL)::INT + (r2 IS NOT NULL)::INT, 0) AS ref
      FROM a GROUP BY l_suppkey, l_linestatus)
SELECT a.l_suppkey, a.l_linestatus, a.l_returnflag, ROUND(r.ref, 6) AS reference_intensity,
  CASE WHEN a.s > 0 AND r.ref > 0 THEN ROUND(LOG2(a.s / r.ref), 6) END AS log2_ratio
FROM a JOIN r ON a.l_suppkey = r.l_suppkey AND a.l_linestatus = r.l_linestatus
"""

ORACLE["q06_range_abs"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, p_partkey, p_retailprice
FROM lineitem JOIN part ON ABS(l_extendedprice / l_quantity - p_retailprice) <= 0.003::DOUBLE
"""

ORACLE["q07_range_ppm"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, p_partkey, p_retailprice
FROM lineitem JOIN part ON ABS(l_extendedprice / l_quantity - p_retailprice) <= p_retailprice * 1e-05::DOUBLE
"""

ORACLE["q08_interval_2d"] = """
SELECT p.event_id, COUNT(*) AS n_points, ROUND(SUM(q.value), 4) AS total
FROM events p JOIN events q
  ON p.user_id = q.user_id AND ABS(q.value - p.value) <= 40.0::DOUBLE
 AND ABS(epoch_us(q.ts) / 1e6::DOUBLE - epoch_us(p.ts) / 1e6::DOUBLE) <= 432000.0::DOUBLE
GROUP BY p.event_id
"""

ORACLE["q09_top_n"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, rn FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
    ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber ASC) AS rn
  FROM lineitem) WHERE rn <= 2
"""

_FDR = """
WITH s AS (
  SELECT {by} l_extendedprice AS score,
    SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END)::BIGINT AS n_target,
    SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS n_decoy
  FROM lineitem GROUP BY {by} l_extendedprice),
c AS (SELECT *,
    SUM(n_target) OVER (PARTITION BY {part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS cum_target,
    SUM(n_decoy) OVER (PARTITION BY {part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS cum_decoy
  FROM s),
f AS (SELECT *, cum_decoy::DOUBLE / GREATEST(cum_target, 1) AS fdr FROM c)
SELECT {cols}, ROUND(MIN(fdr) OVER (PARTITION BY {part} ORDER BY score ASC ROWS UNBOUNDED PRECEDING), 6) AS q_value
FROM f
"""
ORACLE["q10_target_decoy"] = _FDR.format(
    by="", part="1", cols="score, n_target, n_decoy, cum_target, cum_decoy, ROUND(fdr, 6) AS fdr")
ORACLE["q11_by_group"] = _FDR.format(by="l_linestatus,", part="l_linestatus",
                                     cols="l_linestatus, score, cum_target, cum_decoy")

ORACLE["q12_make_unique"] = """
SELECT p_partkey, CASE WHEN rn = 0 THEN p_name ELSE p_name || '.' || rn END AS unique_name
FROM (SELECT p_partkey, p_name, ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS rn FROM part)
"""

ORACLE["q13_channel_check"] = """
WITH seen AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS s FROM events GROUP BY user_id),
e AS (SELECT ['click', 'purchase', 'refund', 'signup', 'view'] AS x)
SELECT user_id,
  array_to_string(list_sort(list_filter(x, lambda v: list_contains(s, v))), ',') AS shared,
  array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(s, v))), ',') AS missing,
  array_to_string(list_sort(list_filter(s, lambda v: NOT list_contains(x, v))), ',') AS extra
FROM seen, e
"""

ORACLE["q14_set_agreement"] = """
WITH n AS (SELECT DISTINCT n_nationkey::VARCHAR AS id FROM nation),
c AS (SELECT DISTINCT c_nationkey::VARCHAR AS id FROM customer),
s AS (SELECT DISTINCT s_nationkey::VARCHAR AS id FROM supplier),
k AS (SELECT id FROM n UNION SELECT id FROM c UNION SELECT id FROM s),
f AS (SELECT id AS PlexID, id IN (SELECT id FROM n) AS in_nation, id IN (SELECT id FROM c) AS in_customer,
        id IN (SELECT id FROM s) AS in_supplier FROM k)
SELECT *, in_nation AND in_customer AND in_supplier AS ok FROM f
"""

ORACLE["q15_build_design"] = """
WITH v AS (
  SELECT 'S' || DENSE_RANK() OVER (ORDER BY r.r_name) AS plex, n.n_nationkey::VARCHAR AS ch,
    CASE WHEN n.n_nationkey = MIN(n.n_nationkey) OVER (PARTITION BY n.n_regionkey) THEN 'ref channel'
         ELSE n.n_name || ' x' END AS lab0
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
v2 AS (SELECT plex, ch,
         REPLACE(CASE WHEN regexp_matches(lab0, '^ref', 'i') THEN 'Ref_' || plex ELSE lab0 END, ' ', '') AS lab
       FROM v),
s AS (SELECT plex AS PlexID, 1 AS QuantBlock, REPLACE(ch, '126C', '126') AS ReporterName, lab AS ReporterAlias,
        CASE WHEN regexp_matches(lab, '^ref', 'i') THEN NULL ELSE lab END AS MeasurementName FROM v2),
r AS (SELECT PlexID, QuantBlock, ReporterAlias AS Reference FROM s WHERE starts_with(ReporterAlias, 'Ref'))
SELECT s.PlexID, s.QuantBlock, s.ReporterName, s.ReporterAlias, s.MeasurementName, r.Reference
FROM s LEFT JOIN r ON s.PlexID = r.PlexID AND s.QuantBlock = r.QuantBlock
"""

ORACLE["q16_combine"] = """
WITH st AS (
  SELECT c.c_custkey AS row_order, '1A' AS pass, c.c_nationkey AS nk, n.n_name AS nm
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL
  SELECT 1000000000000 + s.s_suppkey, '1C', s.s_nationkey, n.n_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
u AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY nm ORDER BY row_order) - 1 AS k FROM st)
SELECT row_order, 'S' || nk || '_' || pass AS PlexID,
  (CASE WHEN k = 0 THEN nm ELSE nm || '.' || k END) || '_' || pass AS ReporterAlias,
  (CASE WHEN k = 0 THEN nm ELSE nm || '.' || k END) || '_' || pass AS MeasurementName,
  '(Ref_S' || nk || '_' || pass || '+' || nm || '_' || pass || ')/2' AS Reference
FROM u
"""

ORACLE["q17_unique_only"] = """
WITH e AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
one AS (SELECT l_orderkey FROM e GROUP BY l_orderkey HAVING COUNT(*) = 1)
SELECT e.l_orderkey, e.l_partkey FROM e JOIN one ON e.l_orderkey = one.l_orderkey
"""

ORACLE["q19_components"] = """
WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS u, l_suppkey + 1000000000000 AS v FROM lineitem),
ed AS (SELECT u AS a, v AS b FROM e UNION SELECT v, u FROM e),
reach(node, lbl) AS (
  SELECT DISTINCT u, u FROM e
  UNION
  SELECT ed.b, reach.lbl FROM reach JOIN ed ON reach.node = ed.a)
SELECT node AS l_partkey, MIN(lbl) AS component_id FROM reach WHERE node < 1000000000000 GROUP BY node
"""

ORACLE["q20_histogram"] = """
WITH mm AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT LEAST(FLOOR((l_extendedprice - lo) * 40 / (hi - lo)) + 1, 40)::BIGINT AS bin, lo, hi FROM lineitem, mm)
SELECT bin, COUNT(*) AS n, ROUND(lo + (bin - 1) * (hi - lo) / 40, 4) AS bin_lo FROM b GROUP BY bin, lo, hi
"""

ORACLE["q21_observation_rate"] = """
WITH r AS (SELECT event_type, value,
    (RANK() OVER (ORDER BY value DESC) - 1)::DOUBLE / (COUNT(*) OVER () - 1) AS pr FROM events)
SELECT event_type,
  ROUND(AVG(CASE WHEN value - 100 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS observation_rate,
  ROUND(AVG(CASE WHEN pr <= 0.8::DOUBLE THEN (CASE WHEN value - 100 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) END), 6)
    AS observation_rate_top,
  COUNT(*) AS n
FROM r GROUP BY event_type
"""

ORACLE["q22_stats"] = """
SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 6) AS mean_value, MIN(value) AS min_value,
  MAX(value) AS max_value, ROUND(STDDEV_SAMP(value), 6) AS std_value
FROM events GROUP BY event_type
"""

ORACLE["q23_noise_filter"] = """
WITH r AS (SELECT event_id, user_id, value, PERCENT_RANK() OVER (PARTITION BY user_id ORDER BY value) AS pr FROM events),
nz AS (SELECT user_id, ROUND(AVG(value), 9) AS noise FROM r WHERE pr <= 0.75::DOUBLE GROUP BY user_id)
SELECT r.event_id, r.user_id, r.value, ROUND(nz.noise, 6) AS noise
FROM r JOIN nz ON r.user_id = nz.user_id WHERE r.value >= 2 * nz.noise
"""

ORACLE["q24_smooth"] = """
SELECT event_id, ROUND(AVG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                         ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smoothed
FROM events
"""

ORACLE["q25_trapezoid"] = """
WITH o AS (
  SELECT user_id, epoch_us(ts) / 1e6::DOUBLE AS t, value,
    LAG(epoch_us(ts) / 1e6::DOUBLE) OVER w AS pt, LAG(value) OVER w AS pv
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ROUND(SUM((t - pt) * (value + pv) / 2), 3) AS area, COUNT(*) AS n_points, MAX(value) AS apex
FROM o GROUP BY user_id
"""

ORACLE["q26_bins"] = """
SELECT FLOOR((l_extendedprice / l_quantity - 0.0::DOUBLE) / 100.0::DOUBLE)::BIGINT AS bin,
  ROUND(SUM(l_quantity), 4) AS total, COUNT(*) AS n
FROM lineitem
WHERE l_extendedprice / l_quantity >= 0.0::DOUBLE AND l_extendedprice / l_quantity < 20000.0::DOUBLE
GROUP BY 1
"""

ORACLE["q27_cluster_gaps"] = """
WITH d AS (SELECT c_acctbal AS mz, SUM(1.0::DOUBLE) AS i, COUNT(*) AS c FROM customer GROUP BY 1),
g AS (SELECT *, CASE WHEN LAG(mz) OVER (ORDER BY mz) IS NULL OR mz - LAG(mz) OVER (ORDER BY mz) > 10.0::DOUBLE
                     THEN 1 ELSE 0 END AS st FROM d),
k AS (SELECT *, SUM(st) OVER (ORDER BY mz ROWS UNBOUNDED PRECEDING) AS cid FROM g)
SELECT cid::BIGINT AS cluster_id, ROUND(SUM(mz * i) / SUM(i), 6) AS center, ROUND(SUM(i), 4) AS total,
  SUM(c)::BIGINT AS n_peaks, MIN(mz) AS mz_min, MAX(mz) AS mz_max
FROM k GROUP BY cid
"""

ORACLE["q28_median_shift"] = """
SELECT c_nationkey, ROUND(MEDIAN(c_acctbal), 6) AS shift, COUNT(c_acctbal) AS n FROM customer GROUP BY c_nationkey
"""

ORACLE["q29_apply"] = """
WITH fit AS (SELECT c_nationkey, MEDIAN(c_acctbal) AS shift FROM customer WHERE c_mktsegment = 'BUILDING'
             GROUP BY c_nationkey HAVING COUNT(c_acctbal) >= 20)
SELECT c.c_custkey, ROUND(c.c_acctbal - COALESCE(fit.shift, 0.0::DOUBLE), 6) AS corrected
FROM customer c LEFT JOIN fit ON c.c_nationkey = fit.c_nationkey
"""

ORACLE["q30_relaxed_threshold"] = """
WITH c AS (SELECT l_suppkey,
    SUM(CASE WHEN l_discount <= 0.01::DOUBLE THEN 1 ELSE 0 END) AS n0,
    SUM(CASE WHEN l_discount <= 0.02::DOUBLE THEN 1 ELSE 0 END) AS n1,
    SUM(CASE WHEN l_discount <= 0.04::DOUBLE THEN 1 ELSE 0 END) AS n2,
    SUM(CASE WHEN l_discount <= 0.08::DOUBLE THEN 1 ELSE 0 END) AS n3
  FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey,
  CASE WHEN n0 >= 165 THEN 0.01::DOUBLE WHEN n1 >= 165 THEN 0.02::DOUBLE WHEN n2 >= 165 THEN 0.04::DOUBLE ELSE 0.08::DOUBLE END AS threshold,
  (CASE WHEN n0 >= 165 THEN n0 WHEN n1 >= 165 THEN n1 WHEN n2 >= 165 THEN n2 ELSE n3 END)::BIGINT AS n_confident
FROM c
"""

ORACLE["q31_digest"] = """
WITH m AS (
  SELECT doc_id, list_filter(string_split(
    regexp_replace(regexp_replace(text, '([eo])([^ \\x01])', '\\1' || chr(1) || '\\2', 'g'),
                   '([eo])([^ \\x01])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: x <> '') AS p
  FROM documents),
pc AS (SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i FROM m),
e AS (SELECT doc_id, i, length(piece) AS n, SUM(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM pc),
x AS (SELECT (b.stop - a.stop + a.n)::INTEGER AS piece_len, (b.i - a.i)::INTEGER AS missed_cleavages
      FROM (SELECT *, unnest(range(i, i + 50)) AS j FROM e) a JOIN e b ON a.doc_id = b.doc_id AND b.i = a.j)
SELECT piece_len, missed_cleavages, COUNT(*) AS n_pieces FROM x WHERE piece_len BETWEEN 6 AND 50 GROUP BY 1, 2
"""

ORACLE["q32_decoy"] = """
SELECT p_partkey::VARCHAR AS accession, p_name AS sequence, false AS is_decoy FROM part
UNION ALL
SELECT 'XXX_' || p_partkey::VARCHAR, reverse(p_name), true FROM part
"""

ORACLE["q33_prefix_sum"] = f"""
WITH c AS (SELECT p_partkey, p_name, unnest(range(1, length(p_name) + 1)) AS i FROM part),
m AS (SELECT p_partkey, i, ascii(substr(p_name, i, 1))::DOUBLE AS mass FROM c),
pre AS (SELECT p_partkey, i,
          SUM(mass) OVER (PARTITION BY p_partkey ORDER BY i ROWS UNBOUNDED PRECEDING) AS pref,
          SUM(mass) OVER (PARTITION BY p_partkey) AS tot FROM m)
SELECT p_partkey, i::INTEGER AS pos, ROUND(pref + {PROTON!r}::DOUBLE, 6) AS b_ion,
  ROUND(tot - pref + {WATER + PROTON!r}::DOUBLE, 6) AS y_ion
FROM pre WHERE pref < tot
"""

_EL_CASE = " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in ELEMENT_MASS.items())
ORACLE["q34_composition"] = f"""
WITH c AS (SELECT p_partkey, 'C' || p_size || 'H' || (p_size * 2 - 5) || 'NO2' AS composition FROM part)
SELECT p_partkey, composition, ROUND(list_sum(list_transform(
    regexp_extract_all(composition, '([A-Z][a-z]?)(-?\\d*)', 0),
    lambda t: (CASE regexp_extract(t, '^([A-Z][a-z]?)', 1) {_EL_CASE} END)
         * COALESCE(TRY_CAST(NULLIF(regexp_extract(t, '(-?\\d+)$', 1), '') AS INTEGER), 1))), 6) AS mass
FROM c
"""

_MODS = """
WITH t AS (
  SELECT p_partkey, unnest(regexp_extract_all(p_name, '([a-z])([^a-z]*)', 0)) AS tok,
    unnest(range(1, len(regexp_extract_all(p_name, '([a-z])([^a-z]*)', 0)) + 1)) AS position
  FROM part),
d AS (SELECT * FROM (VALUES ('', 'r', 'Dimethyl', 28.0313::DOUBLE), ('', 'e', 'Oxidation', 15.994915::DOUBLE),
                            (' ', 'l', 'Phospho', 79.966331::DOUBLE)) v(symbol, residue, mod_name, mass)),
md AS (SELECT t.p_partkey, t.position::INTEGER AS position, substr(t.tok, 1, 1) AS residue, d.symbol, d.mod_name, d.mass
       FROM t JOIN d ON substr(t.tok, 1, 1) = d.residue
        AND (d.symbol = '' OR instr(substr(t.tok, 2), d.symbol) > 0))
"""
ORACLE["q35_mod_details"] = _MODS + "SELECT * FROM md"
ORACLE["q36_summary"] = _MODS + """
SELECT mod_name, residue, mass, COUNT(*) AS n, COUNT(DISTINCT p_partkey) AS n_items FROM md GROUP BY ALL
"""

ORACLE["q37_nearest_tag"] = """
WITH u AS (SELECT DISTINCT l_extendedprice / l_quantity AS unit_price FROM lineitem),
j AS (SELECT unit_price, p_partkey, ABS(unit_price - p_retailprice) AS d
      FROM u JOIN part ON ABS(unit_price - p_retailprice) <= 0.05::DOUBLE),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY unit_price ORDER BY d, p_partkey) AS rn FROM j)
SELECT unit_price, p_partkey, ROUND(d, 9) AS distance FROM r WHERE rn = 1
"""

ORACLE["q38_semi_anti"] = """
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
                       THEN 'with_orders' ELSE 'without_orders' END AS status
FROM customer c
"""

ORACLE["q39_fill_null"] = """
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE value END AS v FROM events),
m AS (SELECT user_id, MIN(CASE WHEN v > 0 THEN v END) AS mp FROM e GROUP BY user_id)
SELECT e.event_id, CASE WHEN e.v > 0 THEN e.v ELSE m.mp END AS filled FROM e JOIN m ON e.user_id = m.user_id
"""

_CONST_COLS = ["l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORACLE["q40_constant_columns"] = (
    "WITH g AS (SELECT l_orderkey, "
    + ", ".join(f"(MIN({c}) = MAX({c}) AND COUNT({c}) = COUNT(*)) AS {c}" for c in _CONST_COLS)
    + " FROM lineitem GROUP BY l_orderkey)\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, SUM({c}::INTEGER)::BIGINT AS n_constant_groups, "
                           f"COUNT(*) AS n_groups FROM g" for c in _CONST_COLS))

ORACLE["q41_peak_depth"] = """
SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id, FLOOR(epoch_us(ts) / 1e6::DOUBLE / 100.0::DOUBLE)
                                    ORDER BY value DESC, event_id) AS depth
FROM events
"""

ORACLE["q42_binomial_score"] = """
WITH g AS (SELECT user_id, COUNT(*) AS n, SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END)::BIGINT AS k
           FROM events GROUP BY user_id)
SELECT user_id, n AS n_trials, k AS n_success,
  ROUND(-10 * LOG10(list_sum(list_transform(range(k, n + 1), lambda j:
    EXP(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * LN(0.25) + (n - j) * LN(0.75))))), 4) AS score
FROM g
"""

ORACLE["q43_md5_table"] = """
SELECT 'doc_' || doc_id AS file_name, md5(text) AS md5 FROM documents
WHERE NOT contains('doc_' || doc_id, 'file_manifest')
"""

ORACLE["q44_json_explode"] = """
WITH k AS (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
SELECT event_id, key, json_extract_string(props, '$."' || key || '"') AS value FROM k
"""

ORACLE["q45_durations"] = """
SELECT user_id, ROUND((MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 1e6::DOUBLE, 6) AS duration_s
FROM events GROUP BY user_id
"""

ORACLE["q46_path_parts"] = """
WITH p AS (
  SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
    regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
q AS (SELECT page_id, scheme, regexp_extract(rest, '^([^/]*)', 1) AS bucket,
        regexp_extract(rest, '^[^/]*/?(.*)$', 1) AS key FROM p)
SELECT page_id, scheme, bucket, key,
  CASE WHEN scheme NOT IN ('https') THEN 'path must start with one of: https://'
       WHEN bucket = '' THEN 'empty bucket name'
       WHEN trim(bucket) = '' THEN 'invalid bucket name' END AS error
FROM q
"""

ORACLE["q47_pivot_long_round_trip"] = """
SELECT user_id, event_type, ROUND(SUM(value), 4) AS intensity FROM events GROUP BY user_id, event_type
"""

ORACLE["q48_annotate"] = """
SELECT n_nationkey, n_name, r_name, 'Homo sapiens' AS species FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

ORACLE["q49_label_free"] = """
WITH b AS (SELECT * FROM (
  SELECT l_suppkey, l_orderkey, l_partkey, ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_orderkey
    ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn = 1)
SELECT b.l_partkey, b.l_suppkey, ROUND(SUM(o.o_totalprice), 2) AS intensity, COUNT(*) AS n_scans
FROM b JOIN orders o ON b.l_orderkey = o.o_orderkey GROUP BY b.l_partkey, b.l_suppkey
"""

ORACLE["q50_cosine"] = """
WITH p AS (
  SELECT a.vec_id AS vec_a, b.vec_id AS vec_b,
    list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c
  FROM embeddings a JOIN embeddings b
    ON a.label = b.label AND a.vec_id < b.vec_id
   AND ABS(a.embedding[1]::DOUBLE - b.embedding[1]::DOUBLE) <= 0.05::DOUBLE
   AND ABS(a.embedding[2]::DOUBLE - b.embedding[2]::DOUBLE) <= 0.05::DOUBLE)
SELECT vec_a, vec_b, ROUND(c, 6) AS cosine FROM p WHERE c >= 0
"""


ORACLE["q51_expand_mods"] = """
WITH p AS (SELECT p_partkey, length(p_name) - length(regexp_replace(p_name, '[aeo]', '', 'g')) AS n FROM part)
SELECT p_partkey, (1 + n + n * (n - 1) // 2 + n * (n - 1) * (n - 2) // 6)::BIGINT AS n_forms,
  16.0::DOUBLE * (n + n * (n - 1) + n * (n - 1) * (n - 2) // 2) AS shift FROM p
"""

ORACLE["q52_match_candidates"] = """
WITH s AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS mz FROM lineitem),
x AS (SELECT s.*, z.z AS charge, i.iso AS isotope,
        (mz - 1.007276466812::DOUBLE) * z.z - i.iso * 1.00335483::DOUBLE AS obs
      FROM s, (VALUES (2), (3), (4), (5)) z(z), (VALUES (-1), (0), (1), (2)) i(iso))
SELECT l_orderkey, l_linenumber, charge, isotope, p_partkey
FROM x JOIN part ON ABS(obs - p_retailprice) <= p_retailprice * 2e-05::DOUBLE
"""

ORACLE["q53_impurity"] = """
WITH ri AS (SELECT user_id, event_type, SUM(value) AS intensity FROM events GROUP BY user_id, event_type),
t AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS i, COUNT(*) OVER () AS n FROM (SELECT DISTINCT event_type FROM events)),
k AS (SELECT * FROM t WHERE i < n),
c AS (SELECT ri.user_id, a.event_type AS channel,
             SUM((CASE WHEN a.i = b.i THEN 1.02::DOUBLE ELSE -0.01::DOUBLE END) * ri.intensity) AS cc
      FROM k a JOIN k b ON ABS(a.i - b.i) <= 1 JOIN ri ON ri.event_type = b.event_type GROUP BY ri.user_id, a.event_type)
SELECT ri.user_id, ri.event_type, ROUND(ri.intensity, 4) AS intensity,
  ROUND(CASE WHEN k.event_type IS NULL THEN ri.intensity ELSE GREATEST(COALESCE(c.cc, 0.0), 0.0) END, 4) AS corrected
FROM ri LEFT JOIN k ON ri.event_type = k.event_type
LEFT JOIN c ON ri.user_id = c.user_id AND ri.event_type = c.channel
"""

ORACLE["q54_synopsis_first_hits"] = """
SELECT l_suppkey, l_orderkey, l_linestatus, l_linenumber, l_partkey, l_discount FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_orderkey, l_linestatus
                               ORDER BY l_discount, l_linenumber, l_partkey) AS rn
  FROM lineitem WHERE l_discount <= 0.02::DOUBLE OR l_tax <= 0.05::DOUBLE) WHERE rn = 1
"""

ORACLE["q55_filter_fdr"] = """
WITH s AS (
  SELECT l_extendedprice AS score,
    SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS nt, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS nd
  FROM lineitem GROUP BY l_extendedprice),
c AS (SELECT *, SUM(nt) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ct,
        SUM(nd) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cd FROM s),
f AS (SELECT score, cd::DOUBLE / GREATEST(ct, 1) AS fdr FROM c),
q AS (SELECT score, MIN(fdr) OVER (ORDER BY score ASC ROWS UNBOUNDED PRECEDING) AS q FROM f)
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, ROUND(q.q, 6) AS q_value
FROM lineitem l JOIN q ON l.l_extendedprice = q.score
WHERE q.q <= 0.49::DOUBLE AND NOT (l.l_returnflag = 'R')
"""

ORACLE["q56_site_permutations"] = """
WITH p AS (SELECT p_partkey, length(p_name) - length(regexp_replace(p_name, '[aeo]', '', 'g')) AS n FROM part)
SELECT p_partkey, (n * (n - 1) // 2)::BIGINT AS n_placements FROM p WHERE n >= 2
"""

ORACLE["q57_semi_digest"] = """
WITH p AS (SELECT p_partkey, p_name AS s, length(p_name) AS n FROM part WHERE length(p_name) >= 6),
c AS (SELECT p_partkey, s, n,
        list_concat([0], list_filter(range(1, n), lambda i: substr(s, i, 1) IN ('e', 'o')
                                                            AND substr(s, i + 1, 1) <> ' '), [n]) AS cuts FROM p),
b AS (SELECT *, unnest(range(0, n - 6 + 1)) AS b FROM c),
e AS (SELECT *, unnest(range(b + 6, LEAST(b + 50, n) + 1)) AS e FROM b),
t AS (SELECT p_partkey, (b + 1)::INTEGER AS start, substr(s, b + 1, e - b) AS peptide,
        (list_contains(cuts, b)::INTEGER + list_contains(cuts, e)::INTEGER) AS ntt,
        len(list_filter(cuts, lambda x: x > b AND x < e))::INTEGER AS missed_cleavages FROM e)
SELECT p_partkey, start, missed_cleavages, ntt, peptide FROM t WHERE ntt >= 1
"""

ORACLE["q58_map_substring"] = """
WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS peptide FROM part WHERE split_part(p_name, ' ', 1) <> ''),
c AS (SELECT doc_id, regexp_extract_all(text, '(?s).{1,64}') AS l FROM documents WHERE text <> ''),
b AS (SELECT doc_id, unnest(l) AS t, unnest(list_append(l[2:], '')) AS next, unnest(range(len(l))) AS k FROM c),
h AS (SELECT doc_id, t || next AS s, k, unnest(range(1, length(t) + 1)) AS i FROM b)
SELECT w.peptide, h.doc_id AS accession, (k * 64 + i)::INTEGER AS start
FROM h JOIN w ON substr(s, i, 1) = substr(w.peptide, 1, 1) AND substr(s, i, length(w.peptide)) = w.peptide
"""

ORACLE["q59_match_fragments"] = """
WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS mz,
             CASE WHEN l_returnflag = 'A' THEN 0.05::DOUBLE ELSE 0.5::DOUBLE END AS tolerance FROM lineitem)
SELECT l_orderkey, l_linenumber, p_partkey, tolerance FROM l JOIN part ON ABS(mz - p_retailprice) <= tolerance
"""

ORACLE["q60_peak_bounds"] = """
WITH e AS (SELECT user_id, epoch_us(ts) / 1e6::DOUBLE AS t, MAX(value) AS y FROM events GROUP BY 1, 2),
a AS (SELECT user_id, MAX({'y': y, 'x': t}) AS top FROM e GROUP BY user_id),
s AS (SELECT e.user_id, MAX(CASE WHEN t < a.top.x AND y < a.top.y / 2 THEN t END) AS lo,
             MIN(CASE WHEN t > a.top.x AND y < a.top.y / 2 THEN t END) AS hi
      FROM e JOIN a USING (user_id) GROUP BY e.user_id),
p AS (SELECT e.user_id, e.t, e.y, a.top.x AS ax, a.top.y AS ay, s.lo, s.hi FROM e JOIN a USING (user_id) JOIN s USING (user_id)
      WHERE (s.lo IS NULL OR e.t >= s.lo) AND (s.hi IS NULL OR e.t <= s.hi)),
w AS (SELECT *, LAG(t) OVER u AS pt, LAG(y) OVER u AS py FROM p WINDOW u AS (PARTITION BY user_id ORDER BY t)),
seg AS (SELECT user_id, ax, ay,
    CASE WHEN pt IS NULL THEN NULL WHEN py < ay / 2 THEN pt + (ay / 2 - py) / (y - py) * (t - pt) ELSE pt END AS x0,
    CASE WHEN py < ay / 2 THEN ay / 2 ELSE py END AS y0,
    CASE WHEN y < ay / 2 THEN t + (ay / 2 - y) / (py - y) * (pt - t) ELSE t END AS x1,
    CASE WHEN y < ay / 2 THEN ay / 2 ELSE y END AS y1 FROM w)
SELECT user_id, ROUND(ax, 3) AS apex_t, ay AS apex_value, ROUND(COALESCE(MAX(x1) - MIN(COALESCE(x0, x1)), 0.0), 2) AS fwhm,
  ROUND(COALESCE(SUM((x1 - x0) * (y0 + y1) / 2), 0.0), 1) AS area
FROM seg GROUP BY user_id, ax, ay
"""

ORACLE["q61_mrm_crosstab"] = """
WITH u AS (SELECT l_orderkey, l_extendedprice / l_quantity AS mz, l_quantity FROM lineitem),
t AS (SELECT * FROM (VALUES ('t900', 900.0::DOUBLE), ('t950', 950.0::DOUBLE), ('t999', 999.9::DOUBLE)) v(transition, tmz)),
j AS (SELECT u.l_orderkey, t.transition, u.l_quantity FROM u JOIN t ON ABS(u.mz - t.tmz) <= 20.0::DOUBLE)
SELECT l_orderkey, SUM(CASE WHEN transition = 't900' THEN l_quantity END) AS t900,
  SUM(CASE WHEN transition = 't950' THEN l_quantity END) AS t950,
  SUM(CASE WHEN transition = 't999' THEN l_quantity END) AS t999
FROM j GROUP BY l_orderkey
"""

ORACLE["q62_group_parent_ions"] = """
WITH RECURSIVE o AS (SELECT o_orderstatus AS st, o_orderkey AS k, o_totalprice::DOUBLE AS mz, datediff('day', DATE '1992-01-01', o_orderdate::DATE)::DOUBLE AS rt FROM orders),
b AS (SELECT l_orderkey AS k, l_suppkey % 4 AS bin, SUM(l_quantity::DOUBLE) AS v FROM lineitem GROUP BY 1, 2),
n AS (SELECT k, SQRT(SUM(v * v)) AS n FROM b GROUP BY k),
pr AS (SELECT x.k AS u, y.k AS w FROM o x JOIN o y ON x.st = y.st AND x.k < y.k
       AND ABS(x.mz - y.mz) <= 2000.0::DOUBLE AND ABS(x.rt - y.rt) <= 60.0::DOUBLE),
d AS (SELECT u, w, SUM(p.v * q.v) AS dot FROM pr JOIN b p ON p.k = u JOIN b q ON q.k = w AND q.bin = p.bin GROUP BY u, w),
links AS (SELECT u, w FROM d JOIN n a ON a.k = u JOIN n c ON c.k = w WHERE a.n * c.n > 0 AND dot / (a.n * c.n) >= 0.9::DOUBLE),
ed AS (SELECT u AS a, w AS b FROM links UNION SELECT w, u FROM links),
reach(node, lbl) AS (SELECT DISTINCT a, a FROM ed UNION SELECT ed.b, reach.lbl FROM reach JOIN ed ON reach.node = ed.a),
comp AS (SELECT node, MIN(lbl) AS c FROM reach GROUP BY node)
SELECT o.st AS o_orderstatus, o.k AS o_orderkey, COALESCE(comp.c, o.k) AS group_id FROM o LEFT JOIN comp ON o.k = comp.node
"""


def cover_sql(edges: str) -> str:
    """CTEs from the edges (p, s) of the table ``edges`` to the cover (p, s) ``cover``: a round per step, in
    which every part votes for the first of its suppliers and those with half of their parts' votes are taken."""
    return f"""
rounds(p, s, rank, owner) AS (
  SELECT p, s, ('0x' || substr(md5(s::VARCHAR), 1, 15))::BIGINT, NULL::BIGINT FROM {edges}
  UNION ALL
  SELECT p, s, rank, (MIN(CASE WHEN 2 * votes >= cnt THEN k END) OVER (PARTITION BY p)).s FROM (
    SELECT *, COUNT(*) FILTER (best.s = s) OVER (PARTITION BY s) AS votes FROM (
      SELECT *, MIN(k) OVER (PARTITION BY p) AS best FROM (
        SELECT *, {{'a': -length(bin(cnt)), 'b': -('0b' || substr(bin(cnt), 1, 4))::INT, 'rank': rank, 's': s}} AS k FROM (
          SELECT p, s, rank, COUNT(*) OVER (PARTITION BY s) AS cnt FROM rounds WHERE owner IS NULL))))),
cover AS (SELECT DISTINCT p, owner AS s FROM rounds WHERE owner IS NOT NULL)"""


ORACLE["q18_parsimony"] = """
WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
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
SELECT e.p AS l_partkey, arg_min(o.s, o.i) AS l_suppkey FROM e JOIN o ON o.s = e.s GROUP BY e.p
"""
