"""Queries of cross-tradition similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import constellations as C
from ..operators import derive as D
from . import derive_plans as P
from . import views as V


def _features(s, d, stop=0.3):
    return C.features(V.features(s, d), stop)


def _edges(s, d, least=3, stop=0.3):
    return C.edges(_features(s, d, stop), least=least)


def _derived(s, d):
    """Features assembled from annotations: code sets, sequences and profiles."""
    a, ann = V.addresses(s, d), V.annotations(s, d)
    best = D.best_annotations(D.confirmed(ann, "propp"), ["nas"])
    return C.assemble(D.code_sets(a, ann), D.sequences(a, best, ""), D.profiles(a, ann))


def _notes(s, d):
    f = V.fragments(s, d).filter("methodology_fit_warning").groupBy("nas").agg(F.max("methodology_fit_note").alias("note"))
    return V.features(s, d).select("nas", F.split("nas", "#")[0].alias("plain")).join(f.withColumnRenamed("nas", "plain"), "plain").select("nas", F.lit("tmi").alias("track"), F.when(F.col("note") == "", None).otherwise(F.col("note")).alias("note"))


def _vector_edges(s, d):
    """Edges whose ends both have vectors, for parallels: others meet no pair of vectors. Stop codes are counted over all fragments."""
    return C.edges(_features(s, d).join(V.vectors(s, d).select("nas").distinct(), "nas", "left_semi"))


def _parallels(s, d, everything=False, threshold=0.65):
    return C.parallels(V.vectors(s, d), _vector_edges(s, d), threshold, everything)


def _by_label(s, d):
    v = V.vectors(s, d)
    return v.select("nas", "vector")


def _q14(s, d):
    e = _edges(s, d)
    score = 0.20 * F.col("tmi_jaccard_leaf") + 0.20 * F.col("tmi_jaccard_branch") + 0.25 * F.col("propp_overlap") + 0.20 * F.col("chronotope_match").cast("double") + 0.15 * (1 - F.coalesce("bakhtin_polyphony_delta", F.lit(1.0)))
    return e.select("member_a", "member_b", F.bround(score, 6).alias("composite"))


QUERIES = {
    "c2_edges": lambda s, d: _edges(s, d),
    "c2_edges_least2": lambda s, d: _edges(s, d, 2),
    "c2_candidates": lambda s, d: C.candidates(_edges(s, d), _notes(s, d)),
    "c2_edges_stop5": lambda s, d: _edges(s, d, 3, 0.05),
    "c2_members": lambda s, d: C.candidate_members(_edges(s, d)),
    "c3_features": lambda s, d: _derived(s, d).select("nas", "tradition", F.array_join("tmi_codes", "|").alias("tmi"), F.array_join(F.array_sort("propp_codes"), "|").alias("propp"), "chronotope_type", "polyphony", "carnivalesque"),
    "c3_edges": lambda s, d: C.edges(C.features(_derived(s, d)), least=2).select("member_a", "member_b", "qualifying_dimensions"),
    "a11_components": lambda s, d: C.components(_edges(s, d)),
    "a27_pair_count": lambda s, d: C.pair_count(_features(s, d)),
    "c6_parallels_above": lambda s, d: _parallels(s, d, threshold=0.55),
    "c6_parallels_all": lambda s, d: _parallels(s, d, True),
    "c7_parallel_report": lambda s, d: C.parallel_report(V.vectors(s, d), _vector_edges(s, d)),
    "a19_pairs_by_tradition": lambda s, d: C.pairs_by_tradition(_parallels(s, d, threshold=0.55)),
    "w9_numbered_parallels": lambda s, d: C.number_pairs(_parallels(s, d, threshold=0.55)).select("parallel_id", "member_a", "member_b"),
    "q13_nearest": lambda s, d: C.nearest(_by_label(s, d), _by_label(s, d).join(V.features(s, d).filter("feature_id % 20 = 0").select("nas"), "nas"), 5).select("query_nas", "nas", F.bround("similarity", 6).alias("similarity"), "rank"),
    "q14_composite": _q14,
    "f17_levels": lambda s, d: _features(s, d).select("nas", F.size("leaf").alias("n_leaf"), F.array_join(F.array_sort("branch"), "|").alias("branch"), F.array_join(F.array_sort("root"), "|").alias("root")),
}

def _sql_features(share: float, views: str = V.VIEWS) -> str:
    """Features in SQL; the stop codes are counted from the raw arrays, a code once a row."""
    return rf"""{views},
stopped AS (SELECT code FROM (SELECT DISTINCT nas, {V.TMI.format("x")} AS code FROM (SELECT nas, unnest(tmi_codes) AS x FROM feat)) WHERE code IS NOT NULL GROUP BY code HAVING count(*) > {share} * (SELECT count(*) FROM feat)),
f00 AS (SELECT nas, tradition, list_distinct(list_filter(list_transform(coalesce(tmi_codes,[]), lambda x: {V.TMI.format("x")}), lambda x: x IS NOT NULL)) AS leaf,
  list_distinct(list_filter(list_transform(coalesce(propp_codes,[]), lambda x: {V.PROPP.format("x")}), lambda x: x IS NOT NULL)) AS propp, chronotope_type, polyphony, carnivalesque
  FROM feat WHERE NOT contains(nas, '/lacuna')),
f0 AS (SELECT f00.* REPLACE (list_filter(leaf, lambda x: NOT list_contains(sc, x)) AS leaf) FROM f00, (SELECT coalesce(list(code), []) AS sc FROM stopped)),
f AS (SELECT *, list_distinct(list_transform(list_filter(leaf, lambda x: regexp_matches(x,'^TMI-[A-Z]+\d+')), lambda x: regexp_extract(x,'^TMI-([A-Z]+)(\d+)',1) || (regexp_extract(x,'^TMI-([A-Z]+)(\d+)',2)::BIGINT // 100 * 100))) AS branch,
  list_distinct(list_transform(list_filter(leaf, lambda x: regexp_matches(x,'^TMI-[A-Z]+\d+')), lambda x: regexp_extract(x,'^TMI-([A-Z]+)(\d+)',1))) AS root FROM f0)"""


_F = _sql_features(0.3)


def _jac(c: str) -> str:
    both = f"len(list_intersect(a.{c}, b.{c}))"
    return f"CASE WHEN len(a.{c})=0 OR len(b.{c})=0 THEN 0.0::DOUBLE ELSE {both}::DOUBLE/(len(a.{c})+len(b.{c})-{both}) END"


def _sql_edges(features: str) -> str:
    return rf"""{features}, s AS (SELECT a.nas AS member_a, b.nas AS member_b, a.tradition AS tradition_a, b.tradition AS tradition_b, {_jac("leaf")} AS l, {_jac("branch")} AS br, {_jac("root")} AS ro,
  CASE WHEN len(a.propp)=0 OR len(b.propp)=0 THEN 0.0::DOUBLE ELSE len(list_intersect(a.propp,b.propp))::DOUBLE/greatest(len(a.propp),len(b.propp)) END AS po,
  coalesce(a.chronotope_type=b.chronotope_type,false) AS chronotope_match, a.polyphony IS NOT NULL AND b.polyphony IS NOT NULL AS bakhtin_profile_available,
  round_even(abs(a.polyphony-b.polyphony),4) AS bakhtin_polyphony_delta, round_even(abs(a.carnivalesque-b.carnivalesque),4) AS bakhtin_carnivalesque_delta
  FROM f a JOIN f b ON a.tradition < b.tradition),
q AS (SELECT *, (l>=0.1 OR br>=0.25)::INT + (po>0)::INT + chronotope_match::INT + coalesce(bakhtin_polyphony_delta<0.15,false)::INT AS qualifying_dimensions FROM s),
e AS (SELECT member_a, member_b, tradition_a, tradition_b, round_even(l,4) AS tmi_jaccard_leaf, round_even(br,4) AS tmi_jaccard_branch, round_even(ro,4) AS tmi_jaccard_root, round_even(po,4) AS propp_overlap,
  chronotope_match, qualifying_dimensions, bakhtin_profile_available, bakhtin_polyphony_delta, bakhtin_carnivalesque_delta FROM q)"""


_E = _sql_edges(_F)
_P = rf"""{_E}, u AS (SELECT nas, tradition, list_transform(vector, lambda x: x::DOUBLE) AS v FROM vec WHERE NOT contains(nas,'/lacuna')),
p AS (SELECT a.nas AS member_a, b.nas AS member_b, a.tradition AS tradition_a, b.tradition AS tradition_b, greatest(0.0, least(1.0, list_cosine_similarity(a.v,b.v))) AS cos FROM u a JOIN u b ON a.tradition < b.tradition),
k AS (SELECT p.*, e.* EXCLUDE (member_a, member_b, tradition_a, tradition_b), coalesce(qualifying_dimensions,0) AS k FROM p LEFT JOIN (SELECT * FROM e WHERE qualifying_dimensions>=3) e USING (member_a, member_b)),
par AS (SELECT member_a, member_b, tradition_a, tradition_b, k AS framework_match_count, round_even(cos,4) AS cosine_similarity, round_even(greatest(0.0,least(1.0,0.5*(k/4)+0.5*cos)),4) AS parallel_score,
  greatest(0.0,least(1.0,0.5*(k/4)+0.5*cos)) AS sc, greatest(coalesce(tmi_jaccard_leaf,0),coalesce(tmi_jaccard_branch,0)) AS tmi_score, coalesce(propp_overlap,0) AS propp_score,
  coalesce(chronotope_match,false)::DOUBLE AS chronotope_score, coalesce(bakhtin_polyphony_delta,0) AS polyphony_score FROM k)"""
_PCOLS = "member_a, member_b, tradition_a, tradition_b, framework_match_count, cosine_similarity, parallel_score, sc >= {0} AS meets_threshold, tmi_score, propp_score, chronotope_score, polyphony_score"
_COMP = rf"""{_E}, g AS (SELECT * FROM e WHERE qualifying_dimensions>=3), both_ AS (SELECT member_a AS x, member_b AS y FROM g UNION SELECT member_b, member_a FROM g),
lab0 AS (SELECT x AS nas, least(x, min(y)) AS lab FROM both_ GROUP BY x)"""
for _i in range(24):
    _COMP += f", lab{_i + 1} AS (SELECT l.nas, least(min(l.lab), min(m.lab)) AS lab FROM lab{_i} l JOIN both_ b ON b.x = l.nas JOIN lab{_i} m ON m.nas = b.y GROUP BY l.nas)"

_CAND = rf"""{_COMP}, comp AS (SELECT nas, lab AS component FROM lab24),
notes AS (SELECT nas, max(methodology_fit_note) AS note FROM frag WHERE methodology_fit_warning GROUP BY 1),
mem AS (SELECT component, list(nas ORDER BY nas) AS m, count(DISTINCT tradition) AS tradition_count FROM comp JOIN f USING (nas) GROUP BY 1),
fig AS (SELECT component, count(*) AS n_edges, avg(qualifying_dimensions) AS md, round_even(avg(tmi_jaccard_leaf),9) AS a1, round_even(avg(tmi_jaccard_branch),9) AS a2, round_even(avg(tmi_jaccard_root),9) AS a3, round_even(avg(propp_overlap),9) AS a4, round_even(avg(chronotope_match::INT),9) AS a5
  FROM e JOIN comp ON nas = member_a WHERE qualifying_dimensions >= 3 GROUP BY 1),
ranked AS (SELECT *, 'C-' || lpad((row_number() OVER (ORDER BY tradition_count DESC, n_edges DESC, component))::VARCHAR, 4, '0') AS candidate_id, greatest(a1,a2,a3,a4,a5) AS top FROM mem JOIN fig USING (component) WHERE tradition_count >= 2),
said AS (SELECT component, string_agg(comp.nas || ' [tmi]: ' || coalesce(nullif(note,''), 'methodology fit concern noted'), chr(10) ORDER BY comp.nas) AS n FROM comp JOIN notes ON notes.nas = split_part(comp.nas,'#',1) JOIN feat USING (nas) GROUP BY 1)"""
_CAND = _CAND.replace("JOIN feat USING (nas)", "")
_SPLIT = "CASE WHEN {0} = '' THEN []::VARCHAR[] ELSE string_split({0}, '|') END"
_DERIVED = f"""SELECT coalesce(x.nas, b.nas) AS nas, split_part(coalesce(x.nas, b.nas),'/',3) AS tradition, coalesce(codes,'') AS tmi, coalesce(pc,'') AS propp, chronotope_type, polyphony, carnivalesque
FROM (SELECT coalesce(t.nas, q.nas) AS nas, codes, pc FROM ({P.ORACLES['a1_code_sets']}) t FULL JOIN
  (SELECT nas, string_agg(code, '|' ORDER BY code) AS pc FROM (SELECT unnest(string_split(episodes,'|')) AS nas, unnest(string_split(sequence,'|')) AS code FROM ({P.ORACLES['a5_propp_sequences']})) GROUP BY 1) q ON q.nas = t.nas) x
FULL JOIN ({P.ORACLES['a8_bakhtin_profiles']}) b ON b.nas = x.nas"""
_DVIEWS = V.VIEWS.replace("feat AS (", "feat_given AS (").replace("FROM feat f", "FROM feat_given f") + f", der AS ({_DERIVED}), feat AS (SELECT nas, tradition, {_SPLIT.format('tmi')} AS tmi_codes, {_SPLIT.format('propp')} AS propp_codes, chronotope_type, polyphony, carnivalesque FROM der)"

ORACLES = {
    "c2_edges_stop5": f"{_sql_edges(_sql_features(0.05))} SELECT * FROM e WHERE qualifying_dimensions >= 3",
    "c2_candidates": f"""{_CAND} SELECT array_to_string(m,'|') AS members, len(m) AS n_members, tradition_count, n_edges, len(m) > 20 AS oversized, CASE WHEN md >= 2.8 THEN 'very_high' WHEN md >= 2 THEN 'high' ELSE 'moderate' END AS dimensional_agreement,
  CASE top WHEN a1 THEN 'tmi_jaccard_leaf' WHEN a2 THEN 'tmi_jaccard_branch' WHEN a3 THEN 'tmi_jaccard_root' WHEN a4 THEN 'propp_overlap' ELSE 'chronotope_match' END AS primary_dimension,
  CASE WHEN length(n) > 800 THEN substring(n,1,797)||'…' ELSE n END AS methodology_fit_note, candidate_id FROM ranked LEFT JOIN said USING (component)""",
    "c2_members": f"{_CAND} SELECT candidate_id, nas, tradition FROM ranked JOIN comp USING (component) JOIN f USING (nas)",
    "c3_features": _DERIVED,
    "c3_edges": f"{_sql_edges(_sql_features(0.3, _DVIEWS))} SELECT member_a, member_b, qualifying_dimensions FROM e WHERE qualifying_dimensions >= 2",
    "c2_edges": f"{_E} SELECT * FROM e WHERE qualifying_dimensions >= 3",
    "c2_edges_least2": f"{_E} SELECT * FROM e WHERE qualifying_dimensions >= 2",
    "a11_components": f"{_COMP} SELECT nas, lab AS component FROM lab24",
    "a27_pair_count": f"{_F} SELECT count(*) AS n_pairs FROM f a JOIN f b ON a.tradition < b.tradition",
    "c6_parallels_above": f"{_P} SELECT {_PCOLS.format(0.55)} FROM par WHERE sc >= 0.55",
    "c6_parallels_all": f"{_P} SELECT {_PCOLS.format(0.65)} FROM par",
    "c7_parallel_report": f"{_P} SELECT count(*) AS n_pairs, count(*) FILTER (WHERE sc>=0.65) AS n_above, min(parallel_score) AS min_score, round_even(quantile_cont(parallel_score,0.5),4) AS median_score, round_even(quantile_cont(parallel_score,0.9),4) AS p90_score, max(parallel_score) AS max_score FROM par",
    "a19_pairs_by_tradition": f"{_P} SELECT least(tradition_a,tradition_b)||'-'||greatest(tradition_a,tradition_b) AS pair, count(*) AS n FROM par WHERE sc>=0.55 GROUP BY 1",
    "w9_numbered_parallels": f"{_P} SELECT 'P-'||lpad(row_number() OVER (ORDER BY member_a, member_b)::VARCHAR,4,'0') AS parallel_id, member_a, member_b FROM par WHERE sc>=0.55",
    "q13_nearest": rf"""{V.VIEWS}, u AS (SELECT nas, list_transform(vector, lambda x: x::DOUBLE) AS v FROM vec),
r AS (SELECT a.nas AS query_nas, b.nas, greatest(0.0, list_cosine_similarity(a.v,b.v)) AS similarity, row_number() OVER (PARTITION BY a.nas ORDER BY greatest(0.0, list_cosine_similarity(a.v,b.v)) DESC, b.nas) AS rank
  FROM u a JOIN feat q ON q.nas=a.nas AND q.feature_id%20=0 JOIN u b ON b.nas<>a.nas) SELECT query_nas, nas, round_even(similarity,6) AS similarity, rank FROM r WHERE rank<=5""",
    "q14_composite": f"{_E} SELECT member_a, member_b, round_even(0.20*tmi_jaccard_leaf+0.20*tmi_jaccard_branch+0.25*propp_overlap+0.20*chronotope_match::DOUBLE+0.15*(1-coalesce(bakhtin_polyphony_delta,1.0)),6) AS composite FROM e WHERE qualifying_dimensions>=3",
    "f17_levels": f"{_F} SELECT nas, len(leaf) AS n_leaf, array_to_string(list_sort(branch),'|') AS branch, array_to_string(list_sort(root),'|') AS root FROM f",
}
