"""Queries of scalar functions and of the structure of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import text as T
from ..operators import constellations as C
from ..operators import corpus
from ..operators import structure as S
from ..model.enums import HEDGES
from ..session import table
from . import views as V

SIGNALS = ["ПЕСНЬ", "РАССКАЗ", "THE ", "DAS LIED", "Book", "Tablet", "Canto"]


def _docs(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("run_id"), "text").filter("text is not null")


def _all_nas(s, d):
    return table(s, d, "fragments").select(F.explode(F.array("nas", "parent_nas")).alias("nas")).filter("nas is not null").distinct()


def _bodies(s, d):
    return V.content(s, d).filter("body is not null")


def _scan(s, d):
    return S.scan_structure(_docs(s, d), SIGNALS)


def _paged(s, d):
    """Bodies with page marks and bare numbers put between their paragraphs."""
    return _bodies(s, d).select("content_id", F.concat(F.lit("[PAGE 1]\n"), F.regexp_replace("body", "\n\n", "\n\n 17 \n\n\n[PAGE 2]\n"), F.lit("\n12345\n")).alias("body"))


def _passages(s, d):
    """Openings taken from inside the documents, found again."""
    docs = _docs(s, d).filter("length(text) > 200").select("run_id", F.col("text").alias("chunk"))
    seg = docs.select("run_id", F.explode(F.array(F.struct(F.lit(1).alias("seq"), F.substring("chunk", 101, 90).alias("passage_opening")), F.struct(F.lit(2).alias("seq"), F.substring("chunk", 11, 50).alias("passage_opening")), F.struct(F.lit(3).alias("seq"), F.lit("nowhere to be found").alias("passage_opening")))).alias("x")).select("run_id", "x.*").withColumn("nas", F.concat(F.lit("s-"), "seq"))
    return S.passages(seg, docs, ["run_id"]).select("run_id", "seq", "pos", "passage_no", F.length("passage_text").alias("n"), F.md5("passage_text").alias("h"))


def _audit(s, d):
    a = V.addresses(s, d)
    derived = a.filter("confirmed_by <> 'reviewer-3'").select("ordinal", F.when(F.col("granularity") == "sub-episode", F.concat("nas", F.lit("-x"))).otherwise(F.col("nas")).alias("nas"))
    return S.audit(a.select("ordinal", "nas"), derived)


def _align(s, d):
    """Function sequences of the pairs that are edges, aligned."""
    f = V.features(s, d)
    code = F.transform("propp_codes", lambda x: F.coalesce(A.canon_propp(x), F.lit("")))  # gaps stay, as wildcards
    p = C.edges(C.features(f).join(f.select("nas", code.alias("sequence")), "nas"), keep=("sequence",))
    return p.select("member_a", "member_b", F.bround(S.align_codes("sequence_a", "sequence_b"), 6).alias("score"))


QUERIES = {
    "f1_f3_addresses": lambda s, d: _all_nas(s, d).select("nas", A.nas_valid(F.col("nas")).alias("valid"), A.nas_part(F.col("nas"), 3).alias("tradition"), A.nas_part(F.col("nas"), 4).alias("division"), A.nas_part(F.col("nas"), 5).alias("episode"), A.nas_depth(F.col("nas")).alias("depth"), A.nas_parent(F.col("nas")).alias("parent")),
    "f4_canonical": lambda s, d: _all_nas(s, d).select("nas", A.canon_nas(F.col("nas")).alias("canonical")),
    "f5_slugs": lambda s, d: V.annotations(s, d).filter("label is not null").select("label").distinct().select("label", T.slugify(F.col("label")).alias("slug")),
    "f6_f9_tmi": lambda s, d: V.annotations(s, d).filter("track = 'tmi'").select("raw_code", "code").distinct().select("raw_code", "code", A.tmi_branch(F.col("code")).alias("branch"), A.tmi_root(F.col("code")).alias("root"), F.coalesce(F.col("raw_code").rlike(A.TMI_VALID), F.lit(False)).alias("valid")),
    "f10_clean_text": lambda s, d: _paged(s, d).select("content_id", F.md5(T.clean_translated(F.col("body"))).alias("h")),
    "f11_f12_citations": lambda s, d: _bodies(s, d).select("content_id", F.array_join(T.citations(F.col("body")), "|").alias("cites"), F.array_join(T.clean_citations(T.citations(F.col("body")), F.col("nas")), "|").alias("clean")),
    "f13_f14_grounding": lambda s, d: corpus.grounding(_bodies(s, d).filter("layer = 'surface'")),
    "f15_hashes": lambda s, d: _bodies(s, d).select("content_id", F.sha2("body", 256).alias("content_hash")),
    "f29_f30_bodies": lambda s, d: _bodies(s, d).select("content_id", T.complete(F.col("body")).alias("complete"), T.hedged(F.col("body")).alias("hedged")),
    "f31_notes": lambda s, d: _bodies(s, d).select("content_id", F.md5(T.cut_note(F.col("body"))).alias("h")),
    "s2_words": lambda s, d: _docs(s, d).select("run_id", T.word_count(F.col("text")).alias("n_words"), F.length("text").alias("n_chars")),
    "w7_lines": lambda s, d: S.lines(_docs(s, d)).groupBy("run_id").agg(F.count("*").alias("n_lines"), F.max("char_end").alias("last_end"), F.sum("char_start").alias("starts")),
    "c8_structure": _scan,
    "w4_toc": lambda s, d: S.detect_toc(_docs(s, d), SIGNALS),
    "f33_slices": lambda s, d: _scan(s, d).join(_docs(s, d), "run_id").select("run_id", "char_start", F.md5(S.slice_text(F.col("text"), F.col("char_start"), F.col("char_end"))).alias("h")),
    "w5_passages": _passages,
    "w6_chunks": lambda s, d: S.chunks(_docs(s, d), budget=1000, overlap=100, slack=500).select("run_id", "chunk_index", "char_start", F.length("chunk").alias("n")),
    "c12_audit": _audit,
    "q15_alignment": _align,
}

_N = "(SELECT DISTINCT unnest([nas, parent_nas]) AS nas FROM fragments) WHERE nas IS NOT NULL"
_B = f"{V.VIEWS}, bod AS (SELECT * FROM cont WHERE body IS NOT NULL)"
_SLUG = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}),'^\s+|\s+$','','g'),'[^a-z0-9\s-]',' ','g'),'[\s_]+','-','g'),'-+','-','g'),'^-+|-+$','','g')"
_PAGED = "'[PAGE 1]'||chr(10)||replace(body, chr(10)||chr(10), chr(10)||chr(10)||' 17 '||chr(10)||chr(10)||chr(10)||'[PAGE 2]'||chr(10))||chr(10)||'12345'||chr(10)"
_CITES = r"regexp_extract_all(body, '\[NAS: ([^\]]+)\]', 1)"
_MARK = r"regexp_replace(regexp_replace(body,'\[NAS: [^\]]+\]',chr(1)||'cited'||chr(1),'g'),'nms://[a-z0-9-]+(/[a-z0-9-]+){1,3}',chr(1)||'cited'||chr(1),'g')"
_LINES = """doc AS (SELECT doc_id AS run_id, text FROM documents WHERE text IS NOT NULL),
parts AS (SELECT run_id, length(text) AS n, string_split(text, chr(10)) AS p FROM doc),
ex AS (SELECT run_id, n, len(p) AS k, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS line_no FROM parts),
sz AS (SELECT *, length(line) + CASE WHEN line_no < k - 1 THEN 1 ELSE 0 END AS size FROM ex),
ln AS (SELECT run_id, line_no, line, sum(size) OVER (PARTITION BY run_id ORDER BY line_no) AS char_end, size FROM sz),
lines AS (SELECT run_id, line_no, regexp_replace(line, chr(13)||'$', '') AS line, (char_end - size)::INT AS char_start, char_end::INT AS char_end FROM ln WHERE size > 0)"""
_HIT = "(" + " OR ".join(f"contains(regexp_replace(line,'^\\s+|\\s+$','','g'), '{p}')" for p in SIGNALS) + ")"
_TOC = rf"""win AS (SELECT run_id, least(floor(length(text)*0.2),10000)::INT AS scan_end, text FROM doc),
th AS (SELECT l.run_id, l.char_start, least(l.char_end, scan_end) AS char_end, scan_end, w.text FROM lines l JOIN win w USING (run_id) WHERE l.char_start < scan_end AND regexp_replace(line,'\s+','','g')<>''
  AND ({" OR ".join(f"contains(regexp_replace(substring(line, 1, scan_end - l.char_start),'^{chr(92)}s+|{chr(92)}s+$','','g'), '{p}')" for p in SIGNALS)})),
tg AS (SELECT *, length(regexp_replace(substring(text, char_end+1, lead(char_start) OVER (PARTITION BY run_id ORDER BY char_start) - char_end),'^\s+|\s+$','','g')) AS gap FROM th),
tt AS (SELECT run_id, count(*) >= 5 AND coalesce(avg(gap),0) < 150 AS t, any_value(scan_end) AS e FROM tg GROUP BY 1),
toc AS (SELECT doc.run_id, coalesce(t,false) AS toc_detected, CASE WHEN t THEN e ELSE 0 END AS toc_char_end FROM doc LEFT JOIN tt USING (run_id))"""
_SCAN = rf"""WITH {_LINES}, {_TOC},
hd AS (SELECT l.run_id, char_start, regexp_replace(line,'^\s+|\s+$','','g') AS heading_text, {_SLUG.format("line")} AS slug_candidate, toc_detected, toc_char_end FROM lines l JOIN toc USING (run_id) WHERE regexp_replace(line,'\s+','','g')<>'' AND {_HIT} AND char_start >= toc_char_end),
fs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, slug_candidate ORDER BY char_start) AS rn FROM hd WHERE slug_candidate<>'') WHERE rn=1),
scan AS (SELECT run_id, heading_text, slug_candidate, char_start, coalesce(lead(char_start) OVER (PARTITION BY run_id ORDER BY char_start), length(text))::INT AS char_end, 0.9::DOUBLE AS confidence, toc_detected, toc_char_end FROM fs JOIN doc USING (run_id))"""
ORACLES = {
    "w5_passages": r"""WITH d AS (SELECT doc_id AS run_id, text AS chunk FROM documents WHERE length(text) > 200), s AS (
SELECT run_id, chunk, 1 AS seq, substring(chunk,101,90) AS o FROM d UNION ALL SELECT run_id, chunk, 2, substring(chunk,11,50) FROM d UNION ALL SELECT run_id, chunk, 3, 'nowhere to be found' FROM d),
t AS (SELECT run_id, chunk, seq, regexp_replace(o,'^\s+|\s+$','','g') AS o FROM s),
p AS (SELECT *, CASE WHEN o = '' THEN NULL ELSE coalesce(nullif(strpos(chunk,o[1:80]),0), nullif(strpos(chunk,o[1:60]),0), nullif(strpos(chunk,o[1:40]),0), nullif(strpos(chunk,o[1:20]),0)) END AS pos FROM t),
x AS (SELECT *, row_number() OVER w AS passage_no, coalesce(lead(pos) OVER w, length(chunk)+1) AS nx FROM p WINDOW w AS (PARTITION BY run_id ORDER BY pos NULLS LAST, seq)),
y AS (SELECT *, CASE WHEN pos IS NULL THEN '' ELSE regexp_replace(substring(chunk, pos, greatest(nx-pos,0)),'^\s+|\s+$','','g') END AS passage FROM x)
SELECT run_id, seq, pos, passage_no, length(passage) AS n, md5(passage) AS h FROM y""",
    "f1_f3_addresses": f"SELECT nas, regexp_full_match(nas,'nms://[a-z0-9-]+(/[a-z0-9-]+){{1,3}}') AS valid, string_split(nas,'/')[3] AS tradition, string_split(nas,'/')[4] AS division, string_split(nas,'/')[5] AS episode, len(string_split(nas,'/'))-2 AS depth, array_to_string(string_split(nas,'/')[1:5],'/') AS parent FROM {_N}",
    "f4_canonical": f"SELECT nas, {V.NAS.format('nas')} AS canonical FROM {_N}",
    "f5_slugs": f"{V.VIEWS} SELECT DISTINCT label, {_SLUG.format('label')} AS slug FROM ann WHERE label IS NOT NULL",
    "f6_f9_tmi": rf"{V.VIEWS} SELECT DISTINCT raw_code, code, CASE WHEN regexp_matches(code,'^TMI-[A-Z]+\d+') THEN regexp_extract(code,'^TMI-([A-Z]+)(\d+)',1)||(regexp_extract(code,'^TMI-([A-Z]+)(\d+)',2)::BIGINT//100*100) END AS branch, nullif(regexp_extract(code,'^TMI-([A-Z]+)(\d+)',1),'') AS root, coalesce(regexp_full_match(raw_code,'TMI-[A-Z]\d[\d.]*'),false) AS valid FROM ann WHERE track='tmi'",
    "f10_clean_text": rf"{_B} SELECT content_id, md5(regexp_replace(regexp_replace(array_to_string(list_filter(string_split({_PAGED},chr(10)), lambda x: NOT regexp_full_match(regexp_replace(x,'^\s+|\s+$','','g'),'\[PAGE \d+\]|\d{{1,5}}')),chr(10)),'\n{{3,}}',chr(10)||chr(10),'g'),'^\s+|\s+$','','g')) AS h FROM bod",
    "f11_f12_citations": rf"{_B}, c AS (SELECT content_id, nas, {_CITES} AS a FROM bod) SELECT content_id, array_to_string(a,'|') AS cites, coalesce(array_to_string(list_filter(a, lambda x, i: x<>nas AND list_position(a,x)=i),'|'),'') AS clean FROM c",
    "f13_f14_grounding": rf"{_B}, m AS (SELECT content_id, regexp_extract_all({_MARK},'[A-ZА-ЯЁ][^.!?]*[.!?]') AS s FROM bod WHERE layer='surface') SELECT content_id, len(s) AS n_sentences, len(list_filter(s, lambda x: NOT contains(x,chr(1)||'cited'||chr(1)))) AS n_uncited, len(s)=0 OR len(list_filter(s, lambda x: NOT contains(x,chr(1)||'cited'||chr(1)))) <= 0.3*len(s) AS grounded FROM m",
    "f15_hashes": f"{_B} SELECT content_id, sha256(body) AS content_hash FROM bod",
    "f29_f30_bodies": rf"{_B} SELECT content_id, regexp_matches(regexp_replace(body,'\s+$',''), '[\].!?»" + "\"''" + rf"]$') AS complete, regexp_matches(lower(regexp_replace(body,'\[NAS:[^\]]*\]','','g')),'{'|'.join(HEDGES)}') AS hedged FROM bod",
    "f31_notes": f"{_B} SELECT content_id, md5(CASE WHEN length(body)>800 THEN substring(body,1,797)||'…' ELSE body END) AS h FROM bod",
    "s2_words": r"SELECT doc_id AS run_id, len(list_filter(regexp_split_to_array(text,'\s+'), lambda x: x<>'')) AS n_words, length(text) AS n_chars FROM documents WHERE text IS NOT NULL",
    "w7_lines": f"WITH {_LINES} SELECT run_id, count(*) AS n_lines, max(char_end) AS last_end, sum(char_start)::BIGINT AS starts FROM lines GROUP BY 1",
    "c8_structure": f"{_SCAN} SELECT * FROM scan",
    "w4_toc": f"WITH {_LINES}, {_TOC} SELECT * FROM toc",
    "f33_slices": f"{_SCAN} SELECT run_id, char_start, md5(substring(text, char_start+1, least(char_end-char_start,4000))) AS h FROM scan JOIN doc USING (run_id)",
    "c12_audit": rf"""{V.VIEWS}, der AS (SELECT ordinal, CASE WHEN granularity='sub-episode' THEN nas||'-x' ELSE nas END AS nas FROM addr WHERE confirmed_by<>'reviewer-3'),
pc AS (SELECT string_split(nas,'/')[4] AS division, row_number() OVER (PARTITION BY string_split(nas,'/')[4] ORDER BY ordinal) AS place, nas AS c FROM addr WHERE len(string_split(nas,'/'))>=5),
pd AS (SELECT string_split(nas,'/')[4] AS division, row_number() OVER (PARTITION BY string_split(nas,'/')[4] ORDER BY ordinal) AS place, nas AS e FROM der WHERE len(string_split(nas,'/'))>=5),
pr AS (SELECT c, e FROM pc JOIN pd USING (division, place) WHERE c<>e)
SELECT 'slug_divergence' AS type, c AS confirmed_nas, e AS derived_nas FROM pr UNION ALL SELECT DISTINCT 'missing_in_source', nas, NULL FROM addr WHERE nas NOT IN (SELECT nas FROM der) AND nas NOT IN (SELECT c FROM pr)
UNION ALL SELECT DISTINCT 'new_in_source', NULL, nas FROM der WHERE nas NOT IN (SELECT nas FROM addr) AND nas NOT IN (SELECT e FROM pr)""",
}
