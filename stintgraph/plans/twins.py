"""SQL twins of the registered queries, on the same tables."""

from __future__ import annotations

from stintgraph.functions import agency
from stintgraph.functions.names import STATES
from stintgraph.operators import gates

EMPLOYMENT = """e AS (
SELECT concat('P', CAST(c.c_custkey AS VARCHAR)) AS post_person_nbr, split_part(p.p_name, ' ', 1) AS post_first_name,
  concat(split_part(p.p_name, ' ', 2), replace(p.p_brand, 'Brand#', '')) AS post_last_name,
  concat(n.n_name, CASE o.o_orderstatus WHEN 'F' THEN ' Police Department' WHEN 'O' THEN ' Sheriff Office' ELSE ' Corrections' END) AS post_agency_name,
  CASE WHEN o.o_orderstatus = 'P' THEN 'CORRECTIONS' ELSE 'POLICE' END AS post_agency_type, o.o_orderdate AS post_start_date,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE ls.max_ship END AS post_end_date, lower(n.n_name) AS state, r.r_name AS county, o.o_orderkey AS rec_ord
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON p.p_partkey = c.c_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS max_ship FROM lineitem GROUP BY l_orderkey) ls ON ls.l_orderkey = o.o_orderkey)"""
MENTIONS = """m AS (
SELECT c.c_custkey AS mention_id, concat('M', CAST(c.c_custkey AS VARCHAR)) AS mention_uid, upper(split_part(p.p_name, ' ', 1)) AS mention_first_name,
  upper(CASE WHEN c.c_custkey % 10 = 3 THEN concat(split_part(p.p_name, ' ', 2), 'x') ELSE concat(split_part(p.p_name, ' ', 2), replace(p.p_brand, 'Brand#', '')) END) AS mention_last_name,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE lower(n.n_name) END AS state,
  CASE WHEN c.c_custkey % 4 = 0 THEN concat(n.n_name, ' District Attorney') ELSE concat(n.n_name, ' Police Department') END AS mention_agency,
  CAST(1995 + c.c_custkey % 7 AS INTEGER) AS incident_year
FROM customer c JOIN part p ON p.p_partkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey)"""
ONE = "(lower(substring(e.post_first_name, 1, 2)) = lower(substring(m.mention_first_name, 1, 2)) AND lower(e.post_last_name) = lower(m.mention_last_name))"
TWO = "(lower(e.post_first_name) = lower(m.mention_first_name) AND lower(substring(e.post_last_name, 1, 2)) = lower(substring(m.mention_last_name, 1, 2)))"
NET = f"""nets AS (SELECT m.mention_id, m.mention_uid, m.mention_first_name, m.mention_last_name, m.mention_agency, m.incident_year, e.*, 1 AS net FROM m JOIN e ON e.state = m.state AND {ONE}
UNION ALL SELECT m.mention_id, m.mention_uid, m.mention_first_name, m.mention_last_name, m.mention_agency, m.incident_year, e.*, 2 AS net FROM m JOIN e ON e.state = m.state AND {TWO}),
net AS (SELECT * FROM nets QUALIFY row_number() OVER (PARTITION BY mention_id, post_person_nbr, post_start_date, post_end_date, post_agency_name, state ORDER BY net, rec_ord) = 1)"""
YEARS = "year(post_start_date) <= {y} + 1 AND coalesce(CASE WHEN year(post_end_date) >= 1950 THEN year(post_end_date) END, 9999) >= {y} - 1"
CAND = f"""typed AS (SELECT *, bool_or(upper(post_agency_type) <> 'POLICE') OVER (PARTITION BY mention_id) AS real FROM net),
cand AS (SELECT * FROM typed WHERE (NOT real OR post_agency_type = 'POLICE') AND {YEARS.format(y="incident_year")})"""
LOW = "lower(mention_first_name) || ' ' || lower(mention_last_name), lower(post_first_name) || ' ' || lower(post_last_name)"
JW = "(CASE WHEN {a} = '' AND {b} = '' THEN 0 ELSE jaro_winkler_similarity({a}, {b}) END)"
LEV = "(1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE))"
RATIO = "(least(length({a}), length({b})) / CAST(greatest(length({a}), length({b})) AS DOUBLE))"
_last = {"a": "lower(mention_last_name)", "b": "lower(post_last_name)"}
_first = {"a": "lower(mention_first_name)", "b": "lower(post_first_name)"}
_fulls = dict(zip("ab", LOW.split(", "), strict=True))
SCORE = f"round(0.45 * {JW.format(**_last)} + 0.35 * {JW.format(**_first)} + 0.20 * {LEV.format(**_fulls)}, 6)"
SCORED = f"""scored AS (SELECT *, {SCORE} AS match_probability,
  upper(mention_first_name) = upper(post_first_name) AND upper(mention_last_name) = upper(post_last_name) AS exact_name FROM {{of}})"""
BASE = f"WITH {EMPLOYMENT}, {MENTIONS}"
ALL = f"{BASE}, {NET}, {CAND}"
WITH_SCORE = f"{ALL}, {SCORED.format(of='cand')}"
FIRST_BEST = "QUALIFY row_number() OVER (PARTITION BY mention_id ORDER BY match_probability DESC, rec_ord) = 1"

SAME = """same AS (SELECT m.mention_id, count(DISTINCT e.post_person_nbr) AS n FROM m LEFT JOIN e ON (m.state IS NULL OR e.state = m.state)
  AND lower(e.post_first_name) = lower(m.mention_first_name) AND starts_with(lower(e.post_last_name), lower(m.mention_last_name)) GROUP BY m.mention_id)"""
STAGE0 = f"""common AS (SELECT upper(post_last_name) AS last_name FROM e GROUP BY 1 ORDER BY count(DISTINCT post_person_nbr) DESC, 1 LIMIT 5),
s0 AS (SELECT m.*, same.n AS same_n, m.mention_last_name IN (SELECT last_name FROM common) AS is_common FROM m JOIN same USING (mention_id)),
stage0 AS (SELECT *, CASE WHEN state IS NULL THEN '{gates.NO_STATE}' WHEN is_common THEN 'Common last name (' || mention_last_name || ') - requires manual verification'
    WHEN same_n >= 2 THEN 'Multiple persons (' || same_n || ') with same name - needs verification' ELSE '' END AS reason0,
  CASE WHEN state IS NULL THEN 'State present:fail:(none)' ELSE 'State present:pass:' || state || '|' ||
    CASE WHEN is_common THEN 'Common last name:flag:' || mention_last_name ELSE 'Common last name:pass:|Unique name in state:' || CASE WHEN same_n >= 2 THEN 'flag:' ELSE 'pass:' END || same_n || ' person(s)' END END AS gates0 FROM s0)"""
GUARDED = "ends_with(mention_agency, 'District Attorney')"
RESOLVED = f"""{ALL}, {SAME}, {STAGE0}, open AS (SELECT cand.* FROM cand JOIN stage0 USING (mention_id) WHERE reason0 = ''), {SCORED.format(of="open")},
elig AS (SELECT * FROM scored WHERE match_probability > 0.5 AND exact_name),
c AS (SELECT mention_id, count(*) AS n, count(*) FILTER (match_probability > 0.5 AND exact_name) AS k, count(DISTINCT CASE WHEN match_probability > 0.5 AND exact_name THEN post_person_nbr END) AS p FROM scored GROUP BY mention_id),
best AS (SELECT elig.* FROM elig JOIN c USING (mention_id) WHERE p < 2 {FIRST_BEST.replace("PARTITION BY mention_id", "PARTITION BY elig.mention_id")}),
v0 AS (SELECT s.mention_id, s.mention_uid, s.reason0, s.gates0, coalesce(c.n, 0) AS n, coalesce(c.k, 0) AS k, coalesce(c.p, 0) AS p, b.post_person_nbr AS person,
  b.mention_id IS NOT NULL AS asked, b.mention_id IS NOT NULL AND NOT (ends_with(s.mention_agency, 'District Attorney')) AS ok
  FROM stage0 s LEFT JOIN c USING (mention_id) LEFT JOIN best b USING (mention_id)),
v AS (SELECT *, CASE WHEN ok THEN 'auto_matched' ELSE 'review' END AS status,
  CASE WHEN reason0 <> '' THEN reason0 WHEN n = 0 THEN '{gates.NO_CANDIDATES}' WHEN k = 0 THEN '{gates.NOT_EXACT}' WHEN p >= 2 THEN '{gates.AMBIGUOUS}' WHEN ok THEN '' ELSE '{agency.GUARD_REASON}' END AS reason FROM v0),
marked AS (SELECT scored.*, coalesce(scored.post_person_nbr = b.post_person_nbr, false) AS is_best, coalesce(scored.post_person_nbr = b.post_person_nbr AND NOT {GUARDED.replace("mention_agency", "b.mention_agency")}, false) AS valid
  FROM scored LEFT JOIN best b USING (mention_id))"""
_le = " OR ".join(f"contains(lower(agency), '{w}')" for w in agency.LE)
_non = " OR ".join(f"contains(' ' || trim(lower(agency)) || ' ', '{w}')" for w in agency.NON_LE)
DOCS = """old AS (SELECT 'd/' || c_custkey AS fs_path, lower(n_name) AS state, '{"phone":"' || c_name || '"}' AS raw FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 17 <> 0),
new AS (SELECT 'd/' || c_custkey AS fs_path, lower(n_name) AS state, '{"phone":"' || c_name || CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE '' END || '"}' AS raw FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 <> 0)"""
_asked = "post_first_name ILIKE '%re%' AND post_last_name ILIKE '%11%'"
_resync = "('france', 'germany', 'china', 'japan')"


def _features() -> str:
    full = {"a": "mention_full_name", "b": "post_full_name"}
    low = {k: f"lower({v})" for k, v in full.items()}
    parts = []
    for part, ab in (("first", _first), ("last", _last), ("full", low)):
        parts += [f"round({k.format(**ab)}, 6) AS {part}_name_{n}" for n, k in (("jaro", JW), ("levenshtein", LEV), ("length_ratio", RATIO))]
    parts += [f"CAST({x} AS DOUBLE) AS {part}_name_{n}" for part in ("middle", "suffix") for n, x in (("jaro", 0), ("levenshtein", 1), ("length_ratio", 1))]
    return f"""{ALL}, f AS (SELECT *, mention_first_name || '  ' || mention_last_name || ' ' AS mention_full_name, post_first_name || '  ' || post_last_name || ' ' AS post_full_name FROM cand)
SELECT mention_uid, rec_ord, mention_full_name, post_full_name, {", ".join(parts)} FROM f"""


def _pairs(kernel: str) -> str:
    return f"{ALL}, p AS (SELECT DISTINCT lower(mention_last_name) AS a, lower(post_last_name) AS b FROM cand) SELECT a, b, round({kernel.format(a='a', b='b')}, 6) AS value FROM p"


def _states() -> str:
    rows = [(c, s) for c, s in STATES.items()] + [(" ca ", "california"), ("New York", "new york"), ("california", "california"), ("ZZ", "zz")]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in rows) + ", ('', NULL)) AS t(given, state)"


ORACLES = {
    "flagship": f"{ALL} SELECT m.mention_uid, count(cand.rec_ord) AS n_candidates, count(DISTINCT cand.post_person_nbr) AS n_persons FROM m LEFT JOIN cand USING (mention_id) GROUP BY m.mention_uid",
    "search_contains": f"{BASE} SELECT rec_ord, post_person_nbr, post_first_name, post_last_name, state FROM e WHERE {_asked}",
    "search_page": f"{BASE} SELECT rec_ord, post_agency_name FROM e WHERE post_agency_name ILIKE '%police%' ORDER BY rec_ord LIMIT 50 OFFSET 20",
    "search_summary": f"{BASE} SELECT count(*) AS n_rows, count(DISTINCT post_person_nbr) AS n_persons FROM e WHERE {_asked}",
    "count_filtered": f"{BASE} SELECT count(*) AS n FROM e WHERE {_asked}",
    "count_all": f"{BASE} SELECT count(*) AS n FROM e",
    "count_by_state": f"{BASE} SELECT state, count(*) AS n FROM e GROUP BY state",
    "normal_states": _states(),
    "officers_by_name": f"{BASE} SELECT m.mention_uid, e.rec_ord FROM m JOIN e ON e.state = m.state AND lower(e.post_first_name) = lower(m.mention_first_name) AND starts_with(lower(e.post_last_name), lower(m.mention_last_name))",
    "same_name_count": f"{BASE}, {SAME} SELECT same.mention_id, same.n FROM same JOIN m USING (mention_id) WHERE m.state IS NOT NULL",
    "name_uniqueness": f"{BASE}, u AS (SELECT DISTINCT mention_first_name AS first_name, mention_last_name AS last_name FROM m) SELECT u.first_name, u.last_name, count(DISTINCT e.post_person_nbr) AS n FROM u LEFT JOIN e ON lower(e.post_first_name) = lower(u.first_name) AND lower(e.post_last_name) = lower(u.last_name) GROUP BY 1, 2",
    "candidate_net": f"{BASE}, {NET} SELECT mention_uid, rec_ord, net FROM nets",
    "candidate_net_dedup": f"{BASE}, {NET} SELECT mention_uid, count(*) AS n, CAST(sum(rec_ord) AS BIGINT) AS ords FROM net GROUP BY mention_uid",
    "batch_candidate_meta": f"{BASE}, {NET}, k AS (SELECT m.mention_id, count(net.rec_ord) AS n FROM m LEFT JOIN net USING (mention_id) WHERE m.state IS NOT NULL GROUP BY m.mention_id) SELECT count(*) AS total_mentions, CAST(sum(n) AS BIGINT) AS total_candidates, count(*) FILTER (n > 0) AS mentions_with_candidates FROM k",
    "agency_counties": f"{BASE} SELECT DISTINCT post_agency_name AS agency, CAST(NULL AS VARCHAR) AS county FROM e",
    "date_overlap": f"{BASE} SELECT rec_ord FROM e WHERE {YEARS.format(y=1995)}",
    "county_person_filter": f"{BASE}, {NET}, x AS (SELECT *, bool_or(county = 'ASIA') OVER (PARTITION BY mention_id, post_person_nbr) AS here FROM net) SELECT mention_uid, count(*) AS n FROM x WHERE here GROUP BY mention_uid",
    "agency_type_detect": f"{ALL} SELECT mention_uid, count(*) AS n, CAST(bool_or(real) AS INTEGER) AS real_types FROM typed GROUP BY mention_uid",
    "select_candidates": f"{ALL} SELECT mention_uid, rec_ord FROM cand",
    "stage0_gates": f"{BASE}, {SAME}, {STAGE0} SELECT mention_uid, CAST(reason0 <> '' AS INTEGER) AS skip, reason0 AS reason, gates0 AS gates FROM stage0",
    "lev_norm": _pairs(LEV),
    "length_ratio": _pairs(RATIO),
    "jaro_winkler": _pairs("jaro_winkler_similarity({a}, {b})"),
    "full_name_features": _features(),
    "embedding_cosine": "SELECT x.vec_id AS a, y.vec_id AS b, round(list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1",
    "score_candidates": f"{WITH_SCORE} SELECT mention_uid, rec_ord, match_probability FROM scored",
    "threshold_filter": f"{WITH_SCORE} SELECT mention_uid, rec_ord FROM scored WHERE match_probability > 0.95",
    "exact_name_split": f"{WITH_SCORE} SELECT mention_uid, count(*) FILTER (exact_name) AS n_exact, count(*) FILTER (NOT exact_name) AS n_failed FROM scored GROUP BY mention_uid",
    "ambiguous_mentions": f"{WITH_SCORE} SELECT mention_uid, count(DISTINCT post_person_nbr) AS n_persons FROM scored WHERE exact_name GROUP BY mention_uid HAVING count(DISTINCT post_person_nbr) >= 2",
    "best_match": f"{WITH_SCORE} SELECT mention_uid, rec_ord, post_person_nbr, match_probability FROM scored {FIRST_BEST}",
    "best_person_stints": f"{WITH_SCORE}, b AS (SELECT mention_id, post_person_nbr FROM scored WHERE match_probability > 0.95 AND exact_name {FIRST_BEST}) SELECT mention_uid, scored.post_person_nbr, count(*) AS n FROM scored JOIN b USING (mention_id, post_person_nbr) GROUP BY 1, 2",
    "agency_classify": f"{BASE}, a AS (SELECT post_agency_name AS agency FROM e UNION SELECT mention_agency FROM m) SELECT agency, CAST(({_le}) AS INTEGER) AS le, CAST(NOT ({_le}) AND ({_non}) AS INTEGER) AS non_le FROM a",
    "agency_list_guard": f"""{BASE}, r AS (SELECT mention_uid, mention_agency, mention_id % 3 AS kind, CASE WHEN mention_id % 5 = 0 THEN '' WHEN mention_id % 5 = 1 THEN 'State Library' ELSE 'Springfield Police Department' END AS post,
  mention_id % 4 = 0 AS da FROM m), g AS (SELECT *, CASE kind WHEN 0 THEN mention_agency || '|' || mention_agency || '|CHP' WHEN 1 THEN mention_agency || '|County Coroner' ELSE mention_agency END AS agencies,
  da AND kind <> 0 AND post = 'Springfield Police Department' AS blocked FROM r)
SELECT mention_uid, agencies, CAST(blocked AS INTEGER) AS blocked, CASE WHEN post = '' THEN '{agency.EMPTY_POST}' WHEN blocked THEN '{agency.GUARD_REASON}' ELSE '' END AS reason FROM g""",
    "verdicts": f"""{RESOLVED} SELECT mention_uid, status, reason, CAST(p >= 2 AS INTEGER) AS ambiguous, CASE WHEN ok THEN person ELSE '' END AS post_person_nbr,
  gates0 || CASE WHEN reason0 <> '' THEN '' ELSE '|Candidates found:' || CASE WHEN n > 0 THEN 'pass:' ELSE 'fail:' END || n || ' candidate(s)' || CASE WHEN n = 0 THEN '' ELSE
    '|Exact-name match:' || CASE WHEN k > 0 THEN 'pass:' ELSE 'fail:' END || k || ' eligible candidate(s)|Not ambiguous:' || CASE WHEN p >= 2 THEN 'flag:' WHEN k > 0 THEN 'pass:' ELSE 'skip:' END || p || ' exact-name person(s)|Agency validation:' ||
    CASE WHEN NOT asked THEN 'skip:' WHEN ok THEN 'pass:' ELSE 'fail:' || reason END END END AS gates FROM v""",
    "candidate_lists": f"{RESOLVED} SELECT mention_id, CAST(count(*) AS INTEGER) AS n, first(post_person_nbr ORDER BY is_best DESC, match_probability DESC, rec_ord) AS first_person FROM marked GROUP BY mention_id",
    "gate_sections": f"""{RESOLVED}, q AS (SELECT *, CASE WHEN is_best AND valid AND exact_name AND match_probability > 0.5 THEN 0 WHEN exact_name AND match_probability > 0.5 THEN 1 WHEN match_probability > 0.5 THEN 2 ELSE 3 END AS section FROM marked)
SELECT mention_id, CAST(section AS INTEGER) AS section, CASE section {" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(gates.SECTIONS))} END AS title, count(*) AS n, string_agg(DISTINCT post_person_nbr, ',' ORDER BY post_person_nbr) AS persons FROM q GROUP BY mention_id, section""",
    "route_buckets": f"{RESOLVED} SELECT CASE WHEN ok THEN 'auto_matched' WHEN contains(reason, 'Common last name') OR contains(reason, 'Multiple persons') THEN 'early_filtered' ELSE 'review' END AS bucket, count(*) AS n FROM v GROUP BY 1",
    "batch_summary": f"{RESOLVED} SELECT count(*) AS n, count(*) FILTER (ok) AS n_matched, count(*) FILTER (NOT ok) AS n_review FROM v",
    "duplicate_rate": f"{BASE} SELECT count(*) AS n_rows, count(DISTINCT post_person_nbr) AS n_distinct, round((count(*) - count(DISTINCT post_person_nbr)) / CAST(count(*) AS DOUBLE) * 100, 6) AS rate FROM e",
    "officer_uid": f"{BASE} SELECT mention_id, sha256(mention_first_name || '|' || mention_last_name || '||' || incident_year || '.0|||' || mention_agency) AS uid FROM m",
    "recent_year": "SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN greatest(year(o_orderdate), 2018) WHEN 3 THEN 0 ELSE year(o_orderdate) END AS INTEGER) AS year FROM orders",
    "sync_plan": f"""WITH {DOCS}, k AS (SELECT state, count(*) AS n FROM new GROUP BY state)
SELECT lower(n_name) AS state, CASE WHEN n_nationkey % 5 = 0 THEN 'new state' WHEN n_nationkey % 3 = 0 THEN 'last_updated advanced' WHEN n_nationkey % 7 = 1 THEN 'row count changed' ELSE 'unchanged' END AS reason FROM nation""",
    "sync_diff": f"WITH {DOCS} SELECT coalesce(a.fs_path, b.fs_path) AS fs_path, CASE WHEN a.fs_path IS NULL THEN 'insert' WHEN b.fs_path IS NULL THEN 'delete' WHEN a.raw <> b.raw THEN 'update' ELSE 'keep' END AS action FROM old a FULL JOIN new b USING (fs_path)",
    "resync_counts": f"""WITH {DOCS} SELECT count(b.fs_path) AS pulled, count(*) FILTER (WHERE b.fs_path IS NOT NULL AND (a.fs_path IS NULL OR a.raw <> b.raw)) AS changed,
  count(*) FILTER (WHERE b.fs_path IS NULL) AS deleted FROM old a FULL JOIN new b USING (fs_path)""",
    "baseline_meta": f"WITH {DOCS} SELECT lower(n_name) AS state, '2024-01-02' AS last_updated, count(fs_path) AS row_count FROM nation LEFT JOIN new ON new.state = lower(n_name) GROUP BY 1",
    "page_after": f"WITH {DOCS} SELECT fs_path, state FROM old WHERE fs_path > 'd/5' ORDER BY fs_path LIMIT 100",
    "search_shown": f"{BASE} SELECT rec_ord, post_person_nbr FROM e WHERE {_asked} ORDER BY rec_ord LIMIT 25",
    "date_display": f"{BASE} SELECT rec_ord, coalesce(substr(CAST(post_start_date AS VARCHAR), 1, 10), '') AS start_day, coalesce(substr(CAST(post_end_date AS VARCHAR), 1, 10), '') AS end_day FROM e",
    "stream_ingest": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "seeded_sample": f"""{BASE} SELECT mention_uid FROM m ORDER BY md5(concat_ws('|', '7', CAST(mention_id AS VARCHAR), mention_uid, mention_first_name, '', mention_last_name, '', state, mention_agency, '', 'POLICE',
  CAST(incident_year AS VARCHAR))) LIMIT 100""",
    "merge_result": f"WITH {DOCS} SELECT fs_path, state, raw FROM old WHERE state NOT IN {_resync} UNION ALL SELECT fs_path, state, raw FROM new WHERE state IN {_resync}",
    "append_new": f"WITH {DOCS} SELECT fs_path, state FROM new WHERE fs_path NOT IN (SELECT fs_path FROM old)",
    "resolve_flagship": f"{RESOLVED} SELECT status, reason, count(*) AS n FROM v GROUP BY status, reason",
}
