"""The same queries as plain SQL for DuckDB, assembled from named table expressions."""

from __future__ import annotations

from claimweave.operators.quality import TEST_KEY
from claimweave.plans import checks, clinical
from claimweave.plans.graph import EVIDENCE
from claimweave.plans.resolve import ADDRESS_LIKENESS, NAME_LIKENESS
from claimweave.plans.queries import (ALL_MEMBERS, ARRIVALS, BAD_FEEDS, DIMENSION_MEMBERS,
                                        LATE_BY_HOURS, _missing_column)
from claimweave.plans.reports import CUBE, CUBE_GRAINS
from claimweave.plans.rules import RULES
from claimweave.sources.layout import LINEAGE, OVERDUE_BUCKETS, SOURCES
from claimweave.sources.samples import EXTERNAL_SQL, INPUT_TABLES, PAYERS, SOURCE_SQL

# name -> (SQL, names it reads)
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def part(name: str, reads: str, sql: str) -> None:
    PARTS[name] = (sql.strip(), tuple(reads.split()))


def query(sql: str, reads: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in PARTS[name][1]:
            if needed != name:
                visit(needed)
        order.append(name)

    for name in reads.split():
        visit(name)
    # a recursive expression reads itself and cannot be forced to materialise
    bodies = [
        f"{n} AS {'' if n in PARTS[n][1] else 'MATERIALIZED '}(\n{PARTS[n][0]}\n)" for n in order]
    return ("WITH RECURSIVE " + ",\n".join(bodies) + "\n" if bodies else "") + sql.strip()


def _inputs() -> dict[str, str]:
    return {t: t for t in INPUT_TABLES}


def _value(name: str, rule: str, *args) -> str:
    t = f"TRIM({name})"
    quoted = ", ".join(f"'{v}'" for v in args[0]) if rule.startswith("one_of") else ""
    return {
        "text": lambda: t, "upper": lambda: f"UPPER({t})", "lower": lambda: f"LOWER({t})",
        "title": lambda: f"COALESCE(UPPER({t}[1]) || LOWER({t}[2:]), '')",
        "digits": lambda: f"REGEXP_REPLACE({t}, '[^0-9]', '', 'g')",
        "prefix": lambda: f"LEFT({t}, {args[0]})",
        "npi": lambda: f"CASE WHEN REGEXP_FULL_MATCH({t}, '[0-9]{{10}}') THEN {t} END",
        "one_of": lambda: f"CASE WHEN LOWER({t}) IN ({quoted}) THEN LOWER({t}) END",
        "one_of_exact": lambda: f"CASE WHEN {t} IN ({quoted}) THEN {t} END",
        "one_of_or": lambda: f"CASE WHEN UPPER({t}) IN ({quoted}) THEN UPPER({t}) ELSE '{args[1]}' END",
        "date": lambda: f"TRY_CAST({name} AS DATE)",
        "timestamp": lambda: f"TRY_CAST({name} AS TIMESTAMP)",
        "int": lambda: f"TRY_CAST({name} AS INTEGER)",
        "decimal": lambda: f"TRY_CAST({name} AS DECIMAL({args[0]},{args[-1]}))",
        "bool": lambda: f"TRY_CAST({name} AS BOOLEAN)",
    }[rule]()


def _key(name: str, rule: str) -> str:
    if rule in ("upper", "one_of_or"):
        return f"UPPER(TRIM({name}))"
    if rule in ("lower", "one_of"):
        return f"LOWER(TRIM({name}))"
    return f"TRIM({name})"


def _cleaned(source, raw_key: bool = False) -> str:
    keys = ", ".join(k if raw_key else _key(k, source.rule(k)[0]) for k in source.key)
    values = ",\n  ".join(f"{_value(*f)} AS {f[0]}" for f in source.fields)
    return f"""
SELECT {values}, {', '.join(LINEAGE)}
FROM (SELECT * FROM landed_{source.name}
      QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY _ingested_at DESC, _row_hash) = 1)"""


for _s in SOURCES.values():
    _hash = ", ".join([f"COALESCE({c}, 'nan')" for c in _s.columns]
                      + [f"'{_s.system}'", f"'{_s.file}'"])
    part(f"landed_{_s.name}", "", f"""
SELECT {', '.join(_s.columns)}, CAST(_load_day AS TIMESTAMP) AS _ingested_at,
  '{_s.system}' AS _source_system, '{_s.file}' AS _source_file,
  MD5(CONCAT_WS('|', {_hash})) AS _row_hash
FROM ({SOURCE_SQL[_s.name].format(**_inputs())})""")
    part(_s.name, f"landed_{_s.name}", _cleaned(_s))

# ---- linkage

_PLACE = "address_line1, city, state, zip"
part("patient_spine", "emr_patient rcm_patient_account referral_order", f"""
SELECT 'emr' AS source_system, emr_patient_id AS source_patient_key, mrn, ssn_last4, first_name,
  last_name, dob, phone, email, {_PLACE}, CAST(NULL AS VARCHAR) AS emr_patient_id_link
FROM emr_patient
UNION ALL
SELECT 'rcm', rcm_account_id, NULL, NULL, patient_first_name, patient_last_name, dob, phone, NULL,
  {_PLACE}, emr_patient_id FROM rcm_patient_account
UNION ALL
SELECT 'referral', referral_order_id, NULL, NULL, patient_first_name, patient_last_name, dob,
  phone, email, {_PLACE}, NULL FROM referral_order""")
part("nodes", "patient_spine",
     "SELECT *, source_system || '::' || source_patient_key AS node FROM patient_spine")

_RULE_ON = {
    "id_link": "y.emr_patient_id_link = x.source_patient_key"
               " AND y.source_system = 'rcm' AND x.source_system = 'emr'",
    "mrn": "x.mrn = y.mrn AND x.node < y.node",
    "ssn_dob": "x.ssn_last4 = y.ssn_last4 AND x.dob = y.dob AND x.node < y.node",
    "email_dob": "x.email = y.email AND x.dob = y.dob AND x.email <> ''"
                 " AND x.source_system < y.source_system",
    "phone_dob": "x.phone = y.phone AND x.dob = y.dob AND x.phone <> ''"
                 " AND x.source_system < y.source_system",
    "phone_lastname": "x.phone = y.phone AND LOWER(x.last_name) = LOWER(y.last_name)"
                      " AND x.phone <> '' AND x.source_system < y.source_system",
}
_RULE_NAMES = [r.name.removeprefix("deterministic_") for r in RULES]
for _i, _n in enumerate(_RULE_NAMES):
    part(f"rule_{_n}", "nodes", f"""
SELECT x.node AS node_a, y.node AS node_b, {_i} AS rule_rank,
  CAST({RULES[_i].confidence} AS DECIMAL(4,3)) AS confidence, '{RULES[_i].name}' AS match_method
FROM nodes x JOIN nodes y ON {_RULE_ON[_n]}""")
part("rule_hits", " ".join(f"rule_{n}" for n in _RULE_NAMES),
     "\nUNION ALL\n".join(f"SELECT * FROM rule_{n}" for n in _RULE_NAMES))
part("exact_pairs", "rule_hits", """
SELECT node_a, node_b, MIN(rule_rank) AS rule_rank, ARG_MIN(confidence, rule_rank) AS confidence,
  ARG_MIN(match_method, rule_rank) AS match_method
FROM rule_hits GROUP BY node_a, node_b""")

part("block_pairs", "nodes", """
SELECT x.node AS node_a, y.node AS node_b FROM nodes x JOIN nodes y
  ON LEFT(LOWER(x.last_name), 3) = LEFT(LOWER(y.last_name), 3) AND x.source_system < y.source_system
UNION
SELECT x.node, y.node FROM (SELECT node, source_system, UNNEST([-1, 0, 1]) + YEAR(dob) AS birth_year
                            FROM nodes WHERE dob IS NOT NULL) x
  JOIN nodes y ON x.birth_year = YEAR(y.dob) AND x.source_system < y.source_system
UNION
SELECT x.node, y.node FROM nodes x JOIN nodes y
  ON x.phone = y.phone AND x.phone <> '' AND x.source_system < y.source_system
UNION
SELECT x.node, y.node FROM nodes x JOIN nodes y
  ON x.zip = y.zip AND x.zip <> '' AND x.source_system < y.source_system""")
part("scores", "block_pairs nodes", """
SELECT p.node_a, p.node_b,
  CASE WHEN x.last_name IS NULL OR y.last_name IS NULL THEN 0.0
       ELSE JARO_WINKLER_SIMILARITY(LOWER(x.last_name), LOWER(y.last_name)) END AS ln,
  CASE WHEN x.first_name IS NULL OR y.first_name IS NULL THEN 0.0
       ELSE JARO_WINKLER_SIMILARITY(LOWER(x.first_name), LOWER(y.first_name)) END AS fn,
  CASE WHEN x.dob IS NULL OR y.dob IS NULL THEN 0.0
       WHEN x.dob = y.dob THEN 1.0
       WHEN ABS(x.dob - y.dob) <= 2 THEN 0.9
       WHEN STRFTIME(x.dob, '%m%d') = STRFTIME(y.dob, '%m%d') AND ABS(YEAR(x.dob) - YEAR(y.dob)) = 1
         THEN 0.6
       WHEN STRFTIME(x.dob, '%Y%m%d') = STRFTIME(y.dob, '%Y%d%m') THEN 0.5
       ELSE 0.0 END AS bd,
  CASE WHEN x.phone <> '' AND x.phone = y.phone THEN 1.0 ELSE 0.0 END AS ph,
  CASE WHEN x.zip IS NULL OR x.zip = '' OR y.zip IS NULL OR x.zip <> y.zip THEN 0.0
       WHEN LOWER(COALESCE(x.city, '')) <> LOWER(COALESCE(y.city, '')) THEN 0.5
       WHEN LOWER(x.address_line1) = LOWER(y.address_line1) THEN 1.0
       ELSE 0.8 END AS ad,
  CASE WHEN x.email <> '' AND x.email = y.email THEN 1.0 ELSE 0.0 END AS em
FROM block_pairs p JOIN nodes x ON x.node = p.node_a JOIN nodes y ON y.node = p.node_b""")
part("likely_pairs", "scores", """
SELECT *, CAST(ROUND(ln * 0.20 + fn * 0.15 + bd * 0.25 + ph * 0.20 + ad * 0.10 + em * 0.10, 3)
               AS DECIMAL(4,3)) AS confidence
FROM scores
WHERE ln * 0.20 + fn * 0.15 + bd * 0.25 + ph * 0.20 + ad * 0.10 + em * 0.10 > 0.64""")
part("scored_pairs", "likely_pairs", "SELECT * FROM likely_pairs WHERE confidence >= 0.70")

part("final_pairs", "exact_pairs scored_pairs", """
SELECT node_a, node_b, confidence, rule_rank, match_method FROM exact_pairs
UNION ALL
SELECT node_a, node_b, confidence, 99, 'probabilistic' FROM scored_pairs""")
part("adjacent", "final_pairs", """
SELECT node_a AS node, node_b AS other FROM final_pairs
UNION SELECT node_b, node_a FROM final_pairs""")
part("reached", "reached adjacent nodes", """
SELECT node, node AS label FROM nodes
UNION
SELECT a.other, r.label FROM reached r JOIN adjacent a ON a.node = r.node WHERE r.label < a.other""")
part("labels", "reached", "SELECT node, MIN(label) AS cluster_id FROM reached GROUP BY node")
part("pass_0", "nodes", "SELECT node, node AS cluster_id FROM nodes")
for _i in range(1, 5):
    part(f"pass_{_i}", f"pass_{_i - 1} adjacent", f"""
SELECT node, MIN(cluster_id) AS cluster_id FROM (
  SELECT node, cluster_id FROM pass_{_i - 1}
  UNION ALL
  SELECT a.other, p.cluster_id FROM pass_{_i - 1} p JOIN adjacent a ON a.node = p.node)
GROUP BY node""")
part("best_match", "final_pairs", """
SELECT node, confidence, match_method FROM (
  SELECT node_a AS node, * FROM final_pairs UNION ALL SELECT node_b, * FROM final_pairs)
QUALIFY ROW_NUMBER() OVER (PARTITION BY node
                           ORDER BY confidence DESC, rule_rank, match_method) = 1""")


def _final(labels: str) -> str:
    return f"""
SELECT n.source_system, n.source_patient_key,
  'PAT-' || LPAD(CAST(DENSE_RANK() OVER (ORDER BY l.cluster_id) AS VARCHAR), 6, '0') AS patient_id,
  l.cluster_id, CAST(COALESCE(b.confidence, 1.000) AS DECIMAL(4,3)) AS match_confidence,
  COALESCE(b.match_method, 'unmatched_singleton') AS match_method
FROM nodes n JOIN {labels} l USING (node) LEFT JOIN best_match b USING (node)"""


part("final_match", "nodes labels best_match", _final("labels"))
part("final_match_4", "nodes pass_4 best_match", _final("pass_4"))
part("patient_source_xref", "final_match", """
SELECT patient_id, source_system, source_patient_key, match_confidence, match_method
FROM final_match""")

_MEMBER_COLUMNS = [(d, t, c) for d, columns in ALL_MEMBERS.items() for t, c in columns]
part("all_members", " ".join(sorted({f"landed_{t}" for _, t, _ in _MEMBER_COLUMNS})),
     "\nUNION\n".join(
         f"SELECT '{d}' AS dimension, {c} AS member, CAST(_ingested_at AS DATE) AS load_day"
         f" FROM landed_{t} WHERE {c} IS NOT NULL" for d, t, c in _MEMBER_COLUMNS))
part("member_loads", "all_members", """
SELECT dimension, load_day, DENSE_RANK() OVER (PARTITION BY dimension ORDER BY load_day) AS nth
FROM (SELECT DISTINCT dimension, load_day FROM all_members)""")
part("cube_rows", "fact_receivable", """
SELECT r.*, STRFTIME(snapshot_date, '%Y-%m') AS month,
  MAX(snapshot_date) OVER (PARTITION BY claim_id, STRFTIME(snapshot_date, '%Y-%m')) AS last_in_month,
  MAX(snapshot_date) OVER (PARTITION BY claim_id) AS last_of_all
FROM fact_receivable r""")
part("arrivals", "", f"""
SELECT e.*, DATE_TRUNC('hour', ts) AS hour, CAST(LEAST(
    FLOOR((FLOOR(EPOCH(ts)) - lo) * {ARRIVALS} / (hi - lo + 1))
    + CASE WHEN event_id % 11 = 0 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END,
    {ARRIVALS - 1}) AS INTEGER) AS batch
FROM events e, (SELECT FLOOR(EPOCH(MIN(ts))) AS lo, FLOOR(EPOCH(MAX(ts))) AS hi FROM events)""")
# what a batch drops: rows of windows that had ended by the watermark of the batches before
part("watermarks", "arrivals", f"""
SELECT b.batch, MAX(a.ts) - INTERVAL {LATE_BY_HOURS} HOUR AS passed
FROM (SELECT UNNEST(RANGE({ARRIVALS})) AS batch) b LEFT JOIN arrivals a ON a.batch < b.batch
GROUP BY 1""")
part("curve_near", "exact_pairs likely_pairs", """
SELECT t.threshold, p.node_a AS node, p.node_b AS other
FROM (SELECT node_a, node_b, confidence FROM exact_pairs
      UNION ALL SELECT node_a, node_b, confidence FROM likely_pairs WHERE confidence >= 0.65) p
JOIN (SELECT CAST(UNNEST(RANGE(65, 101, 5)) / 100.0 AS DECIMAL(4,3)) AS threshold) t
  ON p.confidence >= t.threshold
UNION
SELECT t.threshold, p.node_b, p.node_a
FROM (SELECT node_a, node_b, confidence FROM exact_pairs
      UNION ALL SELECT node_a, node_b, confidence FROM likely_pairs WHERE confidence >= 0.65) p
JOIN (SELECT CAST(UNNEST(RANGE(65, 101, 5)) / 100.0 AS DECIMAL(4,3)) AS threshold) t
  ON p.confidence >= t.threshold""")
part("curve_reached", "curve_reached curve_near", """
SELECT DISTINCT threshold, node, node AS label FROM curve_near
UNION
SELECT a.threshold, a.other, r.label FROM curve_reached r
JOIN curve_near a ON a.node = r.node AND a.threshold = r.threshold WHERE r.label < a.other""")
part("curve_judged", "curve_reached truth", """
SELECT threshold, cluster, j.truth FROM (
  SELECT threshold, node, MIN(label) AS cluster FROM curve_reached GROUP BY 1, 2) c
JOIN truth j ON j.node = c.node""")
part("node_days", "emr_patient rcm_patient_account referral_order", """
SELECT 'emr::' || emr_patient_id AS node, CAST(_ingested_at AS DATE) AS load_day FROM emr_patient
UNION ALL SELECT 'rcm::' || rcm_account_id, CAST(_ingested_at AS DATE) FROM rcm_patient_account
UNION ALL SELECT 'referral::' || referral_order_id, CAST(_ingested_at AS DATE) FROM referral_order""")
part("day_pairs", "final_pairs node_days", """
SELECT d.day, p.* FROM final_pairs p
JOIN node_days x ON x.node = p.node_a JOIN node_days y ON y.node = p.node_b
JOIN (SELECT DISTINCT load_day AS day FROM node_days) d
  ON x.load_day <= d.day AND y.load_day <= d.day""")
part("day_near", "day_pairs", """
SELECT day, node_a AS node, node_b AS other FROM day_pairs
UNION SELECT day, node_b, node_a FROM day_pairs""")
part("day_reached", "day_reached day_near node_days", """
SELECT d.day, n.node, n.node AS label
FROM node_days n JOIN (SELECT DISTINCT load_day AS day FROM node_days) d ON n.load_day <= d.day
UNION
SELECT a.day, a.other, r.label FROM day_reached r
JOIN day_near a ON a.node = r.node AND a.day = r.day WHERE r.label < a.other""")
part("day_best", "day_pairs", """
SELECT day, node, confidence, match_method FROM (
  SELECT node_a AS node, * FROM day_pairs UNION ALL SELECT node_b, * FROM day_pairs)
QUALIFY ROW_NUMBER() OVER (PARTITION BY day, node
                           ORDER BY confidence DESC, rule_rank, match_method) = 1""")
part("day_match", "day_reached day_best", """
SELECT l.day, l.node, l.cluster_id,
  CAST(COALESCE(b.confidence, 1.000) AS DECIMAL(4,3)) AS match_confidence,
  COALESCE(b.match_method, 'unmatched_singleton') AS match_method
FROM (SELECT day, node, MIN(label) AS cluster_id FROM day_reached GROUP BY 1, 2) l
LEFT JOIN day_best b USING (day, node)""")
part("xref_history", "day_match", """
SELECT SPLIT_PART(node, '::', 1) AS source_system, SUBSTRING(node, STRPOS(node, '::') + 2)
    AS source_patient_key, 'PAT-' || MD5(cluster_id) AS patient_id, cluster_id, match_confidence,
  match_method, day AS effective_from,
  LEAD(day) OVER (PARTITION BY node ORDER BY day) AS effective_to
FROM (SELECT *, LAG(ROW(cluster_id, match_confidence, match_method))
        OVER (PARTITION BY node ORDER BY day) AS before FROM day_match)
WHERE before IS DISTINCT FROM ROW(cluster_id, match_confidence, match_method)""")

_FIELDS = ("first_name", "last_name", "dob", "phone", "email", "address_line1", "city", "state",
           "zip")


def _best(people: str) -> str:
    picks = []
    for f in _FIELDS:
        systems = ("emr", "referral") if f == "email" else ("emr", "rcm", "referral")
        tops = ", ".join(f"MAX({f}) FILTER (source_system = '{s}')" for s in systems)
        picks.append(f"COALESCE({tops}) AS best_{f}")
    return f"SELECT patient_id, {', '.join(picks)} FROM {people} GROUP BY patient_id"


part("patient_records", "final_match patient_spine", """
SELECT f.patient_id, s.* FROM final_match f
JOIN patient_spine s USING (source_system, source_patient_key)""")
part("dim_patient", "patient_records", _best("patient_records"))
_gaps = " + ".join(f"CASE WHEN COALESCE(CAST({f} AS VARCHAR), '') = '' THEN 1 ELSE 0 END"
                   for f in _FIELDS)
part("patient_leads", "patient_records", f"""
SELECT * FROM patient_records
QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_id, source_system
                           ORDER BY {_gaps}, source_patient_key DESC) = 1""")

_ENDS = """SPLIT_PART(node_a, '::', 1) AS source_system_a, SPLIT_PART(node_a, '::', 2) AS source_key_a,
  SPLIT_PART(node_b, '::', 1) AS source_system_b, SPLIT_PART(node_b, '::', 2) AS source_key_b"""
part("deterministic_match", "exact_pairs",
     f"SELECT {_ENDS}, confidence, match_method FROM exact_pairs")
_COMPONENTS = ", ".join(
    f"CAST({a} AS DECIMAL(4,3)) AS {b}" for a, b in (
        ("ln", "last_name_score"), ("fn", "first_name_score"), ("bd", "dob_score"),
        ("ph", "phone_score"), ("ad", "address_score"), ("em", "email_score")))
part("probabilistic_match", "scored_pairs", f"""
SELECT {_ENDS}, confidence, 'probabilistic' AS match_method, {_COMPONENTS} FROM scored_pairs""")

part("traits", "nodes", """
SELECT node, source_system AS sys, LOWER(first_name) AS f, LOWER(last_name) AS l, dob,
  NULLIF(phone, '') AS phone, NULLIF(email, '') AS email, LOWER(address_line1) AS street,
  LOWER(COALESCE(city, '')) AS city, NULLIF(zip, '') AS zip,
  MIN(node) OVER (PARTITION BY source_system, LOWER(first_name), LOWER(last_name), dob,
                  NULLIF(phone, ''), NULLIF(email, ''), LOWER(address_line1),
                  LOWER(COALESCE(city, '')), NULLIF(zip, '')) AS rep
FROM nodes""")
part("profile", "traits", "SELECT * FROM traits WHERE node = rep")
_NEAR = "ABS(x.dob - y.dob) BETWEEN 1 AND 2"
_YEAR = "ABS(YEAR(x.dob) - YEAR(y.dob)) = 1 AND STRFTIME(x.dob, '%m%d') = STRFTIME(y.dob, '%m%d')"
_SWAP = "STRFTIME(x.dob, '%Y%m%d') = STRFTIME(y.dob, '%Y%d%m')"
_SAME = {c: f"x.{c} = y.{c}" for c in ("phone", "email", "zip", "city", "street", "dob")}
_AGREE = [
    ("phone email zip", None), ("zip city street dob", None), ("email dob", None),
    ("phone dob", None), ("phone", _NEAR), ("phone", _YEAR), ("email zip", _NEAR),
    ("email zip city street", _YEAR), ("phone zip", _SWAP), ("phone email", _SWAP),
]
part("agreeing", "profile", "\nUNION\n".join(
    "SELECT x.node AS node_a, y.node AS node_b FROM profile x JOIN profile y ON "
    + " AND ".join([*[_SAME[c] for c in cols.split()], "x.sys < y.sys", *([extra] if extra else [])])
    for cols, extra in _AGREE))

# ---- star schema

part("dim_date", "fact_receivable fact_claim_line", """
SELECT d AS date_key, CAST(YEAR(d) AS INT) AS year, CAST(QUARTER(d) AS INT) AS quarter,
  CAST(MONTH(d) AS INT) AS month, MONTHNAME(d) AS month_name, CAST(DAY(d) AS INT) AS day_of_month,
  CAST(DAYOFWEEK(d) AS INT) AS day_of_week, DAYNAME(d) AS day_name,
  CAST(WEEKOFYEAR(d) AS INT) AS week_of_year, DAYOFWEEK(d) IN (0, 6) AS is_weekend,
  CAST(YEAR(d + INTERVAL 3 MONTH) AS INT) AS fiscal_year,
  CAST(MONTH(d + INTERVAL 3 MONTH) AS INT) AS fiscal_quarter,
  CAST(MONTH(d + INTERVAL 3 MONTH) AS INT) AS fiscal_month,
  CAST(QUARTER(d + INTERVAL 3 MONTH) AS INT) AS fiscal_quarter_true
FROM (SELECT CAST(UNNEST(GENERATE_SERIES(MAKE_DATE(YEAR(lo), 1, 1), MAKE_DATE(YEAR(hi), 12, 31),
                                         INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT MIN(x) AS lo, MAX(x) AS hi FROM (
        SELECT UNNEST([snapshot_date, submitted_date, service_from_date]) AS x FROM fact_receivable
        UNION ALL
        SELECT UNNEST([submitted_date, service_from_date, service_to_date]) FROM fact_claim_line)))""")
part("outside_npis", "rcm_claim_header referral_order", """
SELECT npi, MIN(free_name) AS free_name FROM (
  SELECT billing_provider_npi AS npi, NULL AS free_name FROM rcm_claim_header
  UNION ALL SELECT rendering_provider_npi, NULL FROM rcm_claim_header
  UNION ALL SELECT referring_provider_npi, referring_provider_name FROM referral_order)
WHERE npi IS NOT NULL GROUP BY npi""")
part("all_providers", "emr_provider outside_npis", """
SELECT emr_provider_id AS source_provider_id, npi, first_name, last_name, specialty, org_name,
  phone, address_line1, city, state, zip, 'emr' AS source_system FROM emr_provider
UNION ALL
SELECT 'PROV-EXT-' || npi, npi,
  CASE WHEN free_name LIKE '% %' THEN TRIM(SPLIT_PART(free_name, ' ', 1)) ELSE 'Unknown' END,
  CASE WHEN free_name LIKE '% %' THEN TRIM(SPLIT_PART(free_name, ' ', -1)) ELSE 'Unknown' END,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'external'
FROM outside_npis WHERE npi NOT IN (SELECT npi FROM emr_provider WHERE npi IS NOT NULL)""")


def _numbered(prefix: str, width: int, order: str) -> str:
    return f"'{prefix}' || LPAD(CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS VARCHAR), {width}, '0')"


part("dim_provider", "all_providers", f"""
SELECT {_numbered('DPROV-', 5, 'npi NULLS LAST, source_provider_id NULLS LAST')} AS provider_key,
  source_provider_id, npi, first_name, last_name, first_name || ' ' || last_name AS full_name,
  specialty, org_name, phone, address_line1, city, state, zip, source_system
FROM all_providers""")
_BLANK = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}"
                   for c in ("facility_type", "address", "city", "state", "zip"))
part("dim_facility", "emr_encounter rcm_claim_header referral_order", f"""
SELECT {_numbered('DFAC-', 4, 'id')} AS facility_key, id AS source_facility_id,
  'Facility ' || id AS facility_name, {_BLANK}
FROM (SELECT facility_id AS id FROM emr_encounter UNION SELECT facility_id FROM rcm_claim_header
      UNION SELECT receiving_facility_id FROM referral_order)
WHERE id IS NOT NULL""")


def _firm_name(column: str) -> str:
    forms = r"LLC|INC|CORP|LLP|PLLC|PA|PC|P\.A\.|P\.C\."
    return f"TRIM(REGEXP_REPLACE(UPPER({column}), '\\s*({forms})\\s*$', ''))"


part("firm_types", "referral_order", f"""
SELECT {_firm_name('counterparty_org_name')} AS normalized_name, counterparty_org_type AS kind,
  COUNT(DISTINCT counterparty_org_name) AS n, MIN(counterparty_org_name) AS spelling
FROM referral_order WHERE counterparty_org_name IS NOT NULL GROUP BY 1, 2""")
part("firm_kind", "firm_types", """
SELECT normalized_name, kind FROM firm_types WHERE kind IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY normalized_name ORDER BY n DESC, kind) = 1""")
part("dim_counterparty_org", "firm_types firm_kind", f"""
SELECT {_numbered('DCPTY-', 4, 'normalized_name')} AS counterparty_org_key,
  spelling AS counterparty_org_name, normalized_name, kind AS counterparty_org_type,
  CAST(variants AS BIGINT) AS name_variant_count
FROM (SELECT normalized_name, MIN(spelling) AS spelling, SUM(n) AS variants
      FROM firm_types GROUP BY normalized_name) LEFT JOIN firm_kind USING (normalized_name)""")
part("dim_payer", "rcm_claim_header", f"""
SELECT {_numbered('DPAY-', 4, 'payer_name')} AS payer_key, payer_name
FROM (SELECT DISTINCT payer_name FROM rcm_claim_header WHERE payer_name IS NOT NULL)""")
part("bridge_patient_counterparty", "final_match referral_order dim_counterparty_org", f"""
SELECT DISTINCT f.patient_id, d.counterparty_org_key, o.referral_order_id, o.referral_created_at,
  o.counterparty_org_name
FROM referral_order o
JOIN final_match f ON f.source_system = 'referral' AND f.source_patient_key = o.referral_order_id
JOIN dim_counterparty_org d ON d.normalized_name = {_firm_name('o.counterparty_org_name')}""")
part("bridge_pair", "bridge_patient_counterparty", """
SELECT patient_id, counterparty_org_key, COUNT(*) AS referral_count,
  MIN(referral_created_at) AS first_referral_at, MAX(referral_created_at) AS last_referral_at
FROM bridge_patient_counterparty GROUP BY 1, 2""")
part("claim_keys", "rcm_claim_header dim_payer dim_facility", """
SELECT h.*, p.payer_key, f.facility_key FROM rcm_claim_header h
LEFT JOIN dim_payer p ON p.payer_name = h.payer_name
LEFT JOIN dim_facility f ON f.source_facility_id = h.facility_id""")
part("account_patient", "final_match", """
SELECT source_patient_key AS rcm_account_id, patient_id FROM final_match
WHERE source_system = 'rcm'""")
part("fact_receivable", "rcm_ar_balance_snapshot claim_keys account_patient", """
SELECT s.snapshot_date, s.claim_id, a.patient_id, k.facility_key, k.payer_key,
  CAST(COALESCE(s.payer_responsibility_balance, 0) + COALESCE(s.patient_responsibility_balance, 0)
       AS DECIMAL(13,2)) AS total_ar_balance,
  s.payer_responsibility_balance AS payer_balance,
  s.patient_responsibility_balance AS patient_balance, s.aging_bucket, k.claim_status,
  k.total_charge_amount, k.submitted_date, k.service_from_date
FROM rcm_ar_balance_snapshot s LEFT JOIN claim_keys k ON k.claim_id = s.claim_id
LEFT JOIN account_patient a ON a.rcm_account_id = s.rcm_account_id""")
_LATE = ", ".join(f"'{b}'" for b in OVERDUE_BUCKETS)
part("fact_patient_balance", "fact_receivable", f"""
SELECT snapshot_date, patient_id, SUM(total_ar_balance) AS total_outstanding,
  SUM(CASE WHEN aging_bucket IN ({_LATE}) THEN total_ar_balance ELSE 0 END) AS overdue_amount,
  SUM(payer_balance) AS total_payer_balance, SUM(patient_balance) AS total_patient_balance,
  COUNT(DISTINCT claim_id) AS open_claim_count, CAST(NULL AS DATE) AS last_payment_date
FROM fact_receivable WHERE patient_id IS NOT NULL GROUP BY snapshot_date, patient_id""")
part("fact_claim_line", "rcm_claim_line claim_keys account_patient", """
SELECT l.claim_id, l.line_num, l.cpt_code, l.units, l.charge_amount, l.allowed_amount,
  l.paid_amount, l.denial_code, l.denial_code IS NOT NULL AS is_denied, a.patient_id,
  k.facility_key, k.payer_key, k.claim_status, k.submitted_date, k.service_from_date,
  k.service_to_date, k.billing_provider_npi, k.rendering_provider_npi
FROM rcm_claim_line l JOIN claim_keys k ON k.claim_id = l.claim_id
LEFT JOIN account_patient a ON a.rcm_account_id = k.rcm_account_id""")

# ---- reports


def _top_firms(bridge: str) -> str:
    return query(f"""
SELECT d.counterparty_org_name, d.counterparty_org_type,
  SUM(r.total_ar_balance) AS total_pending_ar, COUNT(DISTINCT r.claim_id) AS claim_count
FROM fact_receivable r JOIN {bridge} b ON b.patient_id = r.patient_id
JOIN dim_counterparty_org d ON d.counterparty_org_key = b.counterparty_org_key
WHERE r.aging_bucket IN ({_LATE}) GROUP BY 1, 2
ORDER BY total_pending_ar DESC, d.counterparty_org_name""",
                 f"fact_receivable {bridge} dim_counterparty_org")


def _balances(tail: str) -> str:
    return query(f"""
SELECT p.patient_id, p.best_first_name || ' ' || p.best_last_name AS patient_name,
  b.snapshot_date, b.total_outstanding, b.overdue_amount, b.open_claim_count
FROM fact_patient_balance b JOIN dim_patient p ON p.patient_id = b.patient_id
ORDER BY b.total_outstanding DESC, p.patient_id, b.snapshot_date {tail}""",
                 "fact_patient_balance dim_patient")


def _aging(dim: str, key: str, name: str) -> str:
    return query(f"""
SELECT d.{name}, r.aging_bucket, SUM(r.total_ar_balance) AS total_ar,
  COUNT(DISTINCT r.claim_id) AS claims
FROM fact_receivable r LEFT JOIN {dim} d ON d.{key} = r.{key}
GROUP BY 1, 2 ORDER BY 1, 2""", f"fact_receivable {dim}")


_DENIED = """COUNT(*) AS total_lines, CAST(SUM(CAST(is_denied AS INT)) AS BIGINT) AS denied_lines,
  ROUND(100.0 * SUM(CAST(is_denied AS INT)) / COUNT(*), 2) AS denial_rate_pct"""
part("order_times", "referral_order_status_history", """
SELECT referral_order_id, MIN(status_time) FILTER (status = 'received') AS received_at,
  MIN(status_time) FILTER (status = 'completed') AS completed_at
FROM referral_order_status_history GROUP BY 1""")
part("turnaround", "order_times", """
SELECT *, CAST(CAST(completed_at AS DATE) - CAST(received_at AS DATE) AS INT) AS turnaround_days
FROM order_times WHERE received_at IS NOT NULL AND completed_at IS NOT NULL""")
part("truth", "nodes", """
SELECT node, COALESCE(o.o_custkey, CAST(SUBSTR(source_patient_key, 2) AS BIGINT)) AS truth
FROM nodes LEFT JOIN orders o
  ON source_system = 'referral' AND o.o_orderkey = CAST(SUBSTR(source_patient_key, 2) AS BIGINT)""")
part("judged", "truth labels", "SELECT cluster_id, truth FROM truth JOIN labels USING (node)")


def _pair_count(group: str) -> str:
    return (f"(SELECT CAST(SUM(n * (n - 1) / 2) AS BIGINT) FROM "
            f"(SELECT COUNT(*) AS n FROM judged GROUP BY {group}))")


def _check_sql(c) -> str:
    col = c.columns[0]
    cols = ", ".join(c.columns)
    listed = ", ".join(repr(a) for a in c.args) if c.args else ""
    if c.kind == "not_null":
        failed = f"SELECT COUNT(*) FROM {c.table} WHERE {col} IS NULL"
    elif c.kind == "accepted_values":
        failed = f"SELECT COUNT(*) FROM {c.table} WHERE {col} NOT IN ({listed})"
    elif c.kind == "matches":
        failed = f"SELECT COUNT(*) FROM {c.table} WHERE NOT REGEXP_MATCHES({col}, '{c.args[0]}')"
    elif c.kind == "length":
        failed = f"SELECT COUNT(*) FROM {c.table} WHERE LENGTH({col}) <> {c.args[0]}"
    elif c.kind == "between":
        failed = f"SELECT COUNT(*) FROM {c.table} WHERE {col} NOT BETWEEN {c.args[0]} AND {c.args[1]}"
    elif c.kind == "unique":
        failed = (f"SELECT COUNT(*) FROM (SELECT 1 FROM {c.table} WHERE {col} IS NOT NULL"
                  f" GROUP BY {col} HAVING COUNT(*) > 1)")
    elif c.kind == "unique_combination":
        failed = (f"SELECT COUNT(*) FROM (SELECT 1 FROM {c.table} GROUP BY {cols}"
                  f" HAVING COUNT(*) > 1)")
    else:
        parent, key = c.args
        failed = (f"SELECT COUNT(*) FROM {c.table} c WHERE c.{col} IS NOT NULL"
                  f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{col})")
    return (f"SELECT '{c.table}' AS table_name, '{c.kind}' AS check_kind,"
            f" '{cols}' AS column_names, '{c.severity}' AS severity, ({failed}) AS failures")


def _checks(declared) -> str:
    tables = {c.table for c in declared} | {c.args[0] for c in declared
                                            if c.kind == "relationship"}
    return query("\nUNION ALL\n".join(_check_sql(c) for c in declared), " ".join(sorted(tables)))


def _quote_json(source) -> str:
    pairs = ", ".join(f"'{c}', {c}" for c in source.columns)
    return f"CAST(JSON_OBJECT({pairs}) AS VARCHAR)"


# ---- draws, made feeds, external tables


def _u(key: str, purpose: str) -> str:
    return (f"(CAST(CAST('0x' || LEFT(MD5('{purpose}:' || {key}), 8) AS BIGINT) AS DOUBLE)"
            f" / CAST(4294967296 AS DOUBLE))")


def _whole(key: str, purpose: str, low: int, high: int) -> str:
    return f"(CAST(FLOOR({_u(key, purpose)} * {high - low + 1}) AS INT) + {low})"


def _choose(key: str, purpose: str, values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_whole(key, purpose, 1, len(values))}]"


for _n, _sql in EXTERNAL_SQL.items():
    part(f"ext_{_n}", "", _sql.format(**_inputs()))
_C = "claim_id"
part("ext_living", "ext_patients", """
SELECT Id AS emr_patient_id, FIRST AS first_name, LAST AS last_name, BIRTHDATE AS dob,
  GENDER AS sex, ADDRESS AS address_line1, CITY AS city, STATE AS state, ZIP AS zip,
  RIGHT(SSN, 4) AS ssn_last4, 'N' AS deceased_flag, '2024-01-15 08:00:00' AS last_updated_at
FROM ext_patients WHERE DEATHDATE IS NULL""")
_visit_cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in clinical.VISIT_TYPES.items())
_PK = "(ENCOUNTER || '|' || CODE || '|' || DATE)"
part("ext_codes", "ext_crosswalk", """
SELECT * FROM ext_crosswalk QUALIFY ROW_NUMBER() OVER (PARTITION BY snomed_code ORDER BY line DESC) = 1""")
part("legal", "dim_provider referral_order", f"""
SELECT org_name AS given, phone, address_line1 FROM dim_provider WHERE org_name IS NOT NULL
UNION ALL SELECT counterparty_org_name, NULL, NULL FROM referral_order
WHERE counterparty_org_name IS NOT NULL""")


def _legal(column: str) -> str:
    return (f"TRIM(REGEXP_REPLACE(REGEXP_REPLACE({_firm_name(column)}, '[^A-Z0-9 ]', '', 'g'),"
            f" ' +', ' ', 'g'))")


def _org(column: str) -> str:
    return f"'ORG-' || MD5({_legal(column)})"


def _person_key(column: str) -> str:
    return f"'PER-' || MD5({column})"


part("graph_links", "dim_provider referral_order rcm_claim_header", f"""
SELECT {_person_key('referring_provider_npi')} AS from_entity_id,
  {_org('counterparty_org_name')} AS to_entity_id, 'refers_to' AS edge_type,
  'referral' AS source_system, 'same referral order' AS evidence
FROM referral_order WHERE referring_provider_npi IS NOT NULL AND counterparty_org_name IS NOT NULL
UNION ALL
SELECT {_person_key('npi')}, {_org('org_name')}, 'employed_by', source_system, 'listed organisation'
FROM dim_provider WHERE npi IS NOT NULL AND org_name IS NOT NULL
UNION ALL
SELECT {_person_key('rendering_provider_npi')}, {_person_key('billing_provider_npi')}, 'billed_by',
  'rcm', 'same claim'
FROM rcm_claim_header
WHERE billing_provider_npi IS NOT NULL AND rendering_provider_npi IS NOT NULL""")
_PLAIN = ("TRIM(REGEXP_REPLACE(REGEXP_REPLACE(UPPER({}), '[^A-Z0-9 ]', '', 'g'),"
          " ' +', ' ', 'g'))")
_PLACE = "NULLIF(UPPER(CONCAT_WS(' ', {}, {})), '')"
part("mention_rows", "dim_provider referral_order ext_providers", f"""
SELECT 'provider:' || source_provider_id AS mention, 'person' AS entity_type,
  {_PLAIN.format('full_name')} AS name, {_PLACE.format('address_line1', 'zip')} AS address, phone,
  npi, NULL AS case_id, NULL AS org_type, source_system, {_person_key('npi')} AS entity_id
FROM dim_provider
UNION ALL
SELECT 'employer:' || source_provider_id, 'org', {_legal('org_name')},
  {_PLACE.format('address_line1', 'zip')}, phone, NULL, NULL, NULL, source_system, {_org('org_name')}
FROM dim_provider WHERE org_name IS NOT NULL
UNION ALL
SELECT 'firm:' || referral_order_id, 'org', {_legal('counterparty_org_name')}, NULL, NULL, NULL,
  case_reference_id, counterparty_org_type, 'referral', {_org('counterparty_org_name')}
FROM referral_order WHERE counterparty_org_name IS NOT NULL
UNION ALL
SELECT 'clinical:' || "Id", 'person', {_PLAIN.format('"NAME"')}, {_PLACE.format('"ADDRESS"', '"ZIP"')},
  NULL, NULL, NULL, NULL, 'clinical', NULL FROM ext_providers""")
part("mention_sets", "mention_rows", """
SELECT *, CASE WHEN LENGTH(name) > 0 THEN LIST_DISTINCT(LIST_TRANSFORM(
    RANGE(1, GREATEST(LENGTH(name) - 2, 1) + 1), LAMBDA i: SUBSTRING(name, i, 3))) END AS grams,
  LIST_DISTINCT(STRING_SPLIT_REGEX(address, '\\s+')) AS words
FROM mention_rows""")


def _overlap(c: str) -> str:
    return (f"CAST(LEN(LIST_INTERSECT(x.{c}, y.{c})) AS DOUBLE)"
            f" / LEN(LIST_DISTINCT(LIST_CONCAT(x.{c}, y.{c})))")


_MENTION_PAIR = ("FROM mention_sets x JOIN mention_sets y"
                 " ON x.mention < y.mention AND x.entity_type = y.entity_type")
part("mention_pairs", "mention_sets", f"""
SELECT x.mention AS u, y.mention AS v, 'name and address' AS evidence {_MENTION_PAIR}
WHERE x.address IS NOT NULL AND y.address IS NOT NULL
  AND {_overlap('words')} >= {ADDRESS_LIKENESS} AND {_overlap('grams')} >= {NAME_LIKENESS}
UNION ALL
SELECT x.mention, y.mention, 'phone and address' {_MENTION_PAIR} AND x.phone = y.phone
WHERE x.phone <> '' AND x.address IS NOT NULL AND y.address IS NOT NULL
  AND {_overlap('words')} >= {ADDRESS_LIKENESS}
UNION ALL
SELECT x.mention, y.mention, 'case, type and name' {_MENTION_PAIR} AND x.case_id = y.case_id
  AND x.org_type = y.org_type
WHERE {_overlap('grams')} >= {NAME_LIKENESS}
UNION ALL
SELECT MIN(mention) OVER (PARTITION BY npi), mention, 'same NPI' FROM mention_sets
WHERE npi IS NOT NULL
UNION ALL
SELECT MIN(mention) OVER (PARTITION BY name), mention, 'same legal name' FROM mention_sets
WHERE entity_type = 'org' AND name <> ''""")
part("mention_links", "mention_pairs", "SELECT * FROM mention_pairs WHERE u <> v")
part("mention_near", "mention_links", """
SELECT u AS node, v AS other FROM mention_links UNION SELECT v, u FROM mention_links""")
part("mention_reached", "mention_reached mention_near mention_rows", """
SELECT mention AS node, mention AS label FROM mention_rows
UNION
SELECT a.other, r.label FROM mention_reached r JOIN mention_near a ON a.node = r.node
WHERE r.label < a.other""")
part("resolved_mentions", "mention_reached mention_rows", """
SELECT m.*, 'RES-' || MD5(r.label) AS resolved_id
FROM mention_rows m JOIN (SELECT node, MIN(label) AS label FROM mention_reached GROUP BY node) r
  ON r.node = m.mention""")
part("resolved_names", "resolved_mentions", """
SELECT resolved_id, name, COUNT(*) AS n FROM resolved_mentions WHERE name <> '' GROUP BY ALL""")
part("resolved_evidence", "resolved_mentions mention_links", """
SELECT resolved_id, STRING_AGG(evidence, ', ' ORDER BY evidence) AS evidence FROM (
  SELECT DISTINCT m.resolved_id, l.evidence
  FROM mention_links l JOIN resolved_mentions m ON m.mention = l.u) GROUP BY 1""")
part("resolved_ends", "resolved_mentions", """
SELECT DISTINCT entity_id, resolved_id FROM resolved_mentions WHERE entity_id IS NOT NULL""")
part("registry_rows", "ext_registry", """
SELECT npi, MIN(ROW(first_name, last_name, specialty, org_name, phone, address_line1, city, state,
                    zip)) AS r FROM ext_registry GROUP BY npi""")
part("registered_providers", "all_providers registry_rows", """
SELECT p.source_provider_id, p.npi,
  CASE WHEN r.npi IS NULL THEN p.first_name ELSE COALESCE(r.r[1], p.first_name) END AS first_name,
  CASE WHEN r.npi IS NULL THEN p.last_name ELSE COALESCE(r.r[2], p.last_name) END AS last_name,
  COALESCE(r.r[3], p.specialty) AS specialty, COALESCE(r.r[4], p.org_name) AS org_name,
  COALESCE(r.r[5], p.phone) AS phone, COALESCE(r.r[6], p.address_line1) AS address_line1,
  COALESCE(r.r[7], p.city) AS city, COALESCE(r.r[8], p.state) AS state,
  COALESCE(r.r[9], p.zip) AS zip, p.source_system
FROM all_providers p LEFT JOIN registry_rows r ON r.npi = p.npi AND p.source_system = 'external'""")
part("loads", " ".join(f"landed_{n}" for n in SOURCES), "\nUNION ALL\n".join(
    f"SELECT _source_file, CAST(_ingested_at AS DATE) AS load_day, COUNT(*) AS row_count"
    f" FROM landed_{n} GROUP BY 1, 2" for n in SOURCES))


def _alike(c: str) -> str:
    longest = f"GREATEST(LENGTH(x.{c}), LENGTH(y.{c}))"
    return (f"(CASE WHEN x.{c} IS NULL OR y.{c} IS NULL THEN 0.0 WHEN {longest} = 0 THEN 1.0"
            f" ELSE 1.0 - LEVENSHTEIN(x.{c}, y.{c}) / CAST({longest} AS DOUBLE) END)")


def _made_and_external() -> dict[str, str]:
    def table(name, columns="*"):
        return query(f"SELECT {columns} FROM {name}", name)

    return {
        **{n: query("""
SELECT source_system, source_patient_key, cluster_id, match_confidence, match_method,
  'PAT-' || MD5(cluster_id) AS patient_id FROM final_match""", "final_match") for n in ("er_incremental", "er_incremental_changed", "er_incremental_withdrawn")},
        "dim_provider_registry": query(f"""
SELECT {_numbered('DPROV-', 5, 'npi NULLS LAST, source_provider_id NULLS LAST')} AS provider_key,
  source_provider_id, npi, first_name, last_name, first_name || ' ' || last_name AS full_name,
  specialty, org_name, phone, address_line1, city, state, zip, source_system
FROM registered_providers""", "registered_providers"),
        "graph_entities": query(f"""
SELECT {_person_key('npi')} AS entity_id, 'person' AS entity_type, MIN(full_name) AS canonical_name,
  MIN(phone) AS canonical_phone, MIN(address_line1) AS canonical_address
FROM dim_provider WHERE npi IS NOT NULL GROUP BY 1
UNION ALL
SELECT {_org('given')}, 'org', MIN(given), MIN(phone), MIN(address_line1) FROM legal GROUP BY 1""",
                                "dim_provider legal"),
        "graph_identifiers": query(f"""
SELECT {_person_key('npi')} AS entity_id, 'NPI' AS id_type, npi AS id_value,
  'national registry' AS issuing_authority, source_system FROM dim_provider WHERE npi IS NOT NULL
UNION
SELECT {_person_key('npi')}, 'external_id', source_provider_id, 'source', source_system
FROM dim_provider WHERE npi IS NOT NULL
UNION
SELECT {_org('counterparty_org_name')}, 'case_id', case_reference_id, 'firm', 'referral'
FROM referral_order WHERE counterparty_org_name IS NOT NULL AND case_reference_id IS NOT NULL""",
                                   "dim_provider referral_order"),
        "graph_edges": query(f"""
SELECT *, CAST(ROUND(1.0 - POW(1.0 - CASE evidence {' '.join(
    f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in EVIDENCE.items())} END, support), 3)
  AS DECIMAL(4,3)) AS confidence
FROM (SELECT *, COUNT(*) AS support FROM graph_links GROUP BY ALL)""", "graph_links"),
        "er_threshold_curve": query("""
SELECT threshold, r AS right_pairs, f AS found_pairs, t AS true_pairs,
  ROUND(r / CAST(f AS DOUBLE), 6) AS precision_share, ROUND(r / CAST(t AS DOUBLE), 6) AS recall_share
FROM (SELECT threshold, CAST(SUM(n * (n - 1) / 2) AS BIGINT) AS r FROM (
        SELECT threshold, COUNT(*) AS n FROM curve_judged GROUP BY threshold, cluster, truth)
      GROUP BY 1)
JOIN (SELECT threshold, CAST(SUM(n * (n - 1) / 2) AS BIGINT) AS f FROM (
        SELECT threshold, COUNT(*) AS n FROM curve_judged GROUP BY threshold, cluster)
      GROUP BY 1) USING (threshold),
  (SELECT CAST(SUM(n * (n - 1) / 2) AS BIGINT) AS t FROM (
     SELECT COUNT(*) AS n FROM truth GROUP BY truth))""", "curve_judged truth"),
        "bronze_load_log": query("\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, '{x.file}' AS source_file, "
            + (f"0 AS row_count, '{BAD_FEEDS[n]}' AS status" if n in BAD_FEEDS else
               f"COUNT(*) AS row_count, 'loaded' AS status FROM landed_{n}")
            for n, x in SOURCES.items()), " ".join(f"landed_{n}" for n in SOURCES)),
        "dq_cardinality_sketch": query("""
SELECT *, ROUND(new_members / CAST(known_before AS DOUBLE), 4) AS growth,
  COALESCE(ROUND(new_members / CAST(known_before AS DOUBLE), 4) > 0.5, FALSE) AS spike
FROM (
  SELECT l.dimension, l.load_day,
    (SELECT COUNT(*) FROM all_members m WHERE m.dimension = l.dimension
       AND m.load_day = l.load_day) AS load_members,
    (SELECT COUNT(*) FROM (SELECT member FROM all_members m WHERE m.dimension = l.dimension
       GROUP BY member HAVING MIN(load_day) = l.load_day)) AS new_members,
    CASE WHEN l.nth > 1 THEN (SELECT COUNT(DISTINCT member) FROM all_members m
       WHERE m.dimension = l.dimension AND m.load_day < l.load_day) END AS known_before,
    CASE WHEN l.nth > 1 THEN (SELECT COUNT(*) FROM all_members m JOIN all_members o
         ON o.dimension = m.dimension AND o.member = m.member
       WHERE m.dimension = l.dimension AND m.load_day = l.load_day AND o.load_day = b.load_day) END
      AS shared_with_last
  FROM member_loads l LEFT JOIN member_loads b ON b.dimension = l.dimension AND b.nth = l.nth - 1)""",
                                       "all_members member_loads"),
        "bi_metrics_cube": query("\nUNION ALL\n".join(f"""
SELECT {', '.join(c if c in g else f'NULL AS {c}' for c in CUBE)}, '{','.join(g)}' AS grain,
  COUNT(*) AS receivable_rows, CAST(COALESCE(SUM(total_ar_balance) FILTER (
    snapshot_date = {'last_in_month' if 'month' in g else 'last_of_all'}
    AND claim_id IS NOT NULL), 0) AS DECIMAL(38,2)) AS closing_balance,
  COUNT(DISTINCT claim_id) AS claims, COUNT(DISTINCT patient_id) AS patients
FROM cube_rows {'GROUP BY ' + ', '.join(g) if g else ''}""" for g in CUBE_GRAINS), "cube_rows"),
        "stream_volumes": query(f"""
SELECT event_type AS feed, hour AS window_start, COUNT(*) AS row_count, MIN(ts) AS first_seen,
  MAX(ts) AS last_seen
FROM arrivals a JOIN watermarks w USING (batch)
WHERE w.passed IS NULL OR a.hour + INTERVAL 1 HOUR > w.passed
GROUP BY 1, 2
HAVING ANY_VALUE(a.hour) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL {LATE_BY_HOURS} HOUR FROM events)""",
                                "arrivals watermarks"),
        "stream_changes": query("""
SELECT claim_id, payer_name, CASE WHEN k % 10 = 0 THEN 'reopened' WHEN k % 4 = 0 THEN 'appealed'
  WHEN k % 3 = 0 THEN 'late' ELSE claim_status END AS claim_status, total_charge_amount
FROM (SELECT *, CAST(claim_id[2:] AS BIGINT) AS k FROM rcm_claim_header)
WHERE k % 5 <> 0 OR k % 10 = 0""", "rcm_claim_header"),
        "gold_xref_history": table("xref_history"),
        "fact_receivable_as_of": query("""
SELECT s.claim_id, s.rcm_account_id, s.snapshot_date, s.payer_responsibility_balance,
  s.patient_responsibility_balance, CAST(s._ingested_at AS DATE) AS known_on, h.patient_id,
  h.match_method, l.patient_id AS patient_id_now
FROM rcm_ar_balance_snapshot s
LEFT JOIN xref_history h ON h.source_system = 'rcm' AND h.source_patient_key = s.rcm_account_id
  AND CAST(s._ingested_at AS DATE) >= h.effective_from
  AND (h.effective_to IS NULL OR CAST(s._ingested_at AS DATE) < h.effective_to)
LEFT JOIN xref_history l ON l.source_system = 'rcm' AND l.source_patient_key = s.rcm_account_id
  AND l.effective_to IS NULL""", "rcm_ar_balance_snapshot xref_history"),
        "graph_resolved_entities": query("""
SELECT e.*, COALESCE(b.name_count, 0) AS name_count, b.name AS canonical_name,
  COALESCE(v.evidence, '') AS evidence
FROM (SELECT resolved_id, entity_type, MIN(phone) AS canonical_phone,
        MIN(address) AS canonical_address, COUNT(*) AS mention_count,
        COUNT(DISTINCT npi) AS npi_count,
        ARRAY_TO_STRING(LIST_SORT(LIST(DISTINCT source_system)), ', ') AS source_systems
      FROM resolved_mentions GROUP BY 1, 2) e
LEFT JOIN (SELECT resolved_id, FIRST(name ORDER BY n DESC, name) AS name, COUNT(*) AS name_count
           FROM resolved_names GROUP BY 1) b USING (resolved_id)
LEFT JOIN resolved_evidence v USING (resolved_id)""",
                                         "resolved_mentions resolved_names resolved_evidence"),
        "graph_resolved_edges": query(f"""
SELECT *, CAST(ROUND(1.0 - POW(1.0 - CASE evidence {' '.join(
    f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in EVIDENCE.items())} END, support), 3)
  AS DECIMAL(4,3)) AS confidence
FROM (SELECT f.resolved_id AS from_resolved_id, t.resolved_id AS to_resolved_id, edge_type,
        source_system, evidence, COUNT(*) AS support
      FROM graph_links l JOIN resolved_ends f ON f.entity_id = l.from_entity_id
      JOIN resolved_ends t ON t.entity_id = l.to_entity_id GROUP BY ALL)""",
                                      "graph_links resolved_ends"),
        "fixture_accounts": query("""
SELECT a.rcm_account_id, a.emr_patient_id,
  COALESCE(LOWER(a.patient_first_name) = LOWER(p.last_name)
    AND LOWER(a.patient_last_name) = LOWER(p.first_name)
    AND LOWER(p.first_name) <> LOWER(p.last_name), FALSE) AS names_swapped,
  LOWER(a.patient_first_name) IS DISTINCT FROM LOWER(p.first_name)
    OR LOWER(a.patient_last_name) IS DISTINCT FROM LOWER(p.last_name) AS name_differs,
  a.dob IS DISTINCT FROM p.dob AS dob_differs
FROM rcm_patient_account a JOIN emr_patient p ON p.emr_patient_id = a.emr_patient_id""",
                                  "rcm_patient_account emr_patient"),
        "fixture_money_lines": query("""
SELECT *, COALESCE(paid_amount <= allowed_amount AND allowed_amount <= charge_amount, FALSE)
  AS consistent
FROM (SELECT claim_id, SUM(charge_amount) AS charge_amount, SUM(allowed_amount) AS allowed_amount,
        SUM(paid_amount) AS paid_amount FROM rcm_claim_line GROUP BY 1)""", "rcm_claim_line"),
        "fixture_balances": query("""
SELECT claim_id, SUM(COALESCE(payer_responsibility_balance, 0)
    + COALESCE(patient_responsibility_balance, 0)) AS total_balance,
  SUM(payer_responsibility_balance) AS payer_responsibility_balance,
  SUM(patient_responsibility_balance) AS patient_responsibility_balance,
  MAX(aging_bucket) AS oldest_bucket
FROM rcm_ar_balance_snapshot GROUP BY 1""", "rcm_ar_balance_snapshot"),
        "fixture_status_history": query("""
SELECT referral_order_id, CAST(ROW_NUMBER() OVER w - 1 AS INT) AS step, status,
  CAST(CAST(status_time AS DATE) - CAST(LAG(status_time) OVER w AS DATE) AS INT) AS days_since
FROM referral_order_status_history
WINDOW w AS (PARTITION BY referral_order_id ORDER BY status_time, status)""",
                                        "referral_order_status_history"),
        "fixture_assigned_accounts": query("""
SELECT h.claim_id, h.rcm_account_id, a.rcm_account_id IS NOT NULL AS account_known
FROM rcm_claim_header h LEFT JOIN rcm_patient_account a ON a.rcm_account_id = h.rcm_account_id""",
                                           "rcm_claim_header rcm_patient_account"),
        "fixture_claims_of_encounters": query("""
SELECT e.emr_encounter_id, e.emr_patient_id, COUNT(h.claim_id) AS claims,
  CAST(SUM(h.total_charge_amount) AS DECIMAL(38,2)) AS charged
FROM emr_encounter e
LEFT JOIN rcm_patient_account a ON a.emr_patient_id = e.emr_patient_id
LEFT JOIN rcm_claim_header h ON h.rcm_account_id = a.rcm_account_id
GROUP BY 1, 2""", "emr_encounter rcm_patient_account rcm_claim_header"),
        "fixture_filled_headers": query(f"""
SELECT claim_id, COALESCE(payer_name, {_choose(_C, 'payer', PAYERS.split(','))}) AS payer_name,
  COALESCE(claim_status, 'submitted') AS claim_status FROM rcm_claim_header""", "rcm_claim_header"),
        "external_patients": table("ext_living"),
        "external_patients_head": query("""
SELECT * FROM ext_living ORDER BY emr_patient_id LIMIT 100""", "ext_living"),
        "external_providers": query("""
SELECT p.Id AS emr_provider_id, SPLIT_PART(p.NAME, ' ', 1) AS first_name,
  CASE WHEN p.NAME LIKE '% %' THEN SUBSTR(p.NAME, STRPOS(p.NAME, ' ') + 1) ELSE '' END AS last_name,
  SPECIALITY AS specialty, o.NAME AS org_name, ADDRESS AS address_line1, CITY AS city,
  STATE AS state, ZIP AS zip
FROM ext_providers p LEFT JOIN ext_organizations o ON o.Id = p.ORGANIZATION""",
                                    "ext_providers ext_organizations"),
        "external_encounters": query(f"""
SELECT Id AS emr_encounter_id, PATIENT AS emr_patient_id,
  CASE LOWER(ENCOUNTERCLASS) {_visit_cases} ELSE 'outpatient' END AS encounter_type,
  'completed' AS status, START AS start_time, STOP AS end_time, ORGANIZATION AS facility_id,
  PROVIDER AS attending_provider_id
FROM ext_encounters WHERE PATIENT IN (SELECT emr_patient_id FROM ext_living)""",
                                     "ext_encounters ext_living"),
        "external_diagnoses": query("""
SELECT ENCOUNTER AS emr_encounter_id, CODE AS icd10_code, DESCRIPTION AS diagnosis_desc,
  CAST(ROW_NUMBER() OVER (PARTITION BY ENCOUNTER ORDER BY START, CODE, DESCRIPTION) AS INT)
    AS diagnosis_rank
FROM ext_conditions WHERE PATIENT IN (SELECT emr_patient_id FROM ext_living)""",
                                    "ext_conditions ext_living"),
        "external_procedures": query(f"""
SELECT ENCOUNTER AS emr_encounter_id,
  COALESCE(cpt_code, {_choose(_PK, 'procedure', clinical.FALLBACK_PROCEDURES)}) AS cpt_code,
  CASE WHEN cpt_code IS NULL
       THEN {_choose(_PK, 'procedure', clinical.FALLBACK_PROCEDURES.values())}
       ELSE cpt_description END AS procedure_desc, DATE AS performed_time
FROM ext_procedures LEFT JOIN ext_codes ON snomed_code = CODE
WHERE PATIENT IN (SELECT emr_patient_id FROM ext_living)""", "ext_procedures ext_codes ext_living"),
        "dq_load_volumes": query("""
SELECT *, ROUND((row_count - previous_count) / CAST(previous_count AS DOUBLE), 4) AS change,
  COALESCE(ABS(ROUND((row_count - previous_count) / CAST(previous_count AS DOUBLE), 4)) > 0.5, FALSE)
    AS unusual
FROM (SELECT *, LAG(row_count) OVER (PARTITION BY _source_file ORDER BY load_day) AS previous_count
      FROM loads)""", "loads"),
        "dq_freshness": query("""
SELECT _source_file, MAX(load_day) AS newest_load,
  CAST(DATE '2024-06-10' - MAX(load_day) AS INT) AS age_days,
  DATE '2024-06-10' - MAX(load_day) > 7 AS stale FROM loads GROUP BY 1""", "loads"),
    }


def all_sql() -> dict[str, str]:
    def table(name, columns="*"):
        return query(f"SELECT {columns} FROM {name}", name)

    remit = SOURCES["rcm_remittance_835"]
    out = {
        "bronze_row_hash": query("\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, _row_hash FROM landed_{n}" for n in SOURCES),
            " ".join(f"landed_{n}" for n in SOURCES)),
        "bronze_audit_columns": query(f"""
SELECT remit_id, remit_id AS source_record_id, 'batch-1' AS batch_id,
  {_quote_json(remit)} AS payload_json FROM landed_rcm_remittance_835""",
                                      "landed_rcm_remittance_835"),
    }
    out |= {f"silver_{n}": table(n) for n in SOURCES}
    out["silver_emr_diagnosis_raw_key"] = query(
        _cleaned(SOURCES["emr_diagnosis"], raw_key=True), "landed_emr_diagnosis")
    out["er_spine"] = table("patient_spine")
    out |= {f"er_rule_{n}": query(f"SELECT {_ENDS}, confidence, match_method FROM rule_{n}",
                                  f"rule_{n}") for n in _RULE_NAMES}
    out |= {
        "er_deterministic": table("deterministic_match"),
        "er_candidates_pruned": query(f"SELECT {_ENDS} FROM agreeing", "agreeing"),
        "er_probabilistic": table("probabilistic_match"),
        "er_review_queue": query(f"""
SELECT {_ENDS}, confidence, {_COMPONENTS} FROM likely_pairs
WHERE confidence >= 0.65 AND confidence < 0.70""", "likely_pairs"),
        "er_levenshtein_score": query(f"""
SELECT {_ENDS}, edit_score FROM (
  SELECT p.node_a, p.node_b, CAST(ROUND({_alike('f')} * 0.3 + {_alike('l')} * 0.3
    + COALESCE(1.0 - LEAST(ABS(YEAR(x.dob) - YEAR(y.dob)), 100) / 100.0, 0) * 0.2
    + CAST(p.ad AS DOUBLE) * 0.2, 3) AS DECIMAL(4,3)) AS edit_score
  FROM scores p JOIN traits x ON x.node = p.node_a JOIN traits y ON y.node = p.node_b)
WHERE edit_score >= 0.75""", "scores traits"),
        "er_review_records": query("""
SELECT f.source_system, f.source_patient_key, b.confidence AS best_confidence,
  SPLIT_PART(b.other, '::', 1) AS candidate_system, SPLIT_PART(b.other, '::', 2) AS candidate_key
FROM final_match f LEFT JOIN (
  SELECT * FROM (SELECT node_a AS node, node_b AS other, confidence FROM likely_pairs
                 UNION ALL SELECT node_b, node_a, confidence FROM likely_pairs)
  WHERE confidence >= 0.65
  QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY confidence DESC, other) = 1) b
ON b.node = f.source_system || '::' || f.source_patient_key
WHERE f.match_method = 'unmatched_singleton'""", "final_match likely_pairs"),
        "er_hot_key_pairs": """
SELECT k, CAST(n * (n - 1) / 2 AS BIGINT) AS pairs
FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS k, COUNT(*) AS n
      FROM orders GROUP BY 1) WHERE n > 1""",
        "bronze_csv_round_trip": query("\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, MD5(CONCAT_WS('|', "
            + ", ".join("'nan'" if c == _missing_column(x) else f"COALESCE({c}, 'nan')"
                        for c in x.columns) + f")) AS values_hash FROM landed_{n}"
            for n, x in SOURCES.items()), " ".join(f"landed_{n}" for n in SOURCES)),
        "stream_merged_claims": table("rcm_claim_header",
                                      ", ".join(SOURCES["rcm_claim_header"].columns)),
        "er_match_evidence": query(f"""
SELECT {_ENDS}, CONCAT_WS('; ', e.exact_rules, s.likeness) AS evidence
FROM (SELECT node_a, node_b, STRING_AGG(match_method, '; ' ORDER BY match_method) AS exact_rules
      FROM rule_hits GROUP BY 1, 2) e
FULL JOIN (SELECT node_a, node_b, CONCAT_WS('; ', 'score ' || CAST(confidence AS VARCHAR),
    CASE WHEN CAST(ln AS DECIMAL(4,3)) = 1 THEN 'same last name' END,
    CASE WHEN CAST(fn AS DECIMAL(4,3)) = 1 THEN 'same first name' END,
    CASE WHEN bd = 1 THEN 'same birth date' END, CASE WHEN ph = 1 THEN 'same phone' END,
    CASE WHEN ad = 1 THEN 'same address' END, CASE WHEN em = 1 THEN 'same email' END) AS likeness
  FROM scored_pairs) s USING (node_a, node_b)""", "rule_hits scored_pairs"),
        "er_clusters": table("final_match", "source_system, source_patient_key, cluster_id"),
        "er_clusters_4pass": table("final_match_4",
                                   "source_system, source_patient_key, cluster_id"),
        "er_crosswalk": table("final_match"),
        "er_crosswalk_4pass": table("final_match_4"),
        "er_match_quality": query(f"""
SELECT r AS right_pairs, f AS found_pairs, t AS true_pairs,
  ROUND(r / CAST(f AS DOUBLE), 6) AS precision_share, ROUND(r / CAST(t AS DOUBLE), 6) AS recall_share
FROM (SELECT {_pair_count('cluster_id, truth')} AS r, {_pair_count('cluster_id')} AS f,
             {_pair_count('truth')} AS t)""", "judged"),
        "gold_patient_source_xref": table("patient_source_xref"),
        "gold_dim_patient": table("dim_patient"),
        "gold_dim_patient_record_level": query(_best("patient_leads"), "patient_leads"),
    }
    out |= {n: table(n) for n in (
        "dim_date", "dim_provider", "dim_facility", "dim_counterparty_org", "dim_payer",
        "bridge_patient_counterparty", "bridge_pair", "fact_receivable", "fact_patient_balance",
        "fact_claim_line")}
    out |= {
        "bi_top_counterparties": _top_firms("bridge_patient_counterparty"),
        "bi_top_counterparties_once": _top_firms("bridge_pair"),
        "bi_top_balances": _balances(""),
        "bi_top20_balances": _balances("LIMIT 20"),
        "bi_ar_aging_payer": _aging("dim_payer", "payer_key", "payer_name"),
        "bi_ar_aging_facility": _aging("dim_facility", "facility_key", "facility_name"),
        "bi_denial_rate_payer": query(f"""
SELECT p.payer_name, {_DENIED} FROM fact_claim_line l
LEFT JOIN dim_payer p ON p.payer_key = l.payer_key GROUP BY 1
ORDER BY denial_rate_pct DESC, 1""", "fact_claim_line dim_payer"),
        "bi_denial_payer_cpt_facility": query(f"""
SELECT payer_key, cpt_code, facility_key, {_DENIED} FROM fact_claim_line GROUP BY 1, 2, 3""",
                                              "fact_claim_line"),
        "bi_bucket_summary": query("""
SELECT aging_bucket, COUNT(*) AS receivable_rows, SUM(total_ar_balance) AS total_ar,
  ROUND(CAST(SUM(total_ar_balance) AS DOUBLE) / COUNT(*), 2) AS average_ar
FROM fact_receivable GROUP BY 1""", "fact_receivable"),
        "bi_aging_levels": query("""
SELECT 'payer' AS level, payer_key, NULL AS facility_key, NULL AS counterparty_org_key, aging_bucket,
  SUM(total_ar_balance) AS total_ar, COUNT(*) AS receivable_rows
FROM fact_receivable GROUP BY payer_key, aging_bucket
UNION ALL
SELECT 'facility', NULL, facility_key, NULL, aging_bucket, SUM(total_ar_balance), COUNT(*)
FROM fact_receivable GROUP BY facility_key, aging_bucket
UNION ALL
SELECT 'all', NULL, NULL, NULL, aging_bucket, SUM(total_ar_balance), COUNT(*)
FROM fact_receivable GROUP BY aging_bucket
UNION ALL
SELECT 'counterparty', NULL, NULL, counterparty_org_key, aging_bucket, SUM(total_ar_balance), COUNT(*)
FROM fact_receivable JOIN bridge_pair USING (patient_id) GROUP BY 4, 5""",
                                 "fact_receivable bridge_pair"),
        "bi_ar_aging_counterparty": query("""
SELECT d.counterparty_org_key, d.counterparty_org_name, r.aging_bucket,
  SUM(r.total_ar_balance) AS total_ar, COUNT(DISTINCT r.claim_id) AS claims,
  COUNT(*) AS receivable_rows
FROM fact_receivable r JOIN bridge_pair b ON b.patient_id = r.patient_id
JOIN dim_counterparty_org d ON d.counterparty_org_key = b.counterparty_org_key
GROUP BY 1, 2, 3""", "fact_receivable bridge_pair dim_counterparty_org"),
        "bi_ar_by_fiscal_period": query(f"""
SELECT d.fiscal_year, d.fiscal_month, d.is_weekend, SUM(total_ar_balance) AS total_ar,
  SUM(CASE WHEN aging_bucket IN ({_LATE}) THEN total_ar_balance END) AS overdue_ar,
  COUNT(*) AS receivable_rows
FROM fact_receivable r JOIN dim_date d ON d.date_key = r.snapshot_date GROUP BY 1, 2, 3""",
                                       "fact_receivable dim_date"),
        "bi_denial_by_fiscal_period": query(f"""
SELECT d.fiscal_year, d.fiscal_month, {_DENIED}
FROM fact_claim_line l JOIN dim_date d ON d.date_key = l.submitted_date GROUP BY 1, 2""",
                                           "fact_claim_line dim_date"),
        "bi_turnaround": table("turnaround"),
        "bi_turnaround_summary": query("""
SELECT COUNT(*) AS orders, ROUND(AVG(turnaround_days), 4) AS average_days,
  MIN(turnaround_days) AS fastest_days, MAX(turnaround_days) AS slowest_days FROM turnaround""",
                                       "turnaround"),
        "bi_metrics_by_facility_month": query(f"""
SELECT facility_key, STRFTIME(snapshot_date, '%Y-%m') AS snapshot_month,
  SUM(total_ar_balance) AS ar_balance, SUM(payer_balance) AS payer_ar,
  SUM(patient_balance) AS patient_ar,
  SUM(CASE WHEN aging_bucket IN ({_LATE}) THEN total_ar_balance END) AS overdue_ar,
  COUNT(*) AS receivable_rows, COUNT(DISTINCT claim_id) AS claims
FROM fact_receivable GROUP BY 1, 2""", "fact_receivable"),
        "bi_metrics_by_cpt": query(f"""
SELECT cpt_code, {_DENIED}, SUM(charge_amount) AS charged, SUM(paid_amount) AS paid,
  ROUND(100.0 * CAST(SUM(paid_amount) AS DOUBLE) / CAST(SUM(charge_amount) AS DOUBLE), 2)
    AS collection_pct
FROM fact_claim_line GROUP BY 1""", "fact_claim_line"),
        "dq_dimension_coverage": query("\nUNION ALL\n".join(f"""
SELECT '{c}' AS dimension, COUNT({c}) AS filled, COUNT(*) AS total,
  ROUND(100.0 * COUNT({c}) / COUNT(*), 2) AS coverage_pct FROM fact_receivable""" for c in (
            "patient_id", "facility_key", "payer_key", "aging_bucket")), "fact_receivable"),
        "dq_orphans": query("""
SELECT 'claim_line_to_header' AS reference, COUNT(*) AS orphan_rows FROM rcm_claim_line
WHERE claim_id NOT IN (SELECT claim_id FROM rcm_claim_header)
UNION ALL
SELECT 'encounter_to_patient', COUNT(*) FROM emr_encounter
WHERE emr_patient_id NOT IN (SELECT emr_patient_id FROM emr_patient)
UNION ALL
SELECT 'receivable_to_patient', COUNT(*) FROM fact_receivable
WHERE patient_id NOT IN (SELECT patient_id FROM dim_patient)""",
                            "rcm_claim_line rcm_claim_header emr_encounter emr_patient "
                            "fact_receivable dim_patient"),
        "dq_load_quality": query("\nUNION ALL\n".join(f"""
SELECT _source_system, _source_file, landed_rows, repeated_rows, newest_load,
  UNNEST([{', '.join(f"'{c}'" for c in x.columns)}]) AS column_name,
  UNNEST([{', '.join(f"f_{c}" for c in x.columns)}]) AS filled_share
FROM (SELECT _source_system, _source_file, COUNT(*) AS landed_rows,
        COUNT(*) - COUNT(DISTINCT _row_hash) AS repeated_rows, MAX(_ingested_at) AS newest_load,
        {', '.join(f"ROUND(COUNT({c}) / CAST(COUNT(*) AS DOUBLE), 4) AS f_{c}" for c in x.columns)}
      FROM landed_{n} GROUP BY 1, 2)""" for n, x in SOURCES.items()),
            " ".join(f"landed_{n}" for n in SOURCES)),
        "dq_cardinality": query("""
SELECT *, ROUND(new_members / CAST(known_before AS DOUBLE), 4) AS growth,
  COALESCE(ROUND(new_members / CAST(known_before AS DOUBLE), 4) > 0.5, FALSE) AS spike
FROM (SELECT *, CAST(SUM(new_members) OVER (PARTITION BY dimension ORDER BY load_day
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS known_before
      FROM (SELECT dimension, load_day, COUNT(*) AS new_members FROM (
        SELECT dimension, member, MIN(load_day) AS load_day FROM (""" + "\nUNION ALL\n".join(
            f"SELECT '{d}' AS dimension, {c} AS member, CAST(_ingested_at AS DATE) AS load_day"
            f" FROM landed_{t}" for d, (t, c) in DIMENSION_MEMBERS.items()) + """)
        WHERE member IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 2))""",
                                " ".join(f"landed_{t}" for t, _ in DIMENSION_MEMBERS.values())),
        "dq_fact_volumes": query("""
SELECT *, ROUND((row_count - previous_count) / CAST(previous_count AS DOUBLE), 4) AS change,
  COALESCE(ABS(ROUND((row_count - previous_count) / CAST(previous_count AS DOUBLE), 4)) > 0.2, FALSE)
    AS unusual
FROM (SELECT *, LAG(row_count) OVER (PARTITION BY fact, month IS NULL ORDER BY month) AS previous_count
      FROM (""" + "\nUNION ALL\n".join(
            f"SELECT '{t}' AS fact, STRFTIME({c}, '%Y-%m') AS month, COUNT(*) AS row_count"
            f" FROM {t} GROUP BY 2" for t, c in (
                ("fact_receivable", "snapshot_date"), ("fact_patient_balance", "snapshot_date"),
                ("fact_claim_line", "submitted_date"))) + "))",
                                 "fact_receivable fact_patient_balance fact_claim_line"),
        "dq_reconcile_claim_line": query("\nUNION ALL\n".join(f"""
SELECT '{m}' AS measure, f AS fact_sum, s AS source_sum, f - s AS difference
FROM (SELECT (SELECT SUM({m}_amount) FROM fact_claim_line) AS f,
  (SELECT SUM({m}_amount) FROM rcm_claim_line) AS s)""" for m in ("charge", "allowed", "paid")),
                                         "fact_claim_line rcm_claim_line"),
        "dq_reconcile_patient_balance": query("\nUNION ALL\n".join(f"""
SELECT '{m}' AS measure, f AS fact_sum, s AS source_sum, f - s AS difference
FROM (SELECT (SELECT SUM({a}) FROM fact_patient_balance) AS f,
  (SELECT SUM({b}) FROM fact_receivable WHERE patient_id IS NOT NULL) AS s)""" for m, a, b in (
            ("outstanding", "total_outstanding", "total_ar_balance"),
            ("payer", "total_payer_balance", "payer_balance"),
            ("patient", "total_patient_balance", "patient_balance"))),
                                              "fact_patient_balance fact_receivable"),
        "dq_reconcile_receivable": query("\nUNION ALL\n".join(f"""
SELECT '{m}' AS measure, f AS fact_sum, s AS source_sum, f - s AS difference
FROM (SELECT (SELECT SUM({m}_balance) FROM fact_receivable) AS f,
  (SELECT SUM({m}_responsibility_balance) FROM rcm_ar_balance_snapshot) AS s)"""
                                                            for m in ("payer", "patient")),
                                         "fact_receivable rcm_ar_balance_snapshot"),
        "dq_masked_patient": query("""
SELECT emr_patient_id,
  SHA256('{key}|outer|' || SHA256('{key}|inner|' || ssn_last4)) AS ssn_last4,
  CASE WHEN phone <> '' THEN '***' || RIGHT(phone, 2) END AS phone FROM emr_patient""".replace("{key}", TEST_KEY),
                                   "emr_patient"),
        "dq_checks_clean": _checks(checks.CLEAN_CHECKS),
        "dq_checks_linkage": _checks(checks.LINKAGE_CHECKS),
        "dq_checks_star": _checks(checks.STAR_CHECKS),
    }
    return out | _made_and_external()
