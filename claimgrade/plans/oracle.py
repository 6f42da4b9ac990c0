"""The same questions in DuckDB SQL, written apart from the Spark operators.

Each oracle is a chain of named sub-queries followed by one SELECT. Which of them an
oracle needs is found by looking for their names in its text.
"""

from __future__ import annotations

import re

from claimgrade import config as texts
from claimgrade.config import FACILITY
from claimgrade.review import parse, prompts
from claimgrade.review.inputs import FINGERPRINT_LISTS, FINGERPRINT_PARTS
from claimgrade.sources import testdata

AS_OF = testdata.AS_OF
SNAPSHOT = testdata.SNAPSHOT_TS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(i) for i in items) + "]::VARCHAR[]"


def _array(column: str) -> str:
    """JSON array text -> list, NULL for anything else."""
    return (
        f"CASE WHEN TRY(json_type({column})) = 'ARRAY' THEN"
        f" list_transform(json_extract({column}, '$[*]'), lambda j: j ->> '$') END"
    )


def _int(column: str, sql_type: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+') THEN TRY_CAST({column} AS {sql_type}) END"


def _title(expression: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({expression}), ' '),"
        " lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def _sentence(template: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(
        (f"CAST({p} AS VARCHAR)" if i % 2 else _q(p)) for i, p in enumerate(parts) if p
    )


_SYNONYMS = ", ".join(
    f"({_q(word)}, {_q(name)})" for name, words in FACILITY.regions.synonyms.items() for word in words
)
_LEXICON = ",\n".join(
    "("
    + ", ".join(
        [
            _q(t.capability),
            _list(t.structured),
            _list(t.structured_prefix),
            _list(t.claim),
            _list(t.prose),
            _list(t.screening_any),
            _list(t.screening_none),
            str(t.high_acuity).lower(),
        ]
    )
    + ")"
    for t in FACILITY.lexicon
)


def _found(text: str, terms: str) -> str:
    return f"len(list_filter({terms}, lambda t: contains({text}, t))) > 0"


_REGION = f"""
CASE
  WHEN lower(trim(address_stateOrRegion)) IN (SELECT word FROM synonyms)
    THEN (SELECT canonical FROM synonyms WHERE word = lower(trim(address_stateOrRegion)))
  WHEN trim(address_stateOrRegion) = '' OR trim(address_stateOrRegion) = 'null' THEN NULL
  ELSE {_title('trim(address_stateOrRegion)')}
END
"""

_TABLE = re.compile(rf"@({'|'.join(testdata.COLUMNS)})\b")
# DuckDB writes the order of a joined list inside the call
_ORDERED = re.compile(r"\) WITHIN GROUP \((ORDER BY [^)]*)\)")
CTES: dict[str, str] = {name: _ORDERED.sub(r" \1)", _TABLE.sub(r"\1", text)) for name, (text, _) in testdata.SOURCES.items()}
CTES["synonyms"] = f"SELECT * FROM (VALUES {_SYNONYMS}) s(word, canonical)"
CTES["lexicon"] = (
    f"SELECT * FROM (VALUES {_LEXICON}) l(capability, structured, prefixes, claim, prose, disease, treatment, acute)"
)
CTES["typed"] = f"""
SELECT
  unique_id, source_content_id, cluster_id, name,
  if(facilityTypeId = 'farmacy', 'pharmacy', facilityTypeId) AS facility_type,
  operatorTypeId AS operator_type,
  {_int('numberDoctors')} AS num_doctors,
  {_int('capacity')} AS capacity_beds,
  capability, specialties, procedure, equipment, description,
  {_array('capability')} AS capability_arr,
  {_array('specialties')} AS specialties_arr,
  {_array('procedure')} AS procedure_arr,
  {_array('equipment')} AS equipment_arr,
  {_array('websites')} AS websites_arr,
  {_array('source_urls')} AS source_urls_arr,
  {_array('source_types')} AS source_types_arr,
  if(source_urls IS NULL, 0, len({_array('source_urls')})) AS n_source_urls,
  affiliated_staff_presence = 'true' AS staff_present,
  custom_logo_presence = 'true' AS logo_present,
  {_int('distinct_social_media_presence_count')} AS social_presence_count,
  officialWebsite AS official_website, facebookLink AS facebook_link, source, recency_of_page_update,
  address_line1, address_city, address_stateOrRegion AS state_raw,
  {_REGION} AS state_norm,
  {_int('address_zipOrPostcode', 'BIGINT')} AS pincode,
  address_country, latitude, longitude, facilityTypeId,
  lower(ifnull(specialties, '') || ' ' || ifnull(equipment, '')) AS spec_eq_text,
  lower(ifnull(capability, '')) AS claim_text,
  lower(ifnull(description, '') || ' ' || ifnull(procedure, '')) AS prose_text,
  lower(ifnull(capability, '') || ' ' || ifnull(specialties, '') || ' ' || ifnull(procedure, '') || ' '
    || ifnull(equipment, '') || ' ' || ifnull(description, '')) AS full_text
FROM raw_facilities
"""
CTES["cluster_heads"] = f"""
SELECT DISTINCT ON (ifnull(cluster_id, unique_id)) * FROM typed
WHERE name IS NOT NULL AND list_contains({_list(FACILITY.valid_types)}, facilityTypeId)
ORDER BY ifnull(cluster_id, unique_id), n_source_urls DESC NULLS LAST, unique_id, source_content_id
"""
CTES["entities"] = """
SELECT DISTINCT ON (unique_id) * FROM cluster_heads
ORDER BY unique_id, n_source_urls DESC NULLS LAST, source_content_id
"""
CTES["quarantined"] = f"""
SELECT source_content_id, unique_id, facilityTypeId,
  array_to_string(list_filter([if(name IS NULL, 'missing_name', NULL),
    if(NOT list_contains({_list(FACILITY.valid_types)}, facilityTypeId), 'invalid_type', NULL)], lambda x: x IS NOT NULL), ',') AS reason
FROM raw_facilities
WHERE name IS NULL OR NOT list_contains({_list(FACILITY.valid_types)}, facilityTypeId)
UNION ALL
SELECT source_content_id, unique_id, facilityTypeId, 'duplicate_id'
FROM cluster_heads
WHERE source_content_id NOT IN (SELECT source_content_id FROM entities)
"""
CTES["bridge"] = f"""
SELECT DISTINCT ON (pincode) pincode, district_norm, bridge_state AS state_name
FROM (
  SELECT pincode, upper(trim(district)) AS district_norm, {_title('trim(statename)')} AS bridge_state, count(*) AS n
  FROM raw_pincode_directory GROUP BY ALL
)
ORDER BY pincode, n DESC, district_norm, bridge_state
"""
CTES["profiles"] = """
SELECT e.*, b.district_norm, ifnull(b.state_name, e.state_norm) AS state_name
FROM entities e LEFT JOIN bridge b USING (pincode)
"""
CTES["indicators"] = """
SELECT
  upper(trim(district_name)) AS district_norm,
  trim(state_ut) AS state_ut,
  institutional_birth_5y_pct,
  institutional_birth_in_public_facility_5y_pct,
  births_delivered_by_csection_5y_pct,
  TRY_CAST(nullif(trim(translate(mothers_who_had_at_least_4_anc_visits_lb5y_pct, '()*', '')), '') AS DOUBLE) AS anc_4plus_visits_pct,
  hh_member_covered_health_insurance_pct AS health_insurance_pct,
  women_age_30_49_years_ever_undergone_a_breast_exam_pct AS breast_exam_pct,
  women_age_30_49_years_ever_undergone_a_cervical_screen_pct AS cervical_screen_pct,
  women_age_30_49_years_ever_undergone_an_oral_cancer_exam_pct AS oral_cancer_exam_pct,
  all_w15_49_who_are_anaemic_pct AS anaemia_women_pct,
  w15_plus_with_high_bp_sys_gte_140_mmhg_and_or_dia_gte_90_mm_pct AS hypertension_women_pct,
  w15_plus_with_high_or_very_high_gt_140_mg_dl_blood_sugar_or_pct AS high_bloodsugar_women_pct
FROM raw_district_indicators
"""
CTES["flags"] = f"""
SELECT
  p.* EXCLUDE (capability),
  p.capability AS capability_raw,
  if(capacity_beds BETWEEN 1 AND 5000, capacity_beds, NULL) AS beds_sane,
  if(num_doctors BETWEEN 1 AND 2000, num_doctors, NULL) AS docs_sane,
  ifnull(capacity_beds BETWEEN 20 AND 5000, false) OR ifnull(num_doctors BETWEEN 10 AND 2000, false) AS capacity_supported,
  ifnull(capacity_beds BETWEEN 0 AND 4, false) AND NOT ifnull(num_doctors BETWEEN 2 AND 2000, false) AS capacity_contradicts,
  n_source_urls >= 3 AND lower(ifnull(official_website, '')) NOT IN ('', 'null') AND staff_present AS well_corroborated,
  TRY_CAST(recency_of_page_update AS DATE) AS page_updated,
  ifnull(TRY_CAST(recency_of_page_update AS DATE) >= DATE '{AS_OF}' - INTERVAL 12 MONTH, false) AS recent_update
FROM profiles p
"""
CTES["hits"] = f"""
SELECT
  f.*,
  l.capability,
  l.acute,
  {_found('spec_eq_text', 'l.structured')}
    OR len(list_filter(l.prefixes, lambda t: starts_with(spec_eq_text, t))) > 0 AS structured_hit,
  {_found('claim_text', 'l.claim')} AS claim_hit,
  {_found('prose_text', 'l.prose')} AS prose_hit,
  {_found('full_text', 'l.disease')} AND NOT {_found('full_text', 'l.treatment')} AS screening_only
FROM flags f, lexicon l
"""
_NO_EVIDENCE = f"""
CASE
  WHEN well_corroborated AND recent_update THEN {_q(texts.NO_EVIDENCE_SOURCED_RECENT)}
  WHEN well_corroborated THEN {_q(texts.NO_EVIDENCE_SOURCED)}
  WHEN recent_update THEN {_q(texts.NO_EVIDENCE_RECENT)}
  ELSE {_q(texts.NO_EVIDENCE)}
END
"""
_LIMITED = texts.LIMITED.split("{channels}")
_FOUND_IN = f"""
{_q(_LIMITED[0])} || CASE
  WHEN structured_hit AND claim_hit THEN {_q(texts.CHANNEL_STRUCTURED + ' and ' + texts.CHANNEL_CLAIM)}
  WHEN structured_hit THEN {_q(texts.CHANNEL_STRUCTURED)}
  ELSE {_q(texts.CHANNEL_CLAIM)}
END || {_q(_LIMITED[1])}
"""
_POINTS = "if(tier = 'strong', 90, if(tier = 'partial', 60, if(tier = 'weak_suspicious', 30, 0)))"
_SCORE = f"CAST({_POINTS} + least(ifnull(n_source_urls, 0), 10) + if(recent_update, 10, 0) AS INTEGER)"
CTES["judged"] = f"""
SELECT
  * EXCLUDE (acute),
  acute AND (structured_hit OR claim_hit OR prose_hit) AND (
    capacity_contradicts
    OR (NOT capacity_supported AND list_contains({_list(FACILITY.plausibility.small_types)}, facility_type))
  ) AS implausible,
  CASE
    WHEN greatest(structured_hit, claim_hit, prose_hit) = false THEN 'no_claim'
    WHEN (screening_only AND capability = 'oncology' AND NOT structured_hit) OR implausible THEN 'weak_suspicious'
    WHEN structured_hit THEN if(ifnull(well_corroborated, false), 'strong', 'partial')
    WHEN claim_hit THEN 'partial'
    ELSE 'weak_suspicious'
  END AS tier
FROM hits
"""
CTES["graded"] = f"""
SELECT
  *,
  {_SCORE} AS score,
  CASE
    WHEN tier = 'no_claim' THEN {_NO_EVIDENCE}
    WHEN screening_only AND capability = 'oncology' AND NOT structured_hit THEN {_q(texts.SCREENING_ONLY_BASELINE)}
    WHEN implausible AND capacity_contradicts THEN {_sentence(texts.CAPACITY_TOO_SMALL)}
    WHEN implausible THEN {_sentence(texts.IMPLAUSIBLE_BASELINE)}
    WHEN tier = 'strong' THEN {_sentence(texts.WELL_SUPPORTED)}
    WHEN tier = 'partial' THEN {_FOUND_IN}
    ELSE {_q(texts.PROSE_ONLY)}
  END AS explanation
FROM judged
"""


def _fingerprint_part(name: str) -> str:
    column = {
        "specialties_raw": "specialties",
        "procedure_raw": "procedure",
        "equipment_raw": "equipment",
        "description_raw": "description",
        "citation_urls": "source_urls_arr",
    }.get(name, name)
    if name in FINGERPRINT_LISTS:
        return f"ifnull(CAST(to_json({column}) AS VARCHAR), '[]')"
    return f"ifnull(CAST({column} AS VARCHAR), '')"


CTES["inputs"] = f"""
SELECT *, sha256({" || '||' || ".join(_fingerprint_part(p) for p in FINGERPRINT_PARTS)}) AS evidence_fingerprint
FROM graded
"""
CTES["reviews"] = f"""
SELECT
  r.unique_id, r.capability,
  if(event_id % 3 = 0 AND i.evidence_fingerprint IS NOT NULL, i.evidence_fingerprint, 'old-' || event_id) AS evidence_fingerprint,
  r.prompt_version, 'm-a' AS model_name, NULL::VARCHAR AS model_version, r.run_id,
  TIMESTAMP '{SNAPSHOT}' AS source_snapshot_ts, r.inference_ts, r.record AS parsed_json
FROM responses r LEFT JOIN inputs i ON i.unique_id = r.unique_id AND i.capability = r.capability
"""
CTES["latest"] = """
SELECT DISTINCT ON (unique_id, capability) * FROM reviews
ORDER BY unique_id, capability, inference_ts DESC, prompt_version DESC, run_id DESC, parsed_json DESC, evidence_fingerprint DESC
"""


def _read(field: str) -> str:
    return f"if(json_valid(parsed_json), parsed_json ->> '$.{field}', NULL)"


def _typed_review(source: str) -> str:
    tri = ", ".join(
        f"CASE {_read(f)} WHEN 'true' THEN true WHEN 'false' THEN false END AS {f}_llm"
        for f in ("claim_hit", "prose_hit", "screening_only")
    )
    return f"""
SELECT
  * EXCLUDE (parsed_json), {tri},
  nullif({_read('capability_scope')}, '') AS capability_scope_llm,
  CASE
    WHEN json_valid(parsed_json) AND json_type(parsed_json, '$.supporting_snippets') = 'ARRAY'
      THEN list_transform(json_extract(parsed_json, '$.supporting_snippets[*]'), lambda j: j ->> '$')
    ELSE []
  END AS supporting_snippets_llm,
  TRY_CAST({_read('confidence')} AS DOUBLE) AS confidence_llm,
  nullif({_read('reasoning')}, '') AS reasoning_llm
FROM {source}
"""


CTES["typed_reviews"] = _typed_review("reviews")
CTES["typed_latest"] = _typed_review("latest")
CTES["reviewed"] = """
SELECT
  i.*,
  r.unique_id IS NOT NULL AS has_llm_review,
  CASE WHEN r.unique_id IS NULL THEN 'missing' WHEN r.evidence_fingerprint = i.evidence_fingerprint THEN 'current'
    ELSE 'stale' END AS llm_review_status,
  r.evidence_fingerprint AS reviewed_evidence_fingerprint,
  r.* EXCLUDE (unique_id, capability, evidence_fingerprint)
FROM inputs i LEFT JOIN typed_latest r ON r.unique_id = i.unique_id AND r.capability = i.capability
"""
CTES["overlaid"] = """
SELECT
  * EXCLUDE (tier, score, explanation, claim_hit, prose_hit, screening_only),
  tier AS heuristic_tier, score AS heuristic_score, explanation AS heuristic_explanation,
  claim_hit AS heuristic_claim_hit, prose_hit AS heuristic_prose_hit, screening_only AS heuristic_screening_only,
  llm_review_status = 'current' AS current_llm_review,
  if(llm_review_status = 'current', capability_scope_llm, NULL) AS capability_scope,
  if(llm_review_status = 'current' AND claim_hit_llm IS NOT NULL, claim_hit_llm, claim_hit) AS claim_hit,
  if(llm_review_status = 'current' AND prose_hit_llm IS NOT NULL, prose_hit_llm, prose_hit) AS prose_hit,
  if(llm_review_status <> 'current', screening_only,
    ifnull(capability_scope_llm, '') = 'screening_or_diagnostics_only' OR ifnull(screening_only_llm, screening_only)) AS screening_only
FROM reviewed
"""
CTES["retiered"] = """
SELECT
  *,
  CASE
    WHEN NOT structured_hit AND NOT claim_hit AND NOT prose_hit THEN 'no_claim'
    WHEN ifnull(capability_scope, '') IN ('screening_or_diagnostics_only', 'adjacent_service') THEN 'weak_suspicious'
    WHEN (screening_only AND capability = 'oncology' AND NOT structured_hit) OR implausible THEN 'weak_suspicious'
    WHEN structured_hit THEN if(ifnull(well_corroborated, false), 'strong', 'partial')
    WHEN claim_hit THEN 'partial'
    ELSE 'weak_suspicious'
  END AS tier
FROM overlaid
"""
CTES["mart"] = f"""
SELECT
  *,
  {_SCORE} AS score,
  CASE
    WHEN tier = 'no_claim' THEN {_NO_EVIDENCE}
    WHEN capability_scope = 'screening_or_diagnostics_only' THEN {_sentence(texts.SCOPE_SCREENING)}
    WHEN capability_scope = 'adjacent_service' THEN {_sentence(texts.SCOPE_ADJACENT)}
    WHEN screening_only AND capability = 'oncology' AND NOT structured_hit THEN {_q(texts.SCREENING_ONLY_FINAL)}
    WHEN implausible THEN {_sentence(texts.IMPLAUSIBLE_FINAL)}
    WHEN tier = 'strong' THEN {_sentence(texts.WELL_SUPPORTED)}
    WHEN tier = 'partial' THEN {_FOUND_IN}
    ELSE {_q(texts.PROSE_ONLY)}
  END AS explanation
FROM retiered
"""
CTES["of_prompt"] = f"""
SELECT unique_id, capability,
  arg_max(evidence_fingerprint, (inference_ts, run_id, parsed_json, evidence_fingerprint)) AS evidence_fingerprint
FROM reviews WHERE prompt_version = {_q(testdata.PROMPT_VERSION)} GROUP BY ALL
"""
CTES["pending"] = f"""
SELECT i.unique_id, i.capability, i.name AS facility_name, i.evidence_fingerprint, {_q(SNAPSHOT)} AS source_snapshot_ts
FROM inputs i LEFT JOIN of_prompt p ON p.unique_id = i.unique_id AND p.capability = i.capability
WHERE p.evidence_fingerprint IS DISTINCT FROM i.evidence_fingerprint
"""

_ANSWER_TEXT = """
coalesce(
  if(json_type(raw_response_json, '$.choices[0].message.content') = 'VARCHAR', raw_response_json ->> '$.choices[0].message.content', NULL),
  raw_response_json ->> '$.choices[0].message.content[0].text',
  raw_response_json ->> '$.output[1].content[0].text',
  if(json_type(raw_response_json, '$.predictions[0]') = 'VARCHAR', raw_response_json ->> '$.predictions[0]', NULL),
  raw_response_json ->> '$.predictions[0].text',
  raw_response_json ->> '$.output_text'
)
"""


def _answers(source: str) -> str:
    # a text is cut to its braces only when it is not JSON as it stands
    return f"""
SELECT *, CASE WHEN json_valid(bare) THEN bare WHEN json_valid(cut) THEN cut END AS answer
FROM (
  SELECT *, regexp_extract(bare, '(?s)\\{{.*\\}}') AS cut
  FROM (
    SELECT *, if(starts_with(assistant_text, '```'),
      trim(regexp_replace(regexp_replace(assistant_text, '^```[a-z]*\\n', ''), '\\n```$', ''), E' \\n'),
      trim(assistant_text, E' \\n')) AS bare
    FROM (SELECT *, {_ANSWER_TEXT} AS assistant_text FROM {source})
  )
)
"""


CTES["answers"] = _answers("responses")
CTES["batch_answers"] = _answers("batch_responses")

_TRUE = _list(parse.TRUE_TEXTS)
_FALSE = _list(parse.FALSE_TEXTS)
_ERROR = (
    f"CASE WHEN assistant_text IS NULL THEN {_q(parse.NO_TEXT)} WHEN answer IS NULL THEN {_q(parse.NO_OBJECT)} END"
)


def _tri(source: str, field: str) -> str:
    value = f"lower({source} ->> '$.{field}')"
    return f"CASE WHEN list_contains({_TRUE}, {value}) THEN true WHEN list_contains({_FALSE}, {value}) THEN false END"


CTES["validated"] = f"""
SELECT
  *,
  {", ".join(f"{_tri('answer', f)} AS {f}" for f in parse.BOOLEAN_FIELDS)},
  answer ->> '$.capability_scope' AS capability_scope,
  TRY_CAST(answer ->> '$.confidence' AS DOUBLE) AS confidence,
  answer ->> '$.reasoning' AS reasoning,
  array_to_string(list_filter(list_transform(json_extract(answer, '$.supporting_snippets[*]'), lambda j: trim(j ->> '$')),
    lambda t: t <> ''), '|') AS supporting_snippets
FROM answers
"""
_CAPS = _list(FACILITY.capabilities)
CTES["batch_items"] = """
SELECT event_id, i.position, i.item
FROM batch_answers, unnest(list_transform(json_extract(answer, '$.results[*]'), lambda j, n: {'position': n, 'item': j})) u(i)
WHERE json_type(answer, '$.results') = 'ARRAY'
"""
CTES["batch_checked"] = f"""
SELECT
  b.*,
  CASE
    WHEN assistant_text IS NULL THEN {_q(parse.NO_TEXT)}
    WHEN answer IS NULL THEN {_q(parse.NO_OBJECT)}
    WHEN json_type(answer, '$.results') <> 'ARRAY' THEN 'no list of results'
    WHEN len(list_filter(json_keys(answer), lambda k: k <> 'results')) > 0
      THEN 'unknown keys: ' || array_to_string(list_filter(json_keys(answer), lambda k: k <> 'results'), ', ')
    WHEN c.bad > 0 THEN rtrim(repeat('bad confidence; ', c.bad::BIGINT), '; ')
    WHEN len(c.missing) > 0 THEN 'missing capabilities: ' || array_to_string(c.missing, ', ')
  END AS error
FROM batch_answers b
LEFT JOIN (
  SELECT
    event_id,
    count(*) FILTER (NOT ifnull(TRY_CAST(item ->> '$.confidence' AS DOUBLE) BETWEEN 0 AND 1, true)) AS bad,
    list_sort(list_filter({_CAPS}, lambda c: NOT list_contains(list(lower(item ->> '$.capability')), c))) AS missing
  FROM batch_items GROUP BY event_id
) c USING (event_id)
"""
CTES["override_problems"] = """
SELECT
  unique_id, capability, action, tier, trim(note) AS note, ts, actor_email,
  if(action = 'save' AND ifnull(trim(note), '') = '', 'no_note', NULL) AS problem
FROM override_events
"""
CTES["in_force"] = """
SELECT * EXCLUDE (action, problem) FROM (
  SELECT DISTINCT ON (unique_id, capability) * FROM override_problems WHERE problem IS NULL
  ORDER BY unique_id, capability, ts DESC, action
) WHERE action = 'save'
"""
CTES["effective"] = """
SELECT m.*, ifnull(o.tier, m.tier) AS effective_tier, o.unique_id IS NOT NULL AS has_local_override,
  o.note AS override_note, o.ts AS override_ts
FROM mart m LEFT JOIN in_force o ON o.unique_id = m.unique_id AND o.capability = m.capability
"""

ORACLES: dict[str, str] = {}


def _with(select: str, raw: str = "raw_facilities") -> str:
    """Put the sub-queries a text needs in front of it, in order of definition."""
    names = [n for n in CTES if n not in ("raw_facilities", "raw_documents") or n == raw]
    needed: set[str] = set()
    open_texts = [(select, len(names))]
    while open_texts:
        text, before = open_texts.pop()
        for i, name in enumerate(names[:before]):
            asked = "raw_facilities" if name == raw else name
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{asked}\b", text):
                needed.add(name)
                open_texts.append((CTES[name], i))
    chain = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in names if n in needed]
    return f"WITH {', '.join(chain)}\n{select}" if chain else select


def _oracle(name: str, select: str, raw: str = "raw_facilities") -> None:
    """``raw`` names the raw table that stands for the facilities."""
    ORACLES[name] = re.sub(r"\bFROM raw_facilities\b", f"FROM {raw}", _with(select, raw))


_IDS = "unique_id, capability"
_TIME = "'%Y-%m-%d %H:%M:%S'"


def _joined(column: str) -> str:
    return f"array_to_string({column}, '|')"


_oracle(
    "clean_entities",
    "SELECT unique_id, source_content_id, cluster_id, name, facility_type, operator_type, num_doctors,"
    " capacity_beds, n_source_urls, staff_present, logo_present, social_presence_count, official_website,"
    " facebook_link, source, recency_of_page_update, address_line1, address_city, state_raw, state_norm,"
    " pincode, address_country, latitude, longitude FROM entities",
)
_oracle("clean_quarantine", "SELECT * FROM quarantined")
_ARRAYS = (
    "capability_arr",
    "specialties_arr",
    "procedure_arr",
    "equipment_arr",
    "websites_arr",
    "source_urls_arr",
    "source_types_arr",
)
_oracle(
    "clean_arrays",
    " UNION ALL ".join(
        f"SELECT source_content_id, '{c}' AS column_name, CAST(generate_subscripts({c}, 1) - 1 AS INTEGER) AS position,"
        f" unnest({c}) AS item FROM typed"
        for c in _ARRAYS
    ),
)
_oracle("clean_region", "SELECT state_raw, state_norm, count(*) AS n_rows FROM typed GROUP BY ALL")
_oracle("text_channels", "SELECT source_content_id, spec_eq_text, claim_text, prose_text, full_text FROM typed")
_oracle("dedupe_richest", "SELECT unique_id, source_content_id, cluster_id, n_source_urls FROM entities")
_oracle("clean_indicators", "SELECT * FROM indicators")
_oracle("bridge_dominant", "SELECT * FROM bridge")
_oracle(
    "geo_resolve",
    "SELECT unique_id, name, facility_type, operator_type, num_doctors, capacity_beds, address_city, pincode,"
    " district_norm, state_name, state_norm AS facility_state_norm, latitude, longitude FROM profiles",
)
_oracle(
    "need_index",
    """
SELECT district_norm, state_ut,
  round(CASE WHEN institutional_birth_5y_pct IS NULL THEN 50.0 WHEN institutional_birth_5y_pct > 100 THEN 0.0
    ELSE 100 - institutional_birth_5y_pct END, 1) AS maternity_need,
  round(100 - (ifnull(breast_exam_pct, 0) + ifnull(cervical_screen_pct, 0) + ifnull(oral_cancer_exam_pct, 0)) / 3, 1) AS oncology_screening_gap,
  round(ifnull(hypertension_women_pct, 0), 1) AS hypertension_burden,
  round(ifnull(high_bloodsugar_women_pct, 0), 1) AS diabetes_burden,
  round(ifnull(anaemia_women_pct, 0), 1) AS anaemia_burden,
  institutional_birth_5y_pct, births_delivered_by_csection_5y_pct, breast_exam_pct, cervical_screen_pct,
  oral_cancer_exam_pct, health_insurance_pct
FROM indicators
""",
)
_oracle("evidence_hits", f"SELECT {_IDS}, structured_hit, claim_hit, prose_hit, screening_only FROM hits")
_oracle("evidence_lexicon", f"SELECT {_IDS}, structured_hit, claim_hit, prose_hit, screening_only FROM hits")
_oracle(
    "lexicon_passages",
    """
SELECT source_content_id, p.capability, count_if(contains(claim_text, term)) > 0 AS claim_hit,
  count_if(contains(prose_text, term)) > 0 AS prose_hit
FROM typed, (
  SELECT DISTINCT 'c' || (item_id % 6) AS capability, w[i] || ' ' || w[i + 1] AS term
  FROM (SELECT item_id, string_split(lower(text), ' ') AS w FROM benchmark), range(1, len(w)) r(i)
) p GROUP BY source_content_id, p.capability
""",
    "raw_documents",
)
_oracle(
    "screening_only",
    f"SELECT source_content_id, l.capability, {_found('full_text', 'l.disease')} AND NOT {_found('full_text', 'l.treatment')}"
    " AS screening_only FROM typed, lexicon l WHERE len(l.disease) > 0",
)
_oracle(
    "plausibility",
    f"SELECT {_IDS}, facility_type, beds_sane, docs_sane, capacity_supported, capacity_contradicts, implausible FROM judged",
)
_oracle(
    "corroboration",
    "SELECT source_content_id, n_source_urls, staff_present, n_source_urls >= 3"
    " AND lower(ifnull(official_website, '')) NOT IN ('', 'null') AND staff_present AS well_corroborated FROM typed",
)
_oracle(
    "recency_bonus",
    f"SELECT source_content_id, strftime(d, '%Y-%m-%d') AS page_updated, ifnull(d >= DATE '2000-08-01', false) AS recent_update"
    " FROM (SELECT source_content_id, TRY_CAST(recency_of_page_update AS DATE) AS d FROM typed)",
)
_oracle(
    "grade_heuristic",
    f"SELECT {_IDS}, name, facility_type, operator_type, district_norm, state_name, latitude, longitude, tier, score,"
    " structured_hit, claim_hit, prose_hit, screening_only, well_corroborated, implausible, n_source_urls,"
    f" official_website, staff_present, {_joined('source_urls_arr')} AS citation_urls FROM graded",
)
_oracle(
    "story_grades",
    f"SELECT {_IDS}, tier, score, structured_hit, claim_hit, prose_hit, screening_only, explanation FROM graded",
    "raw_documents",
)
_oracle(
    "story_payload",
    f"SELECT {_IDS}, evidence_fingerprint, description, claim_text, full_text FROM inputs",
    "raw_documents",
)
_oracle("explain_heuristic", f"SELECT {_IDS}, tier, explanation FROM graded")


def _text(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {alias or column}"


_BASE_DOCUMENT = ", ".join(
    [
        *[
            _text(c)
            for c in (
                "structured_hit",
                "claim_hit",
                "prose_hit",
                "screening_only",
                "well_corroborated",
                "implausible",
                "n_source_urls",
            )
        ],
        "if(lower(official_website) IN ('', 'null'), NULL, official_website) AS official_website",
        _text("recent_update"),
        "strftime(page_updated, '%Y-%m-%d') AS page_updated",
        _text("capacity_supported"),
        _text("beds_sane", "beds"),
        _text("docs_sane", "num_doctors"),
    ]
)
_oracle("evidence_document", f"SELECT {_IDS}, {_BASE_DOCUMENT} FROM graded")
_oracle(
    "evidence_readback",
    f"SELECT {_IDS}, recent_update, strftime(page_updated, '%Y-%m-%d') AS page_updated, capacity_supported, beds_sane,"
    " docs_sane FROM graded",
)
_oracle("review_fingerprint", f"SELECT {_IDS}, evidence_fingerprint FROM inputs")
_oracle(
    "review_inputs",
    f"""
SELECT {_IDS}, name, facility_type, operator_type, district_norm, state_name, address_city, pincode, latitude, longitude,
  num_doctors, capacity_beds, source_content_id, {_q(SNAPSHOT)} AS input_snapshot_ts, evidence_fingerprint,
  tier AS heuristic_tier, score AS heuristic_score, explanation AS heuristic_explanation,
  structured_hit AS heuristic_structured_hit, claim_hit AS heuristic_claim_hit, prose_hit AS heuristic_prose_hit,
  screening_only AS heuristic_screening_only, well_corroborated AS heuristic_well_corroborated,
  implausible AS heuristic_implausible, n_source_urls, official_website, staff_present, recency_of_page_update, source,
  {_joined('source_urls_arr')} AS citation_urls, {_joined('source_types_arr')} AS source_types_arr,
  CAST(to_json(source_urls_arr) AS VARCHAR) AS citation_urls_json,
  CAST(to_json(source_types_arr) AS VARCHAR) AS source_types_json,
  capability_raw, specialties AS specialties_raw, procedure AS procedure_raw, equipment AS equipment_raw,
  description AS description_raw, {_joined('capability_arr')} AS capability_arr,
  {_joined('specialties_arr')} AS specialties_arr, {_joined('procedure_arr')} AS procedure_arr,
  {_joined('equipment_arr')} AS equipment_arr, claim_text, prose_text, full_text
FROM inputs
""",
)
def _json(column: str, alias: str) -> str:
    return f"CAST(to_json({column}) AS VARCHAR) AS {alias}"


_oracle(
    "review_payload",
    f"""
SELECT {_IDS}, name, facility_type, operator_type, district_norm, state_name, address_city, {_text('pincode')},
  {_text('latitude')}, {_text('longitude')}, {_text('num_doctors')}, {_text('capacity_beds')}, tier, {_text('score')}, explanation,
  {_text('structured_hit')}, {_text('claim_hit')}, {_text('prose_hit')}, {_text('screening_only')},
  {_text('well_corroborated')}, {_text('implausible')},
  {_json('capability_arr', 'capability_claims')}, {_json('specialties_arr', 'specialties')},
  {_json('procedure_arr', 'procedures')}, {_json('equipment_arr', 'equipment')}, description, claim_text, prose_text, full_text,
  {_json('source_urls_arr', 'citation_urls')}, {_json('source_types_arr', 'source_types')}, {_text('n_source_urls')},
  official_website, {_text('staff_present')}, source_content_id,
  {_q(SNAPSHOT)} AS input_snapshot_ts, evidence_fingerprint,
  'Use the LLM to refine sub-signals only. The final trust tier stays deterministic.' AS note
FROM inputs
""",
)
_oracle(
    "review_latest",
    f"SELECT {_IDS}, evidence_fingerprint, prompt_version, run_id, strftime(inference_ts, {_TIME}) AS inference_ts,"
    " parsed_json FROM latest",
)
_oracle("review_pending", "SELECT * FROM pending")
_FORCED = f"SELECT unique_id, capability, name AS facility_name, evidence_fingerprint, {_q(SNAPSHOT)} AS source_snapshot_ts FROM inputs"
_oracle("review_pending_forced", _FORCED + " WHERE capability = 'icu'")
_oracle("review_pending_one", "SELECT * FROM pending WHERE unique_id = 'f96'")
_oracle(
    "review_repair",
    f"""
SELECT mode, unique_id,
  CASE
    WHEN d = '2' OR d = '3' AND mode = 'row' THEN 'attempt2'
    WHEN d = '1' THEN 'attempt2'
    ELSE 'attempt1'
  END AS attempt,
  CASE
    WHEN d = '0' THEN 'attempt1:repair'
    WHEN d = '1' THEN 'attempt2'
    WHEN d = '2' THEN NULL
    WHEN d = '3' AND mode = 'entity' THEN 'attempt1:repair'
    WHEN d = '3' THEN NULL
    ELSE 'attempt1'
  END AS reasoning,
  CASE WHEN d = '2' THEN 'call failed: ConnectionError: no connection' WHEN d = '3' AND mode = 'row' THEN 'unknown keys: unknown' END AS error
FROM (SELECT unique_id, right(unique_id, 1) AS d FROM profiles), (VALUES ('entity'), ('row')) m(mode)
""",
)
_oracle(
    "review_append",
    f"SELECT {_IDS}, evidence_fingerprint, prompt_version, run_id, strftime(inference_ts, {_TIME}) AS inference_ts, parsed_json FROM reviews",
)
_oracle("review_pending_rows", f"SELECT * FROM pending ORDER BY capability, unique_id LIMIT 120")
_oracle(
    "review_pending_batch",
    "SELECT * FROM pending WHERE unique_id IN (SELECT DISTINCT unique_id FROM pending ORDER BY unique_id LIMIT 25)",
)
_oracle(
    "review_batches",
    f"""
SELECT p.unique_id, CAST(q.n AS INTEGER) AS n_requested, name, facility_type, district_norm, state_name, {_text('pincode')},
  {_text('num_doctors')}, CAST(to_json(q.asked) AS VARCHAR) AS requested_capabilities,
  CAST(to_json(capability_arr) AS VARCHAR) AS capability_claims, CAST(to_json(specialties_arr) AS VARCHAR) AS specialties,
  description, {_text('n_source_urls')}, nullif(official_website, '') AS official_website, {_text('staff_present')}
FROM (SELECT unique_id, count(*) AS n, list(capability ORDER BY capability) AS asked FROM pending GROUP BY 1) q
JOIN profiles p ON p.unique_id = q.unique_id
""",
)


def _prompt(template: str, **columns: str) -> str:
    parts = re.split(r"\$(\w+)", template)
    return " || ".join(columns[p] if i % 2 else _q(p) for i, p in enumerate(parts) if p)


_BATCH_PROMPT = _prompt(
    prompts.BATCH_TEMPLATE,
    facility_name="facility_name",
    unique_id="unique_id",
    capability_count="n",
    capabilities="capabilities",
    llm_input_json="'<payload>'",
)
_ROW_PROMPT = _prompt(
    prompts.ROW_TEMPLATE,
    facility_name="facility_name",
    unique_id="unique_id",
    capability="capability",
    llm_input_json="'<payload>'",
)
_oracle(
    "review_prompts",
    f"""
SELECT 'entity' AS mode, unique_id, capabilities, {_BATCH_PROMPT} AS prompt
FROM (
  SELECT unique_id, any_value(facility_name) AS facility_name, CAST(count(*) AS VARCHAR) AS n,
    string_agg(capability, ', ' ORDER BY capability) AS capabilities
  FROM pending GROUP BY 1
)
UNION ALL
SELECT 'row', unique_id, capability, {_ROW_PROMPT}
FROM pending
""",
)
_oracle(
    "review_extract_text",
    f"SELECT event_id, assistant_text, if(assistant_text IS NULL, {_q(parse.NO_TEXT)}, NULL) AS error FROM answers",
)
_oracle(
    "review_parse",
    "SELECT event_id, answer ->> '$.claim_hit' AS claim_hit, answer ->> '$.capability_scope' AS capability_scope,"
    f" answer ->> '$.reasoning' AS reasoning, {_ERROR} AS error FROM answers",
)
_oracle(
    "review_validate",
    "SELECT event_id, claim_hit, prose_hit, screening_only, capability_scope, confidence, reasoning,"
    " supporting_snippets, answer IS NOT NULL AS valid FROM validated",
)
_ITEM = "arg_max(item, position)"
_oracle(
    "review_split",
    f"""
SELECT event_id, capability, 'fp-' || event_id AS evidence_fingerprint,
  CAST({_tri('item', 'claim_hit')} AS VARCHAR) AS claim_hit, item ->> '$.capability_scope' AS capability_scope,
  CAST(TRY_CAST(item ->> '$.confidence' AS DOUBLE) AS VARCHAR) AS confidence, item ->> '$.reasoning' AS reasoning
FROM (
  SELECT event_id, lower(item ->> '$.capability') AS capability, {_ITEM} AS item
  FROM batch_items WHERE event_id IN (SELECT event_id FROM batch_checked WHERE error IS NULL)
  GROUP BY ALL
)
WHERE list_contains({_CAPS}, capability)
""",
)
_oracle(
    "review_rows",
    f"""
SELECT unique_id, capability, 'fp-' || event_id AS evidence_fingerprint, prompt_version,
  coalesce(if(json_type(raw_response_json, '$.model') = 'VARCHAR', raw_response_json ->> '$.model', NULL),
    trim(raw_response_json ->> '$.meta.served_model_name'), {_q(testdata.TARGET)}) AS model_name,
  coalesce(raw_response_json ->> '$.meta.model_version', raw_response_json ->> '$.served_entity_version') AS model_version,
  run_id, {_q(SNAPSHOT)} AS source_snapshot_ts, strftime(inference_ts, {_TIME}) AS inference_ts, capability_scope
FROM validated WHERE answer IS NOT NULL
""",
)
_oracle(
    "review_dead_letter",
    f"""
SELECT run_id, 1 AS batch_number, CAST(event_id AS VARCHAR) AS request_id, unique_id, 'Facility ' || unique_id AS facility_name,
  {_joined(_CAPS)} AS capabilities, prompt_version, 'test' AS provider, {_q(testdata.TARGET)} AS target, error,
  strftime(inference_ts, {_TIME}) AS timestamp_utc
FROM batch_checked WHERE error IS NOT NULL
""",
)
_oracle(
    "review_run_summary",
    "SELECT run_id, count(*) AS requests, 6 * count(*) AS covered_rows, 6 * count(*) FILTER (error IS NULL) AS written_rows,"
    " count(error) AS failed_requests FROM batch_checked GROUP BY run_id",
)
_oracle(
    "review_typed",
    f"SELECT {_IDS}, run_id, strftime(inference_ts, {_TIME}) AS inference_ts, claim_hit_llm, prose_hit_llm,"
    f" screening_only_llm, capability_scope_llm, {_joined('supporting_snippets_llm')} AS supporting_snippets_llm,"
    " confidence_llm, reasoning_llm FROM typed_reviews",
)
_REVIEW = (
    "claim_hit_llm, prose_hit_llm, screening_only_llm, capability_scope_llm,"
    f" {_joined('supporting_snippets_llm')} AS supporting_snippets_llm, confidence_llm, reasoning_llm, prompt_version,"
    f" model_name, model_version, run_id, strftime(source_snapshot_ts, {_TIME}) AS source_snapshot_ts,"
    f" strftime(inference_ts, {_TIME}) AS inference_ts"
)
_oracle(
    "review_signals",
    f"SELECT {_IDS}, tier AS heuristic_tier, score AS heuristic_score, explanation AS heuristic_explanation,"
    " evidence_fingerprint AS current_evidence_fingerprint, reviewed_evidence_fingerprint, has_llm_review,"
    f" llm_review_status, {_REVIEW} FROM reviewed",
)
_oracle(
    "review_overlay",
    f"SELECT {_IDS}, current_llm_review, structured_hit, claim_hit, prose_hit, screening_only, implausible,"
    " capability_scope FROM overlaid",
)
_oracle(
    "mart_final",
    f"SELECT {_IDS}, name, facility_type, operator_type, district_norm, state_name, latitude, longitude, tier, score,"
    " structured_hit, claim_hit, prose_hit, screening_only, well_corroborated, implausible, n_source_urls,"
    f" official_website, staff_present, {_joined('source_urls_arr')} AS citation_urls, heuristic_tier, heuristic_score,"
    " heuristic_claim_hit, heuristic_prose_hit, heuristic_screening_only, current_llm_review, has_llm_review,"
    f" llm_review_status, capability_scope, {_REVIEW} FROM mart",
)
_oracle("explain_final", f"SELECT {_IDS}, tier, explanation, heuristic_explanation FROM mart")
_oracle(
    "evidence_document_final",
    f"SELECT {_IDS}, {_BASE_DOCUMENT}, capability_scope, {_text('current_llm_review', 'has_current_llm_review')},"
    f" llm_review_status, {_text('claim_hit_llm')}, {_text('prose_hit_llm')}, {_text('screening_only_llm')},"
    " CAST(to_json(supporting_snippets_llm) AS VARCHAR) AS supporting_snippets_llm,"
    f" {_text('confidence_llm')}, reasoning_llm FROM mart",
)
_STAGES = {
    "quarantine": "quarantined", "entities": "entities", "profiles": "profiles", "bridge": "bridge", "indicators": "indicators", "need_index": "indicators",
    "geo": "profiles", "baseline": "graded", "inputs": "graded", "signals": "graded", "mart": "graded",
}
_oracle("run_pipeline", " UNION ALL ".join(f"SELECT '{s}' AS stage, count(*) AS n_rows FROM {t}" for s, t in _STAGES.items()))
for _name in ("mart_refresh", "mart_update"):
    _oracle(
        _name,
        f"SELECT {_IDS}, tier, score, explanation, heuristic_tier, current_llm_review, llm_review_status, run_id FROM mart",
    )
_RANKED = "unique_id, name, facility_type, district_norm, state_name, tier, score, n_source_urls"


def _ranked(where: str, limit: str = " LIMIT 200") -> str:
    return (
        f"SELECT {_RANKED} FROM mart WHERE {where}"
        " ORDER BY list_position(['strong', 'partial', 'weak_suspicious', 'no_claim'], tier), score DESC, unique_id" + limit
    )


_oracle("serve_regions", "SELECT state_name, count(*) AS n_rows FROM mart WHERE state_name <> '' GROUP BY state_name")
_oracle("serve_ranked_all", _ranked("capability = 'icu' AND tier <> 'no_claim'", ""))
_oracle("serve_ranked", _ranked("capability = 'icu' AND tier <> 'no_claim'"))
_oracle(
    "serve_ranked_region", _ranked("capability = 'maternity' AND state_name = 'Kerala' AND tier <> 'no_claim'")
)
_oracle("serve_ranked_tier", _ranked("capability = 'oncology' AND tier = 'weak_suspicious'"))
_oracle(
    "serve_ranked_sorted",
    "SELECT * FROM (" + _ranked("capability = 'trauma' AND tier <> 'no_claim'") + ")"
    " ORDER BY lower(ifnull(district_norm, '')) DESC, unique_id",
)
_DETAIL = """
SELECT unique_id, capability, tier, explanation, CAST(to_json(source_urls_arr) AS VARCHAR) AS citation_urls_json, name,
  facility_type, district_norm, state_name, num_doctors, capacity_beds,
  CAST(to_json(specialties_arr) AS VARCHAR) AS specialties_json,
  CAST(to_json(capability_arr) AS VARCHAR) AS capabilities_json,
  CAST(to_json(equipment_arr) AS VARCHAR) AS equipment_json
FROM mart
"""
_ONE = " WHERE unique_id = 'f96' AND capability = 'icu'"
_oracle("serve_detail", _DETAIL)
_oracle("serve_detail_one", _DETAIL + _ONE)
_oracle(
    "serve_detail_compact",
    "SELECT unique_id, capability, tier, score, CAST(to_json(source_urls_arr) AS VARCHAR) AS citation_urls_json, name,"
    " facility_type, district_norm, state_name FROM mart",
)
_oracle(
    "serve_summary",
    "SELECT unique_id, capability AS focus_capability, effective_tier AS focus_tier, has_local_override,"
    " ifnull(nullif(trim(reasoning_llm), ''), explanation) AS detail,"
    " if(ifnull(trim(reasoning_llm), '') = '', 'heuristic', 'llm') AS source FROM effective",
)
_CONTEXT = "[" + ", ".join(
    f"if({name}, {_q(label)}, NULL)" for name, label in texts.CONTEXT_SIGNAL_LABELS.items()
) + "]"
_EVIDENCE = "[" + ", ".join(
    f"if({name}, {_q(label)}, NULL)" for name, label in texts.EVIDENCE_SIGNAL_LABELS.items()
) + "]"


def _badge(name: str, most: int | None) -> str:
    items = f"ifnull({name}_arr, []::VARCHAR[])"
    more = "0" if most is None else f"greatest(len({items}) - {most}, 0)"
    return f"{_joined(items + _cut(most))} AS {name}_badges, CAST({more} AS INTEGER) AS {name}_more"


def _cut(most: int | None) -> str:
    return "" if most is None else f"[1:{most}]"


def _signals(snippets: int | None = None, citations: int | None = None, badges: int | None = None) -> str:
    given = "list_transform(ifnull(supporting_snippets_llm, []::VARCHAR[]), lambda t: trim(t))"
    each = f"list_filter({given}, lambda t, i: t <> '' AND list_position({given}, t) = i)"
    return f"""
SELECT unique_id, capability,
  ifnull(array_to_string({_EVIDENCE}, '|'), '') AS evidence_signals,
  ifnull(array_to_string({_CONTEXT}, '|'), '') AS context_signals,
  {_joined(each + _cut(snippets))} AS snippets, CAST(len({each}) AS INTEGER) AS n_snippets,
  CAST(ifnull(len(source_urls_arr), 0) AS INTEGER) AS n_citations,
  {_joined('ifnull(source_urls_arr, []::VARCHAR[])' + _cut(citations))} AS citations,
  CASE
    WHEN structured_hit OR claim_hit OR prose_hit THEN NULL
    WHEN well_corroborated AND recent_update THEN {_q(texts.CONTEXT_NOTE_SOURCED_RECENT)}
    WHEN well_corroborated THEN {_q(texts.CONTEXT_NOTE_SOURCED)}
    WHEN recent_update THEN {_q(texts.CONTEXT_NOTE_RECENT)}
    WHEN screening_only OR implausible OR capacity_supported THEN {_q(texts.CONTEXT_NOTE_OTHER)}
  END AS context_note,
  {_badge('specialties', badges)}, {_badge('capability', badges)}, {_badge('equipment', badges)}
FROM mart
"""


_oracle("serve_signals", _signals())
_oracle("serve_signals_page", _signals(5, 10, 24))
_oracle("serve_signals_one", _signals() + _ONE)
_oracle("overrides_valid", "SELECT * FROM override_problems")
_oracle("overrides_state", "SELECT * FROM in_force")
_oracle(
    "overrides_effective",
    f"SELECT {_IDS}, tier, effective_tier, has_local_override, override_note, override_ts FROM effective",
)


def _key_profile(label: str, column: str) -> str:
    return f"""
SELECT '{label}' AS "key", (SELECT count(*) FROM raw_facilities) AS n_rows, count(*) AS distinct_values,
  count(*) FILTER (n > 1) AS repeated_values, CAST(ifnull(sum(n) FILTER (n > 1), 0) AS BIGINT) AS repeated_rows
FROM (SELECT {column}, count(*) AS n FROM raw_facilities WHERE {column} IS NOT NULL GROUP BY 1)
"""


_oracle(
    "profile_keys",
    " UNION ALL ".join(
        _key_profile(label, column)
        for label, column in (("id", "unique_id"), ("cluster", "cluster_id"), ("region", "address_stateOrRegion"))
    ),
)
_oracle(
    "profile_top_groups",
    """
SELECT 'type' AS "grouping", facilityTypeId AS value, count(*) AS n_rows FROM raw_facilities GROUP BY ALL
UNION ALL
SELECT * FROM (
  SELECT 'region', address_stateOrRegion, count(*) AS n FROM raw_facilities GROUP BY ALL
  ORDER BY n DESC, address_stateOrRegion NULLS LAST LIMIT 5
)
""",
)
_oracle("profile_groups", "SELECT address_stateOrRegion AS value, count(*) AS n_rows FROM raw_facilities GROUP BY ALL")
_oracle(
    "profile_invalid_codes",
    f"SELECT count(*) AS n_rows, sum(if(ifnull(list_contains({_list(FACILITY.valid_types)}, facilityTypeId), false), 0, 1))::BIGINT AS invalid_type,"
    " count(*) FILTER (operatorTypeId IS NULL OR operatorTypeId NOT IN ('public', 'private')) AS invalid_operator FROM raw_facilities",
)
_oracle(
    "profile_geo_bounds",
    """
SELECT count(*) AS n_rows,
  count(*) FILTER (latitude >= 6 AND latitude <= 38 AND longitude >= 68 AND longitude <= 98) AS inside,
  count(*) FILTER (latitude < 6 OR latitude > 38 OR longitude < 68 OR longitude > 98) AS outside,
  count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS unknown
FROM raw_facilities
""",
)


def _null_profile(column: str, numeric: bool) -> str:
    number = f"count({_int(column)})" if numeric else "NULL::BIGINT"
    return (
        f"SELECT '{column}' AS column_name, {number} AS numeric_values,"
        f" count(*) FILTER ({column} = 'null') AS null_literals, count(*) - count({column}) AS missing FROM raw_facilities"
    )


_oracle(
    "profile_null_literals",
    " UNION ALL ".join(
        [_null_profile("numberDoctors", True), _null_profile("capacity", True), _null_profile("officialWebsite", False)]
    ),
)
_oracle(
    "profile_join_quality",
    """
SELECT count(*) AS n_rows, count(*) FILTER (t.pincode BETWEEN 100000 AND 999999) AS parseable,
  count(b.pincode) AS matched,
  count(*) FILTER (b.pincode IS NOT NULL AND lower(t.state_norm) = lower(b.state_name)) AS state_agrees,
  count(*) FILTER (b.pincode IS NOT NULL AND lower(t.state_norm) IS DISTINCT FROM lower(b.state_name)) AS state_differs,
  count(*) FILTER (b.district_norm IN (SELECT district_norm FROM indicators)) AS with_indicators
FROM typed t LEFT JOIN bridge b ON b.pincode = t.pincode
""",
)
_oracle(
    "state_consistency",
    """
SELECT e.unique_id, e.pincode, e.state_norm, r.state_name AS postcode_state,
  CASE WHEN e.pincode IS NULL THEN 'no_postcode' WHEN r.state_name IS NULL THEN 'outside' WHEN e.state_norm IS NULL THEN 'no_state'
    WHEN lower(e.state_norm) = lower(r.state_name) THEN 'agrees' ELSE 'differs' END AS consistency
FROM entities e LEFT JOIN (
  SELECT state_name, min(pincode) AS low, max(pincode) AS high
  FROM (
    SELECT pincode, state_name, pincode // 1000 AS bin,
      sum(CASE WHEN state_name IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY pincode // 1000 ORDER BY pincode) AS run
    FROM (SELECT *, lag(state_name) OVER (PARTITION BY pincode // 1000 ORDER BY pincode) AS before FROM bridge WHERE state_name IS NOT NULL AND pincode IS NOT NULL)
  ) GROUP BY bin, run, state_name
) r ON e.pincode BETWEEN r.low AND r.high
""",
)
_oracle(
    "profile_keys_merged",
    " UNION ALL ".join(
        f"SELECT '{key}' AS key, count(DISTINCT right(source_content_id, 1)) AS loads, count(*) AS n_rows, count({column}) AS n_present,"
        f" count(DISTINCT {column}) AS distinct_values, true AS within_bound FROM raw_facilities"
        for key, column in (("id", "unique_id"), ("cluster", "cluster_id"), ("region", "address_stateOrRegion"))
    ),
)
_oracle(
    "coordinate_repair",
    """
SELECT unique_id, pincode, if(ok, latitude, c_lat) AS latitude, if(ok, longitude, c_lon) AS longitude,
  if(ok AND c_lat IS NOT NULL, km, NULL) AS distance_km,
  CASE WHEN ok AND c_lat IS NOT NULL AND km > 100 THEN 'far' WHEN ok THEN 'kept' WHEN c_lat IS NULL THEN 'hidden'
    WHEN latitude IS NULL OR longitude IS NULL THEN 'filled' ELSE 'repaired' END AS coordinates
FROM (
  SELECT e.unique_id, e.pincode, e.latitude, e.longitude, c.c_lat, c.c_lon,
    ifnull(e.latitude BETWEEN 6 AND 38 AND e.longitude BETWEEN 68 AND 98, false) AS ok,
    round(12742.0 * asin(sqrt(least(1.0, pow(sin(radians(c.c_lat - e.latitude) / 2), 2)
      + cos(radians(e.latitude)) * cos(radians(c.c_lat)) * pow(sin(radians(c.c_lon - e.longitude) / 2), 2)))), 1) AS km
  FROM entities e LEFT JOIN (
    SELECT pincode, quantile_disc(round(latitude, 4), 0.5) AS c_lat, quantile_disc(round(longitude, 4), 0.5) AS c_lon
    FROM entities WHERE latitude BETWEEN 6 AND 38 AND longitude BETWEEN 68 AND 98 AND pincode IS NOT NULL
    GROUP BY pincode HAVING count(*) >= 3
  ) c ON c.pincode = e.pincode
)
""",
)
_SUFFIXES = ", ".join(f"({_q(s)}, {_q(c)})" for s, c in testdata.CITATION_SUFFIXES)
_HOST = "nullif(regexp_extract(lower({}), '^[a-z][a-z0-9+.-]*://([^/?#@]*@)?(www[.])?([^/?#:@]+)', 3), '')"
_oracle(
    "citation_quality",
    f"""
SELECT unique_id, count(url) AS n_citations, count(*) FILTER (kind = 'official') AS n_official,
  count(*) FILTER (kind = 'government') AS n_government, count(*) FILTER (kind = 'directory') AS n_directory,
  count(*) FILTER (kind = 'social') AS n_social, count(*) FILTER (kind = 'other') AS n_other,
  count(*) FILTER (kind = 'unreadable') AS n_unreadable,
  arg_min(kind, list_position(['official', 'government', 'directory', 'social', 'other', 'unreadable'], kind)) AS best_citation
FROM (
  SELECT u.unique_id, u.url, CASE WHEN u.url IS NULL THEN NULL WHEN u.host IS NULL THEN 'unreadable' WHEN u.host = u.site THEN 'official'
    ELSE ifnull(x.class, 'other') END AS kind
  FROM (
    SELECT unique_id, site, url, {_HOST.format("url")} AS host
    FROM (SELECT unique_id, {_HOST.format("official_website")} AS site FROM entities) LEFT JOIN (
      SELECT DISTINCT unique_id, trim(url) AS url FROM (
        SELECT unique_id, unnest(source_urls_arr) AS url FROM entities UNION ALL SELECT unique_id, unnest(websites_arr) FROM entities
        UNION ALL SELECT unique_id, official_website FROM entities UNION ALL SELECT unique_id, facebook_link FROM entities
      ) WHERE url IS NOT NULL AND lower(trim(url)) NOT IN ('', 'null')
    ) USING (unique_id)
  ) u
  LEFT JOIN (
    SELECT DISTINCT ON (host) host, class
    FROM (SELECT DISTINCT regexp_extract(url, '://([^/?#]+)', 1) AS host FROM (
      SELECT unnest(list_concat(ifnull(source_urls_arr, []), ifnull(websites_arr, []), [official_website, facebook_link])) AS url FROM entities)) h
    JOIN (VALUES {_SUFFIXES}) s(suffix, class) ON h.host = s.suffix OR ends_with(h.host, '.' || s.suffix)
    ORDER BY host, length(suffix) DESC
  ) x ON x.host = u.host
) GROUP BY unique_id
""",
)
_TYPES = ("hospital", "clinic", "dentist", "doctor", "pharmacy", "nursing_home")
_oracle(
    "profile_capability_by_type",
    f"""
SELECT l.capability, count(*) AS any_match,
  {", ".join(f"count(*) FILTER (facility_type = '{t}') AS {t}" for t in _TYPES)}
FROM (
  SELECT facility_type, lower(concat_ws(' ', name, description, specialties, procedure, equipment, capability)) AS words FROM typed
) t, lexicon l
WHERE {_found('words', 'list_concat(l.structured, l.prefixes, l.claim, l.prose)')}
GROUP BY l.capability
""",
)
_PHRASES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, lower(trim(unnest({c}_arr))) AS phrase FROM typed"
    for c in ("capability", "specialties", "procedure", "equipment")
)
_oracle(
    "profile_vocabulary",
    f"""
SELECT column_name, count(DISTINCT phrase) AS distinct_phrases, count(*) AS mentions,
  count(DISTINCT phrase) FILTER ({_found('phrase', '(SELECT flatten(list(list_concat(structured, claim, prose))) FROM lexicon)')}) AS lexicon_phrases
FROM ({_PHRASES}) WHERE phrase <> '' GROUP BY column_name
""",
)
_oracle(
    "profile_min_support",
    f"""
SELECT column_name, count(*) AS distinct_phrases, {", ".join(f"count(*) FILTER (n >= {k}) AS at_least_{k}" for k in (25, 50, 100, 250))}
FROM (SELECT column_name, phrase, count(*) AS n FROM ({_PHRASES}) WHERE phrase <> '' GROUP BY ALL)
GROUP BY column_name
""",
)
