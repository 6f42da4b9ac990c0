"""Raw tables made from the generated test tables by plain arithmetic.

Each text is SQL that Spark and DuckDB both run; ``@orders`` and the like name the
source tables. The generated tables hold no profiles, so columns are derived from
the keys. Moduli differ so that columns do not move together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01"
SNAPSHOT_TS = "2024-02-01 00:00:00"
PROMPT_VERSION = "view"
TARGET = "reviewer-endpoint"
# Domain suffixes and what pages under them are
CITATION_SUFFIXES = (
    ("gov.in", "government"),
    ("nic.in", "government"),
    ("example", "directory"),
    ("social.example", "social"),
    ("facebook.com", "social"),
    ("instagram.com", "social"),
    ("youtube.com", "social"),
)

RAW_FACILITIES = """
SELECT
  concat('f', cast(CASE WHEN k % 101 = 1 THEN k - 1 ELSE k END AS string)) AS unique_id,
  concat('s', cast(k AS string)) AS source_content_id,
  CASE WHEN k % 19 <> 0 THEN concat('c', cast(k - k % 3 AS string)) END AS cluster_id,
  CASE WHEN k % 97 <> 0 THEN concat('Facility ', cast(k AS string)) END AS name,
  CASE
    WHEN k % 17 <= 6 THEN 'hospital'
    WHEN k % 17 <= 9 THEN 'clinic'
    WHEN k % 17 = 10 THEN 'dentist'
    WHEN k % 17 = 11 THEN 'doctor'
    WHEN k % 17 = 12 THEN 'farmacy'
    WHEN k % 17 = 13 THEN 'pharmacy'
    WHEN k % 17 = 14 THEN 'nursing_home'
    WHEN k % 17 = 15 THEN '{"lat": 1}'
    ELSE 'Hospital'
  END AS facilityTypeId,
  CASE k % 29 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN 'public' ELSE 'private' END AS operatorTypeId,
  CASE k % 12
    WHEN 0 THEN 'null' WHEN 1 THEN '12.7' WHEN 2 THEN '15000' WHEN 3 THEN '0' WHEN 4 THEN '1' WHEN 5 THEN NULL
    ELSE cast(k % 30 AS string)
  END AS numberDoctors,
  CASE k % 14
    WHEN 0 THEN 'null' WHEN 1 THEN NULL WHEN 2 THEN '200000' WHEN 3 THEN '0' WHEN 4 THEN '3'
    ELSE cast(k % 120 AS string)
  END AS capacity,
  CASE k % 9
    WHEN 0 THEN '["ICU with 12 beds", "24/7 emergency"]'
    WHEN 1 THEN '["NICU and newborn care"]'
    WHEN 2 THEN '["Maternity ward", "Labour room"]'
    WHEN 3 THEN '["Trauma care"]'
    WHEN 4 THEN '["Cancer treatment"]'
    WHEN 5 THEN 'null'
    WHEN 6 THEN NULL
    WHEN 7 THEN 'not json'
    ELSE '["Cancer care"]'
  END AS capability,
  CASE k % 8
    WHEN 0 THEN '["criticalCareMedicine"]'
    WHEN 1 THEN '["neonatologyPerinatalMedicine"]'
    WHEN 2 THEN '["obstetricsAndGynecology", "internalMedicine"]'
    WHEN 3 THEN '["emergencyMedicine"]'
    WHEN 4 THEN '["medicalOncology"]'
    WHEN 5 THEN '["traumaSurgery"]'
    WHEN 6 THEN '[]'
    ELSE NULL
  END AS specialties,
  CASE k % 5
    WHEN 0 THEN '["Childbirth", "Antenatal checks"]'
    WHEN 1 THEN '["Neonatal screening"]'
    WHEN 2 THEN NULL
    WHEN 3 THEN '["Cancer screening"]'
    ELSE '[]'
  END AS procedure,
  CASE k % 7
    WHEN 0 THEN '["Ventilator"]'
    WHEN 1 THEN '["Incubator", " Infant Warmer "]'
    WHEN 2 THEN '["Ambulance"]'
    WHEN 3 THEN '["Linear accelerator"]'
    WHEN 4 THEN 'null'
    WHEN 5 THEN NULL
    ELSE '["X-ray"]'
  END AS equipment,
  CASE k % 6
    WHEN 0 THEN 'Accident and Emergency unit, open day and night'
    WHEN 1 THEN 'Polytrauma team and ICU beds'
    WHEN 2 THEN 'Tumour awareness camps'
    WHEN 3 THEN NULL
    WHEN 4 THEN 'Chemotherapy day care'
    ELSE 'General practice'
  END AS description,
  CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 'null' WHEN k % 10 = 2 THEN ''
    ELSE concat('https://f', cast(k AS string), '.example') END AS officialWebsite,
  CASE WHEN k % 4 = 0 THEN NULL ELSE '["https://a.example"]' END AS websites,
  CASE WHEN k % 3 = 0 THEN concat('https://social.example/', cast(k AS string)) END AS facebookLink,
  'crawl' AS source,
  CASE
    WHEN k % 13 = 0 THEN NULL
    WHEN k % 13 = 1 THEN 'junk'
    WHEN k % 13 <= 4 THEN '["u1"]'
    WHEN k % 13 <= 8 THEN '["u1", "u2", "u3"]'
    ELSE '["u1", "u2", "u3", "u4", "u5", "u6", "u7", "u8", "u9", "u10", "u11", "u12"]'
  END AS source_urls,
  CASE WHEN k % 5 = 0 THEN NULL ELSE '["website", "social"]' END AS source_types,
  CASE WHEN k % 23 <= 2 THEN NULL WHEN k % 23 <= 7 THEN 'false' ELSE 'true' END AS affiliated_staff_presence,
  CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS custom_logo_presence,
  CASE k % 6 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE cast(k % 6 AS string) END AS distinct_social_media_presence_count,
  CASE k % 15 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE cast(cast(o_orderdate AS date) AS string) END AS recency_of_page_update,
  concat(cast(k % 200 AS string), ' Main Road') AS address_line1,
  cast(NULL AS string) AS address_line2,
  cast(NULL AS string) AS address_line3,
  concat('City ', cast(k % 50 AS string)) AS address_city,
  CASE k % 11
    WHEN 0 THEN 'tamilnadu' WHEN 1 THEN ' Orissa ' WHEN 2 THEN 'Mumbai' WHEN 3 THEN 'hyderabad'
    WHEN 4 THEN 'Malappuram' WHEN 5 THEN '' WHEN 6 THEN 'null' WHEN 7 THEN 'gujarat'
    WHEN 8 THEN 'UTTAR PRADESH' WHEN 9 THEN 'Satara District' ELSE NULL
  END AS address_stateOrRegion,
  CASE k % 31 WHEN 0 THEN 'null' WHEN 1 THEN '12AB' ELSE cast(110000 + o_custkey % 500 AS string) END AS address_zipOrPostcode,
  'India' AS address_country,
  'IN' AS address_countryCode,
  CASE WHEN k % 211 = 0 THEN cast(-38.26 AS double) ELSE cast(k % 280 AS double) / 10 + 8 END AS latitude,
  cast(k % 290 AS double) / 10 + 68 AS longitude
FROM (SELECT o_orderkey AS k, o_custkey, o_orderdate FROM @orders) t
"""

RAW_PINCODE_DIRECTORY = """
SELECT
  110000 + c_custkey % 400 AS pincode,
  concat(
    '  ',
    CASE c_custkey % 3 WHEN 0 THEN 'District ' WHEN 1 THEN 'DISTRICT ' ELSE 'district ' END,
    cast(c_nationkey % 7 AS string),
    ' '
  ) AS district,
  CASE c_custkey % 5
    WHEN 0 THEN 'TAMIL NADU' WHEN 1 THEN 'ODISHA' WHEN 2 THEN 'MAHARASHTRA' WHEN 3 THEN 'TELANGANA' ELSE 'KERALA'
  END AS statename
FROM @customer
"""


def _percent(prime: int) -> str:
    return f"CASE WHEN p_partkey % 9 <> 0 THEN cast(p_partkey * {prime} % 1100 AS double) / 10 END"


RAW_DISTRICT_INDICATORS = f"""
SELECT
  concat(' District ', cast(p_partkey AS string)) AS district_name,
  CASE p_partkey % 3 WHEN 0 THEN ' Kerala ' WHEN 1 THEN 'Odisha' ELSE 'Gujarat ' END AS state_ut,
  {_percent(7)} AS institutional_birth_5y_pct,
  {_percent(11)} AS institutional_birth_in_public_facility_5y_pct,
  {_percent(13)} AS births_delivered_by_csection_5y_pct,
  CASE p_partkey % 6
    WHEN 0 THEN '(45.6)' WHEN 1 THEN '12.3 *' WHEN 2 THEN '*' WHEN 3 THEN ' 7 ' WHEN 4 THEN NULL ELSE '88.1'
  END AS mothers_who_had_at_least_4_anc_visits_lb5y_pct,
  {_percent(17)} AS hh_member_covered_health_insurance_pct,
  {_percent(19)} AS women_age_30_49_years_ever_undergone_a_breast_exam_pct,
  {_percent(23)} AS women_age_30_49_years_ever_undergone_a_cervical_screen_pct,
  {_percent(29)} AS women_age_30_49_years_ever_undergone_an_oral_cancer_exam_pct,
  {_percent(31)} AS all_w15_49_who_are_anaemic_pct,
  {_percent(37)} AS w15_plus_with_high_bp_sys_gte_140_mmhg_and_or_dia_gte_90_mm_pct,
  {_percent(41)} AS w15_plus_with_high_or_very_high_gt_140_mg_dl_blood_sugar_or_pct
FROM @part
"""

def _record(hit: str, prose: str, only: str, scope: str, snippets: str, confidence: str, reasoning: str) -> str:
    return (
        f'{{"claim_hit": {hit}, "prose_hit": {prose}, "screening_only": {only}, "capability_scope": {scope}, '
        f'"supporting_snippets": {snippets}, "confidence": {confidence}, "reasoning": {reasoning}}}'
    )


# Record texts by event: full, adjacent, screening, unclear, nulls, blank reasoning,
# values as text, and one that is cut off.
RECORDS = (
    _record("true", "true", "false", '"full_capability"', '["icu beds", " icu beds ", "", "ward"]', "0.94", '"Explicit claim."'),
    _record("true", "false", "false", '"adjacent_service"', "[]", "0.5", '"Related service only."'),
    _record("false", "false", "true", '"screening_or_diagnostics_only"', '["camp"]', "0.75", '"Screening only."'),
    _record("false", "false", "false", '"unclear"', '["a", "b", "c", "d", "e", "f", "g"]', "0.25", '"Unclear."'),
    _record("null", "null", "null", "null", "[]", "null", "null"),
    _record("true", "true", "false", '"full_capability"', "[]", "1", '""'),
    _record('"yes"', '"false"', "0", '"full_capability"', "[]", '"0.5"', '"Values as text."'),
    '{"claim_hit": true, "prose',
)

# Batch answers by event: complete; other case and a repeated capability; one
# capability missing; one too many; an unknown key; a bad value; no list; cut off.
_NAMES = ("icu", "nicu", "maternity", "emergency", "oncology", "trauma")


def _item(capability: str, record: str = RECORDS[1]) -> str:
    return f'{{"capability": "{capability}", ' + record[1:]


def _results(*items: str) -> str:
    return '{"results": [' + ", ".join(items) + "]}"


BATCHES = (
    _results(*[_item(c, RECORDS[i]) for i, c in enumerate(_NAMES)]),
    _results(*[_item(c.upper()) for c in _NAMES], _item("icu", RECORDS[0])),
    _results(*[_item(c) for c in _NAMES[:-1]]),
    _results(*[_item(c, RECORDS[6]) for c in (*_NAMES, "dialysis")]),
    _results(*[_item(c) for c in _NAMES])[:-1] + ', "tier": "strong"}',
    _results(*[_item(c, RECORDS[0].replace("0.94", "1.2")) for c in _NAMES]),
    '{"results": "none"}',
    _results(*[_item(c) for c in _NAMES])[:-4],
)


def _choice(texts: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"CASE event_id % {len(texts)} {cases} END"


# Where the text is put in the response, by event; "@text" is the quoted text.
SHAPES = (
    '{"model": "m-a", "choices": [{"message": {"content": @text}}]}',
    '{"meta": {"served_model_name": " m-b ", "model_version": "7"}, "choices": [{"message": {"content": [{"type": "text", "text": @text}]}}]}',
    '{"model": "m-c", "output": [{"type": "reasoning", "summary": []}, {"type": "message", "content": [{"type": "output_text", "text": @text}]}]}',
    '{"predictions": [@text]}',
    '{"output_text": @text, "model": 5}',
    '{"predictions": [{"text": @text}], "served_entity_version": "v2"}',
    '{"status": "busy"}',
)


def _shaped() -> str:
    cases = " ".join(f"WHEN {i} THEN replace('{s}', '@text', quoted)" for i, s in enumerate(SHAPES))
    return f"CASE event_id % {len(SHAPES)} {cases} END"


def _responses(texts: tuple[str, ...]) -> str:
    """Answers with a text around the record: fenced, introduced, blanks, or nothing."""
    return f"""
SELECT
  event_id, unique_id, capability, prompt_version, run_id, inference_ts, record,
  {_shaped()} AS raw_response_json
FROM (
  SELECT
    *,
    concat(
      chr(34),
      replace(replace(wrapped, chr(34), concat(chr(92), chr(34))), chr(10), concat(chr(92), 'n')),
      chr(34)
    ) AS quoted
  FROM (
    SELECT
      *,
      CASE event_id % 5
        WHEN 0 THEN concat('```json', chr(10), record, chr(10), '```')
        WHEN 1 THEN concat('Here it is: ', record, ' Done.')
        WHEN 2 THEN concat(' ', record, chr(10))
        ELSE record
      END AS wrapped
    FROM (
      SELECT
        event_id,
        concat('f', cast(3 * g AS string)) AS unique_id,
        CASE g % 6
          WHEN 0 THEN 'icu' WHEN 1 THEN 'nicu' WHEN 2 THEN 'maternity'
          WHEN 3 THEN 'emergency' WHEN 4 THEN 'oncology' ELSE 'trauma'
        END AS capability,
        event_type AS prompt_version,
        concat('r', cast(event_id % 50 AS string)) AS run_id,
        date_trunc('hour', ts) AS inference_ts,
        {_choice(texts)} AS record
      FROM (SELECT event_id, event_type, ts, cast((event_id - event_id % 4) / 4 AS bigint) AS g FROM @events) e
    ) r
  ) w
) q
"""


RESPONSES = _responses(RECORDS)
BATCH_RESPONSES = _responses(BATCHES)

OVERRIDE_EVENTS = """
SELECT
  concat('f', cast(3 * g AS string)) AS unique_id,
  CASE g % 6
    WHEN 0 THEN 'icu' WHEN 1 THEN 'nicu' WHEN 2 THEN 'maternity'
    WHEN 3 THEN 'emergency' WHEN 4 THEN 'oncology' ELSE 'trauma'
  END AS capability,
  CASE WHEN event_type = 'error' THEN 'clear' ELSE 'save' END AS action,
  CASE event_id % 4 WHEN 0 THEN 'strong' WHEN 1 THEN 'partial' WHEN 2 THEN 'weak_suspicious' ELSE 'no_claim' END AS tier,
  CASE event_id % 10 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE concat(' note ', cast(event_id AS string), ' ') END AS note,
  1704067200000 + event_id * 1000 AS ts,
  CASE WHEN event_id % 3 = 0 THEN 'planner@example.org' END AS actor_email
FROM (SELECT event_id, event_type, cast((event_id - event_id % 4) / 4 AS bigint) AS g FROM @events) e
"""

# Whole document texts as descriptions, and conversations as claims that are no JSON: long texts
# in several languages with odd characters, some with words of the lexicon put after them.
RAW_DOCUMENTS = """
SELECT
  concat('d', cast(doc_id AS string)) AS unique_id,
  concat('sd', cast(doc_id AS string)) AS source_content_id,
  cast(NULL AS string) AS cluster_id,
  concat('Story ', cast(doc_id AS string)) AS name,
  CASE doc_id % 3 WHEN 0 THEN 'hospital' WHEN 1 THEN 'clinic' ELSE 'dentist' END AS facilityTypeId,
  'private' AS operatorTypeId,
  cast(doc_id % 40 AS string) AS numberDoctors,
  cast(doc_id % 150 AS string) AS capacity,
  said AS capability,
  CASE doc_id % 4 WHEN 0 THEN '["criticalCareMedicine"]' WHEN 1 THEN '["medicalOncology"]' END AS specialties,
  text AS procedure,
  cast(NULL AS string) AS equipment,
  CASE doc_id % 5
    WHEN 0 THEN concat(text, ' Tumour awareness camps') WHEN 1 THEN concat('Polytrauma team and ICU beds ', text) ELSE text
  END AS description,
  'https://d.example' AS officialWebsite,
  cast(NULL AS string) AS websites,
  cast(NULL AS string) AS facebookLink,
  source,
  CASE WHEN doc_id % 2 = 0 THEN '["u1", "u2", "u3"]' END AS source_urls,
  '["website"]' AS source_types,
  'true' AS affiliated_staff_presence,
  'false' AS custom_logo_presence,
  cast(NULL AS string) AS distinct_social_media_presence_count,
  '2001-05-01' AS recency_of_page_update,
  cast(NULL AS string) AS address_line1,
  cast(NULL AS string) AS address_line2,
  cast(NULL AS string) AS address_line3,
  lang AS address_city,
  cast(NULL AS string) AS address_stateOrRegion,
  cast(NULL AS string) AS address_zipOrPostcode,
  'India' AS address_country,
  'IN' AS address_countryCode,
  cast(NULL AS double) AS latitude,
  cast(NULL AS double) AS longitude
FROM @documents LEFT JOIN (
  SELECT conv_id, listagg(text, ' ') WITHIN GROUP (ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said
  FROM @conversations GROUP BY conv_id
) c ON conv_id = doc_id
"""

# columns the texts above read; a given schema saves looking into the files first
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint",
    "events": "event_id bigint, ts timestamp_ntz, event_type string",
    "documents": "doc_id bigint, text string, lang string, source string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

SOURCES = {
    "raw_facilities": (RAW_FACILITIES, "orders"),
    "raw_documents": (RAW_DOCUMENTS, "documents"),
    "raw_pincode_directory": (RAW_PINCODE_DIRECTORY, "customer"),
    "raw_district_indicators": (RAW_DISTRICT_INDICATORS, "part"),
    "responses": (RESPONSES, "events"),
    "batch_responses": (BATCH_RESPONSES, "events"),
    "override_events": (OVERRIDE_EVENTS, "events"),
}


def load(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A raw table over the generated tables in ``sf_dir``.

    ``spread_by`` moves the few source columns to all tasks before the texts are made.
    """
    text, table = SOURCES[name]
    source = spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    if spread_by is not None:
        # a given number, as small data would otherwise be put together again
        source = source.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), spread_by)
    quoted = text.replace("{", "{{").replace("}", "}}").replace(f"@{table}", "{source}")
    others = {t: spark.read.schema(c).parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t, c in COLUMNS.items() if f"@{t}" in quoted}
    for other in others:
        quoted = quoted.replace(f"@{other}", f"{{{other}}}")
    return spark.sql(quoted, source=source, **others)


def _fresh() -> Column:
    return F.col("event_id") % 3 == 0


def present_keys(responses: DataFrame) -> DataFrame:
    """Keys of the rows whose fingerprints ``reviews`` looks at."""
    return responses.where(_fresh()).select("unique_id", "capability").distinct()


def reviews(responses: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Landing rows: every third review was made on the present evidence."""
    key = ["unique_id", "capability"]
    present = fingerprints.select(*key, F.col("evidence_fingerprint").alias("_now"))
    fresh = _fresh()
    old = F.concat(F.lit("old-"), F.col("event_id").cast("string"))
    return responses.join(present, key, "left").select(
        "unique_id",
        "capability",
        F.coalesce(F.when(fresh, F.col("_now")), old).alias("evidence_fingerprint"),
        "prompt_version",
        F.lit("m-a").alias("model_name"),
        F.lit(None).cast("string").alias("model_version"),
        "run_id",
        F.lit(SNAPSHOT_TS).cast("timestamp").alias("source_snapshot_ts"),
        F.col("inference_ts").cast("timestamp").alias("inference_ts"),
        "raw_response_json",
        F.col("record").alias("parsed_json"),
    )
