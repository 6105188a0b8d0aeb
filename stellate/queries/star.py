"""Queries for the table jobs and the star schema, run on the derived raw tables."""

from __future__ import annotations

import uuid
from functools import cache, reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators import cleanup, lookups
from stellate.plans import silver, star, star_map
from stellate.queries.inputs import derive, raw
from stellate.queries.operators import (
    SQL_INCLUSION,
    sql_age,
    sql_country,
    sql_map,
    sql_phase,
    sql_sex,
    sql_strip,
    sql_study_type,
)
from stellate.queries.registry import query
from stellate.sources.layers import Layer
from stellate.sources.staging import shared_folder, stage

# --- the clean layer in SQL --------------------------------------------------------------------

STAGE_NAMES = {
    "Preclinical - Drugs": "Discovery & Preclinical",
    "Phase I/II": "Phase II",
    "Phase III - Vaccines": "Phase III",
    "Unclear - Drugs": "Unclear",
    "Regulatory filing - Diagnostics": "Approved",
    "Phase IV - Drugs": "Approved",
    "Clinical evaluation - Diagnostics": "Late development",
    "Phase II - Vaccines": "Phase II",
    "Development - part - Drugs": "Early development",
}

CLEAN_CANDIDATES = f"""{SQL_INCLUSION},
active AS (SELECT c.*, i.* EXCLUDE (row_id), l.vin_name AS stage25 FROM raw_candidates c
  JOIN inclusion i ON i.row_id = c.row_id
  LEFT JOIN raw_rdstageproducts l ON vin_rdstageproductid = _vin_currentrndstage_value
  WHERE statecode = 0),
by_year AS (
  SELECT row_id, '2019-01-01' AS d, vin_2019stagepcr AS st, y2019 AS inc FROM active
  UNION ALL SELECT row_id, '2021-01-01', new_rdstage2021, y2021 FROM active
  UNION ALL SELECT row_id, '2023-01-01', new_2023currentrdstage, y2023 FROM active
  UNION ALL SELECT row_id, '2024-01-01', new_2024currentrdstage, y2024 FROM active
  UNION ALL SELECT row_id, '2025-01-01', stage25, y2025 FROM active),
known_years AS (SELECT * FROM by_year WHERE st IS NOT NULL OR inc IS NOT NULL),
slices AS (SELECT row_id, d AS valid_from, last_value(st IGNORE NULLS) OVER w AS st,
    last_value(inc IGNORE NULLS) OVER w AS includeinpipeline,
    lead(d) OVER (PARTITION BY row_id ORDER BY d) AS valid_to
  FROM known_years WINDOW w AS (PARTITION BY row_id ORDER BY d ROWS UNBOUNDED PRECEDING)),
clean_candidates AS (SELECT a.row_id AS source_row_id, vin_candidateid AS candidateid,
  vin_name AS candidate_name, statecode,
  {sql_map('new_pressuretype', {'Negative pressure ': 'Negative pressure', 'Not applicable ': 'N/A'})}
    AS pressuretype,
  {sql_map('vin_product', {'Drug': 'Drugs', 'Chemical vector control products': 'VCP'},
           'vin_product')} AS product,
  CASE vin_approvalstatus WHEN 862890001 THEN 909670000 ELSE vin_approvalstatus END
    AS approvalstatus,
  CASE vin_approvingauthority WHEN 909670002 THEN 909670001 ELSE vin_approvingauthority END
    AS approvingauthority,
  CASE new_indicationtype WHEN 100000003 THEN 100000001 WHEN 100000004 THEN 100000000
    WHEN 100000005 THEN 100000002 ELSE new_indicationtype END AS indicationtype,
  CASE vin_preclinicalresultsstatus WHEN 909670004 THEN 909670002
    ELSE vin_preclinicalresultsstatus END AS preclinicalresultsstatus,
  vin_whoprequalification AS whoprequalification,
  vin_developersaggregated AS developersaggregated,
  vin_knownfundersaggregated AS knownfundersaggregated,
  _vin_mainproduct_value AS mainproduct_value, _vin_subproduct_value AS subproduct_value,
  _vin_disease_value AS diseasevalue, vin_technologytype AS technologytype,
  CASE a.row_id % 4 WHEN 0 THEN concat('http://x/', a.row_id)
    WHEN 1 THEN concat('https://clinicaltrials.gov/study/nct', a.row_id) END AS ctregistrylink,
  _vin_captype_value AS captype_value, vin_usfdaapprovaldate AS usfdaapprovaldate,
  {sql_map('st', STAGE_NAMES)} AS new_currentrdstage, includeinpipeline, valid_from, valid_to,
  CASE WHEN includeinpipeline = 100000000 THEN 1 ELSE 0 END AS include_in_pipeline
  FROM active a LEFT JOIN slices s ON s.row_id = a.row_id)"""

CLEAN_TRIALS = f"""clean_trials AS (SELECT row_id, vin_clinicaltrialid AS clinicaltrialid,
  _vin_candidate_value AS candidate_value, {sql_phase('vin_ctphase')} AS ctphase,
  {sql_age('new_age')} AS age, {sql_sex('new_sex')} AS sex,
  {sql_study_type('new_studytype')} AS studytype,
  CASE WHEN vin_ctstatus BETWEEN 100000001 AND 100000006 THEN 909670001 ELSE vin_ctstatus END
    AS ctstatus,
  vin_ctenrolment AS cttenrolment, vin_startdate AS startdate, vin_enddate AS enddate,
  new_locations AS locations, vin_name AS name FROM raw_trials)"""

CLEAN_DISEASES = f"""cleaning_diseases AS (SELECT *, {sql_strip('new_diseasefilter')} AS f,
  nullif(nullif({sql_strip('new_secondary_diseae_choice_text')}, ''), 'No secondary disease') AS s
  FROM raw_diseases),
clean_diseases AS (SELECT row_id AS source_row_id, vin_diseaseid AS diseaseid, vin_name AS name,
  vin_disease AS disease, CASE WHEN s = substr(f, strpos(f, ' - ') + 3)
    THEN split_part(f, ' - ', 1) ELSE f END AS disease_filter,
  s AS secondary_disease_name, new_disease_simple AS disease_simple,
  new_globalhealtharea AS globalhealtharea FROM cleaning_diseases)"""

CLEAN_PRIORITIES = """clean_priorities AS (SELECT row_id AS source_row_id,
  vin_rdpriorityid AS rdpriorityid, vin_name AS name,
  CASE new_author WHEN 'World Health Organization' THEN 'WHO' ELSE new_author END AS author,
  new_ppctitle AS ppctitle, new_indication AS indication, _vin_disease_value AS diseasevalue,
  _vin_product_value AS product_value, crc8b_dedicatedtowomenorchildren FROM raw_priorities)"""

CLEAN_DEVELOPERS = f"""enriched_accounts AS (SELECT accountid, name AS org_name,
  CASE WHEN vin_organisationtype = 'NGO' THEN 'NGO' END AS org_type,
  {sql_country('address1_country')} AS country_name FROM raw_accounts),
clean_developers AS (SELECT d.row_id AS source_row_id, vin_developerid AS developerid,
  vin_name AS developer_product_name, _vin_cap_value AS candidateid,
  _vin_developer_value AS accountid, org_name, org_type, country_name
  FROM raw_developers d LEFT JOIN enriched_accounts a ON a.accountid = _vin_developer_value)"""


# --- the clean layer in Spark ------------------------------------------------------------------

# Clean tables that ``clean_frames`` has written when it gives them.
WRITTEN = {"vin_candidates", "vin_clinicaltrials"}


def clean_frames(spark: SparkSession, sf_dir: str):
    """Clean-layer tables by name, each made when it is first asked for."""

    def options(name: str) -> DataFrame:
        return raw(spark, sf_dir, name)

    def job(transform, table: str, sets: dict[str, str] = {}, others: dict[str, str] = {}):
        return transform(
            raw(spark, sf_dir, table),
            {n: options(t) for n, t in sets.items()},
            {n: raw(spark, sf_dir, t) for n, t in others.items()},
        )

    def candidates():
        sets = {
            "_optionset_new_indicationtype": "raw_options_hundred",
            "_optionset_vin_preclinicalresultsstatus": "raw_options_code",
            "_optionset_vin_approvalstatus": "raw_options_code",
            "_optionset_vin_approvingauthority": "raw_options_code",
        }
        return job(
            silver.candidates, "raw_candidates", sets,
            {"vin_rdstageproducts": "raw_rdstageproducts"},
        )

    def cleaned_set(name: str) -> DataFrame:
        removed = silver.candidate_values.OPTION_CODES_REMOVED[name]
        table = "raw_options_hundred" if "indication" in name else "raw_options_code"
        return cleanup.drop_codes(options(table), removed)

    def status_set() -> DataFrame:
        both = options("raw_options_hundred").unionByName(options("raw_options_code"))
        removed = silver.trial_values.OPTION_CODES_REMOVED["_optionset_vin_ctstatus"]
        return cleanup.drop_codes(both, removed)

    generic = {
        "vin_products": "raw_products",
        "vin_rdstages": "raw_rdstages",
        "vin_countries": "raw_countries",
        "accounts": "raw_accounts",
        "vin_sources": "raw_sources",
        "vin_vin_candidate_vin_rdpriorityset": "raw_candidate_priority",
        "vin_vin_candidate_accountset": "raw_candidate_account",
        "vin_vin_clinicaltrial_vin_countryset": "raw_trial_country",
        "_junction_vin_candidates_new_targetcountry": "raw_target_country",
        "_junction_vin_candidates_new_agespecific": "raw_age_specific",
        "_junction_vin_candidates_vin_approvingauthority": "raw_approving_authority",
        "_optionset_agespecific": "raw_options_small",
        "_optionset_whoprequalification": "raw_options_small",
        "_optionset_crc8b_dedicatedtowomenorchildren": "raw_options_small",
        "_optionset_new_targetcountry": "raw_options_country",
    }
    special = {
        # The large clean tables are written once, as the clean-layer job does.
        "vin_candidates": lambda: stage(candidates()[0], "candidates"),
        "vin_clinicaltrials": lambda: stage(
            job(silver.clinical_trials, "raw_trials")[0], "trials"
        ),
        "vin_diseases": lambda: job(silver.diseases, "raw_diseases")[0],
        "vin_rdpriorities": lambda: job(silver.priorities, "raw_priorities")[0],
        "vin_developers": lambda: job(
            silver.developers, "raw_developers", {},
            {"accounts": "raw_accounts", "vin_countries": "raw_countries"},
        )[0],
        "_optionset_indicationtype": lambda: cleaned_set("_optionset_new_indicationtype"),
        "_optionset_preclinicalresultsstatus": lambda: cleaned_set(
            "_optionset_vin_preclinicalresultsstatus"
        ),
        "_optionset_approvalstatus": lambda: cleaned_set("_optionset_vin_approvalstatus"),
        "_optionset_approvingauthority": lambda: cleaned_set(
            "_optionset_vin_approvingauthority"
        ),
        "_optionset_ctstatus": status_set,
        "_optionset_globalhealtharea": lambda: job(
            silver.diseases, "raw_diseases",
            {"_optionset_new_globalhealtharea": "raw_options_area"},
        )[1]["_optionset_new_globalhealtharea"],
    }

    @cache
    def made(name: str) -> DataFrame | None:
        if name in special:
            return special[name]()
        return raw(spark, sf_dir, generic[name]) if name in generic else None

    one_at_a_time: dict[str, Lock] = {}

    def source(name: str) -> DataFrame | None:
        with one_at_a_time.setdefault(name, Lock()):
            return made(name)

    return source


@query(f"WITH {CLEAN_CANDIDATES} SELECT * FROM clean_candidates")
def silver_candidates(spark, sf_dir):
    lookup = {"vin_rdstageproducts": raw(spark, sf_dir, "raw_rdstageproducts")}
    return silver.candidates(raw(spark, sf_dir, "raw_candidates"), {}, lookup)[0]


@query(f"WITH {CLEAN_TRIALS} SELECT * FROM clean_trials")
def silver_trials(spark, sf_dir):
    return silver.clinical_trials(raw(spark, sf_dir, "raw_trials"))[0]


@query(f"WITH {CLEAN_DISEASES} SELECT * FROM clean_diseases")
def silver_diseases(spark, sf_dir):
    return silver.diseases(raw(spark, sf_dir, "raw_diseases"))[0]


@query(f"WITH {CLEAN_PRIORITIES} SELECT * FROM clean_priorities")
def silver_priorities(spark, sf_dir):
    return silver.priorities(raw(spark, sf_dir, "raw_priorities"))[0]


@query(f"WITH {CLEAN_DEVELOPERS} SELECT * FROM clean_developers")
def silver_developers(spark, sf_dir):
    others = {
        "accounts": raw(spark, sf_dir, "raw_accounts"),
        "vin_countries": raw(spark, sf_dir, "raw_countries"),
    }
    return silver.developers(raw(spark, sf_dir, "raw_developers"), {}, others)[0]


# --- the star in SQL ---------------------------------------------------------------------------


def texts(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)


DIM_PRODUCT = """dim_product AS (SELECT row_number() OVER (ORDER BY row_id) AS product_key,
  vin_productid, vin_name AS product_name, vin_name AS product_type,
  CASE WHEN vin_type = 909670000 THEN 'top-level' ELSE 'sub-product' END AS product_level,
  _vin_relatedproduct_value AS parent_product_id FROM raw_products)"""

DIM_DISEASE = """areas AS (SELECT code, CASE label WHEN 'Sexual & reproductive health'
    THEN 'Womens Health' ELSE label END AS label FROM raw_options_area),
dim_disease AS (SELECT row_number() OVER (ORDER BY source_row_id) AS disease_key, diseaseid,
  name AS disease_name, disease AS disease_group_name, label AS global_health_area,
  coalesce(disease_simple, 'Unknown') AS disease_type, disease_filter, secondary_disease_name
  FROM clean_diseases LEFT JOIN areas ON code = globalhealtharea)"""

SORTED_PHASES = {
    "Discovery & Preclinical": 10,
    "Early development": 20,
    "Phase I": 30,
    "Phase II": 40,
    "Phase III": 50,
    "Late development": 60,
    "Regulatory filing": 70,
    "Approved": 80,
    "Post-marketing surveillance": 90,
    "Human safety & efficacy": 95,
    "Not applicable": 999,
    "Unclear": 998,
}

DIM_PHASE = f"""named_phases AS (SELECT DISTINCT new_currentrdstage AS phase_name
  FROM clean_candidates WHERE new_currentrdstage IS NOT NULL),
listed_phases AS (SELECT min(vin_rdstageid) AS vin_rdstageid, vin_name AS phase_name
  FROM raw_rdstages WHERE vin_name IN (SELECT phase_name FROM named_phases) GROUP BY vin_name),
all_phases AS (SELECT * FROM listed_phases UNION ALL SELECT NULL, phase_name FROM named_phases
  WHERE phase_name NOT IN (SELECT phase_name FROM listed_phases)
    AND {sql_map('phase_name', SORTED_PHASES)} IS NOT NULL),
dim_phase AS (SELECT row_number() OVER (ORDER BY sort_order, phase_name) AS phase_key, * FROM (
  SELECT vin_rdstageid, phase_name,
    CAST({sql_map('phase_name', SORTED_PHASES, '500')} AS BIGINT) AS sort_order
  FROM all_phases) AS p)"""

ISO = {
    "Turkey": "TUR",
    "United Kingdom": "GBR",
    "United States of America": "USA",
    "South Korea": "KOR",
    "France": "FRA",
    "Kosovo": "XKX",
}

DIM_GEOGRAPHY = f"""dim_geography AS (SELECT row_number() OVER (ORDER BY row_id) AS country_key,
  vin_countryid, vin_name AS country_name, {sql_map('vin_name', ISO)} AS iso_code,
  'Unknown' AS region_name FROM raw_countries)"""

DIM_ORGANIZATION = """dim_organization AS (SELECT row_number() OVER (ORDER BY row_id)
  AS organization_key, accountid, name AS org_name,
  coalesce(vin_organisationtype, 'Unknown') AS org_type FROM raw_accounts)"""

DIM_PRIORITY = f"""dim_priority AS (SELECT row_number() OVER (ORDER BY source_row_id)
  AS priority_key, rdpriorityid, ppctitle AS priority_name, coalesce(indication, '') AS indication,
  '' AS intended_use, disease_key, product_key, author,
  {texts('publication_date', 'target_population', 'efficacy', 'safety', 'source')},
  label AS dedicated_to_women_or_children
  FROM clean_priorities LEFT JOIN dim_disease ON diseaseid = diseasevalue
  LEFT JOIN dim_product ON vin_productid = product_value
  LEFT JOIN raw_options_small ON code = crc8b_dedicatedtowomenorchildren)"""

DIM_DATE = """dim_date AS (SELECT row_number() OVER (ORDER BY d) AS date_key,
  strftime(d, '%Y-%m-%d') AS full_date, year(d) AS year, quarter(d) AS quarter
  FROM (SELECT unnest(generate_series(TIMESTAMP '2015-01-01', TIMESTAMP '2030-12-31',
    INTERVAL 1 DAY)) AS d) AS days)"""

DIM_AGE_GROUP = """dim_age_group AS (SELECT row_number() OVER (ORDER BY code) AS age_group_key,
  label AS age_group_name, code AS option_code FROM raw_options_small)"""

DIM_AUTHORITY = """dim_approving_authority AS (SELECT row_number() OVER (ORDER BY code)
  AS authority_key, label AS authority_name, code AS option_code FROM raw_options_code
  WHERE code <> 909670002)"""

DIM_CORE = f"""dim_candidate_core AS (SELECT row_number() OVER
    (ORDER BY source_row_id, valid_from NULLS FIRST) AS candidate_key, candidateid, candidate_name,
  {texts('vin_candidate_code')}, developersaggregated AS developers_agg,
  {texts('alternative_names', 'target', 'mechanism_of_action', 'key_features')},
  knownfundersaggregated AS known_funders_agg, {texts('development_status')},
  new_currentrdstage AS current_rd_stage, CAST(NULL AS BIGINT) AS countries_approved_count,
  {texts('countries_approved_agg')},
  CASE captype_value WHEN 'c1746ad3-93d1-f011-bbd3-00224892cefa' THEN 'Candidate'
    WHEN '545d63d9-93d1-f011-bbd3-00224892cefa' THEN 'Product' ELSE 'Other' END AS candidate_type,
  {texts('indication')}, h.label AS indication_type, {texts('healthcare_facility_level')},
  p.label AS preclinical_results_status,
  {texts('type_of_preclinical_results', 'preclinical_results_source', 'recent_updates',
         'test_format', 'technology_principle', 'target_population', 'route_of_administration',
         'platform', 'chim_study')}, ctregistrylink AS key_clinical_trial
  FROM clean_candidates
  LEFT JOIN raw_options_hundred h ON h.code = indicationtype
    AND h.code NOT IN (100000003, 100000004, 100000005)
  LEFT JOIN raw_options_code p ON p.code = preclinicalresultsstatus AND p.code <> 909670004),
candidate_keys AS (SELECT candidateid, max(candidate_key) AS candidate_key
  FROM dim_candidate_core GROUP BY candidateid)"""

DIM_TECH = """dim_candidate_tech AS (SELECT row_number() OVER (ORDER BY technology_type)
  AS technology_key, technology_type FROM (SELECT DISTINCT
    coalesce(technologytype, 'Unknown') AS technology_type FROM clean_candidates) AS t)"""

DIM_REGULATORY = f"""regulatory_sources AS (SELECT DISTINCT approvalstatus, usfdaapprovaldate,
    whoprequalification FROM clean_candidates),
regulatory_rows AS (SELECT a.label AS approval_status, usfdaapprovaldate AS fda_approval_date,
  {texts('who_prequal_date')}, w.label AS who_prequalification,
  {texts('nra_approval_status', 'sra_approval_status', 'ema_approval_status',
         'japanese_mhlw_approval_status', 'us_fda_approval_status')},
  approvalstatus, whoprequalification FROM regulatory_sources
  LEFT JOIN raw_options_code a ON a.code = approvalstatus
  LEFT JOIN raw_options_small w ON w.code = whoprequalification),
regulatory_keyed AS (SELECT row_number() OVER (ORDER BY approval_status NULLS FIRST,
    fda_approval_date NULLS FIRST, who_prequalification NULLS FIRST, approvalstatus NULLS FIRST,
    whoprequalification NULLS FIRST) AS regulatory_key, * FROM regulatory_rows),
dim_candidate_regulatory AS (SELECT * EXCLUDE (approvalstatus, whoprequalification)
  FROM regulatory_keyed),
regulatory_last AS (SELECT approvalstatus, fda_approval_date, whoprequalification,
  max(regulatory_key) OVER (PARTITION BY approval_status, fda_approval_date, who_prequalification)
    AS regulatory_key FROM regulatory_keyed)"""


def delimited_dimension(name: str, key: str, column: str, out: str) -> str:
    return f"""{name} AS (SELECT row_number() OVER (ORDER BY {out}) AS {key}, {out} FROM (
  SELECT DISTINCT {sql_strip('part')} AS {out} FROM (SELECT unnest(string_split({column}, ';'))
    AS part FROM clean_candidates) AS s) AS d WHERE {out} <> '')"""


DIM_DEVELOPER = delimited_dimension(
    "dim_developer", "developer_key", "developersaggregated", "developer_name"
)
DIM_FUNDER = delimited_dimension(
    "dim_funder", "funder_key", "knownfundersaggregated", "funder_name"
)

FACT_SNAPSHOT = """reporting AS (SELECT DISTINCT CAST(substr(d, 1, 4) AS INTEGER) AS y FROM (
    SELECT valid_from AS d FROM clean_candidates UNION ALL SELECT valid_to FROM clean_candidates)
    AS e WHERE d IS NOT NULL),
spans AS (SELECT *, CAST(substr(valid_from, 1, 4) AS INTEGER) AS y1,
  coalesce(CAST(substr(valid_to, 1, 4) AS INTEGER), (SELECT max(y) FROM reporting) + 1) AS y2
  FROM clean_candidates),
copies AS (SELECT s.*, y, max(y) OVER (PARTITION BY source_row_id, valid_from) AS last_y
  FROM spans s JOIN reporting ON y > y1 AND y < y2),
snapshots AS (SELECT *, valid_from AS day, CASE WHEN valid_to IS NULL AND NOT EXISTS (
    SELECT 1 FROM copies c WHERE c.source_row_id = s.source_row_id AND c.valid_from = s.valid_from)
    THEN 1 ELSE 0 END AS active, CAST(NULL AS INTEGER) AS y FROM spans s
  UNION ALL BY NAME SELECT * EXCLUDE (last_y), concat(y, '-01-01') AS day,
    CASE WHEN valid_to IS NULL AND y = last_y THEN 1 ELSE 0 END AS active FROM copies),
fact_pipeline_snapshot AS (SELECT row_number() OVER (ORDER BY source_row_id,
    valid_from NULLS FIRST, y NULLS FIRST) AS snapshot_id, k.candidate_key, p.product_key,
  d.disease_key, sp.product_key AS sub_product_key, t.technology_key, r.regulatory_key,
  ph.phase_key, dd.date_key, CAST(active AS BIGINT) AS is_active_flag, include_in_pipeline
  FROM snapshots s LEFT JOIN candidate_keys k ON k.candidateid = s.candidateid
  LEFT JOIN dim_product p ON p.vin_productid = mainproduct_value
  LEFT JOIN dim_product sp ON sp.vin_productid = subproduct_value
  LEFT JOIN dim_disease d ON d.diseaseid = diseasevalue
  LEFT JOIN dim_candidate_tech t ON t.technology_type = coalesce(technologytype, 'Unknown')
  LEFT JOIN regulatory_last r ON r.approvalstatus IS NOT DISTINCT FROM s.approvalstatus
    AND r.fda_approval_date IS NOT DISTINCT FROM s.usfdaapprovaldate
    AND r.whoprequalification IS NOT DISTINCT FROM s.whoprequalification
  LEFT JOIN dim_phase ph ON ph.phase_name = new_currentrdstage
  LEFT JOIN dim_date dd ON dd.full_date = s.day)"""

FACT_TRIAL = f"""last_snapshot AS (SELECT candidate_key, disease_key, product_key
  FROM fact_pipeline_snapshot QUALIFY row_number() OVER
    (PARTITION BY candidate_key ORDER BY snapshot_id DESC) = 1),
fact_clinical_trial_event AS (SELECT row_number() OVER (ORDER BY row_id) AS trial_id,
  clinicaltrialid, k.candidate_key, l.disease_key, l.product_key, s.date_key AS start_date_key,
  name AS trial_name, {texts('trial_title')}, ctphase AS trial_phase,
  coalesce(cttenrolment, 0) AS enrollment_count, o.label AS status, {texts('sponsor')}, locations,
  age AS age_groups, studytype AS study_type,
  {texts('source_text', 'description', 'ct_results_status')}, e.date_key AS end_date_key,
  CAST(NULL AS BIGINT) AS last_updated_key,
  {texts('collaborator', 'funder_type', 'interventions', 'conditions')},
  CAST(NULL AS BIGINT) AS primary_completion_date_key, {texts('outcome_measure')}, sex,
  {texts('study_design', 'ct_results_type', 'ct_terminated_reason')}
  FROM clean_trials LEFT JOIN candidate_keys k ON k.candidateid = candidate_value
  LEFT JOIN last_snapshot l ON l.candidate_key = k.candidate_key
  LEFT JOIN dim_date s ON s.full_date = startdate
  LEFT JOIN dim_date e ON length(enddate) >= 10 AND e.full_date = substr(enddate, 1, 10)
  LEFT JOIN (SELECT * FROM raw_options_hundred WHERE code = 100000000
    UNION ALL SELECT * FROM raw_options_code) o ON o.code = ctstatus)"""

FACT_PUBLICATION = """fact_publication AS (SELECT row_number() OVER (ORDER BY row_id)
  AS publication_id, candidate_key, vin_name AS title, vin_url AS url,
  vin_description AS description FROM raw_sources
  LEFT JOIN candidate_keys ON candidateid = _vin_regardingid_value)"""

BRIDGE_GEOGRAPHY = """bridge_candidate_geography AS (
  SELECT candidate_key, country_key, 'Target Country' AS location_scope FROM raw_target_country
    JOIN candidate_keys ON candidateid = entity_id JOIN raw_options_country o ON code = option_code
    JOIN dim_geography ON country_name = label
  UNION SELECT candidate_key, country_key, 'Developer Location' FROM clean_developers d
    JOIN candidate_keys k ON k.candidateid = d.candidateid
    JOIN dim_geography g ON g.country_name = d.country_name)"""


def delimited_bridge(name: str, column: str, dimension: str, key: str, value: str) -> str:
    return f"""{name} AS (SELECT candidate_key, {key} FROM (SELECT candidateid,
    unnest(string_split({column}, ';')) AS part FROM clean_candidates) AS s
  JOIN candidate_keys k ON k.candidateid = s.candidateid
  JOIN {dimension} ON {value} = {sql_strip('part')})"""


BRIDGE_DEVELOPER = delimited_bridge(
    "bridge_candidate_developer", "developersaggregated", "dim_developer", "developer_key",
    "developer_name",
)
BRIDGE_FUNDER = delimited_bridge(
    "bridge_candidate_funder", "knownfundersaggregated", "dim_funder", "funder_key", "funder_name"
)
BRIDGE_PRIORITY = """bridge_candidate_priority AS (SELECT candidate_key, priority_key
  FROM raw_candidate_priority JOIN candidate_keys ON candidateid = vin_candidateid
  JOIN dim_priority ON rdpriorityid = vin_rdpriorityid)"""
BRIDGE_AGE_GROUP = """bridge_candidate_age_group AS (SELECT candidate_key, age_group_key
  FROM raw_age_specific a JOIN candidate_keys ON candidateid = entity_id
  JOIN dim_age_group g ON g.option_code = a.option_code)"""
BRIDGE_AUTHORITY = """bridge_candidate_approving_authority AS (SELECT candidate_key, authority_key
  FROM raw_approving_authority a JOIN candidate_keys ON candidateid = entity_id
  JOIN dim_approving_authority g ON g.option_code = a.option_code)"""
BRIDGE_ORGANIZATION = """bridge_candidate_organization AS (SELECT candidate_key, organization_key
  FROM raw_candidate_account a JOIN candidate_keys ON candidateid = vin_candidateid
  JOIN dim_organization o ON o.accountid = a.accountid)"""

# Each location names two countries and England; the two are matched by their own names.
LOCATED = """segments AS (SELECT row_id, clinicaltrialid, trim(unnest(regexp_split_to_array(
    locations, '[|;]'))) AS seg FROM clean_trials),
attempts AS (SELECT row_id, clinicaltrialid, lower(seg) AS whole,
  CASE WHEN contains(seg, ',') THEN lower(trim(string_split(seg, ',')[-1])) END AS tail,
  lower(trim(nullif(regexp_extract(seg, '\\(([^)]+)\\)', 1), ''))) AS inside FROM segments
  WHERE seg <> ''),
spelled AS (SELECT lower(country_name) AS spelling, country_key FROM dim_geography
  UNION ALL SELECT 'england', country_key FROM dim_geography WHERE country_name = 'United Kingdom'),
located AS (SELECT DISTINCT row_id, clinicaltrialid,
    coalesce(a.country_key, b.country_key, c.country_key) AS country_key FROM attempts
  LEFT JOIN spelled a ON a.spelling = whole LEFT JOIN spelled b ON b.spelling = tail
  LEFT JOIN spelled c ON c.spelling = inside)"""
BRIDGE_TRIAL = """bridge_trial_geography AS (
  SELECT trial_id AS trial_key, country_key FROM raw_trial_country c
    JOIN fact_clinical_trial_event f ON f.clinicaltrialid = c.vin_clinicaltrialid
    JOIN dim_geography g ON g.vin_countryid = c.vin_countryid
  UNION SELECT trial_id, country_key FROM located l
    JOIN fact_clinical_trial_event f ON f.clinicaltrialid = l.clinicaltrialid
    WHERE country_key IS NOT NULL)"""

SQL_STAR = ",\n".join(
    [
        CLEAN_CANDIDATES, CLEAN_TRIALS, CLEAN_DISEASES, CLEAN_PRIORITIES, CLEAN_DEVELOPERS,
        DIM_PRODUCT, DIM_DISEASE, DIM_PHASE, DIM_GEOGRAPHY, DIM_ORGANIZATION, DIM_PRIORITY,
        DIM_DATE, DIM_AGE_GROUP, DIM_AUTHORITY, DIM_CORE, DIM_TECH, DIM_REGULATORY, DIM_DEVELOPER,
        DIM_FUNDER, FACT_SNAPSHOT, FACT_TRIAL, FACT_PUBLICATION, BRIDGE_GEOGRAPHY,
        BRIDGE_DEVELOPER, BRIDGE_PRIORITY, BRIDGE_AGE_GROUP, BRIDGE_AUTHORITY,
        BRIDGE_ORGANIZATION, BRIDGE_FUNDER, LOCATED, BRIDGE_TRIAL,
    ]
)


# --- the star in Spark -------------------------------------------------------------------------


def required(names: list[str]) -> list[str]:
    """The named tables and everything they are built from, in load order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for other in star.needs(star_map.TABLES[name]) - wanted:
            add(other)
        wanted.add(name)

    for name in names:
        add(name)
    return [n for n in star_map.TABLES if n in wanted]


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One star table, built together with the tables it refers to. Keys are written once
    where they are made, so the other steps stay part of one plan."""
    built = star.Star(spark, clean_frames(spark, sf_dir), lambda _, df: df, stored=WRITTEN.__contains__)
    return star.build(built, only=required([name]))[name]


STAR_QUERIES = {
    "dim_standard": "dim_candidate_core",
    "dim_product": "dim_product",
    "dim_disease": "dim_disease",
    "dim_phase": "dim_phase",
    "dim_geography": "dim_geography",
    "dim_organization": "dim_organization",
    "dim_priority": "dim_priority",
    "dim_optionset": "dim_approving_authority",
    "dim_age_group": "dim_age_group",
    "dim_distinct": "dim_candidate_regulatory",
    "dim_candidate_tech": "dim_candidate_tech",
    "dim_delimited": "dim_developer",
    "dim_funder": "dim_funder",
    "fact_snapshot": "fact_pipeline_snapshot",
    "fact_trial": "fact_clinical_trial_event",
    "fact_publication": "fact_publication",
    "bridge_standard": "bridge_candidate_priority",
    "bridge_age_group": "bridge_candidate_age_group",
    "bridge_approving_authority": "bridge_candidate_approving_authority",
    "bridge_organization": "bridge_candidate_organization",
    "bridge_delimited": "bridge_candidate_developer",
    "bridge_funder": "bridge_candidate_funder",
    "bridge_union_geo": "bridge_candidate_geography",
    "bridge_trial_geo": "bridge_trial_geography",
}


def _register(name: str, table: str) -> None:
    @query(f"WITH {SQL_STAR} SELECT * FROM {table}", name)
    def run(spark, sf_dir):
        return star_table(spark, sf_dir, table)


for _name, _table in STAR_QUERIES.items():
    _register(_name, _table)


@query(f"""WITH {CLEAN_TRIALS}, {DIM_GEOGRAPHY}, {LOCATED}
SELECT row_id, country_key FROM located WHERE country_key IS NOT NULL""")
def parse_locations(spark, sf_dir):
    countries = raw(spark, sf_dir, "raw_countries").select(
        (F.col("row_id") + 1).cast("bigint").alias("country_key"), "vin_name"
    )
    return lookups.parse_locations(
        raw(spark, sf_dir, "raw_trials"), "row_id", F.col("new_locations"), countries,
        "country_key", "vin_name",
    )


def key_columns(table: str) -> list[str]:
    """Surrogate-key columns of a star table."""
    declared = star_map.TABLES[table]
    return [c for c in declared.declared() if c.endswith("_key") or c == declared.pk]


def sql_key_sum(table: str) -> str:
    total = " + ".join(f"coalesce(sum({c}), 0)" for c in key_columns(table))
    return (
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, "
        f"CAST({total} AS BIGINT) AS key_sum FROM {table}"
    )


def key_sums(table: str, df: DataFrame) -> DataFrame:
    total = (F.coalesce(F.sum(c), F.lit(0)) for c in key_columns(table))
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        reduce(lambda a, b: a + b, total).alias("key_sum"),
    )


@query(f"WITH {SQL_STAR}\n" + "\nUNION ALL ".join(map(sql_key_sum, star_map.TABLES)))
def star_load(spark, sf_dir):
    """Build and write all 25 tables; report rows and the sum of all keys per table."""
    built = star.Star(
        spark, clean_frames(spark, sf_dir), lambda name, df: stage(df, name), stored=WRITTEN.__contains__
    )
    reports = [key_sums(name, df) for name, df in star.build(built).items()]
    return reduce(DataFrame.unionAll, reports)


# Raw tables of the stored layer by name; the two option sets of the trial status are one there.
RAW_LAYER = {
    "vin_candidates": "raw_candidates",
    "vin_clinicaltrials": "raw_trials",
    "vin_diseases": "raw_diseases",
    "vin_rdpriorities": "raw_priorities",
    "vin_developers": "raw_developers",
    "vin_rdstageproducts": "raw_rdstageproducts",
    "vin_products": "raw_products",
    "vin_rdstages": "raw_rdstages",
    "vin_countries": "raw_countries",
    "accounts": "raw_accounts",
    "vin_sources": "raw_sources",
    "vin_vin_candidate_vin_rdpriorityset": "raw_candidate_priority",
    "vin_vin_candidate_accountset": "raw_candidate_account",
    "vin_vin_clinicaltrial_vin_countryset": "raw_trial_country",
    "_junction_vin_candidates_new_targetcountry": "raw_target_country",
    "_junction_vin_candidates_new_agespecific": "raw_age_specific",
    "_junction_vin_candidates_vin_approvingauthority": "raw_approving_authority",
    "_optionset_new_indicationtype": "raw_options_hundred",
    "_optionset_vin_preclinicalresultsstatus": "raw_options_code",
    "_optionset_vin_approvalstatus": "raw_options_code",
    "_optionset_vin_approvingauthority": "raw_options_code",
    "_optionset_new_globalhealtharea": "raw_options_area",
    "_optionset_new_agespecific": "raw_options_small",
    "_optionset_vin_whoprequalification": "raw_options_small",
    "_optionset_crc8b_dedicatedtowomenorchildren": "raw_options_small",
    "_optionset_new_targetcountry": "raw_options_country",
}
SYNC_RUNS = """
SELECT 'completed' AS status, CAST(o_orderkey AS BIGINT) AS records_added,
  CAST(NULL AS BIGINT) AS records_updated, CAST(o_orderdate AS STRING) AS end_time FROM orders"""


@query(f"WITH {SQL_STAR}\n" + "\nUNION ALL ".join(map(sql_key_sum, star_map.TABLES)) + f"""
UNION ALL SELECT 'foreign keys', {len(star_map.foreign_keys())}, 0
UNION ALL SELECT 'last_sync_date ' || max(CAST(o_orderdate AS VARCHAR)), 1, 0 FROM orders""")
def layers_load(spark, sf_dir):
    """Both jobs over stored layers: raw tables to a clean layer, the clean layer to the star.

    The raw layer also holds an empty table, an unregistered one and a log of which one count
    column has no value. A layer goes when the next one stands: nothing reads it after that.
    """
    folder = f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}"
    raw_layer = Layer(spark, f"{folder}/raw")
    for name, table in RAW_LAYER.items():
        raw_layer.write(name, raw(spark, sf_dir, table))
    both = raw(spark, sf_dir, "raw_options_hundred").unionByName(raw(spark, sf_dir, "raw_options_code"))
    raw_layer.write("_optionset_vin_ctstatus", both)
    raw_layer.write("vin_unregistered", raw(spark, sf_dir, "raw_sources"))
    raw_layer.write("vin_empty", raw(spark, sf_dir, "raw_sources").limit(0))
    raw_layer.write(star.SYNC_LOG, derive(spark, sf_dir, SYNC_RUNS))
    silver.clean_layer(spark, raw_layer.folder, f"{folder}/clean")
    raw_layer.delete()
    report = star.star_layer(spark, f"{folder}/clean")
    Layer(spark, f"{folder}/clean").delete()
    done = Layer(spark, f"{folder}/star")
    reports = [key_sums(name, done.read(name)) for name in star_map.TABLES]
    checked = report.fk_integrity.agg(
        F.lit("foreign keys").alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("orphans").cast("bigint").alias("key_sum"),
    )
    told = report.metadata.groupBy(F.concat_ws(" ", "key", "value").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("bigint").alias("key_sum")
    )
    return reduce(DataFrame.unionAll, [*reports, checked, told])
