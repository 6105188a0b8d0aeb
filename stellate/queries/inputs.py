"""Raw-layer tables derived from the given tables.

The given tables hold no candidates or trials. The texts below derive stand-ins with the raw
layer's column names from them, whole table by whole table, in SQL that Spark and the checking
engine both read, so that a query and its check start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

STAGE_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Preclinical - Drugs'
      WHEN '2-HIGH' THEN 'Phase I/II' WHEN '3-MEDIUM' THEN 'Phase III - Vaccines'
      WHEN '4-NOT SPECIFIED' THEN 'Unclear - Drugs' ELSE 'Regulatory filing - Diagnostics' END"""
ANSWER = "CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE 'Maybe' END"
CODE = """CAST(CASE o_orderstatus WHEN 'F' THEN 100000000 WHEN 'O' THEN 100000001
      ELSE NULL END AS BIGINT)"""
CODE_2024 = """CAST(CASE o_orderstatus WHEN 'F' THEN 862890000 WHEN 'O' THEN 100000001
      ELSE 100000002 END AS BIGINT)"""


# Every year of the orders stands for one of the yearly columns.
_MEANS = {1995: "<= 1996", 1997: "= 1997", 1998: "= 1998", 1999: "IN (1999, 2000)", 2001: ">= 2001"}


def _in_year(expression: str, year: int) -> str:
    return f"max(CASE WHEN year(o_orderdate) {_MEANS[year]} THEN {expression} END)"


COUNTRY = """CASE n_nationkey WHEN 0 THEN 'Turkey' WHEN 1 THEN 'United Kingdom'
      WHEN 2 THEN 'United States of America' WHEN 3 THEN 'South Korea' WHEN 4 THEN 'France'
      WHEN 5 THEN 'Kosovo' WHEN 6 THEN 'European Union' ELSE n_name END"""

# A date of the orders, moved by twenty years into the range of the date dimension.
MOVED_DATE = """concat(CAST(year(o_orderdate) + 20 AS STRING),
      substring(CAST(o_orderdate AS STRING), 5, 6))"""

RAW: dict[str, str] = {
    "raw_yearly": f"""
SELECT o_custkey,
  {_in_year(STAGE_TEXT, 1995)} AS vin_2019stagepcr,
  {_in_year(STAGE_TEXT, 1997)} AS new_rdstage2021,
  {_in_year(STAGE_TEXT, 1998)} AS new_2023currentrdstage,
  {_in_year(STAGE_TEXT, 1999)} AS new_2024currentrdstage,
  {_in_year("concat(CASE WHEN o_custkey % 8 = 0 THEN 'none' ELSE 'g' END, o_orderpriority)", 2001)} AS _vin_currentrndstage_value,
  {_in_year(ANSWER, 1995)} AS vin_2019pcrpipelineinclusion,
  {_in_year(CODE, 1997)} AS new_includeinpipeline2021,
  {_in_year(ANSWER, 1998)} AS new_2023includeinevgendatabase,
  {_in_year(CODE_2024, 1999)} AS new_2024includeinpipeline,
  {_in_year(CODE, 2001)} AS new_includeinpipeline
FROM orders GROUP BY o_custkey""",
    "raw_candidates": """
SELECT c_custkey AS row_id, concat('c', c_custkey) AS vin_candidateid, c_name AS vin_name,
  CASE WHEN c_nationkey = 7 THEN 1 WHEN c_nationkey = 8 THEN NULL ELSE 0 END AS statecode,
  vin_2019stagepcr, new_rdstage2021, new_2023currentrdstage, new_2024currentrdstage,
  _vin_currentrndstage_value, vin_2019pcrpipelineinclusion, new_includeinpipeline2021,
  new_2023includeinevgendatabase, new_2024includeinpipeline, new_includeinpipeline,
  CASE c_nationkey % 4 WHEN 0 THEN 'Negative pressure ' WHEN 1 THEN 'Not applicable ' END
    AS new_pressuretype,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Drug' WHEN 'AUTOMOBILE'
    THEN 'Chemical vector control products' ELSE c_mktsegment END AS vin_product,
  CAST(CASE c_nationkey % 5 WHEN 0 THEN 862890001 WHEN 1 THEN 909670000 WHEN 2 THEN 909670005
    WHEN 3 THEN 909670006 END AS BIGINT) AS vin_approvalstatus,
  CAST(909670000 + c_nationkey % 4 + CASE WHEN c_custkey % 11 = 0 THEN 900 ELSE 0 END AS BIGINT)
    AS vin_approvingauthority,
  CAST(100000000 + c_nationkey % 6 + CASE WHEN c_custkey % 13 = 0 THEN 900 ELSE 0 END AS BIGINT)
    AS new_indicationtype,
  CAST(909670000 + c_nationkey % 5 AS BIGINT) AS vin_preclinicalresultsstatus,
  CAST(c_nationkey % 3 AS BIGINT) AS vin_whoprequalification,
  concat('Lab ', c_mktsegment, '; ', c_name, ' ;; Unit ', c_nationkey) AS vin_developersaggregated,
  CASE WHEN c_nationkey % 6 > 0 THEN concat('Fund ', c_mktsegment, ';Fund ', c_nationkey, ' ')
    END AS vin_knownfundersaggregated,
  concat('p', c_custkey) AS _vin_mainproduct_value,
  concat('p', c_custkey * 2) AS _vin_subproduct_value,
  CASE WHEN c_nationkey % 9 > 0 THEN concat('d', c_custkey % 130) END AS _vin_disease_value,
  NULLIF(c_mktsegment, 'MACHINERY') AS vin_technologytype,
  CASE c_custkey % 4 WHEN 0 THEN concat(' http://x/', c_custkey) WHEN 1
    THEN concat('x', chr(10), 'nct', c_custkey, ' ', chr(10), 'NCT9') WHEN 2 THEN 'none' END
    AS new_ctregistrylink,
  CASE c_custkey % 3 WHEN 0 THEN 'c1746ad3-93d1-f011-bbd3-00224892cefa'
    WHEN 1 THEN '545d63d9-93d1-f011-bbd3-00224892cefa' END AS _vin_captype_value,
  CASE WHEN c_nationkey % 2 = 0 THEN concat('2020-01-', 10 + c_nationkey) END
    AS vin_usfdaapprovaldate,
  '{}' AS json_response, CAST(NULL AS STRING) AS new_always_empty
FROM customer LEFT JOIN raw_yearly ON o_custkey = c_custkey""",
    "raw_rdstageproducts": """
SELECT DISTINCT concat('g', o_orderpriority) AS vin_rdstageproductid,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Phase IV - Drugs' WHEN '2-HIGH'
    THEN 'Clinical evaluation - Diagnostics' WHEN '3-MEDIUM' THEN 'Phase II - Vaccines'
    ELSE 'Development - part - Drugs' END AS vin_name
FROM orders""",
    "raw_rdstages": """
SELECT DISTINCT concat('st', o_orderpriority, o_orderstatus) AS vin_rdstageid,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Phase II' WHEN '2-HIGH' THEN 'Phase III'
    WHEN '3-MEDIUM' THEN 'Phase IX' WHEN '4-NOT SPECIFIED' THEN 'Unclear' ELSE '' END AS vin_name
FROM orders""",
    "raw_products": """
SELECT p_partkey AS row_id, concat('p', p_partkey) AS vin_productid, p_type AS vin_name,
  CAST(CASE WHEN p_size % 3 = 0 THEN 909670000 WHEN p_size % 3 = 1 THEN 909670001 END AS BIGINT)
    AS vin_type,
  CASE WHEN p_partkey % 10 > 0 THEN concat('p', p_partkey - p_partkey % 10) END
    AS _vin_relatedproduct_value
FROM part""",
    "raw_diseases": """
SELECT s_suppkey AS row_id, concat('d', s_suppkey) AS vin_diseaseid, s_name AS vin_name,
  concat('Group ', s_nationkey) AS vin_disease,
  CASE WHEN s_suppkey % 5 = 0 THEN concat('Group ', s_nationkey, ' - x - ', s_name, ' ')
    ELSE concat('Group ', s_nationkey, ' - ', s_name, ' ') END AS new_diseasefilter,
  CASE s_suppkey % 4 WHEN 0 THEN concat(chr(9), s_name) WHEN 1 THEN 'No secondary disease '
    WHEN 2 THEN ' ' END AS new_secondary_diseae_choice_text,
  NULLIF(concat('Simple ', s_nationkey % 3), 'Simple 1') AS new_disease_simple,
  CAST(s_nationkey AS BIGINT) AS new_globalhealtharea, 1 AS statecode, 'now' AS sync_time
FROM supplier""",
    "raw_priorities": """
SELECT p_partkey AS row_id, concat('r', p_partkey) AS vin_rdpriorityid, p_name AS vin_name,
  CASE WHEN p_size % 2 = 0 THEN 'World Health Organization' ELSE p_brand END AS new_author,
  concat(p_brand, ' ', p_type) AS new_ppctitle, NULLIF(p_type, 'ECONOMY') AS new_indication,
  concat('d', p_size * 3) AS _vin_disease_value, concat('p', p_partkey * 2) AS _vin_product_value,
  CAST(p_size % 4 AS BIGINT) AS crc8b_dedicatedtowomenorchildren,
  CAST(NULL AS STRING) AS new_safety
FROM part""",
    "raw_countries": f"""
SELECT n_nationkey AS row_id, concat('k', n_nationkey) AS vin_countryid, {COUNTRY} AS vin_name,
  CAST(NULLIF(n_nationkey, 9) AS BIGINT) AS vin_countryno
FROM nation""",
    "raw_accounts": f"""
SELECT s_suppkey AS row_id, concat('a', s_suppkey) AS accountid, s_name AS name,
  CASE s_suppkey % 4 WHEN 0 THEN '5001' WHEN 1 THEN 'NGO' WHEN 2 THEN ' -1.5 ' END
    AS vin_organisationtype,
  CASE s_suppkey % 6 WHEN 0 THEN upper({COUNTRY}) WHEN 1 THEN concat(n_nationkey, '.0')
    WHEN 2 THEN 'Not specified' WHEN 3 THEN concat(' ', {COUNTRY}, chr(9)) WHEN 4 THEN 'Korea'
    END AS address1_country
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "raw_developers": """
SELECT l_orderkey * 100 + l_linenumber AS row_id,
  concat('v', l_orderkey, '-', l_linenumber) AS vin_developerid,
  concat(l_returnflag, l_linestatus) AS vin_name,
  concat('c', l_partkey) AS _vin_cap_value,
  CASE WHEN l_linenumber < 7 THEN concat('a', l_suppkey + l_linenumber) END AS _vin_developer_value
FROM lineitem""",
    "raw_trials": f"""
SELECT o_orderkey AS row_id, concat('t', o_orderkey) AS vin_clinicaltrialid,
  CASE WHEN o_orderkey % 11 > 0 THEN concat('c', o_custkey) END AS _vin_candidate_value,
  CASE o_orderkey % 9 WHEN 0 THEN 'Phase 2/3' WHEN 1 THEN concat('Phase', chr(10), 'III')
    WHEN 2 THEN 'early_phase1' WHEN 3 THEN ' n/a ' WHEN 4 THEN 'None' WHEN 5 THEN 'chim IV'
    WHEN 6 THEN o_orderpriority WHEN 7 THEN 'iv' END AS vin_ctphase,
  CASE o_orderkey % 5 WHEN 0 THEN concat(o_orderkey % 70, ' Years and older') WHEN 1
    THEN concat(o_orderkey % 70, ' months') WHEN 2 THEN 'Infant, Child' WHEN 3 THEN 'neonate' END
    AS new_age,
  CASE o_orderkey % 6 WHEN 0 THEN 'female: yes <br>male: yes' WHEN 1 THEN 'Female: Yes, Male: No'
    WHEN 2 THEN ' m ' WHEN 3 THEN 'Men and female' WHEN 4 THEN o_orderstatus END AS new_sex,
  CASE o_orderkey % 4 WHEN 0 THEN ' interventional Study' WHEN 1 THEN 'Observational'
    WHEN 2 THEN o_orderpriority END AS new_studytype,
  CAST(CASE WHEN o_orderkey % 8 < 7 THEN 100000000 + o_orderkey % 8 END AS BIGINT) AS vin_ctstatus,
  CAST(NULLIF(o_orderkey % 500, 0) AS BIGINT) AS vin_ctenrolment,
  CASE WHEN o_orderkey % 3 = 0 THEN concat({MOVED_DATE}, 'T00:00:00Z') ELSE {MOVED_DATE} END
    AS vin_startdate,
  CASE o_orderkey % 4 WHEN 0 THEN 'soon' WHEN 1 THEN {MOVED_DATE}
    WHEN 2 THEN concat({MOVED_DATE}, 'T10:00:00Z') END AS vin_enddate,
  concat('Site ', o_orderkey, ', City, ', lower(a.vin_name),
    CASE WHEN o_orderkey % 2 = 0 THEN '|' ELSE ' ; ' END, 'Clinic (', b.vin_name, ') east;England',
    CASE WHEN o_orderkey % 7 = 0 THEN '|Unknown|Viet Nam' ELSE '| ' END) AS new_locations,
  o_orderpriority AS vin_name, 'x' AS versionnumber
FROM orders JOIN raw_countries a ON a.row_id = o_orderkey % 25
  JOIN raw_countries b ON b.row_id = o_custkey % 25""",
    "raw_sources": """
SELECT doc_id AS row_id, concat('c', doc_id) AS _vin_regardingid_value, source AS vin_name,
  CASE WHEN lang = 'en' THEN concat('http://', doc_id) END AS vin_url, text AS vin_description
FROM documents""",
    "raw_target_country": """
SELECT concat('c', l_suppkey) AS entity_id, CAST(l_linenumber * 4 AS BIGINT) AS option_code
FROM lineitem""",
    "raw_age_specific": """
SELECT concat('c', l_partkey) AS entity_id, CAST(l_linenumber AS BIGINT) AS option_code
FROM lineitem""",
    "raw_approving_authority": """
SELECT concat('c', o_custkey) AS entity_id,
  CAST(909670000 + o_orderkey % 4 AS BIGINT) AS option_code
FROM orders""",
    "raw_candidate_priority": """
SELECT concat('c', l_suppkey) AS vin_candidateid, concat('r', l_partkey + 5) AS vin_rdpriorityid
FROM lineitem""",
    "raw_candidate_account": """
SELECT concat('c', l_partkey) AS vin_candidateid, concat('a', l_suppkey + 3) AS accountid
FROM lineitem""",
    "raw_trial_country": """
SELECT concat('t', o_orderkey) AS vin_clinicaltrialid, concat('k', o_custkey % 30) AS vin_countryid
FROM orders""",
    "raw_options_area": """
SELECT CAST(n_nationkey AS BIGINT) AS code,
  CASE WHEN n_nationkey % 5 = 0 THEN 'Sexual & reproductive health'
    ELSE concat('Area ', n_nationkey) END AS label, 'x' AS first_seen
FROM nation""",
    "raw_options_code": """
SELECT CAST(909670000 + n_nationkey AS BIGINT) AS code, concat('Label ', n_nationkey) AS label,
  'x' AS first_seen
FROM nation""",
    "raw_options_small": """
SELECT CAST(n_nationkey AS BIGINT) AS code, concat('Small ', n_nationkey % 2) AS label,
  'x' AS first_seen
FROM nation""",
    "raw_options_hundred": """
SELECT CAST(100000000 + n_nationkey AS BIGINT) AS code, concat('Hundred ', n_nationkey) AS label,
  'x' AS first_seen
FROM nation""",
    "raw_options_country": f"""
SELECT CAST(n_nationkey AS BIGINT) AS code, {COUNTRY} AS label, 'x' AS first_seen
FROM nation""",
}


def with_inputs(sql: str) -> str:
    """Put the derived tables the text uses in front of it."""
    used: list[str] = []

    def add(text: str) -> None:
        for name in RAW:
            if name not in used and re.search(rf"\b{name}\b", text):
                add(RAW[name])
                used.append(name)

    add(sql)
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({RAW[name].strip()})" for name in used)
    if sql.startswith("WITH "):
        return f"WITH {ctes},\n{sql.removeprefix('WITH ')}"
    return f"WITH {ctes}\n{sql}"


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a text over the given tables and the derived ones."""
    text = with_inputs(sql.strip())
    for name in BASE_TABLES:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            base(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return derive(spark, sf_dir, f"SELECT * FROM {name}")
