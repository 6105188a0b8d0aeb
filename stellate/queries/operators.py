"""Queries for single operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.config import countries
from stellate.functions import classify, codes, text
from stellate.operators import cleanup, contract, dimensions, keys, lookups, quality, temporal
from stellate.operators.quality import ForeignKey
from stellate.operators.temporal import YearlyGroup
from stellate.plans import silver
from stellate.queries.inputs import BASE_TABLES, STAGE_TEXT, base, derive, raw
from stellate.queries.registry import query
from stellate.sources import layers

WS = text.WHITESPACE


def sql_strip(e: str) -> str:
    return f"trim({e}, '{WS}')"


def sql_normalize(e: str) -> str:
    plain = f"replace(replace({e}, '<br>', ' '), '<BR>', ' ')"
    return f"nullif(trim(regexp_replace({plain}, '[{WS}]+', ' ', 'g')), '')"


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def sql_map(e: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(
        f"WHEN {sql_text(k) if isinstance(k, str) else k} THEN "
        f"{sql_text(v) if isinstance(v, str) or v is None else v}"
        for k, v in mapping.items()
    )
    return f"(CASE {e} {whens} ELSE {default} END)"


# --- sources -----------------------------------------------------------------------------------


@query("SELECT * FROM orders")
def scan_table(spark, sf_dir):
    return layers.Layer(spark, sf_dir).read("orders")


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def scan_projected(spark, sf_dir):
    return layers.Layer(spark, sf_dir).read("lineitem", ["l_orderkey", "l_quantity"])


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def scan_distinct(spark, sf_dir):
    return layers.distinct_values(
        base(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"]
    )


@query("""
SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS highest FROM orders
WHERE o_totalprice > 1000 GROUP BY o_orderstatus""")
def sql_query(spark, sf_dir):
    return layers.query(
        spark,
        """SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS highest
        FROM {orders} WHERE o_totalprice > :floor GROUP BY o_orderstatus""",
        args={"floor": 1000},
        orders=base(spark, sf_dir, "orders"),
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in BASE_TABLES
    )
)
def row_counts(spark, sf_dir):
    return layers.row_counts({t: base(spark, sf_dir, t) for t in BASE_TABLES})


# --- columns -----------------------------------------------------------------------------------


@query("SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def drop_columns(spark, sf_dir):
    return cleanup.drop_columns(base(spark, sf_dir, "lineitem"), ["l_tax", "l_discount", "absent"])


@query("""
SELECT *, CAST(NULL AS VARCHAR) AS valid_to, CASE WHEN o_orderkey = 3 THEN 1 END AS rare
FROM orders""")
def drop_empty_columns(spark, sf_dir):
    df = derive(spark, sf_dir, """
    SELECT *, CAST(NULL AS STRING) AS valid_to, CASE WHEN o_orderkey = 3 THEN 1 END AS rare,
      CAST(NULL AS STRING) AS empty_text, CAST(NULL AS BIGINT) AS empty_number FROM orders""")
    return cleanup.drop_empty_columns(df, ["valid_to"])


@query("""
SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def rename_columns(spark, sf_dir):
    return cleanup.rename_columns(
        base(spark, sf_dir, "customer"),
        {"c_custkey": "customer_id", "c_name": "name", "absent": "other"},
    )


@query("""
SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal
FROM supplier""")
def rename_prefix(spark, sf_dir):
    return cleanup.strip_prefix(base(spark, sf_dir, "supplier"), "s_")


CODES_AS_TEXT = """
SELECT p_partkey, concat(p_size, CASE WHEN p_size % 7 = 0 THEN 'x' ELSE '' END) AS size_code,
  CAST(p_size AS DOUBLE) AS size_number FROM part"""


@query("""
SELECT p_partkey, CASE WHEN p_size % 7 > 0 THEN CAST(p_size AS BIGINT) END AS size_code,
  CAST(p_size AS BIGINT) AS size_number FROM part""")
def cast_codes(spark, sf_dir):
    df = derive(spark, sf_dir, CODES_AS_TEXT)
    return cleanup.cast_codes(df, ["size_code", "size_number", "absent"])


@query(f"""
SELECT doc_id, {sql_normalize("concat(' ', text, chr(9), '<br>')")} AS body,
  CASE lang WHEN 'en' THEN 'English' ELSE lang END AS lang, source, n_chars,
  CAST(NULL AS VARCHAR) AS valid_to FROM documents""")
def generic_cleanup(spark, sf_dir):
    df = derive(spark, sf_dir, """
    SELECT doc_id, concat(' ', text, chr(9), '<br>') AS text, lang, source, n_chars,
      CAST(NULL AS STRING) AS valid_to, CAST(NULL AS STRING) AS empty FROM documents""")
    return cleanup.clean_table(
        df, {"text": "body"}, {"lang": {"en": "English"}, "absent": {"a": "b"}}, ["body", "absent"]
    )


# --- values ------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'F' ELSE o_orderstatus END
  AS status, CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE o_orderpriority END AS priority
FROM orders""")
def replace_values(spark, sf_dir):
    return base(spark, sf_dir, "orders").select(
        "o_orderkey",
        codes.replace_values(F.col("o_orderstatus"), {"F": "O", "O": "F"}).alias("status"),
        codes.replace_values(F.col("o_orderpriority"), {"5-LOW": None}).alias("priority"),
    )


@query("""
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R'
  THEN 'returned' END AS flag_name FROM lineitem""")
def map_values_strict(spark, sf_dir):
    flags = {"A": "accepted", "R": "returned"}
    return base(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        codes.map_strict(F.col("l_returnflag"), flags).alias("flag_name"),
    )


@query("""
SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber WHEN 5 THEN 1 WHEN 6 THEN 2 WHEN 7 THEN 2
  ELSE l_linenumber END AS BIGINT) AS merged,
  CASE WHEN l_linenumber IN (5, 6) THEN CAST(l_linenumber - 4 AS STRING) WHEN l_linenumber = 7
    THEN '7.0' ELSE l_returnflag END AS merged_text FROM lineitem""")
def code_consolidate(spark, sf_dir):
    """Codes as numbers and as text; text without an entry stays as it is."""
    line = F.col("l_linenumber")
    text_code = F.when(line.isin(5, 6), line.cast("string")).when(line == 7, "7.0")
    text_code = text_code.otherwise(F.col("l_returnflag"))
    return base(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        codes.replace_codes(F.col("l_linenumber"), {5: 1, 6: 2, 7: 2}).alias("merged"),
        codes.replace_codes(text_code, {5: 1, 6: 2, 7: 2}, "string").alias("merged_text"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '5-LOW'
  ELSE o_orderpriority END AS priority FROM orders""")
def conditional_override(spark, sf_dir):
    finished = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return base(spark, sf_dir, "orders").select(
        "o_orderkey",
        codes.override_when(F.col("o_orderpriority"), finished, "5-LOW").alias("priority"),
    )


@query("""
SELECT o_orderkey, CASE WHEN NULLIF(o_orderstatus, 'P') IN ('F', 'X') THEN 1 ELSE 0 END AS flag
FROM orders""")
def membership_flag(spark, sf_dir):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return base(spark, sf_dir, "orders").select(
        "o_orderkey", codes.member_flag(status, ["F", "X"]).alias("flag")
    )


INCLUSION_MAPPED = """SELECT row_id,
    CAST(CASE vin_2019pcrpipelineinclusion WHEN 'Yes' THEN 100000000 WHEN 'No' THEN 100000001
      WHEN 'Pending' THEN 100000001 END AS BIGINT) AS y2019,
    new_includeinpipeline2021 AS y2021,
    CAST(CASE new_2023includeinevgendatabase WHEN 'Yes' THEN 100000000 WHEN 'No' THEN 100000001
      WHEN 'Pending' THEN 100000001 END AS BIGINT) AS y2023,
    CASE new_2024includeinpipeline WHEN 862890000 THEN 100000000
      ELSE new_2024includeinpipeline END AS y2024,
    new_includeinpipeline AS y2025
  FROM raw_candidates"""
SQL_INCLUSION = f"""mapped AS ({INCLUSION_MAPPED}),
inclusion AS (SELECT row_id, y2019, CASE WHEN y2019 = 100000000 AND y2021 = 100000001
  THEN 100000000 ELSE y2021 END AS y2021, y2023, y2024, y2025 FROM mapped)"""


@query(f"WITH {SQL_INCLUSION} SELECT * FROM inclusion")
def inclusion_normalize(spark, sf_dir):
    df = silver.normalize_inclusion(raw(spark, sf_dir, "raw_candidates"))
    return df.select(
        "row_id",
        F.col("vin_2019pcrpipelineinclusion").cast("bigint").alias("y2019"),
        F.col("new_includeinpipeline2021").alias("y2021"),
        F.col("new_2023includeinevgendatabase").cast("bigint").alias("y2023"),
        F.col("new_2024includeinpipeline").alias("y2024"),
        F.col("new_includeinpipeline").alias("y2025"),
    )


@query("SELECT row_id, vin_name FROM raw_candidates WHERE statecode = 0")
def filter_active(spark, sf_dir):
    return cleanup.keep_active(raw(spark, sf_dir, "raw_candidates")).select("row_id", "vin_name")


@query("""
SELECT NULLIF(c_custkey, 0) AS code, c_name AS label FROM customer
WHERE c_custkey NOT IN (3, 4)""")
def optionset_dedup(spark, sf_dir):
    options = derive(
        spark, sf_dir, "SELECT NULLIF(c_custkey, 0) AS code, c_name AS label FROM customer"
    )
    return cleanup.drop_codes(options, [3, 4])


@query("""
SELECT code, CASE label WHEN 'Sexual & reproductive health' THEN 'Womens Health' ELSE label END
  AS label, first_seen FROM raw_options_area""")
def optionset_relabel(spark, sf_dir):
    labels = {"Sexual & reproductive health": "Womens Health"}
    return cleanup.relabel(raw(spark, sf_dir, "raw_options_area"), labels)


# --- text --------------------------------------------------------------------------------------

MESSY = "concat(chr(160), text, chr(9), '<br>', chr(28), lang, '<BR>', '<br/>', chr(8195))"


@query(f"""
SELECT doc_id AS id, 'document' AS kind, {sql_normalize(MESSY)} AS value FROM documents
UNION ALL SELECT page_id, 'page', {sql_normalize("html")} FROM pages""")
def normalize_whitespace(spark, sf_dir):
    df = derive(spark, sf_dir, f"""
    SELECT doc_id AS id, 'document' AS kind, {MESSY.replace("chr(8195)", "'" + chr(8195) + "'")}
      AS value FROM documents
    UNION ALL SELECT page_id, 'page', html FROM pages""")
    return df.withColumn("value", text.normalize_whitespace(F.col("value")))


@query(f"""
SELECT page_id, {sql_normalize("url")} AS url, {sql_normalize("html")} AS html FROM pages""")
def normalize_all_text(spark, sf_dir):
    return cleanup.normalize_text(base(spark, sf_dir, "pages"))


SUFFIXED = """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN concat(p_brand, ' - ', p_type)
  WHEN 1 THEN concat(p_brand, ' - ', p_type, ' - ', p_name) ELSE p_name END AS value FROM part"""


@query(f"""
WITH suffixed AS ({SUFFIXED}), parts AS (SELECT *, string_split(value, ' - ') AS p FROM suffixed)
SELECT p_partkey, p[1] AS head,
  CASE WHEN len(p) > 1 THEN array_to_string(p[1:len(p) - 1], ' - ') ELSE value END AS body
FROM parts""")
def strip_suffix(spark, sf_dir):
    value = F.col("value")
    return derive(spark, sf_dir, SUFFIXED).select(
        "p_partkey", text.before_first(value).alias("head"), text.before_last(value).alias("body")
    )


STAGED = f"SELECT o_orderkey, {STAGE_TEXT} AS stage, o_orderstatus FROM orders"


@query(f"""
WITH staged AS ({STAGED})
SELECT o_orderkey, CASE stage WHEN 'Preclinical - Drugs' THEN 'Discovery & Preclinical'
  WHEN 'Phase I/II' THEN 'Phase II' WHEN 'Phase III - Vaccines' THEN 'Phase III'
  WHEN 'Unclear - Drugs' THEN 'Unclear' ELSE 'Approved' END AS stage FROM staged""")
def stage_standardize(spark, sf_dir):
    return derive(spark, sf_dir, STAGED).select(
        "o_orderkey", silver.standardize_stage(F.col("stage")).alias("stage")
    )


@query(f"""
SELECT row_id, {sql_strip("new_diseasefilter")} AS disease_filter,
  nullif(nullif({sql_strip("new_secondary_diseae_choice_text")}, ''), 'No secondary disease')
    AS secondary_disease_name
FROM raw_diseases""")
def disease_filter_clean(spark, sf_dir):
    secondary = text.strip(F.col("new_secondary_diseae_choice_text"))
    return raw(spark, sf_dir, "raw_diseases").select(
        "row_id",
        text.strip(F.col("new_diseasefilter")).alias("disease_filter"),
        text.sentinel_to_null(secondary, ["", "No secondary disease"]).alias(
            "secondary_disease_name"
        ),
    )


NESTED = """
SELECT p_partkey, concat(p_brand, ' - ', p_type, CASE WHEN p_size % 2 = 0 THEN ' - x' ELSE '' END)
  AS value, CASE p_size % 3 WHEN 0 THEN p_type WHEN 1 THEN concat(p_type, ' - x') END AS child
FROM part"""


@query(f"""
WITH nested AS ({NESTED})
SELECT p_partkey, CASE WHEN child = substr(value, strpos(value, ' - ') + 3)
  THEN split_part(value, ' - ', 1) ELSE value END AS value FROM nested""")
def parent_collapse(spark, sf_dir):
    return derive(spark, sf_dir, NESTED).select(
        "p_partkey", text.collapse_to_parent(F.col("value"), F.col("child")).alias("value")
    )


NUMBERS = """
SELECT l_orderkey, l_linenumber, CASE l_partkey % 8 WHEN 0 THEN concat(' ', l_partkey, ' ')
  WHEN 1 THEN concat('-', l_partkey, '.') WHEN 2 THEN concat(l_partkey, '.', l_suppkey)
  WHEN 3 THEN concat(l_partkey, '-', l_suppkey) WHEN 4 THEN concat(l_linenumber, 'e3')
  WHEN 5 THEN concat('.', l_suppkey) WHEN 6 THEN l_returnflag END AS value
FROM lineitem"""


@query(f"""
WITH numbers AS ({NUMBERS})
SELECT l_orderkey, l_linenumber, CASE WHEN TRY_CAST(trim(value) AS DOUBLE) IS NULL
  OR NOT regexp_full_match(trim(value), '[-.0-9]*') THEN value END AS value FROM numbers""")
def numeric_text_null(spark, sf_dir):
    return derive(spark, sf_dir, NUMBERS).select(
        "l_orderkey", "l_linenumber", text.numeric_text_to_null(F.col("value")).alias("value")
    )


LINKS = """
SELECT o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN concat(' http://x/', o_orderkey, ' ')
  WHEN 1 THEN concat('ISRCTN1', chr(10), ' nct', o_orderkey, ' ', chr(10), 'NCT2')
  WHEN 2 THEN concat('NCT', o_orderkey) WHEN 3 THEN o_orderpriority WHEN 4 THEN ' ' END AS link
FROM orders"""


@query(f"""
WITH links AS ({LINKS}),
  tokens AS (SELECT o_orderkey, {sql_strip("link")} AS link,
    list_filter(list_transform(string_split({sql_strip("link")}, chr(10)),
      lambda t: {sql_strip("t")}), lambda t: upper(t) LIKE 'NCT%') AS found FROM links)
SELECT o_orderkey, CASE WHEN link LIKE 'http%' THEN link
  WHEN len(found) > 0 THEN 'https://clinicaltrials.gov/study/' || found[1] END AS link
FROM tokens""")
def registry_link(spark, sf_dir):
    return derive(spark, sf_dir, LINKS).select(
        "o_orderkey", text.registry_link(F.col("link")).alias("link")
    )


# --- classifiers -------------------------------------------------------------------------------


def sql_phase(e: str) -> str:
    v = f"replace({sql_strip(f'upper({e})')}, chr(10), ' ')"

    def has(*terms: str) -> str:
        return "(" + " OR ".join(f"contains({v}, '{t}')" for t in terms) + ")"

    return f"""CASE WHEN {e} IS NULL THEN 'Unknown'
  WHEN {v} IN ('N/A', 'NOT APPLICABLE', 'PHASE N/A', 'PHASE: N/A', 'NA', '0', 'PHASE 0') THEN 'N/A'
  WHEN {v} IN ('UNKNOWN', 'PHASE UNSPECIFIED', 'OTHER', 'NOT SELECTED') THEN 'Unknown'
  WHEN {has('III/IV', '3/4')} THEN 'Phase III/IV'
  WHEN {has('II/III', '2/3', 'PHASE2|PHASE3')} THEN 'Phase II/III'
  WHEN {has('I/II', '1/2', '1 AND 2', 'PHASE1|PHASE2')} OR {v} = '12' THEN 'Phase I/II'
  WHEN {has('OBSERVATIONAL')} THEN 'Observational'
  WHEN {has('INTERVENTIONAL')} THEN 'Interventional'
  WHEN {has('RETROSPECTIVE')} THEN 'Retrospective' WHEN {has('CHIM')} THEN 'CHIM'
  WHEN {has('PHASE 4', 'PHASE IV', 'POST-MARKET', 'POST MARKETING')} OR {v} IN ('IV', '4')
    THEN 'Phase IV'
  WHEN {has('PHASE 3', 'PHASE III', 'PHASE3')} OR {v} IN ('III', '3') THEN 'Phase III'
  WHEN {has('PHASE 2', 'PHASE II', 'PHASR II', 'PHASE2')} OR {v} IN ('II', '2') THEN 'Phase II'
  WHEN {has('PHASE 1', 'PHASE I', 'EARLY_PHASE1', 'PHASE1')} OR {v} IN ('I', '1') THEN 'Phase I'
  ELSE 'Unknown' END"""


def sql_age(e: str) -> str:
    v = sql_strip(f"replace(replace(upper({e}), chr(160), ' '), chr(194), ' ')")

    def has(*terms: str) -> str:
        return "(" + " OR ".join(f"contains({v}, '{t}')" for t in terms) + ")"

    return f"""CASE WHEN {e} IS NULL THEN 'Unknown'
  WHEN {has('OLDER ADULT', 'OLDER_ADULT', '(OLDER)', '65', '64', '60', '55', '50', '49', '48',
            'YEARS AND OLDER', 'YEARS AND OVER')} THEN 'Older adults: 45 >'
  WHEN {has('ADULT', '18', '20', '25')} THEN 'Young Adults 18 - 45'
  WHEN {has('ADOLESCENT', '14', '15', '16', '17')} THEN 'Adolescents'
  WHEN {has('CHILD')} THEN 'Children' WHEN {has('INFANT', '18 MONTHS')} THEN 'Infants'
  WHEN {has('NEONATE')} THEN 'Neonates' ELSE 'Unknown' END"""


def sql_sex(e: str) -> str:
    v = sql_strip(f"replace(upper({e}), '<BR>', ' ')")
    return f"""CASE WHEN {e} IS NULL THEN 'Unknown'
  WHEN contains({v}, 'BOTH') OR contains({v}, 'ALL') OR contains({v}, 'AND FEMALE')
    OR contains({v}, 'AND MALE') THEN 'Both'
  WHEN contains({v}, 'FEMALE: YES') AND contains({v}, 'MALE: NO') THEN 'Female'
  WHEN contains({v}, 'MALE: YES') AND contains({v}, 'FEMALE: NO') THEN 'Male'
  WHEN contains({v}, 'FEMALE: YES') AND contains(
    substr({v}, strpos({v}, 'FEMALE: YES') + 11), 'MALE: YES') THEN 'Both'
  WHEN {v} IN ('F', 'FEMALE', 'FEMALES') THEN 'Female'
  WHEN {v} IN ('M', 'MALE', 'MALES') THEN 'Male' ELSE 'Unknown' END"""


def sql_study_type(e: str) -> str:
    v = sql_strip(f"upper({e})")
    return f"""CASE WHEN {v} IN ('INTERVENTIONAL', 'INTERVENTIONAL STUDY', 'INTERVENTION',
    'INTERVENTIONAL CLINICAL TRIAL OF MEDICINAL PRODUCT') THEN 'Interventional'
  WHEN {v} IN ('OBSERVATIONAL', 'OBSERVATIONAL STUDY', 'OBSERVATIONAL NON INVASIVE')
    THEN 'Observational' ELSE {e} END"""


TRIAL_TEXT = """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE l_linenumber WHEN 1 THEN concat('Phase ', l_suppkey % 6)
    WHEN 2 THEN concat(' phase', l_suppkey % 4, '|Phase', l_suppkey % 4 + 1)
    WHEN 3 THEN concat(l_suppkey % 5, '/', l_suppkey % 5 + 1)
    WHEN 4 THEN CASE l_suppkey % 5 WHEN 0 THEN 'I/II' WHEN 1 THEN concat('Phase', chr(10), 'IV')
      WHEN 2 THEN 'PHASR II' WHEN 3 THEN 'post-marketing' ELSE 'III/IV' END
    WHEN 5 THEN concat(l_suppkey % 14, '')
    WHEN 6 THEN CASE l_suppkey % 4 WHEN 0 THEN 'Interventional I' WHEN 1 THEN 'chim study'
      WHEN 2 THEN 'Phase: n/a' ELSE 'iii' END END AS phase,
  CASE l_returnflag WHEN 'A' THEN concat(l_partkey % 70, ' Years and ',
      CASE WHEN l_suppkey % 2 = 0 THEN 'older' ELSE 'younger' END)
    WHEN 'N' THEN concat(l_partkey % 70, chr(160), 'months') ELSE
    CASE l_suppkey % 6 WHEN 0 THEN 'Child, Adult' WHEN 1 THEN ' neonate' WHEN 2 THEN 'infants'
      WHEN 3 THEN 'children' WHEN 4 THEN 'Adolescent' END END AS age,
  CASE l_suppkey % 12 WHEN 0 THEN 'Female: yes<br>Male: yes' WHEN 1 THEN 'Male: Yes Female: Yes'
    WHEN 2 THEN 'Female: Yes, Male: No' WHEN 3 THEN 'Male: Yes Female: No' WHEN 4 THEN ' f '
    WHEN 5 THEN 'Males' WHEN 6 THEN 'Men and women' WHEN 7 THEN 'Male and Female' WHEN 8
    THEN 'all' WHEN 9 THEN 'None' WHEN 10 THEN l_linestatus END AS sex,
  CASE l_suppkey % 5 WHEN 0 THEN ' Interventional study ' WHEN 1 THEN 'observational' WHEN 2
    THEN 'Intervention' WHEN 3 THEN l_returnflag END AS study
FROM lineitem"""


def _classified(expression: str) -> str:
    return f"""WITH trial_text AS ({TRIAL_TEXT})
SELECT l_orderkey, l_linenumber, l_partkey, {expression} AS label FROM trial_text"""


def _classify(spark, sf_dir, column, classifier):
    df = classify.apply(derive(spark, sf_dir, TRIAL_TEXT), {column: classifier})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.col(column).alias("label"))


@query(_classified(sql_phase("phase")))
def classify_phase(spark, sf_dir):
    return _classify(spark, sf_dir, "phase", classify.phase)


@query(_classified(sql_age("age")))
def classify_age(spark, sf_dir):
    return _classify(spark, sf_dir, "age", classify.age_group)


@query(_classified(sql_sex("sex")))
def classify_gender(spark, sf_dir):
    return _classify(spark, sf_dir, "sex", classify.sex)


@query(_classified(sql_study_type("study")))
def classify_study_type(spark, sf_dir):
    return _classify(spark, sf_dir, "study", classify.study_type)


# --- lookups -----------------------------------------------------------------------------------


@query("""
SELECT row_id, CASE l.vin_name WHEN 'Phase IV - Drugs' THEN 'Phase IV'
  WHEN 'Clinical evaluation - Diagnostics' THEN 'Clinical evaluation'
  WHEN 'Phase II - Vaccines' THEN 'Phase II' WHEN 'Development - part - Drugs'
  THEN 'Development - part' END AS stage
FROM raw_candidates LEFT JOIN raw_rdstageproducts l
  ON vin_rdstageproductid = _vin_currentrndstage_value""")
def lookup_stage(spark, sf_dir):
    return lookups.lookup_name(
        raw(spark, sf_dir, "raw_candidates"),
        F.col("_vin_currentrndstage_value"),
        raw(spark, sf_dir, "raw_rdstageproducts"),
        "vin_rdstageproductid",
        text.before_last(F.col("vin_name")),
        "stage",
    ).select("row_id", "stage")


@query("""
SELECT d.row_id, d.vin_developerid, name AS org_name, address1_country AS country
FROM raw_developers d LEFT JOIN raw_accounts ON accountid = _vin_developer_value""")
def left_enrich(spark, sf_dir):
    return lookups.left_enrich(
        raw(spark, sf_dir, "raw_developers"),
        F.col("_vin_developer_value"),
        raw(spark, sf_dir, "raw_accounts"),
        "accountid",
        {"name": "org_name", "address1_country": "country"},
    ).select("row_id", "vin_developerid", "org_name", "country")


CODED = """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat(' ', o_custkey % 30)
  WHEN 1 THEN concat(o_custkey % 30, '.0') ELSE concat(o_custkey % 30, '') END AS text_code,
  CAST(o_custkey % 60 AS DOUBLE) / 2 AS number_code FROM orders"""


@query(f"""
WITH coded AS ({CODED})
SELECT o_orderkey, a.label AS text_label, b.label AS number_label FROM coded
LEFT JOIN raw_options_area a ON a.code = TRY_CAST(
  CASE WHEN contains(text_code, '.') THEN NULL ELSE text_code END AS BIGINT)
LEFT JOIN raw_options_area b ON b.code = number_code""")
def optionset_label(spark, sf_dir):
    options = raw(spark, sf_dir, "raw_options_area")
    df = derive(spark, sf_dir, CODED)
    df = lookups.option_label(df, "text_code", options, "text_label")
    df = lookups.option_label(df, "number_code", options, "number_label")
    return df.select("o_orderkey", "text_label", "number_label")


# Official names with commas, "and", accents and "Saint", short names, and names of no country.
ISO = {
    "Turkey": "TUR",
    "United Kingdom": "GBR",
    "United States of America": "USA",
    "South Korea": "KOR",
    "France": "FRA",
    "Kosovo": "XKX",
    "Bosnia and Herzegovina": "BIH",
    "Trinidad and Tobago": "TTO",
    "Antigua and Barbuda": "ATG",
    "Saint Lucia": "LCA",
    "Saint Vincent and the Grenadines": "VCT",
    "Saint Kitts & Nevis": "KNA",
    "Myanmar": "MMR",
    "Hong Kong": "HKG",
    "Congo": "COG",
    "Congo, The Democratic Republic of the": "COD",
    "Viet Nam": "VNM",
    "Vietnam": "VNM",
    "Cabo Verde": "CPV",
    "Korea, Republic of": "KOR",
    "Türkiye": "TUR",
    "Syrian Arab Republic": "SYR",
    "Côte d'Ivoire": "CIV",
    "Cote D`Ivoire (Ivory Coast)": "CIV",
    "Åland Islands": "ALA",
    "Curaçao": "CUW",
    "Réunion": "REU",
    "Tanzania, United Republic of": "TZA",
    "Venezuela, Bolivarian Republic of": "VEN",
    "Micronesia, Federated States of": "FSM",
    "Bonaire, Sint Eustatius and Saba": "BES",
    "European Union": None,
    "Atlantis": None,
}
# Every customer has one of these names, or the name of a nation.
COUNTRY_OF_CUSTOMER = f"""
SELECT c_custkey, CASE c_custkey % {len(ISO) + 1} {" ".join(
    f"WHEN {i} THEN {sql_text(name)}" for i, name in enumerate(ISO))}
  ELSE vin_name END AS country FROM customer JOIN raw_countries ON row_id = c_nationkey"""


@query(f"SELECT c_custkey, country, {sql_map('country', ISO)} AS iso_code "
       f"FROM ({COUNTRY_OF_CUSTOMER.strip()}) AS c")
def iso_code(spark, sf_dir):
    df = derive(spark, sf_dir, COUNTRY_OF_CUSTOMER)
    return lookups.iso_code(df, F.col("country"), "iso_code")


def sql_country(e: str) -> str:
    """Scalar subqueries over ``raw_countries`` for one raw text."""
    raw_text = f"nullif({sql_strip(e)}, '')"
    aliased = sql_map(raw_text, countries.ALIASES, raw_text)
    return f"""CASE WHEN {aliased} IS NOT NULL THEN coalesce(
    (SELECT max(n.vin_name) FROM raw_countries n WHERE lower(n.vin_name) = lower({aliased})),
    (SELECT max(n.vin_name) FROM raw_countries n
     WHERE n.vin_countryno = CAST(trunc(TRY_CAST({raw_text} AS DOUBLE)) AS BIGINT))) END"""


@query(f"SELECT row_id, {sql_country('address1_country')} AS country_name FROM raw_accounts")
def resolve_country(spark, sf_dir):
    df = lookups.resolve_country(
        raw(spark, sf_dir, "raw_accounts"),
        F.col("address1_country"),
        raw(spark, sf_dir, "raw_countries"),
        "country_name",
    )
    return df.select("row_id", "country_name")


# --- keys --------------------------------------------------------------------------------------

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


@query(f"""
SELECT row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS line_key, l_orderkey, l_linenumber,
  l_partkey, l_suppkey, l_shipdate FROM lineitem""")
def surrogate_key(spark, sf_dir):
    df = base(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    return keys.surrogate_key(df, "line_key", LINE_ORDER)


@query("""
SELECT row_number() OVER (ORDER BY source, lang, doc_id) AS document_key, doc_id, text, lang, source,
  n_chars FROM documents""")
def surrogate_key_in_place(spark, sf_dir):
    """Keys of the documents; the texts stay where they are stored."""
    return keys.surrogate_key_in_place(base(spark, sf_dir, "documents"), "document_key", ["source", "lang", "doc_id"])


@query("""
SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders
GROUP BY o_custkey""")
def last_per_key(spark, sf_dir):
    return keys.last_per_key(
        base(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey"
    )


@query("""
WITH dim AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey,
    NULLIF(c_nationkey, 3) AS c_nationkey FROM customer),
  by_nation AS (SELECT c_nationkey, max(customer_key) AS k FROM dim GROUP BY c_nationkey)
SELECT o_orderkey, d.customer_key, n.k AS nation_customer_key FROM orders
LEFT JOIN dim d ON d.c_custkey = CASE WHEN o_orderkey % 3 > 0 THEN o_custkey + 5 END
LEFT JOIN by_nation n ON n.c_nationkey = o_orderkey % 30""")
def fk_resolve(spark, sf_dir):
    customers = derive(
        spark, sf_dir, "SELECT c_custkey, NULLIF(c_nationkey, 3) AS c_nationkey FROM customer"
    )
    dim = keys.surrogate_key(customers, "customer_key", ["c_custkey"])
    orders = base(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    source = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey") + 5)
    df = keys.fk_resolve(orders, source, dim, "c_custkey", "customer_key", "customer_key")
    nation = F.col("o_orderkey") % 30
    df = keys.fk_resolve(
        df, nation, dim, "c_nationkey", "customer_key", "nation_customer_key"
    )
    return df.drop("o_custkey")


FLAGS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, NULLIF(l_returnflag, 'N') AS flag,
  NULLIF(l_linestatus, 'O') AS status FROM lineitem"""


@query(f"""
WITH flags AS ({FLAGS}), dim AS (SELECT row_number() OVER
    (ORDER BY flag NULLS FIRST, status NULLS FIRST) AS flag_key, flag, status
  FROM (SELECT DISTINCT flag, status FROM flags) AS d)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, flag_key FROM flags f JOIN dim d
  ON f.flag IS NOT DISTINCT FROM d.flag AND f.status IS NOT DISTINCT FROM d.status""")
def fk_composite(spark, sf_dir):
    lines = derive(spark, sf_dir, FLAGS)
    combinations = dimensions.distinct_rows(lines, ["flag", "status"])
    dim = keys.surrogate_key(combinations, "flag_key", ["flag", "status"])
    sources = {"flag": F.col("flag"), "status": F.col("status")}
    return keys.fk_composite(lines, sources, dim, "flag_key", "flag_key").drop("flag", "status")


ORDER_FACT = """
SELECT o_orderkey, NULLIF(o_custkey, 7) AS customer_key, NULLIF(o_orderkey % 5, 2) AS disease_key,
  o_orderkey % 11 AS product_key FROM orders"""


@query(f"""
WITH fact AS ({ORDER_FACT}), last AS (SELECT * FROM fact QUALIFY
  row_number() OVER (PARTITION BY customer_key ORDER BY o_orderkey DESC) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, disease_key, product_key FROM lineitem
LEFT JOIN last ON customer_key = NULLIF(l_partkey, 5)""")
def fk_via_fact(spark, sf_dir):
    lines = base(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.nullif(F.col("l_partkey"), F.lit(5)).alias("customer_key"),
    )
    fact = derive(spark, sf_dir, ORDER_FACT)
    df = keys.fk_via_fact(
        lines, fact, "customer_key", ["disease_key", "product_key"], "o_orderkey"
    )
    return df.drop("customer_key")


def order_dates(spark, sf_dir):
    """Date dimension of all years with an order, with its key."""
    years = base(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))
    )
    first, last = years.first()
    days = temporal.date_dimension(spark, first, last)
    return keys.surrogate_key(days, "date_key", ["full_date"], bounded=True)


SQL_DATES = """dates AS (
  SELECT row_number() OVER (ORDER BY d) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
    year(d) AS year, quarter(d) AS quarter
  FROM (SELECT unnest(generate_series(
    (SELECT make_date(min(year(o_orderdate)), 1, 1) FROM orders)::TIMESTAMP,
    (SELECT make_date(max(year(o_orderdate)), 12, 31) FROM orders)::TIMESTAMP,
    INTERVAL 1 DAY)) AS d) AS days)"""


@query(f"WITH {SQL_DATES} SELECT * FROM dates")
def dim_date(spark, sf_dir):
    return order_dates(spark, sf_dir)


RUN_DATE = "1998-07-01"


@query(f"""
WITH {SQL_DATES}
SELECT o_orderkey, (SELECT date_key FROM dates WHERE full_date = '{RUN_DATE}') AS today_key,
  (SELECT date_key FROM dates d WHERE full_date = strftime(o_orderdate, '%Y-%m-%d')) AS date_key
FROM orders""")
def fk_today(spark, sf_dir):
    dates = order_dates(spark, sf_dir)
    orders = base(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    df = keys.fk_today(orders, RUN_DATE, dates, "full_date", "date_key", "today_key")
    day = F.col("o_orderdate").cast("date").cast("string")
    df = keys.fk_resolve(df, day, dates, "full_date", "date_key", "date_key")
    return df.select("o_orderkey", "today_key", "date_key")


# --- histories ---------------------------------------------------------------------------------

SQL_YEARLY = """yearly AS (
  SELECT row_id, '2019-01-01' AS d, vin_2019stagepcr AS stage, vin_2019pcrpipelineinclusion AS answer
    FROM raw_candidates
  UNION ALL SELECT row_id, '2021-01-01', new_rdstage2021, NULL FROM raw_candidates
  UNION ALL SELECT row_id, '2023-01-01', new_2023currentrdstage, new_2023includeinevgendatabase
    FROM raw_candidates
  UNION ALL SELECT row_id, '2024-01-01', new_2024currentrdstage, NULL FROM raw_candidates),
known AS (SELECT * FROM yearly WHERE stage IS NOT NULL OR answer IS NOT NULL),
slices AS (SELECT row_id, d AS valid_from, last_value(stage IGNORE NULLS) OVER w AS stage,
    last_value(answer IGNORE NULLS) OVER w AS answer,
    lead(d) OVER (PARTITION BY row_id ORDER BY d) AS valid_to
  FROM known WINDOW w AS (PARTITION BY row_id ORDER BY d ROWS UNBOUNDED PRECEDING))"""


@query(f"""
WITH {SQL_YEARLY}
SELECT r.row_id, stage, answer, valid_from, valid_to FROM raw_candidates r
LEFT JOIN slices s ON s.row_id = r.row_id""")
def scd2_expand(spark, sf_dir):
    stage = {
        "vin_2019stagepcr": "2019-01-01",
        "new_rdstage2021": "2021-01-01",
        "new_2023currentrdstage": "2023-01-01",
        "new_2024currentrdstage": "2024-01-01",
        "absent": "2025-01-01",
    }
    answer = {
        "vin_2019pcrpipelineinclusion": "2019-01-01",
        "new_2023includeinevgendatabase": "2023-01-01",
    }
    groups = [YearlyGroup("stage", stage), YearlyGroup("answer", answer)]
    df = temporal.scd2_expand(raw(spark, sf_dir, "raw_candidates"), groups)
    return df.select("row_id", "stage", "answer", "valid_from", "valid_to")


PURCHASES = """
SELECT event_id, user_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type = 'click' THEN event_id END AS click FROM events"""


@query(f"""
WITH purchases AS ({PURCHASES})
SELECT event_id, user_id, event_type, last_value(amount IGNORE NULLS) OVER w AS amount,
  last_value(click IGNORE NULLS) OVER w AS click FROM purchases
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def forward_fill(spark, sf_dir):
    # Events are numbered in time order; a thousand of them are one chunk.
    return temporal.forward_fill(
        derive(spark, sf_dir, PURCHASES),
        ["user_id"],
        "event_id",
        ["amount", "click"],
        chunk=F.floor(F.col("event_id") / 1000),
    )


@query(f"""
WITH purchases AS ({PURCHASES})
SELECT event_id, user_id, event_type, last_value(amount IGNORE NULLS) OVER w AS amount,
  last_value(click IGNORE NULLS) OVER w AS click FROM purchases
WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def forward_fill_history(spark, sf_dir):
    """The same without a chunk: rows are ranged by user and event."""
    events = derive(spark, sf_dir, PURCHASES)
    return temporal.forward_fill(events, ["user_id"], "event_id", ["amount", "click"])


@query(f"""
WITH purchases AS ({PURCHASES})
SELECT event_id, user_id, event_type, last_value(amount IGNORE NULLS) OVER w AS amount,
  last_value(click IGNORE NULLS) OVER w AS click FROM purchases
WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def forward_fill_one_history(spark, sf_dir):
    """All events are one history: the longest that there can be."""
    return temporal.forward_fill(derive(spark, sf_dir, PURCHASES), [], "event_id", ["amount", "click"])


ORDER_DAYS = "SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS valid_from FROM orders"


@query(f"""
SELECT o_custkey, CAST(valid_from AS STRING) AS valid_from,
  CAST(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS STRING) AS valid_to
FROM ({ORDER_DAYS}) AS d""")
def scd2_lead(spark, sf_dir):
    days = derive(spark, sf_dir, ORDER_DAYS)
    df = temporal.next_boundary(
        days, ["o_custkey"], "valid_from", "valid_to", chunk=F.year("valid_from")
    )
    return df.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query(f"""
SELECT o_custkey, CAST(valid_from AS STRING) AS valid_from,
  CAST(lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS STRING) AS valid_to
FROM ({ORDER_DAYS}) AS d""")
def scd2_lead_history(spark, sf_dir):
    """The same without a chunk: every partition hands its first row to the one before."""
    df = temporal.next_boundary(derive(spark, sf_dir, ORDER_DAYS), ["o_custkey"], "valid_from", "valid_to")
    return df.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query("""
SELECT event_id, lead(event_id) OVER (ORDER BY event_id) AS next_event FROM events""")
def lead_one_history(spark, sf_dir):
    """The following event of every event: one history over all partitions."""
    return temporal.next_boundary(base(spark, sf_dir, "events").select("event_id"), [], "event_id", "next_event")


# Years in which a customer placed an order of one priority: most of them leave gaps to fill.
ORDER_SPANS = """
SELECT DISTINCT o_custkey, o_orderpriority, CASE WHEN o_orderkey % 40 = 0 THEN 'n/a'
  ELSE concat(year(o_orderdate), '-01-01') END AS valid_from FROM orders"""


@query(f"""
WITH starts AS ({ORDER_SPANS}),
spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey, o_orderpriority
    ORDER BY valid_from) AS valid_to FROM starts),
ends AS (SELECT *, TRY_CAST(substr(valid_from, 1, 4) AS INTEGER) AS y1,
    TRY_CAST(substr(valid_to, 1, 4) AS INTEGER) AS y2 FROM spans),
years AS (SELECT DISTINCT y FROM (SELECT y1 AS y FROM ends UNION ALL SELECT y2 FROM ends) AS a
  WHERE y IS NOT NULL),
copies AS (SELECT e.*, y, max(y) OVER (PARTITION BY o_custkey, o_orderpriority, valid_from) AS last_y
  FROM ends e JOIN years ON y > y1 AND y < coalesce(y2, (SELECT max(y) FROM years) + 1))
SELECT o_custkey, o_orderpriority, valid_from, valid_to, CAST(NULL AS INTEGER) AS infill_year,
  CASE WHEN valid_to IS NULL AND NOT EXISTS (SELECT 1 FROM copies c
    WHERE c.o_custkey = e.o_custkey AND c.o_orderpriority = e.o_orderpriority
      AND c.valid_from = e.valid_from) THEN 1 ELSE 0 END AS is_active_flag
FROM ends e
UNION ALL
SELECT o_custkey, o_orderpriority, valid_from, valid_to, y,
  CASE WHEN valid_to IS NULL AND y = last_y THEN 1 ELSE 0 END FROM copies""")
def year_infill(spark, sf_dir):
    starts = derive(spark, sf_dir, ORDER_SPANS)
    spans = temporal.next_boundary(
        starts, ["o_custkey", "o_orderpriority"], "valid_from", "valid_to"
    )
    spans = spans.withColumn("is_active_flag", codes.is_null_flag(F.col("valid_to")))
    return temporal.year_infill(spans)


@query(f"""
WITH staged AS ({STAGED})
SELECT DISTINCT split_part(stage, ' - ', 1) AS phase_name FROM staged""")
def referenced_values(spark, sf_dir):
    return dimensions.referenced_values(derive(spark, sf_dir, STAGED), "stage", "phase_name")


# --- quality and contract ----------------------------------------------------------------------

SHIFTED = "SELECT o_orderkey, NULLIF(o_custkey, 9) + 40 AS o_custkey FROM orders"


@query(f"""
WITH shifted AS ({SHIFTED})
SELECT 'orders' AS child, 'o_custkey' AS fk_column, 'customer' AS parent, count(*) AS orphans
  FROM shifted WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem', 'l_partkey', 'part', count(*) FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem', 'l_suppkey', 'part', count(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem', 'l_orderkey', 'customer', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT c_custkey FROM customer)""")
def fk_integrity(spark, sf_dir):
    frames = {t: base(spark, sf_dir, t) for t in ("lineitem", "part", "customer")}
    frames["orders"] = derive(spark, sf_dir, SHIFTED)
    checks = [
        ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
        ForeignKey("lineitem", "l_suppkey", "part", "p_partkey"),
        ForeignKey("lineitem", "l_orderkey", "customer", "c_custkey"),
    ]
    return quality.fk_integrity(frames, checks)


@query("""
SELECT 'orders' AS table_name, 'o_orderkey' AS pk, count(*) AS repeated_keys
  FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) AS a
UNION ALL SELECT 'lineitem', 'l_orderkey', count(*)
  FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) AS b""")
def pk_unique(spark, sf_dir):
    pks = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    return quality.pk_unique({t: base(spark, sf_dir, t) for t in pks}, pks)


SPANS = """
SELECT CASE WHEN o_orderkey % 50 > 0 THEN CAST(o_orderdate AS STRING) END AS valid_from,
  CASE WHEN o_orderstatus = 'F' THEN concat(1995 + o_orderkey % 7, '-06-01') END AS valid_to
FROM orders"""


@query(f"""
WITH spans AS ({SPANS})
SELECT count(*) AS n_rows, count(*) FILTER (WHERE valid_from > valid_to) AS start_after_end,
  count(*) FILTER (WHERE valid_to IS NULL) AS open_rows,
  count(*) FILTER (WHERE valid_from IS NULL) AS without_start FROM spans""")
def scd2_checks(spark, sf_dir):
    return quality.scd2_checks(derive(spark, sf_dir, SPANS))


@query("""
SELECT 'o_orderstatus' AS column_name, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))
  AS outside FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority NOT IN ('5-LOW'))
  FROM orders""")
def domain_check(spark, sf_dir):
    domains = {"o_orderstatus": ["F", "O"], "o_orderpriority": ["5-LOW"]}
    return quality.domain_check(base(spark, sf_dir, "orders"), domains)


CONTRACT = ["order_key", "line_count", "title", "is_active_flag", "sort_order", "missing_id"]


@query("""
SELECT CAST(l_orderkey AS BIGINT) AS order_key,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS BIGINT) END AS line_count,
  concat(l_linenumber, '') AS title, CAST(1 AS BIGINT) AS is_active_flag,
  CAST(l_suppkey AS BIGINT) AS sort_order, CAST(NULL AS BIGINT) AS missing_id FROM lineitem""")
def schema_contract(spark, sf_dir):
    df = derive(spark, sf_dir, """
    SELECT concat(l_orderkey, '') AS order_key, l_linenumber AS title, 1 AS is_active_flag,
      CASE WHEN l_returnflag = 'A' THEN concat(l_linenumber, '') ELSE 'many' END AS line_count,
      l_suppkey AS sort_order, l_tax AS extra FROM lineitem""")
    return contract.conform(df, CONTRACT)


SYNC_LOG = """
SELECT CAST(ts AS STRING) AS end_time, CASE event_type WHEN 'purchase' THEN 'completed'
  ELSE event_type END AS status, CAST(floor(value) AS BIGINT) - 40 AS records_added,
  CAST(event_id % 3 AS BIGINT) - 1 AS records_updated FROM events"""


@query(f"""
WITH sync_log AS ({SYNC_LOG})
SELECT max(end_time) AS last_sync_date FROM sync_log
WHERE status = 'completed' AND (records_added > 0 OR records_updated > 0)""")
def last_sync(spark, sf_dir):
    return quality.last_sync(derive(spark, sf_dir, SYNC_LOG))


CURRENT = "SELECT event_type AS key, concat(max(event_id), '') AS value FROM events GROUP BY event_type"
CHANGES = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'click' ELSE o_orderstatus END AS key,
  concat(count(*), '') AS value FROM orders GROUP BY 1"""


@query(f"""
WITH current AS ({CURRENT}), changes AS ({CHANGES})
SELECT * FROM changes UNION ALL SELECT * FROM current WHERE key NOT IN (SELECT key FROM changes)""")
def metadata_upsert(spark, sf_dir):
    return contract.metadata_upsert(
        derive(spark, sf_dir, CURRENT), derive(spark, sf_dir, CHANGES)
    )


# --- expressions -------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, coalesce(NULLIF(o_orderstatus, 'P'), 'Unknown') AS status,
  coalesce(NULLIF(o_custkey, 5), 0) AS customer, 'Unknown' AS region,
  coalesce(NULLIF(o_orderpriority, '5-LOW'), o_orderstatus) AS either FROM orders""")
def expr_coalesce(spark, sf_dir):
    return base(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("Unknown")).alias("status"),
        F.coalesce(F.nullif("o_custkey", F.lit(5)), F.lit(0)).alias("customer"),
        F.coalesce(F.lit(None), F.lit("Unknown")).alias("region"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), "o_orderstatus").alias("either"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size = 7 THEN 1 ELSE 0 END AS flag, CASE WHEN p_size = 7
  THEN 'top-level' ELSE 'sub-product' END AS level, CASE WHEN NULLIF(p_type, 'SMALL') IS NULL
  THEN 1 ELSE 0 END AS is_missing FROM part""")
def expr_case(spark, sf_dir):
    size = F.concat(F.col("p_size"), F.lit(""))
    return base(spark, sf_dir, "part").select(
        "p_partkey",
        codes.case_code(size, 7, 1, 0).alias("flag"),
        codes.case_code(F.col("p_size"), 7, "top-level", "sub-product").alias("level"),
        codes.is_null_flag(F.nullif("p_type", F.lit("SMALL"))).alias("is_missing"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' WHEN o_orderpriority = '5-LOW'
  THEN 'later' ELSE 'Other' END AS label, CASE WHEN o_orderstatus = 'F' THEN 'done' END AS state
FROM orders""")
def expr_case_multi(spark, sf_dir):
    return base(spark, sf_dir, "orders").select(
        "o_orderkey",
        codes.case_text(
            F.col("o_orderpriority"), {"1-URGENT": "now", "5-LOW": "later"}, "Other"
        ).alias("label"),
        codes.case_text(F.col("o_orderstatus"), {"F": "done"}).alias("state"),
    )
