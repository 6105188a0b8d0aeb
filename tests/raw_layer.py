"""A small raw layer with the cases the jobs must get right."""

from stellate.sources.layers import Layer

CANDIDATES = """
    row_id bigint, vin_candidateid string, vin_name string, statecode bigint,
    vin_2019stagepcr string, new_2023currentrdstage string, _vin_currentrndstage_value string,
    vin_2019pcrpipelineinclusion string, new_includeinpipeline2021 bigint,
    new_includeinpipeline bigint, new_pressuretype string, vin_product string,
    vin_approvalstatus bigint, new_indicationtype bigint, vin_developersaggregated string,
    vin_knownfundersaggregated string, _vin_mainproduct_value string, _vin_disease_value string,
    vin_technologytype string, new_ctregistrylink string, _vin_captype_value string,
    json_response string, new_allempty string
"""

TABLES = {
    "vin_candidates": (
        CANDIDATES,
        [
            (1, "c1", "One", 0, "Preclinical - Drugs", None, "s3", "Yes", 100000001, 100000000,
             "Negative pressure ", "Drug", 862890001, 100000003, "Acme; Beta ;", "Fund A",
             "p1", "d1", "mRNA", "x\nnct001", "c1746ad3-93d1-f011-bbd3-00224892cefa", "{}", None),
            (2, "c2", "Two", 0, None, "Phase I/II", "unknown", None, None, None,
             None, "Vaccine", 909670000, 100000000, "Beta", None,
             "p2", None, None, "http://a", None, "{}", None),
            (3, "c3", "Gone", 1, "Phase I", None, None, "Yes", None, None,
             None, None, None, None, "Lost", None, None, None, None, None, None, "{}", None),
            (4, "c4", "Four", 0, None, None, None, "maybe", None, None,
             None, None, None, None, None, None, None, None, None, "none", None, "{}", None),
        ],
    ),
    "vin_rdstageproducts": (
        "vin_rdstageproductid string, vin_name string",
        [("s3", "Phase III - Drugs"), ("s4", "Approved - x - Drugs")],
    ),
    "vin_rdstages": (
        "row_id bigint, vin_rdstageid string, vin_name string",
        [
            (1, "st1", "Phase III"),
            (2, "st2", "Phase III"),
            (3, "st3", "Phase II"),
            (4, "st4", "Phase IX"),
            (5, "st5", ""),
        ],
    ),
    "vin_products": (
        "row_id bigint, vin_productid string, vin_name string, vin_type bigint, "
        "_vin_relatedproduct_value string",
        [(1, "p1", "Drugs", 909670000, None), (2, "p2", "Vaccines", 1, "p1")],
    ),
    "vin_diseases": (
        "row_id bigint, vin_diseaseid string, vin_name string, new_diseasefilter string, "
        "new_secondary_diseae_choice_text string, new_globalhealtharea bigint, "
        "valid_from string, valid_to string, statecode bigint",
        [
            (1, "d1", "Gonorrhea", "STIs - Gonorrhea ", "Gonorrhea", 5, None, None, 1),
            (2, "d2", "Malaria", "Malaria ", "No secondary disease", 6, None, None, 0),
            (3, "d3", "Other", "A - B", "", None, None, None, 0),
        ],
    ),
    "vin_rdpriorities": (
        "row_id bigint, vin_rdpriorityid string, vin_name string, new_author string, "
        "new_ppctitle string, _vin_disease_value string, _vin_product_value string",
        [
            (1, "r1", "n", "World Health Organization", "T1", "d1", "p2"),
            (2, "r2", "n", "Other", "T2", "nope", None),
        ],
    ),
    "vin_countries": (
        "row_id bigint, vin_countryid string, vin_name string, vin_countryno bigint",
        [
            (1, "k1", "Turkey", 90),
            (2, "k2", "France", 33),
            (3, "k3", "United Kingdom", 44),
            (4, "k4", "European Union", None),
        ],
    ),
    "accounts": (
        "row_id bigint, accountid string, name string, vin_organisationtype string, "
        "address1_country string",
        [
            (1, "a1", "Acme", "5001", "Türkiye"),
            (2, "a2", "Beta", "NGO", "33.0"),
            (3, "a3", "Gamma", None, "Not specified"),
            (4, "a4", "Delta", "1e3", "united kingdom "),
        ],
    ),
    "vin_developers": (
        "row_id bigint, vin_developerid string, vin_name string, _vin_cap_value string, "
        "_vin_developer_value string, statecode bigint",
        [
            (1, "v1", "x", "c1", "a1", 0),
            (2, "v2", "x", "c1", "a2", 0),
            (3, "v3", "x", "c2", "a3", 0),
            (4, "v4", "x", "c2", "a4", 0),
            (5, "v5", "x", "c9", "a2", 0),
            (6, "v6", "x", "c2", None, 0),
        ],
    ),
    "vin_clinicaltrials": (
        "row_id bigint, vin_clinicaltrialid string, _vin_candidate_value string, "
        "vin_ctphase string, new_age string, new_sex string, new_studytype string, "
        "vin_ctstatus bigint, vin_ctenrolment bigint, vin_startdate string, vin_enddate string, "
        "new_locations string, vin_name string, valid_from string, valid_to string",
        [
            (1, "t1", "c1", "Phase 2/3", "18 Years and older", "All", "Interventional study",
             100000002, None, "2020-01-02", "2021-05-06T00:00:00Z",
             "Site, Paris, france|Clinic (UK); Unknown", "n1", None, None),
            (2, "t2", "c2", "early_phase1", "Child", "F", "other",
             909670001, 12, "2020-01-02T00:00:00Z", "short",
             "England|Scotland|Narnia", "n2", None, None),
            (3, "t3", None, None, None, None, None, None, 3, None, "2035-01-01", None,
             "n3", None, None),
        ],
    ),
    "vin_sources": (
        "row_id bigint, _vin_regardingid_value string, vin_name string, vin_url string",
        [(1, "c1", "Paper", "http://p"), (2, "zz", "Lost", None)],
    ),
    "vin_vin_candidate_vin_rdpriorityset": (
        "vin_candidateid string, vin_rdpriorityid string",
        [("c1", "r1"), ("c1", "r1"), ("c2", "zz")],
    ),
    "vin_vin_candidate_accountset": (
        "vin_candidateid string, accountid string", [("c2", "a2"), ("c3", "a2")],
    ),
    "vin_vin_clinicaltrial_vin_countryset": (
        "vin_clinicaltrialid string, vin_countryid string", [("t1", "k2"), ("t1", "k1")],
    ),
    "_junction_vin_candidates_new_agespecific": (
        "entity_id string, option_code bigint", [("c1", 2), ("c1", 9)],
    ),
    "_junction_vin_candidates_vin_approvingauthority": (
        "entity_id string, option_code bigint", [("c2", 909670001)],
    ),
    "_junction_vin_candidates_new_targetcountry": (
        "entity_id string, option_code bigint", [("c1", 7), ("c1", 7), ("c1", 8)],
    ),
    "_optionset_new_targetcountry": (
        "code bigint, label string, first_seen string",
        [(7, "France", "x"), (8, "Atlantis", "x")],
    ),
    "_optionset_new_agespecific": (
        "code bigint, label string, first_seen string", [(2, "Adults", "x"), (1, "Kids", "x")],
    ),
    "_optionset_vin_approvingauthority": (
        "code bigint, label string, first_seen string",
        [(909670001, "SRA", "x"), (909670002, "SRA Other", "x")],
    ),
    "_optionset_vin_approvalstatus": (
        "code bigint, label string, first_seen string",
        [(909670000, "Approved", "x"), (862890001, "Adopted", "x")],
    ),
    "_optionset_vin_ctstatus": (
        "code bigint, label string, first_seen string",
        [(909670001, "Active", "x"), (100000002, "Recruiting", "x")],
    ),
    "_optionset_new_globalhealtharea": (
        "code bigint, label string, first_seen string",
        [(5, "Sexual & reproductive health", "x"), (6, "Neglected", "x")],
    ),
    "_sync_log": (
        "end_time string, status string, records_added bigint, records_updated bigint",
        [
            ("2024-01-01", "completed", 3, 0),
            ("2024-03-01", "completed", 0, 0),
            ("2024-02-01", "completed", 0, 1),
            ("2024-04-01", "failed", 5, 5),
        ],
    ),
    "empty_table": ("a string", []),
}


def write_raw_layer(spark, folder):
    layer = Layer(spark, folder)
    for name, (schema, rows) in TABLES.items():
        layer.write(name, spark.createDataFrame(rows, schema).coalesce(1))
    return folder
