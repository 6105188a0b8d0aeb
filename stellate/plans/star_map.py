"""The star schema: 14 dimensions, 3 facts and 8 bridges.

Fixed values throughout: table and column names, option-set names, identifiers and labels.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.functions import codes
from stellate.functions.text import iso_date_prefix
from stellate.operators.dimensions import phase_name
from stellate.operators.quality import ForeignKey
from stellate.plans.spec import (
    Branch,
    Bridge,
    Calc,
    CompositeFk,
    CountryBridge,
    DateDimension,
    DelimitedBridge,
    DelimitedDimension,
    Dimension,
    DistinctDimension,
    Fact,
    Fk,
    Iso,
    Label,
    OptionDimension,
    PhaseDimension,
    Source,
    Table,
    ViaFact,
)

CANDIDATE_TYPES = {
    "c1746ad3-93d1-f011-bbd3-00224892cefa": "Candidate",
    "545d63d9-93d1-f011-bbd3-00224892cefa": "Product",
}
TOP_LEVEL_PRODUCT = 909670000
UNKNOWN = "Unknown"


def or_text(column: str, default: str) -> Calc:
    return Calc(lambda c: F.coalesce(c(column).cast("string"), F.lit(default)), (column,))


def or_number(column: str, default: int) -> Calc:
    """The number itself, in its own type, or the default."""
    return Calc(lambda c: F.coalesce(c(column), F.lit(default)), (column,))


def stage_phase(c):
    return phase_name(F.nullif(c, F.lit("")))


DIMENSIONS: tuple[Table, ...] = (
    Dimension(
        "dim_product",
        "vin_products",
        {
            "vin_productid": Source("vin_productid"),
            "product_name": Source("vin_name"),
            "product_type": Source("vin_name"),
            "product_level": Calc(
                lambda c: codes.case_code(
                    c("vin_type"), TOP_LEVEL_PRODUCT, "top-level", "sub-product"
                ),
                ("vin_type",),
            ),
            "parent_product_id": Source("_vin_relatedproduct_value"),
        },
        "product_key",
        "vin_productid",
    ),
    Dimension(
        "dim_disease",
        "vin_diseases",
        {
            "diseaseid": Source("diseaseid"),
            "disease_name": Source("name"),
            "disease_group_name": Source("disease"),
            "global_health_area": Label("globalhealtharea"),
            "disease_type": or_text("disease_simple", UNKNOWN),
            "disease_filter": Source("disease_filter"),
            "secondary_disease_name": Source("secondary_disease_name"),
        },
        "disease_key",
        "diseaseid",
    ),
    PhaseDimension(
        "dim_phase",
        "vin_rdstages",
        {
            "vin_rdstageid": Source("vin_rdstageid"),
            "phase_name": Source("vin_name"),
            "sort_order": Source("sort_order"),
        },
        "phase_key",
        "phase_name",
        referenced_in=("vin_candidates", "new_currentrdstage"),
    ),
    Dimension(
        "dim_geography",
        "vin_countries",
        {
            "vin_countryid": Source("vin_countryid"),
            "country_name": Source("vin_name"),
            "iso_code": Iso("vin_name"),
            "region_name": Calc(lambda c: F.lit(UNKNOWN)),
        },
        "country_key",
        "vin_countryid",
    ),
    Dimension(
        "dim_organization",
        "accounts",
        {
            "accountid": Source("accountid"),
            "org_name": Source("name"),
            "org_type": or_text("vin_organisationtype", UNKNOWN),
        },
        "organization_key",
        "accountid",
    ),
    Dimension(
        "dim_priority",
        "vin_rdpriorities",
        {
            "rdpriorityid": Source("rdpriorityid"),
            "priority_name": Source("ppctitle"),
            "indication": or_text("indication", ""),
            "intended_use": or_text("intendeduse", ""),
            "disease_key": Fk("dim_disease", "diseasevalue"),
            "product_key": Fk("dim_product", "product_value"),
            "author": Source("author"),
            "publication_date": Source("publicationdate"),
            "target_population": Source("targetpopulation"),
            "efficacy": Source("efficacy"),
            "safety": Source("safety"),
            "source": Source("source"),
            "dedicated_to_women_or_children": Label("crc8b_dedicatedtowomenorchildren"),
        },
        "priority_key",
        "rdpriorityid",
    ),
    DateDimension(
        "dim_date", None, {}, "date_key", "full_date", first_year=2015, last_year=2030
    ),
    OptionDimension(
        "dim_age_group", None, {}, "age_group_key", "option_code",
        option_set="agespecific", label="age_group_name",
    ),
    OptionDimension(
        "dim_approving_authority", None, {}, "authority_key", "option_code",
        option_set="approvingauthority", label="authority_name",
    ),
    Dimension(
        "dim_candidate_core",
        "vin_candidates",
        {
            "candidateid": Source("candidateid"),
            "candidate_name": Source("candidate_name"),
            "vin_candidate_code": Source("vin_candidateno"),
            "developers_agg": Source("developersaggregated"),
            "alternative_names": Source("alternativenames"),
            "target": Source("target"),
            "mechanism_of_action": Source("mechanismofaction"),
            "key_features": Source("keyfeatureschallenges"),
            "known_funders_agg": Source("knownfundersaggregated"),
            "development_status": Label("developmentstatus"),
            "current_rd_stage": Source("new_currentrdstage"),
            "countries_approved_count": Source("numberofcountrieswithproductapproval"),
            "countries_approved_agg": Source("countries_product_approved"),
            "candidate_type": Calc(
                lambda c: codes.case_text(c("captype_value"), CANDIDATE_TYPES, "Other"),
                ("captype_value",),
            ),
            "indication": Source("indication"),
            "indication_type": Label("indicationtype"),
            "healthcare_facility_level": Label(
                "healthcarefacilitylevel", "vin_healthcarefacilitylevel"
            ),
            "preclinical_results_status": Label("preclinicalresultsstatus"),
            "type_of_preclinical_results": Source("typeofpreclinicalresults"),
            "preclinical_results_source": Source("preclinicalresultssource"),
            "recent_updates": Source("recentupdates"),
            "test_format": Label("testformat"),
            "technology_principle": Source("technologyprinciple"),
            "target_population": Source("new_targetpopulation"),
            "route_of_administration": Source("routeofadministration"),
            "platform": Source("new_platform"),
            "chim_study": Label("chimstudyyesno", "new_chimstudyyesno"),
            "key_clinical_trial": Source("ctregistrylink"),
        },
        "candidate_key",
        "candidateid",
    ),
    DistinctDimension(
        "dim_candidate_tech",
        "vin_candidates",
        {"technology_type": or_text("technologytype", UNKNOWN)},
        "technology_key",
    ),
    DistinctDimension(
        "dim_candidate_regulatory",
        "vin_candidates",
        {
            "approval_status": Label("approvalstatus"),
            "fda_approval_date": Source("usfdaapprovaldate"),
            "who_prequal_date": Source("whoprequalificationdate"),
            "who_prequalification": Label("whoprequalification"),
            "nra_approval_status": Label("NRAapprovalstatus"),
            "sra_approval_status": Label("SRA_approvalstatus"),
            "ema_approval_status": Label("emaapprovalstatus", "vin_emaapprovalstatus"),
            "japanese_mhlw_approval_status": Label(
                "japanesemhlwapprovalstatus", "vin_japanesemhlwapprovalstatus"
            ),
            "us_fda_approval_status": Label("usfdaapprovalstatus", "vin_usfdaapprovalstatus"),
        },
        "regulatory_key",
    ),
    DelimitedDimension(
        "dim_developer", "vin_candidates", {}, "developer_key", "developer_name",
        column="developersaggregated", out="developer_name",
    ),
    DelimitedDimension(
        "dim_funder", "vin_candidates", {}, "funder_key", "funder_name",
        column="knownfundersaggregated", out="funder_name",
    ),
)

FACTS: tuple[Table, ...] = (
    Fact(
        "fact_pipeline_snapshot",
        "vin_candidates",
        {
            "candidate_key": Fk("dim_candidate_core", "candidateid"),
            "product_key": Fk("dim_product", "mainproduct_value"),
            "disease_key": Fk("dim_disease", "diseasevalue"),
            "sub_product_key": Fk("dim_product", "subproduct_value"),
            "technology_key": CompositeFk("dim_candidate_tech"),
            "regulatory_key": CompositeFk("dim_candidate_regulatory"),
            "phase_key": Fk("dim_phase", "new_currentrdstage", stage_phase),
            "date_key": Fk("dim_date", "valid_from", iso_date_prefix),
            "is_active_flag": Calc(lambda c: codes.is_null_flag(c("valid_to")), ("valid_to",)),
            "include_in_pipeline": Source("include_in_pipeline"),
        },
        "snapshot_id",
        infill=True,
    ),
    Fact(
        "fact_clinical_trial_event",
        "vin_clinicaltrials",
        {
            "clinicaltrialid": Source("clinicaltrialid"),
            "candidate_key": Fk("dim_candidate_core", "candidate_value"),
            "disease_key": ViaFact("fact_pipeline_snapshot", "candidate_key"),
            "product_key": ViaFact("fact_pipeline_snapshot", "candidate_key"),
            "start_date_key": Fk("dim_date", "startdate"),
            "trial_name": Source("name"),
            "trial_title": Source("title"),
            "trial_phase": Source("ctphase"),
            "enrollment_count": or_number("cttenrolment", 0),
            "status": Label("ctstatus"),
            "sponsor": Source("sponsor"),
            "locations": Source("locations"),
            "age_groups": Source("age"),
            "study_type": Source("studytype"),
            "source_text": Source("vin_source"),
            "description": Source("description"),
            "ct_results_status": Label("ctresultsstatus", "vin_ctresultsstatus"),
            "end_date_key": Fk("dim_date", "enddate", iso_date_prefix),
            "last_updated_key": Fk("dim_date", "lastupdated", iso_date_prefix),
            "collaborator": Source("collaborator"),
            "funder_type": Source("fundertype"),
            "interventions": Source("interventions"),
            "conditions": Source("conditions"),
            "primary_completion_date_key": Fk(
                "dim_date", "primarycompletiondate", iso_date_prefix
            ),
            "outcome_measure": Calc(
                lambda c: F.coalesce(c("outcomemeasure_primary"), c("outcomemeasure_secondary")),
                ("outcomemeasure_primary", "outcomemeasure_secondary"),
            ),
            "sex": Source("sex"),
            "study_design": Source("study_design"),
            "ct_results_type": Label("ctresultstype", "vin_ctresultstype"),
            "ct_terminated_reason": Source("ctterminatedreason"),
        },
        "trial_id",
        "clinicaltrialid",
    ),
    Fact(
        "fact_publication",
        "vin_sources",
        {
            "candidate_key": Fk("dim_candidate_core", "_vin_regardingid_value"),
            "title": Source("vin_name"),
            "url": Source("vin_url"),
            "description": Source("vin_description"),
        },
        "publication_id",
    ),
)

BRIDGES: tuple[Table, ...] = (
    CountryBridge(
        "bridge_candidate_geography",
        None,
        entity_key="candidate_key",
        entity_table="dim_candidate_core",
        constants=("location_scope",),
        branches=(
            Branch(
                "_junction_vin_candidates_new_targetcountry",
                "entity_id",
                "option_code",
                "label",
                "new_targetcountry",
                {"location_scope": "Target Country"},
            ),
            Branch(
                "vin_developers",
                "candidateid",
                "country_name",
                "name",
                constants={"location_scope": "Developer Location"},
            ),
        ),
    ),
    DelimitedBridge(
        "bridge_candidate_developer",
        "vin_candidates",
        {
            "candidate_key": Fk("dim_candidate_core", "candidateid"),
            "developer_key": Fk("dim_developer", "developersaggregated"),
        },
        column="developersaggregated",
    ),
    Bridge(
        "bridge_candidate_priority",
        "vin_vin_candidate_vin_rdpriorityset",
        {
            "candidate_key": Fk("dim_candidate_core", "vin_candidateid"),
            "priority_key": Fk("dim_priority", "vin_rdpriorityid"),
        },
    ),
    Bridge(
        "bridge_candidate_age_group",
        "_junction_vin_candidates_new_agespecific",
        {
            "candidate_key": Fk("dim_candidate_core", "entity_id"),
            "age_group_key": Fk("dim_age_group", "option_code"),
        },
    ),
    Bridge(
        "bridge_candidate_approving_authority",
        "_junction_vin_candidates_vin_approvingauthority",
        {
            "candidate_key": Fk("dim_candidate_core", "entity_id"),
            "authority_key": Fk("dim_approving_authority", "option_code"),
        },
    ),
    Bridge(
        "bridge_candidate_organization",
        "vin_vin_candidate_accountset",
        {
            "candidate_key": Fk("dim_candidate_core", "vin_candidateid"),
            "organization_key": Fk("dim_organization", "accountid"),
        },
    ),
    DelimitedBridge(
        "bridge_candidate_funder",
        "vin_candidates",
        {
            "candidate_key": Fk("dim_candidate_core", "candidateid"),
            "funder_key": Fk("dim_funder", "knownfundersaggregated"),
        },
        column="knownfundersaggregated",
    ),
    CountryBridge(
        "bridge_trial_geography",
        None,
        entity_key="trial_key",
        entity_table="fact_clinical_trial_event",
        branches=(
            Branch(
                "vin_vin_clinicaltrial_vin_countryset",
                "vin_clinicaltrialid",
                "vin_countryid",
                "id",
            ),
            Branch("vin_clinicaltrials", "clinicaltrialid", "locations", "locations"),
        ),
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in (*DIMENSIONS, *FACTS, *BRIDGES)}


def foreign_keys() -> list[ForeignKey]:
    """Every foreign key of the star, read from the table descriptions."""
    checks = []
    for table in TABLES.values():
        for column, spec in table.columns.items():
            if isinstance(spec, (Fk, CompositeFk)):
                parent = TABLES[spec.dimension]
            elif isinstance(spec, ViaFact):
                target = TABLES[spec.fact].columns[column]
                parent = TABLES[target.dimension]
            else:
                continue
            checks.append(ForeignKey(table.name, column, parent.name, parent.pk))
        if isinstance(table, CountryBridge):
            entity = TABLES[table.entity_table]
            checks.append(ForeignKey(table.name, table.entity_key, entity.name, entity.pk))
            checks.append(
                ForeignKey(table.name, "country_key", "dim_geography", "country_key")
            )
    return checks
