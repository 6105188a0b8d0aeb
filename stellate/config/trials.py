"""Fixed values for the clinical trials table."""

# Columns removed on the way to the clean layer.
DROPPED = [
    "new_aim1ctlastupdated",
    "new_aim1ctnumber",
    "new_includedaim1",
    "_ownerid_value",
    "new_aim1listsctid",
    "_modifiedby_value",
    "new_aim1ctstatus",
    "new_aim1pcrreviewnotes",
    "new_pipsct",
    "_createdby_value",
    "vin_pcrreviewcomments",
    "_owningbusinessunit_value",
    "new_resultsfirstposted",
    "versionnumber",
    "new_primaryoutcomemeasures",
    "timezoneruleversionnumber",
    "new_secondaryoutcomemeasures",
    "_owninguser_value",
    "json_response",
    "sync_time",
    "new_studydocuments",
    "vin_ctresultssource",
]

# Column renames.
RENAMED = {
    "new_studydesign": "study_design",
    "new_collaborator": "collaborator",
    "new_test": "test",
    "vin_ctphase": "ctphase",
    "vin_ctid": "ctid",
    "new_sponsor": "sponsor",
    "new_fundertype": "fundertype",
    "vin_ctterminatedreason": "ctterminatedreason",
    "vin_clinicaltrialid": "clinicaltrialid",
    "new_locations": "locations",
    "new_primarycompletiondate": "primarycompletiondate",
    "_vin_candidate_value": "candidate_value",
    "new_firstposted": "firstposted",
    "new_outcomemeasure_secondary": "outcomemeasure_secondary",
    "vin_ctresultstype": "ctresultstype",
    "vin_title": "title",
    "vin_enddate": "enddate",
    "new_outcomemeasure_primary": "outcomemeasure_primary",
    "new_interventions": "interventions",
    "vin_ctresultsstatus": "ctresultsstatus",
    "vin_ctenrolment": "cttenrolment",
    "vin_endtype": "endtype",
    "vin_lastupdated": "lastupdated",
    "new_age": "age",
    "vin_startdate": "startdate",
    "new_sex": "sex",
    "vin_ctrialid": "trialid",
    "new_conditions": "conditions",
    "vin_starttype": "starttype",
    "vin_description": "description",
    "new_indicationtype": "indicationtype",
    "vin_ctterminatedtype": "ctterminatedtype",
    "vin_recentupdates": "recentupdates",
    "vin_name": "name",
    "new_studytype": "studytype",
    "vin_ctstatus": "ctstatus",
}

# Status codes merged into "active".
STATUS_CODES = {
    100000001: 909670001,
    100000002: 909670001,
    100000003: 909670001,
    100000004: 909670001,
    100000005: 909670001,
    100000006: 909670001,
    909670003: 909670001,
}

# Codes removed from the status option set.
OPTION_CODES_REMOVED = {
    "_optionset_vin_ctstatus": [
        100000001,
        100000002,
        100000003,
        100000004,
        100000005,
        100000006,
        909670003,
    ],
}
