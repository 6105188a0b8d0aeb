"""Fixed values for the priorities table."""

# Columns removed on the way to the clean layer.
DROPPED = [
    "row_id",
    "crc8b_includeinipps",
    "_owninguser_value",
    "statecode",
    "_ownerid_value",
    "importsequencenumber",
    "_modifiedby_value",
    "crc8b_addedclinicalvalue",
    "crc8b_p2iproductlaunchbasedonrdpriority",
    "_createdby_value",
    "statuscode",
    "timezoneruleversionnumber",
    "crc8b_realisticlaunch",
    "_owningbusinessunit_value",
    "json_response",
    "sync_time",
]

# Column renames.
RENAMED = {
    "vin_name": "name",
    "new_safety": "safety",
    "new_targetpopulation": "targetpopulation",
    "_vin_disease_value": "diseasevalue",
    "vin_rdpriorityid": "rdpriorityid",
    "new_publicationdate": "publicationdate",
    "new_efficacy": "efficacy",
    "new_indication": "indication",
    "new_intendeduse": "intendeduse",
    "new_source": "source",
    "_vin_secondarydisease_value": "secondarydiseasevalue",
    "new_ppctitle": "ppctitle",
    "_vin_product_value": "product_value",
    "new_author": "author",
}

# Author names.
AUTHORS = {"World Health Organization": "WHO"}
