"""Fixed values for the diseases table."""

# Columns removed on the way to the clean layer.
DROPPED = [
    "row_id",
    "createdon",
    "modifiedon",
    "_organizationid_value",
    "crc8b_addedclinicalvalue",
    "crc8b_tppppc",
    "crc8b_addedclinicalvaluedescription",
    "crc8b_p2iproductlaunch",
    "statuscode",
    "statecode",
    "_createdby_value",
    "new_globalhealthareaportal",
    "importsequencenumber",
    "new_incl_eid",
    "_modifiedby_value",
    "new_incl_nd",
    "json_response",
    "sync_time",
]

# Column renames.
RENAMED = {
    "vin_disease": "disease",
    "vin_name": "name",
    "vin_type": "type",
    "new_secondary_diseae_choice_text": "secondary_disease_name",
    "vin_diseasecode": "diseasecode",
    "_vin_product_value": "product_value",
    "new_disease_simple": "disease_simple",
    "new_diseasefilter": "disease_filter",
    "new_disease_sort": "diseasesort",
    "new_secondary_disease_filter": "secondary_disease_filter",
    "new_disease_choice_text": "diseasechoice_text",
    "vin_diseaseid": "diseaseid",
    "_vin_maindisease_value": "maindisease_value",
    "new_globalhealtharea": "globalhealtharea",
}

# Text standing for "no secondary disease".
NO_SECONDARY = ["", "No secondary disease"]

# Option labels renamed.
HEALTH_AREA_LABELS = {"Sexual & reproductive health": "Womens Health"}
HEALTH_AREA_OPTIONS = "_optionset_new_globalhealtharea"
