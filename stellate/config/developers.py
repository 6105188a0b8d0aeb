"""Fixed values for the developers table."""

# Columns removed on the way to the clean layer.
DROPPED = [
    "row_id",
    "_organizationid_value",
    "utcconversiontimezonecode",
    "importsequencenumber",
    "_modifiedonbehalfby_value",
    "_createdonbehalfby_value",
    "versionnumber",
    "_new_developerid_value",
    "_modifiedby_value",
    "statuscode",
    "overriddencreatedon",
    "_createdby_value",
    "timezoneruleversionnumber",
    "json_response",
    "sync_time",
]

# Column renames.
RENAMED = {
    "vin_developerid": "developerid",
    "vin_name": "developer_product_name",
    "_vin_cap_value": "candidateid",
    "_vin_developer_value": "accountid",
    "vin_organisationtype": "org_type",
}
