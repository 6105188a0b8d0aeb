"""Fixed values for option-set tables."""

PREFIX = "_optionset_"

# Option-set tables renamed in the clean layer.
RENAMED_TABLES = {
    "_optionset_vin_approvalstatus": "_optionset_approvalstatus",
    "_optionset_vin_developmentstatus": "_optionset_developmentstatus",
    "_optionset_vin_whoprequalification": "_optionset_whoprequalification",
    "_optionset_vin_nationalregulatoryauthorityapprovalstatus": "_optionset_NRAapprovalstatus",
    "_optionset_new_indicationtype": "_optionset_indicationtype",
    "_optionset_vin_preclinicalresultsstatus": "_optionset_preclinicalresultsstatus",
    "_optionset_new_agespecific": "_optionset_agespecific",
    "_optionset_new_testformat": "_optionset_testformat",
    "_optionset_vin_approvingauthority": "_optionset_approvingauthority",
    "_optionset_vin_stringentregulatoryauthorityapproval": "_optionset_SRA_approvalstatus",
    "_optionset_vin_ctstatus": "_optionset_ctstatus",
    "_optionset_new_globalhealtharea": "_optionset_globalhealtharea",
}

# Clean-layer columns that hold option-set codes: the table names without the prefix.
CODE_COLUMNS = sorted(name.removeprefix(PREFIX) for name in RENAMED_TABLES.values())
