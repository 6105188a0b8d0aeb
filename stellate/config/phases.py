"""Fixed values for research phases."""

# Display order of phases.
SORT_ORDER = {
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

DEFAULT_SORT_ORDER = 500

# Phase names rewritten before lookup.
ALIASES = {
    "Approved product": "Approved",
    "Discovery and Preclinical": "Discovery & Preclinical",
    "Discovery and preclinical": "Discovery & Preclinical",
    "N/A": "Not applicable",
}
